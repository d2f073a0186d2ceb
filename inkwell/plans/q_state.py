"""Queries for seen-state, throttle, latest-row, upsert, constraints and run stats.

``events`` stands in for the crawl log: (event_type, user_id) plays the
(source, url) key of the seen-URL state; for run statistics the site is
``'src' || user_id % 4``, a run is one clock hour, and purchase / error events
are scraped items / row errors.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from inkwell.operators import merge as M
from inkwell.operators import quality as V
from inkwell.operators import seen as S
from inkwell.operators import stats as ST
from inkwell.plans.catalog import ORACLE, query, table

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TS_SQL_FMT = "%Y-%m-%d %H:%M:%S.%f"
SPLIT = "2024-01-16 00:00:00"


# ------------------------------------------------ J-2, F-2, SRC-4, SNK-6
@query(
    "seen_anti_join",
    f"WITH seen AS (SELECT event_type, user_id, max(ts) AS last_accept_at FROM events "
    f"WHERE ts < TIMESTAMP '{SPLIT}' GROUP BY 1, 2) "
    f"SELECT c.event_id, c.user_id, c.event_type FROM events c WHERE c.ts >= TIMESTAMP '{SPLIT}' "
    "AND NOT EXISTS (SELECT 1 FROM seen s WHERE s.event_type = c.event_type AND s.user_id = c.user_id "
    "AND c.ts < s.last_accept_at + INTERVAL 24 HOUR)",
)
def seen_anti_join(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    before = F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz")
    seen = S.advance_seen(None, ev.filter(before), ["event_type", "user_id"], "ts")
    cand = ev.filter(~before)
    kept = S.drop_recently_seen(cand, seen, ["event_type", "user_id"], "ts")
    return kept.select("event_id", "user_id", "event_type")


# ------------------------------------------------------------------ W-3
_TTL_SQL = (
    "WITH RECURSIVE e AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS t, "
    "row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events), "
    "r AS (SELECT user_id, event_type, rn, t AS last_t, event_id, true AS acc FROM e WHERE rn = 1 "
    "UNION ALL SELECT e.user_id, e.event_type, e.rn, "
    "CASE WHEN e.t >= r.last_t + 86400000000 THEN e.t ELSE r.last_t END, e.event_id, "
    "e.t >= r.last_t + 86400000000 FROM r JOIN e ON e.user_id = r.user_id AND e.event_type = r.event_type "
    "AND e.rn = r.rn + 1) SELECT event_id, user_id, event_type FROM r WHERE acc"
)


@query("ttl_throttle", _TTL_SQL)
def ttl_throttle(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    out = S.ttl_throttle(ev, ["user_id", "event_type"], "ts", 86400, tiebreak="event_id")
    return out.select("event_id", "user_id", "event_type")


@query("ttl_throttle_hot_keys", _TTL_SQL)
def ttl_throttle_hot_keys(spark, sf):
    """Same answer by pointer doubling: every key is treated as too large to gather."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    out = S.ttl_throttle(ev, ["user_id", "event_type"], "ts", 86400, tiebreak="event_id", max_group=0)
    return out.select("event_id", "user_id", "event_type")


@query(
    "seen_state_table",
    _TTL_SQL.replace("SELECT event_id, user_id, event_type FROM r WHERE acc",
                     "SELECT user_id, event_type, strftime(make_timestamp(last_t), '" + TS_SQL_FMT + "') AS last_accept_at FROM r "
                     "WHERE acc AND last_t > (SELECT max(t) FROM e) - 86400000000"),
)
def seen_state_table(spark, sf):
    """Three runs over the events against a stored state: what is left are the marks of the last 24 hours."""
    from inkwell.operators import seen_state as SS
    from inkwell.session import scratch_dir

    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    state, keys = scratch_dir(spark, "seen_state") + "/marks", ["user_id", "event_type"]
    bounds = [F.lit(b).cast("timestamp_ntz") for b in ("2024-01-11 00:00:00", "2024-01-21 00:00:00")]
    ts = F.col("ts")
    for k, run in enumerate((ts < bounds[0], (ts >= bounds[0]) & (ts < bounds[1]), ts.isNull() | (ts >= bounds[1]))):
        SS.throttle_run(spark, ev.filter(run), state, keys, "ts", f"run{k}", 86400, tiebreak="event_id")
    newest = ev.agg(F.max("ts")).first()[0]
    marks = SS.live_marks(spark, state, ev, keys, newest - _dt.timedelta(days=1))
    return marks.select("user_id", "event_type", F.date_format("last_accept_at", TS_FMT).alias("last_accept_at"))


# ----------------------------------------------------------- W-1, U-1
def _doc_items(spark, sf, version: int):
    d = table(spark, sf, "documents")
    i = F.col("doc_id")
    head = F.split(F.col("text"), "\n").getItem(0)
    return d.select(
        "doc_id",
        (head if version == 1 else F.concat(F.lit("v2 "), head)).alias("heading"),
        F.col("text").alias("content"),
        (F.concat(F.lit("Desk "), F.col("source")) if version == 1
         else F.when(i % 2 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("Desk "), F.col("source")))).alias("author"),
        F.lit(f"2025-06-0{version}T09:00:00+05:00").alias("date"),
        F.col("lang").alias("category"),
        F.concat(F.lit("https://news.example.com/"), F.md5("text")).alias("url"),
        F.date_format(F.lit(f"2025-06-0{version} 00:00:00").cast("timestamp") + F.make_dt_interval(secs=i.cast("decimal(18,6)")),
                      "yyyy-MM-dd'T'HH:mm:ss").alias("processed_at"),
        F.col("source").alias("spider_name"),
    )


def _items_sql(version: int) -> str:
    head = "split_part(text, chr(10), 1)" if version == 1 else "'v2 ' || split_part(text, chr(10), 1)"
    author = ("'Desk ' || source" if version == 1
              else "CASE WHEN doc_id % 2 = 0 THEN NULL ELSE 'Desk ' || source END")
    return (
        f"SELECT doc_id, {head} AS heading, text AS content, {author} AS author, "
        f"DATE '2025-06-0{version}' AS date, lang AS category, 'https://news.example.com/' || md5(text) AS url, "
        f"TIMESTAMP '2025-06-0{version} 00:00:00' + to_seconds(doc_id) AS processed_at, source AS spider_name FROM documents"
    )


@query(
    "latest_per_url",
    f"WITH d AS ({_items_sql(1)}) SELECT url, doc_id FROM d "
    "QUALIFY row_number() OVER (PARTITION BY url ORDER BY processed_at DESC) = 1",
)
def latest_per_url(spark, sf):
    items = _doc_items(spark, sf, 1)
    return M.latest_per_url(items).select("url", "doc_id")


# ------------------------------------------- J-3, W-4, SNK-4, P-16, P-12
RUN1, RUN2 = "2025-06-01 12:00:00", "2025-06-02 12:00:00"
# Two crawl runs over the documents, split by language (a share of the data
# at every scale): English articles are crawled by both runs (updates), German
# only by the first (kept as they are), all others only by the second (inserts).
# Every seventh article of either run has no url: it never conflicts.
def _run_batch(spark, sf, version: int):
    items = _doc_items(spark, sf, version).withColumn("url", F.when(F.col("doc_id") % 7 != 0, F.col("url")))
    lang = F.coalesce("category", F.lit(""))  # a NULL language is one of the others
    first = lang.isin("en", "de")
    return items.filter(first if version == 1 else ~first | (lang == "en"))


def _batch_sql(version: int) -> str:
    langs = "category IN ('en', 'de')" if version == 1 else "(category IS NULL OR category NOT IN ('en', 'de') OR category = 'en')"
    return f"SELECT * REPLACE (CASE WHEN doc_id % 7 <> 0 THEN url END AS url) FROM ({_items_sql(version)}) WHERE {langs}"


def _newest_sql(version: int) -> str:
    return (f"SELECT * FROM ({_batch_sql(version)}) WHERE url IS NULL UNION ALL SELECT * FROM ({_batch_sql(version)}) "
            "WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY url ORDER BY processed_at DESC) = 1")


_DIGEST_SQL = "md5(concat_ws(chr(31), " + ", ".join(
    f"coalesce('=' || {f}, '')" for f in ("heading", "content", "author", "category", "spider_name")) + "))"
_ID_ORDER = f"ORDER BY url IS NULL, url, {_DIGEST_SQL}"
_NEWS_COLS = ("id, url, heading, content, author, strftime(date, '%Y-%m-%d') AS date, category, "
              f"strftime(processed_at, '{TS_SQL_FMT}') AS processed_at, spider_name, "
              f"strftime(created_at, '{TS_SQL_FMT}') AS created_at, strftime(updated_at, '{TS_SQL_FMT}') AS updated_at")


@query(
    "upsert_articles",
    f"WITH b1 AS ({_newest_sql(1)}), "
    f"t1 AS (SELECT row_number() OVER ({_ID_ORDER}) AS id, heading, content, author, date, category, url, processed_at, "
    f"spider_name, TIMESTAMP '{RUN1}' AS created_at, TIMESTAMP '{RUN1}' AS updated_at FROM b1), "
    f"b2 AS ({_newest_sql(2)}), "
    f"upd AS (SELECT t1.id, b2.heading, b2.content, b2.author, b2.date, b2.category, t1.url, b2.processed_at, "
    f"b2.spider_name, t1.created_at, TIMESTAMP '{RUN2}' AS updated_at FROM t1 JOIN b2 ON t1.url = b2.url), "
    "keep AS (SELECT * FROM t1 WHERE NOT EXISTS (SELECT 1 FROM b2 WHERE b2.url = t1.url)), "
    f"ins AS (SELECT (SELECT max(id) FROM t1) + row_number() OVER ({_ID_ORDER}) AS id, heading, content, author, date, "
    f"category, url, processed_at, spider_name, TIMESTAMP '{RUN2}' AS created_at, TIMESTAMP '{RUN2}' AS updated_at "
    "FROM b2 WHERE NOT EXISTS (SELECT 1 FROM t1 WHERE t1.url = b2.url)), "
    "u AS (SELECT * FROM upd UNION ALL SELECT * FROM keep UNION ALL SELECT * FROM ins) "
    f"SELECT {_NEWS_COLS} FROM u",
)
def upsert_articles(spark, sf):
    b1 = M.to_load_rows(_run_batch(spark, sf, 1))
    b2 = M.to_load_rows(_run_batch(spark, sf, 2))
    # The table after the first run is stored (a checkpoint here), as it would
    # be between two scheduled runs.
    t1 = M.upsert(M.empty_news(spark), b1, RUN1).checkpoint(eager=True)
    t2 = M.upsert(t1, b2, RUN2)
    return t2.select(
        "id", "url", "heading", "content", "author", F.date_format("date", "yyyy-MM-dd").alias("date"), "category",
        F.date_format("processed_at", TS_FMT).alias("processed_at"), "spider_name",
        F.date_format("created_at", TS_FMT).alias("created_at"), F.date_format("updated_at", TS_FMT).alias("updated_at"),
    )


@query("upsert_table")
def upsert_table(spark, sf):
    """Same two runs as ``upsert_articles`` against a stored table: each run
    appends a delta of its batch's size."""
    from inkwell.session import scratch_dir

    path = scratch_dir(spark, "news_table") + "/news"
    b1 = M.to_load_rows(_run_batch(spark, sf, 1))
    b2 = M.to_load_rows(_run_batch(spark, sf, 2))
    M.upsert_into(spark, path, b1, RUN1)
    M.upsert_into(spark, path, b2, RUN2)
    t2 = M.read_news(spark, path)
    return t2.select(
        "id", "url", "heading", "content", "author", F.date_format("date", "yyyy-MM-dd").alias("date"), "category",
        F.date_format("processed_at", TS_FMT).alias("processed_at"), "spider_name",
        F.date_format("created_at", TS_FMT).alias("created_at"), F.date_format("updated_at", TS_FMT).alias("updated_at"),
    )


def chain_sql(steps: list[tuple[str, str]]) -> str:
    """The article table after upserting each (batch SQL, run time) in turn into an empty table."""
    ctes = ["t0 AS (SELECT CAST(0 AS BIGINT) AS id, heading, content, author, date, category, url, processed_at, spider_name, "
            f"TIMESTAMP '2000-01-01' AS created_at, TIMESTAMP '2000-01-01' AS updated_at FROM ({steps[0][0]}) LIMIT 0)"]
    fields = "heading, content, author, date, category, url, processed_at, spider_name"
    for k, (batch, ts) in enumerate(steps, 1):
        ctes += [
            f"b{k} AS (SELECT {fields} FROM ({batch}) WHERE url IS NULL UNION ALL SELECT {fields} FROM ({batch}) WHERE url IS NOT NULL "
            "QUALIFY row_number() OVER (PARTITION BY url ORDER BY processed_at DESC) = 1)",
            f"t{k} AS MATERIALIZED (SELECT t.id, {', '.join('b.' + f for f in fields.split(', '))}, t.created_at, TIMESTAMP '{ts}' AS updated_at "
            f"FROM t{k - 1} t JOIN b{k} b ON t.url = b.url "
            f"UNION ALL SELECT * FROM t{k - 1} t WHERE t.url IS NULL OR NOT EXISTS (SELECT 1 FROM b{k} b WHERE b.url = t.url) "
            f"UNION ALL SELECT (SELECT coalesce(max(id), 0) FROM t{k - 1}) + row_number() OVER ({_ID_ORDER}) AS id, {fields}, "
            f"TIMESTAMP '{ts}', TIMESTAMP '{ts}' FROM b{k} b WHERE NOT EXISTS (SELECT 1 FROM t{k - 1} t WHERE t.url = b.url))",
        ]
    return f"WITH {', '.join(ctes)} SELECT {_NEWS_COLS} FROM t{len(steps)}"


@query(
    "upsert_counts",
    f"WITH b1 AS ({_newest_sql(1)}), d2 AS ({_newest_sql(2)}) "
    "SELECT 'inserted' AS metric, count(*) AS value FROM d2 WHERE NOT EXISTS (SELECT 1 FROM b1 WHERE b1.url = d2.url) "
    "UNION ALL SELECT 'updated', count(*) FROM d2 WHERE EXISTS (SELECT 1 FROM b1 WHERE b1.url = d2.url) "
    f"UNION ALL SELECT 'input_rows', count(*) FROM ({_batch_sql(2)})",
)
def upsert_counts(spark, sf):
    b1 = M.to_load_rows(_run_batch(spark, sf, 1))
    b2 = M.to_load_rows(_run_batch(spark, sf, 2))
    return M.upsert_counts(M.latest_per_url(b1), b2)


# ----------------------------------------------------------- V-4, SNK-8
@query(
    "constraint_violations",
    "WITH d AS (SELECT CASE WHEN doc_id % 13 = 0 THEN NULL ELSE split_part(text, chr(10), 1) END AS heading, "
    "'https://news.example.com/' || md5(text) AS url FROM documents) "
    "SELECT 'heading_null' AS kind, url, count(*) AS n FROM d WHERE heading IS NULL GROUP BY url "
    "UNION ALL SELECT 'url_duplicate', url, count(*) FROM d WHERE url IS NOT NULL GROUP BY url HAVING count(*) > 1",
)
def constraint_violations(spark, sf):
    d = table(spark, sf, "documents").select(
        F.when(F.col("doc_id") % 13 == 0, F.lit(None).cast("string")).otherwise(F.split("text", "\n").getItem(0)).alias("heading"),
        F.concat(F.lit("https://news.example.com/"), F.md5("text")).alias("url"),
    )
    return V.violations(d)


# ------------------------------------------------ A-1, A-4, W-2, SNK-5, ST-4/5
def _crawl_log(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select(
        "event_id", "ts",
        F.concat(F.lit("src"), (F.col("user_id") % 4).cast("string")).alias("source"),
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:00").alias("run_id"),
        F.to_date("ts").alias("date"),
        F.when(F.col("event_type") == "purchase", "scraped").when(F.col("event_type") == "error", "error")
        .otherwise("found").alias("kind"),
        F.when(F.col("event_type") == "error", F.element_at(F.array(F.lit(404), F.lit(403), F.lit(429), F.lit(503)), (F.col("event_id") % 4 + 1).cast("int")))
        .otherwise(200).alias("status"),
        F.floor(F.col("value") * 1000).alias("bytes"),
    )


_LOG_SQL = (
    "SELECT event_id, ts, 'src' || (user_id % 4) AS source, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:00') AS run_id, "
    "CAST(ts AS DATE) AS date, CASE event_type WHEN 'purchase' THEN 'scraped' WHEN 'error' THEN 'error' ELSE 'found' END AS kind, "
    "CASE WHEN event_type = 'error' THEN [404, 403, 429, 503][CAST(event_id % 4 + 1 AS INT)] ELSE 200 END AS status, "
    "CAST(floor(value * 1000) AS BIGINT) AS bytes FROM events"
)
_RUN_STATS_SQL = (
    f"SELECT source, run_id, min(date) AS date, count(*) AS articles_found, count(*) FILTER (WHERE kind = 'scraped') AS articles_scraped, "
    f"count(*) FILTER (WHERE kind = 'error') AS errors, min(ts) AS run_start, max(ts) AS run_end FROM ({_LOG_SQL}) GROUP BY source, run_id"
)


def _run_stats(spark, sf):
    log = _crawl_log(spark, sf)
    rs = ST.run_stats(log, "source", "run_id", "ts", "kind")
    return rs.withColumn("date", F.to_date("run_start"))


@query(
    "run_stats",
    f"SELECT source, run_id, articles_found, articles_scraped, errors, strftime(run_start, '{TS_SQL_FMT}') AS run_start, "
    f"strftime(run_end, '{TS_SQL_FMT}') AS run_end FROM ({_RUN_STATS_SQL})",
)
def run_stats(spark, sf):
    log = _crawl_log(spark, sf)
    rs = ST.run_stats(log, "source", "run_id", "ts", "kind")
    return rs.select("source", "run_id", "articles_found", "articles_scraped", "errors",
                     F.date_format("run_start", TS_FMT).alias("run_start"), F.date_format("run_end", TS_FMT).alias("run_end"))


@query(
    "last_run_stats",
    f"SELECT source, strftime(date, '%Y-%m-%d') AS date, run_id, articles_found, articles_scraped, errors, 'finished' AS reason "
    f"FROM ({_RUN_STATS_SQL}) QUALIFY row_number() OVER (PARTITION BY source, date ORDER BY run_end DESC, run_id DESC) = 1",
)
def last_run_stats(spark, sf):
    rs = _run_stats(spark, sf)
    last = ST.last_run_stats(rs, "source", "date", "run_end", "run_id")
    return last.select("source", F.date_format("date", "yyyy-MM-dd").alias("date"), "run_id", "articles_found",
                       "articles_scraped", "errors", F.lit("finished").alias("reason"))


@query(
    "daily_stats",
    f"SELECT source, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, count(*) AS articles_found, "
    "count(*) FILTER (WHERE kind = 'scraped') AS articles_scraped, count(*) FILTER (WHERE kind = 'error') AS errors "
    f"FROM ({_LOG_SQL}) GROUP BY 1, 2",
)
def daily_stats(spark, sf):
    log = _crawl_log(spark, sf).withColumn("day", F.date_format("date", "yyyy-MM-dd"))
    return ST.run_stats(log, "source", "day", "ts", "kind").select(
        "source", F.col("day").alias("date"), "articles_found", "articles_scraped", "errors")


@query(
    "status_rollup",
    "SELECT source, run_id, count(*) AS requests, count(*) FILTER (WHERE status NOT BETWEEN 200 AND 299) AS n_ignored, "
    f"CAST(sum(bytes) AS BIGINT) AS bytes_in, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000 AS elapsed_ms FROM ({_LOG_SQL}) "
    "GROUP BY source, run_id",
)
def status_rollup(spark, sf):
    return ST.status_rollup(_crawl_log(spark, sf), ["source", "run_id"])


@query("status_counts", f"SELECT source, run_id, status, count(*) AS n FROM ({_LOG_SQL}) GROUP BY source, run_id, status")
def status_counts(spark, sf):
    """Every status that occurs has a count, 429 and 503 as well."""
    return ST.status_counts(_crawl_log(spark, sf), ["source", "run_id"])


@query(
    "rate_per_minute",
    "SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS window_start, count(*) AS events, "
    "count(*) FILTER (WHERE event_type = 'purchase') AS items FROM events GROUP BY 1",
)
def rate_per_minute(spark, sf):
    ev = table(spark, sf, "events").withColumn("is_item", F.col("event_type") == "purchase")
    r = ST.rate(ev, "ts", "1 minute", item_flag="is_item")
    return r.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "events", "items")


# ------------------------------------------------------------------ SRC-5
ARTICLE_SQL = (
    "SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars "
    "FROM news_docs WHERE n_chars >= :min_chars GROUP BY lang, source"
)


@query(
    "article_sql",
    "SELECT lang, source, CAST(count(*) FILTER (WHERE n_chars >= 1500) AS BIGINT) AS n, "
    "CAST(sum(CASE WHEN n_chars >= 1500 THEN n_chars ELSE 0 END) AS BIGINT) AS chars FROM documents GROUP BY lang, source "
    "HAVING count(*) FILTER (WHERE n_chars >= 1500) > 0",
)
def article_sql(spark, sf):
    from inkwell.sources.sql import article_sql as run_sql

    docs = table(spark, sf, "documents")
    return run_sql(spark, ARTICLE_SQL, {"min_chars": 1500}, views={"news_docs": docs})


ORACLE["upsert_table"] = ORACLE["upsert_articles"]
