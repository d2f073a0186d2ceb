"""Queries that exercise whole flows and rules on inputs with known answers.

Page and feed bodies are built around the md5 of every document's text, so the
expected text is stated by the SQL from the same inputs and not from the patterns
under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import text as T
from inkwell.functions import urls as U
from inkwell.functions.dates import publish_ts, ts_string
from inkwell.operators import extract as X
from inkwell.operators import merge as M
from inkwell.operators import seen as S
from inkwell.operators import stats as ST
from inkwell.plans import q_files, q_state, q_stream
from inkwell.plans.catalog import cores, query, table
from inkwell.plans.pipeline import etl_flow
from inkwell.registry import DAWN, TRIBUNE
from inkwell.session import scratch_dir
from inkwell.sinks import files as FS
from inkwell.sources.landing import read_landing

_RUNS = ("2025-06-03T10:00:00", "2025-06-03T11:00:00")


# ------------------------------------------------------------------ SNK-2
@query(
    "per_run_export",
    f"SELECT url, spider_name, r AS run_ts, heading FROM ({q_files._ITEMS_SQL}), (VALUES ('{_RUNS[0]}'), ('{_RUNS[1]}')) v(r)",
)
def per_run_export(spark, sf):
    """Two runs of one day: each is kept under its own run time."""
    out = scratch_dir(spark, "per_run")
    for run in _RUNS:
        FS.export_articles(q_files._items(spark, sf).drop("lang"), out, "2025-06-03", per_run=run)
    back = read_landing(spark, out, layout="lines")
    return back.select("url", "spider_name", F.date_format(F.col("run_ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("run_ts"), "heading")


# ------------------------------------------------------------------ SNK-5
@query(
    "stats_sink",
    f"SELECT source, strftime(date, '%Y-%m-%d') AS date, articles_found, articles_scraped, errors, "
    "CASE WHEN errors = 0 THEN 'finished' ELSE 'finished with errors' END AS reason "
    f"FROM ({q_state._RUN_STATS_SQL}) QUALIFY row_number() OVER (PARTITION BY source, date ORDER BY run_end DESC, run_id DESC) = 1",
)
def stats_sink(spark, sf):
    """Run records are written twice, first the first run of each day and then the
    last; what is read back is one record per (source, day), the last."""
    rs = q_state._run_stats(spark, sf).withColumn(
        "reason", F.when(F.col("errors") == 0, "finished").otherwise("finished with errors"))
    out = scratch_dir(spark, "stats") + "/t"
    first = rs.groupBy("source", "date").agg(F.min_by(F.struct("articles_found", "articles_scraped", "errors", "reason"), "run_end").alias("r"))
    FS.write_stats(first.select("source", "date", "r.*"), out)
    last = ST.last_run_stats(rs, "source", "date", "run_end", "run_id")
    FS.write_stats(last.select("source", "date", "articles_found", "articles_scraped", "errors", "reason"), out)
    return spark.read.json(out).select("source", F.date_format(F.col("date").cast("date"), "yyyy-MM-dd").alias("date"), "articles_found",
                                       "articles_scraped", "errors", "reason")


# ----------------------------------------------------------- SNK-8, SNK-3
@query(
    "create_and_append",
    f"SELECT row_number() OVER ({q_state._ID_ORDER}) AS id, url, heading, spider_name FROM ({q_files._ITEMS_SQL})",
)
def create_and_append(spark, sf):
    """The table is created, created again (no effect), and filled from id 1."""
    path = scratch_dir(spark, "created") + "/news"
    FS.create_news(spark, path, append_variant=True)
    M.append_articles(spark, M.to_load_rows(q_files._items(spark, sf)), path)
    FS.create_news(spark, path, append_variant=True)
    return spark.read.parquet(path).select("id", "url", "heading", "spider_name")


# --------------------------------------- SNK-7, Entry B, V-4, D-10, SRC-3
_LAND_SQL = (
    "SELECT CASE WHEN doc_id % 13 = 0 THEN NULL ELSE 'h ' || md5(text) END AS heading, "
    "CASE WHEN doc_id % 11 = 0 THEN 'someday' ELSE '2025-06-03' END AS date, "
    f"'{q_files.BASE}' || doc_id AS url, source AS spider_name FROM documents"
)


def _landing(spark, sf):
    i = F.col("doc_id")
    return table(spark, sf, "documents").select(
        "doc_id", F.when(i % 13 != 0, F.concat(F.lit("h "), F.md5("text"))).alias("heading"),
        F.when(i % 11 == 0, "someday").otherwise("2025-06-03").alias("date"),
        F.concat(F.lit(q_files.BASE), i.cast("string")).alias("url"),
        F.lit(q_files.RUN_ISO).alias("processed_at"), F.col("source").alias("spider_name"))


def _load_twice(spark, sf):
    """Export (a task writes one file name into the folders of all its sources), load, and load again."""
    land, base = scratch_dir(spark, "flow_landing"), scratch_dir(spark, "flow")
    FS.export_articles(_landing(spark, sf).drop("doc_id"), land, "2025-06-03")
    counts = [etl_flow(spark, land, f"{base}/news", f"{base}/archive", f"2025-06-03 1{k}:00:00", layout="lines") for k in (2, 3)]
    return base, counts


@query(
    "load_rejects",
    f"SELECT url, spider_name, 'heading is null' AS reason FROM ({_LAND_SQL}) WHERE heading IS NULL UNION ALL "
    f"SELECT url, spider_name, 'unreadable date' FROM ({_LAND_SQL}) WHERE heading IS NOT NULL AND date = 'someday' UNION ALL "
    f"SELECT url, spider_name, 'loaded' FROM ({_LAND_SQL}) WHERE heading IS NOT NULL AND date <> 'someday'",
)
def load_rejects(spark, sf):
    """Rows that break a constraint are kept apart with a reason; the rest is loaded."""
    base, _ = _load_twice(spark, sf)
    loaded = M.read_news(spark, f"{base}/news").select("url", "spider_name", F.lit("loaded").alias("reason"))
    return spark.read.json(f"{base}/news_rejects").select("url", "spider_name", "reason").unionByName(loaded)


@query(
    "archive_partitions",
    "SELECT source AS spider_name, '2025-06-03' AS export_date, count(*) AS rows, "
    "(SELECT count(*) FROM documents) AS first_load, 0 AS second_load FROM documents GROUP BY source",
)
def archive_partitions(spark, sf):
    """Every source's file reaches the archive under its own path, and nothing is left to load."""
    base, counts = _load_twice(spark, sf)
    arch = read_landing(spark, f"{base}/archive", layout="lines")
    return arch.groupBy("spider_name", F.col("export_date").cast("string").alias("export_date")).agg(
        F.count(F.lit(1)).alias("rows")).withColumns(
        {"first_load": F.lit(counts[0]).cast("long"), "second_load": F.lit(counts[1])})


@query(
    "archive_resumed",
    "SELECT source AS spider_name, count(*) AS archived, 0 AS loaded_again FROM documents GROUP BY source",
)
def archive_resumed(spark, sf):
    """A run broke once its rows were in and a part of its files had moved: the next run archives
    the rest before it looks for news, so every row is archived once and none is loaded again."""
    from inkwell.sinks.archive import archive
    from inkwell.sources.landing import landing_manifest

    land, base = scratch_dir(spark, "resume_landing"), scratch_dir(spark, "resume")
    FS.export_articles(_landing(spark, sf).drop("doc_id"), land, "2025-06-03")
    read = landing_manifest(read_landing(spark, land, layout="lines")).select("source_file")
    read.select(F.col("source_file").alias("file")).write.parquet(f"{base}/archive_journal/open/broken")
    todo = spark.read.parquet(f"{base}/archive_journal/open/broken")
    archive(spark, todo.filter(F.xxhash64("file") % 2 == 0), land, f"{base}/archive", "file")  # what the broken run had moved
    n = etl_flow(spark, land, f"{base}/news", f"{base}/archive", "2025-06-03 12:00:00", layout="lines")
    arch = read_landing(spark, f"{base}/archive", layout="lines")
    return arch.groupBy("spider_name").agg(F.count(F.lit(1)).alias("archived")).withColumn("loaded_again", F.lit(n))


@query("landing_array", f"SELECT heading, date, url, spider_name FROM ({_LAND_SQL})")
def landing_array(spark, sf):
    """Files that hold one JSON array each, as the exporter of array files writes them; an array
    holds at most the items of 256 ids, so arrays do not grow with the table."""
    path = scratch_dir(spark, "arrays")
    item = F.struct("heading", "date", "url", "processed_at", "spider_name")
    rows = _landing(spark, sf).withColumn("_g", F.floor(F.col("doc_id") / 256))
    files = rows.groupBy("spider_name", "_g").agg(F.collect_list(F.to_json(item)).alias("items"))
    FS.write_arrays(files.select("items"), path)
    return read_landing(spark, path, layout="array", glob="*.txt").select("heading", "date", "url", "spider_name")


# -------------------------------------------------------------------- X-1
@query(
    "item_chain",
    f"WITH i AS (SELECT * REPLACE (CASE WHEN heading IS NULL THEN NULL ELSE '  ' || heading END AS heading) FROM ({_LAND_SQL})), "
    "s AS (SELECT *, CASE WHEN heading IS NULL THEN 'validation' WHEN date = 'someday' THEN 'dates' END AS stage FROM i) "
    "SELECT url, spider_name, coalesce(stage, 'export') AS stage, CASE stage WHEN 'validation' THEN 'Missing heading in ' || url "
    "WHEN 'dates' THEN 'no day' END AS reason, CASE WHEN stage = 'validation' THEN heading ELSE trim(heading) END AS heading FROM s",
)
def item_chain(spark, sf):
    """Three stages, listed in another order than they run: validation (200), a rule of one's own (300), export (400)."""
    from inkwell.plans import chain as C

    out = scratch_dir(spark, "chain") + "/out"
    items = _landing(spark, sf).drop("processed_at").withColumns(
        {"heading": F.concat(F.lit("  "), F.col("heading")), "content": F.lit("text"), "lang": F.col("spider_name")})
    done = C.run_chain(items, [
        C.export(out, "2025-06-03", columns=["heading", "url", "date", "processed_at", "spider_name"]),
        C.reject_where("dates", 300, [(F.col("date") == "someday", "no day")]),
        C.validation(q_files.RUN_ISO)])
    cols = ["url", "spider_name", "stage", "reason", "heading"]
    stored = read_landing(spark, out, layout="lines").withColumns({"stage": F.lit("export"), "reason": F.lit(None).cast("string")})
    return stored.select(*cols).unionByName(done.rejects.select(*cols))


# -------------------------------------------------------------------- F-6
@query(
    "request_dedupe",
    "SELECT page_id, 'p' || page_id AS first_seen, 'http://h.example.com/a/' || page_id || '?b=2&c=1' AS link FROM pages",
)
def request_dedupe(spark, sf):
    """Every page is requested under four spellings of one url; the first stays."""
    pid = F.col("page_id").cast("string")
    head = F.concat(F.lit("http://h.example.com/a/"), pid)
    forms = [F.concat(head, F.lit("?b=2&c=1")), F.concat(F.lit("HTTP://H.EXAMPLE.COM/a/"), pid, F.lit("?c=1&b=2")),
             F.concat(head, F.lit("?b=2&c=1#top")), F.concat(head, F.lit("?c=1&b=2#x"))]
    req = table(spark, sf, "pages").select("page_id", F.posexplode(F.array(*forms)).alias("pos", "link"))
    req = req.withColumn("canon", U.canonical_url(F.col("link")))
    out = S.dedupe_requests(req.withColumn("first_seen", F.when(F.col("pos") == 0, F.concat(F.lit("p"), pid))), ["canon"], "pos")
    return out.select("page_id", "first_seen", "link")


# -------------------------------------------------------------- X-2, P-9
def _container_page(source, h):
    """A page per source with two or nested containers, decoys, and end tags in scripts."""
    w = lambda n: F.substring(h, n * 8 + 1, 8)
    dawn = F.concat(
        F.lit('<html><!-- <div class="story__content"><p>no</p></div> --><div class="story__contents x"><p>'), w(0),
        F.lit('</p><script>var a = "</div></article>";</script><div><p>'), w(1),
        F.lit("</p></div></div><div class=other><p>no</p></div><div data-x='>' class=story__content><p>"), w(2),
        F.lit('<a title="1 > 2">'), w(3), F.lit("</a></div><p>no</p></html>"))
    tribune = F.concat(
        F.lit("<div id='main-section-2'><p>no</p></div><main id=main-section><div><p>"), w(0), F.lit("</p></div><p> "), w(1),
        F.lit(" <p>"), w(2), F.lit("</main><p>no</p>"))
    return F.when(source == "dawn_latest", dawn).otherwise(tribune)


@query(
    "source_rules",
    "WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'tribune_latest' ELSE 'dawn_latest' END AS source, md5(text) AS h FROM documents) "
    "SELECT doc_id, source, substr(h, 1, 8) || ' ' || substr(h, 9, 8) || ' ' || substr(h, 17, 8) || "
    "CASE WHEN source = 'dawn_latest' THEN ' ' || substr(h, 25, 8) ELSE '' END AS text FROM d",
)
def source_rules(spark, sf):
    """Two sources with different container rules in one plan."""
    d = table(spark, sf, "documents", cores(spark)).select(
        "doc_id", F.when(F.col("doc_id") % 3 == 0, "tribune_latest").otherwise("dawn_latest").alias("source"), F.md5("text").alias("h"))
    page = _container_page(F.col("source"), F.col("h"))
    return d.withColumn("html", page).select(
        "doc_id", "source", X.page_fallback_text(F.col("source"), F.col("html"), (DAWN, TRIBUNE)).alias("text"))


def _positioned_page(h):
    """The path's paragraphs, twice, amid decoys in every other position."""
    w = lambda n: F.substring(h, n * 8 + 1, 8)
    inner = '<div><div class="x"><div><span><p>no</p></span><b><span><p>no</p></span></b>'
    return F.concat(
        F.lit('<body><div id="main-section"><div><p>no</p></div><section><p>no<div><div><div><p>no</p></div></div></div></section>'
              '<section data-x="/>"><br><div><div><div><div>' + inner + "<span><i>"), F.lit("</i><p>"), w(0), F.lit(" <b>"), w(1),
        F.lit("</b><p>"), w(2), F.lit("</span><span><p>no</p></span></div></div></div></div></div><div><p>no</p></div></div>"
                                      "<div><div><div><span><p>no</p></span></div></div></div></section></div>"),
        F.lit("<section id=main-section><section><div><div><div><div>" + inner + "<span><p>"), w(3),
        F.lit("</p><div><p>no</p></div></span></div></div></div></div></div></div></section></section></body>"))


@query(
    "container_path",
    "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN substr(h, 1, 8) || ' ' || substr(h, 9, 8) WHEN doc_id % 4 = 1 THEN NULL "
    "ELSE substr(h, 1, 8) || ' ' || substr(h, 9, 8) || ' ' || substr(h, 17, 8) || ' ' || substr(h, 25, 8) END AS text "
    "FROM (SELECT doc_id, md5(text) AS h FROM documents)",
)
def container_path(spark, sf):
    """Paragraphs at a path with positions, in all elements of the id; pages without the path give the
    whole container, or nothing to a strict rule."""
    from dataclasses import replace

    from inkwell.functions.container import container_text

    d = table(spark, sf, "documents", cores(spark)).select("doc_id", F.md5("text").alias("h"))
    i = F.col("doc_id")
    flat = F.concat(F.lit("<main id=main-section><div><p>"), F.substring("h", 1, 8), F.lit("</div></main><p>no<div id='main-section'><span><p>"),
                    F.substring("h", 9, 8), F.lit("</p></span>"))
    d = d.withColumn("html", F.when(i % 4 < 2, flat).otherwise(_positioned_page(F.col("h"))))
    strict = replace(TRIBUNE.container, strict=True)
    return d.select("doc_id", F.when(i % 2 == 1, container_text(F.col("html"), strict))
                    .otherwise(container_text(F.col("html"), TRIBUNE.container)).alias("text"))


# -------------------------------------------------------------------- P-8
@query(
    "rare_references",
    "SELECT doc_id, '✓ © 2025 A A ¬it; ' || md5(text) || ' &unknown; ≪⃒ &lt; €' AS text FROM documents",
)
def rare_references(spark, sf):
    """Names beyond the common ones, names without ';', padded numbers, markup made of references."""
    html = F.concat(F.lit("<p>&check; &copy 2025 &#0000000065; &#x000000041; &notit; "), F.md5("text"),
                    F.lit(" &unknown; &nLt; &amp;lt; &#128;</p>"))
    return table(spark, sf, "documents", cores(spark)).select("doc_id", T.paragraph_text(html).alias("text"))


# ------------------------------------------------------------------- P-11
_ISO_FORMATS = ["yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd HH:mm:ss'.123'", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm:ss'+05:00'"]


@query(
    "iso_dates",
    "SELECT event_id, strftime(CASE event_id % 5 WHEN 0 THEN date_trunc('day', ts) WHEN 1 THEN date_trunc('minute', ts) "
    "WHEN 2 THEN date_trunc('second', ts) WHEN 3 THEN date_trunc('minute', ts) ELSE date_trunc('second', ts) - INTERVAL 5 HOUR END, "
    "'%Y-%m-%d %H:%M:%S') AS published_at FROM events",
)
def iso_dates(spark, sf):
    """ISO spellings with parts left out: date only, minutes only, a fraction after a space."""
    ev = table(spark, sf, "events")
    raw = F.lit(None).cast("string")
    for k, fmt in enumerate(_ISO_FORMATS):
        raw = F.when(F.col("event_id") % 5 == k, F.date_format(F.col("ts"), fmt)).otherwise(raw)
    return ev.select("event_id", ts_string(publish_ts(raw)).alias("published_at"))


# Spellings: (format of the written time, what follows, hours that the written time is ahead, unit it is cut to).
_SPELLINGS = [
    ("EEE, dd MMM yyyy HH:mm", " +0000", 0, "minute"), ("EEE, dd MMM yy HH:mm:ss", " GMT", 0, "second"),
    ("yyyyMMdd'T'HHmmss", "Z", 0, "second"), ("yyyy-MM-dd'T'HH:mm:ss", ",123+00:00", 0, "second"),
    ("yyyy-MM-dd'T'HH:mm:ss", ".123456789Z", 0, "second"), ("yyyy-MM-dd'T'HH", "+05:00", 5, "hour"),
    ("EEEE, dd-MMM-yy HH:mm:ss", " PKT", 5, "second"), ("EEE MMM d HH:mm:ss yyyy", "", 0, "second"),
    ("dd MMMM yyyy", "", 0, "day"), ("d MMM yyyy HH:mm:ss", " -0330 (local time)", -3.5, "second"),
    ("yyyyMMdd HHmm", "+0545", 5.75, "minute"), ("yyyy-MM-dd HH:mm", "-05", -5, "minute"),
    ("EEE,dd MMM yyyy HH:mm:ss.SSS", " EST", -5, "millisecond"), ("yyyy-MM-dd'T'HH:mm:ss", "+05:30:15", 5 + 1815 / 3600, "second"),
    ("yyyy-MM-30'T'HH:mm:ss", "+25:00", 0, None), ("EEE, 32 MMM yyyy HH:mm:ss", " GMT", 0, None),
]


@query(
    "date_spellings",
    f"SELECT event_id, strftime(CASE event_id % {len(_SPELLINGS)} " + " ".join(
        f"WHEN {k} THEN date_trunc('{unit}', ts + to_seconds({round(h * 3600)})) - to_seconds({round(h * 3600)})" if unit else f"WHEN {k} THEN NULL"
        for k, (_, _, h, unit) in enumerate(_SPELLINGS)) + " END, '%Y-%m-%d %H:%M:%S') AS published_at FROM events",
)
def date_spellings(spark, sf):
    """Sixteen ways to write a publish date, two of which name no date."""
    ev = table(spark, sf, "events")
    raw = F.lit(None).cast("string")
    for k, (fmt, tail, hours, _) in enumerate(_SPELLINGS):
        at = F.col("ts").cast("timestamp") + F.make_dt_interval(secs=F.lit(round(hours * 3600)))
        raw = F.when(F.col("event_id") % len(_SPELLINGS) == k, F.concat(F.date_format(at, fmt), F.lit(tail))).otherwise(raw)
    return ev.select("event_id", ts_string(publish_ts(raw)).alias("published_at"))


# ------------------------------------------------------- ST-1 (late rows)
_FIRST = "(SELECT * FROM events WHERE event_id IS NULL OR event_id % 10 <> 0)"


@query(
    "stream_late_rows",
    q_state._TTL_SQL.replace("FROM events", f"FROM {_FIRST}").replace(
        "SELECT event_id, user_id, event_type FROM r WHERE acc",
        ", newest AS (SELECT max(ts) AS m FROM " + _FIRST + "), "
        "marks AS (SELECT user_id, event_type, max(last_t) AS t FROM r WHERE acc GROUP BY 1, 2 "
        "HAVING max(last_t) > (SELECT epoch_us(m) FROM newest) - 90000000000) "
        "SELECT e.event_id, CASE WHEN epoch_us(e.ts) < k.t THEN 'before the last accept of its key' ELSE 'behind the kept marks' END AS reason "
        "FROM events e LEFT JOIN marks k ON k.user_id = e.user_id AND k.event_type = e.event_type "
        "WHERE e.event_id % 10 = 0 AND (epoch_us(e.ts) < k.t OR epoch_us(e.ts) <= (SELECT epoch_us(m) FROM newest) - 90000000000)"),
)
def stream_late_rows(spark, sf):
    """A tenth of the events arrives after all others; what can no longer be judged is kept with a reason."""
    from inkwell.streaming.ttl import ttl_microbatch_sink

    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    land, ckpt, state, out = (scratch_dir(spark, n) for n in ("late_in", "late_ckpt", "late_state", "late_out"))
    sink = ttl_microbatch_sink(state, out, ["user_id", "event_type"], "ts", 86400, tiebreak="event_id")

    def start():
        stream = spark.readStream.schema(ev.schema).parquet(land)
        return (stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start())

    late = F.coalesce(F.col("event_id") % 10 == 0, F.lit(False))
    q_stream._run_in_drops([ev.filter(~late), ev.filter(late)], land, "parquet", start)
    return spark.read.parquet(out + "_late").select("event_id", "reason")


# The value-state throttle knows a key's mark for as long as it is alive at the watermark.
_MARK_ALIVE = "k.t + 86400000000 > w.t"


@query(
    "stream_late_state",
    q_state._TTL_SQL.replace("FROM events", f"FROM {_FIRST}").replace(
        "SELECT event_id, user_id, event_type FROM r WHERE acc",
        f", w AS (SELECT epoch_us(date_trunc('millisecond', max(ts))) - 3600000000 AS t FROM {_FIRST}), "
        "k AS (SELECT user_id, event_type, max(last_t) AS t FROM r WHERE acc GROUP BY 1, 2) "
        f"SELECT e.event_id, CASE WHEN {_MARK_ALIVE} THEN 'before the last accept of its key' ELSE 'behind the kept marks' END AS reason "
        "FROM events e CROSS JOIN w LEFT JOIN k ON k.user_id = e.user_id AND k.event_type = e.event_type "
        f"WHERE e.event_id % 10 = 0 AND epoch_us(e.ts) < CASE WHEN {_MARK_ALIVE} THEN k.t ELSE w.t END"),
)
def stream_late_state(spark, sf):
    """As ``stream_late_rows``, by ``transformWithState``: late rows come out of the same step with a reason."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    late = F.coalesce(F.col("event_id") % 10 == 0, F.lit(False))
    rows = q_stream._value_state(spark, [ev.filter(~late), ev.filter(late)])
    return rows.filter("reason is not null").select("event_id", "reason")
