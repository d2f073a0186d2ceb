"""Queries that write and read files: landing export, append load, overwrite rules.

Files go to a fresh folder under the session's checkpoint directory (shared on
a cluster); the query result is read back from what was written.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.operators import merge as M
from inkwell.plans.catalog import query, table
from inkwell.session import scratch_dir
from inkwell.sinks import files as FS
from inkwell.sources.landing import read_landing

RUN_ISO = "2025-06-03T07:15:27.308000"
BASE = "https://news.example.com/a/"


def _items(spark, sf, heading_prefix: str = ""):
    d = table(spark, sf, "documents")
    return d.select(
        F.concat(F.lit(heading_prefix), F.split("text", "\n").getItem(0)).alias("heading"),
        F.col("text").alias("content"),
        F.concat(F.lit("Desk "), F.col("source")).alias("author"),
        F.lit("2025-06-03T10:00:00+05:00").alias("date"),
        F.col("lang").alias("category"),
        F.concat(F.lit(BASE), F.col("doc_id").cast("string")).alias("url"),
        F.lit(RUN_ISO).alias("processed_at"),
        F.col("source").alias("spider_name"),
        "lang",
    )


_ITEMS_SQL = (
    "SELECT split_part(text, chr(10), 1) AS heading, text AS content, 'Desk ' || source AS author, "
    f"'2025-06-03' AS date, lang AS category, '{BASE}' || doc_id AS url, "
    "'2025-06-03 07:15:27.308000' AS processed_at, source AS spider_name FROM documents"
)
_ORDER = "ORDER BY url, spider_name, processed_at, heading, content, author, category"


# ------------------------------------------------- SNK-3, SRC-3, U-1, F-7
@query(
    "append_load",
    f"WITH d AS (SELECT row_number() OVER ({_ORDER}) AS rn, * FROM ({_ITEMS_SQL})) "
    "SELECT rn AS id, heading, content, author, date, category, url, processed_at, spider_name FROM d "
    "UNION ALL SELECT rn + (SELECT count(*) FROM d), heading, content, author, date, category, url, processed_at, "
    "spider_name FROM d",
)
def append_load(spark, sf):
    land = scratch_dir(spark, "landing")
    FS.export_articles(_items(spark, sf).drop("lang"), land, "2025-06-03")
    table_dir = scratch_dir(spark, "news_append") + "/news"
    for _ in range(2):  # the loader run twice: every row inserted again
        rows = M.to_load_rows(read_landing(spark, land, layout="lines"))
        M.append_articles(spark, rows, table_dir)
    t = spark.read.parquet(table_dir)
    return t.select("id", "heading", "content", "author", F.date_format("date", "yyyy-MM-dd").alias("date"), "category",
                    "url", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("processed_at"), "spider_name")


# ------------------------------------------------------ SNK-1, SNK-2, D-9
@query(
    "export_overwrite",
    f"SELECT url, spider_name, '2025-06-02' AS export_date, heading FROM ({_ITEMS_SQL}) WHERE category IN ('fr', 'de') "
    f"UNION ALL SELECT url, spider_name, '2025-06-03', 'r2 ' || heading FROM ({_ITEMS_SQL}) WHERE category = 'en'",
)
def export_overwrite(spark, sf):
    """Two runs: the first exports every document (fr/de on 06-02, the rest on
    06-03); the second, on 06-03, crawls every source again but finds only the
    English documents.  Its days replace the first run's: sources' 06-03
    files hold the second run only, and a source with no English document has
    its 06-03 day emptied (D-9); 06-02 is untouched."""
    out = scratch_dir(spark, "export")
    items = _items(spark, sf)
    first = items.withColumn("_day", F.when(F.col("lang").isin("fr", "de"), "2025-06-02").otherwise("2025-06-03"))
    for day in ("2025-06-02", "2025-06-03"):
        FS.export_articles(first.filter(F.col("_day") == day).drop("_day", "lang"), out, day)
    run_sources = [r[0] for r in table(spark, sf, "documents").select("source").distinct().collect()]
    second = _items(spark, sf, "r2 ").filter(F.col("lang") == "en").drop("lang")
    FS.export_articles(second, out, "2025-06-03", run_sources=run_sources)
    back = read_landing(spark, out, layout="lines")
    return back.select("url", "spider_name", F.col("export_date").cast("string").alias("export_date"), "heading")


# ------------------------------------------------------------------- M11
_LOG_LEVEL = "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END"
_LOG_MSG = ("CASE event_type WHEN 'purchase' THEN 'Scraped article: ' || event_id WHEN 'error' THEN "
            "'Error parsing article ' || event_id ELSE 'Found ' || CAST(floor(value) AS BIGINT) || ' articles in the feed' END")


@query(
    "log_rollup",
    f"WITH l AS (SELECT 'src' || (user_id % 4) AS source, {_LOG_LEVEL} AS level, {_LOG_MSG} AS message, "
    "date_trunc('millisecond', ts) AS ts FROM events) "
    "SELECT source, level, count(*) AS lines, count(*) FILTER (WHERE starts_with(message, 'Scraped article')) AS scraped, "
    "strftime(min(ts), '%Y-%m-%d %H:%M:%S.%g') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%g') AS last_ts "
    "FROM l GROUP BY source, level",
)
def log_rollup(spark, sf):
    """M11: crawl-log lines rendered from ``events``, written as text, read
    back and parsed natively, then rolled up per source and level."""
    from inkwell.sources import logs as L

    ev = table(spark, sf, "events")
    src = F.concat(F.lit("src"), (F.col("user_id") % 4).cast("string"))
    level = F.expr(_LOG_LEVEL)
    msg = F.expr(_LOG_MSG)
    path = scratch_dir(spark, "logs")
    ev.select(L.format_log_line(F.col("ts").cast("timestamp"), src, level, msg).alias("value")).write.mode("overwrite").text(path)
    r = L.log_rollup(L.read_logs(spark, path))
    return r.select("source", "level", "lines", "scraped",
                    F.date_format("first_ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("first_ts"),
                    F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("last_ts"))
