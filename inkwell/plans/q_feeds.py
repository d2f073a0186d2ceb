"""Feed queries: RSS parsing, entry/page join and the whole crawl-run chain.

Feed documents are built from ``documents`` (one item per document, feeds of
at most 64 items per source), so the RSS parse has real XML to read; the
oracles state the expected values straight from the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import text as T
from inkwell.plans import sqlgen as Q
from inkwell.plans.catalog import cores, query, table
from inkwell.plans.pipeline import COUNTERS, crawl_run
from inkwell.registry import Container, Source
from inkwell.session import scratch_dir
from inkwell.sources import rss as R

PER_FEED = 64
RUN_TS = "2025-06-03 12:00:00"
BASE = "https://news.example.com"
# Sources of the test tables share one rule: relative links below BASE,
# article text in <article>.
SITE_DEFAULT = Source(name="*", allowed_domains=("example.com",), base_url=BASE, container=Container("article"))


def _item_rows(spark, sf):
    d = table(spark, sf, "documents")
    i = F.col("doc_id")
    body = F.concat(F.lit("<p>"), F.replace(T.xml_escape(F.col("text")), F.lit("\n"), F.lit("</p><p>")), F.lit("</p>"))
    first = T.first_line(F.col("text"))
    pub = F.concat(
        F.date_format(F.lit(RUN_TS).cast("timestamp") - F.make_dt_interval(mins=i.cast("int")), "EEE, dd MMM yyyy HH:mm:ss"),
        F.lit(" +0000"),
    )
    return d.select(
        "doc_id", "source",
        F.when(i % 13 == 0, F.lit(None).cast("string")).otherwise(first).alias("title"),
        F.when(i % 11 == 0, F.lit("")).when(i % 3 == 0, F.concat(F.lit("/a/"), i.cast("string")))
        .otherwise(F.concat(F.lit(BASE + "/a/"), i.cast("string"))).alias("link"),
        F.concat(F.lit("desk@"), F.col("source"), F.lit(".example.com (Desk "), F.col("source"), F.lit(")")).alias("author"),
        pub.alias("pub_date"),
        F.array(F.col("lang"), F.col("source")).alias("categories"),
        F.when(i % 8 == 0, F.lit("")).when(i % 4 == 0, F.concat(F.lit("<p>"), T.xml_escape(first), F.lit("</p>")))
        .otherwise(F.lit("<p>Summary.</p>")).alias("description"),
        F.when(i % 4 == 0, F.lit(None).cast("string")).otherwise(body).alias("content"),
    )


def _feeds(spark, sf, link=None):
    it = _item_rows(spark, sf)
    it = it if link is None else it.withColumn("link", link)
    xml = R.rss_item_xml(F.col("title"), F.col("link"), F.col("author"), F.col("pub_date"), F.col("categories"),
                         F.col("description"), F.col("content"))
    return R.build_feeds(it, "source", "doc_id", xml, PER_FEED).withColumn("fetched_at", F.lit(RUN_TS).cast("timestamp"))


def _fetched_pages(spark, sf):
    """Every page as a fetch result: status 404 for page_id % 17 = 0, and a
    response without a body (a row error, V-2) for page_id % 19 = 0."""
    p = table(spark, sf, "pages", cores(spark))
    return p.select(
        F.concat(F.lit(BASE + "/a/"), F.col("page_id").cast("string")).alias("request_url"),
        "url",
        F.when(F.col("page_id") % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("html")).alias("html"),
        F.when(F.col("page_id") % 17 == 0, F.lit(404)).otherwise(F.lit(200)).alias("status"),
    )


def _seen_state(spark, sf):
    """Every document's link was accepted before: one hour before the run for
    doc_id % 7 = 0 (still suppressed), 25 hours before for % 7 = 1 (just
    expired), 30 days before for the rest."""
    d = table(spark, sf, "documents")
    i = F.col("doc_id")
    run = F.lit(RUN_TS).cast("timestamp")
    age = (F.when(i % 7 == 0, F.expr("INTERVAL 1 HOUR")).when(i % 7 == 1, F.expr("INTERVAL 25 HOURS"))
           .otherwise(F.expr("INTERVAL 720 HOURS")))
    return d.select(
        "source", F.concat(F.lit(BASE + "/a/"), i.cast("string")).alias("url"), (run - age).alias("last_accept_at"),
    )


_ITEMS_SQL = (
    "SELECT doc_id, source, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE split_part(text, chr(10), 1) END AS title, "
    f"CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 3 = 0 THEN '/a/' || doc_id ELSE '{BASE}/a/' || doc_id END AS link, "
    "'desk@' || source || '.example.com (Desk ' || source || ')' AS author, "
    f"strftime(TIMESTAMP '{RUN_TS}' - to_minutes(CAST(doc_id AS INTEGER)), '%a, %d %b %Y %H:%M:%S') || ' +0000' AS pub_date, "
    "lang AS category, "
    "CASE WHEN doc_id % 8 = 0 THEN '' WHEN doc_id % 4 = 0 THEN '<p>' || replace(replace(replace(split_part(text, chr(10), 1), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p>' "
    "ELSE '<p>Summary.</p>' END AS description, "
    "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE '<p>' || replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(10), '</p><p>') || '</p>' END AS content "
    "FROM documents"
)


# ------------------------------------------------------------ SRC-1, A-2
@query(
    "rss_items",
    f"WITH i AS ({_ITEMS_SQL}) SELECT source, CAST(doc_id // {PER_FEED} AS BIGINT) AS feed_no, "
    f"CAST(row_number() OVER (PARTITION BY source, doc_id // {PER_FEED} ORDER BY doc_id) - 1 AS INTEGER) AS item_pos, "
    f"CAST(count(*) OVER (PARTITION BY source, doc_id // {PER_FEED}) AS INTEGER) AS n_in_feed, "
    "title, nullif(link, '') AS link, author, pub_date, category, nullif(description, '') AS description, "
    "content AS content_encoded FROM i",
)
def rss_items(spark, sf):
    items = R.rss_items(_feeds(spark, sf), keep=["source", "feed_no"])
    return items.select(
        "source", "feed_no", "item_pos", "n_in_feed", "title", F.nullif("link", F.lit("")).alias("link"), "author",
        "pub_date", F.get("categories", 0).alias("category"), F.nullif("description", F.lit("")).alias("description"),
        "content_encoded",
    )


_PER_FILE = 512  # ids a file; a feed has two files


def _dump(spark, sf, path, part=None):
    """Writes the feeds (or those of one parity) as files, two to a feed."""
    it = _item_rows(spark, sf)
    xml = R.rss_item_xml(F.col("title"), F.col("link"), F.col("author"), F.col("pub_date"), F.col("categories"),
                         F.col("description"), F.col("content"))
    no = F.col("feed_no")
    files = R.build_feeds(it, "source", "doc_id", xml, _PER_FILE).select(
        "source", F.floor(no / 2).alias("feed_no"), (no % 2).alias("part"), "body")
    if part is not None:
        files = files.filter(F.coalesce(F.col("feed_no") % 2, F.lit(0)) == part)
    files.write.mode("append").partitionBy("source", "feed_no", "part").text(path)


_FOLDERS = "source string, feed_no long, part long"
_DUMP_SQL = (
    f"WITH i AS (SELECT *, doc_id // {2 * _PER_FILE} AS f FROM ({_ITEMS_SQL})) SELECT source, CAST(f AS BIGINT) AS feed_no, "
    "CAST(row_number() OVER (PARTITION BY source, f ORDER BY doc_id) - 1 AS INTEGER) AS item_pos, "
    "CAST(count(*) OVER (PARTITION BY source, f) AS INTEGER) AS n_in_feed, "
    "title, nullif(link, '') AS link, author, pub_date, category, nullif(description, '') AS description, "
    "content AS content_encoded FROM i"
)


def _dump_rows(items):
    return items.select(
        "source", "feed_no", "item_pos", "n_in_feed", "title", F.nullif("link", F.lit("")).alias("link"), "author", "pub_date",
        F.get("categories", 0).alias("category"), F.nullif("description", F.lit("")).alias("description"), "content_encoded")


@query("feed_dump", _DUMP_SQL)
def feed_dump(spark, sf):
    """A written dump of feeds, two files to a feed, read back item by item in the feeds' order."""
    from inkwell.sources import feed_files as FF

    path = scratch_dir(spark, "feed_dump")
    _dump(spark, sf, path)
    return _dump_rows(FF.feed_file_items(FF.number_items(FF.read_feed_files(spark, path, _FOLDERS, glob="*.txt"))))


@query("stream_feed_dump", _DUMP_SQL)
def stream_feed_dump(spark, sf):
    """The dump as a stream of files that lands in two drops; each micro-batch's items are numbered and stored."""
    from inkwell.sources import feed_files as FF
    from inkwell.streaming.sinks import run_available

    land, ckpt, out = (scratch_dir(spark, n) for n in ("dump_in", "dump_ckpt", "dump_out"))
    sink = FF.feed_file_sink(lambda rows, n: FF.feed_file_items(rows).write.mode("overwrite").parquet(f"{out}/batch_id={n}"))

    def start():
        return (FF.read_feed_files(spark, land, _FOLDERS, stream=True, glob="*.txt").writeStream.foreachBatch(sink)
                .option("checkpointLocation", ckpt).trigger(availableNow=True).start())

    for part in (0, 1):
        _dump(spark, sf, land, part)
        with FF.bounded_listing(spark):
            run_available(start)
    return _dump_rows(spark.read.parquet(out))


# ------------------------------------------------------------ J-1, SRC-2
@query(
    "entry_page_join",
    f"WITH i AS ({_ITEMS_SQL}), e AS (SELECT doc_id, CASE WHEN NOT starts_with(link, 'http') THEN '{BASE}' || link "
    "ELSE link END AS link FROM i WHERE coalesce(link, '') <> '') "
    f"SELECT e.doc_id, p.page_id, e.link, p.url FROM e JOIN pages p ON e.link = '{BASE}/a/' || p.page_id",
)
def entry_page_join(spark, sf):
    from inkwell.functions import urls as U
    from inkwell.registry import base_url_for

    it = _item_rows(spark, sf).filter(U.has_link(F.col("link")))
    e = it.select("doc_id", U.absolutise(F.col("link"), base_url_for(F.col("source"), (), SITE_DEFAULT)).alias("link"))
    p = table(spark, sf, "pages", cores(spark)).select("page_id", "url", F.concat(F.lit(BASE + "/a/"), F.col("page_id").cast("string")).alias("request_url"))
    return e.join(p, e["link"] == p["request_url"]).select("doc_id", "page_id", "link", "url")


# ----------------------------------------------------------- X-1, U-2, A-1
_CONTAINER_SQL = (
    "CASE WHEN regexp_matches(html, '(?is)<article(?:[^A-Za-z0-9>][^>]*)?>') THEN regexp_extract(html, "
    "'(?is)<article(?:[^A-Za-z0-9>][^>]*)?>(.*?)</article(?:[^A-Za-z0-9>][^>]*)?>', 1) END"
)
_PIPELINE_SQL = (
    f"WITH i AS ({_ITEMS_SQL}), "
    "linked AS (SELECT *, CASE WHEN NOT starts_with(link, 'http') THEN "
    f"'{BASE}' || link ELSE link END AS alink FROM i WHERE coalesce(link, '') <> ''), "
    "found AS (SELECT * FROM linked WHERE doc_id % 7 <> 0), "
    "req AS (SELECT * FROM found), "
    "pg AS (SELECT page_id, CASE WHEN page_id % 19 = 0 THEN NULL ELSE html END AS html FROM pages "
    "WHERE page_id % 17 <> 0), "
    "joined AS (SELECT r.source, r.title, coalesce(nullif(r.content, ''), nullif(r.description, '')) AS entry_html, "
    f"pg.html FROM req r JOIN pg ON r.alink = '{BASE}/a/' || pg.page_id), "
    f"art AS (SELECT source, title, entry_html, {_CONTAINER_SQL} AS inner_html FROM joined WHERE html IS NOT NULL), "
    f"ext AS (SELECT source, {Q.strip_or_null('title')} AS heading, coalesce({Q.paragraph_text('entry_html')}, "
    f"{Q.paragraphs_only_text('inner_html')}) AS content FROM art), "
    "val AS (SELECT source, coalesce(heading, '') <> '' AND coalesce(content, '') <> '' AS ok FROM ext), "
    "m AS (SELECT source, 'entries' AS m FROM i UNION ALL SELECT source, 'found' FROM found "
    "UNION ALL SELECT source, 'requests' FROM req UNION ALL SELECT source, 'scraped' FROM ext "
    "UNION ALL SELECT source, 'errors' FROM joined WHERE html IS NULL "
    "UNION ALL SELECT source, CASE WHEN ok THEN 'accepted' ELSE 'rejected' END FROM val) "
    "SELECT source, " + ", ".join(f"count(*) FILTER (WHERE m = '{c}') AS {c}" for c in COUNTERS) + " FROM m GROUP BY source"
)


@query("pipeline_counts", _PIPELINE_SQL)
def pipeline_counts(spark, sf):
    out = crawl_run(_feeds(spark, sf), _fetched_pages(spark, sf), RUN_TS, seen=_seen_state(spark, sf),
                    sources=(), default=SITE_DEFAULT)
    return out.counts


# Links that a strict parser refuses: on-site without a page, off-site, without a host, and two spellings of one url.
_MESSY = (
    (1, "https://news_x.example.com/a|b/", ""), (2, "https://other.test/x y/", ""), (3, "http:relative/", ""),
    (4, "https://news.example.com/s?b= 1&a=", "#top"),
)


@query(
    "crawl_dropped",
    f"WITH i AS (SELECT * REPLACE (CASE WHEN link = '' THEN link WHEN doc_id % 5 IN (1, 2, 3, 4) AND doc_id % 3 <> 0 THEN CASE doc_id % 5 "
    + " ".join(f"WHEN {k} THEN '{a}' || " + ("doc_id // 10" if k == 4 else "doc_id") + f" || '{b}'" for k, a, b in _MESSY)
    + f" END ELSE link END AS link), CASE WHEN doc_id % 5 IN (1, 2, 3, 4) AND doc_id % 3 <> 0 THEN doc_id % 5 ELSE 0 END AS form FROM ({_ITEMS_SQL})), "
    f"l AS (SELECT doc_id, source, form, CASE WHEN NOT starts_with(link, 'http') THEN '{BASE}' || link ELSE link END AS link FROM i WHERE link <> ''), "
    "f AS (SELECT * FROM l WHERE NOT (form = 0 AND doc_id % 7 = 0)), "
    f"o AS (SELECT * FROM f WHERE form NOT IN (2, 3)), "
    f"q AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY source, link ORDER BY doc_id) = 1), "
    f"g AS (SELECT q.* FROM q WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE q.link = '{BASE}/a/' || p.page_id AND p.page_id % 17 <> 0)), "
    "d AS (SELECT source, 'no link' AS reason FROM i WHERE link = '' UNION ALL SELECT source, 'seen' FROM l WHERE form = 0 AND doc_id % 7 = 0 "
    "UNION ALL SELECT source, 'offsite' FROM f WHERE form IN (2, 3) UNION ALL SELECT source, 'repeated request' FROM o "
    "WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.doc_id = o.doc_id) UNION ALL SELECT source, 'no usable page' FROM g) "
    "SELECT source, reason, count(*) AS n FROM d GROUP BY source, reason",
)
def crawl_dropped(spark, sf):
    """What becomes of every entry without an article: nothing leaves the run unaccounted."""
    i = F.col("doc_id")
    link, messy = F.col("link"), i % 3 != 0
    for k, a, b in _MESSY:
        number = F.floor(i / 10) if k == 4 else i
        link = F.when((F.col("link") != "") & messy & (i % 5 == k), F.concat(F.lit(a), number.cast("string"), F.lit(b))).otherwise(link)
    out = crawl_run(_feeds(spark, sf, link), _fetched_pages(spark, sf), RUN_TS, seen=_seen_state(spark, sf), sources=(), default=SITE_DEFAULT)
    return out.dropped.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "feed_problems",
    f"WITH f AS (SELECT DISTINCT source, doc_id // {PER_FEED} AS feed_no FROM documents) "
    "SELECT source, CAST(feed_no AS BIGINT) AS feed_no, CASE feed_no % 6 WHEN 1 THEN 'unreadable' WHEN 2 THEN 'empty' WHEN 3 THEN 'no channel' "
    "ELSE 'unreadable' END AS reason FROM f WHERE feed_no % 6 IN (1, 2, 3, 4)",
)
def feed_problems(spark, sf):
    """Feeds cut short, empty, of another kind or with a bare '&' are kept with a reason."""
    feeds = _feeds(spark, sf)
    k, body = F.col("feed_no") % 6, F.col("body")
    broken = (F.when(k == 1, F.expr("left(body, length(body) - 20)")).when(k == 2, F.lit(" ")).when(k == 3, F.lit("<html><p>moved</p></html>"))
              .when(k == 4, F.concat(F.lit("<rss><channel><title>a & b</title></channel></rss>"))).otherwise(body))
    return R.feed_problems(feeds.withColumn("body", broken), keep=["source", "feed_no"]).select("source", "feed_no", "reason")


@query(
    "field_problems",
    _PIPELINE_SQL[:_PIPELINE_SQL.index("art AS (")].rstrip(", ").replace(
        "joined AS (SELECT r.source, r.title,", "joined AS (SELECT r.source, r.doc_id, r.title,")
    + f", x AS (SELECT *, {_CONTAINER_SQL} AS inner_html FROM joined), "
    f"y AS (SELECT source, {Q.strip_or_null('title')} AS heading, html, coalesce({Q.paragraph_text('entry_html')}, "
    f"{Q.paragraphs_only_text('inner_html')}) AS content FROM x), "
    "p AS (SELECT source, 'heading' AS field, 'no title' AS reason FROM y WHERE heading IS NULL "
    "UNION ALL SELECT source, 'content', 'response without body' FROM y WHERE html IS NULL "
    "UNION ALL SELECT source, 'content', 'no text in feed or page' FROM y WHERE html IS NOT NULL AND content IS NULL) "
    "SELECT source, field, reason, count(*) AS n FROM p GROUP BY source, field, reason",
)
def field_problems(spark, sf):
    """Per source, field and reason: what the run could not read, counted and not dropped."""
    out = crawl_run(_feeds(spark, sf), _fetched_pages(spark, sf), RUN_TS, seen=_seen_state(spark, sf), sources=(), default=SITE_DEFAULT)
    return out.problems
