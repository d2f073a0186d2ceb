"""Queries over ``documents`` / ``orders`` / ``pages``: item fields, validation, dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import dates as D
from inkwell.functions import text as T
from inkwell.operators import extract as X
from inkwell.operators import quality as V
from inkwell.plans import sqlgen as Q
from inkwell.plans.catalog import cores, query, table
from inkwell.registry import EXAMPLE

RUN_TS = "2025-06-03 07:15:27.308"
RUN_ISO = "2025-06-03T07:15:27.308000"

_FIRST_LINE_SQL = "split_part(text, chr(10), 1)"


def _pad_sql(x: str) -> str:
    pad = ("CASE doc_id % 5 WHEN 0 THEN ' ' WHEN 1 THEN chr(9) || chr(10) WHEN 2 THEN chr(160) "
           "WHEN 3 THEN chr(12288) || ' ' ELSE '' END")
    return f"({pad} || {x} || {pad})"


def _pad(c):
    d = F.col("doc_id") % 5
    pad = (F.when(d == 0, F.lit(" ")).when(d == 1, F.lit("\t\n")).when(d == 2, F.lit("\u00a0"))
           .when(d == 3, F.lit("\u3000 ")).otherwise(F.lit("")))
    return F.concat(pad, c, pad)


# ---------------------------------------------------------------------- P-14
@query(
    "strip_fields",
    "WITH d AS (SELECT doc_id, "
    f"{_pad_sql(_FIRST_LINE_SQL)} AS heading, {_pad_sql('text')} AS content, "
    f"{_pad_sql(chr(39) + 'Desk ' + chr(39) + ' || source')} AS author, {_pad_sql('lang')} AS category, "
    f"{_pad_sql(chr(39) + '2025-06-03' + chr(39))} AS date, "
    f"{_pad_sql(chr(39) + 'https://news.example.com/a/' + chr(39) + ' || doc_id')} AS url FROM documents) "
    f"SELECT doc_id, {Q.py_strip('heading')} AS heading, {Q.py_strip('content')} AS content, "
    f"{Q.py_strip('author')} AS author, {Q.py_strip('category')} AS category, {Q.py_strip('date')} AS date, url FROM d",
)
def strip_fields(spark, sf):
    d = table(spark, sf, "documents").select(
        "doc_id",
        _pad(T.first_line(F.col("text"))).alias("heading"),
        _pad(F.col("text")).alias("content"),
        _pad(F.concat(F.lit("Desk "), F.col("source"))).alias("author"),
        _pad(F.col("lang")).alias("category"),
        _pad(F.lit("2025-06-03")).alias("date"),
        _pad(F.concat(F.lit("https://news.example.com/a/"), F.col("doc_id").cast("string"))).alias("url"),
    )
    return V.clean(d)


# ---------------------------------------------------------- P-1, P-2, P-4, W-5
def _entries_fields(spark, sf):
    d = table(spark, sf, "documents")
    i = F.col("doc_id")
    fl = T.first_line(F.col("text"))
    title = (F.when(i % 6 == 0, F.lit(None).cast("string")).when(i % 6 == 1, F.lit(""))
             .when(i % 6 == 2, F.concat(F.lit("  "), fl, F.lit(" "))).otherwise(fl))
    detail = (F.when(i % 4 == 0, F.struct(F.concat(F.lit("Desk "), F.col("source")).alias("name")))
              .when(i % 4 == 1, F.struct(F.lit(None).cast("string").alias("name"))))
    author = (F.when(i % 3 == 0, F.lit(None).cast("string"))
              .when(i % 3 == 1, F.concat(F.lit(" Reporter "), F.col("lang"), F.lit(" "))).otherwise(F.lit("")))
    term = lambda c: F.struct(c.alias("term"))
    tags = (F.when(i % 5 == 0, F.array().cast("array<struct<term:string>>"))
            .when(i % 5 == 1, F.array(term(F.concat(F.lit(" "), F.col("lang"), F.lit(" ")))))
            .when(i % 5 == 2, F.array(term(F.lit("")), term(F.col("lang"))))
            .when(i % 5 == 3, F.array(term(F.col("source")), term(F.col("lang")))))
    return d.select("doc_id", title.alias("title"), detail.alias("author_detail"), author.alias("author"), tags.alias("tags"))


_TITLE_SQL = (f"CASE WHEN doc_id % 6 = 0 THEN NULL WHEN doc_id % 6 = 1 THEN '' "
              f"WHEN doc_id % 6 = 2 THEN '  ' || {_FIRST_LINE_SQL} || ' ' ELSE {_FIRST_LINE_SQL} END")
_AUTHOR_SRC_SQL = ("CASE WHEN doc_id % 4 = 0 THEN 'Desk ' || source WHEN doc_id % 4 = 1 THEN NULL "
                   "ELSE (CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN ' Reporter ' || lang || ' ' ELSE '' END) END")
_TERM_SQL = "CASE doc_id % 5 WHEN 1 THEN ' ' || lang || ' ' WHEN 2 THEN '' WHEN 3 THEN source ELSE NULL END"


@query(
    "author_category",
    f"WITH e AS (SELECT doc_id, {_TITLE_SQL} AS title, {_AUTHOR_SRC_SQL} AS a, {_TERM_SQL} AS term FROM documents) "
    f"SELECT doc_id, {Q.strip_or_null('title')} AS heading, {Q.strip_or_null('a')} AS author, "
    f"CASE WHEN coalesce(term, '') <> '' THEN {Q.py_strip('term')} ELSE term END AS category FROM e",
)
def author_category(spark, sf):
    e = _entries_fields(spark, sf)
    return e.select(
        "doc_id",
        T.strip_or_null(F.col("title")).alias("heading"),
        X.entry_author(F.col("author"), F.col("author_detail")).alias("author"),
        X.entry_category(F.col("tags")).alias("category"),
    )


# ------------------------------------------------- F-3, V-1, P-14, P-15, A-3
def _dirty_items(spark, sf):
    d = table(spark, sf, "documents")
    i = F.col("doc_id")
    heading = (F.when(i % 13 == 0, F.lit(None).cast("string")).when(i % 17 == 0, F.lit(""))
               .when(i % 19 == 0, F.lit("   ")).otherwise(T.first_line(F.col("text"))))
    url = F.when(i % 23 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/a/"), i.cast("string")))
    content = F.when(i % 29 == 0, F.lit(None).cast("string")).when(i % 31 == 0, F.lit("")).otherwise(F.col("text"))
    author = F.when(i % 2 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit(" "), F.col("source"), F.lit(" desk ")))
    return d.select(
        "doc_id", heading.alias("heading"), content.alias("content"), author.alias("author"),
        F.col("lang").alias("category"), F.lit(" 2025-06-03T10:00:00+05:00").alias("date"), url.alias("url"),
        F.col("source"),
    )


_DIRTY_SQL = (
    "SELECT doc_id, "
    f"CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 17 = 0 THEN '' WHEN doc_id % 19 = 0 THEN '   ' ELSE {_FIRST_LINE_SQL} END AS heading, "
    "CASE WHEN doc_id % 29 = 0 THEN NULL WHEN doc_id % 31 = 0 THEN '' ELSE text END AS content, "
    "CASE WHEN doc_id % 2 = 0 THEN NULL ELSE ' ' || source || ' desk ' END AS author, lang AS category, "
    "' 2025-06-03T10:00:00+05:00' AS date, "
    "CASE WHEN doc_id % 23 = 0 THEN NULL ELSE 'https://' || source || '.example.com/a/' || doc_id END AS url, source "
    "FROM documents"
)
_REJECT_FIELD_SQL = ("CASE WHEN coalesce(heading, '') = '' THEN 'heading' WHEN coalesce(url, '') = '' THEN 'url' "
                     "WHEN coalesce(content, '') = '' THEN 'content' END")


@query(
    "accepted_articles",
    f"WITH d AS ({_DIRTY_SQL}) SELECT doc_id, {Q.py_strip('heading')} AS heading, {Q.py_strip('content')} AS content, "
    f"{Q.py_strip('author')} AS author, {Q.py_strip('category')} AS category, {Q.py_strip('date')} AS date, url, "
    f"source AS spider_name, '{RUN_ISO}' AS processed_at FROM d WHERE {_REJECT_FIELD_SQL} IS NULL",
)
def accepted_articles(spark, sf):
    acc, _ = V.validate(_dirty_items(spark, sf), RUN_TS)
    return acc.select("doc_id", "heading", "content", "author", "category", "date", "url", "spider_name", "processed_at")


@query(
    "rejected_articles",
    f"WITH d AS ({_DIRTY_SQL}) SELECT doc_id, url, 'Missing ' || {_REJECT_FIELD_SQL} || ' in ' || coalesce(url, 'None') AS reason "
    f"FROM d WHERE {_REJECT_FIELD_SQL} IS NOT NULL",
)
def rejected_articles(spark, sf):
    _, rej = V.validate(_dirty_items(spark, sf), RUN_TS)
    return rej.select("doc_id", "url", "reason")


@query(
    "reject_reasons",
    f"WITH d AS ({_DIRTY_SQL}) SELECT {_REJECT_FIELD_SQL} AS reject_field, count(*) AS n FROM d "
    f"WHERE {_REJECT_FIELD_SQL} IS NOT NULL GROUP BY 1",
)
def reject_reasons(spark, sf):
    _, rej = V.validate(_dirty_items(spark, sf), RUN_TS)
    return V.rejects_by_reason(rej)


# ----------------------------------------------------- P-3, P-11, P-12, V-3
# Seven spellings chosen by o_orderkey % 7; the oracle does not parse, it
# states the instant and the literal day each spelling encodes.
_TS_EXPR = "CAST(o_orderdate AS TIMESTAMP) + make_dt_interval(0, 0, 0, (o_orderkey * 7919) % 86400)"


def _spelled_dates(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.expr(_TS_EXPR).alias("ts"))
    k = F.col("o_orderkey") % 7
    ts, ts5 = F.col("ts"), F.col("ts") + F.expr("INTERVAL 5 HOURS")
    raw = (
        F.when(k == 0, F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000")))
        .when(k == 1, F.concat(F.date_format(ts5, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0500")))
        .when(k == 2, F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
        .when(k == 3, F.concat(F.date_format(ts5, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00")))
        .when(k == 4, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .when(k == 5, F.concat(F.date_format(ts5, "yyyy-MM-dd HH:mm:ss"), F.lit("+05:00")))
        .otherwise(F.date_format(ts, "MMMM dd, yyyy"))
    )
    return o.select("o_orderkey", raw.alias("raw"))


_TS_SQL = "(o_orderdate + to_seconds((o_orderkey * 7919) % 86400))"


@query(
    "publish_dates",
    f"WITH o AS (SELECT o_orderkey, {_TS_SQL} AS ts FROM orders) SELECT o_orderkey, "
    "CASE o_orderkey % 7 "
    "WHEN 0 THEN strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' +0000' "
    "WHEN 1 THEN strftime(ts + INTERVAL 5 HOUR, '%a, %d %b %Y %H:%M:%S') || ' +0500' "
    "WHEN 2 THEN strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' GMT' "
    "WHEN 3 THEN strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S') || '+05:00' "
    "WHEN 4 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' "
    "WHEN 5 THEN strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') || '+05:00' "
    "ELSE strftime(ts, '%B %d, %Y') END AS raw, "
    "CASE WHEN o_orderkey % 7 = 6 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS published_at, "
    "CASE WHEN o_orderkey % 7 IN (1, 3, 5) THEN strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%d') "
    "ELSE strftime(ts, '%Y-%m-%d') END AS pub_day, "
    "o_orderkey % 7 = 6 AS date_unparsed FROM o",
)
def publish_dates(spark, sf):
    d = _spelled_dates(spark, sf)
    ts = D.publish_ts(F.col("raw"))
    return d.select(
        "o_orderkey", "raw",
        D.ts_string(ts).alias("published_at"),
        F.date_format(D.literal_day(F.col("raw")), "yyyy-MM-dd").alias("pub_day"),
        D.date_unparsed(F.col("raw"), ts).alias("date_unparsed"),
    )


# --------------------------------------------------------- P-5, P-8, P-10
def _feed_html_sql(x: str) -> str:
    esc = f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    return f"'<p>' || replace({esc}, chr(10), '</p><p>') || '</p>'"


_CONTENT_SQL = (f"CASE WHEN d.doc_id % 3 = 1 THEN {_feed_html_sql('d.text')} "
                "WHEN d.doc_id % 3 = 2 THEN '' END")
_SUMMARY_SQL = (f"CASE WHEN d.doc_id % 4 = 0 THEN '<p>' || split_part(d.text, chr(10), 1) || ' &amp; more</p>' "
                "WHEN d.doc_id % 4 = 1 THEN '' END")


@query(
    "content_choice",
    "WITH j AS (SELECT p.page_id, p.html, "
    f"coalesce(nullif({_CONTENT_SQL}, ''), nullif({_SUMMARY_SQL}, '')) AS entry_html "
    "FROM pages p LEFT JOIN documents d ON p.page_id = d.doc_id), "
    "c AS (SELECT page_id, html, CASE WHEN regexp_matches(html, '(?is)<article(?:[^A-Za-z0-9>][^>]*)?>') "
    "THEN regexp_extract(html, '(?is)<article(?:[^A-Za-z0-9>][^>]*)?>(.*?)</article(?:[^A-Za-z0-9>][^>]*)?>', 1) END AS inner_html, "
    f"{Q.paragraph_text('entry_html')} AS feed_text FROM j), "
    f"t AS (SELECT page_id, feed_text, {Q.paragraphs_only_text('inner_html')} AS page_text FROM c) "
    "SELECT page_id, coalesce(feed_text, page_text) AS content, "
    "CASE WHEN feed_text IS NOT NULL THEN 'feed' WHEN page_text IS NOT NULL THEN 'page' END AS content_from FROM t",
)
def content_choice(spark, sf):
    pages = table(spark, sf, "pages", cores(spark))
    docs = table(spark, sf, "documents")
    i = F.col("doc_id")
    body = F.concat(F.lit("<p>"), F.replace(T.xml_escape(F.col("text")), F.lit("\n"), F.lit("</p><p>")), F.lit("</p>"))
    content = (F.when(i % 3 == 1, F.array(F.struct(F.lit("text/html").alias("type"), body.alias("value"))))
               .when(i % 3 == 2, F.array(F.struct(F.lit("text/html").alias("type"), F.lit("").alias("value")))))
    summary = (F.when(i % 4 == 0, F.concat(F.lit("<p>"), T.first_line(F.col("text")), F.lit(" &amp; more</p>")))
               .when(i % 4 == 1, F.lit("")))
    entries = docs.select(i.alias("doc_id"), content.alias("content"), summary.alias("summary"))
    j = pages.join(entries, pages["page_id"] == entries["doc_id"], "left")
    feed_text = T.paragraph_text(X.entry_html(F.col("content"), F.col("summary")))
    from inkwell.functions.container import container_text

    page_text = container_text(F.col("html"), EXAMPLE.container)
    return j.select(
        "page_id",
        F.coalesce(feed_text, page_text).alias("content"),
        F.when(feed_text.isNotNull(), F.lit("feed")).when(page_text.isNotNull(), F.lit("page")).alias("content_from"),
    )


# ------------------------------------------------ flagship: entry(spark)
_H1_RE = "(?is)<h1(?:[^A-Za-z0-9>][^>]*)?>(.*?)</h1[^>]*>"
_SITE_SQL = "regexp_extract(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]*)', 1)), '[.]([a-z0-9-]+)$', 1)"


@query(
    "page_article_counts",
    "WITH a AS (SELECT page_id, url, "
    f"{_SITE_SQL} AS source, "
    f"{Q.whole_text('regexp_extract(html, ' + Q.lit(_H1_RE) + ', 1)')} AS heading, "
    f"{Q.paragraph_text('html')} AS content FROM pages), "
    "r AS (SELECT source, CASE WHEN coalesce(heading, '') = '' THEN 'heading' WHEN coalesce(url, '') = '' THEN 'url' "
    "WHEN coalesce(content, '') = '' THEN 'content' END AS reject_field, "
    "length(coalesce(content, '')) AS n_chars FROM a) "
    "SELECT source, count(*) AS pages, count(*) FILTER (WHERE reject_field IS NULL) AS accepted, "
    "count(*) FILTER (WHERE reject_field IS NOT NULL) AS rejected, "
    "CAST(sum(n_chars) FILTER (WHERE reject_field IS NULL) AS BIGINT) AS accepted_chars FROM r GROUP BY source",
)
def page_article_counts(spark, sf):
    """Minimum end-to-end slice: extraction -> validation -> per-source counts.

    One scan, narrow projections, then a single grouped aggregate (combined
    map-side), so a dominant source never concentrates rows in one task.
    """
    from inkwell.functions import urls as U

    pages = table(spark, sf, "pages", cores(spark))
    items = pages.select(
        "page_id", "url",
        F.regexp_extract(U.host(F.col("url")), "[.]([a-z0-9-]+)$", 1).alias("source"),
        T.whole_text(F.regexp_extract("html", _H1_RE, 1)).alias("heading"),
        T.paragraph_text(F.col("html")).alias("content"),
    )
    tagged = items.withColumn("reject_field", V.missing_field(items))
    ok = F.col("reject_field").isNull()
    return tagged.groupBy("source").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(ok).alias("accepted"),
        F.count_if(~ok).alias("rejected"),
        F.sum(F.when(ok, F.length(F.coalesce("content", F.lit(""))))).cast("bigint").alias("accepted_chars"),
    )
