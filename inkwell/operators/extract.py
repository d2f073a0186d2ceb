"""Feed entry + fetched page -> article item (J-1, P-1..P-11, F-5, W-5, A-6).

One narrow projection after one equi-join; no Python, no per-row state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.container import container_text
from inkwell.functions.dates import date_unparsed, publish_ts
from inkwell.functions.text import paragraph_text, py_strip, strip_or_null
from inkwell.registry import DEFAULT_SOURCES


def status_ok(pages: DataFrame, status_col: str = "status") -> DataFrame:
    """F-5: only 2xx responses reach extraction (NULL status = not recorded = ok)."""
    if status_col not in pages.columns:
        return pages
    s = F.col(status_col)
    return pages.filter(s.isNull() | s.between(200, 299))


def entry_author(author: Column, author_detail: Column) -> Column:
    """P-2: a present author_detail wins, even when its name is NULL."""
    return strip_or_null(F.when(author_detail.isNotNull(), author_detail["name"]).otherwise(author))


def entry_category(tags: Column) -> Column:
    """P-4 + W-5: first tag's term, stripped when non-empty ('' stays '')."""
    term = F.get(tags, 0)["term"]
    return F.when(F.coalesce(term, F.lit("")) != "", py_strip(term)).otherwise(term)


def entry_html(content: Column, summary: Column) -> Column:
    """P-5: first content value, or the summary when that is empty."""
    first = F.get(content, 0)["value"]
    return F.coalesce(F.nullif(first, F.lit("")), F.nullif(summary, F.lit("")))


def page_fallback_text(source: Column, html: Column, sources=DEFAULT_SOURCES, default=None) -> Column:
    """P-9 dispatched by source: each source's container rule (or the default
    source's rule for sources not in the registry), else NULL."""
    none = F.lit(None).cast("string")
    other = container_text(html, default.container) if default is not None and default.container else none
    expr = None
    for s in sources:
        t = container_text(html, s.container) if s.container is not None else none
        expr = F.when(source == s.name, t) if expr is None else expr.when(source == s.name, t)
    return other if expr is None else expr.otherwise(other)


def article_columns(sources=DEFAULT_SOURCES, default=None, with_page: bool = True) -> list[Column]:
    """Projection from a joined (entry, page) row to the article item.

    ``_feed_text`` is the entry's own text; where that is enough no page is read (``with_page``)."""
    feed_text = F.col("_feed_text")
    page_text = page_fallback_text(F.col("source"), F.col("html"), sources, default) if with_page else F.lit(None).cast("string")
    published_at = publish_ts(F.col("published"), F.col("published_parsed"))
    return [
        F.col("source"),
        F.col("link"),
        F.col("url"),
        strip_or_null(F.col("title")).alias("heading"),
        entry_author(F.col("author"), F.col("author_detail")).alias("author"),
        F.col("published").alias("date"),
        entry_category(F.col("tags")).alias("category"),
        # P-10: feed text first, page text only when the feed text is empty.
        F.coalesce(feed_text, page_text).alias("content"),
        F.when(feed_text.isNotNull(), F.lit("feed")).when(page_text.isNotNull(), F.lit("page")).alias("content_from"),
        published_at.alias("published_at"),
        date_unparsed(F.col("published"), published_at).alias("date_unparsed"),
        # V-2: a fetched page without a body cannot be processed; the row is
        # isolated as an error instead of failing the run.
        F.col("_no_body").alias("error"),
        field_problems(published_at, feed_text, page_text).alias("problems"),
    ]


def field_problems(published_at: Column, feed_text: Column, page_text: Column) -> Column:
    """V-2 by field: array of (field, reason) for what could not be read; the row itself goes on."""
    found = [
        ("date", "unreadable date", date_unparsed(F.col("published"), published_at)),
        ("heading", "no title", strip_or_null(F.col("title")).isNull()),
        ("content", "response without body", F.col("_no_body")),
        ("content", "no text in feed or page", ~F.col("_no_body") & feed_text.isNull() & page_text.isNull()),
        ("author", "author detail without name", F.col("author_detail").isNotNull() & F.col("author_detail")["name"].isNull()),
    ]
    marks = [F.when(cond, F.struct(F.lit(field).alias("field"), F.lit(reason).alias("reason"))) for field, reason, cond in found]
    return F.filter(F.array(*marks), lambda m: m.isNotNull())


def with_feed_text(entries: DataFrame) -> DataFrame:
    """Entries with their own text as ``_feed_text`` (P-5..P-8); store it where several outputs read it."""
    return entries.withColumn("_feed_text", paragraph_text(entry_html(F.col("content"), F.col("summary"))))


def extract_articles(entries: DataFrame, pages: DataFrame, sources=DEFAULT_SOURCES,
                     keep: list[str] | None = None, default=None) -> DataFrame:
    """J-1 + P-1..P-11.

    ``entries`` carries (source, link, title, author, author_detail, published,
    published_parsed, tags, content, summary); ``pages`` carries
    (request_url, url, html[, status]).  The join is on the requested link;
    the page's final url (after redirects) becomes the item url.  Page bodies
    are shuffled only for the links whose entry has no text of its own (an entry
    without text and its page meet in a second join).
    """
    pages = status_ok(pages)
    fetched = pages.select("request_url", "url", F.col("html").isNull().alias("_no_body"))
    texts = entries if "_feed_text" in entries.columns else with_feed_text(entries)
    full = texts.filter(F.col("_feed_text").isNotNull())
    bare = texts.filter(F.col("_feed_text").isNull())
    told = full.join(fetched, full["link"] == fetched["request_url"])
    wanted = pages.join(bare.select(F.col("link").alias("request_url")).distinct(), "request_url", "left_semi") \
        .select("request_url", "url", "html", F.col("html").isNull().alias("_no_body"))
    read = bare.join(wanted, bare["link"] == wanted["request_url"])
    extra = [F.col(c) for c in (keep or [])]
    return told.select(*extra, *article_columns(sources, default, with_page=False)).unionByName(
        read.select(*extra, *article_columns(sources, default)))
