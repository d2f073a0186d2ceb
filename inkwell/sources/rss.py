"""RSS feeds as tables (SRC-1, A-2, F-1).

A feed document is one row ``(source, feed_id, fetched_at, body)``; its
entries are parsed with the built-in ``from_xml`` and exploded in feed order.
Malformed or empty bodies parse to a NULL channel and yield no entries;
``feed_problems`` keeps them with a reason.  Feeds on disk are read item by item
by ``sources.feed_files``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from inkwell.functions.dates import read_date
from inkwell.functions.text import cdata, xml_escape, xml_safe
from inkwell.schemas import RSS_DOC

RSS_OPEN = '<?xml version="1.0" encoding="UTF-8"?><rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>'
RSS_CLOSE = "</channel></rss>"


def rss_items(feeds: DataFrame, body: str = "body", keep: list[str] | None = None) -> DataFrame:
    """SRC-1 + A-2: one row per <item>, with its 0-based position and the feed size."""
    keep = keep if keep is not None else [c for c in feeds.columns if c != body]
    parsed = feeds.select(*keep, F.from_xml(F.col(body), RSS_DOC, {"rowTag": "rss"}).alias("_doc"))
    items = F.coalesce(F.col("_doc.channel.item"), F.array().cast(RSS_DOC["channel"].dataType["item"].dataType))
    return parsed.select(*keep, F.size(items).alias("n_in_feed"), F.posexplode(items).alias("item_pos", "_it")).select(
        *keep,
        "item_pos",
        "n_in_feed",
        *item_columns(lambda c: F.col(f"_it.`{c}`")),
    )


def item_columns(child) -> list[Column]:
    """The columns of an item; ``child`` gives an element of it by name."""
    return [
        child("title").alias("title"),
        child("link").alias("link"),
        child("author").alias("author"),
        child("pubDate").alias("pub_date"),
        child("category").alias("categories"),
        child("description").alias("description"),
        child("content:encoded").alias("content_encoded"),
    ]


def feed_problems(feeds: DataFrame, body: str = "body", keep: list[str] | None = None) -> DataFrame:
    """V-2: the feeds that give no entries because they cannot be read, with a reason and the body.

    ``unreadable`` (not well-formed; the parser's corrupt record), ``empty`` (no body) or ``no channel``
    (some other document).  A channel without items is a feed without news and no problem.
    """
    keep = keep if keep is not None else [c for c in feeds.columns if c != body]
    schema = StructType([*RSS_DOC.fields, StructField("_corrupt_record", StringType())])
    parsed = feeds.select(*keep, F.col(body).alias("body"), F.from_xml(
        F.col(body), schema, {"rowTag": "rss", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("_doc"))
    reason = (F.when(~F.coalesce(F.col("body"), F.lit("")).rlike("\\S"), F.lit("empty"))
              .when(F.col("_doc._corrupt_record").isNotNull(), F.lit("unreadable")).when(F.col("_doc.channel").isNull(), F.lit("no channel")))
    return parsed.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(*keep, "reason", "body")


def author_name(author: Column) -> Column:
    """Name part of an RSS author: 'mail (Name)' -> Name; bare mail -> NULL."""
    in_parens = F.regexp_extract(author, "\\((.*)\\)", 1)
    bare_mail = author.rlike("^[^ ]+@[^ ]+$")
    return F.when(in_parens != "", in_parens).when(bare_mail, F.lit(None).cast("string")).otherwise(author)


def feed_entries(items: DataFrame) -> DataFrame:
    """RSS items -> feed entries (M3) as the extraction step expects them."""
    entry_cols = {
        "title": F.col("title"),
        "author": F.col("author"),
        "author_detail": F.when(F.col("author").isNotNull(), F.struct(author_name(F.col("author")).alias("name"))),
        "published": F.col("pub_date"),
        "published_parsed": read_date(F.col("pub_date")),
        "tags": F.transform(F.coalesce(F.col("categories"), F.array().cast("array<string>")), lambda c: F.struct(c.alias("term"))),
        "content": F.when(
            F.col("content_encoded").isNotNull(),
            F.array(F.struct(F.lit("text/html").alias("type"), F.col("content_encoded").alias("value"))),
        ),
        "summary": F.col("description"),
    }
    drop = ["pub_date", "categories", "description", "content_encoded"]
    return items.withColumns(entry_cols).drop(*drop)


def rss_item_xml(title: Column, link: Column, author: Column, pub_date: Column,
                 categories: Column, description: Column, content: Column) -> Column:
    """One <item> element (text escaped, HTML in CDATA, XML-illegal characters dropped)."""

    def el(name, value, raw=False):
        body = cdata(xml_safe(value)) if raw else xml_escape(xml_safe(value))
        return F.when(value.isNotNull(), F.concat(F.lit(f"<{name}>"), body, F.lit(f"</{name}>"))).otherwise(F.lit(""))

    cats = F.array_join(F.transform(categories, lambda c: F.concat(F.lit("<category>"), xml_escape(xml_safe(c)), F.lit("</category>"))), "")
    return F.concat(
        F.lit("<item>"), el("title", title), el("link", link), el("author", author), el("pubDate", pub_date),
        F.coalesce(cats, F.lit("")), el("description", description, True), el("content:encoded", content, True),
        F.lit("</item>"),
    )


def build_feeds(items: DataFrame, source: str, position: str, item_xml: Column, per_feed: int = 64) -> DataFrame:
    """Assemble feed documents from item rows, at most ``per_feed`` items each.

    Groups are (source, position div per_feed), so a feed body is bounded no
    matter how many items a source has.
    """
    feed_no = F.floor(F.col(position) / per_feed)
    grouped = items.select(F.col(source).alias("source"), feed_no.alias("feed_no"), F.col(position).alias("_p"),
                           item_xml.alias("_x"))
    agg = grouped.groupBy("source", "feed_no").agg(F.array_sort(F.collect_list(F.struct("_p", "_x"))).alias("_items"))
    body = F.concat(F.lit(RSS_OPEN), F.array_join(F.transform("_items", lambda s: s["_x"]), ""), F.lit(RSS_CLOSE))
    return agg.select("source", "feed_no", body.alias("body"))
