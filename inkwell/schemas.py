"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# M3: a feed entry after parsing (what the extraction step consumes).
FEED_ENTRY = T.StructType([
    T.StructField("title", S),
    T.StructField("link", S),
    T.StructField("author", S),
    T.StructField("author_detail", T.StructType([T.StructField("name", S)])),
    T.StructField("published", S),
    T.StructField("published_parsed", T.TimestampType()),
    T.StructField("tags", T.ArrayType(T.StructType([T.StructField("term", S)]))),
    T.StructField("content", T.ArrayType(T.StructType([T.StructField("type", S), T.StructField("value", S)]))),
    T.StructField("summary", S),
])

# RSS 2.0 <item> as read by from_xml (SRC-1).
RSS_ITEM = T.StructType([
    T.StructField("title", S),
    T.StructField("link", S),
    T.StructField("author", S),
    T.StructField("pubDate", S),
    T.StructField("category", T.ArrayType(S)),
    T.StructField("description", S),
    T.StructField("content:encoded", S),
])
RSS_DOC = T.StructType([
    T.StructField("channel", T.StructType([T.StructField("item", T.ArrayType(RSS_ITEM))])),
])

# M5: article item, ten nullable strings.
ARTICLE_FIELDS = [
    "heading", "content", "author", "date", "category", "url", "source",
    "spider_name", "processed_at", "scrape_date",
]
ARTICLE = T.StructType([T.StructField(n, S) for n in ARTICLE_FIELDS])

# P-16: the eight columns a load takes from an item.
LOAD_FIELDS = ["heading", "content", "author", "date", "category", "url", "processed_at", "spider_name"]

# M8: the article table (upsert variant); M9 drops created_at/updated_at.
NEWS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("heading", S),
    T.StructField("content", S),
    T.StructField("author", S),
    T.StructField("date", T.DateType()),
    T.StructField("category", S),
    T.StructField("url", S),
    T.StructField("processed_at", T.TimestampNTZType()),
    T.StructField("spider_name", S),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])
NEWS_APPEND = T.StructType([f for f in NEWS.fields if f.name not in ("created_at", "updated_at")])

# M6: seen-URL state.
SEEN = T.StructType([
    T.StructField("source", S),
    T.StructField("url", S),
    T.StructField("last_accept_at", T.TimestampType()),
])

# M10: one run statistics record.
RUN_STATS = T.StructType([
    T.StructField("source", S),
    T.StructField("date", T.DateType()),
    T.StructField("articles_found", T.LongType()),
    T.StructField("articles_scraped", T.LongType()),
    T.StructField("errors", T.LongType()),
    T.StructField("reason", S),
])
