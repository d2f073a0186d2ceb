"""Queries over ``pages``: text extraction, links, domains, canonical urls."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import container as C
from inkwell.functions import text as T
from inkwell.functions import urls as U
from inkwell.plans import sqlgen as Q
from inkwell.plans.catalog import cores, query, table
from inkwell.registry import DEFAULT_SOURCES, EXAMPLE, Source, base_url_for

# ---------------------------------------------------------------- P-6, F-8, A-6
query_sql = f"SELECT page_id, {Q.paragraph_text('html')} AS text FROM pages"


@query("paragraph_text", query_sql)
def paragraph_text(spark, sf):
    return table(spark, sf, "pages", cores(spark)).select("page_id", T.paragraph_text(F.col("html")).alias("text"))


# ---------------------------------------------------------------------- P-7
# Even pages lose every <p> tag, so their text falls back to the whole page.
_NO_P_RE = "(?i)</?p(?:[^A-Za-z0-9>][^>]*)?>"
_fallback_html_sql = f"CASE WHEN page_id % 2 = 0 THEN regexp_replace(html, {Q.lit(_NO_P_RE)}, '', 'g') ELSE html END"


@query(
    "plain_text_fallback",
    f"WITH p AS (SELECT page_id, {_fallback_html_sql} AS html FROM pages) "
    f"SELECT page_id, {Q.paragraph_text('html')} AS text FROM p",
)
def plain_text_fallback(spark, sf):
    pages = table(spark, sf, "pages", cores(spark))
    html = F.when(F.col("page_id") % 2 == 0, F.regexp_replace("html", _NO_P_RE, "")).otherwise(F.col("html"))
    return pages.select("page_id", T.paragraph_text(html).alias("text"))


# ---------------------------------------------------------------------- P-9
# The oracle uses the first </article> (test pages never nest <article>); the
# Spark side runs the general depth fold.
@query(
    "container_text",
    "WITH c AS (SELECT page_id, CASE WHEN regexp_matches(html, '(?is)<article(?:[^A-Za-z0-9>][^>]*)?>') "
    "THEN regexp_extract(html, '(?is)<article(?:[^A-Za-z0-9>][^>]*)?>(.*?)</article(?:[^A-Za-z0-9>][^>]*)?>', 1) END AS inner_html "
    "FROM pages) "
    f"SELECT page_id, {Q.paragraphs_only_text('inner_html')} AS text FROM c",
)
def container_text(spark, sf):
    pages = table(spark, sf, "pages", cores(spark))
    return pages.select("page_id", C.container_text(F.col("html"), EXAMPLE.container).alias("text"))


# ------------------------------------------------------------- P-13, F-1
# Derived links: NULL for page_id % 11 = 0, '' for % 7 = 0, path-only for
# % 3 = 0; even pages belong to the source with a base url, odd ones to the
# source without one (relative links then stay relative).
_LINK_SQL = (
    "CASE WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 7 = 0 THEN '' "
    "WHEN page_id % 3 = 0 THEN regexp_replace(url, '^[A-Za-z]+://[^/]+', '') ELSE url END"
)
_SRC_SQL = "CASE WHEN page_id % 2 = 0 THEN 'tribune_latest' ELSE 'dawn_latest' END"


def _derived_links(spark, sf):
    pid = F.col("page_id")
    link = (
        F.when(pid % 11 == 0, F.lit(None).cast("string"))
        .when(pid % 7 == 0, F.lit(""))
        .when(pid % 3 == 0, F.regexp_replace("url", "^[A-Za-z]+://[^/]+", ""))
        .otherwise(F.col("url"))
    )
    src = F.when(pid % 2 == 0, F.lit("tribune_latest")).otherwise(F.lit("dawn_latest"))
    return table(spark, sf, "pages", cores(spark)).select("page_id", src.alias("source"), link.alias("link"))


@query(
    "link_absolutise",
    f"WITH e AS (SELECT page_id, {_SRC_SQL} AS source, {_LINK_SQL} AS link FROM pages) "
    "SELECT page_id, source, CASE WHEN NOT starts_with(link, 'http') AND source = 'tribune_latest' "
    "THEN 'https://tribune.com.pk' || link ELSE link END AS link FROM e "
    "WHERE coalesce(link, '') <> ''",
)
def link_absolutise(spark, sf):
    e = _derived_links(spark, sf).filter(U.has_link(F.col("link")))
    return e.select("page_id", "source", U.absolutise(F.col("link"), base_url_for(F.col("source"), DEFAULT_SOURCES)).alias("link"))


# ---------------------------------------------------------------------- F-4
SITES = Source(name="sites", allowed_domains=("example.com", "example.net"))
_HOST_SQL = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]*)', 1))"


@query(
    "domain_filter",
    f"WITH h AS (SELECT page_id, {_HOST_SQL} AS host FROM pages) "
    "SELECT page_id, host FROM h WHERE host = 'example.com' OR host LIKE '%.example.com' "
    "OR host = 'example.net' OR host LIKE '%.example.net'",
)
def domain_filter(spark, sf):
    pages = table(spark, sf, "pages", cores(spark)).select("page_id", U.host(F.col("url")).alias("host"))
    domains = F.array(*[F.lit(d) for d in SITES.allowed_domains])
    return pages.filter(U.in_domain(F.col("host"), domains))


# ------------------------------------------------------------- P-17, F-6
_SCHEME = "lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1))"
_AUTH = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
_PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_QUERY = "regexp_extract(url, '^[^?#]*[?]([^#]*)', 1)"
_SORTED_Q = (
    f"array_to_string(list_transform(list_sort(list_transform(list_filter(string_split({_QUERY}, '&'), "
    "lambda a: a <> ''), lambda a: {'k': split_part(a, '=', 1), 'kv': a})), lambda s: s.kv), '&')"
)


@query(
    "canonical_urls",
    "WITH c AS (SELECT page_id, "
    f"{_SCHEME} || '://' || {_AUTH} || CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END "
    f"|| CASE WHEN {_SORTED_Q} <> '' THEN '?' || {_SORTED_Q} ELSE '' END AS canonical_url FROM pages) "
    "SELECT canonical_url, min(page_id) AS page_id, count(*) AS n_requests FROM c GROUP BY canonical_url",
)
def canonical_urls(spark, sf):
    """F-6: one request per canonical url, the earliest position wins.

    ``min`` is combined map-side, so even a url requested a billion times is
    one row per partition before the shuffle.
    """
    pages = table(spark, sf, "pages", cores(spark)).select("page_id", U.canonical_url(F.col("url")).alias("canonical_url"))
    return pages.groupBy("canonical_url").agg(
        F.min("page_id").alias("page_id"), F.count(F.lit(1)).alias("n_requests")
    )


# Links as feeds spell them: (what precedes the page id, what follows it, expected host, expected canonical form around the id).
_FORMS = [
    ("HTTP://Images_X.Example.com/a|b/", " c[1]", "images_x.example.com", "http://images_x.example.com/a%7Cb/", "%20c%5B1%5D"),
    ("https://user:pw@News.example.com:8080/%zz/%7e%2f/", "?b=%e9&a=1 2", "news.example.com", "https://user:pw@news.example.com:8080/%25zz/~%2F/", "?a=1+2&b=%E9"),
    ("  https://news.example.com?q=", "&&b#x|y", "news.example.com", "https://news.example.com/?b&q=", None),
    ("https://[2001:DB8::1]:443/é/", "/日本?ü=%20", "[2001:db8::1]", "https://[2001:db8::1]:443/%C3%A9/", "/%E6%97%A5%E6%9C%AC?%C3%BC=+"),
    ("//cdn.example.com/", "", "cdn.example.com", None, None),
    ("/story/", "?a^b", None, None, None),
    ("mailto:desk", "@example.com", None, None, None),
]


@query(
    "url_forms",
    "SELECT page_id, form, CASE form " + " ".join(f"WHEN {i} THEN {repr(h) if h else 'NULL'}" for i, (_, _, h, _, _) in enumerate(_FORMS))
    + " END AS host, CASE form " + " ".join(
        f"WHEN {i} THEN '{a}' || page_id" + (f" || '{b}'" if b else "") if a else f"WHEN {i} THEN NULL" for i, (_, _, _, a, b) in enumerate(_FORMS))
    + f" END AS canonical FROM pages, range(0, {len(_FORMS)}) r(form)",
)
def url_forms(spark, sf):
    """Spellings that a strict parser refuses keep their host and get one canonical form."""
    pid = F.col("page_id").cast("string")
    links = F.array(*[F.concat(F.lit(a), pid, F.lit(b)) for a, b, _, _, _ in _FORMS])
    pages = table(spark, sf, "pages", cores(spark)).select("page_id", F.posexplode(links).alias("form", "link"))
    return pages.select("page_id", F.col("form").cast("long").alias("form"), U.host(F.col("link")).alias("host"), U.canonical_url(F.col("link")).alias("canonical"))
