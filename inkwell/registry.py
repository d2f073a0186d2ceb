"""Source registry (M1, X-2, X-3).

One extraction pipeline serves every source; what differs per source is data:
allowed domains, the feed address, the base for relative links, and the rule
that locates the article container in a page (page-text fallback, P-9).
The registry is a handful of rows of configuration, so it is turned into
literal expressions at plan time (constant-folded, no join needed).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Container:
    """Rule for the element that holds article paragraphs in a page.

    ``tag`` is the element name (None: any element); with ``attr`` set, the element must carry that
    attribute, and its value must contain ``needle`` (a substring test, like
    XPath ``contains(@class, ...)``) or equal it when ``exact`` is true.

    ``path`` names the paragraphs below the container by child steps, ``div`` or ``div[2]`` (the
    second ``div`` child).  Where the path leads nowhere in a page, all paragraphs of the container count,
    unless ``strict``.
    """

    tag: str | None
    attr: str | None = None
    needle: str | None = None
    exact: bool = False
    path: str | None = None
    strict: bool = False


@dataclass(frozen=True)
class Source:
    name: str
    allowed_domains: tuple[str, ...]
    feed_url: str | None = None
    base_url: str | None = None
    container: Container | None = None
    ttl_seconds: int = 86400
    extra: dict = field(default_factory=dict, compare=False, hash=False)


# The two sources of the reference and their settings.
DAWN = Source(
    name="dawn_latest",
    allowed_domains=("dawn.com",),
    feed_url="https://www.dawn.com/feed",
    base_url=None,
    container=Container("div", "class", "story__content"),
)
TRIBUNE = Source(
    name="tribune_latest",
    allowed_domains=("tribune.com.pk",),
    feed_url="https://tribune.com.pk/feed/latest",
    base_url="https://tribune.com.pk",
    container=Container(None, "id", "main-section", exact=True, path="section/div[1]/div/div[1]/div/div/div/div/span[2]/p"),
)
# Pages in the test tables keep the article body in <article>.
EXAMPLE = Source(
    name="example",
    allowed_domains=("example.com", "example.org", "example.net"),
    base_url=None,
    container=Container("article"),
)

DEFAULT_SOURCES = (DAWN, TRIBUNE)


def per_source(source_col: Column, sources, pick, default=None) -> Column:
    """CASE source WHEN ... expression built from registry entries.

    ``pick(src)`` returns a Column (or a Python literal) for that source.
    """
    expr = None
    for s in sources:
        val = pick(s)
        val = val if isinstance(val, Column) else F.lit(val)
        expr = F.when(source_col == s.name, val) if expr is None else expr.when(source_col == s.name, val)
    if expr is None:
        return default if isinstance(default, Column) else F.lit(default)
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def base_url_for(source_col: Column, sources=DEFAULT_SOURCES, default: Source | None = None) -> Column:
    dflt = F.lit(default.base_url if default else None).cast("string")
    return per_source(source_col, sources, lambda s: s.base_url, default=dflt).cast("string")


def _domains(s: Source) -> Column:
    return F.array(*[F.lit(d) for d in s.allowed_domains]) if s.allowed_domains else F.array().cast("array<string>")


def domains_for(source_col: Column, sources=DEFAULT_SOURCES, default: Source | None = None) -> Column:
    dflt = _domains(default) if default else F.array().cast("array<string>")
    return per_source(source_col, sources, _domains, default=dflt)
