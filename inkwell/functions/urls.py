"""URL column functions (P-13, P-17, F-1, F-4).

Urls are split by the pattern of RFC 3986 (appendix B), which every string matches, so no
url is lost to a parser that refuses it.  The canonical form writes each unsafe byte as a
percent escape, as a crawler sends it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.functions.text import bind

# Groups: 2 scheme, 4 authority, 5 path, 7 query, 9 fragment.
_PARTS = "(?s)^(([A-Za-z][A-Za-z0-9+.-]*):)?(//([^/?#]*))?([^?#]*)(\\?([^#]*))?(#(.*))?$"
# Characters that need no escape where they stand; "%" is handled apart.
_UNRESERVED = "A-Za-z0-9._~\\-"
_PATH_SAFE = _UNRESERVED + "!$&'()*+,;=:@/"
_QUERY_SAFE = _UNRESERVED + "!$&'()*+,;=:@/?"


def has_link(link: Column) -> Column:
    """F-1: a link is usable when it is neither NULL nor ''."""
    return F.coalesce(link, F.lit("")) != ""


def absolutise(link: Column, base: Column) -> Column:
    """P-13: prefix the source's base unless the link already starts with 'http'.

    A NULL base (source without relative links) leaves the link unchanged.
    """
    return F.when(
        link.isNotNull() & ~link.startswith("http") & base.isNotNull(), F.concat(base, link)
    ).otherwise(link)


def cleaned(url: Column) -> Column:
    """Without control characters and spaces at the ends, and without tabs and line breaks inside."""
    return F.regexp_replace(F.regexp_replace(url, "^[\\x00-\\x20]+|[\\x00-\\x20]+$", ""), "[\\t\\r\\n]", "")


def url_part(url: Column, name: str) -> Column:
    """One part of a cleaned url ('' if it has none; NULL for a NULL url)."""
    group = {"scheme": 2, "authority": 4, "path": 5, "query": 7, "fragment": 9}[name]
    return F.regexp_extract(url, _PARTS, group)


def host(url: Column) -> Column:
    """Lower-cased host: the authority without user and port; NULL for a url without one."""
    authority = url_part(cleaned(url), "authority")
    bare = F.regexp_replace(F.regexp_replace(authority, "(?s)^.*@", ""), "(?s)^(\\[[^\\]]*\\]|[^:\\[]*).*$", "$1")
    return F.nullif(F.lower(bare), F.lit(""))


def in_domain(url_host: Column, domains: Column) -> Column:
    """F-4: host equals an allowed domain or is a sub-domain of one."""
    return F.exists(
        domains, lambda d: (url_host == F.lower(d)) | url_host.endswith(F.concat(F.lit("."), F.lower(d)))
    )


def escaped(part: Column, safe: str) -> Column:
    """Percent-encode every byte outside ``safe`` (a character class).

    Valid escapes stay, with upper-case digits, or become the character if that is unreserved; a
    "%" that begins no escape becomes "%25".  Parts of safe characters only are not taken apart.
    """

    def one(t):
        char = F.char(F.conv(F.substring(t, 2, 2), 16, 10).cast("int"))
        return (F.when((F.length(t) == 3) & t.startswith("%"), F.when(char.rlike(f"^[{_UNRESERVED}]$"), char).otherwise(F.upper(t)))
                .when(t.rlike(f"^[{safe}]+$"), t)
                .otherwise(F.regexp_replace(F.hex(t), "(..)", "%$1")))

    tokens = F.regexp_extract_all(part, F.lit(f"(?s)%[0-9A-Fa-f]{{2}}|[{safe}]+|."), F.lit(0))
    return F.when(part.rlike(f"^[{safe}]*$"), part).otherwise(F.array_join(F.transform(tokens, one), ""))


def sorted_query(query: Column) -> Column:
    """Query arguments sorted by (name, value); empty arguments dropped."""
    args = F.filter(F.split(query, "&"), lambda a: a != "")
    keyed = F.transform(args, lambda a: F.struct(F.split_part(a, F.lit("="), F.lit(1)).alias("k"), a.alias("kv")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: s["kv"]), "&")


def canonical_url(url: Column) -> Column:
    """P-17: request fingerprint form of a URL.

    Scheme and authority lower-cased, empty path -> '/', unsafe bytes escaped, query arguments sorted
    (a space in them is '+', escaped or not), fragment dropped.  NULL for input without scheme and authority.
    """

    def form(u):
        scheme, authority = F.lower(url_part(u, "scheme")), F.lower(F.rtrim(url_part(u, "authority"), F.lit(":")))
        path = escaped(url_part(u, "path"), _PATH_SAFE)
        query = F.regexp_replace(escaped(url_part(u, "query"), _QUERY_SAFE), "%20", "+")
        head = F.concat(scheme, F.lit("://"), authority, F.when(path == "", F.lit("/")).otherwise(path))
        return bind(sorted_query(query), lambda q: F.when(
            (scheme != "") & (authority != ""), F.when(q != "", F.concat(head, F.lit("?"), q)).otherwise(head)))

    return bind(cleaned(url), form)
