"""Text and HTML column functions (P-1, P-6..P-9, P-14, F-8, A-6).

Everything here is a ``Column -> Column`` built from native Spark
expressions (regexp, split, higher-order transform/filter/aggregate), so the
work stays in the JVM with no Python workers, character references included.
"""

from __future__ import annotations

import json
import sys
import zlib
from html.entities import html5 as _HTML5_NAMES

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's ``str.strip()`` removes: derived from ``str.isspace``
# (29 code points), so ``btrim`` matches the reference's strip exactly.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())

# Named character references decoded natively, in the order
# they are applied; "&amp;" must come last so "&amp;lt;" decodes to "&lt;".
COMMON_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&reg;", "®"),
    ("&middot;", "·"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&lsquo;", "‘"),
    ("&rsquo;", "’"),
    ("&ldquo;", "“"),
    ("&rdquo;", "”"),
    ("&hellip;", "…"),
    ("&amp;", "&"),
]

# Any character reference (named or numeric) not in the native list.

# Markup that carries no visible text; removed before any splitting.  Each is
# replaced by an empty inline tag so the text on both sides stays two nodes.
_INVISIBLE_RE = (
    "(?is)<(?:!--.*?-->|script(?:[^A-Za-z0-9>][^>]*)?>.*?</script[^>]*>"
    "|style(?:[^A-Za-z0-9>][^>]*)?>.*?</style[^>]*>)"
)
_NODE_BREAK = "<wbr>"

# The rest of a tag: a ">" inside a quoted value does not end it.  Possessive, so
# a tag of any length is matched in linear time without recursion.
ATTRS = "[^<>=]*+(?:=[ \\t\\r\\n\\f]*+(?:\"[^\"<]*+\"|'[^'<]*+')?+[^<>=]*+)*+"

# A tag (start, end, declaration, processing instruction).  A bare "<" that is
# not followed by a letter, "/", "!" or "?" is text, as in an HTML parser; a
# tag never spans another "<" (malformed markup such as "<b;<p>" is text
# followed by a tag).
TAG_RE = "<(?:/?[A-Za-z]" + ATTRS + "|![^<>]*|[?][^<>]*)>"

# A <p> start tag (not <pre>, <param>, ...).
P_OPEN_RE = "(?i)<p(?:[^A-Za-z0-9<>][^<>]*)?>"

# Elements whose start tag implicitly closes an open <p>, and
# elements whose end tag closes it by closing its parent (HTML5 rules).
P_CLOSING_STARTS = [
    "address", "article", "aside", "blockquote", "details", "div", "dl",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
    "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol",
    "pre", "section", "table", "ul",
]
P_CLOSING_ENDS = [
    "address", "article", "aside", "blockquote", "body", "details", "div",
    "dl", "fieldset", "figcaption", "figure", "footer", "form", "header",
    "html", "li", "main", "menu", "nav", "ol", "section", "table", "td", "th",
    "ul",
]
_P_END_RE = (
    "(?is)<(?:/p[^A-Za-z0-9<>]*"
    "|(?:" + "|".join(P_CLOSING_STARTS) + ")(?:[^A-Za-z0-9<>][^<>]*)?"
    "|/(?:" + "|".join(P_CLOSING_ENDS) + ")(?:[^A-Za-z0-9<>][^<>]*)?)>.*"
)


def py_strip(c: Column) -> Column:
    """Python ``str.strip()``: trims the full Unicode whitespace set."""
    return F.btrim(c, F.lit(PY_WHITESPACE))


def strip_or_null(c: Column) -> Column:
    """``value.strip() if value else None`` (empty input becomes NULL)."""
    return F.when(F.coalesce(c, F.lit("")) != "", py_strip(c))


# A reference the native per-node chain does not cover (numeric, or a rarer
# name).  Java regex (look-ahead); only decides which rows take the slower path.
_RARE_REFERENCE_RE = (
    "&(?:#[0-9]|#[xX][0-9a-fA-F]|(?!(?:"
    + "|".join(k[1:-1] for k, _ in COMMON_ENTITIES if not k.startswith("&#"))
    + ");)[A-Za-z])"
)
_MARKUP_ESCAPE = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")]


_CELLS = 512


def _named_references() -> Column:
    """All HTML names (from the standard library's table) as one literal: an array
    of small maps by checksum, so a lookup is an index and a few comparisons."""
    cells: list[dict] = [{} for _ in range(_CELLS)]
    for name, text in _HTML5_NAMES.items():
        cells[zlib.crc32(name.encode()) % _CELLS][name] = text
    return F.from_json(F.lit(json.dumps(cells)), "array<map<string,string>>")


# Names that HTML also accepts without ";", longest first.
_LEGACY_RE = "^(" + "|".join(sorted((n for n in _HTML5_NAMES if not n.endswith(";")), key=lambda n: (-len(n), n))) + ")"


def _c1_remap() -> dict[int, str]:
    # Numeric references 0x80-0x9F mean windows-1252 characters (HTML rule).
    out = {}
    for b in range(0x80, 0xA0):
        try:
            out[b] = bytes([b]).decode("cp1252")
        except UnicodeDecodeError:
            out[b] = chr(b)  # undefined in windows-1252: kept as is
    return out


def _utf8_hex(cp: Column) -> Column:
    def byte(v):
        return F.lpad(F.hex(v), 2, "0")

    lo6 = cp.bitwiseAND(0x3F).bitwiseOR(0x80)
    mid6 = F.shiftright(cp, 6).bitwiseAND(0x3F).bitwiseOR(0x80)
    hi6 = F.shiftright(cp, 12).bitwiseAND(0x3F).bitwiseOR(0x80)
    return (
        F.when(cp < 0x80, byte(cp))
        .when(cp < 0x800, F.concat(byte(F.shiftright(cp, 6).bitwiseOR(0xC0)), byte(lo6)))
        .when(cp < 0x10000, F.concat(byte(F.shiftright(cp, 12).bitwiseOR(0xE0)), byte(mid6), byte(lo6)))
        .otherwise(F.concat(byte(F.shiftright(cp, 18).bitwiseOR(0xF0)), byte(hi6), byte(mid6), byte(lo6)))
    )


def codepoint_text(cp: Column) -> Column:
    """Character for a numeric reference, with the HTML parser's fix-ups:
    0 / surrogates / out of range -> U+FFFD, C1 range -> windows-1252,
    other control and non-characters -> removed."""
    remap = _c1_remap()
    c1 = F.get(F.lit([remap[k] for k in range(0x80, 0xA0)]), cp - 0x80)
    invalid = (cp == 0) | (cp > 0x10FFFF) | cp.between(0xD800, 0xDFFF)
    dropped = (
        cp.between(0x01, 0x08) | (cp == 0x0B) | cp.between(0x0E, 0x1F) | (cp == 0x7F)
        | cp.between(0xFDD0, 0xFDEF) | (cp.bitwiseAND(0xFFFE) == 0xFFFE)
    )
    return (
        F.when(invalid, F.lit("\ufffd"))
        .when(cp.between(0x80, 0x9F), c1)
        .when(dropped, F.lit(""))
        .otherwise(F.decode(F.unhex(_utf8_hex(cp)), "UTF-8"))
    )


def _markup_safe(c: Column) -> Column:
    for ch, ent in _MARKUP_ESCAPE:
        c = F.replace(c, F.lit(ch), F.lit(ent))
    return c


def resolve_references(html: Column) -> Column:
    """Decode every character reference in a document, natively (P-8 tail).

    Each piece after an "&" is inspected: a numeric reference becomes its
    character (UTF-8 bytes assembled arithmetically, then ``decode``), a
    named one is looked up in the HTML table, and the names that need no ";"
    match as the longest prefix; a produced "&", "<" or ">" is written back as a
    reference so markup structure cannot change.
    """
    names = _named_references()

    def lookup(name):
        return F.try_element_at(F.get(names, F.pmod(F.crc32(name.cast("binary")), F.lit(_CELLS)).cast("int")), name)

    def piece(p, i):
        number = F.regexp_extract(p, "^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", 0)
        hexa = F.ltrim(F.regexp_extract(number, "^#[xX]([0-9a-fA-F]+)", 1), F.lit("0"))
        dec = F.ltrim(F.regexp_extract(number, "^#([0-9]+)", 1), F.lit("0"))
        far = (F.length(dec) > 7) | (F.length(hexa) > 6)  # beyond every code point
        cp = (F.when(far, 0)
              .when(number.rlike("^#[xX]"), F.conv(F.concat(F.lit("0"), hexa), 16, 10).cast("int"))
              .otherwise(F.concat(F.lit("0"), dec).try_cast("int")))
        name = F.regexp_extract(p, "^[A-Za-z][A-Za-z0-9]*;", 0)
        short = F.regexp_extract(p, _LEGACY_RE, 1)
        named, legacy = lookup(name), lookup(short)

        def rest(c):
            return F.substr(p, F.length(c) + 1)

        return (
            F.when(i == 0, p)
            .when(number != "", F.concat(_markup_safe(codepoint_text(cp)), rest(number)))
            .when(named.isNotNull(), F.concat(_markup_safe(named), rest(name)))
            .when(legacy.isNotNull(), F.concat(_markup_safe(legacy), rest(short)))
            .otherwise(F.concat(F.lit("&"), p))
        )

    return F.array_join(F.transform(F.split(html, "&"), piece), "")


def resolve_rare_references(html: Column) -> Column:
    """Only documents holding a reference outside the common set pay for the
    full resolver; the common ones are decoded per text node."""
    return F.when(html.rlike(_RARE_REFERENCE_RE), resolve_references(html)).otherwise(html)


def decode_entities(c: Column) -> Column:
    """Common named references -> characters, natively ("&amp;" last)."""
    chain = c
    for ent, ch in COMMON_ENTITIES:
        chain = F.replace(chain, F.lit(ent), F.lit(ch))
    return F.when(c.contains("&"), chain).otherwise(c)


def strip_invisible(html: Column) -> Column:
    """Drop comments, scripts and styles (their text is never visible), and
    resolve rare character references once for the whole document."""
    return F.regexp_replace(resolve_rare_references(html), _INVISIBLE_RE, _NODE_BREAK)


def bind(value: Column, fn) -> Column:
    """Evaluate ``value`` once and hand it to ``fn`` as a lambda variable.

    Expressions that would otherwise repeat a costly sub-expression (the
    cleaned document, its split into paragraphs) reference the variable
    instead, so each is computed once per row.
    """
    return F.get(F.transform(F.array(value), fn), 0)


# Whole-document formulation used by the public functions: no per-element
# lambdas, only regular-expression passes (compiled once, run in the JVM).
_NUL = "\u0000"
def _ranges_class(chars: str) -> str:
    """A regex character class of ``chars`` written as code-point ranges
    (a long list of single characters is far slower to test)."""
    cps = sorted(ord(c) for c in chars)
    out, start, prev = [], cps[0], cps[0]
    for cp in cps[1:] + [None]:
        if cp is not None and cp == prev + 1:
            prev = cp
            continue
        out.append(f"\\u{start:04x}" if start == prev else f"\\u{start:04x}-\\u{prev:04x}")
        if cp is not None:
            start = prev = cp
    return "[" + "".join(out) + "]"


_WS_CLASS = _ranges_class(PY_WHITESPACE)
# A separator (former tag) and the separators / whitespace after it.  Patterns
# that start with a literal are cheap to search; whitespace *before* a
# separator is handled by running the same search on the reversed string.
_AFTER_SEP_RE = "\\x00[\\x00" + _WS_CLASS[1:-1] + "]*"
_P_OPEN_AHEAD = "(?=<[pP](?:[^A-Za-z0-9<>][^<>]*)?>)"
# Everything before the first <p>.
_P_PREFIX_RE = "(?s)^.*?" + _P_OPEN_AHEAD
# From the end of a paragraph (explicit or implied) to the next <p> or the end.
_P_GAP_RE = _P_END_RE[:-2] + ".*?(?:" + _P_OPEN_AHEAD + "|\\z)"


def _flatten(fragment: Column) -> Column:
    """Text nodes of a fragment, each stripped, empty ones dropped, joined by ' '.

    Tags become a NUL separator; a run of separators and the whitespace
    around them is exactly "strip each node, drop empty nodes, join with one
    space", so one regular-expression replace does it for all nodes.
    """
    marked = decode_entities(F.regexp_replace(fragment, TAG_RE, _NUL))
    forward = F.regexp_replace(marked, _AFTER_SEP_RE, _NUL)
    both = F.reverse(F.regexp_replace(F.reverse(forward), _AFTER_SEP_RE, _NUL))
    return py_strip(F.replace(both, F.lit(_NUL), F.lit(" ")))


def _paragraph_region(clean_html: Column) -> Column:
    """Only the inside of <p> elements, paragraphs separated by NUL."""
    no_prefix = F.regexp_replace(clean_html, _P_PREFIX_RE, "")
    return F.regexp_replace(no_prefix, _P_GAP_RE, _NUL)


def paragraph_text(html: Column) -> Column:
    """P-6/P-7: text of all <p>; with no <p> at all, text of the whole fragment.

    Paragraphs close implicitly as in HTML5.  Result is stripped; an empty
    result is NULL (the reference's ``content_text.strip() if content_text
    else None``).
    """

    def from_clean(clean):
        text = F.when(clean.rlike(P_OPEN_RE), _flatten(_paragraph_region(clean))).otherwise(_flatten(clean))
        return F.nullif(text, F.lit(""))

    return F.when(html.isNotNull(), bind(strip_invisible(html), from_clean))


def paragraphs_only_text(html: Column) -> Column:
    """Text of the <p> elements only (no whole-fragment fallback), '' -> NULL."""
    return bind(strip_invisible(html), clean_paragraphs_text)


def clean_paragraphs_text(clean: Column) -> Column:
    """The same for a document that ``strip_invisible`` has already been through."""
    return F.when(clean.rlike(P_OPEN_RE), bind(_flatten(_paragraph_region(clean)), lambda text: F.nullif(text, F.lit(""))))


def whole_text(html: Column) -> Column:
    """P-7 alone: every visible text node of the fragment, joined by ' '."""
    return F.nullif(_flatten(strip_invisible(html)), F.lit(""))


def first_line(text: Column) -> Column:
    return F.get(F.split(text, "\n"), 0)


def xml_escape(c: Column) -> Column:
    """Escape text for an XML element body ("&" first)."""
    out = F.replace(c, F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit(">"), F.lit("&gt;"))


def cdata(c: Column) -> Column:
    """Wrap text in CDATA, splitting any embedded terminator."""
    return F.concat(F.lit("<![CDATA["), F.replace(c, F.lit("]]>"), F.lit("]]]]><![CDATA[>")), F.lit("]]>"))


# Control characters that XML 1.0 forbids in documents.
XML_ILLEGAL_RE = "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]"


def xml_safe(c: Column) -> Column:
    return F.regexp_replace(c, XML_ILLEGAL_RE, "")
