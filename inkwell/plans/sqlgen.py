"""DuckDB SQL fragments for the oracle queries.

The correctness gate runs each Spark query beside an independent SQL
formulation on the same parquet tables.  These helpers produce the SQL side of
the column functions (same regular expressions; RE2 and Java agree on the
constructs used), so the oracle texts stay readable.
"""

from __future__ import annotations

from inkwell.functions import text as T

# A tag as the oracle sees it: up to the next ">" (the test pages have none in a value).
TAG_SQL_RE = "<(?:/?[A-Za-z][^<>]*|![^<>]*|[?][^<>]*)>"
WS_SQL = "(" + "||".join(f"chr({ord(c)})" for c in T.PY_WHITESPACE) + ")"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def py_strip(x: str) -> str:
    return f"trim({x}, {WS_SQL})"


def decode(x: str) -> str:
    out = x
    for ent, ch in T.COMMON_ENTITIES:
        out = f"replace({out}, {lit(ent)}, {lit(ch)})"
    return out


def strip_invisible(x: str) -> str:
    return f"regexp_replace({x}, {lit(T._INVISIBLE_RE)}, {lit(T._NODE_BREAK)}, 'g')"


def node_text(frag: str, var: str = "n") -> str:
    nodes = f"regexp_split_to_array({frag}, {lit(TAG_SQL_RE)})"
    cleaned = f"list_transform({nodes}, lambda {var}: {py_strip(decode(var))})"
    return f"array_to_string(list_filter({cleaned}, lambda {var}: {var} <> ''), ' ')"


def paragraphs(clean: str) -> str:
    parts = f"regexp_split_to_array({clean}, {lit(T.P_OPEN_RE)})"
    bodies = f"list_slice({parts}, 2, len({parts}))"
    texts = f"list_transform({bodies}, lambda b: {node_text(f'regexp_replace(b, {lit(T._P_END_RE)}, {lit("")})', 'n')})"
    return f"list_filter({texts}, lambda t: t <> '')"


def paragraph_text(html: str) -> str:
    clean = strip_invisible(html)
    has_p = f"len(regexp_split_to_array({clean}, {lit(T.P_OPEN_RE)})) > 1"
    text = f"CASE WHEN {has_p} THEN array_to_string({paragraphs(clean)}, ' ') ELSE {node_text(clean)} END"
    return f"CASE WHEN {html} IS NOT NULL THEN nullif({py_strip(text)}, '') END"


def paragraphs_only_text(html: str) -> str:
    return f"nullif(array_to_string({paragraphs(strip_invisible(html))}, ' '), '')"


def whole_text(html: str) -> str:
    return f"nullif({node_text(strip_invisible(html))}, '')"


def strip_or_null(x: str) -> str:
    return f"CASE WHEN coalesce({x}, '') <> '' THEN {py_strip(x)} END"
