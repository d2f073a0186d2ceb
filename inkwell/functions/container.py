"""Article-container lookup in raw HTML (P-9), as native expressions.

HTML is not well-formed XML, so ``xpath()`` cannot be used.  Comments, scripts
and styles go first; then the start and end tags of the container's element are
listed, and a fold over them keeps the nesting depth and notes where each outermost
matching element begins and ends.  The regions are cut out of the document by
position, so the work is linear in its length.

Rules without an element name, or with a path of child steps, list the tags of all elements and
fold with a stack: each open element knows which steps lead to it and how many children of
each step's name it has had, which decides positions such as ``div[2]``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.functions.text import ATTRS, bind, clean_paragraphs_text, strip_invisible
from inkwell.registry import Container

_WS = "[ \\t\\r\\n\\f]"
# Attributes before the one looked for, values with ">" included.
_EARLIER = f"(?:[^<>=]*+={_WS}*+(?:\"[^\"<]*+\"|'[^'<]*+'|[^ \\t\\r\\n\\f<>\"']*+))*?"


def start_tag_re(rule: Container) -> str:
    """A start tag that matches the rule; group 1 is the element's name."""
    name = re.escape(rule.tag) if rule.tag else "[A-Za-z][A-Za-z0-9]*+"
    if not rule.attr:
        return f"(?is)<({name})(?:[^A-Za-z0-9<>]{ATTRS})?>"
    attr, needle = re.escape(rule.attr), re.escape(rule.needle)
    if rule.exact:
        value = f"(?:\"{needle}\"|'{needle}'|{needle}(?=[ \\t\\r\\n\\f/>]))"
    else:
        value = (f"(?:\"[^\"<]*?{needle}[^\"<]*\"|'[^'<]*?{needle}[^'<]*'"
                 f"|(?![\"'])[^ \\t\\r\\n\\f<>]*?{needle}[^ \\t\\r\\n\\f<>]*)")
    return f"(?is)<({name})(?={_WS}){_EARLIER}[^<>=]*?(?<={_WS}){attr}{_WS}*={_WS}*{value}{ATTRS}>"


# Elements without an end tag, and elements that end an open paragraph (HTML standard).
_VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
_ENDS_P = ["address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure",
           "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "search",
           "section", "summary", "table", "ul"]
_ELEMENT = "struct<name:string,on:array<boolean>,had:array<int>>"
_ANY_TAG = f"(?is)</?[a-z][a-z0-9:_-]*+(?:[^a-z0-9:_<>-]{ATTRS})?>"


def path_steps(path: str | None) -> list[tuple[str, int | None]]:
    """``section/div[1]`` -> [("section", None), ("div", 1)]."""
    steps = [re.fullmatch("([A-Za-z][A-Za-z0-9]*)(?:\\[([1-9][0-9]*)\\])?", p) for p in (path.split("/") if path else [])]
    if not all(steps):
        raise ValueError(f"a path has steps like div or div[2]: {path}")
    return [(m[1].lower(), int(m[2]) if m[2] else None) for m in steps]


def element_regions(clean: Column, rule: Container, targets: list[int]) -> Column:
    """Insides of the outermost elements of any name that so many steps of ``rule`` lead to (0: the container
    itself): an array of texts for each of ``targets``, from one fold.

    An open element is (name, which steps lead to it, children so far by the steps' names).  An end tag closes the
    innermost open element of its name with all inside it, or nothing; a block element ends an open paragraph.
    """
    start, steps = start_tag_re(rule), path_steps(rule.path)
    names = F.array(*[F.lit(n) for n, _ in steps]) if steps else F.array().cast("array<string>")
    places = F.array(*[F.lit(k or 0) for _, k in steps]) if steps else F.array().cast("array<int>")
    zeros = F.transform(names, lambda n: F.lit(0))
    no_range = F.array().cast("array<struct<lo:int,hi:int>>")

    def element(name, on, had):
        return F.struct(name.alias("name"), on.alias("on"), had.alias("had"))

    # The document itself is the lowest element of the stack, so that there is always a parent.
    root = element(F.lit(""), F.transform(F.concat(names, F.array(F.lit(""))), lambda n: F.lit(False)), zeros)

    def listed(tags):
        gaps = F.call_function("split", clean, F.lit(_ANY_TAG), F.lit(-1))
        return bind(gaps, lambda g: F.transform(tags, lambda t, i: F.struct(
            F.length(F.get(g, i)).alias("gap"), F.length(t).alias("len"), t.startswith("</").alias("end"), t.endswith("/>").alias("empty"),
            F.lower(F.regexp_extract(t, "^</?([A-Za-z][A-Za-z0-9:_-]*)", 1)).alias("name"), t.rlike(start).alias("match"))))

    def state(pos, stack, marks):
        return F.struct(pos.alias("pos"), stack.alias("stack"), marks.alias("marks"))

    # For each target: where the open region began, how many elements are open inside it and below (0: no region), ranges found.
    def mark(lo, depth, found):
        return F.struct(lo.alias("lo"), depth.alias("depth"), found.alias("found"))

    def cut(s, left, at, pos):
        """The state with the first ``left`` open elements; a region ends with its element."""
        def close(m):
            return F.when((m["depth"] > 0) & (left < m["depth"]), mark(m["lo"], F.lit(0), F.concat(
                m["found"], F.array(F.struct(m["lo"].alias("lo"), at.alias("hi")))))).otherwise(m)

        return state(pos, F.slice(s["stack"], 1, left), F.transform(s["marks"], close))

    def begun(s, t, up):
        leaf = t["empty"] | t["name"].isin(_VOID)
        led = F.transform(names, lambda n, k: F.get(up["on"], k) & (n == t["name"]) & (
            (F.get(places, k) == 0) | (F.get(places, k) == F.get(up["had"], k) + 1)))
        had = F.zip_with(up["had"], names, lambda c, n: c + (n == t["name"]).cast("int"))
        above = F.concat(F.slice(s["stack"], 1, F.size(s["stack"]) - 1), F.array(element(up["name"], up["on"], had)))
        on = F.concat(F.array(t["match"]), led)
        stack = F.concat(above, F.when(leaf, F.array().cast(f"array<{_ELEMENT}>")).otherwise(F.array(element(t["name"], on, zeros))))
        wanted = F.array(*[F.lit(k) for k in targets])

        # Nothing of the state is bound here: a bound value is copied, and the stack is most of the state.
        return state(s["pos"], stack, F.zip_with(s["marks"], wanted, lambda m, k: F.when(
            ~leaf & (m["depth"] == 0) & F.get(on, k), mark(s["pos"], F.size(s["stack"]) + 1, m["found"])).otherwise(m)))

    def step(s, t):
        # How many open elements stay before the tag takes effect: an end tag closes its element, a block element a paragraph.
        size = F.size(s["stack"])
        back = F.array_position(F.reverse(F.transform(s["stack"], lambda e: e["name"])), t["name"]).cast("int")
        ends_p = t["name"].isin(_ENDS_P) & (F.element_at(s["stack"], -1)["name"] == "p")
        left = size - F.when(t["end"], back).otherwise(ends_p.cast("int"))
        at = s["pos"] + t["gap"]
        ready = bind(left, lambda n: cut(s, n, at, at + t["len"]))
        return bind(ready, lambda r: F.when(t["end"], r).otherwise(begun(r, t, F.element_at(r["stack"], -1))))

    def finish(s):
        return F.transform(s["marks"], lambda m: F.when(m["depth"] > 0, F.concat(m["found"], F.array(F.struct(
            m["lo"].alias("lo"), F.length(clean).alias("hi"))))).otherwise(m["found"]))

    init = state(F.lit(0), F.array(root), F.transform(F.sequence(F.lit(1), F.lit(len(targets))), lambda k: mark(F.lit(0), F.lit(0), no_range)))
    ranges = bind(F.regexp_extract_all(clean, F.lit(_ANY_TAG), F.lit(0)), lambda tags: F.aggregate(listed(tags), init, step, finish))
    return F.transform(ranges, lambda rs: F.transform(rs, lambda r: F.substr(clean, r["lo"] + 1, r["hi"] - r["lo"])))


def container_regions(clean: Column, rule: Container) -> Column:
    """Insides of all outermost elements of a cleaned document that match ``rule``.

    An element inside a matching one is part of it; one that is never closed
    reaches to the end, as in an HTML parser.
    """
    start = start_tag_re(rule)
    any_tag = F.lit(f"(?is)</?{re.escape(rule.tag)}(?:[^A-Za-z0-9<>]{ATTRS})?>")

    def listed(tags):
        gaps = F.call_function("split", clean, any_tag, F.lit(-1))
        return bind(gaps, lambda g: F.transform(tags, lambda t, i: F.struct(
            F.length(F.get(g, i)).alias("gap"), F.length(t).alias("len"),
            t.startswith("</").alias("end"), t.rlike(start).alias("match"))))

    empty = F.array().cast("array<struct<lo:int,hi:int>>")
    init = F.struct(F.lit(0).alias("pos"), F.lit(0).alias("depth"), F.lit(0).alias("lo"), empty.alias("found"))

    def step(s, t):
        pos = s["pos"] + t["gap"] + t["len"]
        depth = (F.when(s["depth"] == 0, F.when(t["match"] & ~t["end"], 1).otherwise(0))
                 .when(t["end"], s["depth"] - 1).otherwise(s["depth"] + 1))
        opened, closed = (s["depth"] == 0) & (depth == 1), (s["depth"] == 1) & (depth == 0)
        return F.struct(pos.alias("pos"), depth.alias("depth"), F.when(opened, pos).otherwise(s["lo"]).alias("lo"),
                        F.when(closed, F.concat(s["found"], F.array(F.struct(s["lo"].alias("lo"), (pos - t["len"]).alias("hi")))))
                        .otherwise(s["found"]).alias("found"))

    def finish(s):
        return F.when(s["depth"] > 0, F.concat(s["found"], F.array(F.struct(
            s["lo"].alias("lo"), F.length(clean).alias("hi"))))).otherwise(s["found"])

    ranges = bind(F.regexp_extract_all(clean, any_tag, F.lit(0)), lambda tags: F.aggregate(listed(tags), init, step, finish))
    return F.transform(ranges, lambda r: F.substr(clean, r["lo"] + 1, r["hi"] - r["lo"]))


def container_text(html: Column, rule: Container) -> Column:
    """P-9: text nodes under the <p> elements of all matching containers; '' -> NULL.

    With a path, the text of the elements it leads to; where it finds no text, see ``Container``.
    """
    start = start_tag_re(rule)

    def paragraphs(regions):
        # Each region ends its open paragraph, so regions do not run into each other.
        return bind(F.array_join(regions, "</p>"), clean_paragraphs_text)  # bound: the fold runs once

    def named(regions):
        return bind(F.concat(F.lit("<p>"), F.array_join(regions, "</p><p>"), F.lit("</p>")), clean_paragraphs_text)

    def from_clean(clean):
        if rule.tag and not rule.path:
            text = paragraphs(container_regions(clean, rule))
        elif not rule.path:
            text = paragraphs(F.get(element_regions(clean, rule, [0]), 0))
        elif rule.strict:
            text = named(F.get(element_regions(clean, rule, [len(path_steps(rule.path))]), 0))
        else:
            text = bind(element_regions(clean, rule, [len(path_steps(rule.path)), 0]),
                        lambda found: F.coalesce(named(F.get(found, 0)), paragraphs(F.get(found, 1))))
        return F.when(clean.rlike(start), text)

    return F.when(html.isNotNull(), bind(strip_invisible(html), from_clean))
