"""P-6..P-9, P-14, F-8: HTML text extraction and whitespace handling."""

from html.parser import HTMLParser

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from inkwell.functions import text as T
from inkwell.functions.container import container_text
from inkwell.registry import Container


def texts(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "h string")
    return [r[0] for r in df.select(fn(F.col("h"))).collect()]


def test_feed_paragraphs_joined_by_space(spark):
    out = texts(spark, T.paragraph_text, ["<p>Rain fell on the harbour.</p><p>Boats stayed in; nets were mended.</p>"])
    assert out == ["Rain fell on the harbour. Boats stayed in; nets were mended."]


def test_paragraphs_inside_div(spark):
    out = texts(spark, T.paragraph_text, ["<div class=a><div><p>1 owl</p></div><p>2 owls</p><span>none</span></div>"])
    assert out == ["1 owl 2 owls"]


def test_one_short_word_is_content(spark):
    # however short, feed text is content: no length rule, no fallback
    assert texts(spark, T.paragraph_text, ["<p>Ok</p>", "<p>.</p>"]) == ["Ok", "."]


def test_no_paragraph_uses_whole_fragment(spark):
    # P-7
    out = texts(spark, T.paragraph_text, ["<div>Hello <b>bold</b>\n world</div>", "plain text only"])
    assert out == ["Hello bold world", "plain text only"]


def test_blank_and_null(spark):
    out = texts(spark, T.paragraph_text, [None, "", "<p>  </p><p>\n</p>", "<p></p>"])
    assert out == [None, None, None, None]


def test_blank_paragraphs_dropped_and_nodes_stripped(spark):
    out = texts(spark, T.paragraph_text, ["<p> a <i> b </i>c</p><p> </p><p>d</p>"])
    assert out == ["a b c d"]


def test_script_style_comment_removed_first(spark):
    h = '<script>var t="</p>";</script><style>p{}</style><!-- <p>hidden</p> --><p>shown</p>'
    assert texts(spark, T.paragraph_text, [h]) == ["shown"]


def test_unclosed_paragraphs_close_implicitly(spark):
    # D-8: each text once, HTML5 implicit closing
    h = "<article><h1>T</h1><p><b>one<br><p>two</p><p>three</article><footer>foot</footer>"
    assert texts(spark, T.paragraph_text, [h]) == ["one two three"]


def test_entities(spark):
    h = "<p>a &amp;lt; b &amp;&amp; c &copy; &middot; &quot;q&quot; &#8217; &#x41; &eacute; &nbsp;x</p>"
    out = texts(spark, T.paragraph_text, [h])[0]
    assert out == "a &lt; b && c © · \"q\" ’ A é \xa0x"


def test_entity_markup_not_reparsed(spark):
    assert texts(spark, T.paragraph_text, ["<p>&lt;p&gt;x&lt;/p&gt; &#60;b&#62;</p>"]) == ["<p>x</p> <b>"]


def test_bare_less_than_is_text(spark):
    assert texts(spark, T.paragraph_text, ["<p>a < b and 3<4</p>"]) == ["a < b and 3<4"]


def test_python_whitespace_strip(spark):
    # P-14: Python strip set, not ASCII space only
    vals = ["\t\n\xa0ab c　 ", " x ", " \x1c y \x1f"]
    out = texts(spark, T.py_strip, vals)
    assert out == [v.strip() for v in vals]


RULE = Container("div", "class", "story__content")


def test_container_nested(spark):
    h = ('<div class="x story__content y"><div><p>one</p></div><p>two</p></div>'
         '<div class="other"><p>outside</p></div>')
    assert texts(spark, lambda c: container_text(c, RULE), [h]) == ["one two"]


def test_container_every_match(spark):
    """All matching elements count, nested ones once; decoys, scripts and odd quoting do not matter."""
    cases = {
        '<div class="story__content"><p>A</p></div><hr><div class="story__content"><p>B</p></div>': "A B",
        '<div class="story__content"><p>A</p><div class="story__content"><p>B</p></div><p>C</p></div><p>no</p>': "A B C",
        '<div class="story__content"><p>A</p><script>x="</div>"</script><!-- </div> --><p>B</p></div><p>no</p>': "A B",
        "<div class=story__content><p>A</p></div>": "A",
        "<div id='a>b' class = 'q story__content'><p>A</div>": "A",
        '<div class="story__content"><p>never closed': "never closed",
        '<div class="story__content"><p>first</div>tail<div class="story__content"><p>last</div>': "first last",
        "<div data-class='story__content'><p>no</p></div>": None,
        "<div title='class=story__content'><p>no</p></div>": None,
        "<div><p>no container</p></div>": None,
        '<div class="story__content"><p> </p></div>': None,
    }
    assert texts(spark, lambda c: container_text(c, RULE), list(cases)) == list(cases.values())


def test_container_many_tags_is_linear(spark):
    h = '<div class="story__content">' + "<div><p>w</p></div>" * 3000 + "</div>"
    assert texts(spark, lambda c: container_text(c, RULE), [h]) == [" ".join(["w"] * 3000)]


def test_container_exact_id(spark):
    rule = Container("section", "id", "main-section", exact=True)
    h = '<section id="main-section-2"><p>no</p></section><section id="main-section"><p>yes</p></section>'
    assert texts(spark, lambda c: container_text(c, rule), [h]) == ["yes"]
    # any element with the id, unquoted values too
    rule = Container(None, "id", "main-section", exact=True)
    h = "<main id=main-section><section><p>yes</p></section></main><section id='x'><p>no</p></section>"
    assert texts(spark, lambda c: container_text(c, rule), [h, "<p id='other'>x</p>"]) == ["yes", None]


def test_quoted_greater_than_does_not_end_a_tag(spark):
    h = ["<p><a title='a>b'>x</a></p>", '<p>1 <img alt="2 > 1" src=x> 2', "<p>it<b class=it's>s</b>", "<p a='x>y</p>"]
    assert texts(spark, T.paragraph_text, h) == ["x", "1 2", "it s", "y"]


def test_references_without_limits(spark):
    h = "<p>&#0000000065; &#x0000000042; &check; &copy 2025 &notit; &amp &#99999999; &#xFFFFFFFF; &nosuchname; &#67x &CounterClockwiseContourIntegral;</p>"
    assert texts(spark, T.paragraph_text, [h]) == ["A B ✓ © 2025 ¬it; & \ufffd \ufffd &nosuchname; Cx ∳"]


class _Twin(HTMLParser):
    """Text nodes of <p> elements (or of everything) by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.paragraphs, self.whole, self.seen = None, [], [], False

    def handle_starttag(self, tag, attrs):
        if tag == "p" or tag in T.P_CLOSING_STARTS:
            self.close_p()
        if tag == "p":
            self.open, self.seen = [], True
        self.cut()

    def handle_endtag(self, tag):
        if tag == "p" or tag in T.P_CLOSING_ENDS:
            self.close_p()
        self.cut()

    def handle_comment(self, data):
        self.cut()

    def cut(self):
        for nodes in (self.whole, self.open):
            if nodes is not None:
                nodes.append("")

    def handle_data(self, data):
        for nodes in (self.whole, self.open):
            if nodes is not None:
                nodes[-1:] = [nodes[-1] + data] if nodes else [data]

    def close_p(self):
        if self.open is not None:
            self.paragraphs += self.open
            self.open = None

    def text(self):
        self.close_p()
        nodes = self.paragraphs if self.seen else self.whole
        return " ".join(x.strip() for x in nodes if x.strip()) or None


def twin(h):
    t = _Twin()
    t.feed(h)
    t.close()
    return t.text()


def test_pages_match_a_parser(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    rows = pages.select("html", T.paragraph_text(F.col("html")).alias("text")).collect()
    import re

    visible = [re.sub(r"(?is)<(script|style)\b.*?</\1>", "<wbr>", r["html"]) for r in rows]
    assert [r["text"] for r in rows] == [twin(v) for v in visible]


_frag = st.lists(
    st.sampled_from(["<p>", "</p>", "<b>", "</b>", "<div>", "</div>", "<br>", "<p class='a>b'>", " ", "\n", "&amp;", "&lt;", "&nbsp;",
                     "\xa0", "<!-- c -->", "<h1>", "</h1>", "<li>", "</li>", "a", "b c", "1 < 2", "&copy 5", "&#x41;"]),
    max_size=14,
).map("".join)


@settings(max_examples=15, deadline=None)
@given(st.lists(_frag, min_size=1, max_size=8))
def test_property_regex_equals_parser(spark, frags):
    df = spark.createDataFrame([(f,) for f in frags], "h string")
    for (got,), f in zip(df.select(T.paragraph_text(F.col("h"))).collect(), frags):
        assert got == twin(f), f


class _Tree:
    """Plain reading of the same pages: parents by a stack, steps by counting children."""

    def __init__(self, html, steps):
        import re

        from inkwell.functions.container import _ENDS_P, _VOID

        self.root = {"name": "", "kids": [], "text": [], "attrs": ""}
        stack = [self.root]
        for m in re.finditer(r"(</?)([a-z0-9]+)([^<>]*)>|([^<]+)", html):
            if m[4]:
                stack[-1]["kids"].append(m[4])
                continue
            name = m[2]
            if m[1] == "</":
                if name in [e["name"] for e in stack]:
                    while stack.pop()["name"] != name:
                        pass
                continue
            if name in _ENDS_P and stack[-1]["name"] == "p":
                stack.pop()
            e = {"name": name, "kids": [], "attrs": m[3]}
            stack[-1]["kids"].append(e)
            if name not in _VOID:
                stack.append(e)
        self.found = []
        self.walk(self.root, steps)

    def walk(self, e, steps):
        for k in e["kids"]:
            if isinstance(k, dict):
                if "id=x" in k["attrs"]:
                    self.follow(k, steps)
                self.walk(k, steps)

    def follow(self, e, steps):
        if not steps:
            self.found.append(e)
            return
        name, nth = steps[0]
        same = [k for k in e["kids"] if isinstance(k, dict) and k["name"] == name]
        for k in same if nth is None else same[nth - 1:nth]:
            self.follow(k, steps[1:])

    def words(self):
        def text(e):
            return [w for k in e["kids"] for w in (k.split() if isinstance(k, str) else text(k))]

        return sorted(w for e in self.found for w in text(e))


def test_container_paths_against_a_tree(spark):
    import random

    from inkwell.functions.container import container_text, path_steps
    from inkwell.registry import Container

    rng = random.Random(9)
    path = "div[2]/span/p"

    def page(depth=0):
        out = []
        for _ in range(rng.randint(1, 4)):
            name = rng.choice(["div", "div", "span", "span", "p", "b", "br"])
            attrs = " id=x" if name == "div" and rng.random() < 0.3 else ""
            out.append(f"<{name}{attrs}>" if rng.random() > 0.05 else f"</{name}>")
            out.append(f"w{rng.randint(0, 9999)}" if rng.random() < 0.6 else "")
            if name != "br" and depth < 5:
                out.append(page(depth + 1))
            out.append(f"</{name}>" if rng.random() > 0.1 else "")
        return " ".join(out)

    pages = [page() for _ in range(150)] + ["<div id=x><div></div><div><span><p>a<p>b</span></div></div>", "<p>none</p>"]
    df = spark.createDataFrame(list(enumerate(pages)), "i long, html string")
    rule = Container(None, "id", "x", exact=True, path=path, strict=True)
    got = {r["i"]: r["t"] for r in df.select("i", container_text(F.col("html"), rule).alias("t")).collect()}
    want = [_Tree(p, path_steps(path)).words() for p in pages]
    assert [sorted((got[i] or "").split()) for i in range(len(pages))] == want
    assert sum(map(bool, want)) > 5


def test_all_elements_with_the_id_count(spark):
    from inkwell.functions.container import container_text
    from inkwell.registry import TRIBUNE, Container

    rule = Container(None, "id", "x", exact=True)
    df = spark.createDataFrame([("<div id=x><p>A</p></div><p>no</p><section id='x'><p>B</p><div id=x><p>C</p></div></section><p>no",)], "html string")
    assert df.select(container_text(F.col("html"), rule)).first()[0] == "A B C"
    lenient = spark.createDataFrame([("<main id=main-section><p>only</p></main>",)], "html string")
    assert lenient.select(container_text(F.col("html"), TRIBUNE.container)).first()[0] == "only"


def test_container_fold_stands_once_in_the_plan(spark):
    """Within a lambda Spark evaluates an expression as often as it stands there; the fold over a page's tags stands there once."""
    from inkwell.functions.container import container_text
    from inkwell.registry import Container

    page = "<div id=x><p>one</p><section><p>two <b>three</b></section></div>"
    df = spark.createDataFrame([(page,), (None,), ("<p>no</p>",), ("<div id=x></div>",)], "html string")
    plain = Container(tag="div", attr="id", needle="x")
    for rule, text in ((plain, "one two three"), (Container(tag="", attr="id", needle="x"), "one two three"),
                       (Container(tag="", attr="id", needle="x", path="section/p", strict=True), "two three")):
        out = df.select(container_text(F.col("html"), rule).alias("t"))
        assert out._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1, rule
        assert [r["t"] for r in out.collect()] == [text, None, None, None], rule
