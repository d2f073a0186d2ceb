"""SRC-1, A-2, J-1, X-1: RSS parsing, extraction and the crawl run."""

from pyspark.sql import functions as F

from inkwell.operators import extract as X
from inkwell.plans.pipeline import crawl_run
from inkwell.registry import DAWN, TRIBUNE
from inkwell.sources.rss import feed_entries, rss_items

def item(title, link=None, author=None, date=None, tags=(), summary=None, content=None):
    """One <item>; absent parts are left out."""
    parts = [("title", title), ("link", link), ("author", author), ("pubDate", date), *[("category", t) for t in tags]]
    body = "".join(f"<{n}>{v}</{n}>" for n, v in parts if v is not None)
    body += "".join(f"<{n}><![CDATA[{v}]]></{n}>" for n, v in (("description", summary), ("content:encoded", content)) if v is not None)
    return f"<item>{body}</item>"


def feed(*items):
    head = '<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>t</title>'
    return head + "".join(items) + "</channel></rss>"


SITE, BASE = "https://www.dawn.com/n", "https://tribune.com.pk"
OWLS = feed(
    item("Owls return", f"{SITE}/owls", "m@x.org (Mira Holt)", "Mon, 05 May 2025 06:30:00 +0200", ["Nature", "Birds"], "<p>short</p>",
         "<p>Nine owls &amp; a heron were counted.</p>"),
    item("Ferry late", f"{SITE}/ferry", "desk@x.org", "2025-05-05", ["Travel"], "<p>Two hours late.</p>"),
    item("Empty story", f"{SITE}/empty", None, "no date", [], "", ""),
    item("Elsewhere", "https://elsewhere.net/a", None, None, ["Travel"], "<p>off site</p>"),
    item("Owls again", f"{SITE}/owls#comments", None, None, [], "<p>same page</p>"))
RIVER = feed(item("Low river", "/river/low", "Ana", "Mon, 05 May 2025 09:00:00 +0500", ["Water"], "   "), item("Untitled link"), item("Blank link", ""))


def feeds_df(spark):
    return spark.createDataFrame(
        [("dawn_latest", 0, OWLS), ("tribune_latest", 0, RIVER), ("dawn_latest", 1, "not xml"), ("dawn_latest", 2, "")],
        "source string, feed_no int, body string")


def pages_df(spark, owls="<p>unused: the feed has the text</p>"):
    empty = '<div class="story__content"><p>Only the page has it.</p></div><div class=story__content><p>In two parts.</p></div>'
    river = "<main id=main-section><p>Knee deep.</p></main>"
    rows = [(f"{SITE}/owls", f"{SITE}/owls-2025", owls, 200), (f"{SITE}/ferry", f"{SITE}/ferry", "<p>f</p>", 200),
            (f"{SITE}/empty", f"{SITE}/empty", empty, 200), (f"{BASE}/river/low", f"{BASE}/river/low", river, 200)]
    return spark.createDataFrame(rows, "request_url string, url string, html string, status int")


def crawl(spark, at="2025-05-05 12:00:00", pages=None, **kw):
    return crawl_run(feeds_df(spark), pages_df(spark) if pages is None else pages, at, sources=(DAWN, TRIBUNE), **kw)


def test_rss_items_in_feed_order(spark):
    items = rss_items(feeds_df(spark)).orderBy("source", "feed_no", "item_pos").collect()
    owls = [r for r in items if r["source"] == "dawn_latest"]
    assert [r["title"] for r in owls] == ["Owls return", "Ferry late", "Empty story", "Elsewhere", "Owls again"]
    assert {r["n_in_feed"] for r in owls} == {5}
    assert owls[0]["categories"] == ["Nature", "Birds"] and owls[2]["categories"] is None
    assert owls[0]["content_encoded"] == "<p>Nine owls &amp; a heron were counted.</p>"
    river = [r for r in items if r["source"] == "tribune_latest"]
    assert [r["item_pos"] for r in river] == [0, 1, 2] and river[1]["link"] is None


def test_feed_entries_author_and_tags(spark):
    e = feed_entries(rss_items(feeds_df(spark))).filter(F.col("source") == "dawn_latest").orderBy("item_pos").collect()
    assert e[0]["author_detail"]["name"] == "Mira Holt" and e[1]["author_detail"]["name"] is None
    assert [t["term"] for t in e[0]["tags"]] == ["Nature", "Birds"] and e[2]["author_detail"] is None


def test_crawl_run(spark):
    out = crawl(spark)
    arts = {r["link"]: r for r in out.articles.collect()}
    assert set(arts) == {f"{SITE}/owls", f"{SITE}/ferry", f"{SITE}/empty", f"{BASE}/river/low"}  # off-site and repeated links are out
    owls = arts[f"{SITE}/owls"]
    assert owls["content"] == "Nine owls & a heron were counted." and owls["content_from"] == "feed"
    assert owls["author"] == "Mira Holt" and owls["category"] == "Nature"
    assert owls["url"] == f"{SITE}/owls-2025"  # a redirect: the final url is the item's
    assert arts[f"{SITE}/ferry"]["content"] == "Two hours late." and arts[f"{SITE}/ferry"]["author"] is None
    assert str(arts[f"{SITE}/ferry"]["published_at"]) == "2025-05-05 00:00:00"
    empty = arts[f"{SITE}/empty"]
    assert empty["content"] == "Only the page has it. In two parts." and empty["content_from"] == "page" and empty["date_unparsed"]
    river = arts[f"{BASE}/river/low"]  # relative link, blank summary -> page text
    assert river["content"] == "Knee deep." and str(river["published_at"]) == "2025-05-05 04:00:00"
    counts = {r["source"]: r.asDict() for r in out.counts.collect()}
    d, t = counts["dawn_latest"], counts["tribune_latest"]
    assert (d["entries"], d["found"], d["requests"], d["scraped"], d["errors"]) == (5, 5, 3, 3, 0)
    assert (t["entries"], t["found"], t["requests"], t["scraped"]) == (3, 1, 1, 1)
    seen = {(r["source"], r["url"]) for r in out.seen.collect()}
    assert {("dawn_latest", f"{SITE}/owls-2025"), ("dawn_latest", f"{SITE}/owls")} <= seen  # D-6: both are marked
    again = {r["source"]: r["scraped"] for r in crawl(spark, "2025-05-05 13:00:00", seen=out.seen).counts.collect()}
    assert again == {"dawn_latest": 0, "tribune_latest": 0}


def test_status_filter(spark):
    pages = spark.createDataFrame([("u", "u", "<p>a</p>", 404), ("v", "v", "<p>b</p>", 200), ("w", "w", "c", None)],
                                  "request_url string, url string, html string, status int")
    assert [r["url"] for r in X.status_ok(pages).collect()] == ["v", "w"]


def test_error_rows_isolated(spark):
    # V-2: a fetched page without a body is an error: counted, not scraped, not marked seen
    out = crawl(spark, pages=pages_df(spark, owls=None))
    c = {r["source"]: r.asDict() for r in out.counts.collect()}["dawn_latest"]
    assert (c["requests"], c["scraped"], c["errors"]) == (3, 2, 1)
    assert f"{SITE}/owls" not in {r["url"] for r in out.seen.collect()}


def test_entry_a_to_entry_b_handoff(spark, tmp_dir):
    # Entry A exports accepted items; Entry B loads them, sets the unreadable date aside, and archives.
    import os

    from inkwell.operators.merge import read_news
    from inkwell.plans.pipeline import etl_flow
    from inkwell.sinks.files import export_articles

    out = crawl(spark)
    land, table, arch = (os.path.join(tmp_dir, n) for n in ("land", "news", "arch"))
    export_articles(out.accepted, land, "2025-05-05", run_sources=["dawn_latest", "tribune_latest"])
    assert out.accepted.count() == 4
    assert etl_flow(spark, land, table, arch, "2025-05-05 12:05:00", layout="lines") == 4
    rows = {r["url"]: r for r in read_news(spark, table).collect()}
    assert set(rows) == {f"{SITE}/owls-2025", f"{SITE}/ferry", f"{BASE}/river/low"}
    assert {str(r["date"]) for r in rows.values()} == {"2025-05-05"}
    rejects = spark.read.json(table + "_rejects").collect()
    assert [(r["url"], r["reason"], r["raw_date"]) for r in rejects] == [(f"{SITE}/empty", "unreadable date", "no date")]
    assert etl_flow(spark, land, table, arch, "2025-05-05 12:10:00", layout="lines") == 0


def test_broken_feeds_and_fields_are_counted_and_kept(spark):
    from inkwell.sources.rss import feed_problems

    bad = [("dawn_latest", 7, "<rss><channel><item><title>a</title></item><it"), ("dawn_latest", 8, None), ("dawn_latest", 9, " \n"),
           ("dawn_latest", 10, "<html/>"), ("dawn_latest", 11, "<rss><channel></channel></rss>"), ("tribune_latest", 12, "not xml")]
    df = spark.createDataFrame(bad, "source string, feed_no long, body string")
    got = {r["feed_no"]: (r["reason"], r["body"]) for r in feed_problems(df).collect()}
    assert got == {7: ("unreadable", bad[0][2]), 8: ("empty", None), 9: ("empty", " \n"), 10: ("no channel", "<html/>"), 12: ("unreadable", "not xml")}
    out = crawl(spark, pages=pages_df(spark, owls=None))
    found = {(r["source"], r["field"], r["reason"]): r["n"] for r in out.problems.collect()}
    assert found[("dawn_latest", "content", "response without body")] == 1 and found[("dawn_latest", "date", "unreadable date")] == 1
    dropped = [(r["source"], r["reason"]) for r in out.dropped.collect()]
    c = {r["source"]: r.asDict() for r in out.counts.collect()}
    for s in c:  # every entry is an article, an error, or dropped with a reason
        assert c[s]["entries"] == c[s]["scraped"] + c[s]["errors"] + sum(x == s for x, _ in dropped)
    assert ("dawn_latest", "offsite") in dropped and ("dawn_latest", "repeated request") in dropped


def test_crawl_against_the_stored_state(spark, tmp_dir):
    import os

    from inkwell.plans.pipeline import crawl_with_state

    state = os.path.join(tmp_dir, "seen")
    runs = [("2025-05-05 12:00:00", 4), ("2025-05-05 12:00:00", 4), ("2025-05-06 11:59:59", 0), ("2025-05-06 12:00:00", 4)]
    for ts, want in runs:  # a repeated run, one inside the TTL, one at its end
        out = crawl_with_state(spark, feeds_df(spark), pages_df(spark), ts, state)
        assert sum(r["scraped"] for r in out.counts.collect()) == want
    hours = {d for d in os.listdir(state) if d.startswith("hour=")}
    assert len(hours) == 2  # the run's own hour, and the one that ends with it


def test_feed_files_by_item(spark, tmp_dir):
    """Files of one feed follow each other; a broken element costs itself only and keeps its place."""
    import os

    from inkwell.sources import feed_files as FF

    def put(name, body):
        path = os.path.join(tmp_dir, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(body)

    item = "<item><title>%s</title></item>"
    put("source=a/feed_no=1/1.xml", "<rss><channel><title>t</title>" + item % "1" + "<!-- " + item % "no" + " -->"
        + "<item><title>2</title><content:encoded><![CDATA[" + item % "no" + "]]></content:encoded></item></channel></rss>")
    put("source=a/feed_no=1/2.xml", "<rss><channel>" + item % "3" + item % "a & b" + item % "4" + "<item><title>5")
    put("source=a/feed_no=2/1.xml", "")
    put("source=b c/feed_no=2/1.xml", "<html>moved</html>")
    put("source=b c/feed_no=2/2.xml", "<rss><channel>" + "".join(item % i for i in range(500)) + "</channel></rss>")
    numbered = FF.number_items(FF.read_feed_files(spark, tmp_dir))
    items = FF.feed_file_items(numbered)
    got = {(r["source"], r["feed_no"], r["item_pos"]): r["title"] for r in items.collect()}
    assert {k[2]: v for k, v in got.items() if k[0] == "a"} == {0: "1", 1: "2", 2: "3", 4: "4"}
    assert {k[2]: v for k, v in got.items() if k[0] == "b c"} == {i: str(i) for i in range(500)}
    assert {(r["feed_no"], r["n_in_feed"]) for r in items.collect()} == {(1, 6), (2, 500)}
    bad = {(r["source"], r["feed_no"], os.path.basename(r["source_file"]), r["item_pos"]) for r in FF.item_problems(numbered).collect()}
    assert bad == {("a", 1, "2.xml", 3), ("a", 1, "2.xml", 5)}
    entry = feed_entries(items.filter("source = 'a' and item_pos = 1")).first()
    assert entry["title"] == "2" and entry["content"][0]["value"] == item % "no"
    alone = FF.number_items(FF.read_feed_files(spark, tmp_dir), feed=[])  # every file a feed
    assert {(os.path.basename(r["source_file"]), r["n_in_feed"]) for r in alone.filter("source = 'a'").collect()} == {("1.xml", 2), ("2.xml", 4)}


def test_item_chain_orders_stages_and_collects_rejects(spark):
    import pytest

    from inkwell.plans import chain as C

    items = spark.createDataFrame(
        [(" h ", "u1", "c", "a"), (None, "u2", "c", "a"), ("h", "u3", "c", "b"), ("h", "u4", "c", None)], "heading string, url string, content string, author string")
    stored = []
    stages = [C.Stage("keep", 400, lambda df: stored.extend(r["url"] for r in df.collect()), sink=True),
              C.reject_where("authors", 300, [(F.col("author") == "b", "blocked"), (F.col("heading") == "h", "after strip")], store=True),
              C.validation("2025-06-03 12:00:00", spider_col=F.lit("s")),
              C.Stage("tag", 350, lambda df: df.withColumn("tag", F.upper("url")))]
    done = C.run_chain(items, stages)
    assert [tuple(r) for r in done.items.select("url", "tag").collect()] == [] and stored == []
    got = {(r["url"], r["stage"], r["reason"], r["heading"]) for r in done.rejects.collect()}
    assert got == {("u1", "authors", "after strip", "h"), ("u2", "validation", "Missing heading in u2", None), ("u3", "authors", "blocked", "h"),
                   ("u4", "authors", "after strip", "h")}
    assert {(r["stage"], r["reason"], r["n"]) for r in done.reject_counts().collect()} == {
        ("authors", "after strip", 2), ("authors", "blocked", 1), ("validation", "Missing heading in u2", 1)}
    alone = C.run_chain(items, [C.Stage("same", 1, lambda df: df)])
    assert alone.rejects is None and alone.items.count() == 4
    assert C.run_chain(items.limit(0), stages[1:3]).rejects.count() == 0
    with pytest.raises(ValueError):
        C.run_chain(items, [stages[1], stages[1]])


def test_crawl_run_with_a_stage_of_ones_own(spark):
    from inkwell.plans.chain import reject_where

    out = crawl(spark, stages=[reject_where("travel", 300, [(F.col("category") == "Travel", "not wanted")])])
    plain = crawl(spark)
    assert {(r["stage"], r["reason"]) for r in out.rejected.filter(F.col("link") == f"{SITE}/ferry").collect()} == {("travel", "not wanted")}
    before = {r["source"]: r.asDict() for r in plain.counts.collect()}
    after = {r["source"]: r.asDict() for r in out.counts.collect()}
    dawn = before["dawn_latest"]
    assert after["dawn_latest"] == {**dawn, "accepted": dawn["accepted"] - 1, "rejected": dawn["rejected"] + 1}
    assert after["tribune_latest"] == before["tribune_latest"]
