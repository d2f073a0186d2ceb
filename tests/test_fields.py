"""P-1..P-5, P-10..P-13, P-17, F-1, F-3, F-4, V-1, V-3, P-14, P-15: item fields and validation."""

import datetime as dt

from pyspark.sql import functions as F


from inkwell.functions import dates as D
from inkwell.functions import urls as U
from inkwell.operators import extract as X
from inkwell.operators import quality as V


def col_values(spark, fn, values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


# ------------------------------------------------------------------ dates
def test_publish_ts_spellings(spark):
    raw = [
        "Tue, 03 Jun 2025 14:30:00 +0000",   # 14
        "Tue, 03 Jun 2025 16:00:00 +0500",   # 15
        "2023-10-27T08:30:00+05:00",         # 16
        "2024-01-15T12:00:00Z",              # 17
        "Wed, 05 Jun 2024 10:20:30 +0000",   # 18
        "Thu, 06 Jun 2024 15:45:10 GMT",     # 19
        "2025-06-03 07:26:44+05:00",         # 20
        "2025-06-03 07:26:44",
        "January 05, 2025",                  # 21
        "garbage", None,
    ]
    got = col_values(spark, lambda c: D.ts_string(D.publish_ts(c)), raw)
    assert got == [
        "2025-06-03 14:30:00", "2025-06-03 11:00:00", "2023-10-27 03:30:00", "2024-01-15 12:00:00",
        "2024-06-05 10:20:30", "2024-06-06 15:45:10", "2025-06-03 02:26:44", "2025-06-03 07:26:44",
        None, None, None,
    ]
    ext = col_values(spark, lambda c: D.ts_string(D.publish_ts(c, extended=True)), ["January 05, 2025"])
    assert ext == ["2025-01-05 00:00:00"]


def test_dates_against_python_readers(spark):
    """Spellings that the feed parser or ``fromisoformat`` reads, and strings that name no date."""
    from email.utils import parsedate_to_datetime

    utc = dt.timezone.utc
    iso = ["2025-06-03", "20250603", "2025-06-03T10", "2025-06-03T10:00", "2025-06-03 10:00:01", "20250603T100000Z", "20250603T1000+0500",
           "2025-06-03T10:00:00,123+00:00", "2025-06-03T10:00:00.123456789", "2025-06-03T10+05:00", "2025-06-03T10:00:00.1-03:30",
           "2025-W23-2", "2025W232T10:00", "2020-W53-7", "2025-W23", "2024-02-29T23:59:59+23:59", "2025-06-03T10:00:00+05:30:15"]
    mail = ["Tue, 03 Jun 2025 14:30 +0000", "Tue, 03 Jun 25 14:30:00 GMT", "Tue, 3 Jun 2025 14:30:00 -0330", "03 Jun 2025 14:30:00 EST",
            "Tue, 03 Jun 2025 14:30:00 +0500 (PKT)", "Tue, 03 Jun 2025 14:30:00 UT"]

    def instant(t):
        t = t if t.tzinfo else t.replace(tzinfo=utc)
        return t.astimezone(utc).replace(tzinfo=None)

    want = [instant(dt.datetime.fromisoformat(s)) for s in iso] + [instant(parsedate_to_datetime(s)) for s in mail]
    rest = {"Tue Jun  3 14:30:00 2025": dt.datetime(2025, 6, 3, 14, 30), "Tue Jun 3 14:30:00 PDT 2025": dt.datetime(2025, 6, 3, 21, 30),
            "Tuesday, 03-Jun-25 14:30:00 PKT": dt.datetime(2025, 6, 3, 9, 30), "3 June 95": dt.datetime(1995, 6, 3),
            " 2025-06-03T10:00:00z\n": dt.datetime(2025, 6, 3, 10)}
    bad = ["2025-02-30", "2025-13-01", "2025-06-03T24:00", "2025-06-03T10:60", "2025-W54-1", "2021-W53-1", "0000-01-01", "32 Jun 2025", "3 Jux 2025",
           "3 June 2025 25:00", "2025-06-03T10:00:00+24:00", "2025-0603", "3 Junuary 2025", "2025", "", "x", None]
    got = col_values(spark, lambda c: D.publish_ts(c).cast("timestamp_ntz"), iso + mail + list(rest) + bad)
    assert got == want + list(rest.values()) + [None] * len(bad)
    days = col_values(spark, D.literal_day, ["20250603T000000+0500", "3 Jun 25", "Tue Jun  3 14:30:00 2025", "2025-W23-2"])
    assert days == [dt.date(2025, 6, 3)] * 4


def test_unparsed_flag_keeps_row(spark):
    df = spark.createDataFrame([("January 05, 2025",), ("2024-01-15T12:00:00Z",), (None,)], "v string")
    flags = [r[0] for r in df.select(D.date_unparsed(F.col("v"), D.publish_ts(F.col("v")))).collect()]
    assert flags == [True, False, False]


def test_literal_day(spark):
    # 22: the day written in the literal, not the UTC day
    got = col_values(spark, D.literal_day, ["2025-06-03T02:00:00+05:00", "Tue, 03 Jun 2025 16:00:00 +0500",
                                            "January 05, 2025", "nonsense"])
    assert got == [dt.date(2025, 6, 3), dt.date(2025, 6, 3), dt.date(2025, 1, 5), None]


def test_iso_string_matches_python(spark):
    got = col_values(spark, D.iso_string, [dt.datetime(2025, 6, 3, 7, 15, 27, 308000), dt.datetime(2025, 6, 3)],
                     "v timestamp_ntz")
    assert got == ["2025-06-03T07:15:27.308000", "2025-06-03T00:00:00"]


# ------------------------------------------------------------------- urls
def test_absolutise(spark):
    # 23
    df = spark.createDataFrame([("/story/1", "https://tribune.com.pk"), ("http://x/1", "https://tribune.com.pk"),
                                ("/story/2", None), (None, "https://b")], "l string, b string")
    got = [r[0] for r in df.select(U.absolutise(F.col("l"), F.col("b"))).collect()]
    assert got == ["https://tribune.com.pk/story/1", "http://x/1", "/story/2", None]


def test_has_link(spark):
    # 24
    assert col_values(spark, U.has_link, [None, "", "x"]) == [False, False, True]


def test_in_domain(spark):
    # 33
    hosts = col_values(spark, U.host, ["https://images.dawn.com/a", "https://www.dawn.com/", "https://notdawn.com/"])
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    got = [r[0] for r in df.select(U.in_domain(F.col("h"), F.array(F.lit("dawn.com")))).collect()]
    assert got == [True, True, False]


def test_canonical_url(spark):
    got = col_values(spark, U.canonical_url, ["HTTP://WWW.Ex.com/a/b?z=1&a=2#top", "https://x.com", "not a url",
                                              "https://x.com/p?b=2&a=1&a=0"])
    assert got == ["http://www.ex.com/a/b?a=2&z=1", "https://x.com/", None, "https://x.com/p?a=0&a=1&b=2"]


def test_hosts_do_not_depend_on_a_strict_parser(spark):
    from urllib.parse import urlsplit

    odd = ["https://dawn.com/a|b", "https://images_x.dawn.com/a b", "https://dawn.com/[1]", "https://dawn.com/%zz", "http://u:p@Dawn.com:80",
           "https://dawn.com", "https://dawn.com?x=//y.com/", "https://dawn.com#//y.com", "//dawn.com/a", "/a//b.com", "mailto:a@b.com", "", None,
           "https://[::1]:80/x", "https:///x", "https://é.com/", " \thttps://da\nwn.com/ "]
    want = [urlsplit(u.strip(" \t\n")).hostname if u is not None else None for u in odd]
    want[13] = "[::1]"
    assert col_values(spark, U.host, odd) == want


def test_canonical_form_escapes_unsafe_bytes(spark):
    got = col_values(spark, U.canonical_url, [
        "https://x.com/a|b c[1]", "https://x.com/%zz%4a%2f%e9%", "https://x.com/é日?ü=1 2&b=%20", "HTTPS://x.com:/", "https://x.com/\U0001f600",
        "  https://x.com/a\tb\n", "https://x.com/?&&b&a=2&a=1", "ftp:x", "https://x.com/a%20b#c d", "https://x.com/~!$&'()*+,;=:@-._"])
    assert got == ["https://x.com/a%7Cb%20c%5B1%5D", "https://x.com/%25zzJ%2F%E9%25", "https://x.com/%C3%A9%E6%97%A5?%C3%BC=1+2&b=+",
                   "https://x.com/", "https://x.com/%F0%9F%98%80", "https://x.com/ab", "https://x.com/?a=1&a=2&b", None,
                   "https://x.com/a%20b", "https://x.com/~!$&'()*+,;=:@-._"]
    again = col_values(spark, U.canonical_url, [g for g in got if g])
    assert again == [g for g in got if g]  # the canonical form is its own


# ---------------------------------------------------------- entry fields
def test_author_detail_wins_even_without_name(spark):
    # P-2, case 13
    df = spark.createDataFrame(
        [(" X ", {"name": " Feed Author Name "}), ("X", {"name": None}), (" Plain ", None), (None, None)],
        "author string, author_detail struct<name:string>")
    got = [r[0] for r in df.select(X.entry_author(F.col("author"), F.col("author_detail"))).collect()]
    assert got == ["Feed Author Name", None, "Plain", None]


def test_category_first_term(spark):
    df = spark.createDataFrame([([{"term": " Feed Category "}, {"term": "b"}],), ([],), (None,), ([{"term": ""}],)],
                               "tags array<struct<term:string>>")
    got = [r[0] for r in df.select(X.entry_category(F.col("tags"))).collect()]
    assert got == ["Feed Category", None, None, ""]


def test_entry_html_choice(spark):
    df = spark.createDataFrame(
        [([{"type": "text/html", "value": "<p>c</p>"}], "<p>s</p>"), ([{"type": "t", "value": ""}], "<p>s</p>"),
         (None, ""), (None, None)],
        "content array<struct<type:string,value:string>>, summary string")
    got = [r[0] for r in df.select(X.entry_html(F.col("content"), F.col("summary"))).collect()]
    assert got == ["<p>c</p>", "<p>s</p>", None, None]


# -------------------------------------------------------------- validation
ITEM = "heading string, content string, author string, category string, date string, url string, source string"


def test_validation_cases(spark):
    rows = [
        ("Valid Title", "Valid content", "Author", "Cat", "2025-06-03", "http://example.com/1", "s"),  # 1
        (None, "Some content", None, None, None, "http://example.com/2", "s"),                       # 2
        ("Title", None, None, None, None, "http://example.com/3", "s"),                               # 3
        ("  Spaced Title  ", "  Spaced content  ", "  Spaced Author  ", "  Spaced Cat  ", "  2025-06-03  ",
         "  http://example.com/4  ", "s"),                                                             # 4
        ("Title5", "Content5", None, "", None, "http://example.com/5", "s"),                          # 5
        (None, None, None, None, None, "http://example.com/6", "s"),                                  # 6
        ("   ", "c", None, None, None, "http://example.com/7", "s"),                                  # 7 (D-1)
        ("h", "c", None, None, None, None, "s"),
    ]
    df = spark.createDataFrame(rows, ITEM)
    acc, rej = V.validate(df, "2025-06-03 07:15:27.308", spider_col=F.lit("dawn_latest"))
    a = {r["url"]: r for r in acc.collect()}
    assert set(a) == {"http://example.com/1", "  http://example.com/4  ", "http://example.com/5", "http://example.com/7"}
    r1 = a["http://example.com/1"]
    assert r1["spider_name"] == "dawn_latest" and r1["processed_at"] == "2025-06-03T07:15:27.308000"
    r4 = a["  http://example.com/4  "]
    assert (r4["heading"], r4["content"], r4["author"], r4["category"], r4["date"]) == (
        "Spaced Title", "Spaced content", "Spaced Author", "Spaced Cat", "2025-06-03")
    assert a["http://example.com/5"]["author"] is None and a["http://example.com/5"]["category"] == ""
    assert a["http://example.com/7"]["heading"] == ""
    reasons = {r["url"]: r["reason"] for r in rej.collect()}
    assert reasons == {
        "http://example.com/2": "Missing heading in http://example.com/2",
        "http://example.com/3": "Missing content in http://example.com/3",
        "http://example.com/6": "Missing heading in http://example.com/6",
        None: "Missing url in None",
    }
    assert acc.count() + rej.count() == df.count()
    strict_acc, _ = V.validate(df, "2025-06-03 00:00:00", strict=True)
    assert "http://example.com/7" not in {r["url"] for r in strict_acc.collect()}


def test_violations(spark):
    df = spark.createDataFrame([("a", "u1"), (None, "u2"), ("b", "u1"), ("c", None), ("d", None)],
                               "heading string, url string")
    got = sorted((r["kind"], r["url"], r["n"]) for r in V.violations(df).collect())
    assert got == [("heading_null", "u2", 1), ("url_duplicate", "u1", 2)]
