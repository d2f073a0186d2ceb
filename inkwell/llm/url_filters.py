"""URL filter lists with a history: validity intervals and an as-of join.

List entries are dated ``add`` / ``remove`` events for a pattern.  Consecutive
events of a pattern become [valid_from, valid_to) intervals; every capture is
evaluated against the intervals that hold its fetch time.  A capture looks up
its url, its host, each parent domain and its leading path prefixes, all by
equi-join on (kind, pattern, time cell); the time test is a residual.  Prefixes may
be of any depth; only the depths that occur among the list's entries are looked up.

Skew: intervals are cut into cells of ``cell_days`` and captures are salted, the
(much smaller) list side being repeated per salt, so a host with a third of all
captures is spread over cells x salts.  Event histories are linked in two levels
(inside a cell, then between cells), so no window holds a pattern's whole history.

Defined cases: a null url or fetch time matches nothing and is kept, not blocked;
events with a null date or pattern are ignored; of events of one pattern at one
instant ``remove`` wins; a pattern removed before it was added has no interval;
repeated captures each get their own result (they share one row key and one
answer); urls of any length are matched whole; an empty list blocks nothing, and no captures
give no rows.  Block lists lose against allow lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.common import hash128

CELL_DAYS = 30
SALTS = 8
_FAR = "9999-12-31 00:00:00"


def url_host(url: Column) -> Column:
    """Host in lower case, without user, port and final dot ('' if there is none)."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"\.?(:[0-9]*)?$", ""))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def prefix_depths(events: DataFrame) -> list[int]:
    """The depths (slashes) of the prefix entries; a list has no more than its longest entry has slashes."""
    slashes = F.length(F.regexp_replace("pattern", "[^/]", ""))
    rows = events.filter((F.col("kind") == "prefix") & F.col("pattern").isNotNull()).select(slashes.alias("_d")).distinct()
    return sorted(r["_d"] for r in rows.collect() if r["_d"] >= 1)


def lookup_keys(url: Column, depths: list[int] | None = None) -> Column:
    """(kind, pattern) of everything a list may name about a url; ``depths`` are those of
    its prefix entries (None: every depth)."""
    host, path = url_host(url), url_path(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    domains = F.when(n >= 2, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.struct(
        F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, n), ".").alias("pattern"))))
    segs = F.filter(F.split(path, "/"), lambda x: x != "")
    every = F.sequence(F.lit(1), F.size(segs)) if depths is None else F.filter(
        F.array(*[F.lit(d) for d in depths]).cast("array<int>"), lambda d: d <= F.size(segs))
    prefixes = F.when(F.size(segs) >= 1, F.transform(
        every,
        lambda i: F.struct(F.lit("prefix").alias("kind"),
                           F.concat(host, F.lit("/"), F.array_join(F.slice(segs, F.lit(1), i), "/")).alias("pattern"))))
    empty = F.array().cast("array<struct<kind:string,pattern:string>>")
    one = F.array(F.struct(F.lit("url").alias("kind"), url.alias("pattern")),
                  F.struct(F.lit("host").alias("kind"), host.alias("pattern")))
    return F.array_distinct(F.concat(one, F.coalesce(domains, empty), F.coalesce(prefixes, empty)))


def _cell(ts: Column, cell_days: int) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / (cell_days * 86_400_000_000))


def validity_intervals(events: DataFrame, cell_days: int = CELL_DAYS) -> DataFrame:
    """(list_name, list_type, kind, pattern, valid_from, valid_to) from dated events."""
    key = ["list_name", "list_type", "kind", "pattern"]
    ev = events.filter(F.col("effective_at").isNotNull() & F.col("pattern").isNotNull()) \
        .groupBy(*key, F.col("effective_at").cast("timestamp").alias("valid_from")) \
        .agg(F.max("action").alias("action")).withColumn("_cell", _cell(F.col("valid_from"), cell_days))
    firsts = ev.groupBy(*key, "_cell").agg(F.min("valid_from").alias("_first"))
    nxt = firsts.withColumn("_next", F.lead("_first").over(Window.partitionBy(*key).orderBy("_cell"))).drop("_first")
    inner = F.lead("valid_from").over(Window.partitionBy(*key, "_cell").orderBy("valid_from"))
    linked = ev.withColumn("_in", inner).alias("e").join(
        nxt.alias("n"), [F.col(f"e.{k}").eqNullSafe(F.col(f"n.{k}")) for k in [*key, "_cell"]])
    return linked.filter(F.col("e.action") == "add").select(
        *[F.col(f"e.{k}") for k in key], F.col("e.valid_from"),
        F.coalesce("e._in", "n._next", F.lit(_FAR).cast("timestamp")).alias("valid_to"))


def filter_captures(captures: DataFrame, events: DataFrame, id_col: str, url_col: str = "url",
                    time_col: str = "fetch_time", cell_days: int = CELL_DAYS, salts: int = SALTS) -> DataFrame:
    """One row per capture: id, url, fetch time, ``blocked``, ``lists`` (names of the
    active lists that match, sorted), ``n_matches`` (active entries), ``active_since``."""
    k1, k2 = hash128(F.col(id_col), F.col(url_col), F.col(time_col))
    cap = captures.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"),
                          F.col(time_col).cast("timestamp").alias("_t"), k1.alias("_k1"), k2.alias("_k2"))
    spans = validity_intervals(events, cell_days)
    low, high = cap.agg(F.min("_t"), F.max("_t")).first()
    lo, hi = F.lit(low).cast("timestamp"), F.lit(high).cast("timestamp")
    spans = spans.filter((F.col("valid_from") <= hi) & (F.col("valid_to") > lo)).withColumn("_cell", F.explode(F.sequence(
        _cell(F.greatest("valid_from", lo), cell_days), _cell(F.least("valid_to", hi), cell_days)))) \
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    probe = cap.filter(F.col("_url").isNotNull() & F.col("_t").isNotNull()).select(
        "_k1", "_k2", "_t", _cell(F.col("_t"), cell_days).alias("_cell"),
        F.pmod("_k2", F.lit(salts)).cast("int").alias("_salt"), F.explode(lookup_keys(F.col("_url"), prefix_depths(events))).alias("_key")) \
        .select("*", "_key.*").drop("_key").distinct()
    hits = probe.join(spans, ["kind", "pattern", "_cell", "_salt"]) \
        .filter((F.col("_t") >= F.col("valid_from")) & (F.col("_t") < F.col("valid_to")))
    verdict = hits.groupBy("_k1", "_k2").agg(
        F.array_join(F.array_sort(F.collect_set("list_name")), ",").alias("lists"),
        F.count(F.lit(1)).alias("n_matches"), F.max("valid_from").alias("active_since"),
        (F.bool_or(F.col("list_type") == "block") & ~F.bool_or(F.col("list_type") == "allow")).alias("blocked"))
    return cap.join(verdict, ["_k1", "_k2"], "left").select(
        F.col("_id").alias(id_col), F.col("_url").alias(url_col), F.col("_t").alias(time_col),
        F.coalesce("blocked", F.lit(False)).alias("blocked"), F.coalesce("lists", F.lit("")).alias("lists"),
        F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"), "active_since")
