"""Seen-URL state and the 24-hour throttle (F-2, J-2, SRC-4, SNK-6, W-3, F-6).

Semantics (reference): per (source, url) an occurrence is accepted iff no
*accepted* occurrence lies less than ``ttl`` before it; a suppressed hit does
not extend the window.  At exactly ``ttl`` the old mark has expired.

Null rules, the same on every path: an occurrence without a time is always
accepted and suppresses nothing; NULL key parts are equal to each other.

Two execution paths for the ordered throttle, which give the same answer:

* keys with a bounded number of occurrences (``max_group``) are folded in
  one ``aggregate`` over their time-sorted occurrences;
* keys above the bound are never gathered: every occurrence points to the first one
  at least ``ttl`` later, and the accepted ones are what the key's first occurrence
  reaches.  Pointers come from an as-of window per (key, ttl-wide time cell), so a
  hot key is spread over its cells; reachability comes from pointer doubling, about
  log2(time span / ttl) rounds, each cut by a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.session import checkpoint_root

US = 1_000_000
DEFAULT_MAX_GROUP = 100_000


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def drop_recently_seen(cand: DataFrame, seen: DataFrame, keys: list[str], ts_col: str,
                       ttl_seconds: int = 86400, seen_ts: str = "last_accept_at") -> DataFrame:
    """J-2: left anti join with a range condition.

    A candidate is dropped when the same key was accepted less than ``ttl``
    before it.  Equi-keys drive a shuffle (or AQE-chosen) join; AQE splits a
    skewed candidate side.
    """
    s = seen.select(*[F.col(k).alias(f"_s_{k}") for k in keys], _micros(F.col(seen_ts)).alias("_s_t"))
    cond = _same(cand, s, keys, "_s_")
    cond.append(_micros(cand[ts_col]) < s["_s_t"] + F.lit(ttl_seconds * US))
    out = cand.join(s, cond, "left_anti")
    return out


def advance_seen(seen: DataFrame | None, accepted: DataFrame, keys: list[str], ts_col: str,
                 seen_ts: str = "last_accept_at", expired: Column | None = None) -> DataFrame:
    """SNK-6: new state = latest accepted time per key (old state included).

    Marks at or before ``expired`` (the run time less the TTL) can suppress nothing any
    more and are left out, so the state follows the last TTL.  ``seen_state`` keeps the
    same marks as a stored table that a run only appends to.
    """
    new = accepted.select(*keys, F.col(ts_col).cast("timestamp").alias(seen_ts))
    if seen is not None:
        new = seen.select(*keys, F.col(seen_ts).cast("timestamp").alias(seen_ts)).unionByName(new)
    if expired is not None:
        new = new.filter(F.col(seen_ts) > expired)
    return new.groupBy(*keys).agg(F.max(seen_ts).alias(seen_ts))


def _same(a: DataFrame, b: DataFrame, keys: list[str], prefix: str = "_k_") -> list[Column]:
    """Null-safe equality of ``keys`` with the same columns of ``b`` under ``prefix``."""
    return [a[k].eqNullSafe(b[prefix + k]) for k in keys]


def _renamed(df: DataFrame, keys: list[str], prefix: str = "_k_") -> DataFrame:
    return df.withColumnsRenamed({k: prefix + k for k in keys})


def _fold_accepts(rows: Column, ttl_us: int) -> Column:
    """Ordered fold over one key's sorted (time, tie) pairs -> accepted ones."""
    init = F.struct(F.lit(None).cast("long").alias("last"), F.slice(rows, 1, 0).alias("acc"))

    def step(state, x):
        take = state["last"].isNull() | (x["_t"] >= state["last"] + F.lit(ttl_us))
        return F.when(take, F.struct(x["_t"].alias("last"), F.concat(state["acc"], F.array(x)).alias("acc"))).otherwise(state)

    return F.aggregate(F.array_sort(rows), init, step, lambda s: s["acc"])


def ttl_throttle(df: DataFrame, keys: list[str], ts_col: str, ttl_seconds: int = 86400,
                 tiebreak: str | None = None, max_group: int = DEFAULT_MAX_GROUP) -> DataFrame:
    """W-3: rows of ``df`` accepted by the per-key TTL throttle (columns kept).

    Occurrences of a key are ordered by (``ts_col``, ``tiebreak``); of rows equal in
    both, one counts.  The paths choose (key, time, tie-break) triples, and the rows
    are joined back to them once; AQE sizes the joins and splits hot keys.
    """
    cols = df.columns
    # Without a tie-break column, equal times are ordered by a hash of the row
    # so recomputation always accepts the same occurrence.
    tie = F.col(tiebreak) if tiebreak else F.xxhash64(*[F.col(c) for c in cols])
    rows = df.withColumns({"_t": _micros(F.col(ts_col)), "_tie": tie})
    timeless = rows.filter(F.col("_t").isNull())
    rows = rows.filter(F.col("_t").isNotNull())
    ev = rows.select(*keys, "_t", "_tie")
    ttl_us = ttl_seconds * US

    sizes = ev.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = _renamed(sizes.filter(F.col("_n") > max_group).select(*keys), keys)
    if hot.isEmpty():
        cold, swept = ev, None
    else:
        cold = ev.join(hot, _same(ev, hot, keys), "left_anti")
        swept = _doubling(ev.join(hot, _same(ev, hot, keys), "left_semi"), keys, ttl_us)
    folded = cold.groupBy(*keys).agg(_fold_accepts(F.collect_list(F.struct("_t", "_tie")), ttl_us).alias("_acc"))
    picked = folded.select(*keys, F.explode("_acc").alias("_r")).select(*keys, "_r.*")
    picked = picked if swept is None else picked.unionByName(swept)
    picked = picked.withColumnsRenamed({"_t": "_k__t", "_tie": "_k__tie"}).withColumnsRenamed({k: f"_k_{k}" for k in keys})
    out = rows.join(picked, _same(rows, picked, [*keys, "_t", "_tie"]), "left_semi")
    return out.dropDuplicates([*keys, "_t", "_tie"]).unionByName(timeless).select(*cols)


def _doubling(ev: DataFrame, keys: list[str], ttl_us: int) -> DataFrame:
    """Exact throttle for keys too large to gather: accepted (key, time, tie) triples."""
    checkpoint_root(ev.sparkSession)
    marked = [x for k in keys for x in (F.isnull(k), F.col(k))]
    ident = ev.withColumns({"_k1": F.xxhash64(*marked), "_k2": F.xxhash64(F.lit(1), *marked)})
    nodes = ident.groupBy("_k1", "_k2", *keys, "_t").agg(F.min("_tie").alias("_tie")).checkpoint(eager=True)
    key = ["_k1", "_k2"]
    cell = F.floor(F.col("at") / F.lit(ttl_us))
    # Each occurrence asks, one ttl later, for the next occurrence.
    asks = nodes.select(*key, (F.col("_t") + F.lit(ttl_us)).alias("at"), F.col("_t").alias("asker"), F.lit(None).cast("long").alias("node"))
    seen = nodes.select(*key, F.col("_t").alias("at"), F.lit(None).cast("long").alias("asker"), F.col("_t").alias("node"))
    rows = asks.unionByName(seen).withColumn("cell", cell)
    back = Window.partitionBy(*key, "cell").orderBy(F.col("at").desc(), F.col("node").isNull())
    upto = back.rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumn("nxt", F.last("node", ignorenulls=True).over(upto)).filter(F.col("asker").isNotNull())
    firsts = rows.groupBy(*key, "cell").agg(F.min("node").alias("first"))
    later = Window.partitionBy(*key).orderBy(F.col("cell").desc()).rowsBetween(Window.unboundedPreceding, -1)
    beyond = firsts.withColumn("beyond", F.last("first", ignorenulls=True).over(later)).drop("first")
    points = inside.join(beyond, [*key, "cell"]).select(*key, F.col("asker").alias("t"), F.coalesce("nxt", "beyond").alias("nxt")) \
        .filter(F.col("nxt").isNotNull())
    reached = nodes.groupBy(*key).agg(F.min("_t").alias("t")).checkpoint(eager=True)
    # Only first occurrences and occurrences that some pointer names can be reached.
    named = points.select(*key, F.col("nxt").alias("t")).unionByName(reached).distinct()
    jump = points.join(named, [*key, "t"], "left_semi").checkpoint(eager=True)
    while not jump.isEmpty():
        step = reached.join(jump, [*key, "t"]).select(*key, F.col("nxt").alias("t"))
        reached = reached.unionByName(step).distinct().checkpoint(eager=True)
        on = jump.select(*key, F.col("t").alias("nxt"), F.col("nxt").alias("far"))
        jump = jump.join(on, [*key, "nxt"]).select(*key, "t", F.col("far").alias("nxt")).checkpoint(eager=True)
    hit = reached.withColumnRenamed("t", "_t")
    return nodes.join(hit, [*key, "_t"], "left_semi").select(*keys, "_t", "_tie")


def dedupe_requests(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """F-6: one request per key, the earliest position wins (map-side combined)."""
    others = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in others]), F.col(position)).alias("_r"))
    return agg.select(*keys, "_r.*")
