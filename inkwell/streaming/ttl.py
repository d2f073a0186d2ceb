"""ST-1: the seen-URL throttle as Structured Streaming keyed state.

``groupBy(bucket).applyInPandasWithState``: a call in Python costs the same for one key as for
thousands, so keys are dealt by their hash into a fixed number of buckets, and the state of a bucket
holds one number per key (the last accepted event time).  It stays O(1) per key however hot the
key is.  Within a micro-batch a bucket's rows are scanned once in the order (time, tie-break), each against its
key's last accept.  Marks that the watermark has passed by the TTL are dropped whenever rows reach their bucket, and a
bucket none of whose marks can suppress a row any more is evicted by an event-time timeout, so
state size follows the number of keys seen in the last ``ttl``, not the stream's
history.  Rows behind the watermark are dropped by Spark before the state function (late data); use
the micro-batch sink below where they must be kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

US = 1_000_000
BUCKETS = 1024
MARKS = "keys array<string>, last array<bigint>"  # the state of a bucket
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def key_text(rows: DataFrame, keys: list[str]) -> Column:
    """A text per key: equal for keys that ``groupBy`` puts together, NULL included, and for no others."""
    def part(name):
        kind, c = rows.schema[name].dataType, F.col(name)
        if isinstance(kind, T.BinaryType):
            s = F.hex(c)
        elif isinstance(kind, T.TimestampType):
            s = F.unix_micros(c).cast("string")
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            s = F.when(c == 0, F.lit("0")).otherwise(c.cast("string"))
        elif isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
            s = F.to_json(F.struct(c), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
        else:
            s = c.cast("string")
        return F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.concat(F.lit(""), *[part(k) for k in keys])


def bucketed(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """``rows`` with ``_key`` and the ``_bucket`` it is in."""
    return rows.withColumn("_key", key_text(rows, keys)).withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("int"))


def stateful_rows(timed: DataFrame, keys: list[str], ts_col: str, tiebreak: str | None, buckets: int,
                  no_tie: int) -> tuple[DataFrame, list[str]]:
    """What the state function reads of rows that have their time in ``_ts``, and the columns that it gives back.

    ``no_tie`` stands for a tie-break that is NULL.  Whole numbers travel as text: a NULL among them would make a pandas column floating point.
    """
    tie = F.coalesce(F.col(tiebreak).cast("long"), F.lit(no_tie)) if tiebreak else F.lit(0).cast("long")
    carried = [*keys, *[c for c in timed.columns if c not in keys and c not in (ts_col, "_ts")]]
    ev = bucketed(timed, keys, buckets)
    ev = ev.select("_bucket", "_key", "_ts", F.coalesce(F.unix_micros("_ts"), F.lit(0)).alias("_t"), F.col("_ts").isNotNull().alias("_timed"),
                   tie.alias("_tie"), *[F.col(c).cast("string") if isinstance(timed.schema[c].dataType, _WHOLE) else F.col(c) for c in carried])
    return ev, [*carried, "_t", "_timed"]


def output_schema(ev: DataFrame, out_cols: list[str]) -> str:
    return ", ".join(f"`{c}` {ev.schema[c].dataType.simpleString()}" for c in out_cols)


def restored(out: DataFrame, timed: DataFrame, ts_col: str) -> DataFrame:
    """The given-back rows with the types and the time column of the input."""
    kept = [F.col(c).cast(timed.schema[c].dataType) if c in timed.columns else F.col(c) for c in out.columns if c not in ("_t", "_timed")]
    return out.select(*kept, F.when(F.col("_timed"), F.timestamp_micros("_t")).alias(ts_col))


def accept_rows(batch: pd.DataFrame, usable: np.ndarray, last: dict[str, int], ttl_us: int) -> list[int]:
    """Places of the ``usable`` rows that are at least the TTL after their key's last accept; moves ``last``."""
    t = batch["_t"].to_numpy(dtype=np.int64)
    order = np.lexsort((batch["_tie"].to_numpy(dtype=np.int64), t))
    order = order[usable[order]]
    picked = []
    for i, k, at in zip(order.tolist(), batch["_key"].to_numpy()[order].tolist(), t[order].tolist()):
        mark = last.get(k)
        if mark is None or at >= mark + ttl_us:
            picked.append(i)
            last[k] = at
    return picked


def _make_fn(out_cols: list[str], ttl_us: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        frames = [f for f in pdfs if len(f)]
        if not frames:
            return
        batch = pd.concat(frames, ignore_index=True)
        behind = state.getCurrentWatermarkMs() * 1000
        last = dict(zip(*state.get)) if state.exists else {}
        last = {k: t for k, t in last.items() if t + ttl_us > behind}
        timed = batch["_timed"].to_numpy(dtype=bool)
        take = ~timed  # a row without a time is accepted and leaves the state alone
        take[accept_rows(batch, timed, last, ttl_us)] = True
        if last:
            state.update((list(last), list(last.values())))
            state.setTimeoutTimestamp((max(last.values()) + ttl_us) // 1000)
        elif state.exists:
            state.remove()
        if take.any():
            yield batch.loc[take, out_cols]

    return fn


def ttl_throttle_stream(stream: DataFrame, keys: list[str], ts_col: str, ttl_seconds: int = 86400,
                        tiebreak: str | None = None, watermark: str = "1 hour", buckets: int = BUCKETS) -> DataFrame:
    """Accepted rows of a streaming DataFrame (append mode), same rule as the batch throttle.

    ``buckets`` bounds the calls of a micro-batch and may grow with the number of live keys; a checkpoint keeps
    the number that it began with.
    """
    timed = stream.withColumn("_ts", F.col(ts_col).cast("timestamp")).withWatermark("_ts", watermark)
    ev, out_cols = stateful_rows(timed, keys, ts_col, tiebreak, buckets, no_tie=2**63 - 1)
    out = ev.groupBy("_bucket").applyInPandasWithState(
        _make_fn(out_cols, ttl_seconds * US), output_schema(ev, out_cols), MARKS, "Append", GroupStateTimeout.EventTimeTimeout)
    return restored(out, timed, ts_col)


def ttl_microbatch_sink(state_root: str, out_root: str, keys: list[str], ts_col: str, ttl_seconds: int = 86400,
                        tiebreak: str | None = None, max_group: int | None = None, late_seconds: int = 3600,
                        late_root: str | None = None):
    """ST-1 as ``foreachBatch``: the batch throttle plus a seen-state table.

    Per micro-batch: candidates still inside the TTL of the stored
    ``last_accept_at`` are dropped (J-2), the rest go through the native
    batch throttle (W-3, hot-key safe), accepted rows are written under
    ``out_root/batch_id=<n>`` and the state advances (SNK-6), keeping only marks
    that can still suppress a later row.  Output and state are written per
    batch id, so a replayed batch rewrites the same files (exactly-once); state
    versions that no replay can need are deleted.

    A row is late when it is older than the stored mark of its key, or more than
    ``ttl + late_seconds`` behind the newest row of earlier batches (marks that far
    back are gone, so it cannot be judged).  Late rows go to ``late_root`` (by
    default ``<out_root>_late``) per batch id, with a reason.
    """
    from inkwell.operators import seen as S
    from inkwell.sinks.files import _fs
    from inkwell.streaming import sinks as SK

    kw = {} if max_group is None else {"max_group": max_group}
    late_root = late_root or out_root.rstrip("/") + "_late"

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read by the late test, the throttle and the horizon
        try:
            step(batch.sparkSession, batch, batch_id)
        finally:
            batch.unpersist()

    def step(spark, batch: DataFrame, batch_id: int) -> None:
        vs = [v for v in SK.versions(spark, state_root) if v < batch_id]
        state, horizon = None, None
        ts = F.col(ts_col).cast("timestamp")
        if vs:
            state = spark.read.parquet(f"{state_root}/v={vs[-1]}/marks")
            horizon = spark.read.parquet(f"{state_root}/v={vs[-1]}/horizon").first()[0]
            marks = state.withColumnsRenamed({k: f"_k_{k}" for k in keys})
            same = [batch[k].eqNullSafe(marks[f"_k_{k}"]) for k in keys]
            reason = F.when(ts < F.col("last_accept_at"), F.lit("before the last accept of its key"))
            if horizon is not None:
                reason = reason.when(ts <= F.lit(horizon) - F.make_dt_interval(secs=F.lit(ttl_seconds + late_seconds)),
                                     F.lit("behind the kept marks"))
            tagged = batch.join(marks, same, "left").withColumn("reason", reason).select(*batch.columns, "reason").persist()
            tagged.filter(F.col("reason").isNotNull()).write.mode("overwrite").parquet(f"{late_root}/batch_id={batch_id}")
            batch = tagged.filter(F.col("reason").isNull()).drop("reason")
            fresh = S.drop_recently_seen(batch, state, keys, ts_col, ttl_seconds)
        else:
            fresh = batch
        accepted = S.ttl_throttle(fresh, keys, ts_col, ttl_seconds, tiebreak, **kw).checkpoint(eager=True)
        accepted.write.mode("overwrite").parquet(f"{out_root}/batch_id={batch_id}")
        new_state = S.advance_seen(state, accepted.filter(ts.isNotNull()), keys, ts_col)
        newest = batch.agg(F.max(ts)).first()[0]
        newest = max((x for x in (newest, horizon) if x is not None), default=None)
        if newest is not None:
            cutoff = F.lit(newest) - F.make_dt_interval(secs=F.lit(ttl_seconds + late_seconds))
            new_state = new_state.filter(F.col("last_accept_at") > cutoff)
        version = f"{state_root}/v={batch_id}"
        new_state.write.mode("overwrite").parquet(f"{version}/marks")
        spark.createDataFrame([(newest,)], "horizon timestamp").coalesce(1).write.mode("overwrite").parquet(f"{version}/horizon")
        fs, path, _ = _fs(spark, f"{version}/_SUCCESS")  # both parts are there: the version counts
        fs.create(path, True).close()
        SK.drop_old_versions(spark, state_root)

    return run
