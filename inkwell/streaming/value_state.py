"""ST-1 with ``transformWithState``: values in RocksDB, event-time timers, an initial state.

The state of a key is one number, the time of its last accept.  Each call into Python and each access to state
has a fixed cost, so keys are dealt into buckets as in ``ttl`` and one value holds a bucket's marks.  RocksDB keeps it
outside the JVM's heap and checkpoints what changed.  Marks that the watermark has passed by the TTL are dropped
whenever rows reach their bucket and when its timer fires, which is set to the end of the newest mark, so the state
follows the keys of the last TTL.  A stream can start from the marks that batch runs have left (``initial``).

Late rows are kept: the watermark moves the timers, but its column does not reach the stateful
step, so Spark drops nothing.  A row that can no longer be judged comes out with a ``reason``
(NULL for accepted rows; suppressed rows do not come out):

* ``before the last accept of its key``: an earlier micro-batch has accepted a later row;
* ``behind the kept marks``: the row is behind the watermark, and the key has no mark that is
  alive there, so it cannot be told whether an expired one would have suppressed it.

A row without a time is accepted and leaves the state alone; NULL keys are one key.  The rows that a
bucket has in one micro-batch meet in one call: bound micro-batches with ``maxFilesPerTrigger`` when a
key can be hot, or use ``ttl.ttl_microbatch_sink``, which splits such keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from inkwell.streaming.ttl import BUCKETS, MARKS, US, accept_rows, bucketed, output_schema, restored, stateful_rows

BEFORE, BEHIND = "before the last accept of its key", "behind the kept marks"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which value state needs."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


class Throttle(StatefulProcessor):
    """Accepts a row if no row of its key was accepted within the TTL before it."""

    def __init__(self, in_cols: list[str], out_cols: list[str], ttl_us: int):
        self.in_cols, self.out_cols, self.ttl_us = in_cols, out_cols, ttl_us

    def init(self, handle) -> None:
        self.handle = handle
        self.marks = handle.getValueState("marks", MARKS)

    def _stored(self) -> dict[str, int] | None:
        value = self.marks.get()
        return None if value is None else dict(zip(value[0], value[1]))

    def _store(self, marks: dict[str, int], known: bool) -> None:
        self.marks.update((list(marks), list(marks.values())))
        if not known:  # a timer that finds marks alive sets itself again
            self._set_timer(marks)

    def _set_timer(self, marks: dict[str, int]) -> None:
        self.handle.registerTimer(-(-(max(marks.values()) + self.ttl_us) // 1000))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        stored = self._stored()
        given = dict(zip(initialState.iloc[:, -2].tolist(), initialState.iloc[:, -1].astype("int64").tolist()))
        self._store({**(stored or {}), **given}, stored is not None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = [f for f in rows if len(f)]
        if not frames:  # a bucket of the initial state only
            return
        batch = pd.concat(frames, ignore_index=True).set_axis(self.in_cols, axis=1)  # computed columns come without their names
        stored, behind = self._stored(), timerValues.getCurrentWatermarkInMs() * 1000
        alive = {k: t for k, t in (stored or {}).items() if t + self.ttl_us > behind}
        timed = batch["_timed"].to_numpy(dtype=bool)
        marks = [alive.get(k) for k in batch["_key"].tolist()]
        late = timed & (batch["_t"].to_numpy(dtype=np.int64) < np.array([behind if m is None else m for m in marks], dtype=np.int64))
        reason = np.full(len(batch), None, dtype=object)
        reason[late] = [BEHIND if marks[i] is None else BEFORE for i in np.flatnonzero(late)]
        take = late | ~timed
        last = dict(alive)
        take[accept_rows(batch, timed & ~late, last, self.ttl_us)] = True
        if last != (stored or {}):
            self._store(last, stored is not None)
        if take.any():
            out = batch[self.out_cols].copy()
            out["reason"] = reason
            yield out[take]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        behind = timerValues.getCurrentWatermarkInMs() * 1000
        stored = self._stored() or {}
        alive = {k: t for k, t in stored.items() if t + self.ttl_us > behind}
        if not alive:
            self.marks.clear()
        else:
            if len(alive) < len(stored):
                self._store(alive, True)
            self._set_timer(alive)
        return iter([])

    def close(self) -> None:
        pass


def ttl_throttle_state(stream: DataFrame, keys: list[str], ts_col: str, ttl_seconds: int = 86400, tiebreak: str | None = None,
                       watermark: str = "1 hour", initial: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Accepted and late rows of a streaming DataFrame (append mode), with ``reason``; start the query inside ``rocksdb_state``.

    ``initial``: a batch table (``keys``, ``last_accept_at``) that the first micro-batch starts from.  ``buckets``: as in
    ``ttl.ttl_throttle_stream``.
    """
    timed = stream.withColumn("_ts", F.col(ts_col).cast("timestamp")).withWatermark("_ts", watermark)
    ev, out_cols = stateful_rows(timed, keys, ts_col, tiebreak, buckets, no_tie=0)
    ev = ev.drop("_ts")
    marks = None
    if initial is not None:
        ended = initial.withColumn("_t", F.unix_micros(F.col("last_accept_at").cast("timestamp"))).filter("_t is not null")
        typed = ended.select(*[F.col(k).cast(stream.schema[k].dataType) for k in keys], "_t")
        marks = bucketed(typed, keys, buckets).groupBy("_bucket", "_key").agg(F.max("_t").alias("_t")).groupBy("_bucket")
    out = ev.groupBy("_bucket").transformWithStateInPandas(
        Throttle(ev.columns, out_cols, ttl_seconds * US), output_schema(ev, out_cols) + ", reason string", "Append", "EventTime", initialState=marks)
    return restored(out, timed, ts_col)
