"""Micro-batch sinks for the streaming flows (ST-1..ST-5).

* Versioned state snapshots ``v=<batchId>`` (the micro-batch throttle's seen
  state): a version is complete once its ``_SUCCESS`` marker exists and readers
  take the highest complete version; a replayed batch rewrites its own version.
* Upserts into the article table, each batch entered in the table's ledger.
* Partition-merge tables for update-mode aggregates: a batch rewrites only the
  partitions (days) it touches.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, root: str) -> list[int]:
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(st.getPath().suffix("/_SUCCESS")):
            out.append(int(name[2:]))
    return sorted(out)


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete all but the newest ``keep`` versions (a replay needs the one before)."""
    fs, p = _fs(spark, root)
    for v in versions(spark, root)[:-keep]:
        fs.delete(p.suffix(f"/v={v}"), True)


def run_available(query_builder: Callable[[], object]) -> None:
    """Start a streaming query with ``trigger(availableNow=True)`` and wait."""
    q = query_builder()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def partitioned_merge_sink(root: str, keys: list[str], part_col: str):
    """foreachBatch function for update-mode aggregates kept in a table
    partitioned by ``part_col`` (e.g. the day of the window).

    Only the partitions the batch touches are read, merged (batch rows replace
    their keys) and rewritten by dynamic partition overwrite, so a batch costs
    the size of its days, not of the whole history.  Update-mode rows carry the
    full current value of their key, so replaying a batch writes the same
    result again.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()  # the stateful aggregate runs once, not once per branch below
        try:
            merge(spark, batch)
        finally:
            batch.unpersist()

    def merge(spark: SparkSession, batch: DataFrame) -> None:
        touched = [r[0] for r in batch.select(part_col).distinct().collect()]  # bounded by days in a batch
        if not touched:
            return
        fs, p = _fs(spark, root)
        exists = fs.exists(p) and any(st.getPath().getName().startswith(part_col + "=") for st in fs.listStatus(p))
        rows = batch
        if exists:
            # Partition values come back type-inferred (a day string becomes a
            # DATE); cast to the batch's type before comparing and merging.
            current = spark.read.parquet(root)
            current = current.withColumn(part_col, F.col(part_col).cast(batch.schema[part_col].dataType))
            current = current.filter(F.col(part_col).isin(touched))
            kept = current.join(batch.select(*keys), keys, "left_anti")
            rows = kept.unionByName(batch.select(*current.columns))
        rows = rows.checkpoint(eager=True)  # the table is read above: never overwrite what is being read
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(part_col).parquet(root))

    return run


def upsert_sink(table_dir: str, run_ts: Callable[[DataFrame], object] | None = None, stream: str | None = None):
    """ST-3: foreachBatch function that upserts article items into the stored table.

    The batch is entered in the table's ledger under the query's own id, which its checkpoint
    keeps over restarts (or under ``stream``).  A replayed batch writes
    nothing, so the run time may be the clock; ``run_ts`` (rows -> time) replaces it.
    """
    from inkwell.operators import merge as M

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = stream or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not own:
            raise ValueError("outside a streaming query the stream needs a name")
        rows = M.to_load_rows(batch)
        now = run_ts(rows) if run_ts else None
        now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        M.upsert_into(spark, table_dir, rows, now, number=batch_id, stream=own)

    return run
