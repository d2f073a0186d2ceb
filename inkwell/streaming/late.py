"""ST-4 / ST-5 with a quarantine: late rows are set aside before the windowed counts.

A watermark makes the aggregate forget closed windows, and rows that come later vanish
there.  So a first stage knows the same watermark (the newest event time of earlier batches less the
delay): rows whose window has closed by then, and rows without a time, go to a quarantine with a
reason, the others to a staging folder.  The second stage counts the staged rows with Spark's own
watermark.  It reads them in the same order and is never ahead of the first, so its watermark closes no
window that the first stage still let rows into: counts and quarantine together hold every row.

Each stage can be replayed: a batch is staged under its number by one rename, and a number that is
already there is left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.session import checkpoint_root
from inkwell.streaming import sinks as SK

TIME = "_event_time"


def _publish(rows: DataFrame, root: str, batch_id: int) -> None:
    """Write a batch's rows as ``root/batch_id=n``, whole or not at all; a batch that is there stays."""
    fs, done = SK._fs(rows.sparkSession, f"{root}/batch_id={batch_id}")
    if fs.exists(done):
        return
    rows.write.mode("overwrite").parquet(f"{root}_staging/batch_id={batch_id}")
    _, staged = SK._fs(rows.sparkSession, f"{root}_staging/batch_id={batch_id}")
    fs.mkdirs(done.getParent())
    if not fs.rename(staged, done):
        raise OSError(f"cannot publish {done}")


def _horizon(spark: SparkSession, root: str, batch_id: int):
    vs = [v for v in SK.versions(spark, root) if v < batch_id]
    return spark.read.parquet(f"{root}/v={vs[-1]}").first()[0] if vs else None


def split_late_sink(root: str, ts_col: str, every: str, delay_seconds: int = 3600):
    """foreachBatch function of the first stage: ``root/on_time`` and ``root/late``, by batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        horizon = _horizon(spark, f"{root}/horizon", batch_id)
        ts = F.col(ts_col).cast("timestamp")
        reason = F.when(ts.isNull(), F.lit("no time"))
        timed = batch.filter(ts.isNotNull()).withColumn("_w", F.window(ts, every))
        rows = timed.withColumn("reason", F.lit(None).cast("string")).unionByName(
            batch.filter(ts.isNull()).withColumn("_w", F.lit(None).cast(timed.schema["_w"].dataType)).withColumn("reason", reason))
        if horizon is not None:
            closed = F.lit(horizon) - F.make_dt_interval(secs=F.lit(delay_seconds))
            rows = rows.withColumn("reason", F.when(F.col("_w.end") <= closed, F.lit("late")).otherwise(F.col("reason")))
        rows = rows.drop("_w").checkpoint(eager=True)  # read for both folders and for the horizon
        _publish(rows.filter(F.col("reason").isNull()).drop("reason"), f"{root}/on_time", batch_id)
        _publish(rows.filter(F.col("reason").isNotNull()), f"{root}/late", batch_id)
        newest = rows.agg(F.max(ts)).first()[0]
        newest = max((x for x in (newest, horizon) if x is not None), default=None)
        spark.createDataFrame([(newest,)], "horizon timestamp").coalesce(1).write.mode("overwrite").parquet(f"{root}/horizon/v={batch_id}")
        SK.drop_old_versions(spark, f"{root}/horizon")

    return run


def counted(stream: DataFrame, ts_col: str, every: str, by: list[str], aggs: list[tuple[str, Column]], fmt: str,
            delay_seconds: int = 3600) -> DataFrame:
    """Windowed aggregates of a stream: window_start (text), ``by``, the aggregates, and the window's day."""
    timed = stream.withColumn(TIME, F.col(ts_col).cast("timestamp")).withWatermark(TIME, f"{delay_seconds} seconds")
    agg = timed.groupBy(F.window(TIME, every).alias("w"), *by).agg(*[e.alias(a) for a, e in aggs])
    return agg.select(F.date_format("w.start", fmt).alias("window_start"), *by, *[a for a, _ in aggs],
                      F.date_format("w.start", "yyyy-MM-dd").alias("day"))


def run_windowed_counts(spark: SparkSession, source, root: str, ts_col: str, every: str, by: list[str],
                        aggs: list[tuple[str, Column]], fmt: str, delay_seconds: int = 3600) -> None:
    """Both stages until they have caught up.  ``source`` gives the streaming DataFrame.

    The counts lie in ``root/counts`` (one row per window and ``by``, partitioned by day), the rows set aside
    in ``root/late``; both read as tables.
    """
    checkpoint_root(spark)
    schema = source().schema
    first = split_late_sink(root, ts_col, every, delay_seconds)
    merge = SK.partitioned_merge_sink(f"{root}/counts", ["window_start", *by], "day")

    def split():
        return (source().writeStream.foreachBatch(first).option("checkpointLocation", f"{root}/ckpt_split")
                .trigger(availableNow=True).start())

    def count():
        staged = spark.readStream.schema(schema).parquet(f"{root}/on_time/batch_id=*")
        rows = counted(staged, ts_col, every, by, aggs, fmt, delay_seconds)
        return (rows.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", f"{root}/ckpt_count")
                .trigger(availableNow=True).start())

    SK.run_available(split)
    SK.run_available(count)
