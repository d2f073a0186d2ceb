"""File sinks (SNK-1, SNK-2, SNK-3, SNK-5, SNK-7, SNK-8).

Writes are Spark writer jobs (every task writes its own files); the only
driver-side file work is deleting emptied partitions (D-9).  The files of a read
manifest are moved by tasks (SNK-7, ``sinks.archive``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters Spark escapes in partition directory names.
_ESCAPED = set('"#%\'*/:=?\\\x7f{[]^')


def escape_partition_value(v: str) -> str:
    return "".join(f"%{ord(c):02X}" if (c in _ESCAPED or ord(c) < 0x20) else c for c in v)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def export_articles(df: DataFrame, out_dir: str, run_date: str, run_sources: list[str] | None = None,
                    per_run: str | None = None) -> None:
    """SNK-1: items by (spider_name, export_date); the run replaces its days.

    Dynamic partition overwrite replaces exactly the (spider, day) partitions
    the run writes.  A source that ran but produced no item would keep its
    old file under dynamic overwrite; the reference writes ``[]`` and so
    empties the day (D-9), which is reproduced by deleting those partitions
    (``run_sources`` lists the sources of the run).

    SNK-2 (``per_run`` = run timestamp): every run is appended under its own
    ``run_ts`` partition and never overwritten.
    """
    spark = df.sparkSession
    if per_run is not None:
        df.withColumn("run_ts", F.lit(per_run)).write.mode("append").partitionBy("spider_name", "run_ts").json(out_dir)
        return
    out = df.withColumn("export_date", F.lit(run_date))
    if run_sources:
        from inkwell.session import checkpoint_root

        checkpoint_root(spark)
        out = out.checkpoint(eager=True)  # read for its sources and for the write
        present = {r[0] for r in out.select("spider_name").distinct().collect()}  # bounded by #sources
        for s in run_sources:
            if s not in present:
                delete_path(spark, f"{out_dir}/spider_name={escape_partition_value(s)}/export_date={run_date}")
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("spider_name", "export_date").json(out_dir))


def write_arrays(files: DataFrame, out_dir: str, col: str = "items") -> None:
    """Array landing files: one file (``*.txt``) per row, holding its JSON items as one array."""
    body = F.concat(F.lit("["), F.array_join(col, ", "), F.lit("]"))
    files.select(body.alias("value")).write.mode("overwrite").option("maxRecordsPerFile", 1).text(out_dir)


def write_stats(stats: DataFrame, out_dir: str) -> None:
    """SNK-5: one record per (source, date); rewriting a day replaces it."""
    (stats.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("source", "date").json(out_dir))


def append_table(rows: DataFrame, table_dir: str) -> None:
    """SNK-3: append every row as one write job (all-or-nothing commit)."""
    rows.write.mode("append").parquet(table_dir)


def create_news(spark: SparkSession, path: str, append_variant: bool = False) -> None:
    """SNK-8: idempotent table creation (an empty snapshot with the schema)."""
    from inkwell.schemas import NEWS, NEWS_APPEND

    fs, p, _ = _fs(spark, path)
    if fs.exists(p):
        return
    spark.createDataFrame([], NEWS_APPEND if append_variant else NEWS).write.parquet(path)


def archive_files(spark: SparkSession, manifest: DataFrame, landing_dir: str, dest_dir: str,
                  file_col: str = "source_file") -> list[str]:
    """SNK-7 for callers that want the moved paths: ``sinks.archive.archive`` and a sorted list.

    Exactly the files listed in ``manifest`` (those that were read) move; a file that landed after
    the read stays.  The path below ``landing_dir`` is kept, so partition values stay readable and
    files of one name in several partitions stay apart.  A file that cannot be moved raises.
    """
    from inkwell.sinks.archive import archive

    return sorted(r[0] for r in archive(spark, manifest, landing_dir, dest_dir, file_col).select("path").collect())
