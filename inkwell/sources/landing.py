"""Landing files (SRC-3, F-7, U-1).

Two layouts are read:

* ``array`` — each file is one JSON array of item objects (what the
  reference's exporter writes); read with ``multiLine`` so each element is a
  row and ``[]`` gives no rows;
* ``lines`` — JSON Lines, what ``inkwell.sinks.files.export_articles`` writes
  (splittable, written in parallel by every task).

Only ``*.json`` files are read (F-7) unless another ``glob`` is given.  A broken file fails the load
(``FAILFAST``), as it does in the reference; missing keys become NULL and
unknown keys are ignored because the schema is explicit.  Every row carries
the file it came from, so cleanup can touch exactly the files that were read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.schemas import ARTICLE


def read_landing(spark: SparkSession, path: str, layout: str = "array", schema: T.StructType = ARTICLE,
                 recursive: bool = False, glob: str = "*.json") -> DataFrame:
    reader = spark.read.schema(schema).option("pathGlobFilter", glob).option("mode", "FAILFAST")
    if layout == "array":
        reader = reader.option("multiLine", "true")
    elif layout != "lines":
        raise ValueError(f"unknown layout {layout!r}")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.json(path)
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def landing_manifest(landing: DataFrame) -> DataFrame:
    """Files actually read, with their row counts (the cleanup manifest)."""
    return landing.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))
