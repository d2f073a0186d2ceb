"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.session import apply_required_conf, checkpoint_root

# A word is a run of characters other than the ASCII white space bytes.
WORD_RE = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, as stored (no repartitioning, no filter)."""
    apply_required_conf(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def every(df: DataFrame, names: list[str] | None = None) -> list[Column]:
    """The columns of ``df`` (or those named), whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in (df.columns if names is None else names)]


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does that for pure ASCII text and is much
    faster than ``translate``, which is used for the rest."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD_RE)).cast("long")


def hash128(*cols: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of the columns under different seeds; nulls are marked,
    since ``xxhash64`` skips them."""
    marked = [x for c in cols for x in (F.isnull(c), c)]
    return F.xxhash64(*marked), F.xxhash64(F.lit(0x9E3779B9), *marked)
