"""Exact dedup: 128-bit content hash, byte comparison inside each hash group.

Rows are grouped by (128-bit hash, normalised text): the hash decides the
partition and the hash-table slot, and the text as part of the grouping key is
the byte comparison that keeps colliding texts apart.  Both groupings are
partial aggregates, so a text that fills a third of the table leaves one row
per map task before the shuffle.

Defined cases: a null text equals the empty text; a null id loses against any
other id; of rows that repeat both id and text exactly one is kept; texts of any length
are compared whole; an empty table gives an empty result; other columns, whatever their names, pass through
``exact_dedup`` untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import every, hash128, lower_ascii, text_or_empty


def _hashed(docs: DataFrame, id_col: str, text_col: str, *extra) -> DataFrame:
    norm = docs.select(F.col(id_col).alias("_id"), lower_ascii(text_or_empty(text_col)).alias("_norm"), *extra)
    h1, h2 = hash128(F.col("_norm"))
    return norm.withColumn("_h1", h1).withColumn("_h2", h2)


def dedup_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    keep: str = "smallest") -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``keep`` is ``smallest`` or ``largest`` id.  The text is shuffled once, as a
    grouping key; rows then meet their class over narrow columns, where AQE
    splits the partition of a hot class.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    hashed = _hashed(docs, id_col, text_col)
    classes = (
        hashed.groupBy("_h1", "_h2", "_norm")
        .agg(pick("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("_h1", "_h2", F.sha2(F.col("_norm"), 256).alias("text_sha256"), "keep_id", "group_size")
    )
    rows = (
        hashed.select("_id", "_h1", "_h2", F.sha2(F.col("_norm"), 256).alias("text_sha256"))
        .groupBy("_id", "_h1", "_h2", "text_sha256").agg(F.count(F.lit(1)).alias("_m"))
    )
    return (
        rows.join(classes, ["_h1", "_h2", "text_sha256"])
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_m"))).alias("_copy"))
        .select(
            F.col("_id").alias(id_col), "keep_id", F.col("group_size").cast("long").alias("group_size"),
            (F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"), "text_sha256",
        )
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "smallest") -> DataFrame:
    """The rows that stay, one per distinct normalised text, with all their columns."""
    pick = {"smallest": F.min_by, "largest": F.max_by}[keep]
    row = F.struct(*every(docs)).alias("_row")
    hashed = _hashed(docs, id_col, text_col, row)
    # A null id must lose: it sorts last for the smallest and first for the largest.
    present = F.col("_id").isNotNull()
    order = F.struct(~present if keep == "smallest" else present, F.col("_id"), F.xxhash64(F.to_json("_row")))
    return hashed.groupBy("_h1", "_h2", "_norm").agg(pick("_row", order).alias("_row")).select("_row.*")
