"""Line dedup over overlapping three-line windows.

Every run of three consecutive lines is hashed to 128 bits.  Windows that occur
more than once anywhere (within a document too) keep their first occurrence, in
order of (id, row key, position); the lines covered by any later occurrence are
removed, overlapping occurrences being merged as a set of line positions.

The count per window is a partial aggregate, so a passage that a third of all
documents share is combined before the shuffle.  The repeated windows
are stored first and meet the occurrences in a join whose hot partitions AQE splits.

Defined cases: a null text counts as empty and stays null; texts of fewer than
three lines have no window and stay as they are; windows in which no line has a
word are not compared; rows that repeat both id and text share one row key and
get the same result, as one document; texts of any length are read whole, a row at a time;
empty tables give empty results; the other columns come back inside ``row``, so that no name can clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import checkpoint, every, hash128, text_or_empty

WINDOW = 3


def _keyed(docs: DataFrame, id_col: str, text_col: str, *extra) -> DataFrame:
    k1, k2 = hash128(F.col(id_col), F.col(text_col))
    return docs.select(*extra, F.col(id_col).alias("_id"), k1.alias("_k1"), k2.alias("_k2"),
                       F.split(text_or_empty(text_col), "\n", -1).alias("_lines"))


def window_occurrences(keyed: DataFrame, size: int = WINDOW) -> DataFrame:
    """(_id, _k1, _k2, _pos, _h1, _h2): one row per window that has a word."""
    lines = F.col("_lines")

    def window(i):
        parts = [F.get(lines, i + j) for j in range(size)]
        h1, h2 = hash128(*parts)
        blank = ~F.concat_ws("", *parts).rlike(r"[^\x20\x09-\x0D]")
        return F.struct(i.alias("_pos"), h1.alias("_h1"), h2.alias("_h2"), blank.alias("_blank"))

    wins = F.when(F.size(lines) >= size,
                  F.transform(F.sequence(F.lit(0), F.size(lines) - size), window))
    return (
        keyed.select("_id", "_k1", "_k2", F.explode(wins).alias("_w"))
        .select("_id", "_k1", "_k2", "_w.*").filter(~F.col("_blank")).drop("_blank")
    )


def covered_lines(keyed: DataFrame, size: int = WINDOW) -> DataFrame:
    """(_k1, _k2, _cov): line positions covered by later occurrences, per document."""
    occ = window_occurrences(keyed, size)
    at = F.struct("_id", "_k1", "_k2", "_pos")
    # Stored, so that either side of the join has an exchange of its own and a hot window can be split.
    repeated = checkpoint(
        occ.groupBy("_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_n"), F.min(at).alias("_first"))
        .filter(F.col("_n") > 1).drop("_n")
    )
    later = occ.join(repeated, ["_h1", "_h2"]).filter(~at.eqNullSafe(F.col("_first")))
    cover = F.flatten(F.transform("_pos", lambda p: F.sequence(p, p + (size - 1))))
    return later.groupBy("_k1", "_k2").agg(F.collect_set("_pos").alias("_pos")) \
        .select("_k1", "_k2", F.array_distinct(cover).alias("_cov"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """All rows and columns of ``docs`` with the text reduced to the kept lines,
    as ``struct row``, ``text``, ``n_lines`` and ``n_removed``."""
    row = F.struct(*every(docs, [c for c in docs.columns if c != text_col])).alias("row")
    keyed = _keyed(docs, id_col, text_col, row, F.col(text_col).isNull().alias("_null"))
    # Lines are split below the join, so the lambda after it reads a stored array.
    joined = keyed.join(covered_lines(_keyed(docs, id_col, text_col), size), ["_k1", "_k2"], "left")
    n = F.size("_lines")
    kept = F.array_except(F.sequence(F.lit(0), n - 1), F.coalesce("_cov", F.array().cast("array<int>")))
    text = F.array_join(F.transform(kept, lambda i: F.get(F.col("_lines"), i)), "\n")
    return joined.select(
        "row",
        F.when(F.col("_cov").isNull(), F.when(~F.col("_null"), F.array_join("_lines", "\n")))
        .otherwise(text).alias("text"),
        F.when(F.col("_null"), 0).otherwise(n).cast("long").alias("n_lines"),
        F.when(F.col("_cov").isNull(), 0).otherwise(F.size("_cov")).cast("long").alias("n_removed"),
    )
