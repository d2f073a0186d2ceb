"""Validation, cleaning and constraint checks (F-3, P-14, P-15, V-1, V-4, A-3).

``validate`` splits one DataFrame into accepted and rejected rows with a
single CASE ladder; both outputs come from the same plan, so callers that use
both should persist or checkpoint the input first.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.dates import iso_string
from inkwell.functions.text import py_strip

# Required fields in check order, and the fields stripped.
REQUIRED_FIELDS = ["heading", "url", "content"]
STRIPPED_FIELDS = ["heading", "content", "author", "category", "date"]


def _falsy(c: Column) -> Column:
    return c.isNull() | (c == "")


def missing_field(df: DataFrame, strict: bool = False) -> Column:
    """Name of the first required field that is NULL or '' (NULL if none).

    The reference checks before stripping, so '   ' passes (D-1); with
    ``strict`` the check is made on the stripped value.
    """
    expr = None
    for f in REQUIRED_FIELDS:
        c = F.col(f)
        cond = _falsy(py_strip(c)) if strict else _falsy(c)
        expr = F.when(cond, F.lit(f)) if expr is None else expr.when(cond, F.lit(f))
    return expr


def reject_reason(field: Column) -> Column:
    """``Missing {field} in {url}``; a NULL url prints as Python's None."""
    return F.concat(F.lit("Missing "), field, F.lit(" in "), F.coalesce(F.col("url"), F.lit("None")))


def clean(df: DataFrame) -> DataFrame:
    """P-14: strip the five text fields; url is left as it is."""
    return df.withColumns({f: py_strip(F.col(f)) for f in STRIPPED_FIELDS if f in df.columns})


def stamp(df: DataFrame, run_ts, spider_col: Column | None = None) -> DataFrame:
    """P-15: processed_at (ISO string of the run time) and spider_name.

    The run time is an argument, not the wall clock, so reruns are repeatable.
    """
    ts = F.lit(run_ts).cast("timestamp_ntz") if isinstance(run_ts, (str, _dt.datetime)) else run_ts
    out = df.withColumn("processed_at", iso_string(ts))
    if spider_col is not None:
        out = out.withColumn("spider_name", spider_col)
    return out


def validate(df: DataFrame, run_ts, strict: bool = False,
             spider_col: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """F-3 + P-14 + P-15 + V-1 -> (accepted, rejected).

    Rejected rows keep every input column plus ``reject_field`` and ``reason``.
    """
    if spider_col is None and "spider_name" not in df.columns and "source" in df.columns:
        spider_col = F.col("source")
    tagged = df.withColumn("reject_field", missing_field(df, strict))
    accepted = stamp(clean(tagged.filter(F.col("reject_field").isNull()).drop("reject_field")), run_ts, spider_col)
    rejected = tagged.filter(F.col("reject_field").isNotNull()).withColumn(
        "reason", reject_reason(F.col("reject_field"))
    )
    return accepted, rejected


def rejects_by_reason(rejected: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A-3: reject counts per missing field (partial aggregation, no skew risk)."""
    keys = (by or []) + ["reject_field"]
    return rejected.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def load_constraints(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """V-4 + D-10 at load time -> (loadable, rejects).

    ``rows`` are typed load rows that carry the original date text as ``raw_date``.  A NULL heading breaks the table's NOT NULL; a date text
    that names no day cannot be stored.  Rejects keep the row, the text and ``reason``.
    """
    reason = (F.when(F.col("heading").isNull(), F.lit("heading is null"))
              .when(F.col("date").isNull() & (F.coalesce(py_strip(F.col("raw_date")), F.lit("")) != ""), F.lit("unreadable date")))
    tagged = rows.withColumn("reason", reason)
    return (tagged.filter(F.col("reason").isNull()).drop("reason", "raw_date"),
            tagged.filter(F.col("reason").isNotNull()))


def violations(df: DataFrame) -> DataFrame:
    """V-4: rows breaking ``heading NOT NULL`` and urls breaking ``url UNIQUE``.

    NULL urls never collide.  Duplicate detection is a grouped count, which
    Spark combines map-side, so a url repeated a billion times costs one row
    per partition before the shuffle.
    """
    null_heading = df.filter(F.col("heading").isNull()).groupBy("url").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("heading_null").alias("kind"), "url", "n"
    )
    dup_url = (
        df.filter(F.col("url").isNotNull())
        .groupBy("url")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .select(F.lit("url_duplicate").alias("kind"), "url", "n")
    )
    return null_heading.unionByName(dup_url)
