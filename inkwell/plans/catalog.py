"""Registered example queries over the test tables.

The test tables hold no feeds or articles, so each query derives its input
deterministically from a whole table (every row participates), runs the
operator under test, and returns a DataFrame.  ``ORACLE`` holds the matching
DuckDB SQL; the two are compared by the correctness gate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict = {}


def oracles() -> dict[str, str]:
    return {k: (v() if callable(v) else v) for k, v in ORACLE.items()}


def query(name: str, sql=None):
    """Register a query; ``sql`` is its oracle text, or a callable returning
    another query's oracle (resolved when the oracles are read)."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str, tasks: int | None = None) -> DataFrame:
    """Read one input table.  The session settings the operators rely on (UTC
    session time zone, dynamic partition overwrite) are applied first, so the
    queries give the same answer in any session they are handed.

    ``tasks`` deals the rows out to that many tasks before heavy work per row,
    for inputs stored as fewer splits than there are cores.
    """
    from inkwell.session import apply_required_conf

    apply_required_conf(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.repartition(tasks) if tasks else df


def cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


# Import the query modules so they register themselves.
from inkwell.plans import q_articles, q_feeds, q_files, q_pages, q_state  # noqa: E402,F401
from inkwell.plans import q_stream  # noqa: E402,F401  (uses oracles registered above)
from inkwell.plans import q_flows  # noqa: E402,F401
