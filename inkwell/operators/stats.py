"""Run counters and roll-ups (A-1..A-5, W-2, SNK-5, ST-4/ST-5 batch twins).

Every roll-up is one grouped aggregate of conditional counts (``count_if``),
which Spark combines map-side; no pivot job, no window over a whole source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_stats(events: DataFrame, source: str = "source", run: str = "run_id", ts: str = "ts",
              kind: str = "kind") -> DataFrame:
    """A-1: per (source, run) articles_found / articles_scraped / errors.

    ``kind`` marks each log event: every event with a link counts as found,
    'scraped' as extracted, 'error' as an isolated row failure (V-2).
    """
    return events.groupBy(source, run).agg(
        F.count(F.lit(1)).alias("articles_found"),
        F.count_if(F.col(kind) == "scraped").alias("articles_scraped"),
        F.count_if(F.col(kind) == "error").alias("errors"),
        F.min(ts).alias("run_start"),
        F.max(ts).alias("run_end"),
    )


def last_run_stats(stats: DataFrame, source: str = "source", day: str = "date",
                   end: str = "run_end", tiebreak: str = "run_id") -> DataFrame:
    """W-2 / SNK-5: one record per (source, day), the last run to finish wins.

    ``max_by`` keeps this a partial aggregate even when one source has most runs.
    """
    keep = [c for c in stats.columns if c not in (source, day)]
    row = F.struct(*[F.col(c) for c in keep])
    return stats.groupBy(source, day).agg(F.max_by(row, F.struct(F.col(end), F.col(tiebreak))).alias("_r")).select(
        source, day, "_r.*"
    )


def status_rollup(responses: DataFrame, run_keys: list[str], nbytes: str = "bytes", ts: str = "ts") -> DataFrame:
    """A-4 + F-5: requests, ignored (non-2xx) responses, bytes in and elapsed time per run."""
    return responses.groupBy(*run_keys).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(~F.col("status").between(200, 299)).alias("n_ignored"),
        F.sum(nbytes).cast("bigint").alias("bytes_in"),
        ((F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp"))) / 1000)
        .cast("bigint").alias("elapsed_ms"))


def status_counts(responses: DataFrame, run_keys: list[str]) -> DataFrame:
    """A-4: one row per run and status that occurs (NULL: no response recorded)."""
    return responses.groupBy(*run_keys, "status").agg(F.count(F.lit(1)).alias("n"))


def rate(events: DataFrame, ts: str = "ts", every: str = "1 minute", by: list[str] | None = None,
         item_flag: str | None = None) -> DataFrame:
    """ST-4 (batch): events and items per tumbling window."""
    w = F.window(F.col(ts).cast("timestamp"), every)
    aggs = [F.count(F.lit(1)).alias("events")]
    if item_flag:
        aggs.append(F.count_if(F.col(item_flag)).alias("items"))
    return events.groupBy(w.alias("w"), *(by or [])).agg(*aggs).select(
        F.col("w.start").alias("window_start"), *(by or []), *[a for a in ["events", "items"] if a == "events" or item_flag]
    )
