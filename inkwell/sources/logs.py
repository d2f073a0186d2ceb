"""Run-log lines (M11) as a table: ``asctime - name - level - message``.

Text files are read with ``spark.read.text`` (splittable, one row per line)
and split with one native regular expression; lines that do not match keep
their text with NULL fields, so nothing is silently dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The line layout and its timestamp format.
LOG_LINE_RE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3}) - (.*?) - ([A-Z]+) - (.*)$"
ASCTIME_FORMAT = "yyyy-MM-dd HH:mm:ss,SSS"


def parse_log_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """(ts TIMESTAMP, source, level, message, line) per input line.

    One pass of the pattern marks the four parts; a line that does not match stays
    a single part.
    """
    marked = lines.select(F.col(col).alias("line"), F.split(
        F.regexp_replace(F.regexp_replace(col, "\x00", ""), LOG_LINE_RE, "$1\x00$2\x00$3\x00$4"), "\x00").alias("_p"))
    part = lambda i: F.when(F.size("_p") == 4, F.nullif(F.get(F.col("_p"), i), F.lit("")))
    return marked.select(
        F.try_to_timestamp(part(0), F.lit(ASCTIME_FORMAT)).alias("ts"),
        part(1).alias("source"),
        part(2).alias("level"),
        part(3).alias("message"),
        "line",
    )


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return parse_log_lines(spark.read.text(path))


def format_log_line(ts: Column, source: Column, level: Column, message: Column) -> Column:
    return F.concat_ws(" - ", F.date_format(ts, ASCTIME_FORMAT), source, level, message)


def log_rollup(logs: DataFrame) -> DataFrame:
    """Lines per (source, level) with the span of the run log and scraped-article
    messages counted (one grouped aggregate)."""
    return logs.groupBy("source", "level").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("message").startswith("Scraped article")).alias("scraped"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )
