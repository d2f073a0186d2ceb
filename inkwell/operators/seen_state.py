"""SRC-4 / SNK-6: the stored seen state, which expires.

Marks (key, last accepted time) lie in a table partitioned by the hour of the accept and by
the run that wrote them.  A run appends its own marks and nothing else, J-2 reads only the
hours in which a mark can still suppress something (partition pruning), and hours that lie
wholly beyond the TTL are deleted.  So the state follows the accepts of the last TTL, like
the key-value store whose entries expire, and not the urls ever seen.

A replayed run is judged without its own marks and writes its (hour, run) partitions again, so
it gives the same result.  Rows without a time leave no mark.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from inkwell.operators import seen as S

HOUR = 3600
_EPOCH = _dt.datetime(1970, 1, 1)


def _seconds(t: _dt.datetime) -> float:
    """Seconds since the epoch of a naive UTC time or one with a zone."""
    if t.tzinfo is not None:
        t = t.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return (t - _EPOCH).total_seconds()


def as_time(t: str | _dt.datetime) -> _dt.datetime:
    return t if isinstance(t, _dt.datetime) else _dt.datetime.fromisoformat(t)


def add_marks(accepted: DataFrame, state_dir: str, keys: list[str], ts_col: str, run_id: str) -> None:
    """Append the run's marks: the newest accept per key, in the partition of its hour.

    The rows are dealt out by hour and large hours are split, so a run whose accepts fall into
    one hour still writes from many tasks.
    """
    at = F.col(ts_col).cast("timestamp")
    marks = accepted.filter(F.col(ts_col).isNotNull()).groupBy(*keys).agg(F.max(at).alias("last_accept_at"))
    marks = marks.withColumns({"hour": F.floor(F.unix_seconds("last_accept_at") / HOUR).cast("long"), "run": F.lit(run_id)})
    (marks.hint("rebalance", "hour").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("hour", "run").parquet(state_dir))


def live_marks(spark, state_dir: str, like: DataFrame, keys: list[str], since: str | _dt.datetime,
               but_run: str | None = None) -> DataFrame:
    """Marks later than ``since`` of all runs but ``but_run``; only partitions of that hour and later are read.

    ``like`` gives the types of the keys.  A key that several runs accepted may have several marks.
    """
    from inkwell.sinks.files import _fs

    fs, path, _ = _fs(spark, state_dir)
    own = [StructField(k, like.schema[k].dataType) for k in keys] + [StructField("last_accept_at", TimestampType())]
    if not fs.exists(path):
        return spark.createDataFrame([], StructType(own))
    schema = StructType([*own, StructField("hour", LongType()), StructField("run", StringType())])
    seconds = _seconds(as_time(since))
    table = spark.read.schema(schema).parquet(state_dir).filter(F.col("hour") >= int(seconds // HOUR))
    if but_run is not None:
        table = table.filter(F.col("run") != but_run)
    return table.filter(F.col("last_accept_at") > F.timestamp_micros(F.lit(round(seconds * S.US)))).select(*keys, "last_accept_at")


def expire_marks(spark, state_dir: str, now: str | _dt.datetime, ttl_seconds: int = 86400) -> int:
    """Delete the hours all of whose marks have expired at ``now``; returns their number.

    The driver lists partitions: one per hour of the TTL and of the pause since the last run.
    """
    from inkwell.sinks.files import _fs

    fs, root, _ = _fs(spark, state_dir)
    if not fs.exists(root):
        return 0
    limit, gone = _seconds(as_time(now)) - ttl_seconds, 0
    for st in fs.listStatus(root):
        m = re.fullmatch("hour=(-?[0-9]+)", st.getPath().getName())
        if m and (int(m[1]) + 1) * HOUR <= limit:
            gone += bool(fs.delete(st.getPath(), True))
    return gone


def throttle_run(spark, cand: DataFrame, state_dir: str, keys: list[str], ts_col: str, run_id: str,
                 ttl_seconds: int = 86400, tiebreak: str | None = None, max_group: int = S.DEFAULT_MAX_GROUP,
                 late_seconds: int = 3600) -> DataFrame:
    """One run against the stored state: J-2 on the live marks, W-3 among the run's own rows, then
    SNK-6.  Returns the accepted rows.

    Runs come in time order: a row may be ``late_seconds`` older than the newest row of earlier runs (the
    streaming sink keeps later ones apart).  A mark that can suppress no such row is not
    written; hours expire by the run's oldest row, so that the run can be replayed.
    """
    from inkwell.session import checkpoint_root

    checkpoint_root(spark)
    at, kept = F.col(ts_col).cast("timestamp_ntz"), _dt.timedelta(seconds=ttl_seconds + late_seconds)
    span = cand.agg(F.min(at).alias("lo"), F.max(at).alias("hi")).first()
    if span["lo"] is None:  # no row has a time: all are accepted, and none leaves a mark
        return cand
    marks = live_marks(spark, state_dir, cand, keys, span["lo"] - _dt.timedelta(seconds=ttl_seconds), run_id)
    fresh = S.drop_recently_seen(cand, marks, keys, ts_col, ttl_seconds)
    accepted = S.ttl_throttle(fresh, keys, ts_col, ttl_seconds, tiebreak, max_group).checkpoint(eager=True)
    add_marks(accepted.filter(at > F.lit(span["hi"] - kept)), state_dir, keys, ts_col, run_id)
    expire_marks(spark, state_dir, span["lo"], ttl_seconds + late_seconds)
    return accepted
