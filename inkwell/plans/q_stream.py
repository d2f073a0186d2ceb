"""Structured Streaming twins of the batch operators (ST-1..ST-5, SNK-7).

Each query lands its input in time-ordered chunks (as a crawler would, run
after run) and processes each drop with ``trigger(availableNow=True)`` on one
checkpoint, so state and sink progress carry across runs.  The result is read
from what the sink wrote; the oracle is the batch twin's.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.operators import merge as M
from inkwell.plans import q_state
from inkwell.plans.catalog import ORACLE, query, table
from inkwell.schemas import ARTICLE
from inkwell.session import scratch_dir
from inkwell.streaming import sinks as SK
from inkwell.streaming.ttl import ttl_throttle_stream

EVENT_CHUNKS = ["2024-01-11 00:00:00", "2024-01-21 00:00:00"]


def _chunk_filters(ts_col: str, bounds: list[str]):
    ts = F.col(ts_col)
    lits = [F.lit(b).cast("timestamp_ntz") for b in bounds]
    conds = [ts < lits[0]]
    for lo, hi in zip(lits, lits[1:]):
        conds.append((ts >= lo) & (ts < hi))
    conds.append(ts.isNull() | (ts >= lits[-1]))  # the last drop takes every other row
    return conds


_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def _run_in_drops(drops, land: str, fmt: str, start_stream=None, catch_up=None, **options: str) -> None:
    """Write each drop into ``land`` (``options`` are the writer's) and let the stream (or ``catch_up``, which runs several) catch up after each.

    Runs are scheduled catch-ups, so the extra micro-batch Spark would start
    only to move the watermark is skipped: update-mode results are already
    out, and state eviction happens with the next drop's batch instead.
    """
    spark = drops[0].sparkSession
    before = spark.conf.get(_NO_DATA, "true")
    spark.conf.set(_NO_DATA, "false")
    try:
        for df in drops:
            df.write.mode("append").format(fmt).options(**options).save(land)
            catch_up() if catch_up else SK.run_available(start_stream)
    finally:
        spark.conf.set(_NO_DATA, before)


# ------------------------------------------------------------------ ST-1
@query("stream_ttl", lambda: ORACLE["ttl_throttle"])
def stream_ttl(spark, sf):
    """Micro-batch formulation: native batch throttle + seen-state table per batch."""
    from inkwell.streaming.ttl import ttl_microbatch_sink

    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    land, ckpt, state, out = (scratch_dir(spark, n) for n in ("events_in", "ttl_ckpt", "ttl_state", "ttl_out"))
    sink = ttl_microbatch_sink(state, out, ["user_id", "event_type"], "ts", 86400, tiebreak="event_id")

    def start():
        stream = spark.readStream.schema(ev.schema).parquet(land)
        return (stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt)
                .trigger(availableNow=True).start())

    _run_in_drops([ev.filter(c) for c in _chunk_filters("ts", EVENT_CHUNKS)], land, "parquet", start)
    return spark.read.parquet(out).select("event_id", "user_id", "event_type")


@query("stream_ttl_keyed_state", lambda: ORACLE["ttl_throttle"])
def stream_ttl_keyed_state(spark, sf):
    """Keyed-state formulation: applyInPandasWithState, one number of state per key."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    land, ckpt, out = (scratch_dir(spark, n) for n in ("events_in", "ttl_ckpt", "ttl_out"))

    def start():
        stream = spark.readStream.schema(ev.schema).parquet(land)
        acc = ttl_throttle_stream(stream, ["user_id", "event_type"], "ts", 86400, tiebreak="event_id")
        return (acc.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
                .outputMode("append").trigger(availableNow=True).start())

    _run_in_drops([ev.filter(c) for c in _chunk_filters("ts", EVENT_CHUNKS)], land, "parquet", start)
    return spark.read.parquet(out).select("event_id", "user_id", "event_type")


def _value_state(spark, drops, initial=None):
    """Accepted and late rows (with a reason) of the value-state throttle, after all drops."""
    from inkwell.streaming.value_state import rocksdb_state, ttl_throttle_state

    land, ckpt, out = (scratch_dir(spark, n) for n in ("events_in", "value_ckpt", "value_out"))

    def start():
        stream = spark.readStream.schema(drops[0].schema).parquet(land)
        rows = ttl_throttle_state(stream, ["user_id", "event_type"], "ts", 86400, tiebreak="event_id", initial=initial)
        return (rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
                .outputMode("append").trigger(availableNow=True).start())

    with rocksdb_state(spark):
        _run_in_drops(drops, land, "parquet", start)
    return spark.read.parquet(out)


@query("stream_ttl_value_state", lambda: ORACLE["ttl_throttle"])
def stream_ttl_value_state(spark, sf):
    """The first days are throttled as a batch; the stream starts from its marks and judges the rest
    with ``transformWithState``.  Together they are what one batch over all days accepts."""
    from inkwell.operators import seen as S

    keys = ["user_id", "event_type"]
    ev = table(spark, sf, "events").select("event_id", *keys, "ts")
    days, *rest = [ev.filter(c) for c in _chunk_filters("ts", EVENT_CHUNKS)]
    by_batch = S.ttl_throttle(days, keys, "ts", 86400, tiebreak="event_id").select("event_id", *keys, "ts").checkpoint(eager=True)
    marks = S.advance_seen(None, by_batch, keys, "ts")
    streamed = _value_state(spark, rest, marks).filter("reason is null")
    return by_batch.select("event_id", *keys).unionByName(streamed.select("event_id", *keys))


# ------------------------------------------------------------------ ST-3
def _noon(rows):
    """The noon of the newest ``processed_at``; None (the clock) if no row has one."""
    return rows.agg(F.date_format(F.max("processed_at"), "yyyy-MM-dd 12:00:00")).first()[0]


def _upsert_stream(spark, land: str, ckpt: str, sink):
    """Landing files go once a later batch begins: their rows are in the table, and only the last batch can be replayed."""
    stream = spark.readStream.schema(ARTICLE).option("cleanSource", "delete").json(land)
    return (stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())


def _news_rows(t):
    f = q_state.TS_FMT
    return t.select(
        "id", "url", "heading", "content", "author", F.date_format("date", "yyyy-MM-dd").alias("date"), "category",
        F.date_format("processed_at", f).alias("processed_at"), "spider_name",
        F.date_format("created_at", f).alias("created_at"), F.date_format("updated_at", f).alias("updated_at"),
    )


@query("stream_upsert", lambda: ORACLE["upsert_articles"])
def stream_upsert(spark, sf):
    """Each micro-batch is upserted as a delta of its own size.  So that the result is
    fixed, the run time is taken from the data here and not from the clock."""
    land, ckpt = (scratch_dir(spark, n) for n in ("landing", "upsert_ckpt"))
    table_dir = scratch_dir(spark, "news") + "/news"
    drops = [
        q_state._run_batch(spark, sf, 1).drop("doc_id"),
        q_state._run_batch(spark, sf, 2).drop("doc_id"),
    ]
    sink = SK.upsert_sink(table_dir, _noon)
    _run_in_drops(drops, land, "json", lambda: _upsert_stream(spark, land, ckpt, sink), compression="gzip")
    return _news_rows(M.read_news(spark, table_dir))


# Batch loads and two streams take turns on one table: (version of the items, languages, writer, run time).
# The last group takes every other language, NULL included.
_TURNS = [
    (1, ["en", "de"], "load", "2025-06-01 12:00:00"),
    (2, ["en"], "a", "2025-06-02 12:00:00"),
    (1, ["fr"], "load", "2025-06-03 12:00:00"),
    (2, None, "b", "2025-06-04 12:00:00"),
    (1, ["en", "fr"], "a", "2025-06-05 12:00:00"),
    (2, ["de"], "load", "2025-06-06 12:00:00"),
]
_NAMED = ["en", "de", "fr"]


def _turn_sql(version: int, langs) -> str:
    which = (f"category IN {tuple(langs)}".replace(",)", ")") if langs else f"(category IS NULL OR category NOT IN {tuple(_NAMED)})")
    return (f"SELECT * REPLACE (CASE WHEN doc_id % 7 <> 0 THEN url END AS url) FROM ({q_state._items_sql(version)}) WHERE {which}")


@query("interleaved_upserts", q_state.chain_sql([(_turn_sql(v, langs), ts) for v, langs, _, ts in _TURNS]))
def interleaved_upserts(spark, sf):
    """Batch loads and two streams take turns on one table, then both streams replay their last
    batch, as after a crash between the sink's commit and the checkpoint's.  No
    row is lost, and the replays write nothing."""
    from inkwell.sinks.files import delete_path

    root = scratch_dir(spark, "turns")
    table_dir, clock, last = f"{root}/news", [], {}
    sink = SK.upsert_sink(table_dir, lambda rows: clock[-1])

    def catch_up(writer):
        SK.run_available(lambda: _upsert_stream(spark, f"{root}/land_{writer}", f"{root}/ckpt_{writer}", sink))

    for version, langs, writer, run_ts in _TURNS:
        items = q_state._doc_items(spark, sf, version).withColumn("url", F.when(F.col("doc_id") % 7 != 0, F.col("url")))
        lang = F.coalesce("category", F.lit(""))
        items = items.filter(lang.isin(langs) if langs else ~lang.isin(_NAMED)).drop("doc_id")
        clock.append(run_ts)
        if writer == "load":
            M.upsert_into(spark, table_dir, M.to_load_rows(items), run_ts, max_deltas=3)
            continue
        items.write.mode("append").json(f"{root}/land_{writer}", compression="gzip")
        catch_up(writer)
        last[writer] = last.get(writer, -1) + 1
    clock.append("2030-01-01 00:00:00")  # what a replay would leave behind
    for writer, n in last.items():
        delete_path(spark, f"{root}/ckpt_{writer}/commits/{n}")
        catch_up(writer)
    return _news_rows(M.read_news(spark, table_dir))


# ------------------------------------------------------------- ST-4, ST-5
def _windowed_counts(spark, sf, name: str, every: str, by: list[str], aggs, fmt: str, drops=None):
    """Windowed counts with a watermark (update mode), kept in a table partitioned by the
    window's day; rows whose window has closed are set aside first.  Returns the folder of both."""
    from inkwell.streaming.late import run_windowed_counts

    log = q_state._crawl_log(spark, sf).select("event_id", "ts", "source", "kind")
    land, root = scratch_dir(spark, f"{name}_in"), scratch_dir(spark, f"{name}_out")

    def catch_up():
        run_windowed_counts(spark, lambda: spark.readStream.schema(log.schema).parquet(land), root, "ts", every, by, aggs, fmt)

    _run_in_drops([log.filter(c) for c in drops or _chunk_filters("ts", EVENT_CHUNKS)], land, "parquet", catch_up=catch_up)
    return root


@query("stream_daily", lambda: ORACLE["daily_stats"])
def stream_daily(spark, sf):
    aggs = [
        ("articles_found", F.count(F.lit(1))),
        ("articles_scraped", F.count_if(F.col("kind") == "scraped")),
        ("errors", F.count_if(F.col("kind") == "error")),
    ]
    t = spark.read.parquet(_windowed_counts(spark, sf, "daily", "1 day", ["source"], aggs, "yyyy-MM-dd") + "/counts")
    return t.select("source", F.col("window_start").alias("date"), "articles_found", "articles_scraped", "errors")


@query(
    "stream_rate",
    "SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS window_start, count(*) AS events, "
    "count(*) FILTER (WHERE event_type = 'purchase') AS items FROM events GROUP BY 1",
)
def stream_rate(spark, sf):
    aggs = [("events", F.count(F.lit(1))), ("items", F.count_if(F.col("kind") == "scraped"))]
    t = spark.read.parquet(_windowed_counts(spark, sf, "rate", "1 minute", [], aggs, "yyyy-MM-dd HH:mm") + "/counts")
    return t.drop("day")  # only the storage partition


_LATE = "(event_id % 10 = 0)"
_NEWEST = f"(SELECT max(ts) FROM events WHERE event_id IS NULL OR NOT {_LATE})"
_CLOSED = f"({_LATE} AND date_trunc('day', ts) + INTERVAL 1 DAY <= {_NEWEST} - INTERVAL 1 HOUR)"


@query(
    "stream_late_counts",
    "SELECT strftime(ts, '%Y-%m-%d') AS date, 'src' || (user_id % 4) AS source, "
    f"count(*) FILTER (WHERE NOT coalesce({_CLOSED}, false)) AS counted, count(*) FILTER (WHERE {_CLOSED}) AS late FROM events GROUP BY 1, 2",
)
def stream_late_counts(spark, sf):
    """A tenth of the events arrives after all others: what still finds its window open is counted, the
    rest is in the quarantine, and together they are the input."""
    late = F.coalesce(F.col("event_id") % 10 == 0, F.lit(False))
    root = _windowed_counts(spark, sf, "late_counts", "1 day", ["source"], [("n", F.count(F.lit(1)))], "yyyy-MM-dd", [~late, late])
    counts = spark.read.parquet(root + "/counts").select(F.col("window_start").alias("date"), "source", F.col("n").alias("counted"), F.lit(0).alias("late"))
    aside = spark.read.parquet(root + "/late").filter("reason = 'late'").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("date"), "source") \
        .agg(F.lit(0).alias("counted"), F.count(F.lit(1)).alias("late"))
    return counts.unionByName(aside).groupBy("date", "source").agg(F.sum("counted").alias("counted"), F.sum("late").alias("late"))


# ------------------------------------------------------------ ST-2, SNK-7
@query(
    "stream_landing",
    "SELECT 'https://news.example.com/a/' || doc_id AS url, source AS spider_name, "
    "split_part(text, chr(10), 1) AS heading FROM documents",
)
def stream_landing(spark, sf):
    """Landing files are loaded as they arrive and archived once committed
    (``cleanSource=archive``): a file is moved only after its rows are in."""
    from inkwell.plans.q_files import _items

    items = _items(spark, sf).drop("lang")
    land, arch, ckpt, out = (scratch_dir(spark, n) for n in ("landing", "archive", "landing_ckpt", "news_append"))
    english = F.coalesce("category", F.lit("")) == "en"
    drops = [items.filter(english), items.filter(~english)]

    def start():
        stream = (spark.readStream.schema(ARTICLE).option("pathGlobFilter", "*.json")
                  .option("cleanSource", "archive").option("sourceArchiveDir", arch).json(land))
        rows = M.to_load_rows(stream)
        return (rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
                .outputMode("append").trigger(availableNow=True).start())

    _run_in_drops(drops, land, "json", start)
    return spark.read.parquet(out).select("url", "spider_name", "heading")
