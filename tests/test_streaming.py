"""ST-1: keyed-state throttle equals the batch throttle across micro-batches."""

import datetime as dt
import os
import random

from inkwell.operators import seen as S
from inkwell.streaming.ttl import ttl_throttle_stream

T0 = dt.datetime(2025, 6, 1)


def test_stream_ttl_equals_batch(spark, tmp_dir):
    rnd = random.Random(3)
    rows = [(i, f"k{rnd.randrange(6)}", T0 + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 6))) for i in range(300)]
    schema = "event_id long, k string, ts timestamp_ntz"
    df = spark.createDataFrame(rows, schema)
    batch = {r[0] for r in S.ttl_throttle(df, ["k"], "ts", 86400, "event_id").collect()}
    land, ckpt, out = (os.path.join(tmp_dir, n) for n in ("in", "ckpt", "out"))
    cut = T0 + dt.timedelta(days=3)
    for part in (df.filter(df.ts < cut), df.filter(df.ts >= cut)):
        part.write.mode("append").parquet(land)
        stream = spark.readStream.schema(df.schema).parquet(land)
        q = (ttl_throttle_stream(stream, ["k"], "ts", 86400, "event_id").writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
    streamed = {r["event_id"] for r in spark.read.parquet(out).collect()}
    assert streamed == batch


def test_microbatch_sink_hot_key_equals_batch(spark, tmp_dir):
    # Default ST-1 path: native throttle per micro-batch (hot key forced onto
    # pointer doubling with max_group=20) against a seen-state table.
    from inkwell.streaming.ttl import ttl_microbatch_sink

    rnd = random.Random(11)
    rows = [(i, "hot" if i % 2 == 0 else f"k{rnd.randrange(5)}",
             T0 + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 6))) for i in range(240)]
    df = spark.createDataFrame(rows, "event_id long, k string, ts timestamp_ntz")
    batch = {r[0] for r in S.ttl_throttle(df, ["k"], "ts", 86400, "event_id").collect()}
    land, ckpt, state, out = (os.path.join(tmp_dir, n) for n in ("in", "ckpt", "state", "out"))
    sink = ttl_microbatch_sink(state, out, ["k"], "ts", 86400, tiebreak="event_id", max_group=20)
    cut = T0 + dt.timedelta(days=3)
    for part in (df.filter(df.ts < cut), df.filter(df.ts >= cut)):
        part.write.mode("append").parquet(land)
        q = (spark.readStream.schema(df.schema).parquet(land).writeStream.foreachBatch(sink)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
    streamed = {r["event_id"] for r in spark.read.parquet(out).collect()}
    assert streamed == batch
    assert len([d for d in os.listdir(state) if d.startswith("v=")]) <= 2


def test_late_rows_are_kept_with_a_reason(spark, tmp_dir):
    from inkwell.streaming.ttl import ttl_microbatch_sink

    h = dt.timedelta(hours=1)
    state, out = (os.path.join(tmp_dir, n) for n in ("state", "out"))
    sink = ttl_microbatch_sink(state, out, ["k"], "ts", 86400, tiebreak="event_id")
    schema = "event_id long, k string, ts timestamp_ntz"
    sink(spark.createDataFrame([(1, "a", T0), (2, None, T0 + 100 * h), (3, "b", T0 + 100 * h)], schema), 0)
    second = [(4, "a", T0 + 10 * h), (5, None, T0 + 90 * h), (6, "b", T0 + 130 * h), (7, "c", T0 + 99 * h)]
    for _ in range(2):  # a replayed batch writes the same
        sink(spark.createDataFrame(second, schema), 1)
    late = {(r["event_id"], r["reason"]) for r in spark.read.parquet(out + "_late").collect()}
    assert late == {(4, "behind the kept marks"), (5, "before the last accept of its key")}
    assert {r["event_id"] for r in spark.read.parquet(out).collect()} == {1, 2, 3, 6, 7}


def test_late_rows_beside_windowed_counts(spark, tmp_dir):
    """Counts and quarantine hold every row, over restarts and a replayed batch."""
    from pyspark.sql import functions as F

    from inkwell.streaming.late import run_windowed_counts, split_late_sink

    h = dt.timedelta(hours=1)
    drops = [[(1, "a", T0 + h), (2, "a", T0 + 30 * h), (3, "b", None)],
             [(4, "a", T0 + 23 * h), (5, "b", T0 + 26 * h), (6, "b", T0 + 31 * h)],  # the first day has closed at T0 + 29h
             [(7, "a", T0 + 40 * h), (8, "b", T0 + 2 * h)]]
    schema = "event_id long, k string, ts timestamp_ntz"
    land, root = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")

    def source():
        return spark.readStream.schema(schema).parquet(land)

    for rows in drops:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(land)
        run_windowed_counts(spark, source, root, "ts", "1 day", ["k"], [("n", F.count(F.lit(1)))], "yyyy-MM-dd")
    counts = {(r["window_start"], r["k"]): r["n"] for r in spark.read.parquet(root + "/counts").collect()}
    assert counts == {("2025-06-01", "a"): 1, ("2025-06-02", "a"): 2, ("2025-06-02", "b"): 2}
    late = {(r["event_id"], r["reason"]) for r in spark.read.parquet(root + "/late").collect()}
    assert late == {(3, "no time"), (4, "late"), (8, "late")}
    sink = split_late_sink(root, "ts", "1 day")
    sink(spark.createDataFrame(drops[2], schema), 2)  # replayed
    assert spark.read.parquet(root + "/on_time").count() == 5 and spark.read.parquet(root + "/late").count() == 3


def _through_value_state(spark, tmp_dir, drops, schema, **kw):
    from inkwell.streaming.value_state import rocksdb_state, ttl_throttle_state

    land, ckpt, out = (os.path.join(tmp_dir, n) for n in ("in", "ckpt", "out"))
    with rocksdb_state(spark):
        for rows in drops:
            rows.write.mode("append").parquet(land)
            stream = spark.readStream.schema(schema).parquet(land)
            (ttl_throttle_state(stream, ["k"], "ts", 86400, "event_id", **kw).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination())
    return {r["event_id"]: r["reason"] for r in spark.read.parquet(out).collect()}


def test_value_state_from_batch_marks_equals_batch(spark, tmp_dir):
    """The batch fold judges the first days, the stream the rest from its marks, over two restarts."""
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["a", "b", "c", None]), T0 + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 9))) for i in range(400)]
    schema = "event_id long, k string, ts timestamp_ntz"
    df = spark.createDataFrame(rows, schema)
    whole = {r[0] for r in S.ttl_throttle(df, ["k"], "ts", 86400, "event_id").collect()}
    cuts = [T0 + dt.timedelta(days=3), T0 + dt.timedelta(days=6)]
    first = S.ttl_throttle(df.filter(df.ts < cuts[0]), ["k"], "ts", 86400, "event_id")
    marks = S.advance_seen(None, first, ["k"], "ts")
    streamed = _through_value_state(spark, tmp_dir, [df.filter((df.ts >= cuts[0]) & (df.ts < cuts[1])), df.filter(df.ts >= cuts[1])],
                                    schema, initial=marks)
    assert set(streamed.values()) == {None}
    assert {r["event_id"] for r in first.collect()} | set(streamed) == whole


def test_value_state_keeps_late_rows_and_rows_without_time(spark, tmp_dir):
    h = dt.timedelta(hours=1)
    schema = "event_id long, k string, ts timestamp_ntz"
    drops = [[(1, "a", T0), (2, None, T0 + 100 * h), (3, "b", T0 + 100 * h), (10, "b", None)],
             [(4, "a", T0 + 10 * h), (5, None, T0 + 90 * h), (6, "b", T0 + 130 * h), (7, "c", T0 + 99 * h), (11, "b", None),
              (12, "b", T0 + 110 * h)],
             [(8, "c", T0 + 98 * h), (9, "a", T0 + 140 * h)]]
    got = _through_value_state(spark, tmp_dir, [spark.createDataFrame(d, schema) for d in drops], schema)
    before, behind = "before the last accept of its key", "behind the kept marks"
    assert got == {1: None, 2: None, 3: None, 10: None, 4: behind, 5: before, 6: None, 7: None, 11: None, 8: behind, 9: None}


def _counted_events(spark):
    h = dt.timedelta(hours=1)
    rows = [(n * 200 + u, u if u else None, T0 + n * 20 * h) for n in range(3) for u in range(200)]
    rows += [(2**60 + 1, 7, T0 + 90 * h), (None, 8, T0 + 90 * h), (2**60 + 3, None, T0 + 90 * h)]
    return spark.createDataFrame(rows, "event_id long, k long, ts timestamp_ntz")


def test_calls_into_python_follow_buckets_not_keys(spark, tmp_dir, monkeypatch):
    """200 keys in 8 buckets: the state functions are called once per bucket and batch, the rows are those of the batch fold."""
    from inkwell.streaming import ttl, value_state

    df, cut = _counted_events(spark), T0 + dt.timedelta(hours=30)
    whole = {(r["event_id"], r["k"]) for r in S.ttl_throttle(df, ["k"], "ts", 86400, "event_id").collect()}
    assert len(whole) == 200 + 200 + 3
    for name, throttle in (("keyed", ttl.ttl_throttle_stream), ("value", value_state.ttl_throttle_state)):
        calls = os.path.join(tmp_dir, name + "_calls")
        os.makedirs(calls)

        def counted(fn, calls=calls):
            def call(*args):
                import uuid

                with open(os.path.join(calls, uuid.uuid4().hex), "w"):
                    pass
                yield from fn(*args)

            return call

        with monkeypatch.context() as m:
            if name == "keyed":
                make = ttl._make_fn
                m.setattr(ttl, "_make_fn", lambda *a, make=make: counted(make(*a)))
            else:
                m.setattr(value_state.Throttle, "handleInputRows", counted(value_state.Throttle.handleInputRows))
            land, ckpt, out = (os.path.join(tmp_dir, name + n) for n in ("in", "ckpt", "out"))
            with value_state.rocksdb_state(spark):
                for part in (df.filter(df.ts < cut), df.filter(df.ts >= cut)):
                    part.write.mode("append").parquet(land)
                    stream = spark.readStream.schema(df.schema).parquet(land)
                    (throttle(stream, ["k"], "ts", 86400, "event_id", buckets=8).writeStream.format("parquet").option("path", out)
                     .option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination())
        got = spark.read.parquet(out)
        assert {(r["event_id"], r["k"]) for r in got.collect()} == whole, name
        assert got.schema["event_id"].dataType.simpleString() == "bigint"
        assert len(os.listdir(calls)) <= 8 * 4, name  # two drops, and two batches that only move the watermark


def test_keys_keep_apart_in_their_text(spark):
    from inkwell.streaming.ttl import key_text

    rows = [("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("ab", None), ("1:a", None), (None, None), ("-", None)]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(key_text(df, ["a", "b"]).alias("k")).distinct().count() == len(rows)
    same = spark.sql("SELECT * FROM VALUES (0.0D), (-0.0D) AS t(d)")
    assert same.select(key_text(same, ["d"]).alias("k")).distinct().count() == 1


def test_streamed_rows_without_time_are_accepted(spark, tmp_dir):
    rows = [(1, "a", T0), (2, "a", None), (3, "a", T0 + dt.timedelta(hours=1)), (4, None, None)]
    spark.createDataFrame(rows, "event_id long, k string, ts timestamp_ntz").write.parquet(os.path.join(tmp_dir, "in"))
    stream = spark.readStream.schema("event_id long, k string, ts timestamp_ntz").parquet(os.path.join(tmp_dir, "in"))
    out = os.path.join(tmp_dir, "out")
    (ttl_throttle_stream(stream, ["k"], "ts", 86400, "event_id").writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", os.path.join(tmp_dir, "ckpt")).trigger(availableNow=True).start().awaitTermination())
    assert {(r["event_id"], r["ts"] is None) for r in spark.read.parquet(out).collect()} == {(1, False), (2, True), (4, True)}


def _documents(spark, tmp_dir):
    rows = [(i, f"Head {i % 50}\nbody of {i % 50}" if i % 11 else None, ["en", "de", "fr", "es", None][i % 5], f"s{i % 3}", 9) for i in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(os.path.join(tmp_dir, "documents.parquet"))
    return tmp_dir


def _landed(*folders):
    return {f: sorted(n for n in os.listdir(f) if n.startswith("part-")) for f in folders}


def test_stream_upsert_keeps_landed_rows_compressed_until_they_are_in(spark, tmp_dir, monkeypatch):
    """Landing files are gzip; those of the first run are gone once the second one begins."""
    import inkwell.plans.catalog  # noqa: F401  (before its query modules)
    from inkwell.plans import q_state, q_stream

    sf, land, seen = _documents(spark, tmp_dir), os.path.join(tmp_dir, "landing"), []
    monkeypatch.setattr(q_stream, "scratch_dir", lambda _, name: os.path.join(tmp_dir, name))
    inner = q_stream.SK.run_available
    monkeypatch.setattr(q_stream.SK, "run_available", lambda start: (seen.append(_landed(land)[land]), inner(start)))
    got = sorted(map(tuple, q_stream.stream_upsert(spark, sf).collect()), key=repr)
    assert got == sorted(map(tuple, q_state.upsert_articles(spark, sf).collect()), key=repr) and got
    first, both = seen
    assert all(n.endswith(".json.gz") for n in both) and set(first) < set(both)
    assert set(_landed(land)[land]) == set(both) - set(first)


def test_interleaved_upserts_keep_landed_rows_compressed_until_they_are_in(spark, tmp_dir, monkeypatch):
    """Landing files are gzip; of each stream only the last batch's are left, which the replays read."""
    import inkwell.plans.catalog  # noqa: F401
    from inkwell.plans import q_stream

    sf, root = _documents(spark, tmp_dir), os.path.join(tmp_dir, "turns")
    monkeypatch.setattr(q_stream, "scratch_dir", lambda _, name: os.path.join(tmp_dir, name))
    rows = q_stream.interleaved_upserts(spark, sf).collect()
    assert len({r["id"] for r in rows}) == len(rows) and {r["category"] for r in rows if r["url"]} == {"en", "de", "fr", "es", None}
    assert max(r["updated_at"] for r in rows) < "2030" and {r["updated_at"][:10] for r in rows} >= {"2025-06-05", "2025-06-06"}
    left = _landed(f"{root}/land_a", f"{root}/land_b")
    assert all(n and all(f.endswith(".json.gz") for f in n) for n in left.values())
    found = {r["category"] for r in spark.read.json(f"{root}/land_a").collect()}
    assert found == {"en", "fr"} and {r["author"] for r in spark.read.json(f"{root}/land_a").collect()} <= {f"Desk s{k}" for k in range(3)}
