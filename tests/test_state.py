"""F-2, J-2, W-3, SNK-6, W-1, W-4, J-3, SNK-4, A-1, W-2, A-4: state, merge and counters."""

import datetime as dt
import random

from pyspark.sql import functions as F

from inkwell.operators import merge as M
from inkwell.operators import seen as S
from inkwell.operators import stats as ST

T0 = dt.datetime(2025, 6, 1)


def brute_ttl(rows, ttl):
    """Reference semantics: per key, accept iff >= last accepted + ttl."""
    last, out = {}, set()
    for eid, key, ts in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        if key not in last or ts >= last[key] + ttl:
            last[key] = ts
            out.add(eid)
    return out


def events_df(spark, rows):
    return spark.createDataFrame([(e, k[0], k[1], t) for e, k, t in rows],
                                 "event_id long, source string, url string, ts timestamp_ntz")


def test_ttl_cases(spark):
    h = dt.timedelta(hours=1)
    rows = [
        (1, ("s", "a"), T0), (2, ("s", "a"), T0 + dt.timedelta(hours=23, minutes=59, seconds=59)),
        (3, ("s", "a"), T0 + 24 * h),                                              # case 25
        (4, ("s", "b"), T0), (5, ("s", "b"), T0 + 20 * h), (6, ("s", "b"), T0 + 25 * h),  # case 26
        (7, ("t", "a"), T0 + h),                                                   # other source: own key
    ]
    df = events_df(spark, rows)
    for max_group in (S.DEFAULT_MAX_GROUP, 0):
        got = {r[0] for r in S.ttl_throttle(df, ["source", "url"], "ts", 86400, "event_id", max_group).collect()}
        assert got == {1, 3, 4, 6, 7}


def test_ttl_random_against_brute_force_with_hot_key(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(600):
        key = ("s", "hot") if i % 3 == 0 else ("s", f"u{rnd.randrange(40)}")
        rows.append((i, key, T0 + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 9))))
    expect = brute_ttl(rows, dt.timedelta(days=1))
    df = events_df(spark, rows)
    fold = {r[0] for r in S.ttl_throttle(df, ["source", "url"], "ts", 86400, "event_id").collect()}
    # max_group=50: the hot key (200 rows) takes pointer doubling, the rest the fold
    mixed = {r[0] for r in S.ttl_throttle(df, ["source", "url"], "ts", 86400, "event_id", max_group=50).collect()}
    assert fold == expect and mixed == expect


def test_ttl_null_times_and_keys_agree_on_both_paths(spark):
    """A row without a time is accepted and suppresses nothing; NULL keys are one key."""
    h = dt.timedelta(hours=1)
    rows = [(1, ("s", None), T0), (2, ("s", None), None), (3, ("s", None), T0 + h), (4, ("s", None), T0 + 24 * h),
            (5, (None, None), T0 + h), (6, (None, None), T0 + 2 * h), (7, (None, None), None), (8, (None, None), None)]
    for max_group in (S.DEFAULT_MAX_GROUP, 3, 0):
        got = {r[0] for r in S.ttl_throttle(events_df(spark, rows), ["source", "url"], "ts", 86400, "event_id", max_group).collect()}
        assert got == {1, 2, 4, 5, 7, 8}
    same = events_df(spark, [(1, ("s", "a"), T0)] * 3)
    for max_group in (S.DEFAULT_MAX_GROUP, 0):
        assert S.ttl_throttle(same, ["source", "url"], "ts", 86400, None, max_group).count() == 1


def test_seen_anti_join_boundary(spark):
    seen = spark.createDataFrame([("s", "a", T0)], "source string, url string, last_accept_at timestamp")
    cand = spark.createDataFrame(
        [(1, "s", "a", T0 + dt.timedelta(hours=23)), (2, "s", "a", T0 + dt.timedelta(hours=24)),
         (3, "t", "a", T0 + dt.timedelta(hours=1))], "id long, source string, url string, ts timestamp")
    kept = {r[0] for r in S.drop_recently_seen(cand, seen, ["source", "url"], "ts").collect()}
    assert kept == {2, 3}
    adv = S.advance_seen(seen, cand.filter("id = 2"), ["source", "url"], "ts").collect()
    assert adv[0]["last_accept_at"] == T0 + dt.timedelta(hours=24)


LOAD = "heading string, content string, author string, date string, category string, url string, processed_at string, spider_name string"


def batch(spark, rows):
    return M.to_load_rows(spark.createDataFrame(rows, LOAD))


def test_upsert_semantics(spark):
    t0 = M.empty_news(spark)
    b1 = batch(spark, [("h1", "c1", "a1", "2025-06-01", "k", "u1", "2025-06-01T01:00:00", "s"),
                       ("h2", "c2", "a2", "2025-06-01", "k", "u2", "2025-06-01T01:00:00", "s")])
    t1 = M.upsert(t0, b1, "2025-06-01 12:00:00").checkpoint()
    # case 28: matched row takes NULL author; id and created_at kept; updated_at moves
    b2 = batch(spark, [("h1b", "c1b", None, "2025-06-02", "k", "u1", "2025-06-02T01:00:00", "s"),
                       ("h1c", "older", "x", "2025-06-02", "k", "u1", "2025-06-02T00:00:00", "s"),  # W-1 loser
                       ("h3", "c3", "a3", "2025-06-02", "k", "u3", "2025-06-02T01:00:00", "s"),
                       ("hn", "cn", None, None, None, None, "2025-06-02T01:00:00", "s")])          # D-11
    t2 = M.upsert(t1, b2, "2025-06-02 12:00:00").checkpoint()
    rows = {r["url"]: r for r in t2.collect()}
    before = {r["url"]: r for r in t1.collect()}
    u1 = rows["u1"]
    assert u1["heading"] == "h1b" and u1["author"] is None and u1["content"] == "c1b"
    assert u1["id"] == before["u1"]["id"] and u1["created_at"] == before["u1"]["created_at"]
    assert u1["updated_at"] == dt.datetime(2025, 6, 2, 12)
    assert rows["u2"]["updated_at"] == dt.datetime(2025, 6, 1, 12)
    ids = sorted(r["id"] for r in t2.collect())
    assert ids == [1, 2, 3, 4] and rows["u3"]["id"] == 3 and rows[None]["id"] == 4
    assert t2.filter(F.col("url").isNotNull()).groupBy("url").count().filter("count > 1").count() == 0
    # case 29: applying the same batch again changes nothing but updated_at; NULL-url rows are added, stored ones kept
    t3 = M.upsert(t2, b2, "2025-06-03 12:00:00").checkpoint()
    strip = lambda df: sorted(tuple(r) for r in df.filter("url is not null").drop("updated_at").collect())
    assert strip(t3) == strip(t2)
    stored = [r for r in t3.filter("url is null").orderBy("id").collect()]
    assert [(r["id"], r["heading"]) for r in stored] == [(4, "hn"), (5, "hn")]
    assert stored[0] == rows[None]  # the whole row, unchanged


def test_dense_index_distributed(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).cast("string").alias("k")).repartition(5)
    out = M.dense_index(df, ["k"], "n", start=11).collect()
    assert sorted(r["n"] for r in out) == list(range(11, 1011))
    assert [r["k"] for r in sorted(out, key=lambda r: r["n"])] == sorted(r["k"] for r in out)


def test_run_stats_and_last_run(spark):
    # case 31 and 32
    rows = [("dawn", "r1", T0 + dt.timedelta(hours=1), k) for k in ["found"] * 60 + ["scraped"] * 56]
    rows = [(s, r, t, "scraped" if k == "scraped" else "found") for s, r, t, k in rows]
    rows += [("dawn", "r2", T0 + dt.timedelta(hours=5), "scraped")] * 3
    df = spark.createDataFrame(rows, "source string, run_id string, ts timestamp, kind string")
    rs = ST.run_stats(df).withColumn("date", F.to_date("run_start"))
    r1 = rs.filter("run_id = 'r1'").first()
    assert (r1["articles_found"], r1["articles_scraped"], r1["errors"]) == (116, 56, 0)
    last = ST.last_run_stats(rs).collect()
    assert len(last) == 1 and last[0]["run_id"] == "r2" and last[0]["articles_scraped"] == 3


def test_status_counts(spark):
    df = spark.createDataFrame([("r", 200, 10, T0), ("r", 200, 5, T0 + dt.timedelta(seconds=142)),
                                ("r", 429, 1, T0), ("r", 503, 1, T0), ("r", None, 0, T0)],
                               "run string, status int, bytes long, ts timestamp")
    r = ST.status_rollup(df, ["run"]).first()
    assert (r["requests"], r["n_ignored"], r["bytes_in"], r["elapsed_ms"]) == (5, 2, 17, 142000)
    assert {(r["status"], r["n"]) for r in ST.status_counts(df, ["run"]).collect()} == {(200, 2), (429, 1), (503, 1), (None, 1)}


def load(spark, n, version="h", day=1):
    return batch(spark, [(f"{version}{i}", "c" * 50, "a", f"2025-06-0{day}", "k", f"u{i}", f"2025-06-0{day}T01:00:00", "s") for i in n])


def size(path):
    import os

    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_upsert_into_writes_the_batch_only(spark, tmp_dir):
    import os

    path = os.path.join(tmp_dir, "news")
    first = M.upsert_into(spark, path, load(spark, range(2000)), "2025-06-01 12:00:00")
    assert first == {"input_rows": 2000, "inserted": 2000, "updated": 0}
    before = size(path)
    null_row = batch(spark, [("no url", "c", "a", "2025-06-02", "k", None, "2025-06-02T01:00:00", "s")])
    small = load(spark, [3, 5000], "new", 2).unionByName(null_row)
    assert M.upsert_into(spark, path, small, "2025-06-02 12:00:00") == {"input_rows": 3, "inserted": 2, "updated": 1}
    assert size(path) - before < 0.3 * before
    kept = M.read_news(spark, path).filter("url is null").collect()
    M.upsert_into(spark, path, null_row, "2025-06-03 12:00:00")
    t = {r["id"]: r for r in M.read_news(spark, path).collect()}
    assert sorted(t) == list(range(1, 2004)) and t[kept[0]["id"]] == kept[0]
    assert {r["url"]: r["heading"] for r in t.values()}["u3"] == "new3"


def test_compaction_and_replay(spark, tmp_dir):
    import os

    path = os.path.join(tmp_dir, "news")
    for k in range(5):
        M.upsert_into(spark, path, load(spark, range(k, k + 4), f"v{k}-", 1), f"2025-06-0{k + 1} 12:00:00", max_deltas=2, number=k + 1)
    want = sorted(map(tuple, M.read_news(spark, path).collect()))
    assert len(want) == 8 and len(M._parts(spark, path)[1]) <= 2
    M.upsert_into(spark, path, load(spark, range(9)), "2025-06-09 12:00:00", number=4)  # a replayed batch
    assert sorted(map(tuple, M.read_news(spark, path).collect())) == want
    M.compact(spark, path)
    assert sorted(map(tuple, M.read_news(spark, path).collect())) == want and M._parts(spark, path)[1] == []
    os.makedirs(f"{path}/{M.DELTA}00000099")  # a write that crashed before its commit
    assert sorted(map(tuple, M.read_news(spark, path).collect())) == want


def news(spark, path):
    return sorted(map(tuple, M.read_news(spark, path).collect()), key=repr)


def test_batch_loads_and_streams_share_a_table(spark, tmp_dir):
    """A stream's first batches on a table that batch loads have filled are not taken for replays."""
    import os

    path = os.path.join(tmp_dir, "news")
    for k in (1, 2):
        M.upsert_into(spark, path, load(spark, range(k), f"l{k}-"), f"2025-06-0{k} 12:00:00")
    for k in range(3):  # numbers 0..2 of each of two streams
        for s in ("a", "b"):
            got = M.upsert_into(spark, path, load(spark, [f"{s}{k}"], s, 3), "2025-06-03 12:00:00", number=k, stream=s, max_deltas=3)
            assert got == {"input_rows": 1, "inserted": 1, "updated": 0}
    M.upsert_into(spark, path, load(spark, [9], "late"), "2025-06-04 12:00:00", max_deltas=3)
    want = news(spark, path)
    assert {r[6] for r in want} == {"u0", "u1", "u9", *(f"u{s}{k}" for s in "ab" for k in range(3))}
    assert sorted(r[0] for r in want) == list(range(1, 10))
    for s in ("a", "b"):
        for k in range(3):  # every replay, also of batches that compaction has folded away
            assert M.upsert_into(spark, path, load(spark, [f"{s}{k}"], "again", 5), "2025-07-01 12:00:00", number=k, stream=s)["updated"] == 0
    assert news(spark, path) == want
    assert M.upsert_into(spark, path, load(spark, [1], "new"), "2025-07-02 12:00:00", number=0, stream="c")["updated"] == 1


def test_a_crashed_snapshot_keeps_table_and_ledger(spark, tmp_dir):
    import os

    path = os.path.join(tmp_dir, "news")
    M.upsert_into(spark, path, load(spark, range(3)), "2025-06-01 12:00:00", number=4, stream="s")
    want = news(spark, path)
    os.makedirs(f"{path}/{M.SNAPSHOT}00000001")  # compaction that crashed before its commit, with and without its ledger
    assert news(spark, path) == want and M.upsert_into(spark, path, load(spark, [8]), "2025-06-02 12:00:00", number=4, stream="s")["inserted"] == 0
    M.compact(spark, path)
    assert news(spark, path) == want and list(M.read_ledger(spark, path).values()) == [4]
    assert sum(d.startswith(M.LEDGER) for d in os.listdir(path)) == 1


def test_a_second_writer_is_refused(spark, tmp_dir, monkeypatch):
    import os

    import pytest

    path = os.path.join(tmp_dir, "news")
    M.upsert_into(spark, path, load(spark, range(3)), "2025-06-01 12:00:00")
    inner = M.batch_changes

    def slow(*a, **k):  # another run commits while this one is at work
        monkeypatch.setattr(M, "batch_changes", inner)
        M.upsert_into(spark, path, load(spark, [7], "other"), "2025-06-01 13:00:00")
        return inner(*a, **k)

    monkeypatch.setattr(M, "batch_changes", slow)
    with pytest.raises(M.ConcurrentWrite):
        M.upsert_into(spark, path, load(spark, [7, 8], "mine"), "2025-06-01 14:00:00")
    assert {r[6]: r[1] for r in news(spark, path)} == {"u0": "h0", "u1": "h1", "u2": "h2", "u7": "other7"}


def test_upsert_reads_no_bodies_of_the_table(spark, tmp_dir):
    import os

    path = os.path.join(tmp_dir, "news")
    for k in (1, 2, 3):
        M.upsert_into(spark, path, load(spark, range(k)), f"2025-06-0{k} 12:00:00", max_deltas=1 if k == 2 else 9)
    plan = M.read_news(spark, path, ["id", "url", "created_at"])._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan and "content" not in plan


def prose(spark, n, shift=0, day=1, tasks=3):
    """Rows whose bodies do not compress, in several files; every seventh without url, every fifth url twice."""
    i = F.col("id") + shift
    body = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.sha2(F.concat_ws("-", i.cast("string"), k.cast("string")), 256)))
    rows = spark.range(0, n, 1, tasks).select(
        F.concat(F.lit(f"v{day}-"), i.cast("string")).alias("heading"), body.alias("content"), F.lit(None).cast("string").alias("author"),
        F.lit(f"2025-06-0{day}").alias("date"), F.lit("k").alias("category"), F.when(i % 7 != 0, F.concat(F.lit("u"), i.cast("string"))).alias("url"),
        F.lit(f"2025-06-0{day}T01:00:00").alias("processed_at"), F.lit("s").alias("spider_name"))
    older = rows.filter(F.substring("url", -1, 1).isin("0", "5")).withColumns({"processed_at": F.lit("2025-05-01T01:00:00"), "heading": F.lit("older")})
    return M.to_load_rows(rows.unionByName(older))


def disk(path):
    import os

    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path.removeprefix("file:")) for f in fs)


def test_upsert_into_leaves_no_copies_of_bodies(spark, tmp_dir):
    """Neither checkpoints nor shuffle files with the batch's bodies stay behind."""
    import os
    import time

    from inkwell.session import checkpoint_root

    b, path = prose(spark, 2000), os.path.join(tmp_dir, "news")
    bodies = 2000 * 60 * 64 / 2  # hex digits hold half a byte each
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    folders = [checkpoint_root(spark), *local]
    before = sum(map(disk, folders))
    M.upsert_into(spark, path, b, "2025-06-01 12:00:00")
    left = lambda: sum(map(disk, folders)) - before
    until = time.time() + 20
    while left() > 0.5 * bodies and time.time() < until:
        time.sleep(0.5)
    assert left() < 0.5 * bodies < size(path)


def test_read_news_shuffles_no_bodies(spark, tmp_dir):
    import os

    path = os.path.join(tmp_dir, "news")
    for k in (1, 2, 3):
        M.upsert_into(spark, path, load(spark, range(2 * k)), f"2025-06-0{k} 12:00:00", max_deltas=1 if k == 2 else 9)
    assert M._parts(spark, path)[0] and len(M._parts(spark, path)[1]) == 1
    M.upsert_into(spark, path, load(spark, range(3)), "2025-06-04 12:00:00")
    plan = M.read_news(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(url" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_slices_write_the_same_table(spark, tmp_dir, monkeypatch):
    """Ids, winners and outdated rows over several slices and bitmaps, against the frame version."""
    import os

    want = M.empty_news(spark)
    runs = [(load(spark, range(33000)), "2025-06-01 12:00:00"), (prose(spark, 300, 32700, 2), "2025-06-02 12:00:00"),
            (prose(spark, 90, 32750, 3).unionByName(load(spark, [5, 40000], "x", 3)), "2025-06-03 12:00:00")]
    for b, ts in runs:
        want = M.upsert(want, b, ts).checkpoint()
    want = news_of(want)
    for bytes_, n in ((1 << 40, 1), (1, 8)):
        monkeypatch.setattr(M, "SLICE_BYTES", bytes_)
        path = os.path.join(tmp_dir, f"news{n}")
        os.makedirs(f"{path}/{M.PENDING}00000001-crashed")
        os.makedirs(f"{path}/{M.PENDING}00000009-of-another-run")
        for b, ts in runs:
            M.upsert_into(spark, path, b, ts)
        assert news_of(M.read_news(spark, path)) == want
        assert [d for d in os.listdir(path) if d.startswith(M.PENDING)] == [f"{M.PENDING}00000009-of-another-run"]
        M.compact(spark, path)
        assert news_of(M.read_news(spark, path)) == want


def news_of(t):
    """Rows as (id, ...): ids of rows without url are in the order of their digests, so all are fixed."""
    return sorted(map(tuple, t.select("id", "heading", F.md5("content"), "date", "url", "processed_at", "created_at", "updated_at").collect()))


def test_scratch_of_an_upsert_is_gone_before_compaction(spark, tmp_dir, monkeypatch):
    import os

    from inkwell import session

    seen, inner = [], M.compact
    monkeypatch.setattr(M, "compact", lambda *a: (seen.append([p for p in session._SCRATCH if "/upsert-" in p]), inner(*a)))
    before = [p for p in session._SCRATCH if "/upsert-" in p]
    for k in (1, 2):
        M.upsert_into(spark, os.path.join(tmp_dir, "news"), load(spark, range(k)), f"2025-06-0{k} 12:00:00", max_deltas=1)
    assert seen == [before]


def marks_on_disk(spark, state):
    return {(r["k"], r["last_accept_at"]) for r in spark.read.parquet(state).collect()}


def test_seen_state_expires_and_is_pruned(spark, tmp_dir):
    import os

    from inkwell.operators import seen_state as SS

    rnd, h = random.Random(5), dt.timedelta(hours=1)
    rows = [(i, f"k{rnd.randrange(30)}" if i % 9 else None, T0 + dt.timedelta(minutes=rnd.randrange(60 * 24 * 12))) for i in range(500)]
    rows += [(1000, "k1", None)]
    df = spark.createDataFrame(rows, "event_id long, k string, ts timestamp_ntz")
    state, got = os.path.join(tmp_dir, "marks"), set()
    for d in range(0, 12, 4):
        lo, hi = T0 + d * 24 * h, T0 + (d + 4) * 24 * h
        run = df.filter((F.col("ts") >= F.lit(lo)) & (F.col("ts") < F.lit(hi)) | (F.col("ts").isNull() if d == 8 else F.lit(False)))
        for _ in range(1 if d != 4 else 2):  # a repeated run gives the same result
            got |= {r["event_id"] for r in SS.throttle_run(spark, run, state, ["k"], "ts", f"run{d}", 86400, "event_id").collect()}
        assert all(t > lo - 26 * h for _, t in marks_on_disk(spark, state))  # an hour for late rows; whole hours are dropped
    want = {r["event_id"] for r in S.ttl_throttle(df, ["k"], "ts", 86400, "event_id").collect()}
    assert got == want
    live = SS.live_marks(spark, state, df, ["k"], T0 + 11 * 24 * h)
    plan = live._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan and {r["last_accept_at"] for r in live.collect()} <= {t for _, _, t in rows}
    assert SS.expire_marks(spark, state, "2026-01-01") > 0 and not [d for d in os.listdir(state) if d.startswith("hour=")]
    assert SS.live_marks(spark, os.path.join(tmp_dir, "none"), df, ["k"], T0).isEmpty()


def test_seen_frame_expires(spark):
    old = spark.createDataFrame([("s", "a", T0 - dt.timedelta(days=2000)), ("s", "b", T0), ("s", "c", T0 + dt.timedelta(hours=1))],
                                "source string, url string, last_accept_at timestamp")
    new = old.limit(0).withColumnRenamed("last_accept_at", "ts")
    left = S.advance_seen(old, new, ["source", "url"], "ts", expired=F.lit(T0))
    assert [r["url"] for r in left.collect()] == ["c"]
