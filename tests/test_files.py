"""SRC-3, F-7, U-1, SNK-1, SNK-2, SNK-3, SNK-7, SNK-8, D-9: landing files and exports."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from inkwell.sinks import files as FS
from inkwell.sources.landing import landing_manifest, read_landing


def write(path, name, payload):
    with open(os.path.join(path, name), "w") as f:
        f.write(payload if isinstance(payload, str) else json.dumps(payload, indent=4))


def test_array_landing_files(spark, tmp_dir):
    write(tmp_dir, "dawn_latest_2025-06-03.json", [
        {"heading": "h1", "url": "u1", "content": "c", "spider_name": "dawn_latest", "extra_key": 1},
        {"heading": "h2", "url": "u2"}])
    write(tmp_dir, "tribune_latest_2025-06-03.json", [])
    write(tmp_dir, "notes.txt", "not json")
    df = read_landing(spark, tmp_dir)
    rows = {r["url"]: r for r in df.collect()}
    assert set(rows) == {"u1", "u2"}
    assert rows["u2"]["content"] is None and "extra_key" not in df.columns
    man = {os.path.basename(r["source_file"]): r["rows"] for r in landing_manifest(df).collect()}
    assert man == {"dawn_latest_2025-06-03.json": 2}


def test_broken_file_fails_the_load(spark, tmp_dir):
    write(tmp_dir, "a.json", [{"heading": "h", "url": "u"}])
    write(tmp_dir, "b.json", '[{"heading": "h", "url": ')
    with pytest.raises(Exception):
        read_landing(spark, tmp_dir).collect()


def test_export_overwrite_and_empty_run(spark, tmp_dir):
    items = spark.createDataFrame([("a1", "u1", "a"), ("b1", "u2", "b")], "heading string, url string, spider_name string")
    FS.export_articles(items, tmp_dir, "2025-06-03")
    FS.export_articles(items.filter("spider_name = 'a'").withColumn("heading", F.lit("a2")), tmp_dir, "2025-06-04")
    # second run on 06-03: source a re-exported, source b ran but found nothing (D-9)
    FS.export_articles(items.filter("spider_name = 'a'").withColumn("heading", F.lit("a3")), tmp_dir, "2025-06-03",
                       run_sources=["a", "b"])
    got = sorted((r["spider_name"], str(r["export_date"]), r["heading"]) for r in read_landing(spark, tmp_dir, "lines").collect())
    assert got == [("a", "2025-06-03", "a3"), ("a", "2025-06-04", "a2")]


def test_per_run_export_appends(spark, tmp_dir):
    items = spark.createDataFrame([("h", "u", "a")], "heading string, url string, spider_name string")
    FS.export_articles(items, tmp_dir, "2025-06-03", per_run="2025-06-03T10:00:00")
    FS.export_articles(items, tmp_dir, "2025-06-03", per_run="2025-06-03T11:00:00")
    assert read_landing(spark, tmp_dir, "lines").count() == 2


def test_archive_only_files_read(spark, tmp_dir):
    land, arch = os.path.join(tmp_dir, "land"), os.path.join(tmp_dir, "arch")
    os.makedirs(land)
    write(land, "a.json", [{"heading": "h", "url": "u"}])
    df = read_landing(spark, land)
    manifest = landing_manifest(df)
    manifest.collect()
    write(land, "late.json", [{"heading": "h2", "url": "u2"}])  # lands after the read
    assert FS.archive_files(spark, manifest, land, arch) == ["a.json"]
    assert sorted(os.listdir(land)) == ["late.json"] and os.listdir(arch) == ["a.json"]


def test_archive_keeps_paths_and_fails_loudly(spark, tmp_dir):
    """One task writes one file name into several folders; they stay apart."""
    land, arch = os.path.join(tmp_dir, "la nd"), os.path.join(tmp_dir, "arch")
    items = spark.createDataFrame([("h", "u1", "a b"), ("h", "u2", "c:d"), ("h", "u3", None)], "heading string, url string, spider_name string")
    FS.export_articles(items.coalesce(1), land, "2025-06-03")
    manifest = landing_manifest(read_landing(spark, land, "lines"))
    moved = FS.archive_files(spark, manifest, land, arch)
    assert len(moved) == 3 and len({os.path.basename(m) for m in moved}) == 1
    back = {(r["url"], r["spider_name"]) for r in read_landing(spark, arch, "lines").collect()}
    assert back == {("u1", "a b"), ("u2", "c:d"), ("u3", None)}
    shutil.copytree(arch, land, dirs_exist_ok=True)  # the same files land again: the archive has them
    with pytest.raises(OSError):
        FS.archive_files(spark, manifest, land, arch)


def test_broken_archive_run_is_finished_once(spark, tmp_dir):
    """A run that breaks half-way: its journal is open, the next run archives the rest and loads nothing twice."""
    from inkwell.operators.merge import read_news
    from inkwell.plans.pipeline import etl_flow
    from inkwell.sinks import archive as A

    land, arch, table = (os.path.join(tmp_dir, n) for n in ("land", "arch", "news"))
    items = spark.createDataFrame([("h", f"u{i}", f"s {i % 5}", "2025-06-03T11:00:00") for i in range(20)],
                                  "heading string, url string, spider_name string, processed_at string")
    FS.export_articles(items.coalesce(1), land, "2025-06-03")
    files = sorted(r[0] for r in landing_manifest(read_landing(spark, land, "lines")).collect())
    manifest = spark.createDataFrame([(f,) for f in files], "source_file string")
    assert len(files) == 5
    # Broken after two moves: one clean, one copied but not yet deleted (a store without rename).
    manifest.select(F.col("source_file").alias("file")).write.parquet(arch + "_journal/open/r1")
    from urllib.parse import unquote, urlsplit
    paths = [os.path.relpath(unquote(urlsplit(f).path), land) for f in files]
    for k, p in enumerate(paths[:2]):
        os.makedirs(os.path.dirname(os.path.join(arch, p)))
        (shutil.move, shutil.copy)[k](os.path.join(land, p), os.path.join(arch, p))
    items.limit(0).select(F.col("url").alias("file")).write.parquet(arch + "_journal/open/r0")
    os.remove(arch + "_journal/open/r0/_SUCCESS")  # broke while it wrote its manifest
    write(os.path.join(land, os.path.dirname(paths[0])), "new.json",
          '{"heading": "n", "url": "new", "processed_at": "2025-06-03T12:00:00"}')
    assert etl_flow(spark, land, table, arch, "2025-06-03 12:00:00", layout="lines") == 1  # only the new file
    assert {r["url"] for r in read_news(spark, table).collect()} == {"new"}
    assert read_landing(spark, arch, "lines").count() == 21 and not os.listdir(arch + "_journal/open")
    done = {r["path"]: r["status"] for r in spark.read.parquet(arch + "_journal/done/run=r1").collect()}
    assert [done[p] for p in paths] == ["was moved", "was moved", "moved", "moved", "moved"]
    assert not [f for _, _, fs in os.walk(land) for f in fs if f.startswith("part-")]
    assert A.resume(spark, land, arch) == []


def test_archive_names_what_it_cannot_move(spark, tmp_dir):
    from inkwell.sinks.archive import archive

    land, arch = os.path.join(tmp_dir, "land"), os.path.join(tmp_dir, "arch")
    os.makedirs(land), os.makedirs(arch)
    write(land, "a.json", "1")
    write(land, "b.json", "2")
    write(arch, "b.json", "2")  # an equal file of an earlier run is not this run's copy
    names = ["file://" + os.path.join(land, n) for n in ("a.json", "b.json", "gone.json")]
    with pytest.raises(OSError, match="1 conflict.*1 missing"):
        archive(spark, spark.createDataFrame([(n,) for n in names], "source_file string"), land, arch, run="x")
    assert os.listdir(land) == ["b.json"] and sorted(os.listdir(arch)) == ["a.json", "b.json"]
    assert os.listdir(arch + "_journal/open") == ["x"]
    with pytest.raises(ValueError):
        archive(spark, spark.createDataFrame([("file:///elsewhere/a.json",)], "source_file string"), land, arch + "2")
    empty = archive(spark, spark.createDataFrame([], "source_file string"), land, arch + "3")
    assert empty.count() == 0


def test_append_and_create(spark, tmp_dir):
    path = os.path.join(tmp_dir, "news")
    FS.create_news(spark, path)
    FS.create_news(spark, path)  # idempotent
    assert spark.read.parquet(path).count() == 0
    rows = spark.read.parquet(path).limit(0)
    FS.append_table(rows, path)
    assert spark.read.parquet(path).count() == 0


def test_log_lines(spark, tmp_dir):
    from inkwell.sources.logs import log_rollup, read_logs

    with open(os.path.join(tmp_dir, "dawn_latest_2025-06-03.log"), "w") as f:
        f.write("2025-06-03 07:15:27,308 - dawn_latest - INFO - Found 28 articles in the feed\n")
        f.write("2025-06-03 07:15:28,001 - dawn_latest - INFO - Scraped article: X - Y from https://x\n")
        f.write("2025-06-03 07:15:29,500 - dawn_latest - WARNING - Could not parse date: 2025-06-03 07:26:44+05:00\n")
        f.write("free text line\n")
    logs = read_logs(spark, tmp_dir)
    rows = logs.collect()
    free = [r for r in rows if r["line"] == "free text line"][0]
    assert free["source"] is None and free["ts"] is None
    first = [r for r in rows if r["message"] == "Found 28 articles in the feed"][0]
    assert first["level"] == "INFO" and str(first["ts"]) == "2025-06-03 07:15:27.308000"
    scraped = [r for r in rows if r["message"] and r["message"].startswith("Scraped")][0]
    assert scraped["message"] == "Scraped article: X - Y from https://x"
    roll = {(r["source"], r["level"]): r for r in log_rollup(logs).collect()}
    assert roll[("dawn_latest", "INFO")]["lines"] == 2 and roll[("dawn_latest", "INFO")]["scraped"] == 1


def test_etl_flow_entry_b(spark, tmp_dir):
    from inkwell.operators.merge import read_news
    from inkwell.plans.pipeline import etl_flow

    land, table, arch = (os.path.join(tmp_dir, n) for n in ("land", "news", "arch"))
    os.makedirs(land)
    assert etl_flow(spark, land, table, arch, "2025-06-03 12:00:00") == 0  # case 34: empty landing
    assert not os.path.exists(table)
    write(land, "dawn_latest_2025-06-03.json", [
        {"heading": "h1", "content": "c1", "url": "u1", "date": "2025-06-03T10:00:00+05:00",
         "processed_at": "2025-06-03T11:00:00", "spider_name": "dawn_latest"},
        {"heading": "h2", "content": "c2", "url": "u2", "processed_at": "2025-06-03T11:00:00",
         "spider_name": "dawn_latest"}])
    write(land, "tribune_latest_2025-06-03.json", [
        {"heading": "h1b", "content": "c1b", "url": "u1", "processed_at": "2025-06-03T11:30:00",
         "spider_name": "tribune_latest"}])
    assert etl_flow(spark, land, table, arch, "2025-06-03 12:00:00") == 3  # input rows, as the reference returns
    rows = {r["url"]: r for r in read_news(spark, table).collect()}
    assert set(rows) == {"u1", "u2"} and rows["u1"]["heading"] == "h1b"  # case 27: one row per url
    assert os.listdir(land) == [] and sorted(os.listdir(arch)) == ["dawn_latest_2025-06-03.json",
                                                                   "tribune_latest_2025-06-03.json"]


def test_stats_last_run_of_day_wins(spark, tmp_dir):
    # SNK-5 / case 31: rewriting a (source, date) replaces it; other days stay
    import datetime as dt

    schema = "source string, date date, articles_found long, articles_scraped long, errors long, reason string"
    first = spark.createDataFrame([("dawn", dt.date(2025, 6, 3), 28, 16, 0, "finished"),
                                   ("dawn", dt.date(2025, 6, 2), 30, 27, 0, "finished")], schema)
    FS.write_stats(first, tmp_dir)
    second = spark.createDataFrame([("dawn", dt.date(2025, 6, 3), 16, 16, 0, "finished")], schema)
    FS.write_stats(second, tmp_dir)
    got = sorted((str(r["date"]), r["articles_found"]) for r in spark.read.json(tmp_dir).collect())
    assert got == [("2025-06-02", 30), ("2025-06-03", 16)]


def test_feed_files_are_listed_by_few_tasks(spark, tmp_dir):
    from inkwell.sources import feed_files as FF

    path, conf = os.path.join(tmp_dir, "feeds"), "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    for n in range(40):
        os.makedirs(f"{path}/source=a/feed_no={n}")
        with open(f"{path}/source=a/feed_no={n}/f.xml", "w") as f:
            f.write(f"<rss><channel><item><title>{n}</title></item></channel></rss>")
    before, tracker = spark.conf.get(conf), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("feed listing", "")
    try:
        items = FF.read_feed_files(spark, path)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in tracker.getJobIdsForGroup("feed listing") for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(tracker.getStageInfo(s).numTasks for s in stages) <= 2 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(conf) == before
    assert {(r["feed_no"], r["title"]) for r in items.collect()} == {(n, str(n)) for n in range(40)}
