"""SNK-7: landing files are moved to the archive by Spark tasks, with a journal.

``archive`` first writes the list of files to move (the manifest of what was read and
loaded) to ``<dest>_journal/open/<run>``, then moves them in tasks that each take a
share of the list, and records what became of every file in
``<dest>_journal/done/run=<run>``.  No file list reaches the driver.

A run that breaks at any point leaves its manifest open.  ``resume`` finishes
open runs: a file that the broken run had moved is only recorded, the others are moved.
A repeated task attempt finds the same.  Stores without a rename copy and then delete; a copy
cut off before the delete is recognised in a repeated attempt by its equal bytes.

A file that cannot be moved (``conflict``: the archive has another file of that path;
``missing``: it is in neither place; ``outside``: it is not below the landing folder) raises once the
others are moved, because it would be loaded again; the run stays open.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.sinks.files import _fs, delete_path

FILES_PER_TASK = 1000
_BLOCK = 1 << 20
_BAD = ("conflict", "missing", "outside")
_SCHEMES = {"s3a": "s3", "s3n": "s3"}  # Hadoop's names of a store -> Arrow's


def _parts(spark: SparkSession, path: str) -> tuple[str, str, str]:
    """(scheme, authority, decoded path) of a folder."""
    fs, p, _ = _fs(spark, path)
    uri = fs.makeQualified(p).toUri()
    return uri.getScheme() or "file", uri.getAuthority() or "", uri.getPath().rstrip("/")


def _store(scheme: str, authority: str):
    """Arrow's file system of a store, and what stands before a path in it."""
    from pyarrow import fs

    if scheme == "file":
        return fs.LocalFileSystem(), ""
    store, root = fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{authority}/")
    return store, root.rstrip("/")


def _equal(store, a: str, b: str) -> bool:
    with store.open_input_stream(a) as x, store.open_input_stream(b) as y:
        while True:
            p, q = x.read(_BLOCK), y.read(_BLOCK)
            if p != q or not p:
                return p == q


def _move(store, src: str, dst: str, repeated: bool) -> str:
    from pyarrow.fs import FileType

    here, there = (i.type == FileType.File for i in store.get_file_info([src, dst]))
    if here and there:
        if not (repeated and _equal(store, src, dst)):
            return "conflict"
        store.delete_file(src)
        return "was moved"
    if not here:
        return "was moved" if there else "missing"
    store.create_dir(dst.rpartition("/")[0], recursive=True)
    store.move(src, dst)
    return "moved"


def _mover(land, dest, resumed: bool):
    def run(frames):
        import pandas as pd
        from pyspark import TaskContext
        from urllib.parse import unquote, urlsplit

        store, root = _store(*dest[:2])
        repeated = resumed or TaskContext.get().attemptNumber() > 0
        for frame in frames:
            out = []
            for name in frame["file"]:
                at = urlsplit(name)  # paths in the metadata column are URIs
                path, base = unquote(at.path), land[2] + "/"
                if (at.scheme, at.netloc) != land[:2] or land[:2] != dest[:2] or not path.startswith(base):
                    out.append((name, None, "outside"))
                    continue
                rel = path[len(base):]
                src, dst = root + path, f"{root}{dest[2]}/{rel}"
                if land[0] == "file":  # Hadoop's checksum file goes along
                    crc = ["{0}/.{2}.crc".format(*p.rpartition("/")) for p in (src, dst)]
                    if _has(store, src) and not _has(store, dst) and _has(store, crc[0]):
                        store.create_dir(crc[1].rpartition("/")[0], recursive=True)
                        store.move(*crc)
                out.append((name, rel, _move(store, src, dst, repeated)))
            yield pd.DataFrame(out, columns=["file", "path", "status"])

    return run


def _has(store, path: str) -> bool:
    from pyarrow.fs import FileType

    return store.get_file_info(path).type == FileType.File


def _journal(dest_dir: str) -> str:
    return dest_dir.rstrip("/") + "_journal"


def _carry_out(spark: SparkSession, run: str, landing_dir: str, dest_dir: str, resumed: bool) -> DataFrame:
    todo = spark.read.parquet(f"{_journal(dest_dir)}/open/{run}")
    n = todo.count()
    tasks = max(1, min(n, max(spark.sparkContext.defaultParallelism, -(-n // FILES_PER_TASK))))
    moves = todo.repartition(tasks, "file").mapInPandas(
        _mover(_parts(spark, landing_dir), _parts(spark, dest_dir), resumed), "file string, path string, status string")
    done = f"{_journal(dest_dir)}/done/run={run}"
    moves.write.mode("overwrite").parquet(done)
    out = spark.read.parquet(done)
    bad = out.filter(F.col("status").isin(*_BAD)).groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.min("file").alias("one")).orderBy("status").collect()  # a row per status
    if bad:
        text = "; ".join(f"{r['n']} {r['status']} (such as {r['one']})" for r in bad)
        error = ValueError if {r["status"] for r in bad} == {"outside"} else OSError
        raise error(f"cannot move files of {landing_dir} to {dest_dir}: {text}")
    delete_path(spark, f"{_journal(dest_dir)}/open/{run}")
    return out


def archive(spark: SparkSession, manifest: DataFrame, landing_dir: str, dest_dir: str, file_col: str = "source_file",
            run: str | None = None) -> DataFrame:
    """Move the files listed in ``manifest`` from ``landing_dir`` to the same paths below ``dest_dir``.

    Returns (file, path, status), one row per file, as recorded in the journal.  Call it once the
    rows of the files are safely stored.  ``run`` names the journal entry.
    """
    run = run or uuid.uuid4().hex
    manifest.select(F.col(file_col).alias("file")).distinct().write.parquet(f"{_journal(dest_dir)}/open/{run}")
    return _carry_out(spark, run, landing_dir, dest_dir, resumed=False)


def resume(spark: SparkSession, landing_dir: str, dest_dir: str) -> list[str]:
    """Finish the runs of ``dest_dir`` that broke while they moved files; returns their names.

    A run that broke while it wrote its manifest has moved nothing and is dropped: its
    files are still in the landing folder.
    """
    fs, p, jvm = _fs(spark, _journal(dest_dir) + "/open")
    if not fs.exists(p):
        return []
    runs = sorted(s.getPath().getName() for s in fs.listStatus(p))
    for run in runs:
        if not fs.exists(jvm.org.apache.hadoop.fs.Path(p, run + "/_SUCCESS")):
            delete_path(spark, f"{_journal(dest_dir)}/open/{run}")
            continue
        _carry_out(spark, run, landing_dir, dest_dir, resumed=True)
    return runs
