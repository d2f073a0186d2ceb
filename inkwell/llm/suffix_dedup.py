"""Removal of repeated byte strings by external induced suffix sorting.

A byte goes if some string of ``length`` bytes that covers it starts anywhere else
in the corpus, in the same document too.

1. Anchors.  Every window of ``length`` bytes has the leftmost smallest hash of its
   ``GRAM``-byte pieces as anchor.  Equal windows have equal anchors, so windows of
   one document that share an anchor form a fragment, and only windows whose anchor
   piece has the same hash can be equal.  Fragments whose anchor hash occurs once in
   the corpus cannot repeat and are dropped.  The anchor hash is the shard key.
2. Fragments.  The rest are cut out of the texts.  Equal fragments (128-bit hash)
   are stored once with their occurrences; a fragment that occurs twice repeats as a
   whole.  That also levels hot passages: however often one is copied, its shard
   holds it once.
3. Suffix sort.  Each shard streams its different fragments into a disk-backed text
   and sorts its suffixes with ``induced_sort``; windows whose common prefix with a
   neighbour reaches ``length`` are repeated.  A shard may be far larger than memory.
4. Cover.  Repeated windows go back to their occurrences, and each document removes
   the union of their bytes.

Intermediate tables are Parquet in the session's shared scratch folder; nothing is
broadcast or collected.

Defined cases: a null text counts as empty; texts shorter than ``length`` have no
window; repeated rows are documents of their own, so their texts repeat; matches
never cross documents; texts of any length are handled in pieces; null ids are ordinary; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import induced_sort
from inkwell.llm.common import hash128
from inkwell.session import scratch_dir

LENGTH = 200
GRAM = 64
_SEGMENT = 4 << 20  # bytes hashed at once; positions take 24 bits of a window's sort key
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


class AnchorHasher:
    """Anchors of all windows of concatenated texts, by a vectorised rolling hash."""

    def __init__(self, length: int, gram: int):
        import numpy as np

        self.length, self.gram, self.reach = length, gram, length - gram + 1
        size = _SEGMENT + 2 * length
        self.table = np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.up, self.down = (np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, b, np.uint64)])
                              for b in (_BASE, pow(_BASE, -1, 1 << 64)))

    def anchors(self, data: bytes, ends: list[int]):
        """(start, windows, key) of every fragment of the texts that end at ``ends`` in ``data``."""
        import numpy as np

        n, gram, reach = len(data), self.gram, self.reach
        if n < self.length:
            return (np.empty(0, np.int64),) * 3
        t = np.frombuffer(data, np.uint8)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[t] * self.up[:n], out=sums[1:])
        h = (sums[gram:] - sums[:-gram]) * self.down[:n - gram + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        low = np.uint64((1 << 24) - 1)
        least, step = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1
        while step * 2 <= reach:
            least, step = np.minimum(least[:-step], least[step:]), step * 2
        if step < reach:
            least = np.minimum(least[:len(least) - (reach - step)], least[reach - step:])
        at = (least & low).astype(np.int64)
        inside = np.ones(len(at), bool)
        for e in ends:
            inside[max(0, e - self.length + 1):e] = False
        start = np.flatnonzero(inside)
        at = at[start]
        cut = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.empty(0, np.int64)
        return start[cut], np.diff(np.r_[cut, len(start)]), h[at[cut]].view(np.int64)


def _anchor_rows(length: int, gram: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        hasher = AnchorHasher(length, gram)

        def flush(rows, texts):
            """One output row per text (or piece of a long text) that has a window."""
            ends = np.cumsum([len(x[1]) for x in texts])
            start, windows, key = hasher.anchors(b"".join(x[1] for x in texts), ends.tolist())
            begins = np.r_[0, ends[:-1]]
            which = np.searchsorted(ends, start, side="right")
            bounds = np.searchsorted(which, np.arange(len(texts) + 1)).astype(np.int32)
            local = (start - begins[which] + np.array([x[0] for x in texts], np.int64)[which]).astype(np.int64)
            lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(v)) for v in (local, windows.astype(np.int32), key)]
            ids = [pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)]
            piece = pa.array([x[0] for x in texts], pa.int64())
            return pa.RecordBatch.from_arrays([*ids, piece, *lists], names=["_k1", "_k2", "piece", "starts", "counts", "keys"])

        rows, texts, held = [], [], 0
        for b in batches:
            for k1, k2, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                text = text.as_py() or b""
                step = _SEGMENT - length + 1
                # A text longer than a segment is cut so that every window lies in one piece.
                pieces = [(i, text[i:i + _SEGMENT]) for i in range(0, max(1, len(text) - length + 1), step)]
                for at, piece in pieces:
                    if len(piece) < length:
                        continue
                    if held + len(piece) > _SEGMENT and texts:
                        yield flush(rows, texts)
                        rows, texts, held = [], [], 0
                    rows.append((k1, k2))
                    texts.append((at, piece))
                    held += len(piece)
        if texts:
            yield flush(rows, texts)

    return run


def _fragment_rows(length: int):
    names = ["_k1", "_k2", "start", "windows", "key", "f1", "f2", "body"]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        digest_of, known = xxhash.xxh3_128_digest, set()
        for b in batches:
            lists = [b.column(i) for i in (3, 4, 5)]
            ends = lists[0].offsets.to_numpy()
            start, windows, key = (x.values.to_numpy() for x in lists)
            stop = start + windows + (length - 1)
            for row in range(b.num_rows):
                text = b.column(2)[row].as_py()
                for lo in range(ends[row], ends[row + 1], 20_000):  # bounded output batches
                    hi = min(lo + 20_000, ends[row + 1])
                    bodies = [text[i:j] for i, j in zip(start[lo:hi].tolist(), stop[lo:hi].tolist())]
                    digests = list(map(digest_of, bodies))
                    if len(known) >= 1 << 20:
                        known.clear()
                    for i, d in enumerate(digests):  # a task stores a body once; shards drop what several tasks store
                        if d in known:
                            bodies[i] = None
                        else:
                            known.add(d)
                    f = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                    n = hi - lo
                    ids = [pa.array(np.full(n, b.column(i)[row].as_py(), np.int64)) for i in (0, 1)]
                    yield pa.RecordBatch.from_arrays(
                        [*ids, pa.array(start[lo:hi]), pa.array(windows[lo:hi].astype(np.int32)), pa.array(key[lo:hi]),
                         pa.array(f[:, 0].copy()), pa.array(f[:, 1].copy()), pa.array(bodies, pa.binary())], names=names)

    return run


def _shard_rows(length: int, memory: int):
    """Repeated windows (f1, f2, lo, hi) of one shard, whose rows come sorted by (key, f1, f2)."""

    def run(batches):
        import tempfile

        import numpy as np
        import pyarrow as pa

        with tempfile.TemporaryFile() as spool, tempfile.TemporaryFile() as table:
            size = 0

            def write(f1, f2, body):
                nonlocal size
                spool.write((np.frombuffer(body, np.uint8).astype(np.uint16) + np.uint16(1)).tobytes() + b"\0\0")
                table.write(np.array([f1, f2, size, len(body)], np.int64).tobytes())
                size += len(body) + 1

            # Fragments of one anchor hash are written once there is a second, different one;
            # a lone one has nothing to be compared with.
            last_key, last, first = None, None, None
            for b in batches:
                for key, f1, f2, body in zip(*(b.column(i).to_pylist() for i in range(4))):
                    if key != last_key:
                        last_key, last, first = key, (f1, f2), body
                    elif (f1, f2) != last:
                        if first is not None:
                            write(*last, first)
                            first = None
                        last = (f1, f2)
                        write(f1, f2, body)
            if not size:
                return
            spool.flush()
            table.flush()
            codes = np.memmap(spool, np.uint16, "r", shape=(size,))
            flag = induced_sort.repeated_windows(codes, length, memory)
            table.seek(0)
            while part := table.read(32 * 65536):
                out = [[], [], [], []]
                for f1, f2, at, n in np.frombuffer(part, np.int64).reshape(-1, 4).tolist():
                    marks = flag[at:at + n]
                    if not marks.any():
                        continue
                    edge = np.flatnonzero(np.diff(np.r_[0, marks, 0].astype(np.int8)))
                    for lo, hi in edge.reshape(-1, 2).tolist():
                        for c, v in zip(out, (f1, f2, lo, hi)):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["f1", "f2", "lo", "hi"])

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    k1, k2 = hash128(F.col(id_col), F.col(text_col))
    return docs.select(F.col(id_col).alias("_id"), k1.alias("_k1"), k2.alias("_k2"), F.col(text_col).cast("binary").alias("_text"))


def _free(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished phases."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _write_anchors(texts: DataFrame, path: str, length: int, gram: int) -> None:
    """Anchors of every text (or piece of a long one); the row number is stored, so later reads agree."""
    texts.filter(F.octet_length("_text") >= length).mapInArrow(
        _anchor_rows(length, gram), "_k1 long, _k2 long, piece long, starts array<long>, counts array<int>, keys array<long>") \
        .withColumn("_r", F.monotonically_increasing_id()).write.parquet(path)


def _write_shared(anchors: DataFrame, path: str) -> None:
    """Anchor hashes that occur more than once, rows that repeat a document included."""
    anchors.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("_n")) \
        .filter("_n > 1").select("key").write.parquet(path)


def _write_found(anchors: DataFrame, shared: DataFrame, path: str) -> None:
    """Per document the fragments whose anchor is shared, as parallel arrays.

    ``shared`` is a stored table, so the join has an exchange of its own on either side
    and AQE can split a hot anchor.  Of repeated rows one stands for all.
    """
    one = anchors.groupBy("_k1", "_k2", "piece").agg(F.min("_r").alias("_r")).select("_r", "_k1", "_k2")
    place = F.shiftleft(F.col("a.starts"), 16) + F.col("a.counts")  # a fragment has fewer windows than 2**16
    flat = anchors.select("_r", F.explode(F.arrays_zip("starts", "counts", "keys")).alias("a")) \
        .select("_r", place.alias("place"), F.col("a.keys").alias("key"))
    rows = flat.join(shared, "key", "left_semi").groupBy("_r").agg(F.collect_list(F.struct("place", "key")).alias("f"))
    rows.join(one, "_r").groupBy("_k1", "_k2").agg(F.flatten(F.collect_list("f")).alias("f")) \
        .select("_k1", "_k2", F.transform("f.place", lambda p: F.shiftright(p, 16)).alias("starts"),
                F.transform("f.place", lambda p: p.bitwiseAND(0xFFFF)).alias("counts"), F.col("f.key").alias("keys")).write.parquet(path)


def _write_fragments(texts: DataFrame, found: DataFrame, path: str, length: int) -> None:
    texts.join(found, ["_k1", "_k2"]).select("_k1", "_k2", "_text", "starts", "counts", "keys").mapInArrow(
        _fragment_rows(length), "_k1 long, _k2 long, start long, windows int, key long, f1 long, f2 long, body binary") \
        .write.parquet(path)


def _write_repeated(occ: DataFrame, path: str, length: int, memory: int) -> None:
    """Repeated windows (f1, f2, lo, hi): of fragments that occur again, and by the suffix sort."""
    part = occ.filter(F.col("body").isNotNull()).select("key", "f1", "f2", "body") \
        .repartition("key").sortWithinPartitions("key", "f1", "f2") \
        .mapInArrow(_shard_rows(length, memory), "f1 long, f2 long, lo long, hi long")
    whole = occ.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("_n"), F.max("windows").cast("long").alias("hi")) \
        .filter("_n > 1").select("f1", "f2", F.lit(0).cast("long").alias("lo"), "hi")
    part.unionByName(whole).write.parquet(path)


def repeated_runs(keyed: DataFrame, root: str, length: int = LENGTH, gram: int = GRAM,
                  memory: int = induced_sort.MEMORY) -> DataFrame:
    """(_k1, _k2, runs): array of [lo, hi) window starts that repeat, per document."""
    spark, texts = keyed.sparkSession, keyed.select("_k1", "_k2", "_text")

    def read(name: str) -> DataFrame:
        _free(spark)  # what the phase before has shuffled is not needed any more
        return spark.read.parquet(f"{root}/{name}")

    _write_anchors(texts, f"{root}/anchors", length, gram)
    _write_shared(read("anchors"), f"{root}/shared")
    _write_found(read("anchors"), read("shared"), f"{root}/found")
    _write_fragments(texts, read("found"), f"{root}/fragments", length)
    _write_repeated(read("fragments"), f"{root}/repeated", length, memory)
    occ, repeated = read("fragments"), read("repeated")
    hits = occ.select("_k1", "_k2", "start", "f1", "f2").join(repeated, ["f1", "f2"])
    return hits.groupBy("_k1", "_k2").agg(F.array_sort(F.collect_set(F.struct(
        (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi")))).alias("runs"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, memory: int = induced_sort.MEMORY) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``removed`` (maximal byte spans) and ``kept`` (the bytes left)."""
    if not 0 < gram <= length < 1 << 16:
        raise ValueError("0 < gram <= length < 65536")
    keyed = _keyed(docs, id_col, text_col)
    runs = repeated_runs(keyed, scratch_dir(docs.sparkSession, "suffix"), length, gram, memory)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        span = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
        for b in batches:
            sizes, removed, kept = [], [], []
            for text, found in zip(b.column(1), b.column(2)):
                text = text.as_py() or b""
                merged: list[list[int]] = []
                for r in found.as_py() or ():
                    lo, hi = r["lo"], r["hi"] - 1 + length
                    if merged and lo <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], hi)
                    else:
                        merged.append([lo, hi])
                at, left = 0, []
                for lo, hi in merged:
                    left.append(text[at:lo])
                    at = hi
                left.append(text[at:])
                sizes.append(len(text))
                removed.append([{"lo": lo, "hi": hi} for lo, hi in merged])
                kept.append(b"".join(left))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(removed, span),
                                              pa.array(kept, pa.binary())], names=["_id", "n_bytes", "removed", "kept"])

    out = keyed.join(runs, ["_k1", "_k2"], "left").select("_id", "_text", "runs").mapInArrow(
        run, f"_id {id_type}, n_bytes long, removed array<struct<lo:bigint,hi:bigint>>, kept binary")
    return out.withColumnRenamed("_id", id_col)
