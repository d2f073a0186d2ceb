"""Byte-level BPE encoding and decoding with a fixed rank file.

``encode_words`` is the method in Spark higher-order functions: every distinct
word is an array of byte pieces, and ``aggregate`` folds the merges over it, each
step joining the leftmost pair of the lowest rank.  The rank map is a literal,
stored as an array of small maps by checksum so that a lookup is one index and a
few comparisons.  Words of more than ``FOLD_BYTES`` bytes use the same rule over a
heap, since the fold is quadratic in the length of a word.

``encode`` applies the same rule to whole documents inside the scan's own tasks:
the text is split once, each distinct word is merged once per worker (in a table of
bounded size) and the ids are gathered from it.  It needs no shuffle.  Joining
words encoded by ``encode_words`` back to documents would shuffle every token, or
every document with its share of the vocabulary, which is beyond the disk that
the checks allow (see README); broadcasting the vocabulary has no size bound.

``decode`` concatenates the byte pieces of the ids, natively.

Defined cases: null and empty texts give no ids and decode to no bytes; texts and
words of any length are encoded whole; special token strings are ordinary text;
ids outside the vocabulary decode to nothing; repeated rows are encoded each; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import every

FOLD_BYTES = 128
TABLE_WORDS = 1 << 20
_CELLS = 1 << 13


def load_ranks(path: str) -> dict[bytes, int]:
    """The rank file: one base64 piece and its rank per line (read by the driver)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: repeatedly join the adjacent pair of the lowest rank, leftmost first."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > FOLD_BYTES:
        return _merge_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    get = ranks.get
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges in O(n log n): a heap of (rank, position) over linked pieces."""
    n = len(word)
    start_end = {i: i + 1 for i in range(n)}  # piece start -> end
    prev = {i: i - 1 for i in range(n)}
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, a, end = heapq.heappop(heap)
        b = start_end.get(a)
        if b is None or b >= n or start_end.get(b) != end:
            continue  # one of the two pieces has been merged meanwhile
        start_end[a] = end
        del start_end[b]
        if end < n:
            prev[end] = a
            r = ranks.get(word[a:start_end[end]])
            if r is not None:
                heapq.heappush(heap, (r, a, start_end[end]))
        p = prev[a]
        if p >= 0:
            r = ranks.get(word[p:end])
            if r is not None:
                heapq.heappush(heap, (r, p, end))
    return [ranks[word[a:start_end[a]]] for a in sorted(start_end)]


def _rank_literal(ranks: dict[bytes, int]) -> Column:
    cells: list[dict] = [{} for _ in range(_CELLS)]
    for piece, rank in ranks.items():
        key = piece.hex().upper()
        cells[zlib.crc32(key.encode()) % _CELLS][key] = rank
    return F.from_json(F.lit(json.dumps(cells)), "array<map<string,int>>")


def _fold(word: Column, ranks: Column) -> Column:
    """Ids of a binary word as a fold of merges over its byte pieces."""

    def rank(piece: Column) -> Column:
        return F.try_element_at(F.get(ranks, F.pmod(F.crc32(piece.cast("binary")), F.lit(_CELLS)).cast("int")), piece)

    pieces = F.transform(F.sequence(F.lit(0), F.octet_length(word) - 1), lambda i: F.substring(F.hex(word), i * 2 + 1, F.lit(2)))

    def merge(p: Column, _: Column) -> Column:
        # The lowest (rank, position) pair; the last piece has no right neighbour.
        pairs = F.transform(p, lambda x, i: F.struct(rank(F.concat(x, F.get(p, i + 1))).alias("r"), i.alias("i")))
        best = F.array_min(F.filter(pairs, lambda x: x["r"].isNotNull()))["i"]
        return F.when(best.isNull(), p).otherwise(F.transform(
            F.filter(p, lambda x, i: i != best + 1), lambda x, i: F.when(i == best, F.concat(x, F.get(p, i + 1))).otherwise(x)))

    done = F.aggregate(F.sequence(F.lit(1), F.octet_length(word)), pieces, merge)
    whole = rank(F.hex(word))
    return F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(done, rank))


def encode_words(words: DataFrame, ranks: dict[bytes, int], word_col: str = "word") -> DataFrame:
    """Distinct words with their ids, by a native fold (long words by the heap)."""
    from pyspark.sql.types import ArrayType, IntegerType

    @F.udf(ArrayType(IntegerType()))
    def long_word(w):
        return merge_word(bytes(w), shared.value)

    shared = words.sparkSession.sparkContext.broadcast(ranks)  # fixed size: the vocabulary file
    raw = words.select(word_col).filter(F.col(word_col).isNotNull() & (F.col(word_col) != "")).distinct() \
        .withColumn("_b", F.col(word_col).cast("binary"))
    short = raw.filter(F.octet_length("_b") <= FOLD_BYTES).select(word_col, _fold(F.col("_b"), _rank_literal(ranks)).alias("ids"))
    return short.unionByName(raw.filter(F.octet_length("_b") > FOLD_BYTES).select(word_col, long_word("_b").alias("ids")))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col`` (array of int) in place of the text column."""
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    # Fixed size: the vocabulary file.  A worker process loads it once and keeps its word table beside it.
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": ranks})
    kept = [c for c in docs.columns if c not in (text_col, ids_col)]
    schema = StructType([*[docs.schema[c] for c in kept], StructField(ids_col, ArrayType(IntegerType()))])

    def run(batches):
        from array import array

        import numpy as np
        import pyarrow as pa
        import regex

        worker = shared.value
        table_ranks, find = worker["ranks"], regex.compile(pattern).findall

        class Table(dict):
            """Word -> row of the flat id store, filled on first use."""

            def __init__(self):
                super().__init__()
                self.flat, self.ends = array("i"), array("q", [0])

            def __missing__(self, word):
                self.flat.extend(merge_word(word.encode(), table_ranks))
                self.ends.append(len(self.flat))
                self[word] = row = len(self.ends) - 2
                return row

        table = worker.setdefault("table", Table())
        for b in batches:
            out, sizes = [], []
            for t in b.column(len(kept)):
                words = find(t.as_py() or "")
                rows = np.fromiter(map(table.__getitem__, words), np.int64, len(words))
                ends = np.frombuffer(table.ends, np.int64)
                first, count = ends[rows], ends[rows + 1] - ends[rows]
                total = int(count.sum())
                at = np.arange(total) + np.repeat(first - (np.cumsum(count) - count), count)
                out.append(np.frombuffer(table.flat, np.int32)[at] if total else np.empty(0, np.int32))
                sizes.append(total)
                del ends  # a view would keep the store from growing
                if len(table) > TABLE_WORDS:
                    table = worker["table"] = Table()
            offsets = np.zeros(len(sizes) + 1, np.int64)
            np.cumsum(sizes, out=offsets[1:])
            values = np.concatenate(out) if out else np.empty(0, np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(kept)], ids], names=[*kept, ids_col])

    src = docs.select(*[c.alias(f"_c{i}") for i, c in enumerate(every(docs, kept))], F.col(text_col).alias("_text"))
    return src.mapInArrow(run, schema)


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """Bytes of an id array: the pieces of the vocabulary, concatenated."""
    size = max(ranks.values(), default=-1) + 1
    pieces = [""] * size
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex().upper()
    table = F.split(F.lit(",".join(pieces)), ",")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""))
