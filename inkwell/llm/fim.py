"""Fill-in-the-middle transformation with content-defined chunks.

A text is cut into tokens (a word with the white space before it, or white space at
the end), and two cuts drawn from a hash of the document id divide it into prefix,
middle and suffix.  To count tokens and find the cuts, a rolling hash divides the
bytes into chunks at places that depend on the content alone, so copied passages
give equal chunks wherever they stand.  The summary of a chunk (code points, word ends,
whether it begins and ends inside a word) is kept in a cache of the worker, whose
hits are verified by comparing the chunk's bytes.  Summaries combine from left to right:
their running sums give the number of tokens and name the chunk that holds a cut, and
only that chunk is read again.  The cache only saves work; it is emptied beyond
``CACHE_BYTES``, and results never depend on what it holds.

Spark keeps the texts in the JVM: the Python side gets a text and two numbers and returns
the cuts, and the output is assembled by column expressions.

Defined cases: a null text counts as empty; empty texts and texts that hold a marker stay
plain; a null id draws as the id ``null``; repeated rows and ids are rows of their own and
draw alike; a text of any length is read whole, in blocks of ``BLOCK`` bytes; an
empty table gives an empty result; the input's columns come back inside ``row``, so that no
name can clash.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import islice

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import every, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
WINDOW = 16  # bytes under the rolling hash; a power of two, at most MIN_CHUNK
MIN_CHUNK, MAX_CHUNK = 64, 4096
CHUNK_BITS = 8  # a chunk ends where this many top bits of the hash are zero
BLOCK = 1 << 20
CACHE_BYTES = 64 << 20
_FACTOR = 0x9E3779B1
_WORD = re.compile(rb"[^\x20\x09-\x0d]+")
_SPACE = frozenset(b" \t\n\x0b\x0c\r")
_CONT = bytes(range(0x80, 0xC0))
CUTS = "struct<n:long,lo:long,hi:long,prefix_chars:long,middle_chars:long>"


def window_ends(data: bytes) -> list[int]:
    """Positions where the hash of the ``WINDOW`` bytes before them ends a chunk, and a code point begins."""
    import numpy as np

    found = []
    for at in range(0, max(len(data) - WINDOW, 0), BLOCK):
        a = np.frombuffer(data, np.uint8, min(BLOCK + WINDOW, len(data) - at), at)
        h = (a.astype(np.uint32) + np.uint32(1)) * np.uint32(_FACTOR)
        width = 1
        while width < WINDOW:  # the hash of 2w bytes from the hashes of two runs of w
            h = h[:-width] * np.uint32(pow(_FACTOR, width, 1 << 32)) + h[width:]
            h ^= h >> np.uint32(15)
            width *= 2
        ends = np.flatnonzero(h[:-1] >> np.uint32(32 - CHUNK_BITS) == 0) + WINDOW
        found += (ends[(a[ends] & 0xC0) != 0x80] + at).tolist()
    return found


def chunk_ends(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``; each is found from its chunk's own bytes."""
    n, ends, start = len(data), [], 0
    marks = window_ends(data)
    while n - start > MIN_CHUNK:
        i = bisect_left(marks, start + MIN_CHUNK)
        end = marks[i] if i < len(marks) else n
        if end - start > MAX_CHUNK:
            end = start + MAX_CHUNK
            while end < n and end > start + MAX_CHUNK - 4 and 0x80 <= data[end] < 0xC0:
                end -= 1
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def summary(chunk: bytes) -> tuple[int, int, bool, bool]:
    """(code points, word ends followed by a space inside, begins with a word, ends with a word)."""
    last = chunk[-1] not in _SPACE
    return len(chunk.translate(None, _CONT)), len(chunk.split()) - last, chunk[0] not in _SPACE, last


class ChunkCache:
    """Summaries by chunk.  The dictionary compares the bytes behind equal hashes, so a hit is the same text."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.held, self.known, self.hits, self.misses = limit, 0, {}, 0, 0

    def get(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        found = self.known.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        self.misses += 1
        found = summary(chunk)
        if self.held > self.limit:
            self.known.clear()
            self.held = 0
        self.known[chunk] = found
        self.held += len(chunk) + 200  # the bytes, and about what the entry itself takes
        return found


class ChunkedText:
    """A text as chunk summaries with their running sums."""

    def __init__(self, data: bytes, cache: ChunkCache):
        self.data, self.ends = data, chunk_ends(data)
        self.points, self.words = [0], [0]  # code points and closed words up to each chunk's end
        self.split = []  # a word closes just where the chunk begins
        start, inside = 0, False
        for end in self.ends:
            points, ends, first, last = cache.get(data[start:end])
            self.split.append(inside and not first)
            self.points.append(self.points[-1] + points)
            self.words.append(self.words[-1] + ends + self.split[-1])
            start, inside = end, last
        # What is left at the end is one more token: an open word, or white space.
        self.n = self.words[-1] + (len(data) > 0)

    def cut(self, token: int) -> tuple[int, int]:
        """(bytes, code points) before the end of the first ``token`` tokens."""
        if token <= 0:
            return 0, 0
        if token >= self.n:
            return len(self.data), self.points[-1]
        k = bisect_left(self.words, token) - 1  # the chunk in which the word closes
        start = self.ends[k - 1] if k else 0
        nth = token - self.words[k] - self.split[k]
        if nth == 0:
            return start, self.points[k]
        chunk = self.data[start:self.ends[k]]
        off = next(islice(_WORD.finditer(chunk), nth - 1, None)).end()
        return start + off, self.points[k] + len(chunk[:off].translate(None, _CONT))


_CACHE: list[ChunkCache] = []


def _cuts(text, h1, h2):
    """Arrow arrays of texts and draws -> struct array of the token count and the two cuts."""
    import pyarrow as pa

    if not _CACHE:
        _CACHE.append(ChunkCache())  # one for the worker's life
    cols: list[list[int]] = [[], [], [], [], []]
    for t, a, b in zip(text, h1.to_pylist(), h2.to_pylist()):
        doc = ChunkedText(t.as_py(), _CACHE[0])
        lo, hi = sorted((a % (doc.n + 1), b % (doc.n + 1)))
        (lo_byte, lo_point), (hi_byte, hi_point) = doc.cut(lo), doc.cut(hi)
        for c, v in zip(cols, (doc.n, lo_byte, hi_byte, lo_point, hi_point - lo_point)):
            c.append(v)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], ["n", "lo", "hi", "prefix_chars", "middle_chars"])


def draws(ident: Column, seed: int = SEED) -> list[Column]:
    """h1 to h4: the first four groups of eight digits of sha256(seed:id) as numbers."""
    sha = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(sha, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = 50,
                   suffix_first: int = 80, seed: int = SEED) -> DataFrame:
    """``row`` (the input's columns) with n, form, prefix_chars, middle_chars and the ``output`` text.

    ``rate`` percent of the texts are rearranged, ``suffix_first`` percent of these as spm.
    """
    cut = F.arrow_udf(_cuts, CUTS)
    h1, h2, h3, h4 = draws(F.col("row")[id_col], seed)
    src = docs.select(F.struct(*every(docs)).alias("row"), text_or_empty(text_col).alias("_text")) \
        .withColumns({"_data": F.col("_text").cast("binary"), "_h1": h1, "_h2": h2, "_h3": h3, "_h4": h4})
    marked = F.lit(False)
    for m in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("_text", F.lit(m))
    form = F.when((F.col("_text") == "") | marked | (F.col("_h3") % 100 >= rate), "plain") \
        .when(F.col("_h4") % 100 < suffix_first, "spm").otherwise("psm")
    src = src.withColumns({"form": form, "_cut": cut("_data", "_h1", "_h2")})
    lo, hi = F.col("_cut.lo").cast("int"), F.col("_cut.hi").cast("int")
    data = F.col("_data")
    head, mid, tail = F.substr(data, F.lit(1), lo), F.substr(data, lo + 1, hi - lo), F.substr(data, hi + 1, F.octet_length(data) - hi)

    def joined(*parts):
        return F.concat(*[F.lit(p).cast("binary") if isinstance(p, str) else p for p in parts])

    moved = F.when(F.col("form") == "psm", joined(PREFIX, head, SUFFIX, tail, MIDDLE, mid)) \
        .otherwise(joined(SUFFIX, tail, PREFIX, head, MIDDLE, mid)).cast("string")
    plain = F.col("form") == "plain"
    return src.select("row", F.col("_cut.n").alias("n"), "form", F.when(~plain, F.col("_cut.prefix_chars")).alias("prefix_chars"),
                      F.when(~plain, F.col("_cut.middle_chars")).alias("middle_chars"),
                      F.when(plain, F.col("_text")).otherwise(moved).alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The exact text, from the output and its form alone (a rearranged text holds each marker once)."""
    parts = F.split(output, "<[PSM]>", -1)
    second, third, last = F.get(parts, F.lit(1)), F.get(parts, F.lit(2)), F.get(parts, F.lit(3))
    return F.when(form == "psm", F.concat(second, last, third)).when(form == "spm", F.concat(third, last, second)).otherwise(output)
