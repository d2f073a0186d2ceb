"""Vector code compression: product codes over integer vectors, by value dictionaries.

Every component becomes an integer, a vector is cut into equal parts, and each part is
replaced by the index of its nearest codebook entry.  The vectors are stored once as blocks
of at most ``BLOCK`` rows: for each dimension a dictionary of the distinct integers in the
block, and a code per row.  To compare a block with a codebook, the squared difference
of every dictionary value to every entry is tabulated, once per dimension; the distances of
all parts are then sums of gathered table rows, without a multiplication per vector.

A round is one pass over the blocks.  Each task adds up its parts per entry and returns at most
parts x entries rows, Spark sums them, and the driver receives one row per entry:
``parts * entries`` rows of integers, whatever the size of the table.  Integers
make every result independent of the order of rows and tasks.

Defined cases: a vector that is null, or holds a null, NaN or infinite component, is
dropped.  The first row by id (null ids last, ties by the vector) whose length is a positive multiple
of ``parts`` fixes the dimension; vectors of another length, empty ones among them, are dropped too.
Repeated rows and ids are rows of their own.  Fewer rows than entries give a codebook of that many entries;
an empty table gives an empty result.  Components beyond ``LIMIT`` after scaling
are an error, because sums of their squares could leave 64 bits.  Carried columns come back inside
``row``, so that no name can clash.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from inkwell.llm.common import checkpoint, every

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BLOCK = 4096
LIMIT = 1 << 26


def integer_vector(vec: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of all components; null if the vector is null or a component is null or not finite."""
    x = F.transform(vec, lambda c: c.cast("double"))
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(vec.isNotNull() & whole, F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long")))


def make_blocks(batches, dim: int):
    """(carried struct, integer vector) rows -> blocks: carried rows, one value dictionary per dimension, codes by dimension."""
    import numpy as np
    import pyarrow as pa

    for b in batches:
        for at in range(0, b.num_rows, BLOCK):
            part = b.slice(at, BLOCK)
            n = part.num_rows
            v = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, dim)
            if n and max(-int(v.min()), int(v.max())) > LIMIT:
                raise ValueError(f"a scaled component lies beyond {LIMIT}")
            values, codes = [], np.empty((dim, n), np.uint16)
            for j in range(dim):
                distinct, codes[j] = np.unique(v[:, j], return_inverse=True)
                values.append(distinct)
            ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
            inner = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values)))
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.concat_arrays([part.column(0)])),
                 pa.ListArray.from_arrays(pa.array([0, dim], pa.int32()), inner), pa.array([codes.tobytes()], pa.binary())],
                names=["carried", "values", "codes"])


def read_blocks(batches):
    """(carried rows, value dictionaries, codes) of every stored block."""
    import numpy as np

    for b in batches:
        for i in range(b.num_rows):
            carried = b.column(0)[i].values
            values = [np.asarray(d.values.to_numpy(zero_copy_only=False)) for d in b.column(1)[i].values]
            yield carried, values, np.frombuffer(b.column(2)[i].as_py(), np.uint16).reshape(len(values), len(carried))


def nearest(values: list, codes, book):
    """Nearest entry and squared distance of one part of every row; ties go to the lower index.

    ``values`` and ``codes`` belong to the part's dimensions; ``book`` is (entries, width).
    """
    import numpy as np

    book = np.asarray(book, np.int64)
    span = max([1, *(max(int(v.max()), int(book.max())) - min(int(v.min()), int(book.min())) for v in values)])
    kind = np.int32 if span * span * len(values) < 1 << 31 else np.int64
    total = np.zeros((codes.shape[1], len(book)), kind)
    for j, v in enumerate(values):
        table = ((v[:, None] - book[:, j]) ** 2).astype(kind)  # every distinct integer against all entries
        total += table[codes[j]]
    best = total.argmin(axis=1)
    return best, total[np.arange(len(best)), best].astype(np.int64)


def part_sums(batches, books):
    """Counts and component sums of the parts nearest to each entry, over all blocks of a task."""
    import numpy as np
    import pyarrow as pa

    parts, entries, width = len(books), len(books[0]), len(books[0][0])
    counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
    for _, values, codes in read_blocks(batches):
        for p in range(parts):
            own, c = values[p * width:(p + 1) * width], codes[p * width:(p + 1) * width]
            best, _ = nearest(own, c, books[p])
            counts[p] += np.bincount(best, minlength=entries)
            np.add.at(sums[p], best, np.stack([v[k] for v, k in zip(own, c)], axis=1))
    p, e = np.nonzero(counts)
    flat = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * width), pa.array(sums[p, e].reshape(-1)))
    yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e]), flat],
                                     names=["part", "entry", "n", "sums"])


def assign(batches, books):
    """The carried row, the hexadecimal code and the squared error of every vector."""
    import numpy as np
    import pyarrow as pa

    parts, width = len(books), len(books[0][0])
    digits = np.array([f"{i:02x}" for i in range(len(books[0]))])
    for carried, values, codes in read_blocks(batches):
        code, error = None, np.zeros(len(carried), np.int64)
        for p in range(parts):
            best, d = nearest(values[p * width:(p + 1) * width], codes[p * width:(p + 1) * width], books[p])
            error += d
            code = digits[best] if code is None else np.char.add(code, digits[best])
        yield pa.RecordBatch.from_arrays([carried, pa.array(code.tolist(), pa.string()), pa.array(error)], names=["row", "code", "error"])


def compress_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", carry: list[str] | None = None,
                     parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list]:
    """(``row`` with the ``carry`` columns, code, error) of every kept vector, and the final codebooks
    as nested lists [part][entry][position]; two hexadecimal digits a part, so at most 256 entries."""
    if not 1 <= entries <= 256:
        raise ValueError("a code digit pair names at most 256 entries")
    carry = carry or [c for c in vectors.columns if c != vec_col]
    ident = every(vectors, [id_col])[0]
    src = vectors.select(F.struct(*every(vectors, carry)).alias("row"), ident.alias("_id"),
                         integer_vector(every(vectors, [vec_col])[0], scale).alias("_v")).filter("_v is not null")
    order = [F.col("_id").asc_nulls_last(), F.col("_v")]
    usable = src.filter((F.size("_v") > 0) & (F.size("_v") % parts == 0))
    first = usable.orderBy(*order).select(F.size("_v")).first()
    out = StructType([StructField("row", src.schema["row"].dataType), StructField("code", StringType()), StructField("error", LongType())])
    if first is None:
        return vectors.sparkSession.createDataFrame([], out), []
    dim = first[0]
    kept = src.filter(F.size("_v") == dim)
    width = dim // parts
    start = [r[0] for r in kept.orderBy(*order).limit(entries).select("_v").collect()]  # at most ``entries`` rows
    books = [[v[p * width:(p + 1) * width] for v in start] for p in range(parts)]
    stored = StructType([StructField("carried", ArrayType(out["row"].dataType)), StructField("values", ArrayType(ArrayType(LongType())))]) \
        .add("codes", "binary")
    blocks = checkpoint(kept.select("row", "_v").mapInArrow(lambda b: make_blocks(b, dim), stored))
    for _ in range(rounds):
        now = books
        sums = blocks.mapInArrow(lambda b: part_sums(b, now), "part int, entry int, n long, sums array<long>") \
            .groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(j))) for j in range(width)]).alias("s"))
        books = [[list(e) for e in book] for book in books]
        for r in sums.collect():  # one row per used entry
            books[r["part"]][r["entry"]] = [s // r["n"] for s in r["s"]]
    final = books
    return blocks.mapInArrow(lambda b: assign(b, final), out), final


def codebooks_digest(books: list) -> str:
    """sha256 of all components in order of part, entry and position."""
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def with_label_error(codes: DataFrame, label: Column) -> DataFrame:
    """``label_error``: the error summed over equal labels, nulls together.

    The sums are combined before the shuffle and stored before the join, so
    a label that a third of all rows share is split by the join.
    """
    keyed = codes.withColumn("_label", label)
    sums = checkpoint(keyed.groupBy("_label").agg(F.sum("error").alias("label_error")).withColumnRenamed("_label", "_of"))
    return keyed.join(sums, F.col("_label").eqNullSafe(F.col("_of"))).drop("_label", "_of")
