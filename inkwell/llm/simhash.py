"""SimHash near-dedup with meet-in-the-middle ball hashing.

Fingerprints: 64-bit SimHash over word shingles (XXH64, seed 42), counted with
numpy inside the scan's own tasks.  Two fingerprints that differ in at most
three bits meet at a variant that is at most one flip from one and two flips
from the other.  Of three bits two lie in the same 32-bit half, so it is enough
to emit the fingerprint itself, its 64 one-flip variants and the 992 two-flip
variants within a half.  Rows are shuffled on the variant.  All that share a
variant with some fingerprint at most one flip away are within three bits of
it, so each variant yields a star around that hub and never all pairs of its
group (which has at most 2081 members).  Links are deduplicated and verified by
their bit distance.

Only distinct fingerprints take part, so copies cost nothing.  A lossless screen
comes first: of seven bit blocks, three differing bits leave four blocks equal,
hence a fingerprint that shares no four blocks with another one has no link and
emits no variants.  The values of four blocks that several fingerprints share are found by a combined
aggregate and stored before the join, so a template with many different
fingerprints meets in no single task.  Components come from large-star / small-star rounds over the
links, each cut by a reliable checkpoint.

Defined cases: null and wordless texts have fingerprint 0 and link like any other;
fewer words than a shingle make one shingle of all words; null ids are ignored
when the smallest id is sought (null if there is no other); repeated rows are
equal fingerprints; texts of any length are read whole; empty tables give empty results.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import checkpoint, every, hash128

SHINGLE = 3
RADIUS = 3
_STEP = 1 << 16


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def ball_masks() -> list[int]:
    """Flips of at most one bit (65, first), then two bits of one half (992)."""
    one = [0] + [1 << i for i in range(64)]
    two = [(1 << i) | (1 << j) for half in (range(32), range(32, 64)) for i, j in combinations(half, 2)]
    return [_signed(m) for m in one + two]


def block_masks() -> list[int]:
    """Masks of every four of seven bit blocks."""
    edges = [0, 9, 18, 27, 36, 45, 54, 64]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [_signed(sum(c)) for c in combinations(blocks, 4)]


def fingerprint_bytes(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a UTF-8 text."""
    import numpy as np
    import xxhash

    words = text.lower().split()  # on bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*[words[i:] for i in range(shingle)])))
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, len(grams), _STEP):
        raw = b"".join([digest(g, 42) for g in grams[at:at + _STEP]])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(grams)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(_id, _k1, _k2, _fp), one narrow checkpointed row per input row."""
    k1, k2 = hash128(F.col(id_col), F.col(text_col))
    src = docs.select(F.col(id_col).alias("_id"), k1.alias("_k1"), k2.alias("_k2"), F.col(text_col).cast("binary").alias("_text"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            fps = [0 if t is None else fingerprint_bytes(t.as_py() or b"", shingle) for t in b.column(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(fps, pa.int64())], names=["_id", "_k1", "_k2", "_fp"])

    schema = f"_id {src.schema['_id'].dataType.simpleString()}, _k1 long, _k2 long, _fp long"
    return checkpoint(src.mapInArrow(run, schema))


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) links between distinct fingerprints ``_fp``: stars whose closure is that of all links."""
    if radius != 3:
        raise ValueError("the ball and the screen are built for a radius of 3 bits")
    from pyspark.sql import Window

    screen = distinct.select("_fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col("_fp").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(block_masks())])).alias("_b")) \
        .select("_fp", "_b.c", "_b.v")
    shared = checkpoint(screen.groupBy("c", "v").agg(F.min("_fp").alias("lo"), F.max("_fp").alias("hi")).filter("lo <> hi").select("c", "v"))
    near = screen.join(shared, ["c", "v"], "left_semi").select("_fp").distinct()
    masks = F.array(*[F.lit(m) for m in ball_masks()])
    ball = near.select("_fp", F.posexplode(masks).alias("_i", "_m")) \
        .select("_fp", (F.col("_i") <= 64).alias("_near"), F.col("_fp").bitwiseXOR(F.col("_m")).alias("_v"))
    hub = F.min(F.when(F.col("_near"), F.col("_fp"))).over(Window.partitionBy("_v"))
    return ball.withColumn("a", hub).filter("a is not null and a <> _fp").select("a", F.col("_fp").alias("b")) \
        .distinct().filter(_distance(F.col("a"), F.col("b")) <= radius)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every linked node with the smallest node it reaches.

    Large-star and small-star rounds; each is two combined aggregates and a join,
    and the state is one row per node once the graph has become stars.
    """
    state = checkpoint(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    seen = None
    while True:
        both = state.union(state.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        state = checkpoint(small)
        mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(_id, _k1, _k2, _fp, component_id, _rep): one row per input row.

    ``component_id`` is the smallest id of the class; ``_rep`` its (id, row key)."""
    fps = fingerprints(docs, id_col, text_col, shingle)
    rep = F.struct(F.isnull("_id").alias("n"), F.col("_id").alias("i"), F.col("_k1").alias("k1"), F.col("_k2").alias("k2"))
    distinct = checkpoint(fps.groupBy("_fp").agg(F.min("_id").alias("_min"), F.min(rep).alias("_rep")))
    roots = components(links(distinct.select("_fp"), radius))
    linked = distinct.join(roots, distinct["_fp"] == roots["node"], "left") \
        .select("_fp", "_min", "_rep", F.coalesce("root", "_fp").alias("_root"))
    # Checkpointed, so the join below has an exchange of its own on either side and AQE can split a large class.
    best = checkpoint(linked.groupBy("_root").agg(F.min("_min").alias("component_id"), F.min("_rep").alias("_rep")))
    classes = linked.select("_fp", "_root").join(best, "_root").select("_fp", "component_id", "_rep")
    return fps.join(classes, "_fp")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that represent their class: the smallest id, null ids last; one of repeated rows."""
    keep = near_duplicate_classes(docs, id_col, text_col) \
        .filter((F.col("_rep.k1") == F.col("_k1")) & (F.col("_rep.k2") == F.col("_k2"))).select("_k1", "_k2").distinct()
    k1, k2 = hash128(F.col(id_col), F.col(text_col))
    rows = docs.select(F.struct(*every(docs)).alias("_row"), k1.alias("_k1"), k2.alias("_k2"))
    return rows.join(keep, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"]).select("_row.*")
