"""Mixing sources to target weights by a low-discrepancy schedule.

* Targets: the weights share out all words; a target stops at ``max_epochs``
  times its source's size and the excess is shared again by weight.  That
  water level is the largest of the levels met while sources are capped in
  order of cap / weight, so one window over the sources gives it.
* Schedule: slot k of equal-sized slots is the golden-ratio point
  frac(k * phi) (in integer arithmetic modulo 2**31), mapped through the
  cumulative targets to a source; slots are ranked per source.
* Blocks: each source's documents, in shuffled order, form one stream of words
  that repeats; slot rank r takes words [r * block, (r + 1) * block) of it.
  Pieces of documents are joined to slots by (source, rank).

Ranks and stream offsets are two-level prefix sums (chunks of 2**16 slots, 4096
shuffle buckets), so no window partition holds a whole source.

Defined cases: null and wordless texts have size 0 and are never taken; a null
source is a source, last in order; a null id is shuffled under its own name; repeated rows
are documents of their own; texts of any length are counted whole; an empty table has no slots and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.common import checkpoint, every, hash128, text_or_empty, word_count

BLOCK_WORDS = 64
MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
MOD = 2**31
STEP = 1327217885  # round(2**31 / golden ratio), odd
_BEFORE = (Window.unboundedPreceding, -1)


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(_s, _source, _tot, target, lo, hi): one row per source; [lo, hi) is its share of the unit interval."""
    w = Window.orderBy(F.col("_source").asc_nulls_last())
    src = sizes.groupBy("_source").agg(F.sum("_size").alias("_tot"))
    src = src.withColumn("_s", F.row_number().over(w) - 1)
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.col("_s"), len(weights)) + 1)
    src = src.withColumn("_w", weight).withColumn("_cap", (F.col("_tot") * max_epochs).cast("double"))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), "_s")
    every = Window.partitionBy()
    capped = F.coalesce(F.sum("_cap").over(by_ratio.rowsBetween(*_BEFORE)), F.lit(0.0))
    open_w = F.sum("_w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    src = src.withColumn("_level", (F.sum("_tot").over(every) - capped) / open_w)
    src = src.withColumn("target", F.least("_cap", F.max("_level").over(every) * F.col("_w")))
    cum = F.sum("target").over(Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("target").over(every)
    return src.withColumn("hi", F.try_divide(cum, total)) \
        .withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("_s")), F.lit(0.0))) \
        .select("_s", "_source", "_tot", "target", "lo", "hi")


def schedule(spark, targets: DataFrame, n_slots: int, bins: int = 1024) -> DataFrame:
    """(slot, _s, rank): the source of every slot and its rank among that source's slots.

    Points meet the sources' intervals by an equi-join on ``bins`` equal cells.
    """
    point = (F.pmod(F.pmod(F.col("id"), F.lit(MOD)) * STEP, F.lit(MOD)) + 0.5) / MOD
    slots = spark.range(n_slots).select(F.col("id").alias("slot"), point.alias("_u")) \
        .withColumn("_bin", F.floor(F.col("_u") * bins).cast("int"))
    cells = targets.filter("hi > lo").select("_s", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") * bins).cast("int"), F.floor(F.col("hi") * bins).cast("int"))).alias("_bin"))
    # The last source also takes what rounding leaves above its bound.
    last = cells.select("*", (F.col("hi") >= 1 - 1e-9).alias("_end"))
    mapped = slots.join(last, "_bin").filter((F.col("_u") >= F.col("lo")) & ((F.col("_u") < F.col("hi")) | F.col("_end"))) \
        .select("slot", "_s", F.shiftright("slot", 16).alias("_chunk"))
    counts = mapped.groupBy("_s", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    base = counts.select("_s", "_chunk", F.coalesce(
        F.sum("_n").over(Window.partitionBy("_s").orderBy("_chunk").rowsBetween(*_BEFORE)), F.lit(0)).alias("_base"))
    inner = F.row_number().over(Window.partitionBy("_s", "_chunk").orderBy("slot")) - 1
    return mapped.withColumn("_r", inner).join(base, ["_s", "_chunk"]) \
        .select("slot", "_s", (F.col("_base") + F.col("_r")).alias("rank"))


def document_sizes(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", seed: int = 7) -> DataFrame:
    """Narrow, checkpointed rows: id, source, words, row key and shuffle key."""
    k1, k2 = hash128(F.col(id_col), F.col(source_col), F.col(text_col))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    return checkpoint(docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), k1.alias("_k1"), k2.alias("_k2"),
        word_count(text_or_empty(text_col)).alias("_size"), order.alias("_ord")))


def _streams(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Every document with its offset in its source's shuffled word stream."""
    d = sizes.withColumn("_bucket", F.substring("_ord", 1, 3))
    per = d.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_b"))
    base = per.select("_source", "_bucket", F.coalesce(F.sum("_b").over(
        Window.partitionBy("_source").orderBy("_bucket").rowsBetween(*_BEFORE)), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("_source", "_bucket").orderBy("_ord", "_size", "_k1", "_k2") \
        .rowsBetween(Window.unboundedPreceding, 0)
    base = base.join(targets, base["_source"].eqNullSafe(targets["_source"])).drop(targets["_source"]) \
        .withColumnsRenamed({"_source": "_bs", "_bucket": "_bb"})
    d = d.withColumn("_in", F.sum("_size").over(inner) - F.col("_size"))
    return d.join(base, d["_source"].eqNullSafe(base["_bs"]) & (d["_bucket"] == base["_bb"])) \
        .withColumn("_off", F.col("_base") + F.col("_in")).drop("_bs", "_bb", "_bucket", "_in", "_base")


def takes(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS,
          block_words: int = BLOCK_WORDS, max_epochs: int = MAX_EPOCHS, seed: int = 7) -> DataFrame:
    """One row per document and pass over its source: words taken in that pass.

    Columns _id, _source, _k1, _k2, _size, _tot, target, _s, _off, _epoch, _taken, _slot
    (the first slot that takes from it).  Blocks of a source are taken in rank
    order from 0, so the words of a pass are a prefix of the document.
    """
    sizes = document_sizes(docs, id_col, text_col, source_col, seed)
    total = sizes.agg(F.sum("_size")).first()[0] or 0
    targets = checkpoint(source_targets(sizes, weights, max_epochs))
    streams = _streams(sizes, targets)
    slots = schedule(docs.sparkSession, targets, -(-total // block_words))
    # A source's slots reach so many words of its stream; passes beyond them take nothing.
    reach = checkpoint(slots.groupBy("_s").agg((F.max("rank") + 1).alias("_blocks")))
    passes = streams.filter("_size > 0").join(reach, "_s") \
        .withColumn("_epoch", F.explode(F.array(*[F.lit(e) for e in range(max_epochs)]))) \
        .withColumn("_start", F.col("_epoch") * F.col("_tot") + F.col("_off")) \
        .filter(F.col("_start") < F.col("_blocks") * block_words)
    end = F.col("_start") + F.col("_size")
    # (_s, _off) names a document with words, so the pieces travel without its columns.
    pieces = passes.select("_s", "_off", "_epoch", "_start", end.alias("_end"), F.explode(F.sequence(
        F.floor(F.col("_start") / block_words), F.least(F.floor((end - 1) / block_words), F.col("_blocks") - 1))).alias("rank")) \
        .select("_s", "_off", "_epoch", "rank", (F.least("_end", (F.col("rank") + 1) * block_words)
                                                 - F.greatest("_start", F.col("rank") * block_words)).alias("_words"))
    got = pieces.join(slots, ["_s", "rank"]).groupBy("_s", "_off", "_epoch") \
        .agg(F.sum("_words").alias("_taken"), F.min("slot").alias("_slot"))
    key = ["_id", "_source", "_k1", "_k2", "_size", "_tot", "target", "_s", "_off"]
    none = streams.select(*key, F.lit(0).alias("_epoch"), F.lit(0).cast("long").alias("_taken"), F.lit(None).cast("long").alias("_slot"))
    some = streams.filter("_size > 0").join(got, ["_s", "_off"], "left") \
        .select(*key, F.coalesce("_epoch", F.lit(0)).alias("_epoch"), F.coalesce("_taken", F.lit(0)).alias("_taken"), "_slot")
    return some.unionByName(none.filter("_size = 0"))


def mix_report(docs: DataFrame, id_col="doc_id", **kw) -> DataFrame:
    """id, size, source_size, target and taken (all passes) per document."""
    t = takes(docs, id_col=id_col, **kw)
    nonzero = t.filter("_size > 0").groupBy("_id", "_size", "_tot", "target", "_s", "_off").agg(F.sum("_taken").alias("_taken"))
    both = nonzero.unionByName(t.filter("_size = 0").select(*nonzero.columns))
    return both.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_tot").alias("source_size"),
                       "target", F.col("_taken").cast("long").alias("taken"))


def mix_documents(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", **kw) -> DataFrame:
    """The mixed corpus: one row of ``docs`` per document and pass that takes any of it.

    A pass that takes part of a document carries the text up to its last taken word.
    """
    t = takes(docs, id_col=id_col, text_col=text_col, source_col=source_col, **kw).filter("_taken > 0") \
        .select("_k1", "_k2", "_size", "_taken")
    k1, k2 = hash128(F.col(id_col), F.col(source_col), F.col(text_col))
    rows = docs.select(F.struct(*every(docs)).alias("_row"), F.col(text_col).alias("_text"), k1.alias("_k1"), k2.alias("_k2")) \
        .dropDuplicates(["_k1", "_k2"])
    word = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++"
    # The prefix with the first n words: possessive, so linear and free of recursion.
    cut = F.call_function("regexp_extract", F.col("_text"), F.concat(
        F.lit(f"^(?:{word}){{"), F.col("_taken").cast("string"), F.lit("}+")), F.lit(0))
    text = F.when(F.col("_taken") >= F.col("_size"), F.col("_text")).otherwise(cut)
    return rows.join(t, ["_k1", "_k2"]).withColumn("_cut", text).select(
        *[F.col("_cut").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns])
