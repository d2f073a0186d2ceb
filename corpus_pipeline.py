"""A training-corpus pipeline over ``documents``: quality rules, line dedup, SimHash
near-dedup, mixing to target weights, byte-level BPE.

Each stage takes (spark, docs, sf_dir); ``run`` writes what a stage returns as
Parquet in the shared scratch folder and hands the reread table to the next one.
All stages but the last return the columns of ``documents``; the last returns a
row per mixed text with its token count and digests.  Nulls, empty and long texts, repeated rows,
empty tables and extra columns are handled as the stage's operator defines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import line_dedup, mixing, quality, simhash
from inkwell.llm.common import read_table
from inkwell.llm.queries import token_digests
from inkwell.session import scratch_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line labels keep."""
    return quality.keep_content(docs, read_table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines repeated from earlier documents; a document goes only if no word of it is left."""
    out = line_dedup.dedup_lines(docs).filter((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(F.length("text"))} \
        if "n_chars" in docs.columns else {"text": F.col("text")}
    return out.select(*[(changed[c] if c in changed else F.col("row")[c]).alias(c) for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash class, the one with the smallest id."""
    return simhash.near_dedup(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once per pass that takes words from it, cut to what the pass takes."""
    out = mixing.mix_documents(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the token ids and of the bytes they decode to."""
    return token_digests(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("mixing to target weights", mixing_stage),
    ("byte-level BPE", bpe_stage),
]

# The field's labels, the bit-count fingerprints and the merges are not SQL; tests hold a brute-force twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    root = scratch_dir(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{root}/stage{i}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
