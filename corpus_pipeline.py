"""Documents made ready for training: five stages, each over all that the one before kept.

Every stage takes and returns a table with the columns of ``documents``, the last one gives packed pieces. Each
result is written to the shared folder and read again, so a lost executor costs a stage's tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rillframe.llm import langid, neardup, packing, passages, quality
from rillframe.llm.store import settled, unwrapped, wrapped

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go: the fixed rules, and cutoffs certified on the labels for each language."""
    return quality.passing(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go: no letters, or far from every centroid that the labelled documents give, if any is labelled."""
    return unwrapped(langid.predict(wrapped(docs, "text"), langid.fit(docs)).where("NOT rejected"), docs.columns, "text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: shingles of five words, similarity 0.8."""
    return neardup.deduplicated(docs, size=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that a document of smaller id has too are cut out; n_chars follows.

    A document with no word left goes; one that had none to begin with stays.
    """
    shown = ["doc_id", "text", *["n_chars"] * ("n_chars" in docs.columns)]
    found = passages.removals(wrapped(docs, *shown), 50).where("n_words = 0 OR n_removed < n_words")
    changed = F.col("n_removed") > 0
    if "n_chars" in shown:
        found = found.withColumn("n_chars", F.when(changed, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars")))
    return unwrapped(found.withColumn("text", F.col("kept_text")), docs.columns, *shown)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences of 4096 tokens."""
    return packing.packed(docs, TOKENIZER, END_ID)


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

#: No SQL for certified cutoffs, centroids and packing; tests compare with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir))
    return docs
