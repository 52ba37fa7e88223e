"""Corpus pipeline: quality rules, n-gram Jaccard join, benchmark decontamination, PII, mixing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept.  All but the last return the columns of ``documents``.  Rows without a
doc_id are judged by their text.  Rows that share a doc_id are copies of one
document: quality rules and decontamination judge each by its text, one of them stays after the Jaccard join and
in the mix, that with the smallest text.  Columns of other names pass through;
``copies`` and ``source_target`` of the mix replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyspark.llm import decontaminate, jaccard, mixing, pii, quality
from tallyspark.llm.common import cut, one_each, row_key, table, without


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that every quality rule lets pass."""
    return quality.keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest key."""
    key = row_key()
    single = one_each(docs, key)
    members, _ = jaccard.jaccard_join(single.select(key.alias("key"), "text"), "key")
    return without(single, key, members.where("doc_id <> component_id").select("doc_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; n_chars follows."""
    clean = pii.redact(docs, pii.fit_field(docs))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix with the number of copies it takes of each."""
    key = row_key()
    docs = one_each(docs, key)
    taken = mixing.mix(docs.select(key.alias("key"), "text", "source"), "key").where("copies > 0")
    taken = taken.select(F.col("doc_id").alias("__p_key"), F.col("copies").alias("__p_copies"), F.col("target").alias("__p_target"))
    mixed = docs.withColumn("__p_row", key).join(taken, F.col("__p_row") == F.col("__p_key"))
    return mixed.withColumn("copies", F.col("__p_copies")).withColumn("source_target", F.col("__p_target")).drop("__p_row", "__p_key", "__p_copies", "__p_target")


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("pii", personal_data),
    ("mixing", mixture),
]

# the latent search and the field of stages 3 and 4 have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs
