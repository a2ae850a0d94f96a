"""From raw documents to packed sequences: the stages of the training-data pipeline, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.gam import feature_table, keep_quality, train_quality
from textloom.llm.jaccard import one_of_each
from textloom.llm.packing import pack_documents
from textloom.llm.queries import held_out, packing_vocabulary, table
from textloom.llm.scratch import Steps
from textloom.llm.suffixes import without_repeated_passages


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It learns from the labels that are not held out."""
    labels = table(spark, sf_dir, "labels").filter(~held_out()).select("doc_id", "quality")
    features = Steps(spark, "quality").store(feature_table(docs), "features")
    return keep_quality(docs, train_quality(features, labels, "quality"))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of at least 0.8 similarity, on five-word shingles, connect."""
    return one_of_each(docs, 80, 100, words=5)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte passages that occur elsewhere; every document stays, if only its row."""
    kept = without_repeated_passages(docs, 200)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of at most 1024 tokens."""
    return pack_documents(docs, packing_vocabulary())


STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", near_copy_stage),
    ("suffix_array_dedup", passage_stage),
    ("packing", packing_stage),
]

#: The classifier and the packing have no form in SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each on what the one before it has stored."""
    steps, docs = Steps(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = steps.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
