"""The whole way: landed files, stored fragments, dataset, vocabulary, training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.operators.select import require_same_size, special_token_check
from textloom.operators.vocabulary import MIN_FREQUENCY, VOCABULARY_SIZE
from textloom.plans.corpus import FRAGMENT_KEY, learn_vocabulary
from textloom.plans.examples import training_rows
from textloom.plans.sources import build_corpus
from textloom.sources import sinks
from textloom.sources.reference_values import MAX_ENTRY_BYTES


def checked_vocabulary(vocabulary: DataFrame) -> DataFrame:
    """The vocabulary as given, if its reserved tokens have their ids and no id occurs twice; an error if not."""
    wrong = special_token_check(vocabulary).filter("NOT ok").collect()  # a row per reserved token at most
    if wrong:
        raise ValueError("reserved tokens without their ids: " + ", ".join(r["token"] for r in wrong))
    require_same_size(vocabulary, vocabulary.select("id").distinct()).collect()
    return vocabulary


def prepare_training(
    spark: SparkSession,
    landed: dict[str, str],
    store: str,
    output: str,
    ranks: int,
    batch_size: int,
    quotas: dict[str, int] | None = None,
    size: int = VOCABULARY_SIZE,
    min_frequency: int = MIN_FREQUENCY,
    branches: DataFrame | None = None,
    caps: dict[str, int] | None = None,
    max_entry_bytes: int = MAX_ENTRY_BYTES,
) -> DataFrame:
    """Everything below `output`: `dataset` (text), `dataset-keyed`, `vocabulary`, `merges` and `rows`.

    Vocabulary and rows come from the mixed dataset, so quotas hold for them too. Returns the build's report.
    """
    report = build_corpus(spark, landed, store, f"{output}/dataset", quotas, caps, branches=branches, max_entry_bytes=max_entry_bytes)
    texts = spark.read.parquet(f"{output}/dataset-keyed")
    vocabulary, merges = learn_vocabulary(texts, size, min_frequency, f"{store}/vocabularies")
    sinks.replace_table(checked_vocabulary(vocabulary), f"{output}/vocabulary", "parquet")
    sinks.replace_table(merges, f"{output}/merges", "parquet")
    stored = spark.read.parquet(f"{output}/vocabulary"), spark.read.parquet(f"{output}/merges")
    sinks.write_examples(training_rows(texts, FRAGMENT_KEY, *stored, ranks=ranks, batch_size=batch_size), f"{output}/rows")
    return report
