"""From stored fragments to the mixed dataset, and the vocabulary learned from it."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.packing import pack_paragraphs
from textloom.functions.text import clean_prose
from textloom.operators.mix import seeded_shuffle, take_quota
from textloom.operators.select import worth_caching
from textloom.operators.vocabulary import (
    MIN_FREQUENCY,
    VOCABULARY_SIZE,
    pretoken_counts,
    stored_vocabulary,
    train_vocabulary,
)
from textloom.session import materialised
from textloom.sources.readers import fragments
from textloom.sources.reference_values import SEED

log = logging.getLogger(__name__)

FRAGMENT_KEY = ["source", "doc_key", "frag_idx"]


def prose_fragments(documents: DataFrame, source: str = "source", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Clean and pack every document; keep the fragments worth storing."""
    pieces = pack_paragraphs(clean_prose(F.col(text)))
    return fragments(documents, F.col(source), F.col(key), pieces).filter(worth_caching(F.col("text")))


def mixed_dataset(
    stored: DataFrame, quotas: dict[str, int] | None = None, seed: int = SEED
) -> DataFrame:
    """Quota per source, then one seeded shuffle over all sources.

    Without `quotas` every source is taken whole; with them, sources that they do not name are left out, which
    is logged. `stored` should be a table: the quota reads its key columns once more than its text.
    """
    if quotas is None:
        return seeded_shuffle(stored, FRAGMENT_KEY, seed)
    unnamed = [r["source"] for r in stored.select("source").distinct().collect() if r["source"] not in quotas]
    if unnamed:
        log.warning("no quota for %s, left out", ", ".join(map(str, unnamed)))
    return seeded_shuffle(take_quota(stored, quotas, ["doc_key", "frag_idx"]), FRAGMENT_KEY, seed)


def build_dataset(documents: DataFrame, quotas: dict[str, int] | None = None, seed: int = SEED) -> DataFrame:
    """Documents to mixed dataset, with the fragments stored once in between."""
    return mixed_dataset(materialised(prose_fragments(documents), "fragments"), quotas, seed)


def learn_vocabulary(
    dataset: DataFrame, size: int = VOCABULARY_SIZE, min_frequency: int = MIN_FREQUENCY, folder: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Vocabulary and merge tables of a dataset with a `text` column; with `folder`, trained once (`stored_vocabulary`)."""
    counts = pretoken_counts(dataset)
    return train_vocabulary(counts, size, min_frequency) if folder is None else stored_vocabulary(counts, folder, size, min_frequency)
