"""From texts to fixed-length training rows, split, dealt to ranks and batched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.arrays import PRETRAIN_LEN, TUNE_LEN, cut_closed, cut_head, frame, pad_to, shifted
from textloom.operators.mix import batches, exact_split, shard
from textloom.operators.select import enough_tokens
from textloom.operators.vocabulary import encode
from textloom.session import materialised


def example_rows(coded: DataFrame, max_len: int | None = None, tuning: bool = False, ids: str = "ids") -> DataFrame:
    """`input` and `target` arrays of `max_len` ids for every sequence that is long enough."""
    length = max_len or (TUNE_LEN if tuning else PRETRAIN_LEN)
    framed = coded.withColumn("_f", frame(F.col(ids))).filter(enough_tokens(F.col("_f")))
    cut = cut_closed(F.col("_f"), length) if tuning else cut_head(F.col("_f"), length)
    source, target = shifted(F.col("_p"), length)
    return (
        framed.withColumn("_p", pad_to(cut, length + 1))
        .withColumns({"input": source, "target": target})
        .drop("_f", "_p", ids)
    )


def training_rows(
    texts: DataFrame,
    key: list[str],
    vocabulary: DataFrame,
    merges: DataFrame,
    ranks: int,
    batch_size: int,
    epoch: int = 1,
    max_len: int | None = None,
    tuning: bool = False,
) -> DataFrame:
    """Encode once, then split 90/10, deal each part to the ranks and number the batches.

    The encoded rows are stored: what follows reads their keys several times, but the arrays only once.
    Training rows are reordered every epoch and lose the incomplete last batch. Validation rows keep one
    order; their last batch is dropped in pre-training and kept in tuning.
    """
    coded = encode(texts.select(*key, "text"), vocabulary, merges)
    stored = materialised(example_rows(coded, max_len, tuning), "examples")
    rows = exact_split(stored, key, at_least=1 if tuning else 0)
    train = batches(shard(rows.filter("split = 'train'"), key, ranks, epoch), ranks, batch_size)
    held_out = batches(
        shard(rows.filter("split = 'val'"), key, ranks), ranks, batch_size, drop_last=not tuning
    )
    return train.unionByName(held_out)
