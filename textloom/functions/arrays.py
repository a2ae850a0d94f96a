"""Token-id arrays: framing, cutting, padding and shifting into training examples."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reserved ids in vocabulary order.
SPECIAL_TOKENS = ["<pad>", "<unk>", "<bos>", "<eos>", "<sep>", "<code>"]
PAD, UNK, BOS, EOS, SEP, CODE = range(6)

MIN_TOKENS = 8
PRETRAIN_LEN = 1024
TUNE_LEN = 512


def frame(ids: Column) -> Column:
    """Put the begin and end ids around a sequence."""
    return F.concat(F.array(F.lit(BOS)), ids, F.array(F.lit(EOS)))


def cut_head(ids: Column, max_len: int) -> Column:
    """Keep the first `max_len + 1` ids; the end id of a long sequence is lost (pre-training rule)."""
    return F.slice(ids, 1, max_len + 1)


def cut_closed(ids: Column, max_len: int) -> Column:
    """Keep `max_len` ids and close a long sequence with the end id (fine-tuning rule)."""
    return F.when(
        F.size(ids) > max_len + 1, F.concat(F.slice(ids, 1, max_len), F.array(F.lit(EOS)))
    ).otherwise(ids)


def pad_to(ids: Column, length: int) -> Column:
    """Fill a sequence on the right with the pad id."""
    return F.concat(ids, F.array_repeat(F.lit(PAD), F.greatest(F.lit(length) - F.size(ids), F.lit(0))))


def shifted(ids: Column, max_len: int) -> tuple[Column, Column]:
    """Input (all but the last id) and target (all but the first) of a padded sequence."""
    return F.slice(ids, 1, max_len), F.slice(ids, 2, max_len)


def until_eos(ids: Column) -> Column:
    """Ids before the first end id, or all of them."""
    at = F.array_position(ids, EOS)
    return F.when(at > 0, F.slice(ids, F.lit(1), (at - 1).cast("int"))).otherwise(ids)


def real_tokens(ids: Column) -> Column:
    """Number of ids that are not padding."""
    return F.size(F.filter(ids, lambda i: i != PAD))
