"""Mixing of sources: union, quotas, caps, seeded shuffle, split, shards and batches."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.operators.ranking import (
    hash_position,
    hash_threshold,
    order_hash,
    ordered_rank,
    ordered_running,
)
from textloom.session import path_exists
from textloom.sources.reference_values import FILES_PER_REPO, SEED

log = logging.getLogger(__name__)


def union_sources(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Union of the stored fragments of several sources, duplicates kept.

    `tables` maps a source name to its parquet path. A source without a table is reported and skipped.
    """
    found = []
    for source, path in tables.items():
        if path_exists(spark, path):
            found.append(spark.read.parquet(path).withColumn("source", F.lit(source)))
        else:
            log.warning("no table for source %s, skipped", source)
    if not found:
        raise ValueError("none of the sources has a table")
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole


def take_quota(
    fragments: DataFrame,
    quotas: dict[str, int],
    order: list[str],
    source: str = "source",
) -> DataFrame:
    """The first `quotas[s]` rows of each source `s`; sources without a quota, or with one of 0, are left out.

    Only the key columns are ranked. What comes back from that is one row per source, the key of its last
    row within the quota; the fragments themselves are filtered against it without a shuffle.
    """
    quotas = {name: quota for name, quota in quotas.items() if quota > 0}
    if not quotas:
        return fragments.filter(F.lit(False))
    wanted = fragments.filter(F.col(source).isin(list(quotas)))
    ranked = ordered_rank(wanted.select(source, *order), [source], order)
    at_quota = F.lit(False)
    for name, quota in quotas.items():
        at_quota = at_quota | ((F.col(source) == name) & (F.col("rank") == quota))
    last = ranked.filter(at_quota).select(source, F.struct(*order).alias("_last"))  # one row per quota
    return (
        wanted.join(F.broadcast(last), source, "left")
        .filter(F.col("_last").isNull() | (F.struct(*order) <= F.col("_last")))
        .drop("_last")
    )


def sample_per_group(
    files: DataFrame, group: list[str], key: list[str], n: int = FILES_PER_REPO, seed: int = SEED
) -> DataFrame:
    """At most `n` rows of each group, chosen by hash.

    A constant limit on a row number is applied before the shuffle too, so each task sends at most `n` rows
    of a group, however large the group is.
    """
    at = F.row_number().over(W.partitionBy(*group).orderBy("_h", *key))
    return (
        files.withColumn("_h", order_hash(seed, *key))
        .withColumn("_at", at)
        .filter(F.col("_at") <= n)
        .drop("_h", "_at")
    )


def cap_by_unit(fragments: DataFrame, unit: str, cap: int) -> DataFrame:
    """Whole units in order until their running total has reached `cap`; the last one may overshoot it.

    Units are counted first, ranked by name, and the last admitted name filters the fragments in place. Rows
    without a unit are the first one.
    """
    if cap <= 0:
        return fragments.filter(F.lit(False))
    units = fragments.groupBy(unit).agg(F.count("*").alias("_n"))
    running = ordered_running(units, [], [unit], "_n", "_total")
    last = running.filter(F.col("_total") - F.col("_n") < cap).agg(F.max(unit)).scalar()
    return fragments.filter(F.col(unit).isNull() | (F.col(unit) <= last))


def seeded_shuffle(df: DataFrame, key: list[str], seed: int = SEED) -> DataFrame:
    """A fixed permutation for a fixed seed, with the sources interleaved.

    `orderBy` range-partitions on the hash, which is uniform, so the partitions are even.
    """
    return df.withColumn("_h", order_hash(seed, *key)).orderBy("_h").drop("_h")


def validation_size(share: float = 0.1, at_least: int = 0) -> Column:
    """Size of the held-out part of `n` rows; pre-training uses the plain share, fine-tuning at least 1."""
    return F.greatest(F.floor(F.col("n") * F.lit(share)), F.lit(at_least).cast("long"))


def exact_split(
    df: DataFrame, key: list[str], share: float = 0.1, at_least: int = 0, seed: int = SEED
) -> DataFrame:
    """Label every row `val` or `train`, with exactly the requested number in `val`.

    The exact count comes from one threshold on the hash, so the rows are labelled where they are.
    """
    hashed = df.withColumn("_h", order_hash(seed, *key))
    cut = hash_threshold(hashed, "_h", validation_size(share, at_least)).scalar()
    held_out = F.coalesce(F.col("_h") <= cut, F.lit(False))
    return hashed.withColumn("split", F.when(held_out, "val").otherwise("train")).drop("_h")


def shard(df: DataFrame, key: list[str], ranks: int, epoch: int = 0, seed: int = SEED) -> DataFrame:
    """Deal the rows to `ranks` equal shards: position p of the epoch's order goes to rank p mod `ranks`.

    Rows from the start are dealt again to fill the last round, so all shards have the same size. Epoch 0
    with a fixed seed gives a fixed order (validation); training passes the epoch number.
    """
    placed = hash_position(df.withColumn("_h", order_hash(seed + epoch, *key)), "_h").drop("_h")
    padded = F.ceil(F.col("total") / ranks) * ranks
    return (
        placed.withColumn("pos", F.explode(F.sequence("pos", padded - 1, "total")))
        .withColumn("rank", (F.col("pos") % ranks).cast("int"))
        .withColumn("slot", F.floor(F.col("pos") / ranks))
    )


def batches(sharded: DataFrame, ranks: int, batch_size: int, drop_last: bool = True) -> DataFrame:
    """Batch number of every row of its shard; with `drop_last` the incomplete last batch goes away.

    All shards have the same size, which follows from the total, so nothing has to be counted.
    """
    numbered = sharded.withColumn("batch", F.floor(F.col("slot") / batch_size))
    if not drop_last:
        return numbered
    full = F.floor(F.ceil(F.col("total") / ranks) / batch_size)
    return numbered.filter(F.col("batch") < full)
