"""Exact global positions without a single-task window.

Two orders occur. A *hashed* order (md5 of a seed and a unique key) is uniform, so a prefix of the hash cuts
the rows into even buckets that are already in order. A *natural* order can be as uneven as the data; there
Spark's range partitioning on the full order key does the cutting, so a group holding a third of the rows is
spread over as many partitions as its size needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.session import materialised

HASH_DIGITS = 4  # 65,536 buckets: a fixed, small table of counts


def order_hash(seed: int | str, *keys: Column | str) -> Column:
    """Reproducible random order: hexadecimal md5 of `seed:key|key...`. The keys must identify the row."""
    joined = F.concat_ws("|", *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys])
    return F.md5(F.concat(F.lit(f"{seed}:"), joined))


def _hash_buckets(df: DataFrame, hash_col: str) -> tuple[DataFrame, DataFrame]:
    """`df` with its bucket, and per bucket the rows in it, before it and in total (at most 65,536 rows)."""
    bucketed = df.withColumn("_bucket", F.substring(hash_col, 1, HASH_DIGITS))
    counts = bucketed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # the window below runs over the bucket counts, never over the rows
    before = F.sum("_n").over(W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1))
    buckets = counts.select(
        "_bucket",
        "_n",
        F.coalesce(before, F.lit(0)).alias("_before"),
        F.sum("_n").over(W.partitionBy()).alias("_total"),
    )
    return bucketed, buckets


def hash_position(df: DataFrame, hash_col: str, position: str = "pos", total: str = "total") -> DataFrame:
    """0-based position of every row in the order of `hash_col`, and the number of rows."""
    bucketed, buckets = _hash_buckets(df, hash_col)
    inside = F.row_number().over(W.partitionBy("_bucket").orderBy(hash_col))
    return (
        bucketed.join(F.broadcast(buckets.drop("_n")), "_bucket")
        .withColumn(position, F.col("_before") + inside - 1)
        .withColumnRenamed("_total", total)
        .drop("_bucket", "_before")
    )


def hash_threshold(df: DataFrame, hash_col: str, how_many: Column) -> DataFrame:
    """One row with the `how_many`-th smallest hash; no row when `how_many` is 0.

    `how_many` may use the column `n`, the number of rows. Only the one bucket that holds the answer is
    sorted, so taking an exact share of a table never moves the table.
    """
    narrow, buckets = _hash_buckets(df.select(hash_col), hash_col)
    cut = (
        buckets.withColumn("n", F.col("_total"))
        .withColumn("_k", how_many)
        .filter((F.col("_before") < F.col("_k")) & (F.col("_k") <= F.col("_before") + F.col("_n")))
        .select("_bucket", (F.col("_k") - F.col("_before")).alias("_need"))
    )
    inside = F.row_number().over(W.partitionBy("_bucket").orderBy(hash_col))
    return (
        narrow.join(F.broadcast(cut), "_bucket")  # `cut` is one row
        .withColumn("_at", inside)
        .filter(F.col("_at") == F.col("_need"))
        .select(F.col(hash_col).alias("threshold"))
    )


def _placed(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Rows range-partitioned and sorted by group and order, with partition `_part` and place `_at` in it.

    The bounds of a range partitioning come from a sample, so two runs need not agree; the result is written
    once and every later step reads that.
    """
    keys = [*group, *order]
    row_id = F.monotonically_increasing_id()  # partition number in the upper bits, row number in the lower 33
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_id", row_id)
        .withColumn("_part", F.shiftright("_id", 33))
        .withColumn("_at", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_id")
    )
    return materialised(placed, "placed")


def _part_offsets(parts: DataFrame, group: list[str], sums: list[str]) -> DataFrame:
    """Running totals over the partitions of each group: as many rows as partitions plus groups."""
    earlier = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return parts.select(
        *group,
        "_part",
        "_first",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before{c}") for c in sums],
    )


def _same_group(left: str, right: str, group: list[str]) -> Column:
    same = F.col(f"{left}._part") == F.col(f"{right}._part")
    for g in group:
        same = same & F.col(f"{left}.{g}").eqNullSafe(F.col(f"{right}.{g}"))
    return same


def ordered_rank(df: DataFrame, group: list[str], order: list[str], rank: str = "rank") -> DataFrame:
    """1-based rank of every row within its group, in the natural order of `order` (which must be unique).

    Pass only the key columns when the rows are wide: every column given here is shuffled.
    """
    placed = _placed(df, group, order)
    parts = placed.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    offsets = _part_offsets(parts, group, ["_n"])
    return (
        placed.alias("p")
        .join(offsets.alias("o"), _same_group("p", "o", group))
        .select("p.*", (F.col("o._before_n") + F.col("p._at") - F.col("o._first") + 1).alias(rank))
        .drop("_part", "_at")
    )


def ordered_running(
    df: DataFrame, group: list[str], order: list[str], value: str, total: str, rank: str = "rank"
) -> DataFrame:
    """Rank and running sum of `value` within each group, as `ordered_rank` (current row included)."""
    placed = _placed(df, group, order)
    parts = placed.groupBy(*group, "_part").agg(
        F.count("*").alias("_n"), F.min("_at").alias("_first"), F.sum(value).alias("_s")
    )
    offsets = _part_offsets(parts, group, ["_n", "_s"])
    # a window per group *and* partition: no larger than one partition, whatever the size of the group
    inside = W.partitionBy("_part", *group).orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    summed = placed.withColumn("_inside", F.sum(value).over(inside))
    return (
        summed.alias("p")
        .join(offsets.alias("o"), _same_group("p", "o", group))
        .select(
            "p.*",
            (F.col("o._before_n") + F.col("p._at") - F.col("o._first") + 1).alias(rank),
            (F.col("o._before_s") + F.col("p._inside")).alias(total),
        )
        .drop("_part", "_at", "_inside")
    )


def _key(order: list[str]) -> Column:
    return F.struct(*order)


def _key_at_rank(df: DataFrame, order: list[str], rank: int) -> Column:
    """Order key of the row with the given rank, as a scalar subquery (NULL when there are fewer rows)."""
    ranked = ordered_rank(df.select(*order), [], order)
    return ranked.filter(F.col("rank") == rank).select(_key(order)).scalar()


def take_first(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first `n` rows in the natural order, none if `n` is 0. Only the keys are sorted; the rows are filtered
    in place."""
    if n <= 0:
        return df.filter(F.lit(False))
    last = _key_at_rank(df, order, n)
    return df.filter(last.isNull() | (_key(order) <= last))


def skip_first(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """All rows but the first `n` in the natural order."""
    return df if n <= 0 else df.filter(_key(order) > _key_at_rank(df, order, n))
