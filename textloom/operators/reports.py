"""Corpus reports and run metrics."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from textloom.operators.ranking import ordered_running
from textloom.operators.select import has_both_roles, topic

MAX_EXPONENT = 20


def capped_perplexity(loss: Column) -> Column:
    return F.exp(F.least(loss, F.lit(float(MAX_EXPONENT))))


def fragments_per_source(fragments: DataFrame) -> DataFrame:
    """Rows per source and, with `source` NULL, in total."""
    return fragments.rollup("source").agg(F.count("*").alias("fragments"))


def outcome_counts(pieces: DataFrame, source: str, key: str, n: Column) -> DataFrame:
    """Per source the keys that yielded something and those that yielded nothing."""
    per_key = pieces.groupBy(source, key).agg(F.sum(n).alias("_n"))
    return per_key.groupBy(source).agg(
        F.count_if(F.col("_n") > 0).alias("succeeded"), F.count_if(F.col("_n") == 0).alias("failed")
    )


def example_counts(framed: DataFrame, valid: Column) -> DataFrame:
    """Usable and skipped rows; `valid` may be NULL for a row that did not parse."""
    ok = F.coalesce(valid, F.lit(False))
    return framed.agg(F.count_if(ok).alias("valid"), F.count_if(~ok).alias("skipped"))


def tuning_report(lines: DataFrame, text: str = "text") -> DataFrame:
    """Counts over non-blank lines; `text` is NULL for a line beyond repair."""
    t = F.col(text)
    return lines.agg(
        F.count(t).alias("processed"),
        F.count_if(has_both_roles(t)).alias("well_formed"),
        F.count_if(~has_both_roles(t)).alias("malformed"),
        F.count_if(t.isNull()).alias("unrepairable"),
    )


def topic_histogram(titles: DataFrame, title: str = "title", top: int = 10) -> DataFrame:
    """The most frequent topics; ties by name."""
    counts = titles.groupBy(topic(F.col(title)).alias("category")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), "category").limit(top)


def run_summary(steps: DataFrame, group: list[str], loss: Column, tokens: Column, seconds: Column) -> DataFrame:
    """Mean loss, capped perplexity and tokens per second."""
    summary = steps.groupBy(*group).agg(
        F.avg(loss).alias("mean_loss"), (F.sum(tokens) / seconds).alias("tokens_per_s")
    )
    return summary.withColumn("perplexity", capped_perplexity(F.col("mean_loss")))


def mean_of_rank_means(steps: DataFrame, group: list[str], rank: str, loss: Column) -> DataFrame:
    """Each rank counts the same, however many batches it saw."""
    per_rank = steps.groupBy(*group, rank).agg(F.avg(loss).alias("_mean"))
    return per_rank.groupBy(*group).agg(F.avg("_mean").alias("loss"), F.count("*").alias("ranks"))


def improvements(history: DataFrame, run: str | None = None, epoch: str = "epoch", loss: str = "val_loss") -> DataFrame:
    """Epochs that were better than all before them, with a flag on the best so far.

    The window holds one row per epoch of a run.
    """
    keys = [run] if run else []
    earlier = W.partitionBy(*keys).orderBy(epoch).rowsBetween(W.unboundedPreceding, -1)
    best = history.withColumn("best_before", F.min(loss).over(earlier)).filter(
        F.col("best_before").isNull() | (F.col(loss) < F.col("best_before"))
    )
    last = W.partitionBy(*keys)
    return best.withColumn("is_best", F.col(epoch) == F.max(epoch).over(last)).drop("best_before")


def progress_points(steps: DataFrame, rank: str, order: list[str], loss: str, every: int) -> DataFrame:
    """Every `every`-th step of a rank with the mean loss up to it.

    A rank may hold most of the steps, so the running sums come from range partitions, not one window.
    """
    running = ordered_running(steps.select(rank, *order, loss), [rank], order, loss, "_total", "step")
    return (
        running.filter(F.col("step") % every == 0)
        .withColumn("running_loss", F.col("_total") / F.col("step"))
        .drop("_total")
    )


def rounded(value: Column, digits: int) -> Column:
    """Decimal rounding of the binary value itself, as in Python: 6.55 is below the half and becomes 6.5.

    Spark's `bround` rounds the printed decimal instead. For history tables, which have a row per epoch.
    """

    @F.pandas_udf(DoubleType())
    def round_binary(values: pd.Series) -> pd.Series:
        return values.map(lambda v: round(v, digits), na_action="ignore")

    return round_binary(value)


def rounded_history(history: DataFrame) -> DataFrame:
    """History values at the precision they are stored with."""
    digits = {"train_loss": 4, "val_loss": 4, "val_ppl": 2, "duration_s": 1}
    return history.withColumns({name: rounded(F.col(name), n) for name, n in digits.items()})
