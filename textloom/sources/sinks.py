"""Writers. A table that is being read is never overwritten in place."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from textloom.operators.select import worth_caching
from textloom.session import path_exists


def append_fragments(fragments: DataFrame, path: str) -> None:
    """Append the fragments worth keeping to the store, one folder per source."""
    fragments.filter(worth_caching(F.col("text"))).write.mode("append").partitionBy("source").parquet(path)


def write_dataset(dataset: DataFrame, path: str) -> None:
    """The final dataset as JSON lines with the single key `text`."""
    dataset.select("text").write.mode("overwrite").json(path)


def json_line(text: str = "text"):
    """A fragment as one JSON line, non-ASCII characters as they are."""
    return F.to_json(F.struct(F.col(text).alias("text")))


def export_corpus(dataset: DataFrame, path: str) -> int:
    """Plain-text corpus, one fragment after the other; returns their number, counted while writing."""
    seen = Observation()
    dataset.select("text").observe(seen, F.count("*").alias("n")).write.mode("overwrite").text(path)
    return seen.get["n"]


def replace_table(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Write `df` beside `path`, then swap the two folders. `df` may read from `path`."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    target, mark = path.rstrip("/"), uuid.uuid4().hex
    fresh, old = (jvm.org.apache.hadoop.fs.Path(f"{target}.{kind}-{mark}") for kind in ("new", "old"))
    df.write.format(fmt).save(fresh.toString())
    place = jvm.org.apache.hadoop.fs.Path(target)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    replaced = fs.exists(place)
    if replaced and not fs.rename(place, old):
        raise OSError(f"could not move {place} away; the new table is at {fresh}")
    if not fs.rename(fresh, place):
        if replaced:
            fs.rename(old, place)
        raise OSError(f"could not move {fresh} to {place}")
    if replaced:
        fs.delete(old, True)


def write_ledger(keys: DataFrame, path: str) -> None:
    """Replace the stored set of finished keys."""
    replace_table(keys.distinct(), path, "parquet")


HISTORY_SCHEMA = "epoch int, train_loss double, val_loss double, val_ppl double, duration_s double"


def merge_history(earlier: DataFrame, new: DataFrame) -> DataFrame:
    return earlier.unionByName(new, allowMissingColumns=True)


def append_history(spark: SparkSession, new: DataFrame, path: str) -> None:
    """Add epochs to a stored history (pre-training); fine-tuning replaces it with `replace_table`."""
    if path_exists(spark, path):
        earlier = spark.read.schema(HISTORY_SCHEMA).json(path)
    else:
        earlier = spark.createDataFrame([], HISTORY_SCHEMA)
    replace_table(merge_history(earlier, new), path)


def write_examples(examples: DataFrame, path: str) -> None:
    """Training rows by split and rank; a worker reads only its own folder, whose files, by name, are in the
    order of the slots.

    The rows are range-partitioned in that order, so there are about as many files as partitions and ranks.
    """
    place = ["split", "rank", "slot"]
    ordered = examples.repartitionByRange(*place).sortWithinPartitions(*place)
    ordered.write.mode("overwrite").partitionBy("split", "rank").parquet(path)


