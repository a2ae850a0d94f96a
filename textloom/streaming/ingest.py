"""Resumable ingest of landed JSON-lines files."""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from textloom.operators.select import worth_caching
from textloom.session import materialised

LANDED_SCHEMA = "source string, doc_key string, text string"


def landed_stream(spark: SparkSession, path: str, files_per_batch: int = 1000, schema: str = LANDED_SCHEMA) -> DataFrame:
    """Stream over the files landed in a folder, a bounded number of them per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def seen_keys(landed: DataFrame) -> DataFrame:
    """The keys of a stream's rows, each with the time of the batch that it came with and the first file by name that has
    it there (`_first`), and the time of its last batch (`_last`); rows without a key have a line for every file.

    The state store holds one such line per key, so a batch looks up its own keys only, however many there have been,
    and no text passes through it. A repeated batch has its old time.
    """
    named = landed.select("source", "doc_key", F.col("_metadata.file_path").alias("_file"), F.current_timestamp().alias("_time"))
    kept = named.groupBy("source", "doc_key", F.when(F.col("doc_key").isNull(), F.col("_file")).alias("_of"))
    return kept.agg(F.min(F.struct("_time", "_file")).alias("_first"), F.max("_time").alias("_last"))


def new_keys(seen: DataFrame) -> DataFrame:
    """Of a batch's `seen_keys` those that did not come before, with the file to read them from."""
    new = F.col("doc_key").isNull() | (F.col("_first._time") == F.col("_last"))
    return seen.filter(new).select("source", "doc_key", F.col("_first._file").alias("_file"))


def rows_of_keys(keys: DataFrame, schema: StructType) -> DataFrame:
    """The landed rows of a batch's `new_keys`, read from their files: of a key the smallest row, nulls first; rows
    without a key are all kept."""
    files = [r["_file"] for r in keys.select("_file").distinct().collect()]  # no more than the files of a batch
    spark, rest = keys.sparkSession, [c for c in schema.names if c not in ("source", "doc_key")]
    if not files:
        return spark.createDataFrame([], schema)
    plain = [re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(f)) for f in files]  # names, which metadata encodes, not patterns
    read = spark.read.schema(schema).json(plain).withColumn("_file", F.col("_metadata.file_path")).alias("r")
    same = (F.col("r.doc_key") == F.col("k.doc_key")) & F.col("r.source").eqNullSafe(F.col("k.source")) & (F.col("r._file") == F.col("k._file"))
    found = read.join(keys.alias("k"), same, "left_semi").groupBy("source", "doc_key")
    first = found.agg(F.min(F.struct(*rest)).alias("_r")) if rest else found.agg(F.lit(None).alias("_r"))
    keyed = first.select(*[F.col("_r")[c].alias(c) if c in rest else F.col(c) for c in schema.names])
    return keyed.unionByName(read.filter("doc_key IS NULL").select(*schema.names))


def store_batches(
    landed: DataFrame,
    to_fragments: Callable[[DataFrame], DataFrame],
    store: str,
    ledger: str,
    checkpoint: str,
) -> StreamingQuery:
    """Process what is new and stop. A later run continues where this one ended.

    The checkpoint keeps a file from being read twice and, in its state store, a key that lands again from being
    stored twice (`seen_keys`); the rows of new keys are then read from their files (`rows_of_keys`). Every micro-batch overwrites its own folder, fragments first and then the keys
    it finished; a batch that is repeated after a failure starts from the same state and replaces its own output. Of
    rows with the same key the one of the first file by name counts, in one batch as over several, so the result does
    not depend on the number of files per batch. The ledger is a record for readers; no batch reads it.

    The number of state partitions is that of the shuffle partitions of the first run. With very many keys, set
    `spark.sql.streaming.stateStore.providerClass` to the RocksDB provider, which keeps them on disk.
    """

    def store_batch(batch: DataFrame, number: int) -> None:
        keys = materialised(new_keys(batch), "new-keys")  # the state is gone through once
        kept = to_fragments(rows_of_keys(keys, landed.schema)).filter(worth_caching(F.col("text")))
        kept.write.mode("overwrite").parquet(f"{store}/batch={number}")
        done = keys.filter("doc_key IS NOT NULL").select("source", F.col("doc_key").alias("key"))
        done.write.mode("overwrite").parquet(f"{ledger}/batch={number}")

    return (
        seen_keys(landed).writeStream.outputMode("update").foreachBatch(store_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def progress_counts(landed: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Running number of landed rows per source, a small table per micro-batch below `path`."""

    def store_counts(counts: DataFrame, number: int) -> None:
        counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        landed.groupBy("source")
        .count()
        .writeStream.outputMode("update")
        .foreachBatch(store_counts)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
