"""ST: resumable ingest, bounded micro-batches and running counts, over files written from the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions.packing import pack_paragraphs
from textloom.functions.text import clean_prose
from textloom.queries import query, table
from textloom.queries import sqltext as S
from textloom.queries.sources import new_path
from textloom.sources.readers import fragments
from textloom.streaming.ingest import landed_stream, progress_counts, store_batches

PACKED = S.prose_of("SELECT doc_id AS k, text AS raw FROM documents")


#: Files that a small table lands as; a larger one has as many for every split of its scan.
LANDED = 4


def land(spark, sf, path: str, wanted=None) -> int:
    """Write the documents as line files; returns into how many times four of them."""
    read = table(spark, sf, "documents")
    times = read.rdd.getNumPartitions()
    docs = read.select("source", F.col("doc_id").cast("string").alias("doc_key"), "text", "lang")
    kept = docs if wanted is None else docs.filter(wanted)
    kept.drop("lang").repartition(LANDED * times).write.mode("append").json(path)
    return times


def packed(batch):
    return fragments(batch, F.col("source"), F.col("doc_key"), pack_paragraphs(clean_prose(F.col("text"))))


def ingest(spark, landing: str, store: str, files: int) -> None:
    stream = landed_stream(spark, landing, files_per_batch=files)
    store_batches(stream, packed, f"{store}/fragments", f"{store}/ledger", f"{store}/progress").awaitTermination()


@query(
    "st1_resumable_ingest",
    PACKED
    + f" SELECT d.source, CAST(k AS VARCHAR) AS doc_key, frag_idx, p.text FROM packed p JOIN documents d ON d.doc_id = p.k "
    f"WHERE length({S.strip('p.text')}) > 50",
)
def st1(spark, sf):
    """English documents land first, then all of them; the second run stores the others, the third nothing."""
    landing, store = new_path(spark, "landing"), new_path(spark, "ingest")
    times = land(spark, sf, landing, F.col("lang") == "en")
    ingest(spark, landing, store, files=2 * times)
    land(spark, sf, landing)
    ingest(spark, landing, store, files=2 * times)
    ingest(spark, landing, store, files=2 * times)
    return spark.read.parquet(f"{store}/fragments").drop("batch")


@query(
    "st1_many_files_per_batch",
    PACKED
    + f" SELECT d.source, CAST(k AS VARCHAR) AS doc_key, frag_idx, p.text FROM packed p JOIN documents d ON d.doc_id = p.k "
    f"WHERE length({S.strip('p.text')}) > 50",
)
def st1_many(spark, sf):
    """Every document lands twice, and all files are one batch: the same rows as one file at a time."""
    landing, store = new_path(spark, "landing"), new_path(spark, "ingest")
    land(spark, sf, landing)
    times = land(spark, sf, landing)
    ingest(spark, landing, store, files=1000 * times)
    return spark.read.parquet(f"{store}/fragments").drop("batch")


@query("st2_bounded_batches", "SELECT source, CAST(doc_id AS VARCHAR) AS key, 1 AS times FROM documents")
def st2(spark, sf):
    """Every key is in the ledger of exactly one of several micro-batches."""
    landing, store = new_path(spark, "landing"), new_path(spark, "ingest")
    times = land(spark, sf, landing)
    ingest(spark, landing, store, files=times)
    done = spark.read.parquet(f"{store}/ledger")
    return done.groupBy("source", "key").agg(F.count_distinct("batch").cast("int").alias("times"))


@query("st3_running_counts", "SELECT source, count(*) AS landed FROM documents GROUP BY source")
def st3(spark, sf):
    landing, counts = new_path(spark, "landing"), new_path(spark, "counts")
    times = land(spark, sf, landing)
    stream = landed_stream(spark, landing, files_per_batch=2 * times)
    progress_counts(stream, counts, new_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(counts).groupBy("source").agg(F.max("count").alias("landed"))
