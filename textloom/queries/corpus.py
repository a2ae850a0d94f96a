"""U, O and the flagship: sources united, cut to their quotas and shuffled."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators.mix import seeded_shuffle, take_quota, union_sources
from textloom.operators.ranking import hash_position, order_hash
from textloom.plans.corpus import build_dataset
from textloom.queries import query, table, wide_table
from textloom.queries import sqltext as S
from textloom.queries.sources import new_path

# A quota for each of the twenty sources of the given tables; small ones bind, large ones do not.
QUOTAS = {f"src{i}": 10 * (i + 1) for i in range(20)}
QUOTA_SQL = "10 * (CAST(substr(source, 4) AS INTEGER) + 1)"


@query(
    "w1_o1_mixed_dataset",
    S.prose_of("SELECT doc_id AS k, text AS raw FROM documents")
    + f""", ranked AS (SELECT d.source, CAST(k AS VARCHAR) AS doc_key, frag_idx, p.text,
        row_number() OVER (PARTITION BY d.source ORDER BY CAST(k AS VARCHAR), frag_idx) AS rn
        FROM packed p JOIN documents d ON d.doc_id = p.k WHERE length({S.strip('p.text')}) > 50)
    SELECT source, doc_key, frag_idx, text FROM ranked WHERE rn <= {QUOTA_SQL}""",
)
def mixed_dataset(spark, sf):
    return build_dataset(wide_table(spark, sf, "documents"), QUOTAS)


@query(
    "w1_quota",
    f"SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn "
    f"FROM documents) WHERE rn <= {QUOTA_SQL}",
)
def w1(spark, sf):
    return take_quota(table(spark, sf, "documents").select("doc_id", "source"), QUOTAS, ["doc_id"])


@query(
    "w1_quota_zero",
    f"SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn "
    f"FROM documents) WHERE rn <= {QUOTA_SQL} AND source <> 'src3'",
)
def w1_zero(spark, sf):
    return take_quota(table(spark, sf, "documents").select("doc_id", "source"), QUOTAS | {"src3": 0}, ["doc_id"])


@query("o1_seeded_shuffle", "SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id)) - 1 AS pos FROM documents")
def o1(spark, sf):
    """The position in the permutation, so that the check sees the order."""
    hashed = table(spark, sf, "documents").select("doc_id").withColumn("h", order_hash(42, "doc_id"))
    return hash_position(hashed, "h").select("doc_id", "pos")


@query("o1_shuffled_rows", "SELECT doc_id, source, text FROM documents")
def o1_rows(spark, sf):
    return seeded_shuffle(table(spark, sf, "documents").select("doc_id", "source", "text"), ["source", "doc_id"])


@query(
    "u1_union_sources",
    "SELECT source, doc_id FROM (SELECT 'wikipedia' AS source, doc_id FROM documents "
    "UNION ALL SELECT 'gutenberg', doc_id FROM documents WHERE lang = 'en')",
)
def u1(spark, sf):
    stored = {name: new_path(spark, name) for name in ("wikipedia", "gutenberg", "opensubtitles_es")}
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    docs.select("doc_id").write.parquet(stored["wikipedia"])
    docs.filter("lang = 'en'").select("doc_id").write.parquet(stored["gutenberg"])
    return union_sources(spark, stored).select("source", "doc_id")  # the third source has no table


@query("u2_ledger_set", "SELECT DISTINCT source, lang AS key FROM documents")
def u2(spark, sf):
    return table(spark, sf, "documents").select("source", F.col("lang").alias("key")).distinct()


