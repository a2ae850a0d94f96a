"""J and W: lookups, caps, split, shards and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import select
from textloom.operators.mix import batches, cap_by_unit, exact_split, sample_per_group, shard
from textloom.operators.ranking import ordered_rank, skip_first, take_first
from textloom.operators.scoring import block_words, document_token_ids, words
from textloom.functions.arrays import SPECIAL_TOKENS
from textloom.queries import query, table, wide_table
from textloom.queries import sqltext as S
from textloom.session import materialised
from textloom.sources import reference_values as ref

# --- J -----------------------------------------------------------------------------------------------


@query("j1_pending", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j1(spark, sf):
    return select.pending(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels"), ["doc_id"])


@query(
    "j1_pending_distinct",
    "SELECT DISTINCT conv_id FROM conversations WHERE conv_id NOT IN (SELECT doc_id FROM labels)",
)
def j1_distinct(spark, sf):
    done = table(spark, sf, "labels").select(F.col("doc_id").alias("conv_id"))
    return select.pending(table(spark, sf, "conversations").select("conv_id"), done, ["conv_id"], dedupe=True)


@query(
    "j2_first_success",
    "SELECT conv_id, min(turn) AS turn, arg_min(text, turn) AS text FROM conversations "
    "WHERE length(text) >= 200 GROUP BY conv_id",
)
def j2(spark, sf):
    return select.first_success(
        table(spark, sf, "conversations"), "conv_id", "turn", F.length("text") >= 200, ["text"]
    )


@query(
    "j2_branch_order",
    "SELECT doc_id, CASE WHEN source = 'src0' THEN 'main,master' WHEN source = 'src1' THEN 'master,main' "
    "ELSE source || ',main,master' END AS branches FROM documents",
)
def j2_branches(spark, sf):
    branch = F.when(F.col("source") == "src0", "main").when(F.col("source") == "src1", "master").otherwise(F.col("source"))
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(select.branch_candidates(branch), ",").alias("branches")
    )


WORDS_SQL = "SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: w <> '')) AS token FROM documents"
VOCABULARY_SQL = f"""SELECT token, CAST(5 + row_number() OVER (ORDER BY n DESC, token) AS INTEGER) AS id
    FROM (SELECT token, count(*) AS n FROM ({WORDS_SQL}) GROUP BY token HAVING count(*) >= 10)"""
RESERVED_SQL = " UNION ALL ".join(f"SELECT '{t}' AS token, {i} AS id" for i, t in enumerate(SPECIAL_TOKENS))


def document_words(spark, sf):
    return wide_table(spark, sf, "documents").select("doc_id", F.explode(words(F.col("text"))).alias("token"))


def word_vocabulary(spark, sf):
    """Words that occur ten times or more, most frequent first, after the reserved tokens."""
    return vocabulary_of(spark, document_words(spark, sf).groupBy("token").agg(F.count("*").alias("n")))


def vocabulary_of(spark, counts):
    counts = counts.filter("n >= 10")
    ranked = ordered_rank(counts.select("token", (-F.col("n")).alias("_o")), [], ["_o", "token"])
    reserved = spark.createDataFrame([(t, i) for i, t in enumerate(SPECIAL_TOKENS)], "token string, id int")
    return reserved.unionByName(ranked.select("token", (F.col("rank") + 5).cast("int").alias("id")))


@query(
    "j3_token_ids",
    f"SELECT doc_id, token, coalesce(id, 1) AS id, count(*) AS n FROM ({WORDS_SQL}) LEFT JOIN "
    f"({VOCABULARY_SQL} UNION ALL {RESERVED_SQL}) USING (token) GROUP BY ALL",
)
def j3(spark, sf):
    rows = block_words(wide_table(spark, sf, "documents"), "doc_id")
    counts = rows.filter("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("n"))
    return document_token_ids(rows, materialised(vocabulary_of(spark, counts), "vocabulary"), "doc_id")


@query(
    "j4_vocabulary_contract",
    f"SELECT e.token, e.id AS expected_id, coalesce(v.id, -1) AS actual_id, CAST(coalesce(v.id, -1) = e.id AS INTEGER) AS ok "
    f"FROM ({RESERVED_SQL} UNION ALL SELECT 'the', 6) e LEFT JOIN ({VOCABULARY_SQL} UNION ALL {RESERVED_SQL}) v USING (token)",
)
def j4(spark, sf):
    checked = select.special_token_check(word_vocabulary(spark, sf), [*SPECIAL_TOKENS, "the"])
    return checked.withColumn("ok", F.col("ok").cast("int"))


@query("j5_same_size", f"SELECT count(*) AS size FROM ({VOCABULARY_SQL} UNION ALL {RESERVED_SQL})")
def j5(spark, sf):
    vocabulary = materialised(word_vocabulary(spark, sf), "vocabulary")
    return select.require_same_size(vocabulary, vocabulary.select("id").distinct())


TOPIC_SQL = (
    "CASE "
    + " ".join(
        f"WHEN {S.any_of('t', keys)} THEN '{name}'" for name, keys in ref.TOPICS.items()
    )
    + f" ELSE '{ref.OTHER_TOPIC}' END"
)


@query(
    "j6_topic",
    f"SELECT doc_id, {TOPIC_SQL} AS category FROM (SELECT doc_id, replace(lower(text), '_', ' ') AS t FROM documents)",
)
def j6(spark, sf):
    return wide_table(spark, sf, "documents").select("doc_id", select.topic(F.col("text")).alias("category"))


# --- W -----------------------------------------------------------------------------------------------


@query(
    "w2_sample_per_group",
    "SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source "
    "ORDER BY md5('42:' || doc_id), doc_id) AS rn FROM documents) WHERE rn <= 50",
)
def w2(spark, sf):
    return sample_per_group(table(spark, sf, "documents").select("doc_id", "source"), ["source"], ["doc_id"])


@query(
    "w3_cap_by_unit",
    "SELECT conv_id, turn FROM conversations WHERE conv_id IN (SELECT conv_id FROM (SELECT conv_id, "
    "sum(n) OVER (ORDER BY conv_id) - n AS before FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id)) "
    "WHERE before < 200)",
)
def w3(spark, sf):
    return cap_by_unit(table(spark, sf, "conversations").select("conv_id", "turn"), "conv_id", 200)


@query(
    "w4_hard_cap",
    "SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY lang, doc_id) AS rn FROM documents "
    "WHERE length(text) >= 40) WHERE rn <= 300",
)
def w4(spark, sf):
    kept = wide_table(spark, sf, "documents").filter(select.long_enough_raw(F.col("text"))).select("doc_id", "lang")
    return take_first(kept, 300, ["lang", "doc_id"])


@query("w4_cap_zero", "SELECT doc_id FROM documents WHERE false")
def w4_zero(spark, sf):
    return take_first(table(spark, sf, "documents").select("doc_id"), 0, ["doc_id"])


@query(
    "w3_cap_restart",
    "SELECT conv_id, turn FROM conversations WHERE conv_id IN (SELECT conv_id FROM (SELECT conv_id, "
    "sum(n) OVER (ORDER BY conv_id) - n AS before FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id)) "
    "WHERE before < 200)",
)
def w3_restart(spark, sf):
    """A second run with what the first one stored taken off the cap adds nothing."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn")
    first = materialised(cap_by_unit(turns, "conv_id", 200), "stored")
    rest = select.pending(turns, first.select("conv_id").distinct(), ["conv_id"])
    return first.unionByName(cap_by_unit(rest, "conv_id", 200 - first.count()))


@query(
    "w5_resume_offset",
    "SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY lang, doc_id) AS rn FROM documents "
    "WHERE length(text) >= 40) WHERE rn > 300",
)
def w5(spark, sf):
    kept = wide_table(spark, sf, "documents").filter(select.long_enough_raw(F.col("text"))).select("doc_id", "lang")
    return skip_first(kept, 300, ["lang", "doc_id"])


@query(
    "w6_exact_split",
    "SELECT doc_id, CASE WHEN rn <= floor(n * 0.1) THEN 'val' ELSE 'train' END AS split FROM (SELECT doc_id, "
    "row_number() OVER (ORDER BY md5('42:' || doc_id)) AS rn, count(*) OVER () AS n FROM documents)",
)
def w6(spark, sf):
    return exact_split(table(spark, sf, "documents").select("doc_id"), ["doc_id"])


@query(
    "w6_exact_split_tuning",
    "SELECT conv_id, turn, CASE WHEN rn <= greatest(1, floor(n * 0.1)) THEN 'val' ELSE 'train' END AS split FROM ("
    "SELECT conv_id, turn, row_number() OVER (ORDER BY md5('42:' || conv_id || '|' || turn)) AS rn, count(*) OVER () AS n "
    "FROM conversations)",
)
def w6_tuning(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn")
    return exact_split(turns, ["conv_id", "turn"], at_least=1)


def sharded_sql(ranks: int, seed: int) -> str:
    return f"""SELECT doc_id, pos, CAST(pos % {ranks} AS INTEGER) AS rank, pos // {ranks} AS slot, n FROM (
        SELECT doc_id, p + r.k * n AS pos, n FROM (
            SELECT doc_id, row_number() OVER (ORDER BY md5('{seed}:' || doc_id)) - 1 AS p, count(*) OVER () AS n
            FROM documents), (SELECT unnest(range({ranks})) AS k) r
        WHERE p + r.k * n < ceil(n / {ranks}.0) * {ranks})"""


@query("w7_shards", f"SELECT doc_id, pos, rank, slot FROM ({sharded_sql(7, 45)})")
def w7(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    return shard(docs, ["doc_id"], ranks=7, epoch=3).select("doc_id", "pos", "rank", "slot")


@query(
    "w8_batches",
    f"SELECT doc_id, rank, slot // 3 AS batch FROM ({sharded_sql(7, 43)}) WHERE slot // 3 < CAST(ceil(n / 7.0) AS BIGINT) // 3",
)
def w8(spark, sf):
    dealt = shard(table(spark, sf, "documents").select("doc_id"), ["doc_id"], ranks=7, epoch=1)
    return batches(dealt, ranks=7, batch_size=3).select("doc_id", "rank", "batch")


@query("w8_batches_kept", f"SELECT doc_id, rank, slot // 2 AS batch FROM ({sharded_sql(7, 42)})")
def w8_kept(spark, sf):
    dealt = shard(table(spark, sf, "documents").select("doc_id"), ["doc_id"], ranks=7)
    return batches(dealt, ranks=7, batch_size=2, drop_last=False).select("doc_id", "rank", "batch")
