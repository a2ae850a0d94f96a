"""T1 to T5 and A8: words, vocabulary training, encoding, decoding, and the training rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import select
from textloom.operators import vocabulary as V
from textloom.plans.examples import training_rows
from textloom.plans.tuning import question_answer_rows
from textloom.queries import query, table, wide_table
from textloom.session import shared_folder

# RE2 has no look-ahead: the last blank of a run is split off by a mark first.
_MARKED = "regexp_replace(' ' || {0}, '(\\s)(\\s\\S)', '\\1' || chr(1) || '\\2', 'g')"
_WORDS = (
    "regexp_extract_all(" + _MARKED + ", "
    "'''s|''t|''re|''ve|''m|''ll|''d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^\\s\\p{{L}}\\p{{N}}\\x01]+|\\s+')"
)


@query(
    "t1_pretokens",
    f"SELECT doc_id, CAST(len(ws) AS INTEGER) AS words, md5(array_to_string(ws, chr(30))) AS digest "
    f"FROM (SELECT doc_id, {_WORDS.format('text')} AS ws FROM documents)",
)
def t1(spark, sf):
    found = wide_table(spark, sf, "documents").select("doc_id", V.pretokens(F.col("text")).alias("ws"))
    return found.select(
        "doc_id", F.size("ws").alias("words"), F.md5(F.array_join("ws", "\x1e")).alias("digest")
    )


@query(
    "a8_word_counts",
    f"SELECT word, count(*) AS freq FROM (SELECT unnest({_WORDS.format('line || chr(10)')}) AS word FROM ("
    "SELECT unnest(str_split(text, chr(10))) AS line FROM documents)) GROUP BY word",
)
def a8(spark, sf):
    return V.pretoken_counts(wide_table(spark, sf, "documents"))


def learned(spark, sf):
    """Training at the full size; it ends when no pair is frequent enough, the operator's own rule. The queries of a
    session share it: the words are counted by each, and the counts name the stored vocabulary."""
    return V.stored_vocabulary(V.pretoken_counts(wide_table(spark, sf, "documents")), f"{shared_folder(spark)}/vocabularies")


@query("t2_vocabulary")
def t2(spark, sf):
    return learned(spark, sf)[0]


@query("t3_encode")
def t3(spark, sf):
    coded = V.encode(wide_table(spark, sf, "documents").select("doc_id", "text"), *learned(spark, sf))
    return coded.select("doc_id", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query("t4_round_trip", "SELECT doc_id, 1 AS ok FROM documents")
def t4(spark, sf):
    checked = V.round_trip(wide_table(spark, sf, "documents").select("doc_id", "text"), *learned(spark, sf))
    return checked.select("doc_id", F.col("ok").cast("int").alias("ok"))


@query(
    "t5_reserved_ids",
    "SELECT unnest(['<pad>', '<unk>', '<bos>', '<eos>', '<sep>', '<code>']) AS token, unnest([0, 1, 2, 3, 4, 5]) AS expected_id, "
    "unnest([0, 1, 2, 3, 4, 5]) AS actual_id, 1 AS ok",
)
def t5(spark, sf):
    return select.special_token_check(learned(spark, sf)[0]).withColumn("ok", F.col("ok").cast("int"))


@query("e3_training_rows")
def e3(spark, sf):
    docs = wide_table(spark, sf, "documents").select("doc_id", "text")
    rows = training_rows(docs, ["doc_id"], *learned(spark, sf), ranks=4, batch_size=3)
    return rows.select("split", "rank", "batch", "slot", "doc_id", F.md5(F.array_join(F.col("input").cast("array<string>"), ",")).alias("digest"))


@query("e3_tuning_rows")
def e3_tuning(spark, sf):
    """Questions and answers to tuning rows: closed at their cut, the last validation batch kept."""
    asked = question_answer_rows(table(spark, sf, "conversations"))
    rows = training_rows(asked, ["conv_id", "turn"], *learned(spark, sf), ranks=4, batch_size=3, tuning=True)
    digest = F.md5(F.array_join(F.concat("input", "target").cast("array<string>"), ","))
    return rows.select("split", "rank", "batch", "slot", "conv_id", "turn", digest.alias("digest"))
