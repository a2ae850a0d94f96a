"""T6, T7 and O3: bigram scores, next-word table, top-k with ties."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators.scoring import bigram_scores, next_word_table, top_k_with_ties
from textloom.queries import query, table, wide_table

BIGRAMS_SQL = """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: w <> '') AS ws
        FROM documents),
    g AS (SELECT doc_id, ws[i] AS a, ws[i + 1] AS b FROM (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM w)),
    pair AS (SELECT a, b, count(*) AS n FROM g GROUP BY a, b)"""


@query(
    "t6_bigram_scores",
    BIGRAMS_SQL
    + """, context AS (SELECT a, sum(n) AS n FROM pair GROUP BY a),
    v AS (SELECT count(DISTINCT t) AS v FROM (SELECT a AS t FROM pair UNION ALL SELECT b FROM pair)),
    cost AS (SELECT pair.a, pair.b, -ln((pair.n + 1) / (context.n + v)) AS c FROM pair JOIN context USING (a), v)
    SELECT doc_id, count(*) AS bigrams, round(avg(c), 6) AS nll, round(exp(least(avg(c), 20)), 3) AS perplexity
    FROM g JOIN cost USING (a, b) GROUP BY doc_id""",
)
def t6(spark, sf):
    scores = bigram_scores(wide_table(spark, sf, "documents"), "doc_id")
    return scores.select(
        "doc_id", "bigrams", F.round("nll", 6).alias("nll"), F.round("perplexity", 3).alias("perplexity")
    )


@query(
    "t7_next_word",
    BIGRAMS_SQL
    + """, ranked AS (SELECT a, b, n, ln(n) / 0.8 AS logit, rank() OVER (PARTITION BY a ORDER BY n DESC) AS r FROM pair),
    kept AS (SELECT *, exp(logit - max(logit) OVER (PARTITION BY a)) AS e FROM ranked WHERE r <= 40)
    SELECT a AS context, b AS candidate, n, round(e / sum(e) OVER (PARTITION BY a), 6) AS probability FROM kept""",
)
def t7(spark, sf):
    found = next_word_table(wide_table(spark, sf, "documents"))
    return found.withColumn("probability", F.round("probability", 6))


@query(
    "o3_top_k_ties",
    "SELECT lang, doc_id, score FROM (SELECT lang, doc_id, n_chars // 100 AS score, rank() OVER (PARTITION BY lang "
    "ORDER BY n_chars // 100 DESC) AS r FROM documents) WHERE r <= 20",
)
def o3(spark, sf):
    docs = table(spark, sf, "documents").select("lang", "doc_id", F.floor(F.col("n_chars") / 100).alias("score"))
    return top_k_with_ties(docs, ["lang"], "score", 20)
