"""The registered query of each operator, with its SQL where SQL can say it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.bpe import decode_batches, encode_documents, read_ranks
from textloom.llm.codes import compress_vectors
from textloom.llm.divergence import source_divergence
from textloom.llm.exact import exact_duplicates
from textloom.llm.fingerprints import edit_likeness
from textloom.llm.gam import quality_scores
from textloom.llm.jaccard import jaccard_components
from textloom.llm.licenses import scan_licenses
from textloom.llm.lm import score_against_target
from textloom.llm.neighbours import near_duplicates
from textloom.llm.packing import pack_documents
from textloom.llm.suffixes import drop_repeated_passages
from textloom.llm.urls import filter_urls

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key: str = "doc_id"):
    """Whether a row's labels are kept from the fit; a row without a key has no labels and is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

JACCARD_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM sets
  UNION SELECT r.a, e.b FROM reached r JOIN edges e ON r.b = e.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id
FROM sets s JOIN (SELECT a, min(b) AS component_id FROM reached GROUP BY a) c ON s.doc_id = c.a
"""


@query("op1_ngram_jaccard_join", JACCARD_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(table(spark, sf_dir, "documents"), 90, 100, words=3, extra=1.0)
    return found.select("doc_id", "n_shingles", "component_id")


@query("op2_lm_scoring")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_against_target(table(spark, sf_dir, "documents"), table(spark, sf_dir, "conversations"))


@query("op3_embedding_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"), 0.93)


@query("op4_suffix_array_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_passages(table(spark, sf_dir, "documents"), 200)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_document_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_likeness(table(spark, sf_dir, "documents"))


@query("op6_byte_level_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = encode_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, id_at, data, data_at in decode_batches(batches, ranks):
            ids, data = memoryview(ids.astype("<u4").tobytes()), memoryview(data.tobytes())
            yield pa.RecordBatch.from_pydict({
                "doc_id": rows.column("doc_id"),
                "n_tokens": np.diff(id_at).astype(np.int64),
                "ids_sha256": [hashlib.sha256(ids[4 * a : 4 * b]).hexdigest() for a, b in zip(id_at[:-1], id_at[1:], strict=True)],
                "decoded_sha256": [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(data_at[:-1], data_at[1:], strict=True)],
            })

    return encoded.mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query("op7_quality_classifier")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(~held_out()).select("doc_id", "quality")
    scored = quality_scores(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: The rules of the query's contract.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


@query("op8_url_filters")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), "page_id", URL_RULES)


def packing_vocabulary() -> str:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), packing_vocabulary())


#: The phrases of the query's contract.
LICENSE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


@query("op10_license_scans")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), LICENSE_PHRASES)


EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query("op11_exact_dedup", EXACT_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


DIVERGENCE_SQL = rf"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
words AS (SELECT r, lang, source, unnest(terms) AS term FROM docs),
counts AS MATERIALIZED (SELECT lang, source, term, count(*) AS c, count(DISTINCT r) AS d FROM words GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, term, sum(c) AS c FROM counts GROUP BY ALL HAVING sum(d) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
sources AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (
  SELECT s.lang, s.source, coalesce(sum(x.c), 0) AS n FROM sources s
  LEFT JOIN (SELECT counts.* FROM counts JOIN kept USING (lang, term)) x ON s.lang = x.lang AND s.source = x.source GROUP BY ALL),
shares AS MATERIALIZED (
  SELECT s.lang, s.source, k.term, coalesce(c.c, 0) AS c,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 2)) // (s.n + 2 * l.v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (k.c + 2)) // (l.n + 2 * l.v) AS q
  FROM sizes s JOIN kept k ON s.lang = k.lang JOIN langs l ON s.lang = l.lang
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query("op12_source_divergence", DIVERGENCE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def codes_sql(rounds: int = 6) -> str:
    """The rounds of the vector codes, one after the other."""
    far = "list_sum(list_transform(list_zip(x.w, b.w), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = ["""
WITH whole AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
  SELECT vec_id, p, w[p * (len(w) // 8) + 1 : (p + 1) * (len(w) // 8)] AS w FROM whole, range(8) r(p)),
book0 AS MATERIALIZED (
  SELECT p, e, w FROM (SELECT p, w, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM cut) WHERE e < 16)"""]
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
  SELECT vec_id, p, arg_min(e, d * 16 + e) AS e, min(d) AS d, any_value(w) AS w
  FROM (SELECT x.vec_id, x.p, x.w, b.e, {far} AS d FROM cut x JOIN book{r} b ON x.p = b.p) GROUP BY vec_id, p)""")
        if r < rounds:
            steps.append(f"""
sums{r} AS (
  SELECT p, e, i, sum(v) AS s, count(*) AS c
  FROM (SELECT p, e, unnest(w) AS v, generate_subscripts(w, 1) AS i FROM near{r}) GROUP BY p, e, i),
mean{r} AS (SELECT p, e, list(CAST((s - ((s % c) + c) % c) // c AS BIGINT) ORDER BY i) AS w FROM sums{r} GROUP BY p, e),
book{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.w, b.w) AS w FROM book{r} b LEFT JOIN mean{r} m ON b.p = m.p AND b.e = m.e)""")
    last = f"""
coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
SELECT c.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY w.label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded c JOIN whole w USING (vec_id), digest"""
    return ",".join(steps + [last])


@query("op13_vector_codes", codes_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(table(spark, sf_dir, "embeddings"))
