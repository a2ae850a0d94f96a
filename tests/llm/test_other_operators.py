"""Embeddings, URLs, components and the registered queries beside brute force and SQL."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as driver
from textloom.llm import hnsw, neighbours, urls
from textloom.llm.components import components
from textloom.llm.queries import QUERIES, SQL, URL_RULES


def multiset(values):
    return Counter(tuple(v) for v in values)


# --- components


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(1000 + i, 1001 + i) for i in range(120)]  # a chain
    links += [(2000, 2001 + i) for i in range(150)]  # a star
    links += [(5, 5), (None, 3), (7, None), links[0]]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            parent[root(a)] = root(b)
    assert set(got) == set(parent)
    assert len({(got[x], root(x)) for x in parent}) == len(set(got.values())) == len({root(x) for x in parent})


# --- 3


def brute_neighbours(rows, threshold):
    def usable(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [i for i, (k, v, label) in enumerate(rows) if k is not None and label is not None and usable(v)]
    links = {i: set() for i in range(len(rows))}
    for a in good:
        for b in good:
            (_, x, la), (_, y, lb) = rows[a], rows[b]
            if a != b and la == lb and len(x) == len(y):
                x, y = np.array(x, float), np.array(y, float)
                if (x / abs(x).max()) @ (y / abs(y).max()) / np.linalg.norm(x / abs(x).max()) / np.linalg.norm(y / abs(y).max()) >= threshold:
                    links[a].add(b)
    comp = {}
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            todo += [x for x in links[todo.pop()] if x not in seen and not seen.add(x)]
        keys = [rows[x][0] for x in seen if rows[x][0] is not None]
        comp[i] = min(keys) if keys else None
    return [(k, len(links[i]), comp[i], k == comp[i]) for i, (k, _, _) in enumerate(rows)]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    rows = []
    for centre in range(12):
        c = rng.normal(size=16)
        for _ in range([1, 3, 90][centre % 3]):
            rows.append((len(rows), (c + rng.normal(size=16) * 0.05).tolist(), centre % 2))
    rows += [(900, rows[0][1], rows[0][2]), (900, rows[0][1], rows[0][2]), (901, [-x for x in rows[0][1]], rows[0][2])]
    rows += [(902, None, 0), (903, [0.0] * 16, 0), (904, [float("nan")] + [1.0] * 15, 0), (905, [float("inf")] + [1.0] * 15, 0), (906, [None] + [1.0] * 15, 0)]
    rows += [(907, rows[0][1], None), (None, rows[0][1], rows[0][2]), (908, [], 0), (909, [1.0, 2.0], 0), (910, [2.0, 4.0], 0), (911, [1e-200, 2e-200], 0), (912, [1e200, 2e200], 0)]
    return rows


@pytest.mark.parametrize("shard_rows", [16_000, 40])
def test_near_duplicates(spark, vectors, shard_rows):
    schema = "vec_id long, embedding array<double>, label int, row string, hits int, vector int"
    df = spark.createDataFrame([(k, v, label, "x", 1, 2) for k, v, label in vectors], schema).repartition(3)
    got = neighbours.near_duplicates(df, 0.93, shard_rows=shard_rows)
    assert multiset(tuple(r) for r in got.collect()) == multiset(brute_neighbours(vectors, 0.93))
    assert neighbours.near_duplicates(df.limit(0), 0.93).count() == 0


def test_graph_recall():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph, order = hnsw.build(x, rng.random(3000) * 0.99 + 0.005)
    assert sorted(order.tolist()) == list(range(3000))
    ids, _ = graph.search(graph.vectors[:200], 64)
    true = np.argsort(-(graph.vectors[:200] @ graph.vectors.T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids[:, :10].tolist(), true.tolist(), strict=True)]) > 0.95


def test_recall_on_embeddings(spark):
    """Links of all rows against brute force on a table with groups of close vectors."""
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    rng = np.random.default_rng(1)
    rows += [(10_000 + i, (np.array(rows[i % 7][1]) + rng.normal(size=64) * 0.02).tolist(), rows[i % 7][2]) for i in range(140)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in neighbours.near_duplicates(df, 0.93, shard_rows=100).collect()}
    true = {k: n for k, n, _, _ in brute_neighbours(rows, 0.93)}
    assert sum(min(got[k], n) for k, n in true.items()) >= 0.99 * sum(true.values()) > 0
    assert all(got[k] <= n for k, n in true.items())


def test_large_groups_are_whole(spark):
    """Groups of copies, and of near copies that fill most of a shard, keep all their links."""
    rng = np.random.default_rng(5)
    one, other = rng.normal(size=(2, 16))
    rows = [(i, one.tolist(), 0) for i in range(700)]
    rows += [(1000 + i, (other + rng.normal(size=16) * 0.02).tolist(), 0) for i in range(1200)]
    rows += [(3000 + i, rng.normal(size=16).tolist(), 0) for i in range(300)]
    unit = np.array([v for _, v, _ in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    true = dict(zip([k for k, _, _ in rows], ((unit @ unit.T >= 0.93).sum(1) - 1).tolist(), strict=True))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = {r["vec_id"]: r for r in neighbours.near_duplicates(df, 0.93).collect()}
    assert all(got[k]["n_links"] == true[k] for k in range(700))
    assert sum(got[k]["n_links"] for k in true) >= 0.99 * sum(true.values())
    assert all(got[k]["n_links"] <= n for k, n in true.items())
    assert {got[k]["component_id"] for k in range(700)} == {0}


def test_graphs_are_copied_once_per_lot(spark, monkeypatch):
    """A graph travels in pieces and once per lot of queries, not in one row per chunk; every query meets every shard."""
    monkeypatch.setattr(neighbours, "CHUNK_ROWS", 3)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 8))
    rows = [(i, (centres[i % 40] + rng.normal(size=8) * 0.1).astype(np.float32).tolist(), 0) for i in range(300)]
    meetings, seen = neighbours._meetings, []

    def spy(*args):
        met = meetings(*args)
        seen.extend(met.groupBy("shard").agg(F.countDistinct("chunk").alias("chunks"), F.count_if(F.col("chunk") < 0).alias("pieces"), F.countDistinct("row").alias("rows"), F.count_if(F.col("chunk") >= 0).alias("queries")).collect())
        return met

    monkeypatch.setattr(neighbours, "_meetings", spy)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got = neighbours.near_duplicates(df, 0.93, shard_rows=150)
    assert [(r["queries"], r["rows"]) for r in seen] == [(300, 300)] * 2
    assert all(r["pieces"] <= 16 and r["chunks"] > 64 for r in seen)
    assert multiset(tuple(r) for r in got.collect()) == multiset(brute_neighbours(rows, 0.93))
    monkeypatch.setattr(neighbours, "PIECE_BYTES", 2_000)
    columns = {"cell": [7] * 300, "shard": [0] * 300, "dim": [8] * 300, "row": range(300), "vector": [v for _, v, _ in rows]}
    table = pa.table({c: pa.array(v, pa.list_(pa.float32()) if c == "vector" else pa.int64()) for c, v in columns.items()})
    pieces = neighbours._build(table)
    assert pieces.num_rows == 5 and all(len(x) <= 2_000 for x in pieces.column("vectors").to_pylist())
    shard = neighbours._Shard(pieces)
    assert sorted(shard.ids.tolist()) == list(range(300)) and all((level < 300).all() for level in shard.graph.links)


# --- 8


def brute_url(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :], re.S).group()
        host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    fits = []
    for rule in URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append(rule)
    return host, path, max(fits, key=len, default=None)


URLS = [
    None, "", "no scheme", "http://", "https://EXAMPLE.com/de/x?y=1", "http://example.com/de", "http://example.com?/de/", "http://a.example.net/en/1#top",
    "http://example.net", "http://example.net/", "http://xexample.net/en/", "http://net/", "http://notnet/", "http://a.org/fr/", "http://a.org/fr", "x://é.org/fr/a",
    "http://a.b.c.org/fr/?q=://z", "http://net", "http://ex.net:80/en/", "http://u@h.net/a\nb", "http://example.com/de/", "http://example.com/de/",
    "://host.net/", "http://h#.net/", "http://" + "a" * 5000 + ".net/" + "b" * 5000,
]


def test_urls(spark):
    rows = [(i, u, "x", 1) for i, u in enumerate(URLS * 4)] + [(None, "http://a.net/", "x", 1), (3, "http://a.net/", "x", 1)]
    rows += [(1000 + i, f"http://h{i}.{'net' if i % 2 else 'org'}/{'fr' if i % 3 else 'en'}/{i}", "x", 1) for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, suffix int")
    got = urls.filter_urls(df, "page_id", URL_RULES).collect()
    want = multiset((k, *brute_url(u)) for k, u, _, _ in rows)
    assert multiset((r["page_id"], r["host"], r["path"], r["rule"]) for r in got) == want
    for r in got:
        assert r["verdict"] == URL_RULES[r["rule"]] if r["rule"] else r["verdict"] in ("block", "allow")
        assert 0 <= r["score"] <= 1


def test_rates_come_from_other_folds(spark):
    """Against a plain count over all labelled urls of the other folds."""
    rng = np.random.default_rng(3)
    data = [(i, f"k{rng.integers(30)}", [None, "block", "allow"][rng.integers(3)], int(rng.integers(urls.FOLDS))) for i in range(300)]
    data += [(900, "one", "block", 0), (901, "never", None, 1), (902, None, "block", 2)]
    rows = spark.createDataFrame(data, "i int, suffix string, says string, fold int")
    labelled = rows.filter("says IS NOT NULL").withColumn("label", (F.col("says") == "block").cast("double"))
    joined = rows.join(urls._counts(labelled, "suffix"), F.col("suffix") == F.col("suffix_key"), "left")
    found = joined.withColumns(urls._rates("suffix", 0.7)).collect()
    assert len(found) == len(data)
    for r in found:
        others = [s for _, k, s, f in data if k is not None and k == r["suffix"] and s and not (r["says"] and f == r["fold"])]
        want = (others.count("block") + 1) / (len(others) + 2) if others else 0.7
        assert np.isclose(r["suffix_rate"], want) and np.isclose(r["suffix_known"], np.log1p(len(others)))


def test_trees_follow_the_labels(spark):
    """Rules cover one half of the hosts; the rest looks like it in the path."""
    rows = [(i, f"http://host{i}.{'com' if i % 2 else 'net'}/{'ads' if i % 4 < 2 else 'news'}/{i}") for i in range(800)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = urls.filter_urls(df, "page_id", {"net/ads/": "block", "net/news/": "allow"}).filter("rule IS NULL").collect()
    assert np.mean([(r["verdict"] == "block") == ("/ads/" in r["path"]) for r in got]) > 0.95


def test_urls_of_one_kind_or_none(spark):
    df = spark.createDataFrame([(1, "http://a.net/"), (2, "http://a.com/"), (3, None)], "page_id long, url string")
    assert {r["verdict"] for r in urls.filter_urls(df, "page_id", {"net/": "block"}).collect()} == {"block"}
    assert {r["verdict"] for r in urls.filter_urls(df, "page_id", {}).collect()} == {"allow"}
    assert urls.filter_urls(df.limit(0), "page_id", URL_RULES).count() == 0


# --- registered queries

SCHEMAS = {
    "op1_ngram_jaccard_join": "doc_id n_shingles component_id",
    "op2_lm_scoring": "doc_id n_tokens target_loss background_loss score",
    "op3_embedding_near_dedup": "vec_id n_links component_id kept",
    "op4_suffix_array_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op5_document_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op6_byte_level_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op7_quality_classifier": "doc_id held_out score predicted",
    "op8_url_filters": "page_id host path rule verdict",
    "op9_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op10_license_scans": "doc_id n_words n_base first_word last_word base_labels labels score",
}


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_query_columns(name, spark, sf_dir):
    assert set(SCHEMAS[name].split()) <= set(QUERIES[name](spark, sf_dir).columns)
    assert name in driver.queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(name, spark, sf_dir):
    rows, only_spark, only_sql = compare(QUERIES[name](spark, sf_dir), connect(sf_dir), SQL[name])
    assert rows and not only_spark and not only_sql


# --- pipeline


def test_pipeline_stages(spark, awkward, sf_dir, tmp_path):
    import corpus_pipeline

    docs = awkward.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    docs = docs.unionByName(spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 10_000))
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, sf_dir)
            path = str(tmp_path / f"{name}-{rows is docs}-{random.random()}")
            out.write.parquet(path)
            before, rows = rows, spark.read.parquet(path)
            if name != "packing":
                assert rows.columns == docs.columns and rows.count() <= before.count()
            if name == "suffix_array_dedup":
                assert rows.count() == before.count()
                assert rows.filter("n_chars <> length(text)").count() == 0


def test_pipeline_keeps_good_documents(spark):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.quality_stage(spark, docs, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good, bad = labels.filter("quality = 1"), labels.filter("quality = 0")
    assert kept.join(good, "doc_id").count() >= 0.98 * good.count()
    assert kept.join(bad, "doc_id").count() <= 0.05 * bad.count()


def test_pipeline_runs(spark, sf_dir):
    pieces = driver.queries()["pipeline"](spark, sf_dir)
    assert pieces.count() > 0 and pieces.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 1024
