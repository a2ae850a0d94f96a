"""Exact positions on data where one group holds a large part of the rows."""

import math
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.operators import mix, ranking, scoring
from textloom.operators.scoring import bigram_scores, block_words, document_token_ids, join_uneven, next_word_table, top_k_with_ties
from textloom.session import shared_folder


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.6 else f"g{rng.randrange(40)}", i, rng.randrange(9)) for i in range(5000)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "g string, k long, v long").repartition(8)


def same(left, right):
    assert sorted(map(tuple, left.collect())) == sorted(map(tuple, right.collect()))


def test_ordered_rank_and_running_sum(rows):
    w = W.partitionBy("g").orderBy("k")
    plain = rows.select("g", "k", F.row_number().over(w).alias("rank"), F.sum("v").over(w).alias("t"))
    same(ranking.ordered_rank(rows.select("g", "k"), ["g"], ["k"]).select("g", "k", "rank"), plain.drop("t"))
    same(ranking.ordered_running(rows, ["g"], ["k"], "v", "t").select("g", "k", "rank", "t"), plain)


def test_prefixes(rows):
    ordered = sorted((r.g, r.k) for r in rows.collect())
    for n in (0, 1, 777, 5000, 6000):
        assert sorted((r.g, r.k) for r in ranking.take_first(rows, n, ["g", "k"]).collect()) == ordered[:n]
        assert sorted((r.g, r.k) for r in ranking.skip_first(rows, n, ["g", "k"]).collect()) == ordered[n:]


def test_hash_positions_are_a_permutation(rows):
    placed = ranking.hash_position(rows.withColumn("h", ranking.order_hash(42, "k")), "h").collect()
    assert [r.k for r in sorted(placed, key=lambda r: r.pos)] == [r.k for r in sorted(placed, key=lambda r: r.h)]
    assert sorted(r.pos for r in placed) == list(range(5000))
    assert {r.total for r in placed} == {5000}


@pytest.mark.parametrize("n, expected, floor", [(5000, 500, 0), (9, 0, 0), (9, 1, 1), (1, 1, 1)])
def test_split_is_exact(rows, n, expected, floor):
    part = rows.filter(F.col("k") < n)
    split = mix.exact_split(part, ["k"], at_least=floor)
    assert split.filter("split = 'val'").count() == expected
    assert split.count() == part.count()


@pytest.mark.parametrize("n, ranks", [(5000, 7), (3, 8), (1, 3), (16, 4)])
def test_shards(rows, n, ranks):
    dealt = mix.shard(rows.filter(F.col("k") < n), ["k"], ranks).collect()
    sizes = [sum(r["rank"] == w for r in dealt) for w in range(ranks)]
    assert sizes == [-(-n // ranks)] * ranks
    assert {r.k for r in dealt} == set(range(n))
    assert all(r.pos == r.slot * ranks + r["rank"] for r in dealt)


def test_batches(rows):
    dealt = mix.shard(rows, ["k"], 3)
    full = mix.batches(dealt, 3, 64).groupBy("rank", "batch").count().collect()
    assert {r["count"] for r in full} == {64} and len(full) == 3 * (1667 // 64)
    assert mix.batches(dealt, 3, 64, drop_last=False).count() == 5001


def test_quota_with_a_hot_source(rows):
    quotas = {"hot": 1000, "g1": 5, "g2": 10_000, "absent": 3}
    taken = mix.take_quota(rows, quotas, ["k"], source="g")
    w = W.partitionBy("g").orderBy("k")
    limit = F.create_map(*[F.lit(x) for pair in quotas.items() for x in pair])
    plain = rows.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= limit[F.col("g")]).drop("r")
    same(taken.select("g", "k", "v"), plain)


def test_cap_by_unit_overshoots_with_the_last_unit(rows):
    sizes = sorted((r.g, r["count"]) for r in rows.groupBy("g").count().collect())
    total, units = 0, []
    for g, n in sizes:
        if total >= 500:
            break
        total, units = total + n, [*units, g]
    kept = mix.cap_by_unit(rows, "g", 500)
    assert {r.g for r in kept.select("g").distinct().collect()} == set(units)
    assert kept.count() == total


def test_sample_per_group(rows):
    taken = mix.sample_per_group(rows, ["g"], ["k"], 20)
    assert {r["count"] for r in taken.groupBy("g").count().collect()} == {20}


def test_top_k_keeps_ties(rows):
    w = W.partitionBy("g").orderBy(F.desc("v"))
    plain = rows.withColumn("r", F.rank().over(w)).filter("r <= 5").drop("r")
    same(top_k_with_ties(rows, ["g"], "v", 5).select("g", "k", "v"), plain)


@pytest.mark.parametrize("share", [0.0, 0.1, 2.0])  # every key hot, one key hot, none hot
def test_join_uneven(rows, share):
    counts = rows.groupBy("g").agg(F.count("*").alias("n"), F.max("v").alias("top"))
    same(join_uneven(rows, counts, ["g"], "n", share).select("k", "n", "top"), rows.join(counts, "g").select("k", "n", "top"))


def test_quota_and_cap_of_zero(rows):
    assert mix.take_quota(rows, {"hot": 0, "g1": 2, "g2": 10**9}, ["k"], "g").groupBy("g").count().filter("g = 'hot'").count() == 0
    assert mix.take_quota(rows, {}, ["k"], "g").count() == 0
    assert mix.cap_by_unit(rows, "g", 0).count() == 0


def test_rows_without_a_unit_or_a_key(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4)], "g string, k long")
    assert sorted(r.k for r in mix.cap_by_unit(rows, "g", 3).collect()) == [1, 2, 3]
    counts = rows.groupBy("g").agg(F.count("*").alias("uses"))
    assert sorted(r.k for r in join_uneven(rows, counts, ["g"], "uses", 0.4).collect()) == [1, 2, 3, 4]


def test_top_k_of_one_large_group(spark):
    """Nearly all rows in one group, all scores different, and a group without a name."""
    rng = random.Random(2)
    data = [("hot", i, rng.random()) for i in range(4000)] + [(None, 9000 + i, float(i)) for i in range(5)] + [("t", 1, 1.0), ("t", 2, 1.0), ("t", 3, 0.5)]
    df = spark.createDataFrame(data, "g string, k long, s double")
    kept = top_k_with_ties(df, ["g"], "s", 3).collect()
    want = sorted((k for g, k, s in sorted((r for r in data if r[0] == "hot"), key=lambda r: -r[2])[:3]))
    assert sorted(r.k for r in kept if r.g == "hot") == want
    assert sorted(r.k for r in kept if r.g is None) == [9002, 9003, 9004]
    assert sorted(r.k for r in kept if r.g == "t") == [1, 2, 3]


@pytest.mark.parametrize("block", [1, 50, 10**6])  # one text a block, several blocks a partition, one block
def test_bigram_scores_in_blocks(spark, monkeypatch, block):
    """Equal to a plain count over all texts, however the documents fall into blocks."""
    monkeypatch.setattr(scoring, "BLOCK_WORDS", block)
    rng = random.Random(block)
    texts = [" ".join(rng.choice("abcdefgh") * rng.choice((1, 1, 2)) for _ in range(rng.randrange(30))) for _ in range(200)]
    texts += [None, "", " \n", "alone", "Two\twords", "hot hot " * 3000]
    rows = [(i if i % 50 else None, t, "x", 1) for i, t in enumerate(texts)] + [(7, "a b c", "x", 1)]
    df = spark.createDataFrame(rows, "n long, text string, first string, _block long").repartition(3)
    pairs, of_key = Counter(), defaultdict(list)
    for key, text, *_ in rows:
        words = (text or "").lower().split()
        for pair in zip(words, words[1:]):
            pairs[pair] += 1
            of_key[key].append(pair)
    starts, v = Counter(), len({w for p in pairs for w in p})
    for (a, _), c in pairs.items():
        starts[a] += c
    want = {k: (len(ps), sum(-math.log((pairs[p] + 1) / (starts[p[0]] + v)) for p in ps) / len(ps)) for k, ps in of_key.items()}
    found = {r.n: (r.bigrams, r.nll) for r in bigram_scores(df, "n").collect()}
    assert found.keys() == want.keys()
    assert all(found[k][0] == want[k][0] and math.isclose(found[k][1], want[k][1], rel_tol=1e-9) for k in want)
    table = {(r.context, r.candidate): r.n for r in next_word_table(df, k=10**6).collect()}
    assert table == dict(pairs)


def test_bigram_scores_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bigram_scores(empty, "doc_id").count() == 0
    assert next_word_table(empty).count() == 0
    assert bigram_scores(spark.createDataFrame([(1, None), (2, "one")], "doc_id long, text string"), "doc_id").count() == 0


@pytest.mark.parametrize("block", [3, 10_000])
def test_token_ids_by_blocks(spark, monkeypatch, block):
    """Only a block's distinct words are joined; equal keys, null included, count as one; a word may have two ids."""
    monkeypatch.setattr("textloom.operators.scoring.BLOCK_WORDS", block)
    texts = [(1, "a b a  C"), (2, "c c a"), (2, "a d"), (None, "b"), (None, "b <unk>"), (3, ""), (4, None), (5, "e")]
    vocabulary = spark.createDataFrame([("a", 5), ("b", 6), ("<unk>", 1), ("<unk>", 9), ("c", 7)], "token string, id int")
    for cut in (texts, [t for t in texts if t[0] not in (2, None)]):
        rows = block_words(spark.createDataFrame(cut, "doc_id long, text string").repartition(2), "doc_id")
        ids = {"a": [5], "b": [6], "c": [7], "<unk>": [1, 9]}
        counted = Counter((k, w) for k, t in cut for w in (t or "").lower().split())
        expected = sorted(((k, w, i, n) for (k, w), n in counted.items() for i in ids.get(w, [1])), key=str)
        assert sorted((tuple(r) for r in document_token_ids(rows, vocabulary, "doc_id").collect()), key=str) == expected
    assert rows.filter("token = 'a'").agg(F.sum("n")).first()[0] == 2


def test_bigrams_meet_as_numbers(spark):
    """Words are shuffled once per block, not in every bigram."""
    texts = spark.createDataFrame([(1, "a b a b c"), (2, "b a"), (3, "z"), (4, None)], "doc_id long, text string").coalesce(1)
    rows = scoring._numbered_blocks(texts, "doc_id", "text")
    assert sorted((r.token, r.uses) for r in rows.filter("token IS NOT NULL").collect()) == [("a", 2), ("b", 3), ("c", 0)]
    pairs = rows.filter("_first IS NOT NULL").collect()
    assert [sorted(r._n) for r in pairs] == [[1, 2, 2]] and [len(r._second) for r in pairs] == [3]
    assert sorted((r._key, len(r._numbers)) for r in rows.filter("_numbers IS NOT NULL").collect()) == [(1, 4), (2, 1)]


def test_packed_numbers_and_words():
    for numbers in ([], [0, 0], [255, 256, 0], [2**40, 1, 2**31]):
        assert scoring._unpack(scoring._pack(np.array(numbers, np.int64))).tolist() == numbers
    known = pa.array(["a", "straße", "\x00b", "😀", "a" * 5000, "z"])
    for part in (known, known[2:5], known[6:]):
        assert scoring._unpack_words(*scoring._pack_words(part)).equals(part)
        assert len(set(scoring._places(part).tolist())) == len(part)
    assert scoring._places(known[2:5]).tolist() == scoring._places(known).tolist()[2:5]


def test_bigrams_travel_packed(spark, monkeypatch):
    """The tables of bigram scores are smaller than the texts, and many blocks and buckets give the counts of one."""
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(30_000)}" for _ in range(1000)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "n long, text string").repartition(2)
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.rglob("*.parquet"))
    one = {r.n: (r.bigrams, r.nll) for r in bigram_scores(df, "n").collect()}
    assert sum(f.stat().st_size for f in set(folder.rglob("*.parquet")) - before if f.is_file()) < 0.8 * sum(map(len, texts))
    for name, size in (("BLOCK_WORDS", 20_000), ("BUCKET_WORDS", 5_000), ("BUCKET_BIGRAMS", 30_000)):
        monkeypatch.setattr(scoring, name, size)
    many = {r.n: (r.bigrams, r.nll) for r in bigram_scores(df, "n").collect()}
    assert many.keys() == one.keys() == set(range(300))
    assert all(many[k][0] == one[k][0] == 999 and math.isclose(many[k][1], one[k][1], rel_tol=1e-9) for k in one)
    pairs = Counter(p for t in texts for p in zip(t.split(), t.split()[1:]))
    starts = Counter()
    for (a, _), n in pairs.items():
        starts[a] += n
    words = len({w for p in pairs for w in p})
    for k in (0, 150, 299):
        ps = list(zip(texts[k].split(), texts[k].split()[1:]))
        assert math.isclose(one[k][1], sum(-math.log((pairs[p] + 1) / (starts[p[0]] + words)) for p in ps) / len(ps), rel_tol=1e-9)
