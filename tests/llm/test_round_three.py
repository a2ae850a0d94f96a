"""Exact dedup, source divergence and vector codes beside brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import codes, divergence, exact

# --- 11


def brute_groups(rows, keep):
    groups = defaultdict(list)
    for key, text in rows:
        groups[text or ""].append(key)
    best = {t: (max if keep == "largest" else min)((k for k in ks if k is not None), default=None) for t, ks in groups.items()}
    return groups, best


@pytest.mark.parametrize(("keep", "run_rows"), [("largest", 250_000), ("smallest", 1)])
def test_exact_duplicates(awkward, pairs, keep, run_rows):
    got = exact.exact_duplicates(awkward, keep=keep, carry=["text", "row", "length"], run_rows=run_rows).collect()
    groups, best = brute_groups(pairs, keep)
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(pairs)
    for r in got:
        text = r["text"] or ""
        assert (r["keep_id"], r["group_size"]) == (best[text], len(groups[text]))
        assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest() and (r["row"], r["length"]) == (1, 0)
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert Counter(r["text"] or "" for r in got if r["kept"]) == Counter(groups.keys())


def test_exact_duplicates_drop(awkward, pairs, empty):
    clash = awkward.withColumns({"kept": F.lit("k"), "Keep_ID": F.lit(1)})
    got = exact.drop_exact_duplicates(clash, normalise=F.upper)
    assert got.columns == clash.columns
    rows = got.collect()
    assert Counter((r["text"] or "").upper() for r in rows) == Counter({(t or "").upper() for _, t in pairs})
    assert {r["kept"] for r in rows} == {"k"}
    assert exact.exact_duplicates(empty).collect() == []


def test_exact_duplicates_of_one_text(spark):
    rows = spark.range(0, 5000, numPartitions=7).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    got = exact.exact_duplicates(rows, keep="largest", run_rows=10).groupBy("group_size").agg(F.count("*").alias("n"), F.max("keep_id").alias("k")).collect()
    assert {(r["group_size"], r["n"], r["k"]) for r in got} == {(3333, 3333, 4999), (1, 1667, 4998)}


# --- 12


def brute_divergence(rows, min_docs, top):
    def share(c, n, v):
        return 1 + floor(Fraction(10**9 * (c + 2), n + 2 * v))

    def far(p, q):
        return floor(Fraction((p - q) ** 2, p + q))

    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in {key for key, _ in counts}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = [s for key, s in counts if key == lang]
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def spread(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: share(c[t], n, len(kept)) for t in kept}

        p, q = {s: spread(counts[lang, s]) for s in sources}, spread(whole)
        for s in sources:
            peers = [(sum(far(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(far(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", peers, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda f: (-f[0], f[1].encode()))[:limit]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return Counter(out)


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(8)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["Straße", "ÉTÉ", "été", "I'm", "a1b", "😀", "A", "a"]
    rows = []
    for _ in range(220):
        source = rng.choice(["s0", "s0", "s0", "s1", "s2", "é", None, ""])
        lang = rng.choice(["en", "en", "de", None])
        lean = words[: 10 + 7 * (len(source or "") + ord((source or "x")[-1]) % 5)]
        rows.append((lang, source, " ".join(rng.choices(lean, k=rng.randint(0, 40)))))
    rows += [("en", "quiet", None), ("en", "numbers", "1 2 3"), ("xx", "one", "alone"), ("xx", "two", None), ("en", "s1", "wa " * 30_000)] + rows[:9]
    return rows, spark.createDataFrame([(*r, "t", 1) for r in rows], "lang string, source string, text string, term string, n int").repartition(5)


@pytest.mark.parametrize("limits", [(8 << 20, 500_000, 1 << 20), (20, 40, 7)])
def test_divergence(spoken, limits, monkeypatch):
    rows, table = spoken
    for name, value in zip(("_ACCUMULATORS", "_BLOCK", "_EXPANDED"), limits, strict=True):
        monkeypatch.setattr(divergence, name, value)
    got = divergence.source_divergence(table, min_docs=4, top=5).collect()
    assert Counter(tuple(r) for r in got) == brute_divergence(rows, 4, 5)


def test_divergence_of_nothing(spoken):
    assert divergence.source_divergence(spoken[1].limit(0)).collect() == []


def test_shares_of_large_counts():
    rng = random.Random(1)
    for _ in range(200):
        total, kept = rng.randrange(1, 10**15), rng.randrange(1, 10**9)
        count = rng.randrange(total + 1)
        assert divergence.shares(np.array([count]), total, kept)[0] == 1 + 10**9 * (count + 2) // (total + 2 * kept)


# --- 13


def brute_codes(rows, parts, entries, rounds):
    def usable(v):
        return v is not None and len(v) and len(v) % parts == 0 and all(x is not None and np.isfinite(x) for x in v)

    rows = [(k, lb, [floor(4096 * float(np.float32(x))) for x in v]) for k, v, lb in rows if usable(v)]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    rows = [r for r in rows if len(r[2]) == len(rows[0][2])]
    size = len(rows[0][2]) // parts
    cut = [[tuple(r[2][p * size : (p + 1) * size]) for p in range(parts)] for r in rows]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for c in cut:
                groups[nearest(c[p], books[p])[1]].append(c[p])
            for i, members in groups.items():
                books[p][i] = tuple(sum(column) // len(members) for column in zip(*members, strict=True))
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for r, e in zip(rows, errors, strict=True):
        by_label[r[1]] += e
    return Counter((r[0], "".join(f"{i:02x}" for _, i in f), e, by_label[r[1]], digest) for r, f, e in zip(rows, found, errors, strict=True))


def vector_rows(n, seed, length=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(25, length))
    return [(i, [float(np.float32(x)) for x in centres[i % 25] + rng.normal(size=length) * 0.3], [0, 1, 1, 1, None][i % 5]) for i in range(n)]


SHAPE = "vec_id long, embedding array<float>, label int, state string, error int, _key int"


@pytest.mark.parametrize("bounds", [4, 1, 0, 40])
def test_vector_codes(spark, bounds):
    rows = vector_rows(400, bounds)
    same = rows[7][1]
    rows += [(1000 + i, same, 2) for i in range(150)] + [rows[3]] * 2
    rows += [(None, rows[5][1], 1), (None, rows[6][1], None), (2000, None, 1), (2001, [1.0, None] * 8, 1), (2002, [float("nan")] * 16, 1)]
    rows += [(2003, [float("inf")] + [0.0] * 15, 1), (2004, [], 1), (2005, [1.0] * 8, 1), (2006, [1.0] * 9, 1), (2007, [0.0] * 16, 1), (2008, [-0.5] * 16, 1)]
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SHAPE).repartition(5)
    got = codes.compress_vectors(table, kept_bounds=bounds).collect()
    assert Counter(tuple(r) for r in got) == brute_codes(rows, 8, 16, 6)


@pytest.mark.parametrize("n", [1, 3, 17])
def test_few_vectors(spark, n):
    rows = [(i, [float(i // 2), -1.25] * 8, 1) for i in range(n)]  # ties in pairs
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SHAPE)
    assert Counter(tuple(r) for r in codes.compress_vectors(table).collect()) == brute_codes(rows, 8, 16, 6)


def test_no_vectors(spark):
    table = spark.createDataFrame([(1, None, 1, "x", 1, 2)], SHAPE)
    assert codes.compress_vectors(table).collect() == [] and codes.compress_vectors(table.limit(0)).collect() == []
    with pytest.raises(ValueError, match="too large"):
        codes.compress_vectors(spark.createDataFrame([(1, [1e12] * 8, 1, "x", 1, 2)], SHAPE))


def test_bounds_spare_distances():
    """The bounds decide most rows, and the results are those of all distances."""
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(4000, 8)) * 2000).astype(np.int64)
    book = x[:16].copy()
    state, _ = codes.PartState.fresh(x, book, 4)
    asked = 0
    for _ in range(12):
        moved = np.array([x[state.own == e].sum(0) // max((state.own == e).sum(), 1) for e in range(16)])
        moves = np.nextafter(codes._up(codes._squared(moved, book)).astype(np.float32), np.float32(np.inf))
        book = moved
        least, need = state.moved(x, book, moves, 4)
        every = np.stack([codes._squared(x, e) for e in book], 1)
        assert (state.own == every.argmin(1)).all() and (least == every.min(1)).all()
        asked += int((need == 5).sum())
    assert asked < 12 * len(x) / 2
