"""The operators on texts beside brute force, on awkward rows and on empty tables."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from textloom.llm import bpe, fingerprints, gam, jaccard, licenses, lm, packing, pretokens, suffixes
from textloom.llm.arrays import chunks, groups

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWERED = str.maketrans(UPPER, UPPER.lower())


def rows(df):
    return [r.asDict() for r in df.collect()]


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWERED))
    return set(zip(*[w[i:] for i in range(k)], strict=False)) if len(w) >= k else ({tuple(w)} if w else set())


def multiset(values):
    return Counter(tuple(v) for v in values)


# --- 1


def brute_components(pairs, num, den, k):
    sets = [shingles(t, k) for _, t in pairs]
    parent = list(range(len(pairs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    usable = [i for i, (key, _) in enumerate(pairs) if key is not None and sets[i]]
    for a in usable:
        for b in usable:
            both = len(sets[a] & sets[b]) if a < b else 0
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    least = defaultdict(list)
    for i in usable:
        least[root(i)].append(pairs[i][0])
    out = []
    for i, (key, _) in enumerate(pairs):
        out.append((key, len(sets[i]), min(least[root(i)]) if i in usable else key))
    return out


@pytest.mark.parametrize(("num", "words", "extra"), [(90, 3, 1.0), (80, 5, 0.5), (50, 2, 0.0)])
def test_jaccard_components(awkward, pairs, num, words, extra, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_ROWS", 4)  # several tiles
    got = jaccard.jaccard_components(awkward, num, 100, words, extra=extra).collect()
    want = brute_components(pairs, num, 100, words)
    assert multiset((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == multiset(want)


def test_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"g{i}" for i in range(150)]
    pairs = []
    for i in range(300):
        w = list(base)
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = f"x{rng.random()}"
        pairs.append((i, " ".join(w)))
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    got = jaccard.jaccard_components(df, 90, 100, 3, extra=1.0).collect()
    assert multiset((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == multiset(brute_components(pairs, 90, 100, 3))


def test_one_of_each(awkward, pairs):
    left = jaccard.one_of_each(awkward, 80, 100, 5)
    assert left.columns == awkward.columns
    wanted = {(k, t) for (k, t), (_, _, c) in zip(pairs, brute_components(pairs, 80, 100, 5), strict=True) if c == k}
    assert multiset((r["doc_id"], r["text"]) for r in left.collect()) == multiset(wanted)


# --- 2


def test_lm_scores(awkward, pairs, spark):
    target = spark.createDataFrame([("w1 w2 w3 the w1",), (None,), ("",), ("don't w1 w2",)], "text string")
    got = multiset((r["doc_id"], r["n_tokens"], round(r["target_loss"], 9), round(r["background_loss"], 9), round(r["score"], 8)) for r in lm.score_against_target(awkward, target).collect())

    def tokens(t):
        return ["<", *re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWERED)), ">"]

    def counts(texts):
        pair, one = Counter(), Counter()
        for t in texts:
            w = tokens(t)
            pair.update(zip(w, w[1:], strict=False))
            one.update(w[1:])
        return pair, one, sum(one.values())

    models = [counts(r["text"] for r in target.collect()), counts(t for _, t in pairs)]
    size = len(set(models[0][1]) | set(models[1][1]))

    def loss(w, pair, one, total):
        one = one | {"<": one[">"]}
        each = [math.log((pair[a, b] + lm.PRIOR * (one.get(b, 0) + 1) / (total + size)) / (one.get(a, 0) + lm.PRIOR)) for a, b in zip(w, w[1:], strict=False)]
        return -sum(each) / len(each)

    want = []
    for key, t in pairs:
        a, b = (loss(tokens(t), *m) for m in models)
        want.append((key, len(tokens(t)) - 1, round(a, 9), round(b, 9), round(a - b, 8)))
    assert got == multiset(want)


def test_lm_blocks_do_not_matter(awkward, spark, monkeypatch):
    target = spark.createDataFrame([("w1 w2",)], "text string")
    whole = multiset((r["doc_id"], round(r["score"], 9)) for r in lm.score_against_target(awkward, target).collect())
    monkeypatch.setattr(lm, "BLOCK_BYTES", 2000)
    assert multiset((r["doc_id"], round(r["score"], 9)) for r in lm.score_against_target(awkward, target).collect()) == whole


# --- 4


def brute_passages(pairs, length):
    raw = [(t or "").encode() for _, t in pairs]
    seen = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for (key, _), t in zip(pairs, raw, strict=True):
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        cover = np.cumsum(gone)[: len(t)] > 0
        kept = bytes(b for b, c in zip(t, cover, strict=True) if not c)
        runs = sum(bool(c) and (i == 0 or not cover[i - 1]) for i, c in enumerate(cover))
        out.append((key, len(t), int(cover.sum()), runs, kept))
    return out


@pytest.mark.parametrize("bucket", [8 << 20, 700])
def test_passages(awkward, pairs, bucket, monkeypatch):
    monkeypatch.setattr(suffixes, "_BUCKET_BYTES", bucket)  # the small one cuts groups across buckets
    short = [(k, t) for k, t in pairs if len(t or "") < 5000]
    df = awkward.filter("text IS NULL OR length(text) < 5000")
    got = suffixes.drop_repeated_passages(df, 100)
    assert multiset(tuple(r) for r in got.collect()) == multiset(brute_passages(short, 100))


@pytest.mark.parametrize("bucket", [8 << 20, 3000])
def test_passages_with_runs_of_nul(spark, bucket, monkeypatch):
    """Texts that others continue with U+0000 only, so that they differ in length alone."""
    monkeypatch.setattr(suffixes, "_BUCKET_BYTES", bucket)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(40):
        x = "".join(rng.choice(list("abcdefgh \x00"), rng.integers(128, 170)))
        rows += [(4 * i, x + "\x00" * 75), (4 * i + 1, x), (4 * i + 2, x + "\x00" * 75), (4 * i + 3, "\x00" * int(i) + x + "\x00" * 40)]
    rows += [(1000 + i, "same start " + "\x00" * (180 + i)) for i in range(60)]  # one large group
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffixes.drop_repeated_passages(df, 200)
    assert multiset(tuple(r) for r in got.collect()) == multiset(brute_passages(rows, 200))


def test_passages_of_long_texts(awkward, pairs):
    long = [(k, t.encode()) for k, t in pairs if k in (410, 411)]
    times = Counter(hash(t[i : i + 200]) for _, t in long for i in range(len(t) - 199))
    want = {}
    for k, t in long:
        again = [i for i in range(len(t) - 199) if times[hash(t[i : i + 200])] > 1]
        assert again == list(range(again[0], again[-1] + 1))  # one run
        want[k] = again[-1] + 200 - again[0]
    got = {r["doc_id"]: r["n_removed"] for r in suffixes.drop_repeated_passages(awkward, 200).collect() if r["doc_id"] in want}
    assert got == want


def test_without_passages_keeps_columns(awkward, pairs):
    out = suffixes.without_repeated_passages(awkward, 100)
    assert out.columns == awkward.columns and out.count() == len(pairs)
    brute = dict(((k, t), kept) for (k, t), (*_, kept) in zip(pairs, brute_passages([(k, t if len(t or "") < 5000 else "") for k, t in pairs], 100), strict=True))
    again = {(r["doc_id"], r["_runs"]): r["text"] for r in out.collect()}
    for r in awkward.collect():
        if len(r["text"] or "") < 5000:
            text = again[r["doc_id"], r["_runs"]]
            assert (text is None) == (r["text"] is None)
            assert (text or "") == brute[r["doc_id"], r["text"]].decode(errors="ignore")


def test_multikey_quicksort():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 3, (5000, 6)).astype(np.uint64)
    order = suffixes.multikey_order(words)
    assert [tuple(w) for w in words[order]] == sorted(map(tuple, words))


# --- 5


def test_fingerprints(awkward, pairs):
    got = fingerprints.fingerprint_documents(awkward).collect()
    by_set = defaultdict(set)
    texts = defaultdict(list)
    for k, t in pairs:
        texts[k].append(t)
    for r in got:
        if len(texts[r["doc_id"]]) == 1:
            by_set[frozenset(shingles(texts[r["doc_id"]][0], 5))].add(r["fingerprint"])
    assert all(len(f) == 1 for f in by_set.values())
    assert by_set[frozenset()] == {""}


def test_edit_likeness(awkward, pairs):
    got = fingerprints.edit_likeness(awkward).collect()
    assert multiset((r["doc_id"],) for r in got) == multiset((k,) for k, _ in pairs)
    single = [(k, t or "") for k, t in pairs if k is not None and sum(x == k for x, _ in pairs) == 1]
    order = sorted(((k if k is not None else -(1 << 63), t or "") for k, t in pairs), key=lambda x: -x[0])
    following = {order[i][0]: order[(i + 1) % len(order)] for i in range(len(order))}
    by_key = {r["doc_id"]: r for r in got}
    for k, t in single:
        nk, nt = following[k]
        if sum((x if x is not None else -(1 << 63)) == nk for x, _ in pairs) > 1:
            continue  # ties are in the order of their hash
        want = t[: len(t) - len(t) // 3] + nt[: len(t) // 3]
        r = by_key[k]
        assert r["edited_sha256"] == hashlib.sha256(want.encode()).hexdigest() and r["n_chars"] == len(t)
        a, b, c = shingles(t, 5), shingles(want, 5), shingles(nt, 5)
        assert abs(r["near_edited"] - (len(a & b) / len(a | b) if a | b else 1.0)) < 0.16
        assert abs(r["near_next"] - (len(a & c) / len(a | c) if a | c else 1.0)) < 0.16


def test_next_across_ranges(spark):
    df = spark.range(0, 50).selectExpr("id * 7 AS doc_id", "concat('text ', id) AS text").repartition(4)
    placed = fingerprints.with_next(df, rows_per_range=6)
    assert placed.filter("NOT _guest").count() == 50
    assert placed.filter("_guest").count() == placed.select("_range").distinct().count()
    got = {r["doc_id"]: r["edited_sha256"] for r in fingerprints.edit_likeness(df).collect()}
    for i in range(50):
        t, n = f"text {i}", f"text {(i - 1) % 50}"
        assert got[i * 7] == hashlib.sha256((t[: len(t) - len(t) // 3] + n[: len(t) // 3]).encode()).hexdigest()


# --- 6 and 9


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pretokens_as_the_library(library):
    rng = random.Random(1)
    letters = list("ab'stvremld  \n\t!.,'1٣éß中  \x1c\x85​😀ñ")
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(3000)] + ["don't we've 'tis it's's 'll\n's", "", None, "  ", " a", "a  "]
    encoder = pretokens.WordEncoder(lambda ws: [library._encode_single_piece(w) for w in ws], keep=500)
    for part, data, offsets in chunks(iter([pa.RecordBatch.from_pydict({"text": texts})]), "text", 4000):
        ids, at = encoder(data, offsets)
        for i, t in enumerate(part.column("text").to_pylist()):
            assert ids[at[i] : at[i + 1]].tolist() == library.encode_ordinary(t or "")


def test_bpe_round_trip(awkward, pairs, ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 3000)
    encoded = bpe.encode_documents(awkward, ranks, public_tokenizers.PATTERN)
    got = multiset((r["doc_id"], tuple(r["ids"])) for r in encoded.collect())
    assert got == multiset((k, tuple(library.encode_ordinary(t or ""))) for k, t in pairs)
    decoded = bpe.decode_documents(encoded, ranks)
    assert multiset((r["doc_id"], bytes(r["decoded"])) for r in decoded.collect()) == multiset((k, (t or "").encode()) for k, t in pairs)


@pytest.fixture(scope="module")
def vocabulary():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


def test_packing(awkward, pairs, vocabulary):
    library = Tokenizer.from_str(vocabulary)
    library.encode_special_tokens = True
    got = rows(packing.pack_documents(awkward, vocabulary, limit=64, with_ids=True))
    sequences = defaultdict(list)
    for r in got:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    want = Counter()
    for k, t in pairs:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want.update((k, s, tuple(ids[s : s + 64]), len(ids)) for s in range(0, len(ids), 64))
    assert multiset((r["doc_id"], r["start"], tuple(r["ids"]), r["doc_tokens"]) for r in got) == want
    assert len(sequences) <= 1.02 * math.ceil(sum(r["length"] for r in got) / 64) + 1


def test_rows_without_a_key_stay(spark):
    text = "the same words in every one of these rows"
    docs = [(None, text), (None, text), (None, None), (None, None), (None, ""), (5, text), (5, text), (6, text), (7, None), (7, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    got = multiset((r["doc_id"], r["text"]) for r in jaccard.one_of_each(df).collect())
    assert got == Counter([*docs[:5], (5, text), (7, None)])


def test_packing_added_tokens(spark, vocabulary):
    """The file's added token in the text has its own id, as in the library's default encoding."""
    end = "<|endoftext|>"
    texts = ["ab" + end + "cd", end, end * 3, "<|endof", "text|>", f" a {end} b\n\n{end}  é", None, "", end[:-1], f"<{end}>", "plain text", "😀" + end]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    library, want = Tokenizer.from_str(vocabulary), Counter()
    for k, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want.update((k, s, tuple(ids[s : s + 4]), len(ids)) for s in range(0, len(ids), 4))
    got = rows(packing.pack_documents(df, vocabulary, limit=4, with_ids=True))
    assert multiset((r["doc_id"], r["start"], tuple(r["ids"]), r["doc_tokens"]) for r in got) == want
    assert (0, 0, (397, 50256, 10210, 0), 4) in want


def test_shortest_pack_first():
    patterns = packing.shortest_pack_first({6: 2, 4: 3, 3: 2, 1: 1}, 10)
    used = Counter()
    for pattern, count in patterns:
        assert sum(pattern) <= 10
        for length in pattern:
            used[length] += count
    assert used == {6: 2, 4: 3, 3: 2, 1: 1} and sum(c for _, c in patterns) == 4


# --- 7


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no feature says anything alone
    model = gam.fit_additive(x[:3000], y[:3000], pairs=2)
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.9
    assert gam.fit_additive(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]
    assert (gam.fit_additive(x[:8], np.ones(8)).score(x[:2]) > 0.5).all()


def test_quality_scores(spark, sf_dir, awkward, pairs):
    from textloom.llm.queries import QUERIES

    got = QUERIES["op7_quality_classifier"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    both = got.join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in both]) > 0.95
    known = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (None, 1), (3, None), (4, 7), (400, 0)], "doc_id long, quality int")
    scored = gam.quality_scores(awkward, known).collect()
    assert multiset((r["doc_id"],) for r in scored) == multiset((k,) for k, _ in pairs)
    assert all(0 <= r["score"] <= 1 for r in scored)


def plain_features(text):
    """The statistics of one text, one character or word at a time."""
    raw = (text or "").encode()
    kinds = [
        lambda c: 32 < c < 127 and not chr(c).isalnum(), lambda c: chr(c) in "0123456789", lambda c: 65 <= c <= 90,
        lambda c: 65 <= c <= 90 or 97 <= c <= 122, lambda c: c >= 128, lambda c: c == 32 or 9 <= c <= 13,
    ]
    words, lines = re.findall(rb"[^\x20\x09-\x0D]+", raw), [x for x in raw.split(b"\n") if x]
    low = [w.lower() for w in words]
    runs = [tuple(low[i : i + 3]) for i in range(len(low) - 2)] if len(low) > 2 else [tuple(low)] if low else []
    n, w = max(len(raw), 1), max(len(words), 1)

    def distinct(values):
        return len(set(values)) / len(values) if values else 1.0

    return [
        math.log1p(len(raw)), math.log1p(len(words)), sum(map(len, words)) / w, *(sum(map(k, raw)) / n for k in kinds),
        distinct(words), distinct(runs), distinct(lines), math.log1p(len(raw) / max(len(lines), 1)),
        sum(not any(kinds[3](c) or c >= 128 for c in x) for x in words) / w, sum(kinds[0](x[-1]) for x in words) / w,
        sum(raw.count(c) for c in b"!.?") / w, max(Counter(c for c in raw if kinds[0](c)).values(), default=0) / n,
    ]


def plain_score(model, x):
    """A sum of table cells, cell by cell."""
    def cell(cuts, value):
        return sum(value >= c for c in cuts)

    total = model.base + sum(t[cell(model.cuts[j], x[j])] for j, t in enumerate(model.tables))
    total += sum(t[cell(model.pair_cuts[a], x[a])][cell(model.pair_cuts[b], x[b])] for (a, b), t in model.pairs.items())
    return 1 / (1 + math.exp(-total))


def test_quality_equals_plain_python(spark, awkward, pairs):
    """Features and scores of every row against a plain version, by a model with tables and pair tables."""
    more = [f"{'good words here. ' * (i % 7)}{'!!# 12 ' * (i % 5)}\n{'Line\n' * (i % 3)}x{i}" for i in range(200)]
    df = awkward.select("doc_id", "text").unionByName(spark.createDataFrame([(5000 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    everything = [*pairs, *((5000 + i, t) for i, t in enumerate(more))]
    table = gam.feature_table(df)
    want = {k: [] for k, _ in everything}
    for k, t in everything:
        want[k].append(plain_features(t))
    got = table.collect()
    assert len(got) == len(everything)
    for k, vectors in want.items():
        mine = sorted(r["features"] for r in got if r["doc_id"] == k)
        assert np.allclose(np.array(mine), np.array(sorted(vectors)), rtol=1e-9, atol=1e-12), k
    x = np.array([r["features"] for r in got])
    y = np.array([float((r["doc_id"] or 0) % 3 == 0) for r in got])
    model = gam.fit_additive(x, y, rounds=12)
    assert model.tables and model.pairs
    scored = sorted((r["doc_id"] or -1, r["score"]) for r in gam.score_quality(table, model).collect())
    plain = sorted((r["doc_id"] or -1, plain_score(model, r["features"])) for r in got)
    assert [k for k, _ in scored] == [k for k, _ in plain]
    assert np.allclose([v for _, v in scored], [v for _, v in plain], rtol=1e-9, atol=1e-12)
    kept = gam.keep_quality(df, model, 0.4).count()
    assert kept == sum(v >= 0.4 for _, v in plain)


def test_repeated_keys_do_not_enlarge_the_fit(spark, monkeypatch):
    """A key with a third of all rows and repeated labels gives one row of the fit."""
    docs = spark.createDataFrame([(i if i % 3 else 0, f"text {i}. " * (i % 9)) for i in range(600)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)] + [(0, 0)] * 50, "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(gam, "fit_additive", lambda x, y: seen.append(len(y)))
    gam.train_quality(gam.feature_table(docs), labels, "quality")
    assert seen == [401]


def test_keep_quality_keeps_columns(awkward):
    model = gam.AdditiveModel(1.0)
    assert gam.keep_quality(awkward, model).count() == awkward.count()
    assert gam.keep_quality(awkward, model, 0.9).count() == 0
    assert gam.keep_quality(awkward, model).columns == awkward.columns


# --- 10

BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit", "w1 w2": "pair"}


def test_licenses(awkward, pairs, spark):
    more = ["MIT License, mit  LICENSE", "Xmit license", "cc-by cc by-nc 4.0", "apache\nlicense", "GNU General Public License v3", "w1 w2 w1 w2",
            "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 */"]
    df = awkward.select("doc_id", "text").unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    got = licenses.scan_licenses(df, BASE).collect()
    want = Counter()
    for k, t in [*pairs, *((1000 + i, t) for i, t in enumerate(more))]:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWERED))
        hits = [(i, label) for p, label in BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        want[k, len(w), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None), ",".join(sorted({x for _, x in hits}))] += 1
    assert multiset((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got) == want
    by_key = {r["doc_id"]: r for r in got}
    assert by_key[1006]["labels"] == "apache,gpl,mit" and by_key[1006]["permissive"] is False
    assert by_key[1002]["labels"] == "cc-by,cc-by-nc" and by_key[402]["labels"] == "" and by_key[402]["score"] == 0.0
    assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got)


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("MIT", (["mit"], True)),
        ("MIT OR GPL-3.0-or-later", (["gpl", "mit"], True)),
        ("MIT AND GPL-3.0-or-later", (["gpl", "mit"], False)),
        ("GPL-2.0 AND MIT OR ISC", (["gpl", "isc", "mit"], True)),
        ("GPL-2.0 AND (MIT OR ISC)", (["gpl", "isc", "mit"], False)),
        ("Apache-2.0 WITH LLVM-exception -->", (["apache"], True)),
        ("((MIT))", (["mit"], True)),
        ("NOASSERTION", ([], None)),
        ("LicenseRef-x", (["licenseref-x"], None)),
        ("LicenseRef-x AND GPL-2.0", (["gpl", "licenseref-x"], False)),
        ("LicenseRef-x OR MIT", (["licenseref-x", "mit"], True)),
        ("NONE OR GPL-2.0", (["gpl"], None)),
        ("CC-BY-NC-4.0", (["cc-by-nc"], False)),
        ("CC-BY-4.0", (["cc-by"], True)),
        ("MIT OR", None),
        ("(MIT", None),
        ("", None),
    ],
)
def test_expressions(text, found):
    assert licenses.evaluate(text) == found


@pytest.mark.parametrize(
    "text",
    [
        None, "", ":", "SPDX-License-Identifier:", "SPDX-License-Identifier: MIT", "xSPDX-license-IDENTIFIER:MIT\r\nGPL", "é SPDX-License-Identifier:\tISC \n",
        "SPDX License Identifier: MIT", "SPDX-License-Identifier : MIT", "spdx-license-identifier MIT", "SPDX-License-Identifier: A é 中\rB",
        "SPDX-License-Identifier: SPDX-License-Identifier: MIT", "a\nSPDX-License-Identifier: NOASSERTION\nSPDX-License-Identifier: GPL-2.0\n" * 3,
        "-SPDX-License-Identifier:\nMIT license " + "word " * 20000 + "SPDX-License-Identifier: 0BSD",
    ],
)
def test_tags_of_one_text(text):
    """Tags by the automaton are those of a plain pattern over the text."""
    found = re.findall(r"spdx-license-identifier:[ \t]*([^\r\n]*)", text or "", re.IGNORECASE | re.ASCII)
    want = [e.strip() for e in found if licenses.evaluate(e)]
    if text and text.count("SPDX-License-Identifier: SPDX"):
        want = ["MIT"]  # every tag is read, also one in the line of another
        assert licenses.scan_text(text, ())["expressions"][-1:] == want
    else:
        assert licenses.scan_text(text, ())["expressions"] == want


# --- all


def test_empty_tables(spark, empty, ranks, vocabulary):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert jaccard.jaccard_components(empty).count() == 0
    assert jaccard.one_of_each(empty).count() == 0
    assert lm.score_against_target(empty, empty).count() == 0
    assert suffixes.drop_repeated_passages(empty).count() == 0
    assert suffixes.without_repeated_passages(empty).count() == 0
    assert fingerprints.edit_likeness(empty).count() == 0
    assert bpe.decode_documents(bpe.encode_documents(empty, ranks, public_tokenizers.PATTERN), ranks).count() == 0
    assert packing.pack_documents(empty, vocabulary).count() == 0
    assert gam.quality_scores(empty, labels).count() == 0
    assert licenses.scan_licenses(empty, BASE).count() == 0


def test_empty_target(awkward, spark):
    scored = lm.score_against_target(awkward, spark.createDataFrame([], "text string")).collect()
    assert len(scored) == awkward.count() and len({round(r["target_loss"], 9) for r in scored}) == 1


def test_groups_across_batches():
    table = pa.table({"k": [1, 1, 1, 2, 3, 3], "v": list(range(6))})
    got = []
    list(groups(iter(table.to_batches(max_chunksize=2)), ["k"], lambda t: got.append(t.column("v").to_pylist()) or []))
    assert got == [[0, 1, 2], [3], [4, 5]]


def test_read_ranks(ranks):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        token, rank = next(lines).split()
    assert ranks[base64.b64decode(token)] == int(rank) and len(ranks) == 50_256
