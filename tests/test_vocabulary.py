"""Vocabulary training, encoding and decoding against the public byte-level tokenizer package."""

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.decoders import ByteLevel as ByteLevelDecoder
from tokenizers.models import BPE
from tokenizers.normalizers import NFKC
from tokenizers.pre_tokenizers import ByteLevel
from tokenizers.trainers import BpeTrainer

from textloom.functions.arrays import BOS, EOS, PAD, SPECIAL_TOKENS
from textloom.operators import vocabulary as V
from textloom.plans.examples import example_rows, training_rows
from textloom.queries.vocabulary import learned
from textloom.sources.reference_values import ROUND_TRIP_TEXTS

ODD = ["aaaa aaaaa aaaaaaa", "  dos  espacios \n\n\n y ﬁn ①②", "日本語 한국어 😀😀", "\t\ttab", "it's we'll don't", "x\n\n\ny"]


@pytest.fixture(scope="module")
def trained(spark, sf_dir, tmp_path_factory):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").filter("length(text) < 1500")
    extra = [(10**6 + i, t) for i, t in enumerate(ROUND_TRIP_TEXTS * 3 + ODD)]
    texts = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string")).cache()
    corpus = tmp_path_factory.mktemp("corpus") / "corpus.txt"
    corpus.write_text("".join(r.text + "\n" for r in texts.collect()), encoding="utf-8", newline="\n")
    package = Tokenizer(BPE(unk_token="<unk>"))
    package.normalizer, package.pre_tokenizer = NFKC(), ByteLevel(add_prefix_space=True)
    package.decoder = ByteLevelDecoder()
    trainer = BpeTrainer(vocab_size=260, min_frequency=3, special_tokens=SPECIAL_TOKENS, show_progress=False)
    package.train([str(corpus)], trainer)
    vocabulary, merges = V.train_vocabulary(V.pretoken_counts(texts), 260, 3)
    return texts, package, vocabulary, merges


def test_training_equals_the_package(trained):
    _, package, vocabulary, _ = trained
    assert {r.token: r.id for r in vocabulary.collect()} == package.get_vocab()


def test_encoding_equals_the_package(spark, trained):
    texts, package, vocabulary, merges = trained
    unseen = ["", " ", "Ω≈ç√ unseen bytes", "x <bos> y<eos><pad>z", "tail  "]
    more = texts.unionByName(spark.createDataFrame(list(enumerate(unseen, 10**7)), "doc_id long, text string"))
    coded = V.encode(more, vocabulary, merges)
    back = coded.withColumn("back", V.decode(F.col("ids"), vocabulary)).collect()
    assert all(r.ids == package.encode(r.text).ids for r in back)
    assert all(r.back.strip() == package.decode(r.ids).strip() for r in back)


def test_round_trip_texts(spark, trained):
    _, _, vocabulary, merges = trained
    texts = spark.createDataFrame([(t,) for t in ROUND_TRIP_TEXTS], "text string")
    assert all(r.ok for r in V.round_trip(texts, vocabulary, merges).collect())


def test_min_frequency_and_size_stop_training(spark):
    counts = spark.createDataFrame([(" abab", 5), (" ab", 2), (" zz", 1)], "word string, freq long")
    vocabulary, merges = V.train_vocabulary(counts, 1000, 5)
    assert merges.count() >= 1
    assert {r.token for r in vocabulary.collect()} >= {"ab", "Ġ"}
    assert not vocabulary.filter("token = 'zz'").count()


def test_bytes_and_stand_ins(spark):
    texts = ["".join(map(chr, range(256))), "ñ😀\x00"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    there = V.as_bytes_text(F.col("t"))
    found = rows.select(F.length(there).alias("n"), V.from_bytes_text(there).alias("t")).collect()
    assert [(r.n, r.t) for r in found] == [(len(t.encode()), t) for t in texts]


@pytest.mark.parametrize("tuning", [False, True])
def test_examples(trained, tuning):
    texts, package, vocabulary, merges = trained
    rows = example_rows(V.encode(texts, vocabulary, merges), 32, tuning).collect()
    expected = {}
    for r in texts.collect():
        ids = [BOS, *package.encode(r.text).ids, EOS]
        if len(ids) >= 8:
            if len(ids) > 33:
                ids = [*ids[:32], EOS] if tuning else ids[:33]
            ids += [PAD] * (33 - len(ids))
            expected[r.doc_id] = (ids[:-1], ids[1:])
    assert {r.doc_id: (r.input, r.target) for r in rows} == expected


def test_training_rows(trained):
    texts, _, vocabulary, merges = trained
    rows = training_rows(texts, ["doc_id"], vocabulary, merges, ranks=2, batch_size=3, max_len=16).collect()
    per_batch = {}
    for r in rows:
        per_batch.setdefault((r.split, r["rank"], r.batch), []).append(r)
    assert {len(b) for b in per_batch.values()} == {3}
    train = {r.doc_id for r in rows if r.split == "train"}
    assert not train & {r.doc_id for r in rows if r.split == "val"}


def test_long_words(spark):
    import random
    import time


    rng = random.Random(4)
    text = "".join(rng.choices("abcd", k=400))
    counts = spark.createDataFrame([(text, 1), ("abab", 20), ("cdcd", 30)], "word string, freq long")
    vocabulary, merges = V.train_vocabulary(counts, 200, 1)
    encoder = V.WordEncoder({r.token: r.id for r in vocabulary.collect()}, [tuple(r) for r in merges.collect()])

    def plain(word):
        ids = [encoder.ids.get(encoder.standins[b], 1) for b in word.encode()]
        while True:
            found = [(encoder.merges[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in encoder.merges]
            if not found:
                return ids
            _, at = min(found)
            ids[at : at + 2] = [encoder.merges[ids[at], ids[at + 1]][1]]

    for n in (0, 1, 2, 3, 50, 400):
        word = "".join(rng.choices("abcd", k=n))
        assert encoder.word(word) == plain(word)
    assert encoder.word("aaaaaaa") == plain("aaaaaaa")
    started = time.perf_counter()
    encoder.word("".join(rng.choices("abcd", k=50_000)))
    assert time.perf_counter() - started < 1.5


def test_registered_training_is_whole(spark, sf_dir, tmp_path):
    """The queries' vocabulary: 32,000 ids, or every pair that occurs ten times."""
    corpus = tmp_path / "corpus.txt"
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    corpus.write_text("".join(t + "\n" for t in texts if t is not None), encoding="utf-8", newline="\n")
    package = Tokenizer(BPE(unk_token="<unk>"))
    package.normalizer, package.pre_tokenizer = NFKC(), ByteLevel(add_prefix_space=True)
    package.train([str(corpus)], BpeTrainer(vocab_size=32_000, min_frequency=10, special_tokens=SPECIAL_TOKENS, show_progress=False))
    assert {r.token: r.id for r in learned(spark, sf_dir)[0].collect()} == package.get_vocab()


def test_held_words_train_alike(spark):
    """Counted rounds, bands of held words and all words at once choose the same merges."""
    import random

    rng = random.Random(8)
    stems = ["".join(rng.choices("abcde", k=rng.randint(1, 5))) for _ in range(60)]
    words = {" " + "".join(rng.choices(stems, k=rng.randint(1, 4))): rng.randint(1, 40) for _ in range(400)} | {" aaaaaaa": 9, "aaaa": 7}
    counts = spark.createDataFrame(list(words.items()), "word string, freq long").cache()

    def trained(held_symbols, per_table):
        found = V.train_vocabulary(counts, 60, 6, merges_per_table=per_table, held_symbols=held_symbols)
        return [sorted(tuple(r) for r in t.collect()) for t in found]

    want = trained(10**6, 64)
    assert len(want[1]) > 30
    assert trained(0, 64) == want
    assert trained(2500, 1) == want


def test_vocabulary_is_trained_once(spark, tmp_path, monkeypatch):
    counts = spark.createDataFrame([(" abab", 5), (" ab", 2), (" zz", 1)], "word string, freq long")
    first = [sorted(map(tuple, t.collect())) for t in V.stored_vocabulary(counts, str(tmp_path), 1000, 2)]
    assert first == [sorted(map(tuple, t.collect())) for t in V.train_vocabulary(counts, 1000, 2)]

    def not_again(*args, **kwargs):
        raise AssertionError("trained again")

    monkeypatch.setattr(V, "train_vocabulary", not_again)
    again = V.stored_vocabulary(counts.repartition(3), str(tmp_path), 1000, 2)
    assert [sorted(map(tuple, t.collect())) for t in again] == first
    for other in (counts.filter("freq > 1"), counts.withColumn("freq", F.col("freq") + 1)):
        with pytest.raises(AssertionError, match="trained again"):
            V.stored_vocabulary(other, str(tmp_path), 1000, 2)


def test_linked_pairs_are_one_group():
    live = [("ab", 9, 10), ("cd", 8, 10), ("ef", 7, 10), ("gh", 7, 10), ("ij", 6, 10)]
    links = [(0, 2), (1, 3), (2, 4), (3, 4)]
    assert V._band(live, links, 100) == (5, [V._band(live, links, 100)[1][0]] * 5)
    cut, group = V._band(live, links, 25)  # the last pair would join all
    assert cut == 4 and group[0] == group[2] != group[1] == group[3]
    assert V._band(live, links, 15)[0] == 2  # pairs of one count are taken together
    assert V._band(live, links, 5)[0] == 0


def test_pieces_of_words_train_alike(spark, monkeypatch):
    """A table far above the held symbols is trained in few bands of pieces, with no counted round."""
    import random

    rng = random.Random(9)
    stems = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 5))) for _ in range(60)]
    words = {" " + "".join(rng.choices(stems, k=rng.randint(2, 6))): rng.randint(1, 9) for _ in range(3000)} | {" aaaaaaa": 9, "aaaa": 7}
    counts = spark.createDataFrame(list(words.items()), "word string, freq long").cache()

    def trained(held_symbols):
        found = V.train_vocabulary(counts, 300, 6, merges_per_table=4, held_symbols=held_symbols)
        return [sorted(tuple(r) for r in t.collect()) for t in found]

    want = trained(10**6)

    def not_counted(*args):
        raise AssertionError("a counted round")

    monkeypatch.setattr(V, "Neighbours", not_counted)
    assert sum(map(len, words)) > 30_000 and trained(12_000) == want


def test_words_are_cut_at_other_pairs():
    assert list(V._cut("abcdeab", {"ab", "bc", "de"})) == ["abc", "de", "ab"]
    assert list(V._cut("a", {"ab"})) == list(V._cut("acac", {"ab"})) == []
