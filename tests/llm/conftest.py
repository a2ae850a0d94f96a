import random

import pytest

LONG = " ".join(f"wort{i % 977} straße{i % 13}" for i in range(30_000))


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with null keys and texts, empty, one-word and long texts, repeated rows, ties and odd columns."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)] + ["don't", "Café", "naïve", "😀", "it's", "42", " x", "A", "the"]
    base = [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t) for i, t in enumerate(base[:6])]  # exact copies
    for i, t in enumerate(base):  # near copies
        parts = t.split(" ")
        parts[rng.randrange(len(parts))] = f"changed{i}"
        rows.append((200 + i, " ".join(parts)))
    passage = " ".join(rng.choices(words, k=70))
    rows += [(300 + i, f"{base[i]}\n{passage}\n{base[-i - 1]}") for i in range(6)]
    rows += [(400, None), (401, None), (402, ""), (403, ""), (404, "   \n\t "), (405, "word"), (406, "word"), (407, "two words")]
    rows += [(408, "=" * 700), (409, "ab" * 300), (410, LONG), (411, LONG + " end"), (412, "\x00 \x00 nul"), (413, "é" * 250)]
    rows += [(0, base[0]), (0, base[0]), (1, "another text with the key of one"), (None, base[2]), (None, None), (None, "no key at all " * 30)]
    rng.shuffle(rows)
    schema = "doc_id long, text string, row long, n long, digest string, ids string, features string, _runs int, _text_hash int, _range int, length int"
    return spark.createDataFrame([(k, t, 1, None, "x", "y", "z", i, None, 7, 0) for i, (k, t) in enumerate(rows)], schema).repartition(5).cache()


@pytest.fixture(scope="session")
def pairs(awkward):
    """The same documents as a list of key and text."""
    return [(r["doc_id"], r["text"]) for r in awkward.collect()]


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)
