"""Cleaning and packing against a row-by-row restatement of the rules, on awkward random texts."""

import random
import re
import unicodedata
from urllib.parse import quote, unquote

import pytest
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions.packing import pack_code, pack_paragraphs

ALPHABET = ["a", "Z", "é", "é", "ñ", "ﬁ", ".", "!", "? ", ". ", " ", "  ", "\t", "\n", "\n\n", "\n\n\n\n", "\r\n",
            "​", "﻿", " ", "", "\x1c", "\x00", "😀", "　", " ", "한", "가", "word ", "b" * 50]


def random_texts(n, seed, longest=120):
    rng = random.Random(seed)
    texts = ["", " ", "\n", "x", "." * 5, "a. b! c? d"]
    for _ in range(n):
        texts.append("".join(rng.choice(ALPHABET) for _ in range(rng.randrange(longest))))
    texts.append("w" * 2100 + ". " + "short. " * 400 + "\n\n" + "tail " * 40)
    return texts


def applied(spark, texts, expression):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(8)
    found = rows.select("i", expression(F.col("t")).alias("r")).collect()
    return [r.r for r in sorted(found, key=lambda r: r.i)]


def without_controls(text, kept):
    return "".join(c for c in text if c in kept or not unicodedata.category(c).startswith("C"))


def prose(text):
    text = without_controls(unicodedata.normalize("NFC", text), "\n ")
    for pattern, new in [(r"\n{3,}", "\n\n"), (r"[ \t]+", " "), (r" *\n *", "\n")]:
        text = re.sub(pattern, new, text)
    return text.strip()


def code(text):
    text = re.sub(r"\n{5,}", "\n\n\n", without_controls(unicodedata.normalize("NFC", text), "\n\t "))
    return "\n".join(line.rstrip(" \t") for line in text.split("\n")).strip()


def grown(pieces, gap, limit):
    """Groups of a next-fit packing as (index of the piece that closed it, joined text)."""
    groups, held = [], None
    for at, piece in pieces:
        if held is not None and len(held) + len(gap) + len(piece) <= limit:
            held += gap + piece
        else:
            if held is not None:
                groups.append((at, held))
            held = piece
    return groups + ([(10**9, held)] if held is not None else [])


def packed(text, limit, least):
    paragraphs = [(i, p.strip()) for i, p in enumerate(re.split(r"\n{2,}", text)) if p.strip()]
    found = [(at, 0, t) for at, t in grown([p for p in paragraphs if len(p[1]) <= limit], "\n\n", limit)]
    for at, paragraph in paragraphs:
        if len(paragraph) > limit:
            parts = enumerate(re.split(r"(?<=[.!?])\s+", paragraph))
            found += [(at, k, t) for k, (_, t) in enumerate(grown(parts, " ", limit))]
    return [t for _, _, t in sorted(found) if len(t) >= least]


def packed_code(text, limit, least):
    blocks, held = [], []
    for line in text.split("\n"):
        held.append(line)
        size = sum(map(len, held)) + len(held) - 1
        if size >= 1.5 * limit or (size >= limit and not line.strip()):
            blocks.append(held)
            held = []
    return [b for b in ("\n".join(h).strip() for h in [*blocks, held]) if len(b) >= least]


def test_whitespace_is_what_python_strips():
    assert set(T.WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def characters(ranges):
    spans = re.findall(r"\\x\{([0-9A-F]+)\}(?:-\\x\{([0-9A-F]+)\})?", ranges)
    return {chr(c) for lo, hi in spans for c in range(int(lo, 16), int(hi or lo, 16) + 1)}


def test_plain_ranges():
    plain = characters(T.PLAIN_LOW + T.PLAIN_HIGH)
    assert plain <= characters(T.NFC_LOW + T.NFC_HIGH)
    assert not any(unicodedata.category(c).startswith("C") for c in plain)


@pytest.mark.parametrize("form, ranges", [("NFC", T.NFC_LOW + T.NFC_HIGH), ("NFKC", T.NFKC_LOW + T.NFKC_HIGH)])
def test_stable_ranges(form, ranges):
    stable = characters(ranges)
    assert all(unicodedata.normalize(form, c) == c and not unicodedata.combining(c) for c in stable)
    seconds = {chr(c) for c in range(0x1161, 0x11C3)}  # jamo that complete a syllable
    for c in range(0x110000):
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            seconds.add(chr(int(parts[1], 16)))
    assert not stable & seconds


def test_cleaning(spark):
    texts = random_texts(400, 1)
    assert applied(spark, texts, T.nfc) == [unicodedata.normalize("NFC", t) for t in texts]
    assert applied(spark, texts, T.nfkc) == [unicodedata.normalize("NFKC", t) for t in texts]
    assert applied(spark, texts, T.strip) == [t.strip() for t in texts]
    assert applied(spark, texts, T.clean_prose) == [prose(t) for t in texts]
    assert applied(spark, texts, T.clean_code) == [code(t) for t in texts]


@pytest.mark.parametrize("limit, least", [(60, 10), (2000, 150)])
def test_packing(spark, limit, least):
    texts = [prose(t) for t in random_texts(300, 2)]
    assert applied(spark, texts, lambda c: pack_paragraphs(c, limit, least)) == [packed(t, limit, least) for t in texts]
    texts = [code(t) for t in random_texts(300, 3)]
    assert applied(spark, texts, lambda c: pack_code(c, limit, least)) == [packed_code(t, limit, least) for t in texts]


def test_long_paragraph_does_not_close_the_open_group(spark):
    text = "first part\n\n" + "One sentence. " * 10 + "\n\nlast part"
    assert applied(spark, [text], lambda c: pack_paragraphs(c, 60, 5))[0][-1] == "first part\n\nlast part"


def test_titles(spark):
    titles = ["Año_nuevo", "a+b c", "100%", "50%_caf%C3%A9", "C%2B%2B", "x*y~z", "(a)/b:c", "ñ&?=#", "%zz", "HTTP/2"]
    assert applied(spark, titles, T.encode_title) == [quote(unquote(t), safe="_:()/") for t in titles]


def test_paths(spark):
    names = ["a.py", "x/.gitignore", "x/..b", "a/b.tar.gz", "noext", "dir.d/file", "a.", ".a.b", "x/...", "a/b/"]
    from os.path import splitext

    assert applied(spark, names, T.extension) == [splitext(n.split("/")[-1])[1] for n in names]
    assert applied(spark, names, T.base_name) == [n.split("/")[-1] for n in names]


def test_banners(spark):
    start, end = "*** START OF THIS PROJECT GUTENBERG EBOOK X ***", "*** END OF THE PROJECT GUTENBERG EBOOK X"
    texts = [
        f"head\n\n{start}\n\n\nbody\n\nmore\n\n{end}\ntail",
        f"head\r\n\r\n{start}\r\n\r\nbody\r\n{end}",
        "no marks at all",
        f"body first {end} rest",
        f"{start} no blank line",
    ]
    assert applied(spark, texts, T.trim_banner) == [
        "body\n\nmore",
        f"head\r\n\r\n{start}\r\n\r\nbody",
        "no marks at all",
        "body first",
        f"{start} no blank line",
    ]


def test_texts_reach_python_in_small_batches(spark):
    from textloom import session

    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(rows), spark.conf.get(size)
    try:
        for given, kept in ((("10000", "64m"), ("1000", str(16 << 20))), (("0", "1g"), ("1000", str(16 << 20))), (("300", "1000000"), ("300", "1000000"))):
            spark.conf.set(rows, given[0])
            spark.conf.set(size, given[1])
            session.spread(spark.range(3))
            assert (spark.conf.get(rows), spark.conf.get(size).rstrip("b")) == kept
    finally:
        spark.conf.set(rows, before[0])
        spark.conf.set(size, before[1])


def test_blocks_of_words_do_not_grow_with_the_batch(monkeypatch):
    import pyarrow as pa

    from textloom.operators import scoring

    monkeypatch.setattr(scoring, "BLOCK_WORDS", 10)
    lists = [["a"] * n for n in (3, 4, 5, 0, 30, 1)] + [None, ["b"] * 9]
    parts = list(scoring._block_parts(pa.RecordBatch.from_pydict({"_w": pa.array(lists, pa.list_(pa.string()))})))
    assert [w for p in parts for w in p.column("_w").to_pylist()] == lists
    assert max(len(p.column("_w").flatten()) for p in parts) == 30 and len(parts) == 3
    assert list(scoring._block_parts(parts[0].slice(0, 0)))[0].num_rows == 0
