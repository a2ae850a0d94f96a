"""Books in pieces give what their whole texts give."""

import io
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.functions.packing import pack_paragraphs
from textloom.functions.text import BOOK_END, BOOK_START, clean_prose, trim_banner
from textloom.session import materialised
from textloom.sources import books


def book(rng, paragraphs):
    words = ["uno", "dos", "é", "　", "tres.", "\x07", "fin!", "  ", " ", "x" * 30]

    def line():
        return " ".join(rng.choice(words) for _ in range(rng.randrange(1, 14)))

    out = []
    for _ in range(paragraphs):
        out.append("\n".join(line() for _ in range(rng.choice([1, 1, 2, 5, 20]))))
        out.append(rng.choice(["\n\n", "\n\n", "\n \n", "\n\n\n\n", "\n", " \n　\n", "\n\r\n", "\n\n \n\n"]))
    for _ in range(rng.choice([0, 0, 1, 2])):
        mark = rng.choice(BOOK_START + BOOK_END + ["***  END OF THE PROJECT GUTENBERG EBOOK"])
        out.insert(rng.randrange(len(out)), rng.choice(["", "\n", "antes "]) + mark + rng.choice([" X ***\n\n", " X ***\n", "\n \n", "\r\n\r\n"]))
    text = "".join(out)
    return text.replace("\n", "\r\n") if rng.random() < 0.15 else text


@pytest.mark.parametrize("size", [40, 300, 2_000])
def test_pieces_give_what_whole_books_give(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(books, "PIECE_BYTES", size)
    rng = random.Random(size)
    texts = {i: book(rng, rng.randrange(1, 60)) for i in range(50)}
    for i, text in texts.items():
        raw = text.encode()
        if i % 3:
            (tmp_path / f"{i}-0.txt").write_bytes(raw)
        else:  # landed in parts, which are numbered and end with a line
            lines = io.BytesIO(raw).readlines()
            for k in range(0, len(lines), 9):
                (tmp_path / f"{i}-0.{k}.txt").write_bytes(b"".join(lines[k : k + 9]))
    limit, least = 200, 30
    rows = materialised(spark.createDataFrame(list(texts.items()), "id int, t string").select("id", trim_banner(F.col("t")).alias("t")))
    whole = pack_paragraphs(clean_prose(F.col("t")), limit, least)
    expected = {(str(r.id), k): t for r in rows.select("id", whole.alias("f")).collect() for k, t in enumerate(r.f)}
    read = books.read_pieces

    def read_in_small_blocks(spark, path):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
        try:
            return materialised(read(spark, path).coalesce(4))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")

    monkeypatch.setattr(books, "read_pieces", read_in_small_blocks)
    got = books.landed_book_fragments(spark, str(tmp_path), limit, least).collect()
    found = {(r.doc_key, r.frag_idx): r.text for r in got}
    assert len(found) == len(got) and len(found) > 200
    assert found == expected


def test_no_row_has_a_whole_book(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(books, "PIECE_BYTES", 1_000)
    text = "\n\n".join(f"Libro uno, párrafo {i}. " + "palabra " * 10 for i in range(400))
    (tmp_path / "1-0.txt").write_text(text)
    sizes = [r.n for r in books.read_pieces(spark, str(tmp_path)).select(F.length("text").alias("n")).collect()]
    assert len(sizes) > 20 and max(sizes) < 1_200 and sum(sizes) >= len(text)


def test_first_copy_with_fragments(spark, tmp_path):
    long = "una frase bastante larga " * 10
    for name, text in {"7-0": "corto", "7-2": long + "dos", "7-11": long + "once", "8": long, "x-0": long, "9-1": ""}.items():
        (tmp_path / f"{name}.txt").write_text(text)
    found = [(r.source, r.doc_key, r.frag_idx, r.text) for r in books.landed_book_fragments(spark, str(tmp_path)).collect()]
    assert found == [("gutenberg", "7", 0, long + "dos")]


def test_lines_of_a_block_over_many_batches():
    rows = [("a", 0, b"x" * 10), ("a", 0, b"\xff"), ("a", 9, b"y"), ("b", 0, b"")]
    batches = [pa.RecordBatch.from_pydict({"path": [p], "block": [b], "line": [t]}) for p, b, t in rows]
    found = [tuple(x[0] for x in batch.to_pydict().values()) for batch in books._pieces(iter(batches))]
    assert found == [("a", 0, 0, "x" * 10 + "\n\n"), ("a", 9, 0, "y\n"), ("b", 0, 0, "\n")]


def test_open_groups_from_lengths_alone():
    rng = random.Random(5)
    for _ in range(300):
        limit = rng.randrange(3, 60)
        sizes = [rng.randrange(1, limit + 1) for _ in range(rng.randrange(1, 30))]
        step = np.array(books.exits(np.array(sizes), limit))
        for before in (-1, *range(1, limit + 1)):
            used, closed = before, False
            for n in sizes:
                fresh = used < 0 or used + n + books.GAP > limit
                used, closed = (n, True) if fresh else (used + n + books.GAP, closed)
            if 0 <= before <= step[0]:
                assert not closed and used == before + step[1]
            else:
                assert closed and used == step[3::2][np.searchsorted(step[2::2], before, side="right") - 1]
