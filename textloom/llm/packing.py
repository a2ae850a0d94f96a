"""Packing documents into sequences: shortest-pack-first over the length histogram."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textloom.llm.arrays import chunks
from textloom.llm.pretokens import WordEncoder
from textloom.session import materialised

#: Printable stand-ins of the bytes in the vocabulary file: visible Latin-1 characters stand for themselves, the
#: rest for the characters from U+0100 on.
_SELF = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_STAND_IN = dict(zip([*_SELF, *(b for b in range(256) if b not in _SELF)], [*_SELF, *range(256, 512)], strict=False))
#: Words that a Python worker remembers from one task to the next.
REMEMBERED = 700_000

_encoders: dict[int, TextEncoder] = {}


class TextEncoder:
    """Ids of the texts of a chunk as the library's `encode` gives them: texts are split at the file's added tokens,
    which have ids of their own, and the parts between them are pre-tokens."""

    def __init__(self, words: WordEncoder, added: dict[bytes, int]):
        self.words, self.added = words, added
        longest_first = sorted(added, key=len, reverse=True)
        self._pattern = re.compile(b"|".join(map(re.escape, longest_first))) if added else None

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and where each row's begin (rows + 1)."""
        raw = data.tobytes()
        if self._pattern is None or not self._pattern.search(raw):
            return self.words(data, offsets)
        rows = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
        found = [(m.start(), m.end(), self.added[m.group()]) for a, b in rows for m in self._pattern.finditer(raw, a, b)]
        begin, end, token = np.array(found, np.int64).reshape(-1, 3).T
        bounds = np.sort(np.concatenate([offsets, begin, end]))
        ids, at = self.words(data, bounds)
        part = np.searchsorted(bounds, begin, "right") - 1  # the parts that are added tokens: one id each
        size, lone = np.diff(at), np.zeros(len(bounds) - 1, bool)
        lone[part] = True
        dropped = np.repeat(lone, size)
        dropped[at[part]] = False
        ids[at[part]] = token
        first = np.concatenate([[0], np.cumsum(np.where(lone, 1, size))])
        return ids[~dropped], first[np.searchsorted(bounds, offsets)]


def text_encoder(vocabulary: str) -> TextEncoder:
    """The encoder of a vocabulary file's content, kept by the Python worker."""
    if (key := hash(vocabulary)) not in _encoders:
        library = Tokenizer.from_str(vocabulary)
        model, added = library.model, library.get_added_tokens_decoder()
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values()):
            raise ValueError("added tokens are only known as plain strings, found in the text as it is")

        def encode(words: list[bytes]) -> list[list[int]]:
            return [[t.id for t in model.tokenize(w.decode("latin-1").translate(_STAND_IN))] for w in words]

        _encoders.clear()
        _encoders[key] = TextEncoder(WordEncoder(encode, REMEMBERED), {t.content.encode(): i for i, t in added.items()})
    return _encoders[key]


def token_pieces(docs: DataFrame, vocabulary: str, limit: int, end_id: int, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of at most `limit` ids of every document, `end_id` included; only the last one is shorter.

    Columns: `key`, `start`, `length`, `ids_crc32`, `doc_tokens`, with `with_ids` also `ids`, and the
    partition `_part` with the piece's number `_at` among the pieces of its length there.
    """
    key_type = docs.schema[key].dataType.simpleString()
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "_part", "_at", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = text_encoder(vocabulary), TaskContext.get().partitionId(), np.zeros(limit + 1, np.int64)
        for rows, data, offsets in chunks(batches, text):
            ids, first = encoder(data, offsets)
            ids = np.insert(ids, first[1:], end_id).astype("<u4")
            tokens = np.diff(first) + 1
            cuts = -(-tokens // limit)
            row = np.repeat(np.arange(len(tokens)), cuts)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * limit
            length = np.minimum(limit, tokens[row] - start)
            begin = (np.cumsum(tokens) - tokens)[row] + start
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
            at = np.empty(len(row), np.int64)
            order = np.argsort(length, kind="stable")
            sizes, counts = np.unique(length, return_counts=True)
            at[order] = np.concatenate([seen[s] + np.arange(c) for s, c in zip(sizes, counts, strict=True)]) if len(sizes) else []
            seen[sizes] += counts
            columns = [rows.column(key).take(pa.array(row)), *map(pa.array, (start, length, np.array(crc, np.int64), tokens[row], np.full(len(row), part, np.int64), at))]
            if with_ids:  # a document's pieces lie one after the other
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"{key} {key_type}, start long, length long, ids_crc32 long, doc_tokens long, _part long, _at long"
    return docs.select(key, text).mapInArrow(run, schema + ", ids array<int>" * with_ids)


def shortest_pack_first(histogram: dict[int, int], limit: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in one pack) and how often each occurs, for a histogram of lengths up to `limit`.

    Lengths are placed longest first, each into the shortest pack with room for it, all packs of one pattern
    at a time; only a part of a pattern's packs may get one, which splits the pattern.
    """
    done: list[tuple[tuple[int, ...], int]] = []
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # space left -> patterns
    spaces: list[int] = []  # ascending

    def keep(pattern: tuple[int, ...], count: int) -> None:
        left = limit - sum(pattern)
        if not left:
            done.append((pattern, count))
            return
        if left not in room:
            insort(spaces, left)
        room.setdefault(left, []).append((pattern, count))

    for length in sorted(histogram, reverse=True):
        to_place = histogram[length]
        while to_place:
            if not spaces or spaces[-1] < length:
                keep((length,), to_place)
                break
            left = spaces[-1]
            pattern, count = room[left].pop()
            if not room[left]:
                del room[left], spaces[bisect_left(spaces, left)]
            used = min(count, to_place)
            if used < count:
                keep(pattern, count - used)
            keep((*pattern, length), used)
            to_place -= used
    return done + [p for left in sorted(room) for p in room[left]]


def pack_pieces(pieces: DataFrame, limit: int) -> DataFrame:
    """`sequence_id` and `offset` for every row of a table with `length` (1 to `limit`), `_part` and `_at`.

    Only the histogram, at most `limit` numbers, reaches the driver, and the patterns' slots, a few times as
    many, come back. A row's rank among the rows of its length is its place in its partition plus the rows of
    earlier partitions, so a length that a third of the rows have is never sorted or gathered. `pieces` is
    read three times and must be stored.
    """
    counts = pieces.groupBy("_part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots, taken, sequence = [], dict.fromkeys(histogram, 0), 0
    for pattern, count in shortest_pack_first(histogram, limit):
        offset = 0
        for length in pattern:
            slots.append((length, taken[length], taken[length] + count, sequence, offset))
            taken[length] += count
            offset += length
        sequence += count
    slot_table = pieces.sparkSession.createDataFrame(slots, "length long, _from long, _to long, _sequence long, offset long")
    before = W.partitionBy("length").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    earlier = counts.select("_part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    ranked = pieces.join(earlier, ["_part", "length"]).withColumn("_rank", F.col("_before") + F.col("_at"))
    fits = (ranked["length"] == slot_table["length"]) & (F.col("_from") <= F.col("_rank")) & (F.col("_rank") < F.col("_to"))
    return (
        ranked.join(F.broadcast(slot_table), fits)
        .drop(slot_table["length"])
        .withColumn("sequence_id", F.col("_sequence") + F.col("_rank") - F.col("_from"))
        .drop("_part", "_at", "_before", "_rank", "_from", "_to", "_sequence")
    )


def pack_documents(
    docs: DataFrame, vocabulary: str, limit: int = 1024, end_id: int = 0, key: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """One row per piece of a document: `key`, `start`, `length`, `ids_crc32`, `doc_tokens`, `sequence_id`, `offset`.

    `vocabulary` is the content of a byte-level tokenizer file, whose added tokens are found in the texts. A document is its ids and `end_id`, cut every
    `limit` ids; a null or empty text is `end_id` alone. Sequences hold at most `limit` ids and have no gaps.
    Null keys and repeated rows stay and are packed like any other; other columns are not read; an empty
    table gives no rows. With `with_ids` every piece carries its `ids`.
    """
    pieces = materialised(token_pieces(docs, vocabulary, limit, end_id, key, text, with_ids), "pieces")
    return pack_pieces(pieces, limit)
