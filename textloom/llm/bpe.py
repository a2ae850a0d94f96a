"""Byte-level BPE encoding and decoding with the ranks of a public tokenizer.

Documents stay in blocks of consecutive rows. A block knows each of its distinct pre-tokens by a small number;
the numbers in text order are the positions. The distinct words of all blocks meet in one shuffle, where a
word is encoded once, and its ids go back to the blocks that asked for it.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from textloom.llm.arrays import chunks
from textloom.llm.pretokens import distinct_words, gather

#: Text of one block; a block's words and positions are in memory at a time.
BLOCK_BYTES = 32 << 20
#: Distinct words that an encoding task remembers; beyond them a word may be encoded again.
REMEMBERED = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (one base64 token and its id per line), a table of fixed size."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _pack(values: np.ndarray | bytes) -> bytes:
    return pa.compress(values if isinstance(values, bytes) else values.tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes, size: int) -> bytes:
    return pa.decompress(packed, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _numbers(packed: bytes, count: int) -> np.ndarray:
    return np.frombuffer(_unpack(packed, 4 * count), np.int32)


class _Block:
    """Numbers of the distinct words of a block, in order of first use."""

    def __init__(self, block: int):
        self.id, self.words, self._number, self.bytes = block, [], {}, 0

    def add(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes, words, hashes, first = distinct_words(data, offsets)
        numbers = np.empty(len(words), np.int32)
        for i, (h, word) in enumerate(zip(hashes.tolist(), words, strict=True)):
            n = self._number.setdefault(h, len(self.words))
            if n == len(self.words):
                self.words.append(word)
            numbers[i] = n
        self.bytes += len(data)
        return numbers[codes], first


def _blocks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[_Block, pa.RecordBatch, np.ndarray, np.ndarray, bool]]:
    """Chunks with their block, word numbers and row bounds; the last flag says that the block is complete.

    Blocks depend only on the rows of a partition and their order, so a repeated task makes the same ones.
    """
    part, n = TaskContext.get().partitionId(), 0
    block, before = _Block(part << 24), None
    for rows, data, offsets in chunks(batches, text):
        if before is not None:
            full = block.bytes >= BLOCK_BYTES
            yield block, *before, full
            if full:
                n += 1
                block = _Block(part << 24 | n)
        numbers, first = block.add(data, offsets)
        before = rows, numbers, first
    if before is not None:
        yield block, *before, True


def _requests(batches: Iterator[pa.RecordBatch], text: str, buckets: int) -> Iterator[pa.RecordBatch]:
    """The distinct words of every block, dealt to buckets by the word: one packed row per block and bucket."""
    for block, _, _, _, complete in _blocks(batches, text):
        if not complete:
            continue
        dealt: dict[int, list[int]] = {}
        for i, word in enumerate(block.words):
            dealt.setdefault(_bucket(word, buckets), []).append(i)
        for bucket, numbers in dealt.items():
            words = [block.words[i] for i in numbers]
            raw, sizes = b"".join(words), np.array([len(w) for w in words], np.int32)
            yield pa.RecordBatch.from_pydict({
                "bucket": [bucket], "block": [block.id], "n": [len(words)], "size": [len(raw)],
                "numbers": [_pack(np.array(numbers, np.int32))], "sizes": [_pack(sizes)], "words": [_pack(raw)],
            })


def _bucket(word: bytes, buckets: int) -> int:
    # a fixed hash: Python's own differs between processes
    return int.from_bytes(word[-7:], "little") * 0x9E3779B97F4A7C15 % (1 << 64) * buckets >> 64


def _replies(batches: Iterator[pa.RecordBatch], ranks: dict[bytes, int], pattern: str) -> Iterator[pa.RecordBatch]:
    """Ids of the requested words; every distinct word of a bucket is encoded once."""
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    known: dict[bytes, list[int]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            sizes, raw, at, ids = _numbers(row["sizes"], row["n"]), _unpack(row["words"], row["size"]), 0, []
            for size in sizes.tolist():
                word, at = raw[at : at + size], at + size
                if word not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    # the word is one match of the pattern, so the library merges it as a whole
                    known[word] = encoding._encode_single_piece(word)
                ids.append(known[word])
            flat = np.array([i for word in ids for i in word], np.int32)
            lengths = np.array([len(word) for word in ids], np.int32)
            yield pa.RecordBatch.from_pydict({
                "block": [row["block"]], "n": [row["n"]], "total": [len(flat)], "numbers": [row["numbers"]],
                "lengths": [_pack(lengths)], "ids": [_pack(flat)],
            })


def _positions(batches: Iterator[pa.RecordBatch], key: str, text: str) -> Iterator[pa.RecordBatch]:
    """Every document as the numbers of its words in its block, in text order."""
    for block, rows, numbers, first, _ in _blocks(batches, text):
        packed = [_pack(numbers[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([block.id] * rows.num_rows, pa.int64()), rows.column(key), pa.array(np.diff(first), pa.int64()), pa.array(packed, pa.binary())],
            names=["block", key, "n", "numbers"],
        )


def _reassemble(documents: Iterator[pa.RecordBatch], replies: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Ids of the documents of one block, a few at a time."""
    found = [r for batch in replies for r in batch.to_pylist()]
    count = sum(r["n"] for r in found)
    lengths, begins = np.zeros(count, np.int64), np.zeros(count, np.int64)
    ids, used = np.concatenate([_numbers(r["ids"], r["total"]) for r in found] or [np.zeros(0, np.int32)]), 0
    for r in found:
        numbers, size = _numbers(r["numbers"], r["n"]), _numbers(r["lengths"], r["n"])
        lengths[numbers] = size
        begins[numbers] = used + np.concatenate([[0], np.cumsum(size[:-1])])
        used += r["total"]
    for batch in documents:
        n, at = batch.column("n").to_numpy(), 0
        total = np.concatenate([[0], np.cumsum(n)])
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(total, total[at] + (1 << 20), "right")) - 1)
            packed = batch.column("numbers").slice(at, stop - at).to_pylist()
            numbers = np.concatenate([_numbers(p, c) for p, c in zip(packed, n[at:stop], strict=True)])
            if len(numbers) and numbers.max() >= count:
                raise ValueError("a block's words and its documents come from different rows; store the input first")
            values, word_at = gather(numbers, lengths, begins, ids)
            bounds = word_at[np.concatenate([[0], np.cumsum(n[at:stop])])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).slice(at, stop - at), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))],
                names=[key, "ids"],
            )
            at = stop


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key` and the token `ids` of every document: each match of `pattern` is merged by itself, no special tokens.

    `docs` is read twice and must give the same rows both times: a file scan or a stored table. A null text
    counts as empty and has no ids; null keys and repeated rows stay; other columns are not read.
    """
    narrow = docs.select(key, text)
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key_type = docs.schema[key].dataType.simpleString()
    requests = narrow.mapInArrow(
        lambda b: _requests(b, text, buckets),
        "bucket long, block long, n long, size long, numbers binary, sizes binary, words binary",
    )
    replies = requests.repartition(buckets, "bucket").mapInArrow(
        lambda b: _replies(b, ranks, pattern), "block long, n long, total long, numbers binary, lengths binary, ids binary"
    )
    positions = narrow.mapInArrow(lambda b: _positions(b, key, text), f"block long, {key} {key_type}, n long, numbers binary")
    return (
        positions.groupBy("block")
        .cogroup(replies.groupBy("block"))
        .applyInArrow(_reassembler(key), f"{key} {key_type}, ids array<int>")
    )


def _reassembler(key: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(documents: pa.Table, replies: pa.Table) -> pa.Table:
        rows = _reassemble(iter(documents.combine_chunks().to_batches()), iter(replies.to_batches()), key)
        return pa.Table.from_batches(list(rows))

    return run


def token_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length, place and bytes of every token, by id. Ids without a token are empty."""
    size = max(ranks.values(), default=-1) + 1
    tokens = [b""] * size
    for token, i in ranks.items():
        tokens[i] = token
    lengths = np.array([len(t) for t in tokens], np.int64)
    return lengths, np.concatenate([[0], np.cumsum(lengths)])[:-1], np.frombuffer(b"".join(tokens), np.uint8)


def decode_batches(
    batches: Iterator[pa.RecordBatch], ranks: dict[bytes, int], step: int = 1 << 20
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of rows with their ids and id bounds, and the bytes those stand for and their bounds."""
    lengths, begins, raw = token_table(ranks)
    for batch in batches:
        ids = batch.column("ids")
        size = np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(size, size[at] + step, "right")) - 1)
            values, bounds = ids.slice(at, stop - at).flatten().to_numpy(), size[at : stop + 1] - size[at]
            data, token_at = gather(values, lengths, begins, raw)
            yield batch.slice(at, stop - at), values, bounds, data, token_at[bounds]
            at = stop


def decode_documents(encoded: DataFrame, ranks: dict[bytes, int], key: str = "doc_id") -> DataFrame:
    """`key` and the `decoded` bytes of rows of ids: ids joined with the table of token bytes. Map-only.

    Null ids count as none. An id beyond the table is an error.
    """
    key_type = encoded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _, data, bounds in decode_batches(batches, ranks):
            raw = data.tobytes()
            texts = [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column(key), pa.array(texts, pa.binary())], names=[key, "decoded"])

    return encoded.select(key, "ids").mapInArrow(run, f"{key} {key_type}, decoded binary")
