"""LM scoring: the difference of cross-entropy under a target and a background n-gram model.

Both models are interpolated bigram models with the same smoothing over one vocabulary, all words of both corpora.
Counts are exact. Documents stay in blocks of consecutive rows; a block sends the counts of its distinct
n-grams to the buckets of their hashes, where those of all blocks and of the target corpus are added, and gets
the totals of the n-grams that it has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.arrays import LOWER, chunks, groups, mix, prefix_hash, span_hash, word_spans
from textloom.llm.scratch import Steps

#: Text of one block; its words and n-grams are in memory at a time.
BLOCK_BYTES = 32 << 20
#: Pseudo-counts that the word model lends to every context.
PRIOR = 50.0

#: Words are runs of digits, letters and bytes beyond ASCII.
_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False
_START, _END = np.uint64(0x5354415254), np.uint64(0x454E44)
_ONE = np.uint64(1)


def _pack(values: np.ndarray) -> bytes:
    """Numbers by byte position, which compresses well where the upper bytes are alike."""
    if not len(values):
        return b""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes, n: int, kind: type) -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    width = np.dtype(kind).itemsize
    raw = pa.decompress(packed, decompressed_size=n * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).view(kind).ravel()


def _blocks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[int, list[pa.RecordBatch], np.ndarray, np.ndarray]]:
    """Blocks with their rows, word hashes and the first word of each row (rows + 1).

    They depend only on the rows of a partition and their order, so a repeated task makes the same ones.
    """
    part, n = TaskContext.get().partitionId(), 0
    rows, words, counts, size = [], [], [], 0
    for batch, data, offsets in chunks(batches, text):
        data = LOWER[data]
        starts, ends, first = word_spans(_GAP[data], offsets)
        rows.append(batch)
        words.append(span_hash(prefix_hash(data), starts, ends))
        counts.append(np.diff(first))
        size += len(data)
        if size >= BLOCK_BYTES:
            yield part << 24 | n, rows, np.concatenate(words), np.concatenate([[0], np.cumsum(np.concatenate(counts))])
            rows, words, counts, size, n = [], [], [], 0, n + 1
    if rows:
        yield part << 24 | n, rows, np.concatenate(words), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


def _keys(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the pair, the word and the context of every token; each row ends with an end token.

    Keys of words are odd and those of pairs even. The context of a row's first word occurs once per row, as
    the end does, and shares its key.
    """
    tokens = np.insert(words, first[1:], _END)
    begin = first[:-1] + np.arange(len(first) - 1)  # of each row among the tokens
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[begin] = _START
    pairs = mix(mix(before) * np.uint64(31) + tokens) & ~_ONE
    of_word = mix(tokens) | _ONE
    context = mix(np.where(before == _START, _END, before)) | _ONE
    return pairs, of_word, context


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


_REQUEST = "bucket long, block long, target boolean, n long, keys binary, counts binary"


def _requests(batches: Iterator[pa.RecordBatch], text: str, buckets: int, target: bool) -> Iterator[pa.RecordBatch]:
    """Counts of the distinct pairs and words of each block: a row per bucket, keys ascending."""
    for block, _, words, first in _blocks(batches, text):
        pairs, of_word, _ = _keys(words, first)
        keys, counts = np.unique(np.concatenate([pairs, of_word]), return_counts=True)
        bounds = np.searchsorted(_bucket_of(keys, buckets), np.arange(buckets + 1))
        for bucket in np.flatnonzero(np.diff(bounds)):
            a, b = bounds[bucket], bounds[bucket + 1]
            yield pa.RecordBatch.from_pydict({
                "bucket": [int(bucket)], "block": [block], "target": [target], "n": [int(b - a)],
                "keys": [_pack(np.diff(keys[a:b], prepend=np.uint64(0)))], "counts": [_pack(counts[a:b].astype(np.int64))],
            })


_REPLY = "block long, bucket long, n long, background binary, target binary, words long, background_tokens long, target_tokens long"


def _add_up(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Totals of one bucket for every block that asked, and a row of sums (`block` -1)."""
    rows = table.to_pylist()
    keys = [np.cumsum(_unpack(r["keys"], r["n"], np.uint64)) for r in rows]
    every, number = np.unique(np.concatenate(keys), return_inverse=True)
    totals, at = {False: np.zeros(len(every), np.int64), True: np.zeros(len(every), np.int64)}, 0
    places = []
    for r in rows:
        places.append(number[at : at + r["n"]])
        totals[r["target"]][places[-1]] += _unpack(r["counts"], r["n"], np.int64)
        at += r["n"]
    for r, place in zip(rows, places, strict=True):
        if not r["target"]:
            yield _reply(r["block"], r["bucket"], r["n"], _pack(totals[False][place]), _pack(totals[True][place]))
    words = (every & _ONE).astype(bool)
    yield _reply(-1, rows[0]["bucket"], 0, b"", b"", int(words.sum()), int(totals[False][words].sum()), int(totals[True][words].sum()))


def _reply(*values) -> pa.RecordBatch:
    names = ["block", "bucket", "n", "background", "target", "words", "background_tokens", "target_tokens"]
    return pa.RecordBatch.from_pydict({name: [value] for name, value in zip(names, [*values, 0, 0, 0][:8], strict=True)})


def _positions(batches: Iterator[pa.RecordBatch], key: str, text: str, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Each document as numbers of its block's distinct words, and a row with the words' hashes (`n` negative)."""
    names = ["block", key, "n", "packed"]
    for block, rows, words, first in _blocks(batches, text):
        distinct, codes = np.unique(words, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block]), pa.nulls(1, key_type), pa.array([-1 - len(distinct)]), pa.array([_pack(distinct)], pa.binary())], names=names
        )
        at = 0
        for batch in rows:
            bounds = first[at : at + batch.num_rows + 1]
            packed = [_pack(codes[a:b].astype(np.int32)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * batch.num_rows), batch.column(key), pa.array(np.diff(bounds)), pa.array(packed, pa.binary())], names=names
            )
            at += batch.num_rows


def _losses(documents: pa.Table, replies: pa.Table, key: str, buckets: int, sums: tuple[int, int, int], prior: float) -> pa.Table:
    """Mean loss per token of the documents of one block under both models."""
    sizes, packed = documents.column("n").to_pylist(), documents.column("packed").to_pylist()
    where = next(i for i, n in enumerate(sizes) if n < 0)
    distinct = _unpack(packed[where], -1 - sizes[where], np.uint64)
    rows = [i for i in range(len(sizes)) if i != where]
    counts = np.array([sizes[i] for i in rows], np.int64)
    codes = np.concatenate([_unpack(packed[i], sizes[i], np.int32) for i in rows] or [np.zeros(0, np.int32)])
    first = np.concatenate([[0], np.cumsum(counts)])
    pairs, of_word, context = _keys(distinct[codes] if len(codes) else np.zeros(0, np.uint64), first)
    known = np.unique(np.concatenate([pairs, of_word]))
    found = sorted(replies.to_pylist(), key=lambda r: r["bucket"])
    expected = np.bincount(_bucket_of(known, buckets), minlength=buckets)
    if {r["bucket"]: r["n"] for r in found} != {b: int(n) for b, n in enumerate(expected) if n}:
        raise ValueError("a block's counts and its documents come from different rows; store the input first")
    pair_at, word_at, context_at = (np.searchsorted(known, k) for k in (pairs, of_word, context))
    begin = first[:-1] + np.arange(len(rows))
    words, *tokens = sums
    loss = []
    for side, total in zip(("background", "target"), tokens, strict=True):
        count = np.concatenate([_unpack(r[side], r["n"], np.int64) for r in found]).astype(np.float64)
        alone = (count[word_at] + 1.0) / (total + words)
        each = -np.log((count[pair_at] + prior * alone) / (count[context_at] + prior))
        loss.append(np.add.reduceat(each, begin) / (counts + 1))
    return pa.Table.from_arrays(
        [documents.column(key).take(pa.array(rows)), pa.array(counts + 1), pa.array(loss[1]), pa.array(loss[0]), pa.array(loss[1] - loss[0])],
        names=[key, "n_tokens", "target_loss", "background_loss", "score"],
    )


def score_against_target(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", prior: float = PRIOR
) -> DataFrame:
    """`key`, `n_tokens`, `target_loss`, `background_loss` and `score` of every document.

    The background model is counted over all of `docs`, the target model over all of `target`. Tokens are
    lower-cased words and one end per document. `p(b | a) = (n(ab) + prior * p(b)) / (n(a) + prior)` with
    `p(b) = (n(b) + 1) / (tokens + words)`; losses are mean negative logarithms per token, and `score` is the
    target's loss minus the background's: the lower, the more a document is like the target.

    `docs` is read twice and must give the same rows both times: a file scan or a stored table. A null or empty
    text is one end token. With an empty target its model is uniform. Null keys and repeated rows stay; other
    columns are not read.
    """
    spark = docs.sparkSession
    steps = Steps(spark, "lm")
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = docs.select(key, text)
    asked = narrow.mapInArrow(lambda b: _requests(b, text, buckets, False), _REQUEST)
    wanted = target.select(target_text).mapInArrow(lambda b: _requests(b, target_text, buckets, True), _REQUEST)
    dealt = asked.unionByName(wanted).repartition("bucket").sortWithinPartitions("bucket")
    replies = steps.store(dealt.mapInArrow(lambda b: groups(b, ["bucket"], _add_up), _REPLY), "replies")
    steps.drop()
    # three sums are all that reaches the driver
    sums = replies.agg(F.sum("words"), F.sum("background_tokens"), F.sum("target_tokens")).first()
    sums = tuple(int(x or 0) for x in sums)
    kind = docs.schema[key].dataType.simpleString()
    arrow_type = docs.select(key).limit(0).toArrow().schema.field(0).type
    positions = narrow.mapInArrow(lambda b: _positions(b, key, text, arrow_type), f"block long, {key} {kind}, n long, packed binary")
    met = positions.groupBy("block").cogroup(replies.filter("block >= 0").groupBy("block"))
    return met.applyInArrow(
        lambda d, r: _losses(d, r, key, buckets, sums, prior),
        f"{key} {kind}, n_tokens long, target_loss double, background_loss double, score double",
    )
