"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.arrays import chunks, mix, shingle_hashes, utf8

BINS, BITS, WORDS = 512, 4, 5
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _densified(least: np.ndarray) -> np.ndarray:
    """Fill the empty bins of every row that has a full one.

    An empty bin tries other bins in an order that depends on its own number and the attempt only, and takes
    the first full one: two sets with the same full bins fill the empty ones alike.
    """
    bins = least.shape[1]
    full = least != _EMPTY
    count = full.sum(1)
    one = count == 1
    if one.any():  # whatever the order, there is only one to take
        least[one] = least[one].min(1, keepdims=True)
    row, cell = np.nonzero(~full & ((count > 1)[:, None]))
    filled, attempt = least, 0
    while len(row):
        attempt += 1
        step = np.uint64(attempt * 0xD1B54A32D192ED03 & (1 << 64) - 1)
        other = (mix(cell.astype(np.uint64) + np.uint64(1) + step) % np.uint64(bins)).astype(np.int64)
        found = full[row, other]
        filled[row[found], cell[found]] = least[row[found], other[found]]
        row, cell = row[~found], cell[~found]
    return filled


def fingerprints(data: np.ndarray, offsets: np.ndarray, words: int = WORDS, bins: int = BINS, bits: int = BITS) -> np.ndarray:
    """Low-order bits of the bins of every row (rows x bins); rows without words are marked by -1.

    Every shingle is hashed once: the upper part of the hash names its bin, the smallest hash of a bin counts.
    """
    hashes, at = shingle_hashes(data, offsets, words)
    rows = len(offsets) - 1
    least = np.full(rows * bins, _EMPTY, np.uint64)
    # the upper half names the bin; the value is scrambled again to be independent of the bin
    cell = np.repeat(np.arange(rows), np.diff(at)) * bins + ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(cell, kind="stable")
    if len(order):
        cells = cell[order]
        first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
        least[cells[first]] = np.minimum.reduceat(mix(hashes)[order], first)
    # bins that share a value must not agree by chance together: each scrambles it in its own way
    own = mix(_densified(least.reshape(rows, bins)) ^ mix(np.arange(1, bins + 1, dtype=np.uint64)))
    low = (own & np.uint64((1 << bits) - 1)).astype(np.int16)
    low[np.diff(at) == 0] = -1
    return low


def packed(low: np.ndarray, bits: int = BITS) -> list[str]:
    """Hexadecimal form of each row's bits; a row without words is the empty string."""
    planes = (low[:, :, None] >> np.arange(bits - 1, -1, -1)) & 1
    raw = np.packbits(planes.reshape(len(low), -1).astype(np.uint8), axis=1)
    return ["" if row[0] < 0 else r.tobytes().hex() for row, r in zip(low, raw, strict=True)]


def likeness(a: np.ndarray, b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Estimated Jaccard similarity of rows of fingerprints, from 0 to 1.

    Bits of different values agree by chance once in 2**bits, which is taken off. Two rows without words are
    alike (1), one without words is like no other (0).
    """
    chance = 2.0**-bits
    same = ((a == b).mean(1) - chance) / (1 - chance)
    return np.where((a[:, 0] < 0) | (b[:, 0] < 0), (a[:, 0] == b[:, 0]).astype(float), np.clip(same, 0.0, 1.0))


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """`key` and the packed `fingerprint` of every whole text; map-only.

    Equal sets of shingles have equal fingerprints. A null text or one without words has an empty one; null
    keys and repeated rows stay; other columns are not read.
    """
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, text, 1 << 19):
            found = pa.array(packed(fingerprints(data, offsets, words, bins, bits), bits), pa.string())
            yield pa.RecordBatch.from_arrays([rows.column(key), found], names=[key, "fingerprint"])

    return docs.select(key, text).mapInArrow(run, f"{key} {key_type}, fingerprint string")


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", rows_per_range: int = 2_000) -> DataFrame:
    """Rows dealt to ranges of descending `key`, so that each row meets the next one without a global window.

    Adds `_range` and `_guest`. Sampled splitters cut the keys into ranges of about `rows_per_range` rows; the
    first row of a range visits the range before it as a guest, and the first of all visits the last. Only the
    splitters, one number per range, pass the driver. Partitions are sorted by range, guests last, descending
    key and text hash: the row after an own row is its next one. Null keys come last, as the smallest.
    """
    order = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col(key), F.coalesce(text, F.lit("")).alias(text), order.alias("_order"))
    cuts = max(1, -(-rows.count() // rows_per_range))
    shares = [i / cuts for i in range(1, cuts)] or [0.5]
    found = rows.agg(F.percentile_approx("_order", shares, 20 * cuts).alias("p")).first()["p"]
    bounds = np.array(sorted(set(found or [])), np.int64)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # descending order: the largest keys are in range 0
            own = len(bounds) - np.searchsorted(bounds, batch.column("_order").to_numpy(), "left")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int64))], names=[*batch.schema.names, "_range"])

    dealt = rows.mapInArrow(ranges, T.StructType([*rows.schema.fields, T.StructField("_range", T.LongType())]))
    keys = rows.select("_order").mapInArrow(ranges, "_order long, _range long")
    firsts = keys.groupBy("_range").agg(F.max("_order").alias("_order"))
    # one row per range in this window
    across = W.orderBy("_range")
    ends = firsts.agg(F.max("_range").alias("_last"))
    guests = firsts.select("_order", F.lag("_range").over(across).alias("_visits")).crossJoin(F.broadcast(ends))
    guests = guests.select("_order", F.coalesce("_visits", "_last").alias("_visits"))
    visiting = dealt.join(F.broadcast(guests), "_order").withColumn("_range", F.col("_visits")).drop("_visits")
    both = dealt.withColumn("_guest", F.lit(False)).unionByName(visiting.withColumn("_guest", F.lit(True)))
    return (
        both.repartition("_range")
        .sortWithinPartitions("_range", "_guest", F.desc("_order"), F.xxhash64(text))
        .select(key, text, "_range", "_guest")
    )


def edited(text: str, following: str) -> str:
    """`text` with its last third replaced by as many characters from the start of `following`, or all of it."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def edit_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Fingerprints of every text and of its edited version, and how alike they and the next document's are.

    Columns: `key`, `n_chars`, `edited_sha256`, `fingerprint`, `edited_fingerprint`, `near_edited`,
    `near_next`. The next document is the one with the next smaller key, after the last the first (with
    `edited` for the edit); of equal keys, texts are in the order of their hash. A null text counts as empty, a
    null key as the smallest; every row of the input has one in the result; other columns are not read.
    """
    schema = (
        f"{key} {docs.schema[key].dataType.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def work(kind: pa.DataType, keys: list, texts: list[str], following: list[str], low: np.ndarray, next_low: np.ndarray) -> pa.RecordBatch:
        changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
        changed_low = fingerprints(*utf8(pa.array(changed, pa.string())), words, bins, bits)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys, kind),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                pa.array(packed(low, bits), pa.string()),
                pa.array(packed(changed_low, bits), pa.string()),
                pa.array(likeness(low, changed_low, bits)),
                pa.array(likeness(low, next_low, bits)),
            ],
            names=names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row seen waits for the one after it
        for rows, data, offsets in chunks(batches, text, 1 << 19):
            low = fingerprints(data, offsets, words, bins, bits)
            keys, texts = rows.column(key).to_pylist(), rows.column(text).to_pylist()
            guest = rows.column("_guest").to_pylist()
            if held is not None:
                low, keys, texts, guest = np.concatenate([held[0], low]), [held[1], *keys], [held[2], *texts], [held[3], *guest]
            own = [i for i in range(len(keys) - 1) if not guest[i]]
            if own:
                after = [i + 1 for i in own]
                yield work(rows.column(key).type, [keys[i] for i in own], [texts[i] for i in own], [texts[i] for i in after], low[own], low[after])
            held = low[-1:], keys[-1], texts[-1], guest[-1]

    return with_next(docs, key, text).mapInArrow(run, schema)
