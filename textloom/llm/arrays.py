"""Text as arrays: bytes, words and hashes of whole Arrow batches, and groups of a sorted stream.

The functions work on a few megabytes of text at once, so a task's memory follows `max_bytes` and the longest
single text, not the size of its partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20

_UP, _DOWN = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: The bytes 0x20 and 0x09 to 0x0D part words; only A-Z have a lower case here.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers 0 to n of the hash's odd multiplier and of its inverse modulo 2**64; kept for the next chunk."""
    if len(_powers[0]) <= n:
        size = max(1 << 16, 1 << int(n).bit_length())
        for i, base in enumerate((_UP, _DOWN)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one, so that every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(
    batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of about `max_bytes` of text, each with its bytes and row offsets; a null text is empty."""
    for batch in batches:
        column = pc.fill_null(batch.column(text), "")
        size = np.concatenate([[0], np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))])
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(size, size[start] + max_bytes, "right")) - 1)
            data, offsets = utf8(column.slice(start, stop - start))
            yield batch.slice(start, stop - start), data, offsets
            start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column without nulls, and where each row begins (one entry more than rows)."""
    column = column.cast(pa.large_binary())
    _, offset_buffer, data = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(space: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of bytes that are not `space`, and the first run of each row (rows + 1)."""
    if not len(space):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    before, after = np.ones(len(space), bool), np.ones(len(space), bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    before[offsets[:-1][offsets[:-1] < len(space)]] = True
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    starts = np.flatnonzero(before & ~space)
    return starts, np.flatnonzero(after & ~space) + 1, np.searchsorted(starts, offsets)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash; `span_hash` reads the hash of any span from it."""
    up, _ = _power_tables(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def span_hash(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; equal bytes have equal hashes wherever they stand."""
    _, down = _power_tables(len(running))
    return mix((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `words` words of each row, repeats included, and the first one of each row.

    Words are lower-cased (A-Z) and parted by white space. A row with fewer words has its whole sequence as
    its only shingle; a row without words has none.
    """
    data = LOWER[data]
    starts, ends, first = word_spans(SPACE[data], offsets)
    word = span_hash(prefix_hash(data), starts, ends)
    count = np.diff(first)
    shingles = np.where(count >= words, count - words + 1, (count > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(shingles)])
    # the n-th shingle of a row begins at the row's n-th word
    begin = np.arange(at[-1]) - np.repeat(at[:-1], shingles) + np.repeat(first[:-1], shingles)
    length = np.repeat(np.minimum(count, words), shingles)
    out = mix(length.astype(np.uint64))
    for j in range(words):
        inside = j < length
        step = word[np.where(inside, begin + j, 0)] if len(word) else out
        out = np.where(inside, mix(out * np.uint64(31) + step), out)
    return out, at


def groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], work: Callable[[pa.Table], Iterator[pa.RecordBatch]]
) -> Iterator[pa.RecordBatch]:
    """Call `work` with all rows of each key of a stream that is sorted by `keys` (no nulls in them)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        if held and any(held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys):
            yield from work(pa.Table.from_batches(held))
            held = []
        start = 0
        for stop in np.flatnonzero(change):
            held.append(batch.slice(start, stop - start))
            yield from work(pa.Table.from_batches(held))
            held, start = [], stop
        held.append(batch.slice(start))
    if held:
        yield from work(pa.Table.from_batches(held))
