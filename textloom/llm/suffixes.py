"""Suffix-array dedup: byte passages that also start anywhere else, found from sorted suffixes.

A passage of `length` bytes is represented by an anchor: of all `GRAM`-byte strings in it, the one with the
smallest hash (the leftmost of equal ones). Equal passages have their anchors at the same offset, and neighbouring passages share
one, so only about one suffix in a hundred is needed. Anchors whose string occurs once in the corpus go.
The suffixes of the others are range-partitioned by their leading bytes between sampled splitters; every bucket
is sorted by multikey quicksort, once by what follows the anchors and once by what stands before them, and
the common lengths with the neighbours bound the passages to compare. A group of equal anchors that is larger
than a bucket is cut, and compared across the buckets' boundaries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.arrays import chunks, mix, prefix_hash, span_hash
from textloom.llm.scratch import Steps, free_name

GRAM = 32
#: Positions that are told apart in one search for anchors; the upper bits hold the hash.
_POSITION_BITS = 24
_BUCKET_BYTES = 8 << 20


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours, from running minima of blocks in both directions."""
    n = len(values) - width + 1
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def _anchor_of(grams: np.ndarray, width: int) -> np.ndarray:
    """Position of the anchor of every passage: the smallest of the next `width` gram hashes."""
    out, step = [], (1 << _POSITION_BITS) - width
    for start in range(0, len(grams) - width + 1, step):
        part = grams[start : start + step + width - 1]
        low = np.uint64((1 << _POSITION_BITS) - 1)
        found = _sliding_min((part & ~low) | np.arange(len(part), dtype=np.uint64), width)
        out.append((found & low).astype(np.int64) + start)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


_ANCHORS = (
    "row_id long, row_hash long, at long, first long, last long, gram long, span long, weight int"  # gram null: only an interval
)


def _anchors(batches: Iterator[pa.RecordBatch], text: str, length: int) -> Iterator[pa.RecordBatch]:
    """Anchors of every document with the starts of the passages they stand for (`first` to `last`).

    Anchors with the same surroundings in one document, as in a run of one character, are one row of weight 2;
    all their passages occur twice, and are reported as intervals.
    """
    width = length - GRAM + 1
    for rows, data, offsets in chunks(batches, text, 1 << 20):
        if len(data) < length:
            continue
        running = prefix_hash(data)
        starts = np.arange(len(data) - GRAM + 1)
        grams = span_hash(running, starts, starts + GRAM)
        anchor = _anchor_of(grams, width)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(anchor)]
        whole = np.arange(len(anchor)) + length <= offsets[row + 1]  # passages that end in their document
        begin = np.flatnonzero(whole)
        if not len(begin):
            continue
        new = np.concatenate([[True], (anchor[begin][1:] != anchor[begin][:-1]) | (row[begin][1:] != row[begin][:-1])])
        at = np.flatnonzero(new)
        first, last = begin[at], begin[np.append(at[1:], len(begin)) - 1]
        where, doc = anchor[first], row[first]
        span = span_hash(running, first, last + length)
        order = np.lexsort((span, doc))
        same = (span[order][1:] == span[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        again = np.concatenate([[False], same])  # a repetition of the row before it
        weight = np.ones(len(order), np.int32)
        weight[np.flatnonzero(again[1:]) if len(again) > 1 else []] = 2
        weight[again] = 2
        ids, hashes = rows.column("row_id"), rows.column("row_hash")
        base = offsets[doc]
        kept, repeats = order[~again], np.sort(order[again])
        yield pa.RecordBatch.from_arrays(
            [
                ids.take(pa.array(doc[kept])), hashes.take(pa.array(doc[kept])),
                *map(pa.array, ((where - base)[kept], (first - base)[kept], (last - base)[kept])),
                pa.array(grams[where[kept]].view(np.int64)), pa.array(span[kept].view(np.int64)), pa.array(weight[~again]),
            ],
            names=["row_id", "row_hash", "at", "first", "last", "gram", "span", "weight"],
        )
        if len(repeats):
            low, high, owner = first[repeats], last[repeats] + length, doc[repeats]
            cut = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (low[1:] > high[:-1])]))
            stop = np.append(cut[1:], len(low)) - 1
            d, b = owner[cut], offsets[owner[cut]]
            none = pa.nulls(len(cut), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(d)), hashes.take(pa.array(d)), none, pa.array(low[cut] - b), pa.array(high[stop] - length - b),
                    none, none, pa.array(np.full(len(cut), 2, np.int32)),
                ],
                names=["row_id", "row_hash", "at", "first", "last", "gram", "span", "weight"],
            )


def multikey_order(words: np.ndarray) -> np.ndarray:
    """Order of the rows of a matrix of unsigned words, compared from the first column on.

    Multikey quicksort: rows are parted by one word into smaller, equal and greater ones, and only the equal
    ones go on to the next word. Small parts are sorted directly.
    """
    order, waiting = np.arange(len(words)), [(0, len(words), 0)]
    while waiting:
        low, high, depth = waiting.pop()
        if high - low < 2 or depth == words.shape[1]:
            continue
        part = order[low:high]
        if high - low <= 48:
            order[low:high] = part[np.lexsort(words[part, depth:].T[::-1])]
            continue
        key = words[part, depth]
        pivot = np.sort(key[[0, len(key) // 4, len(key) // 2, 3 * len(key) // 4, -1]])[2]
        smaller, equal = key < pivot, key == pivot
        a, b = low + int(smaller.sum()), low + int(smaller.sum()) + int(equal.sum())
        order[low:high] = np.concatenate([part[smaller], part[equal], part[~smaller & ~equal]])
        waiting += [(low, a, depth), (a, b, depth + 1), (b, high, depth)]
    return order


def _rows_of_bytes(data: np.ndarray, begin: np.ndarray, size: np.ndarray, width: int, step: int) -> np.ndarray:
    """Matrix of the bytes from each place on, forwards or backwards, with zeros after the end."""
    at = begin[:, None] + step * np.arange(width)[None, :]
    inside = np.arange(width)[None, :] < size[:, None]
    return np.where(inside, data[np.where(inside, at, 0)], 0).astype(np.uint8)


def _common(matrix: np.ndarray, size: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common start of each row and the one after it in `order`."""
    a, b = order[:-1], order[1:]
    differ = np.concatenate([matrix[a] != matrix[b], np.ones((len(a), 1), bool)], axis=1)
    return np.minimum(differ.argmax(1), np.minimum(size[a], size[b]))


def _words(matrix: np.ndarray) -> np.ndarray:
    pad = -matrix.shape[1] % 8
    return np.ascontiguousarray(np.pad(matrix, ((0, 0), (0, pad)))).view(">u8").astype(np.uint64)


def _held(size: np.ndarray, width: int) -> np.ndarray:
    """Bytes of each row that are not padding, as the last word to compare: a row goes before its extension by NULs."""
    return np.minimum(size, width)[:, None].astype(np.uint64)


_SUFFIXES = "row_id long, row_hash long, first long, weight int, large boolean, anchor long, bytes binary"


def _cut(batches: Iterator[pa.RecordBatch], text: str, length: int) -> Iterator[pa.RecordBatch]:
    """The bytes around each wanted anchor: all passages that it stands for."""
    for batch in batches:
        for row in batch.to_pylist():
            raw = (row[text] or "").encode()
            found = row["spans"]
            yield pa.RecordBatch.from_pydict({
                "row_id": [row["row_id"]] * len(found), "row_hash": [row["row_hash"]] * len(found),
                "first": [s["first"] for s in found], "weight": pa.array([s["weight"] for s in found], pa.int32()), "large": [s["large"] for s in found],
                "anchor": [s["at"] - s["first"] for s in found], "bytes": [raw[s["first"] : s["last"] + length] for s in found],
            })


_FOUND = "row_id long, row_hash long, low long, high long, passage long"


def _bucket(batches: list[pa.RecordBatch], length: int, cut: bool) -> Iterator[pa.RecordBatch]:
    """Passages that occur twice among the suffixes of a bucket, as intervals of the documents (`passage` null).

    With `cut`, the first and the last group of equal anchors may go on in another bucket: their passages are
    passed on by their hash, each one once.
    """
    table = pa.Table.from_batches(batches) if batches else None
    if table is None or not table.num_rows:
        return
    table = table.combine_chunks()
    spans = table.column("bytes").combine_chunks().cast(pa.large_binary())
    bounds = np.frombuffer(spans.buffers()[1], np.int64)[spans.offset : spans.offset + len(spans) + 1]
    data = np.frombuffer(spans.buffers()[2], np.uint8)
    ids, hashes, base, weight, at = (table.column(c).to_numpy() for c in ("row_id", "row_hash", "first", "weight", "anchor"))
    size, m = np.diff(bounds), len(table)
    passages = size - length + 1
    right, left = _rows_of_bytes(data, bounds[:-1] + at, size - at, length, 1), _rows_of_bytes(data, bounds[:-1] + at - 1, at, length - GRAM, -1)
    order = multikey_order(np.concatenate([_words(right), _held(size - at, length)], axis=1))
    common = _common(right, size - at, order)
    group_in_order = np.concatenate([[0], np.cumsum(common < GRAM)])
    group = np.empty(m, np.int64)
    group[order] = group_in_order
    after, before = np.zeros(m, np.int64), np.zeros(m, np.int64)
    np.maximum.at(after, order[:-1], common)
    np.maximum.at(after, order[1:], common)
    by_left = multikey_order(np.concatenate([group[:, None].astype(np.uint64), _words(left), _held(at, length - GRAM)], axis=1))
    near = np.where(group[by_left[:-1]] == group[by_left[1:]], _common(left, at, by_left), 0)
    np.maximum.at(before, by_left[:-1], near)
    np.maximum.at(before, by_left[1:], near)
    open_end = ((group == 0) | (group == group_in_order[-1])) & cut
    edge = np.zeros(m, bool)  # rows whose neighbour in the order is in another bucket
    edge[order[[0, -1]]] = cut
    # offsets of the anchor in the passages that can occur elsewhere
    least = np.maximum(at - passages + 1, np.where(edge, 0, length - after))
    most = np.minimum(at, np.where(open_end, length, before))
    count = np.maximum(most - least + 1, 0)
    row = np.repeat(np.arange(m), count)
    offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + least[row]
    begin = bounds[row] + at[row] - offset
    passage = mix(span_hash(prefix_hash(data), begin, begin + length) + mix(offset.astype(np.uint64)))
    _, one, number, times = np.unique(passage, return_index=True, return_inverse=True, return_counts=True)
    twice = (times[number] > 1) & (weight[row] == 1)
    start = at[row] - offset + base[row]
    yield from _intervals(ids[row[twice]], hashes[row[twice]], row[twice], start[twice], length)
    # other buckets hear of each passage once; only those that are single here wait for an answer
    out = one[open_end[row[one]]]
    sure = (times[number[out]] > 1) | (weight[row[out]] > 1)
    for part in np.array_split(np.arange(len(out)), max(1, -(-len(out) // 100_000))):
        low = start[out[part]]
        yield pa.RecordBatch.from_pydict({
            "row_id": ids[row[out[part]]], "row_hash": hashes[row[out[part]]], "low": low, "high": np.where(sure[part], -1, low + length),
            "passage": passage[out[part]].view(np.int64),
        })


def _intervals(ids: np.ndarray, hashes: np.ndarray, row: np.ndarray, start: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
    if not len(start):
        return
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    cut = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] > start[:-1] + length)]))
    stop = np.append(cut[1:], len(row)) - 1
    yield pa.RecordBatch.from_pydict({
        "row_id": ids[order][cut], "row_hash": hashes[order][cut], "low": start[cut], "high": start[stop] + length,
        "passage": pa.nulls(len(cut), pa.int64()),
    })


def _sorted_bucket(length: int, cut: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    return lambda batches: _bucket(list(batches), length, cut)


def repeated_intervals(docs: DataFrame, length: int, text: str, steps: Steps) -> DataFrame:
    """`row_id`, `row_hash`, `low`, `high`: byte intervals whose union is what passages found elsewhere cover.

    `docs` has `row_id`, `row_hash` and the text; rows with equal ids and hashes must have equal texts.
    """
    anchors = steps.store(docs.mapInArrow(lambda b: _anchors(b, text, length), _ANCHORS), "anchors")
    one = F.struct("row_id", "row_hash", "at", "first", "last").alias("one")
    spans = anchors.filter("gram IS NOT NULL").groupBy("gram", "span").agg(F.sum("weight").alias("weight"), F.min(one).alias("one"))
    grams = spans.groupBy("gram").agg(F.count("*").alias("spans"), F.sum("weight").alias("n"), F.min("weight").alias("least")).filter("n > 1")
    # a span that occurs twice is covered whole; a single one may share passages with others of its gram
    mixed = ((F.col("spans") > 1) & (F.col("least") == 1)).alias("mixed")
    large = (F.col("spans") * 2 * length > _BUCKET_BYTES).alias("large")
    spans = steps.store(spans.join(grams, "gram").select("gram", "span", "weight", "one", mixed, large), "spans")
    covered = anchors.join(spans.filter("weight > 1").select("gram", "span").hint("merge"), ["gram", "span"])
    interval = ["row_id", "row_hash", F.col("first").alias("low"), (F.col("last") + length).alias("high")]
    covered = steps.store(covered.select(*interval).unionByName(anchors.filter("gram IS NULL").select(*interval)), "covered")
    steps.drop("anchors")

    wanted = spans.filter("mixed").select("weight", "large", "one.*")
    # a document's passages are a list no longer than its text
    lists = wanted.groupBy("row_id", "row_hash").agg(F.collect_list(F.struct("first", "last", "at", "weight", "large")).alias("spans"))
    suffixes = docs.join(lists.hint("merge"), ["row_id", "row_hash"]).mapInArrow(lambda b: _cut(b, text, length), _SUFFIXES)
    suffixes = steps.store(suffixes, "suffixes")
    steps.drop("spans")
    found = None
    for large in (False, True):
        # anchors with the same leading bytes stay together; only a group beyond a bucket's size is cut
        part = suffixes.filter(F.col("large") == large)
        total = part.agg(F.sum(F.length("bytes"))).first()[0] or 0
        leading = F.substring("bytes", F.col("anchor") + 1, F.lit(length if large else GRAM))
        buckets = part.repartitionByRange(1 + total // _BUCKET_BYTES, leading, *["bytes"] * large)
        rows = buckets.mapInArrow(_sorted_bucket(length, large), _FOUND)
        found = rows if found is None else found.unionByName(rows)
    found = steps.store(found, "found")
    across = found.filter("passage IS NOT NULL")
    # a weight above one stands for passages that occur twice by themselves
    twice = across.groupBy("passage").agg(F.sum(F.when(F.col("high") < 0, 2).otherwise(1)).alias("n")).filter("n > 1").select("passage")
    late = across.filter("high >= 0").join(twice, "passage").select("row_id", "row_hash", "low", "high")
    return covered.unionByName(found.filter("passage IS NULL").select("row_id", "row_hash", "low", "high")).unionByName(late)


def _merged(found: list[dict] | None) -> list[list[int]]:
    """Maximal runs of a document's intervals, in order."""
    runs: list[list[int]] = []
    for low, high in sorted((r["low"], r["high"]) for r in found or []):
        if runs and low <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], high)
        else:
            runs.append([low, high])
    return runs


def _without(raw: bytes, runs: list[list[int]]) -> bytes:
    ends = [0, *(b for run in runs for b in run), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))


def _with_runs(docs: DataFrame, length: int, key: str, text: str, out: str = "_runs") -> DataFrame:
    """The rows of `docs` with `out`, the intervals to remove (null: none). `key` is a whole number."""
    steps = Steps(docs.sparkSession, "passages")
    number = F.col(key).cast("long")
    row_id, row_hash = F.coalesce(number, F.lit(0)), F.xxhash64(number.isNull(), F.coalesce(text, F.lit("")))
    rows = docs.select(row_id.alias("row_id"), row_hash.alias("row_hash"), F.col(text))
    runs = repeated_intervals(rows, length, text, steps).distinct()
    names = free_name(docs, "_row_id"), free_name(docs, "_row_hash")
    runs = runs.groupBy(F.col("row_id").alias(names[0]), F.col("row_hash").alias(names[1]))
    runs = steps.store(runs.agg(F.collect_list(F.struct("low", "high")).alias(out)), "runs")
    steps.drop("covered", "found", "suffixes")
    same = (row_id == F.col(names[0])) & (row_hash == F.col(names[1]))
    return docs.join(runs.hint("merge"), same, "left").drop(*names)


def drop_repeated_passages(docs: DataFrame, length: int = 200, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `n_bytes`, `n_removed`, `n_spans` and the `kept` bytes of every document.

    Removes each byte of the UTF-8 text that lies in a string of `length` bytes (64 at least) which also starts
    anywhere else, in another or the same document; overlaps count, and matches never cross documents.
    `n_spans` counts maximal removed runs. `kept` may begin or end inside a character. Strings are compared by
    64-bit hashes within groups of equal 32-byte strings.

    A null text counts as empty; shorter texts are kept whole. Repeated rows and null keys stay: repeated rows
    are documents of their own. Other columns are not read. `key` is a whole number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, found in zip(batch.column(text), batch.column("_runs"), strict=True):
                raw, runs = (value.as_py() or "").encode(), _merged(found.as_py())
                out.append((len(raw), sum(b - a for a, b in runs), len(runs), _without(raw, runs)))
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())],
                names=[key, "n_bytes", "n_removed", "n_spans", "kept"],
            )

    rows = _with_runs(docs.select(key, text), length, key, text)
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept binary"
    return rows.mapInArrow(run, schema)


def without_repeated_passages(docs: DataFrame, length: int = 200, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, with the passages of `drop_repeated_passages` cut out of the text.

    Bytes of a character that was cut in two go as well. A null text stays null.
    """
    columns, hidden = docs.columns, free_name(docs, "_runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            out = []
            for value, found in zip(batch.column(text), batch.column(hidden), strict=True):
                value, runs = value.as_py(), _merged(found.as_py())
                out.append(_without(value.encode(), runs).decode(errors="ignore") if runs else value)
            yield batch.set_column(at, text, pa.array(out, pa.string())).select(columns)

    return _with_runs(docs, length, key, text, hidden).mapInArrow(run, docs.schema)
