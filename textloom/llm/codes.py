"""Vector code compression: product codes of whole numbers, clustered with adaptive distance bounds.

Each part of a vector keeps, from round to round, its entry, its `b` closest other entries with a lower bound of the
distance to each (ascending: a bound holds for all later entries, too) and one outer bound for all the rest (Drake and
Hamerly). When the entries of a codebook move, the bounds are lowered by how far they moved; the exact distance to the
own entry then tells how many of the next entries have to be looked at, often none. Distances that are looked at are
whole numbers, so ties and near ties are decided exactly; bounds are rounded towards certainty. After each round `b`
is lowered to what nearly all parts needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.scratch import Steps, free_name
from textloom.operators.scoring import join_uneven

SCALE = 4096
#: Of all parts, so many of a thousand must have been decided by the bounds for a smaller `b`.
_DECIDED = 990
_CHUNK_ROWS = 16_384


def _up(distance: np.ndarray) -> np.ndarray:
    """Root of a squared distance, rounded up beyond all errors of double precision."""
    return np.sqrt(distance.astype(np.float64)) * (1 + 1e-12)


def _down(distance: np.ndarray) -> np.ndarray:
    """Root of a squared distance as a single, rounded down."""
    root = np.sqrt(distance.astype(np.float64)) * (1 - 1e-12)
    return np.nextafter(root.astype(np.float32), np.float32(-1))


def _squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances between rows of whole numbers."""
    return ((x - entries) ** 2).sum(-1)


class PartState:
    """Entry, closest other entries, their lower bounds and the outer bound of one part of many vectors."""

    def __init__(self, own: np.ndarray, close: np.ndarray, bounds: np.ndarray):
        self.own, self.close, self.bounds = own, close, bounds  # the last column of `bounds` is the outer bound

    @classmethod
    def fresh(cls, x: np.ndarray, book: np.ndarray, b: int) -> tuple[PartState, np.ndarray]:
        """All distances; equal ones are in the order of the entries."""
        distance = np.stack([_squared(x, entry) for entry in book], axis=1)
        order = np.argsort(distance, axis=1, kind="stable")
        ranked = np.take_along_axis(distance, order, axis=1)
        bounds = np.full((len(x), b + 1), np.inf, np.float32)
        bounds[:, : min(b + 1, len(book) - 1)] = _down(ranked[:, 1 : b + 2])
        return cls(order[:, 0].astype(np.uint8), order[:, 1 : b + 1].astype(np.uint8), bounds), ranked[:, 0]

    def moved(self, x: np.ndarray, book: np.ndarray, moves: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Assign anew after the entries moved; returns squared distances and how many bounds each row needed."""
        self.close, self.bounds = self.close[:, :b], self.bounds[:, : b + 1]  # the first bound left out is an outer one
        # rounding once more downwards makes up for the subtraction
        self.bounds[:, :b] = np.nextafter(self.bounds[:, :b] - moves[self.close], np.float32(-np.inf))
        self.bounds[:, b] = np.nextafter(self.bounds[:, b] - moves.max(), np.float32(-np.inf))
        self.bounds = np.minimum.accumulate(self.bounds[:, ::-1], axis=1)[:, ::-1].copy()
        least = _squared(x, book[self.own])
        # entries from a bound on that the distance is below are out of the question; equal is not below
        sure = np.concatenate([_up(least)[:, None] < self.bounds, np.ones((len(x), 1), bool)], axis=1)
        need = sure.argmax(1)
        for z in range(1, b + 1):
            rows = np.flatnonzero(need == z)
            if not len(rows):
                continue
            ids = np.concatenate([self.own[rows, None], self.close[rows, :z]], axis=1)
            distance = _squared(x[rows, None, :], book[ids])
            order = np.lexsort((ids, distance), axis=1)
            ids, distance = np.take_along_axis(ids, order, axis=1), np.take_along_axis(distance, order, axis=1)
            self.own[rows], self.close[rows, :z], least[rows] = ids[:, 0], ids[:, 1:], distance[:, 0]
            self.bounds[rows, :z] = np.minimum(_down(distance[:, 1:]), self.bounds[rows, z][:, None])
        rows = np.flatnonzero(need == b + 1)
        if len(rows):
            again, least[rows] = PartState.fresh(x[rows], book, b)
            self.own[rows], self.close[rows], self.bounds[rows] = again.own, again.close, again.bounds
        return least, need


def _fields(b: int, parts: int) -> np.dtype:
    return np.dtype([("own", "u1", (parts,)), ("close", "u1", (parts, b)), ("bounds", "<f4", (parts, b + 1))])


_STATE = "vector binary, state binary, error long, sums array<long>, need array<long>"


def _round(books: np.ndarray, moves: np.ndarray | None, old_b: int, b: int, columns: list[str]):
    """One round over the vectors: their new state, and in one row per task the sums of the parts of every entry.

    `books` has the entries of each part; `moves`, how far they moved since the states were written (None: there are
    no states yet, and all distances are taken).
    """
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        needs, schema = np.zeros(b + 2, np.int64), None
        for batch in batches:
            schema = batch.select(columns).schema
            for at in range(0, batch.num_rows, _CHUNK_ROWS):
                rows = batch.slice(at, _CHUNK_ROWS)
                n = rows.num_rows
                x = np.frombuffer(b"".join(rows.column("vector").to_pylist()), "<i4").astype(np.int64).reshape(n, parts, width)
                new, error = np.zeros(n, _fields(b, parts)), np.zeros(n, np.int64)
                old = None if moves is None else np.frombuffer(b"".join(rows.column("state").to_pylist()), _fields(old_b, parts))
                for p in range(parts):
                    if old is None:
                        state, least = PartState.fresh(x[:, p], books[p], b)
                    else:
                        state = PartState(old["own"][:, p].copy(), old["close"][:, p].copy(), old["bounds"][:, p].copy())
                        least, need = state.moved(x[:, p], books[p], moves[p], b)
                        needs += np.bincount(need, minlength=b + 2)
                    new["own"][:, p], new["close"][:, p], new["bounds"][:, p] = state.own, state.close, state.bounds
                    error += least
                    counts[p] += np.bincount(state.own, minlength=entries)
                    np.add.at(sums[p], state.own, x[:, p])
                size = new.dtype.itemsize
                packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), n, [None, pa.py_buffer(new.tobytes())]).cast(pa.binary())
                none = pa.nulls(n, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*rows.select(columns).columns, rows.column("vector"), packed, pa.array(error), none, none],
                    names=[*columns, "vector", "state", "error", "sums", "need"],
                )
        if schema is not None:
            gathered = np.concatenate([sums.ravel(), counts.ravel()])
            values = [pa.nulls(1, f.type) for f in schema] + [pa.nulls(1, pa.binary())] * 2 + [pa.nulls(1, pa.int64())]
            lists = [pa.array([v], pa.list_(pa.int64())) for v in (gathered.tolist(), needs.tolist())]
            yield pa.RecordBatch.from_arrays([*values, *lists], names=[*columns, "vector", "state", "error", "sums", "need"])

    return run


def _totals(step: DataFrame, column: str) -> np.ndarray:
    """Sum over the tasks' arrays, place by place; as many numbers as one array has reach the driver."""
    places = step.filter(f"{column} IS NOT NULL").select(F.posexplode(column).alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n"))
    found = sorted((r["at"], r["n"]) for r in places.collect())
    return np.array([n for _, n in found], np.int64)


def _whole_numbers(vectors: DataFrame, vector: str, columns: list[str], parts: int, steps: Steps) -> tuple[DataFrame, int]:
    """Vectors that are usable, as whole numbers, and the common length (0: none is usable)."""
    whole = F.transform(F.col(vector), lambda x: F.floor(F.lit(SCALE) * x.cast("double")))
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fits = (F.size(vector) > 0) & (F.size(vector) % parts == 0)
    rows = vectors.filter(F.col(vector).isNotNull() & fits & F.coalesce(finite, F.lit(False)))
    rows = steps.store(rows.select(*columns, whole.alias("_whole")), "whole")
    first = rows.orderBy(F.col(columns[0]).asc_nulls_last(), "_whole").select(F.size("_whole")).first()
    if first is None:
        return rows, 0
    rows = rows.filter(F.size("_whole") == first[0])
    top = rows.select(F.greatest(F.abs(F.array_max("_whole")), F.abs(F.array_min("_whole"))).alias("top")).agg(F.max("top")).first()[0]
    if top >= 1 << 31 or 4 * top * top * first[0] >= 1 << 63:
        raise ValueError("components are too large for exact squared distances in 64 bits")
    return rows, first[0]


def _packed(batches: Iterator[pa.RecordBatch], columns: list[str], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column("_whole").flatten().to_numpy().astype("<i4")
        packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * length), batch.num_rows, [None, pa.py_buffer(values.tobytes())])
        yield pa.RecordBatch.from_arrays([*batch.select(columns).columns, packed.cast(pa.binary())], names=[*columns, "vector"])


def compress_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    kept_bounds: int = 4,
) -> DataFrame:
    """`key`, `code`, `error`, `label_error`, `codebooks_sha256` of every usable vector.

    Components become floor(4096 * x), vectors are cut into `parts` equal parts, and each part position has a codebook
    of at most 256 `entries`. It starts from the vectors with the smallest keys. A round assigns every part to the nearest entry
    (squared Euclidean distance, ties to the lower index), then moves each entry to the componentwise floor of the
    mean of its parts; entries without parts stay. After the last round parts are assigned again. `code` has two
    hexadecimal digits per part, `error` is the sum of the squared distances, `label_error` its sum over rows with the
    same label (nulls are one label), `codebooks_sha256` the digest of all final components, joined by commas. All
    results are exact; `kept_bounds` changes the work only.

    Vectors that are null, empty or not divisible by `parts`, that hold null or non-finite components, or whose length
    is not that of the first usable one by key, are dropped. A null key comes last, equal keys go by their vectors, and
    repeated rows count and stay. Fewer vectors than entries make fewer entries; an empty table gives no rows. Other
    columns are not read. Components whose squared distances could exceed 64 bits are an error.
    """
    spark = vectors.sparkSession
    steps = Steps(spark, "codes")
    names = {"_key": key, "_label": label}
    narrow = vectors.select(*[F.col(c).alias(n) for n, c in names.items()], F.col(vector).alias("_vector"))
    types = {n: narrow.schema[n].dataType.simpleString() for n in names}
    rows, length = _whole_numbers(narrow, "_vector", list(names), parts, steps)
    if not length:
        shape = f"{key} {types['_key']}, code string, error long, label_error long, codebooks_sha256 string"
        return spark.createDataFrame([], shape)
    seeds = rows.orderBy(F.col("_key").asc_nulls_last(), "_whole").limit(entries).select("_whole").collect()
    books = np.array([r["_whole"] for r in seeds], np.int64).reshape(len(seeds), parts, length // parts).transpose(1, 0, 2)
    columns, shape = list(names), ", ".join(f"{n} {t}" for n, t in types.items())
    step = steps.store(rows.mapInArrow(lambda b: _packed(b, columns, length), f"{shape}, vector binary"), "vectors")
    steps.drop("whole")
    b = old_b = max(0, min(kept_bounds, books.shape[1] - 1))
    moves, last = None, "vectors"
    for turn in range(rounds + 1):
        run = _round(books, moves, old_b, b, columns)
        step = steps.store(step.filter("vector IS NOT NULL").mapInArrow(run, f"{shape}, {_STATE}"), f"round{turn}")
        steps.drop(last)
        last, old_b = f"round{turn}", b
        if turn == rounds:
            break
        totals = _totals(step, "sums")
        sums, counts = totals[: books.size].reshape(books.shape), totals[books.size :].reshape(books.shape[:2])
        means = np.floor_divide(sums, np.maximum(counts, 1)[:, :, None])
        moved = np.where(counts[:, :, None] > 0, means, books)
        distance = _up(_squared(moved, books))
        moves = np.nextafter(distance.astype(np.float32), np.float32(np.inf))
        moves[distance == 0] = 0
        books = moved
        needs = np.cumsum(_totals(step, "need"))
        if turn:  # the first round has no bounds yet
            enough = int(np.searchsorted(needs[: b + 1] * 1000, needs[-1] * _DECIDED))
            b = min(b, max(enough, 1))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    final = step.filter("vector IS NOT NULL")
    labels = steps.store(final.groupBy("_label").agg(F.sum("error").alias("label_error"), F.count("*").alias("uses")), "labels")
    coded = final.select(*columns, F.lower(F.hex(F.substring("state", 1, parts))).alias("code"), "error")
    out = join_uneven(coded, labels, ["_label"], "uses")
    return out.select(F.col("_key").alias(key), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
