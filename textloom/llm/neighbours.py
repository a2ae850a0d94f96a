"""Embedding near-dedup: a small-world graph per shard, every shard searched by all vectors of its label."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from textloom.llm import hnsw
from textloom.llm.arrays import mix
from textloom.llm.components import components
from textloom.llm.scratch import Steps

#: Rows of a graph, which one task holds in memory, and queries that search it together.
SHARD_ROWS, CHUNK_ROWS = 16_000, 512
#: Queries that one copy of a graph meets at least, unless cores would have no work, and bytes of vectors in a piece of a graph.
LOT_ROWS, PIECE_BYTES = 65_536, 256 << 10
#: First width of the search beams, queries that are audited per chunk and shard, and the recall to reach.
BEAM, AUDITED, RECALL = 64, 48, 0.99


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dim)


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector by its largest number, so that squares neither vanish nor overflow."""
    wide = vectors.astype(np.float64)
    return wide / np.abs(wide).max(axis=1, keepdims=True)


def _distinct(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each distinct vector, and which of them every vector is."""
    whole = np.ascontiguousarray(vectors + 0.0)  # one kind of zero
    _, first, which = np.unique(whole.view(np.dtype((np.void, whole.itemsize * whole.shape[1]))).ravel(), return_index=True, return_inverse=True)
    return first, which.ravel()


def _build(table: pa.Table) -> pa.Table:
    """The graph of a shard in pieces of consecutive nodes. Equal vectors are one node, whose rows lie one after the other."""
    table = table.combine_chunks()
    rows = table.column("row").to_numpy()
    dim = table.column("dim")[0].as_py()
    raw = _matrix(table.column("vector").combine_chunks(), dim)
    vectors = _scaled(raw)
    first, which = _distinct(vectors)
    distinct = vectors[first]
    unit = distinct / np.linalg.norm(distinct, axis=1, keepdims=True)
    draw = (mix(rows[first].astype(np.uint64)) >> np.uint64(11)).astype(np.float64) / 2.0**53
    graph, order = hnsw.build(unit, np.maximum(draw, 1e-12))
    node = np.empty(len(order), np.int64)
    node[order] = np.arange(len(order))
    ids = rows[np.lexsort((rows, node[which]))]
    sizes = np.bincount(node[which], minlength=len(order)).astype(np.int64)
    ends, nodes = np.concatenate([[0], np.cumsum(sizes)]), raw[first][order]
    # the nodes of an upper level are the first ones, the others have no links there
    used = [int(np.flatnonzero((level >= 0).any(1)).max(initial=-1)) + 1 for level in graph.links]
    step = max(1, PIECE_BYTES // (raw.itemsize * dim))
    starts = range(0, len(order), step)
    return pa.Table.from_pydict({
        "cell": [table.column("cell")[0].as_py()] * len(starts), "shard": [table.column("shard")[0].as_py()] * len(starts),
        "piece": list(range(len(starts))), "dim": [dim] * len(starts),
        "rows": [ids[ends[i] : ends[min(i + step, len(order))]].tobytes() for i in starts],
        "sizes": [sizes[i : i + step].tobytes() for i in starts], "vectors": [nodes[i : i + step].tobytes() for i in starts],
        "links": [[level[i : min(i + step, n)].astype(np.int32).tobytes() for level, n in zip(graph.links, used, strict=True)] for i in starts],
    }, schema=_INDEX)


_INDEX = pa.schema([
    ("cell", pa.int64()), ("shard", pa.int32()), ("piece", pa.int32()), ("dim", pa.int32()), ("rows", pa.binary()), ("sizes", pa.binary()),
    ("vectors", pa.binary()), ("links", pa.list_(pa.binary())),
])
_INDEX_SQL = "cell long, shard int, piece int, dim int, rows binary, sizes binary, vectors binary, links array<binary>"


class _Shard:
    """A shard's graph, put together from its pieces in order."""

    def __init__(self, pieces: pa.Table):
        dim = self.dim = pieces.column("dim")[0].as_py()
        whole = {c: [x.as_buffer() for chunk in pieces.column(c).chunks for x in chunk] for c in ("rows", "sizes", "vectors")}
        self.ids, self.sizes = (np.concatenate([np.frombuffer(x, np.int64) for x in whole[c]]) for c in ("rows", "sizes"))
        n = len(self.sizes)
        kind = np.float32 if sum(x.size for x in whole["vectors"]) == 4 * n * dim else np.float64
        vectors = _scaled(np.concatenate([np.frombuffer(x, kind) for x in whole["vectors"]]).reshape(n, dim))
        self.unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        links = []
        for k, level in enumerate(zip(*pieces.column("links").to_pylist(), strict=True)):
            some = np.frombuffer(b"".join(level), np.int32).reshape(-1, hnsw.most_links(k))
            links.append(np.full((n, hnsw.most_links(k)), -1, np.int64))
            links[-1][: len(some)] = some
        self.graph = hnsw.Graph(self.unit.astype(np.float32), links)


def _audit(found: list[np.ndarray], queries: np.ndarray, unit: np.ndarray, threshold: float, sample: np.ndarray) -> float:
    """Share of the true links of a sample of queries that were found; every vector of the shard is compared."""
    true = queries[sample] @ unit.T >= threshold
    hit = sum(int(true[i, found[q]].sum()) for i, q in enumerate(sample))
    return hit / max(int(true.sum()), 1)


def _compared(queries: np.ndarray, unit: np.ndarray, threshold: float) -> list[np.ndarray]:
    """The true links of every query, by comparison with all vectors, in blocks."""
    found, step = [], max(1, (4 << 20) // max(len(unit), 1))
    for start in range(0, len(queries), step):
        part = queries[start : start + step]
        for q, like in zip(part, part @ unit.T, strict=True):
            candidates = np.flatnonzero(like >= threshold - 1e-9)
            found.append(candidates[unit[candidates] @ q >= threshold])
    return found


def _search(shard: _Shard, batch: pa.Table, threshold: float) -> pa.Table:
    """Per query the number of links into the shard, and links that connect what its links connect.

    Equal queries are searched once. A beam that is full of links is doubled for its query. Then a sample, links
    first, is audited against all vectors; while it misses its recall, all beams are doubled. Beams that would be
    wider than an eighth of the shard's nodes give way to a comparison with all vectors, which misses nothing.
    """
    batch = batch.combine_chunks()
    rows, unit, graph, n = batch.column("row").to_numpy(), shard.unit, shard.graph, len(shard.unit)
    raw = _scaled(_matrix(batch.column("vector").combine_chunks(), shard.dim))
    first, which = _distinct(raw)
    queries = raw[first] / np.linalg.norm(raw[first], axis=1, keepdims=True)
    found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
    beam, todo, exact = min(BEAM, n), np.arange(len(queries)), np.zeros(len(queries), bool)
    while len(todo):
        again = []
        if beam > max(BEAM, n // 8):
            exact[todo] = True
            for q, hits in zip(todo, _compared(queries[todo], unit, threshold), strict=True):
                found[q] = hits
        else:
            step = max(1, (16 << 20) // max(n, 1))
            for start in range(0, len(todo), step):
                part = todo[start : start + step]
                near, _ = graph.search(queries[part].astype(np.float32), beam)
                for q, candidates in zip(part, near, strict=True):
                    candidates = candidates[candidates >= 0]
                    hits = candidates[unit[candidates] @ queries[q] >= threshold]  # double precision decides
                    found[q] = hits
                    if len(hits) == len(candidates) == beam:
                        again.append(q)
        todo = np.array(again, np.int64)
        if not len(todo) and not exact.all():
            walked = ~exact
            linked = np.array([len(f) > 1 for f in found])
            sample = np.concatenate([np.flatnonzero(side)[:: max(1, side.sum() // AUDITED)] for side in (walked & linked, walked & ~linked)])
            if _audit(found, queries, unit, threshold, sample) < RECALL:
                todo = np.flatnonzero(walked)
        beam *= 2
    return _links(shard.ids, shard.sizes, rows, [found[i] for i in which])


def _search_lots(threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Search sorted rows: the pieces of a shard's graph, then chunks of queries; one graph and one chunk are held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, place = None, [], None

        def finish() -> Iterator[pa.RecordBatch]:
            nonlocal shard
            if held:
                whole = pa.concat_tables(held)
                if place[-1] < 0:
                    shard = _Shard(whole)
                else:
                    yield from _search(shard, whole, threshold).to_batches()
            held.clear()

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("cell", "shard", "lot", "chunk")], axis=1)
            bounds = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for start, stop in pairwise(bounds):
                if stop > start:
                    if place != (here := tuple(keys[start].tolist())):
                        yield from finish()
                        place = here
                    held.append(pa.Table.from_batches([batch.slice(start, stop - start)]))
        yield from finish()

    return run


def _meetings(index: DataFrame, dealt: DataFrame, split: DataFrame) -> DataFrame:
    """Pieces of graphs (`chunk` -1) and queries, each query with every shard of its label. A graph is copied once per lot of chunks."""
    kind = dict(index.dtypes) | dict(dealt.dtypes)
    wide = ["cell", "shard", "lot", "chunk", "row", "dim", "rows", "sizes", "vectors", "links", "vector"]

    def shaped(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(kind[c]).alias(c) for c in wide])

    pieces = index.join(split.select("cell", "lots"), "cell").withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)))
    pieces = pieces.withColumns({"chunk": F.lit(-1), "row": F.col("piece").cast("long")})
    chunk = F.pmod(F.xxhash64("row", F.lit(1)), "chunks").cast("int")
    queries = dealt.drop("shard", "dim").withColumn("chunk", chunk).withColumn("lot", F.pmod("chunk", "lots"))
    queries = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    return shaped(pieces).unionByName(shaped(queries))


def _links(ids: np.ndarray, sizes: np.ndarray, rows: np.ndarray, found: list[np.ndarray]) -> pa.Table:
    """Counts without the vector itself, and a spanning forest of the links between queries and shard.

    A node stands for its first row. Each row is a query of its own shard once, where it meets its node; so the
    other rows of a node are linked with the first one there.
    """
    first = np.cumsum(sizes) - sizes
    order = np.argsort(ids)
    place = order[np.minimum(np.searchsorted(ids, rows, sorter=order), len(ids) - 1)]
    own = np.where(ids[place] == rows, np.searchsorted(first, place, "right") - 1, -1)  # node of a query of this shard
    found = [f if o < 0 or o in f else np.append(f, o) for o, f in zip(own, found, strict=True)]
    counts = np.array([int(sizes[f].sum()) - (o >= 0) for o, f in zip(own, found, strict=True)], np.int64)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    a, b = [], []
    for q, f in zip(rows.tolist(), found, strict=True):
        for x in ids[first[f]].tolist():
            left, right = root(q), root(x)
            if left != right:
                parent[left] = right
                a.append(q)
                b.append(x)
    none = [None]
    return pa.Table.from_pydict(
        {"row": [*rows.tolist(), *none * len(a)], "hits": [*counts.tolist(), *none * len(a)], "a": [*none * len(rows), *a], "b": [*none * len(rows), *b]},
        schema=_RESULT,
    )


_RESULT = pa.schema([("row", pa.int64()), ("hits", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.93,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """`key`, `n_links`, `component_id` and `kept` of every vector.

    Two rows link if their labels are equal and not null and their cosine, in double precision, is found to be
    at least `threshold`. The vectors of a label are dealt to shards of about `shard_rows` rows by a hash; each
    shard has a graph, and all vectors of the label search each of its graphs in chunks. A graph is stored in pieces
    and copied once per lot of chunks, whose rows a task streams. `component_id` is the
    smallest key that links lead to, `kept` says that it is the row's own. All vectors are indexed, equal ones of a
    shard as one; the search is approximate, audited against exact comparison (see `RECALL`), and gives way to it.

    Vectors that are null, empty or zero or hold null or non-finite numbers, and rows with a null label or key,
    link with nothing; vectors of different lengths do not link. Repeated rows stay and link with each other
    (their key counts once for `component_id`). Other columns are not read. `key` is a whole number.
    """
    steps = Steps(vectors.sparkSession, "neighbours")
    value, number = F.col(vector).cast("array<double>"), F.col(key).cast("long")
    numbers = F.forall(value, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    good = numbers & F.exists(value, lambda x: x != 0) & F.col(label).isNotNull() & number.isNotNull()
    narrow = isinstance(getattr(vectors.schema[vector].dataType, "elementType", None), FloatType)
    rows = steps.store(
        vectors.select(
            number.alias("key"), F.monotonically_increasing_id().alias("row"), F.xxhash64(F.col(label), F.size(value)).alias("cell"),
            F.size(value).alias("dim"), F.coalesce(good, F.lit(False)).alias("good"), F.when(good, F.col(vector) if narrow else value).alias("vector"),
        ),
        "rows",
    )
    usable = rows.filter("good")
    size = usable.groupBy("cell").agg(F.count("*").alias("n"))
    split = size.select("cell", "n", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards"), F.ceil(F.col("n") / CHUNK_ROWS).cast("int").alias("chunks"))
    # lots are for the cores only, no result depends on them: some four per core, if there are as many chunks
    work = split.agg(F.sum(F.col("n") * F.col("shards"))).scalar()
    lots = F.greatest(F.ceil(F.col("n") / LOT_ROWS), F.ceil(4 * vectors.sparkSession.sparkContext.defaultParallelism * F.col("n") / work))
    split = split.withColumn("lots", F.least("chunks", lots).cast("int"))
    dealt = usable.join(split, "cell").select("cell", "row", "dim", "vector", "shards", "chunks", "lots", F.pmod(F.xxhash64("row"), "shards").cast("int").alias("shard"))
    index = steps.store(dealt.groupBy("cell", "shard").applyInArrow(_build, _INDEX_SQL), "index")
    steps.drop()
    lot = ["cell", "shard", "lot"]
    met = _meetings(index, dealt, split).repartition(*lot).sortWithinPartitions(*lot, "chunk", "row")
    found = steps.store(met.mapInArrow(_search_lots(threshold), "row long, hits long, a long, b long"), "found")
    steps.drop("index")
    counts = found.filter("row IS NOT NULL").groupBy("row").agg(F.sum("hits").alias("hits"))
    roots = components(found.filter("a IS NOT NULL").select("a", "b")).withColumnRenamed("id", "row")
    placed = rows.select("key", "row").join(counts, "row", "left").join(roots, "row", "left").withColumn("root", F.coalesce("root", "row"))
    least = placed.groupBy("root").agg(F.min("key").alias("component_id"))
    return placed.join(least, "root").select(
        F.col("key").cast(vectors.schema[key].dataType).alias(key), F.coalesce("hits", F.lit(0)).alias("n_links"), "component_id",
        F.col("key").eqNullSafe(F.col("component_id")).alias("kept"),
    )
