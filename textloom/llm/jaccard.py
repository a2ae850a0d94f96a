"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

The matrix is first cut to the columns and rows that can matter. A document keeps its first n-grams in a hash
order, so many that two similar documents must share a number of them that follows from their sizes. Columns
with one document and documents with too few shared columns go; both steps lose no pair. The whole sets of the
documents that are left go through the same steps, in which columns are in the order of their frequency. The
rest falls into blocks of documents around a common one. Within a block, tiles of the product accumulate the
overlap counts of all n-grams, and between blocks those of the pairs that still share a rare column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.llm.arrays import chunks, groups, mix, shingle_hashes
from textloom.llm.components import components
from textloom.llm.scratch import Steps, free_name
from textloom.session import materialised

#: Rows and n-grams of one tile of the product.
TILE_ROWS, TILE_NGRAMS = 512, 400_000


def _sets(batches: Iterator[pa.RecordBatch], text: str, words: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, int]]:
    """Row by row: its batch and number in it, its sorted distinct n-gram hashes, and a digest of the set."""
    for rows, data, offsets in chunks(batches, text):
        hashes, at = shingle_hashes(data, offsets, words)
        for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
            ordered = np.sort(hashes[a:b])
            if len(ordered):
                ordered = ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])]
            digest = mix(np.array([mix(ordered).sum() + np.uint64(len(ordered))], np.uint64)).view(np.int64)[0]
            yield rows, i, ordered, int(digest)


def _slack(n: Column, num: int, den: int) -> Column:
    """How many of its `n` n-grams a document may not share with a similar one: `n - ceil(n * num / den)`."""
    return F.floor(n * (den - num) / den)


def _shared(n: Column, num: int, den: int, extra: float) -> Column:
    return F.floor(_slack(n, num, den) * extra) + 1


def _incidence(docs: DataFrame, num: int, den: int, words: int, key: str, text: str, extra: float) -> DataFrame:
    """Per document: `key`, a hash of the text, `n`, `digest` of the set (null if empty) and its first n-grams
    in hash order.

    The prefix has `slack + shared` n-grams. Two sets with an overlap of at least `n - slack` each have their
    first `shared` common n-grams, for the smaller `shared` of the two, within both prefixes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []
        size = 0
        for rows, i, ordered, digest in _sets(batches, text, words):
            n = len(ordered)
            slack = n * (den - num) // den
            prefix = ordered[: slack + int(slack * extra) + 1]
            out.append((rows.column(key)[i].as_py(), rows.column("row_hash")[i].as_py(), n, digest if n else None, prefix))
            size += len(prefix)
            if size > 1 << 18:
                yield batch(out)
                out, size = [], 0
        if out:
            yield batch(out)

    def batch(out: list) -> pa.RecordBatch:
        bounds = np.concatenate([[0], np.cumsum([len(r[4]) for r in out])])
        prefixes = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate([r[4] for r in out]).view(np.int64)))
        columns = [pa.array([r[j] for r in out], pa.int64()) for j in range(4)]
        return pa.RecordBatch.from_arrays([*columns, prefixes], names=[key, "row_hash", "n", "digest", "prefix"])

    keyed = docs.select(F.col(key).cast("long").alias(key), F.xxhash64(text).alias("row_hash"), text)
    return keyed.mapInArrow(run, f"{key} long, row_hash long, n long, digest long, prefix array<long>")


def _rarest(rows: DataFrame, need: Column, steps: Steps, name: str) -> DataFrame:
    """`digest`, `n`, `h`, `g`: for every set its rarest shared columns, so many that similar sets meet in one.

    `rows` are `digest`, `n` and column `h`; similar sets have `need` columns of a set or more in common there.
    Columns with one set and sets with fewer shared columns are dropped, three times and twice; `g` columns
    of a set are left.
    """
    often = rows.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").select("h")
    shared = rows.join(often.hint("merge"), "h").distinct()
    for turn in range(2):
        shared = steps.store(shared.select("digest", "n", "h"), f"{name}-{turn}")
        steps.drop()
        df = shared.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
        met = shared.join(df, "h")
        enough = met.groupBy("digest", "n").agg(F.count("*").alias("g")).filter(F.col("g") >= need)
        shared = met.join(enough.select("digest", "g"), "digest")
    # a set has at most as many rows here as its text has words
    rarest = W.partitionBy("digest").orderBy("df", "h")
    kept = shared.withColumn("at", F.row_number().over(rarest)).filter(F.col("at") <= F.col("g") - need + 1)
    kept = steps.store(kept.select("digest", "n", "h", "g"), name)
    steps.drop(f"{name}-0", f"{name}-1")
    return kept


def _blocks(kept: DataFrame) -> DataFrame:
    """`digest` and `block`: each set joins the richest set that it meets in one of its columns, and that one's.

    Following the richer set twice brings a group of near copies together whose members meet different ones.
    """
    richest = kept.groupBy("h").agg(F.max(F.struct("g", "digest")).alias("top"), F.min("digest").alias("x"), F.max("digest").alias("y"))
    richest = richest.filter("x <> y").select("h", "top")  # of two sets or more
    blocks = materialised(kept.join(richest, "h").groupBy("digest").agg(F.max("top")["digest"].alias("block")), "richest")
    for _ in range(2):
        onward = blocks.select(F.col("digest").alias("block"), F.col("block").alias("next"))
        blocks = blocks.join(onward, "block", "left").select("digest", F.coalesce("next", "block").alias("block"))
    return blocks


def _tile_links(table: pa.Table, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Links within one tile of a block, or between two: the product of incidence rows, column by column block.

    Emits each set with the smallest-numbered one that links connect it with inside the tile.
    """
    sets = table.column("hashes").combine_chunks()
    digest, tile = table.column("digest").to_numpy(), table.column("tile").to_numpy()
    m = len(digest)
    if m < 2:
        return
    size = sets.value_lengths().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(m), size)
    _, column, count = np.unique(sets.flatten().to_numpy(), return_inverse=True, return_counts=True)
    used = count > 1
    number = np.cumsum(used) - 1
    row, column = row[used[column]], number[column[used[column]]]
    overlap = np.zeros((m, m), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for start in range(0, int(used.sum()), 2048):
        a, b = np.searchsorted(column, (start, start + 2048))
        part = np.zeros((m, 2048), np.float32)
        part[row[a:b], column[a:b] - start] = 1
        overlap += part @ part.T
    # a pair below the bound of its sizes is discarded here
    union = size[:, None] + size[None, :] - overlap
    linked = den * overlap.astype(np.float64) >= num * union
    if tile.min() != tile.max():
        linked &= tile[:, None] != tile[None, :]
    np.fill_diagonal(linked, True)
    label = np.arange(m)
    while True:
        least = np.where(linked, label[None, :], m).min(1)
        least = least[least]
        if (least == label).all():
            break
        label = least
    off = np.flatnonzero(label != np.arange(m))
    if len(off):
        yield pa.RecordBatch.from_pydict({"a": digest[off], "b": digest[label[off]]})


def _inside(blocks: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links within the blocks. A large block is cut to tiles, and every two tiles meet in one place."""
    size = blocks.groupBy("block").agg(F.count("*").alias("m"), F.sum("n").alias("total")).filter("m > 1")
    tiles = F.greatest(F.ceil(F.col("m") / TILE_ROWS), F.ceil(F.col("total") / TILE_NGRAMS)).cast("int")
    dealt = blocks.join(size.select("block", tiles.alias("tiles")), "block").withColumn(
        "tile", F.pmod(F.xxhash64("digest"), F.col("tiles")).cast("int")
    )
    met = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    pairs = met.select(
        "digest", "block", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile"
    )
    rows = pairs.join(sets, "digest").repartition("block", "i", "j").sortWithinPartitions("block", "i", "j")
    return rows.mapInArrow(lambda b: groups(b, ["block", "i", "j"], lambda t: _tile_links(t, num, den)), "a long, b long")


def _between(kept: DataFrame, blocks: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links between sets of different blocks that meet in a column and whose sizes allow it."""
    rows = kept.select("digest", "n", "h").join(blocks.select("digest", "block"), "digest")
    mixed = rows.groupBy("h").agg(F.min("block").alias("x"), F.max("block").alias("y")).filter("x <> y").select("h")
    rows = materialised(rows.join(mixed, "h"), "mixed")
    a, b = (rows.select("h", *[F.col(c).alias(f"{c}_{s}") for c in ("digest", "n", "block")]) for s in "ab")
    near = F.col("n_a").between(F.ceil(F.col("n_b") * num / den), F.floor(F.col("n_b") * den / num))
    pairs = materialised(
        a.join(b, "h").filter((F.col("block_a") < F.col("block_b")) & near).select("digest_a", "digest_b", "n_a", "n_b").distinct(), "pairs"
    )
    left, right = (sets.select(F.col("digest").alias(f"digest_{s}"), F.col("hashes").alias(f"set_{s}")) for s in "ab")
    overlap = F.size(F.array_intersect("set_a", "set_b"))
    both = pairs.join(left, "digest_a").join(right, "digest_b").withColumn("o", overlap)
    linked = both.filter(F.col("o") * den >= (F.col("n_a") + F.col("n_b") - F.col("o")) * num)
    return linked.select(F.col("digest_a").alias("a"), F.col("digest_b").alias("b"))


def jaccard_components(
    docs: DataFrame, num: int = 80, den: int = 100, words: int = 5, key: str = "doc_id", text: str = "text", extra: float = 0.5
) -> DataFrame:
    """`key`, `n_shingles`, `component_id` and `row_hash` (Spark's 64-bit hash of the text) of every document.

    A document's set are its distinct n-grams of `words` lower-cased words of the whole text; with fewer words
    the whole sequence is the only one, without words the set is empty. Documents link if
    `den * intersection >= num * union`; `component_id` is the smallest key that links lead to. Equal sets are
    one row of the matrix, whatever their number. `extra` says how many n-grams beyond the least a document
    shows for the search; it changes the work, never the result. N-grams and sets are told apart by 64-bit
    hashes.

    Null texts have empty sets; an empty set and a row with a null key link with nothing (its component is its
    key). Repeated rows stay. Other columns are not read. `key` is a whole number.
    """
    steps = Steps(docs.sparkSession, "jaccard")
    incidence = steps.store(_incidence(docs, num, den, words, key, text, extra), "incidence")
    usable = F.col("digest").isNotNull() & F.col(key).isNotNull()
    documents = steps.store(incidence.drop("prefix"), "documents")
    known = documents.filter(usable)
    # first by the prefixes of all documents, then by the whole sets of those that are left
    smallest = _shared(F.ceil(F.col("n") * num / den), num, den, extra)
    near = _rarest(incidence.filter(usable).select("digest", "n", F.explode("prefix").alias("h")), smallest, steps, "near")
    steps.drop("incidence")
    one = known.select("digest", key).join(near.select("digest").distinct(), "digest", "left_semi").groupBy("digest").agg(F.min(key).alias(key))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the join brings equal keys one after the other; a repeated set does no harm later
        for rows, i, ordered, digest in _sets(batches, text, words):
            # another row of the same key may have another text
            if digest == rows.column("digest")[i].as_py() and digest != last:
                last = digest
                yield pa.RecordBatch.from_pydict({"digest": [digest], "hashes": [ordered.view(np.int64)]})

    texts = docs.select(F.col(key).cast("long").alias(key), text).join(one.hint("merge"), key)
    full = steps.store(texts.mapInArrow(sets, "digest long, hashes array<long>"), "sets")
    steps.drop("near")
    size = F.size("hashes").cast("long").alias("n")
    kept = _rarest(full.select("digest", size, F.explode("hashes").alias("h")), F.col("n") - _slack(F.col("n"), num, den), steps, "kept")
    blocks = steps.store(_blocks(kept).join(kept.select("digest", "n").distinct(), "digest"), "blocks")
    links = _inside(blocks, full, num, den).unionByName(_between(kept, blocks, full, num, den))
    roots = components(links).withColumnRenamed("id", "digest")
    placed = known.select(key, "digest").join(roots, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    least = placed.groupBy("root").agg(F.min(key).alias("component_id"))
    by_digest = placed.select("digest", "root").distinct().join(least, "root").select("digest", "component_id")
    out = documents.select(key, "row_hash", F.col("n").alias("n_shingles"), "digest").join(by_digest, "digest", "left")
    return out.select(key, "n_shingles", F.when(F.col(key).isNotNull(), F.coalesce("component_id", key)).alias("component_id"), "row_hash")


def one_of_each(docs: DataFrame, num: int = 80, den: int = 100, words: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, of which only the one with the smallest key of each component stays.

    Rows with the same key and text are one. Rows with a null key, and documents without words, stay.
    """
    found = jaccard_components(docs, num, den, words, key, text, extra=0.25)
    mark, other, hashed, lone = (free_name(docs, name) for name in ("_text_hash", "_other_key", "_other_hash", "_lone"))
    gone = found.filter(F.col("component_id") != F.col(key)).select(F.col(key).alias(other), F.col("row_hash").alias(hashed))
    # a row without a key repeats no other one
    marked = docs.withColumn(mark, F.xxhash64(text)).withColumn(lone, F.when(F.col(key).isNull(), F.monotonically_increasing_id()))
    left = marked.join(gone.hint("merge"), (F.col(key).cast("long") == F.col(other)) & (F.col(mark) == F.col(hashed)), "left_anti")
    return left.dropDuplicates([key, mark, lone]).select(*docs.columns)
