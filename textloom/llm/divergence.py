"""Source divergence audit: how far the word use of each source is from its language and from its other sources.

A source's divergences from all its peers are a row of a sparse product, gathered by Gustavson's method: for each of
its terms, the term's list of sources in the term-major index is scattered into a dense accumulator with a place per
peer. No pair of postings leaves a task. The accumulators start from what the divergence would be if the two sources
had no term in common, where every count that one of them lacks is the baseline of a count of zero; a shared term adds
its own divergence and takes the baselines out. The index is cut into blocks of terms, and the rows of the product
into tiles of sources, so that the accumulators of a task are bounded; the tasks' accumulators are added up.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.llm.arrays import LOWER, chunks, word_spans
from textloom.llm.scratch import Steps
from textloom.operators.scoring import join_uneven

#: ASCII bytes other than letters part terms; every other byte belongs to one.
PARTS = np.ones(256, bool)
PARTS[128:] = False
for _first in b"Aa":
    PARTS[_first : _first + 26] = False

_ACCUMULATORS = 8 << 20  # numbers in the accumulators of a task
_BLOCK = 50_000  # postings of a block of terms, or as many as the accumulators that it adds, if those are more
_EXPANDED = 1 << 20  # postings scattered at once

_COUNTS = "lang string, source string, term string, n long, docs long"


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of every term, and documents with it, per language and source of a few megabytes of text.

    Each language and source also has a row with the empty term, which no text holds.
    """
    for rows, data, offsets in chunks(batches, "text", 4 << 20):
        parts = PARTS[data]
        starts, ends, first = word_spans(parts, offsets)
        bounds = np.concatenate([[0], np.cumsum(ends - starts)])
        spelled = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(LOWER[data[~parts]])])
        coded = spelled.dictionary_encode()
        term, terms = coded.indices.to_numpy().astype(np.int64), max(len(coded.dictionary), 1)
        lang, source = (rows.column(c).dictionary_encode() for c in ("lang", "source"))
        pair = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        pairs, group = np.unique(pair, return_inverse=True)
        doc_term, times = np.unique(np.repeat(np.arange(rows.num_rows), np.diff(first)) * terms + term, return_counts=True)
        found, at = np.unique(group[doc_term // terms] * terms + doc_term % terms, return_inverse=True)
        n = np.bincount(at, times, len(found)).astype(np.int64)
        docs = np.bincount(at, minlength=len(found)).astype(np.int64)
        owner = np.concatenate([found // terms, np.arange(len(pairs))])
        spelling = pa.concat_arrays([coded.dictionary.take(pa.array(found % terms)), pa.array([b""] * len(pairs), pa.large_binary())])
        none = np.zeros(len(pairs), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                lang.dictionary.take(pa.array(pairs[owner] // len(source.dictionary))),
                source.dictionary.take(pa.array(pairs[owner] % len(source.dictionary))),
                spelling.cast(pa.large_string()).cast(pa.string()),
                pa.array(np.concatenate([n, none])),
                pa.array(np.concatenate([docs, none])),
            ],
            names=["lang", "source", "term", "n", "docs"],
        )


def shares(count: np.ndarray, total: np.ndarray | int, kept: int) -> np.ndarray:
    """1 + floor(10**9 * (count + 2) / (total + 2 * kept)), divided in three steps that fit 64 bits."""
    over = np.asarray(total, np.int64) + 2 * kept
    share, rest = np.divmod(np.asarray(count, np.int64) + 2, over)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, over)
        share = share * 1000 + digits
    return share + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


_PIECES = "lang string, source string, part string, item string, value long"


class _Tile:
    """The accumulators of the sources `mine` of one language, over one block of its terms."""

    def __init__(self, lang: str, groups: pa.Table, top: int):
        self.lang, self.top = lang, top
        self.names = groups.column("item").combine_chunks()
        self.kept, self.all = groups.column("kept")[0].as_py(), groups.column("whole")[0].as_py()
        self.total = groups.column("total").to_numpy()
        self.distribution = groups.column("distribution").combine_chunks()
        self.owns = self.distribution.is_valid().to_numpy(zero_copy_only=False)
        mine = np.flatnonzero(groups.column("mine").to_numpy(zero_copy_only=False))
        self.mine, self.row = mine, np.full(len(groups), -1)
        self.row[mine] = np.arange(len(mine))
        self.used = groups.column("terms").to_numpy()
        if self.kept:
            self.zero = shares(np.zeros(len(groups), np.int64), self.total, self.kept)
        self.sums = np.zeros((len(mine), len(groups)), np.int64)

    def rows(self, source: np.ndarray, part: str, item: pa.Array, value: np.ndarray) -> pa.RecordBatch:
        n = len(value)
        columns = [pa.repeat(self.lang, n), self.names.take(pa.array(source)), pa.repeat(part, n), item, pa.array(value)]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "part", "item", "value"])

    def scatter(self, index: pa.Table) -> Iterator[pa.RecordBatch]:
        """Take in rows of the index, sorted by term; yields the most telling of its terms for each source of `mine`."""
        postings = index.column("postings").combine_chunks()
        size = pc.list_value_length(postings).to_numpy()
        flat = postings.flatten()
        peer = pc.index_in(flat.field("source"), self.names).to_numpy()
        p = shares(flat.field("n").to_numpy(), self.total[peer], self.kept)
        term = np.repeat(np.arange(len(size)), size)
        begin = (np.cumsum(size) - size)[term]
        own = np.flatnonzero(self.row[peer] >= 0)
        width = size[term[own]]
        cut = [0, *np.searchsorted(np.cumsum(width), np.arange(_EXPANDED, width.sum(), _EXPANDED), "right"), len(own)]
        for low, high in itertools.pairwise(cut):
            if low < high:
                self._scatter(own[low:high], width[low:high], begin, peer, p)
        q = shares(index.column("total").to_numpy(), self.all, self.kept)[term[own]]
        more = own[p[own] > q]
        value = divergence(p[more], q[p[own] > q])
        order = np.lexsort((term[more], -value, peer[more]))
        source = peer[more][order]
        place = np.arange(len(order)) - np.searchsorted(source, source)
        best = order[place < self.top]
        yield self.rows(peer[more][best], "term", index.column("item").combine_chunks().take(pa.array(term[more][best])), value[best])

    def _scatter(self, own: np.ndarray, width: np.ndarray, begin: np.ndarray, peer: np.ndarray, p: np.ndarray) -> None:
        entry = np.repeat(own, width)
        other = np.arange(len(entry)) - np.repeat(np.cumsum(width) - width, width) + begin[entry]
        g, h, x, y = peer[entry], peer[other], p[entry], p[other]
        here, there = self.zero[g], self.zero[h]
        change = divergence(x, y) - divergence(x, there) - divergence(here, y) + divergence(here, there)
        np.add.at(self.sums.ravel(), self.row[g] * len(self.names) + h, change)

    def _base(self, g: int) -> np.ndarray:
        """Divergence of the terms of source `g` from the baselines of all others."""
        out = np.zeros(len(self.names), np.int64)
        if self.kept:
            found = self.distribution[int(g)].values
            p, times = shares(found.field("n").to_numpy(), self.total[g], self.kept), found.field("times").to_numpy()
            step = max(1, _EXPANDED // len(out))
            for at in range(0, len(p), step):
                out += (divergence(p[at : at + step, None], self.zero[None, :]) * times[at : at + step, None]).sum(0)
        return out

    def finish(self) -> Iterator[pa.RecordBatch]:
        everyone = np.arange(len(self.names))
        for g in self.mine:
            others = everyone[everyone != g]
            same = np.full(len(others), g)
            value = self.sums[self.row[g]][others]
            if self.owns[g]:  # one block adds the baselines of this source
                base = self._base(g)[others]
                if self.kept:
                    value = value + base + (self.kept - self.used[g] - self.used[others]) * divergence(self.zero[g], self.zero[others])
                    yield self.rows(others, "pair", self.names.take(pa.array(same)), base)
                yield self.rows(same, "pair", self.names.take(pa.array(others)), value)
            else:
                some = value != 0
                yield self.rows(same[some], "pair", self.names.take(pa.array(others[some])), value[some])


def _gather(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks one after the other: first the sources of the language, then the rows of the index."""
        key, tile, groups = None, None, []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("lang", "block", "tile", "index")]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            for low, high in zip([0, *change], [*change, batch.num_rows], strict=True):
                if low == high:
                    continue
                part = table.slice(low, high - low)
                now = tuple(k[low] for k in keys[:3])
                if now != key:
                    if key is not None:
                        tile = tile or _Tile(key[0], pa.concat_tables(groups), top)
                        yield from tile.finish()
                    key, tile, groups = now, None, []
                if not keys[3][low]:
                    groups.append(part)
                    continue
                tile = tile or _Tile(key[0], pa.concat_tables(groups), top)
                yield from tile.scatter(part)
        if key is not None:
            tile = tile or _Tile(key[0], pa.concat_tables(groups), top)
            yield from tile.finish()

    return run


def source_divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 10, top: int = 10
) -> DataFrame:
    """`lang`, `source`, `part`, `item`, `value`, `rank`: what sets every source of a language apart.

    Terms are the runs of ASCII letters and other characters beyond ASCII, A-Z lower-cased. A language keeps the terms
    in at least `min_docs` of its documents. With `count` occurrences of a term, `N` of all V kept terms, its share is
    p = 1 + floor(10**9 * (count + 2) / (N + 2 * V)), in a source as in the whole language, and two shares diverge by
    floor((p - q)**2 / (p + q)), all in whole numbers. Part `pair` has a row per other source of the language, with
    the sum over all kept terms (0 if V is 0). Part `term` has the `top` terms of the source that are more frequent in
    it than in the language, with their divergence from it. `rank` counts from 1 within source and part: the greatest
    value first, then the item in the order of its UTF-8 bytes.

    Null texts, languages and sources are empty strings, and those are a language and a source like others. A source
    without terms has all its pairs and no terms. Repeated rows are documents of their own. Equal values are ranked by
    item. An empty table gives no rows; long texts count whole; other columns are not read.
    """
    steps = Steps(docs.sparkSession, "divergence")
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))]
    pieces = docs.select(*named).mapInArrow(_count_terms, _COUNTS)
    counts = pieces.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = steps.store(counts, "counts")
    # a term's list is no longer than the list of its language's sources
    lists = counts.filter("term <> ''").groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("postings")
    )
    index = steps.store(lists.filter(F.col("docs") >= max(min_docs, 1)).drop("docs"), "index")
    groups = steps.store(counts.filter("term = ''").select("lang", "source"), "sources")
    steps.drop("counts")

    same = index.select("lang", F.inline("postings")).groupBy("lang", "source", "n").agg(F.count("*").alias("times"))
    used = same.groupBy("lang", "source").agg(
        F.sum(F.col("n") * F.col("times")).alias("total"), F.sum("times").alias("terms"), F.collect_list(F.struct("n", "times")).alias("distribution")
    )
    kept = index.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("whole"), F.sum(F.size("postings")).alias("postings"))
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(kept, "lang", "left").fillna(0, ["kept", "whole", "postings"])
    square = F.col("sources") * F.col("sources")
    langs = langs.withColumn("tiles", F.ceil(square / _ACCUMULATORS)).withColumn(
        "blocks", F.floor(F.col("postings") / F.greatest(square, F.lit(_BLOCK))) + 1
    )
    langs = steps.store(langs.drop("postings"), "langs")

    none = F.array().cast("array<struct<n: long, times: long>>")
    groups = steps.store(groups.join(used, ["lang", "source"], "left"), "groups")
    rows = join_uneven(groups, langs, ["lang"], "sources")
    rows = rows.withColumns({
        "block": F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)), "home": F.pmod(F.xxhash64("source"), "tiles"),
        "first": F.pmod(F.xxhash64("source", F.lit(1)), "blocks"), "distribution": F.coalesce("distribution", none),
    }).withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    mine = F.col("home") == F.col("tile")
    rows = rows.select(
        "lang", "block", "tile", F.lit(False).alias("index"), F.col("source").alias("item"), F.coalesce("total", F.lit(0)).alias("total"),
        F.lit(None).cast("array<struct<source: string, n: long>>").alias("postings"), "kept", "whole", F.coalesce("terms", F.lit(0)).alias("terms"),
        mine.alias("mine"), F.when(mine & (F.col("first") == F.col("block")), F.col("distribution")).alias("distribution"),
    )
    dealt = join_uneven(index, langs.filter("kept > 0"), ["lang"], "kept")
    dealt = dealt.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))).select(
        "lang", F.pmod(F.xxhash64("term"), "blocks").alias("block"), "tile", F.lit(True).alias("index"), F.col("term").alias("item"), "total",
        "postings", *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("kept", "whole", "terms", "mine", "distribution")],
    )
    place = ["lang", "block", "tile"]
    stream = rows.unionByName(dealt).repartition(*place).sortWithinPartitions(*place, "index", "item")
    found = stream.mapInArrow(_gather(top), _PIECES).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = W.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    return found.withColumn("rank", F.row_number().over(order)).filter((F.col("part") == "pair") | (F.col("rank") <= top))
