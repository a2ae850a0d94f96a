"""First keyword of a table of any size that occurs in a text, by an index of short grams.

Every keyword is found by one gram of at most four bytes: of its grams the one that the fewest keywords have. A
table within a bound goes to all executors, where whole batches of texts are compared with it at once; a larger one
is joined by gram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import materialised

GRAM = 4
#: Bytes of keywords, categories and priorities that may be sent to every executor.
SENT_BYTES = 64 << 20
#: Places in a batch that are compared at once.
BLOCK = 1 << 20


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each starts and ends; a null text is empty."""
    whole = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = whole.buffers()[2]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """The gram of `size` bytes at every place that has one, marked by its size."""
    places = max(0, len(data) - size + 1)
    value = np.full(places, size, np.uint64)
    for i in range(size):
        value = value << np.uint64(8) | data[i : i + places]
    return value


def _slot(grams: np.ndarray, bits: int) -> np.ndarray:
    return (grams * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


class KeywordIndex:
    """Keywords with ranks; `first` gives each text the least rank of the keywords that occur in it."""

    def __init__(self, keywords: list[str], ranks: list[int]):
        self.data, starts = _bytes(pa.array(keywords, pa.string()))
        self.start, self.size = starts[:-1], np.diff(starts)
        self.rank = np.array(ranks, np.int64)
        self.none = int(self.rank.max(initial=-1)) + 1
        self.always = int(self.rank[self.size == 0].min(initial=self.none))
        self.tables = {size: self._table(size) for size in range(1, GRAM + 1)}

    def _table(self, size: int) -> tuple | None:
        mine = np.flatnonzero(self.size == size if size < GRAM else self.size >= GRAM)
        if not len(mine):
            return None
        places = self.size[mine] - size + 1
        word = np.repeat(np.arange(len(mine)), places)
        within = np.arange(places.sum()) - np.repeat(np.cumsum(places) - places, places)
        gram = _grams(self.data, size)[self.start[mine][word] + within]
        _, which, users = np.unique(gram, return_inverse=True, return_counts=True)
        rarest = np.lexsort((within, users[which], word))
        chosen = rarest[np.cumsum(places) - places]
        chosen = chosen[np.lexsort((self.rank[mine], gram[chosen]))]
        values, first, counts = np.unique(gram[chosen], return_index=True, return_counts=True)
        bits = int(np.clip(np.ceil(np.log2(32 * len(values))), 12, 26))
        present = np.zeros(1 << bits, bool)
        present[_slot(values, bits)] = True
        return values, first, counts, mine[word[chosen]], within[chosen], present, bits

    def first(self, texts: pa.Array) -> np.ndarray:
        """Least rank per text, `none` where no keyword occurs or the text is null."""
        data, offsets = _bytes(texts)
        best = np.full(len(texts), self.always, np.int64)
        for size, table in self.tables.items():
            if table is not None:
                for at in range(0, len(data), BLOCK):
                    self._block(data, offsets, best, size, table, at)
        best[np.asarray(texts.is_null())] = self.none
        return best

    def _block(self, data: np.ndarray, offsets: np.ndarray, best: np.ndarray, size: int, table: tuple, at: int) -> None:
        values, first, counts, words, within, present, bits = table
        gram = _grams(data[at : at + BLOCK + size - 1], size)
        place = np.flatnonzero(present[_slot(gram, bits)])
        found = np.searchsorted(values, gram[place])
        same = values[np.minimum(found, len(values) - 1)] == gram[place]
        place, found = place[same] + at, found[same]
        text = np.searchsorted(offsets, place, "right") - 1
        # candidates are keyword and place; so many at a time that a gram of many keywords stays within bounds
        ends = np.cumsum(counts[found])
        for low in range(0, int(ends[-1]) if len(ends) else 0, BLOCK):
            candidate = np.arange(low, min(low + BLOCK, int(ends[-1])))
            of = np.searchsorted(ends, candidate, "right")
            entry = first[found[of]] + candidate - (ends[of] - counts[found[of]])
            self._verify(data, offsets, best, text[of], place[of] - within[entry], words[entry])

    def _verify(self, data: np.ndarray, offsets: np.ndarray, best: np.ndarray, text: np.ndarray, start: np.ndarray, word: np.ndarray) -> None:
        open_ = (self.rank[word] < best[text]) & (start >= offsets[text]) & (start + self.size[word] <= offsets[text + 1])
        text, start, word = text[open_], start[open_], word[open_]
        step = 0
        while len(word):
            over = self.size[word] == step
            if over.any():
                np.minimum.at(best, text[over], self.rank[word[over]])
            going = ~over
            text, start, word = text[going], start[going], word[going]
            same = data[start + step] == self.data[self.start[word] + step]
            text, start, word = text[same], start[same], word[same]
            step += 1


def named(text: Column, keywords: list[tuple[str, str]]) -> Column:
    """Category of the first of the (category, keyword) pairs whose keyword occurs in `text`, else null.

    For short lists that are part of the program; `first_category` is for tables.
    """
    index = KeywordIndex([word for _, word in keywords], list(range(len(keywords))))
    names = pa.array([*(name for name, _ in keywords), None], pa.string())

    @F.arrow_udf("string")
    def find(texts: pa.Array) -> pa.Array:
        return names.take(pa.array(index.first(texts)))

    return find(text)


@F.arrow_udf("array<bigint>")
def _distinct_grams(texts: pa.Array, sizes: pa.Array) -> pa.Array:
    """Distinct grams of every text: of four bytes, of the text's size if it is a shorter keyword, or of all sizes."""
    data, offsets = _bytes(texts)
    found = []
    for low, high, wanted in zip(offsets[:-1], offsets[1:], sizes.to_pylist(), strict=True):
        part = data[low:high]
        grams = [_grams(part, size) for size in ([wanted] if wanted else range(1, GRAM + 1))]
        found.append(np.unique(np.concatenate(grams)).astype(np.int64))
    ends = np.cumsum([0, *map(len, found)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*found, np.zeros(0, np.int64)])))


def _by_join(rows: DataFrame, text: Column, table: DataFrame) -> DataFrame:
    """`rows` with `_first`, the first priority and category, by joins on grams."""
    kept = materialised(rows.withColumn("_text", text).withColumn("_row", F.monotonically_increasing_id()))
    words = table.groupBy("keyword").agg(F.min(F.struct("priority", "category")).alias("_first"))
    everywhere = words.filter("keyword = ''").select(F.col("_first").alias("_always"))
    size = F.least(F.octet_length("keyword"), F.lit(GRAM))
    grams = words.filter("keyword <> ''").withColumn("_gram", F.explode(_distinct_grams("keyword", size)))
    users = grams.groupBy("_gram").agg(F.count("*").alias("_users"))
    rarest = F.min_by("_gram", F.struct("_users", "_gram")).alias("_gram")
    anchors = grams.join(users, "_gram").groupBy("keyword").agg(rarest, F.first("_first").alias("_first"))
    texts = kept.filter("_text IS NOT NULL").select("_row", "_text")
    held = texts.select("_row", F.explode(_distinct_grams("_text", F.lit(0))).alias("_gram"))
    candidates = held.join(anchors, "_gram").select("_row", "keyword", "_first")
    occurs = (texts["_row"] == candidates["_row"]) & F.contains(texts["_text"], candidates["keyword"])
    found = candidates.join(texts.hint("merge"), occurs).groupBy(candidates["_row"]).agg(F.min("_first").alias("_first"))
    both = kept.join(found, "_row", "left").join(F.broadcast(everywhere), F.col("_text").isNotNull(), "left")
    return both.withColumn("_first", F.least("_first", "_always")).drop("_row", "_text", "_always")


def first_category(rows: DataFrame, text: Column, keywords: DataFrame, name: str = "category", other: str | None = None, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """`rows` with the category of the first keyword that occurs in `text`, in order of priority, then of category.

    `keywords` has `priority`, `category` and `keyword`; rows with a null among them do not count. Keywords are
    substrings and are compared as they are, so both sides must be lower-cased alike where case does not matter. The empty keyword
    occurs in every text. A null text, and one without a keyword, gets `other`. Repeated rows stay.

    Up to `sent_bytes` the table is sent to all executors and `rows` are neither shuffled nor stored; beyond it `rows` are
    stored once, and only their distinct grams and the candidates that these give are shuffled.
    """
    spark = rows.sparkSession
    table = keywords.select(F.col("priority").cast("long"), F.col("category").cast("string"), F.col("keyword").cast("string")).na.drop()
    table = table.distinct()
    # a keyword, its name and rank, and the arrays of the index: about 40 bytes beside the text
    size = table.agg(F.sum(F.octet_length("keyword") + F.octet_length("category") + 40).alias("n")).first()["n"] or 0
    if size > sent_bytes:
        found = _by_join(rows, text, table).withColumn(name, F.coalesce("_first.category", F.lit(other)))
        return found.drop("_first")
    held = sorted((r.priority, r.category.encode(), r.keyword) for r in table.collect())
    order = {pair: at for at, pair in enumerate(dict.fromkeys((p, c) for p, c, _ in held))}
    index = KeywordIndex([word for _, _, word in held], [order[p, c] for p, c, _ in held])
    names = pa.array([*(c.decode() for _, c in order), other], pa.string())
    sent = spark.sparkContext.broadcast((index, names))

    @F.arrow_udf("string")
    def find(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index, names = sent.value
        for texts in parts:
            yield names.take(pa.array(index.first(texts)))

    return rows.withColumn(name, find(text))
