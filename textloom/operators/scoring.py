"""Scoring of a corpus with smoothed bigram counts, next-word tables and vector similarity."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain, pairwise
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions.vectors import cosine
from textloom.operators.reports import capped_perplexity
from textloom.operators.select import token_ids
from textloom.session import materialised, release_shuffles

HOT_SHARE = 1e-4
#: Words of one block of documents; a block's words and bigrams are in memory at a time.
BLOCK_WORDS = 1_000_000
#: Words of blocks that are numbered together, and bigrams of blocks that are added up together, on average.
BUCKET_WORDS, BUCKET_BIGRAMS = 1 << 20, 1 << 20


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def _coded_words(lists: list[pa.Array]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Number of words of each document of a block, the words' numbers in order, and the distinct words."""
    sizes = np.concatenate([x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) for x in lists])
    coded = pa.chunked_array([x.flatten() for x in lists]).dictionary_encode().combine_chunks()
    if isinstance(coded, pa.ChunkedArray):
        coded = pa.concat_arrays(coded.chunks)
    return sizes, coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _bigrams(sizes: np.ndarray, codes: np.ndarray, known: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A block's distinct bigrams: first words, second words and counts, and the bigrams' numbers in the order of the text."""
    followed = np.ones(len(codes), bool)
    followed[np.cumsum(sizes)[sizes > 0] - 1] = False
    at = np.flatnonzero(followed)
    pairs, numbers, counts = np.unique(codes[at] * known + codes[np.minimum(at + 1, len(codes) - 1)], return_inverse=True, return_counts=True)
    return pairs // max(known, 1), pairs % max(known, 1), counts, numbers


def _count_block(block: int, keys: list[pa.Array], lists: list[pa.Array]) -> Iterator[pa.RecordBatch]:
    """One block's distinct bigrams with their counts."""
    sizes, codes, known = _coded_words(lists)
    first, second, counts, _ = _bigrams(sizes, codes, len(known))
    columns = [known.take(pa.array(first)), known.take(pa.array(second)), pa.array(counts.astype(np.int64))]
    yield pa.RecordBatch.from_arrays(columns, names=["first", "second", "n"])


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers, not negative, as compressed planes of their bytes; planes without a number above zero are left out."""
    planes = np.ascontiguousarray(np.asarray(numbers).astype("<i8").view(np.uint8).reshape(-1, 8).T)
    width = int(np.flatnonzero(planes.any(1)).max(initial=-1)) + 1
    parts = [pa.compress(plane.tobytes(), "zstd", asbytes=True) for plane in planes[:width]]
    return np.array([len(numbers), width, *map(len, parts)], "<i8").tobytes() + b"".join(parts)


def _unpack(packed: bytes) -> np.ndarray:
    n, width = np.frombuffer(packed, "<i8", 2).tolist()
    planes, at = np.zeros((8, n), np.uint8), 8 * (2 + width)
    for plane, size in enumerate(np.frombuffer(packed, "<i8", width, 16).tolist()):
        planes[plane] = np.frombuffer(pa.decompress(packed[at : at + size], n, "zstd", asbytes=True), np.uint8)
        at += size
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def _pack_words(known: pa.Array) -> tuple[bytes, bytes]:
    """Words as the packed numbers of their bytes and their bytes."""
    _, bounds, data = known.buffers()
    ends = np.frombuffer(bounds, np.int32)[known.offset : known.offset + len(known) + 1]
    whole = bytes(memoryview(data)[ends[0] : ends[-1]]) if data and len(known) else b""
    return _pack(np.diff(ends)), pa.compress(whole, "zstd", asbytes=True)


def _unpack_words(lengths: bytes, data: bytes) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(_unpack(lengths))])
    whole = pa.decompress(data, int(ends[-1]), "zstd") if ends[-1] else pa.py_buffer(b"")
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int32)), whole)


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """Numbers spread over 64 bits, to deal them out evenly; equal numbers stay equal."""
    x = numbers.astype(np.uint64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _places(known: pa.Array) -> np.ndarray:
    """A 64-bit place of each word, by its bytes. It only deals words out; words with equal places stay apart."""
    _, bounds, data = known.buffers()
    ends = np.frombuffer(bounds, np.int32)[known.offset : known.offset + len(known) + 1].astype(np.int64)
    if not len(known):
        return np.zeros(0, np.uint64)
    whole, sizes = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], np.diff(ends)
    at = np.arange(len(whole)) - np.repeat(ends[:-1] - ends[0], sizes)
    with np.errstate(over="ignore"):
        terms = (whole.astype(np.uint64) + np.uint64(1)) * np.power(np.uint64(0x9E3779B97F4A7C15), at.astype(np.uint64))
    return _mixed(np.add.reduceat(terms, ends[:-1] - ends[0]))


def _buckets(places: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets that cut the range of places, so words in the order of their places are in the order of their buckets."""
    return ((places >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _pack_block(block: int, keys: list[pa.Array], lists: list[pa.Array]) -> Iterator[pa.RecordBatch]:
    """One block's documents of two words or more as one row: distinct words in the order of their places, keys and numbers of
    words of the documents, and the words' numbers in the order of the text."""
    sizes, codes, known = _coded_words(lists)
    long = sizes > 1
    if not long.any():
        return
    codes = codes[np.repeat(long, sizes)]
    at = np.unique(codes)
    words = known.take(pa.array(at)).cast(pa.string())
    order = np.argsort(_places(words), kind="stable")
    number = np.zeros(len(known), np.int64)
    number[at[order]] = np.arange(len(at))
    lengths, data = _pack_words(words.take(pa.array(order)))
    of = pa.concat_arrays(keys).filter(pa.array(long))
    columns = {
        "_block": pa.array([block]), "_known": pa.array([len(at)]), "_held": pa.array([len(codes)]), "_lengths": [lengths], "_words": [data],
        "_keys": pa.ListArray.from_arrays(pa.array([0, len(of)], pa.int32()), of), "_sizes": [_pack(sizes[long])], "_codes": [_pack(number[codes])],
    }
    yield pa.RecordBatch.from_pydict({c: pa.array(x, pa.binary()) if isinstance(x, list) else x for c, x in columns.items()})


def _packed_blocks(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Blocks of documents, a row each (see `_pack_block`), as a stored table; every text is cut into words once."""
    tokens = texts.select(words(F.col(text)).alias("_w"), F.col(key).alias("_key"))
    kind = texts.schema[key].dataType.simpleString()
    schema = f"_block long, _known long, _held long, _lengths binary, _words binary, _keys array<{kind}>, _sizes binary, _codes binary"
    return materialised(tokens.mapInArrow(_by_blocks(_pack_block), schema), "packed-blocks")


def _uses(sizes: np.ndarray, codes: np.ndarray, known: int) -> np.ndarray:
    """How often each word of a block is the first of a bigram."""
    followed = np.ones(len(codes), bool)
    followed[np.cumsum(sizes) - 1] = False
    return np.bincount(codes[followed], minlength=known)


def _spell_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ints = pa.list_(pa.int32())
    for batch in batches:
        for i, row in enumerate(batch.to_pylist()):
            sizes, codes, known = _unpack(row["_sizes"]), _unpack(row["_codes"]), row["_known"]
            first, second, counts, numbers = _bigrams(sizes, codes, known)
            keys = batch.column("_keys").slice(i, 1).flatten()

            def rows(n: int, block: int = row["_block"], kind: pa.DataType = keys.type, **columns: pa.Array) -> pa.RecordBatch:
                kinds = {"_at": pa.int32(), "token": pa.string(), "uses": pa.int64(), "_first": ints, "_second": ints, "_n": ints, "_key": kind, "_numbers": ints}
                made = {"_block": pa.array(np.full(n, block))} | {c: columns[c] if c in columns else pa.nulls(n, t) for c, t in kinds.items()}
                return pa.RecordBatch.from_arrays(list(made.values()), names=list(made))

            at, words = pa.array(np.arange(known, dtype=np.int32)), _unpack_words(row["_lengths"], row["_words"])
            yield rows(known, _at=at, token=words, uses=pa.array(_uses(sizes, codes, known)))
            yield rows(1, **{c: pa.array([x.astype(np.int32)], ints) for c, x in (("_first", first), ("_second", second), ("_n", counts))})
            bounds = pa.array(np.concatenate([[0], np.cumsum(sizes - 1)]).astype(np.int32))
            yield rows(len(sizes), _key=keys, _numbers=pa.ListArray.from_arrays(bounds, pa.array(numbers.astype(np.int32))))


def _numbered_blocks(texts: DataFrame, key: str, text: str) -> DataFrame:
    """What the packed blocks hold, spelled out in three kinds of rows: words (`token`) with their uses as a first word, one row
    of a block's distinct bigrams (`_first`, `_second`, `_n`), and documents as numbers of bigrams (`_numbers`)."""
    schema = (
        "_block long, _at int, token string, uses long, _first array<int>, _second array<int>, _n array<int>, "
        f"_key {texts.schema[key].dataType.simpleString()}, _numbers array<int>"
    )
    return _packed_blocks(texts, key, text).mapInArrow(_spell_out, schema)


def _block_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most about `BLOCK_WORDS` words, whatever the number of its rows."""
    sizes = batch.column("_w").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(sizes) - sizes) // BLOCK_WORDS
    starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for start, end in pairwise(starts):
        yield batch.slice(start, end - start)


def _block_bigrams(texts: DataFrame, text: str) -> DataFrame:
    """Distinct bigrams of blocks of documents with their count `n`; every text is cut into words once."""
    tokens = texts.select(words(F.col(text)).alias("_w"))
    return tokens.mapInArrow(_by_blocks(_count_block), "first string, second string, n long")


def _deal_words(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A block's words, with their uses, in a row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            known = _unpack_words(row["_lengths"], row["_words"])
            uses = _uses(_unpack(row["_sizes"]), _unpack(row["_codes"]), len(known))
            bucket = _buckets(_places(known), buckets)
            bounds = np.searchsorted(bucket, np.arange(buckets + 1))
            found = [(b, *_pack_words(known[start:stop]), _pack(uses[start:stop])) for b, (start, stop) in enumerate(pairwise(bounds.tolist())) if stop > start]
            if found:
                columns = [pa.array(x, t) for x, t in zip(zip(*found, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), row["_block"])), *columns], names=["_block", "_bucket", "_lengths", "_words", "_uses"])

    return run


def _number_words(buckets: int) -> Callable[[pa.Table], pa.Table]:
    """Numbers and uses in the corpus of the words of a bucket, returned to their blocks. Frequent words have small numbers."""

    def run(pieces: pa.Table) -> pa.Table:
        lists = [_unpack_words(x, y) for x, y in zip(pieces.column("_lengths").to_pylist(), pieces.column("_words").to_pylist(), strict=True)]
        sizes, codes, known = _coded_words([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists])
        uses = np.concatenate([_unpack(x) for x in pieces.column("_uses").to_pylist()])
        total = np.zeros(len(known), np.int64)
        np.add.at(total, codes, uses)
        ids = np.empty(len(known), np.int64)
        ids[np.argsort(-total, kind="stable")] = np.arange(len(known)) * buckets + pieces.column("_bucket")[0].as_py()
        parts = np.split(codes, np.cumsum(sizes)[:-1])
        return pa.table({
            "_block": pieces.column("_block"), "_bucket": pieces.column("_bucket"), "_ids": pa.array([_pack(ids[x]) for x in parts], pa.binary()),
            "_uses": pa.array([_pack(total[x]) for x in parts], pa.binary()), "_distinct": pa.array([len(known)] + [0] * (len(parts) - 1), pa.int64()),
        })

    return run


def _whole(pieces: pa.Table, column: str) -> np.ndarray:
    """The numbers of all pieces of a block, in the order of their buckets."""
    order = np.argsort(pieces.column("_bucket").to_numpy())
    packed = pieces.column(column).to_pylist()
    return np.concatenate([np.zeros(0, np.int64), *[_unpack(packed[i]) for i in order]])


def _dealt_bigrams(first: np.ndarray, second: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of bigrams of words' numbers by bucket, first and second word, and the bounds of the buckets in it."""
    bucket = (_mixed(_mixed(first) + second.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((second, first, bucket))
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _deal_bigrams(buckets: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A block's distinct bigrams as numbers of words in the corpus, with their counts, in a row per bucket."""

    def run(blocks: pa.Table, words: pa.Table) -> pa.Table:
        ids, found = _whole(words, "_ids"), []
        for row in blocks.to_pylist():
            first, second, n, _ = _bigrams(_unpack(row["_sizes"]), _unpack(row["_codes"]), len(ids))
            order, bounds = _dealt_bigrams(ids[first], ids[second], buckets)
            first, second, n = ids[first][order], ids[second][order], n[order]
            for b, (start, stop) in enumerate(pairwise(bounds.tolist())):
                if stop > start:  # first words rise in a bucket
                    steps = np.diff(first[start:stop], prepend=0)
                    found.append((row["_of"], b, _pack(steps), _pack(second[start:stop]), _pack(n[start:stop])))
        return _rows(found, _block=pa.int64(), _bucket=pa.int32(), _first=pa.binary(), _second=pa.binary(), _n=pa.binary())

    return run


def _add_bigrams(pieces: pa.Table) -> pa.Table:
    """Counts in the corpus of the bigrams of a bucket, returned to their blocks."""
    first, second, n = ([_unpack(x) for x in pieces.column(c).to_pylist()] for c in ("_first", "_second", "_n"))
    sizes = [len(x) for x in n]
    first, second, n = np.concatenate([np.cumsum(x) for x in first]), np.concatenate(second), np.concatenate(n)
    order = np.lexsort((second, first))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)
    totals = np.empty(len(order), np.int64)
    totals[order] = np.add.reduceat(n[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    parts = np.split(totals, np.cumsum(sizes)[:-1])
    return pa.table({"_block": pieces.column("_block"), "_bucket": pieces.column("_bucket"), "_totals": pa.array([_pack(x) for x in parts], pa.binary())})


def _rows(found: list[tuple], **kinds: pa.DataType) -> pa.Table:
    columns = zip(*found, strict=True) if found else [[]] * len(kinds)
    return pa.table({c: pa.array(x, t) for (c, t), x in zip(kinds.items(), columns, strict=True)})


def _by_blocks(count: Callable[[int, list[pa.Array], list[pa.Array]], Iterator[pa.RecordBatch]]) -> Callable:
    """Apply `count` to blocks of about `BLOCK_WORDS` words: number of the block, keys (`_key`, if any) and words (`_w`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held, keys, lists = TaskContext.get().partitionId(), 0, 0, [], []
        for batch in chain.from_iterable(map(_block_parts, batches)):
            lists.append(batch.column("_w"))
            if "_key" in batch.schema.names:
                keys.append(batch.column("_key"))
            held += len(batch.column("_w").flatten())
            if held >= BLOCK_WORDS:
                yield from count(part << 32 | made, keys, lists)
                made, held, keys, lists = made + 1, 0, [], []
        if lists:
            yield from count(part << 32 | made, keys, lists)

    return run


def _count_block_words(block: int, keys: list[pa.Array], lists: list[pa.Array]) -> Iterator[pa.RecordBatch]:
    """One block's rows: its distinct words with their counts, then its documents as numbers of distinct words with counts."""
    sizes, codes, known = _coded_words(lists)
    names, n = ["_block", "_at", "token", "n", "_key", "_numbers", "_counts"], len(known)
    lists_type = pa.list_(pa.int32())
    yield pa.RecordBatch.from_arrays([
        pa.array(np.full(n, block)), pa.array(np.arange(n, dtype=np.int32)), known, pa.array(np.bincount(codes, minlength=n).astype(np.int64)),
        pa.nulls(n, keys[0].type), pa.nulls(n, lists_type), pa.nulls(n, lists_type),
    ], names=names)
    documents = np.repeat(np.arange(len(sizes)), sizes)
    pairs, counts = np.unique(documents * n + codes, return_counts=True)
    used = sizes > 0
    ends = np.cumsum(np.bincount(pairs // max(n, 1), minlength=len(sizes))[used])
    bounds, m = pa.array(np.concatenate([[0], ends]).astype(np.int32)), int(used.sum())
    yield pa.RecordBatch.from_arrays([
        pa.array(np.full(m, block)), pa.nulls(m, pa.int32()), pa.nulls(m, known.type), pa.nulls(m, pa.int64()),
        pa.concat_arrays(keys).filter(pa.array(used)), pa.ListArray.from_arrays(bounds, pa.array((pairs % max(n, 1)).astype(np.int32))),
        pa.ListArray.from_arrays(bounds, pa.array(counts.astype(np.int32))),
    ], names=names)


def block_words(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Words of blocks of documents, a stored table. Rows with `token` are the distinct words of a block with their count
    `n`; the others are its documents, which hold words as numbers."""
    tokens = texts.select(words(F.col(text)).alias("_w"), F.col(key).alias("_key"))
    kind = texts.schema[key].dataType.simpleString()
    schema = f"_block long, _at int, token string, n long, _key {kind}, _numbers array<int>, _counts array<int>"
    return materialised(tokens.mapInArrow(_by_blocks(_count_block_words), schema), "block-words")


def _tokens_of_documents(documents: pa.Table, known: pa.Table) -> pa.Table:
    """Distinct words of one block's documents with their ids and counts; a word with several ids has as many rows."""
    numbers, counts = (_flat(documents.column(c)) for c in ("_numbers", "_counts"))
    order = np.argsort(known.column("_at").to_numpy(), kind="stable")
    at = known.column("_at").to_numpy()[order]
    first, last = np.searchsorted(at, numbers, "left"), np.searchsorted(at, numbers, "right")
    times = last - first
    row = np.repeat(np.arange(len(numbers)), times)
    place = pa.array(order[first[row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)])
    sizes = pc.list_value_length(documents.column("_numbers")).to_numpy()
    document = np.repeat(np.arange(documents.num_rows), sizes)[row]
    return pa.table({
        "_key": documents.column("_key").take(pa.array(document)), "token": known.column("token").take(place),
        "id": known.column("id").take(place), "n": pa.array(counts[row].astype(np.int64)),
    })


def _flat(lists: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in lists.chunks] or [np.zeros(0, np.int32)])


def document_token_ids(rows: DataFrame, vocabulary: DataFrame, key: str) -> DataFrame:
    """Per document its distinct words with `id` and count `n`; `rows` are `block_words`.

    Only a block's distinct words meet the vocabulary; ids return to the block. Documents with equal keys count as one.
    """
    known = token_ids(rows.filter("token IS NOT NULL").select("_block", "_at", "token"), vocabulary)
    documents = rows.filter("token IS NULL").select(F.col("_block").alias("_of"), "_key", "_numbers", "_counts")
    kind = rows.schema["_key"].dataType.simpleString()
    found = (
        documents.groupBy("_of")
        .cogroup(known.groupBy("_block"))
        .applyInArrow(_tokens_of_documents, f"_key {kind}, token string, id int, n long")
        .withColumnRenamed("_key", key)
    )
    often = documents.groupBy(F.col("_key").alias("_often")).agg(F.count("*").alias("_n")).filter("_n > 1")
    often = materialised(often.select("_often"), "repeated-keys")
    if often.isEmpty():
        return found
    found = materialised(found, "document-words")
    same = found[key].eqNullSafe(often["_often"])
    summed = found.join(often, same, "left_semi").groupBy(key, "token", "id").agg(F.sum("n").alias("n"))
    return found.join(often, same, "left_anti").unionByName(summed)


def _cost_of_documents(buckets: int, distinct: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Sum of the costs of each document's bigrams, and their number, in one block. Its bigrams are found in the order in which
    `_deal_bigrams` sent them, so their totals in the corpus need no names."""

    def run(blocks: pa.Table, pieces: pa.Table) -> pa.Table:
        words, bigrams = pieces.filter(pc.is_valid(pieces.column("_ids"))), pieces.filter(pc.is_valid(pieces.column("_totals")))
        ids, uses, totals = _whole(words, "_ids"), _whole(words, "_uses"), _whole(bigrams, "_totals")
        keys, sums, counts = [blocks.column("_keys").combine_chunks().flatten()], [np.zeros(0)], [np.zeros(0, np.int64)]
        for row in blocks.drop_columns("_keys").to_pylist():
            sizes = _unpack(row["_sizes"])
            first, second, _, numbers = _bigrams(sizes, _unpack(row["_codes"]), len(ids))
            order, _ = _dealt_bigrams(ids[first], ids[second], buckets)
            cost = np.empty(len(order))
            cost[order] = -np.log((totals + 1) / (uses[first[order]] + distinct))
            sums.append(np.add.reduceat(cost[numbers], np.cumsum(sizes - 1) - (sizes - 1)))
            counts.append(sizes - 1)
        return pa.table({"_key": pa.concat_arrays(keys), "_cost": np.concatenate(sums), "_n": np.concatenate(counts)})

    return run


def join_uneven(rows: DataFrame, counts: DataFrame, keys: list[str], uses: str, share: float = HOT_SHARE) -> DataFrame:
    """Join `rows` with one count row per key when some keys are in a large part of `rows`.

    `uses` is the column of `counts` with the number of rows a key meets. Keys that meet at least `share` of
    all rows number at most 1/share, so they are safe to broadcast and their rows stay where they are. The
    others are small by the same measure, and are joined by shuffle; the hint keeps the planner from
    broadcasting `rows`, whose size it underestimates after an explode. `counts` is read several times and
    should be a stored table.
    """
    total = counts.agg(F.sum(uses)).scalar()
    limit = total * share
    hot = F.broadcast(counts.filter(F.col(uses) >= limit))
    cold = counts.filter(F.col(uses) < limit).hint("merge")


    def meet(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        """Join on equal keys, where two nulls are equal; the keys of `left` stay."""
        named = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
        same = reduce(and_, [left[k].eqNullSafe(named[f"_key_{k}"]) for k in keys])
        return left.join(named, same, how).drop(*[f"_key_{k}" for k in keys])

    rest = meet(rows, hot.select(*keys), "left_anti")
    return meet(rows, hot, "inner").unionByName(meet(rest, cold, "inner"))


def bigram_scores(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Mean negative log-likelihood and capped perplexity of each document under the corpus' own bigrams.

    Add-one smoothing: p(b | a) = (count(ab) + 1) / (count(a) + number of distinct words). Bigrams are counted
    per block of documents. A block's distinct words are numbered for the whole corpus, and its distinct bigrams meet
    those of other blocks as pairs of numbers. Both travel packed, one row per block and bucket, and what returns is in the
    order of what was sent: no word or bigram has a row of its own. Documents of fewer than two words have no row; documents
    with equal keys, null included, count as one.
    """
    spark = texts.sparkSession
    blocks = _packed_blocks(texts, key, text)
    known, held = blocks.agg(F.sum("_known"), F.sum("_held")).first()
    of_words, of_bigrams = (max(1, -(-(n or 0) // size)) for n, size in ((known, BUCKET_WORDS), (held, BUCKET_BIGRAMS)))
    pieces = blocks.select("_block", "_lengths", "_words", "_sizes", "_codes").mapInArrow(
        _deal_words(of_words), "_block long, _bucket int, _lengths binary, _words binary, _uses binary"
    )
    numbered = pieces.groupBy("_bucket").applyInArrow(_number_words(of_words), "_block long, _bucket int, _ids binary, _uses binary, _distinct long")
    numbered = materialised(numbered, "numbered-words")
    release_shuffles(spark)
    distinct = numbered.agg(F.sum("_distinct")).first()[0] or 0
    texts_of = blocks.select(F.col("_block").alias("_of"), "_keys", "_sizes", "_codes").groupBy("_of")
    pairs = (
        blocks.select(F.col("_block").alias("_of"), "_sizes", "_codes").groupBy("_of")
        .cogroup(numbered.select("_block", "_bucket", "_ids").groupBy("_block"))
        .applyInArrow(_deal_bigrams(of_bigrams), "_block long, _bucket int, _first binary, _second binary, _n binary")
    )
    added = materialised(pairs.groupBy("_bucket").applyInArrow(_add_bigrams, "_block long, _bucket int, _totals binary"), "bigram-totals")
    release_shuffles(spark)
    returned = numbered.drop("_distinct").unionByName(added, allowMissingColumns=True)
    scored = texts_of.cogroup(returned.groupBy("_block")).applyInArrow(
        _cost_of_documents(of_bigrams, distinct), f"_key {texts.schema[key].dataType.simpleString()}, _cost double, _n long"
    )
    return (
        scored.groupBy(F.col("_key").alias(key))
        .agg((F.sum("_cost") / F.sum("_n")).alias("nll"), F.sum("_n").alias("bigrams"))
        .withColumn("perplexity", capped_perplexity(F.col("nll")))
    )


def _score_cutoffs(df: DataFrame, group: list[str], score: str, k: int) -> DataFrame:
    """Per group the lowest score kept, the highest, the softmax denominator and the number of rows.

    Rows with equal scores are counted first. Of the distinct scores only the best `k` can be kept; that limit
    on a row number is applied before the shuffle, so a task sends at most `k` rows of a group.
    """
    equal = df.groupBy(*group, score).agg(F.count("*").alias("_c"))
    ordered = W.partitionBy(*group).orderBy(F.col(score).desc())
    best = equal.withColumn("_at", F.row_number().over(ordered)).filter(F.col("_at") <= k)
    before = F.coalesce(F.sum("_c").over(ordered.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    kept = best.withColumn("_before", before).withColumn("_top", F.max(score).over(W.partitionBy(*group))).filter(F.col("_before") < k)
    cutoffs = kept.groupBy(*group).agg(
        F.min(score).alias("_cutoff"), F.max("_top").alias("_top"), F.sum(F.col("_c") * F.exp(F.col(score) - F.col("_top"))).alias("_mass")
    )
    sizes = df.groupBy(*[F.col(g).alias(f"_of_{g}") for g in group]).agg(F.count("*").alias("_rows"))
    same = reduce(and_, [cutoffs[g].eqNullSafe(sizes[f"_of_{g}"]) for g in group])
    return cutoffs.join(sizes, same).drop(*[f"_of_{g}" for g in group])


def top_k_with_ties(df: DataFrame, group: list[str], score: str, k: int) -> DataFrame:
    """Rows whose score is not below the k-th best of their group; all rows equal to the k-th stay.

    The cut is one score per group, taken from counts of equal scores, so neither a large group nor a long
    run of ties is ever gathered.
    """
    cutoffs = materialised(_score_cutoffs(df, group, score, k), "cutoffs")
    kept = join_uneven(df, cutoffs, group, "_rows")
    return kept.filter(F.col(score) >= F.col("_cutoff")).select(*df.columns)


def next_word_table(texts: DataFrame, text: str = "text", k: int = 40, temperature: float = 0.8) -> DataFrame:
    """For each word its most frequent followers with their softmax probability at a temperature."""
    counts = (
        _block_bigrams(texts, text)
        .groupBy(F.col("first").alias("context"), F.col("second").alias("candidate"))
        .agg(F.sum("n").alias("n"))
    )
    logits = materialised(counts.withColumn("logit", F.ln("n") / F.lit(max(temperature, 1e-5))), "logits")
    cutoffs = materialised(_score_cutoffs(logits, ["context"], "logit", k), "cutoffs")
    kept = join_uneven(logits, cutoffs, ["context"], "_rows")
    return kept.filter(F.col("logit") >= F.col("_cutoff")).select(
        "context",
        "candidate",
        "n",
        (F.exp(F.col("logit") - F.col("_top")) / F.col("_mass")).alias("probability"),
    )


def pair_similarity(vectors: DataFrame, key: str, vector: str, pairs: DataFrame) -> DataFrame:
    """Cosine similarity of the given pairs `(left_id, right_id)`, found by two equi-joins."""
    left = vectors.select(F.col(key).alias("left_id"), F.col(vector).alias("_l"))
    right = vectors.select(F.col(key).alias("right_id"), F.col(vector).alias("_r"))
    return (
        pairs.join(left, "left_id")
        .join(right, "right_id")
        .select("left_id", "right_id", cosine(F.col("_l"), F.col("_r")).alias("similarity"))
    )
