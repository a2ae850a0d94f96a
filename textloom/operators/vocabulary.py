"""Byte-level sub-word vocabulary: pre-tokens, training, encoding, decoding.

A word is held as a string with one character per symbol (`symbol`). Merging a pair is then Spark's own
`replace`, which works left to right without overlap, just as a merge does.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce
from heapq import heapify, heappop, heappush
from itertools import pairwise
from operator import itemgetter, or_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.arrays import SPECIAL_TOKENS, UNK
from textloom.functions.text import nfkc, strip
from textloom.session import file_system, materialised, path_exists

VOCABULARY_SIZE = 32_000
MIN_FREQUENCY = 10
#: Symbols of the words that a task holds at a time in training, whatever the size of the corpus.
HELD_SYMBOLS = 4_000_000
#: Pairs, and links between them, that the driver sees in a round of training.
LIVE_PAIRS = 100_000
#: Pairs of the first band of training.
FIRST_PAIRS = 1_024
#: Different pieces of words that a task adds up before it passes them on.
HELD_PIECES = 500_000
#: Tasks that bring the links of all words together.
FOREST_TASKS = 8

# Fixed value: the word split of byte-level vocabularies (letters, digits, contractions, other, blanks). The
# alternatives that begin alike keep their order; letters come first because most words are.
WORD_PATTERN = (
    r"(?U) ?\p{L}++| ?\p{N}++|'(?:s|t|re|ve|m|ll|d)| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"
)

# Characters set around a reserved token found in raw text; noncharacters never occur in real text.
_OPEN, _CLOSE = "\ufdd0", "\ufdd1"
_RESERVED = "|".join(SPECIAL_TOKENS)


def byte_alphabet() -> list[str]:
    """Printable stand-in of each byte value: itself if visible in Latin-1, else the next free from U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(0x100 + hidden.index(b)) for b in range(256)]


_BYTES = "".join(map(chr, range(256)))
_STANDINS = "".join(byte_alphabet())


def as_bytes_text(text: Column) -> Column:
    """One stand-in character per UTF-8 byte."""
    latin = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    return F.translate(latin, _BYTES, _STANDINS)


def from_bytes_text(standins: Column) -> Column:
    """Inverse of `as_bytes_text`; bytes that are not UTF-8 become U+FFFD."""
    # `translate` reads a NUL replacement as "delete", so that byte is put back on its own
    latin = F.replace(F.translate(standins, _STANDINS[1:], _BYTES[1:]), F.lit(_STANDINS[0]), F.lit("\0"))
    raw = F.encode(latin, "ISO-8859-1")
    return F.make_valid_utf8(raw.cast("string"))


def _words(piece: Column) -> Column:
    spaced = F.when(piece.startswith(" "), piece).otherwise(F.concat(F.lit(" "), piece))
    return F.regexp_extract_all(spaced, F.lit(WORD_PATTERN), F.lit(0))


def pretokens(text: Column, normalise: bool = True) -> Column:
    """Words of a text as the encoder sees them: NFKC, a space in front, then the word split.

    Reserved tokens written out in the text stay whole and separate the words around them.
    """
    reserved = reduce(or_, [text.contains(t) for t in SPECIAL_TOKENS])
    marked = F.when(reserved, F.regexp_replace(text, f"({_RESERVED})", f"{_OPEN}$1{_CLOSE}")).otherwise(text)
    whole = nfkc(marked) if normalise else marked
    pieces = F.filter(F.split(whole, f"(?={_OPEN})|(?<={_CLOSE})"), lambda p: p != "")
    split_up = F.transform(
        pieces,
        lambda p: F.when(p.startswith(_OPEN), F.array(F.translate(p, _OPEN + _CLOSE, ""))).otherwise(_words(p)),
    )
    return (
        F.when(reserved, F.flatten(split_up))
        .when(text == "", F.array().cast("array<string>"))
        .otherwise(_words(whole))
    )


def training_lines(texts: DataFrame, text: str = "text") -> DataFrame:
    """Lines of the corpus file: each fragment ends with a line break, each line keeps its own."""
    return texts.select(F.explode(F.split(text, "\n")).alias("line")).select(
        F.concat("line", F.lit("\n")).alias("line")
    )


def pretoken_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """Frequency of every word of the corpus, the only input of vocabulary training.

    The counts combine on the map side, so a very frequent word is one row per task.
    """
    words = training_lines(texts, text).select(F.explode(_words(nfkc(F.col("line")))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("freq"))


def symbol(token_id: int) -> str:
    """Character that stands for a token id inside a word under training (surrogates are stepped over)."""
    point = token_id + 0x100
    return chr(point if point < 0xD800 else point + 0x800)


def symbol_id(char: str) -> int:
    point = ord(char)
    return (point if point < 0xD800 else point - 0x800) - 0x100


def _pairs(words: DataFrame) -> DataFrame:
    """Every adjacent pair of symbols with its word and place."""
    places = F.sequence(F.lit(1), F.greatest(F.length("w") - 1, F.lit(1)))
    return (
        words.withColumn("at", F.explode(places))
        .withColumn("pair", F.substring("w", F.col("at"), F.lit(2)))
        .filter(F.length("pair") == 2)  # a single symbol has no pair
    )


def _pair_counts(words: DataFrame) -> DataFrame:
    return _pairs(words).groupBy("pair").agg(F.sum("freq").alias("n"))


class Neighbours:
    """What stands beside the best pairs: how often at most one symbol, and how often another best pair
    overlaps one."""

    def __init__(self, words: DataFrame, pairs: list[str]):
        left = F.when(F.col("at") > 1, F.substring("w", F.col("at") - 1, F.lit(1)))
        right = F.nullif(F.substring("w", F.col("at") + 2, F.lit(1)), F.lit(""))
        beside = (
            _pairs(words)
            .filter(F.col("pair").isin(pairs))
            .select("freq", "pair", F.posexplode(F.array(left, right)).alias("side", "next"))
            .filter("next IS NOT NULL")
            .groupBy("pair", "side", "next")
            .agg(F.sum("freq").alias("freq"))
        )
        first, second = F.substring("pair", 1, 1), F.substring("pair", 2, 1)
        other = F.when(F.col("side") == 0, F.concat("next", first)).otherwise(F.concat(second, "next"))
        overlap = F.when(other.isin(pairs), F.struct(other.alias("other"), "freq"))
        found = beside.groupBy("pair").agg(  # a row per pair, with at most two overlaps per other pair
            F.max("freq").alias("bound"), F.collect_list(overlap).alias("overlaps")
        )
        self.bound: dict[str, int] = {}
        self.overlap: dict[tuple[str, str], int] = {}
        for row in found.collect():
            self.bound[row.pair] = row.bound
            for o in row.overlaps:
                key = (row.pair, o.other)
                self.overlap[key] = max(self.overlap.get(key, 0), o.freq)


def _certain_merges(
    best: list[tuple[str, int]], beside: Neighbours, tokens: dict[str, int], names: list[str]
) -> list[str]:
    """Pairs that merging one at a time would certainly choose next, in this order.

    Merging a pair never raises the count of an existing pair. Going down the list by count, `rival` is the
    highest count that anything not on the list can have by now:

    * A pair newly created by a merge consists of the merged symbol and one neighbour. It is at most as
      frequent as that neighbour was beside the merged pair.
    * A pair that overlaps one already taken has lost at least the places they shared. It is put off to the
      next round with what can be left of it.

    A pair more frequent than every rival, which overlaps no pair taken, still has its full count and is
    next. A pair of equal symbols overlaps itself, and a pair whose text is a token already raises existing
    counts: such a pair is only taken alone.
    """
    taken: list[str] = []
    texts: set[str] = set()
    rival = 0
    for pair, count in best:
        if taken and rival >= count:
            break
        a, b = pair
        text = names[symbol_id(a)] + names[symbol_id(b)]
        if a == b or text in tokens or text in texts:
            return taken or [pair]
        shared = [beside.overlap.get((t, pair), 0) for t in taken if t[1] == a or t[0] == b]
        if shared:
            rival = max(rival, count - max(shared))
            continue
        taken.append(pair)
        texts.add(text)
        rival = max(rival, beside.bound.get(pair, 0))
    return taken


def _merged(words: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    w = F.col("w")
    for pair, whole in merges:
        w = F.replace(w, F.lit(pair), F.lit(whole))
    return words.select(w.alias("w"), "freq")


def _live_pairs(words: DataFrame, least: int) -> tuple[list[tuple[str, int, int]], bool]:
    """The most frequent pairs, at most `LIVE_PAIRS`, with their counts and the symbols of their words, in the order
    in which they would be merged; and whether these are all that occur `least` times. Counts are not cut in between."""
    counts = _pairs(words).groupBy("pair").agg(F.sum("freq").alias("n"), F.sum(F.length("w")).alias("load"))
    first = counts.filter(F.col("n") >= least).orderBy(F.col("n").desc(), "pair").limit(LIVE_PAIRS + 1).toPandas()
    rows = list(zip(first["pair"], first["n"].tolist(), first["load"].tolist(), strict=True))
    if len(rows) <= LIVE_PAIRS:
        return rows, True
    return [r for r in rows if r[1] > rows[-1][1]], False


class Joined:
    """Sets of numbers that links have joined."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[b] = a
        return a != b


def _forest(links: Iterable[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """Of links (a, b), a < b, the fewest that join the same numbers, whichever number the links are cut at."""
    joined = Joined(n)
    return [(a, b) for a, b in sorted(links, key=itemgetter(1)) if joined.join(a, b)]


def _shared_words(words: DataFrame, pairs: list[str]) -> list[tuple[int, int]]:
    """Links between pairs that words have in common, by their places in `pairs`: a forest of them.

    Every task sends a forest of at most one link per pair, and few tasks merge those, so what reaches the driver does
    not grow with the words.
    """
    place, n = {pair: i for i, pair in enumerate(pairs)}, len(pairs)

    def of_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        links: set[tuple[int, int]] = set()
        for frame in frames:
            for w in frame["w"]:
                found = sorted({place[p] for p in map("".join, pairwise(w)) if p in place})
                links.update(pairwise(found))  # the first pairs of a word are linked without the later ones
            if len(links) > 4 * n:
                links = set(_forest(links, n))
        yield pd.DataFrame(_forest(links, n), columns=["a", "b"], dtype="int32")

    def of_links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        links: set[tuple[int, int]] = set()
        for frame in frames:
            links = set(_forest(links.union(zip(frame["a"].tolist(), frame["b"].tolist(), strict=True)), n))
        yield pd.DataFrame(_forest(links, n), columns=["a", "b"], dtype="int32")

    found = words.select("w").mapInPandas(of_words, "a int, b int").repartition(FOREST_TASKS).mapInPandas(of_links, "a int, b int").toPandas()
    return list(zip(found["a"].tolist(), found["b"].tolist(), strict=True))


def _band(live: list[tuple[str, int, int]], links: list[tuple[int, int]], held_symbols: int) -> tuple[int, list[int]]:
    """How many of the live pairs, the first ones, fall into groups without a common word whose words have at most
    `held_symbols` symbols each, and the group of each of them."""
    joined, load, at = Joined(len(live)), [n for _, _, n in live], 0
    links = sorted(links, key=itemgetter(1))
    cut = len(live)
    for i in range(len(live)):
        while at < len(links) and links[at][1] == i:
            a, b = joined.root(links[at][0]), joined.root(i)
            if joined.join(a, b):
                load[a] += load[b]
            at += 1
        if load[joined.root(i)] > held_symbols:
            cut = next(j for j in range(i + 1) if live[j][1] == live[i][1])
            break
    groups = Joined(cut)
    for a, b in links:
        if b < cut:
            groups.join(a, b)
    return cut, [groups.root(i) for i in range(cut)]


def _merges_of_group(
    words: list[tuple[str, int]], floor: int, limit: int, names: list[str], tokens: dict[str, int], alone: bool
) -> list[tuple[int, int, int]]:
    """Merges one pair at a time while one makes up `floor` or more: count and the two ids of each.

    `words` are all words with a pair that frequent that is linked to theirs. A merge changes only words that hold
    its pair, and every pair it creates lies in them, so these words alone decide their merges down to `floor`. New
    tokens get the next ids here, in their order; the caller gives them their ids. Only a pair whose text is a token
    already raises counts in other words, too: it is the last merge unless these are all words (`alone`). Counts
    are kept by what a merge changes.
    """
    spelled, freq = [w for w, _ in words], [f for _, f in words]
    counts: dict[str, int] = {}
    places: dict[str, set[int]] = {}
    for i, (w, f) in enumerate(words):
        for pair in map("".join, pairwise(w)):
            counts[pair] = counts.get(pair, 0) + f
            places.setdefault(pair, set()).add(i)
    heap = [(-n, pair) for pair, n in counts.items() if n >= floor]
    heapify(heap)
    base, texts, own = len(names), [], {}
    out: list[tuple[int, int, int]] = []
    while heap and len(texts) < limit:
        n, pair = heappop(heap)
        now = counts[pair]
        if now != -n:  # it has changed since; a count that rose has an entry of its own
            if floor <= now < -n:
                heappush(heap, (-now, pair))
            continue
        a, b = pair
        ids = symbol_id(a), symbol_id(b)
        text = "".join(names[i] if i < base else texts[i - base] for i in ids)
        out.append((now, *ids))
        known = tokens.get(text, own.get(text))
        if known is None:
            known = own[text] = base + len(texts)
            texts.append(text)
        elif not alone:
            break
        new = symbol(known)
        change: dict[str, int] = {}
        for i in places.pop(pair):
            parts, f = spelled[i].split(pair), freq[i]
            if len(parts) == 1:
                continue
            spelled[i] = new.join(parts)
            change[pair] = change.get(pair, 0) - f * (len(parts) - 1)
            beside = []  # pairs at the edges of the merged places, before and after
            for k in range(1, len(parts)):
                if parts[k - 1]:
                    beside.append((parts[k - 1][-1] + a, parts[k - 1][-1] + new))
                elif k > 1:
                    beside.append((b + a, new + new))
                if parts[k]:
                    beside.append((b + parts[k][0], new + parts[k][0]))
            for old, created in beside:
                change[old] = change.get(old, 0) - f
                change[created] = change.get(created, 0) + f
                places.setdefault(created, set()).add(i)
        for other, d in change.items():
            counts[other] = counts.get(other, 0) + d
            if d > 0 and counts[other] >= floor:
                heappush(heap, (-counts[other], other))
    return out


class Vocabulary:
    """Token texts by id, ids by text, and the merges so far: what training has decided."""

    def __init__(self, names: list[str]):
        self.names, self.tokens = names, {t: i for i, t in enumerate(names)}
        self.merges: list[tuple[int, int, int, int]] = []

    def merge(self, left: int, right: int) -> tuple[int, bool]:
        """Id of the merged token, and whether its text was a token before."""
        text = self.names[left] + self.names[right]
        known = text in self.tokens
        if not known:
            self.tokens[text] = len(self.names)
            self.names.append(text)
        self.merges.append((len(self.merges), left, right, self.tokens[text]))
        return self.tokens[text], known


def _interleaved(groups: dict[int, list[tuple[int, int, int]]], found: Vocabulary, size: int, alone: bool) -> None:
    """The groups' merges in the order of one-by-one training: always the next merge of a group that is the most
    frequent, on ties the one with smaller ids. A group's order does not depend on the others, its new ids do."""
    base = len(found.names)
    own: dict[int, list[int]] = {g: [] for g in groups}
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(g: int, at: int) -> None:
        if at < len(groups[g]):
            n, *ids = groups[g][at]
            heappush(heap, (-n, *(i if i < base else own[g][i - base] for i in ids), g, at))

    for g in groups:
        offer(g, 0)
    while heap and len(found.names) < size:
        _, left, right, g, at = heappop(heap)
        merged, known = found.merge(left, right)
        if known and not alone:
            return  # counts elsewhere have risen
        if not known:
            own[g].append(merged)
        offer(g, at + 1)


def _merged_in_order(words: DataFrame, merges: list[tuple[int, int, int, int]]) -> DataFrame:
    """The words after the merges, each applied once, in their order."""
    ranks: dict[str, list[int]] = {}
    for rank, (_, left, right, _) in enumerate(merges):
        ranks.setdefault(symbol(left) + symbol(right), []).append(rank)
    whole = [symbol(new) for *_, new in merges]

    def merged(w: str) -> str:
        last = -1
        while True:
            later = [(r, p) for p in set(map("".join, pairwise(w))) for r in ranks.get(p, ()) if r > last]
            if not later:
                return w
            last, pair = min(later)
            w = w.replace(pair, whole[last])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"w": [merged(w) for w in frame["w"]], "freq": frame["freq"]})

    return words.mapInPandas(run, "w string, freq long")


def _cut(word: str, kept: set[str]) -> Iterator[str]:
    """The parts of a word in which all adjacent pairs are among `kept`."""
    start = 0
    for i, pair in enumerate(map("".join, pairwise(word)), 1):
        if pair not in kept:
            if i - start > 1:
                yield word[start:i]
            start = i
    if len(word) - start > 1:
        yield word[start:]


def _pieces(words: DataFrame, pairs: list[str]) -> DataFrame:
    """The words cut wherever a pair is not among `pairs`, equal pieces as one row with their frequencies added up."""
    kept = set(pairs)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, int] = {}
        for frame in frames:
            for w, f in zip(frame["w"], frame["freq"].tolist(), strict=True):
                for piece in _cut(w, kept):
                    found[piece] = found.get(piece, 0) + f
            if len(found) > HELD_PIECES:
                yield pd.DataFrame(found.items(), columns=["w", "freq"])
                found = {}
        yield pd.DataFrame(found.items(), columns=["w", "freq"]).astype({"w": "object", "freq": "int64"})

    return words.mapInPandas(run, "w string, freq long").groupBy("w").agg(F.sum("freq").alias("freq"))


def _symbols(words: DataFrame) -> int:
    return words.agg(F.sum(F.length("w"))).first()[0] or 0


def _band_of_merges(
    table: DataFrame, found: Vocabulary, size: int, least: int, held_symbols: int, enough: int, width: int
) -> tuple[DataFrame | None, int]:
    """Take all merges of a band of counts and return the words after them, and how many pairs to begin the next band
    with; None if not even the pieces around the `enough` most frequent pairs have at most `held_symbols` symbols.

    A pair that is created later is at most as frequent as the two symbols were that meet in its middle. Words may
    therefore be cut at all pairs below the band: nothing that spans a cut gets into the band. The pieces repeat much
    more than the words, and equal ones are one row, so a band that reaches as deep as `held_symbols` admits is held
    whatever the size of the corpus. Pairs that no piece links to each other cannot change each other's counts: the
    executors merge each group of linked pairs by itself, one pair at a time, and the driver only puts the groups'
    merges in order.
    """
    live, complete = _live_pairs(table, least)
    if not live:
        return table.filter("w IS NULL"), width
    pairs, floor, pieces = live, least if complete else live[-1][1], table
    if whole := _symbols(table) <= held_symbols:
        symbols = 0
    while not whole:
        if width < len(live):
            floor = live[width - 1][1]
            pairs = [p for p in live if p[1] >= floor]
        pieces = materialised(_pieces(table, [p for p, *_ in pairs]), "pieces")
        symbols = _symbols(pieces)
        if symbols <= held_symbols:
            break
        if width <= enough:
            return None, width
        width = max(min(width, len(live)) // 4, 1)
    links = _shared_words(pieces, [p for p, *_ in pairs])
    _, group = _band([(pair, n, 0) for pair, n, _ in pairs], links, held_symbols)
    alone = whole and complete and len(set(group)) == 1
    part_of = {pair: g for (pair, *_), g in zip(pairs, group, strict=True)}
    names, tokens, room = found.names, found.tokens, size - len(found.names)

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            part = [next((part_of[p] for p in map("".join, pairwise(w)) if p in part_of), -1) for w in frame["w"]]
            yield frame.assign(part=part)[["w", "freq", "part"]]

    def trained(frame: pd.DataFrame) -> pd.DataFrame:
        words = list(zip(frame["w"], frame["freq"].tolist(), strict=True))
        rows = _merges_of_group(words, floor, room, names, tokens, alone)
        out = pd.DataFrame(rows, columns=["n", "left_id", "right_id"], dtype="int64")
        return out.assign(part=frame["part"].iloc[0], at=range(len(rows)))[["part", "at", "n", "left_id", "right_id"]]

    rows = pieces.mapInPandas(placed, "w string, freq long, part int").filter("part >= 0").groupBy("part")
    rows = rows.applyInPandas(trained, "part int, at int, n long, left_id int, right_id int")
    chosen = rows.toPandas().sort_values(["part", "at"])  # no more than the band's pairs and the tokens that may follow
    groups: dict[int, list[tuple[int, int, int]]] = {}
    for part, n, left, right in zip(*(chosen[c].tolist() for c in ("part", "n", "left_id", "right_id")), strict=True):
        groups.setdefault(part, []).append((n, left, right))
    before = len(found.merges)
    _interleaved(groups, found, size, alone)
    deeper = 4 if symbols * 4 <= held_symbols else 2 if symbols * 2 <= held_symbols else 1
    return _merged_in_order(table, found.merges[before:]), min(width * deeper, LIVE_PAIRS)


def train_vocabulary(
    counts: DataFrame,
    size: int = VOCABULARY_SIZE,
    min_frequency: int = MIN_FREQUENCY,
    candidates: int = 512,
    merges_per_table: int = 64,
    held_symbols: int = HELD_SYMBOLS,
) -> tuple[DataFrame, DataFrame]:
    """Tables `vocabulary(id, token)` and `merges(rank, left_id, right_id, id)` from word counts.

    Ids: reserved tokens, then the bytes seen in order of their stand-ins, then merges. The result equals merging
    one pair at a time, the most frequent first and on ties the one with smaller ids.

    A round takes all merges of a band of counts: the words are cut at the pairs below the band, equal pieces are added
    up, and each group of linked pieces is merged by a task of its own, at most `held_symbols` symbols in all
    (`_band_of_merges`). If no band of `merges_per_table` pairs fits, a round counts pairs, takes every merge that is
    already certain (`_certain_merges`) and applies them together; at most `candidates` pairs reach the driver. The
    driver sees pairs, their counts and their merges, never words. Words that are down to one symbol drop out whenever
    the table is rewritten.
    """
    spark = counts.sparkSession
    spelled = materialised(
        counts.select(as_bytes_text(F.col("word")).alias("w"), F.col("freq").cast("long").alias("freq")), "words"
    )
    seen = spelled.select(F.explode(F.split("w", "")).alias("c")).filter("c <> ''").distinct()
    alphabet = sorted(r.c for r in seen.collect())  # at most 256 rows
    found = Vocabulary([*SPECIAL_TOKENS, *alphabet])
    least = max(min_frequency, 1)

    start = "".join(symbol(found.tokens[c]) for c in alphabet)
    words = spelled.withColumn("w", F.translate("w", "".join(alphabet), start)) if alphabet else spelled
    parallel = spark.sparkContext.defaultParallelism

    def rewritten(words: DataFrame) -> DataFrame:
        return materialised(words.filter(F.length("w") > 1).repartition(parallel), "words")

    table, waiting = None, []  # the words as last written, and the merges applied to them since
    reach = FIRST_PAIRS  # pairs that the next band begins with
    width = 32  # pairs looked at in a round: twice as many as the last round could use
    while len(found.names) < size:
        if table is None or len(waiting) >= merges_per_table:
            table, waiting = rewritten(_merged(words if table is None else table, waiting)), []
            while len(found.names) < size:
                after, reach = _band_of_merges(table, found, size, least, held_symbols, merges_per_table, reach)
                if after is None:
                    break
                table = rewritten(after)
                if table.isEmpty():
                    break
        current = _merged(table, waiting)
        best = (
            _pair_counts(current)
            .filter(F.col("n") >= least)
            .orderBy(F.col("n").desc(), "pair")
            .limit(width)
            .collect()
        )
        if not best or len(found.names) >= size:
            break
        beside = Neighbours(current, [r.pair for r in best])
        chosen = _certain_merges([(r.pair, r.n) for r in best], beside, found.tokens, found.names)
        width = min(max(2 * len(chosen), 32), candidates)
        for pair in chosen:
            if len(found.names) >= size:
                break
            merged, _ = found.merge(symbol_id(pair[0]), symbol_id(pair[1]))
            waiting.append((pair, symbol(merged)))
    vocabulary = spark.createDataFrame(list(enumerate(found.names)), "id int, token string")
    return vocabulary, spark.createDataFrame(found.merges, "rank int, left_id int, right_id int, id int")


def stored_vocabulary(
    counts: DataFrame, folder: str, size: int = VOCABULARY_SIZE, min_frequency: int = MIN_FREQUENCY
) -> tuple[DataFrame, DataFrame]:
    """`train_vocabulary`, kept below `folder` under a digest of the word counts and the parameters.

    Equal counts are trained once, whoever asks: every later call reads the two tables. A training that is lost leaves
    nothing under the digest. Of two at the same time one is kept; they are equal.
    """
    spark = counts.sparkSession
    counts = materialised(counts.select("word", "freq"), "word-counts")
    sums = [F.sum(F.xxhash64(F.lit(seed), "word", "freq").cast("decimal(38, 0)")) for seed in (1, 2)]
    seen = counts.agg(F.count("*"), F.sum("freq"), *sums).first()
    digest = hashlib.sha256(repr((*map(str, seen), size, min_frequency, SPECIAL_TOKENS, WORD_PATTERN)).encode()).hexdigest()[:32]
    place = f"{folder.rstrip('/')}/{digest}"
    if not path_exists(spark, place):
        vocabulary, merges = train_vocabulary(counts, size, min_frequency)
        fresh = f"{folder.rstrip('/')}/.{digest}-{uuid.uuid4().hex}"
        vocabulary.write.parquet(f"{fresh}/vocabulary")
        merges.write.parquet(f"{fresh}/merges")
        fs, target = file_system(spark, place)
        if not fs.exists(target) and not fs.rename(file_system(spark, fresh)[1], target) and not fs.exists(target):
            raise OSError(f"could not move {fresh} to {place}")
    vocabulary = spark.read.schema("id int, token string").parquet(f"{place}/vocabulary")
    return vocabulary, spark.read.schema("rank int, left_id int, right_id int, id int").parquet(f"{place}/merges")


class WordEncoder:
    """Applies a merge table to single words; the size of both tables is bounded by the vocabulary."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[int, int, int, int]]):
        self.ids = vocabulary
        self.merges = {(left, right): (rank, new) for rank, left, right, new in merges}
        self.reserved = {t: vocabulary[t] for t in SPECIAL_TOKENS if t in vocabulary}
        self.standins = byte_alphabet()
        self.cached = lru_cache(maxsize=100_000)(self.word)

    def word(self, word: str) -> list[int]:
        if word in self.reserved:
            return [self.reserved[word]]
        # a linked list of the symbols and a heap of the pairs that have a rule: n log n for a long word
        ids: list[int | None] = [self.ids.get(self.standins[b], UNK) for b in word.encode("utf-8")]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < len(ids):
                pair = ids[at], ids[after[at]]
                if pair in self.merges:
                    rank, new = self.merges[pair]
                    heappush(heap, (rank, at, *pair, new))

        for at in range(len(ids) - 1):
            offer(at)
        while heap:
            _, at, left, right, new = heappop(heap)
            gone = after[at]
            if ids[at] != left or gone >= len(ids) or ids[gone] != right:
                continue  # one of the two has been merged since
            ids[at], ids[gone] = new, None
            after[at] = after[gone]
            if after[at] < len(ids):
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [i for i in ids if i is not None]


def encode(texts: DataFrame, vocabulary: DataFrame, merges: DataFrame, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the token ids of every text.

    A map-only job: the words are cut on the JVM, and each task merges a word once and remembers it, so
    nothing is exploded, joined back or shuffled. The two tables are small by construction.
    """
    table = {r.token: r.id for r in vocabulary.collect()}  # bounded by the vocabulary size
    rules = [tuple(r) for r in merges.select("rank", "left_id", "right_id", "id").collect()]
    shared = texts.sparkSession.sparkContext.broadcast((table, rules))

    @F.pandas_udf("array<int>")
    def word_ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = WordEncoder(*shared.value)
        for batch in batches:
            yield batch.map(lambda words: [i for w in words for i in encoder.cached(w)], na_action="ignore")

    # declared nondeterministic so that a filter on the ids is not pushed down to run the encoder twice
    return texts.withColumn(ids, word_ids.asNondeterministic()(pretokens(F.col(text))))


def decode(ids: Column, vocabulary: DataFrame) -> Column:
    """Text of a token sequence; reserved tokens are left out.

    The vocabulary, small by construction, becomes one constant array addressed by id: no join.
    """
    shown = {r.id: "" if r.token in SPECIAL_TOKENS else r.token for r in vocabulary.collect()}
    listed = "\x01".join(shown.get(i, "") for i in range(max(shown, default=-1) + 1))
    tokens = F.split(F.lit(listed), "\x01")  # folded to a literal; no stand-in is U+0001
    pieces = F.transform(ids, lambda i: F.coalesce(F.get(tokens, i), F.lit("")))
    return from_bytes_text(F.array_join(pieces, ""))


def round_trip(texts: DataFrame, vocabulary: DataFrame, merges: DataFrame, text: str = "text") -> DataFrame:
    """Encode and decode every text and compare with its normal form, both stripped."""
    coded = encode(texts, vocabulary, merges, text)
    back = coded.withColumn("decoded", strip(decode(F.col("ids"), vocabulary)))
    return back.withColumn("ok", F.col("decoded") == strip(nfkc(F.col(text))))
