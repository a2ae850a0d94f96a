"""Books of any size. Landed files are read by lines and held in pieces; no row, task or worker has a whole book.

The result is that of `readers.book_fragments`, which takes texts that are rows already. A paragraph that a piece's end
cuts is joined again, and the packing of short paragraphs goes on from piece to piece: a piece knows by lengths alone
what a group that is open before it turns into (`_exits`), so only these few numbers per piece meet for a book.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions.packing import MAX_CHARS, MIN_PROSE, next_fit_starts, paragraph_groups, sentence_groups
from textloom.functions.text import BOOK_END, BOOK_MARK, BOOK_START, base_name, clean_prose_lines, strip
from textloom.session import materialised, text_batches

#: Bytes of whole lines after which a piece ends.
PIECE_BYTES = 512 << 10
#: Characters between the paragraphs of a fragment.
GAP = 2
PIECE_SCHEMA = "path string, block long, piece int, text string"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of a file's block, in order, as texts of about `PIECE_BYTES`; bytes that are not UTF-8 are dropped."""
    place, number, lines, size = (None, None), 0, [], 0

    def piece() -> pa.RecordBatch:
        text = (b"\n".join(lines) + b"\n").decode("utf-8", errors="ignore")
        return pa.RecordBatch.from_arrays(
            [pa.array([place[0]], pa.string()), pa.array([place[1]], pa.int64()), pa.array([number], pa.int32()), pa.array([text], pa.string())],
            names=["path", "block", "piece", "text"],
        )

    for batch in batches:
        for path, block, line in zip(*(batch.column(c).to_pylist() for c in ("path", "block", "line")), strict=True):
            if (path, block) != place:
                if lines:
                    yield piece()
                place, number, lines, size = (path, block), 0, [], 0
            lines.append(line)
            size += len(line) + 1
            if size >= PIECE_BYTES:
                yield piece()
                number, lines, size = number + 1, [], 0
    if lines:
        yield piece()


def read_pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Pieces of the landed copies of books: `copy`, its place `at` in the copy, `text`, every line with its line feed.

    A copy is a file `<book id>-<rank>.txt`, or files `<book id>-<rank>.<part>.txt` that end with a line feed and follow
    each other by the number of the part.
    """
    text_batches(spark)
    files = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    lines = files.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"),
    )
    part = F.regexp_extract(base_name(F.col("path")), r"^\d+-\d+\.(\d+)\.[^.]*$", 1).try_cast("long")
    copy = F.when(part.isNull(), F.col("path")).otherwise(F.regexp_replace("path", r"\.\d+(\.[^./]*)$", "$1"))
    at = F.struct(F.coalesce(part, F.lit(0)).alias("part"), "block", "piece")
    pieces = lines.mapInArrow(_pieces, PIECE_SCHEMA).select(copy.alias("copy"), at.alias("at"), "text")
    return pieces.filter(_rank(F.col("copy")).isNotNull())


def _rank(copy: Column) -> Column:
    return F.regexp_extract(base_name(copy), r"^\d+-(\d+)", 1).try_cast("int")


# --- the body of a book ----------------------------------------------------------------------------


def _first_mark(rows: DataFrame, text: Column, marks: list[str], name: str) -> DataFrame:
    """Per copy the place `at`, `pos` of the first mark of the list that occurs at all; no row when none does."""
    hits = [F.instr(text, F.lit(mark)) for mark in marks]
    found = [F.min(F.when(hit > 0, F.struct("at", hit.alias("pos")))) for hit in hits]
    return rows.groupBy("copy").agg(F.coalesce(*found).alias(name)).filter(F.col(name).isNotNull())


def book_bodies(pieces: DataFrame) -> DataFrame:
    """`trim_banner` on pieces (a stored table, with `marked` where a mark may be)."""
    text, marked = F.col("text"), pieces.filter("marked")
    starts = _first_mark(marked, text, BOOK_START, "start")
    # the blank line behind the start line; a line feed that ends the piece before counts
    blank = F.when(F.col("at") == F.col("start.at"), F.position(F.lit("\n\n"), text, F.col("start.pos"))).otherwise(
        F.instr(F.concat(F.lit("\n"), text), F.lit("\n\n"))
    )
    behind = pieces.join(starts, "copy").filter(F.col("at") >= F.col("start.at"))
    begins = behind.groupBy("copy").agg(F.min(F.when(blank > 0, F.struct("at", blank.alias("pos")))).alias("begin"))
    begins = materialised(begins.filter("begin IS NOT NULL"), "book-begins")

    def body(rows: DataFrame) -> DataFrame:
        within = rows.join(begins, "copy", "left").filter(F.col("begin").isNull() | (F.col("at") >= F.col("begin.at")))
        rest = F.when(F.col("at") == F.col("begin.at"), F.substring(text, F.col("begin.pos"), F.length(text))).otherwise(text)
        return within.withColumn("text", rest).drop("begin")

    ends = materialised(_first_mark(body(marked), text, BOOK_END, "end"), "book-ends")
    within = body(pieces).join(ends, "copy", "left").filter(F.col("end").isNull() | (F.col("at") <= F.col("end.at")))
    cut = F.when(F.col("at") == F.col("end.at"), F.substring(text, F.lit(1), F.col("end.pos") - 1)).otherwise(text)
    return within.select("copy", "at", cut.alias("text"))


# --- paragraphs ------------------------------------------------------------------------------------


def _paragraphs(bodies: DataFrame) -> DataFrame:
    """Cleaned paragraphs per place: `copy`, `place`, `paragraphs`. Those that an end of a piece cuts are places of their own."""
    # the line feed in front takes the blanks at the start of a line along, as inside the text
    cleaned = bodies.select("copy", "at", F.split(clean_prose_lines(F.concat(F.lit("\n"), "text")), r"\n{2,}").alias("_p"))
    n = F.size("_p")
    inner = F.filter(F.transform(F.slice("_p", F.lit(2), F.greatest(n - 2, F.lit(0))), strip), lambda p: p != "")
    parts = materialised(
        cleaned.select(
            "copy", "at", (n == 1).alias("single"), F.get("_p", F.lit(0)).alias("head"), F.when(n > 1, F.get("_p", n - 1)).alias("tail"),
            inner.alias("paragraphs"),
        ),
        "book-parts",
    )
    # narrow: a row per piece. Every piece with a break in it closes a paragraph and opens the next
    earlier = W.partitionBy("copy").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    turns = parts.select("copy", "at", F.coalesce(F.sum((~F.col("single")).cast("int")).over(earlier), F.lit(0)).alias("id"))
    ends = parts.select("copy", "at", "head", "tail").join(turns, ["copy", "at"])
    ends = ends.select("copy", "at", F.inline(F.array(_part(F.col("id"), "head"), _part(F.col("id") + 1, "tail"))))
    whole = ends.filter("t IS NOT NULL").groupBy("copy", "id").agg(
        F.min("at").alias("at"), F.sort_array(F.collect_list(F.struct("at", F.btrim("t", F.lit("\n")).alias("t")))).alias("ts")
    )
    text = strip(F.array_join(F.filter("ts.t", lambda t: t != ""), "\n"))
    whole = whole.select("copy", _place(F.when(F.col("id") == 0, 0).otherwise(2)), F.array(text).alias("paragraphs"))
    whole = materialised(whole.filter(F.col("paragraphs")[0] != ""), "book-cut-paragraphs")
    inside = parts.filter(F.size("paragraphs") > 0).select("copy", _place(F.lit(1)), "paragraphs")
    return inside.unionByName(whole)


def _part(number: Column, text: str) -> Column:
    """Part of the paragraph or group of that number, which reaches from place to place."""
    return F.struct(number.alias("id"), F.col(text).alias("t"))


def _place(half: Column) -> Column:
    return F.struct("at.part", "at.block", "at.piece", half.alias("half")).alias("place")


# --- packing ---------------------------------------------------------------------------------------


def exits(sizes: np.ndarray, max_chars: int, gap: int = GAP) -> list[int]:
    """What these lengths make of the open group before them: `[room, total, least, out, least, out, ...]`.

    An open group of up to `room` characters takes them all and grows by `total`. A larger one is closed by one of them, and a
    new group of `out` characters is open behind them; `out` is that of the last `least` not above its size (-1: none is open).
    """
    n, ends = len(sizes), np.concatenate([[0], np.cumsum(sizes.astype(np.int64) + gap)])
    following = np.searchsorted(ends, ends[:-1] + max_chars + gap, side="right") - 1  # that a group begun here leaves out
    known: dict[int, int] = {}

    def out(start: int) -> int:
        path = []
        while start not in known:
            path.append(start)
            if following[start] >= n:
                known[start] = int(ends[n] - ends[start] - gap)
            else:
                start = int(following[start])
        for at in path:
            known[at] = known[start]
        return known[start]

    room = int(max_chars - ends[n])
    found = [room, int(ends[n]), -1, out(0)]
    last = int(np.searchsorted(ends, max_chars, side="right"))  # behind the last one that can be the first to close a group
    for first in range(min(last, n) - 1, -1, -1):
        made = out(first)
        if made != found[-1]:
            found += [max(int(max_chars - ends[first + 1]) + 1, 0), made]
    return found


def entries(steps: list[np.ndarray]) -> list[int]:
    """Size of the open group before each step (-1: none), and number of earlier steps in which a group begins."""
    used, groups, found = -1, 0, []
    for step in steps:
        found += [used, groups]
        if 0 <= used <= step[0]:
            used += int(step[1])
        else:
            used, groups = int(step[3::2][np.searchsorted(step[2::2], used, side="right") - 1]), groups + 1
    return found


def _open_groups(elements: DataFrame, max_chars: int) -> DataFrame:
    """Per place of short paragraphs the size of the group that is open before it, `used`, and the number `id` of that group
    among those that reach from place to place."""

    @F.pandas_udf("array<int>")
    def exits_of(sizes: pd.Series) -> pd.Series:
        return sizes.map(lambda s: exits(np.asarray(s), max_chars))

    @F.pandas_udf("array<int>")
    def entries_of(steps: pd.Series) -> pd.Series:
        return steps.map(entries)

    sizes = F.filter(F.transform("paragraphs", F.length), lambda n: n <= max_chars)
    narrow = elements.select("copy", "place", sizes.alias("sizes")).filter(F.size("sizes") > 0)
    steps = narrow.select("copy", F.struct("place", exits_of("sizes").alias("exits")).alias("step"))
    # some numbers per place, for places of about PIECE_BYTES
    books = steps.groupBy("copy").agg(F.sort_array(F.collect_list("step")).alias("steps"))
    known = books.select("copy", "steps.place", entries_of("steps.exits").alias("entries"))
    placed = known.select("copy", "entries", F.posexplode("place").alias("i", "place"))
    used, groups = F.get("entries", 2 * F.col("i")), F.get("entries", 2 * F.col("i") + 1)
    return materialised(placed.select("copy", "place", used.alias("used"), groups.alias("id")), "book-entries")


def _packed(elements: DataFrame, max_chars: int, min_chars: int) -> DataFrame:
    """Per place its own fragments, the number of fragments that end there, and its parts of groups that reach further.

    `own` are `at` (number within the place) and `text`. `first` belongs to the group `id` that is open before the place,
    which gets number `closed_at` if it is closed there; `open` begins group `id + 1`.
    """
    groups = _open_groups(elements, max_chars)
    opened = elements.join(groups, ["copy", "place"], "left")
    numbered = F.transform("paragraphs", lambda p, i: F.struct(i.alias("pos"), p.alias("text")))
    listed = opened.select("copy", "place", "used", "id", numbered.alias("_all"))
    listed = listed.withColumn("_short", F.filter("_all", lambda p: F.length(p["text"]) <= max_chars))
    sizes = F.transform("_short", lambda p: F.length(p["text"]))
    listed = listed.withColumn("_sizes", sizes)
    listed = listed.withColumn("_starts", next_fit_starts(F.col("_sizes"), GAP, max_chars, F.coalesce("used", F.lit(-1))))
    begins = F.get("_starts", F.lit(0))
    joined = F.slice("_short", F.lit(1), F.coalesce(begins, F.size("_short")))
    closes = (F.col("used") >= 0) & begins.isNotNull()
    size = F.aggregate(F.slice("_sizes", F.lit(1), begins), F.col("used"), lambda total, n: total + n + GAP)
    listed = listed.select(
        "copy", "place", "id",
        paragraph_groups(F.col("_short"), F.col("_starts"), F.lit(-1)).alias("_groups"),
        F.flatten(
            F.transform(
                F.filter("_all", lambda p: F.length(p["text"]) > max_chars), lambda p: sentence_groups(p["text"], p["pos"], max_chars)
            )
        ).alias("_long"),
        F.array_join(F.transform(joined, lambda p: p["text"]), "\n\n").alias("first"),
        F.when(closes, F.get("_short", begins)["pos"]).alias("_closed"),
        F.coalesce(F.when(closes, (size >= min_chars).cast("int")), F.lit(0)).alias("_kept"),
    )
    inner = F.filter("_groups", lambda g: g["pos"] >= 0)
    own = F.sort_array(F.filter(F.concat(inner, F.col("_long")), lambda f: F.length(f["text"]) >= min_chars))
    listed = listed.withColumn("_own", own)
    shift = lambda f: F.when(f["pos"] > F.col("_closed"), F.col("_kept")).otherwise(0)
    return listed.select(
        "copy", "place", "id", (F.size("_own") + F.col("_kept")).alias("n"),
        F.transform("_own", lambda f, i: F.struct((i + shift(f)).alias("at"), f["text"].alias("text"))).alias("own"),
        "first", F.get(F.filter("_groups", lambda g: g["pos"] < 0), F.lit(0))["text"].alias("open"),
        F.when(F.col("_closed").isNotNull(), F.size(F.filter("_own", lambda f: f["pos"] < F.col("_closed")))).alias("closed_at"),
    )


def _reaching(packed: DataFrame, min_chars: int) -> DataFrame:
    """Fragments of groups that reach from place to place: `copy`, `place` and `at` where they are closed (NULL: not), `text`."""
    rows = packed.filter("id IS NOT NULL")
    parts = rows.select("copy", "place", F.lit(None).cast("int").alias("closed_at"), _part(F.col("id") + 1, "open").alias("part"))
    parts = parts.unionByName(rows.select("copy", "place", "closed_at", _part(F.col("id"), "first").alias("part")))
    parts = parts.select("copy", "place", "closed_at", "part.*").filter("id > 0 AND t IS NOT NULL")
    closed = F.max(F.when(F.col("closed_at").isNotNull(), F.struct("place", "closed_at"))).alias("c")
    whole = parts.groupBy("copy", "id").agg(closed, F.sort_array(F.collect_list(F.struct("place", "t"))).alias("ts"))
    text = F.array_join(F.filter("ts.t", lambda t: t != ""), "\n\n")
    found = whole.select("copy", F.col("c.place").alias("place"), F.col("c.closed_at").alias("at"), text.alias("text"))
    return found.filter(F.length("text") >= min_chars)


def landed_book_fragments(spark: SparkSession, path: str | list[str], max_chars: int = MAX_CHARS, min_chars: int = MIN_PROSE) -> DataFrame:
    """Fragments of the first copy of each landed book that yields any, as `readers.book_fragments` of their whole texts.

    A line, and a paragraph, must fit a row; a book need not.
    """
    marked = F.contains(F.col("text"), F.lit(BOOK_MARK))
    pieces = materialised(read_pieces(spark, path).withColumn("marked", marked), "book-pieces")
    packed = materialised(_packed(_paragraphs(book_bodies(pieces)), max_chars, min_chars), "book-packed")
    reaching = materialised(_reaching(packed, min_chars), "book-reaching")
    earlier = W.partitionBy("copy").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    offsets = packed.select("copy", "place", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    offsets = materialised(offsets, "book-offsets")
    ends = offsets.groupBy("copy").agg(F.sum("n").alias("n"))
    last = reaching.filter("place IS NULL").select("copy", F.lit(1).alias("more"))
    made = ends.join(last, "copy", "left").withColumn("made", F.col("n") + F.coalesce("more", F.lit(0)))
    book = F.regexp_extract(base_name(F.col("copy")), r"^(\d+)", 1).try_cast("int")
    tried = made.filter("made > 0").select(book.alias("book_id"), F.struct(_rank(F.col("copy")).alias("rank"), "copy").alias("best"), "n")
    chosen = tried.groupBy("book_id").agg(F.min_by(F.struct("best.copy", "n"), "best").alias("c"))
    chosen = materialised(chosen.select("book_id", "c.copy", F.col("c.n").alias("all")), "book-copies")
    own = packed.select("copy", "place", F.inline("own")).join(offsets.drop("n"), ["copy", "place"])
    far = reaching.join(offsets.drop("n"), ["copy", "place"], "left").select("copy", "place", "at", "text", "before")
    every = own.select("copy", "place", "at", "text", "before").unionByName(far).join(chosen, "copy")
    number = F.coalesce(F.col("before") + F.col("at"), F.col("all"))
    return every.select(
        F.lit("gutenberg").alias("source"), F.col("book_id").cast("string").alias("doc_key"), number.cast("int").alias("frag_idx"), "text"
    )
