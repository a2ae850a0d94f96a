"""Packing of cleaned text into fragments of bounded size.

Both packers are next-fit folds. The folds run over piece *lengths* and keep only integers, so a step costs
the same however long the text is; the pieces are joined once, when the cut points are known.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import is_blank, let, sentences, strip

MAX_CHARS = 2_000
MIN_PROSE = 150
MIN_CODE = 100


def _lengths(pieces: Column) -> Column:
    return F.transform(pieces, F.length)


def _range(pieces: Column, start: Column, end: Column) -> Column:
    """Pieces at 0-based positions `start` (included) to `end` (excluded)."""
    return F.slice(pieces, start + 1, end - start)


def next_fit_starts(lengths: Column, gap: int, max_chars: int, used: Column | None = None) -> Column:
    """Positions at which a new group begins when pieces are joined with `gap` characters between them.

    A piece joins the open group unless the result would exceed `max_chars`. `used` is the size of the group that is
    open before the first piece, -1 if there is none.
    """
    empty = F.struct(
        F.lit(0).alias("at"), (F.lit(-1) if used is None else used).alias("used"), F.array().cast("array<int>").alias("starts")
    )

    def step(acc: Column, size: Column) -> Column:
        fresh = (acc["used"] < 0) | (acc["used"] + size + gap > max_chars)
        return F.struct(
            (acc["at"] + 1).alias("at"),
            F.when(fresh, size).otherwise(acc["used"] + size + gap).alias("used"),
            F.when(fresh, F.concat(acc["starts"], F.array(acc["at"]))).otherwise(acc["starts"]).alias("starts"),
        )

    return F.aggregate(lengths, empty, step, lambda acc: acc["starts"])


def sentence_groups(paragraph: Column, position: Column, max_chars: int) -> Column:
    """Sentences of a long paragraph packed together: `pos`, `sub` and `text`."""

    def groups(parts: Column) -> Column:
        return let(
            next_fit_starts(_lengths(parts), 1, max_chars),
            lambda starts: F.transform(
                starts,
                lambda start, k: F.struct(
                    position.alias("pos"),
                    k.alias("sub"),
                    F.array_join(
                        _range(parts, start, F.coalesce(F.get(starts, k + 1), F.size(parts))), " "
                    ).alias("text"),
                ),
            ),
        )

    return let(sentences(paragraph), groups)


def paragraph_groups(short: Column, starts: Column, last: Column) -> Column:
    """Short paragraphs (`pos`, `text`) packed together in groups that begin at `starts`: `pos`, `sub` and `text`.

    A group is emitted by the paragraph that no longer fits, or at the very end (`last`).
    """
    return F.transform(
        starts,
        lambda start, k: let(
            F.get(starts, k + 1),
            lambda following: F.struct(
                F.coalesce(F.get(short, following)["pos"], last).alias("pos"),
                F.lit(0).alias("sub"),
                F.array_join(
                    F.transform(_range(short, start, F.coalesce(following, F.size(short))), lambda p: p["text"]), "\n\n"
                ).alias("text"),
            ),
        ),
    )


def _packed_paragraphs(short: Column, last: Column, max_chars: int) -> Column:
    starts = next_fit_starts(F.transform(short, lambda p: F.length(p["text"])), 2, max_chars)
    return let(starts, lambda at: paragraph_groups(short, at, last))


def pack_paragraphs(text: Column, max_chars: int = MAX_CHARS, min_chars: int = MIN_PROSE) -> Column:
    """Fragments of a prose text, as an array in emission order.

    Paragraphs are packed together up to `max_chars`. A paragraph longer than that is packed sentence by
    sentence on its own; it does not close the group of short paragraphs that is open around it, so its
    fragments can precede earlier text. A sentence is never cut. Groups shorter than `min_chars` are dropped.
    """
    paragraphs = F.filter(F.transform(F.split(text, r"\n{2,}"), strip), lambda p: p != "")
    numbered = F.transform(paragraphs, lambda p, i: F.struct(i.alias("pos"), p.alias("text")))

    def pack(all_: Column) -> Column:
        long = F.flatten(
            F.transform(
                F.filter(all_, lambda p: F.length(p["text"]) > max_chars),
                lambda p: sentence_groups(p["text"], p["pos"], max_chars),
            )
        )
        short = let(
            F.filter(all_, lambda p: F.length(p["text"]) <= max_chars),
            lambda ps: _packed_paragraphs(ps, F.size(all_), max_chars),
        )
        kept = F.filter(F.concat(short, long), lambda f: F.length(f["text"]) >= min_chars)
        return F.transform(F.sort_array(kept), lambda f: f["text"])

    return let(numbered, pack)


def code_cut_ends(lines: Column, max_chars: int) -> Column:
    """Positions after which a block of lines is closed.

    A block closes at a blank line once it has `max_chars` characters, and anywhere at one and a half times
    that.
    """
    empty = F.struct(
        F.lit(0).alias("at"), F.lit(-1).alias("used"), F.array().cast("array<int>").alias("ends")
    )

    def step(acc: Column, line: Column) -> Column:
        used = F.when(acc["used"] < 0, line["size"]).otherwise(acc["used"] + line["size"] + 1)
        return let(
            used,
            lambda n: let(
                ((n >= max_chars) & line["blank"]) | (n * 2 >= max_chars * 3),
                lambda full: F.struct(
                    (acc["at"] + 1).alias("at"),
                    F.when(full, F.lit(-1)).otherwise(n).alias("used"),
                    F.when(full, F.concat(acc["ends"], F.array(acc["at"] + 1)))
                    .otherwise(acc["ends"])
                    .alias("ends"),
                ),
            ),
        )

    measured = F.transform(lines, lambda s: F.struct(F.length(s).alias("size"), is_blank(s).alias("blank")))
    return F.aggregate(measured, empty, step, lambda acc: acc["ends"])


def code_blocks(text: Column, max_chars: int = MAX_CHARS, min_chars: int = MIN_CODE) -> Column:
    """Fragments of a code text, as an array of `at` (number of the block, short ones counted) and `text`: whole lines,
    cut by `code_cut_ends`."""

    def blocks(lines: Column) -> Column:
        bounds = F.concat(
            F.array(F.lit(0)), code_cut_ends(lines, max_chars), F.array(F.size(lines))
        )
        return let(
            bounds,
            lambda b: F.transform(
                F.slice(b, F.lit(1), F.size(b) - 1),
                lambda start, k: F.struct(k.alias("at"), strip(F.array_join(_range(lines, start, F.get(b, k + 1)), "\n")).alias("text")),
            ),
        )

    return F.filter(let(F.split(text, "\n"), blocks), lambda f: F.length(f["text"]) >= min_chars)


def pack_code(text: Column, max_chars: int = MAX_CHARS, min_chars: int = MIN_CODE) -> Column:
    """Fragments of a code text, as an array in order."""
    return F.transform(code_blocks(text, max_chars, min_chars), lambda f: f["text"])
