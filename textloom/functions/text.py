"""Normalising and cleaning of prose and code.

Everything is a JVM expression except Unicode normalisation, which Spark does not offer: that one goes
through an Arrow UDF, and only the texts that can change are sent to it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = r"[\s\x1c-\x1f]"  # the same set inside a (?U) pattern

# Ranges in which every text is its own NFC form: no combining mark, no character with a canonical
# singleton, no second half of a composition (checked exhaustively in the tests). The low range holds most
# of any text and is matched on its own.
NFC_LOW = r"\x{0}-\x{2FF}"
NFC_HIGH = (
    r"\x{2010}-\x{2027}\x{2030}-\x{205E}\x{20A0}-\x{20BF}"
    r"\x{3041}-\x{3096}\x{30A1}-\x{30FA}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7A3}"
)
# The same for NFKC: without the characters that have a compatibility form.
NFKC_LOW = r"\x{0}-\x{7F}"
NFKC_HIGH = (
    r"\x{A1}-\x{A7}\x{A9}\x{AB}-\x{AE}\x{B0}\x{B1}\x{B6}\x{B7}\x{BB}\x{BF}-\x{131}"
    r"\x{134}-\x{13E}\x{141}-\x{148}\x{14A}-\x{17E}\x{2012}-\x{2016}\x{2018}-\x{2023}\x{20AC}"
)
# Characters that cleaning leaves as they are: stable under NFC and not in a control category.
PLAIN_LOW = r"\x{20}-\x{7E}"
PLAIN_HIGH = r"\x{A0}-\x{AC}\x{AE}-\x{2FF}" + NFC_HIGH


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times in `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _normaliser(form: str) -> Callable[[Column], Column]:
    @F.pandas_udf("string")
    def normalise(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize(form, t), na_action="ignore")

    return normalise


def _consists_of(text: Column, low: str, high: str) -> Column:
    """Whether every character is in the given ranges, matched without backtracking in one pass."""
    return text.rlike(rf"\A(?:[{low}]++|[{high}]++)*+\z")


def _normalised(text: Column, form: str, low: str, high: str) -> Column:
    # Stable texts reach the UDF as NULL, so their bytes are not shipped to Python.
    unstable = F.when(~_consists_of(text, low, high), text)
    return F.coalesce(_normaliser(form)(unstable), text)


def nfc(text: Column) -> Column:
    """Canonical composition."""
    return _normalised(text, "NFC", NFC_LOW, NFC_HIGH)


def nfkc(text: Column) -> Column:
    """Compatibility composition."""
    return _normalised(text, "NFKC", NFKC_LOW, NFKC_HIGH)


def _without_controls(text: Column, kept: str) -> Column:
    """NFC without the control characters other than those in `kept`.

    One pass finds the texts that cannot change in either way. They are NULL for the UDF, and what comes
    back as NULL skips the second pattern too.
    """
    composed = _normaliser("NFC")(F.when(~_consists_of(text, PLAIN_LOW + kept, PLAIN_HIGH), text))
    return F.when(composed.isNull(), text).otherwise(
        F.regexp_replace(composed, rf"[\p{{C}}&&[^{kept} ]]+", "")
    )


def _replaced_where(text: Column, marks: list[str], pattern: str, new: str) -> Column:
    """Pattern replacement, tried only on texts that contain one of `marks`: a far cheaper test."""

    def replaced(t: Column) -> Column:
        present = reduce(or_, [F.contains(t, F.lit(m)) for m in marks])
        return F.when(present, F.regexp_replace(t, pattern, new)).otherwise(t)

    return let(text, replaced)


def strip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends (Spark's `trim` removes only U+0020)."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def clean_prose_lines(text: Column) -> Column:
    """`clean_prose` for a part of a text between two lines: both ends stay as they are."""
    c = _without_controls(text, r"\n")
    c = _replaced_where(c, ["\n\n\n"], r"\n{3,}", "\n\n")
    c = _replaced_where(c, ["  "], r" {2,}", " ")
    return _replaced_where(c, [" \n", "\n "], r" ?\n ?", "\n")


def clean_prose(text: Column) -> Column:
    """Prose cleaning: NFC, control characters out, blank runs collapsed, lines trimmed.

    Tabs and carriage returns are control characters here: they vanish, they do not become spaces.
    """
    return strip(clean_prose_lines(text))


def clean_code(text: Column) -> Column:
    """Code cleaning: NFC, control characters except tab out, long blank gaps cut, line ends trimmed."""
    c = _without_controls(text, r"\n\t")
    c = _replaced_where(c, ["\n\n\n\n\n"], r"\n{5,}", "\n\n\n")
    c = _replaced_where(c, [" \n", "\t\n"], r"(?<![ \t])[ \t]++(?=\n)", "")
    return strip(c)


def sentences(paragraph: Column) -> Column:
    """Split after `.`, `!` or `?` followed by whitespace."""
    return F.split(paragraph, rf"(?U)(?<=[.!?]){SPACE_CLASS}+")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column) -> Column:
    """Extension of the last path part with its dot; a name that only starts with dots has none."""
    return F.regexp_extract(base_name(path), r"(?s)^\.*[^.].*(\.[^.]*)$", 1)


def parent_path(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*\z", "")


def file_header(name: Column, ext: Column) -> Column:
    """Line put before the code of a file from a source tree."""
    return F.concat(F.lit("# Archivo: "), name, F.lit(" (extension: "), ext, F.lit(")\n\n"))


def repo_header(owner: Column, repo: Column, name: Column) -> Column:
    """Line put before the code of a file from a repository archive."""
    return F.concat(F.lit("# Repo: "), owner, F.lit("/"), repo, F.lit(" | Archivo: "), name, F.lit("\n\n"))


def encode_title(title: Column) -> Column:
    """Percent-decode a title, then percent-encode it again leaving `_:()/` readable."""
    guarded = F.regexp_replace(title, r"%(?![0-9A-Fa-f]{2})", "%25")  # a stray % is a plain character
    decoded = F.url_decode(F.replace(guarded, F.lit("+"), F.lit("%2B")))
    encoded = F.url_encode(decoded)
    # Where form encoding differs from path encoding, and the characters kept readable.
    for form, path in [("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%3A", ":"), ("%28", "("), ("%29", ")"), ("%2F", "/")]:
        encoded = F.replace(encoded, F.lit(form), F.lit(path))
    return encoded


# The lines around the body of a digitised book, in order of preference.
BOOK_START = ["*** START OF THE PROJECT GUTENBERG EBOOK", "*** START OF THIS PROJECT GUTENBERG EBOOK"]
BOOK_END = ["*** END OF THE PROJECT GUTENBERG EBOOK", "*** END OF THIS PROJECT GUTENBERG EBOOK"]
BOOK_MARK = " PROJECT GUTENBERG EBOOK"  # in each of them


def _first_hit(text: Column, marks: list[str]) -> Column:
    """1-based position of the first mark of the list that occurs at all, 0 when none does."""
    hits = F.array(*[F.instr(text, F.lit(mark)) for mark in marks])
    return F.coalesce(F.get(F.filter(hits, lambda at: at > 0), F.lit(0)), F.lit(0))


def _cut_start(text: Column) -> Column:
    def cut(start: Column) -> Column:
        rest = F.substring(text, start, F.length(text))
        gap = F.instr(rest, F.lit("\n\n"))
        return F.when((start > 0) & (gap > 0), strip(F.substring(rest, gap, F.length(rest)))).otherwise(text)

    return let(_first_hit(text, BOOK_START), cut)


def _cut_end(text: Column) -> Column:
    return let(
        _first_hit(text, BOOK_END),
        lambda end: F.when(end > 0, strip(F.substring(text, F.lit(1), end - 1))).otherwise(text),
    )


def trim_banner(text: Column) -> Column:
    """Cut a book text to its body: after the blank line that follows the start line, before the end line.

    A text with CRLF line ends has no blank line in this sense, so its start is not cut.
    """
    return let(_cut_start(text), _cut_end)


def repair_escapes(line: Column) -> Column:
    r"""Drop the backslash before `<`, `>` and `!`, which JSON does not know as escapes."""
    return F.regexp_replace(line, r"\\([<>!])", "$1")


def title_words(title: Column) -> Column:
    """Lower-case a title and turn its underscores into spaces."""
    return F.replace(F.lower(title), F.lit("_"), F.lit(" "))
