"""License scans: notice phrases by Aho-Corasick, identifier tags by a shunting-yard expression parser."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache, reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Notice phrases (lower case, words parted by one space) and the label each one gives.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "apache license version 2 0": "apache-2.0",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "permission is hereby granted free of charge": "mit",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "creative commons": "cc",
    "unlicense": "unlicense",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
}

#: Identifiers as they begin in tags, lower case, and the label of their family.
FAMILIES = {
    "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "apache": "apache", "mit": "mit", "bsd": "bsd", "mpl": "mpl",
    "epl": "epl", "isc": "isc", "cc-by": "cc-by", "cc-by-sa": "cc-by-sa", "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd",
    "cc0": "cc0", "unlicense": "unlicense", "zlib": "zlib",
}
#: Families that ask for derived works under the same licence, or restrict what is done with the work.
NOT_PERMISSIVE = {"gpl", "lgpl", "agpl", "mpl", "epl", "cc-by-sa", "cc-by-nc", "cc-by-nd"}
#: Identifiers that name no licence.
NO_CLAIM = {"noassertion", "none"}

_TAG = b"spdx-license-identifier:"
_TAG_WORDS = "spdx license identifier "
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_RANK = {"or": 1, "and": 2, "with": 3}

_WORD = bytearray(b" " * 256)
for _c in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    _WORD[_c] = _c
for _c in range(0x41, 0x5B):
    _WORD[_c] = _c + 32


def words_of(text: str) -> list[bytes]:
    """The words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of a text after lower-casing A-Z, as UTF-8."""
    return text.encode().translate(bytes(_WORD)).split(b" ") if text else []


def family(identifier: str) -> str:
    """The label of an identifier: its family, or the identifier itself in lower case."""
    name = identifier.lower().rstrip("+")
    fits = [f for f in FAMILIES if name == f or name.startswith(f + "-")]
    return FAMILIES[max(fits, key=len)] if fits else name


def _either(left: bool | None, right: bool | None) -> bool | None:
    return True if left or right else None if left is None or right is None else False


def _both(left: bool | None, right: bool | None) -> bool | None:
    return False if left is False or right is False else None if left is None or right is None else True


def evaluate(expression: str) -> tuple[list[str], bool | None] | None:
    """Labels of an `AND` / `OR` / `WITH` expression, and whether it can be used permissively.

    Shunting-yard: operators wait on a stack until one that binds less tightly, a parenthesis or the end sends
    them to the values. `OR` is permissive if one side is, `AND` if both are, and an exception (`WITH`) keeps
    its licence's labels. Identifiers of no known family keep their name as label and leave it open (None) whether
    use is permissive; `NOASSERTION` and `NONE` have no label, too. Returns None for anything that is no expression; text after a finished expression,
    such as the end of a comment, is left out.
    """
    values: list[tuple[frozenset[str], bool | None]] = []
    waiting: list[str] = []

    def apply() -> bool:
        name = waiting.pop()
        if name not in _RANK or len(values) < 2:
            return False
        right, left = values.pop(), values.pop()
        if name == "with":
            values.append(left)
        else:
            values.append((left[0] | right[0], (_either if name == "or" else _both)(left[1], right[1])))
        return True

    operand = True  # an operand is due next
    for match in _TOKEN.finditer(expression):
        token, word = match.group(), match.group().lower()
        if token == "(" and operand:
            waiting.append(token)
        elif token == ")" and not operand:
            while waiting and waiting[-1] != "(":
                if not apply():
                    return None
            if not waiting:
                break
            waiting.pop()
        elif word in _RANK and not operand:
            while waiting and _RANK.get(waiting[-1], 0) >= _RANK[word]:
                if not apply():
                    return None
            waiting.append(word)
            operand = True
        elif operand and word not in _RANK and token not in "()":
            label = family(token)
            permissive = label not in NOT_PERMISSIVE if label in FAMILIES.values() else None
            values.append((frozenset([label]) - NO_CLAIM, permissive))
            operand = False
        else:
            break
    while waiting:
        if not apply():
            return None
    return (sorted(values[0][0]), values[0][1]) if len(values) == 1 and not operand else None


@cache
def _automaton(phrases: tuple[tuple[str, str, bool], ...]) -> ahocorasick.Automaton:
    """Phrases with a space on either side, over bytes that are read as Latin-1 characters, and the words of a tag."""
    automaton = ahocorasick.Automaton()
    kept: dict[str, list[tuple[str, bool]]] = {}
    for phrase, label, base in phrases:
        kept.setdefault(" " + phrase.encode().decode("latin-1") + " ", []).append((label, base))
    for key, labels in kept.items():
        automaton.add_word(key, (len(key), labels))
    # the words of a tag; what stands before it may be joined to it
    automaton.add_word(_TAG_WORDS, (0, []))
    automaton.make_automaton()
    return automaton


def _expressions(raw: bytes, ends: list[int]) -> list[str]:
    """The rest of the line behind each tag; `ends` are the numbers of the words that may end one."""
    word = np.frombuffer(raw.translate(bytes(_WORD)), np.uint8) != 32
    after = np.flatnonzero(word & ~np.append(word[1:], False)) + 1
    found = []
    for at in after[ends].tolist():
        begin = at + 1 - len(_TAG)
        if begin >= 0 and raw[begin : at + 1].lower() == _TAG:
            stop = min((p for p in (raw.find(b"\n", at), raw.find(b"\r", at)) if p >= 0), default=len(raw))
            found.append(raw[at + 1 : stop].decode().strip())
    return found


def scan_text(text: str | None, phrases: tuple[tuple[str, str, bool], ...]) -> dict:
    """All places of the phrases in one text, its tags, and the labels of both."""
    words = [w for w in words_of(text or "") if w]
    joined = " " + b" ".join(words).decode("latin-1") + " "
    matches = list(_automaton(phrases).iter(joined)) if words else []
    hits = [(end - size + 1, label, base) for end, (size, labels) in matches for label, base in labels]
    tag_ends = [end for end, (size, _) in matches if not size]
    gaps = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 32) if matches else []
    places = np.searchsorted(gaps, [h[0] for h in hits]) if hits else []
    base = [(int(p), label) for p, (_, label, is_base) in zip(places, hits, strict=True) if is_base]
    read = _expressions(text.encode(), [int(n) - 1 for n in np.searchsorted(gaps, tag_ends)]) if tag_ends else []
    tags = [(expression, evaluate(expression)) for expression in read]
    tagged = {label for _, found in tags if found for label in found[0]}
    own = {label for _, label, is_base in hits if not is_base} | tagged
    base_labels = {label for _, label in base}
    doubt = 0.4 ** len(base_labels) * 0.5 ** len(own - tagged - base_labels) * 0.1 ** min(len(tagged), 3)
    return {
        "n_words": len(words), "n_base": len(base), "first_word": min((p for p, _ in base), default=None),
        "last_word": max((p for p, _ in base), default=None), "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(base_labels | own)), "score": 1.0 - doubt,
        "expressions": [expression for expression, found in tags if found],
        "permissive": reduce(_both, [found[1] for _, found in tags if found]) if any(found for _, found in tags) else None,
    }


SCHEMA = pa.schema([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("expressions", pa.list_(pa.string())), ("permissive", pa.bool_()),
])


def scan_licenses(
    docs: DataFrame, base: dict[str, str], key: str = "doc_id", text: str = "text", notices: dict[str, str] | None = None
) -> DataFrame:
    """License evidence of every document, from its whole text; map-only.

    `base` and `notices` map phrases to labels: a phrase counts where its words stand one after the other.
    `base` phrases are reported with their places (words counted from 0). `notices` (default `NOTICES`) and
    `SPDX-License-Identifier` tags, whose expressions are parsed, add labels. `score` rises with the kinds of
    evidence found, 0 without any; `permissive` says whether all tags allow permissive use (null: no tag, or a licence
    that is not known leaves it open). The tags' words are found with the phrases, in the same pass.

    A null text counts as empty: no words, null places, empty labels, score 0. Null keys and repeated rows
    stay; other columns are not read.
    """
    more = NOTICES if notices is None else notices
    phrases = (*((p, v, True) for p, v in base.items()), *((p, v, False) for p, v in more.items()))
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                rows = [scan_text(t.as_py(), phrases) for t in part.column(text)]
                found = pa.RecordBatch.from_pylist(rows, SCHEMA)
                yield pa.RecordBatch.from_arrays([part.column(key), *found.columns], names=[key, *SCHEMA.names])

    schema = (
        f"{key} {key_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, expressions array<string>, permissive boolean"
    )
    return docs.select(key, text).mapInArrow(run, schema)
