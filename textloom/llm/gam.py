"""Quality classifier: a generalised additive model with pairwise interactions over text statistics.

Features are binned; cyclic boosting of shallow trees, one feature at a time, adds up to one lookup table per
feature. The strongest pairs then get two-dimensional tables on what is left. A score is a sum of table cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.arrays import SPACE, chunks, prefix_hash, shingle_hashes, span_hash, word_spans
from textloom.session import materialised

#: Default bound of the labelled rows that the tables are learnt from.
FIT_ROWS = 50_000

FEATURES = [
    "log_bytes", "log_words", "word_length", "symbols", "digits", "upper", "letters", "wide", "spaces",
    "distinct_words", "distinct_shingles", "distinct_lines", "line_length", "wordless", "marked_words",
    "sentence_marks", "top_symbol",
]

_KIND = np.zeros((6, 256), bool)
_KIND[0, [c for c in range(33, 127) if not chr(c).isalnum()]] = True
_KIND[1, range(48, 58)] = True
_KIND[2, range(65, 91)] = True
_KIND[3, [*range(65, 91), *range(97, 123)]] = True
_KIND[4, range(128, 256)] = True
_KIND[5] = SPACE
_LINE = np.zeros(256, bool)
_LINE[10] = True
_SENTENCE = np.zeros(256, bool)
_SENTENCE[[33, 46, 63]] = True


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags are set in each row."""
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])[bounds]).astype(float)


def _distinct(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Share of distinct values in each row; 1 for a row without any."""
    out = np.ones(len(bounds) - 1)
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if b > a:
            ordered = np.sort(values[a:b])
            out[i] = (1 + np.count_nonzero(ordered[1:] != ordered[:-1])) / (b - a)
    return out


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of statistics per text, of the whole text. An empty text has zeros and full distinct shares."""
    size = np.diff(offsets).astype(float)
    per_byte = np.maximum(size, 1)
    running = prefix_hash(data)
    starts, ends, first = word_spans(SPACE[data], offsets)
    words = np.diff(first).astype(float)
    line_starts, line_ends, line_first = word_spans(_LINE[data], offsets)
    shingles, shingle_first = shingle_hashes(data, offsets, 3)
    kinds = [_per_row(k[data], offsets) for k in _KIND]
    letters = np.concatenate([[0], np.cumsum((_KIND[3] | _KIND[4])[data], dtype=np.int32)])
    wordless = letters[ends] == letters[starts]
    marked = _KIND[0][data[ends - 1]] if len(ends) else np.zeros(0, bool)
    symbols = np.flatnonzero(_KIND[0][data])
    row = np.searchsorted(offsets, symbols, "right") - 1
    top = np.bincount(row * 128 + data[symbols], minlength=len(size) * 128).reshape(len(size), 128).max(1)
    return np.column_stack([
        np.log1p(size), np.log1p(words), _per_row_sum(ends - starts, first) / np.maximum(words, 1),
        *[kinds[i] / per_byte for i in (0, 1, 2, 3, 4, 5)],
        _distinct(span_hash(running, starts, ends), first), _distinct(shingles, shingle_first),
        _distinct(span_hash(running, line_starts, line_ends), line_first),
        np.log1p(size / np.maximum(np.diff(line_first), 1)),
        _per_row(wordless, first) / np.maximum(words, 1), _per_row(marked, first) / np.maximum(words, 1),
        _per_row(_SENTENCE[data], offsets) / np.maximum(words, 1), top / per_byte,
    ])


def _per_row_sum(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values)])[bounds]).astype(float)


def _gain(grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    return grad**2 / (hess + 1.0)


def _shallow_tree(grad: np.ndarray, hess: np.ndarray, splits: int = 2) -> np.ndarray:
    """Values per bin of a tree with at most `splits` splits on one feature (Newton steps in the leaves)."""
    cuts = [0, len(grad)]
    for _ in range(splits):
        best = (1e-9, None)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            left_g, left_h = np.cumsum(grad[a:b])[:-1], np.cumsum(hess[a:b])[:-1]
            if len(left_g):
                all_g, all_h = grad[a:b].sum(), hess[a:b].sum()
                gains = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
                at = int(gains.argmax())
                best = max(best, (gains[at], a + at + 1), key=lambda x: x[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(grad))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out[a:b] = grad[a:b].sum() / (hess[a:b].sum() + 1.0)
    return out


def _pair_tree(grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of a tree that splits a two-feature grid once along its rows and each half along its columns."""
    gains = []
    for at in range(1, grad.shape[0]):
        total = 0.0
        for g, h in ((grad[:at].sum(0), hess[:at].sum(0)), (grad[at:].sum(0), hess[at:].sum(0))):
            left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
            total += (_gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h)).max()
        gains.append(total)
    if not gains or grad.shape[1] < 2:
        return np.zeros_like(grad), 0.0
    at = int(np.argmax(gains)) + 1
    out = np.zeros_like(grad)
    out[:at] = _shallow_tree(grad[:at].sum(0), hess[:at].sum(0), 1)
    out[at:] = _shallow_tree(grad[at:].sum(0), hess[at:].sum(0), 1)
    return out, gains[at - 1] - _gain(grad.sum(), hess.sum())


@dataclass
class AdditiveModel:
    """Cut points and one table per feature, coarser cut points and one table per pair, and the base score."""

    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row of features."""
        total = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[j], x[:, j], "right")]
        for (a, b), table in self.pairs.items():
            at = [np.searchsorted(self.pair_cuts[j], x[:, j], "right") for j in (a, b)]
            total += table[at[0], at[1]]
        return 1.0 / (1.0 + np.exp(-total))


def _quantile_cuts(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.arange(1, bins) / bins)) for c in x.T]


def fit_additive(
    x: np.ndarray, y: np.ndarray, bins: int = 48, pair_bins: int = 12, rounds: int = 150, pairs: int = 8, rate: float = 0.1
) -> AdditiveModel:
    """Learn the tables from a bounded sample. With labels of one kind the score is the smoothed share."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    model = AdditiveModel(float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return model
    model.cuts, model.pair_cuts = _quantile_cuts(x, bins), _quantile_cuts(x, pair_bins)
    at = [np.searchsorted(c, col, "right") for c, col in zip(model.cuts, x.T, strict=True)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    total = np.full(len(y), model.base)

    def slopes(cell: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-total))
        return np.bincount(cell, y - p, cells), np.bincount(cell, p * (1 - p), cells)

    for _ in range(rounds):
        for j, table in enumerate(model.tables):  # cyclic: every feature in turn, a small step each
            step = rate * _shallow_tree(*slopes(at[j], len(table)))
            table += step
            total += step[at[j]]
    coarse = [np.searchsorted(c, col, "right") for c, col in zip(model.pair_cuts, x.T, strict=True)]
    widths = [len(c) + 1 for c in model.pair_cuts]
    grids = {}
    for a in range(x.shape[1]):
        for b in range(a + 1, x.shape[1]):
            cell, shape = coarse[a] * widths[b] + coarse[b], (widths[a], widths[b])
            g, h = (s.reshape(shape) for s in slopes(cell, widths[a] * widths[b]))
            grids[a, b] = (_pair_tree(g, h)[1], cell, shape)
    strongest = sorted(grids, key=lambda k: (-grids[k][0], k))[:pairs]
    model.pairs = {k: np.zeros(grids[k][2]) for k in strongest}
    for _ in range(rounds // 3):
        for k in strongest:
            _, cell, shape = grids[k]
            g, h = (s.reshape(shape) for s in slopes(cell, shape[0] * shape[1]))
            step = rate * _pair_tree(g, h)[0]
            model.pairs[k] += step
            total += step.ravel()[cell]
    return model


def feature_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key` and the array `features` of every row, map-only. A null text counts as empty; a null key stays."""
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, features array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches, text):
            x = text_features(data, offsets)
            rows = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(key), rows], names=[key, "features"])

    return docs.select(key, text).mapInArrow(run, schema)


def train_quality(features: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", fit_rows: int = FIT_ROWS) -> AdditiveModel:
    """Fit on the rows of `labels` (0 or 1; others are left out), at most about `fit_rows` chosen by a hash of `key`.

    The sample is the only thing that reaches the driver. The same rows give the same model. Labels that are
    repeated count once, and of several rows with a chosen key the one with the least features is taken, so
    repeated keys do not enlarge the sample.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(key, F.col(label).cast("double").alias("_y")).distinct()
    n = known.count()
    chosen = known.filter(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < int(min(1.0, fit_rows / max(n, 1)) * (1 << 20)))
    one = features.join(chosen, key).groupBy(key, "_y").agg(F.min("features").alias("features"))
    rows = one.toPandas().sort_values([key, "_y"])
    x = np.array(rows["features"].tolist(), float).reshape(len(rows), len(FEATURES))
    return fit_additive(x, rows["_y"].to_numpy(float))


def score_quality(features: DataFrame, model: AdditiveModel, key: str = "doc_id") -> DataFrame:
    """`key` and `score` (0 to 1) of every row of a feature table."""
    schema = f"{key} {features.schema[key].dataType.simpleString()}, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("features").flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(model.score(x))], names=[key, "score"])

    return features.mapInArrow(run, schema)


def keep_quality(docs: DataFrame, model: AdditiveModel, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, whose whole text scores at least `threshold`; map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, text):
            yield rows.filter(pa.array(model.score(text_features(data, offsets)) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def quality_scores(
    docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS
) -> DataFrame:
    """`key` and `score` of every document, by a model learnt from `labels` (columns `key` and `label`).

    Features come from the whole text alone. Empty and null texts are scored like any other; repeated rows
    stay; an empty table gives an empty result; other columns are not read. Without labels, or with labels of
    one kind, every score is the smoothed share of label 1.
    """
    features = materialised(feature_table(docs, key, text), "quality-features")
    return score_quality(features, train_quality(features, labels, label, key, fit_rows), key)
