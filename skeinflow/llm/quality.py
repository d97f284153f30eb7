"""Quality by a generalised additive model with pairwise interactions.

Some twenty counts of a text's bytes, words and lines are binned.  Cyclic boosting goes round the
features, each time fitting a shallow tree on one feature's gradient histogram and adding it to
that feature's lookup table; then round the strongest pairs, on coarser two-way tables.  A score is a
sum of table entries, taken for many documents at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks, flat, hash_spans, table
from .labelled import fold, sample

#: Most labelled documents that the driver fits from.
FIT_ROWS = 20_000
THRESHOLD = 0.7
BINS = 48
PAIR_BINS = 8

FEATURES = (
    "log_bytes", "log_words", "log_lines", "word_bytes", "upper", "digits", "exclaim", "marks", "pipes",
    "stops", "commas", "other_punctuation", "non_ascii", "spaces", "distinct_words", "distinct_lines",
    "line_bytes", "upper_words", "marked_words", "runs",
)

_UPPER, _LOWER, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = True
_HIGH = np.arange(256) >= 128
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "#$%&*@^~=+<>\\/_{}[]"]] = True
_OTHER = np.zeros(256, bool)
_OTHER[[ord(c) for c in "()\"':;?`-"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def features(texts: pa.Array) -> np.ndarray:
    """(rows, features); null and empty texts are all zero."""
    data, ends = flat(texts)
    n, size = len(texts), np.diff(ends)
    out = np.zeros((n, len(FEATURES)))
    if not len(data):
        return out

    def per_row(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[ends[1:]] - sums[ends[:-1]]

    def pieces(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        step = np.diff(np.concatenate([[False], inside, [False]]).view(np.int8))
        start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        cut = np.unique(ends[1:-1])
        cut = cut[(cut > 0) & (cut < len(data))]
        cut = cut[inside[cut - 1] & inside[cut]]
        start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
        return start, end, np.searchsorted(ends, start, "right") - 1

    def distinct(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
        order = np.lexsort((keys, row))
        k, r = keys[order], row[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
        return np.bincount(r[new], minlength=n)

    start, end, row = pieces(~_SPACE[data])
    words = np.bincount(row, minlength=n)
    l_start, l_end, l_row = pieces(data != 10)
    lines = np.bincount(l_row, minlength=n)
    upper = np.concatenate([[0], np.cumsum(_UPPER[data], dtype=np.int64)])
    marks = np.concatenate([[0], np.cumsum(_MARK[data] | (data == 33), dtype=np.int64)])
    shouted = np.bincount(row[(upper[end] - upper[start]) >= np.maximum(2, (end - start) // 2)], minlength=n)
    marked = np.bincount(row[marks[end] - marks[start] >= 2], minlength=n)
    same = np.zeros(len(data), bool)
    same[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & ~_SPACE[data[2:]]
    b, w, ln = np.maximum(size, 1), np.maximum(words, 1), np.maximum(lines, 1)
    letters = np.maximum(per_row(_UPPER[data] | _LOWER[data] | _HIGH[data]), 1)
    columns = (
        np.log1p(size), np.log1p(words), np.log1p(lines), per_row(~_SPACE[data]) / w, per_row(_UPPER[data]) / letters, per_row(_DIGIT[data]) / b,
        per_row(data == 33) / w, per_row(_MARK[data]) / w, per_row(data == 124) / w, per_row(data == 46) / w, per_row(data == 44) / w, per_row(_OTHER[data]) / w,
        per_row(_HIGH[data]) / b, per_row(_SPACE[data]) / b, distinct(hash_spans(data, start, end), row) / w, distinct(hash_spans(data, l_start, l_end), l_row) / ln,
        size / ln, shouted / w, marked / w, per_row(same) / b,
    )
    for k, c in enumerate(columns):
        out[:, k] = c
    return out


@dataclass
class Additive:
    """Lookup tables of the features and of pairs of features."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0
    #: Labelled rows that it learnt from.
    rows: int = 0

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for k, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += t[np.searchsorted(e, x[:, k], "right")]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            total += t[np.searchsorted(self.pair_edges[i], x[:, i], "right"), np.searchsorted(self.pair_edges[j], x[:, j], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def _edges(v: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(v, np.arange(1, bins) / bins)) if len(v) else np.zeros(0)


def _split(g: np.ndarray, h: np.ndarray, least: float, reg: float) -> tuple[float, int]:
    """Best cut of a histogram: its gain and place (0: none)."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl * gl / (hl + reg) + gr * gr / (hr + reg) - g.sum() ** 2 / (h.sum() + reg)
    gain = np.where((hl >= least) & (hr >= least), gain, 0)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1 if gain[k] > 1e-9 else 0


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, least: float, reg: float) -> np.ndarray:
    """Piecewise constant update of a feature's table with at most ``leaves`` pieces."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        found = [(*_split(g[a:b], h[a:b], least, reg), a, b) for a, b in parts]
        gain, cut, a, b = max(found, key=lambda f: f[0])
        if not cut:
            break
        parts.remove((a, b))
        parts += [(a, a + cut), (a + cut, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + reg)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, least: float, reg: float) -> tuple[np.ndarray, float]:
    """Two-level tree over a two-way table: a cut of one feature, then a cut of the other on each side."""
    best, out = 0.0, np.zeros_like(g)
    whole = g.sum() ** 2 / (h.sum() + reg)
    for flip in (False, True):
        gg, hh = (g.T, h.T) if flip else (g, h)
        for cut in range(1, len(gg)):
            value, update = -whole, np.zeros_like(gg)
            for a, b in ((0, cut), (cut, len(gg))):
                sg, sh = gg[a:b].sum(0), hh[a:b].sum(0)
                _, c = _split(sg, sh, least, reg)
                for p, q in ((0, c), (c, len(sg))) if c else ((0, len(sg)),):
                    s, t = sg[p:q].sum(), sh[p:q].sum()
                    value += s * s / (t + reg)
                    update[a:b, p:q] = -s / (t + reg)
            if value > best:
                best, out = value, update.T if flip else update
    return out, best


def fit(x: np.ndarray, y: np.ndarray, *, rounds: int = 120, pair_rounds: int = 30, pairs: int = 6, rate: float = 0.15, leaves: int = 4, least: float = 2.0, reg: float = 1.0) -> Additive:
    """Cyclic boosting of the features, then of the ``pairs`` pairs with the largest remaining gain."""
    k = x.shape[1]
    edges, coarse = ([_edges(x[:, j], b) for j in range(k)] for b in (BINS, PAIR_BINS))
    share = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
    model = Additive(edges, [np.zeros(len(e) + 1) for e in edges], coarse, base=float(np.log(share / (1 - share))), rows=len(y))
    if not len(y):
        return model
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    wide = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -50, 50)))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for j in range(k):
            g, h = slopes()
            m = len(model.tables[j])
            update = rate * _tree(np.bincount(bins[j], g, m), np.bincount(bins[j], h, m), leaves, least, reg)
            model.tables[j] += update
            total += update[bins[j]]
    g, h = slopes()
    gains = []
    for i in range(k):
        for j in range(i):
            shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
            cell = wide[i] * shape[1] + wide[j]
            gains.append((_pair_tree(*(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (g, h)), least, reg)[1], i, j))
    model.pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:pairs]]
    model.pair_tables = [np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for t, (i, j) in zip(model.pair_tables, model.pairs, strict=True):
            g, h = slopes()
            cell = wide[i] * t.shape[1] + wide[j]
            update = rate * _pair_tree(*(np.bincount(cell, v, t.size).reshape(t.shape) for v in (g, h)), least, reg)[0]
            t += update
            total += update.ravel()[cell]
    return model


def fit_from(labelled: DataFrame, limit: int = FIT_ROWS) -> Additive:
    """Fit from (text, y); features are computed on the executors, at most ``limit`` rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in blocks(texts):
                x = features(texts.slice(a, b - a))
                off = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(off), pa.array(x.ravel())), batch.column("y").slice(a, b - a)], ["x", "y"])

    got = labelled.mapInArrow(run, "x array<double>, y int").toArrow()
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    y = got.column("y").to_numpy().astype(float)
    order = np.lexsort((y, *x.T))[:limit]
    return fit(x[order], y[order])


def scored(docs: DataFrame, model: Additive, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with the score.  Null and empty texts are scored as empty.

    A column called like the score is replaced.
    """
    docs = docs.drop(score_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col)
            got = [sent.value.score(features(texts.slice(a, b - a))) for a, b in blocks(texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([*got, np.zeros(0)]))], [*batch.schema.names, score_col])

    return docs.mapInArrow(run, schema)


def op6_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored; labels of the fold with remainder 2 of 4 are never learnt."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_from(sample(docs, table(spark, sf_dir, "labels"), "quality", FIT_ROWS, folds=4, held=2))
    out = scored(docs, model).withColumn("held_out", fold("doc_id", 4) == 2)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
