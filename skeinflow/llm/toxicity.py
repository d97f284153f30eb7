"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are presence bits of one- and two-word runs and of word pairs with one word between, hashed
to 2**BITS places.  Training goes through the sample document by document with a learning rate of
its own for each coordinate; L1 leaves few non-zero weights, which are the only thing that is sent to the
executors.  Scoring looks all places up at once and counts each place once per document.
"""

from __future__ import annotations

import hashlib
import mmap
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, blocks, flat, hash_spans, mix, remove, table, written
from .labelled import fold, sample

BITS = 20
#: Most labelled documents that the driver fits from.
FIT_ROWS = 12_000
#: Bytes of their places that the driver fetches at once.
FETCH_BYTES = 8 << 20
#: Passes over the sample, and the strength of L1 at every sample size.  A place that a single toxic document has
#: gathers at most 4 a pass (see ``fit``), 20 in all, and so keeps no weight: what is learnt recurs in documents.
PASSES, L1 = 5, 24.0
#: Share of non-toxic weight at which a document is called toxic.
THRESHOLD = 0.5

_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def places(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed places of all n-grams and skip-grams, with their rows (repeats stay).

    Words are runs of letters and digits (A-Z lower-cased; every non-ASCII character is a letter).
    """
    data, ends = flat(texts)
    data = _LOWER[data]
    inside = np.concatenate([[False], _LETTER[data], [False]])
    step = np.diff(inside.view(np.int8))
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    cut = np.unique(ends[1:-1])
    cut = cut[(cut > 0) & (cut < len(data))]
    cut = cut[inside[cut] & inside[cut + 1]] if len(cut) else cut
    start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
    if not len(start):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    row = np.searchsorted(ends, start, "right") - 1
    w = hash_spans(data, start, end)
    shift = U64(64 - bits)
    out, rows = [w >> shift], [row]
    for gap, seed in ((1, 0x8CB92BA72F3D8DD7), (2, 0xA24BAED4963EE407)):
        if len(w) > gap:
            same = row[gap:] == row[:-gap]
            out.append(mix(w[:-gap] * U64(seed) + w[gap:])[same] >> shift)
            rows.append(row[gap:][same])
    return np.concatenate(out).astype(np.int32), np.concatenate(rows)


def unique_places(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct places, row by row, and their counts."""
    place, row = places(texts, bits)
    key = np.unique(row << bits | place)
    return (key & ((1 << bits) - 1)).astype(np.int32), np.bincount(key >> bits, minlength=len(texts))


@dataclass(frozen=True)
class Weights:
    """Non-zero weights by place, and the bias."""

    place: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int = BITS
    #: Labelled rows that they were learnt from.
    rows: int = 0

    def score(self, texts: pa.Array) -> np.ndarray:
        """Chance of label 1 of each row; a text without words has the bias alone."""
        dense = np.zeros(1 << self.bits, np.float32)
        dense[self.place] = self.weight
        place, row = places(texts, self.bits)
        some = dense[place] != 0
        key = np.unique(row[some] << self.bits | place[some])
        total = np.bincount(key >> self.bits, dense[key & ((1 << self.bits) - 1)], len(texts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def fit(rows: list[np.ndarray], y: np.ndarray, *, bits: int = BITS, alpha: float = 1.0, beta: float = 1.0, l1: float = L1, l2: float = 1.0, passes: int = PASSES, seed: int = 7) -> Weights:
    """FTRL-proximal; ``rows`` are the distinct places of each document.  No rows: a score of one half."""
    size = 1 << bits
    z, n = np.zeros(size), np.zeros(size)
    bz = bn = bias = 0.0
    rng = np.random.default_rng(seed)
    # the log-loss of the rarer label counts as much as that of the other
    share = np.clip(y.mean() if len(y) else 0.5, 0.02, 0.98)
    weight_of = {0: 1.0, 1: float(min(4.0, (1 - share) / share))}

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(passes):
        for k in rng.permutation(len(rows)):
            i = rows[k]
            w = weights(i)
            bias = -bz / ((beta + np.sqrt(bn)) / alpha)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -50, 50)))
            g = (p - y[k]) * weight_of[int(y[k])]
            root = np.sqrt(n[i])
            z[i] += g - (np.sqrt(n[i] + g * g) - root) / alpha * w
            n[i] += g * g
            bz += g - (np.sqrt(bn + g * g) - np.sqrt(bn)) / alpha * bias
            bn += g * g
    touched = np.flatnonzero(np.abs(z) > l1)
    return Weights(touched.astype(np.int32), weights(touched).astype(np.float32), float(-bz / ((beta + np.sqrt(bn)) / alpha)), bits, len(rows))


def _fetched(found: DataFrame, file: BinaryIO) -> tuple[list[np.ndarray], np.ndarray]:
    """The rows' places, as views of ``file`` mapped to memory, and their labels, in an order that only they decide.

    The driver fetches about ``FETCH_BYTES`` at once; what it has read lies in ``file``, so texts of any length fit.
    """
    total = found.agg(F.sum(F.octet_length("places"))).first()[0] or 0
    ends, y = [0], []
    for r in found.repartition(max(1, -(-total // FETCH_BYTES))).toLocalIterator():
        file.write(r["places"])
        ends.append(ends[-1] + len(r["places"]) // 4)
        y.append(r["y"])
    file.flush()
    data = np.frombuffer(mmap.mmap(file.fileno(), 4 * ends[-1], access=mmap.ACCESS_READ), np.int32) if ends[-1] else np.zeros(0, np.int32)
    rows = [data[a:b] for a, b in pairwise(ends)]
    order = sorted(range(len(rows)), key=lambda k: (len(rows[k]), rows[k][:8].tolist(), y[k], hashlib.blake2b(rows[k], digest_size=16).digest()))
    return [rows[k] for k in order], np.array([y[k] for k in order], np.int32)


def fit_from(labelled: DataFrame, limit: int = FIT_ROWS) -> Weights:
    """Fit from (text, y); texts become places on the executors, and the model learns from at most ``limit`` rows.

    Their bytes are bounded by the sample (see ``labelled``); the driver holds them in a temporary file, never at once
    in its memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in blocks(texts):
                place, counts = unique_places(texts.slice(a, b - a))
                off = np.concatenate([[0], 4 * np.cumsum(counts)]).astype(np.int32)
                packed = pa.BinaryArray.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(off), pa.py_buffer(place)])
                yield pa.RecordBatch.from_arrays([packed, batch.column("y").slice(a, b - a)], ["places", "y"])

    found, path = written(labelled.mapInArrow(run, "places binary, y int"), "places")
    with tempfile.TemporaryFile() as file:
        rows, y = _fetched(found, file)
    remove(labelled.sparkSession, path)
    return fit(rows[:limit], y[:limit])


def scored(docs: DataFrame, weights: Weights, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with the score.  Null and empty texts are scored as empty.

    A column called like the score is replaced.
    """
    docs = docs.drop(score_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col)
            got = [sent.value.score(texts.slice(a, b - a)) for a, b in blocks(texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([*got, np.zeros(0)]))], [*batch.schema.names, score_col])

    return docs.mapInArrow(run, schema)


def op9_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored; labels of the fold with remainder 0 of 5 are never learnt."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = fit_from(sample(docs, table(spark, sf_dir, "labels"), "toxic", FIT_ROWS, folds=5, held=0))
    out = scored(docs, weights).withColumn("held_out", fold("doc_id", 5) == 0)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
