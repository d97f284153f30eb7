"""Best-fit packing of token sequences by length patterns fitted with non-negative least squares.

Only the histogram of piece lengths (at most ``capacity`` numbers) reaches the driver.  There,
patterns of up to three lengths that fill a sequence exactly get repeat counts by non-negative least
squares, the counts are rounded within what the histogram holds, and the residual lengths are packed
best-fit decreasing.  The plan is a list of (pattern, repeats), so pieces find their place by their
rank among the pieces of their length: ranks come from counts per written part, never from one
sorted group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import byte_bpe
from .common import blocks, doc_text, remove, table, written

CAPACITY = 1024
END_ID = 2

PIECE = "part int, row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def patterns(capacity: int, present: np.ndarray) -> np.ndarray:
    """All patterns of one to three present lengths that sum to ``capacity``; absent places are 0."""
    ok = np.zeros(capacity + 1, bool)
    ok[present] = True
    out = [np.array([[capacity, 0, 0]])] if ok[capacity] else []
    a = np.arange(1, capacity // 2 + 1)
    pair = a[ok[a] & ok[capacity - a]]
    out.append(np.stack([capacity - pair, pair, 0 * pair], 1))
    for c in range(1, capacity // 3 + 1):
        if ok[c]:
            b = np.arange(c, (capacity - c) // 2 + 1)
            b = b[ok[b] & ok[capacity - c - b]]
            out.append(np.stack([capacity - c - b, b, np.full_like(b, c)], 1))
    return np.concatenate(out) if out else np.zeros((0, 3), int)


def fit(hist: np.ndarray, pats: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative x that minimises the squared difference of the patterns' lengths from ``hist``.

    Accelerated projected gradient; longer lengths weigh more, as what is left of them is harder to fill.
    """
    if not len(pats):
        return np.zeros(0)
    width = len(hist)
    weight = np.sqrt(np.arange(width) / (width - 1))
    weight[0] = 0
    used = [pats[:, k] for k in range(pats.shape[1])]
    target = weight * hist

    def forward(x: np.ndarray) -> np.ndarray:
        return weight * sum(np.bincount(u, x, width) for u in used)

    def back(r: np.ndarray) -> np.ndarray:
        wr = weight * r
        return sum(wr[u] for u in used)

    v = np.ones(len(pats))
    for _ in range(12):
        v = back(forward(v))
        norm = np.linalg.norm(v)
        v /= norm
    step, x = 1 / (1.05 * norm), np.zeros(len(pats))
    y, t = x, 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * back(forward(y) - target))
        if np.dot(y - new, new - x) > 0:
            t = 1.0
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / nt * (new - x), new, nt
    return x


def plan(hist: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how often each is used; together they use the histogram exactly.

    ``hist[n]`` is the count of pieces of length n, up to ``capacity``.
    """
    left = np.asarray(hist, np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        out.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    pats = patterns(capacity, np.flatnonzero(left))
    x = fit(left.astype(float), pats)
    # rounding by carry: the whole counts follow the fitted ones along the pattern order
    carried = np.floor(np.cumsum(x) + 0.5)
    counts = np.diff(np.concatenate([[0], carried])).astype(np.int64)
    for k in np.lexsort((-pats[:, 0], -x)) if len(pats) else []:
        if counts[k]:
            lengths, need = np.unique(pats[k][pats[k] > 0], return_counts=True)
            n = int(min(counts[k], (left[lengths] // need).min()))
            if n:
                left[lengths] -= n * need
                out.append((tuple(int(v) for v in pats[k] if v), n))
    return out + best_fit(left, capacity)


def best_fit(hist: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: equal open sequences are held as one entry with a count."""
    spaces: dict[int, dict[tuple[int, ...], int]] = {}
    for length in np.flatnonzero(hist)[::-1].tolist():
        todo = int(hist[length])
        while todo:
            room = min((r for r in spaces if r >= length), default=None)
            if room is None:
                per = min(capacity // length, todo)
                n = todo // per
                made = spaces.setdefault(capacity - per * length, {})
                made[(length,) * per] = made.get((length,) * per, 0) + n
                todo -= n * per
                continue
            pattern, n = next(iter(spaces[room].items()))
            per = min(room // length, todo)
            use = min(n, todo // per)
            if use == n:
                del spaces[room][pattern]
                if not spaces[room]:
                    del spaces[room]
            else:
                spaces[room][pattern] = n - use
            made = spaces.setdefault(room - per * length, {})
            new = pattern + (length,) * per
            made[new] = made.get(new, 0) + use
            todo -= use * per
    return [(p, n) for entries in spaces.values() for p, n in entries.items()]


class Places:
    """The plan by length: where the piece of a length and a rank goes.  Bounded by the plan's slots."""

    def __init__(self, chosen: list[tuple[tuple[int, ...], int]]):
        rows, sequence = [], 0
        for pattern, n in chosen:
            offset = 0
            for length in pattern:
                rows.append((length, n, sequence, offset))
                offset += length
            sequence += n
        self.sequences = sequence
        rows.sort(key=lambda r: r[0])
        table = np.array(rows, np.int64).reshape(-1, 4)
        lengths, n, self.base, self.offset = table.T
        ends = np.cumsum(n)
        before = ends - n
        first = np.searchsorted(lengths, lengths)
        self.low = before - before[first] if len(n) else before  # rank within the length
        self.lengths = lengths
        # one sorted key over (length, rank)
        self.shift = 40
        self.keys = lengths << self.shift | self.low

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.keys, length << self.shift | rank, "right") - 1
        return self.base[k] + rank - self.low[k], self.offset[k]


def pieces_of(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, piece number, start and length of the pieces; a longer row's first piece takes the remainder."""
    n = -(-counts // capacity)
    row = np.repeat(np.arange(len(counts)), n)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    first = counts - (n - 1) * capacity
    start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
    length = np.where(piece == 0, first[row], capacity)
    return row, piece, start, length


def tokenized_pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece, with ids when asked.  A null or empty text is the end id alone."""
    tokenizer = tokenizer or byte_bpe.default_path()
    schema = PIECE + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, done = TaskContext.get().partitionId(), 0
        encode = byte_bpe.encoder(tokenizer).encode
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id")
            for a, b in blocks(texts, byte_bpe.BLOCK_BYTES):
                ids, counts = encode(texts.slice(a, b - a))
                ids, counts = np.insert(ids, np.cumsum(counts), end_id).astype("<u4"), counts + 1
                row, piece, start, length = pieces_of(counts, capacity)
                at = (np.cumsum(counts) - counts)[row] + start
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(at.tolist(), (at + length).tolist(), strict=True)]
                m = len(row)
                cols = [np.full(m, part, np.int32), done + np.arange(m), piece.astype(np.int32), start, length]
                cols = [pa.array(c) for c in cols] + [pa.array(crc, pa.int64())]
                cols.insert(2, doc_ids.take(pa.array(a + row)))  # as Arrow: a null id stays null, a large one exact
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.array(ids.view("<i4"))))
                done += m
                yield pa.RecordBatch.from_arrays(cols, [f.split()[0] for f in schema.split(", ")])

    return doc_text(docs, id_col, text_col).mapInArrow(cut, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to a written table of pieces (part, row, length and any others).

    ``pieces`` must be stored: ranks are counted by its ``part``.  An empty table packs into nothing.
    """
    counts = pieces.groupBy("part", "length").count()
    hist = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("count").alias("n")).toLocalIterator():  # at most capacity rows
        hist[r["length"]] = r["n"]
    places = Places(plan(hist, capacity))
    before = counts.withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    first = before.select("part", "length", F.coalesce("before", F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("part", "length").orderBy("row")) - 1
    ranked = pieces.withColumn("rank", own).join(first, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before")).drop("before")
    schema = T.StructType([*ranked.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            sequence, offset = places.of(length, rank)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)], [*batch.schema.names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenize, cut what is longer than ``capacity`` and pack: one row per piece.

    A null or empty text is one piece of the end id.  Repeated rows are packed each.  Columns beside
    id and text are not read.  The pieces are written to the shared folder once, so that ranks do not
    change when a task runs again.
    """
    pieces, path = written(tokenized_pieces(docs, id_col=id_col, text_col=text_col, tokenizer=tokenizer, end_id=end_id, capacity=capacity, with_ids=with_ids), "pieces")
    packed, _ = written(pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else [])), "packed")
    remove(docs.sparkSession, path)
    return packed


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))
