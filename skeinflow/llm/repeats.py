"""Repeated byte strings by a run-length Burrows-Wheeler index, dealt by content anchors.

Every ``length``-byte window picks an anchor: the least-hashed ``gram`` bytes inside it.  Equal windows pick
equal anchors at equal offsets, so windows need only meet within their anchor.  The consecutive windows
of one anchor occurrence form a cell, whose context (the bytes they cover) is what is compared.

1. One pass over whole texts lists the cells: anchor, digest of the context, row key, place, windows.
2. Anchors that occur once are dropped.  Counting precedes the index: equal contexts are counted by partial
   aggregation, and two or more mean that every window of the cell repeats, whatever the size of the group.
3. For anchors with several different contexts, one copy of each context is cut from its text and
   goes to its anchor's task.  There a run-length Burrows-Wheeler transform of the contexts is built, suffix
   positions and common-prefix lengths are kept at the ends of its runs only, and matching statistics of
   every position are streamed from those samples: within a run, the match of a position is the match
   of the one before less one byte.  Windows whose longest match elsewhere is ``length`` bytes or
   more are marked.
   An anchor with more than ``BLOCK`` different contexts is split first: windows in the farther and in the nearer
   half of the places that the anchor may take each share a longer core around it, which replaces the
   anchor.  Equal windows have equal cores, so they still meet; contexts go to two halves at most, and at
   the last level the core is the window itself, so no group stays too large.
4. Marks return to all occurrences of their context and are merged into spans per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Tables, U64, blocks, flat, hash_spans, lanes, remove, rolling, table, written
from .near_dup import _grouped

LENGTH = 200
GRAM = 48
#: Different contexts of one anchor that one task holds.
BLOCK = 1024
#: Window starts that are worked on at once; a longer text is taken in segments, whose windows are the same.
SEGMENT = 4 << 20
#: Bytes of contexts in one index.
INDEX_BYTES = 1 << 20

_ROW, _KEY, _TEXT = "_row", "_row_key", "_row_text"
CELL = "anchor long, ctx long, key long, at int, windows int, off int"
CUT = "anchor long, ctx long, root_anchor long, root_ctx long, shift int, off int, windows int, different long, context binary"


def windows(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Cells of all rows: row, place in ``data``, windows, anchor and context hashes, place of the anchor in the cell."""
    if len(data) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    grams = rolling(data, gram)
    i = np.arange(len(grams))
    low = U64((1 << 28) - 1)
    best = (grams & ~low) | i.astype(U64)
    width, size = length - gram + 1, 1
    while size * 2 <= width:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    if size < width:
        best = np.minimum(best[: len(best) - (width - size)], best[width - size :])
    place = (best & low).astype(np.int64)
    s = np.arange(len(place))
    row = np.searchsorted(ends, s, "right") - 1
    ok = s + length <= ends[row + 1]
    s, place, row = s[ok], place[ok], row[ok]
    if not len(s):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.append(first[1:], len(s)) - 1
    ctx = hash_spans(data, s[first], s[last] + length).view(np.int64)
    return row[first], s[first], last - first + 1, grams[place[first]].view(np.int64), ctx, place[first] - s[first]


def suffix_array(text: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Suffix order of concatenated strings; ``stops`` are the places of their ends, each unlike all others.

    Prefix doubling from seven symbols; only groups of equal rank are sorted again.
    """
    n = len(text)
    sym = text.astype(np.int64) + 1
    sym[stops] = 0
    stop_of = np.searchsorted(stops, np.arange(n))
    gap = stops[stop_of] - np.arange(n)
    key = np.zeros(n, np.int64)
    padded = np.concatenate([sym, np.zeros(7, np.int64)])
    for k in range(7):
        key = key << 9 | np.where(gap > k, padded[k : k + n], 0)
    order = np.argsort(key, kind="stable")  # short tails: by place
    k = key[order]
    new = np.ones(n, bool)
    new[1:] = (k[1:] != k[:-1]) | (gap[order[1:]] < 7)
    del key, k, padded, sym
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h = 7
    while True:
        alone = new & np.append(new[1:], True)
        todo = np.flatnonzero(~alone)
        if not len(todo):
            return order
        at = order[todo]
        pair = rank[at] << 32 | rank[at + h]
        sub = np.argsort(pair, kind="stable")
        order[todo] = at[sub]
        pair = pair[sub]
        new[todo[1:]] |= pair[1:] != pair[:-1]
        rank[order[todo]] = np.maximum.accumulate(np.where(new[todo], todo, 0))
        h *= 2


class RunIndex:
    """Run-length Burrows-Wheeler transform with suffix positions and match lengths at run ends.

    ``strings`` lie one after another in ``text``, each followed by one byte at its place in ``stops``.
    """

    def __init__(self, text: np.ndarray, stops: np.ndarray):
        order = suffix_array(text, stops)
        before = text[order - 1].astype(np.int32)
        before[np.isin(order - 1, stops) | (order == 0)] = -1
        change = before[1:] != before[:-1]
        change |= before[1:] < 0  # ends of strings are all different
        heads = np.concatenate([[True], change])
        tails = np.concatenate([change, [True]])
        self.n, self.n_stops = len(text), len(stops)
        self.symbols = before[heads]
        self.lengths = np.diff(np.append(np.flatnonzero(heads), self.n))
        # samples at run ends: position, and match with the neighbour outside the run
        j = np.flatnonzero(heads)[1:]
        match = common(text, stops, order[j - 1], order[j])
        self.head_at, self.head_match = np.append(order[0], order[j]), np.append(0, match)
        self.tail_at, self.tail_match = np.append(order[j - 1], order[-1]), np.append(match, 0)
        assert tails.sum() == len(self.tail_at)

    def statistics(self) -> np.ndarray:
        """Longest match of each position with any other, streamed from the samples."""
        best = np.zeros(self.n, np.int64)
        for at, match in ((self.head_at, self.head_match), (self.tail_at, self.tail_match)):
            # within a run, the neighbour of the position before, moved by one, is the neighbour: one byte less
            value = np.zeros(self.n, np.int64)
            source = np.zeros(self.n, np.int64)
            source[at], value[at] = at, match
            source = np.maximum.accumulate(source)
            np.maximum(best, value[source] - (np.arange(self.n) - source), out=best)
        return best


    def count(self, pattern: bytes) -> int:
        """Occurrences of ``pattern``, by backward search over the runs."""
        low, high = 0, self.n
        ends = np.cumsum(self.lengths)
        for c in reversed(pattern):
            own = np.flatnonzero(self.symbols == c)
            upto = np.concatenate([[0], np.cumsum(self.lengths[own])])

            def rank(i: int) -> int:
                k = int(np.searchsorted(ends, i, "right"))  # the run of place i
                within = i - (int(ends[k - 1]) if k else 0)
                return int(upto[np.searchsorted(own, k)]) + (within if k < len(ends) and self.symbols[k] == c else 0)

            first = self.n_stops + int(self.lengths[(self.symbols >= 0) & (self.symbols < c)].sum())
            low, high = first + rank(low), first + rank(high)
            if low >= high:
                return 0
        return high - low


def common(text: np.ndarray, stops: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of the suffixes at x and y, compared eight bytes at a time.

    Not cut at the asked length: streaming takes off one byte a place, so samples must hold full lengths.
    """
    words = lanes(text)
    top = np.minimum(stops[np.searchsorted(stops, x)] - x, stops[np.searchsorted(stops, y)] - y)
    out = top.copy()
    live, done = np.flatnonzero(top > 0), 0
    while len(live):
        apart = words[x[live] + done] ^ words[y[live] + done]
        other = np.flatnonzero(apart)
        low = apart[other] & (~apart[other] + U64(1))  # its lowest bit tells the first byte that differs
        out[live[other]] = np.minimum(out[live[other]], done + np.bitwise_count(low - U64(1)).astype(np.int64) // 8)
        done += 8
        live = live[(apart == 0) & (top[live] > done)]
    return out


def row_cells(rows: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = batch.column(_TEXT), batch.column(_KEY).to_numpy(zero_copy_only=False)
            for a, b in blocks(texts):
                data, ends = flat(texts.slice(a, b - a))
                for p in range(0, max(1, len(data)), SEGMENT):  # only a very long text has several
                    q = min(len(data), p + SEGMENT + length - 1)
                    row, at, n, anchor, ctx, off = windows(data[p:q], np.clip(ends, p, q) - p, length, gram)
                    if not len(row):
                        continue
                    cols = [anchor, ctx, keys[a:b][row], (at + p - ends[row]).astype(np.int32), n.astype(np.int32), off.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["anchor", "ctx", "key", "at", "windows", "off"])

    return rows.select(_KEY, _TEXT).mapInArrow(run, CELL)


def cut_contexts(rows: DataFrame, length: int) -> DataFrame:
    """Rows with a list ``cut`` of (anchor, ctx, at, windows, off, different): one row per context with its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, cut in zip(batch.column(_TEXT), batch.column("cut"), strict=True):
                raw = memoryview((text.as_py() or "").encode())
                c = cut.values
                at, n = (c.field(k).to_numpy() for k in ("at", "windows"))
                got = [bytes(raw[a : a + w + length - 1]) for a, w in zip(at.tolist(), n.tolist(), strict=True)]
                anchor, ctx = c.field("anchor"), c.field("ctx")
                cols = [anchor, ctx, anchor, ctx, pa.array(np.zeros(len(at), np.int32)), c.field("off"), c.field("windows"), c.field("different"), pa.array(got, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, [f.split()[0] for f in CUT.split(", ")])

    return rows.select(_TEXT, "cut").mapInArrow(run, CUT)


def halves(contexts: DataFrame, length: int, spread: list[tuple[int, int]]) -> DataFrame:
    """The contexts' windows, dealt by how many bytes after their start the anchor lies.

    Each (low, high) of ``spread`` takes those with low .. high - 1; all of them share a core, whose hash becomes the
    anchor.  A row of ``contexts`` gives one row for each interval in which it has windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = flat(batch.column("context"))
            raw = data.tobytes()
            offs, n, shift = (batch.column(c).to_numpy().astype(np.int64) for c in ("off", "windows", "shift"))
            for low, high in spread:
                first, last = np.maximum(0, offs - (high - 1)), np.minimum(n - 1, offs - low)
                some = np.flatnonzero(first <= last)
                if not len(some):
                    continue
                first, last, off = first[some], last[some], offs[some]
                start, end = ends[some] + first, ends[some] + last + length
                at = ends[some] + off - low  # the core: from the start of the last window to the end of the first
                anchor = hash_spans(data, at, at + length - (high - 1 - low), low + 1).view(np.int64)
                ctx = hash_spans(data, start, end, high + 1).view(np.int64)
                got = [raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
                keep = pa.array(some)
                cols = [pa.array(anchor), pa.array(ctx), batch.column("root_anchor").take(keep), batch.column("root_ctx").take(keep), *(pa.array(v.astype(np.int32)) for v in (shift[some] + first, off - first, last - first + 1)), pa.array(np.zeros(len(some), np.int64)), pa.array(got, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, [f.split()[0] for f in CUT.split(", ")])

    return contexts.mapInArrow(run, CUT)


def marked_contexts(contexts: DataFrame, length: int) -> DataFrame:
    """(anchor, ctx, mask): windows of each context that occur elsewhere among its anchor's contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _grouped(batches, ["anchor"]):
            anchor = t.column("anchor").to_numpy()
            new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
            _, ends = flat(t.column("context").combine_chunks())
            a = 0
            starts = np.append(new, len(anchor))
            while a < len(new):  # whole groups up to the bytes of one index
                b = max(a + 1, int(np.searchsorted(ends[starts], ends[starts[a]] + INDEX_BYTES, "right")) - 1)
                yield _mark(t.slice(starts[a], starts[b] - starts[a]), length)
                a = b

    dealt = contexts.select("anchor", "ctx", "windows", "context").repartition("anchor").sortWithinPartitions("anchor", "ctx")
    return dealt.mapInArrow(run, "anchor long, ctx long, mask binary")


def _mark(t: pa.Table, length: int) -> pa.RecordBatch:
    data, ends = flat(t.column("context").combine_chunks())
    n = t.column("windows").to_numpy().astype(np.int64)
    count = len(n)
    text = np.insert(data, ends[1:], 0)
    start = ends[:-1] + np.arange(count)
    stops = ends[1:] + np.arange(count)
    hit = RunIndex(text, stops).statistics() >= length
    masks = [np.packbits(hit[a : a + w], bitorder="little").tobytes() for a, w in zip(start.tolist(), n.tolist(), strict=True)]
    some = np.array([any(m) for m in masks], bool)
    keep = pa.array(some)
    cols = [t.column("anchor").combine_chunks().filter(keep), t.column("ctx").combine_chunks().filter(keep), pa.array(masks, pa.binary()).filter(keep)]
    return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols], ["anchor", "ctx", "mask"])


def keyed_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each row as one struct (so no name can clash), its text and a key per (id, text); equal rows share the key."""
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(_ROW), F.xxhash64(F.col(f"`{id_col}`"), text).alias(_KEY), text.alias(_TEXT))


def repeated_windows(rows: DataFrame, *, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK) -> tuple[DataFrame, list[str]]:
    """(key, marks): for each keyed row with repeats, a list of (at, windows, mask), null mask: all.

    The second value: folders to remove after use.
    """
    spark, tables = rows.sparkSession, Tables(rows.sparkSession)
    cells, cells_at = written(row_cells(rows, length, gram), "cells")
    # written first: Spark splits a skewed join only between plain exchanges, not after an aggregate of its key
    often, often_at = written(cells.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "anchors")
    shared, n_shared = tables.keep(cells.join(often.hint("merge"), "anchor"), "shared")
    remove(spark, cells_at, often_at)
    each = shared.groupBy("anchor", "ctx").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "at")).alias("one"), F.first("windows").alias("windows"), F.first("off").alias("off"))
    each, n_each = tables.keep(each, "contexts", rows=n_shared)

    def several(contexts: DataFrame, n: int) -> DataFrame:
        return tables.keep(contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("different")).filter("different > 1"), "several", rows=n)[0]

    counted = several(each, n_each)
    cuts = each.join(counted.hint("merge"), "anchor").select(F.col("one.key").alias(_KEY), F.struct("anchor", "ctx", F.col("one.at").alias("at"), "windows", "off", "different").alias("c"))
    cuts = cuts.groupBy(_KEY).agg(F.collect_list("c").alias("cut"))
    one_each = rows.select(_KEY, _TEXT).join(cuts.hint("merge"), _KEY)
    contexts, n_cut = tables.keep(cut_contexts(one_each, length).dropDuplicates(["anchor", "ctx"]), "cut", rows=n_each)
    marked, _ = tables.keep(marked_contexts(contexts.filter(F.col("different") <= block), length), "marked")
    mask = ["anchor", "ctx", "shift", "windows", "mask"]
    none = F.lit(None).cast("binary").alias("mask")
    once = each.filter("n = 1").select("anchor", "ctx", F.lit(0).alias("shift"), "windows")
    found = each.filter("n > 1").select("anchor", "ctx", F.lit(0).alias("shift"), "windows", none).unionByName(marked.join(once, ["anchor", "ctx"]).select(mask))
    # anchors of too many contexts: halves of their windows by longer cores, until no group is too large
    hot, n = tables.keep(contexts.filter(F.col("different") > block), "hot", rows=n_cut)
    spread = [(0, length - gram + 1)]
    while n and any(b - a > 1 for a, b in spread):
        spread = [(x, y) for a, b in spread for x, y in ((a, (a + b) // 2), ((a + b) // 2, b)) if y > x]
        sub, n = tables.keep(halves(hot, length, spread), "halves", rows=2 * n)
        own = sub.groupBy("anchor", "ctx").agg(F.count(F.lit(1)).alias("n"), F.first("root_anchor").alias("root_anchor"), F.first("root_ctx").alias("root_ctx"), F.first("shift").alias("shift"), F.first("windows").alias("windows"))
        own, _ = tables.keep(own, "contexts", rows=n)
        root = [F.col("root_anchor").alias("anchor"), F.col("root_ctx").alias("ctx"), "shift", "windows"]
        found = found.unionByName(sub.join(own.filter("n > 1").select("anchor", "ctx").hint("merge"), ["anchor", "ctx"]).select(*root, none))
        counted = several(own, n)
        apart = sub.drop("different").join(counted.hint("merge"), "anchor").dropDuplicates(["anchor", "ctx"]).select(*[f.split()[0] for f in CUT.split(", ")])
        apart, n = tables.keep(apart, "cut", rows=n)
        marked, _ = tables.keep(marked_contexts(apart.filter(F.col("different") <= block), length), "marked", rows=n)
        found = found.unionByName(marked.join(own.filter("n = 1"), ["anchor", "ctx"]).select(*root, "mask"))
        hot, n = tables.keep(apart.filter(F.col("different") > block), "hot", rows=n)
    found = found.withColumnRenamed("windows", "marked")
    at = F.struct((F.col("at") + F.col("shift")).alias("at"), F.col("marked").alias("windows"), "mask")
    marks = shared.join(found.hint("merge"), ["anchor", "ctx"]).groupBy("key").agg(F.collect_list(at).alias("marks"))
    return marks.withColumnRenamed("key", _KEY), tables.paths


def removed_spans(marks: pa.StructArray | None, length: int) -> list[tuple[int, int]]:
    """Maximal byte spans [from, to) that the marked windows cover."""
    if marks is None or not len(marks):
        return []
    at, n = (marks.field(k).to_numpy() for k in ("at", "windows"))
    starts = []
    for a, w, mask in zip(at.tolist(), n.tolist(), marks.field("mask").to_pylist(), strict=True):
        own = np.arange(a, a + w)
        starts.append(own if mask is None else own[np.unpackbits(np.frombuffer(mask, np.uint8), count=w, bitorder="little").astype(bool)])
    s = np.unique(np.concatenate(starts))
    if not len(s):
        return []
    gap = np.flatnonzero(np.diff(s) > length)
    return list(zip(s[np.append(0, gap + 1)].tolist(), (s[np.append(gap, len(s) - 1)] + length).tolist(), strict=True))


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, block: int = BLOCK, clean_text: bool = True) -> DataFrame:
    """Every row of ``docs`` without the bytes that a repeated ``length``-byte string covers.

    clean_text: all columns, the text being replaced (characters that a span cuts go as a whole).
    Otherwise id, n_bytes, n_removed, n_spans and kept_sha256 of the exact bytes.  A null text is empty
    (with clean_text it stays null).  Equal rows count as different places, so both lose what they
    share.  Texts shorter than ``length`` never change.
    """
    spark = docs.sparkSession
    rows = keyed_rows(docs, id_col, text_col)
    found, paths = repeated_windows(rows, length=length, gram=gram, block=block)
    if clean_text:
        kept, fields = rows, [T.StructField(_ROW, rows.schema[_ROW].dataType), T.StructField(_TEXT, T.StringType())]
    else:
        kept = rows.select(F.col(_ROW).getField(id_col).alias(id_col), _KEY, _TEXT)
        fields = [T.StructField(id_col, docs.schema[id_col].dataType), *(T.StructField(k, T.LongType()) for k in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept_sha256", T.StringType())]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"text": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            marks_of = batch.column("marks")
            for k, text in enumerate(batch.column(_TEXT)):
                text = text.as_py()
                marks = marks_of[k].values if marks_of[k].is_valid else None
                cuts = removed_spans(marks, length)
                if clean_text:
                    out["text"].append(text if not cuts else _without(text.encode(), cuts))
                    continue
                raw = (text or "").encode()
                kept_bytes = b"".join(raw[a:b] for a, b in zip([0, *(e for _, e in cuts)], [*(s for s, _ in cuts), len(raw)], strict=True))
                for name, value in (("n_bytes", len(raw)), ("n_removed", len(raw) - len(kept_bytes)), ("n_spans", len(cuts)), ("kept_sha256", hashlib.sha256(kept_bytes).hexdigest())):
                    out[name].append(value)
            made = {_TEXT: pa.array(out["text"], pa.string())} if clean_text else {k: pa.array(out[k], pa.string() if k == "kept_sha256" else pa.int64()) for k in names[1:]}
            yield pa.RecordBatch.from_arrays([made[c] if c in made else batch.column(c) for c in names], names)

    out_rows = kept.join(found.hint("merge"), _KEY, "left").drop(_KEY).mapInArrow(run, T.StructType(fields))
    if clean_text:
        out_rows = out_rows.select(*[F.col(_TEXT).alias(c) if c == text_col else F.col(_ROW).getField(c).alias(c) for c in docs.columns])
    result, _ = written(out_rows, "without_repeats")
    remove(spark, *paths)
    return result


def _without(raw: bytes, cuts: list[tuple[int, int]]) -> str:
    parts, at = [], 0
    for a, b in cuts:
        while a > at and raw[a] & 0xC0 == 0x80:
            a -= 1
        parts.append(raw[at:a])
        at = b
        while at < len(raw) and raw[at] & 0xC0 == 0x80:
            at += 1
    return b"".join([*parts, raw[at:]]).decode()


def op7_run_length_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of repeated 200-byte strings."""
    return remove_repeats(table(spark, sf_dir, "documents"), clean_text=False)


OP7_SQL = """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, substr(h, 2 * i + 1, 400) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM bytes)),
often AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
starts AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS first FROM windows SEMI JOIN often USING (s)),
islands AS (SELECT doc_id, i, sum(first) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM starts),
gone AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM islands GROUP BY doc_id, k),
edges AS (SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_, b FROM gone UNION ALL
  SELECT t.doc_id, length(h) // 2, coalesce(max(g.b), 0), NULL FROM bytes t LEFT JOIN gone g USING (doc_id) GROUP BY t.doc_id, h),
kept AS (SELECT e.doc_id, string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY from_, a) AS k, count(b) AS n_spans, CAST(coalesce(sum(b - a) FILTER (WHERE b IS NOT NULL), 0) AS BIGINT) AS n_removed, any_value(length(h) // 2) AS n_bytes
  FROM edges e JOIN bytes USING (doc_id) GROUP BY e.doc_id)
SELECT doc_id, n_bytes, n_removed, n_spans, sha256(unhex(k)) AS kept_sha256 FROM kept
"""
