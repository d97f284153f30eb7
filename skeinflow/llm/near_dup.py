"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact verification.

1. One pass gives each document its shingle-set size, a 128-bit digest of the set and a MinHash
   signature.  Documents of equal sets form a class at once (partial aggregation, so a hot group of
   copies never meets in one task); the rest works on one representative a class.
2. Representatives that share a band are candidates.  Signatures are compared in batches; after each
   batch the posterior of the similarity given the matches so far prunes pairs whose chance to
   reach the threshold is below ``miss``.
3. Leaders first: within a block of each bucket, every member names one survivor, the smallest of those that are
   all but sure to be linked, else the likeliest.  These pairs, one a member, are verified on the full sets,
   so large groups of copies grow together at the cost of one text a member.  Further rounds do the same with
   one member per class so far, in buckets of several blocks, as long as each halves what is not connected.
4. Buckets whose members are all connected by then are done.  In the others every two members of
   different classes are compared; survivors gather them into groups, a task emitting a spanning
   star of its survivors, never the pairs.  Each group's texts meet in a task, where survivors that are
   not connected yet are verified on the full sets.
5. Connected components of the verified links give the class of each document.

In step 4 groups and buckets above ``BLOCK`` members are dealt as pairs of blocks, each a task of bounded
size: every pair of members still meets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Tables, U64, blocks, doc_text, flat, hash_spans, mix, table, written
from .graph import components, labels

#: MinHash functions of a signature; 16 bits of each are kept.
HASHES = 120
#: Hashes that are compared before each look at the posterior.
BATCH = 24
#: Chance that a pair at the threshold shares no band.
BAND_MISS = 1e-6
#: Members of a bucket or group that one task holds.
BLOCK = 1024
#: Posterior at which a pair is taken for all but sure, so that its smaller side may lead.
SURE = 0.99

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEEDS = np.random.default_rng(20240501).integers(0, 1 << 63, HASHES, dtype=np.int64).astype(U64) * U64(2) + U64(1)


@dataclass(frozen=True)
class Rule:
    """Link two documents when intersection / union of their shingle sets reaches percent / 100."""

    words: int = 5
    percent: int = 80
    miss: float = 1e-7
    block: int = BLOCK

    @property
    def rows(self) -> int:
        t = self.percent / 100
        return max((r for r in range(1, 21) if (1 - t**r) ** (HASHES // r) <= BAND_MISS), default=1)

    def least_matches(self) -> np.ndarray:
        """For each batch end n, the fewest matches whose posterior P(J >= t) is ``miss`` or more.

        With a uniform prior, P(J >= t | m of n) = P(Binomial(n + 1, t) <= m).
        """
        return np.array([self._matches(n, self.miss) for n in range(BATCH, HASHES + 1, BATCH)])

    def sure_matches(self) -> int:
        """Matches of all hashes from which P(J >= t) is ``SURE`` or more."""
        return self._matches(HASHES, SURE)

    def _matches(self, n: int, chance: float) -> int:
        t, total, m = self.percent / 100, 0.0, -1
        while total < chance and m <= n:
            m += 1
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        return m


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all rows as two independent 64-bit hashes, sorted by the first, and the n + 1 offsets.

    A-Z are lower-cased; words are runs of other than ASCII white space.  A row of fewer words is one
    shingle, a row without words has none.
    """
    data, ends = flat(texts)
    n = len(ends) - 1
    data = _LOWER[data]
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    step = np.diff(inside.view(np.int8))
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if not len(start):
        return np.zeros(0, U64), np.zeros(0, U64), np.zeros(n + 1, np.int64)
    # words never cross rows
    cut = np.searchsorted(ends, start, "right")
    far = end > ends[np.minimum(cut, n)]
    while far.any():
        at = ends[cut[far]]
        start, end = np.concatenate([start, at]), np.concatenate([np.where(far, ends[np.minimum(cut, n)], end), end[far]])
        order = np.argsort(start, kind="stable")
        start, end = start[order], end[order]
        keep = end > start
        start, end = start[keep], end[keep]
        cut = np.searchsorted(ends, start, "right")
        far = end > ends[np.minimum(cut, n)]
    row = cut - 1
    per_row = np.bincount(row, minlength=n)
    first = np.cumsum(per_row) - per_row
    length = np.minimum(per_row, words)
    count = np.where(per_row > 0, per_row - length + 1, 0)
    rows = np.repeat(np.arange(n), count)
    at = np.repeat(first, count) + np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
    width = length[rows]
    both = []
    for seed in (0, 1):
        word = hash_spans(data, start, end, seed)
        h = np.zeros(len(rows), U64)
        for k in range(words):
            on = width > k
            h[on] = mix(h[on] * U64(0x9FB21C651E98DF25) + word[at[on] + k] + U64(k + 1))
        both.append(h)
    h, second = both
    order = np.lexsort((h, rows))
    h, second, rows = h[order], second[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    h, second, rows = h[new], second[new], rows[new]
    return h, second, np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int64)


def signatures(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(rows, HASHES) 16-bit MinHash values; rows without shingles are all zero."""
    n = len(off) - 1
    out = np.zeros((n, HASHES), np.uint16)
    full = np.flatnonzero(off[1:] > off[:-1])
    if len(full):
        buf = np.empty_like(h)
        for k in range(HASHES):
            np.multiply(h, _SEEDS[k], out=buf)
            low = np.minimum.reduceat(buf, off[full])
            out[full, k] = (mix(low) >> U64(40)).astype(np.uint16)
    return out


def digests(h: np.ndarray, second: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each row's set, one of each hash: equal for equal sets."""
    out = []
    for own, seed in ((h, 0xA0761D6478BD642F), (second, 0xE7037ED1A0B428DB)):
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(mix(own ^ U64(seed)))])
        out.append((sums[off[1:]] - sums[off[:-1]]).view(np.int64))
    return out[0], out[1]


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """(documents, bands) 64-bit keys."""
    bands = HASHES // rows
    part = sig[:, : bands * rows].reshape(len(sig), bands, rows).astype(U64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=U64), part.shape[:2]) * U64(0x9E3779B97F4A7C15)
    for k in range(rows):
        key = mix(key + part[:, :, k] * U64(0xD6E8FEB86659FD93) + U64(k))
    return key.view(np.int64)


def survivors(sig: np.ndarray, x: np.ndarray, y: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs that no batch's posterior pruned, with their matches."""
    got = np.zeros(len(x), np.int32)
    for b, need in enumerate(least):
        part = slice(b * BATCH, (b + 1) * BATCH)
        got = got + (sig[x, part] == sig[y, part]).sum(1, dtype=np.int32)
        keep = got >= need
        x, y, got = x[keep], y[keep], got[keep]
    return x, y, got


def member_pairs(side: np.ndarray, size: np.ndarray, percent: int, chunk: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of members whose set sizes allow a link, in chunks.

    side: 0 for one block; of a pair of blocks, only pairs across (sides 1 and 2) are given.
    """
    order = np.argsort(size, kind="stable")
    s = size[order]
    reach = np.searchsorted(s, s * 100 // percent, "right")  # 100 * s[x] >= percent * s[y]
    counts = reach - np.arange(len(s)) - 1
    ends = np.cumsum(counts)
    at = 0
    while at < len(s):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + chunk, "right")))
        n = counts[at:to]
        x = np.repeat(np.arange(at, to), n)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
        x, y = order[x], order[y]
        if side.any():
            keep = side[x] != side[y]
            x, y = x[keep], y[keep]
        yield x, y
        at = to


def features(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, key, n_shingles, digest (d1, d2) and signature of each row (doc_id, key, text)."""
    words = rule.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in blocks(texts):
                h, second, off = shingle_sets(texts.slice(a, b - a), words)
                d1, d2 = digests(h, second, off)
                sig = signatures(h, off)
                cols = [batch.column("doc_id").slice(a, b - a), batch.column("key").slice(a, b - a), pa.array(np.diff(off)), pa.array(d1), pa.array(d2), pa.array([r.tobytes() for r in sig], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "key", "n_shingles", "d1", "d2", "sig"])

    return docs.mapInArrow(run, "doc_id long, key long, n_shingles long, d1 long, d2 long, sig binary")


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches sorted by ``keys``: about a batch of rows, or one group."""
    held: list[pa.Table] = []
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if not t.num_rows:
            continue
        ids = np.stack([t.column(k).to_numpy() for k in keys])
        last = np.flatnonzero((ids != ids[:, -1:]).any(0))
        if not len(last):
            if held and any(held[-1].column(k)[-1].as_py() != t.column(k)[0].as_py() for k in keys):
                yield pa.concat_tables(held).combine_chunks()
                held = []
            held.append(t)
            continue
        cut = int(last[-1]) + 1
        yield pa.concat_tables([*held, t.slice(0, cut)]).combine_chunks()
        held = [t.slice(cut)]
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _cells(members: DataFrame, group: str, count: str, id_col: str, block: int) -> DataFrame:
    """Deal each group into cells of two blocks at most: columns cell and side are added.

    One block: cell 0, side 0.  Of b blocks, each pair of blocks is a cell (sides 1 and 2), and so is each
    block alone; a member goes to b cells.
    """
    n = F.greatest(F.lit(1), F.ceil(F.col(count) / block)).cast("int")
    own = F.pmod(F.xxhash64(id_col), n).cast("int")
    out = members.withColumn("_n", n).withColumn("_own", own).withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    low, high = F.least("_own", "_with"), F.greatest("_own", "_with")
    side = F.when(F.col("_own") == F.col("_with"), 0).when(F.col("_own") < F.col("_with"), 1).otherwise(2)
    return out.withColumn("cell", low * F.col("_n") + high).withColumn("side", side.cast("int")).drop("_n", "_own", "_with", count)


def _close(t: pa.Table, rule: Rule, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of the surviving pairs in whole cells, and their matches; pairs of one label are passed over."""
    percent = rule.percent
    label, size, side = (t.column(c).to_numpy() for c in ("label", "n_shingles", "side"))
    sig = _matrix(t.column("sig"))
    key, cell = t.column("key").to_numpy(), t.column("cell").to_numpy()
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])]))
    ends = np.append(new[1:], len(key))
    lengths = ends - new
    for m in np.unique(lengths[lengths <= 48]):  # small groups of one size at once
        if m > 1:
            i, j = np.triu_indices(m, 1)
            base = new[lengths == m]
            for a in range(0, len(base), max(1, (1 << 18) // len(i))):
                own = base[a : a + max(1, (1 << 18) // len(i))]
                x, y = (own[:, None] + i).ravel(), (own[:, None] + j).ravel()
                ok = (100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])) & ((side[x] == 0) | (side[x] != side[y])) & (label[x] != label[y])
                yield survivors(sig, x[ok], y[ok], least)
    for a, e in zip(new[lengths > 48], ends[lengths > 48], strict=True):
        for x, y in member_pairs(side[a:e], size[a:e], percent):
            x, y = x + a, y + a
            ok = label[x] != label[y]
            yield survivors(sig, x[ok], y[ok], least)


def leaders(members: DataFrame, rule: Rule) -> DataFrame:
    """(a, far, worth, b): for each member with a survivor in its cell, the one it is to be verified with.

    That is the smallest of those with ``sure_matches`` (far 0), else the one of most matches (far 1, worth their
    negative).
    """
    least, sure = rule.least_matches(), rule.sure_matches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _grouped(batches, ["key", "cell"]):
            rep = t.column("rep").to_numpy()
            best = [np.zeros(0, np.int64)] * 4
            for x, y, got in _close(t, rule, least):
                a, b, got = np.concatenate([rep[x], rep[y]]), np.concatenate([rep[y], rep[x]]), np.concatenate([got, got])
                far = (got < sure).astype(np.int64)
                best = [np.concatenate(v) for v in zip(best, (a, far, -got.astype(np.int64) * far, b), strict=True)]
                order = np.lexsort(best[::-1])
                first = order[np.unique(best[0][order], return_index=True)[1]]
                best = [v[first] for v in best]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in best], ["a", "far", "worth", "b"])

    return members.mapInArrow(run, "a long, far long, worth long, b long")


def candidate_stars(members: DataFrame, rule: Rule) -> DataFrame:
    """Spanning stars (a, b) of the pairs of different labels that survive in each bucket."""
    least = rule.least_matches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _grouped(batches, ["key", "cell"]):
            pairs = [(x, y) for x, y, _ in _close(t, rule, least)]
            yield _stars(t.column("rep").to_numpy(), [x for x, _ in pairs], [y for _, y in pairs])

    return members.mapInArrow(run, "a long, b long")


def _stars(rep: np.ndarray, xs: list[np.ndarray], ys: list[np.ndarray]) -> pa.RecordBatch:
    ids, at = np.unique(rep, return_inverse=True)
    x, y = (at[np.concatenate(v)] if v else np.zeros(0, np.int64) for v in (xs, ys))
    label = labels(len(ids), x, y)
    own = np.flatnonzero(label != np.arange(len(ids)))
    return pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(ids[label[own]])], ["a", "b"])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    data, ends = flat(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)
    return data.view(np.uint16).reshape(len(ends) - 1, HASHES) if len(data) else np.zeros((len(ends) - 1, HASHES), np.uint16)


def verified_stars(members: DataFrame, rule: Rule) -> DataFrame:
    """Spanning stars (a, b) of the exactly verified links between different labels within each group's cells."""
    least, percent, words = rule.least_matches(), rule.percent, rule.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _grouped(batches, ["key", "cell"]):
            key, cell = t.column("key").to_numpy(), t.column("cell").to_numpy()
            new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])]))
            for a, e in zip(new, np.append(new[1:], len(key)), strict=True):
                g = t.slice(a, e - a)
                rep = g.column("rep").to_numpy()
                sets: list[tuple[np.ndarray, np.ndarray]] = []
                texts = g.column("text").combine_chunks()
                for p, q in blocks(texts):
                    h, second, off = shingle_sets(texts.slice(p, q - p), words)
                    sets += zip(np.split(h, off[1:-1]), np.split(second, off[1:-1]), strict=True)
                size = np.array([len(s) for s, _ in sets])
                sig, side = _matrix(g.column("sig")), g.column("side").to_numpy()
                _, first, which = np.unique(g.column("label").to_numpy(), return_index=True, return_inverse=True)
                label = first[which]
                xs, ys = [], []
                for x, y in member_pairs(side, size, percent):
                    x, y, got = survivors(sig, x, y, least)
                    order = np.argsort(-got, kind="stable")
                    x, y = x[order], y[order]
                    step = 64
                    while len(x):
                        apart = label[x] != label[y]
                        x, y = x[apart], y[apart]
                        now, x, y = (x[:step], y[:step]), x[step:], y[step:]
                        hit = np.array([_linked(sets[i], sets[j], percent) for i, j in zip(*now, strict=True)], bool)
                        if hit.any():
                            xs.append(now[0][hit])
                            ys.append(now[1][hit])
                            label = labels(len(rep), np.concatenate([label, xs[-1]]), np.concatenate([np.arange(len(rep)), ys[-1]]))
                        else:
                            step = min(4096, step * 2)
                yield _stars(rep, xs, ys)

    return members.mapInArrow(run, "a long, b long")


def verified_leaves(cells: DataFrame, rule: Rule) -> DataFrame:
    """The exactly verified links (a, b) of each cell's leader (side 1, its first row) with the others (side 2).

    A task holds the leader's set and those of about a megabyte of text, however large the cell is.
    """
    percent, words = rule.percent, rule.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, lead_rep, lead_label = None, -1, -1
        for batch in batches:
            rep, side, label = (batch.column(c).to_numpy() for c in ("rep", "side", "label"))
            texts = batch.column("text")
            found: list[tuple[int, int]] = []
            for p, q in blocks(texts):
                h, second, off = shingle_sets(texts.slice(p, q - p), words)
                for k in range(p, q):
                    own = slice(off[k - p], off[k - p + 1])
                    if side[k] == 1:
                        lead, lead_rep, lead_label = (h[own].copy(), second[own].copy()), int(rep[k]), label[k]
                    elif label[k] != lead_label and _linked(lead, (h[own], second[own]), percent):
                        found.append((int(rep[k]), lead_rep))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    return cells.mapInArrow(run, "a long, b long")


def _linked(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], percent: int) -> bool:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int((a[1][i] == b[1][j]).sum())
    return both > 0 and 100 * both >= percent * (len(a[0]) + len(b[0]) - both)


def led_cells(tables: Tables, pairs: DataFrame, rows: int, block: int) -> tuple[DataFrame, int]:
    """Cells (key, cell) of one leader (side 1) and about ``block`` of the others that it meets (side 2).

    ``pairs`` holds at most ``rows`` of (key, rep): a leader and another.  What comes out grows with the pairs
    only; the second value is a bound on its rows.
    """
    pairs, n = tables.keep(pairs.distinct(), "pairs", rows=rows)
    hot = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    cells = F.ceil(F.coalesce("n", F.lit(1)) / block).cast("int")
    others = pairs.join(hot, "key", "left").select("key", F.pmod(F.xxhash64("rep"), cells).cast("int").alias("cell"), "rep", F.lit(2).alias("side"))
    return others.unionByName(others.select("key", "cell", F.col("key").alias("rep"), F.lit(1).alias("side")).distinct()), 2 * n


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id and kept.

    Every row is a document, whether or not it repeats another's id: rows of one id but unlike texts are linked
    each by its own text.  component_id is the smallest id among the linked rows.  Rows with a null id
    take part; component_id is null where no linked row has an id, and such rows are kept.
    Documents without words (null, empty, white space) have no shingles and are linked with nothing.
    Columns beside id and text are not read.  Links between different texts are lost with probability
    BAND_MISS + 5 * miss at the threshold, less above it; every reported link was verified on the full sets
    (of 128-bit shingle hashes).
    """
    spark: SparkSession = docs.sparkSession
    own = doc_text(docs, id_col, text_col).withColumn("key", F.xxhash64("doc_id", "text"))
    tables = Tables(spark)
    feats, n = tables.keep(features(own, rule), "features")
    classes = feats.filter("n_shingles > 0").groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("first_id"), F.min("key").alias("key"), F.first("sig").alias("sig"))
    # the table is written once, so its numbers name the classes from here on
    reps, n = tables.keep(classes.withColumn("rep", F.monotonically_increasing_id()), "classes", rows=n)
    bands = HASHES // rule.rows

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(_matrix(batch.column("sig")), rule.rows)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(batch.column("rep").to_numpy(), keys.shape[1]))], ["key", "rep"])

    def connected(edges: DataFrame, rows: int | None = None) -> DataFrame:
        found, path = components(edges, rows)
        tables.paths.append(path)
        return found

    keys = reps.select("rep", "sig").mapInArrow(keyed, "key long, rep long")
    # written first: Spark splits a skewed join only between plain exchanges, not after an aggregate of its key
    shared, n_shared = tables.keep(keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "bands", rows=n * bands)
    buckets, n_buckets = tables.keep(keys.join(shared.hint("merge"), "key"), "buckets", rows=n * bands)
    signed = reps.select("rep", "n_shingles", "sig")

    def dealt(tasks: DataFrame, label: DataFrame, *order: str) -> DataFrame:
        """Cells with the members' texts, signatures and labels."""
        full = tasks.join(texts.hint("merge"), "rep").join(label, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        return full.repartition("key", "cell").sortWithinPartitions("key", "cell", *order)

    def led(members: DataFrame) -> DataFrame:
        """The pairs that members of each block of a bucket name."""
        block = F.pmod(F.xxhash64("rep"), F.ceil(F.col("members") / rule.block)).cast("int")
        cells = members.select("key", "rep", block.alias("cell"), F.lit(0).alias("side"), "label").join(signed.hint("merge"), "rep")
        return leaders(cells.repartition("key", "cell").sortWithinPartitions("key", "cell"), rule)

    def best(named: DataFrame) -> DataFrame:
        """Each member's best choice over all its buckets, as (key, rep): the smaller of the two leads."""
        one = named.groupBy("a").agg(F.min(F.struct("far", "worth", "b")).alias("to")).select("a", F.col("to.b").alias("b"))
        return one.select(F.least("a", "b").alias("key"), F.greatest("a", "b").alias("rep"))

    # leaders of single documents
    named, n_named = tables.keep(led(buckets.withColumn("label", F.col("rep"))), "leaders", rows=n_buckets)
    # in a bucket of several blocks a member may meet its first survivor only later on
    candidates = named.select(F.explode(F.array("a", "b")).alias("rep")).unionByName(buckets.filter(F.col("members") > rule.block).select("rep")).distinct()
    wanted = reps.select("rep", "key", "sig").join(candidates, "rep")
    texts = own.select("key", "text").join(wanted.hint("merge"), "key").dropDuplicates(["rep"]).select("rep", "text", "sig")
    texts, n_texts = tables.keep(texts, "texts")
    none = spark.createDataFrame([], "rep long, label long")
    tasks, rows = led_cells(tables, best(named), n_named, rule.block)
    links = connected(verified_leaves(dealt(tasks, none, "side"), rule), rows)
    label = links.select(F.col("node").alias("rep"), F.col("component").alias("label"))

    def still_open(label: DataFrame) -> tuple[DataFrame, int]:
        """Members of the buckets that hold more than one class so far."""
        own = buckets.join(label, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        several, _ = tables.keep(own.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("key"), "several", rows=n_buckets)
        return tables.keep(own.join(several.hint("merge"), "key"), "open", rows=n_buckets)

    left, n_left = still_open(label)
    # in open buckets of several blocks, rounds with one member per class, while each at least halves what is open
    large = left.filter(F.col("members") > rule.block)
    n_large, before = large.count(), 0
    while n_large and (not before or 2 * n_large <= before):
        classes_of = large.groupBy("key", "label").agg(F.min("rep").alias("rep"))
        sizes, _ = tables.keep(classes_of.groupBy("key").agg(F.count(F.lit(1)).alias("members")), "sizes", rows=n_large)
        again, n_again = tables.keep(led(classes_of.join(sizes.hint("merge"), "key")), "leaders", rows=n_large)
        tasks, rows = led_cells(tables, best(again), n_again, rule.block)
        links = connected(links.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(verified_leaves(dealt(tasks, label, "side"), rule)), n_texts + rows)
        label = links.select(F.col("node").alias("rep"), F.col("component").alias("label"))
        left, n_left = still_open(label)
        large = left.filter(F.col("members") > rule.block)
        n_large, before = large.count(), n_large
    # every pair of different classes that share a bucket
    cells = _cells(left.join(signed.hint("merge"), "rep"), "key", "members", "rep", rule.block).repartition("key", "cell").sortWithinPartitions("key", "cell")
    groups = connected(candidate_stars(cells, rule), n_left).select(F.col("node").alias("rep"), F.col("component").alias("key"))
    sized = groups.join(groups.groupBy("key").agg(F.count(F.lit(1)).alias("members")), "key")
    more = verified_stars(dealt(_cells(sized, "key", "members", "rep", rule.block), label), rule)
    linked = connected(links.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more), 2 * n_texts)
    grouped = reps.select("rep", "d1", "d2", "n_shingles", "first_id").join(linked.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    by_group, _ = tables.keep(grouped.groupBy("component").agg(F.min("first_id").alias("component_id")), "groups", rows=n)
    by_set = grouped.join(by_group.hint("merge"), "component").select("d1", "d2", "n_shingles", "component_id", F.lit(True).alias("found"))
    out = feats.select("doc_id", "n_shingles", "d1", "d2").join(by_set, ["d1", "d2", "n_shingles"], "left")
    out = out.select("doc_id", "n_shingles", F.when(F.col("found"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    result, _ = written(out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "near_duplicates")
    tables.remove()
    return result


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: three-word shingles, similarity of 0.85 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), Rule(words=3, percent=85))


OP10_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words
), placed AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
linked AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM placed a JOIN placed b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), spread AS (
  SELECT doc_id AS label, doc_id FROM sets UNION SELECT s.label, l.y FROM spread s JOIN linked l ON l.x = s.doc_id AND l.y > s.label
), classes AS (SELECT doc_id, min(label) AS component_id FROM spread GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN classes USING (doc_id)
"""
