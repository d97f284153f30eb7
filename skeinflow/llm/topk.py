"""Exact top-k inner products by norm buckets.

Candidates are range-dealt and sorted by length, and cut into buckets of similar length.  For each query
the k-th best score so far gives a local cosine threshold for the bucket.  Above one, the bucket is
passed over.  Otherwise the cheaper of two prunings picks candidates: the bucket's prefix that is long
enough, or the band of values that a strong coordinate of the query may meet at that cosine.  All
scores are exact integer products of the candidates.

Queries come in blocks of bounded size, one job over all buckets each, so what is broadcast does not grow with the
data; every job appends its parts' best to one table, which is merged by query at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import remove, table, written

BUCKET = 2048
#: Queries of one job at most, and bytes of their numbers.
QUERY_BLOCK = 16_384
QUERY_BYTES = 16 << 20
#: Longest vectors whose scores give each query its first threshold.
HEAD = 1024
#: Coordinates of a query that are tried for pruning.
FOCUS = 3
#: Stands for a null id inside a search: it sorts last, and is reported as null.
NO_ID = 2**63 - 1
#: Below this share of a bucket, candidates are gathered one query at a time.
SPARSE = 0.2

VECTOR = "vec_id long, dim int, norm double, ints array<double>"


def valid(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """vec_id, dim, norm and floor(scale * x) of the vectors that take part."""
    v = F.col(f"`{vector_col}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    vec_id = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("vec_id")
    rows = vectors.select(vec_id, v.cast("array<double>").alias("v")).filter("v is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            off = v.offsets.to_numpy() - v.offsets[0].as_py()
            ints = np.floor(scale * v.flatten().to_numpy(zero_copy_only=False))
            row = np.repeat(np.arange(len(v)), np.diff(off))
            norm = np.sqrt(np.bincount(row, ints * ints, len(v))) if len(ints) else np.zeros(len(v))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(np.diff(off).astype(np.int32)), pa.array(norm), pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ints))], ["vec_id", "dim", "norm", "ints"])

    return rows.filter(~bad).select("vec_id", "v").mapInArrow(run, VECTOR)


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of q and p, as int64; beyond a long, its bounds."""
    most = (np.abs(q).max(initial=0) * np.abs(p).max(initial=0)) * max(1, q.shape[1])
    if most < 2**53:
        return (q @ p.T).astype(np.int64)
    if most < 2**62:
        return q.astype(np.int64) @ p.astype(np.int64).T
    big = np.array([[int(x) for x in r] for r in q], object).reshape(q.shape) @ np.array([[int(x) for x in r] for r in p], object).reshape(p.shape).T
    return np.clip(big, -(2**63), 2**63 - 1).astype(np.int64)


class Best:
    """The k best (score, id) of each query so far; ties to the smaller id."""

    def __init__(self, queries: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.k = queries, k
        self.floor = floor.astype(float)
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.scores = [np.zeros(0, np.int64)] * len(queries)
        self.vecs = [np.zeros(0, np.int64)] * len(queries)

    def add(self, i: int, scores: np.ndarray, vecs: np.ndarray) -> None:
        ok = (scores >= self.floor[i]) & (vecs != self.ids[i])
        if not ok.any():
            return
        s, v = scores[ok], vecs[ok]
        if len(s) > self.k:
            cut = np.partition(s, len(s) - self.k)[len(s) - self.k]
            s, v = s[s >= cut], v[s >= cut]
        s, v = np.concatenate([self.scores[i], s]), np.concatenate([self.vecs[i], v])
        order = np.lexsort((v, -s))[: self.k]
        self.scores[i], self.vecs[i] = s[order], v[order]
        if len(order) == self.k:
            self.floor[i] = max(self.floor[i], float(s[order[-1]]))

    def batch(self) -> pa.RecordBatch:
        n = [len(s) for s in self.scores]
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(self.ids, n)), pa.array(np.concatenate([*self.vecs, np.zeros(0, np.int64)])), pa.array(np.concatenate([*self.scores, np.zeros(0, np.int64)]))], ["query_id", "vec_id", "score"])


def search_bucket(best: Best, q: np.ndarray, q_norm: np.ndarray, p: np.ndarray, p_norm: np.ndarray, vecs: np.ndarray) -> None:
    """Add one bucket's candidates; p is sorted by falling length."""
    n = len(p)
    with np.errstate(divide="ignore", invalid="ignore"):
        unit = np.where(p_norm[:, None] > 0, p / p_norm[:, None], 0)
        theta = best.floor * (1 - 1e-9 * np.sign(best.floor))
        local = np.where(q_norm > 0, theta / (q_norm * p_norm[0]), np.where(theta > 0, 2.0, -1.0))
        need = np.where(q_norm > 0, theta / q_norm, -1)
    live = np.flatnonzero(~(local > 1 + 1e-9))
    if not len(live):
        return
    prefix = np.searchsorted(-p_norm, -(need[live] * (1 - 1e-12)), "right")
    prefix = np.where(need[live] > 0, prefix, n)
    order = np.argsort(unit, axis=0, kind="stable")
    dense: list[int] = []
    for i, length_cut in zip(live.tolist(), prefix.tolist(), strict=True):
        cos = local[i]
        pick = None
        if 0 < cos <= 1:
            u = q[i] / q_norm[i]
            for f in np.argsort(-np.abs(u))[:FOCUS].tolist():
                # with cosine c or more, the coordinate lies within c*u +- sqrt((1-c^2)(1-u^2)), and beyond c*u on u's side
                # longer vectors of the bucket need no less than c, shorter ones more: c is a lower bound for all
                half = np.sqrt(max(0.0, (1 - cos * cos) * (1 - u[f] * u[f])))
                low, high = cos * u[f] - half - 1e-9, cos * u[f] + half + 1e-9
                if u[f] > cos:
                    high = 1.0
                if -u[f] > cos:
                    low = -1.0
                column = unit[order[:, f], f]
                a, b = np.searchsorted(column, low, "left"), np.searchsorted(column, high, "right")
                if b - a < (length_cut if pick is None else pick[1] - pick[0]):
                    pick = (a, b, f)
        size = length_cut if pick is None else pick[1] - pick[0]
        if size > SPARSE * n:
            dense.append(i)
            continue
        at = np.arange(length_cut) if pick is None else order[pick[0] : pick[1], pick[2]]
        at = at[at < length_cut]
        if len(at):
            best.add(i, products(q[i : i + 1], p[at])[0], vecs[at])
    for a in range(0, len(dense), 256):
        own = dense[a : a + 256]
        got = products(q[own], p)
        top = got.max(1)
        for j, i in enumerate(own):
            if top[j] >= best.floor[i]:
                best.add(i, got[j], vecs)


def _arrays(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.array([r["vec_id"] for r in rows], np.int64), np.array([r["norm"] for r in rows], float), np.array([r["ints"] for r in rows], float).reshape(len(rows), -1)


def _top(buckets: DataFrame, block: list, head: list, k: int, bucket: int) -> DataFrame:
    """Best candidates of each part of the buckets for one block of queries of one dimension."""
    ids, norms, q = _arrays(block)
    dim = q.shape[1]
    hid, _, hp = _arrays(head)
    start = np.full(len(ids), -np.inf)
    if len(head) > k:
        for a in range(0, len(ids), 1024):
            got = products(q[a : a + 1024], hp).astype(float)
            got[ids[a : a + 1024, None] == hid[None, :]] = -np.inf
            start[a : a + 1024] = np.partition(got, len(hid) - k, axis=1)[:, len(hid) - k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(ids, start, k)
        for batch in batches:
            n = batch.num_rows
            p_all = batch.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(n, dim)
            p_norm, vecs = batch.column("norm").to_numpy(), batch.column("vec_id").to_numpy()
            order = np.argsort(-p_norm, kind="stable")  # a task may read several files, each sorted by itself
            p_all, p_norm, vecs = p_all[order], p_norm[order], vecs[order]
            for a in range(0, n, bucket):
                search_bucket(best, q, norms, p_all[a : a + bucket], p_norm[a : a + bucket], vecs[a : a + bucket])
        yield best.batch()

    return buckets.filter(F.col("dim") == dim).mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0, bucket: int = BUCKET) -> DataFrame:
    """query_id, rank, vec_id and score of the k highest integer products of each query.

    ``is_query`` is a condition on ``vec_id``.  Null vectors and vectors with null or non-finite
    components take no part; products are taken between vectors of one dimension.  A row is no
    candidate of a query of its id.  Rows that repeat an id are each candidates; as a query, the least
    of them stands for the id.  Ties go to the smaller id.  Rows with a null id (or 2**63 - 1, which stands
    for it) are candidates reported with a null ``vec_id``, last among ties; they ask nothing.
    """
    spark = vectors.sparkSession
    n = spark.sparkContext.defaultParallelism
    ready, ready_at = written(valid(vectors, id_col, vector_col, scale), "vectors")
    sorted_rows = ready.repartitionByRange(max(2 * n, int(spark.conf.get("spark.sql.shuffle.partitions"))), F.desc("norm"), "vec_id").sortWithinPartitions(F.desc("norm"), "vec_id")
    buckets, buckets_at = written(sorted_rows, "buckets")
    queries = ready.filter(is_query & (F.col("vec_id") != NO_ID)).groupBy("vec_id").agg(F.min(F.struct("dim", "ints", "norm")).alias("q")).select("vec_id", "q.dim", "q.norm", "q.ints")
    heads: dict[int, list] = {}
    found, found_at = written(spark.createDataFrame([], "query_id long, vec_id long, score long"), "top")
    for block in _blocks(queries.orderBy("dim", "vec_id")):
        dim = block[0]["dim"]
        if dim not in heads:
            heads = {dim: buckets.filter(F.col("dim") == dim).orderBy(F.desc("norm"), "vec_id").limit(HEAD).collect()}
        _top(buckets, block, heads[dim], k, bucket).write.mode("append").option("compression", "zstd").parquet(found_at)
    found = spark.read.schema(found.schema).parquet(found_at)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    vec_id = F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id")
    top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), vec_id, "score")
    out, _ = written(top, "top_k")
    remove(spark, ready_at, buckets_at, found_at)
    return out


def _blocks(queries: DataFrame) -> Iterator[list]:
    """Blocks of bounded size of queries of one dimension, a partition at a time on the driver."""
    block: list = []
    for r in queries.toLocalIterator():
        if block and (len(block) >= min(QUERY_BLOCK, max(1, QUERY_BYTES // (8 * max(1, r["dim"])))) or block[0]["dim"] != r["dim"]):
            yield block
            block = []
        block.append(r)
    if block:
        yield block


def op3_norm_bucket_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all embeddings for each whose id is divisible by 50."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, p.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * p.e[i])) AS BIGINT) AS score
  FROM v q JOIN v p ON p.vec_id IS DISTINCT FROM q.vec_id AND len(p.e) = len(q.e) WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""
