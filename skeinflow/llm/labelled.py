"""A bounded, reproducible sample of labelled documents for fitting on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Most bytes of text that a model is fitted from.
FIT_BYTES = 256 << 20


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(f"`{id_col}`").cast("string")) % folds


def sample(docs: DataFrame, labels: DataFrame, target: str, limit: int, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 0, held: int = 0, max_bytes: int = FIT_BYTES) -> DataFrame:
    """(text, y) of at most ``limit`` labelled documents and ``max_bytes`` of text, in an order that only the id decides.

    Rows of the held-out fold, null labels and ids that are labelled both ways are left out.  Both bounds are
    documented bounds on what the driver fits from: when more is labelled, the smallest id hashes are taken until
    either bound is met.  Of rows that repeat an id the least text stands for it.  The sample is a table, so
    that documents are read once for it.
    """
    own = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{target}`").cast("int").alias("y")).filter("_id is not null and y is not null")
    if folds:
        own = own.filter(F.crc32(F.col("_id").cast("string")) % folds != held)
    own = own.groupBy("_id").agg(F.max("y").alias("y"), F.min("y").alias("_low")).filter(F.col("y") == F.col("_low"))
    own = own.select("_id", "y", F.xxhash64("_id").alias("_hash")).orderBy("_hash", "_id").limit(limit)
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    met = texts.join(F.broadcast(own), "_id").groupBy("_id", "_hash", "y").agg(F.min("text").alias("text"))
    met, _ = written(met, "sample", rows=16 * limit)  # texts, so fewer of them in a task
    sizes = sorted((r["_hash"], r["_id"], r["n"] or 0) for r in met.select("_hash", "_id", F.octet_length("text").alias("n")).toLocalIterator())  # at most ``limit`` rows
    total, last = 0, None
    for h, i, n in sizes:
        total += n
        if total > max_bytes:
            break
        last = (h, i)
    if last is None:
        return met.limit(0).select("text", "y")
    upto = (F.col("_hash") < last[0]) | ((F.col("_hash") == last[0]) & (F.col("_id") <= last[1]))
    return met.filter(upto).select("text", "y")
