"""Shared pieces: session folders, durable intermediate tables, vectorised byte hashing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.storage import Tables, new_path, remove, shared_dir, written

U64 = np.uint64
#: Bytes of a span from which the library's digest is faster than eight bytes at a time.
LONG = 512
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)
#: Bytes of text that are worked on at once in a Python worker.
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blocks(texts: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; one row at least."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    ends = np.cumsum(byte_lengths(texts))
    at, n = 0, len(ends)
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield at, to
        at = to


def byte_lengths(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), np.int64)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in one array, and the n + 1 offsets (null: empty)."""
    lengths = byte_lengths(texts)
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    raw = texts.buffers()
    off = np.frombuffer(raw[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(raw[2], np.uint8)[off[0] : off[-1]] if raw[2] is not None and len(off) else np.zeros(0, np.uint8)
    return data, ends


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one little-endian number; zero bytes follow the data."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end), which may overlap.

    Eight bytes at a time go through a mix that is not linear, so no two texts meet by their structure.  Long
    spans take a keyed digest of the library.  Another ``seed`` gives an independent hash.
    """
    n = (end - start).astype(np.int64)
    h = mix(n.astype(U64) * U64(0x9E3779B97F4A7C15) + U64((seed + 1) * 0xD6E8FEB86659FD93 % (1 << 64)))
    if not len(n):
        return h
    words, done = lanes(data), 0
    live = np.flatnonzero((n > 0) & (n <= LONG))
    while len(live):
        h[live] = mix(h[live] ^ (words[start[live] + done] & _KEEP[np.minimum(n[live] - done, 8)]))
        done += 8
        live = live[n[live] > done]
    key = seed.to_bytes(8, "little")
    for k in np.flatnonzero(n > LONG).tolist():
        h[k] = int.from_bytes(hashlib.blake2b(data[int(start[k]) : int(end[k])], digest_size=8, key=key).digest(), "little")
    return h


def same_spans(data: np.ndarray, start: np.ndarray, length: np.ndarray, other: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the bytes of each span equal those of ``other`` from ``at`` on, compared one by one.

    ``other`` ends in eight spare bytes or more.
    """
    x, y = lanes(data), np.ndarray((len(other) - 7,), "<u8", other, 0, (1,))
    ok = np.ones(len(start), bool)
    live, done = np.flatnonzero(length > 0), 0
    while len(live):
        if done >= LONG:
            for k in live.tolist():
                a, b, n = int(start[k]), int(at[k]), int(length[k])
                ok[k] = np.array_equal(data[a : a + n], other[b : b + n])
            break
        keep = _KEEP[np.minimum(length[live] - done, 8)]
        equal = (x[start[live] + done] & keep) == (y[at[live] + done] & keep)
        ok[live[~equal]] = False
        done += 8
        live = live[equal & (length[live] > done)]
    return ok


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit value of each ``width``-byte window: equal for equal windows, and mixed.

    Windows are composed from their halves, so each doubling is one pass.  Meant for choosing places: unlike
    windows may meet, and what is chosen must be compared in another way.
    """
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    size, level = (8, lanes(data)[: len(data) - 7].copy()) if width >= 8 else (1, data.astype(U64))
    while size * 2 <= width:
        step = size
        level = level[: len(level) - step] * U64(0x9FB21C651E98DF25) + (level[step:] ^ (level[step:] >> U64(29)))
        level ^= level >> U64(32)
        size *= 2
    rest = width - size
    return mix(level[:n] * U64(0xD6E8FEB86659FD93) + level[rest : rest + n])


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0] .. start[0]+length[0]-1, start[1] ..., in one array."""
    length = length.astype(np.int64)
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(length)
    return np.repeat(start.astype(np.int64) - (ends - length), length) + np.arange(total)


def local_tasks(df: DataFrame, per_partition: int = 2) -> int:
    """A partition count that follows the cluster's cores."""
    return max(1, df.sparkSession.sparkContext.defaultParallelism * per_partition)


def doc_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names; other columns cannot clash."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


__all__ = ["Tables", "blocks", "byte_lengths", "doc_text", "flat", "hash_spans", "lanes", "local_tasks", "mix", "new_path", "ranges", "remove", "rolling", "same_spans", "shared_dir", "table", "written"]
