"""Token ids as wavelet matrices: one compressed, searchable file image per shard.

A shard holds whole documents in ascending id order, those without an id first.  Its image has a header, the
documents' ids, which of them are null, their token counts, and one bit-plane per bit of the largest token id, most significant first, each with
the count of ones before every 512 bits.  Token access, rank, select, counts and occurrence lookup work on
the image alone.  Images travel in a Parquet table (zstd), the container that any Hadoop store
accepts from executors: one row per shard.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import byte_bpe
from .common import blocks, doc_text, new_path, table

MAGIC = b"SKWM0002"
#: Tokens from which a shard is closed (one document is never cut).
SHARD_TOKENS = 1 << 21
#: Id appended to each document.
END_ID = 2
_BLOCK = 512

SHARD = "part int, seq int, first_doc long, n_docs long, n_tokens long, image binary"
DIGEST = "part int, seq int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


class WaveletMatrix:
    """Rank/select structure over integers below 2**len(planes)."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks

    @classmethod
    def build(cls, values: np.ndarray) -> "WaveletMatrix":
        values = np.ascontiguousarray(values)
        depth = max(1, int(values.max()).bit_length()) if len(values) else 1
        s = values.astype(np.uint16 if depth <= 16 else np.uint32)
        planes, zeros, ranks = [], [], []
        for level in range(depth):
            mask = (s & s.dtype.type(1 << (depth - 1 - level))) != 0
            plane = np.packbits(mask, bitorder="little")
            planes.append(plane)
            ranks.append(_directory(plane))
            low = np.compress(~mask, s)  # far faster than indexing by the mask
            zeros.append(len(low))
            s = np.concatenate([low, np.compress(mask, s)])
        return cls(len(values), planes, zeros, ranks)

    def values(self) -> np.ndarray:
        """All values in order, by undoing the planes' partitions from the last to the first."""
        depth = len(self.planes)
        kind = np.uint16 if depth <= 16 else np.uint32
        s = np.zeros(self.n, kind)
        for level in range(depth - 1, -1, -1):
            mask = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            z = self.zeros[level]
            out = np.empty(self.n, kind)
            out[np.flatnonzero(~mask)] = s[:z]
            out[np.flatnonzero(mask)] = s[z:] | kind(1 << (depth - 1 - level))
            s = out
        return s

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        b = i // _BLOCK
        plane = self.planes[level]
        a, e = b * _BLOCK // 8, i // 8
        got = int(self.ranks[level][b]) + int(np.bitwise_count(plane[a:e]).sum())
        return got + (int(plane[e] & ((1 << (i % 8)) - 1)).bit_count() if i % 8 else 0)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3] >> (i & 7)) & 1

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, i), self._ones(level, i)
            value = value << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def _range(self, value: int, i: int) -> tuple[int, int]:
        """Where the values equal to ``value`` among the first i begin and end below the last plane."""
        a, e = 0, i
        depth = len(self.planes)
        if value < 0 or value >> depth:
            return 0, 0
        for level in range(depth):
            x, y = self._ones(level, a), self._ones(level, e)
            a, e = (self.zeros[level] + x, self.zeros[level] + y) if value >> (depth - 1 - level) & 1 else (a - x, e - y)
        return a, e

    def rank(self, value: int, i: int) -> int:
        """How many of the first i values equal ``value``."""
        a, e = self._range(value, min(max(i, 0), self.n))
        return e - a

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def select(self, value: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of ``value``."""
        a, e = self._range(value, self.n)
        if not 0 <= k < e - a:
            raise IndexError(k)
        i, depth = a + k, len(self.planes)
        for level in range(depth - 1, -1, -1):
            one = bool(value >> (depth - 1 - level) & 1)
            i = self._place(level, one, i - self.zeros[level] if one else i)
        return i

    def _place(self, level: int, one: bool, k: int) -> int:
        """Place of the k-th one (or zero) bit of a plane, by bisection on the directory."""
        ranks = self.ranks[level]
        b = bisect_right(range(len(ranks)), k, key=lambda i: int(ranks[i]) if one else i * _BLOCK - int(ranks[i])) - 1
        before = int(ranks[b]) if one else b * _BLOCK - int(ranks[b])
        bits = np.unpackbits(self.planes[level][b * _BLOCK // 8 : (b + 1) * _BLOCK // 8], bitorder="little")
        return b * _BLOCK + int(np.flatnonzero(bits == one)[k - before])

    def _places(self, level: int, one: bool, k: np.ndarray, chunk: int = 4096) -> np.ndarray:
        """As _place for many ascending k; only the blocks that hold them are unpacked."""
        ranks = self.ranks[level]
        before = ranks if one else np.arange(len(ranks)) * _BLOCK - ranks
        b = np.searchsorted(before, k, "right") - 1
        blocks_, which = np.unique(b, return_inverse=True)
        width, out = _BLOCK // 8, np.empty(len(k), np.int64)
        plane = self.planes[level]
        for a in range(0, len(blocks_), chunk):
            own = blocks_[a : a + chunk]
            at = own[:, None] * width + np.arange(width)
            raw = np.where(at < len(plane), plane[np.minimum(at, len(plane) - 1)], 0).astype(np.uint8)
            bits = np.unpackbits(raw, axis=1, bitorder="little") == one
            some = np.flatnonzero((which >= a) & (which < a + chunk))
            hits = np.flatnonzero(bits)  # of all blocks, in order: the first of each follows from the counts
            first = np.concatenate([[0], np.cumsum(bits.sum(1))])
            hit = hits[first[which[some] - a] + k[some] - before[b[some]].astype(np.int64)]
            out[some] = own[hit // _BLOCK] * _BLOCK + hit % _BLOCK
        return out

    def occurrences(self, value: int) -> np.ndarray:
        """All places of ``value``, ascending."""
        a, e = self._range(value, self.n)
        at, depth = np.arange(a, e), len(self.planes)
        for level in range(depth - 1, -1, -1):
            one = bool(value >> (depth - 1 - level) & 1)
            at = self._places(level, one, at - self.zeros[level] if one else at) if len(at) else at
        return at


def _directory(plane: np.ndarray) -> np.ndarray:
    width = _BLOCK // 8
    full = np.zeros(-(-len(plane) // width) * width, np.uint8)
    full[: len(plane)] = plane
    ones = np.bitwise_count(full).reshape(-1, width).sum(1, dtype=np.uint32)
    return np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32)


class TokenShard:
    """Documents' token ids: the wavelet matrix of all of them, and where each document begins."""

    def __init__(self, doc_ids: np.ndarray, counts: np.ndarray, matrix: WaveletMatrix, null: np.ndarray | None = None):
        self.doc_ids, self.counts, self.matrix = doc_ids, counts, matrix
        self.null = np.zeros(len(doc_ids), bool) if null is None else null
        self.starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    @classmethod
    def of(cls, doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, null: np.ndarray | None = None) -> "TokenShard":
        return cls(np.asarray(doc_ids, np.int64), np.asarray(counts, np.int64), WaveletMatrix.build(ids), null)

    def tokens(self, k: int) -> np.ndarray:
        """Ids of the k-th document by access alone."""
        return np.array([self.matrix.access(i) for i in range(self.starts[k], self.starts[k + 1])], np.uint32)

    def to_bytes(self) -> bytes:
        m = self.matrix
        head = np.array([len(self.doc_ids), m.n, len(m.planes), *m.zeros], "<i8")
        parts = [MAGIC, np.array([len(head)], "<i8").tobytes(), head.tobytes(), self.doc_ids.astype("<i8").tobytes(), self.counts.astype("<i8").tobytes(), np.packbits(self.null, bitorder="little").tobytes()]
        for plane, ranks in zip(m.planes, m.ranks, strict=True):
            parts += [plane.tobytes(), ranks.astype("<u4").tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, image: bytes) -> "TokenShard":
        if image[:8] != MAGIC:
            raise ValueError("not a token shard")
        k = int(np.frombuffer(image, "<i8", 1, 8)[0])
        head = np.frombuffer(image, "<i8", k, 16)
        n_docs, n, depth = (int(x) for x in head[:3])
        at = 16 + 8 * k
        ids, counts = np.frombuffer(image, "<i8", n_docs, at), np.frombuffer(image, "<i8", n_docs, at + 8 * n_docs)
        at += 16 * n_docs
        null = np.unpackbits(np.frombuffer(image, np.uint8, -(-n_docs // 8), at), count=n_docs, bitorder="little").astype(bool)
        at += -(-n_docs // 8)
        width = -(-n // 8)
        entries = -(-width // (_BLOCK // 8)) + 1
        planes, ranks = [], []
        for _ in range(depth):
            planes.append(np.frombuffer(image, np.uint8, width, at))
            ranks.append(np.frombuffer(image, "<u4", entries, at + width))
            at += width + 4 * entries
        return cls(ids, counts, WaveletMatrix(n, planes, [int(x) for x in head[3:]], ranks), null)


def write_shards(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode whole texts and write shards at ``path``; returns the table of shards.

    Rows go in ascending id order, null ids first (rows of one id: by a hash of their texts, so that they
    need not all go through one task).  A null or empty text is the end id alone.  An empty table gives no
    shards.  Columns beside id and text are not read.  ``part`` and ``seq`` number the shards in id order;
    ``first_doc`` is null for a shard that begins with a null id.
    """
    tokenizer = tokenizer or byte_bpe.default_path()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        encode = byte_bpe.encoder(tokenizer).encode
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        n = 0

        def close() -> pa.RecordBatch:
            ids = [np.concatenate(x) for x in zip(*held, strict=True)]
            image = TokenShard.of(*ids).to_bytes()
            first = None if ids[3][0] else int(ids[0][0])
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([first], pa.int64()), pa.array([len(ids[0])], pa.int64()), pa.array([len(ids[2])], pa.int64()), pa.array([image], pa.binary())],
                ["part", "seq", "first_doc", "n_docs", "n_tokens", "image"],
            )

        for batch in batches:
            texts, null = batch.column("text"), batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            doc_ids = batch.column("doc_id").fill_null(0).to_numpy()
            for a, b in blocks(texts, byte_bpe.BLOCK_BYTES):
                ids, counts = encode(texts.slice(a, b - a))
                ids, counts = np.insert(ids, np.cumsum(counts), end_id), counts + 1
                ends, p, at = np.cumsum(counts), 0, 0
                while p < len(counts):  # up to the document that fills the shard
                    q = min(len(counts), int(np.searchsorted(ends, at + shard_tokens - n)) + 1)
                    held.append((doc_ids[a + p : a + q], counts[p:q], ids[at : ends[q - 1]], null[a + p : a + q]))
                    n, p, at = n + int(ends[q - 1]) - at, q, int(ends[q - 1])
                    if n >= shard_tokens:
                        yield close()
                        held, n, seq = [], 0, seq + 1
        if held:
            yield close()

    rows = doc_text(docs, id_col, text_col).withColumn("_hash", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "_hash").sortWithinPartitions("doc_id", "_hash").select("doc_id", "text")
    dealt.mapInArrow(build, SHARD).write.option("compression", "zstd").parquet(path)
    return read_shards(docs.sparkSession, path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The table of shards at ``path``."""
    return spark.read.schema(SHARD).parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """Tokens of all shards before each: within a part by its few shards, over parts by their sums."""
    own = shards.select("part", "seq", "n_tokens")
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    parts = own.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    return own.withColumn("within", within).join(before, "part").select("part", "seq", (F.col("within") + F.col("before")).alias("shard_start"))


def document_digests(shards: DataFrame) -> DataFrame:
    """Read every image: doc_id, start, n_tokens and the crc32 of the ids of each document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, image in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "image")), strict=True):
                shard = TokenShard.from_bytes(image)
                raw = memoryview(shard.matrix.values().astype("<u4").tobytes())
                at = (shard.starts * 4).tolist()
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, seq, np.int32)), pa.array(shard.doc_ids, mask=shard.null), pa.array(shard.starts[:-1]), pa.array(shard.counts), pa.array(crc, pa.int64())],
                    ["part", "seq", "doc_id", "local_start", "n_tokens", "ids_crc32"],
                )

    rows = shards.select("part", "seq", "image").mapInArrow(read, DIGEST)
    return rows.join(shard_starts(shards), ["part", "seq"]).select("doc_id", (F.col("shard_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def token_counts(shards: DataFrame, token_ids: list[int]) -> DataFrame:
    """Occurrences of each asked token in each shard, by rank on the images: part, seq, token_id, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, image in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "image")), strict=True):
                m = TokenShard.from_bytes(image).matrix
                k = len(token_ids)
                yield pa.RecordBatch.from_arrays([pa.array([part] * k, pa.int32()), pa.array([seq] * k, pa.int32()), pa.array(token_ids, pa.int64()), pa.array([m.count(t) for t in token_ids], pa.int64())], ["part", "seq", "token_id", "n"])

    return shards.select("part", "seq", "image").mapInArrow(count, "part int, seq int, token_id long, n long")


def op1_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as shards in the shared folder, and read back."""
    return document_digests(write_shards(table(spark, sf_dir, "documents"), new_path(spark, "tokens")))


__all__ = ["SHARD_TOKENS", "TokenShard", "WaveletMatrix", "document_digests", "op1_wavelet_tokens", "read_shards", "shard_starts", "token_counts", "write_shards"]
