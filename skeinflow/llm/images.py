"""Cropped or edited copies of pictures by local descriptors.

1. Each picture (PNG, PGM or PPM bytes, or any column that a given function turns into grey pixels) gets
   corners on several scales: local maxima of the structure tensor's lesser response.  A corner's patch is
   turned by its intensity centroid and described by 256 brightness comparisons, read between the pixels.
2. Equal pictures form a class by partial aggregation; the rest works on one of each.
3. Hamming tables: each of ``TABLES`` keys is ``KEY_BITS`` of the 256 bits.  Two corners that share a key and differ in
   at most ``CHECK`` of 64 other bits are a vote for their pictures.
4. In each bucket a member votes with the smallest picture that it is close to.  Pairs of ``SEEN`` votes are
   verified: their descriptors are matched, and a similarity transform (turn, scale, shift) must carry
   at least ``AGREE`` corners of one picture onto the other's.  Large groups of copies grow together here, at
   one pair a member.
5. Then the votes of all other close members of a bucket count, if verified links do not connect them yet, and
   pairs that come to ``SEEN`` votes are verified too.
6. Connected components of the links are the copies.

One rule holds for buckets of every size; those above ``block`` members are dealt as pairs of blocks, in which every two
members still meet.  For corners whose descriptors differ in d bits, a table's keys agree with a chance of about
(1 - d / 256) ** KEY_BITS: 0.33 at 10 bits, 0.10 at 20, 0.01 at 36; pictures that share many corners need two such
keys among all their corners and tables.  tests/llm holds the candidates against all pairs.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Tables, remove, table, written
from .graph import components
from .near_dup import _cells, _grouped, led_cells

#: Strongest corners that describe a picture: a number, and one more for so many pixels.
CORNERS = 64
AREA = 1024
SCALES = tuple(2 ** (k / 6) for k in range(7))
RADIUS = 12
#: Bits in which descriptors of one corner may differ.
DIFFER = 56
AGREE = 5
#: Votes that make two pictures candidates.
SEEN = 2
KEY_BITS = 28
TABLES = 6
#: Bits of 64 in which members of a bucket may differ to vote.
CHECK = 14
BLOCK = 1024
#: Points are kept in parts of a pixel.
_PART = 8

_rng = np.random.default_rng(5)
#: Places of the 256 comparisons, in units of the patch radius.
_PAIRS = np.clip(_rng.normal(0, 0.42, (256, 2, 2)), -0.95, 0.95)
_places = _rng.permutation(256)
#: Bits of each table's key, and of the check: disjoint groups.
_KEYS = _places[: TABLES * KEY_BITS].reshape(TABLES, KEY_BITS)
_CHECK = _places[TABLES * KEY_BITS :][:64]
_D = np.arange(-RADIUS, RADIUS + 1)
_DISC = (_D[:, None] ** 2 + _D[None, :] ** 2 <= RADIUS * RADIUS).astype(np.float32)

#: Closest matches of two pictures that may prove one scene.
PROOF = 160

FEATURE = "image_id long, d1 long, d2 long, n_corners int, error string, points binary, words binary"
FIRST = "a long, b long, n int, key int, cell int, side int, check long"


class Unreadable(ValueError):
    """Bytes that are no picture, or one of a kind that is not read."""


def decode(data: bytes | None) -> np.ndarray:
    """Grey pixels of a PNG (any depth and kind, interlaced or not), PGM or PPM; raises Unreadable for all else."""
    if not data:
        raise Unreadable("empty")
    data = bytes(data)
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return _png(data)
        if data[:2] in (b"P5", b"P6"):
            fields, at = [], 2
            while len(fields) < 3:
                while data[at : at + 1].isspace() or data[at : at + 1] == b"#":
                    at = data.index(b"\n", at) + 1 if data[at : at + 1] == b"#" else at + 1
                end = at
                while not data[end : end + 1].isspace():
                    end += 1
                fields.append(int(data[at:end]))
                at = end
            width, height, top = fields
            planes = 1 if data[1:2] == b"5" else 3
            pixels = np.frombuffer(data, np.uint8 if top < 256 else ">u2", width * height * planes, at + 1).reshape(height, width, planes)
            return _grey(pixels.astype(np.float32) * (255 / top))
    except (ValueError, IndexError, KeyError, ZeroDivisionError, struct.error, zlib.error) as e:
        raise Unreadable("damaged") from e
    if data[:2] == b"\xff\xd8" or data[:3] == b"GIF" or data[8:12] == b"WEBP":
        raise Unreadable("kind not read")
    raise Unreadable("no picture")


def _grey(pixels: np.ndarray) -> np.ndarray:
    return (pixels[:, :, 0] if pixels.shape[2] < 3 else pixels[:, :, :3] @ np.array([0.299, 0.587, 0.114], np.float32)).astype(np.float32)


#: First row, first column, row step and column step of the passes of an interlaced PNG (fixed by its format).
_PASSES = ((0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1))


def _png(data: bytes) -> np.ndarray:
    at, body, palette, head = 8, [], None, None
    while at + 8 <= len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        chunk = data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", chunk)
        elif kind == b"PLTE":
            palette = np.frombuffer(chunk, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body.append(chunk)
        at += 12 + n
    width, height, depth, kind, _, _, laced = head or (0, 0, 0, -1, 0, 0, 0)
    planes = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[kind]
    raw, at = zlib.decompress(b"".join(body)), 0
    pixels = np.zeros((height, width, planes), np.uint16)
    for y, x, down, right in _PASSES if laced else ((0, 0, 1, 1),):
        h, w = -(-(height - y) // down), -(-(width - x) // right)
        if h > 0 and w > 0:
            line = -(-w * planes * depth // 8)
            rows = np.frombuffer(raw, np.uint8, h * (1 + line), at).reshape(h, 1 + line)
            at += h * (1 + line)
            pixels[y::down, x::right] = _samples(_unfiltered(rows, max(1, planes * depth // 8)), w * planes, depth).reshape(h, w, planes)
    if kind == 3:
        return _grey(palette[pixels[:, :, 0]].astype(np.float32))
    return _grey(pixels.astype(np.float32) * np.float32(255 / ((1 << depth) - 1)))


def _samples(rows: np.ndarray, n: int, depth: int) -> np.ndarray:
    if depth == 16:
        return np.ascontiguousarray(rows).view(">u2")[:, :n].astype(np.uint16)
    if depth == 8:
        return rows[:, :n].astype(np.uint16)
    bits = np.unpackbits(rows, axis=1)[:, : n * depth].reshape(len(rows), n, depth)
    return bits @ (1 << np.arange(depth - 1, -1, -1)).astype(np.uint16)


def _unfiltered(rows: np.ndarray, step: int) -> np.ndarray:
    """Bytes of filtered lines (each led by its filter's number); all lines go together, along diagonals."""
    kind = rows[:, 0].astype(np.int32)
    h, w = rows.shape[0], -(-(rows.shape[1] - 1) // step)
    raw = np.zeros((h, w * step), np.int32)
    raw[:, : rows.shape[1] - 1] = rows[:, 1:]
    raw = raw.reshape(h, w, step)
    out = np.zeros((h + 1, w + 1, step), np.int32)
    if not kind.any():
        out[1:, 1:] = raw
    else:
        for d in range(h + w - 1):
            y = np.arange(max(0, d - w + 1), min(h, d + 1))
            x = d - y
            a, b, c, k = out[y + 1, x], out[y, x + 1], out[y, x], kind[y, None]
            pa_, pb, pc = np.abs(b - c), np.abs(a - c), np.abs(a + b - 2 * c)
            guess = np.where((pa_ <= pb) & (pa_ <= pc), a, np.where(pb <= pc, b, c))
            out[y + 1, x + 1] = (raw[y, x] + np.select([k == 1, k == 2, k == 3, k == 4], [a, b, (a + b) >> 1, guess], 0)) & 255
    return out[1:, 1:].reshape(h, w * step)[:, : rows.shape[1] - 1].astype(np.uint8)


def _blur(p: np.ndarray) -> np.ndarray:
    for axis in (0, 1):
        n = np.pad(p, [(2, 2) if a == axis else (0, 0) for a in (0, 1)], mode="edge")
        cut = [n[k : k + p.shape[0]] if axis == 0 else n[:, k : k + p.shape[1]] for k in range(5)]
        p = (cut[0] + cut[4] + 4 * (cut[1] + cut[3]) + 6 * cut[2]) / 16
    return p


def _resize(p: np.ndarray, scale: float) -> np.ndarray:
    """``p`` made smaller by ``scale`` about its centre, so that a turned picture shrinks to a turned one."""
    h, w = max(1, round(p.shape[0] / scale)), max(1, round(p.shape[1] / scale))
    y = ((np.arange(h) - (h - 1) / 2) * scale + (p.shape[0] - 1) / 2).clip(0, p.shape[0] - 1)
    x = ((np.arange(w) - (w - 1) / 2) * scale + (p.shape[1] - 1) / 2).clip(0, p.shape[1] - 1)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, p.shape[0] - 1), np.minimum(x0 + 1, p.shape[1] - 1)
    fy, fx = (y - y0).astype(np.float32)[:, None], (x - x0).astype(np.float32)[None, :]
    a, b = p[y0], p[y1]
    return (a[:, x0] * (1 - fx) + a[:, x1] * fx) * (1 - fy) + (b[:, x0] * (1 - fx) + b[:, x1] * fx) * fy


def describe(pixels: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(n, 2) places (in parts of a pixel) of the strongest corners, the strongest first, and (n, 4) words of their 256 bits."""
    none = np.zeros((0, 2), np.uint16), np.zeros((0, 4), np.uint64)
    if pixels is None or min(pixels.shape) <= 2 * RADIUS + 2:
        return none
    base = _blur(pixels.astype(np.float32))
    levels = []
    for scale in SCALES:
        p = base if scale == 1 else _resize(base, scale)
        if min(p.shape) <= 2 * RADIUS + 2:
            break
        gy, gx = np.gradient(p)
        xx, yy, xy = _blur(gx * gx), _blur(gy * gy), _blur(gx * gy)
        strength = np.round((xx + yy) / 2 - np.sqrt(((xx - yy) / 2) ** 2 + xy * xy), 3)
        strength[:RADIUS] = strength[-RADIUS:] = 0
        strength[:, :RADIUS] = strength[:, -RADIUS:] = 0
        h, w = strength.shape
        wide = np.pad(strength, 2)
        wide = np.max([wide[a : a + h] for a in range(5)], axis=0)
        peak = np.max([wide[:, b : b + w] for b in range(5)], axis=0)
        y, x = np.nonzero((strength == peak) & (strength > 4))
        levels.append((p, scale, y, x, strength[y, x]))
    found = np.concatenate([v[4] for v in levels])
    if not len(found):
        return none
    limit = CORNERS + pixels.size // AREA
    least = -np.partition(-found, min(len(found), limit) - 1)[min(len(found), limit) - 1]
    points, words, strengths = [], [], []
    for p, scale, y, x, strength in levels:
        ok = strength >= least
        if not ok.any():
            continue
        y, x = y[ok], x[ok]
        patch = p[y[:, None, None] + _D[None, :, None], x[:, None, None] + _D[None, None, :]] * _DISC
        across, along = (patch.sum(1) * _D).sum(1), (patch.sum(2) * _D).sum(1)
        far = np.maximum(np.hypot(across, along), 1e-9)
        c, s = (across / far)[:, None, None], (along / far)[:, None, None]
        ox, oy = _PAIRS[None, :, :, 0] * RADIUS, _PAIRS[None, :, :, 1] * RADIUS
        px = (x[:, None, None] + c * ox - s * oy).clip(0, p.shape[1] - 1.001)
        py = (y[:, None, None] + s * ox + c * oy).clip(0, p.shape[0] - 1.001)
        ix, iy = px.astype(np.int32), py.astype(np.int32)
        fx, fy = (px - ix).astype(np.float32), (py - iy).astype(np.float32)
        at, flat, wide = iy * p.shape[1] + ix, np.ravel(p), p.shape[1]
        v = (flat[at] * (1 - fx) + flat[at + 1] * fx) * (1 - fy) + (flat[at + wide] * (1 - fx) + flat[at + wide + 1] * fx) * fy
        words.append(np.packbits(v[:, :, 0] < v[:, :, 1], axis=1).view(np.uint64))
        places = [(place - (size - 1) / 2) * scale + (full - 1) / 2 for place, size, full in ((x, p.shape[1], pixels.shape[1]), (y, p.shape[0], pixels.shape[0]))]
        points.append(np.stack(places, 1))
        strengths.append(strength[ok])
    order = np.argsort(-np.concatenate(strengths), kind="stable")
    points = np.round(np.concatenate(points)[order] * _PART).clip(0, 65535).astype(np.uint16)
    return points, np.concatenate(words)[order]


def few_splits(rows: DataFrame) -> int:
    """0, or how many tasks to deal ``rows`` to, if reading them gives too few to keep all cores busy.

    Describing a picture takes milliseconds, so tables of a few splits are worth a shuffle, and large ones are not.
    """
    spark = rows.sparkSession
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    tasks = 2 * spark.sparkContext.defaultParallelism
    return max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))) if size // split < tasks else 0


def features(images: DataFrame, id_col: str, image_col: str, pixels: Callable[[object], np.ndarray | None]) -> DataFrame:
    rows = images.select(F.col(f"`{id_col}`").cast("long").alias("image_id"), F.col(f"`{image_col}`").alias("image"))
    few = few_splits(rows)
    if few:  # else the pictures are read where they are
        rows = rows.repartition(few)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                out = []
                for value in part.column("image"):
                    p, error = None, None
                    try:
                        p = pixels(value.as_py())
                    except Unreadable as e:
                        error = str(e)
                    if p is None:
                        out.append((None, None, 0, error or "empty", b"", b""))
                        continue
                    points, words = describe(p)
                    digest = hashlib.blake2b(repr(p.shape).encode() + np.ascontiguousarray(p, np.float32).tobytes(), digest_size=16).digest()
                    out.append((*struct.unpack("<qq", digest), len(points), None, points.tobytes(), words.tobytes()))
                cols = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("image_id"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], ["image_id", "d1", "d2", "n_corners", "error", "points", "words"])

    return rows.mapInArrow(run, FEATURE)


def _numbers(bits: np.ndarray) -> np.ndarray:
    """Rows of up to 64 bits as integers."""
    full = np.zeros((len(bits), 64), np.uint8)
    full[:, : bits.shape[1]] = bits
    return np.packbits(full, axis=1, bitorder="little").view(np.int64).ravel()


def table_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(corners, tables) keys of 256-bit descriptors, and each one's 64 bits of check."""
    bits = np.unpackbits(words.view(np.uint8).reshape(len(words), 32), axis=1)
    keys = np.stack([_numbers(bits[:, places]) | t << KEY_BITS for t, places in enumerate(_KEYS)], 1) if len(words) else np.zeros((0, TABLES), np.int64)
    return keys.astype(np.int32), _numbers(bits[:, _CHECK])


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1)


def matches(wa: np.ndarray, wb: np.ndarray, rows: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and distances of descriptors that are each other's nearest and differ in at most DIFFER bits."""
    to, far = np.zeros(len(wa), np.int64), np.zeros(len(wa), np.int64)
    back, least = np.zeros(len(wb), np.int64), np.full(len(wb), 257)
    for a in range(0, len(wa), rows):
        d = differing(wa[a : a + rows, None, :], wb[None, :, :])
        to[a : a + rows] = d.argmin(1)
        far[a : a + rows] = d.min(1)
        low = d.min(0)
        closer = low < least
        back[closer], least[closer] = a + d.argmin(0)[closer], low[closer]
    i = np.flatnonzero((far <= DIFFER) & (back[to] == np.arange(len(to))))
    return i, to[i], far[i]


def same_scene(pa_: np.ndarray, wa: np.ndarray, pb: np.ndarray, wb: np.ndarray) -> bool:
    """Whether one similarity transform carries AGREE corners onto matching corners.

    Of more than ``PROOF`` matches the closest ones are tried.
    """
    if len(wa) < AGREE or len(wb) < AGREE:
        return False
    i, j, far = matches(wa, wb)
    if len(i) < AGREE:
        return False
    order = np.argsort(far, kind="stable")[:PROOF]
    a, b = pa_[i[order]] / _PART, pb[j[order]] / _PART
    za, zb = a[:, 0] + 1j * a[:, 1], b[:, 0] + 1j * b[:, 1]
    # every two matches fix a transform z -> m z + t
    x, y = np.triu_indices(len(za), 1)
    gap = za[y] - za[x]
    ok = np.abs(gap) > 4
    if not ok.any():
        return False
    x, y = x[ok], y[ok]
    m = (zb[y] - zb[x]) / gap[ok]
    size = np.abs(m)
    ok = (size > 0.4) & (size < 2.5)
    m, x = m[ok], x[ok]
    t = zb[x] - m * za[x]
    near = np.abs(m[:, None] * za[None, :] + t[:, None] - zb[None, :]) <= 3 + 1.5 * np.abs(m)[:, None]
    for row in near[np.argsort(-near.sum(1), kind="stable")]:
        if row.sum() < AGREE:
            return False
        if len(np.unique(np.round(za[row] / 3))) >= AGREE:
            return True
    return False


def close_pairs(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the close pairs of unlike pictures in whole cells (the larger picture first), and each row's cell."""
    rep, check, side, key, cell = (t.column(c).to_numpy() for c in ("rep", "check", "side", "key", "cell"))
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])]))
    size = np.diff(np.append(new, len(key)))
    highs, lows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def add(x: np.ndarray, y: np.ndarray) -> None:
        ok = (np.bitwise_count(check[x] ^ check[y]) <= CHECK) & (rep[x] != rep[y]) & ((side[x] == 0) | (side[x] != side[y]))
        x, y = x[ok], y[ok]
        up = rep[x] > rep[y]
        highs.append(np.where(up, x, y))
        lows.append(np.where(up, y, x))

    for m in np.unique(size[(size > 1) & (size <= 64)]):  # small cells of one size at once
        i, j = np.triu_indices(m, 1)
        base = new[size == m]
        for a in range(0, len(base), max(1, (1 << 19) // len(i))):
            own = base[a : a + max(1, (1 << 19) // len(i)), None]
            add((own + i).ravel(), (own + j).ravel())
    for a, m in zip(new[size > 64].tolist(), size[size > 64].tolist(), strict=True):
        for k in range(0, m, 256):
            i, j = np.meshgrid(np.arange(k, min(m, k + 256)), np.arange(k + 1, m), indexing="ij")
            ok = j > i
            add(a + i[ok], a + j[ok])
    high, low = np.concatenate(highs), np.concatenate(lows)
    order = np.lexsort((rep[low], high))
    return high[order], low[order], np.repeat(np.arange(len(new)), size)


def _votes(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)
    return a[first], b[first], np.diff(np.append(first, len(a)))


def first_votes(members: DataFrame) -> DataFrame:
    """Votes (a, b, n) of each member with the smallest picture that it is close to, and (with a null b) the
    close members of the cells that hold other close pairs too."""
    names = [f.split()[0] for f in FIRST.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _grouped(batches, ["key", "cell"]):
            high, low, group = close_pairs(t)
            if not len(high):
                continue
            rep = t.column("rep").to_numpy()
            leads = np.concatenate([[True], high[1:] != high[:-1]])
            a, b, n = _votes(rep[high[leads]], rep[low[leads]])
            blank = [pa.nulls(len(a), k) for k in (pa.int32(), pa.int32(), pa.int32(), pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n.astype(np.int32)), *blank], names)
            more = np.unique(group[high[~leads]])
            if len(more):
                own = np.unique(np.concatenate([high, low]))
                own = own[np.isin(group[own], more)]
                keep = pa.array(own)
                cols = [t.column(c).combine_chunks().take(keep) for c in ("key", "cell", "side", "check")]
                yield pa.RecordBatch.from_arrays([pa.array(rep[own]), pa.nulls(len(own), pa.int64()), pa.nulls(len(own), pa.int32()), *cols], names)

    return members.mapInArrow(run, FIRST)


def other_votes(members: DataFrame) -> DataFrame:
    """Votes (a, b, n) of the close pairs of unlike ``label`` that first_votes passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _grouped(batches, ["key", "cell"]):
            high, low, _ = close_pairs(t)
            rep, label = t.column("rep").to_numpy(), t.column("label").to_numpy()
            leads = np.concatenate([[True], high[1:] != high[:-1]]) if len(high) else np.zeros(0, bool)
            lead_of = np.full(len(rep), -1, np.int64)
            lead_of[high[leads]] = rep[low[leads]]
            ok = (rep[low] != lead_of[high]) & (label[low] != label[high])
            a, b, n = _votes(rep[high[ok]], rep[low[ok]])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n.astype(np.int32))], ["a", "b", "n"])

    return members.mapInArrow(run, "a long, b long, n int")


def verified(cells: DataFrame) -> DataFrame:
    """The links (a, b) of each cell's leader (side 1) with the others that show its scene."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _grouped(batches, ["key", "cell"]):
            key, rep, side = (t.column(c).to_numpy() for c in ("key", "rep", "side"))
            cell = t.column("cell").to_numpy()
            points = [np.frombuffer(x, np.uint16).reshape(-1, 2) for x in t.column("points").to_pylist()]
            words = [np.frombuffer(x, np.uint64).reshape(-1, 4) for x in t.column("words").to_pylist()]
            lead = {(k, c): i for i, (k, c, s) in enumerate(zip(key.tolist(), cell.tolist(), side.tolist(), strict=True)) if s == 1}
            found = []
            for i, (k, c, s) in enumerate(zip(key.tolist(), cell.tolist(), side.tolist(), strict=True)):
                j = lead[k, c]
                if s == 2 and same_scene(points[j], words[j], points[i], words[i]):
                    found.append((int(rep[i]), int(rep[j])))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    return cells.mapInArrow(run, "a long, b long")


def copies(images: DataFrame, *, id_col: str = "image_id", image_col: str = "image", pixels: Callable[[object], np.ndarray | None] = decode, block: int = BLOCK) -> DataFrame:
    """One row per row of ``images``: image_id, n_corners, error, component_id (smallest id of its copies) and kept.

    ``pixels`` gives grey pixels, None for an empty value, or raises Unreadable.  Pictures that are null or cannot be
    read stand alone and say why in ``error``; those too small for a corner's patch have no corners.  Equal
    pictures are copies even without corners.  Rows with a null id take part; component_id is null where no copy has an
    id, and such rows are kept.  Other columns are not read.
    """
    spark = images.sparkSession
    tables = Tables(spark)

    def connected(edges: DataFrame, rows: int) -> DataFrame:
        found, path = components(edges, rows)
        tables.paths.append(path)
        return found

    full, full_at = written(features(images, id_col, image_col, pixels), "pictures")
    classes = full.filter("d1 is not null").groupBy("d1", "d2").agg(F.min("image_id").alias("first_id"), F.first("points").alias("points"), F.first("words").alias("words"))
    # the table is written once, so its numbers name the classes from here on
    reps, n = tables.keep(classes.withColumn("rep", F.monotonically_increasing_id()), "picture_classes")
    feats, _ = tables.keep(full.select("image_id", "n_corners", "error", "d1", "d2"), "pictures")
    remove(spark, full_at)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                lists = part.column("words").to_pylist()
                keys, check = table_keys(np.frombuffer(b"".join(lists), np.uint64).reshape(-1, 4))
                rep = np.repeat(part.column("rep").to_numpy(), [len(x) // 32 for x in lists])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(rep, TABLES)), pa.array(np.repeat(check, TABLES))], ["key", "rep", "check"])

    keys = reps.select("rep", "words").mapInArrow(keyed, "key int, rep long, check long")
    hot, _ = tables.keep(keys.select("key").groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > block), "hot")
    dealt = _cells(keys.join(hot, "key", "left").withColumn("members", F.coalesce("members", F.lit(1))), "key", "members", "rep", block)
    first, n_first = tables.keep(first_votes(dealt.repartition("key", "cell").sortWithinPartitions("key", "cell")), "votes")
    lead, n_lead = tables.keep(first.filter("b is not null").groupBy("a", "b").agg(F.sum("n").alias("n")), "votes", rows=n_first)

    def verify(pairs: DataFrame, rows: int) -> tuple[DataFrame, int]:
        tasks, rows = led_cells(tables, pairs.select(F.least("a", "b").alias("key"), F.greatest("a", "b").alias("rep")), rows, block)
        shown = tasks.join(reps.select("rep", "points", "words").hint("merge"), "rep")
        return verified(shown.repartition("key", "cell").sortWithinPartitions("key", "cell")), rows

    links = connected(*verify(lead.filter(F.col("n") >= SEEN), n_lead))
    label = links.select(F.col("node").alias("rep"), F.col("component").alias("label"))
    left = first.filter("b is null").select("key", "cell", "side", F.col("a").alias("rep"), "check").join(label, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    others, n_others = tables.keep(other_votes(left.repartition("key", "cell").sortWithinPartitions("key", "cell")), "votes", rows=n_first)
    both = others.withColumn("new", F.lit(1)).unionByName(lead.select("a", "b", F.col("n").cast("int").alias("n"), F.lit(0).alias("new")))
    pairs = both.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("new").alias("new")).filter((F.col("n") >= SEEN) & (F.col("new") == 1))
    more, rows = verify(pairs, n_others)
    linked = connected(links.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more), n + rows)
    grouped = reps.select("rep", "d1", "d2", "first_id").join(linked.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    by_group, _ = tables.keep(grouped.groupBy("component").agg(F.min("first_id").alias("component_id")), "groups", rows=n)
    by_class = grouped.join(by_group.hint("merge"), "component").select("d1", "d2", "component_id", F.lit(True).alias("found"))
    out = feats.join(by_class, ["d1", "d2"], "left").select("image_id", "n_corners", "error", F.when(F.col("found"), F.col("component_id")).otherwise(F.col("image_id")).alias("component_id"))
    result, _ = written(out.withColumn("kept", F.col("image_id").eqNullSafe(F.col("component_id"))), "picture_copies")
    tables.remove()
    return result


_grid = np.arange(64) / 64
_waves = _rng.integers(1, 9, (64, 2))
_phases = _rng.uniform(0, 2 * np.pi, (64, 2))


def painted(vector: list[float] | None) -> np.ndarray | None:
    """The 64 x 64 picture that a vector paints: a sum of plane waves with its numbers as weights.

    Stands in for a media column, which no test table has.  Null, non-finite or empty: None.
    """
    if not vector:
        return None
    v = np.array([np.nan if x is None else x for x in vector], float)
    if not np.isfinite(v).all():
        return None
    v = v[np.arange(64) % len(v)] / max(1e-12, np.abs(v).max())
    gx = np.sin(2 * np.pi * _waves[:, :1] * _grid + _phases[:, :1])
    gy = np.sin(2 * np.pi * _waves[:, 1:] * _grid + _phases[:, 1:])
    p = (gy * v[:, None]).T @ gx
    low, high = p.min(), p.max()
    return np.round((p - low) * (255 / (high - low)) if high > low else p * 0).astype(np.float32)


def op4_picture_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies among the pictures that all embeddings paint."""
    return copies(table(spark, sf_dir, "embeddings"), id_col="vec_id", image_col="embedding", pixels=painted)
