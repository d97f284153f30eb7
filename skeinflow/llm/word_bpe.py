"""Word-level BPE encoding and decoding by batched numpy merge rounds.

Symbols of many words lie in one flat array.  Each round looks up the rank of every new adjacent pair
by binary search over the sorted pair keys, merges each word's lowest-ranked pair, and drops words
that are done.  Only the tokenizer's vocabulary and merge list are read from its file.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .byte_bpe import byte_alphabet
from .common import U64, blocks, doc_text, flat, hash_spans, ranges, same_spans, table

_NONE = np.int32(2**31 - 1)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
#: Distinct white-space-free spans that a worker keeps, and bytes of them; beyond, it starts anew.
KEEP = 2_000_000
KEEP_BYTES = 64 << 20

_models: dict[str, "WordBPE"] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def model(path: str) -> "WordBPE":
    if path not in _models:
        _models[path] = WordBPE(path)
    return _models[path]


class Texts:
    """Byte strings by number in one flat array."""

    def __init__(self, items: list[bytes]):
        self.n = np.array([len(x) for x in items], np.int64)
        self.at = np.cumsum(self.n) - self.n
        self.data = np.frombuffer(b"".join(items), np.uint8)

    def join(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = self.n[ids]
        return self.data[ranges(self.at[ids], n)], n


class Store:
    """A growing flat array of byte or id runs, with eight spare places at its end."""

    def __init__(self, kind: type):
        self.data, self.used = np.zeros(1 << 16, kind), 0

    def add(self, values: np.ndarray) -> int:
        need = self.used + len(values)
        if need + 8 > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(need, len(self.data)), self.data.dtype)])
        self.data[self.used : need] = values
        at, self.used = self.used, need
        return at


class WordBPE:
    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        vocab = dict(spec["model"]["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        suffix = spec["model"]["end_of_word_suffix"] or ""
        chars = byte_alphabet()
        self.base = np.array([vocab[c] for c in chars], np.int32)
        self.base_end = np.array([vocab[c + suffix] for c in chars], np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        a, b = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        made = np.array([vocab[x + y] for x, y in pairs], np.int32)
        keys = a << 32 | b
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = made
        # merging all places of a pair at once equals merging one by one if no merge can precede its parts
        latest = np.full(max(vocab.values()) + 1, -1)
        np.maximum.at(latest, made, np.arange(len(made)))
        self.at_once = bool((latest[a] < np.arange(len(a))).all() and (latest[b] < np.arange(len(b))).all())
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        names = [names.get(i, "") for i in range(max(names) + 1)]
        self.decimal = Texts([b"%d " % i for i in range(len(names))])
        self.strings = Texts([t.encode() + b" " for t in names])
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in self.special) + ")") if self.special else None
        self._reset()

    def _reset(self) -> None:
        self.seen, self.slot = np.zeros(0, U64), np.zeros(0, np.int64)
        self.ids, self.id_at, self.id_n = Store(np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.raw, self.raw_at, self.raw_n = Store(np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _keep(self, items: list[bytes]) -> np.ndarray:
        """Encode spans and keep them; their slots."""
        ids, counts = self._encode_spans([x.decode() for x in items])
        size = np.array([len(x) for x in items], np.int64)
        slots = len(self.id_n) + np.arange(len(items))
        self.id_at = np.concatenate([self.id_at, self.ids.add(ids) + np.cumsum(counts) - counts])
        self.raw_at = np.concatenate([self.raw_at, self.raw.add(np.frombuffer(b"".join(items), np.uint8)) + np.cumsum(size) - size])
        self.id_n, self.raw_n = np.concatenate([self.id_n, counts]), np.concatenate([self.raw_n, size])
        return slots

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[k] == key, self.ranks[k], _NONE)

    def merge(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of byte words (one after another, none empty) and each word's count."""
        n = len(lengths)
        if not n:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        ends = np.cumsum(lengths)
        sym = self.base[data]
        sym[ends - 1] = self.base_end[data[ends - 1]]
        word = np.repeat(np.arange(n), lengths)
        rank = np.full(len(sym), _NONE, np.int32)
        same = word[1:] == word[:-1]
        at = np.flatnonzero(same)
        rank[at] = self.ranks_of(sym[at], sym[at + 1])
        done_sym, done_word = [], []
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            low = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(sym)))
            over = low == _NONE
            if over.any():
                out = np.repeat(over, size)
                done_sym.append(sym[out])
                done_word.append(word[out])
                sym, word, rank = sym[~out], word[~out], rank[~out]
                low, size = low[~over], size[~over]
                if not len(sym):
                    break
            lows = np.repeat(low, size)
            hit = np.flatnonzero(rank == lows)
            if self.at_once:
                run = np.concatenate([[True], np.diff(hit) > 1])  # overlapping places: every other one from the left
                if not run.all():
                    start = np.flatnonzero(run)
                    hit = hit[(np.arange(len(hit)) - np.repeat(start, np.diff(np.append(start, len(hit))))) % 2 == 0]
            else:
                hit = hit[np.unique(word[hit], return_index=True)[1]]
            sym[hit] = self.made[rank[hit]]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            touched = np.zeros(len(sym), bool)
            touched[hit] = True
            touched[hit[hit > 0] - 1] = True
            touched[hit[hit > 1] - 2] |= ~keep[hit[hit > 1] - 1]
            sym, word, rank, touched = sym[keep], word[keep], rank[keep], touched[keep]
            at = np.flatnonzero(touched)
            rank[at] = _NONE
            at = at[at < len(sym) - 1]
            at = at[word[at] == word[at + 1]]
            rank[at] = self.ranks_of(sym[at], sym[at + 1])
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        return sym[np.argsort(word, kind="stable")], np.bincount(word, minlength=n)

    def _encode_spans(self, items: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of white-space-free spans and each one's count."""
        words: list[bytes] = []
        owner: list[int] = []
        fixed: list[tuple[int, int]] = []  # place among the words, id of a special token
        for k, item in enumerate(items):
            for part in self.split.split(item) if self.split and "<|" in item else (item,):
                if part in self.special:
                    fixed.append((len(words), self.special[part]))
                    words.append(b"?")
                    owner.append(k)
                elif part:
                    if not part.isascii():
                        part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
                    found = self.words.findall(part.lower())
                    words += [w.encode() for w in found]
                    owner += [k] * len(found)
        lengths = np.array([len(w) for w in words], np.int64)
        ids, counts = self.merge(np.frombuffer(b"".join(words), np.uint8), lengths)
        at = np.cumsum(counts) - counts
        for place, value in fixed:
            ids[at[place]] = value
        return ids, np.bincount(np.array(owner, np.int64), counts, len(items)).astype(np.int64)

    def spans(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of the stored span of each span of the rows, and each row's first span (n + 1)."""
        data, ends = flat(texts)
        inside = np.concatenate([[False], ~_WHITE[data], [False]])
        step = np.diff(inside.view(np.int8))
        start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        cut = np.unique(ends[1:-1])  # spans that cross rows are cut there
        cut = cut[(cut > 0) & (cut < len(data))]
        cut = cut[inside[cut] & inside[cut + 1]] if len(cut) else cut
        start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
        rows = np.searchsorted(start, ends)
        if not len(start):
            return np.zeros(0, np.int64), rows
        keys, first, which = np.unique(hash_spans(data, start, end), return_index=True, return_inverse=True)
        if len(self.seen) > KEEP or self.raw.used > KEEP_BYTES:
            self._reset()
        place = np.searchsorted(self.seen, keys)
        inner = place < len(self.seen)
        known = np.zeros(len(keys), bool)
        known[inner] = self.seen[place[inner]] == keys[inner]
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            slots = self._keep([raw[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)])
            self.seen, self.slot = np.insert(self.seen, place[new], keys[new]), np.insert(self.slot, place[new], slots)
            place = np.searchsorted(self.seen, keys)
        slot = self.slot[place][which]
        # a hash only finds the slot: spans whose bytes are others get slots of their own
        same = self.raw_n[slot] == end - start
        at = np.flatnonzero(same)
        same[at] = same_spans(data, start[at], end[at] - start[at], self.raw.data, self.raw_at[slot[at]])
        if not same.all():
            own = np.flatnonzero(~same)
            raw = data.tobytes()
            items = [raw[a:b] for a, b in zip(start[own].tolist(), end[own].tolist(), strict=True)]
            each = sorted(set(items))
            slots = dict(zip(each, self._keep(each).tolist(), strict=True))
            slot[own] = [slots[x] for x in items]
        return slot, rows

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, and each row's count.  Null is the empty text."""
        span, rows = self.spans(texts)
        n = self.id_n[span]
        sums = np.concatenate([[0], np.cumsum(n)])
        return self.ids.data[ranges(self.id_at[span], n)], np.diff(sums[rows])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """UTF-8 of each row's token strings joined by one space (the file names no decoder)."""
        return _rows(self.strings, ids, counts)

    def decimals(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        return _rows(self.decimal, ids, counts)


def _rows(strings: Texts, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    data, n = strings.join(ids)
    sums = np.concatenate([[0], np.cumsum(n)])
    at = sums[np.concatenate([[0], np.cumsum(counts)])].tolist()
    raw = data.tobytes()
    return [raw[a : max(a, b - 1)] for a, b in zip(at[:-1], at[1:], strict=True)]


def encode_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """doc_id, ids and the decoded text of each row; a null or empty text has no ids and decodes to ''.

    Repeated rows stay; columns beside id and text are not read.
    """
    path = tokenizer or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for batch in batches:
            texts = batch.column("text")
            for a, b in blocks(texts):
                ids, counts = bpe.encode(texts.slice(a, b - a))
                off = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                decoded = pa.array([x.decode() for x in bpe.decode(ids, counts)], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.ListArray.from_arrays(pa.array(off), pa.array(ids)), decoded], ["doc_id", "ids", "decoded"])

    return doc_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def document_digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """As encode_documents, with digests in place of ids and decoded text."""
    path = tokenizer or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for batch in batches:
            texts = batch.column("text")
            for a, b in blocks(texts):
                ids, counts = bpe.encode(texts.slice(a, b - a))
                hashed = [[hashlib.sha256(x).hexdigest() for x in f(ids, counts)] for f in (bpe.decimals, bpe.decode)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(counts, pa.int64()), *map(pa.array, hashed)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return doc_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded."""
    return document_digests(table(spark, sf_dir, "documents"))


