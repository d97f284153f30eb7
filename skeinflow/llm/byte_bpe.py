"""Byte-level BPE ids of whole texts by the tokenizers library, each distinct piece encoded once.

The library's pre-tokenizer never joins a space to what stands before it, and never breaks the bond
between a single space and a visible character after it.  So a text may be cut before every space
that a visible character follows, and the ids of the text are the ids of the pieces in order.
Distinct pieces (by a 64-bit hash) are encoded by the library and kept for the worker's life.  What was looked
up is then spelled out and compared with the text, byte by byte: a row in which two pieces met in one hash
goes to the library as a whole.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from .common import U64, flat, hash_spans, ranges, same_spans

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Bytes that may follow a cut: visible ASCII, and lead bytes that begin no Unicode white space.
_VISIBLE = np.zeros(256, bool)
_VISIBLE[33:127] = True
_VISIBLE[[b for b in range(0xC3, 0xF5) if b not in (0xE1, 0xE2, 0xE3)]] = True
#: Distinct pieces that a worker keeps; beyond, it starts anew.
KEEP = 2_400_000
#: Bytes of text that are encoded at once: repeats within it cost no lookup.
BLOCK_BYTES = 2 << 20
#: New pieces that are kept apart until they are merged into the sorted store.
RECENT = 200_000

_encoders: dict[str, "PieceEncoder"] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str) -> "PieceEncoder":
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else 256 and on."""
    out, more = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(more))
            more += 1
    return out


class PieceEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocab = self.library.get_vocab(with_added_tokens=True)
        added = {t.content for t in self.library.get_added_tokens_decoder().values()}
        if max(vocab.values()) > 65535:
            raise ValueError("ids of more than 16 bits are not kept")
        self.begins = np.zeros(max(vocab.values()) + 1, bool)
        self.begins[[i for t, i in vocab.items() if t.startswith("Ġ")]] = True
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        spelled = [b""] * len(self.begins)
        for t, i in vocab.items():
            spelled[i] = t.encode() if t in added else bytes(byte_of[c] for c in t)
        self.n_bytes = np.array([len(x) for x in spelled], np.int64)
        self.bytes_at, self.bytes = np.cumsum(self.n_bytes) - self.n_bytes, np.frombuffer(b"".join(spelled) + bytes(8), np.uint8)
        self._reset()

    def _reset(self) -> None:
        # sorted keys with places and counts of ids: the store, and the pieces met since the last merge
        self.tables = [(np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int32)) for _ in range(2)]
        self.ids, self.used = np.zeros(1 << 20, np.uint16), 0

    def _add(self, level: int, keys: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
        own = self.tables[level]
        where = np.searchsorted(own[0], keys)
        self.tables[level] = tuple(np.insert(a, where, b) for a, b in zip(own, (keys, at, n), strict=True))

    def _store(self, ids: np.ndarray) -> int:
        need = self.used + len(ids)
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(need - len(self.ids), len(self.ids) // 2), self.ids.dtype)])
        self.ids[self.used : need] = ids
        at, self.used = self.used, need
        return at

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after another, and each one's count."""
        simple = [k for k, p in enumerate(pieces) if p[:1] == b" " and p.count(b" ") == 1]
        done = np.zeros(len(pieces), bool)
        who, ids, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for a in range(0, len(simple), 4096):
            own = simple[a : a + 4096]
            runs = [own[b : b + 64] for b in range(0, len(own), 64)]
            got = self.library.encode_batch_fast([b"".join(pieces[k] for k in run).decode() for run in runs], add_special_tokens=False)
            for run, e in zip(runs, got, strict=True):
                have = np.array(e.ids, np.uint32)
                starts = np.flatnonzero(self.begins[have])
                if len(starts) == len(run) and starts[0] == 0:
                    n = np.empty(len(run), np.int64)
                    n[:-1], n[-1] = starts[1:] - starts[:-1], len(have) - starts[-1]
                    who.append(np.array(run))
                    ids.append(have)
                    counts.append(n)
                    done[run] = True
        rest = np.flatnonzero(~done).tolist()
        for a in range(0, len(rest), 4096):
            got = [e.ids for e in self.library.encode_batch_fast([pieces[k].decode() for k in rest[a : a + 4096]], add_special_tokens=False)]
            ids.append(np.fromiter(chain.from_iterable(got), np.uint32))
            counts.append(np.fromiter(map(len, got), np.int64, len(got)))
        who.append(np.array(rest, np.int64))
        who, ids, n = np.concatenate(who), np.concatenate(ids), np.concatenate(counts)
        at, counts = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        at[who], counts[who] = np.cumsum(n) - n, n
        return ids[ranges(at, counts)], counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (uint32) of all rows one after another, and each row's count.  Null is the empty text."""
        data, ends = flat(texts)
        n = len(data)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        cut = np.zeros(n + 1, bool)
        cut[:-2] = (data[:-1] == 32) & _VISIBLE[data[1:]]
        last = ends[1:] - 1
        cut[last[ends[1:] > ends[:-1]]] = False  # what follows is another row
        cut[ends] = True
        bounds = np.flatnonzero(cut)
        start, end = bounds[:-1], bounds[1:]
        keys, first, which = np.unique(hash_spans(data, start, end), return_index=True, return_inverse=True)
        if len(self.tables[0][0]) > KEEP:
            self._reset()
        at, n = np.zeros(len(keys), np.int64), np.full(len(keys), -1, np.int32)
        for have, places, counts in self.tables:
            slot = np.minimum(np.searchsorted(have, keys), max(0, len(have) - 1))
            hit = have[slot] == keys if len(have) else np.zeros(len(keys), bool)
            at[hit], n[hit] = places[slot[hit]], counts[slot[hit]]
        new = np.flatnonzero(n < 0)
        if len(new):
            raw = data.tobytes()
            ids, counts = self._encode([raw[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)])
            at[new], n[new] = self._store(ids) + np.cumsum(counts) - counts, counts
            self._add(1, keys[new], at[new], n[new])
            if len(self.tables[1][0]) > RECENT:
                self._add(0, *self.tables[1])
                self.tables[1] = tuple(a[:0] for a in self.tables[1])
        lengths = n[which].astype(np.int64)
        ids = self.ids[ranges(at[which], lengths)].astype(np.uint32)
        sums = np.concatenate([[0], np.cumsum(lengths)])
        per_row = np.diff(sums[np.searchsorted(bounds, ends)])
        return self._checked(texts, data, ends, ids, per_row, end, sums[1:])

    def _checked(self, texts: pa.Array, data: np.ndarray, ends: np.ndarray, ids: np.ndarray, per_row: np.ndarray, piece_end: np.ndarray, id_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts, with the library's own in rows with a piece whose ids do not spell its bytes."""
        size = self.n_bytes[ids]
        reach = np.cumsum(size)
        if int(reach[-1]) == len(data) and np.array_equal(reach[id_end - 1], piece_end) and same_spans(data, reach - size, size, self.bytes, self.bytes_at[ids]).all():
            return ids, per_row
        own, a, p = [], 0, 0
        for k, n in enumerate(per_row.tolist()):
            got = ids[a : a + n]
            q = int(np.searchsorted(id_end, a + n, "right"))
            fits = np.array_equal(np.cumsum(size[a : a + n])[id_end[p:q] - 1 - a] + ends[k], piece_end[p:q])
            if not fits or not np.array_equal(self.bytes[ranges(self.bytes_at[got], self.n_bytes[got])], data[ends[k] : ends[k + 1]]):
                got = np.array(self.library.encode(texts[k].as_py() or "", add_special_tokens=False).ids, np.uint32)
            own.append(got)
            a, p = a + n, q
        return np.concatenate(own), np.array([len(x) for x in own], np.int64)
