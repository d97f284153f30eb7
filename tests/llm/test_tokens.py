"""Token shards, packing, word BPE against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skeinflow.llm import byte_bpe, packing, wavelet, word_bpe

ODD = [
    "a  b", "  x", "foo \n bar", "\n  x ", None, "", " ", "a   b", "x <|endoftext|> y", "é à  ç", "'s 't don't", "tab\t b", "  　 z", "\x85 q \x85", "\x1c \x1d k",
    "aaaaaaaaaa " * 40, "ΣΟΦΟΣ İstanbul ½²", "😀😀😀 !!!???", "한국어 中文", "ﬁ Å", "x" * 5000, "same", "same",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en", k) for k, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, part string, seq int")  # names of the operators' own columns


def library(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def test_piecewise_ids_are_the_librarys():
    lib = Tokenizer.from_file(byte_bpe.default_path())
    ids, n = byte_bpe.encoder(byte_bpe.default_path()).encode(pa.array(ODD))
    want = [lib.encode(t or "", add_special_tokens=False).ids for t in ODD]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


def test_wavelet_matrix_operations():
    v = np.random.default_rng(0).zipf(1.4, 5000) % 3000
    m = wavelet.WaveletMatrix.build(v)
    assert (m.values() == v).all() and all(m.access(i) == v[i] for i in range(0, 5000, 37))
    for c in (1, 2, 7, 2999, 5000):
        at = np.flatnonzero(v == c)
        assert m.count(c) == len(at) and m.occurrences(c).tolist() == at.tolist() and m.rank(c, 2345) == (at < 2345).sum()
        assert [m.select(c, k) for k in range(len(at))][:20] == at[:20].tolist() and (not len(at) or m.select(c, len(at) - 1) == at[-1])
    for one in (np.zeros(0, int), np.array([0]), np.full(1025, 7)):
        assert (wavelet.WaveletMatrix.build(one).values() == one).all()
    shard = wavelet.TokenShard.from_bytes(wavelet.TokenShard.of([3, 9], [2, 3], np.array([5, 2, 8, 1, 2])).to_bytes())
    assert shard.doc_ids.tolist() == [3, 9] and shard.tokens(1).tolist() == [8, 1, 2]


def test_shards_round_trip(spark, docs, tmp_path):
    shards = wavelet.write_shards(docs, (tmp_path / "s").as_uri(), shard_tokens=50)
    got = {r["doc_id"]: r for r in wavelet.document_digests(shards).collect()}
    start = 0
    for k, t in enumerate(ODD):
        ids = [*library(byte_bpe.default_path(), t), 2]
        assert (got[k]["start"], got[k]["n_tokens"], got[k]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), k
        start += len(ids)
    assert shards.count() > 2
    repeated = docs.selectExpr("CASE WHEN doc_id % 3 = 0 THEN null WHEN doc_id % 3 = 1 THEN 7 ELSE doc_id END AS doc_id", "text")
    read = wavelet.document_digests(wavelet.write_shards(repeated, (tmp_path / "n").as_uri(), shard_tokens=50)).orderBy("start").collect()
    want = sorted(((None if k % 3 == 0 else 7 if k % 3 == 1 else k, zlib.crc32(np.array([*library(byte_bpe.default_path(), t), 2], "<u4").tobytes())) for k, t in enumerate(ODD)), key=str)
    assert sorted(((r["doc_id"], r["ids_crc32"]) for r in read), key=str) == want
    ids = [r["doc_id"] for r in read]
    assert ids == sorted(ids, key=lambda i: (i is not None, i)) and [r["start"] for r in read] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in read])])[:-1].tolist()
    assert wavelet.token_counts(shards, [2]).agg(F.sum("n")).first()[0] >= len(ODD)
    assert wavelet.document_digests(wavelet.write_shards(docs.limit(0), (tmp_path / "e").as_uri())).count() == 0


def test_packing(spark, docs):
    got = packing.pack_documents(docs, capacity=64, with_ids=True).collect()
    for k, t in enumerate(ODD):
        ids = [*library(byte_bpe.default_path(), t), 2]
        own = sorted((r for r in got if r["doc_id"] == k), key=lambda r: r["piece"])
        assert sum((r["ids"] for r in own), []) == ids and [r["piece"] for r in own] == list(range(len(own)))
        assert all(r["length"] == len(r["ids"]) <= 64 and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in own)
        assert all(r["length"] == 64 for r in own[1:])
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_plan_uses_the_histogram_and_is_no_worse_than_best_fit():
    rng = np.random.default_rng(4)
    for n in (0, 3, 400, 20_000):
        hist = np.bincount(np.minimum(1 + rng.geometric(0.01, n), 256), minlength=257)
        chosen = packing.plan(hist, 256)
        used = np.zeros(257, int)
        for pattern, k in chosen:
            assert sum(pattern) <= 256
            for v in pattern:
                used[v] += k
        assert (used == hist).all()
        bound = -(-int((hist * np.arange(257)).sum()) // 256)
        assert sum(k for _, k in chosen) <= max(bound + 3, sum(k for _, k in packing.best_fit(hist, 256)))


def test_word_bpe_is_the_librarys(spark, docs):
    path = word_bpe.default_path()
    lib = Tokenizer.from_file(path)
    got = {r["doc_id"]: r for r in word_bpe.encode_documents(docs).collect()}
    digests = {r["doc_id"]: r for r in word_bpe.document_digests(docs).collect()}
    for k, t in enumerate(ODD):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        decoded = lib.decode(ids, skip_special_tokens=False)
        assert got[k]["ids"] == ids and got[k]["decoded"] == decoded, t
        assert digests[k]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert digests[k]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest() and digests[k]["n_tokens"] == len(ids)
    assert word_bpe.encode_documents(docs.limit(0)).count() == 0


def test_word_bpe_one_merge_at_a_time_agrees():
    m = word_bpe.WordBPE(word_bpe.default_path())
    words = [b"mississippi", b"aaaaaaa", b"%%%%%%%%%", b"internationalisation"]
    data, n = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
    both = []
    for at_once in (True, False):
        m.at_once = at_once
        ids, counts = m.merge(data, n)
        both.append((ids.tolist(), counts.tolist()))
    assert both[0] == both[1]
