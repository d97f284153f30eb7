"""Texts that meet in any polynomial hash modulo 2**64, and caches whose hashes are made to meet."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from skeinflow.llm import byte_bpe, common, near_dup, packing, repeats, wavelet, word_bpe


def thue_morse(n):
    return "".join("ab"[bin(k).count("1") % 2] for k in range(n))


def other(text):
    return text.translate(str.maketrans("ab", "ba"))


PAIRS = [t for n in (512, 1024, 2048) for t in (thue_morse(n), other(thue_morse(n)))]


def library(path, text):
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_hashes_differ_and_do_not_depend_on_the_place():
    data = np.frombuffer("".join(PAIRS).encode(), np.uint8)
    end = np.cumsum([len(t) for t in PAIRS])
    start = end - [len(t) for t in PAIRS]
    for seed in (0, 1):
        assert len(set(common.hash_spans(data, start, end, seed).tolist())) == len(PAIRS)
    assert set(common.hash_spans(data, start, end).tolist()).isdisjoint(common.hash_spans(data, start, end, 1).tolist())
    rng = np.random.default_rng(0)
    text = rng.integers(97, 100, 700).astype(np.uint8)
    twice = np.concatenate([text, [1, 2, 3], text]).astype(np.uint8)
    a, b = np.sort(rng.integers(0, 701, (2, 300)), axis=0)
    assert (common.hash_spans(twice, a, b) == common.hash_spans(twice, a + 703, b + 703)).all()
    for width in (1, 5, 8, 48, 100):
        got = common.rolling(twice, width)
        assert (got[: 701 - width] == got[703 : 1404 - width]).all()
        seen = {}
        assert all(seen.setdefault(got[i], bytes(twice[i : i + width])) == bytes(twice[i : i + width]) for i in range(len(got)))


def test_tokenizers(spark):
    ids, n = byte_bpe.encoder(byte_bpe.default_path()).encode(pa.array(PAIRS))
    want = [library(byte_bpe.default_path(), t) for t in PAIRS]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])
    ids, n = word_bpe.WordBPE(word_bpe.default_path()).encode(pa.array(PAIRS))
    want = [library(word_bpe.default_path(), t) for t in PAIRS]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


def test_tokenizers_when_hashes_meet(monkeypatch):
    """With a hash that tells lengths only, both caches still give the library's ids."""

    def weak(data, start, end, seed=0):
        return (end - start).astype(np.uint64)

    texts = ["one two six ten", "the cat sat on the mat", None, "", "abc abd abe", " a b c", *PAIRS[:2], "two one", "x" * 600, "y" * 600]
    monkeypatch.setattr(byte_bpe, "hash_spans", weak)
    monkeypatch.setattr(word_bpe, "hash_spans", weak)
    for path, encoder in ((byte_bpe.default_path(), byte_bpe.PieceEncoder(byte_bpe.default_path())), (word_bpe.default_path(), word_bpe.WordBPE(word_bpe.default_path()))):
        for part in (texts, texts[::-1], texts[3:7]):  # later calls meet a filled cache
            ids, n = encoder.encode(pa.array(part, pa.string()))
            want = [library(path, t or "") for t in part]
            assert n.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


def test_shards_and_packing(spark, tmp_path):
    rows = [(k, t) for k, t in enumerate(PAIRS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["ids_crc32"] for r in wavelet.document_digests(wavelet.write_shards(docs, (tmp_path / "s").as_uri())).collect()}
    want = {k: zlib.crc32(np.array([*library(byte_bpe.default_path(), t), 2], "<u4").tobytes()) for k, t in rows}
    assert got == want
    pieces = sorted(packing.pack_documents(docs, with_ids=True).collect(), key=lambda r: (r["doc_id"], r["piece"]))
    for k, t in rows:
        assert sum((r["ids"] for r in pieces if r["doc_id"] == k), []) == [*library(byte_bpe.default_path(), t), 2]


def test_near_duplicates(spark):
    rows = [(k, t) for k, t in enumerate(PAIRS)] + [(20 + k, f"{t} and some more words") for k, t in enumerate(PAIRS)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), near_dup.Rule(3, 85)).collect()
    assert all(r["component_id"] == r["doc_id"] for r in got)


@pytest.mark.parametrize("length", [200, 1024])
def test_repeats(spark, length):
    rows = [(k, t) for k, t in enumerate(PAIRS[2:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["kept_sha256"] for r in repeats.remove_repeats(docs, clean_text=False, length=length).collect()}
    count = {}
    for _, t in rows:
        for i in range(len(t) - length + 1):
            count[t[i : i + length]] = count.get(t[i : i + length], 0) + 1
    for k, t in rows:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        assert got[k] == hashlib.sha256("".join(c for c, g in zip(t, gone, strict=True) if not g).encode()).hexdigest()
