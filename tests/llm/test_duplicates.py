"""Near duplicates, repeated strings, components against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from skeinflow.llm import near_dup, repeats
from skeinflow.llm.graph import labels

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute_classes(docs, words, percent):
    sets = {}
    for i, t in docs:
        w = [x for x in re.split(r"[\x20\x09-\x0d]+", (t or "").translate(LOWER)) if x]
        sets[i] = {tuple(w)} if 0 < len(w) < words else {tuple(w[a : a + words]) for a in range(len(w) - words + 1)}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            n = len(sets[i] & sets[j])
            if i < j and n and 100 * n >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus():
    rng = random.Random(11)
    words = [f"w{k}" for k in range(400)]
    base = [" ".join(rng.choices(words, k=rng.randint(20, 150))) for _ in range(25)]
    texts = list(base)
    for b in base[:8]:
        for _ in range(12):  # near copies on both sides of the threshold
            w = b.split()
            for _ in range(rng.randint(1, 5)):
                w[rng.randrange(len(w))] = rng.choice(words)
            texts.append(" ".join(w))
    texts += [base[0]] * 5 + [base[1].upper(), "\t" + base[2].replace(" ", "\n ")] + [None, "", "  \n", "one", "one", "One", "two words", "Two  words", "É é", "é é", "x" * 70_000, "y " * 30_000]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("words", "percent", "block"), [(3, 85, 1024), (5, 80, 1024), (3, 85, 8)])
def test_near_duplicates_match_brute_force(spark, words, percent, block):
    docs = corpus()
    want = brute_classes(docs, words, percent)
    table = spark.createDataFrame([(i, t, i, "r") for i, t in docs], "doc_id long, text string, key long, rep string")
    got = {r["doc_id"]: r for r in near_dup.near_duplicates(table, near_dup.Rule(words=words, percent=percent, block=block)).collect()}
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_near_duplicates_of_nothing_and_of_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.near_duplicates(empty).count() == 0
    twice = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b"), (None, "a b"), (None, "a b c d e f"), (None, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(twice).collect()), key=str)
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (None, 1, False), (None, None, True), (None, None, True), (None, None, True)]


def test_near_duplicates_of_one_id_with_several_texts(spark):
    rng = random.Random(4)
    a, b, c = (" ".join(rng.choices([f"w{k}" for k in range(300)], k=60)) for _ in range(3))
    rows = [(1, a), (1, b), (7, a + " tail"), (9, b + " tail"), (5, c), (5, c), (4, c + " more"), (None, b + " end"), (3, "alone here")]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = sorted(((r["doc_id"], r["component_id"]) for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
        assert got == sorted([(1, 1), (1, 1), (7, 1), (9, 1), (5, 4), (5, 4), (4, 4), (None, 1), (3, 3)], key=str)


def test_bands_and_pruning_hold_their_miss_rates():
    for rule in (near_dup.Rule(3, 85), near_dup.Rule(5, 80)):
        t = rule.percent / 100
        assert (1 - t**rule.rows) ** (near_dup.HASHES // rule.rows) <= near_dup.BAND_MISS
        rng = np.random.default_rng(1)
        matches = (rng.random((200_000, near_dup.HASHES)) < t).cumsum(1)
        ends = np.arange(near_dup.BATCH, near_dup.HASHES + 1, near_dup.BATCH) - 1
        assert (matches[:, ends] < rule.least_matches()).any(1).mean() < 1e-4


def test_labels():
    assert labels(6, np.array([4, 3, 5]), np.array([3, 1, 0])).tolist() == [0, 1, 2, 1, 1, 0]


def brute_repeats(docs, length):
    count = collections.Counter()
    for _, t in docs:
        b = (t or "").encode()
        count.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = {}
    for k, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for j in range(len(b)) if gone[j] and (not j or not gone[j - 1]))
        out[k] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def passages():
    rng = random.Random(5)
    alphabet = "abcdefghij klmé\n"

    def noise(n):
        return "".join(rng.choices(alphabet, k=n))

    shared, line = noise(260), noise(120)
    texts = [noise(rng.randint(0, 900)) for _ in range(30)]
    texts += [noise(rng.randint(0, 300)) + shared[rng.randint(0, 50) :] + noise(rng.randint(0, 300)) for _ in range(25)]
    texts += [noise(100) + line + noise(100) for _ in range(20)]
    texts += [shared, shared, None, "", "z" * 199, "z" * 200, "z" * 450, "ab" * 300, noise(50) + "ab" * 300, noise(199) + shared + noise(40) + shared]
    texts += [texts[0], texts[1] + "x"]
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [1024, 6])
def test_repeats_match_brute_force(spark, block, monkeypatch):
    docs = passages()
    table = spark.createDataFrame([(i, t, i, "k") for i, t in docs], "doc_id long, text string, marks long, _row_key string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.remove_repeats(table, clean_text=False, block=block).collect()}
    assert got == brute_repeats(docs, 200)
    cleaned = repeats.remove_repeats(table, block=block)
    assert cleaned.columns == table.columns
    for r in cleaned.collect():
        before = dict(docs)[r["doc_id"]]
        assert (r["text"] is None) == (before is None) and r["marks"] == r["doc_id"] and r["_row_key"] == "k"
        if got[r["doc_id"]][1] == 0:
            assert r["text"] == before


def test_segments_of_long_texts_give_the_same_windows(monkeypatch):
    rng = np.random.default_rng(2)
    data = rng.integers(97, 101, 5000).astype(np.uint8)
    ends = np.array([0, 5000])
    owner = {}
    for p in range(0, 5000, 700):
        q = min(5000, p + 700 + 199)
        row, at, n, anchor, _, _ = repeats.windows(data[p:q], np.clip(ends, p, q) - p, 200, 48)
        for a, w, k in zip(at, n, anchor, strict=True):
            owner.update({p + a + i: k for i in range(w)})
    _, at, n, anchor, _, _ = repeats.windows(data, ends, 200, 48)
    whole = {a + i: k for a, w, k in zip(at, n, anchor, strict=True) for i in range(w)}
    assert owner == whole and len(whole) == 4801


def test_run_index_statistics_match_brute_force():
    rng = random.Random(9)
    base = bytes(rng.choices(b"ab", k=60))
    strings = [base, base[10:50], base[:30] + b"c" + base[31:], bytes(rng.choices(b"abc", k=40)), b"a" * 30]
    text = np.frombuffer(b"".join(s + b"\0" for s in strings), np.uint8)
    stops = np.cumsum([len(s) + 1 for s in strings]) - 1
    index = repeats.RunIndex(text, stops)
    got = index.statistics()
    places = [(k, i) for k, s in enumerate(strings) for i in range(len(s))]
    starts = stops - [len(s) for s in strings]
    for k, i in places:
        best = 0
        for m, j in places:
            if (m, j) != (k, i):
                x, y, n = strings[k][i:], strings[m][j:], 0
                while n < min(len(x), len(y)) and x[n] == y[n]:
                    n += 1
                best = max(best, n)
        assert got[starts[k] + i] == best
    assert index.lengths.sum() == len(text) and len(index.lengths) < len(text)
    for pattern in (b"a", b"b", b"c", b"ab", b"ba", b"aaa", base[5:25], base[:61], b"abcabcabca", b"d"):
        assert index.count(pattern) == sum(s[i : i + len(pattern)] == pattern for s in strings for i in range(len(s))), pattern


def test_repeats_of_nothing(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def stages(spark):
    """(id, bytes written to shuffles) of the latest stages; Spark forgets old ones."""
    store = spark.sparkContext._jsc.sc().statusStore()
    found = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), spark._jvm.java.util.ArrayList())
    return [(found.apply(k).stageId(), found.apply(k).shuffleWriteBytes()) for k in range(found.size())]


def hot_group(n):
    """Unlike near copies of one text."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(900)}" for _ in range(150)]
    out = []
    for k in range(n):
        w = list(base)
        w[rng.randrange(150)] = f"new{k}"
        out.append((k, " ".join(w)))
    return out


def hot_anchor(n):
    """Texts with one short phrase between unlike words, of which every fifth repeats a longer passage."""
    rng = random.Random(4)
    phrase = "".join(rng.choices("abcdefgh ", k=110))
    long = "".join(rng.choices("ijklmnop ", k=260))

    def noise(k):
        return "".join(rng.choices("qrstuvwxyz ", k=k))

    return [(k, noise(170) + phrase + (long if k % 5 == 0 else "") + noise(170)) for k in range(n)]


@pytest.mark.parametrize("kind", ["group", "anchor"])
def test_what_a_hot_group_shuffles_grows_with_its_rows(spark, kind, request):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the same joins at both sizes
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    took = []
    spark.range(1).count()
    for n in (700, 1400):
        rows = (hot_group if kind == "group" else hot_anchor)(n)
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        before = max(k for k, _ in stages(spark))
        if kind == "group":
            got = near_dup.near_duplicates(docs, near_dup.Rule(words=3, percent=85, block=16)).collect()
            assert {r["component_id"] for r in got} == {0}
        else:
            got = {r["doc_id"]: r["n_removed"] for r in repeats.remove_repeats(docs, clean_text=False, block=16).collect()}
            assert all((got[k] >= 369) == (k % 5 == 0) for k, _ in rows)  # the passage with the phrase before it
            assert all(got[k] == 0 for k, _ in rows if k % 5)
        took.append(sum(n for k, n in stages(spark) if k > before))
    assert took[1] < 2.6 * took[0], took
