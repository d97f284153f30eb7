"""Classifiers, top-k, pages and pictures."""

import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skeinflow.llm import html_layout, quality, topk, toxicity
from skeinflow.llm.labelled import sample


def labelled_texts(n=900, seed=3):
    rng = random.Random(seed)
    words = [f"word{k}" for k in range(300)]
    rows = []
    for k in range(n):
        w = rng.choices(words, k=rng.randint(5, 80))
        toxic, good = int(rng.random() < 0.25), int(rng.random() < 0.7)
        if toxic:
            w.insert(rng.randrange(len(w)), rng.choice(["Moron", "idiot!", "scum,"]))
        text = " ".join(w)
        if not good:
            text = text.upper().replace(" ", "!! ") if k % 2 else text.replace(" ", "*** ")
        rows.append((k, text, good, toxic))
    return rows


EDGES = [(10_000, None), (10_001, ""), (10_002, "  \n"), (10_003, "x" * 100_000), (10_004, "word1 " * 20_000)]


@pytest.fixture(scope="module")
def tables(spark):
    rows = labelled_texts()
    docs = spark.createDataFrame([(k, t, "a") for k, t, _, _ in rows] + [(k, t, "b") for k, t in EDGES], "doc_id long, text string, y string")
    labels = spark.createDataFrame([(k, q, x) for k, _, q, x in rows] + [(5, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    return docs, labels, rows


@pytest.mark.parametrize(("module", "target", "folds", "held", "cut"), [(quality, "quality", 4, 2, 0.7), (toxicity, "toxic", 5, 0, 0.5)])
def test_held_out_accuracy_and_edges(spark, tables, module, target, folds, held, cut):
    docs, labels, rows = tables
    model = module.fit_from(sample(docs, labels, target, 5000, folds=folds, held=held))
    again = module.fit_from(sample(docs, labels, target, 5000, folds=folds, held=held))
    got = {r["doc_id"]: r["score"] for r in module.scored(docs, model).collect()}
    assert got == {r["doc_id"]: r["score"] for r in module.scored(docs, again).collect()}
    assert len(got) == len(rows) + len(EDGES) and all(0 <= s <= 1 for s in got.values())
    assert got[10_000] == got[10_001]
    truth = {k: (q if target == "quality" else x) for k, _, q, x in rows}
    out = [k for k in truth if zlib.crc32(str(k).encode()) % folds == held]
    assert np.mean([(got[k] >= cut) == truth[k] for k in out]) > 0.95
    assert set(module.scored(docs.limit(0), model).columns) == {*docs.columns, "score"}


def test_nothing_to_learn_from(spark, tables):
    docs, labels, _ = tables
    none = labels.limit(0)
    assert toxicity.scored(docs, toxicity.fit_from(sample(docs, none, "toxic", 10))).first()["score"] == 0.5
    assert quality.scored(docs, quality.fit_from(sample(docs, none, "quality", 10))).first()["score"] == 0.5


def test_places_reach_the_driver_in_bounded_parts(spark, monkeypatch):
    """Long texts have more places than one answer to the driver may hold; the model is that of all of them."""
    rng = random.Random(8)
    texts = [(" ".join(f"{rng.randrange(9_999)}" for _ in range(4_000)) + " moron" * t, t) for t in (0, 0, 1) * 16] + [(None, 0), ("", 0)]
    rows = [toxicity.unique_places(pa.array([t], pa.string()))[0] for t, _ in texts]
    assert sum(r.nbytes for r in rows) > 2 << 20
    order = sorted(range(len(rows)), key=lambda k: (len(rows[k]), rows[k][:8].tolist(), texts[k][1]))
    want = toxicity.fit([rows[k] for k in order], np.array([texts[k][1] for k in order]))
    conf, key = spark.sparkContext._jsc.sc().conf(), "spark.driver.maxResultSize"
    monkeypatch.setattr(toxicity, "FETCH_BYTES", 1 << 18, raising=False)
    before = conf.get(key, "1g")
    conf.set(key, "1m")
    try:
        got = toxicity.fit_from(spark.createDataFrame(texts, "text string, y int").repartition(3))
    finally:
        conf.set(key, before)
    assert got.rows == len(texts) and len(got.place) and got.bias == want.bias
    assert np.array_equal(got.place, want.place) and np.array_equal(got.weight, want.weight)


def test_sample_is_bounded_and_leaves_the_fold_out(spark, tables):
    docs, labels, _ = tables
    assert sample(docs, labels, "toxic", 50).count() == 50
    kept = {r["text"] for r in sample(docs, labels, "toxic", 5000, folds=5, held=0).collect()}
    assert all(t not in kept for k, t, _, _ in labelled_texts() if zlib.crc32(str(k).encode()) % 5 == 0)


def test_places_do_not_cross_rows():
    place, row = toxicity.places(pa.array(["a b c", None, "a", "", "b c"]))
    assert np.bincount(row, minlength=5).tolist() == [6, 0, 1, 0, 3]
    one, _ = toxicity.places(pa.array(["b c"]))
    assert sorted(place[row == 4]) == sorted(one)


def top_rows():
    rng = np.random.default_rng(8)
    v = rng.normal(size=(400, 12)) * rng.gamma(1.0, 1.0, (400, 1))
    rows = [(k, [float(x) for x in v[k].astype(np.float32)], "m") for k in range(400)]
    rows += [(400 + k, rows[7][1], "t") for k in range(8)]  # ties
    rows += [(500, None, "n"), (550, [1.0, None] * 6, "n"), (600, [float("nan")] * 12, "n"), (650, [float("inf")] * 12, "n"), (700, [0.0] * 12, "z"), (750, [1.0, 2.0], "d"), (751, [3.0, -1.0], "d"), (300, rows[3][1], "again")]
    return rows


def test_top_k_matches_sql(spark, monkeypatch):
    for bucket, head in ((2048, 1024), (32, 16)):
        monkeypatch.setattr(topk, "HEAD", head)
        rows = [r for r in top_rows() if r[2] != "again"]
        table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, norm string")
        got = sorted(tuple(r) for r in topk.top_k(table, F.col("vec_id") % 50 == 0, 5, bucket=bucket).select("query_id", "rank", "vec_id", "score").collect())
        embeddings = pa.table({"vec_id": [r[0] for r in rows], "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32()))})  # noqa: F841
        assert got == sorted(duckdb.sql(topk.OP3_SQL).fetchall())


def test_top_k_repeated_ids_huge_numbers_and_nothing(spark):
    got = topk.top_k(spark.createDataFrame(top_rows(), "vec_id long, embedding array<float>, ints string"), F.col("vec_id") == 300, 500).collect()
    assert all(r["vec_id"] != 300 for r in got)
    huge = spark.createDataFrame([(0, [1e18, 1.0]), (1, [1e18, 2.0]), (2, [-1e18, 0.0])], "vec_id long, embedding array<double>")
    assert [(r["rank"], r["vec_id"]) for r in topk.top_k(huge, F.col("vec_id") == 0, 2).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert topk.top_k(huge.limit(0), F.lit(True), 2).count() == 0


def test_top_k_in_blocks_and_without_ids(spark, monkeypatch):
    rows = [(k if k % 4 else None, [float(k % 7), float(k % 5), 1.0]) for k in range(60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = sorted(topk.top_k(table, F.lit(True), 4).collect(), key=str)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    assert sorted(topk.top_k(table, F.lit(True), 4).collect(), key=str) == want
    ints = [(i, [256 * x for x in v]) for i, v in rows]
    for q in (1, 33, 59):
        scores = sorted(((-sum(a * b for a, b in zip(ints[q][1], v, strict=True)), i is None, i) for i, v in ints if i != q), key=lambda t: (t[0], t[1], t[2] or 0))[:4]
        assert [(r["vec_id"], r["score"]) for r in sorted((r for r in want if r["query_id"] == q), key=lambda r: r["rank"])] == [(i, -s) for s, _, i in scores]
    assert all(r["query_id"] is not None for r in want) and {r["query_id"] for r in want} == {i for i, _ in rows if i is not None}


PAGE = """<!doctype html><title>t</title><style>p{}</style><h1>Head</h1><p>one<p>two <b>bold</b>,x<br>line
<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul><table><tr><th>Name<th>N<tr><td>foo<td>1<tr><td colspan=2>wide cell</table><pre>x
  y</pre><div style="display: none">no</div><span hidden>no</span><details><summary>S</summary>no</details><details open><summary>T</summary>yes</details>
&lt;tag&gt; &copy; 3 < 4<script>var t="</p>";</script><!-- no --><template>no</template></i> end"""


def test_layout():
    assert html_layout.visible_text(PAGE) == (
        "Head\n\none\n\ntwo bold,x\nline\n\n- a\n- b\n  3. c\n  4. d\n\nName  N\nfoo   1\nwide cell\n\nx\n  y\n\nS\nT\nyes\n<tag> © 3 < 4 end"
    )
    for odd in (None, "", "   ", "<", "<p", "</p>", "<!--", "a<br", "<table><td>x", "<script>", "text only"):
        assert isinstance(html_layout.visible_text(odd), str)
    assert html_layout.visible_text("<div>" * 30_000 + "deep") == "deep"
    assert len(html_layout.visible_text("<p>word</p>" * 20_000)) > 100_000


def test_extract_keeps_rows_and_columns(spark):
    pages = spark.createDataFrame([(1, "<p>a", "x", "old"), (1, "<p>a", "x", "old"), (2, None, "y", "old")], "page_id long, html string, _page string, text string")
    got = html_layout.extract(pages)
    assert got.columns == ["page_id", "_page", "text"] and sorted((r["page_id"], r["text"]) for r in got.collect()) == [(1, "a"), (1, "a"), (2, "")]
    assert html_layout.extract(pages.limit(0)).count() == 0


def test_ftrl_is_the_plain_algorithm():
    """Coordinate by coordinate in dictionaries, as the method is written down."""
    import math

    rng = np.random.default_rng(3)
    y = (rng.random(150) < 0.3).astype(int)
    rows = [np.unique(np.concatenate([rng.integers(0, 60, 12), [60 + t] if rng.random() < 0.9 else []])).astype(np.int32) for t in y]
    kw = dict(alpha=0.7, beta=0.9, l1=0.8, l2=0.3, passes=3, seed=5)
    got = toxicity.fit(rows, y, bits=8, **kw)
    z, n, bz, bn = {}, {}, 0.0, 0.0
    share = y.mean()
    heavy = min(4.0, (1 - share) / share)
    order = np.random.default_rng(kw["seed"])

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= kw["l1"]:
            return 0.0
        return -(zi - math.copysign(kw["l1"], zi)) / ((kw["beta"] + math.sqrt(n.get(i, 0.0))) / kw["alpha"] + kw["l2"])

    for _ in range(kw["passes"]):
        for k in order.permutation(len(rows)):
            w = {i: weight(i) for i in rows[k].tolist()}
            bias = -bz / ((kw["beta"] + math.sqrt(bn)) / kw["alpha"])
            p = 1 / (1 + math.exp(-(sum(w.values()) + bias)))
            g = (p - y[k]) * (heavy if y[k] else 1.0)
            for i, wi in w.items():
                before = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / kw["alpha"] * wi
                n[i] = before + g * g
            bz += g - (math.sqrt(bn + g * g) - math.sqrt(bn)) / kw["alpha"] * bias
            bn += g * g
    want = {i: weight(i) for i in z if weight(i)}
    assert dict(zip(got.place.tolist(), got.weight.tolist(), strict=True)) == pytest.approx(want, rel=1e-5)
    texts = ["a b c", "", "b c d a", None]
    model = toxicity.Weights(np.arange(0, 1 << 20, 2, dtype=np.int32), np.linspace(-1, 1, 1 << 19).astype(np.float32), 0.25)
    for t, s in zip(texts, model.score(pa.array(texts)), strict=True):
        place, _ = toxicity.unique_places(pa.array([t], pa.string()))
        total = 0.25 + sum(float(model.weight[i // 2]) for i in set(place.tolist()) if i % 2 == 0)
        assert s == pytest.approx(1 / (1 + math.exp(-total)))


def test_additive_scores_are_naive_sums_of_table_entries():
    import math

    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(600, 4)), 1)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)  # a pair, which no single feature tells
    model = quality.fit(x, y, rounds=10, pair_rounds=15)
    for row, s in zip(x[:80], model.score(x[:80]), strict=True):
        total = model.base
        for k in range(4):
            total += model.tables[k][sum(e <= row[k] for e in model.edges[k])]
        for (i, j), t in zip(model.pairs, model.pair_tables, strict=True):
            total += t[sum(e <= row[i] for e in model.pair_edges[i])][sum(e <= row[j] for e in model.pair_edges[j])]
        assert s == pytest.approx(1 / (1 + math.exp(-total)))
    assert ((model.score(x) > 0.5) == y).mean() > 0.9 and (1, 0) in model.pairs[:2]


def test_features_of_quality_are_plain_counts():
    text = "One two, TWO!! ## 12\nOne two é | aaa"
    got = dict(zip(quality.FEATURES, quality.features(pa.array([text]))[0], strict=True))
    words, size = text.split(), len(text.encode())
    assert got["log_bytes"] == pytest.approx(np.log1p(size)) and got["log_words"] == pytest.approx(np.log1p(len(words)))
    assert got["exclaim"] == pytest.approx(2 / len(words)) and got["pipes"] == pytest.approx(1 / len(words)) and got["digits"] == pytest.approx(2 / size)
    assert got["distinct_words"] == pytest.approx(len(set(words)) / len(words)) and got["commas"] == pytest.approx(1 / len(words))


def test_sample_bounds_bytes_and_leaves_contradictions_out(spark):
    docs = spark.createDataFrame([(k, "x" * 100) for k in range(50)] + [(7, "least"), (60, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(50)] + [(3, 0), (60, 1)], "doc_id long, toxic int")
    rows = sample(docs, labels, "toxic", 1000).collect()
    assert len(rows) == 50 and sum(r["text"] == "least" for r in rows) == 1 and sum(r["y"] for r in rows) == 25
    few = sample(docs, labels, "toxic", 1000, max_bytes=1000)
    assert 10 <= few.count() <= 12 and sample(docs, labels, "toxic", 20).count() <= 20
    assert sample(docs, labels, "toxic", 1000, max_bytes=0).count() <= 1
