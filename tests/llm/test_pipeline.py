"""The pipeline's stages on planted cases, and the registration of all queries."""

import random

import numpy as np
import pytest

import corpus_pipeline
from skeinflow.llm.queries import ORACLE_SQL, QUERIES

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "ru", "so", "ta", "vi") for b in ("ba", "de", "fi", "go", "hu", "ri", "ly", "men")]


def prose(rng, n):
    w = rng.choices(WORDS, k=n)
    return ". ".join(" ".join(w[a : a + 9]).capitalize() for a in range(0, n, 9)) + "."


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(12)
    rows, labels, kind = [], [], {}

    def add(text, what, quality=None, toxic=None):
        i = len(rows)
        rows.append((i, text, "en", "src0", len(text or "")))
        kind[i] = what
        if quality is not None:
            labels.append((i, quality, toxic))

    for _ in range(500):
        add(prose(rng, rng.randint(40, 160)), "clean", 1, 0)
    for _ in range(150):
        add(prose(rng, 80).upper().replace(" ", "!! "), "junk", 0, 0)
    for _ in range(250):
        w = prose(rng, 90).split(" ")
        for _ in range(3):
            w.insert(rng.randrange(len(w)), rng.choice(["moron", "idiot", "scum"]))
        add(" ".join(w), "toxic", 1, 1)
    base = prose(rng, 150)
    for k in range(6):
        w = base.split(" ")
        if k:
            w[20 * k] = "changed"
        add(" ".join(w), "near")
    passage = prose(rng, 60)
    for _ in range(5):
        add(prose(rng, 60) + " " + passage + " " + prose(rng, 60), "passage")
    add(None, "null")
    add("", "empty")
    at = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at), dict((r[0], r[1]) for r in rows), kind, passage


def test_stages(spark, planted):
    at, texts, kind, passage = planted
    docs = spark.read.parquet(f"{at}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, at)
        assert out.columns == columns and out.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
        path = f"{at}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}

    def share(of, name, before):
        own = [i for i, k in kind.items() if k == of and i in before]
        return np.mean([i in kept[name] for i in own])

    everyone = set(kind)
    assert share("clean", "quality", everyone) > 0.98 and share("junk", "quality", everyone) < 0.05
    assert share("clean", "toxicity", kept["quality"]) > 0.98 and share("toxic", "toxicity", kept["quality"]) < 0.05
    assert share("clean", "near_dedup", kept["toxicity"]) == 1
    near = [i for i in kept["toxicity"] if kind[i] == "near"]
    assert len(near) == 6 and [i for i in kept["near_dedup"] if kind[i] == "near"] == [min(near)]
    assert set(kept["repeats"]) == set(kept["near_dedup"])
    assert all(kept["repeats"][i] == texts[i] for i in kept["repeats"] if kind[i] in ("clean", "near", "empty"))
    assert not any(passage in t for i, t in kept["repeats"].items() if kind[i] == "passage")
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, at).collect()
    assert {r["doc_id"] for r in packed} == set(kept["repeats"])


def test_run_and_registration(spark, planted):
    at = planted[0]
    assert corpus_pipeline.run(spark, at).count() > 500
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_dedup", "repeats", "packing"]
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert set(QUERIES) | {"pipeline"} <= names and sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert set(ORACLE_SQL) <= set(QUERIES)
