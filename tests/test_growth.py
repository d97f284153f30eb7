"""What queries move and how often they read: growth with the input, seen on small tables."""

import math
import random

import pyarrow as pa
from pyspark.sql import functions as F

from skeinflow.operators import dedupe, ranking
from skeinflow.plans import articles as bind
from skeinflow.plans import catalogue

SF = "/root/testdata/sf0.001"
ARTICLE = "seq long, title string, link string, summary string, published timestamp, source_name string, source_tier int, category string, feed_url string"


def nodes(plan):
    yield plan
    children = plan.children()
    for k in range(children.length()):
        yield from nodes(children.apply(k))


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan()


def columns(plan):
    return [plan.output().apply(k).name() for k in range(plan.output().length())]


def test_no_join_carries_whole_texts(spark):
    joins = [n for n in nodes(optimized(bind.in_window(spark, SF))) if n.nodeName() == "Join"]
    assert len(joins) == 2 and not any("text" in columns(j) for j in joins)


def test_documents_are_read_once_for_articles(spark):
    scans = [n for n in nodes(optimized(bind.in_window(spark, SF))) if n.nodeName().startswith("LogicalRelation") or n.nodeName() == "Relation"]
    assert len(scans) == 3 and sum("text" in columns(n) for n in scans) == 1


def counted(spark, rows):
    """Rows whose number is counted each time they are made."""
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield pa.RecordBatch.from_arrays(batch.columns, batch.schema.names)

    df = spark.createDataFrame(rows, ARTICLE)
    return df.mapInArrow(run, df.schema), made


def test_articles_are_made_once_for_events(spark, monkeypatch):
    rows = [(k, f"alpha beta gamma {k % 3}", f"https://e.com/{k % 4}", "s", None, f"src{k % 2}", 1, "cat1", "f") for k in range(8)]
    articles, made = counted(spark, rows)
    assert dedupe.clustered(articles).count() == 8 and made.value == 8

    monkeypatch.setattr(bind, "in_window", lambda *_: articles)
    for query in ("coverage", "run_meta"):
        made.value = 0
        catalogue.QUERIES[query](spark, SF).collect()
        assert made.value == 8, query
    for run in (lambda: [catalogue._classes(spark, SF)], lambda: catalogue._run(spark, SF)):
        made.value = 0
        for df in run():
            df.collect()
        assert made.value == 8


def test_terms_are_looked_up_in_a_text_made_once(spark):
    rows = spark.createDataFrame([("Fed and AI chips", "s"), (None, "an obituary"), ("maize", None)], "title string, summary string")
    noise, topics = (rows.select(f(F.col("title"), F.col("summary")).alias("x")) for f in (ranking.is_noise, ranking.topic_hits))
    assert [r["x"] for r in noise.collect()] == [False, True, False]
    assert [r["x"] for r in topics.collect()] == [["통화정책", "기술"], [], []]
    for df in (noise, topics):
        plan = optimized(df).toString()
        assert plan.count("lower(") == 1 and "lower(" not in plan.partition("lambdafunction(")[2]


def test_titles_that_meet_in_one_rare_word_are_no_candidates(spark):
    words = [[f"pair{k // 2}"] + [f"{'odd' if k % 2 else 'even'}{j}" for j in range(6)] for k in range(20)]
    sets = spark.createDataFrame([(k, sorted(w), len(w)) for k, w in enumerate(words)], "class_id long, tokens array<string>, n int")
    frequency = sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    got = {(r["a"], r["b"]) for r in dedupe.candidate_pairs(sets, frequency).collect()}
    assert {(a, b) for a in range(20) for b in range(a + 1, 20) if (a - b) % 2 == 0} == got  # six of seven words


def test_candidates_hold_every_pair_that_shares_enough(spark):
    rng = random.Random(5)
    words, sets = [f"w{k}" for k in range(60)], set()
    while len(sets) < 150:
        base = rng.sample(words, rng.randint(2, 24))
        sets |= {frozenset(base), frozenset([*base[: len(base) - rng.randint(0, 8)], *rng.sample(words, rng.randint(0, 9))])}
    sets = [x for x in sorted(map(sorted, sets)) if len(x) > 1]
    classes = spark.createDataFrame([(k, x, k) for k, x in enumerate(sets)], "gid long, tokens array<string>, class_id long")
    got = {(r["a"], r["b"], r["overlap"]) for r in dedupe.shared_tokens(classes).collect()}
    shared = {(a, b): len({*sets[a]} & {*sets[b]}) for a in range(len(sets)) for b in range(a + 1, len(sets))}
    least = {k: max(2, math.ceil(dedupe.SHARE * len(x) - 1e-9)) for k, x in enumerate(sets)}
    want = {(a, b, n) for (a, b), n in shared.items() if n >= min((len(sets[k]), least[k]) for k in (a, b))[1]}
    assert got == want and len(want) > 50
