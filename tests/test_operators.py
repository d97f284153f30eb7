"""Operators on small tables."""

import random
from datetime import date, datetime

from pyspark.sql import functions as F

from skeinflow.functions import terms
from skeinflow.operators import components, coverage, dedupe, links, ranking, rules, series
from skeinflow.plans.collect import collect

ARTICLE = "seq long, title string, link string, summary string, published timestamp, source_name string, source_tier int, category string, feed_url string"
NOW = datetime(2026, 9, 10, 12)


def article(seq, title, link=None, summary="", published=NOW, source="s", tier=2, category="미국"):
    return (seq, title, link or f"https://e.com/{seq}", summary, published, source, tier, category, "f")


def test_components_of_a_chain_and_a_star(spark):
    nodes = spark.range(9).withColumnRenamed("id", "node")
    edges = spark.createDataFrame([(i, i + 1) for i in range(4)] + [(8, 6), (7, 6), (6, 6)], "a long, b long")
    got = dict(map(tuple, components.connected_components(nodes, edges).collect()))
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 5, 6: 6, 7: 6, 8: 6}


def test_components_of_random_graphs(spark):
    rng = random.Random(8)
    for n, m in ((60, 30), (60, 50), (200, 260), (40, 0)):
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        hub = [(n, k) for k in range(0, n, 7)] + [(n + 1 + k, n) for k in range(5)]  # a centre that is larger than its leaves, and smaller
        label = list(range(n + 6))
        for _ in range(n + 6):
            for a, b in pairs + hub:
                label[a] = label[b] = min(label[a], label[b])
        edges = spark.createDataFrame(pairs + hub, "a long, b long")
        got = dict(map(tuple, components.connected_components(spark.range(n + 6).withColumnRenamed("id", "node"), edges).collect()))
        assert got == dict(enumerate(label))
    none = components.connected_components(spark.range(2).withColumnRenamed("id", "node"), spark.createDataFrame([], "a long, b long"))
    assert sorted(map(tuple, none.collect())) == [(0, 0), (1, 1)]


def test_similarity_edges_and_transitive_events(spark):
    titles = ["alpha beta gamma delta", "alpha beta gamma omega", "alpha beta gamma omega sigma kappa", "alpha beta zeta theta", "lonely", "lonely", "12 34"]
    rows = spark.createDataFrame([article(i, t) for i, t in enumerate(titles)], ARTICLE)
    got = {r["seq"]: r["component"] for r in dedupe.clustered(rows).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 5, 6: 6}


def test_prefix_filter_finds_all_similar_pairs(spark):
    import random

    rng = random.Random(3)
    words = [f"word{k}" for k in range(30)]
    titles = [" ".join(rng.sample(words, rng.randint(1, 7))) for _ in range(120)]
    groups = spark.createDataFrame(list(enumerate(titles)), "gid long, title string")
    got = {(r["a"], r["b"]) for r in dedupe.similar_titles(dedupe.title_classes(groups)).collect()}
    first = {}
    for i, t in enumerate(titles):
        first.setdefault(frozenset(t.split()), i)
    sets = sorted((i, s) for s, i in first.items())
    want = set()
    for i, a in sets:
        for j, b in sets:
            n = len(a & b)
            if i < j and n >= 2 and (n / min(len(a), len(b)) >= 0.75 or n / len(a | b) >= 0.55):
                want.add((i, j))
    assert got == want


def test_same_address_is_one_group_and_leads_by_tier_then_time(spark):
    rows = [
        article(1, "first title here", "https://e.com/a?utm_source=q", tier=2, source="b", published=NOW),
        article(2, "second title there", "https://www.e.com/a/", tier=1, source="a", published=None),
        article(3, "third title elsewhere", "https://e.com/a#x", tier=1, source="b", published=datetime(2026, 9, 10, 3)),
    ]
    clustered = dedupe.clustered(spark.createDataFrame(rows, ARTICLE))
    lead = ranking.leads(clustered).first()["lead"]
    assert lead["seq"] == 3
    assert ranking.outlets(clustered).first()["sources"] == ["b", "a"]


def test_topics_noise_and_score(spark):
    rows = spark.createDataFrame([article(1, "Fed cuts as 한국ai rises", tier=1), article(2, "An ai chip", published=None, tier=4), article(3, "recipe", tier=3, published=datetime(2026, 9, 11))], ARTICLE)
    hits = {r["seq"]: r["t"] for r in rows.select("seq", ranking.topic_hits(F.col("title"), F.col("summary")).alias("t")).collect()}
    assert hits == {1: ["통화정책"], 2: ["기술"], 3: []}
    scores = {r["lead"]["seq"]: r["score"] for r in ranking.events(dedupe.clustered(rows), F.lit(NOW)).collect()}
    assert scores == {1: 3 + 1.5 + 2, 2: 0.5 + 1.5 - 1.5, 3: 1 - 3 + 2 - 6}


def test_numbering_is_by_score_then_component(spark):
    found = spark.createDataFrame([(1, 2.0), (5, -3.25), (3, 2.0), (4, 7.5), (2, 2.01)], "component long, score double")
    got = {r["event_id"]: r["component"] for r in ranking.numbered(found).collect()}
    assert got == {1: 4, 2: 2, 3: 1, 4: 3, 5: 5}


def test_curve_against_the_row_before(spark):
    days = {date(2026, 9, 10): (4.00, 4.56, 4.75, 4.95, 5.37), date(2026, 9, 11): (4.07, 4.63, 4.78, 4.96, 5.35)}
    raw = [(0, d, n, str(v)) for d, vs in days.items() for n, v in zip(terms.TENORS, vs, strict=True)] + [(0, date(2026, 9, 11), "BC_7YEAR", "1"), (0, date(2026, 9, 9), "BC_2YEAR", "n/a")]
    kept = series.tenor_project(spark.createDataFrame(raw, "seq long, as_of date, name string, value string"))
    curve = series.curve_delta(kept)
    assert {r["tenor"]: r["change_bp"] for r in curve.collect()} == {"3M": 7.0, "2Y": 7.0, "5Y": 3.0, "10Y": 1.0, "30Y": -2.0}
    assert "| 30Y | 5.35 | -2.0 |" in series.curve_markdown(curve).first()["text"]
    only = series.curve_delta(kept.filter("as_of = '2026-09-11'")).first()
    assert only["change_bp"] is None and only["compared_with"] is None
    assert "확인 불가" in series.curve_markdown(series.curve_delta(kept.filter("1 = 0"))).first()["text"]


def test_link_verdicts(spark):
    rows = [("a", "HEAD", 200, None), ("b", "HEAD", 404, None), ("c", "HEAD", 403, None), ("c", "GET", 200, None), ("d", "HEAD", 403, None), ("d", "GET", 403, None), ("e", "HEAD", 418, None), ("e", "GET", 418, None), ("f", "HEAD", None, "T"), ("f", "GET", None, "T"), ("g", "HEAD", 405, None), ("g", "GET", 410, None)]
    got = {r["url"]: r["verdict"] for r in links.link_verdicts(spark.createDataFrame(rows, "url string, method string, status int, exception string")).collect()}
    assert got == {"a": "정상", "b": "실패", "c": "정상", "d": "확인 불가", "e": "확인 불가", "f": "확인 불가", "g": "실패"}


def good_report():
    events = "".join(f"### #{k} title\n[사실] a\n[해석] b\n[불확실] c\n시각: d\n출처: [x](https://e.com/{k})\n" for k in range(1, 6))
    return "\n".join([terms.SECTIONS[0], "시장 환경: **혼조**", "지배 변수: x", "유효기간: y", terms.SECTIONS[1], events, terms.SECTIONS[2], *(f"[{c}]" for c in terms.CATEGORIES), *terms.SECTIONS[3:], *(f"- {f}: v" for f in terms.AUDIT_FIELDS), "- 최종 채택 수: 5/20"])


def test_rules_pass_a_good_report_and_catch_each_mutation(spark):
    good = good_report()
    cases = {
        "good": good, "section": good.replace(terms.SECTIONS[3], ""), "section_order": good.replace(terms.SECTIONS[3], "@").replace(terms.SECTIONS[4], terms.SECTIONS[3]).replace("@", terms.SECTIONS[4]),
        "state_value": good.replace("혼조", "좋음"), "state_missing": good.replace("시장 환경:", ""), "header": good.replace("유효기간:", ""), "category": good.replace("[일본]", ""),
        "event_label": good.replace("시각: d", "", 1), "id_gap": good.replace("### #5", "### #7"), "id_over": good + "\n#21", "forbidden": good + "\n목표 주가", "audit": good.replace("검색 완료 카테고리", ""),
        "declared_format": good.replace("5/20", "5"), "declared_differs": good.replace("5/20", "6/20"), "core_few": good.replace("### #5", "#5"), "core_count": good.replace(terms.SECTIONS[2], "### #6 t\n[사실][해석][불확실]시각:출처:](https://e)\n" + terms.SECTIONS[2]),
    }
    names = list(cases)
    docs = spark.createDataFrame([(i, cases[n]) for i, n in enumerate(names)], "report_id long, text string")
    found = {}
    for r in rules.violations(docs).collect():
        found.setdefault(names[r["report_id"]], set()).add(r["rule"])
    assert "good" not in found
    assert all(n in found[n] for n in names[1:]), found
    gate = {names[r["report_id"]]: r["passed"] for r in rules.gate(docs).collect()}
    assert gate["good"] and gate["declared_differs"] and not gate["section"]
    assert not {names[r["report_id"]]: r["passed"] for r in rules.gate(docs, strict=True).collect()}["declared_differs"]


def test_whole_run(spark):
    rows = spark.createDataFrame([article(1, "Fed raises interest rate sharply", source="a", tier=1), article(2, "Fed raises interest rate sharply today", source="b"), article(3, "old story entirely", published=datetime(2026, 9, 1))], ARTICLE)
    status = spark.createDataFrame([("미국", "a", "u", 1, True, 2, None), ("한국", "b", "u", 2, False, 0, "E")], "category string, name string, url string, tier int, ok boolean, fetched long, error string")
    run = collect(rows, status, F.lit(NOW))
    events = run.events.collect()
    assert len(events) == 1 and events[0]["sources"] == ["a", "b"]
    text = {r["ord"]: r["text"] for r in run.markdown.collect()}
    assert "중복 보도 1개 매체: b" in text[1] and "피드 실패 1개" in text[5] and "구간 내 신규 기사 없음" in text[0]
    meta = run.meta.first()
    assert (meta["articles_fetched"], meta["articles_in_window"], meta["clusters"], meta["feeds_ok"]) == (3, 2, 1, 1)
    assert meta["window_label"] == terms.LABEL_DAY
    wider = collect(rows, status, F.lit(NOW), since=F.lit(datetime(2026, 9, 1)))
    assert wider.meta.first()["articles_in_window"] == 3 and wider.events.count() == 2
    monday = collect(rows, status, F.lit(datetime(2026, 9, 13, 22))).meta.first()
    assert monday["window_label"] == "마지막 주요 시장 마감(미국 2026-09-11 16:00 EDT) 이후"
    winter = collect(rows, status, F.lit(datetime(2026, 12, 6, 22))).meta.first()
    assert "2026-12-04 16:00 EST" in winter["window_label"]
    long = status.withColumn("error", F.when(~F.col("ok"), F.repeat(F.lit("E"), 500)))
    assert max(len(r["error"] or "") for r in coverage.feed_status(long, rows).collect()) == 200
    assert coverage.failed_feeds(status).first()["failed"] == "b"
