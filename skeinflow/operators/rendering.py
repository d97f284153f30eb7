"""Events as lines, documents and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import SEOUL, seoul
from ..functions.terms import DIGEST_NOTES, DIGEST_TITLE, NO_TIME
from .ranking import top_per_category

SUMMARY, OUTLETS = 180, 6


def event_line(event_id: Column, lead: str, topics: Column) -> Column:
    """[id] title | time | outlet(tier) | subject areas | link"""
    when = F.coalesce(F.concat(F.date_format(F.from_utc_timestamp(F.col(f"{lead}.published"), SEOUL), "MM-dd HH:mm"), F.lit(" KST")), F.lit(NO_TIME))
    areas = F.when(F.size(topics) > 0, F.concat(F.lit(" | 주제: "), F.array_join(topics, ", "))).otherwise("")
    return F.concat(F.lit("- ["), event_id.cast("string"), F.lit("] "), F.col(f"{lead}.title"), F.lit(" | "), when, F.lit(" | "), F.col(f"{lead}.source_name"), F.lit("(T"), F.col(f"{lead}.source_tier").cast("string"), F.lit(")"), areas, F.lit(" | "), F.col(f"{lead}.link"))


def event_lines(events: DataFrame, n: int = 35) -> DataFrame:
    """(category, place, line): up to three lines of each of the first n events of a category, as one text."""
    others = F.array_except("sources", F.array("lead.source_name"))
    summary = F.when(F.col("lead.summary") != "", F.concat(F.lit("\n    · "), F.substring("lead.summary", 1, SUMMARY))).otherwise("")
    more = F.when(F.size(others) > 0, F.concat(F.lit("\n    ↳ 중복 보도 "), F.size(others).cast("string"), F.lit("개 매체: "), F.array_join(F.slice(others, 1, OUTLETS), ", "))).otherwise("")
    top = top_per_category(events, n)
    return top.select(F.col("lead.category").alias("category"), "place", F.concat(event_line(F.col("event_id"), "lead", F.col("topics")), summary, more).alias("line"))


def markdown(categories: DataFrame, coverage: DataFrame, events: DataFrame, n: int = 35) -> DataFrame:
    """(ord, text): one section per category in presentation order, with its failed feeds and what was left out."""
    lines = event_lines(events, n).groupBy("category").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]), "\n").alias("body"))
    counted = coverage.select("category", "candidate_events", "feeds_failed")
    joined = categories.join(counted, "category", "left").join(lines, "category", "left")
    found, failed = F.coalesce("candidate_events", F.lit(0)), F.coalesce("feeds_failed", F.lit(0))
    head = F.concat(F.lit("## ["), "category", F.lit("] 후보 "), found.cast("string"), F.lit("건"), F.when(failed > 0, F.concat(F.lit(" · 피드 실패 "), failed.cast("string"), F.lit("개 — 누락 가능성 있음"))).otherwise(""))
    left_out = F.when(found > n, F.concat(F.lit("\n- (중요도 하위 "), (found - n).cast("string"), F.lit("건은 지면상 생략, candidates.json에는 모두 있음)"))).otherwise("")
    body = F.when(found == 0, "- 구간 내 신규 기사 없음").otherwise(F.concat(F.coalesce("body", F.lit("")), left_out))
    return joined.select("ord", F.concat(head, F.lit("\n\n"), body, F.lit("\n")).alias("text"))


def markdown_document(meta: DataFrame, sections: DataFrame) -> DataFrame:
    """(ord, text): the whole digest in order: title, window and counts, how to read it, then the sections."""
    c = {n: F.col(n).cast("string") for n in meta.columns}
    head = F.concat(
        F.lit(f"{DIGEST_TITLE}\n\n- 수집 구간: "), c["window_start_kst"], F.lit(" ~ "), c["window_end_kst"], F.lit(" ("), c["window_label"], F.lit(")\n- 피드: 정상 "), c["feeds_ok"], F.lit("/"), c["feeds_total"],
        F.lit("\n- 구간 내 기사: "), c["articles_in_window"], F.lit("건 → 1차 중복제거 후 후보 "), c["clusters"], F.lit("건\n\n" + "\n".join(DIGEST_NOTES) + "\n"),
    )
    return meta.select(F.lit(-1).cast("long").alias("ord"), head.alias("text")).unionByName(sections.select(F.col("ord").cast("long").alias("ord"), "text")).orderBy("ord")


def _article(prefix: str = "") -> list[Column]:
    f = F.col if not prefix else (lambda n: F.col(f"{prefix}.{n}"))
    return [f("title").alias("title"), f("link").alias("link"), f("summary").alias("summary"), seoul(f("published")).alias("published_kst"), f("source_name").alias("source_name"), f("source_tier").alias("source_tier"), f("category").alias("category")]


def run_document(meta: DataFrame, coverage: DataFrame, events: DataFrame, articles: DataFrame) -> DataFrame:
    """(part, event_id, place, text): lines that read one after another are one JSON document of meta, coverage and events.

    Every event holds all its articles, each a line of its own: no event's articles are gathered in one row.
    """
    keep = {"ignoreNullFields": "false"}

    def line(part: int, event_id: Column, place: Column, text: Column) -> list[Column]:
        return [F.lit(part).alias("part"), event_id.cast("long").alias("event_id"), place.cast("long").alias("place"), text.alias("text")]

    zero = F.lit(0)
    first = meta.select(*line(0, zero, zero, F.concat(F.lit('{"meta": '), F.to_json(F.struct("*"), keep), F.lit(', "coverage": ['))))
    covered = coverage.select(*line(1, zero, F.col("ord"), F.concat(F.when(F.col("ord") == 0, "").otherwise(","), F.to_json(F.struct(*[c for c in coverage.columns if c != "ord"]), keep))))
    opened = meta.select(*line(2, zero, zero, F.lit('], "events": [')))
    body = F.struct(F.col("event_id").alias("id"), F.col("lead.category").alias("category"), F.col("score").alias("prescore"), "topics", F.struct(*_article("lead")).alias("lead"), (F.size("sources") - 1).alias("duplicate_count"), "sources", F.col("has_primary").alias("has_primary_source"))
    shown = F.to_json(body, keep)
    # the closing brace of an event's own fields makes room for its articles
    heads = events.select(*line(3, F.col("event_id"), F.lit(-1), F.concat(F.when(F.col("event_id") == 1, "").otherwise(","), F.substr(shown, F.lit(1), F.length(shown) - 1), F.lit(', "articles": ['))))
    own = articles.join(events.select("component", "event_id", F.col("lead.seq").alias("lead_seq")), "component")
    # the lead stands first and without a comma before it
    led = F.col("seq") == F.col("lead_seq")
    members = own.select(*line(3, F.col("event_id"), F.when(led, 0).otherwise(F.col("seq") + 1), F.concat(F.when(led, "").otherwise(","), F.to_json(F.struct(*_article()), keep))))
    closed = events.select(*line(3, F.col("event_id"), F.lit(2**62), F.lit("]}")))
    last = meta.select(*line(4, zero, zero, F.lit("]}")))
    out = first
    for part in (covered, opened, heads, members, closed, last):
        out = out.unionByName(part)
    return out


def write_lines(lines: DataFrame, path: str, *order: str) -> None:
    """The ``text`` of lines as files under ``path`` whose names follow ``order``: read one after another they are the document."""
    lines.orderBy(*order).select(F.col("text").alias("value")).write.mode("overwrite").text(path)


def events_json(events: DataFrame) -> DataFrame:
    """(event_id, json): one document per event."""
    lead = F.struct(
        F.col("lead.title").alias("title"), F.col("lead.link").alias("link"), seoul(F.col("lead.published")).alias("published_kst"),
        F.col("lead.source_name").alias("source_name"), F.col("lead.source_tier").alias("source_tier"), F.col("lead.category").alias("category"),
    )
    body = F.struct(F.col("event_id").alias("id"), F.col("lead.category").alias("category"), F.col("topics"), lead.alias("lead"), (F.size("sources") - 1).alias("duplicate_count"), F.col("sources"), F.col("has_primary").alias("has_primary_source"))
    return events.select("event_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))


def write_run(events: DataFrame, coverage: DataFrame, meta: DataFrame, path: str) -> None:
    """Events, coverage and the digest as JSON lines under ``path``, one folder each."""
    for name, df in (("events", events_json(events).select(F.col("json").alias("value"))), ("coverage", coverage.select(F.to_json(F.struct("*")).alias("value"))), ("meta", meta.select(F.to_json(F.struct("*")).alias("value")))):
        df.write.mode("overwrite").text(f"{path}/{name}")
