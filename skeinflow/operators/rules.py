"""Structure rules of report documents (report_id, text); each operator is one check over all documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.terms import AUDIT_FIELDS, CATEGORIES, DECLARED, EVENT_LABELS, FORBIDDEN, HEADER_LABELS, HEADING, MARKET_STATES, SECTIONS, STATE

MAX_EVENTS, MAX_CORE = 20, 5


def section(text: Column, start: str, end: str | None) -> Column:
    """From marker to marker; empty when either is missing or they stand the other way round."""
    a = F.instr(text, start)
    if end is None:
        return F.when(a > 0, F.substr(text, a)).otherwise("")
    b = F.instr(text, end)
    return F.when((a > 0) & (b > a), F.substr(text, a, b - a)).otherwise("")


def absent(where: Column, wanted: tuple[str, ...]) -> Column:
    """Wanted strings that ``where`` does not hold."""
    return F.filter(F.array(*[F.lit(w) for w in wanted]), lambda w: ~where.contains(w))


def absent_sections(text: Column) -> Column:
    return absent(text, SECTIONS)


def absent_categories(text: Column) -> Column:
    return absent(section(text, "## 6-3.", "## 6-4."), tuple(f"[{c}]" for c in CATEGORIES))


def absent_audit(text: Column) -> Column:
    return absent(section(text, "## 6-8.", None), AUDIT_FIELDS)


def absent_header(text: Column) -> Column:
    return F.array_compact(F.array(*[F.when(~text.rlike(rf"{w}\s*[:：]"), F.lit(w)) for w in HEADER_LABELS]))


def places(text: Column) -> Column:
    return F.array(*[F.instr(text, s) for s in SECTIONS])


def complete(text: Column) -> Column:
    return ~F.exists(places(text), lambda p: p == 0)


def ordered(text: Column) -> Column:
    """Sections in their order; a text that lacks any passes here."""
    return ~complete(text) | (places(text) == F.array_sort(places(text)))


def state(text: Column) -> Column:
    """The declared market state without its marks; null when there is none."""
    raw = F.regexp_replace(F.regexp_extract(text, STATE, 1), r"\s+$", "")
    return F.when(text.rlike(STATE), F.trim(F.regexp_replace(F.trim(raw), r"^[*`]+|[*`]+$", "")))


def core_ids(text: Column) -> Column:
    return F.regexp_extract_all(section(text, "## 6-2.", "## 6-3."), F.lit(HEADING), F.lit(1))


def core_blocks(text: Column) -> Column:
    """Structs (id, block) of the core events in order."""
    parts = F.split(section(text, "## 6-2.", "## 6-3."), r"(?m)^###\s+#\d+\s+")
    both = F.arrays_zip(core_ids(text).alias("id"), F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))).alias("block"))
    return F.filter(both, lambda e: e["id"].isNotNull() & e["block"].isNotNull())


def absent_labels(block: Column) -> Column:
    """Labels, and the direct link, that a core event lacks."""
    return F.concat(absent(block, EVENT_LABELS), F.when(~block.rlike(r"\]\(https?://"), F.array(F.lit("link"))).otherwise(F.array().cast("array<string>")))


def refs(text: Column) -> Column:
    """Distinct numbers after # anywhere, ascending."""
    numbers = F.transform(F.regexp_extract_all(text, F.lit(r"#(\d+)"), F.lit(1)), lambda x: F.try_to_number(x, F.lit("9" * 18)).cast("long"))
    return F.array_sort(F.array_distinct(F.array_compact(numbers)))


def adopted(ids: Column) -> Column:
    return F.filter(ids, lambda i: i.between(1, MAX_EVENTS))


def over(ids: Column) -> Column:
    return F.filter(ids, lambda i: i > MAX_EVENTS)


def gaps(kept: Column) -> Column:
    full = F.when(F.size(kept) > 0, F.sequence(F.lit(1).cast("long"), F.array_max(kept))).otherwise(F.array().cast("array<long>"))
    return F.array_except(full, kept)


def forbidden_hits(text: Column) -> Column:
    """Structs (rule, found): the first match of each expression that must not occur."""
    hits = [F.when(text.rlike(f"(?iU)({p})"), F.struct(F.lit(name).alias("rule"), F.regexp_extract(text, f"(?iU)({p})", 1).alias("found"))) for p, name in FORBIDDEN]
    return F.array_compact(F.array(*hits))


def declared(text: Column) -> Column:
    number = F.regexp_extract(section(text, "## 6-8.", None), DECLARED, 1)
    return F.when(number != "", number.try_cast("long"))


def link_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(r"\]\((https?://[^\s)]+)\)"), F.lit(1))).cast("long")


# one check over all documents each


def missing_sections(docs: DataFrame) -> DataFrame:
    return docs.select("report_id", F.explode(absent_sections(F.col("text"))).alias("missing"))


def missing_categories(docs: DataFrame) -> DataFrame:
    return docs.select("report_id", F.explode(absent_categories(F.col("text"))).alias("missing"))


def missing_audit_fields(docs: DataFrame) -> DataFrame:
    return docs.select("report_id", F.explode(absent_audit(F.col("text"))).alias("missing"))


def missing_header_labels(docs: DataFrame) -> DataFrame:
    return docs.select("report_id", F.explode(absent_header(F.col("text"))).alias("missing"))


def section_order(docs: DataFrame) -> DataFrame:
    """(report_id, complete, ordered): whether all sections are there, and in order if so."""
    return docs.select("report_id", complete(F.col("text")).alias("complete"), ordered(F.col("text")).alias("ordered"))


def market_state(docs: DataFrame) -> DataFrame:
    """(report_id, state, allowed)."""
    found = docs.select("report_id", state(F.col("text")).alias("state"))
    return found.withColumn("allowed", F.coalesce(F.col("state").isin(*MARKET_STATES), F.lit(False)))


def event_blocks(docs: DataFrame) -> DataFrame:
    """(report_id, pos, event_id, block) of the core events."""
    rows = docs.select("report_id", F.posexplode(core_blocks(F.col("text"))).alias("pos", "e"))
    return rows.select("report_id", "pos", F.col("e.id").cast("long").alias("event_id"), F.col("e.block").alias("block"))


def missing_event_labels(docs: DataFrame) -> DataFrame:
    """(report_id, event_id, missing)."""
    return event_blocks(docs).select("report_id", "event_id", F.explode(absent_labels(F.col("block"))).alias("missing"))


def event_refs(docs: DataFrame) -> DataFrame:
    return docs.select("report_id", refs(F.col("text")).alias("ids"))


def id_gaps(docs: DataFrame) -> DataFrame:
    """(report_id, adopted, missing, over): ids within 1..20, the gaps below their largest, ids above."""
    found = event_refs(docs).select("report_id", adopted(F.col("ids")).alias("adopted"), over(F.col("ids")).alias("over"))
    return found.select("report_id", "adopted", gaps(F.col("adopted")).alias("missing"), "over")


def forbidden(docs: DataFrame) -> DataFrame:
    """(report_id, rule, found)."""
    return docs.select("report_id", F.explode(forbidden_hits(F.col("text"))).alias("h")).select("report_id", "h.rule", "h.found")


def declared_counts(docs: DataFrame) -> DataFrame:
    """(report_id, declared, counted, links): the declared number of events, those seen, and the links."""
    text = F.col("text")
    return docs.select("report_id", declared(text).alias("declared"), F.size(adopted(refs(text))).cast("long").alias("counted"), link_count(text).alias("links"))


def checked(docs: DataFrame) -> DataFrame:
    """(report_id, found): all violations (severity, rule, subject) of each document, in one pass without a shuffle."""
    text = F.col("text")
    parts = docs.select(
        "report_id", "text", state(text).alias("_state"), core_ids(text).alias("_ids"), core_blocks(text).alias("_blocks"),
        refs(text).alias("_refs"), declared(text).alias("_declared"), link_count(text).alias("_links"),
    )
    parts = parts.withColumn("_adopted", adopted(F.col("_refs"))).withColumn("_counted", F.size("_adopted").cast("long")).withColumn("_n", F.size("_ids"))

    def row(severity: str, rule: str, subject: Column) -> Column:
        return F.struct(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), subject.cast("string").alias("subject"))

    def each(subjects: Column, rule: str) -> Column:
        return F.transform(subjects, lambda x: row("error", rule, x))

    def when(holds: Column, severity: str, rule: str, subject: Column) -> Column:
        return F.when(holds, F.array(row(severity, rule, subject))).otherwise(F.array().cast("array<struct<severity:string,rule:string,subject:string>>"))

    none, n, counted, number = F.lit(""), F.col("_n"), F.col("_counted"), F.col("_declared")
    labels = F.flatten(F.transform("_blocks", lambda e: F.transform(absent_labels(e["block"]), lambda m: F.concat(F.lit("#"), e["id"], F.lit(" "), m))))
    found = [
        each(absent_sections(text), "section"),
        when(~ordered(text), "error", "section_order", none),
        when(F.col("_state").isNull(), "error", "state_missing", none),
        when(F.coalesce(~F.col("_state").isin(*MARKET_STATES), F.lit(False)), "error", "state_value", F.col("_state")),
        each(absent_header(text), "header"),
        each(absent_categories(text), "category"),
        when(n == 0, "error", "core_missing", none),
        when(n > MAX_CORE, "error", "core_count", n),
        when(n.between(1, MAX_CORE - 1), "warning", "core_few", n),
        when(n != F.size(F.array_distinct("_ids")), "error", "core_repeated", none),
        each(labels, "event_label"),
        when(F.size(over(F.col("_refs"))) > 0, "error", "id_over", F.array_join(over(F.col("_refs")), ",")),
        when(F.size(gaps(F.col("_adopted"))) > 0, "error", "id_gap", F.array_join(gaps(F.col("_adopted")), ",")),
        F.transform(forbidden_hits(text), lambda h: row("error", "forbidden", h["rule"])),
        each(absent_audit(text), "audit"),
        when(number.isNull(), "error", "declared_format", none),
        when(F.coalesce(number > MAX_EVENTS, F.lit(False)), "error", "declared_over", number),
        when(F.coalesce((counted > 0) & (number != counted), F.lit(False)), "warning", "declared_differs", number),
        when(F.col("_links") < F.greatest(counted, F.lit(1)), "warning", "links_few", F.col("_links")),
    ]
    return parts.select("report_id", F.concat(*found).alias("found"))


def violations(docs: DataFrame) -> DataFrame:
    """(report_id, severity, rule, subject): all rules over all documents."""
    return checked(docs).select("report_id", F.explode("found").alias("v")).select("report_id", "v.severity", "v.rule", "v.subject")


def gate(docs: DataFrame, *, strict: bool = False) -> DataFrame:
    """(report_id, errors, warnings, passed) of every document."""
    def count(severity: str) -> Column:
        return F.size(F.filter("found", lambda v: v["severity"] == severity)).cast("long")

    out = checked(docs).select("report_id", count("error").alias("errors"), count("warning").alias("warnings"))
    return out.withColumn("passed", (F.col("errors") == 0) & (F.lit(not strict) | (F.col("warnings") == 0)))


def gate_lines(docs: DataFrame, *, strict: bool = False) -> DataFrame:
    """(report_id, line, text): what a reader is told of each document, warnings first, the verdict last."""
    found = checked(docs).select("report_id", "found", F.size(F.filter("found", lambda v: v["severity"] == "error")).alias("errors"), F.size(F.filter("found", lambda v: v["severity"] == "warning")).alias("warnings"))

    def told(severity: str, word: str) -> Column:
        own = F.filter("found", lambda v: v["severity"] == severity)
        return F.transform(own, lambda v: F.concat(F.lit(f"  {word}  "), v["rule"], F.when(v["subject"] != "", F.concat(F.lit(": "), v["subject"])).otherwise("")))

    errors, warnings = F.col("errors").cast("string"), F.col("warnings").cast("string")
    verdict = (
        F.when(F.col("errors") > 0, F.concat(F.lit("\n검증 실패: 오류 "), errors, F.lit("건, 경고 "), warnings, F.lit("건")))
        .when(F.lit(strict) & (F.col("warnings") > 0), F.concat(F.lit("\n검증 실패(strict): 경고 "), warnings, F.lit("건")))
        .otherwise(F.concat(F.lit("\n검증 통과 (경고 "), warnings, F.lit("건)")))
    )
    lines = F.concat(told("warning", "경고"), told("error", "오류"), F.array(verdict))
    return found.select("report_id", F.posexplode(lines).alias("line", "text"))


def exit_code(states: DataFrame, gated: DataFrame) -> int:
    """2 if a document is missing or empty (``states``: report_id, state), else 1 if one does not pass, else 0."""
    if not states.filter(F.col("state") != "ok").isEmpty():
        return 2
    return int(not gated.filter(~F.col("passed")).isEmpty())
