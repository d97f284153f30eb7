"""Daily series by maturity: keep the wanted ones, compare the last row with the row before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.terms import CURVE_EMPTY, CURVE_LIMITS, CURVE_MISSING, CURVE_NOTE, CURVE_PAGE, CURVE_SOURCE, CURVE_TITLE, TENORS


def tenor_project(raw: DataFrame, tenors: dict[str, str] | None = None) -> DataFrame:
    """(seq, as_of, tenor, percent) of the wanted maturities; values that are no numbers are skipped."""
    names = tenors or TENORS
    lookup = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    kept = raw.filter(F.col("name").isin(*names)).withColumn("percent", F.expr("try_cast(trim(value) AS double)"))
    return kept.filter("percent is not null and as_of is not null").select("seq", "as_of", F.try_element_at(lookup, F.col("name")).alias("tenor"), "percent")


def curve_delta(series: DataFrame) -> DataFrame:
    """(tenor, percent, change_bp, as_of, compared_with) of the latest row against the row before it.

    Rows are (as_of, seq); the row before counts whatever the days between.  A maturity absent from the
    latest row is left out, one absent from the row before has no change.
    """
    last_two = series.groupBy("as_of", "seq").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("as_of"), F.desc("seq")).limit(2)
    place = last_two.withColumn("_place", F.row_number().over(Window.orderBy(F.desc("as_of"), F.desc("seq")))).drop("_n")
    rows = series.join(F.broadcast(place), ["as_of", "seq"])  # two rows
    latest = rows.filter("_place = 1").select("tenor", "percent", "as_of")
    before = rows.filter("_place = 2").select("tenor", F.col("percent").alias("_before"))
    compared = place.filter("_place = 2").select(F.col("as_of").alias("compared_with"))
    joined = latest.join(before, "tenor", "left").join(F.broadcast(compared), F.lit(True), "left")
    return joined.select("tenor", "percent", F.round((F.col("percent") - F.col("_before")) * 100, 1).alias("change_bp"), "as_of", "compared_with")


def curve_lines(curve: DataFrame) -> DataFrame:
    """(tenor, line): the table rows of a rendered curve."""
    change = F.when(F.col("change_bp").isNull(), "확인 불가").otherwise(F.format_string("%+.1f", "change_bp"))
    return curve.select("tenor", F.concat(F.lit("| "), "tenor", F.lit(" | "), F.format_string("%.2f", "percent"), F.lit(" | "), change, F.lit(" |")).alias("line"))


def curve_markdown(curve: DataFrame, errors: DataFrame | None = None, order: list[str] | None = None) -> DataFrame:
    """(text): the whole rendered curve; without rows, a note that nothing can be confirmed, and why (``errors``: one row)."""
    rank = F.array_position(F.array(*[F.lit(t) for t in order or list(TENORS.values())]), F.col("tenor"))
    rows = curve_lines(curve).withColumn("rank", rank).agg(F.array_join(F.array_sort(F.collect_list(F.struct("rank", "line"))).getField("line"), "\n").alias("rows"))
    head = curve.agg(F.max("as_of").alias("as_of"), F.max("compared_with").alias("compared_with"))
    if errors is None:
        errors = head.select(F.lit(None).cast("string").alias("error"))
    missing = F.concat(F.lit("- 확인 불가: "), F.coalesce("error", F.lit(CURVE_EMPTY)), F.lit("\n" + CURVE_MISSING))
    day = F.date_format("as_of", "yyyy-MM-dd")
    before = F.coalesce(F.date_format("compared_with", "yyyy-MM-dd"), F.lit("없음(비교 불가)"))
    table = F.concat_ws(
        "\n", F.concat(F.lit("- As-of: "), day, F.lit(f" ({CURVE_NOTE})")), F.concat(F.lit("- 전일 비교 기준일: "), before), F.lit(f"- 출처: {CURVE_SOURCE} — {CURVE_PAGE}"), F.lit(""),
        F.lit("| 만기 | 수익률(%) | 전일 대비(bp) |"), F.lit("| --- | --- | --- |"), F.col("rows"), F.lit(""), F.lit("\n".join(CURVE_LIMITS)),
    )
    body = F.when(F.col("as_of").isNull(), missing).otherwise(table)
    return head.crossJoin(rows).crossJoin(errors).select(F.concat(F.lit("\n".join(CURVE_TITLE) + "\n"), body, F.lit("\n")).alias("text"))  # three single rows


def curve_json(curve: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """(json): one document with the source, all maturities, and whether they are available or why not."""
    yields = F.map_from_entries(F.array_sort(F.collect_list(F.struct("tenor", F.struct("percent", "change_bp")))))
    one = curve.agg((F.count(F.lit(1)) > 0).alias("available"), F.date_format(F.max("as_of"), "yyyy-MM-dd").alias("as_of"), F.date_format(F.max("compared_with"), "yyyy-MM-dd").alias("compared_with"), yields.alias("yields"))
    if errors is None:
        errors = one.select(F.lit(None).cast("string").alias("error"))
    why = F.when(~F.col("available"), F.coalesce("error", F.lit(CURVE_EMPTY))).alias("error")
    body = F.struct(F.lit(CURVE_SOURCE).alias("source"), F.lit(CURVE_PAGE).alias("source_url"), "available", why, "as_of", F.lit(CURVE_NOTE).alias("as_of_note"), "compared_with", "yields")
    return one.crossJoin(errors).select(F.to_json(F.struct(body.alias("treasury_curve")), {"ignoreNullFields": "false"}).alias("json"))  # two single rows
