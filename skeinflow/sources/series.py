"""Monthly series documents: one fetch per month, failures kept as rows, fields by a table function."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.terms import CURVE_EMPTY
from ..operators.series import curve_delta, tenor_project
from .feed_xml import ParseSeries
from .feeds import fetch


def read_series(spark: SparkSession, address: str, months: list[str], *, timeout: int = 30, retries: int = 2) -> DataFrame:
    """(month, payload, error) of each month; ``address`` holds {month} as yyyyMM.  A failed fetch is a row with its error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for month in frame["month"]:
                try:
                    rows.append((month, fetch(address.format(month=month), timeout, retries), None))
                except Exception as e:  # noqa: BLE001  one month never fails the others
                    rows.append((month, None, f"{type(e).__name__}: {e}"[:200]))
            yield pd.DataFrame(rows, columns=["month", "payload", "error"])

    listed = spark.createDataFrame([(m,) for m in months], "month string")
    return listed.repartition(max(1, len(months)), "month").mapInPandas(run, "month string, payload binary, error string")


def fields(read: DataFrame) -> DataFrame:
    """(seq, as_of, name, value) of the read documents; seq follows month and place."""
    parsed = read.filter("payload is not null").lateralJoin(ParseSeries(F.col("payload").outer()))
    ordinal = F.col("month").cast("long") * 1_000_000 + F.col("seq")
    return parsed.select(ordinal.alias("seq"), F.to_date(parse_date(F.col("as_of_raw"))).alias("as_of"), "name", "value")


def curve(read: DataFrame, tenors: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The latest curve with its changes, and one row (error): why there is none, null where there is one."""
    found = curve_delta(tenor_project(fields(read), tenors))
    failed = read.agg(F.max("error").alias("error"))
    some = found.agg(F.count(F.lit(1)).alias("n"))
    why = failed.crossJoin(some).select(F.when(F.col("n") == 0, F.coalesce("error", F.lit(CURVE_EMPTY))).alias("error"))  # two single rows
    return found, why
