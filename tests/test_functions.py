"""Scalar functions on hand-written cases."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from skeinflow.functions import dates, text, urls


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(make(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTP://www.Example.com/a/?utm_source=x&b=1#f", "http://example.com/a?b=1"),
        ("https://example.com", "https://example.com/"),
        ("https://example.com:8080/x//", "https://example.com:8080/x"),
        ("https://e.com/p?b&a=&UTM_Source=1&c=%E2%9C%93", "https://e.com/p?b=&a=&c=%E2%9C%93"),
        ("https://e.com/p?q=a+b&s=~*", "https://e.com/p?q=a+b&s=~%2A"),
        ("https://e.com/p?&&x=%zz", "https://e.com/p?x=%25zz"),
        ("https://wwwx.e.com/?ref=1", "https://wwwx.e.com/"),
        ("", ""),
        ("https://a.com/x\ty\n?b=1", "https://a.com/xy?b=1"),
        ("https:///x", "https:///x"),
        ("mailto:a@b.c", "mailto:a@b.c"),
    ],
)
def test_canonical_url(spark, url, want):
    assert one(spark, url, urls.canonical) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("Mon, 07 Sep 2026 07:00:00 +0900", "2026-09-06 22:00:00"),
        ("Mon, 07 Sep 2026 07:00:00 EST", "2026-09-07 12:00:00"),
        ("7 Sep 2026 07:00 GMT", "2026-09-07 07:00:00"),
        ("Mon, 07 Sep 2026 07:00:00 KST", "2026-09-07 07:00:00"),
        ("2026-09-07T07:00:00Z", "2026-09-07 07:00:00"),
        ("2026-09-07T07:00+09:00", "2026-09-06 22:00:00"),
        ("2026-09-07 07:00:00+0900", "2026-09-06 22:00:00"),
        ("2026-09-07T07:00:00.25Z", "2026-09-07 07:00:00.250000"),
        ("2026/09/07 07:00:00", "2026-09-07 07:00:00"),
        ("2026.09.07 07:00", "2026-09-07 07:00:00"),
        ("2026-09-07", "2026-09-07 00:00:00"),
        ("  ", None),
        ("soon", None),
    ],
)
def test_parse_date(spark, raw, want):
    got = one(spark, raw, lambda c: dates.parse_date(c).cast("string"))
    assert got == (want.replace(".250000", ".25") if want else None)


MAIL = [
    "10 Sep 26 07:00:00 GMT", "Thu, 10 Sep 26 07:00:00 +0900", "10 September 2026 07:00:00 GMT", "Thursday, 10-Sep-26 07:00:00 GMT", "Thu, 10 Sep 2026 07:00:00 +09:00",
    "Thu, 10 Sep 2026 07:00:00 GMT+0900", "Thu Sep 10 07:00:00 2026", "Thu, 10 Sep 2026 07:00:00 +0900 (KST)", "Thu, 10 Sep 2026 07:00 PST", "10 sep 1999 7:05:09 EDT",
    "Thu,10 Sep 2026 07:00:00 -0330", "Thu, 10 Sep 68 07:00:00 Z", "Thu, 10 Sep 69 07:00:00 Z", "Sep 10, 2026 07:00:00 EST", "Thu, Sep 10 2026 07:00:00", "Thu Sep 10 07:00:00 EST 2026",
    "10 Sep 2026 07:00:00+0900", "Thu, 10 Sep 2026 07:00:00 -0000", "Thu, 10 Sep 2026 07:00:00 XYZ", "29 Feb 2024 00:00:00 UT",
]
NO_MAIL = ["30 Feb 2026 07:00:00 GMT", "10 Sept 2026 07:00:00 GMT", "10 Sep 2026 25:00:00 GMT", "10 Sep 2026", "2026 Sep 10", "Thu, 10 Sep 2026 07:61:00 GMT", "hello there my old friend"]
ISO = [
    "20260910T070000Z", "2026-09-10T07", "2026-W37-4", "2026-W37", "2026W374T0730", "2026-09-10T07:00:00+09", "2026-09-10T07:00:00.1234567+09:00", "2026-09-10 07:00:00,5", "20260910", "2026-09-10T07:00:00-03:30",
    "2020-W53-7", "2026-09-10T070000+0900", "2026-09-10T07:00:00 +0900",
]
NO_ISO = ["2026-13-01", "2026-02-30T00:00", "2025-W53-1", "2026-W00-1", "2026-W37-8", "2026-09-10T24:30", "26-09-10", "2026-09", "202609"]


def test_parse_date_agrees_with_the_standard_library(spark):
    from email.utils import parsedate_to_datetime

    def utc(d):
        return (d if d.tzinfo else d.replace(tzinfo=timezone.utc)).astimezone(timezone.utc).replace(tzinfo=None)

    want = {r: utc(parsedate_to_datetime(r)) for r in MAIL} | {r: utc(datetime.fromisoformat(r)) for r in ISO} | dict.fromkeys(NO_MAIL + NO_ISO)
    want |= {"2026-9-1 7:00:05": datetime(2026, 9, 1, 7, 0, 5), "2026/9/1 07:00:00": datetime(2026, 9, 1, 7), "2026.9.1 7:00": datetime(2026, 9, 1, 7), "2026-9-1": datetime(2026, 9, 1), " 2026-09-10T07 ": datetime(2026, 9, 10, 7)}
    for r in NO_MAIL:
        with pytest.raises(ValueError):
            parsedate_to_datetime(r)
    for r in NO_ISO:
        with pytest.raises(ValueError):
            datetime.fromisoformat(r)
    rows = spark.createDataFrame([(r,) for r in want], "raw string").select("raw", F.unix_micros(dates.parse_date(F.col("raw"))).alias("at")).collect()
    got = {r["raw"]: None if r["at"] is None else datetime(1970, 1, 1) + timedelta(microseconds=r["at"]) for r in rows}
    assert got == want


@pytest.mark.parametrize(
    ("now", "start"),
    [
        ("2026-09-13 22:03:00", "2026-09-11 20:00:00"),  # Monday 07:03 in Seoul
        ("2026-09-12 22:03:00", "2026-09-11 20:00:00"),  # Sunday
        ("2026-09-11 22:03:00", "2026-09-10 22:03:00"),
        ("2026-09-10 04:58:00", "2026-09-09 04:58:00"),
        ("2026-12-06 22:03:00", "2026-12-04 21:00:00"),  # winter time
    ],
)
def test_window_start(spark, now, start):
    assert one(spark, datetime.fromisoformat(now), lambda c: dates.window_start(c).cast("string"), "timestamp") == start


def test_clean_text_strips_tags_before_entities(spark):
    assert one(spark, "<p>a&lt;b&gt; &amp;\n c</p>", text.clean_text) == "a<b> & c"
    assert one(spark, None, text.clean_text) == ""
    assert one(spark, "x" * 401, text.clean_text) == "x" * 399 + "…"
    assert one(spark, "&eacute;&hellip;", lambda c: text.clean_text(c, full=True)) == "é…"


def test_title_tokens(spark):
    def tokens(s):
        return set(one(spark, s, text.title_tokens))

    assert tokens("[속보] The Fed ＡＢＣ raises 25 한국 ai カナ 中国 2026") == {"fed", "abc", "raises", "한국", "中国"}
    assert tokens("the of 12 ab") == set()


def test_html_flag(spark):
    assert one(spark, "  <!DOCTYPE html><x>", text.looks_like_html) is True
    assert one(spark, "<?xml version='1.0'?>", text.looks_like_html) is False
