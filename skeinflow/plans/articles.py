"""Binding of the test tables to the relations that the operators work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import terms, text
from ..functions.dates import window_start, within

#: The fixed moment of all test runs.
NOW = "2024-01-03 12:00:00"
#: Terms that occur in the test texts stand in for the subject areas and for the matters put last.
TEST_TOPICS = {"article": (" the ", " der ", " la "), "suffix": ("tion", "keit", "ción"), "legal": ("license", "copyright"), "short": (" ai ", " en "), "marks": ("###", "$$$")}
TEST_NOISE = ("!!", "***", "idiot", "stupid", "trash")
TEST_TENORS = {"click": "3M", "view": "2Y", "purchase": "5Y", "signup": "10Y", "login": "30Y"}  # one kind is unwanted, one maturity never comes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


def _feed(n: Column) -> list[Column]:
    return [(n % 4 + 1).cast("int").alias("source_tier"), F.concat(F.lit("cat"), (n % 10).cast("string")).alias("category"), F.concat(F.lit("https://feeds.example.com/src"), n.cast("string")).alias("feed_url")]


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """category, tier, name, url, error and blocked_reason of each source.

    Feed 3 of 7 cannot be read; sources 15 and above are candidates that were blocked.
    """
    n = F.substring("source", 4, 9).cast("int")
    own = table(spark, sf_dir, "documents").select("source").distinct().filter("source is not null")
    tier, category, url = _feed(n)
    return own.select(
        category, tier.alias("tier"), F.col("source").alias("name"), url.alias("url"), F.when(n % 7 == 3, "HTTPError: 403").alias("error"),
        F.when(n >= 15, F.element_at(F.array(F.lit("waf"), F.lit("none"), F.lit("egress_policy")), (n % 3 + 1).cast("int"))).alias("blocked_reason"),
    )


def feeds_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources as one JSON document, as a run is configured with: a dimension of some dozen rows."""
    own = feeds(spark, sf_dir).withColumn("note", F.lit(None).cast("string")).withColumn("detail", F.col("error"))
    fields = ["category", "tier", "name", "url", "note"]
    active = F.collect_list(F.when(F.col("blocked_reason").isNull(), F.struct(*fields))).alias("feeds")
    blocked = F.collect_list(F.when(F.col("blocked_reason").isNotNull(), F.struct(*fields, "blocked_reason", "detail"))).alias("candidate_feeds")
    return own.agg(active, blocked).select(F.to_json(F.struct("feeds", "candidate_feeds")).alias("value"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles; those with a page come twice, the second time re-tagged and from another outlet.

    Title and summary, both bounded, are taken where documents are read: no join carries whole texts.
    """
    d, e, p = (table(spark, sf_dir, t) for t in ("documents", "events", "pages"))
    own = d.select(F.col("doc_id").alias("_id"), text.clean_text(F.split("text", "\n")[0], 300).alias("title"), text.clean_text(F.col("text"), 400).alias("summary"), "source")
    dated = e.select(F.col("event_id").alias("_id"), F.col("ts").cast("timestamp").alias("ts"))
    joined = own.join(dated, "_id", "left").join(p.select(F.col("page_id").alias("_id"), F.col("url").alias("page_url")), "_id", "left")
    # a row is dealt as its first and, with a page, its second article: one read and one join for both
    paged = F.col("page_url").isNotNull()
    both = joined.withColumn("_second", F.explode(F.when(paged, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    again = F.col("_second")
    link = F.coalesce("page_url", F.concat(F.lit("https://src.example.com/"), F.col("_id").cast("string")))
    tagged = F.concat(link, F.when(link.contains("?"), "&").otherwise("?"), F.lit("utm_medium=x"))
    n = F.substring("source", 4, 9).cast("int")
    n = F.when(again, (n + 7) % 20).otherwise(n)
    return both.select(
        (F.col("_id") + F.when(again, 10_000_000).otherwise(0)).alias("seq"), "title", F.when(again, tagged).otherwise(link).alias("link"), "summary",
        F.when(F.col("_id") % 37 != 0, F.col("ts")).alias("published"), F.concat(F.lit("src"), n.cast("string")).alias("source_name"), *_feed(n),
    )


def valid(rows: DataFrame) -> DataFrame:
    return rows.filter((F.col("title") != "") & (F.col("link") != ""))


def in_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of the collection window; only what later steps need is read."""
    return valid(articles(spark, sf_dir)).filter(within(F.col("published"), window_start(now()), now()))


def categories(spark: SparkSession) -> DataFrame:
    return spark.range(10).select(F.col("id").alias("ord"), F.concat(F.lit("cat"), F.col("id").cast("string")).alias("category"))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw series: one row per day and kind of event, the mean as text; one kind per day is no number."""
    e = table(spark, sf_dir, "events").withColumn("as_of", F.to_date("ts"))
    daily = e.groupBy("as_of", F.col("event_type").alias("name")).agg(F.expr("CAST(sum(CAST(value AS DECIMAL(18, 6))) * 1000000 AS BIGINT) DIV count(value)").alias("v"))
    shown = F.concat(F.expr("CAST(v DIV 1000000 AS STRING)"), F.lit("."), F.lpad(F.expr("CAST(v % 1000000 AS STRING)"), 6, "0"))
    value = F.when(F.pmod(F.dayofmonth("as_of") + F.length("name"), F.lit(9)) == 0, "n/a").otherwise(shown)
    return daily.select(F.lit(0).cast("long").alias("seq"), "as_of", "name", value.alias("value"))


#: A report per turn of a conversation, in SQL that Spark and DuckDB both read.  Each rule is broken by some of them.
_EVENTS = " || ".join(
    f"CASE WHEN r % 7 >= {k} THEN '### #{k + 1 if k != 3 else 5} headline {k} [P]\n' || CASE WHEN r % 11 = {k} THEN '' ELSE '[사실] fact\n' END || '[해석] view\n[불확실] open\n' || CASE WHEN r % 13 = {k} THEN '' ELSE '시각: 07:00\n' END || '출처: [desk](https://example.com/' || CAST(r AS VARCHAR(20)) || CASE WHEN r % 9 = {k} THEN ').' ELSE '/{k}) and [wire](https://wire.example.org/a,b.)' END || '\n' ELSE '' END"
    for k in range(7)
)
_CATEGORIES = " || ".join(f"CASE WHEN (r + {i}) % 23 = 0 THEN '' ELSE '### [{c}] ok | unique 3 | adopted 1\n' END" for i, c in enumerate(terms.CATEGORIES))
#: The number of adopted events is written apart, below.
_AUDIT = " || ".join(f"CASE WHEN (r + {i}) % 29 = 0 THEN '' ELSE '- {f}: v\n' END" for i, f in enumerate(f for f in terms.AUDIT_FIELDS if f != "최종 채택 수"))
REPORT = f"""
'# Brief (Asia/Seoul)\n' || CASE WHEN r % 31 = 5 THEN '' ELSE '## 6-1. 오늘의 한 문장\n' END
|| CASE WHEN r % 17 = 0 THEN '' ELSE '- 시장 환경: ' || CASE r % 6 WHEN 0 THEN '우호' WHEN 1 THEN '**혼조**' WHEN 2 THEN '부담 ' WHEN 3 THEN '판단 불가' WHEN 4 THEN 'calm' ELSE '혼조' END || '\n' END
|| CASE WHEN r % 5 = 0 THEN '' ELSE '- 지배 변수: rates\n' END || CASE WHEN r % 8 = 0 THEN '' ELSE '- 유효기간: 1d\n' END
|| '## 6-2. 핵심 사건 5\n' || {_EVENTS}
|| '## 6-3. 카테고리별 글로벌 브리프\n' || {_CATEGORIES}
|| CASE WHEN r % 19 = 3 THEN '## 6-5. PEST Quick View\n## 6-4. 시장 전달경로\n' ELSE '## 6-4. 시장 전달경로\n#1 and #2\n## 6-5. PEST Quick View\n' END
|| '## 6-6. 반대 근거와 불확실성\n' || body || '\n' || CASE WHEN r % 37 = 2 THEN '목표 가격\n' ELSE '' END || CASE WHEN r % 41 = 4 THEN 'an Aggressive stance\n' ELSE '' END || CASE WHEN r % 43 = 6 THEN 'see #27\n' ELSE '' END
|| '## 6-7. 다음 확인 일정\n## 6-8. Coverage Audit\n' || {_AUDIT}
|| CASE WHEN r % 47 = 7 THEN '- 최종 채택 수: many\n' ELSE '- 최종 채택 수: ' || CAST(1 + r % 7 AS VARCHAR(20)) || '/20\n' END
"""


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(report_id, text): a report for each turn of each conversation, with the whole turn in its body."""
    turns = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1_000_000 + F.col("turn")).alias("report_id"), (F.col("conv_id") + F.col("turn")).alias("r"), F.coalesce("text", F.lit("")).alias("body"))
    return turns.select("report_id", F.expr(_spark_literals(REPORT)).alias("text"))


def _spark_literals(sql: str) -> str:
    """Spark reads backslash escapes inside quotes; line ends there are written as such."""
    out, quoted = [], False
    for ch in sql:
        quoted ^= ch == "'"
        out.append("\\n" if quoted and ch == "\n" else ch)
    return "".join(out)


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, method, status, exception): outcomes of probing each page's address, by its id."""
    p = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("https://probe.example.com/"), F.col("page_id").cast("string")).alias("url"))
    codes = [200, 301, 403, 404, 410, 418, 429, 500, 503]
    head = F.element_at(F.array(*[F.lit(c) for c in codes]), (F.col("page_id") % 9 + 1).cast("int"))
    get = F.element_at(F.array(*[F.lit(c) for c in (200, 403, 404, 418)]), (F.col("page_id") % 4 + 1).cast("int"))
    first = p.select("url", F.lit("HEAD").alias("method"), F.when(F.col("page_id") % 10 != 9, head).alias("status"), F.when(F.col("page_id") % 10 == 9, "TimeoutError: slow").alias("exception"))
    second = p.select("url", F.lit("GET").alias("method"), F.when(F.col("page_id") % 14 != 13, get).alias("status"), F.when(F.col("page_id") % 14 == 13, "OSError: reset").alias("exception"))
    return first.unionByName(second)
