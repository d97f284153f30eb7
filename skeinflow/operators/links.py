"""Links of documents: extraction, verdicts of probes, counts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.terms import GONE, LINK, LINK_BLOCKED, LINK_GONE, LINKS_BROKEN, LINKS_UNVERIFIED, NO_LINKS, UNVERIFIABLE, VERDICT_BROKEN, VERDICT_OK, VERDICT_UNKNOWN

#: Who asks, for servers that refuse requests without it.
USER_AGENT = "Mozilla/5.0 (compatible; skeinflow/1.0)"


def extract_links(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, ord, url): distinct links of each document by first place, without closing punctuation."""
    found = docs.select(id_col, F.posexplode(F.regexp_extract_all(F.col(text_col), F.lit(LINK), F.lit(2))).alias("pos", "raw"))
    urls = found.withColumn("url", F.regexp_replace("raw", "[.,;]+$", ""))
    return urls.groupBy(id_col, "url").agg(F.min("pos").alias("ord"))


def link_verdicts(attempts: DataFrame) -> DataFrame:
    """(url, status, verdict, detail) of attempts (url, method HEAD or GET, status, exception); an ``ord`` is kept.

    A success or proof of absence ends the probing; otherwise GET follows HEAD and its outcome counts.
    """
    order = F.when(F.col("method") == "HEAD", 0).otherwise(1)
    ok = F.col("exception").isNull() & F.col("status").between(200, 399)
    gone = F.col("exception").isNull() & F.col("status").isin(*GONE)
    tried = attempts.withColumn("_end", ok | gone).withColumn("_order", order)
    # the first attempt that ends the probing, else the last one
    place = [F.min("ord").alias("ord")] if "ord" in attempts.columns else []
    last = tried.groupBy("url").agg(*place, F.min_by(F.struct("status", "exception", "_end"), F.when(F.col("_end"), F.col("_order")).otherwise(9 - F.col("_order"))).alias("a"), F.max_by("status", F.when(F.col("status").isNotNull(), F.col("_order"))).alias("any_status"))
    status, exception = F.col("a.status"), F.col("a.exception")
    verdict = F.when(F.col("a._end") & status.isin(*GONE), VERDICT_BROKEN).when(F.col("a._end"), VERDICT_OK).otherwise(VERDICT_UNKNOWN)
    detail = (
        F.when(exception.isNotNull(), F.substring(exception, 1, 120))
        .when(status.isin(*GONE), F.concat(F.lit("HTTP "), status.cast("string"), F.lit(LINK_GONE)))
        .when(status.isin(*UNVERIFIABLE), F.concat(F.lit("HTTP "), status.cast("string"), F.lit(LINK_BLOCKED)))
        .when(~F.col("a._end"), F.concat(F.lit("HTTP "), status.cast("string")))
    )
    return last.select(*(["ord"] if place else []), "url", F.when(exception.isNull(), status).otherwise(F.col("any_status")).alias("status"), verdict.alias("verdict"), detail.alias("detail"))


def link_summary(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("verdict").agg(F.count(F.lit(1)).alias("links"))


def exit_code(verdicts: DataFrame) -> int:
    """1 when a link is broken or there are none."""
    row = verdicts.agg(F.count(F.lit(1)), F.count_if(F.col("verdict") == VERDICT_BROKEN)).first()
    return int(row[0] == 0 or row[1] > 0)


def link_lines(verdicts: DataFrame) -> DataFrame:
    """(part, ord, text): what a reader is told: good links, unverified ones, broken ones, the counts and advice.

    ``verdicts`` may have an ``ord`` for the order of its links.
    """
    ord_ = F.col("ord") if "ord" in verdicts.columns else F.lit(0)
    part = F.when(F.col("verdict") == VERDICT_OK, 0).when(F.col("verdict") == VERDICT_UNKNOWN, 1).otherwise(2)
    why = F.concat(F.lit("\n            → "), F.coalesce("detail", F.lit("None")))
    shown = F.when(part == 1, F.col("verdict")).otherwise(F.rpad("verdict", 7, " "))  # a wide character takes two places
    told = F.concat(F.lit("  "), shown, F.lit(" "), F.col("url"), F.when(part > 0, why).otherwise(""))
    own = verdicts.select(part.alias("part"), ord_.cast("long").alias("ord"), told.alias("text"))
    n = {v: F.count_if(F.col("verdict") == v) for v in (VERDICT_OK, VERDICT_UNKNOWN, VERDICT_BROKEN)}
    counts = verdicts.agg(F.count(F.lit(1)).alias("all"), *[c.alias(f"n{k}") for k, c in enumerate(n.values())])
    total = F.concat(F.lit("\n링크 "), F.col("all").cast("string"), F.lit("개"), *[x for k, v in enumerate(n) for x in (F.lit(f" · {v} "), F.col(f"n{k}").cast("string"))])
    advice = F.concat(F.when(F.col("n1") > 0, F.lit("\n" + LINKS_UNVERIFIED)).otherwise(""), F.when(F.col("n2") > 0, F.lit("\n" + LINKS_BROKEN)).otherwise(""))
    return own.unionByName(counts.select(F.lit(3).alias("part"), F.lit(0).cast("long").alias("ord"), F.when(F.col("all") == 0, NO_LINKS).otherwise(F.concat(total, advice)).alias("text")))


def probe_links(urls: DataFrame, tasks: int = 10, timeout: int = 20) -> DataFrame:
    """Attempts (ord, url, method, status, exception) over the network, ``tasks`` at a time.

    ``urls`` may have an ``ord``: each address is probed once and keeps its smallest, so that results can be put in
    the order of their links.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import urllib.error
        import urllib.request

        for frame in frames:
            rows = []
            for place, url in zip(frame["ord"], frame["url"], strict=True):
                for method in ("HEAD", "GET"):
                    status, exception = None, None
                    try:
                        request = urllib.request.Request(url, method=method, headers={"User-Agent": USER_AGENT, "Accept": "*/*"})
                        with urllib.request.urlopen(request, timeout=timeout) as got:
                            status = got.status
                    except urllib.error.HTTPError as e:
                        status = e.code
                    except Exception as e:  # noqa: BLE001  any network failure is an outcome
                        exception = f"{type(e).__name__}: {e}"
                    rows.append((place, url, method, status, exception))
                    if status is not None and (status < 400 or status in GONE):
                        break
            yield pd.DataFrame(rows, columns=["ord", "url", "method", "status", "exception"]).astype({"status": "Int32"})

    ord_ = F.min("ord") if "ord" in urls.columns else F.lit(0)
    once = urls.groupBy("url").agg(ord_.cast("long").alias("ord")).select("ord", "url")
    return once.repartition(tasks, "url").mapInPandas(run, "ord long, url string, method string, status int, exception string")
