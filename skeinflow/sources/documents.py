"""Whole text documents, with a word on those that are missing or empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(report_id, path, text, state) of each named document: state is ok, missing or empty.

    report_id is the name without folder and ending.  Any store that Spark reads will do.
    """

    def there(path: str) -> bool:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        store = at.getFileSystem(spark._jsc.hadoopConfiguration())
        return store.exists(at) and store.getFileStatus(at).isFile()

    listed = spark.createDataFrame([(k, p) for k, p in enumerate(paths)], "ord long, path string")
    known = spark.createDataFrame([], "name string, text string, ord long")
    found = [(k, p) for k, p in enumerate(paths) if there(p)]
    if found:
        read = spark.read.text([p for _, p in found], wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
        # a scheme or authority may be added to what was asked for
        asked = F.broadcast(spark.createDataFrame(found, "ord long, asked string"))
        bare = F.regexp_replace("asked", r"^[a-z0-9+.-]+:/+", "/")
        plain = F.regexp_replace(F.try_url_decode("file"), r"^[a-z0-9+.-]+:/+", "/")
        known = read.join(asked, plain.endswith(bare)).select(F.col("asked").alias("name"), "text", "ord")
    exists = F.col("ord").isin([k for k, _ in found]) if found else F.lit(False)
    state = F.when(~exists, "missing").when(F.coalesce(F.length("text"), F.lit(0)) == 0, "empty").otherwise("ok")
    name = F.regexp_replace(F.regexp_extract("path", r"([^/]+)$", 1), r"\.[^.]*$", "")
    return listed.join(known.drop("name"), "ord", "left").select(name.alias("report_id"), "path", "text", state.alias("state"))
