"""Tables written to the folder that all machines share, to end lineage between rounds."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Rows of a task and its file, where the number of rows is known beforehand.
FILE_ROWS = 20_000


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local session without it gets a folder of its own."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not at:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        at = f"file:///tmp/checkpoints/skeinflow-{uuid.uuid4().hex}"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(at)
    return at


_cleaned: set[str] = set()


def _own_dir(spark: SparkSession) -> str:
    """This application's folder; what is left in it goes when the application's Python ends."""
    at = f"{shared_dir(spark)}/skeinflow/{spark.sparkContext.applicationId}"
    if at not in _cleaned:
        _cleaned.add(at)
        atexit.register(_forget, spark)
    return at


def _forget(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is not None and spark.sparkContext._jsc.sc().isStopped() is False:
        purge(spark)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "zstd", rows: int | None = None) -> tuple[DataFrame, str]:
    """``df`` as Parquet in the shared folder, and its path: lineage ends there.

    ``rows``, where known, is a bound on the rows of what is joined or written; tasks and files follow from it.
    """
    path = new_path(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


class Tables:
    """Tables of one run of an operator: their row counts, taken while writing, and their removal."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def keep(self, df: DataFrame, name: str, codec: str = "zstd", rows: int | None = None) -> tuple[DataFrame, int]:
        """``df`` as a table, and its number of rows."""
        seen = Observation()
        made, path = written(df.observe(seen, F.count(F.lit(1)).alias("n")), name, codec, rows)
        self.paths.append(path)
        return made, seen.get["n"]

    def remove(self) -> None:
        remove(self.spark, *self.paths)
        self.paths = []


def remove(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def purge(spark: SparkSession) -> None:
    """Remove all tables this application wrote, results included: when nothing lazy is left to read."""
    remove(spark, _own_dir(spark))
