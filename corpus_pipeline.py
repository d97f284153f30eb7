"""Corpus pipeline: quality, toxicity, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet in the
shared folder and rereads it as the next stage's ``docs``.  All but the last stage return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinflow.llm import near_dup, packing, quality, repeats, toxicity
from skeinflow.llm.common import new_path, remove, table
from skeinflow.llm.labelled import sample


def _unused(name: str, docs: DataFrame) -> str:
    """``name``, or one like it that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the model learns from labelled documents at hand.

    Without a usable label there is nothing to judge by: all documents stay.
    """
    model = quality.fit_from(sample(docs, table(spark, sf_dir, "labels"), "quality", quality.FIT_ROWS))
    if not model.rows:
        return docs
    score = _unused("_score", docs)
    return quality.scored(docs, model, score_col=score).filter(F.col(score) >= quality.THRESHOLD).select(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not called toxic; the model learns from the labels of all documents.

    Without a usable label there is nothing to judge by: all documents stay.
    """
    labelled = sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic", toxicity.FIT_ROWS)
    model = toxicity.fit_from(labelled)
    if not model.rows:
        return docs
    score = _unused("_score", docs)
    return toxicity.scored(docs, model, score_col=score).filter(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more.

    A document is an (id, text); of a group the one with the smallest id stays, one with an id before one with
    none.  Rows that repeat both id and text stay as one row; unlike texts of one id are documents of their own.
    Rows with a null id take part; those of them without words are nobody's duplicate, so each stays.
    """
    rows = repeats.keyed_rows(docs, "doc_id", "text")
    row, key, text = (rows[c] for c in rows.columns)
    doc_id = row.getField("doc_id")
    found = near_dup.near_duplicates(rows, near_dup.Rule(words=5, percent=80), id_col=rows.columns[1], text_col=rows.columns[2])
    found = found.groupBy(F.col("doc_id").alias("_found")).agg(F.first("component_id").alias("_group"), F.first("n_shingles").alias("_n"))
    ids = rows.groupBy(key.alias("_found")).agg(F.min(doc_id).alias("_id"))
    first = found.join(ids, "_found").groupBy("_group").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_found", "_n")).alias("_first"))
    kept = first.select(F.col("_first._found").alias("_found"), F.col("_first._n").alias("_n"))
    joined = rows.join(kept.hint("merge"), key == kept["_found"])
    alone = joined.filter(doc_id.isNull() & (F.col("_n") == 0))
    once = joined.filter(doc_id.isNotNull() | (F.col("_n") > 0)).dropDuplicates(["_found"])
    return once.unionByName(alone).select(*[row.getField(c).alias(c) for c in docs.columns])


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what a 200-byte string covers that occurs elsewhere; n_chars follows the text."""
    return repeats.remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens in as few sequences as can be; a null or empty text is one piece, the end id."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dup_stage),
    ("repeats", repeats_stage),
    ("packing", packing_stage),
]

#: SQL cannot express fitted models and tokenizers; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        result = stage(spark, docs, sf_dir)
        result.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if last:
            remove(spark, last)
        last = path
    return docs
