"""From articles to candidate events: address groups, title similarity, components.

Similar titles are found by prefix filtering.  A pair counts only if the smaller token set shares at
least ``least_shared`` tokens, so it must meet the larger one in some of its rarest tokens: those alone are
joined, and very common words never are unless a title has nothing rarer.  Equal token sets are one
title class, so a hot group of copies costs one row.  Articles with their addresses, address groups, classes and
token frequencies are tables: each is made once and read by all that need it.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, urls
from ..functions.terms import MIN_CONTAINED, MIN_JACCARD, MIN_SHARED
from ..plans.storage import remove, written
from .components import connected_components

#: Share of the smaller set that any similar pair has in common: the lesser of the two conditions.
SHARE = min(MIN_CONTAINED, 2 * MIN_JACCARD / (1 + MIN_JACCARD))

#: Rare tokens that two titles must share before their sets are compared; few pairs do by chance.
MET = 3


def url_groups(articles: DataFrame) -> DataFrame:
    """One row per canonical address: gid (first arrival), title of the first arrival, members in order."""
    keyed = articles.withColumn("url", urls.canonical(F.col("link")))
    return keyed.groupBy("url").agg(F.min("seq").alias("gid"), F.min_by("title", "seq").alias("title"), F.count(F.lit(1)).alias("members"))


def least_shared(size: Column) -> Column:
    return F.greatest(F.lit(MIN_SHARED), F.ceil(F.lit(SHARE) * size - 1e-9)).cast("int")


def title_classes(groups: DataFrame, *, compatibility: bool = True) -> DataFrame:
    """(gid, tokens, class_id): class_id is the smallest gid of the same token set; tokens sorted."""
    own = groups.select("gid", F.array_sort(text.title_tokens(F.col("title"), compatibility=compatibility)).alias("tokens"))
    firsts = own.groupBy("tokens").agg(F.min("gid").alias("class_id"))
    return own.join(firsts, "tokens").select("gid", "tokens", "class_id")


def _sets(classes: DataFrame) -> DataFrame:
    """One row per class: class_id, tokens and their number."""
    return classes.filter(F.col("gid") == F.col("class_id")).select("class_id", "tokens", F.size("tokens").alias("n"))


def token_frequency(classes: DataFrame) -> DataFrame:
    """In how many title classes each token occurs."""
    return _sets(classes).select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def candidate_pairs(sets: DataFrame, frequency: DataFrame) -> DataFrame:
    """Pairs (a < b) of title classes that share ``MET`` of the rarest tokens of the smaller set, as any similar pair must.

    A set of n tokens lacks at most n - least of them in a similar one, so of any n - least + k tokens that one has k.
    """
    placed = sets.select("class_id", "n", F.explode("tokens").alias("token")).join(frequency, "token")
    ordered = placed.groupBy("class_id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("rare"))
    least = least_shared(F.col("n"))
    need = F.least(least, F.lit(MET)).alias("need")
    # a token of one class meets no other
    rare = ordered.select("class_id", "n", need, F.explode(F.slice("rare", F.lit(1), F.col("n") - least + need)).alias("r")).filter("r.df > 1")
    rare = rare.select(F.col("class_id").alias("x"), F.col("n").alias("xn"), "need", F.col("r.token").alias("token"))
    every = sets.select(F.col("class_id").alias("y"), F.col("n").alias("yn"), F.explode("tokens").alias("token"))
    met = rare.join(every, "token").filter((F.col("xn") < F.col("yn")) | ((F.col("xn") == F.col("yn")) & (F.col("x") < F.col("y"))))
    enough = met.groupBy("x", "y", "need").agg(F.count(F.lit(1)).alias("met")).filter("met >= need")
    return enough.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def shared_tokens(classes: DataFrame) -> DataFrame:
    """Pairs of title classes (a < b) that share at least what any similar pair must: overlap, sizes."""
    spark = classes.sparkSession
    sets, sets_at = written(_sets(classes), "sets")
    frequency, frequency_at = written(sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df")), "frequency")
    sets = sets.filter(F.col("n") >= MIN_SHARED)
    pairs = candidate_pairs(sets, frequency)
    left = sets.select(F.col("class_id").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("class_id").alias("b"), F.col("tokens").alias("tb"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", F.size("ta").alias("size_a"), F.size("tb").alias("size_b"), F.size(F.array_intersect("ta", "tb")).alias("overlap"))
    found, _ = written(full.filter(F.col("overlap") >= least_shared(F.least("size_a", "size_b"))), "shared")
    remove(spark, sets_at, frequency_at)
    return found


def similar(overlap: Column, a: Column, b: Column) -> Column:
    """Whether titles of a and b tokens, ``overlap`` shared, tell of one event."""
    return (overlap >= MIN_SHARED) & ((overlap / F.least(a, b) >= MIN_CONTAINED) | (overlap / (a + b - overlap) >= MIN_JACCARD))


def similar_titles(classes: DataFrame) -> DataFrame:
    return shared_tokens(classes).filter(similar(F.col("overlap"), F.col("size_a"), F.col("size_b")))


def event_components(classes: DataFrame) -> DataFrame:
    """(gid, component): groups whose titles are linked by a chain of similar ones; smallest gid."""
    classes, path = written(classes, "classes")
    nodes = classes.select("gid", "class_id", F.size("tokens").alias("n"))
    members = nodes.filter((F.col("n") >= MIN_SHARED) & (F.col("gid") != F.col("class_id"))).select(F.col("gid").alias("a"), F.col("class_id").alias("b"))
    edges = similar_titles(classes).select("a", "b").unionByName(members)
    found = connected_components(nodes.select("gid"), edges, "gid")
    remove(classes.sparkSession, path)
    return found


def clustered(articles: DataFrame, *, compatibility: bool = True) -> DataFrame:
    """Articles with url, gid and component (the candidate event), as a table."""
    spark = articles.sparkSession
    keyed, keyed_at = written(articles.withColumn("url", urls.canonical(F.col("link"))), "keyed")
    groups, path = written(keyed.groupBy("url").agg(F.min("seq").alias("gid"), F.min_by("title", "seq").alias("title")), "groups")
    found = event_components(title_classes(groups, compatibility=compatibility))
    result, _ = written(keyed.join(groups.select("url", "gid"), "url").join(found, "gid"), "clustered")
    remove(spark, keyed_at, path)
    return result


__all__ = ["clustered", "event_components", "least_shared", "shared_tokens", "similar", "similar_titles", "title_classes", "token_frequency", "url_groups"]
