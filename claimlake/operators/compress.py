"""Compression of claims: clusters within drawers, redundant pairs over all, a summary of both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialise
from .reports import by_drawer, cluster_topics, render_notes, render_theory
from .similarity import classes, greedy_cluster, similar_pairs


def compress(claims: DataFrame, negatives: DataFrame, threshold: float = 0.85) -> tuple[DataFrame, DataFrame]:
    """(theory, counts) of claims (id, condition, action, drawer) and negatives (id, ord, reason, drawer).

    theory has a text for each drawer and one, without a drawer, of pairs and negatives; counts a row for each drawer and one
    for all. Claims of a drawer with the same text are met as one: copies always share a cluster, and count once in pairs.
    Without claims both are empty. Claims are written before they are read several times: what they come from may be dear.
    """
    rows = materialise(claims.select("id", by_drawer(F.col("drawer")).alias("drawer"), F.concat_ws(" ", "condition", "action").alias("text")), "claims")
    own = materialise(classes(rows, by="drawer"), "classes")
    firsts = rows.join(own.where("id = rep").select("id"), "id", "left_semi")
    drawer_of = firsts.select("id", "drawer")
    pairs = similar_pairs(firsts, threshold)
    for side in ("a", "b"):
        pairs = pairs.join(drawer_of.select(F.col("id").alias(side), F.col("drawer").alias(f"{side}_drawer")), side)
    pairs = materialise(pairs, "pairs")
    roots = greedy_cluster(firsts, pairs.where("a_drawer = b_drawer"))
    clusters = materialise(rows.join(own, "id").join(roots.select(F.col("id").alias("rep"), "root"), "rep").select("id", "drawer", "text", "root"), "clusters")
    titled = clusters.join(cluster_topics(clusters, "root", "id", "text"), "root")
    notes = render_notes(pairs, negatives).join(F.broadcast(rows.limit(1).select(F.lit(1).alias("one"))), F.lit(True)).select(F.lit(None).cast("int").alias("drawer"), "text")
    theory = render_theory(titled, negatives).unionByName(notes)

    counts = clusters.rollup("drawer").agg(F.count(F.lit(1)).alias("claims"), F.count_if(F.col("id") == F.col("root")).alias("clusters"))
    redundant = pairs.where("a_drawer = b_drawer").groupBy(F.col("a_drawer").alias("d")).agg(F.count(F.lit(1)).alias("pairs"))
    redundant = redundant.unionByName(pairs.agg(F.count(F.lit(1)).alias("pairs")).select(F.lit(None).cast("int").alias("d"), "pairs"))
    counts = counts.join(redundant, F.col("drawer").eqNullSafe(F.col("d")), "left").drop("d")
    return theory, counts.withColumn("pairs", F.coalesce("pairs", F.lit(0).cast("long")))
