"""Connected components of an edge table by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import delete, fresh_path, join_large


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("size"))
    return join_large(both, least, ["u"], 2 * total).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("size"))
    moved = join_large(edges, least, ["u"], total).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).unionByName(moved).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; component is its smallest node.

    edges: columns u and v of one orderable type. Each round is written to the shared folder and the one before deleted, so that neither
    plans nor tables pile up; only two numbers come to the driver. Nodes with a large share of the edges are not dealt to one task. Loops and nulls are ignored.
    """
    spark = edges.sparkSession

    def written(rows: DataFrame) -> tuple[DataFrame, str]:
        path = fresh_path(spark, "edges")
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path), path

    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u is not null and v is not null and u <> v").distinct()
    (edges, path), before = written(edges), None
    total = edges.count()
    while True:
        # of each edge, large stars keep one direction at most: they are no more than the edges
        large, between = written(_large_star(edges, total))
        (edges, newer), older = written(_small_star(large, total)), path
        delete(spark, older)
        delete(spark, between)
        path = newer
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before, total = now, now[0]
