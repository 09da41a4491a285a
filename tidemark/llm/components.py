"""Connected components of links between keys, by alternating large and small stars, without the driver."""

from pyspark.sql import DataFrame, functions as F

from tidemark.session import written


def _least(edges: DataFrame) -> DataFrame:
    """``(u, v, m)``: m is the least of u and all its neighbours. Counted before the join, so a hot u is one row per task."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _least(down)
    out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(near.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node in ``edges(u, v)``, the root being the least node that links reach.

    Each round is written to the shared folder, so lineage stays short and lost executors cost one round.
    """
    edges = written(edges.where("u != v").distinct(), "links")
    before = None
    while True:
        edges = written(_small_star(_large_star(edges)), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = now
