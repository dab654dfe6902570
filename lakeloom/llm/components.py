"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import drop_path, new_path


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on rows (a, b).

    The least neighbour of each node is a map-side combined minimum, joined back to
    the edges, so a hub is never gathered in one task.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    step = both.join(least, "a")
    if large:
        out = step.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        own = least.select("a", F.col("m").alias("b"))
        out = step.select(F.col("b").alias("a"), F.col("m").alias("b")).union(own)
    return out.where("a > b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge table (a, b); component is the least node.

    Self-loops and rows with a null end are ignored, repeated rows count once. No
    edges: no rows. Each round is a written table, so a lost executor costs one
    round; nothing of the graph comes to the driver but one count and one checksum
    per round. Raises if the stars have not settled after max_rounds.
    """
    spark = edges.sparkSession
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def write(df: DataFrame) -> tuple[DataFrame, str, tuple]:
        path = new_path(spark, "stars")
        df.write.parquet(path)
        back = spark.read.schema(df.schema).parquet(path)
        sums = back.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return back, path, tuple(sums)

    e, path, mark = write(e)
    if not mark[0]:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(max_rounds):
        nxt, new, now = write(_star(_star(e, True), False))
        drop_path(spark, path)
        e, path = nxt, new
        if now == mark:
            own = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(own)
        mark = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
