"""Graphs beyond components and ranks: paths, cores, labels, modularity, density.

Edge tables have two node columns; NULL ends are left out. Iterated functions
checkpoint each round, so plans stay flat and a lost executor costs one round, and
only a count of what moved comes to the driver. Edges and nodes are dealt to tasks by
node once, as many as their number asks for, and stay there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.learning import connected_components, triangles
from lakeloom.session import checkpointed, placed, tasks_for


def _both_ways(edges: DataFrame, src: str, dst: str, tasks: int | None = None) -> DataFrame:
    """(a, b) for each edge in both directions, once, without loops; dealt to tasks by a, if a number is given."""
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = e.union(e.select("b", "a"))
    return (both.repartition(tasks, "a") if tasks else both).distinct()


def shortest_paths(edges: DataFrame, src: str, dst: str, source, weight: str | None = None, rounds: int = 1000) -> DataFrame:
    """(node, distance) of nodes that can be reached from source along edges; weights (1 without) are not negative.

    Each round only nodes whose distance fell send it on. Raises if distances still
    fall after so many rounds.
    """
    cost = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    n = tasks_for(edges)
    rows = edges.select(F.col(src).alias("a"), F.col(dst).alias("b"), cost.alias("w")).where("a IS NOT NULL AND b IS NOT NULL")
    e = placed(rows.repartition(n, "a").groupBy("a", "b").agg(F.min("w").alias("w")), n, "a")
    known = placed(e.sparkSession.range(1).select(F.lit(source).cast(dict(e.dtypes)["a"]).alias("node"), F.lit(0.0).alias("distance"), F.lit(True).alias("moved")), n, "node")
    for _ in range(rounds):
        sent = e.join(known.where("moved"), F.col("a") == F.col("node")).groupBy("b").agg(F.min(F.col("distance") + F.col("w")).alias("d"))
        met = known.select("node", "distance").join(sent, F.col("node") == F.col("b"), "full")
        near = F.least(F.coalesce("distance", F.lit(float("inf"))), F.coalesce("d", F.lit(float("inf"))))
        known = placed(met.select(F.coalesce("node", "b").alias("node"), near.alias("distance"), (F.col("distance").isNull() | (F.col("d") < F.col("distance"))).alias("moved")).na.fill(False, ["moved"]), n, "node")
        if not known.where("moved").limit(1).count():
            return known.select("node", "distance")
    raise RuntimeError(f"distances still fall after {rounds} rounds")


def k_core(edges: DataFrame, src: str, dst: str, k: int) -> DataFrame:
    """(a, b) with a < b: the edges left when nodes of fewer than k neighbours are taken away until none is left."""
    tasks = tasks_for(edges, 2)
    e = placed(_both_ways(edges, src, dst, tasks), tasks, "a")
    n = e.count()
    while n:
        kept = e.groupBy("a").agg(F.count("*").alias("d")).where(F.col("d") >= k).select("a")
        # every edge is there both ways, so that the other end is looked at after turning it round
        half = e.join(kept, "a", "left_semi").select(F.col("b").alias("a"), F.col("a").alias("b"))
        e = placed(half.join(kept, "a", "left_semi").select("a", "b"), tasks, "a")
        left = e.count()
        if left == n:
            break
        n = left
    return e.where("a < b")


def label_propagation(edges: DataFrame, src: str, dst: str, rounds: int = 10) -> DataFrame:
    """(node, label) after some rounds in which every node takes the label most frequent among its neighbours and itself, the least of equals."""
    tasks = tasks_for(edges, 2)
    both = placed(_both_ways(edges, src, dst, tasks), tasks, "a")
    labels = placed(both.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct(), tasks, "node")
    for _ in range(rounds):
        # a node's label goes to its neighbours, and all votes for a node meet in one place
        votes = both.join(labels, F.col("a") == F.col("node")).select(F.col("b").alias("node"), "label").union(labels)
        counts = votes.repartition(tasks, "node").groupBy("node", "label").agg(F.count("*").alias("n"))
        best = counts.groupBy("node").agg(F.min(F.struct(-F.col("n"), F.col("label"))).alias("best"))
        labels = placed(best.select("node", F.col("best.label").alias("label")), tasks, "node")
    return labels


def modularity(edges: DataFrame, src: str, dst: str, labels: DataFrame) -> DataFrame:
    """One row: the modularity of a labelling (node, label) of an undirected graph.

    The share of edges inside labels, less what their degrees let expect. Edges of
    nodes without a label are inside none.
    """
    tasks = tasks_for(edges, 2)
    both = _both_ways(edges, src, dst, tasks)
    x, y = (labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in "ab")
    met = both.join(x, "a", "left").repartition(tasks, "b").join(y, "b", "left")
    by = met.groupBy("la").agg(F.count("*").cast("double").alias("d"), F.count_if(F.col("la") == F.col("lb")).alias("i"))
    m = F.sum("d")
    expected = F.sum(F.when(F.col("la").isNotNull(), F.pow("d", F.lit(2))).otherwise(0.0))
    return by.agg((F.sum("i") / m - expected / m / m).alias("modularity"))


def node_density(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, density): the share of pairs of a node's neighbours that are neighbours; 0 under two neighbours."""
    degree = _both_ways(edges, src, dst, tasks_for(edges, 2)).groupBy(F.col("a").alias("node")).agg(F.count("*").alias("d"))
    found = triangles(edges, src, dst)
    pairs = F.col("d") * (F.col("d") - 1) / 2.0
    return degree.join(found, "node", "left").select("node", F.when(F.col("d") > 1, F.coalesce("triangles", F.lit(0)) / pairs).otherwise(0.0).alias("density"))


def largest_component(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, component) of the component of most nodes, the least of equals."""
    held = checkpointed(connected_components(edges, src, dst))
    best = held.groupBy("component").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "component").limit(1)
    return held.join(F.broadcast(best.select("component")), "component").select("node", "component")  # one row
