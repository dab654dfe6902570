"""Graphs and texts beyond the basic ones, and classifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import learning as L
from lakeloom.operators import networks as G
from lakeloom.operators import texts as X
from lakeloom.plans.registry import Registry
from lakeloom.session import table

_r = Registry()
QUERIES, ORACLES = _r.queries, _r.oracles

#: Suppliers and parts (under negative ids, as both count from 0) that share lines, both ways.
_B = """WITH e AS (SELECT DISTINCT l_suppkey AS s, -1 - l_partkey AS t FROM lineitem), u AS (SELECT s AS a, t AS b FROM e UNION ALL SELECT t, s FROM e)"""


def _edges(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("s"), (-1 - F.col("l_partkey")).alias("t"))


@_r.add(_B + """, l1 AS (SELECT DISTINCT b AS node FROM u WHERE a = 1), l2 AS (SELECT DISTINCT b AS node FROM u JOIN l1 ON a = node WHERE b <> 1),
l3 AS (SELECT DISTINCT b AS node FROM u JOIN l2 ON a = node WHERE b NOT IN (SELECT node FROM l1)), l4 AS (SELECT DISTINCT b AS node FROM u JOIN l3 ON a = node WHERE b <> 1 AND b NOT IN (SELECT node FROM l2)),
l5 AS (SELECT DISTINCT b AS node FROM u JOIN l4 ON a = node WHERE b NOT IN (SELECT node FROM l1) AND b NOT IN (SELECT node FROM l3))
SELECT 1 AS node, 0.0::DOUBLE AS distance UNION ALL SELECT node, 1.0 FROM l1 UNION ALL SELECT node, 2.0 FROM l2 UNION ALL SELECT node, 3.0 FROM l3 UNION ALL SELECT node, 4.0 FROM l4 UNION ALL SELECT node, 5.0 FROM l5""")
def graph_shortest_paths(spark, d):
    """Steps from the first supplier to every node of the graph of suppliers and parts (its SQL looks five steps far)."""
    e = _edges(spark, d)
    return G.shortest_paths(e.union(e.select("t", "s")), "s", "t", 1)


@_r.add()
def graph_k_core(spark, d):
    """What is left of the graph when nodes of fewer than 5 neighbours go, again and again."""
    return G.k_core(_edges(spark, d), "s", "t", 5)


@_r.add()
def graph_labels(spark, d):
    """Labels after three rounds of propagation."""
    return G.label_propagation(_edges(spark, d), "s", "t", 3)


@_r.add(_B + """, x AS (SELECT abs(a) % 3 AS la, abs(b) % 3 AS lb FROM u), m AS (SELECT count(*) AS m FROM u)
SELECT round(sum(i / m - (d / m) ** 2), 9) AS modularity FROM (SELECT la, count(*) AS d, count(*) FILTER (la = lb) AS i FROM x GROUP BY la), m""")
def graph_modularity(spark, d):
    """How well remainders modulo 3 part the graph."""
    e = _edges(spark, d)
    nodes = e.select("s").union(e.select("t")).distinct().select(F.col("s").alias("node"), (F.abs("s") % 3).alias("label"))
    return G.modularity(e, "s", "t", nodes).select(F.round("modularity", 9).alias("modularity"))


@_r.add("""
WITH e AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS t FROM lineitem), u AS (SELECT DISTINCT least(s, t) AS a, greatest(s, t) AS b FROM e WHERE s <> t),
n AS (SELECT node, count(*) AS d FROM (SELECT a AS node FROM u UNION ALL SELECT b FROM u) GROUP BY node),
x AS (SELECT p.a AS i, p.b AS j, q.b AS k FROM u p JOIN u q ON p.b = q.a JOIN u r ON r.a = p.a AND r.b = q.b),
t AS (SELECT node, count(*) AS c FROM (SELECT unnest([i, j, k]) AS node FROM x) GROUP BY node)
SELECT n.node, CASE WHEN d > 1 THEN coalesce(c, 0) / (d * (d - 1) / 2.0) ELSE 0.0 END AS density FROM n LEFT JOIN t ON t.node = n.node""")
def graph_node_density(spark, d):
    """How many of a node's neighbours are neighbours."""
    e = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("t"))
    return G.node_density(e, "s", "t")


@_r.add("SELECT DISTINCT x AS node, (SELECT -1 - max(l_partkey) FROM lineitem) AS component FROM (SELECT unnest([l_suppkey, -1 - l_partkey]) AS x FROM lineitem)")
def graph_largest_component(spark, d):
    """The component of most nodes (in these tables all suppliers and parts share lines)."""
    return G.largest_component(_edges(spark, d), "s", "t")


@_r.add(r"""
WITH w AS (SELECT item_id, regexp_extract_all(text, '[^\s]+') AS ws FROM benchmark), g AS (
  SELECT item_id, array_to_string(ws[i:i+2], ' ') AS gram FROM (SELECT item_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3))
SELECT item_id, gram, count(*) AS count FROM g GROUP BY item_id, gram""")
def text_ngrams(spark, d):
    """Runs of three words in texts."""
    return X.ngrams(table(spark, d, "benchmark"), "item_id", "text", 3)


@_r.add(r"""
WITH w AS (SELECT item_id, unnest(regexp_extract_all(text, '[^\s]+')) AS word FROM benchmark), tf AS (SELECT item_id, word, count(*) AS tf FROM w GROUP BY 1, 2),
df AS (SELECT word, count(*) AS df FROM tf GROUP BY word),
x AS (SELECT item_id, word, tf * ln((SELECT count(DISTINCT item_id) FROM benchmark) / df) AS tf_idf FROM tf JOIN df USING (word))
SELECT item_id, word, tf_idf, CAST(row_number() OVER (PARTITION BY item_id ORDER BY tf_idf DESC, word) AS INTEGER) AS rank FROM x QUALIFY rank <= 4""")
def text_keywords(spark, d):
    """The four words of each text that weigh most."""
    return X.keywords(table(spark, d, "benchmark"), "item_id", "text", 4)


@_r.add("""
SELECT c_custkey, levenshtein(c_name, c_mktsegment) AS edits, 1 - levenshtein(c_name, c_mktsegment) / greatest(length(c_name), length(c_mktsegment)) AS alike FROM customer""")
def text_differences(spark, d):
    """Edits between two columns, and their likeness."""
    a, b = F.col("c_name"), F.col("c_mktsegment")
    return table(spark, d, "customer").select("c_custkey", X.distance(a, b).cast("long").alias("edits"), X.similarity(a, b).alias("alike"))


@_r.add("SELECT p_partkey, CASE WHEN p_size > 40 THEN 2.0::DOUBLE WHEN p_size > 25 THEN 1.0 ELSE 0.0 END AS prediction FROM part")
def model_tree_classes(spark, d):
    """A tree tells three classes apart, row by row."""
    s = F.col("p_size")
    t = table(spark, d, "part").select("p_partkey", s.cast("double").alias("x"), F.when(s > 40, 2).when(s > 25, 1).otherwise(0).alias("y"))
    return L.forest_classes(t, ["x"], "y", trees=1, bins=64).select("p_partkey", "prediction")


@_r.add("""
WITH s AS (SELECT CAST(p_size > 25 AS INTEGER) AS y, count(*) AS n, avg(p_size) AS m, var_pop(p_size) AS v FROM part GROUP BY 1),
x AS (SELECT p_partkey, y, ln(n / (SELECT count(*) FROM part)) - 0.5 * ln(2 * pi() * v) - (p_size - m) ** 2 / (2 * v) AS l FROM part, s)
SELECT p_partkey, CAST(arg_max(y, l) AS DOUBLE) AS prediction FROM x GROUP BY p_partkey""")
def model_naive_bayes(spark, d):
    """The likelier of two normal classes, row by row."""
    t = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("x"), (F.col("p_size") > 25).cast("int").alias("y"))
    return L.naive_bayes(t, ["x"], "y").select("p_partkey", "prediction")
