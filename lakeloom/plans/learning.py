"""Metrics, statistics, graphs and models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from lakeloom.operators import learning as L
from lakeloom.operators import metrics as M
from lakeloom.plans.registry import Registry
from lakeloom.session import table

_r = Registry()
QUERIES, ORACLES = _r.queries, _r.oracles

_S = """WITH s AS (SELECT o_orderkey, CASE WHEN o_totalprice > 150000 THEN 1 ELSE 0 END AS y, CASE WHEN o_orderkey % 7 < 3 THEN 1 ELSE 0 END AS p,
  (o_orderkey * 37 % 101) / 101.0 + CASE WHEN o_totalprice > 150000 THEN 0.2 ELSE 0.0 END AS score, o_totalprice AS t, o_totalprice * 0.9 + 1000 AS e FROM orders) """


def _scored(spark, d):
    k, t = F.col("o_orderkey"), F.col("o_totalprice")
    y = F.when(t > 150000, 1).otherwise(0)
    return table(spark, d, "orders").select(
        k, y.alias("y"), F.when(k % 7 < 3, 1).otherwise(0).alias("p"), (k * 37 % 101 / 101.0 + F.when(t > 150000, 0.2).otherwise(0.0)).alias("score"), t.alias("t"), (t * 0.9 + 1000).alias("e")
    )


@_r.add(_S + "SELECT y AS true, p AS pred, count(*) AS n FROM s GROUP BY y, p")
def metric_confusion(spark, d):
    """Counts of label pairs."""
    return M.confusion(_scored(spark, d), "y", "p")


@_r.add(_S + "SELECT avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) AS accuracy FROM s")
def metric_accuracy(spark, d):
    """Share of equal labels."""
    return M.accuracy(_scored(spark, d), "y", "p")


@_r.add(_S + """, c AS (SELECT l AS label, sum((y = l AND p = l)::INT) AS tp, sum((y = l)::INT) AS support, sum((p = l)::INT) AS named FROM s, (SELECT unnest([0, 1]) AS l) GROUP BY l)
SELECT CAST(label AS INTEGER) AS label, tp / named AS precision, tp / support AS recall, 5 * (tp / named) * (tp / support) / (4 * (tp / named) + tp / support) AS fbeta, CAST(support AS BIGINT) AS support FROM c""")
def metric_by_class(spark, d):
    """Precision, recall and F2 per class."""
    return M.by_class(_scored(spark, d), "y", "p", 2.0).select("label", "precision", "recall", "fbeta", "support")


@_r.add(_S + """, c AS (SELECT l, sum((y = l AND p = l)::INT) AS tp, sum((y = l)::INT) AS support, sum((p = l)::INT) AS named FROM s, (SELECT unnest([0, 1]) AS l) GROUP BY l),
m AS (SELECT support, tp / named AS p, tp / support AS r, 2 * (tp / named) * (tp / support) / (tp / named + tp / support) AS f FROM c)
SELECT sum(p * support) / sum(support) AS precision, sum(r * support) / sum(support) AS recall, sum(f * support) / sum(support) AS fbeta FROM m""")
def metric_weighted(spark, d):
    """Averages weighted by support."""
    return M.averaged(_scored(spark, d), "y", "p", "weighted")


@_r.add(_S + """, g AS (SELECT score AS threshold, sum(y) AS p1, sum(1 - y) AS n1 FROM s GROUP BY score)
SELECT round(threshold, 9) AS threshold, sum(n1) OVER w / sum(n1) OVER () AS fpr, sum(p1) OVER w / sum(p1) OVER () AS tpr FROM g WINDOW w AS (ORDER BY threshold DESC)""")
def metric_roc(spark, d):
    """Points of the ROC curve."""
    return M.roc_curve(_scored(spark, d), "y", "score").withColumn("threshold", F.round("threshold", 9))


@_r.add(_S + """, r AS (SELECT y, (rank() OVER (ORDER BY score) + rank() OVER (ORDER BY score) + count(*) OVER (PARTITION BY score) - 1) / 2.0 AS k FROM s)
SELECT (sum(k) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)) AS auc FROM r""")
def metric_auc(spark, d):
    """Area under the ROC curve."""
    return M.roc_auc(_scored(spark, d), "y", "score")


@_r.add(_S + """, g AS (SELECT score AS threshold, sum(y) AS p1, count(*) AS m FROM s GROUP BY score)
SELECT round(threshold, 9) AS threshold, sum(p1) OVER w / sum(m) OVER w AS precision, sum(p1) OVER w / sum(p1) OVER () AS recall FROM g WINDOW w AS (ORDER BY threshold DESC)""")
def metric_precision_recall(spark, d):
    """Points of the precision-recall curve."""
    return M.precision_recall_curve(_scored(spark, d), "y", "score").withColumn("threshold", F.round("threshold", 9))


@_r.add(_S + """, g AS (SELECT score, sum(y) AS p1, count(*) AS m FROM s GROUP BY score),
c AS (SELECT p1, sum(p1) OVER w AS tp, sum(m) OVER w AS k, sum(p1) OVER () AS p FROM g WINDOW w AS (ORDER BY score DESC))
SELECT sum(p1 / p * tp / k) AS average_precision FROM c""")
def metric_average_precision(spark, d):
    """Average precision."""
    return M.average_precision(_scored(spark, d), "y", "score")


@_r.add(_S + """, g AS (SELECT score, sum(y) AS p1, count(*) AS m FROM s GROUP BY score),
c AS (SELECT score, sum(p1) OVER w / sum(p1) OVER () AS gain, sum(m) OVER w / sum(m) OVER () AS depth FROM g WINDOW w AS (ORDER BY score DESC))
SELECT round(score, 9) AS threshold, depth, gain / depth AS lift FROM c""")
def metric_lift(spark, d):
    """Points of the lift chart."""
    return M.lift_chart(_scored(spark, d), "y", "score").withColumn("threshold", F.round("threshold", 9))


@_r.add(_S + """SELECT avg((t - e) ** 2) AS mse, sqrt(avg((t - e) ** 2)) AS rmse, avg(abs(t - e)) AS mae, avg(abs((t - e) / t)) AS mape, sum((t - m) ** 2) AS sst, sum((e - m) ** 2) AS sse,
sqrt(sum((e - m) ** 2) / sum((t - m) ** 2)) AS multi_corr, 1 - sum((t - e) ** 2) / sum((t - m) ** 2) AS r2 FROM s, (SELECT avg(t) AS m FROM s)""")
def metric_regression(spark, d):
    """Regression errors."""
    return M.regression(_scored(spark, d), "t", "e")


@_r.add(_S + """, h AS (SELECT t - e AS x FROM s), b AS (SELECT min(x) AS lo, max(x) AS hi FROM h)
SELECT CAST(least(9, floor((x - lo) * 10 / (hi - lo))) AS INTEGER) AS bin, count(*) AS n FROM h, b GROUP BY 1""")
def metric_residuals(spark, d):
    """Histogram of residuals."""
    return M.residual_histogram(_scored(spark, d), "t", "e")


@_r.add("""
SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, corr(l_quantity, l_extendedprice) AS r FROM lineitem UNION ALL SELECT 'l_quantity', 'l_discount', corr(l_quantity, l_discount) FROM lineitem
UNION ALL SELECT 'l_extendedprice', 'l_discount', corr(l_extendedprice, l_discount) FROM lineitem""")
def stat_correlation(spark, d):
    """Pearson correlations of all pairs."""
    out = L.correlation(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return out


@_r.add("SELECT 'l_quantity' AS a, 'l_quantity' AS b, covar_samp(l_quantity, l_quantity) AS cov FROM lineitem UNION ALL SELECT 'l_quantity', 'l_tax', covar_samp(l_quantity, l_tax) FROM lineitem UNION ALL SELECT 'l_tax', 'l_tax', covar_samp(l_tax, l_tax) FROM lineitem")
def stat_covariance(spark, d):
    """Covariances of all pairs."""
    return L.covariance(table(spark, d, "lineitem"), ["l_quantity", "l_tax"])


@_r.add("""
WITH b AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)
SELECT CAST(least(7, floor((c_acctbal - lo) * 8 / (hi - lo))) AS INTEGER) AS bin, count(*) AS n FROM customer, b GROUP BY 1""")
def stat_histogram(spark, d):
    """Equal bins."""
    return L.histogram(table(spark, d, "customer"), "c_acctbal", 8)


@_r.add("SELECT quantile_cont(c_acctbal, [0.0, 0.25, 0.5, 0.75, 1.0]) AS edges FROM customer")
def stat_quantile_bins(spark, d):
    """Edges of bins of equal counts."""
    return L.quantile_bins(table(spark, d, "customer"), "c_acctbal", 4)


@_r.add("""
WITH s AS (SELECT o_orderstatus AS g, count(*) AS n, avg(o_totalprice) AS m, var_samp(o_totalprice) AS v FROM orders GROUP BY 1)
SELECT (a.m - b.m) / sqrt(a.v / a.n + b.v / b.n) AS t, (a.v / a.n + b.v / b.n) ** 2 / ((a.v / a.n) ** 2 / (a.n - 1) + (b.v / b.n) ** 2 / (b.n - 1)) AS df FROM s a, s b WHERE a.g = 'F' AND b.g = 'O'""")
def stat_t_test(spark, d):
    """Welch's test of two groups."""
    return L.t_test(table(spark, d, "orders"), "o_totalprice", "o_orderstatus", "F", "O")


@_r.add("""
WITH c AS (SELECT o_orderstatus AS a, o_orderpriority AS b, count(*) AS n FROM orders GROUP BY 1, 2), x AS (SELECT a, sum(n) AS na FROM c GROUP BY a), y AS (SELECT b, sum(n) AS nb FROM c GROUP BY b),
t AS (SELECT sum(n) AS t FROM c), g AS (SELECT x.a, y.b, na * nb / t AS e, coalesce(n, 0) AS n FROM x CROSS JOIN y CROSS JOIN t LEFT JOIN c ON c.a = x.a AND c.b = y.b)
SELECT sum((n - e) ** 2 / e) AS chi2, CAST((count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS BIGINT) AS df FROM g""")
def stat_chi_square(spark, d):
    """Independence of two columns."""
    return L.chi_square(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority").select(F.round("chi2", 6).alias("chi2"), "df")


ORACLES["stat_chi_square"] = ORACLES["stat_chi_square"].replace("SELECT sum((n - e) ** 2 / e) AS chi2", "SELECT round(sum((n - e) ** 2 / e), 6) AS chi2")

_G = "WITH e AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS t FROM lineitem) "


def _edges(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("t"))


@_r.add(_G + "SELECT node, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree FROM (SELECT s AS node, 1 AS o, 0 AS i FROM e UNION ALL SELECT t, 0, 1 FROM e) GROUP BY node")
def graph_degrees(spark, d):
    """Degrees of nodes."""
    return L.degrees(_edges(spark, d).distinct(), "s", "t")


@_r.add(_G + """, u AS (SELECT DISTINCT least(s, t) AS a, greatest(s, t) AS b FROM e WHERE s <> t),
x AS (SELECT p.a AS i, p.b AS j, q.b AS k FROM u p JOIN u q ON p.b = q.a JOIN u r ON r.a = p.a AND r.b = q.b)
SELECT node, count(*) AS triangles FROM (SELECT unnest([i, j, k]) AS node FROM x) GROUP BY node""")
def graph_triangles(spark, d):
    """Triangles through each node."""
    return L.triangles(_edges(spark, d), "s", "t")


@_r.add()
def graph_components(spark, d):
    """Connected components of suppliers and parts (negative ids) that share lines."""
    return L.connected_components(_edges(spark, d).withColumn("t", -1 - F.col("t")), "s", "t")


@_r.add()
def graph_page_rank(spark, d):
    """Ranks after ten rounds."""
    return L.page_rank(_edges(spark, d), "s", "t")


# Three of them under the names that once told them from graphs of a part of the lines.
for _f in (graph_degrees, graph_triangles, graph_components):
    QUERIES[f"{_f.__name__}_whole"] = _f
    if _f.__name__ in ORACLES:
        ORACLES[f"{_f.__name__}_whole"] = ORACLES[_f.__name__]


@_r.add("""
WITH p AS (SELECT DISTINCT user_id AS u, event_type AS i FROM events), n AS (SELECT i, count(*) AS n FROM p GROUP BY i),
s AS (SELECT x.i AS a, y.i AS b, count(*) AS c FROM p x JOIN p y ON x.u = y.u AND x.i < y.i GROUP BY 1, 2)
SELECT a, b, c / (na.n + nb.n - c) AS jaccard FROM s JOIN n na ON na.i = a JOIN n nb ON nb.i = b""")
def recommend_items(spark, d):
    """Item similarity by shared users."""
    return L.item_similarity(table(spark, d, "events"), "user_id", "event_type")


@_r.add(r"""
WITH w AS (SELECT item_id, unnest(regexp_extract_all(text, '[^\s]+')) AS word FROM benchmark), tf AS (SELECT item_id, word, count(*) AS tf FROM w GROUP BY 1, 2),
df AS (SELECT word, count(*) AS df FROM tf GROUP BY word)
SELECT item_id, word, tf, df, tf * ln((SELECT count(DISTINCT item_id) FROM benchmark) / df) AS tf_idf FROM tf JOIN df USING (word)""")
def text_tf_idf(spark, d):
    """Weights of words in texts."""
    return L.tf_idf(table(spark, d, "benchmark"), "item_id", "text")


@_r.add()
def model_kmeans(spark, d):
    """Clusters of customers, with the variance ratio of their clustering."""
    t = table(spark, d, "customer").select("c_custkey", F.col("c_acctbal"), F.col("c_nationkey").cast("double").alias("n"))
    return M.calinski_harabasz(L.kmeans(t, ["c_acctbal", "n"], 4), "cluster", ["c_acctbal", "n"])


@_r.add("""
SELECT unnest(['l_quantity', 'intercept']) AS feature, unnest([round(regr_slope(l_extendedprice, l_quantity), 4), round(regr_intercept(l_extendedprice, l_quantity), 3)]) AS coefficient FROM lineitem""")
def model_linear(spark, d):
    """Least squares of a price on a quantity."""
    got = L.linear_coefficients(table(spark, d, "lineitem"), ["l_quantity"], "l_extendedprice")
    return got.select("feature", F.when(F.col("feature") == "intercept", F.round("coefficient", 3)).otherwise(F.round("coefficient", 4)).alias("coefficient"))


@_r.add()
def model_importances(spark, d):
    """What a forest finds important in a price."""
    t = table(spark, d, "part").select(F.col("p_size").cast("double").alias("size"), (F.col("p_partkey") % 100).cast("double").alias("key"), "p_retailprice")
    return L.importances(t, ["size", "key"], "p_retailprice", trees=5)


@_r.add("SELECT p_partkey, CASE WHEN p_size > 25 THEN 1.0::DOUBLE ELSE 0.0 END AS prediction FROM part")
def model_logistic(spark, d):
    """A separable label is learned, row by row."""
    t = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("x"), (F.col("p_size") > 25).cast("int").alias("y"))
    return L.logistic_regression(t, ["x"], "y").select("p_partkey", "prediction")


@_r.add("SELECT p_partkey, CASE WHEN p_size > 25 THEN 10.0::DOUBLE ELSE 0.0 END AS prediction FROM part")
def model_boosted(spark, d):
    """Boosted trees follow a step, row by row."""
    t = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("x"), F.when(F.col("p_size") > 25, 10.0).otherwise(0.0).alias("y"))
    return L.boosted_trees(t, ["x"], "y", rounds=3, bins=64).select("p_partkey", F.round("prediction", 6).alias("prediction"))


@_r.add("SELECT o_orderkey, CAST(1 AS BIGINT) AS tested, CAST(4 AS BIGINT) AS learned FROM orders")
def model_folds(spark, d):
    """Of five folds every row is tested in one and learned from in the others."""
    pairs = M.train_test(table(spark, d, "orders").select("o_orderkey"), 5, ["o_orderkey"])
    each = [df.select("o_orderkey", F.lit(t).alias("t")) for a, b in pairs for df, t in ((b, 1), (a, 0))]
    return reduce(lambda x, y: x.union(y), each).groupBy("o_orderkey").agg(F.sum("t").cast("long").alias("tested"), F.count_if(F.col("t") == 0).alias("learned"))


@_r.add("""
WITH t AS (SELECT CAST(l_orderkey % 3 AS INTEGER) AS f, l_quantity AS x, l_extendedprice AS y FROM lineitem), k AS (SELECT unnest([0, 1, 2]) AS fold),
m AS (SELECT fold, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM k, t WHERE f <> fold GROUP BY fold)
SELECT CAST(fold AS INTEGER) AS fold, round(sqrt(avg((y - a * x - b) ** 2)), 3) AS score FROM m, t WHERE f = fold GROUP BY fold""")
def model_cross_validated(spark, d):
    """Root mean squared error of a line on each of three folds, learned from the others."""
    t = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    fit = lambda a, b: L.linear_predictions(a, b, ["l_quantity"], "l_extendedprice")
    rmse = lambda p: M.regression(p, "l_extendedprice", "prediction").select(F.round("rmse", 3).alias("score"))
    return M.cross_val_score(t, fit, rmse, 3, by=F.col("l_orderkey"))


@_r.add("SELECT p_partkey, p_size, p_retailprice FROM part")
def model_select_features(spark, d):
    """Of a telling column and one of noise the telling one stays."""
    t = table(spark, d, "part").select("p_partkey", "p_size", (F.col("p_partkey") * 7919 % 13).alias("noise"), "p_retailprice")
    return L.select_features(t.withColumn("y", F.col("p_size") * 3.0), ["p_size", "noise"], "y", 1, method="linear").drop("y")


@_r.add("""
WITH e AS (SELECT quantile_cont(c_acctbal, [0.25, 0.5, 0.75]) AS q FROM customer)
SELECT c_custkey, CAST((c_acctbal > q[1])::INT + (c_acctbal > q[2])::INT + (c_acctbal > q[3])::INT AS INTEGER) AS bin FROM customer, e""")
def stat_binned(spark, d):
    """Values placed in bins of equal counts."""
    t = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return L.binned(t, "c_acctbal", L.quantile_bins(t, "c_acctbal", 4)).select("c_custkey", "bin")


@_r.add(_S + """, g AS (SELECT score AS threshold, sum(y) AS p1, count(*) AS m FROM s GROUP BY score),
c AS (SELECT threshold, sum(p1) OVER w / sum(p1) OVER () AS gain, sum(m) OVER w / sum(m) OVER () AS depth FROM g WINDOW w AS (ORDER BY threshold DESC))
SELECT round(threshold, 9) AS threshold, depth, gain FROM c""")
def metric_gain(spark, d):
    """Points of the gain chart."""
    return M.gain_chart(_scored(spark, d), "y", "score").withColumn("threshold", F.round("threshold", 9))


@_r.add(_S + """, c AS (SELECT l, sum((y = l AND p = l)::INT) AS tp, sum((p = l)::INT) AS named, sum((y = l)::INT) AS support FROM s, (SELECT unnest([0, 1]) AS l) GROUP BY l)
SELECT avg(tp / named) AS precision, avg(tp / support) AS recall, avg(2 * (tp / named) * (tp / support) / (tp / named + tp / support)) AS fbeta FROM c""")
def metric_macro(spark, d):
    """Plain averages over classes."""
    return M.averaged(_scored(spark, d), "y", "p", "macro")


@_r.add(_S + """SELECT sum((y = 1 AND p = 1)::INT) / sum(p) AS precision, sum((y = 1 AND p = 1)::INT) / sum(y) AS recall,
2 * sum((y = 1 AND p = 1)::INT) / (sum(p) + sum(y)) AS fbeta FROM s""")
def metric_binary(spark, d):
    """One class's figures."""
    return M.averaged(_scored(spark, d), "y", "p", "binary")


@_r.add("""
WITH m AS (SELECT CAST(month(o_orderdate) AS DOUBLE) AS x, avg(o_totalprice) AS y FROM orders GROUP BY 1)
SELECT round(sum((x - px) * (y + py) / 2), 4) AS auc FROM (SELECT x, y, lag(x) OVER w AS px, lag(y) OVER w AS py FROM m WINDOW w AS (ORDER BY x))""")
def metric_trapezoid(spark, d):
    """Area under the mean price of months."""
    points = table(spark, d, "orders").groupBy(F.month("o_orderdate").cast("double").alias("x")).agg(F.avg("o_totalprice").alias("y"))
    return M.auc(points, "x", "y").select(F.round("auc", 4).alias("auc"))
