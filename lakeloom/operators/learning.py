"""Statistics, graphs and models: aggregates, iterated joins and Spark's own estimators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.session import checkpointed, listed, placed, tasks_for


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, r) for each pair of columns, in one aggregate."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    one = df.agg(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(a, b).alias("r")) for a, b in pairs]).alias("x"))
    return one.select(F.inline("x"))


def covariance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, cov) for each pair of columns and each with itself; sample covariance."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.covar_samp(a, b).alias("cov")) for a, b in pairs]).alias("x"))
    return one.select(F.inline("x"))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """(bin, n): equal bins between least and greatest value; NULLs are left out."""
    x = df.select(F.col(col).cast("double").alias("x")).where("x IS NOT NULL")
    told = x.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    at = F.least(F.lit(bins - 1), F.coalesce(F.floor(F.try_divide((F.col("x") - F.col("lo")) * bins, F.col("hi") - F.col("lo"))), F.lit(0)))
    return x.crossJoin(F.broadcast(told)).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def quantile_bins(df: DataFrame, col: str, bins: int) -> DataFrame:
    """One row of bin edges at equal shares (exact quantiles)."""
    return df.agg(F.percentile(col, F.array(*[F.lit(i / bins) for i in range(bins + 1)])).alias("edges"))


def t_test(df: DataFrame, col: str, group: str, a, b) -> DataFrame:
    """One row: Welch's t and its degrees of freedom for two groups."""
    f = lambda g, agg: agg(F.when(F.col(group) == g, F.col(col)))
    s = df.agg(*[f(g, agg).alias(f"{n}{i}") for i, g in ((1, a), (2, b)) for n, agg in (("n", F.count), ("m", F.avg), ("v", F.var_samp))])
    e1, e2 = F.col("v1") / F.col("n1"), F.col("v2") / F.col("n2")
    return s.select(
        ((F.col("m1") - F.col("m2")) / F.sqrt(e1 + e2)).alias("t"),
        ((e1 + e2) ** 2 / (e1**2 / (F.col("n1") - 1) + e2**2 / (F.col("n2") - 1))).alias("df"),
    )


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: the chi-square statistic of two columns' counts, with its degrees of freedom."""
    cells = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("n"))
    ra, rb = (cells.groupBy(k).agg(F.sum("n").alias(f"n{k}")) for k in ("a", "b"))
    total = cells.agg(F.sum("n").alias("t"), F.count_distinct("a").alias("ka"), F.count_distinct("b").alias("kb"))
    e = F.col("na") * F.col("nb") / F.col("t")
    # sum of (n - e)^2 / e over all cells, empty ones too, is the sum of n^2 / e less the total
    return cells.join(ra, "a").join(rb, "b").crossJoin(F.broadcast(total)).agg(
        (F.sum(F.col("n") ** 2 / e) - F.max("t")).alias("chi2"), F.max((F.col("ka") - 1) * (F.col("kb") - 1)).alias("df")
    )


def degrees(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, out_degree, in_degree)."""
    ends = F.explode(F.array(F.struct(F.col(src).alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col(dst).alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"))))
    return edges.select(ends.alias("e")).groupBy("e.node").agg(F.sum("e.o").alias("out_degree"), F.sum("e.i").alias("in_degree"))


def triangles(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, triangles) of an undirected graph.

    Edges point from the end of lower degree, so no node points to over sqrt(2 m) others.
    Degrees count repeated edges, as any order will do and m may be the rows: edges are then
    made distinct once, where they are put in lists. Each node sends every one it points to
    those of them that come after it; what the receiver points to as well closes a triangle.
    So a wedge is a number in an array instead of a row of its own. Degrees and lists of a
    task are few and hashed, so edges and what is sent are never sorted.
    """
    tasks = tasks_for(edges)
    pairs = edges.where(F.col(src) != F.col(dst)).select(F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b"))
    deg = placed(pairs.select(F.explode(F.array("a", "b")).alias("v")).groupBy("v").agg(F.count("*").alias("d")), tasks, "v")
    one = pairs.repartition(tasks, "a").join(deg.select(F.col("v").alias("a"), F.col("d").alias("da")).hint("shuffle_hash"), "a").repartition(tasks, "b")
    ranked = one.join(deg.select(F.col("v").alias("b"), F.col("d").alias("db")).hint("shuffle_hash"), "b")
    up = F.struct("da", "a") < F.struct("db", "b")
    low, high = F.struct(F.col("da").alias("d"), F.col("a").alias("v")), F.struct(F.col("db").alias("d"), F.col("b").alias("v"))
    e = ranked.select(F.when(up, F.col("a")).otherwise(F.col("b")).alias("u"), F.when(up, high).otherwise(low).alias("to")).repartition(tasks, "u").distinct()
    lists = placed(e.groupBy("u").agg(F.array_sort(F.collect_list("to")).getField("v").alias("to")), tasks, "u")
    sent = lists.select("u", F.posexplode("to").alias("i", "v"), "to").where(F.col("i") + 1 < F.size("to")).select("u", "v", F.slice("to", F.col("i") + 2, F.size("to")).alias("after"))
    met = sent.repartition(tasks, "v").join(lists.select(F.col("u").alias("v"), F.col("to").alias("own")).hint("shuffle_hash"), "v")
    third = met.select("u", "v", F.array_intersect("after", "own").alias("w")).withColumn("n", F.size("w").cast("long")).where("n > 0")
    each = F.concat(F.array(F.struct(F.col("u").alias("node"), "n"), F.struct(F.col("v").alias("node"), "n")), F.transform("w", lambda w: F.struct(w.alias("node"), F.lit(1).cast("long").alias("n"))))
    return third.select(F.inline(each)).groupBy("node").agg(F.sum("n").alias("triangles"))


def page_rank(edges: DataFrame, src: str, dst: str, rounds: int = 10, damping: float = 0.85) -> DataFrame:
    """(node, rank) after some rounds; ranks sum to 1, dangling mass is spread evenly.

    Each round is an aggregate and a join on the node, checkpointed so that the plan
    stays flat and a lost executor costs one round. Edges stay where their source is,
    many of them in a row.
    """
    tasks = tasks_for(edges)
    e = edges.select(F.col(src).alias("s"), F.col(dst).alias("d")).where("s IS NOT NULL AND d IS NOT NULL")
    e = listed(e, tasks, "s", "d")
    out = e.groupBy("s").agg(F.sum(F.size("d")).alias("deg"))
    nodes = e.select("s").distinct().union(e.select(F.explode("d"))).distinct().withColumnRenamed("s", "node")
    held = placed(nodes.join(out.withColumnRenamed("s", "node"), "node", "left"), tasks, "node")
    n = held.count()
    if not n:
        return held.select("node", F.lit(0.0).alias("rank"))
    ranks = held.select("node", "deg", F.lit(1.0 / n).alias("rank"))
    for _ in range(rounds):
        loose = ranks.agg(F.coalesce(F.sum(F.when(F.col("deg").isNull(), F.col("rank"))), F.lit(0.0)).alias("_loose"))
        sent = e.join(ranks.where("deg IS NOT NULL"), F.col("s") == F.col("node")).select(F.explode("d").alias("d"), (F.col("rank") / F.col("deg")).alias("part"))
        sent = sent.groupBy("d").agg(F.sum("part").alias("got"))
        ranks = placed(held.join(sent, F.col("node") == F.col("d"), "left").crossJoin(F.broadcast(loose)).select(  # one row
            "node", "deg", (F.lit((1 - damping) / n) + damping * (F.coalesce("got", F.lit(0.0)) + F.col("_loose") / n)).alias("rank")
        ), tasks, "node")
    return ranks.select("node", "rank")


def item_similarity(df: DataFrame, user: str, item: str, block: int = 500) -> DataFrame:
    """(a, b, jaccard) of items by shared users, for a recommender.

    Every user counts. A user's items are dealt to blocks of about `block` items, and
    each two blocks of a user meet under a key of their own, so that the pairs of a
    user with many items are made by many tasks; pairs are counted before the shuffle.
    Rows with a NULL user or item are left out of pairs.
    """
    p = df.select(F.col(user).alias("u"), F.col(item).alias("i")).distinct()
    n = p.groupBy("i").agg(F.count("*").alias("n"))
    size = p.where("u IS NOT NULL AND i IS NOT NULL").groupBy("u").agg(F.ceil(F.count("*") / block).cast("int").alias("k"))
    dealt = p.where("i IS NOT NULL").join(size, "u").withColumn("x", F.pmod(F.xxhash64("i"), F.col("k")).cast("int"))
    # a block meets each block, itself too; (lo, hi) names the meeting
    met = dealt.select("u", "i", "x", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("y"))
    met = met.select("u", "i", "x", F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi"))
    left, right = met.where("x = lo").select("u", "lo", "hi", F.col("i").alias("a")), met.where("x = hi").select("u", "lo", "hi", F.col("i").alias("b"))
    both = left.join(right, ["u", "lo", "hi"]).where((F.col("lo") < F.col("hi")) | (F.col("a") < F.col("b")))
    shared = both.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count("*").alias("c"))
    na, nb = n.select(F.col("i").alias("a"), F.col("n").alias("na")), n.select(F.col("i").alias("b"), F.col("n").alias("nb"))
    return shared.join(na, "a").join(nb, "b").select("a", "b", (F.col("c") / (F.col("na") + F.col("nb") - F.col("c"))).alias("jaccard"))


def assembled(df: DataFrame, cols: Sequence[str], name: str = "features") -> DataFrame:
    """df with a vector column of numeric columns."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(cols), outputCol=name, handleInvalid="skip").transform(df)


def in_parts(df: DataFrame) -> DataFrame:
    """df dealt to as many tasks as its rows ask for, for models that keep their rows in memory and read them again and again."""
    return df.repartition(tasks_for(df))


def kmeans(df: DataFrame, cols: Sequence[str], k: int, seed: int = 1) -> DataFrame:
    """df with cluster."""
    from pyspark.ml.clustering import KMeans

    held = assembled(df, cols)
    return KMeans(k=k, seed=seed, predictionCol="cluster").fit(held).transform(held).drop("features")


def linear_regression(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """df with prediction, by least squares."""
    from pyspark.ml.regression import LinearRegression

    held = assembled(df, cols)
    return LinearRegression(labelCol=label, solver="normal").fit(held).transform(held).drop("features")


def linear_predictions(train: DataFrame, test: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """test with prediction, by least squares over train."""
    from pyspark.ml.regression import LinearRegression

    return LinearRegression(labelCol=label, solver="normal").fit(assembled(train, cols)).transform(assembled(test, cols)).drop("features")


def linear_coefficients(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """(feature, coefficient) by least squares; the intercept is the feature `intercept`."""
    from pyspark.ml.regression import LinearRegression

    model = LinearRegression(labelCol=label, solver="normal").fit(assembled(df, cols))
    return df.sparkSession.createDataFrame([*((c, float(v)) for c, v in zip(cols, model.coefficients)), ("intercept", float(model.intercept))], "feature string, coefficient double")


def boosted_trees(df: DataFrame, cols: Sequence[str], label: str, rounds: int = 10, seed: int = 1, bins: int = 32) -> DataFrame:
    """df with prediction, by gradient-boosted trees; bins: split candidates of a column."""
    from pyspark.ml.regression import GBTRegressor

    held = assembled(df, cols)
    return GBTRegressor(labelCol=label, maxIter=rounds, seed=seed, maxBins=bins).fit(in_parts(held)).transform(held).drop("features")


def logistic_regression(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """df with prediction, by logistic regression."""
    from pyspark.ml.classification import LogisticRegression

    held = assembled(df, cols)
    return LogisticRegression(labelCol=label).fit(held).transform(held).drop("features", "rawPrediction", "probability")


def forest_classes(df: DataFrame, cols: Sequence[str], label: str, trees: int = 20, seed: int = 1, bins: int = 32) -> DataFrame:
    """df with prediction, by a forest of classification trees (of one tree: over all rows)."""
    from pyspark.ml.classification import RandomForestClassifier

    held = assembled(df, cols)
    return RandomForestClassifier(labelCol=label, numTrees=trees, seed=seed, maxBins=bins).fit(in_parts(held)).transform(held).drop("features", "rawPrediction", "probability")


def naive_bayes(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """df with prediction, by normal distributions of each column in each class."""
    from pyspark.ml.classification import NaiveBayes

    held = assembled(df, cols)
    return NaiveBayes(labelCol=label, modelType="gaussian").fit(held).transform(held).drop("features", "rawPrediction", "probability")


def linear_svm(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """df with prediction (0 or 1), by a linear support vector machine."""
    from pyspark.ml.classification import LinearSVC

    held = assembled(df, cols)
    return LinearSVC(labelCol=label).fit(held).transform(held).drop("features", "rawPrediction")


def importances(df: DataFrame, cols: Sequence[str], label: str, trees: int = 20, seed: int = 1, method: str = "forest") -> DataFrame:
    """(feature, importance), one row per column.

    method: forest or boosted (share of the splits' gains), or linear (size of the
    coefficient times the column's deviation).
    """
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor

    held = assembled(df, cols)
    if method == "linear":
        model = LinearRegression(labelCol=label, solver="normal").fit(held)
        spread = df.agg(*[F.stddev_samp(c) for c in cols]).first()
        values = [abs(b) * (s or 0.0) for b, s in zip(model.coefficients, spread)]
    else:
        made = {"forest": lambda: RandomForestRegressor(labelCol=label, numTrees=trees, seed=seed), "boosted": lambda: GBTRegressor(labelCol=label, maxIter=trees, seed=seed)}[method]()
        values = made.fit(held).featureImportances.toArray()
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(cols, values)], "feature string, importance double")


def select_features(df: DataFrame, cols: Sequence[str], label: str, keep: int, **how) -> DataFrame:
    """df without the columns of cols that are not among the `keep` most important; equal ones by name."""
    ranked = sorted(importances(df, cols, label, **how).collect(), key=lambda r: (-r["importance"], r["feature"]))  # a row per column
    best = {r["feature"] for r in ranked[:keep]}
    return df.drop(*[c for c in cols if c not in best])


def binned(df: DataFrame, col: str, edges: DataFrame, name: str = "bin") -> DataFrame:
    """df with the bin of col under edges (one row, an ascending array edges, as quantile_bins gives it).

    Bin i holds edges[i] < value <= edges[i + 1]; values at or under the second edge are
    in bin 0, those over the last but one in the last. NULL has no bin.
    """
    inner = F.slice("_edges", 2, F.greatest(F.size("_edges") - 2, F.lit(0)))
    at = F.when(F.col(col).isNotNull(), F.size(F.filter(inner, lambda e: e < F.col(col))))
    return df.crossJoin(F.broadcast(edges.select(F.col("edges").alias("_edges")))).withColumn(name, at).drop("_edges")


def tf_idf(df: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, word, tf, df, tf_idf) of words between blanks."""
    words = df.select(doc, F.explode(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda w: w != "")).alias("word"))
    tf = words.groupBy(doc, "word").agg(F.count("*").alias("tf"))
    dfs = tf.groupBy("word").agg(F.count("*").alias("df"))
    n = df.agg(F.count_distinct(doc).alias("_n"))
    return tf.join(dfs, "word").crossJoin(F.broadcast(n)).select(doc, "word", "tf", "df", (F.col("tf") * F.ln(F.col("_n") / F.col("df"))).alias("tf_idf"))


def connected_components(edges: DataFrame, src: str, dst: str, rounds: int = 100) -> DataFrame:
    """(node, component): the least node that each can reach, edges read both ways.

    Every round a node takes the least label of its neighbours and then its label's
    own label, so distances halve; each round is checkpointed. Raises if labels still
    move after so many rounds. Edges with a NULL end are left out.
    """
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    tasks = tasks_for(edges, 2)
    both = listed(e.union(e.select("b", "a")), tasks, "b", "a")
    ends = edges.select(F.explode(F.array(src, dst)).alias("node")).where("node IS NOT NULL").distinct()
    labels = placed(ends.select("node", F.col("node").alias("component")), tasks, "node")
    for _ in range(rounds):
        near = both.join(labels, F.col("b") == F.col("node")).select(F.explode("a").alias("a"), "component").groupBy("a").agg(F.min("component").alias("m"))
        met = labels.join(near, F.col("node") == F.col("a"), "left").select("node", "component", F.least("component", F.coalesce("m", "component")).alias("m"))
        up = met.select(F.col("node").alias("p"), F.col("m").alias("pm"))
        new = placed(met.join(up, F.col("m") == F.col("p")).select("node", F.least("m", "pm").alias("component"), (F.least("m", "pm") < F.col("component")).alias("moved")), tasks, "node")
        labels = new.select("node", "component")
        if not new.where("moved").limit(1).count():
            return labels
    raise RuntimeError(f"labels still move after {rounds} rounds")
