"""Evaluation metrics as aggregates; nothing but class counts or curve points leaves Spark."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.session import checkpointed


def confusion(df: DataFrame, true: str, pred: str) -> DataFrame:
    """(true, pred, n) of all pairs that occur."""
    return df.groupBy(F.col(true).alias("true"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))


def accuracy(df: DataFrame, true: str, pred: str, normalize: bool = True) -> DataFrame:
    """One row: the share (or count) of equal labels."""
    hit = F.count_if(F.col(true) == F.col(pred))
    return df.agg((F.try_divide(hit.cast("double"), F.count("*")) if normalize else hit).alias("accuracy"))


def by_class(df: DataFrame, true: str, pred: str, beta: float = 1.0) -> DataFrame:
    """(label, precision, recall, fbeta, support) per label; an undefined ratio is 0."""
    pairs = confusion(df, true, pred)
    sides = F.explode(F.array(
        F.struct(F.col("true").alias("label"), F.when(F.col("true") == F.col("pred"), F.col("n")).otherwise(0).alias("tp"), F.col("n").alias("support"), F.lit(0).cast("long").alias("named")),
        F.struct(F.col("pred").alias("label"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("support"), F.col("n").alias("named")),
    ))
    sums = pairs.select(sides.alias("s")).groupBy("s.label").agg(*[F.sum(f"s.{c}").alias(c) for c in ("tp", "support", "named")])
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("named")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    f = F.coalesce(F.try_divide((1 + beta**2) * p * r, beta**2 * p + r), F.lit(0.0))
    return sums.select("label", p.alias("precision"), r.alias("recall"), f.alias("fbeta"), "support", "tp", "named")


def averaged(df: DataFrame, true: str, pred: str, average: str = "macro", pos_label=1, beta: float = 1.0) -> DataFrame:
    """One row of precision, recall and fbeta: binary, micro, macro or weighted (by support)."""
    t = by_class(df, true, pred, beta)
    if average == "binary":
        return t.where(F.col("label") == pos_label).select("precision", "recall", "fbeta")
    if average == "micro":
        p = F.try_divide(F.sum("tp").cast("double"), F.sum("named"))
        return t.agg(p.alias("precision"), p.alias("recall"), p.alias("fbeta"))
    known = t.where("support > 0") if average == "weighted" else t
    w = (lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")) if average == "weighted" else F.avg
    return known.agg(*[w(c).alias(c) for c in ("precision", "recall", "fbeta")])


def curve(df: DataFrame, true: str, score: str, pos_label=1) -> DataFrame:
    """(threshold, p1, n1, tp, fp, p, n) at each distinct score, from the highest; p1 and n1 are those of the score.

    Counts are aggregated per score first; distinct scores are dealt to ranges of about
    equal numbers, whatever their distribution, and the running sums go over each range
    from where the higher ranges end, so no single task sees them all.
    """
    pos = F.col(true) == pos_label
    steps = df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(pos).alias("p1"), F.count_if(~F.coalesce(pos, F.lit(False))).alias("n1")
    )
    dealt = checkpointed(steps.repartitionByRange(F.desc("threshold")).withColumn("b", F.spark_partition_id()))
    sums = dealt.groupBy("b").agg(F.sum("p1").alias("bp"), F.sum("n1").alias("bn"))
    up = Window.orderBy("b")  # a row per range
    starts = sums.select(
        "b", (F.sum("bp").over(up) - F.col("bp")).alias("sp"), (F.sum("bn").over(up) - F.col("bn")).alias("sn"),
        F.sum("bp").over(Window.partitionBy()).alias("p"), F.sum("bn").over(Window.partitionBy()).alias("n"),
    )
    w = Window.partitionBy("b").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    return dealt.join(F.broadcast(starts), "b").select(
        "threshold", "p1", "n1", (F.sum("p1").over(w) + F.col("sp")).alias("tp"), (F.sum("n1").over(w) + F.col("sn")).alias("fp"), "p", "n"
    )


def roc_curve(df: DataFrame, true: str, score: str, pos_label=1) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score."""
    return curve(df, true, score, pos_label).select("threshold", F.try_divide(F.col("fp").cast("double"), F.col("n")).alias("fpr"), F.try_divide(F.col("tp").cast("double"), F.col("p")).alias("tpr"))


def roc_auc(df: DataFrame, true: str, score: str, pos_label=1) -> DataFrame:
    """One row: the area, from average ranks of tied scores (equal to the trapezoid rule)."""
    area = F.sum(F.col("n1").cast("double") * (F.col("tp") - F.col("p1") / 2.0))
    return curve(df, true, score, pos_label).agg(F.try_divide(area, F.max("p").cast("double") * F.max("n")).alias("auc"))


def precision_recall_curve(df: DataFrame, true: str, score: str, pos_label=1) -> DataFrame:
    """(threshold, precision, recall) per distinct score."""
    c = curve(df, true, score, pos_label)
    return c.select("threshold", (F.col("tp").cast("double") / (F.col("tp") + F.col("fp"))).alias("precision"), F.try_divide(F.col("tp").cast("double"), F.col("p")).alias("recall"))


def average_precision(df: DataFrame, true: str, score: str, pos_label=1) -> DataFrame:
    """One row: precision summed over the gains in recall."""
    gain = F.col("p1").cast("double") / F.col("p") * F.col("tp") / (F.col("tp") + F.col("fp"))
    return curve(df, true, score, pos_label).agg(F.sum(gain).alias("average_precision"))


def gain_chart(df: DataFrame, true: str, score: str, pos_label=1) -> DataFrame:
    """(threshold, depth, gain): share of rows at or above a score, and of positives among them."""
    c = curve(df, true, score, pos_label)
    return c.select("threshold", ((F.col("tp") + F.col("fp")).cast("double") / (F.col("p") + F.col("n"))).alias("depth"), F.try_divide(F.col("tp").cast("double"), F.col("p")).alias("gain"))


def lift_chart(df: DataFrame, true: str, score: str, pos_label=1) -> DataFrame:
    """(threshold, depth, lift): gain over depth."""
    return gain_chart(df, true, score, pos_label).select("threshold", "depth", (F.col("gain") / F.col("depth")).alias("lift"))


def auc(points: DataFrame, x: str, y: str) -> DataFrame:
    """One row: the trapezoid area under a curve of few points."""
    w = Window.orderBy(x, y)
    step = (F.col(x) - F.lag(x).over(w)) * (F.col(y) + F.lag(y).over(w)) / 2
    return points.select(step.alias("s")).agg(F.sum("s").alias("auc"))


def regression(df: DataFrame, true: str, pred: str) -> DataFrame:
    """One row of the regression figures."""
    y, p = F.col(true).cast("double"), F.col(pred).cast("double")
    told = df.agg(F.avg(y).alias("my"))
    e = y - p
    sums = df.crossJoin(F.broadcast(told)).agg(  # one row
        F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.avg(F.abs(F.try_divide(e, y))).alias("mape"),
        F.sum((y - F.col("my")) ** 2).alias("sst"), F.sum((p - F.col("my")) ** 2).alias("sse"), F.sum(e * e).alias("ssr"),
    )
    return sums.select(
        "mse", F.sqrt("mse").alias("rmse"), "mae", "mape", "sst", "sse", F.sqrt(F.try_divide(F.col("sse"), F.col("sst"))).alias("multi_corr"),
        (1 - F.try_divide(F.col("ssr"), F.col("sst"))).alias("r2"),
    )


def residual_histogram(df: DataFrame, true: str, pred: str, bins: int = 10) -> DataFrame:
    """(bin, n): residuals in equal bins between their least and greatest."""
    e = df.select((F.col(true) - F.col(pred)).cast("double").alias("e")).where("e IS NOT NULL")
    lo_hi = e.agg(F.min("e").alias("lo"), F.max("e").alias("hi"))
    at = F.least(F.lit(bins - 1), F.coalesce(F.floor(F.try_divide((F.col("e") - F.col("lo")) * bins, F.col("hi") - F.col("lo"))), F.lit(0)))
    return e.crossJoin(F.broadcast(lo_hi)).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def calinski_harabasz(df: DataFrame, label: str, cols: list[str]) -> DataFrame:
    """One row: variance between clusters over that within, (SSB / (k-1)) / (SSW / (n-k))."""
    per = df.groupBy(label).agg(F.count("*").alias("n"), *[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("m", F.avg), ("v", F.var_pop))])
    whole = df.agg(*[F.avg(c).alias(f"g_{c}") for c in cols])
    ssb = sum(((F.col(f"m_{c}") - F.col(f"g_{c}")) ** 2 for c in cols), F.lit(0.0)) * F.col("n")
    ssw = sum((F.col(f"v_{c}") for c in cols), F.lit(0.0)) * F.col("n")
    return per.crossJoin(F.broadcast(whole)).agg((F.sum(ssb) / (F.count("*") - 1) / (F.sum(ssw) / (F.sum("n") - F.count("*")))).alias("score"))


def k_fold(df: DataFrame, n: int, columns: list[str] | None = None, seed: int = 0, by: Column | None = None) -> DataFrame:
    """df with fold (0 to n-1) from a hash of columns, or from a whole number `by` of each row."""
    place = by if by is not None else F.xxhash64(F.lit(seed), *columns)
    return df.withColumn("fold", F.pmod(place, F.lit(n)).cast("int"))


def train_test(df: DataFrame, n: int, columns: list[str] | None = None, seed: int = 0, by: Column | None = None) -> list[tuple[DataFrame, DataFrame]]:
    """Of n folds, each as (the others, itself)."""
    held = k_fold(df, n, columns, seed, by)
    return [(held.where(F.col("fold") != i).drop("fold"), held.where(F.col("fold") == i).drop("fold")) for i in range(n)]


def cross_val_score(df: DataFrame, fit_predict, score, n: int = 5, columns: list[str] | None = None, seed: int = 0, by: Column | None = None) -> DataFrame:
    """(fold, score): fit_predict(train, test) gives test with predictions, of which score makes one row with a column score."""
    pairs = train_test(df, n, columns, seed, by)
    return reduce(DataFrame.unionByName, [score(fit_predict(a, b)).select(F.lit(i).alias("fold"), F.col("score").cast("double").alias("score")) for i, (a, b) in enumerate(pairs)])
