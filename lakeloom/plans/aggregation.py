"""Aggregates, windows and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import aggregates as A
from lakeloom.functions import windows as W
from lakeloom.operators import reshape as P
from lakeloom.plans.registry import Registry
from lakeloom.session import table

_r = Registry()
QUERIES, ORACLES = _r.queries, _r.oracles


@_r.add("""
SELECT l_returnflag, count(*) AS n, count(l_quantity) AS n_quantity, sum(l_quantity) AS total, min(l_quantity) AS least, max(l_shipdate) AS latest, avg(l_discount) AS mean,
       var_samp(l_quantity) AS var1, var_pop(l_quantity) AS var0, stddev_samp(l_quantity) AS std1, stddev_pop(l_quantity) AS std0, count(DISTINCT l_suppkey) AS suppliers,
       CAST(sum(DISTINCT l_linenumber) AS BIGINT) AS lines
FROM lineitem GROUP BY l_returnflag HAVING count(*) > 10""")
def group_basic(spark, d):
    """Counts, sums, extremes, spread, distinct values, with HAVING."""
    q = F.col("l_quantity")
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.count(q).alias("n_quantity"), A.total(q).alias("total"), F.min(q).alias("least"), F.max("l_shipdate").alias("latest"), F.avg("l_discount").alias("mean"),
        A.variance(q).alias("var1"), A.variance(q, 0).alias("var0"), A.deviation(q).alias("std1"), A.deviation(q, 0).alias("std0"), A.nunique("l_suppkey").alias("suppliers"),
        A.distinct_sum(F.col("l_linenumber")).cast("long").alias("lines"),
    ).where("n > 10")


@_r.add("""
SELECT event_type, median(value) AS med, quantile_cont(value, 0.25) AS q1, list_transform(quantile_cont(value, [0.1, 0.9]), lambda x: round(x, 9)) AS tails, round(skewness(value), 9) AS skew, round(kurtosis(value), 9) AS kurt,
       round(avg(value ** 3), 6) AS m3, round(avg(value ** 2) - avg(value) ** 2, 6) AS c2
FROM events GROUP BY event_type""")
def group_moments(spark, d):
    """Median, quantiles (in an array, whose values are compared exactly, to nine places), moments, corrected skewness and kurtosis."""
    v = F.col("value")
    return table(spark, d, "events").groupBy("event_type").agg(
        F.median(v).alias("med"), A.quantile(v, F.lit(0.25)).alias("q1"), F.transform(A.quantile(v, F.array(F.lit(0.1), F.lit(0.9))), lambda x: F.round(x, 9)).alias("tails"), F.round(A.skew(v), 9).alias("skew"),
        F.round(A.kurtosis(v), 9).alias("kurt"), F.round(A.moment(v, 3), 6).alias("m3"), F.round(A.moment(v, 2, central=True), 6).alias("c2"),
    )


@_r.add("SELECT event_type, median(value) AS med, true AS close FROM events GROUP BY event_type")
def group_quantile_sketch(spark, d):
    """A median, and whether its sketch of bounded size is within a hundredth of the ranks of it."""
    v = F.col("value")
    told = [A.quantile(v, F.lit(p)).alias(n) for p, n in ((0.49, "lo"), (0.5, "med"), (0.51, "hi"))]
    t = table(spark, d, "events").groupBy("event_type").agg(*told, A.quantile(v, F.lit(0.5), approximate=True).alias("sketch"))
    return t.select("event_type", "med", F.col("sketch").between(F.col("lo"), F.col("hi")).alias("close"))


@_r.add("""
SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names, string_agg(substr(n_name, 1, 1), '' ORDER BY n_nationkey) AS initials, count(*) FILTER (WHERE n_nationkey > 10) AS high,
       bool_or(n_nationkey > 20) AS some, bool_and(n_nationkey > 3) AS every, list_sort(list(n_nationkey)) AS keys, list_sort(list(DISTINCT length(n_name))) AS lengths
FROM nation GROUP BY n_regionkey""")
def group_collect(spark, d):
    """Joined strings, lists, sets, and boolean aggregates."""
    k, n = F.col("n_nationkey"), F.col("n_name")
    return table(spark, d, "nation").groupBy("n_regionkey").agg(
        A.joined(n, ",", order=n).alias("names"), A.total(F.substring(n, 1, 1), "string", order=k).alias("initials"), A.total(k > 10, "boolean").alias("high"), A.any_(k > 20).alias("some"),
        A.all_(k > 3).alias("every"), F.sort_array(A.to_list(k)).alias("keys"), F.sort_array(A.to_list(F.length(n).cast("long"), unique=True)).alias("lengths"),
    )


@_r.add("SELECT (sum(l_extendedprice) + 1) / max(l_quantity) AS x, count(DISTINCT (l_returnflag, l_linestatus)) AS pairs FROM lineitem")
def aggregate_expressions(spark, d):
    """Arithmetic over aggregates of the whole table, distinct tuples."""
    return table(spark, d, "lineitem").agg(((F.sum("l_extendedprice") + 1) / F.max("l_quantity")).alias("x"), A.nunique("l_returnflag", "l_linestatus").alias("pairs"))


@_r.add("SELECT l_returnflag AS f, l_linestatus AS s, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def group_cube(spark, d):
    """All grouping sets of two columns."""
    return table(spark, d, "lineitem").cube(F.col("l_returnflag").alias("f"), F.col("l_linestatus").alias("s")).agg(F.count("*").alias("n"))


@_r.add("SELECT o_orderstatus AS s, o_orderpriority AS p, sum(o_totalprice) AS t FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def group_rollup(spark, d):
    """Subtotals and a total."""
    return table(spark, d, "orders").rollup(F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p")).agg(F.sum("o_totalprice").alias("t"))


_O = "OVER (PARTITION BY user_id ORDER BY ts, event_id"


#: Rounded to five places; the mean is moved off the ties that rounding may break either way.
_RUN = {
    "c_sum": "sum(value) {o} ROWS UNBOUNDED PRECEDING)", "c_max": "max(value) {o} ROWS UNBOUNDED PRECEDING)", "c_min": "min(value) {o} ROWS UNBOUNDED PRECEDING)",
    "c_mean": "1e-7 + avg(value) {o} ROWS UNBOUNDED PRECEDING)", "c_std": "stddev_pop(value) {o} ROWS UNBOUNDED PRECEDING)",
    "c_median": "median(value) {o} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)", "near_sum": "sum(value) {o} ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)",
    "next_sum": "sum(value) {o} ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)", "past_sum": "sum(value) {o} ROWS BETWEEN 5 PRECEDING AND 2 PRECEDING)",
    "whole_sum": "sum(value) OVER (PARTITION BY user_id)",
}


@_r.add(f"""
SELECT event_id, count(value) {_O} ROWS UNBOUNDED PRECEDING) AS c_count, {", ".join(f"round({x.format(o=_O)}, 5) AS {n}" for n, x in _RUN.items())}
FROM events""")
def window_running(spark, d):
    """Running aggregates under every form of frame."""
    v, o = F.col("value"), ["ts", "event_id"]
    w = W.frame(["user_id"], o)
    made = {
        "c_sum": W.cumsum(v, w), "c_max": W.cummax(v, w), "c_min": W.cummin(v, w), "c_mean": W.cummean(v, w) + 1e-7, "c_std": W.cumstd(v, w),
        "c_median": W.cummedian(v, W.frame(["user_id"], o, preceding=4)), "near_sum": W.cumsum(v, W.frame(["user_id"], o, 2, 1)),
        "next_sum": W.cumsum(v, W.frame(["user_id"], o, following=2)), "past_sum": W.cumsum(v, W.frame(["user_id"], o, preceding=(5, 2))), "whole_sum": W.cumsum(v, W.frame(["user_id"])),
    }
    return table(spark, d, "events").select("event_id", W.cumcount(v, w).alias("c_count"), *[F.round(c, 5).alias(n) for n, c in made.items()])


@_r.add(f"""
SELECT event_id, rank() OVER (PARTITION BY user_id ORDER BY event_type) AS r, dense_rank() OVER (PARTITION BY user_id ORDER BY event_type) AS dr,
       percent_rank() OVER (PARTITION BY user_id ORDER BY event_type) AS pr, cume_dist() OVER (PARTITION BY user_id ORDER BY event_type) AS cd, row_number() {_O}) AS rn,
       ntile(4) {_O}) - 1 AS bin, lag(value, 2, -1.0) {_O}) AS before, lead(value, 1) {_O}) AS after, nth_value(value, 3) {_O} ROWS UNBOUNDED PRECEDING) AS third
FROM events""")
def window_ranking(spark, d):
    """Ranks, bins, neighbours and the nth value."""
    o, e = W.frame(["user_id"], ["ts", "event_id"]), W.Window.partitionBy("user_id").orderBy("event_type")
    rows = W.Window.partitionBy("user_id").orderBy("ts", "event_id")
    v = F.col("value")
    return table(spark, d, "events").select(
        "event_id", W.rank(e).alias("r"), W.dense_rank(e).alias("dr"), W.percent_rank(e).alias("pr"), W.cume_dist(e).alias("cd"), W.row_number(rows).alias("rn"), W.qcut(4, rows).alias("bin"),
        W.lag(v, 2, rows, -1.0).alias("before"), W.lead(v, 1, rows).alias("after"), W.nth_value(v, 2, o).alias("third"),
    )


@_r.add("""
WITH u AS (SELECT user_id, count(DISTINCT event_type) AS kinds, median(value) AS med FROM events GROUP BY user_id)
SELECT event_id, kinds, med FROM events JOIN u USING (user_id)""")
def window_distinct(spark, d):
    """Distinct count and median of a partition on every row."""
    w = W.frame(["user_id"])
    return table(spark, d, "events").select("event_id", W.cumcount(F.col("event_type"), w, unique=True).alias("kinds"), F.median("value").over(w).alias("med"))


@_r.add("""
SELECT o_orderpriority, sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS F, sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS O, sum(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS P
FROM orders GROUP BY o_orderpriority""")
def pivot_cells(spark, d):
    """One value per cell, a column per status."""
    cells = table(spark, d, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.sum("o_totalprice").alias("t"))
    return P.pivot(cells, ["o_orderpriority"], "o_orderstatus", ["t"])


@_r.add("""
SELECT l_returnflag, coalesce(avg(l_quantity) FILTER (WHERE l_linestatus = 'F'), 0.0) AS F_l_quantity_mean, coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 0.0) AS F_l_quantity_sum,
       coalesce(avg(l_quantity) FILTER (WHERE l_linestatus = 'O'), 0.0) AS O_l_quantity_mean, coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'O'), 0.0) AS O_l_quantity_sum
FROM lineitem GROUP BY l_returnflag""")
def pivot_table_filled(spark, d):
    """Aggregates per cell, empty cells filled."""
    return P.pivot_table(table(spark, d, "lineitem"), ["l_quantity"], ["l_returnflag"], "l_linestatus", ["mean", "sum"], fill=0.0)


@_r.add("SELECT l_returnflag, avg(l_quantity) AS l_quantity_mean, max(l_tax) AS l_tax_max FROM lineitem GROUP BY l_returnflag")
def pivot_table_plain(spark, d):
    """Aggregates without a column dimension."""
    return P.pivot_table(table(spark, d, "lineitem"), ["l_quantity", "l_tax"], ["l_returnflag"], funcs={"l_quantity": ["mean"], "l_tax": ["max"]})


@_r.add("""
SELECT l_orderkey, l_linenumber, 'l_quantity' AS variable, l_quantity AS value FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem""")
def melt_columns(spark, d):
    """Wide to long."""
    return P.melt(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax"), ["l_orderkey", "l_linenumber"])


@_r.add("SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS kv_a, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS DOUBLE) ELSE 0.0 END AS kv_b FROM customer")
def extract_key_values(spark, d):
    """`key:value` text to columns."""
    even = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit(",b:"), F.col("c_custkey").cast("string"))).otherwise("")
    t = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("a:"), F.col("c_nationkey").cast("string"), even).alias("kv"))
    return P.extract_kv(t, ["kv"], fill=0.0)


@_r.add("SELECT c_custkey, 'c_nationkey:' || c_nationkey || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ',seg:' || c_mktsegment END AS kv FROM customer")
def to_key_values(spark, d):
    """Columns to `key:value` text, NULLs left out."""
    t = table(spark, d, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("seg"))
    return P.to_kv(t, ["c_nationkey", "seg"], name="kv")


_GAPS = """WITH t AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS a, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 END AS b, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal + 2 END AS c FROM customer) """


def _gaps(spark, d):
    k, x = F.col("c_custkey"), F.col("c_acctbal")
    return table(spark, d, "customer").select(k.alias("k"), F.when(k % 2 == 0, x).alias("a"), F.when(k % 3 == 0, x + 1).alias("b"), F.when(k % 5 != 0, x + 2).alias("c"))


@_r.add(_GAPS + "SELECT * FROM t WHERE (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT >= 2")
def drop_missing(spark, d):
    """Rows with at least two values."""
    return P.dropna(_gaps(spark, d), thresh=2, subset=["a", "b", "c"])


@_r.add(_GAPS + "SELECT k, coalesce(a, 0.0) AS a, coalesce(b, 0.0) AS b, c FROM t")
def fill_missing(spark, d):
    """Missing values of some columns replaced."""
    return P.fillna(_gaps(spark, d), 0.0, ["a", "b"])


@_r.add(_GAPS + "SELECT k, a, coalesce(b, a) AS b, coalesce(c, b, a) AS c FROM t")
def fill_forward(spark, d):
    """From the left within the row."""
    return P.ffill(_gaps(spark, d), ["a", "b", "c"])


@_r.add(_GAPS + "SELECT k, coalesce(a, b, c) AS a, coalesce(b, c) AS b, c FROM t")
def fill_backward(spark, d):
    """From the right within the row."""
    return P.bfill(_gaps(spark, d), ["a", "b", "c"])


@_r.add("""
SELECT c_custkey, c_acctbal, round((c_acctbal - min(c_acctbal) OVER ()) / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()) * 2 - 1, 9) AS c_acctbal_scaled FROM customer""")
def scale_min_max(spark, d):
    """A column moved to -1 .. 1, beside the old one."""
    out = P.min_max_scale(table(spark, d, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"], (-1, 1), preserve=True)
    return out.withColumn("c_acctbal_scaled", F.round("c_acctbal_scaled", 9))


@_r.add("""
SELECT c_custkey, c_mktsegment, round((c_acctbal - avg(c_acctbal) OVER w) / stddev_pop(c_acctbal) OVER w, 8) AS c_acctbal FROM customer WINDOW w AS (PARTITION BY c_mktsegment)""")
def scale_standard(spark, d):
    """Mean 0 and deviation 1 within groups."""
    out = P.std_scale(table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), ["c_acctbal"], group=["c_mktsegment"])
    return out.withColumn("c_acctbal", F.round("c_acctbal", 8))


@_r.add("SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS append_id, o_orderkey FROM orders")
def append_ids(spark, d):
    """Dense ids in an order."""
    return P.append_id(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"]).drop("o_totalprice")


@_r.add("""
SELECT n_name, s_name FROM (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) AS i FROM nation) FULL JOIN (SELECT s_name, row_number() OVER (ORDER BY s_suppkey) AS i FROM supplier) USING (i)""")
def concat_side_by_side(spark, d):
    """Two tables by place."""
    n, s = table(spark, d, "nation").select("n_nationkey", "n_name"), table(spark, d, "supplier").select("s_suppkey", "s_name")
    return P.concat_columns(n, ["n_nationkey"], s, ["s_suppkey"]).select("n_name", "s_name")


@_r.add("SELECT s_suppkey, upper(s_name) AS s_name FROM supplier")
def apply_to_columns(spark, d):
    """A function over columns."""
    return P.applymap(table(spark, d, "supplier").select("s_suppkey", "s_name"), F.upper, ["s_name"])
