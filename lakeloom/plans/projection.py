"""Projection, filters, conditions and arithmetic over the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import elements as E
from lakeloom.operators import relational as R
from lakeloom.plans.registry import Registry
from lakeloom.session import table

_r = Registry()
QUERIES, ORACLES = _r.queries, _r.oracles


@_r.add("SELECT o_orderkey AS key, o_totalprice * 2 AS twice, upper(o_orderstatus) AS status FROM orders")
def project_expressions(spark, d):
    """Columns, expressions and renames."""
    return R.project(table(spark, d, "orders"), F.col("o_orderkey").alias("key"), twice=F.col("o_totalprice") * 2, status=F.upper("o_orderstatus"))


@_r.add("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def project_exclude(spark, d):
    """All columns but one."""
    return R.exclude(table(spark, d, "supplier"), "s_acctbal")


@_r.add("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal, c_acctbal < 0 AS owing FROM customer")
def assign_where(spark, d):
    """A column set only where a condition holds."""
    df = table(spark, d, "customer").select("c_custkey", "c_acctbal").withColumn("owing", F.col("c_acctbal") < 0)
    return R.assign(df, "c_acctbal", 0.0, F.col("c_acctbal") < 0)


@_r.add("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_discount BETWEEN 0.05 AND 0.07 AND l_returnflag <> 'N'")
def filter_all(spark, d):
    """Rows for which several predicates hold."""
    df = table(spark, d, "lineitem")
    kept = R.where_all(df, F.col("l_quantity") > 45, E.between(F.col("l_discount"), 0.05, 0.07), F.col("l_returnflag") != "N")
    return kept.select("l_orderkey", "l_linenumber", "l_quantity")


@_r.add("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000 AND o_orderstatus IN ('F', 'O')")
def filter_query_text(spark, d):
    """A condition as SQL text with a parameter."""
    return R.query(table(spark, d, "orders"), "o_totalprice > :least AND o_orderstatus IN ('F', 'O')", least=200000).select("o_orderkey", "o_totalprice")


@_r.add("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE (l_returnflag = 'A' AND l_linestatus = 'F') OR l_returnflag = 'R'")
def filter_partitions(spark, d):
    """Partition text: comma is and, slash is or; the columns go."""
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    return R.where_parts(df, "l_returnflag=A,l_linestatus=F/l_returnflag=R")


@_r.add("""
SELECT unnest(['count','mean','std','min','quantile_25','quantile_50','quantile_75','max']) AS type,
       unnest([count(c_acctbal), avg(c_acctbal), stddev_samp(c_acctbal), min(c_acctbal), quantile_cont(c_acctbal, 0.25),
               quantile_cont(c_acctbal, 0.5), quantile_cont(c_acctbal, 0.75), max(c_acctbal)]) AS c_acctbal
FROM customer""")
def describe_numeric(spark, d):
    """Figures of a numeric column."""
    return R.describe(table(spark, d, "customer").select("c_acctbal"))


@_r.add("""
SELECT o_orderkey, o_totalprice - (SELECT avg(o_totalprice) FROM orders) AS above FROM orders
WHERE o_totalprice > 1.5 * (SELECT avg(o_totalprice) FROM orders)""")
def filter_by_total(spark, d):
    """A whole-table mean inside a filter and a projection."""
    df = R.with_totals(table(spark, d, "orders"), m=F.avg("o_totalprice"))
    return df.where(F.col("o_totalprice") > 1.5 * F.col("m")).select("o_orderkey", (F.col("o_totalprice") - F.col("m")).alias("above"))


@_r.add("SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS whole, CAST(o_orderkey AS VARCHAR) AS text, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders")
def cast_types(spark, d):
    """Casts; one to a whole number cuts toward zero, halves too."""
    df = table(spark, d, "orders")
    return df.select("o_orderkey", F.col("o_totalprice").cast("long").alias("whole"), F.col("o_orderkey").cast("string").alias("text"), F.col("o_orderdate").cast("date").cast("string").alias("day"))


@_r.add("""
WITH t AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'nan'::DOUBLE ELSE c_acctbal END AS x FROM customer)
SELECT c_custkey, x IS NULL AS is_null, x IS NOT NULL AS not_null, x IS NULL OR coalesce(isnan(x), false) AS is_na,
       NOT (x IS NULL OR coalesce(isnan(x), false)) AS not_na, CASE WHEN x IS NULL OR isnan(x) THEN -1.0 ELSE x END AS filled FROM t""")
def element_missing(spark, d):
    """NULL and NaN tests and replacement."""
    k, x = F.col("c_custkey"), F.col("x")
    t = table(spark, d, "customer").select("c_custkey", F.when(k % 5 == 0, None).when(k % 7 == 0, float("nan")).otherwise(F.col("c_acctbal")).alias("x"))
    return t.select("c_custkey", x.isNull().alias("is_null"), x.isNotNull().alias("not_null"), E.is_na(x).alias("is_na"), E.not_na(x).alias("not_na"), E.fill_na(x, F.lit(-1.0)).alias("filled"))


@_r.add("""
SELECT p_partkey, p_size IN (1, 5, 9) AS among, p_size NOT IN (1, 5, 9) AS not_among, p_size BETWEEN 10 AND 20 AS within, p_size > 10 AND p_size < 20 AS strictly,
       CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS kind,
       CASE WHEN p_size < 10 THEN 'a' WHEN p_size < 30 THEN 'b' ELSE 'c' END AS searched,
       CASE p_size WHEN 1 THEN 'one' WHEN 2 THEN 'two' ELSE 'many' END AS simple,
       CAST(CASE WHEN p_size > 0 AND p_size <= 10 THEN 0 WHEN p_size > 10 AND p_size <= 25 THEN 1 WHEN p_size > 25 AND p_size <= 40 THEN 2 END AS INTEGER) AS bin,
       CASE WHEN p_size < 10 THEN 'u' WHEN p_size >= 10 AND p_size < 20 THEN 'x' WHEN p_size >= 20 AND p_size < 30 THEN 'y' WHEN p_size >= 30 THEN 'o' END AS label
FROM part""")
def element_conditions(spark, d):
    """Membership, ranges, conditions and bins."""
    s = F.col("p_size")
    return table(spark, d, "part").select(
        "p_partkey", E.is_in(s, [1, 5, 9]).alias("among"), E.not_in(s, [1, 5, 9]).alias("not_among"), E.between(s, 10, 20).alias("within"),
        E.between(s, 10, 20, inclusive=False).alias("strictly"), E.if_else(s > 25, "big", "small").alias("kind"),
        E.switch((s < 10, "a"), (s < 30, "b"), default="c").alias("searched"), E.switch((1, "one"), (2, "two"), value=s, default="many").alias("simple"),
        E.cut(s, [0, 10, 25, 40]).alias("bin"), E.cut(s, [10, 20, 30], right=False, labels=["u", "x", "y", "o"], include_under=True, include_over=True).alias("label"),
    )


@_r.add("""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey - 1000 AS a, l_linenumber - 3 AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, a + b AS added, a - b AS less, a * b AS times, a / CAST(nullif(b, 0) AS DOUBLE) AS divided,
       CAST(floor(a / CAST(nullif(b, 0) AS DOUBLE)) AS BIGINT) AS floored, CAST(((a % nullif(b, 0)) + b) % nullif(b, 0) AS BIGINT) AS remainder,
       -a AS negated, abs(a) AS absolute, ~a AS inverted, a > b AS greater, a = b AS same, a <> b AS other, (a > 0) AND (b > 0) AS both, (a > 0) OR (b > 0) AS either
FROM t""")
def arithmetic_integers(spark, d):
    """Whole numbers with Python's division and remainder."""
    a, b = F.col("a"), F.col("b")
    t = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") - 1000).alias("a"), (F.col("l_linenumber") - 3).cast("long").alias("b"))
    return t.select(
        "l_orderkey", "l_linenumber", (a + b).alias("added"), (a - b).alias("less"), (a * b).alias("times"), E.true_divide(a, b).alias("divided"),
        E.floor_divide(a, b).alias("floored"), E.modulo(a, b).alias("remainder"), (-a).alias("negated"), F.abs(a).alias("absolute"), F.bitwise_not(a).alias("inverted"),
        (a > b).alias("greater"), (a == b).alias("same"), (a != b).alias("other"), ((a > 0) & (b > 0)).alias("both"), ((a > 0) | (b > 0)).alias("either"),
    )


@_r.add("""
SELECT o_orderkey, CAST(date_sub('millisecond', TIMESTAMP '1995-01-01', o_orderdate) AS BIGINT) AS ms, o_orderstatus || '-' || o_orderpriority AS joined,
       CAST(pow(o_orderkey % 10, 3) AS BIGINT) AS cubed FROM orders""")
def arithmetic_times(spark, d):
    """Milliseconds between times, text concatenation, whole powers."""
    return table(spark, d, "orders").select(
        "o_orderkey", E.milliseconds(F.col("o_orderdate"), F.lit("1995-01-01").cast("timestamp_ntz")).alias("ms"),
        F.concat("o_orderstatus", F.lit("-"), "o_orderpriority").alias("joined"), E.power(F.col("o_orderkey") % 10, 3, integral=True).alias("cubed"),
    )


@_r.add("""
WITH t AS (SELECT p_partkey, p_retailprice / 10000 AS x, CAST(p_size AS DOUBLE) AS s FROM part)
SELECT p_partkey, round(sqrt(s), 9) AS a_sqrt, round(sin(s), 9) AS a_sin, round(cos(s), 9) AS a_cos, round(tan(x), 9) AS a_tan, round(sinh(x), 9) AS a_sinh, round(cosh(x), 9) AS a_cosh,
       round(tanh(x), 9) AS a_tanh, round(exp(x), 9) AS a_exp, round(exp(x) - 1, 9) AS a_expm1, round(ln(s), 9) AS a_ln, round(ln(s) / ln(7.0), 9) AS a_log7, round(log2(s), 9) AS a_log2,
       round(log10(s), 9) AS a_log10, round(ln(1 + s), 9) AS a_log1p, round(acos(x), 9) AS a_acos, round(asin(x), 9) AS a_asin, round(atan(s), 9) AS a_atan, round(asinh(s), 9) AS a_asinh,
       round(acosh(s + 1), 9) AS a_acosh, round(atanh(x), 9) AS a_atanh, round(radians(s), 9) AS a_radians, round(degrees(x), 9) AS a_degrees,
       CAST(ceil(x * 100) AS BIGINT) AS a_ceil, CAST(floor(-x * 100) AS BIGINT) AS a_floor, abs(-s) AS a_abs
FROM t""")
def math_functions(spark, d):
    """Roots, powers, logarithms, angles and rounding."""
    x, s = F.col("x"), F.col("s")
    t = table(spark, d, "part").select("p_partkey", (F.col("p_retailprice") / 10000).alias("x"), F.col("p_size").cast("double").alias("s"))
    made = {
        "sqrt": F.sqrt(s), "sin": F.sin(s), "cos": F.cos(s), "tan": F.tan(x), "sinh": F.sinh(x), "cosh": F.cosh(x), "tanh": F.tanh(x), "exp": F.exp(x),
        "expm1": F.expm1(x), "ln": E.log(s), "log7": E.log(s, 7), "log2": F.log2(s), "log10": F.log10(s), "log1p": F.log1p(s), "acos": F.acos(x), "asin": F.asin(x),
        "atan": F.atan(s), "asinh": F.asinh(s), "acosh": F.acosh(s + 1), "atanh": F.atanh(x), "radians": F.radians(s), "degrees": F.degrees(x),
    }
    whole = [F.ceil(x * 100).alias("a_ceil"), F.floor(-x * 100).alias("a_floor"), F.abs(-s).alias("a_abs")]
    return t.select("p_partkey", *[F.round(c, 9).alias(f"a_{n}") for n, c in made.items()], *whole)


@_r.add("SELECT c_custkey, trunc(c_acctbal) AS cut, sign(c_acctbal) * floor(abs(c_acctbal) * 10) / 10 AS cut1, to_timestamp(c_custkey * 86400)::TIMESTAMP AS t, CAST(instr(c_name, '0') AS INTEGER) AS called FROM customer")
def math_truncate(spark, d):
    """Truncation, unix seconds to time, an engine function by name."""
    c = F.col("c_acctbal")
    return table(spark, d, "customer").select(
        "c_custkey", E.truncate(c).alias("cut"), E.truncate(c, 1).alias("cut1"), E.to_datetime(F.col("c_custkey") * 86400).cast("timestamp_ntz").alias("t"),
        E.call("instr", F.col("c_name"), F.lit("0"), returns="int").alias("called"),
    )
