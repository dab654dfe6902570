"""Joins, set operations, sorting and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import relational as R
from lakeloom.plans.registry import Registry
from lakeloom.session import table

_r = Registry()
QUERIES, ORACLES = _r.queries, _r.oracles


def _sides(spark, d):
    left = table(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    right = table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("sid"), F.col("s_name").alias("name")).where("s_nationkey > 5")
    return left.where("k < 20"), right


_CTE = """WITH l AS (SELECT c_nationkey AS k, c_custkey AS id, c_name AS name FROM customer WHERE c_nationkey < 20),
r AS (SELECT s_nationkey AS k, s_suppkey AS sid, s_name AS name FROM supplier WHERE s_nationkey > 5) """

#: Pairs of customers and suppliers from which on a nation is dealt to several tasks: there are few nations, of many pairs each.
_PAIRS = 1_000_000


@_r.add(_CTE + "SELECT l.k, id, l.name AS name_x, sid, r.name AS name_y FROM l JOIN r ON l.k = r.k")
def join_inner(spark, d):
    """One copy of the key, suffixes on other shared names."""
    return R.join(*_sides(spark, d), on="k", spread=_PAIRS)


@_r.add(_CTE + "SELECT l.k AS k_x, id, l.name AS name_x, r.k AS k_y, sid, r.name AS name_y FROM l LEFT JOIN r ON l.k = r.k")
def join_left(spark, d):
    """An outer join keeps both keys."""
    return R.join(*_sides(spark, d), on="k", how="left", spread=_PAIRS)


@_r.add(_CTE + "SELECT coalesce(l.k, r.k) AS k, id, l.name AS name_a, sid, r.name AS name_b FROM l RIGHT JOIN r ON l.k = r.k")
def join_right_merged(spark, d):
    """A merged key and other suffixes."""
    return R.join(*_sides(spark, d), on="k", how="right", merge=True, suffixes=("_a", "_b"), spread=_PAIRS)


@_r.add(_CTE + "SELECT coalesce(l.k, r.k) AS k, id, l.name AS name_x, sid, r.name AS name_y FROM l FULL JOIN r ON l.k = r.k")
def join_outer_merged(spark, d):
    """A full join with its key merged."""
    return R.join(*_sides(spark, d), on="k", how="outer", merge={"k": "auto"}, spread=_PAIRS)


# The same four under the names that once told them from joins of a part of customer.
for _f in (join_inner, join_left, join_right_merged, join_outer_merged):
    QUERIES[f"{_f.__name__}_whole"], ORACLES[f"{_f.__name__}_whole"] = _f, ORACLES[_f.__name__]


@_r.add("SELECT o_orderkey, o_custkey, c_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey AND o_totalprice > c_acctbal * 20")
def join_named_keys(spark, d):
    """Keys of different names and a further condition."""
    o, c = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    out = R.join(o, c, on=("o_custkey", "c_custkey"), small=True, extra=lambda a, b: a("o_totalprice") > b("c_acctbal") * 20)
    return out.select("o_orderkey", "o_custkey", "c_custkey", "c_name")


@_r.add("SELECT a.n_nationkey AS x, b.r_regionkey AS y FROM nation a JOIN region b ON a.n_regionkey < b.r_regionkey")
def join_theta(spark, d):
    """A condition without a key, the right side small."""
    out = R.theta_join(table(spark, d, "nation"), table(spark, d, "region"), lambda a, b: a["n_regionkey"] < b["r_regionkey"])
    return out.select(F.col("n_nationkey").alias("x"), F.col("r_regionkey").alias("y"))


@_r.add("SELECT a.n_nationkey AS x, b.n_nationkey AS y, a.n_regionkey AS region FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey WHERE a.n_nationkey < b.n_nationkey")
def join_self(spark, d):
    """A table with itself."""
    n = table(spark, d, "nation").select("n_regionkey", "n_nationkey")
    out = R.join(n, n, on="n_regionkey", extra=lambda a, b: a("n_nationkey") < b("n_nationkey"))
    return out.select(F.col("n_nationkey_x").alias("x"), F.col("n_nationkey_y").alias("y"), F.col("n_regionkey").alias("region"))


@_r.add("SELECT l_orderkey, l_linenumber, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def join_salted(spark, d):
    """An equi-join with its keys spread over salts."""
    l = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber")  # noqa: E741
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), "o_totalprice")
    return R.salted_join(l, o, "k", per=3).select(F.col("k").alias("l_orderkey"), "l_linenumber", "o_totalprice")


@_r.add("SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def semi_join(spark, d):
    """Rows whose key is among another table's."""
    return R.semi(table(spark, d, "customer"), "c_custkey", table(spark, d, "orders").where("o_totalprice > 300000"), "o_custkey")


@_r.add("SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def anti_join_not_in(spark, d):
    """Rows whose key is not among another table's, with SQL's NULLs."""
    return R.anti_in(table(spark, d, "customer"), "c_custkey", table(spark, d, "orders"), "o_custkey")


@_r.add("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT nullif(o_custkey, 1) FROM orders) ")
def anti_join_null_right(spark, d):
    """A NULL on the right leaves nothing."""
    right = table(spark, d, "orders").select(F.nullif("o_custkey", F.lit(1)).alias("k"))
    return R.anti_in(table(spark, d, "customer").select("c_custkey"), "c_custkey", right, "k")


@_r.add("SELECT c.* FROM customer c WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_nationkey = c.c_nationkey)")
def drop_matching_rows(spark, d):
    """Rows without a match."""
    return R.drop_rows(table(spark, d, "customer"), table(spark, d, "supplier").withColumnRenamed("s_nationkey", "c_nationkey"), ["c_nationkey"])


@_r.add("SELECT c_nationkey AS k, c_custkey AS id FROM customer UNION ALL SELECT s_nationkey, s_suppkey FROM supplier")
def union_by_name(spark, d):
    """All rows of two tables, matched by name."""
    a = table(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("id"))
    return R.union(a, table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("k")))


@_r.add("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark, d):
    """One of each."""
    return R.union(table(spark, d, "customer").select(F.col("c_nationkey").alias("k")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")), distinct=True)


def _keys(spark, d):
    return [table(spark, d, t).select(F.col(c).alias("k")) for t, c in (("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey"))]


@_r.add("SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier EXCEPT ALL SELECT n_nationkey FROM nation")
def difference_bag(spark, d):
    """Copies cancel one by one, over two right sides."""
    return R.difference(*_keys(spark, d))


@_r.add("SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier")
def difference_distinct(spark, d):
    """Tuples that the right side lacks."""
    _, s, n = _keys(spark, d)
    return R.difference(n, s, distinct=True)


@_r.add("SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier")
def intersection_bag(spark, d):
    """The least number of copies."""
    return R.intersection(*_keys(spark, d)[:2])


@_r.add("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier INTERSECT SELECT n_nationkey FROM nation")
def intersection_distinct(spark, d):
    """Tuples that all sides have."""
    return R.intersection(*_keys(spark, d), distinct=True)


@_r.add("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey")
def sort_keys(spark, d):
    """Several keys, one descending."""
    return R.order(table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), ["o_orderpriority", "-o_totalprice", "o_orderkey"])


@_r.add("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 10")
def sort_slice(spark, d):
    """Rows 10 to 35 in an order."""
    return R.window_of(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 10, 35, [F.desc("o_totalprice"), "o_orderkey"])


@_r.add("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_columns(spark, d):
    """Distinct tuples of columns."""
    return R.distinct_on(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus")


@_r.add("SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def value_counts(spark, d):
    """Values by frequency."""
    return R.value_counts(table(spark, d, "events"), "event_type")


@_r.add("SELECT user_id, count(*) AS count FROM events GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 7")
def top_values(spark, d):
    """The most frequent values."""
    return R.topk(table(spark, d, "events"), "user_id", 7)


@_r.add("SELECT l_orderkey, l_linenumber, o_totalprice FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_quantity > 25")
def join_salted_left(spark, d):
    """A left join with its keys spread over salts."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), "o_totalprice")
    l = table(spark, d, "lineitem").where("l_quantity > 25").select(F.col("l_orderkey").alias("k"), F.col("l_orderkey"), "l_linenumber")  # noqa: E741
    return R.salted_join(o, l, "k", "left", per=2).select("l_orderkey", "l_linenumber", "o_totalprice")


@_r.add("SELECT coalesce(c_nationkey, s_nationkey) AS k, c_custkey, s_suppkey FROM (SELECT * FROM customer WHERE c_nationkey < 20) FULL JOIN (SELECT * FROM supplier WHERE s_nationkey > 5) ON c_nationkey = s_nationkey")
def join_salted_outer(spark, d):
    """A full join with its hot keys spread over salts."""
    c = table(spark, d, "customer").where("c_nationkey < 20").select(F.col("c_nationkey").alias("k"), "c_custkey")
    s = table(spark, d, "supplier").where("s_nationkey > 5").select(F.col("s_nationkey").alias("k"), "s_suppkey")
    return R.salted_join(c, s, "k", "outer", per=10)


@_r.add("SELECT o_orderkey, o_totalprice FROM orders")
def split_parts(spark, d):
    """Two complementary parts together are the table."""
    a, b = R.split(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 0.3, 7, ["o_orderkey"])
    return a.unionAll(b)


@_r.add("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 12")
def sort_tail(spark, d):
    """The last rows in an order."""
    return R.tail(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 12, ["o_orderkey"])


@_r.add("SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS i FROM orders) WHERE i BETWEEN 5 AND 499 AND (i - 5) % 7 = 0")
def sort_slice_step(spark, d):
    """Every seventh row from 5 to 500 in an order."""
    return R.slice_rows(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 5, 500, 7).select("o_orderkey")


@_r.add("SELECT o_orderkey, true AS inside FROM orders")
def random_column(spark, d):
    """A seeded random number on every row."""
    x = R.random_number(7)
    return table(spark, d, "orders").select("o_orderkey", x.alias("x")).select("o_orderkey", ((F.col("x") >= 0) & (F.col("x") < 1)).alias("inside"))


@_r.add("SELECT o_orderkey, CAST(1 AS BIGINT) AS parts FROM orders")
def sample_parts(spark, d):
    """Every row is in one of three parts by hash."""
    o = table(spark, d, "orders").select("o_orderkey")
    parts = [R.sample(o, parts=3, part=i, columns=["o_orderkey"], seed=5) for i in range(3)]
    return R.union(*parts).groupBy("o_orderkey").agg(F.count("*").alias("parts"))


@_r.add()
def sample_fraction(spark, d):
    """About a tenth of the rows."""
    return R.sample(table(spark, d, "orders"), frac=0.1, seed=3)


@_r.add()
def sample_weighted(spark, d):
    """A hundred rows, likelier with a higher price."""
    return R.sample(table(spark, d, "orders"), n=100, weight="o_totalprice", columns=["o_orderkey"])


@_r.add()
def sample_strata(spark, d):
    """Fractions per status."""
    return R.sample(table(spark, d, "orders"), strata=("o_orderstatus", {"F": 0.1, "O": 0.2, "P": 1.0}), seed=3)


@_r.add("SELECT o_orderkey, o_custkey FROM orders")
def reshuffle_sorted(spark, d):
    """Rows dealt by a key and sorted within partitions."""
    return R.reshuffle(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"], ["o_custkey", "o_orderkey"])
