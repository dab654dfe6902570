"""Edge cases of the operators: NULLs, names, errors."""

import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from lakeloom import session
from lakeloom.functions import aggregates as A
from lakeloom.functions import elements as E
from lakeloom.functions import strings as S
from lakeloom.functions import windows as W
from lakeloom.operators import learning as L
from lakeloom.operators import metrics as M
from lakeloom.operators import networks as G
from lakeloom.operators import python_functions as U
from lakeloom.operators import relational as R
from lakeloom.operators import reshape as P
from lakeloom.operators import sketches as K
from lakeloom.operators import texts as X
from lakeloom.plans import joining
from lakeloom.plans import learning as graphs
from lakeloom.sources import tables as T


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()[0]


@pytest.mark.parametrize(("a", "b"), [(7, 3), (-7, 3), (7, -3), (-7, -3), (6, 3), (0, 5)])
def test_python_division(spark, a, b):
    assert one(spark, E.modulo(F.lit(a), F.lit(b))) == a % b
    assert one(spark, E.floor_divide(F.lit(a), F.lit(b))) == a // b


def test_division_by_zero_is_null(spark):
    for f in (E.modulo, E.floor_divide, E.true_divide):
        assert one(spark, f(F.lit(1), F.lit(0))) is None


def test_join_names_and_merge(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "p"), (3, "q")], "k int, v string")
    assert R.join(a, b, "k").columns == ["k", "v_x", "v_y"]
    assert R.join(a, b, "k", "left").columns == ["k_x", "v_x", "k_y", "v_y"]
    assert values(R.join(a, b, "k", "outer", merge=True).select("k")) == [(1,), (2,), (3,), (None,)]
    with pytest.raises(ValueError):
        R.join(a, b, "k", "left", merge={"v": "auto"})
    with pytest.raises(ValueError):
        R.join(a.toDF("i", "j"), b)


def test_not_in_with_nulls(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    some, empty = spark.createDataFrame([(1,), (None,)], "k int"), spark.createDataFrame([], "k int")
    assert values(R.anti_in(a, "k", some, "k")) == []
    assert values(R.anti_in(a, "k", some.na.drop(), "k")) == [(2,)]
    assert len(values(R.anti_in(a, "k", empty, "k"))) == 3
    assert values(R.drop_rows(a, some.na.drop(), ["k"])) == [(2,), (None,)]


def test_bag_operations(spark):
    a = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (3, 3), (3, 3)], "a int, b int")
    b = spark.createDataFrame([(1, 1), (3, 3)], "a int, b int")
    assert values(R.difference(a, b)) == [(2, 2), (3, 3), (3, 3)]
    assert values(R.difference(a, b, distinct=True)) == [(2, 2)]
    assert values(R.intersection(a, b.union(b.where("a = 3")))) == [(1, 1), (3, 3), (3, 3)]


def test_pivot(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "r string, c string, v int")
    assert values(P.pivot(df, ["r"], "c", ["v"])) == [("a", 1, 2), ("b", 3, None)]
    with pytest.raises(Exception, match="two rows in a cell"):
        P.pivot(df.union(df), ["r"], "c", ["v"]).collect()


def test_kv(spark):
    df = spark.createDataFrame([(1, "a:1,b:2"), (2, ""), (3, None)], "i int, kv string")
    assert values(P.extract_kv(df, ["kv"], fill=0.0)) == [(1, 1.0, 2.0), (2, 0.0, 0.0), (3, 0.0, 0.0)]
    with pytest.raises(Exception, match="malformed"):
        P.extract_kv(spark.createDataFrame([("a1",)], "kv string"), ["kv"]).collect()
    wide = spark.createDataFrame([(1, 2, None)], "i int, a int, b int")
    assert values(P.to_kv(wide, ["a", "b"])) == [(1, "a:2")]


def test_fill_and_scale(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (float("nan"), 5.0, None)], "a double, b double, c double")
    assert values(P.ffill(df)) == [(1.0, 1.0, 3.0), (None, 5.0, 5.0)]
    assert values(P.bfill(df)) == [(1.0, 3.0, 3.0), (5.0, 5.0, None)]
    flat = spark.createDataFrame([(2.0,), (2.0,)], "a double")
    assert values(P.min_max_scale(flat, ["a"])) == [(0.0,), (0.0,)]
    assert values(P.std_scale(flat, ["a"])) == [(0.0,), (0.0,)]


def test_append_id_is_dense(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k")).repartition(7)
    got = P.append_id(df, ["k"]).orderBy("k").collect()
    assert [r["append_id"] for r in got] == list(range(1000))


def test_aggregates_of_strings_and_booleans(spark):
    df = spark.createDataFrame([("b", True), ("a", None), (None, False)], "s string, f boolean")
    got = df.agg(A.total(F.col("s"), "string", F.col("s")).alias("s"), A.total(F.col("f"), "boolean").alias("n"), A.any_(F.col("f")).alias("any"), A.all_(F.col("f")).alias("all")).first()
    assert tuple(got) == ("ab", 1, True, False)
    assert spark.createDataFrame([(1.0,)], "x double").agg(A.skew(F.col("x")), A.variance(F.col("x"))).first()[0] is None


def test_frames(spark):
    df = spark.range(5).withColumn("g", F.lit(1))
    w = W.frame(["g"], ["id"], following=2)
    assert [r[0] for r in df.select(W.cumsum(F.col("id"), w).alias("s")).collect()] == [3, 6, 9, 7, 4]
    with pytest.raises(ValueError):
        W.frame(["g"], ["id"], preceding=-1)


def test_strings(spark):
    c = F.lit("a-b-c")
    assert one(spark, S.rsplit(c, "-", 1)) == ["a-b", "c"]
    assert one(spark, S.split(c, "-", 1)) == ["a", "b-c"]
    assert one(spark, S.replace(F.lit("aXbXc"), "X", "-", n=1)) == "a-bXc"
    assert one(spark, S.rfind(F.lit("abab"), "ab")) == 2 and one(spark, S.find(F.lit("abab"), "z")) == -1
    assert one(spark, S.slice_(F.lit("abcdef"), 1, -1, 2)) == "bd"
    assert one(spark, S.pad(F.lit("ab"), 5, "both", "*")) == "*ab**"
    assert one(spark, S.title(F.lit("it's a-b"))) == "It'S A-B"
    assert one(spark, S.extract(F.lit("xyz"), "[0-9]")) is None


def test_upsert_and_partitions(spark, tmp_path):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    changes = spark.createDataFrame([(2, "x", 1, "put"), (2, "y", 2, "put"), (1, "", 3, "delete"), (3, "n", 1, "put")], "k int, v string, t int, op string")
    assert values(T.upsert(base, changes, ["k"], "t", "op")) == [(2, "y"), (3, "n")]
    with pytest.raises(ValueError):
        T.aligned(base, [("k", "bigint")])
    T.write(base, str(tmp_path / "t"), partition_by=["k"])
    T.write(base.where("k = 1").withColumn("v", F.lit("z")), str(tmp_path / "t"), mode="overwrite", partition_by=["k"])
    assert values(T.read(spark, str(tmp_path / "t"), columns=["k", "v"])) == [(1, "z"), (2, "b")]
    assert T.max_partition(spark, str(tmp_path / "t"), "k") == 2


def test_table_function_with_state(spark):
    class Count:
        def __init__(self):
            self.n = 0

        def process(self, row):
            self.n += 1

        def close(self):
            return [(self.n,)]

    assert sum(r[0] for r in U.apply_rows(spark.range(10), Count, "n long").collect()) == 10
    assert U.apply_rows(spark.range(2), lambda r: None, "x string", keep=["id"], keep_nulls=True).count() == 2


def test_sampling(spark):
    df = spark.range(1000)
    a, b = R.split(df, 0.4, 1)
    assert a.count() + b.count() == 1000 and a.join(b, "id").count() == 0
    assert R.sample(df, n=10).count() == 10
    assert sum(R.sample(df, parts=3, part=i).count() for i in range(3)) == 1000
    with pytest.raises(ValueError):
        R.sample(df, n=1, frac=0.5)


def test_theta_join_needs_a_small_side(spark):
    big = spark.range(10**9)
    with pytest.raises(ValueError):
        R.theta_join(big, big, lambda a, b: a["id"] < b["id"])


def test_item_similarity_of_busy_users(spark):
    rng = random.Random(4)
    rows = [("busy", i) for i in rng.sample(range(700), 620)] + [(f"u{rng.randint(0, 20)}", rng.randint(0, 699)) for _ in range(900)]
    rows += [(None, 1), ("u1", None), rows[0]]
    items = collections.defaultdict(set)
    for u, i in rows:
        items[i].add(u)
    known = sorted(i for i in items if i is not None)
    want = {}
    for x, a in enumerate(known):
        for b in known[x + 1 :]:
            c = len((items[a] & items[b]) - {None})
            if c:
                want[a, b] = c / (len(items[a]) + len(items[b]) - c)
    df = spark.createDataFrame(rows, "user string, item int")
    for block in (500, 37):
        got = {(r["a"], r["b"]): r["jaccard"] for r in L.item_similarity(df, "user", "item", block).collect()}
        assert got == pytest.approx(want)


def test_graphs_of_all_lines(spark, tmp_path):
    rng = random.Random(6)
    lines = [(n, rng.randint(1, 60), rng.randint(1, 150)) for n in range(1, 151)]  # most lines are no multiple of 40 or 97
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    edges = {(s, t) for _, s, t in lines}
    nodes = {x for e in edges for x in e}
    degrees = sorted((v, sum(s == v for s, _ in edges), sum(t == v for _, t in edges)) for v in nodes)
    assert values(graphs.graph_degrees(spark, str(tmp_path))) == sorted(degrees, key=repr)
    near = collections.defaultdict(set)
    for s, t in edges:
        if s != t:
            near[s].add(t), near[t].add(s)
    through = {v: sum(b in near[a] for a in near[v] for b in near[v]) // 2 for v in nodes}
    assert values(graphs.graph_triangles(spark, str(tmp_path))) == sorted(((v, n) for v, n in through.items() if n), key=repr)

    label = {x: x for s, t in edges for x in (s, -1 - t)}
    moved = True
    while moved:
        moved = False
        for s, t in edges:
            low = min(label[s], label[-1 - t])
            moved |= label[s] != low or label[-1 - t] != low
            label[s] = label[-1 - t] = low
    assert values(graphs.graph_components(spark, str(tmp_path))) == sorted(label.items(), key=repr)

    rank = dict.fromkeys(nodes, 1 / len(nodes))
    out = collections.Counter(s for s, _ in edges)
    for _ in range(10):
        loose = sum(r for v, r in rank.items() if not out[v])
        got = collections.Counter()
        for s, t in edges:
            got[t] += rank[s] / out[s]
        rank = {v: (0.15 + 0.85 * loose) / len(nodes) + 0.85 * got[v] for v in nodes}
    assert dict(values(graphs.graph_page_rank(spark, str(tmp_path)))) == pytest.approx(rank)


def test_graphs_have_more_tasks_when_they_grow(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 50)
    edges = spark.range(1000).select((F.col("id") % 40).alias("s"), (-1 - F.col("id") % 75).alias("t"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    made = [G.label_propagation(edges, "s", "t", 2), G.shortest_paths(edges, "s", "t", 1), G.k_core(edges, "s", "t", 2), L.connected_components(edges, "s", "t"), L.page_rank(edges, "s", "t", 2)]
    assert all(df.rdd.getNumPartitions() >= 20 for df in made)
    assert before == {c: spark.conf.get(c) for c in before}
    held = session.placed(edges, 20, "s")
    met = held.join(session.placed(edges.select(F.col("s").alias("node")).distinct(), 20, "node"), F.col("s") == F.col("node"))
    assert met.count() == 1000 and "Exchange hash" not in met._jdf.queryExecution().executedPlan().toString()


def test_triangles_of_a_dense_graph_make_no_row_of_each_wedge(spark):
    edges = spark.range(60).alias("x").crossJoin(spark.range(60).alias("y")).select(F.col("x.id").alias("s"), F.col("y.id").alias("t")).where("s <> t OR s = 3")
    got = L.triangles(edges, "s", "t")
    assert {r["triangles"] for r in got.collect()} == {59 * 58 // 2} and got.count() == 60
    assert "array_intersect" in got._jdf.queryExecution().optimizedPlan().toString()
    assert L.triangles(edges.where("s = 0"), "s", "t").count() == 0  # a star


def test_bloom_filter_hashes_a_key_once_per_seven_bits(spark):
    keys, strange = spark.range(2000).select(F.col("id").alias("k")), spark.range(5000, 9000).select(F.col("id").alias("q"))
    for rate in (0.01, 0.0001):  # 7 and 13 hashes
        assert K.bloom_filter(keys, "k", keys, "k", 2000, rate).count() == 2000
        assert K.bloom_filter(strange, "q", keys, "k", 2000, rate).count() <= 4000 * rate * 2 + 3
    plan = K.bloom_filter(strange, "q", keys, "k", 2000, 0.01)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") <= 6  # block, bits and a check of the block, on both sides


def test_trees_read_their_rows_in_parts(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    rows = spark.range(0, 2000, 1, 1).select(F.col("id").cast("double").alias("x"), (F.col("id") > 700).cast("double").alias("y"))
    got = L.boosted_trees(rows, ["x"], "y", rounds=2)
    assert got.count() == 2000 and L.in_parts(rows).rdd.getNumPartitions() >= 20


def test_triangles_of_repeated_edges_are_met_without_sorting_what_is_sent(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 50)
    rng = random.Random(8)
    rows = [(rng.randint(1, 30), rng.randint(1, 30)) for _ in range(150)]
    rows += rows[:40] * 5 + [(b, a) for a, b in rows[:60]] + [(None, 1), (1, None), (None, None), (7, 7)]
    near = collections.defaultdict(set)
    for a, b in rows:
        if a is not None and b is not None and a != b:
            near[a].add(b), near[b].add(a)
    through = {v: sum(b in near[a] for a in near[v] for b in near[v]) // 2 for v in near}
    got = L.triangles(spark.createDataFrame(rows, "s int, d long"), "s", "d")
    assert {r["node"]: r["triangles"] for r in got.collect()} == {v: n for v, n in through.items() if n}
    plan = got._jdf.queryExecution().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_page_rank_reads_many_edges_in_a_row(spark, monkeypatch):
    monkeypatch.setattr(session, "LISTED", 7)
    rng = random.Random(5)
    rows = [(0, i) for i in range(1, 60)] + [(rng.randint(1, 80), rng.randint(0, 80)) for _ in range(150)]
    edges = spark.createDataFrame([*rows, *rows[:9], (None, 1), (1, None)], "s int, d int")
    held = session.listed(edges.dropna(), 3, "s", "d").collect()
    assert sorted((r["s"], d) for r in held for d in r["d"]) == sorted(set(rows))
    assert max(len(r["d"]) for r in held) == 7 and len(held) < len(set(rows))  # a hub is many rows
    outs, nodes = {}, {n for e in rows for n in e}
    for s, d in set(rows):
        outs.setdefault(s, set()).add(d)
    ranks = dict.fromkeys(nodes, 1 / len(nodes))
    for _ in range(4):
        loose = sum(r for n, r in ranks.items() if n not in outs)
        got = dict.fromkeys(nodes, 0.0)
        for s, ds in outs.items():
            for d in ds:
                got[d] += ranks[s] / len(ds)
        ranks = {n: 0.15 / len(nodes) + 0.85 * (g + loose / len(nodes)) for n, g in got.items()}
    assert {r["node"]: r["rank"] for r in L.page_rank(edges, "s", "d", 4).collect()} == pytest.approx(ranks)


def test_joins_of_all_customers(spark, sf_dir):
    left = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_nationkey < 20")
    want = {r["c_custkey"] for r in left.collect()}
    assert {r["id"] for r in joining.join_left(spark, sf_dir).select("id").distinct().collect()} == want
    assert {r["id"] for r in joining.join_outer_merged(spark, sf_dir).where("id IS NOT NULL").select("id").distinct().collect()} == want


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
def test_salted_join_spreads_equal_rows_of_a_hot_key(spark, how):
    left = spark.createDataFrame([("hot", "same")] * 300 + [(f"k{i}", "x") for i in range(20)] + [(None, "n")], "k string, a string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3), ("alone", 4), (None, 5)], "k string, b int")
    got = R.salted_join(left, right, "k", how, per=10)
    assert values(got) == values(left.join(right, "k", how).select("k", "a", "b"))
    plan = got.where("k = 'hot'") if how == "inner" else None
    if plan is not None:
        salt = left.join(left.groupBy("k").agg(F.ceil(F.count("*") / 10).cast("int").alias("n")), "k").select(F.pmod(F.monotonically_increasing_id(), F.col("n")).alias("s"), "k").where("k = 'hot'")
        sizes = [r["count"] for r in salt.groupBy("s").count().collect()]
        assert len(sizes) == 30 and max(sizes) <= 20  # no salt holds much more than its share


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
def test_join_deals_keys_of_many_pairs_to_many_tasks(spark, how):
    left = spark.createDataFrame([(k, "same") for k in (1, 2) for _ in range(3000)] + [(3, "x"), (4, "y"), (None, "n")], "k int, a string")
    right = spark.createDataFrame([(k, i) for k in (1, 2) for i in range(40)] + [(3, 7), (5, 8), (None, 9)], "k int, a int")
    plain = R.join(left, right, "k", how, merge=how != "inner" or None)
    got = R.join(left, right, "k", how, merge=how != "inner" or None, spread=1000)
    assert got.columns == plain.columns == ["k", "a_x", "a_y"]
    assert values(got.groupBy(*got.columns).count()) == values(plain.groupBy(*plain.columns).count())
    tasks = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) >= 16 and max(tasks) < 240_000 / 4


def test_salted_join_repeats_right_rows_no_more_often_than_there_are_tasks(spark):
    left = spark.range(20_000).select(F.lit(1).alias("k"), "id")
    right = spark.range(30).select(F.lit(1).alias("k"), F.col("id").alias("r"))
    a, b = R._dealt(left, right, [("k", "k")], left.groupBy(F.col("k").alias("_k0")).agg(F.ceil(F.count("*") / 10).cast("int").alias("_n")))
    assert a.count() == 20_000 and b.count() <= 30 * R._tasks(left)
    assert R.salted_join(left, right, "k", "outer", per=10).count() == 600_000


def test_salted_join_repeats_no_right_row_of_a_key_that_is_not_hot(spark):
    left = spark.range(1000).select(F.when(F.col("id") < 600, F.col("id")).when(F.col("id") < 700, F.lit(7)).alias("k"), "id")
    right = spark.range(650).select(F.col("id").alias("k"), F.col("id").alias("r"))
    hot = left.dropna().groupBy(F.col("k").alias("_k0")).agg(F.ceil(F.count("*") / 20).cast("int").alias("_n")).where("_n > 1")
    a, b = R._dealt(left, right, [("k", "k")], hot)
    salts = {r["k"]: r["n"] for r in a.groupBy("k").agg(F.countDistinct("_salt").alias("n")).collect()}
    assert salts.pop(7) == 6 and salts.pop(None) > 6 and set(salts.values()) == {1}  # 101 rows, 300 rows without a key, single rows
    assert b.count() == 650 + 5 and b.where("k <> 7").agg(F.max("_salt")).first()[0] == 0
    assert values(R.salted_join(left, right, "k", "outer", per=20)) == values(left.join(right, "k", "outer"))


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
def test_join_in_blocks_by_keys_of_other_names(spark, how):
    left = spark.createDataFrame([(i % 3, "a" if i % 2 else None, i) for i in range(700)] + [(8, "a", -1), (9, "b", -2)], "k int, s string, v int")
    right = spark.createDataFrame([(i % 3, "a", i / 2) for i in range(600)] + [(8, "a", -0.0), (7, None, 1.0), (None, "a", 2.0)], "k long, t string, w double")
    plain = R.join(left, right, ["k", ("s", "t")], how)
    got = R.join(left, right, ["k", ("s", "t")], how, spread=10_000)
    assert got.schema.simpleString() == plain.schema.simpleString()
    assert values(got.groupBy(*got.columns).count()) == values(plain.groupBy(*plain.columns).count())
    assert got.where("w = 0").count() == plain.where("w = 0").count() > 0


def test_join_deals_left_rows_that_meet_none(spark):
    left = spark.range(5000).select(F.lit(1).alias("k"), "id")
    right = spark.range(10).select(F.lit(2).alias("k"), F.col("id").alias("r"))
    hot = R._heavy(left, right, [("k", "k")], 1000)
    a, b = R._dealt(left, right, [("k", "k")], hot)
    assert a.select("_salt").distinct().count() == 5 and b.count() == 10
    assert R.join(left, right, "k", "left", spread=1000).where("r IS NULL").count() == 5000


def test_pairs_of_hot_keys_are_written_small(spark, tmp_path):
    left = spark.range(1500).select(F.lit(1).alias("k"), (F.col("id") * 7919).alias("id"), F.format_string("left %09d", F.col("id") * 7919).alias("name"))
    right = spark.range(1501).select(F.lit(1).alias("k"), (F.col("id") * 104_729).alias("sid"), F.format_string("right %09d", F.col("id") * 104_729).alias("name"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as larger sides would be joined
    try:
        R.join(left, right, "k", "right", merge=True, spread=100_000).write.parquet(str(tmp_path / "pairs"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    back = spark.read.parquet(str(tmp_path / "pairs"))
    assert back.count() == back.distinct().count() == 1500 * 1501
    assert sum(p.stat().st_size for p in (tmp_path / "pairs").glob("*.parquet")) < 0.6 * 1500 * 1501


def test_curves_of_scores_with_an_outlier(spark):
    rng = random.Random(8)
    rows = [(rng.randint(0, 1), rng.choice([rng.random(), round(rng.random(), 1), 1e12 if rng.random() < 0.01 else 0.5])) for _ in range(500)] + [(1, None), (None, 0.25)]
    df = spark.createDataFrame(rows, "y int, s double")
    got = {r["threshold"]: (r["tp"], r["fp"]) for r in M.curve(df, "y", "s").collect()}
    known = [(y, s) for y, s in rows if s is not None]
    assert got == {t: (sum(y == 1 for y, s in known if s >= t), sum(y != 1 for y, s in known if s >= t)) for _, t in known}
    pairs = [((a > b) + (a == b) / 2) for y, a in known if y == 1 for z, b in known if z != 1]
    assert M.roc_auc(df, "y", "s").first()[0] == pytest.approx(sum(pairs) / len(pairs))
    assert M.curve(df.limit(0), "y", "s").count() == 0


def test_bloom_filter_keeps_its_error_rate(spark):
    keys = spark.range(5000).withColumnRenamed("id", "k")
    assert K.bloom_filter(keys, "k", keys, "k", 5000, 0.01).count() == 5000
    strange = spark.range(10**6, 10**6 + 50_000).withColumnRenamed("id", "q").withColumn("_probe2", F.lit(1))
    kept = K.bloom_filter(strange, "q", keys, "k", 5000, 0.01)
    assert kept.columns == ["q", "_probe2"] and kept.count() <= 0.015 * 50_000
    assert K.bloom_filter(keys, "k", keys.limit(0), "k").count() == 0


def test_slices_tail_and_random(spark):
    df = spark.range(50).select((F.col("id") * 7 % 50).alias("k")).repartition(4)
    assert sorted(r[0] for r in R.slice_rows(df, ["k"], 3, 40, 5).collect()) == list(range(3, 40, 5))
    assert sorted(r[0] for r in R.slice_rows(df, ["k"], 48).collect()) == [48, 49]
    assert [r[0] for r in R.tail(df, 2, ["k"]).collect()] == [49, 48]
    assert spark.range(20).select(R.random_number(3)).collect() == spark.range(20).select(R.random_number(3)).collect()
    wide = R.describe(df, "k", approximate=True).where("type = 'quantile_50'").first()["k"]
    assert 23 <= wide <= 26


def test_folds_features_and_bins(spark):
    df = spark.range(200).select("id", (F.col("id") % 10).cast("double").alias("x"), (F.col("id") * 7919 % 13).cast("double").alias("noise")).withColumn("y", F.col("x") * 2)
    pairs = M.train_test(df, 4, ["id"])
    assert all(a.join(b, "id").count() == 0 and a.count() + b.count() == 200 for a, b in pairs)
    got = M.cross_val_score(df, lambda a, b: L.linear_predictions(a, b, ["x"], "y"), lambda p: M.regression(p, "y", "prediction").select(F.col("rmse").alias("score")), 4, ["id"])
    assert sorted(r["fold"] for r in got.collect()) == [0, 1, 2, 3] and all(r["score"] < 1e-6 for r in got.collect())
    for method in ("forest", "boosted", "linear"):
        assert "noise" not in L.select_features(df, ["x", "noise"], "y", 1, method=method, trees=4).columns
    edges = spark.createDataFrame([([0.0, 2.0, 4.0, 9.0],)], "edges array<double>")
    assert {r["x"]: r["bin"] for r in L.binned(df.select("x"), "x", edges).collect()} == {float(x): 0 if x <= 2 else 1 if x <= 4 else 2 for x in range(10)}
    assert L.binned(spark.createDataFrame([(None,)], "x double"), "x", edges).first()["bin"] is None


def test_shared_folder_is_asked_for_on_a_cluster(spark, monkeypatch):
    from lakeloom import session

    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Away:
        conf = {}
        sparkContext = Context()

    Away.conf = type("C", (), {"get": lambda self, k, default=None: default})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Away())
    assert session.shared_dir(spark)


def test_paths_cores_and_labels(spark):
    rng = random.Random(12)
    edges = [(rng.randint(0, 40), rng.randint(0, 40), float(rng.randint(0, 9))) for _ in range(150)] + [(100, 101, 1.0), (None, 3, 1.0), (4, None, 1.0), (7, 7, 2.0)]
    df = spark.createDataFrame(edges, "s long, t long, w double")
    known = [e for e in edges if None not in e]
    far = {0: 0.0}
    for _ in range(60):
        for a, b, w in known:
            if a in far and far[a] + w < far.get(b, math.inf):
                far[b] = far[a] + w
    assert dict(values(G.shortest_paths(df, "s", "t", 0, "w"))) == far
    assert values(G.shortest_paths(df, "s", "t", 999)) == [(999, 0.0)]

    near = collections.defaultdict(set)
    for a, b, _ in known:
        if a != b:
            near[a].add(b), near[b].add(a)
    core = {k: set(v) for k, v in near.items()}
    while any(len(v) < 4 for v in core.values()):
        gone = {k for k, v in core.items() if len(v) < 4}
        core = {k: v - gone for k, v in core.items() if k not in gone}
    assert core and values(G.k_core(df, "s", "t", 4)) == sorted(((a, b) for a, v in core.items() for b in v if a < b), key=repr)
    assert values(G.k_core(df, "s", "t", 50)) == []

    label = {k: k for k in near}
    for _ in range(3):
        new = {}
        for k in near:
            votes = collections.Counter([label[k], *(label[j] for j in near[k])])
            new[k] = min(x for x, n in votes.items() if n == max(votes.values()))
        label = new
    assert dict(values(G.label_propagation(df, "s", "t", 3))) == label
    m = sum(map(len, near.values()))
    want = sum(sum(label[j] == label[k] for j in near[k]) for k in near) / m - sum((sum(len(near[k]) for k in near if label[k] == x) / m) ** 2 for x in set(label.values()))
    got = G.modularity(df, "s", "t", spark.createDataFrame(list(label.items()), "node long, label long")).first()[0]
    assert got == pytest.approx(want)
    dense = {k: sum(b in near[a] for a in v for b in v) / max(1, len(v) * (len(v) - 1)) for k, v in near.items()}
    assert dict(values(G.node_density(df, "s", "t"))) == pytest.approx(dense)
    assert {r["component"] for r in G.largest_component(df, "s", "t").collect()} == {0}


def test_texts_and_classifiers(spark):
    df = spark.createDataFrame([(1, "a b a b"), (2, "a"), (3, None), (4, " c\n c ")], "i int, t string")
    assert values(X.ngrams(df, "i", "t", 2)) == [(1, "a b", 2), (1, "b a", 1), (4, "c c", 1)]
    assert [r["word"] for r in X.keywords(df, "i", "t", 1).where("i = 1").collect()] == ["b"]
    assert one(spark, X.similarity(F.lit(""), F.lit(""))) == 1.0 and one(spark, X.similarity(F.lit("abcd"), F.lit("abxd"))) == 0.75
    rows = spark.range(200).select("id", (F.col("id") % 20).cast("double").alias("x")).withColumn("y", (F.col("x") > 9).cast("int"))
    for f in (L.linear_svm, L.naive_bayes, L.forest_classes):
        assert f(rows, ["x"], "y").where("prediction = y").count() >= 190
