"""Catalog tables, statements, concurrent actions and streams with late rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import learning as L
from lakeloom.operators import relational as R
from lakeloom.sources import tables as T
from lakeloom.streaming import events as V


def test_catalog_table(spark):
    spark.sql("DROP TABLE IF EXISTS lakeloom_t")
    try:
        T.persist(spark.range(6).withColumn("k", F.col("id") % 2), "lakeloom_t", {"ds": "a"}, ["k"])
        T.persist(spark.range(2).withColumn("k", F.lit(0).cast("long")), "lakeloom_t", {"ds": "b"}, ["k"], mode="append")
        got = T.read_named(spark, "lakeloom_t", where=F.col("ds") == "a", columns=["id"], limit=10)
        assert sorted(r[0] for r in got.collect()) == list(range(6))
        plan = T.read_named(spark, "lakeloom_t", where=F.col("ds") == "a")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(ds" in plan
    finally:
        spark.sql("DROP TABLE IF EXISTS lakeloom_t")


def test_scan_prunes_and_pushes_down(spark, sf_dir):
    df = T.read(spark, f"{sf_dir}/lineitem.parquet", columns=["l_orderkey"], where=F.col("l_quantity") > 49)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,49" in plan and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_statement_restores_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert T.statement(spark, "SELECT :x + 1 AS y", {"spark.sql.shuffle.partitions": "3"}, {"x": 1}).first()[0] == 2
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert T.cost(spark.range(10))["bytes"] == 80


def test_actions_together(spark):
    assert T.together(*[lambda n=n: spark.range(n).count() for n in (3, 5, 7)]) == [3, 5, 7]


def test_json_batches_and_trunc(spark):
    assert [x for b in T.batches(spark.range(3)) for x in b.column(0).to_pylist()] == [0, 1, 2]
    assert sum(int(f["id"].sum()) for f in T.frames(spark.range(10))) == 45
    t = spark.range(1).select(F.lit(dt.datetime(2024, 5, 6, 7, 8)).alias("t"))
    assert t.select(*[T.trunc_time(F.col("t"), p) for p in ("year", "month", "day", "hour")]).first() == ("2024", "2024-05", "2024-05-06", "2024-05-06 07:00:00")


def test_late_rows_are_dropped(spark, tmp_path):
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    for i, hours in enumerate(([1, 2, 50], [51], [3, 80, 52])):
        spark.createDataFrame([(at(h),) for h in hours], "ts timestamp").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema("ts timestamp").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").option("latestFirst", "false").parquet(f"{tmp_path}/in")
    out = V.tumbling(stream, "ts", "1 hour", [], F.count("*").alias("n"), late="2 hours")
    V.run(out, f"{tmp_path}/state", f"{tmp_path}/out")
    got = {r["window"]["start"]: r["n"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got[at(1)] == got[at(2)] == 1 and at(3) not in got  # hour 3 came two batches after hour 50


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 3), (5, 4), (None, 1)]])
def test_components(spark, edges):
    got = {tuple(r) for r in L.connected_components(_checked(spark).createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    want = {0: set(), 1: {(1, 1)}}.get(len(edges), {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)})
    assert got == want


def _checked(spark):
    if not spark.sparkContext.getCheckpointDir():
        import tempfile

        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakeloom-"))
    return spark


def test_salted_join_spreads_a_hot_key(spark):
    left = spark.range(1000).select(F.lit(1).alias("k"), "id")
    right = spark.createDataFrame([(1, "a")], "k int, v string")
    out = R.salted_join(left, right, "k", per=8)
    assert out.count() == 1000 and out.columns == ["k", "id", "v"]
