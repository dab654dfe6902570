"""Python functions, sketches, table input and output, and streams."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from lakeloom.operators import python_functions as U
from lakeloom.operators import sketches as K
from lakeloom.plans.registry import Registry
from lakeloom.session import checkpointed, shared_dir, table
from lakeloom.sources import tables as T
from lakeloom.streaming import events as V

_r = Registry()
QUERIES, ORACLES = _r.queries, _r.oracles


def _work(spark) -> str:
    """A fresh folder under the session's shared one."""
    return f"{shared_dir(spark)}/plans-{uuid.uuid4().hex}"


@_r.add("SELECT s_suppkey, s_nationkey * 10 + 1 AS m FROM supplier")
def udf_map(spark, d):
    """A function per element, in Arrow batches."""
    return table(spark, d, "supplier").select("s_suppkey", U.map_column(F.col("s_nationkey"), lambda x, a: x * a + 1, "int", args=(10,)).alias("m"))


@_r.add("SELECT n_nationkey, n_name, n_nationkey + n_regionkey AS both FROM nation")
def udf_row(spark, d):
    """A scalar from a whole row."""
    return U.reduce_rows(table(spark, d, "nation"), lambda r: int(r.n_nationkey + r.n_regionkey), "int", "both").drop("n_regionkey")


@_r.add("SELECT r_regionkey, unnest(regexp_extract_all(r_name, '[A-Z]')) AS letter FROM region")
def udf_table(spark, d):
    """Several rows per row, with a column of the row beside."""
    return U.apply_rows(table(spark, d, "region"), lambda r: [(c,) for c in r.r_name if c.isupper()], "letter string", keep=["r_regionkey"])


class _Mean:
    """Sum and count, merged over batches."""

    def buffer(self):
        return [0.0, 0]

    def __call__(self, buffer, x):
        if x is not None and x == x:
            buffer[0] += x
            buffer[1] += 1

    def merge(self, buffer, other):
        buffer[0] += other[0]
        buffer[1] += other[1]

    def getvalue(self, buffer):
        return buffer[0] / buffer[1] if buffer[1] else None


@_r.add("SELECT event_type, round(avg(value), 9) AS mean FROM events GROUP BY event_type")
def udf_aggregate(spark, d):
    """A Python aggregator with partial buffers."""
    out = U.aggregate(table(spark, d, "events"), ["event_type"], _Mean, ["value"], "double", "mean")
    return out.withColumn("mean", F.round("mean", 9))


@_r.add("""
SELECT user_id, count(*) AS runs FROM (SELECT user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
WHERE p IS NULL OR p <> event_type GROUP BY user_id""")
def udf_groups(spark, d):
    """A function over each group's rows in order."""

    def runs(key, rows):
        n, last = 0, None
        for r in rows:
            n, last = n + (r.event_type != last), r.event_type
        yield int(key[0]), n

    return U.apply_groups(table(spark, d, "events").select("user_id", "event_type", "ts", "event_id"), ["user_id"], runs, "user_id long, runs long", ["ts", "event_id"])


@_r.add(r"""
SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word FROM benchmark) GROUP BY word""")
def map_reduce_words(spark, d):
    """Word counts by mapper, combiner and reducer."""
    mapper = lambda r: [(w.decode(), 1) for w in r.text.encode().split()]
    add = lambda key, rows: [(key[0], sum(int(r.n) for r in rows))]
    return U.map_reduce(table(spark, d, "benchmark"), mapper, "word string, n long", ["word"], add, "word string, n long", combiner=add)


@_r.add("SELECT count(DISTINCT l_partkey) AS n, true AS close FROM lineitem")
def sketch_distinct(spark, d):
    """A distinct count, and whether its sketch is within five hundredths of it."""
    t = table(spark, d, "lineitem").agg(K.hll_count(F.col("l_partkey"), 0.01).alias("e"), F.count_distinct("l_partkey").alias("n"))
    return t.select("n", (F.abs(F.col("e") - F.col("n")) <= 0.05 * F.col("n")).alias("close"))


@_r.add("SELECT count(DISTINCT l_partkey) AS n, true AS close FROM lineitem")
def sketch_merged(spark, d):
    """Sketches per group, merged, beside the distinct count of all groups."""
    parts = table(spark, d, "lineitem").groupBy("l_returnflag").agg(K.hll_sketch(F.col("l_partkey")).alias("s"))
    n = table(spark, d, "lineitem").agg(F.count_distinct("l_partkey").alias("n"))
    return parts.agg(K.hll_merge(F.col("s")).alias("e")).crossJoin(n).select("n", (F.abs(F.col("e") - F.col("n")) <= 0.05 * F.col("n")).alias("close"))


@_r.add("SELECT c_custkey, true AS kept FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def bloom_members(spark, d):
    """Every true member and whether a Bloom filter keeps it."""
    keys = table(spark, d, "orders").where("o_totalprice > 300000")
    customers = table(spark, d, "customer").select("c_custkey")
    got = K.bloom_filter(customers, "c_custkey", keys, "o_custkey", 3000, 0.01).select("c_custkey", F.lit(True).alias("kept"))
    true = customers.join(keys, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    return true.join(got, "c_custkey", "left").select("c_custkey", F.coalesce("kept", F.lit(False)).alias("kept"))


@_r.add("SELECT true AS few FROM (SELECT 1)")
def bloom_false_positives(spark, d):
    """Under a fiftieth of the keys that a filter never saw pass it."""
    keys = checkpointed(table(spark, d, "lineitem").select("l_orderkey").distinct())
    strange = keys.select((-F.col("l_orderkey")).alias("k"))
    n = keys.agg(F.count("*").alias("n")).first()[0]
    kept = K.bloom_filter(strange, "k", keys, "l_orderkey", n, 0.01).agg(F.count("*").alias("kept"))
    return kept.select((F.col("kept") <= 0.02 * n).alias("few"))


def _round_trip(form: str, **options):
    def run(spark, d):
        df = table(spark, d, "nation")
        path = f"{_work(spark)}/t"
        T.write(df, path, form, **options)
        return T.read(spark, path, form, schema=df.schema, columns=["n_nationkey", "n_name", "n_regionkey"], where=F.col("n_nationkey") > 3, **options)

    return run


for _form in ("csv", "json", "parquet", "orc"):
    _f = _round_trip(_form, **({"header": "true"} if _form == "csv" else {}))
    _f.__name__, _f.__doc__ = f"round_trip_{_form}", f"Written and read as {_form}, with pruned columns and a pushed filter."
    _r.add("SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_nationkey > 3")(_f)


@_r.add("SELECT CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END AS price, o_orderkey, o_orderstatus FROM orders")
def partition_overwrite(spark, d):
    """Overwriting replaces only the partitions that come."""
    df = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), "o_orderstatus")
    path = f"{_work(spark)}/t"
    T.write(df, path, partition_by=["o_orderstatus"])
    T.write(df.where("o_orderstatus = 'F'").withColumn("price", F.lit(0.0)), path, mode="overwrite", partition_by=["o_orderstatus"])
    return T.read(spark, path, columns=["price", "o_orderkey", "o_orderstatus"])


@_r.add("SELECT o_orderkey FROM orders WHERE strftime(o_orderdate, '%Y') = (SELECT max(strftime(o_orderdate, '%Y')) FROM orders)")
def partition_latest(spark, d):
    """Rows of the greatest partition of a generated label."""
    path = f"{_work(spark)}/t"
    T.write(table(spark, d, "orders").select("o_orderkey", T.trunc_time(F.col("o_orderdate"), "year").alias("y")), path, partition_by=["y"])
    last = T.max_partition(spark, path, "y")
    return T.read(spark, path, where=F.col("y") == last, columns=["o_orderkey"])


@_r.add("""
WITH c AS (SELECT c_custkey AS k, c_acctbal + 1 AS b, CASE WHEN c_custkey % 10 = 0 THEN 'delete' ELSE 'put' END AS op FROM customer WHERE c_custkey % 2 = 0)
SELECT c_custkey AS k, c_acctbal AS b FROM customer WHERE c_custkey NOT IN (SELECT k FROM c) UNION ALL SELECT k, b FROM c WHERE op <> 'delete'""")
def upsert_by_key(spark, d):
    """Keyed puts and deletes; the last version counts."""
    base = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("b"))
    even = base.where("k % 2 = 0")
    old = even.select("k", (F.col("b") * 0).alias("b"), F.lit(1).alias("v"), F.lit("put").alias("op"))
    new = even.select("k", (F.col("b") + 1).alias("b"), F.lit(2).alias("v"), F.when(F.col("k") % 10 == 0, "delete").otherwise("put").alias("op"))
    return T.upsert(base, old.unionByName(new), ["k"], "v", "op")


@_r.add("SELECT event_id FROM events WHERE event_id > 100 AND event_id <= 200")
def incremental_read(spark, d):
    """Rows between two versions."""
    return T.incremental(table(spark, d, "events"), "event_id", 100, 200).select("event_id")


@_r.add("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderstatus")
def sql_statement(spark, d):
    """An SQL statement with a parameter and a setting."""
    view = T.temporary_view(table(spark, d, "orders"))
    sql = f"SELECT o_orderstatus, count(*) AS n FROM {view} WHERE o_totalprice > :least GROUP BY o_orderstatus"
    return T.statement(spark, sql, {"spark.sql.shuffle.partitions": "4"}, {"least": 100000})


@_r.add("SELECT o_orderstatus, o_orderkey FROM orders WHERE o_totalprice > 200000")
def sql_to_table(spark, d):
    """A statement's result written with dynamic partitions and read again."""
    view, path = T.temporary_view(table(spark, d, "orders")), f"{_work(spark)}/t"
    T.write_query(spark, f"SELECT o_orderkey, o_orderstatus FROM {view} WHERE o_totalprice > 200000", path, partition_by=["o_orderstatus"])
    return T.read(spark, path, columns=["o_orderstatus", "o_orderkey"])


@_r.add("SELECT n_nationkey, n_name FROM nation")
def compact_files(spark, d):
    """Many small files rewritten as few."""
    folder = _work(spark)
    T.write(table(spark, d, "nation").select("n_nationkey", "n_name").repartition(8), f"{folder}/many")
    T.compact(spark, f"{folder}/many", f"{folder}/few")
    return T.read(spark, f"{folder}/few")


@_r.add("SELECT event_type, CAST(row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS INTEGER) AS version, event_id FROM events")
def versions_per_key(spark, d):
    """Version numbers per key."""
    return T.running_version(table(spark, d, "events").select("event_type", "event_id"), ["event_type"], ["event_id"])


@_r.add("SELECT user_id, arg_max(event_id, event_id) AS event_id FROM events GROUP BY user_id")
def latest_per_key(spark, d):
    """The row of greatest version per key."""
    return T.latest(table(spark, d, "events").select("user_id", "event_id"), ["user_id"], "event_id")


@_r.add()
def sketch_top(spark, d):
    """Frequent items from a bounded sketch."""
    return K.top_k(table(spark, d, "events"), "event_type", 3)


@_r.add(r"""
SELECT lang, count(DISTINCT word) AS n, true AS close FROM (SELECT lang, unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY lang""")
def sketch_tokens(spark, d):
    """Distinct tokens per language, and whether their sketch is within five hundredths of them."""
    docs = table(spark, d, "documents")
    told = docs.select("lang", F.explode(F.split("text", " ")).alias("word")).groupBy("lang").agg(F.count_distinct("word").alias("n"))
    met = told.alias("t").join(K.hll_tokens(docs, "text", " ", ["lang"]).alias("s"), F.col("t.lang").eqNullSafe(F.col("s.lang")))
    return met.select("t.lang", "n", (F.abs(F.col("hll_count") - F.col("n")) <= 0.05 * F.col("n")).alias("close"))


def _stream(spark, d):
    df = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    folder = _work(spark)
    df.repartition(3).write.parquet(f"{folder}/in")
    return V.source(spark, f"{folder}/in", df.schema), folder


def _windowed(spark, d, make):
    """A stream's complete result, through files."""
    stream, folder = _stream(spark, d)
    V.run(make(stream), f"{folder}/state", mode="complete", each=V.kept_whole(f"{folder}/out"))
    return spark.read.parquet(f"{folder}/out")


@_r.add("SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2")
def stream_tumbling(spark, d):
    """Daily windows of a stream."""
    out = _windowed(spark, d, lambda s: V.tumbling(s, "ts", "1 day", ["event_type"], F.count("*").alias("n"), F.sum("value").alias("total")))
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 6).alias("total"))


@_r.add("""
SELECT start, count(*) AS n FROM (SELECT unnest([date_trunc('day', ts) + (CASE WHEN hour(ts) < 12 THEN INTERVAL 0 HOUR ELSE INTERVAL 12 HOUR END),
  date_trunc('day', ts) + (CASE WHEN hour(ts) < 12 THEN INTERVAL 0 HOUR ELSE INTERVAL 12 HOUR END) - INTERVAL 12 HOUR])::TIMESTAMP AS start FROM events) GROUP BY start""")
def stream_sliding(spark, d):
    """Windows of a day every twelve hours."""
    out = _windowed(spark, d, lambda s: V.sliding(s, "ts", "24 hours", "12 hours", [], F.count("*").alias("n")))
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "n")


@_r.add("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM g)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, sid""")
def stream_sessions(spark, d):
    """Sessions of a user with gaps under six hours."""
    out = _windowed(spark, d, lambda s: V.sessions(s, "ts", "6 hours", ["user_id"], F.count("*").alias("n")))
    return out.select("user_id", F.col("session_window.start").cast("timestamp_ntz").alias("start"), "n")


@_r.add("SELECT event_id FROM events")
def stream_deduplicated(spark, d):
    """Rows sent twice come out once."""
    stream, folder = _stream(spark, d)
    V.run(V.deduplicated(stream.union(stream), ["event_id"], "ts", "40 days"), f"{folder}/state", f"{folder}/out")
    return spark.read.parquet(f"{folder}/out").select("event_id")


@_r.add("SELECT user_id, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY user_id")
def stream_state(spark, d):
    """Running totals per user from keyed state; the last of each."""
    stream, folder = _stream(spark, d)
    keep = lambda batch, i: batch.withColumn("i", F.lit(i)).write.mode("append").parquet(f"{folder}/out")
    V.run(V.running_totals(stream, "user_id", "value"), f"{folder}/state", mode="update", each=keep)
    return T.latest(spark.read.parquet(f"{folder}/out"), ["user_id"], "i").select("user_id", "n", F.round("total", 6).alias("total"))


@_r.add("""
SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 1 THEN c_acctbal + 100 ELSE c_acctbal END AS b FROM customer WHERE c_custkey % 6 <> 0""")
def stream_upsert(spark, d):
    """A stream of keyed changes, out of order, merged into a table batch by batch."""
    base = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("b"))
    change = lambda rows, v, op, b: rows.select("k", b.alias("b"), F.lit(v).alias("v"), F.lit(op).alias("op"))
    b = F.col("b")
    changes = change(base.where("k % 4 = 1"), 2, "put", b + 100).union(change(base.where("k % 4 = 1"), 1, "put", b * 0)).union(change(base.where("k % 6 = 0"), 3, "delete", b))
    folder = _work(spark)
    changes.repartition(3, "k").write.parquet(f"{folder}/in")  # all changes of a key come in one batch
    stream = V.source(spark, f"{folder}/in", changes.schema)
    V.run(stream, f"{folder}/state", each=V.upserted(base, f"{folder}/table", ["k"], "v", "op"))
    return spark.read.parquet(f"{folder}/table/3")


@_r.add("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def arrow_batches(spark, d):
    """A small table brought to the driver as Arrow batches, and made a table again."""
    df = table(spark, d, "nation")
    return spark.createDataFrame(pa.Table.from_batches(list(T.batches(df))))


@_r.add("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def read_partition(spark, d):
    """Rows of a named partition."""
    path = f"{_work(spark)}/t"
    T.write(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), path, partition_by=["o_orderstatus", "o_orderpriority"])
    return T.read(spark, path, partition="o_orderstatus=F,o_orderpriority=1-URGENT", columns=["o_orderkey", "o_orderpriority"])


@_r.add("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'")
def persist_named(spark, d):
    """A catalog table of a partition, read by name."""
    name, path = f"t_{uuid.uuid4().hex}", f"{_work(spark)}/t"
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus").where("o_orderstatus IN ('O', 'F')")
    T.persist(rows, name, {"ds": "a"}, ["o_orderstatus"], path=path)
    return T.read_named(spark, name, where=(F.col("ds") == "a") & (F.col("o_orderstatus") == "O"), columns=["o_orderkey", "o_orderstatus"])


@_r.add("SELECT CAST(s_name AS VARCHAR) AS name, CAST(s_suppkey AS DOUBLE) AS key, CAST(NULL AS INTEGER) AS missing FROM supplier")
def aligned_columns(spark, d):
    """Columns put into a table's order and types, a missing one NULL."""
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").alias("KEY"), F.col("s_name").alias("name"))
    return T.aligned(rows, [("name", "string"), ("key", "double"), ("missing", "int")])


@_r.add("SELECT 'nation' AS name, count(*) AS n FROM nation UNION ALL SELECT 'region', count(*) FROM region UNION ALL SELECT 'orders', count(*) FROM orders")
def actions_together(spark, d):
    """Several actions run side by side."""
    names = ("nation", "region", "orders")
    counts = T.together(*[lambda n=n: table(spark, d, n).count() for n in names])
    return spark.createDataFrame(list(zip(names, counts)), "name string, n long")


@_r.add("SELECT true AS known FROM (SELECT 1)")
def statement_cost(spark, d):
    """Whether the optimizer's estimate of a scan is a positive size that a narrower scan undercuts."""
    whole, part = T.cost(table(spark, d, "orders")), T.cost(table(spark, d, "orders").select("o_orderkey"))
    return spark.createDataFrame([(0 < part["bytes"] < whole["bytes"],)], "known boolean")


@U.output(["letter", "place"], ["string", "int"])
def _letters(row):
    return [(c, i) for i, c in enumerate(row.r_name) if c == "A"]


@_r.add("SELECT 'A' AS letter, CAST(i - 1 AS INTEGER) AS place, r_regionkey FROM (SELECT r_regionkey, r_name, unnest(range(1, length(r_name) + 1)) AS i FROM region) WHERE r_name[i] = 'A'")
def udf_declared_output(spark, d):
    """A row function that declares its output columns."""
    return U.apply_rows(table(spark, d, "region"), _letters, keep=["r_regionkey"])


@U.annotate("bigint -> bigint")
class _Scaled:
    """A function class with a resource."""

    def __init__(self, factor):
        self.factor = factor

    def evaluate(self, x):
        return None if x is None else x * self.factor


@_r.add("SELECT s_suppkey, s_suppkey * 7 AS scaled FROM supplier")
def udf_annotated(spark, d):
    """A function class with declared types and a resource."""
    return table(spark, d, "supplier").select("s_suppkey", U.map_column(F.col("s_suppkey"), _Scaled, resources=(7,)).alias("scaled"))
