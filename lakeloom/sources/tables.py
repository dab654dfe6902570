"""Reading and writing tables: formats, partitions, keyed updates, versions, upkeep."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.operators.relational import where_parts


def read(spark: SparkSession, path: str, form: str = "parquet", columns: Sequence[str] | None = None, where: Column | None = None, schema=None, limit: int | None = None, partition: str | None = None, **options) -> DataFrame:
    """A table by path and format; the columns, the filter and a partition (`a=1,b=x`) reach the scan.

    Rows have no order of their own; relational.slice_rows takes start, stop and step in one.
    """
    reader = spark.read.format(form).options(**options)
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    df = df if partition is None else where_parts(df, partition, exclude=False)
    df = df if where is None else df.where(where)
    df = df.select(*columns) if columns else df
    return df if limit is None else df.limit(limit)


def read_named(spark: SparkSession, name: str, **how) -> DataFrame:
    """A catalog table, with the choices of read()."""
    df = spark.table(name)
    df = df.where(how["where"]) if how.get("where") is not None else df
    df = df.select(*how["columns"]) if how.get("columns") else df
    return df.limit(how["limit"]) if how.get("limit") is not None else df


def batches(df: DataFrame) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches, one partition at a time at the driver."""

    def packed(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as out:
                out.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["b"])

    for row in df.mapInArrow(packed, "b binary").toLocalIterator(prefetchPartitions=True):
        yield from pa.ipc.open_stream(row["b"])


def frames(df: DataFrame) -> Iterator:
    """Rows as pandas frames, a batch each."""
    for batch in batches(df):
        yield batch.to_pandas()


def aligned(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """df in a table's column order and types; missing columns are NULL, others an error."""
    unknown = {c.lower() for c in df.columns} - {n.lower() for n, _ in columns}
    if unknown:
        raise ValueError(f"columns that the table lacks: {sorted(unknown)}")
    have = {c.lower() for c in df.columns}
    return df.select(*[(F.col(n).cast(t) if n.lower() in have else F.lit(None).cast(t)).alias(n) for n, t in columns])


def write(df: DataFrame, path: str, form: str = "parquet", mode: str = "append", partition_by: Sequence[str] = (), dynamic: bool = True, **options) -> None:
    """Writes df; an overwrite with partitions replaces only those that df has, if dynamic."""
    if mode == "overwrite" and partition_by and dynamic:
        options["partitionOverwriteMode"] = "dynamic"
    writer = df.write.format(form).mode(mode).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def persist(df: DataFrame, name: str, partition: dict | None = None, partition_by: Sequence[str] = (), mode: str = "overwrite", path: str | None = None) -> None:
    """Writes df as a catalog table (its files under path, if given); partition gives constant partition values."""
    for k, v in (partition or {}).items():
        df = df.withColumn(k, F.lit(v))
    keys = [*(partition or {}), *partition_by]
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer = writer if path is None else writer.option("path", path)
    (writer.partitionBy(*keys) if keys else writer).saveAsTable(name)


def write_query(spark: SparkSession, sql: str, path: str, **how) -> None:
    """The result of a statement written like write()."""
    write(spark.sql(sql), path, **how)


def max_partition(spark: SparkSession, path: str, column: str, form: str = "parquet"):
    """The greatest value of a partition column; only the partition values are looked at."""
    return spark.read.format(form).load(path).agg(F.max(column)).first()[0]


def partitions(spark: SparkSession, path: str, columns: Sequence[str], form: str = "parquet") -> DataFrame:
    """Distinct partition values."""
    return spark.read.format(form).load(path).select(*columns).distinct()


def latest(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The row of greatest version per key: combined before the shuffle, so a hot key is one row per task."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_r"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_r.`{c}`").alias(c) for c in df.columns])


def upsert(base: DataFrame, changes: DataFrame, keys: Sequence[str], version: str, op: str | None = None) -> DataFrame:
    """base with keyed changes: the last version of a key wins; op `delete` removes it.

    Returns the new table's rows; write them under a new path and switch readers.
    """
    last = latest(changes, keys, version)
    kept = base.join(last.select(*keys), list(keys), "left_anti")
    new = last if op is None else last.where(F.col(op) != "delete")
    return kept.unionByName(new.select(*base.columns))


def incremental(df: DataFrame, version: str, after, until=None) -> DataFrame:
    """Rows with after < version <= until."""
    out = df.where(F.col(version) > F.lit(after))
    return out if until is None else out.where(F.col(version) <= F.lit(until))


def trunc_time(c: Column, part: str) -> Column:
    """A partition label from a time: year, month, day or hour."""
    return F.date_format(F.date_trunc(part, c), {"year": "yyyy", "month": "yyyy-MM", "day": "yyyy-MM-dd", "hour": "yyyy-MM-dd HH:00:00"}[part])


def compact(spark: SparkSession, path: str, out: str, form: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Rewrites a table with fewer, evenly sized files."""
    df = spark.read.format(form).load(path)
    hinted = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    write(hinted, out, form, "overwrite", partition_by, dynamic=False)


def together(*actions, n: int = 4) -> list:
    """Runs several actions (functions without arguments) from a few driver threads; results in order."""
    with ThreadPoolExecutor(n) as pool:
        return [f.result() for f in [pool.submit(a) for a in actions]]


def statement(spark: SparkSession, sql: str, hints: dict | None = None, args: dict | None = None) -> DataFrame:
    """An SQL statement with parameters, under settings that hold while it is planned."""
    before = {k: spark.conf.get(k, None) for k in hints or {}}
    try:
        for k, v in (hints or {}).items():
            spark.conf.set(k, v)
        return spark.sql(sql, args=args)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cost(df: DataFrame) -> dict:
    """The optimizer's estimate of a result: bytes, and rows where known."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    rows = stats.rowCount()
    return {"bytes": int(str(stats.sizeInBytes())), "rows": int(str(rows.get())) if rows.isDefined() else None}


def temporary_view(df: DataFrame) -> str:
    """df under a fresh view name of this session."""
    name = f"t_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    return name


def running_version(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "version") -> DataFrame:
    """df with a version number per key in the given order."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
