"""Streams of events: ingestion, windows with late data, state, keyed updates.

Each function takes a streaming (or a batch) DataFrame and returns one; run() starts
a query that ends when the input is read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lakeloom.sources.tables import upsert


def source(spark: SparkSession, path: str, schema, files: int = 1, form: str = "parquet") -> DataFrame:
    """A file source that takes a few new files per batch."""
    return spark.readStream.format(form).schema(schema).option("maxFilesPerTrigger", files).load(path)


def tumbling(df: DataFrame, ts: str, width: str, keys: list[str], *aggs, late: str | None = None) -> DataFrame:
    """Aggregates per window and keys; late is how long a window waits for late rows."""
    held = df.withWatermark(ts, late) if late else df
    return held.groupBy(F.window(ts, width), *keys).agg(*aggs)


def sliding(df: DataFrame, ts: str, width: str, slide: str, keys: list[str], *aggs, late: str | None = None) -> DataFrame:
    """Aggregates per overlapping window and keys."""
    held = df.withWatermark(ts, late) if late else df
    return held.groupBy(F.window(ts, width, slide), *keys).agg(*aggs)


def sessions(df: DataFrame, ts: str, gap: str, keys: list[str], *aggs, late: str | None = None) -> DataFrame:
    """Aggregates per session: rows of a key with less than gap between neighbours."""
    held = df.withWatermark(ts, late) if late else df
    return held.groupBy(F.session_window(ts, gap), *keys).agg(*aggs)


def deduplicated(df: DataFrame, keys: list[str], ts: str, late: str) -> DataFrame:
    """The first row of each key within the watermark."""
    return df.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def running_totals(df: DataFrame, key: str, value: str) -> DataFrame:
    """Per batch and key that occurs in it, rows and total so far, from keyed state."""
    kind = df.schema[key].dataType.simpleString()

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for pdf in frames:
            n, total = n + len(pdf), total + float(pdf[value].sum())
        state.update((n, total))
        yield pd.DataFrame([(k[0], n, total)], columns=[key, "n", "total"])

    return df.select(key, value).groupBy(key).applyInPandasWithState(
        step, f"`{key}` {kind}, n long, total double", "n long, total double", "update", GroupStateTimeout.NoTimeout
    )


def kept_whole(path: str) -> Callable:
    """For run(each=..) in complete mode: each batch's result takes the place of the one before, in files."""
    return lambda batch, i: batch.write.mode("overwrite").parquet(path)


def upserted(base: DataFrame, path: str, keys: list[str], version: str, op: str | None = None) -> Callable:
    """For run(each=..): each batch of changes is merged into the table, under path/number; path/0 is base.

    Number n holds all batches up to n - 1, so a batch that is repeated after a failure
    is merged into the same table as before.
    """
    base.write.mode("overwrite").parquet(f"{path}/0")

    def each(batch: DataFrame, i: int) -> None:
        spark = batch.sparkSession
        upsert(spark.read.parquet(f"{path}/{i}"), batch, keys, version, op).write.mode("overwrite").parquet(f"{path}/{i + 1}")

    return each


def run(df: DataFrame, checkpoint: str, path: str | None = None, mode: str = "append", each: Callable | None = None, name: str | None = None) -> None:
    """Runs the stream over what there is: into files, a function of (batch, number), or a memory table."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if each is not None:
        query = writer.foreachBatch(each).start()
    elif path is not None:
        query = writer.format("parquet").option("path", path).start()
    else:
        query = writer.format("memory").queryName(name).start()
    query.awaitTermination()
