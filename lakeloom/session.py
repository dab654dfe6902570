"""Session defaults shared by the tests, the bench and ad-hoc use."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def local_session(app: str = "lakeloom", cores: int | None = None, memory: str = "8g") -> SparkSession:
    """A local session: UTC, ANSI on, AQE on, few shuffle partitions."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a local one of its own.

    A local one is made only where the master is local; elsewhere a missing setting is
    an error, as other machines could not read such a folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    held = shared or spark.sparkContext.getCheckpointDir()
    if not held:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="lakeloom-"))
        held = spark.sparkContext.getCheckpointDir()
    return held.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """df.checkpoint(), with the folder of shared_dir() where the session has none yet."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


#: Rows that one task of a graph's steps holds, about.
TASK_ROWS = 1_000_000


def tasks_for(df: DataFrame, times: int = 1) -> int:
    """Tasks for `times` the rows of df, so that what one task holds doesn't grow with them; at least the session's shuffle partitions."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-times * df.count() // TASK_ROWS))


def placed(df: DataFrame, tasks: int, key: str) -> DataFrame:
    """df checkpointed with its rows dealt to tasks by key and sorted by it, so that joins and groupings by it need no shuffle.

    A checkpoint remembers that only of a plan that is not adaptive, so adaptive execution
    is off meanwhile; all shuffles of df have that number of tasks as well.
    """
    conf = df.sparkSession.conf
    names = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    before = [conf.get(c) for c in names]
    try:
        for c, value in zip(names, ("false", str(tasks))):
            conf.set(c, value)
        return checkpointed(df.repartition(tasks, key).sortWithinPartitions(key))
    finally:
        for c, value in zip(names, before):
            conf.set(c, value)


#: Most neighbours of a node in one row of listed().
LISTED = 1_000


def listed(pairs: DataFrame, tasks: int, key: str, other: str) -> DataFrame:
    """(key, other) with the distinct others of a key in arrays of at most LISTED; placed by key.

    Iterated steps then read a row for many edges. A hub's others are many rows, so that
    no row grows with the graph.
    """
    at = F.row_number().over(Window.partitionBy(key).orderBy(other))
    dealt = pairs.repartition(tasks, key).distinct().select(key, other, F.floor((at - 1) / LISTED).alias("_row"))
    return placed(dealt.groupBy(key, "_row").agg(F.collect_list(other).alias(other)).select(key, other), tasks, key)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, by name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
