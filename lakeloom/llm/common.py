"""Helpers shared by the corpus operators: work tables, byte tokens, hashes."""

from __future__ import annotations

import atexit
import hashlib
import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import shared_dir

#: The six ASCII separators of a word.
BLANKS = " \t\n\x0b\x0c\r"

#: Java / RE2 pattern of a word between those separators.
WORD = r"[^\x20\x09-\x0D]+"


def _delete(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  the session may have ended already
        pass


#: Paths of work tables in the order in which they were made.
_MADE: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the process ends."""
    path = f"{shared_dir(spark)}/lakeloom/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    atexit.register(_delete, spark, path)
    return path


@contextmanager
def scratch(spark: SparkSession):
    """Gives a function that removes the work tables made inside but for the last one, the result that was stored()."""
    begun = len(_MADE)

    def trim() -> None:
        for path in _MADE[begun:-1]:
            _delete(spark, path)
        del _MADE[begun:-1]

    yield trim
    trim()


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a work table that no later step reads."""
    _delete(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as a work table and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with free_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of a bucket of a work table (as stored, estimated), and Spark's limit of their number.
BUCKET_BYTES, BUCKETS = 128 << 20, 100_000
#: What Spark gives as the size of a table that it doesn't know is over this.
UNKNOWN_BYTES = 1 << 60


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """df as a work table bucketed by key: one shuffle now, and none of it in later joins on key.

    There are at least as many buckets as shuffle partitions, so that the other side of
    such a join is dealt to them and not they anew.
    """
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    size = sum(x for x in sizes if x < UNKNOWN_BYTES)  # of the tables behind df
    n = min(BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES))
    path, table = new_path(spark, name), f"{name}_{uuid.uuid4().hex}"
    with free_shuffles(spark):
        df.repartition(n, key).write.format("parquet").option("path", path).bucketBy(n, key).saveAsTable(table)
    atexit.register(_forget, spark, table)
    return spark.table(table)


def _forget(spark: SparkSession, table: str) -> None:
    try:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    except Exception:  # noqa: BLE001  the session may have ended already
        pass


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo modulus; null without a key."""
    return F.crc32(F.col(key).cast("string")) % modulus


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """Whether a row's fold is that one; a row without a key, from which nothing learns, is held out too."""
    return F.coalesce(fold(key, modulus) == remainder, F.lit(True))


#: Odd multipliers: of runs of word hashes, and seeds of the two word hashes.
_B1, _B2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F

#: Bytes of a word up to which it is hashed eight bytes at a time; longer ones go through BLAKE2b.
_SHORT = 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, elementwise."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; the longest asked for up to 4M is kept."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        out = np.full(max(n, 1), base, dtype=np.uint64)
        out[0] = 1
        held = np.multiply.accumulate(out)
        if n <= 1 << 22:
            _POWERS[base] = held
    return held[:n]


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string or binary array; null counts as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[off[0] : off[-1]], off - off[0]


def word_bounds(text: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all words of a batch, and words before each document.

    is_word: for each of the 256 bytes, whether it belongs to a word. Words end at
    a document's end.
    """
    inside = np.zeros(len(text) + 1, bool)
    np.take(is_word, text, out=inside[:-1])
    edge = inside.copy()
    edge[1:] = inside[1:] != inside[:-1]
    at = off[1:-1][off[1:-1] < len(text)]
    joined = at[(at > 0) & inside[at] & inside[np.maximum(at - 1, 0)]]
    edges = np.flatnonzero(edge)
    if len(joined):
        edges = np.sort(np.concatenate([edges, np.repeat(np.unique(joined), 2)]))
    starts, ends = edges[0::2], edges[1::2]
    return starts, ends, np.searchsorted(starts, off)


def blank_table() -> np.ndarray:
    """Which bytes belong to words between ASCII blanks."""
    t = np.ones(256, bool)
    t[[ord(c) for c in BLANKS]] = False
    return t


#: What keeps the first k bytes of eight.
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def word_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, second: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes, alike in every batch; second gives another, independent one.

    Every eight bytes pass a mixing step that has an inverse, so words of up to eight
    bytes and the same length never collide; words over _SHORT bytes take a
    cryptographic hash. Together the two are a hash of 128 bits.
    """
    seed = _B2 if second else _B1
    size = ends - starts
    out = mix(size.astype(np.uint64) * np.uint64(_B1) + np.uint64(seed))
    held = np.concatenate([text, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(text) + 1, "<u8", held, strides=(1,))  # the eight bytes from each place
    at = np.flatnonzero(size <= _SHORT)
    for k in range(0, _SHORT, 8):
        if len(at) == len(out):
            out = mix(out ^ (eight[starts + k] & _KEEP[np.minimum(size - k, 8)]))
        elif len(at):
            out[at] = mix(out[at] ^ (eight[starts[at] + k] & _KEEP[np.minimum(size[at] - k, 8)]))
        at = at[size[at] > k + 8]
    for i in np.flatnonzero(size > _SHORT).tolist():
        digest = hashlib.blake2b(text[starts[i] : ends[i]].tobytes(), digest_size=16).digest()
        out[i] = int.from_bytes(digest[8 * second : 8 * second + 8], "little")
    return out


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of k word hashes; the last k-1 positions are left out."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= np.uint64(_B2)
        out += words[j : j + n]
    return mix(out)


#: Bytes of an Arrow batch between Spark and Python, whatever the number of rows.
BATCH_BYTES = 4 << 20


def in_arrow(df: DataFrame, f, schema) -> DataFrame:
    """df.mapInArrow(f, schema) with batches bounded in bytes, so that long texts don't add up.

    The bound is a setting of the session and stays; a smaller one is left alone.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = df.sparkSession.conf.get(key, None)
    if held is None or not held.isdigit() or not 0 < int(held) <= BATCH_BYTES:
        df.sparkSession.conf.set(key, str(BATCH_BYTES))
    return df.mapInArrow(f, schema)


def pieces(batches, column: int = 1, most: int = 1 << 20):
    """The batches cut between rows so that the texts of a piece take about most bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = buffers(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            stop = max(begin + 1, int(np.searchsorted(off, off[begin] + most, "right")) - 1)
            stop = min(stop, batch.num_rows)
            yield batch.slice(begin, stop - begin)
            begin = stop


class Runs:
    """Hashes of any run of words of a piece, from prefix sums over word hashes."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * powers(_B2, n), out=self.sums[1:])
        self.inverse = powers(pow(_B2, -1, 1 << 64), n + 1)

    def of(self, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hash of words[begin:stop], elementwise."""
        return mix((self.sums[stop] - self.sums[begin]) * self.inverse[begin] + (stop - begin).astype(np.uint64))


@contextmanager
def free_shuffles(spark: SparkSession):
    """While open, shuffle files go when the statement that wrote them ends."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def least_hashed(ids: DataFrame, n: int, rows: int, key: str = "id") -> DataFrame:
    """The n rows of least hash of key, of so many rows in all.

    A first cut by the hash keeps about twice n, so the final sort meets few rows
    however many tasks there are; ties go by the key.
    """
    u = F.shiftrightunsigned(F.xxhash64(key), 12)
    cut = ids if rows <= 4 * n else ids.where(u < int((1 << 52) * (2.0 * n + 100) / rows))
    return cut.orderBy(F.xxhash64(key), key).limit(n)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, per_class: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, y): up to per_class labelled rows of each class, those of least hash.

    keep: condition on the id column of labels (the learning folds). Rows without a
    label or an id are left out; an id labelled twice counts under its least label, and
    one that several documents have gives one text (that of least hash). So there are
    at most 2 * per_class rows.
    """
    known = labels.where(keep & F.col(id_col).isNotNull()).where(F.col(label).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.min(label).cast("int").alias("y"))
    size = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    picked = [least_hashed(known.where(F.col("y") == y), per_class, size.get(y, 0)) for y in (0, 1)]
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    met = texts.join(F.broadcast(picked[0].union(picked[1])), "id")  # 2 * per_class rows
    one = met.groupBy("id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("r"))
    return one.select("id", "r.text", "y")
