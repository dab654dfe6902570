"""Distinct-count sketches and Bloom filters, on Spark's own sketch functions."""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _lg(error_rate: float) -> int:
    """Log2 of the registers for a relative error (about 0.83 / sqrt(registers))."""
    return min(21, max(4, math.ceil(2 * math.log2(0.83 / error_rate))))


def hll_count(c: Column, error_rate: float = 0.01) -> Column:
    """Estimated distinct values of an aggregate column."""
    return F.hll_sketch_estimate(F.hll_sketch_agg(c.cast("string"), F.lit(_lg(error_rate))))


def hll_tokens(df: DataFrame, col: str, splitter: str, keys: list[str] | None = None, error_rate: float = 0.01) -> DataFrame:
    """Estimated distinct tokens of a text column, per keys."""
    tokens = df.select(*(keys or []), F.explode(F.split(F.col(col), re.escape(splitter))).alias("_t"))
    return tokens.groupBy(*(keys or [])).agg(hll_count(F.col("_t"), error_rate).alias("hll_count"))


def hll_sketch(c: Column, error_rate: float = 0.01) -> Column:
    """The sketch itself, to be stored and merged."""
    return F.hll_sketch_agg(c.cast("string"), F.lit(_lg(error_rate)))


def hll_merge(sketch: Column) -> Column:
    """Estimate over the union of stored sketches."""
    return F.hll_sketch_estimate(F.hll_union_agg(sketch))


#: Bits of a block of a Bloom filter, and how much larger a blocked filter is than a plain one of the same error rate.
BLOCK_BITS, ROOM = 512, 1.3

#: Bits of a hash that tell a place in a block.
PLACE_BITS = 9


def bloom_bits(capacity: int, error_rate: float) -> tuple[int, int]:
    """Blocks and hashes of a filter for so many keys at a false positive rate."""
    bits = max(1.0, -capacity * math.log(error_rate) / math.log(2) ** 2)
    return max(1, math.ceil(ROOM * bits / BLOCK_BITS)), max(1, round(-math.log2(error_rate)))


def bloom_filter(df: DataFrame, on: str, keys: DataFrame, column: str, capacity: int = 3000, error_rate: float = 0.01) -> DataFrame:
    """Rows whose key may be among keys' column: all true ones and a few false ones.

    A key's hashes all lie in one block of BLOCK_BITS bits, so the filter is a table of
    blocks (eight words each), aggregated from the keys and joined once. It may have any
    size, as Spark broadcasts it only if it is small; a NULL key goes. A key is hashed
    once for its block and once for each seven of its bits (nine bits of a hash tell a
    place), and only its places, not its words, are shuffled.
    """
    blocks, hashes = bloom_bits(capacity, error_rate)
    each = 63 // PLACE_BITS
    seeds = range(-(-hashes // each))
    parts = [f"_h{i}" for i in seeds]

    def hashed(df: DataFrame, c: Column, *kept: str) -> DataFrame:
        text = c.cast("string")
        own = [F.xxhash64(F.lit(i), text).alias(f"_h{i}") for i in seeds]
        return df.where(c.isNotNull()).select(*kept, F.pmod(F.xxhash64(F.lit(-1), text), F.lit(blocks)).alias("_block"), *own)

    def words(df: DataFrame, name: str) -> DataFrame:
        """The bits of a key in each of the block's words, instead of its hashes."""
        at = [F.shiftright(f"_h{i // each}", PLACE_BITS * (i % each)).bitwiseAND(F.lit(BLOCK_BITS - 1).cast("long")).alias(f"_p{i}") for i in range(hashes)]
        placed = df.select(*[c for c in df.columns if c not in parts], *at)
        bit = lambda p: F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63).cast("long")).cast("int"))
        every = [F.col(f"_p{i}") for i in range(hashes)]
        out = [reduce(lambda x, y: x.bitwiseOR(y), [F.when(F.shiftright(p, 6) == w, bit(p)).otherwise(F.lit(0).cast("long")) for p in every]).alias(f"{name}{w}") for w in range(BLOCK_BITS // 64)]
        return placed.select(*[c for c in df.columns if c not in parts], *out)

    made = words(hashed(keys, F.col(column)), "_w")
    held = made.groupBy("_block").agg(*[F.bit_or(c).alias(c) for c in made.columns[1:]])
    probe = hashed(df, F.col(on), *df.columns)
    met = words(probe.join(held, "_block"), "_q")
    inside = reduce(lambda x, y: x & y, [F.col(f"_w{i}").bitwiseAND(F.col(f"_q{i}")) == F.col(f"_q{i}") for i in range(BLOCK_BITS // 64)])
    return met.where(inside).select(*df.columns)


def top_k(df: DataFrame, col: str, k: int) -> DataFrame:
    """Approximate most frequent items from a bounded sketch per task."""
    return df.agg(F.call_function("approx_top_k", F.col(col), F.lit(k), F.lit(max(1000, 10 * k))).alias("t")).select(F.inline("t"))
