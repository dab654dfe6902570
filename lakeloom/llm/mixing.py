"""Mixing sources to target weights by Poisson replication.

Each source has a mean repetition rate: target share times rows wanted over rows it
has. A row's count inverts the Poisson distribution of that mean at a uniform number
hashed from the seed and the row's id, so counts need no state, no second pass and
come out alike on any partitioning. Rows are exploded by count and dealt over all
partitions by a hash of (seed, id, copy), in whose order each partition is sorted.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import let, stored

#: Seed of all draws; the exponent of source sizes in the default targets.
SEED, EXPONENT = 20240, 0.5

#: Largest mean of one draw; a larger mean is the sum of several draws.
STEP = 256.0


def sizes(docs: DataFrame, source_col: str = "source") -> DataFrame:
    """(source, n): rows per source; a null source is a source of its own."""
    return docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))


def tempered(counts: DataFrame, exponent: float = EXPONENT) -> DataFrame:
    """(source, weight): weights in proportion to n ** exponent."""
    return counts.select("source", F.pow(F.col("n").cast("double"), F.lit(exponent)).alias("weight"))


def rates(counts: DataFrame, targets: DataFrame, wanted: float | None = None) -> DataFrame:
    """(source, rate): mean copies per row; wanted rows in all, by default as many as there are.

    Weights are normalised over the sources that have rows. A source without a
    target, or with a null or negative weight, gets rate 0; so does every source if
    the weights sum to 0.
    """
    t = targets.groupBy(F.col("source").alias("_s")).agg(F.sum("weight").alias("weight"))
    held = counts.join(t, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        "source", "n", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight")
    )
    whole = held.agg(F.sum("weight").alias("_w"), F.sum("n").alias("_n"))
    rows = F.col("_n").cast("double") if wanted is None else F.lit(float(wanted))
    return held.crossJoin(F.broadcast(whole)).select(  # one row of totals
        "source", F.coalesce(F.try_divide(F.col("weight") * rows, F.col("_w") * F.col("n")), F.lit(0.0)).alias("rate")
    )


def _curve(rate: Column) -> Column:
    """Distribution function of a Poisson mean at 0, 1, 2, .. until it is 1 to double precision."""
    top = (rate + 12 * F.sqrt(rate) + 40).cast("int")
    first = F.exp(-rate)
    return F.aggregate(
        F.sequence(F.lit(1), top),
        F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("all")),
        lambda acc, k: let(
            acc["p"] * rate / k,
            lambda p: F.struct(p.alias("p"), (acc["c"] + p).alias("c"), F.concat(acc["all"], F.array(acc["c"] + p)).alias("all")),
        ),
    )["all"]


def uniform(seed: int, key: Column, draw: Column) -> Column:
    """A number in [0, 1) with 52 bits from the MD5 of seed, key and draw."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null")), draw.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def replicate(docs: DataFrame, mean: DataFrame, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """docs with copy (1, 2, ..), each row as often as its draw says, in a global shuffle.

    mean: (source, rate). Rows of a source without a rate are left out, as are rows
    whose count is 0. Rows that repeat an id draw the same count. A column named
    copy in docs is replaced.
    """
    draws = F.greatest(F.ceil(F.col("rate") / STEP), F.lit(1)).cast("int")
    curves = mean.where("rate > 0").select(F.col("source").alias("_source"), draws.alias("_draws"), _curve(F.col("rate") / draws).alias("_curve"))
    cols = [c for c in docs.columns if c != "copy"]
    # the curves are one row per source; Spark broadcasts them only under its size limit
    joined = docs.join(curves, F.col(source_col).eqNullSafe(F.col("_source")))
    count = F.aggregate(
        F.sequence(F.lit(1), F.col("_draws")),
        F.lit(0),
        lambda acc, j: acc + let(uniform(seed, F.col(id_col), j), lambda u: F.size(F.filter(F.col("_curve"), lambda c: c <= u))),
    )
    counted = joined.select(*cols, count.alias("_n")).where("_n > 0")
    copies = counted.select(*cols, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("copy"))
    place = F.xxhash64(F.lit(seed), F.col(id_col), F.col("copy"))
    return copies.withColumn("_place", place).repartition("_place").sortWithinPartitions("_place").drop("_place")


def mix(docs: DataFrame, targets: DataFrame | None = None, wanted: float | None = None, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """docs replicated to the target weights (by default tempered source sizes).

    Sizes and rates are written tables of one row per source, so docs are read twice.
    """
    counts = stored(sizes(docs, source_col), "sizes")
    mean = stored(rates(counts, tempered(counts) if targets is None else targets, wanted), "rates")
    return replicate(docs, mean, seed, id_col, source_col)


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents mixed to the square root of their sources' sizes."""
    from lakeloom.session import table

    return mix(table(spark, sf_dir, "documents"))


ORACLE = """
WITH s AS (SELECT source, count(*) AS n, sqrt(CAST(count(*) AS DOUBLE)) AS w FROM documents GROUP BY source),
r AS (SELECT source, w * (SELECT sum(n) FROM s) / ((SELECT sum(w) FROM s) * n) AS rate FROM s),
k AS (SELECT source, rate, unnest(range(0, CAST(floor(rate + 12 * sqrt(rate) + 40) AS BIGINT) + 1)) AS k FROM r),
c AS (SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf FROM k),
u AS (SELECT *, CAST('0x' || substr(md5('20240:' || doc_id || ':1'), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM documents),
n AS (SELECT u.doc_id, count(*) AS n FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source AND c.cdf <= u.u GROUP BY u.doc_id)
SELECT doc_id, text, lang, source, n_chars, CAST(unnest(range(1, n + 1)) AS INTEGER) AS copy
FROM documents JOIN n USING (doc_id)"""
