"""Aggregates with the conventions of statistics packages.

All are built from Spark's own aggregates, so they combine before the shuffle.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(c: Column, kind: str = "number", order: Column | None = None) -> Column:
    """Sum; of strings their concatenation (in order, if given), of booleans the count of true."""
    if kind == "string":
        return joined(c, "", order)
    if kind == "boolean":
        return F.coalesce(F.sum(c.cast("long")), F.lit(0).cast("long"))
    return F.sum(c)


def any_(c: Column) -> Column:
    """Some row true; NULL counts as false."""
    return F.bool_or(F.coalesce(c, F.lit(False)))


def all_(c: Column) -> Column:
    """Every row true; NULL counts as false."""
    return F.bool_and(F.coalesce(c, F.lit(False)))


def variance(c: Column, ddof: int = 1) -> Column:
    """Variance with a correction; NULL if there are not more rows than ddof."""
    if ddof in (0, 1):
        return F.var_pop(c) if ddof == 0 else F.when(F.count(c) > 1, F.var_samp(c))
    n = F.count(c)
    return F.when(n > ddof, F.var_pop(c) * n / (n - ddof))


def deviation(c: Column, ddof: int = 1) -> Column:
    """Square root of variance."""
    return F.sqrt(variance(c, ddof))


def moment(c: Column, order: int, central: bool = False) -> Column:
    """Raw or central moment, from averages of powers."""
    raw = lambda k: F.avg(F.pow(c, F.lit(float(k)))) if k else F.lit(1.0)
    if not central:
        return raw(order)
    mean = F.avg(c)
    out = F.lit(0.0)
    for k in range(order + 1):
        out = out + F.lit(float(comb(order, k) * (-1) ** (order - k))) * raw(k) * F.pow(mean, F.lit(float(order - k)))
    return out


def skew(c: Column) -> Column:
    """Bias-corrected skewness; NULL under 3 rows."""
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def kurtosis(c: Column) -> Column:
    """Bias-corrected excess kurtosis; NULL under 4 rows."""
    n = F.count(c).cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6))


def quantile(c: Column, p, approximate: bool = False) -> Column:
    """Exact interpolated quantile, or an array of them; approximate trades exactness for bounded memory."""
    return F.percentile_approx(c, p, 10_000) if approximate else F.percentile(c, p)


def nunique(*cols: Column) -> Column:
    """Distinct tuples without NULLs."""
    return F.count_distinct(*cols)


def joined(c: Column, sep: str = "", order: Column | None = None, na_rep: str | None = None) -> Column:
    """Strings joined; NULLs skipped or as na_rep. With order, in that order."""
    value = c if na_rep is None else F.coalesce(c, F.lit(na_rep))
    if order is None:
        return F.listagg(value, sep)
    pairs = F.sort_array(F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v")))))
    return F.array_join(F.transform(pairs, lambda x: x["v"]), sep)


def to_list(c: Column, unique: bool = False) -> Column:
    """Values as an array, or the set of them."""
    return F.collect_set(c) if unique else F.collect_list(c)


def distinct_sum(c: Column) -> Column:
    """Sum of distinct values."""
    return F.sum_distinct(c)
