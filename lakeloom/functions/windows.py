"""Window functions over row frames.

frame(): PARTITION BY keys, ORDER BY, and a frame of rows. preceding and following
are row counts, or (far, near) pairs on one side; following alone starts at the
current row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def frame(keys: Sequence, order: Sequence = (), preceding: int | tuple | None = None, following: int | tuple | None = None) -> WindowSpec:
    """A window; without an order it spans the partition, with one and no frame it runs up to the row."""
    for x in (preceding, following):
        if any(v < 0 for v in ((x,) if isinstance(x, int) else x or ())):
            raise ValueError("frame bounds count rows and can't be negative")
    w = Window.partitionBy(*keys)
    if order:
        w = w.orderBy(*order)
    if isinstance(preceding, tuple):
        return w.rowsBetween(-preceding[0], -preceding[1])
    if isinstance(following, tuple):
        return w.rowsBetween(*following)
    if preceding is None and following is None:
        return w.rowsBetween(Window.unboundedPreceding, 0) if order else w
    return w.rowsBetween(-(preceding or 0), following or 0)


def cumsum(c: Column, w: WindowSpec) -> Column:
    """Running sum; of a boolean the running count of true."""
    return F.sum(c).over(w)


def cummax(c: Column, w: WindowSpec) -> Column:
    """Running maximum."""
    return F.max(c).over(w)


def cummin(c: Column, w: WindowSpec) -> Column:
    """Running minimum."""
    return F.min(c).over(w)


def cummean(c: Column, w: WindowSpec) -> Column:
    """Running mean."""
    return F.avg(c).over(w)


def cummedian(c: Column, w: WindowSpec) -> Column:
    """Running median; holds the frame's values of a row, so give it a bounded frame at scale."""
    s = F.sort_array(F.collect_list(c).over(w))
    n = F.size(s)
    mid = lambda x: F.get(x, F.floor((n - 1) / 2).cast("int")) / 2 + F.get(x, F.floor(n / 2).cast("int")) / 2
    return F.when(n > 0, mid(s))


def cumcount(c: Column, w: WindowSpec, unique: bool = False) -> Column:
    """Running count; unique counts distinct values of an unordered window."""
    return F.size(F.collect_set(c).over(w)).cast("long") if unique else F.count(c).over(w)


def cumstd(c: Column, w: WindowSpec) -> Column:
    """Running population deviation."""
    return F.stddev_pop(c).over(w)


def distinct_sum(c: Column, w: WindowSpec) -> Column:
    """Sum of the distinct values of an unordered window."""
    return F.aggregate(F.collect_set(c).over(w), F.lit(0).cast("double"), lambda a, x: a + x)


def nth_value(c: Column, n: int, w: WindowSpec, skip_nulls: bool = False) -> Column:
    """The value at a 0-based place of the frame."""
    return F.nth_value(c, n + 1, skip_nulls).over(w)


def qcut(bins: int, w: WindowSpec) -> Column:
    """Bin of equal counts, from 0."""
    return F.ntile(bins).over(w) - 1


def rank(w: WindowSpec) -> Column:
    """Rank with gaps."""
    return F.rank().over(w)


def dense_rank(w: WindowSpec) -> Column:
    """Rank without gaps."""
    return F.dense_rank().over(w)


def percent_rank(w: WindowSpec) -> Column:
    """Rank as a share."""
    return F.percent_rank().over(w)


def row_number(w: WindowSpec) -> Column:
    """Place from 1."""
    return F.row_number().over(w)


def cume_dist(w: WindowSpec) -> Column:
    """Share of rows up to this one and its equals."""
    return F.cume_dist().over(w)


def lag(c: Column, offset: int, w: WindowSpec, default=None) -> Column:
    """The value some rows before."""
    return F.lag(c, offset, default).over(w)


def lead(c: Column, offset: int, w: WindowSpec, default=None) -> Column:
    """The value some rows after."""
    return F.lead(c, offset, default).over(w)
