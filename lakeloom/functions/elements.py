"""Element-wise conditions and arithmetic with Python's rules.

Division by zero and failed lookups give NULL; Spark's ANSI mode stays on and the
try_ forms are chosen here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_na(c: Column, floating: bool = True) -> Column:
    """NULL, or NaN for a floating column."""
    return c.isNull() | F.isnan(c) if floating else c.isNull()


def not_na(c: Column, floating: bool = True) -> Column:
    """The negation of is_na."""
    return ~is_na(c, floating)


def fill_na(c: Column, value, floating: bool = True) -> Column:
    """value where c is missing."""
    return F.when(is_na(c, floating), value).otherwise(c)


def is_in(c: Column, values: Sequence) -> Column:
    """Membership in a literal list."""
    return c.isin(list(values))


def not_in(c: Column, values: Sequence) -> Column:
    """Negated membership; a NULL stays NULL."""
    return ~c.isin(list(values))


def between(c: Column, low, high, inclusive: bool = True) -> Column:
    """Range test with both ends in, or both out."""
    return c.between(low, high) if inclusive else (c > low) & (c < high)


def if_else(cond: Column, yes, no) -> Column:
    """yes where cond holds; no where it is false or NULL."""
    return F.when(cond, yes).otherwise(no)


def switch(*cases: tuple, value: Column | None = None, default=None) -> Column:
    """CASE over (condition, result) pairs; with value, over (constant, result) pairs."""
    out = None
    for test, result in cases:
        cond = test if value is None else value == test
        out = F.when(cond, result) if out is None else out.when(cond, result)
    return out.otherwise(default)


def cut(c: Column, bins: Sequence, right: bool = True, labels: Sequence | None = None, include_lowest: bool = False, include_under: bool = False, include_over: bool = False) -> Column:
    """The bin of c: its label, or its number from 0; outside all bins NULL.

    right: a bin holds its upper edge, otherwise its lower one. include_lowest adds
    the outermost edge. include_under and include_over add an open bin at that end.
    """
    edges: list = [*([None] if include_under else []), *bins, *([None] if include_over else [])]
    out = None
    last = len(edges) - 2
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        low_in = not right or (include_lowest and i == (1 if include_under else 0))
        high_in = right or (include_lowest and i == (last - 1 if include_over else last))
        cond = F.lit(True)
        if a is not None:
            cond = cond & (c >= a if low_in and not (right and include_under and a == bins[0]) else c > a)
        if b is not None:
            cond = cond & (c <= b if high_in else c < b)
        result = labels[i] if labels is not None else i
        out = F.when(cond, result) if out is None else out.when(cond, result)
    return out


def modulo(a: Column, b: Column) -> Column:
    """Remainder with the sign of the divisor; NULL for divisor 0."""
    d = F.nullif(b, F.lit(0))
    return ((a % d) + d) % d


def floor_divide(a: Column, b: Column) -> Column:
    """Integer quotient rounded down; NULL for divisor 0."""
    d = F.nullif(b, F.lit(0))
    r = ((a % d) + d) % d
    return ((a - r) / d).cast("long")


def true_divide(a: Column, b: Column) -> Column:
    """Quotient as a double; NULL for divisor 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def power(a: Column, b, integral: bool = False) -> Column:
    """a to the b; cast back to a whole number if integral."""
    out = F.pow(a, b if isinstance(b, Column) else F.lit(b))
    return out.cast("long") if integral else out


def milliseconds(a: Column, b: Column) -> Column:
    """a - b of two timestamps in whole milliseconds."""
    return F.timestamp_diff("MILLISECOND", b, a)


def truncate(c: Column, digits: int = 0) -> Column:
    """c cut toward zero to that many digits."""
    unit = F.lit(10.0**digits)
    return F.signum(c) * F.floor(F.abs(c) * unit) / unit


def log(c: Column, base: float | None = None) -> Column:
    """Natural logarithm, or to a base; NULL or NaN outside the domain as Spark gives it."""
    return F.ln(c) if base is None else F.ln(c) / F.ln(F.lit(float(base)))


def call(name: str, *cols: Column, returns: str | None = None) -> Column:
    """Any engine function by name, cast if a type is given."""
    out = F.call_function(name, *cols)
    return out if returns is None else out.cast(returns)


def digest(*cols: Column) -> Column:
    """A 64-bit hash, alike in every process."""
    return F.xxhash64(*cols)


def to_datetime(c: Column) -> Column:
    """Unix seconds to a timestamp."""
    return F.timestamp_seconds(c)
