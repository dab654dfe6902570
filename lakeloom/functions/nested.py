"""Arrays, maps and JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def item(c: Column, i: int) -> Column:
    """Element at a 0-based place, negative from the end; NULL outside."""
    return F.get(c, F.lit(i)) if i >= 0 else F.get(c, F.size(c) + i)


def key(c: Column, k) -> Column:
    """Value of a map key; NULL without it."""
    return F.try_element_at(c, F.lit(k))


def size(c: Column) -> Column:
    """Elements of an array or map; NULL for NULL."""
    return F.when(c.isNotNull(), F.size(c))


def contains(c: Column, value) -> Column:
    """Whether an array has the value."""
    return F.array_contains(c, value)


def sort(c: Column) -> Column:
    """Ascending, NULLs first."""
    return F.sort_array(c)


def make_list(*cols: Column) -> Column:
    """An array of columns."""
    return F.array(*cols)


def make_dict(*pairs: Column) -> Column:
    """A map from key, value, key, value, .."""
    return F.create_map(*pairs)


def json_field(c: Column, path: str, returns: str = "string") -> Column:
    """A field of JSON text by path."""
    return F.get_json_object(c, path).try_cast(returns)


def explode(df: DataFrame, col: str, names: list[str], pos: bool = False, keep_nulls: bool = False) -> DataFrame:
    """A row per element of an array or map column, which goes.

    names: of the element, or key and value; with pos, the 0-based place first.
    keep_nulls keeps rows of NULL and empty values.
    """
    if pos:
        f = F.posexplode_outer if keep_nulls else F.posexplode
    else:
        f = F.explode_outer if keep_nulls else F.explode
    return df.select(*[c for c in df.columns if c != col], f(F.col(col)).alias(*names))
