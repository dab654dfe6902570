"""Pivoting, key-value text, missing values, scaling, row ids."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.session import checkpointed

_NUMERIC = {"byte", "short", "integer", "long", "float", "double"}

#: Distinct values that a pivot or a key discovery may make into columns.
MOST_COLUMNS = 10_000


def numeric(df: DataFrame) -> list[str]:
    """Names of the numeric columns."""
    return [f.name for f in df.schema if f.dataType.typeName() in _NUMERIC or f.dataType.typeName().startswith("decimal")]


def _values(df: DataFrame, col: str) -> list:
    """Sorted distinct values that become columns; more than MOST_COLUMNS is an error."""
    got = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().limit(MOST_COLUMNS + 1).collect()]
    if len(got) > MOST_COLUMNS:
        raise ValueError(f"{col} has more than {MOST_COLUMNS} values")
    return sorted(got)


def pivot(df: DataFrame, rows: Sequence[str], column: str, values: Sequence[str]) -> DataFrame:
    """rows by the values of column; a cell with two rows raises when the result is computed."""
    heads = _values(df, column)
    one = lambda v: F.when(F.count("*") > 1, F.raise_error(F.lit("two rows in a cell"))).otherwise(F.any_value(v))
    cells = df.groupBy(*rows, column).agg(*[one(v).alias(v) for v in values])
    aggs = [
        F.any_value(F.when(F.col(column) == h, F.col(v)), ignoreNulls=True).alias(str(h) if len(values) == 1 else f"{v}_{h}")
        for v in values for h in heads
    ]
    return cells.groupBy(*rows).agg(*aggs)


def pivot_table(df: DataFrame, values: Sequence[str], rows: Sequence[str], column: str | None = None, funcs: dict | Sequence[str] = ("mean",), fill=None) -> DataFrame:
    """Aggregates by rows and, if given, the values of column.

    funcs: names for all values, or {value: names}. Columns are {head}_{value}_{func}
    with column and {value}_{func} without; fill replaces empty cells of the former.
    """
    named = {
        "mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count, "nunique": F.count_distinct,
        "median": F.median, "std": F.stddev_samp, "var": F.var_samp,
    }
    todo = [(v, f) for v in values for f in (funcs[v] if isinstance(funcs, dict) else funcs)]
    if column is None:
        return df.groupBy(*rows).agg(*[named[f](v).alias(f"{v}_{f}") for v, f in todo])
    aggs = []
    for h in _values(df, column):
        for v, f in todo:
            cell = named[f](F.when(F.col(column) == h, F.col(v)))
            if f == "count":
                cell = F.when(cell > 0, cell)
            aggs.append((cell if fill is None else F.coalesce(cell, F.lit(fill))).alias(f"{h}_{v}_{f}"))
    return df.groupBy(*rows).agg(*aggs)


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None, var_name: str = "variable", value_name: str = "value", ignore_nan: bool = False) -> DataFrame:
    """Wide to long; ignore_nan leaves missing values out."""
    out = df.unpivot(list(ids), list(values) if values else [c for c in df.columns if c not in ids], var_name, value_name)
    if not ignore_nan:
        return out
    v = F.col(value_name)
    keep = v.isNotNull()
    return out.where(keep & ~F.isnan(v)) if out.schema[value_name].dataType.typeName() in ("float", "double") else out.where(keep)


def extract_kv(df: DataFrame, columns: Sequence[str], kv: str = ":", item: str = ",", dtype: str = "double", fill=None) -> DataFrame:
    """`k1:v1,k2:v2` text columns to a column per key, {column}_{key}; a malformed pair raises.

    The keys are found by a job of their own.
    """
    out = df
    for c in columns:
        pairs = F.when(F.length(F.col(c)) > 0, F.split(F.col(c), re.escape(item)))
        checked = F.transform(
            pairs,
            lambda p: F.when(F.contains(p, F.lit(kv)), p).otherwise(F.raise_error(F.concat(F.lit("malformed pair: "), p))),
        )
        parsed = F.map_from_entries(
            F.transform(checked, lambda p: F.struct(F.substring_index(p, kv, 1).alias("k"), F.substr(p, F.instr(p, kv) + len(kv)).alias("v")))
        )
        held = f"_{c}_map"
        out = out.withColumn(held, parsed)
        keys = _values(out.select(F.explode(F.map_keys(held)).alias("k")), "k")
        cell = lambda k: F.try_element_at(F.col(held), F.lit(k)).cast(dtype)
        out = out.select("*", *[(cell(k) if fill is None else F.coalesce(cell(k), F.lit(fill))).alias(f"{c}_{k}") for k in keys]).drop(c, held)
    return out


def to_kv(df: DataFrame, columns: Sequence[str], kv: str = ":", item: str = ",", name: str = "kv_col") -> DataFrame:
    """Columns to one `name:value` text column; NULLs are left out."""
    parts = [F.when(F.col(c).isNotNull(), F.concat(F.lit(c + kv), F.col(c).cast("string"))) for c in columns]
    return df.select(*[c for c in df.columns if c not in columns], F.concat_ws(item, *parts).alias(name))


def dropna(df: DataFrame, how: str = "any", thresh: int | None = None, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows with too many missing values go; NaN is missing."""
    return df.na.drop(how, thresh, list(subset) if subset else None)


def _missing(df: DataFrame, c: str) -> Column:
    return F.col(c).isNull() | F.isnan(c) if df.schema[c].dataType.typeName() in ("float", "double") else F.col(c).isNull()


def fillna(df: DataFrame, value, subset: Sequence[str] | None = None) -> DataFrame:
    """Missing values of the columns replaced."""
    cols = set(subset or df.columns)
    return df.select(*[F.when(_missing(df, c), F.lit(value)).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def _filled(df: DataFrame, subset: Sequence[str] | None, back: bool) -> DataFrame:
    cols = list(subset or df.columns)
    have = {c: F.when(~_missing(df, c), F.col(c)) for c in cols}
    out = []
    for c in df.columns:
        if c in have:
            i = cols.index(c)
            near = cols[i:] if back else cols[i::-1]
            out.append(F.coalesce(*[have[x] for x in near]).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def ffill(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Within a row, a missing value takes the nearest one to its left."""
    return _filled(df, subset, False)


def bfill(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Within a row, a missing value takes the nearest one to its right."""
    return _filled(df, subset, True)


def _scaled(df: DataFrame, columns, group, preserve, suffix, stats, value) -> DataFrame:
    cols = list(columns or [c for c in numeric(df) if c not in (group or [])])
    figures = [f(F.col(c)).alias(f"_{n}_{c}") for c in cols for n, f in stats.items()]
    if group:
        told = df.groupBy(*group).agg(*figures)
        same = reduce(lambda a, b: a & b, [F.col(f"_d.`{g}`").eqNullSafe(F.col(f"_t.`{g}`")) for g in group])
        held = df.alias("_d").join(told.alias("_t"), same)
    else:
        held = df.alias("_d").crossJoin(F.broadcast(df.agg(*figures)))  # one row
    made = {c: value(F.col(f"_d.`{c}`"), {n: F.col(f"_{n}_{c}") for n in stats}) for c in cols}
    keep = [F.col(f"_d.`{c}`") if preserve or c not in made else made[c].alias(c) for c in df.columns]
    return held.select(*keep, *([made[c].alias(c + suffix) for c in cols] if preserve else []))


def min_max_scale(df: DataFrame, columns=None, feature_range=(0, 1), preserve: bool = False, suffix: str = "_scaled", group=None) -> DataFrame:
    """Columns moved to a range, over the table or within groups; a column of one value goes to its low end."""
    a, b = map(float, feature_range)
    return _scaled(
        df, columns, group, preserve, suffix, {"lo": F.min, "hi": F.max},
        lambda x, s: F.when(s["hi"] == s["lo"], F.lit(a)).otherwise((x - s["lo"]) / (s["hi"] - s["lo"]) * (b - a) + a),
    )


def std_scale(df: DataFrame, columns=None, with_means: bool = True, with_std: bool = True, preserve: bool = False, suffix: str = "_scaled", group=None) -> DataFrame:
    """Columns less their mean, over their population deviation; deviation 0 gives 0 (or the mean without with_means)."""

    def value(x, s):
        moved = x - s["mean"] if with_means else x.cast("double")
        if not with_std:
            return moved
        return F.when(s["std"] == 0, F.lit(0.0) if with_means else s["mean"]).otherwise(moved / s["std"])

    return _scaled(df, columns, group, preserve, suffix, {"mean": F.avg, "std": F.stddev_pop}, value)


def append_id(df: DataFrame, order: Sequence, name: str = "append_id") -> DataFrame:
    """Dense ids from 0 in the order of keys that together are unique.

    The sorted rows are a checkpoint with their partition and place; the partitions'
    sizes, one small row each, give the offsets. No single task sees all rows.
    """
    held = checkpointed(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33)
    sizes = held.groupBy(part.alias("_p")).agg(F.count("*").alias("_c"))
    starts = sizes.select("_p", (F.sum("_c").over(Window.orderBy("_p")) - F.col("_c")).alias("_s"))
    place = F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    return held.join(F.broadcast(starts), part == F.col("_p")).select((F.col("_s") + place).alias(name), *df.columns)


def concat_columns(left: DataFrame, left_order: Sequence, right: DataFrame, right_order: Sequence) -> DataFrame:
    """Two tables side by side by their places in the given orders; a shorter one ends in NULLs."""
    if set(left.columns) & set(right.columns):
        raise ValueError("column names collide")
    a, b = append_id(left, left_order, "_id"), append_id(right, right_order, "_id")
    return a.join(b, "_id", "full").drop("_id")


def applymap(df: DataFrame, f, columns: Sequence[str] | None = None) -> DataFrame:
    """f(column) over the columns."""
    cols = set(columns or df.columns)
    return df.select(*[f(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])
