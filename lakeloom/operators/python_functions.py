"""Python functions over rows and groups, on Arrow batches.

Prefer column expressions; these serve what they can't express. Output schemas are
DDL text. Classes keep state per task; resources are passed as broadcast values.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def output(names: Sequence[str], types: Sequence[str]):
    """Declares the output columns of a row function or class."""

    def mark(f):
        f.output_schema = ", ".join(f"`{n}` {t}" for n, t in zip(names, types))
        return f

    return mark


def annotate(signature: str):
    """Declares `in, in -> out` types of a function class with evaluate."""

    def mark(f):
        f.returns = signature.rpartition("->")[2].strip()
        return f

    return mark


def map_column(c: Column, f: Callable, returns: str | None = None, args: tuple = (), resources: tuple = ()) -> Column:
    """f(value, *args) per element in Arrow batches; f may be a class, made once per batch stream.

    A class is called with resources; it has evaluate or __call__.
    """
    returns = returns or getattr(f, "returns", "string")

    @F.pandas_udf(returns)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = f(*resources) if isinstance(f, type) else f
        call = getattr(held, "evaluate", held)
        for s in batches:
            yield s.astype(object).where(s.notna(), None).map(lambda x: call(x, *args))

    return run(c)


def apply_rows(df: DataFrame, f, schema: str | None = None, keep: Sequence[str] = (), keep_nulls: bool = False, resources: tuple = ()) -> DataFrame:
    """f(row) gives any number of output tuples; a class may give more at the end through close().

    keep: columns of the input row repeated beside its outputs (a lateral view); with
    keep_nulls a row without output appears once with NULLs.
    """
    schema = schema or f.output_schema
    names = [x.strip().split()[0].strip("`") for x in schema.split(",")]
    kept = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = f(*resources) if isinstance(f, type) else f
        call = getattr(held, "process", held)
        for pdf in batches:
            rows = []
            for row in pdf.itertuples(index=False):
                got = list(call(row) or ())
                if not got and keep_nulls:
                    got = [(None,) * len(names)]
                rows += [(*(getattr(row, c) for c in keep), *(x if isinstance(x, (tuple, list)) else (x,))) for x in got]
            if rows:
                yield pd.DataFrame(rows, columns=[*keep, *names])
        if hasattr(held, "close"):
            rest = [(*(None for _ in keep), *(x if isinstance(x, (tuple, list)) else (x,))) for x in held.close() or ()]
            if rest:
                yield pd.DataFrame(rest, columns=[*keep, *names])

    return df.mapInPandas(run, f"{kept}, {schema}" if kept else schema)


def reduce_rows(df: DataFrame, f: Callable, returns: str, name: str) -> DataFrame:
    """df with a column f(row): a scalar from the whole row."""

    @F.pandas_udf(returns)
    def run(rows: pd.DataFrame) -> pd.Series:
        return pd.Series([f(r) for r in rows.itertuples(index=False)], dtype=object)

    return df.withColumn(name, run(F.struct(*df.columns)))


def aggregate(df: DataFrame, keys: Sequence[str], aggregator: type, cols: Sequence[str], returns: str, name: str, args: tuple = ()) -> DataFrame:
    """A Python aggregator with buffer(), __call__(buffer, *values), merge(buffer, other), getvalue(buffer).

    Rows are folded into one buffer per key in each Arrow batch before the shuffle;
    buffers travel pickled and are merged per key as they stream in.
    """
    import pickle

    kept = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            agg, held = aggregator(*args), {}
            for row in pdf[[*keys, *cols]].itertuples(index=False, name=None):
                k = row[: len(keys)]
                buffer = held.setdefault(k, None) or agg.buffer()
                held[k] = buffer
                agg(buffer, *row[len(keys) :])
            yield pd.DataFrame([(*k, pickle.dumps(b)) for k, b in held.items()], columns=[*keys, "_buffer"])

    def final(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        agg = aggregator(*args)
        buffer = agg.buffer()
        for pdf in batches:
            for b in pdf["_buffer"]:
                agg.merge(buffer, pickle.loads(b))
        yield pd.DataFrame([(*key, agg.getvalue(buffer))], columns=[*keys, name])

    if not keys:
        one = df.withColumn("_all", F.lit(1))
        return aggregate(one, ["_all"], aggregator, cols, returns, name, args).drop("_all")
    parts = df.select(*keys, *cols).mapInPandas(partial, f"{kept}, _buffer binary")
    return parts.groupBy(*keys).applyInPandas(final, f"{kept}, `{name}` {returns}")


def apply_groups(df: DataFrame, keys: Sequence[str], f: Callable, schema: str, sort: Sequence[str] = ()) -> DataFrame:
    """f(key, iterator of rows in order) gives output tuples, group by group.

    Groups are read as a sorted stream, never gathered: a group may be larger than
    memory.
    """
    names = [x.strip().split()[0].strip("`") for x in schema.split(",")]
    dealt = df.repartition(*keys).sortWithinPartitions(*keys, *sort)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from itertools import groupby

        rows = (r for pdf in batches for r in pdf.itertuples(index=False))
        none = lambda v: None if v is None or v != v else v
        out = []
        for key, group in groupby(rows, key=lambda r: tuple(none(getattr(r, k)) for k in keys)):
            for x in f(key, group) or ():
                out.append(x if isinstance(x, (tuple, list)) else (x,))
                if len(out) >= 10_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    return dealt.mapInPandas(run, schema)


def map_reduce(df: DataFrame, mapper: Callable | None, mapped: str | None, group: Sequence[str], reducer: Callable, reduced: str, sort: Sequence[str] = (), combiner: Callable | None = None) -> DataFrame:
    """mapper(row) -> tuples; combiner and reducer (key, rows) -> tuples.

    The combiner runs on each mapped batch before the shuffle and gives rows of the
    mapped schema.
    """
    rows = df if mapper is None else apply_rows(df, mapper, mapped)
    if combiner is not None:
        schema = rows.schema.simpleString()[7:-1].replace(":", " ")
        names = rows.columns

        def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out = [x for k, g in pdf.groupby(list(group), dropna=False, sort=False) for x in combiner(k, g.itertuples(index=False))]
                yield pd.DataFrame(out, columns=names)

        rows = rows.mapInPandas(combine, schema)
    return apply_groups(rows, group, reducer, reduced, sort)


def reduce_columns(df: DataFrame, cols: Sequence[str], f: Callable[[Column, Column], Column]) -> Column:
    """A column folded from several by f."""
    return reduce(f, [F.col(c) for c in cols])
