"""Projection, filters, joins, set operations, sorting and sampling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.aggregates import quantile
from lakeloom.operators.reshape import append_id

#: Bytes up to which a side may be broadcast on request, by the optimizer's estimate; in memory it may be several times that.
BROADCAST_BYTES = 64 << 20


def small_enough(df: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether the optimizer's size estimate of df is at most so many bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= most


def exclude(df: DataFrame, *cols: str) -> DataFrame:
    """All columns but these; an unknown name is an error."""
    unknown = set(cols) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return df.drop(*cols)


def project(df: DataFrame, *fields, **named) -> DataFrame:
    """Columns, expressions and renamed expressions; a name twice is an error."""
    out = df.select(*fields, *[(c if isinstance(c, Column) else F.col(c)).alias(n) for n, c in named.items()])
    if len(set(out.columns)) < len(out.columns):
        raise ValueError(f"column names repeat: {out.columns}")
    return out


def assign(df: DataFrame, name: str, value, where: Column | None = None) -> DataFrame:
    """Sets a column, or only its rows where a condition holds (others keep theirs, or NULL if it is new)."""
    value = value if isinstance(value, Column) else F.lit(value)
    if where is not None:
        value = F.when(where, value).otherwise(F.col(name) if name in df.columns else F.lit(None))
    return df.withColumn(name, value)


def where_all(df: DataFrame, *predicates: Column) -> DataFrame:
    """Rows for which every predicate holds."""
    return df.where(reduce(lambda a, b: a & b, predicates)) if predicates else df


def query(df: DataFrame, condition: str, **values) -> DataFrame:
    """Rows for which an SQL condition holds; `:name` stands for a given value, passed as a literal."""
    args = {k: F.lit(v) for k, v in values.items()}
    return df.sparkSession.sql(f"SELECT * FROM {{df}} WHERE {condition}", args=args, df=df)


def where_parts(df: DataFrame, parts: str, exclude: bool = True) -> DataFrame:
    """Rows of partitions named as `a=1,b=2/a=2`: comma is and, slash is or. exclude drops those columns."""
    names: list[str] = []

    def one(text: str) -> Column:
        name, _, value = text.partition("=")
        names.append(name.strip())
        return F.col(name.strip()) == F.lit(value.strip().strip("'\"")).cast(df.schema[name.strip()].dataType)

    ways = [reduce(lambda a, b: a & b, [one(p) for p in way.split(",")]) for way in parts.split("/")]
    out = df.where(reduce(lambda a, b: a | b, ways))
    return out.drop(*names) if exclude else out


def describe(df: DataFrame, *cols: str, approximate: bool = False) -> DataFrame:
    """A row per figure (count, mean, std, min, quartiles, max) with a column per numeric column.

    Exact quartiles hold a column's distinct values in one task; approximate ones a
    sketch of bounded size, which is the choice for large tables.
    """
    cols = cols or tuple(f.name for f in df.schema if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double") or f.dataType.typeName().startswith("decimal"))
    figures = {
        "count": lambda c: F.count(c), "mean": F.avg, "std": F.stddev_samp, "min": F.min,
        "quantile_25": lambda c: quantile(c, F.lit(0.25), approximate), "quantile_50": lambda c: quantile(c, F.lit(0.5), approximate),
        "quantile_75": lambda c: quantile(c, F.lit(0.75), approximate), "max": F.max,
    }
    rows = F.array(*[
        F.struct(F.lit(n).alias("type"), *[f(F.col(c)).cast("double").alias(c) for c in cols]) for n, f in figures.items()
    ])
    return df.agg(rows.alias("r")).select(F.inline("r"))


def with_totals(df: DataFrame, **totals: Column) -> DataFrame:
    """df with whole-table aggregates on every row: one row of them, joined without a single-task window."""
    return df.crossJoin(F.broadcast(df.agg(*[c.alias(n) for n, c in totals.items()])))  # one row


def join(left: DataFrame, right: DataFrame, on=None, how: str = "inner", suffixes: tuple[str, str] = ("_x", "_y"), merge=None, small: bool = False, extra=None, spread: int | None = None) -> DataFrame:
    """Equi-join with naming rules.

    on: a name, (left, right) names, a list of either, or None for the shared names.
    Columns of both sides with the same name get the suffixes; an inner join keeps
    one copy of a same-named key. merge (outer joins): True fills a same-named key
    from either side, a dict {name: "left" | "right" | "auto"} per key. small asks
    for the right side to be broadcast, which happens if it is small enough. extra:
    f(left, right) gives a further condition. NULL keys don't match. spread: pairs of
    rows from which on a key is dealt to several tasks, for keys that many rows of both
    sides share; the few keys would otherwise be the most tasks that the join can have.
    Without a further condition rows then meet in blocks of _BLOCK of each side.
    """
    if on is None:
        on = [c for c in left.columns if c in right.columns]
    keys = [(k, k) if isinstance(k, str) else tuple(k) for k in ([on] if isinstance(on, (str, tuple)) else on)]
    if not keys:
        raise ValueError("a join needs a key; use theta_join for other conditions")
    same = [a for a, b in keys if a == b]
    merge = {k: "auto" for k in same} if merge is True else dict(merge or {})
    if set(merge) - set(same):
        raise ValueError("only keys of the same name can be merged")
    kind, rest, blocks = {"outer": "full"}.get(how, how), None, bool(spread) and extra is None
    a, b = left, right
    if spread:
        if extra is not None and how in ("right", "outer"):
            raise ValueError("a spread join that keeps right rows takes no further condition")
        kind = {"right": "inner", "outer": "left"}.get(how, how)
        a, b = _dealt(left, right, keys, _heavy(left, right, keys, spread))
        if how in ("right", "outer"):
            held = left.select(*[F.col(f"`{p}`").alias(f"_k{i}") for i, (p, _) in enumerate(keys)]).distinct()
            alone = right.join(held, reduce(lambda x, y: x & y, [F.col(f"`{q}`") == F.col(f"_k{i}") for i, (_, q) in enumerate(keys)]), "left_anti")
            rest = join(left.where(F.lit(False)), alone, on, "right", suffixes, merge)
    if blocks:
        a, b = _blocks(a, left.columns, [p for p, _ in keys], "_x"), _blocks(b, right.columns, [q for _, q in keys], "_y")
    a, b = a.alias("_l"), b.alias("_r")
    cond = reduce(lambda x, y: x & y, [F.col(f"_l._k{i}" if blocks else f"_l.`{p}`") == F.col(f"_r._k{i}" if blocks else f"_r.`{q}`") for i, (p, q) in enumerate(keys)])
    if extra is not None:
        cond = cond & extra(lambda c: F.col(f"_l.`{c}`"), lambda c: F.col(f"_r.`{c}`"))
    if spread:
        cond = cond & (F.col("_l._salt") == F.col("_r._salt"))
    if small and small_enough(right):
        b = F.broadcast(b)
    both = set(left.columns) & set(right.columns)
    one = set(same) if how == "inner" else set(merge)
    mine = {c: F.col(f"_x{i}" if blocks else f"_l.`{c}`") for i, c in enumerate(left.columns)}
    theirs = {c: F.col(f"_y{i}" if blocks else f"_r.`{c}`") for i, c in enumerate(right.columns)}
    out = []
    for c in left.columns:
        value = mine[c]
        if c in one and how != "inner":
            other = theirs[c]
            value = {"left": value, "right": other}.get(merge[c], F.coalesce(value, other))
        out.append(value.alias(c if c in one or c not in both else c + suffixes[0]))
    for c in right.columns:
        if c not in one:
            out.append(theirs[c].alias(c if c not in both else c + suffixes[1]))
    met = a.join(b, cond, kind)
    if blocks:  # coalesce() leaves the tasks as they are, but without it a task would hold all pairs of a left block at once
        met = met.select(F.col("_l._rows").alias("_rows"), F.col("_r._rows").alias("_others")).coalesce(_tasks(left))
        met = met.select("_rows", F.inline_outer("_others")).select("*", F.inline("_rows"))
    met = met.select(*out)
    return met if rest is None else met.union(rest)


#: Rows of each side that meet at once, at most; a task holds so many pairs, squared.
_BLOCK = 128


def _blocks(dealt: DataFrame, cols: Sequence[str], keys: Sequence[str], name: str) -> DataFrame:
    """(_k0, _k1, ..., _salt, _rows): rows dealt by keys and _salt, in arrays of at most _BLOCK rows of one key and salt.

    Columns are called by name and place. The pairs of two blocks follow one another, so
    that written pairs repeat within short distances and take little disk.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    rows = F.struct(*[F.col(f"`{c}`").alias(f"{name}{i}") for i, c in enumerate(cols)])
    held = dealt.select(*[F.col(f"`{c}`").alias(n) for n, c in zip(names, keys)], "_salt", rows.alias("_row"))
    at = F.row_number().over(Window.partitionBy(*names, "_salt").orderBy(F.lit(0)))
    return held.withColumn("_block", F.floor((at - 1) / _BLOCK)).groupBy(*names, "_salt", "_block").agg(F.collect_list("_row").alias("_rows")).drop("_block")


def _tasks(df: DataFrame) -> int:
    """Tasks among which hot keys are spread: several for each core, so that uneven ones even out."""
    spark = df.sparkSession
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _heavy(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], pairs: int) -> DataFrame:
    """(_k0, _k1, ..., _n): keys of more pairs of rows than that, and the salts that their left rows are dealt to.

    Such a key has over sqrt(pairs) rows on one side, so there are few of them. A left row
    that meets none counts as a pair, as outer joins keep it.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    na = left.groupBy(*[F.col(f"`{p}`").alias(n) for n, (p, _) in zip(names, keys)]).agg(F.count("*").alias("_a"))
    nb = right.groupBy(*[F.col(f"`{q}`").alias(n) for n, (_, q) in zip(names, keys)]).agg(F.count("*").alias("_b"))
    salts = F.least(F.ceil(F.col("_a").cast("double") * F.coalesce("_b", F.lit(1)) / pairs), "_a", F.lit(_tasks(left))).cast("int")
    return F.broadcast(na.join(nb, names, "left").select(*names, salts.alias("_n")).where("_n > 1"))


def _dealt(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with a _salt, dealt to tasks by keys and salt.

    hot is (_k0, _k1, ..., _n): a key's left rows are dealt over n salts by their place,
    its right rows are repeated for each. No more salts than tasks are of use, and more
    would only repeat right rows, so n ends there. Keys that are not hot have one salt, and
    no right row is repeated for them; left rows without a key, which meet none, are dealt
    to all tasks. The number of tasks is given, as adaptive execution goes by the bytes of
    what is read, which say nothing of the pairs.
    """
    tasks = _tasks(left)

    def told(df: DataFrame, names: list[str]) -> DataFrame:
        met = df.join(hot, reduce(lambda x, y: x & y, [F.col(f"`{c}`") == F.col(f"_k{i}") for i, c in enumerate(names)]), "left")
        return met.withColumn("_n", F.least(F.coalesce("_n", F.lit(1)), F.lit(tasks))).drop(*[f"_k{i}" for i in range(len(names))])  # least() alone skips a NULL

    ls, rs = [p for p, _ in keys], [q for _, q in keys]
    keyless = reduce(lambda x, y: x | y, [F.col(f"`{c}`").isNull() for c in ls])
    salt = F.pmod("_at", F.when(keyless, F.lit(tasks)).otherwise(F.col("_n"))).cast("int")
    a = told(left.withColumn("_at", F.monotonically_increasing_id()), ls).withColumn("_salt", salt).drop("_at", "_n")
    b = told(right, rs).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n")
    return tuple(df.repartition(tasks, *[F.col(f"`{c}`") for c in names], "_salt") for df, names in ((a, ls), (b, rs)))


def theta_join(left: DataFrame, right: DataFrame, cond, how: str = "inner") -> DataFrame:
    """Join on any condition f(left, right); the right side must be small enough to be broadcast.

    Raises if it is not: such a join can't be partitioned by a key.
    """
    if not small_enough(right):
        raise ValueError("the right side of a join without keys must be small")
    return left.join(F.broadcast(right), cond(left, right), how)


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", per: int = 1_000_000) -> DataFrame:
    """Equi-join (inner, left, right or outer) on a key of both sides, with hot keys of the left side split.

    Keys with over `per` left rows (so at most rows / per of them) are counted first.
    Their left rows are dealt over as many salts by place, though not over more than there
    are tasks, so equal rows are split as well, and the right rows of such a key are
    repeated for each salt; all other keys stay as they are. Right rows without a match, which repeats would multiply, are
    added from an anti join. NULL keys don't match; the key comes once, first.
    """
    hot = left.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k0")).agg(F.ceil(F.count("*") / per).cast("int").alias("_n")).where("_n > 1")
    a, b = _dealt(left, right, [(key, key)], hot)
    out = a.join(b, [key, "_salt"], {"inner": "inner", "right": "inner"}.get(how, "left")).drop("_salt")
    if how in ("right", "outer"):
        alone = right.join(left.select(key).distinct(), key, "left_anti")
        out = out.unionByName(alone, allowMissingColumns=True)
    return out


def semi(left: DataFrame, col: str, right: DataFrame, right_col: str) -> DataFrame:
    """Rows whose value is among the right column's (IN)."""
    values = right.select(F.col(right_col).alias("_v"))
    return left.join(values, F.col(col) == F.col("_v"), "left_semi")


def anti_in(left: DataFrame, col: str, right: DataFrame, right_col: str) -> DataFrame:
    """NOT IN with SQL's NULLs: a NULL on the right leaves no rows, a NULL on the left goes.

    The right side is checked for NULLs and emptiness by one small aggregate, so the
    join itself stays a partitioned anti join.
    """
    values = right.select(F.col(right_col).alias("_v"))
    told = values.agg(F.count("*").alias("_n"), F.count_if(F.col("_v").isNull()).alias("_nulls"))
    kept = left.join(values.where("_v IS NOT NULL"), F.col(col) == F.col("_v"), "left_anti")
    return kept.crossJoin(F.broadcast(told)).where((F.col("_n") == 0) | ((F.col("_nulls") == 0) & F.col(col).isNotNull())).drop("_n", "_nulls")


def drop_rows(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows without a match on cols; NULL keys on the left stay."""
    return left.join(right.select(*cols).distinct(), list(cols), "left_anti")


def union(left: DataFrame, *rights: DataFrame, distinct: bool = False) -> DataFrame:
    """All rows, by name where the names agree and else by place; distinct keeps one of each."""
    out = left
    for r in rights:
        out = out.unionByName(r) if set(out.columns) == set(r.columns) else out.union(r)
    return out.distinct() if distinct else out


def difference(left: DataFrame, *rights: DataFrame, distinct: bool = False) -> DataFrame:
    """Bag difference (copies cancel one by one), or with distinct the tuples that no right side has."""
    for r in rights:
        left = left.subtract(r.select(*left.columns)) if distinct else left.exceptAll(r.select(*left.columns))
    return left


def intersection(left: DataFrame, *rights: DataFrame, distinct: bool = False) -> DataFrame:
    """Bag intersection (least number of copies), or with distinct the tuples that all sides have."""
    for r in rights:
        left = left.intersect(r.select(*left.columns)) if distinct else left.intersectAll(r.select(*left.columns))
    return left


def order(df: DataFrame, by: Sequence, ascending=True) -> DataFrame:
    """Sorted by several keys, each ascending or not; `-name` is descending; NULLs first ascending, last descending."""
    flags = [ascending] * len(by) if isinstance(ascending, bool) else list(ascending)
    keys = []
    for b, up in zip(by, flags):
        if isinstance(b, str) and b.startswith("-"):
            b, up = b[1:], False
        c = F.col(b) if isinstance(b, str) else b
        keys.append(c.asc() if up else c.desc())
    return df.orderBy(*keys)


def window_of(df: DataFrame, start: int, stop: int | None, by: Sequence) -> DataFrame:
    """Rows start to stop in the order of by."""
    out = df.orderBy(*by).offset(start)
    return out if stop is None else out.limit(stop - start)


def tail(df: DataFrame, n: int, by: Sequence[str]) -> DataFrame:
    """The last n rows in the order of the columns by."""
    return df.orderBy(*[F.col(c).desc() for c in by]).limit(n)


def slice_rows(df: DataFrame, by: Sequence, start: int = 0, stop: int | None = None, step: int = 1) -> DataFrame:
    """Every step-th row from start to stop in an order of unique keys; places come from dense ids, not from one task."""
    i = F.col("_place")
    held = append_id(df, by, "_place").where(i >= start).where((i - start) % step == 0)
    return (held if stop is None else held.where(i < stop)).drop("_place")


def random_number(seed: int | None = None) -> Column:
    """A number in [0, 1) for each row; with a seed alike as long as rows keep their partitions and order."""
    return F.rand(seed)


def distinct_on(df: DataFrame, *cols) -> DataFrame:
    """Distinct tuples of cols, and only those columns."""
    return df.select(*cols).distinct() if cols else df.distinct()


def value_counts(df: DataFrame, col: str, sort: bool = True, ascending: bool = False, dropna: bool = False) -> DataFrame:
    """(value, count), most frequent first; equal counts by value."""
    out = df.groupBy(col).agg(F.count("*").alias("count"))
    if dropna:
        out = out.where(F.col(col).isNotNull())
    return out.orderBy(F.col("count").asc() if ascending else F.col("count").desc(), col) if sort else out


def topk(df: DataFrame, col: str, k: int) -> DataFrame:
    """The k most frequent values."""
    return value_counts(df, col).limit(k)


def sample(df: DataFrame, frac: float | None = None, n: int | None = None, parts: int | None = None, part: int = 0, columns: Sequence[str] = (), seed: int = 0, replace: bool = False, strata: tuple | None = None, weight: str | None = None) -> DataFrame:
    """Exactly one of frac, n, parts or strata.

    parts splits rows by a hash of columns and takes one part. strata: (column,
    {value: fraction}). n takes the rows of least hash order; with weight, by
    weighted sampling without replacement (exponential keys).
    """
    if sum(x is not None for x in (frac, n, parts, strata)) != 1:
        raise ValueError("give one of frac, n, parts or strata")
    if frac is not None:
        return df.sample(replace, frac, seed)
    if strata is not None:
        return df.sampleBy(strata[0], strata[1], seed)
    cols = list(columns) or df.columns
    if parts is not None:
        return df.where(F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(parts)) == part)
    u = (F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 52)) + 1).cast("double") / float(1 << 52)
    key = u if weight is None else -F.ln(u) / F.col(weight)
    picked = df if weight is None else df.where(F.col(weight) > 0)
    return picked.withColumn("_k", key).orderBy("_k").limit(n).drop("_k")


def split(df: DataFrame, frac: float, seed: int = 0, columns: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Two complementary parts by a hash of columns: alike on any partitioning."""
    u = F.pmod(F.xxhash64(F.lit(seed), *(list(columns) or df.columns)), F.lit(1 << 30)) < int(frac * (1 << 30))
    return df.where(u), df.where(~u)


def reshuffle(df: DataFrame, by: Sequence = (), sort: Sequence = ()) -> DataFrame:
    """Rows dealt by keys (evenly without) and sorted within partitions."""
    out = df.repartition(*by) if by else df.repartition(df.sparkSession.sparkContext.defaultParallelism)
    return out.sortWithinPartitions(*sort) if sort else out
