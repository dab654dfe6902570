"""String, date, array, map and JSON functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import dates as D
from lakeloom.functions import elements as E
from lakeloom.functions import nested as N
from lakeloom.functions import strings as S
from lakeloom.plans.registry import Registry
from lakeloom.session import table

_r = Registry()
QUERIES, ORACLES = _r.queries, _r.oracles


@_r.add(r"""
SELECT p_partkey, upper(p_brand[1]) || lower(p_brand[2:]) AS capitalized, concat_ws('/', p_brand, p_name, nullif(p_type, p_type)) AS joined, regexp_matches(p_brand, '[0-9]+$') AS has_number,
       regexp_matches(p_brand, '(?i)BRAND') AS has_any_case, contains(p_brand, '#1') AS has_literal, CAST(len(regexp_extract_all(p_brand, '[0-9]')) AS INTEGER) AS n_digits,
       starts_with(p_brand, 'B') AS starts, suffix(p_brand, '7') AS ends, CASE WHEN regexp_matches(p_brand, '([0-9])[0-9]*') THEN regexp_extract(p_brand, '([0-9])[0-9]*', 1) END AS first_digit,
       CAST(instr(p_brand, '1') - 1 AS INTEGER) AS found, CAST(CASE WHEN instr(reverse(p_brand), '1') > 0 THEN length(p_brand) - instr(reverse(p_brand), '1') ELSE -1 END AS INTEGER) AS rfound,
       regexp_replace(p_brand, '[0-9]', '#', 'g') AS replaced, regexp_replace(p_brand, '[0-9]', '#') AS replaced_once, CAST(length(p_brand) AS INTEGER) AS n
FROM part""")
def string_search(spark, d):
    """Case, search, extraction and replacement."""
    c = F.col("p_brand")
    return table(spark, d, "part").select(
        "p_partkey", S.capitalize(c).alias("capitalized"), S.cat(c, [F.col("p_name"), F.nullif("p_type", "p_type")], "/").alias("joined"), S.contains(c, "[0-9]+$").alias("has_number"),
        S.contains(c, "BRAND", case=False).alias("has_any_case"), S.contains(c, "#1", regex=False).alias("has_literal"), S.count(c, "[0-9]").alias("n_digits"),
        F.startswith(c, F.lit("B")).alias("starts"), F.endswith(c, F.lit("7")).alias("ends"), S.extract(c, "([0-9])[0-9]*", 1).alias("first_digit"),
        S.find(c, "1").alias("found"), S.rfind(c, "1").alias("rfound"), S.replace(c, "[0-9]", "#").alias("replaced"), S.replace(c, "[0-9]", "#", n=1).alias("replaced_once"), F.length(c).alias("n"),
    )


@_r.add(r"""
SELECT p_partkey, substr(p_brand, 1, 1) AS c0, substr(p_brand, -1, 1) AS c_last, array_to_string(regexp_extract_all(p_brand, '.'), '.') AS spread,
       p_brand || repeat('*', greatest(0, 10 - length(p_brand))) AS l_just, repeat('*', greatest(0, 10 - length(p_brand))) || p_brand AS r_just,
       repeat('-', CAST(greatest(0, 11 - length(p_brand)) // 2 AS INTEGER)) || p_brand || repeat('-', CAST(greatest(0, 11 - length(p_brand)) - greatest(0, 11 - length(p_brand)) // 2 AS INTEGER)) AS middle,
       repeat('0', greatest(0, 6 - length(CAST(p_size AS VARCHAR)))) || p_size AS zeros, lower(p_type) AS low, upper(p_type) AS up, trim(p_brand, 'B1') AS stripped, ltrim(p_brand, 'Bra') AS l_stripped,
       rtrim(p_brand, '123') AS r_stripped, CAST(len(string_split(p_type, ' ')) AS INTEGER) AS n_parts, string_split(p_type, ' ')[1] AS part0, repeat(p_brand, 2) AS twice,
       substr(p_brand, 2, 3) AS sliced, substr(p_brand, greatest(length(p_brand) - 2, 0) + 1) AS tail, translate(p_brand, 'Brand', 'bRAND') AS swapped
FROM part""")
def string_shape(spark, d):
    """Padding, stripping, splitting and slicing."""
    c, t = F.col("p_brand"), F.col("p_type")
    return table(spark, d, "part").select(
        "p_partkey", S.get(c, 0).alias("c0"), S.get(c, -1).alias("c_last"), S.join_characters(c, ".").alias("spread"), S.ljust(c, 10, "*").alias("l_just"), S.rjust(c, 10, "*").alias("r_just"),
        S.pad(c, 11, "both", "-").alias("middle"), S.zfill(F.col("p_size").cast("string"), 6).alias("zeros"), F.lower(t).alias("low"), F.upper(t).alias("up"), S.strip(c, "B1").alias("stripped"),
        S.lstrip(c, "Bra").alias("l_stripped"), S.rstrip(c, "123").alias("r_stripped"), F.size(S.split(t, " ")).alias("n_parts"), F.get(S.split(t, " "), F.lit(0)).alias("part0"),
        S.repeat(c, 2).alias("twice"), S.slice_(c, 1, 4).alias("sliced"), S.slice_(c, -2).alias("tail"), S.swapcase(c).alias("swapped"),
    )


@_r.add(r"""
WITH t AS (SELECT o_orderkey, o_orderpriority AS p, CAST(o_orderkey AS VARCHAR) AS k FROM orders)
SELECT o_orderkey, regexp_matches(p, '^[A-Za-z0-9]+$') AS alnum, regexp_matches(p, '^[A-Za-z]+$') AS alpha, regexp_matches(k, '^[0-9]+$') AS digit, regexp_matches(k, '^[0-9]+$') AS num,
       regexp_matches(k, '^[0-9]+$') AS dec, regexp_matches(p, '^\s+$') AS space, p = lower(p) AND p <> upper(p) AS low, p = upper(p) AND p <> lower(p) AS up FROM t""")
def string_tests(spark, d):
    """Character class tests."""
    p, k = F.col("o_orderpriority"), F.col("o_orderkey").cast("string")
    return table(spark, d, "orders").select(
        "o_orderkey", S.is_alnum(p).alias("alnum"), S.is_alpha(p).alias("alpha"), S.is_digit(k).alias("digit"), S.is_numeric(k).alias("num"), S.is_decimal(k).alias("dec"),
        S.is_space(p).alias("space"), S.is_lower(p).alias("low"), S.is_upper(p).alias("up"),
    )


@_r.add("""
SELECT c_custkey, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS titled, c_mktsegment = upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS is_titled, CAST(c_custkey AS VARCHAR) AS got,
       CAST(2 AS INTEGER) AS n_keys, strptime('2024-03-' || lpad(CAST(c_custkey % 31 + 1 AS VARCHAR), 2, '0'), '%Y-%m-%d') AS day
FROM customer""")
def string_parse(spark, d):
    """Title case, text to map, text to time."""
    k = F.col("c_custkey")
    text = F.concat(F.lit("k="), k.cast("string"), F.lit(",z=1"))
    t = table(spark, d, "customer")
    return t.select(
        "c_custkey", S.title("c_mktsegment").alias("titled"), S.is_title("c_mktsegment").alias("is_titled"), N.key(S.to_dict(text), "k").alias("got"), N.size(S.to_dict(text)).alias("n_keys"),
        S.strptime(F.concat(F.lit("2024-03-"), F.lpad((k % 31 + 1).cast("string"), 2, "0")), "%Y-%m-%d").cast("timestamp_ntz").alias("day"),
    )


@_r.add("""
SELECT event_id, date_trunc('day', ts)::TIMESTAMP AS d_day, strftime(ts, '%H:%M:%S') AS d_time, CAST(year(ts) AS INTEGER) AS d_year, CAST(month(ts) AS INTEGER) AS d_month, CAST(day(ts) AS INTEGER) AS d_dom,
       CAST(hour(ts) AS INTEGER) AS d_hour, CAST(minute(ts) AS INTEGER) AS d_minute, CAST(second(ts) AS INTEGER) AS d_second, CAST(microsecond(ts) % 1000000 AS BIGINT) AS d_us, CAST(weekofyear(ts) AS INTEGER) AS d_week,
       CAST(isodow(ts) - 1 AS INTEGER) AS d_weekday, CAST(dayofyear(ts) AS INTEGER) AS d_doy, CAST(floor(epoch(ts)) AS BIGINT) AS d_unix, day(ts) = 1 AS month_start, CAST(ts AS DATE) = last_day(ts) AS month_end,
       dayofyear(ts) = 1 AS year_start, month(ts) = 12 AND day(ts) = 31 AS year_end, strftime(ts, '%Y/%m/%d %H:%M') AS text,
       ts + INTERVAL 1 YEAR AS y1, ts - INTERVAL 1 MONTH AS m1, ts + INTERVAL 10 DAY AS d10, ts + INTERVAL 5 HOUR AS h5, ts - INTERVAL 90 MINUTE AS mi90, ts + INTERVAL 30 SECOND AS s30, ts + INTERVAL 250 MILLISECOND AS ms250
FROM events""")
def date_functions(spark, d):
    """Parts of a time, tests, text and shifts."""
    t = F.col("ts")
    return table(spark, d, "events").select(
        "event_id", D.day_of(t).cast("timestamp_ntz").alias("d_day"), D.time_of(t).alias("d_time"), F.year(t).alias("d_year"), F.month(t).alias("d_month"), F.dayofmonth(t).alias("d_dom"), F.hour(t).alias("d_hour"),
        F.minute(t).alias("d_minute"), F.second(t).alias("d_second"), D.microsecond(t).alias("d_us"), F.weekofyear(t).alias("d_week"), D.weekday(t).alias("d_weekday"), F.dayofyear(t).alias("d_doy"),
        D.unix_timestamp(t).alias("d_unix"), D.is_month_start(t).alias("month_start"), D.is_month_end(t).alias("month_end"), D.is_year_start(t).alias("year_start"), D.is_year_end(t).alias("year_end"),
        D.strftime(t, "%Y/%m/%d %H:%M").alias("text"), *[D.shift(t, u, n).alias(a) for a, u, n in (("y1", "year", 1), ("m1", "month", -1), ("d10", "day", 10), ("h5", "hour", 5), ("mi90", "minute", -90), ("s30", "second", 30))],
        D.shift(t, "microsecond", 250_000).alias("ms250"),
    )


@_r.add("""
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, embedding[1] AS first, embedding[len(embedding)] AS last, CAST(NULL AS FLOAT) AS beyond, list_contains(embedding, embedding[2]) AS has,
       list_sort(embedding)[1] AS least FROM embeddings""")
def array_functions(spark, d):
    """Size, places, membership and order of arrays."""
    e = F.col("embedding")
    return table(spark, d, "embeddings").select(
        "vec_id", N.size(e).alias("n"), N.item(e, 0).alias("first"), N.item(e, -1).alias("last"), N.item(e, 100_000).alias("beyond"), N.contains(e, N.item(e, 1)).alias("has"), N.item(N.sort(e), 0).alias("least")
    )


@_r.add("""
SELECT r_regionkey, r_name AS v, CAST(2 AS INTEGER) AS n, CAST(NULL AS VARCHAR) AS missing, 'k' AS key0, r_name AS value0, CAST(r_regionkey + 1 AS INTEGER) AS second FROM region""")
def map_functions(spark, d):
    """Construction and lookup of maps and lists."""
    m = N.make_dict(F.lit("k"), F.col("r_name"), F.lit("z"), F.lit("y"))
    return table(spark, d, "region").select(
        "r_regionkey", N.key(m, "k").alias("v"), N.size(m).alias("n"), N.key(m, "q").alias("missing"), N.item(F.map_keys(m), 0).alias("key0"), N.item(F.map_values(m), 0).alias("value0"),
        N.item(N.make_list("r_regionkey", F.col("r_regionkey") + 1), 1).alias("second"),
    )


@_r.add("""
SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, embedding[i] AS x FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""")
def explode_positions(spark, d):
    """A row per element with its place."""
    return N.explode(table(spark, d, "embeddings").select("vec_id", "embedding"), "embedding", ["pos", "x"], pos=True)


@_r.add("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_fields(spark, d):
    """A field of JSON text."""
    return table(spark, d, "events").select("event_id", N.json_field(F.col("props"), "$.k", "long").alias("k"))


@_r.add("""
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE string_split(o_orderpriority, '-') END AS a FROM orders)
SELECT o_orderkey, unnest(a) AS piece FROM t WHERE a IS NOT NULL UNION ALL SELECT o_orderkey, NULL FROM t WHERE a IS NULL""")
def explode_outer(spark, d):
    """A row per element, and one for a NULL array."""
    t = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, S.split(F.col("o_orderpriority"), "-")).alias("a"))
    return N.explode(t, "a", ["piece"], keep_nulls=True)


@_r.add("""
SELECT o_orderkey, CASE WHEN len(string_split(p, '-')) <= 2 THEN string_split(p, '-') ELSE [array_to_string(string_split(p, '-')[:-2], '-'), string_split(p, '-')[-1]] END AS cut, string_split(p, '-') AS whole
FROM (SELECT o_orderkey, o_orderpriority || '-' || o_orderstatus AS p FROM orders)""")
def string_split_right(spark, d):
    """Pieces cut from the right."""
    p = F.concat("o_orderpriority", F.lit("-"), "o_orderstatus")
    return table(spark, d, "orders").select("o_orderkey", S.rsplit(p, "-", 1).alias("cut"), S.rsplit(p, "-").alias("whole"))


@_r.add("SELECT event_id, CAST(floor((microsecond(ts) % 1000000) / 1000) AS BIGINT) AS ms FROM (SELECT event_id, ts + to_microseconds(event_id * 1777) AS ts FROM events)")
def date_milliseconds(spark, d):
    """Milliseconds within the second."""
    t = D.shift(F.col("ts"), "microsecond", F.col("event_id") * 1777)
    return table(spark, d, "events").select("event_id", D.millisecond(t).alias("ms"))


@_r.add("SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(1 AS BIGINT) AS hashes FROM orders GROUP BY 1, 2")
def hash_columns(spark, d):
    """Rows and distinct hashes of each pair of values: equal values hash alike."""
    h = E.digest(F.col("o_orderstatus"), F.col("o_orderpriority"))
    return table(spark, d, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.count_distinct(h).alias("hashes"))
