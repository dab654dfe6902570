"""Benchmark decontamination as a prefix-filtered set join.

The sets are the word shingles of benchmark windows (item-sized, WINDOW words) and of
documents; an item window must be contained whole. Shingles are ordered by rarity in
the documents. For containment of all shingles the necessary prefix is the single
rarest one, so only that one is joined; a window with a shingle that no document has
is dropped. The shingle's place in the window and the document's length bound where
the window can lie; the words there are then compared exactly.

Documents are read twice: once to count the benchmark's shingles, once to count their
words and note the places of prefix shingles with the words around them. Which
shingles matter is sent to the tasks as a sorted hash list. A benchmark of more than
SENT shingles is cut into slices by hash, with a reading of the documents for each, so
what is sent stays bounded and document shingles are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import buffers, gram_hashes, in_arrow, let, pieces, stored, word_bounds, word_hashes

WINDOW, SHINGLE = 10, 5

#: Benchmark shingles whose hashes are sent to a task at once (8 bytes each); places in a row.
SENT, PLACES = 2_000_000, 10_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _word_table() -> np.ndarray:
    t = np.zeros(256, bool)
    t[0x30:0x3A] = t[0x61:0x7B] = t[0x80:] = True
    return t


def _tokens(batch: pa.RecordBatch) -> tuple:
    text, off = buffers(batch.column(1))
    text = _LOWER[text]
    starts, ends, first = word_bounds(text, off, _word_table())
    return text, starts, ends, first


def _hash(words: np.ndarray, n: int) -> np.ndarray:
    return gram_hashes(words, n) + np.uint64(n)


def _windows(window: int, shingle: int):
    """(id, text) of items to one row per window and shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            text, starts, ends, first = _tokens(batch)
            words = word_hashes(text, starts, ends)
            body = text.tobytes()
            rows = []
            for i, item in enumerate(batch.column(0).to_pylist()):
                a, b = int(first[i]), int(first[i + 1])
                size = min(window, b - a)
                if not size:
                    continue
                s = min(shingle, size)
                h = _hash(words[a:b], s).view(np.int64).tolist()
                tokens = [body[x:y].decode() for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist())]
                for w in range(b - a - size + 1):
                    span = " ".join(tokens[w : w + size])
                    rows += [(item, span, size, s, k, h[w + k]) for k in range(size - s + 1)]
            cols = list(zip(*rows)) or [[]] * 6
            kinds = [batch.column(0).type, pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["item", "span", "size", "width", "place", "h"])

    return run


def _found(words: np.ndarray, first: np.ndarray, wanted: dict[int, np.ndarray]) -> Iterator[tuple]:
    """For each shingle size the places whose shingle is wanted and lies in one document."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for s, own in wanted.items():
        h = _hash(words, s)
        at = np.flatnonzero(doc[: len(h)] == doc[s - 1 :]) if len(h) else np.zeros(0, int)
        x = h[at].view(np.int64)
        at = at[own[np.minimum(np.searchsorted(own, x), len(own) - 1)] == x]
        if len(at):
            yield s, at, h[at].view(np.int64), doc[at]


def _counts(wanted):
    """(key, text) to occurrences of wanted shingles, summed per piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            text, starts, ends, first = _tokens(batch)
            words = word_hashes(text, starts, ends)
            for _, _, h, _ in _found(words, first, wanted.value):
                value, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(n.astype(np.int64))], ["h", "n"])

    return run


_PLACE = "h long, pos int, before int, reach int, around string"


def _places(wanted, window: int):
    """(key, text) to rows (key, n_words, places): n_words in the first row of each document.

    A place is a prefix shingle with the words up to a window's reach around it; one
    row holds PLACES of them at most.
    """
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
    names = [x.split()[0] for x in _PLACE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            text, starts, ends, first = _tokens(batch)
            words = word_hashes(text, starts, ends)
            body = text.tobytes()
            docs, rows = [np.arange(batch.num_rows)], []
            for s, at, h, doc in _found(words, first, wanted.value):
                lo = np.maximum(at - (window - s), first[doc])
                hi = np.minimum(at + window, first[doc + 1])
                around = [
                    b" ".join([body[x:y] for x, y in zip(starts[p:q].tolist(), ends[p:q].tolist())]).decode()
                    for p, q in zip(lo.tolist(), hi.tolist())
                ]
                docs.append(doc)
                rows += zip(h.tolist(), (at - first[doc]).tolist(), (at - lo).tolist(), (hi - lo).tolist(), around)
            doc = np.concatenate(docs)
            order = np.argsort(doc, kind="stable")  # a document's count, then its places
            doc = doc[order]
            begin = np.searchsorted(doc, doc)
            nth = np.arange(len(doc)) - begin - 1
            lead = np.flatnonzero((nth == -1) | ((nth > 0) & (nth % PLACES == 0)))
            of = doc[lead]
            counted = nth[lead] == -1
            place = order[nth >= 0] - batch.num_rows
            off = np.append(lead - (of + 1) + counted, len(place))  # counts before a row's first place: one for each document so far
            held = [rows[i] for i in place.tolist()]
            cols = list(zip(*held)) or [[]] * len(kinds)
            places = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)
            n = np.diff(first)[of]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of)), pa.array(n.astype(np.int64), mask=~counted), pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), places)],
                ["key", "n_words", "places"],
            )

    return run


def row_key(id_col: str, text_col: str) -> Column:
    """What tells rows apart: the id (which may be null) and a hash of it and the text."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).alias("h"))


def matched(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (key, n_words) of docs, their occurrences (key, span, a, size) from word a on, and the items of spans (span, item).

    Words are runs outside ASCII other than letters and digits, after lower-casing
    A-Z. Null and empty texts have no words and never match. key is row_key().
    """
    spark = docs.sparkSession
    kind = items.schema[item_col].dataType.simpleString()
    rows = items.select(F.col(item_col).alias("item"), F.col(item_text).alias("text"))
    grams = stored(in_arrow(rows, _windows(window, shingle), f"item {kind}, span string, size int, width int, place int, h long"), "windows")
    texts = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    key_kind = texts.schema["key"].dataType.simpleString()

    def sent(table: DataFrame):
        """The hashes by shingle size, a slice at a time; one empty slice without any."""
        hashes = table.select("width", "h").distinct()
        slices = max(1, -(-hashes.count() // SENT))
        for i in range(slices):
            held = hashes.where(F.pmod(F.xxhash64("h"), F.lit(slices)) == i).toPandas()  # about SENT rows
            yield spark.sparkContext.broadcast({int(s): np.sort(g["h"].to_numpy()) for s, g in held.groupby("width")})

    counted = reduce(DataFrame.union, [in_arrow(texts, _counts(w), "h long, n long") for w in sent(grams)]).groupBy("h").agg(F.sum("n").alias("n"))
    # a shingle that no document has drops its windows
    ranked = grams.join(counted, "h", "left").groupBy("span", "size", "width").agg(
        F.min(F.coalesce("n", F.lit(0))).alias("least"),
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "place")).alias("rare"),
    )
    prefix = stored(ranked.where("least > 0").select("span", "size", "width", "rare.h", "rare.place"), "prefix")
    read = [stored(in_arrow(texts, _places(w, window), f"key {key_kind}, n_words long, places array<struct<{_PLACE.replace(' ', ':').replace(',:', ',')}>>"), "places") for w in sent(prefix)]
    places = reduce(DataFrame.union, [r.select("key", F.inline("places")) for r in read])
    words = F.split("around", " ", -1)
    begin = F.col("before") - F.col("place")
    # positional and length bounds, then the words themselves
    hit = (
        places.join(prefix, "h")
        .where((begin >= 0) & (begin + F.col("size") <= F.col("reach")))
        .where(F.array_join(F.slice(words, begin + 1, F.col("size")), " ") == F.col("span"))
        .select("key", "span", (F.col("pos") - F.col("place")).alias("a"), "size")
    )
    return read[0].where("n_words IS NOT NULL").select("key", "n_words"), hit, grams.select("span", "item").distinct()


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Per row of docs: id, n_words, n_hit (words inside any occurrence) and items (sorted as strings).

    A document without a hit has 0 and an empty array. Rows that repeat an id and rows
    without one have hits of their own. An empty benchmark hits nothing; an item without
    an id hits, but isn't among the items. Other columns are left out.
    """
    rows, hit, named = matched(docs, items, id_col, text_col, item_col, item_text, window, shingle)
    # words covered: each start adds what lies beyond the furthest end so far
    walk = lambda s: F.aggregate(
        s,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["a"] + x["size"] - F.greatest(acc["to"], x["a"]))).cast("long").alias("n"),
            F.greatest(acc["to"], x["a"] + x["size"]).alias("to"),
        ),
    )["n"]
    hit = stored(hit, "hits")  # read for the words and for the items
    runs = hit.groupBy("key", "a").agg(F.max("size").alias("size")).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("a", "size"))).alias("runs"))
    # a document's spans first, so an item whose window stands often in it counts once
    met = hit.select("key", "span").distinct().join(named, "span").groupBy("key").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
    out = rows.join(runs.select("key", let(F.col("runs"), walk).alias("n_hit")), "key", "left").join(met, "key", "left")
    return out.select(
        F.col("key.id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Words of every document that a benchmark window covers, and whose."""
    from lakeloom.session import table

    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i:i+k-1], ' ') AS g FROM (
    SELECT item_id, ws, least(10, len(ws)) AS k, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i
    FROM b WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (
  SELECT doc_id, i, k, array_to_string(ws[i:i+k-1], ' ') AS g FROM (
    SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, ks WHERE len(ws) >= k)),
h AS (SELECT dw.doc_id, dw.i, dw.k, iw.item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.g = iw.g),
c AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM (
    SELECT doc_id, i, unnest(range(0, k)) AS j FROM (SELECT DISTINCT doc_id, i, k FROM h)) GROUP BY doc_id),
n AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""
