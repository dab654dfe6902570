"""Scoring documents with the recurrent language model, counts taken from the whole corpus.

1. All training tokens are counted by word hash (64 bits) with their shape; the
   counts stay a table.
2. The most frequent words (a documented number) go to the tasks with their counts;
   one task gives the model its first weights on a share of the training texts taken by
   hash, and it is then trained on all of them: tasks run over their parts of the texts
   from the same weights, and the weights are averaged after each round. No text comes
   to the driver.
3. One pass scores every document; words outside the frequent ones leave it as
   (document, word, times) rows.
4. Those meet the counts table on the word, and their sums return to the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm import recurrent_lm as lm
from lakeloom.llm.common import blank_table, buffers, fold, held_out, in_arrow, pieces, stored, word_bounds, word_hashes

#: Frequent words sent to tasks (24 bytes each).
FREQUENT = 200_000

#: First weights: tokens of the share of texts (about), passes over it, lanes, rate.
FIRST_TOKENS, FIRST_PASSES, FIRST_LANES, FIRST_RATE = 300_000, 3, 96, 4e-3

#: Training on all texts: tokens of a part, rounds after which weights are averaged, tokens a task holds at once, lanes, rate.
PART_TOKENS, ROUNDS, HELD_TOKENS, LANES, RATE = 4_000_000, 3, 500_000, 512, 4e-3

#: Words of a window of back-propagation.
WINDOW = 24

#: Rows in which a task hands over its weights; parts whose weights are averaged in one group.
SLOTS, TOGETHER = 64, 256

#: Tokens that are scored together: a group takes as many steps as its longest text has words, the last ones for few texts.
GROUP = 2_000_000

#: The hash of the end of a text.
END = np.uint64(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_TAILS = np.zeros(256, np.int64)  # endings: letter or digit, stop, comma, and five kinds of symbols
for _i, _group in enumerate((".", ",", "!", "*&", "$%", "#|<>", "-;:?\"')(")):
    _TAILS[[ord(c) for c in _group]] = _i + 1


def _tokens(batch: pa.RecordBatch, column: int) -> tuple:
    """Hash and shape of the words of a piece, and words before each document."""
    text, off = buffers(batch.column(column))
    text = _LOWER[text]
    starts, ends, first = word_bounds(text, off, blank_table())
    h = word_hashes(text, starts, ends)
    h[h == END] += np.uint64(1)
    high = np.concatenate([[0], np.cumsum(text >= 128)])
    far = high[ends] - high[starts]
    where = np.flatnonzero(text >= 128)
    alphabet = np.zeros(len(starts), np.int64)
    some = far > 0
    if some.any():  # the second byte of the first letter beyond ASCII
        at = where[high[starts[some]]]
        alphabet[some] = 1 + text[np.minimum(at + 1, len(text) - 1)] % 3
    tail = _TAILS[text[np.maximum(ends - 1, 0)]] if len(starts) else np.zeros(0, np.int64)
    shape = alphabet * 16 + tail * 2 + (ends - starts > 7)
    return h, shape, first


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (h, shape, n), summed per piece; the end counts once per text."""
    for batch in pieces(batches, 0):
        h, shape, _ = _tokens(batch, 0)
        value, at, n = np.unique(h, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(value, END).view(np.int64)), pa.array(np.append(shape[at], 0).astype(np.int32)), pa.array(np.append(n, batch.num_rows).astype(np.int64))],
            ["h", "shape", "n"],
        )


class _Tables:
    """What tasks need: frequent words with counts and numbers, totals, and the model."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, numbers: np.ndarray, shapes: np.ndarray, total: int, distinct: int, ends: int, model: lm.Model | None = None):
        self.words, self.counts, self.numbers = words, counts, numbers  # words ascend
        self.head = np.searchsorted(words, np.arange(1 << 18, dtype=np.uint64) << np.uint64(46))  # first of each 18 leading bits
        self.head = np.append(self.head, len(words))
        self.shapes, self.total, self.distinct, self.ends, self.model = shapes, total, distinct, ends, model

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the frequent words, and whether it is one."""
        if not len(self.words):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        lead = (h >> np.uint64(46)).astype(np.int64)
        at, stop, last = self.head[lead], self.head[lead + 1], len(self.words) - 1
        known = self.words[np.minimum(at, last)] == h
        open_ = np.flatnonzero(~known & (at + 1 < stop))
        while len(open_):  # as often as the most words share their leading bits
            at[open_] += 1
            hit = self.words[at[open_]] == h[open_]
            known[open_[hit]] = True
            open_ = open_[~hit & (at[open_] + 1 < stop[open_])]
        return np.minimum(at, last), known

    def number(self, at: np.ndarray, known: np.ndarray, shape: np.ndarray) -> np.ndarray:
        """The model's token: a vocabulary number or the shape's."""
        own = np.where(known, self.numbers[at], -1) if len(self.words) else np.full(len(shape), -1)
        return np.where(own >= 0, own, lm.VOCABULARY + shape)

    def end(self) -> int:
        at, known = self.find(np.array([END]))
        return int(self.number(at, known, np.zeros(1, np.int64))[0])


def _numbered(tables):
    """(h, text) to h and the model's tokens, the end included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = tables.value
        for batch in pieces(batches):
            h, shape, first = _tokens(batch, 1)
            at, known = held.find(h)
            flow = np.insert(held.number(at, known, shape), first[1:], held.end())
            off = first + np.arange(len(first))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(flow.astype(np.int32)))], ["h", "tokens"])

    return run


def _trained(weights, first: float, last: float, lanes: int, passes: int = 1):
    """(h, tokens) of a part to its weights, as (slot, part, n, v): n tokens, v a slice of the weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, n, size, texts = lm.Trainer(weights.value), 0, 0, []

        def learn() -> None:
            for i in range(passes):
                trainer.run(texts, lanes, WINDOW, *(first + (last - first) * (i + k) / passes for k in (0, 1)))

        for batch in batches:
            off = batch.column(1).offsets.to_numpy().astype(np.int64)
            flow = batch.column(1).flatten().to_numpy().astype(np.int64)
            texts += np.split(flow, (off - off[0])[1:-1]) if batch.num_rows else []
            size += len(flow)
            if size >= HELD_TOKENS:
                learn()
                n, size, texts = n + size, 0, []
        if size:
            learn()
        if n + size:
            cut = np.array_split(lm.packed(lm.Model(trainer.p)), SLOTS)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(SLOTS, dtype=np.int32)), pa.array(np.full(SLOTS, TaskContext.get().partitionId(), np.int32)),
                    pa.array(np.full(SLOTS, n + size)), pa.array([c.tobytes() for c in cut], pa.binary()),
                ],
                ["slot", "part", "n", "v"],
            )

    return run


def _mean(table: pa.Table) -> pa.Table:
    """Rows of a slot and group to their mean, weighted by tokens; in a fixed order, so that sums come out alike."""
    rows = sorted(zip(table["n"].to_pylist(), table["v"].to_pylist()))
    total = sum(n for n, _ in rows)
    mean = sum(np.frombuffer(v, np.float32).astype(np.float64) * (n / total) for n, v in rows)
    return pa.table({"slot": table["slot"].slice(0, 1), "part": table["part"].slice(0, 1), "n": pa.array([total], pa.int64()), "v": pa.array([mean.astype(np.float32).tobytes()], pa.binary())})


def _averaged(done: DataFrame, parts: int) -> DataFrame:
    """The mean of all parts per slot, by groups of TOGETHER parts, then of groups, and so on."""
    while True:
        parts = -(-parts // TOGETHER)
        group = F.floor(F.col("part") / TOGETHER).cast("int") if parts > 1 else F.lit(0)
        grouped = done.withColumn("part", group).groupBy("slot", "part")
        done = grouped.applyInArrow(_mean, "slot int, part int, n long, v binary")
        if parts <= 1:
            return done


def train_on_all(docs: DataFrame, held: _Tables, id_col: str = "doc_id", text_col: str = "text") -> lm.Model:
    """held.model after first weights and one pass over every text of docs.

    The first weights are learned in one task, on the share of texts whose hash is
    least, of about FIRST_TOKENS tokens whatever the size of the corpus. Then all texts
    are dealt to parts and rounds by a hash, so a part is a cross-section of the corpus
    whatever the files are sorted by. The number of parts grows with the tokens.
    """
    spark = docs.sparkSession
    numbers = spark.sparkContext.broadcast(held)
    parts = -(-held.total // PART_TOKENS)
    rounds = ROUNDS if held.total > HELD_TOKENS else 1
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.xxhash64(F.col(id_col), text).alias("h"), text.alias("text"))

    def learned(model: lm.Model, some: DataFrame, parts: int, *how) -> lm.Model:
        dealt = in_arrow(some, _numbered(numbers), "h long, tokens array<int>").repartition(parts, "h").sortWithinPartitions("h")
        done = in_arrow(dealt, _trained(spark.sparkContext.broadcast(model), *how), "slot int, part int, n long, v binary")
        got = {r["slot"]: r["v"] for r in stored(_averaged(done, parts), "weights").collect()}  # the model's size
        return lm.unpacked(np.concatenate([np.frombuffer(got[k], np.float32) for k in range(SLOTS)]), model) if got else model

    if not held.total:
        return held.model
    share = F.shiftrightunsigned(F.xxhash64("h"), 12) < int(min(1.0, FIRST_TOKENS / held.total) * (1 << 52))
    model = learned(held.model, rows.where(share), 1, FIRST_RATE, FIRST_RATE / 10, FIRST_LANES, FIRST_PASSES)
    for i in range(rounds):
        some = rows.where(F.pmod(F.shiftrightunsigned("h", 20), F.lit(rounds)) == i)
        model = learned(model, some, parts, *(RATE * (1 - 0.9 * (i + k) / rounds) for k in (0, 1)), LANES)
    return model


_SCORED = "n_tokens long, n_known long, base double, model double, rare array<struct<h:long,m:int>>"


def _scored(tables):
    """(row, text) to sums over frequent words, and the other words with their times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Tables = tables.value
        unit = np.log10(held.total + held.distinct + 1)
        share = np.log10(held.shapes)  # tokens, words and one unseen word of each shape
        end_count, end = held.ends, held.end()
        done, texts, rows = [], [], []

        def flush():
            model = lm.log10_likelihood(held.model, texts)
            whole = [pa.concat_arrays(c) for c in zip(*done)]
            out = pa.RecordBatch.from_arrays(
                [pa.concat_arrays(rows), *whole[:3], pa.array(whole[3].to_numpy() + model), whole[4]],
                ["row", "n_tokens", "n_known", "base", "model", "rare"],
            )
            done.clear(), texts.clear(), rows.clear()
            return out

        for batch in pieces(batches):
            h, shape, first = _tokens(batch, 1)
            n = batch.num_rows
            doc = np.repeat(np.arange(n), np.diff(first))
            at, known = held.find(h)
            flow = held.number(at, known, shape)
            count = np.where(known, held.counts[at], 0) if len(held.words) else np.zeros(len(h))
            gain = np.log10(count + 1.0)
            base = np.bincount(doc, weights=gain - unit, minlength=n) + np.log10(end_count + 1.0) - unit
            outside = flow >= lm.VOCABULARY
            extra = np.where(outside, gain - share[np.where(outside, flow - lm.VOCABULARY, 0)], 0.0)
            model = np.bincount(doc, weights=extra, minlength=n)
            if end >= lm.VOCABULARY:
                model += np.log10(end_count + 1.0) - share[end - lm.VOCABULARY]
            seen = np.bincount(doc, weights=known, minlength=n).astype(np.int64) + int(end_count > 0)
            rare = ~known
            d, x = doc[rare], h[rare]
            order = np.lexsort((x, d))
            d, x = d[order], x[order]
            new = np.ones(len(d), bool)
            new[1:] = (d[1:] != d[:-1]) | (x[1:] != x[:-1])
            lead = np.flatnonzero(new)
            times = np.diff(np.append(lead, len(d)))
            off = np.searchsorted(d[lead], np.arange(n + 1)).astype(np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(x[lead].view(np.int64)), pa.array(times.astype(np.int32))], ["h", "m"])
            done.append([pa.array(np.diff(first) + 1), pa.array(seen), pa.array(base), pa.array(model), pa.ListArray.from_arrays(pa.array(off), pairs)])
            rows.append(batch.column(0))
            whole = np.insert(flow, first[1:], end)
            texts += np.split(whole, (first + np.arange(n + 1))[1:-1])
            if sum(map(len, texts)) >= GROUP:
                yield flush()
        if rows:
            yield flush()

    return run


def counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(h, shape, n): how often each word occurs in all texts; the end is a word too."""
    tally = in_arrow(docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")), _counted, "h long, shape int, n long")
    return tally.groupBy("h").agg(F.min("shape").alias("shape"), F.sum("n").alias("n"))


def _most_frequent(table: DataFrame, n: int) -> DataFrame:
    """The n rows of greatest count.

    A first cut at the count that about n rows reach (found on a histogram of eighths
    of powers of two) leaves few rows for the final sort.
    """
    level = F.floor(F.log2("n") * 8)
    steps = sorted(((r["level"], r["count"]) for r in table.groupBy(level.alias("level")).count().collect()), reverse=True)
    seen, least = 0, 0
    for least, count in steps:
        seen += count
        if seen >= n:
            break
    return table.where(level >= least).orderBy(F.desc("n"), "h").limit(n)


def learn(docs: DataFrame, table: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> _Tables:
    """Frequent words and totals of a counts table, and a model trained on all docs."""
    top = _most_frequent(table, FREQUENT).toPandas()  # bounded by FREQUENT
    total = table.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(F.sum(F.when(F.col("h") == int(END), F.col("n"))), F.lit(0)).alias("ends")
    ).first()
    vocabulary = top.iloc[: lm.VOCABULARY]
    shapes = np.zeros((lm.SHAPES, 2))
    for r in table.groupBy("shape").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        shapes[r["shape"]] = r["n"], r["v"]
    np.subtract.at(shapes, vocabulary["shape"].to_numpy(np.int64), np.stack([vocabulary["n"], np.ones(len(vocabulary))], 1))
    words = top["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    number = np.where(np.arange(len(top)) < lm.VOCABULARY, np.arange(len(top)), -1)
    held = _Tables(words[order], top["n"].to_numpy(np.int64)[order], number[order], shapes.sum(1) + 1, int(total["n"]), int(total["v"]), int(total["ends"]))
    held.model = lm.new_model(vocabulary["n"].to_numpy(float), shapes[:, 0])
    held.model = train_on_all(docs, held, id_col, text_col)
    return held


def score(docs: DataFrame, tables: _Tables, table: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) per row of docs.

    score is the model's log10 probability of the whole text and its end, base_score
    that of add-one unigrams. A null or empty text is its end alone. Rows that repeat
    an id are scored on their own. With nothing learned every word is unseen.
    """
    spark = docs.sparkSession
    rows = docs.select(F.struct(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id")).alias("row"), F.col(text_col).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    done = stored(in_arrow(rows, _scored(spark.sparkContext.broadcast(tables)), f"row {kind}, {_SCORED}"), "scored")
    rare = done.select(F.col("row.key").alias("key"), F.explode("rare").alias("w")).select("key", "w.h", "w.m")
    found = rare.join(table.select("h", "n"), "h", "left").groupBy("key").agg(
        F.sum(F.col("m") * F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("gain"), F.sum(F.when(F.col("n").isNotNull(), F.col("m")).otherwise(0)).alias("known")
    )
    met = done.select("row.key", "row.id", "n_tokens", "n_known", "base", "model").join(found, "key", "left")
    gain = F.coalesce("gain", F.lit(0.0))
    return met.select(
        F.col("id").alias(id_col), "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        (F.col("base") + gain).alias("base_score"), (F.col("model") + gain).alias("score"),
    )


def fit_and_score(docs: DataFrame, keep: Column, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, _Tables]:
    """Scores of all docs, learned from those where keep holds; and what was learned."""
    train = docs.where(keep)
    table = stored(counts(train, text_col), "counts")
    tables = learn(train, table, id_col, text_col)
    return score(docs, tables, table, id_col, text_col), tables


def op3_lm(spark, sf_dir: str) -> DataFrame:
    """Log10 probability of every document, learned outside fold 2 of 7."""
    from lakeloom.session import table

    out, tables = fit_and_score(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)
    return out.select("doc_id", held_out("doc_id", 7, 2).alias("held_out"), "n_tokens", "n_known", F.lit(tables.total).cast("long").alias("train_tokens"), "base_score", "score")
