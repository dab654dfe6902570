"""Toxicity from a weighted lexicon, matched by Aho-Corasick after folding.

Texts are lower-cased, homoglyphs and digit substitutions are folded to letters, and
what is no letter becomes one space. Lexicon entries are word beginnings whose
documents are toxic far more often than clean, learned from a bounded sample of
labelled rows; an entry's weight is its log odds. Exception phrases take the entries
inside them out: those that a caller gives, and two-word phrases around an entry that
stand in clean documents of the sample far more often than the entry does. The sum of
weights over the length in words goes through a logistic curve fitted on the same
sample.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import fold, held_out, in_arrow, labelled_sample, pieces, stored

#: Labelled rows per class that the lexicon is learned from.
PER_CLASS = 4000
#: Beginnings of SHORT to LONG letters; toxic cases that a candidate has at least.
SHORT, LONG, CASES = 4, 12, 4
#: Entries expected by chance: the log likelihood ratio asked for is that of one case in candidates / CHANCE.
CHANCE = 0.05
#: Log odds that an entry must reach (about 33 to 1); log likelihood ratio that a learned exception must reach.
WEIGHT, SPARED = 3.5, 8.0

#: Letters of other scripts that look like Latin ones, and digits read as letters.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "ԁ": "d", "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ѵ": "v", "ԝ": "w", "ɡ": "g",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ⅼ": "l", "ո": "n", "ս": "u", "օ": "o",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}

class _Fold(dict):
    """Code point to its folded form, filled as code points are met."""

    def __missing__(self, point: int):
        c = chr(point)
        if 0xFF21 <= point <= 0xFF5A:
            c = chr(point - 0xFEE0)
        c = HOMOGLYPHS.get(c, DIGITS.get(c, c))
        out = "" if point in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF) else c.lower() if c.isalpha() else " "
        self[point] = out
        return out


_FOLD = _Fold()
_INNER = re.compile(r"(?<=[^\W_])[@$](?=[^\W_])")


def folded(text: str) -> list[str]:
    """The words of a text after folding."""
    text = text.lower()
    if "@" in text or "$" in text:
        text = _INNER.sub(lambda m: "a" if m[0] == "@" else "s", text)
    return text.translate(_FOLD).split()


@dataclass(frozen=True)
class Lexicon:
    """Entries with weights, exception phrases, and the curve's slope and offset."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    slope: float = 1.0
    offset: float = 0.0


def _automaton(lexicon: Lexicon):
    found = ahocorasick.Automaton()
    for word, w in lexicon.weights.items():
        found.add_word(" " + word, (len(word), w))
    for phrase in lexicon.exceptions:
        key = f" {phrase} "
        held = found.get(key, None)
        found.add_word(key, (len(phrase) + 1, -math.inf) if held is None else held)
    if len(found):
        found.make_automaton()
    return found


def weigh(words: list[str], found) -> float:
    """Sum of weights of matched entries; of nested entries the heaviest of a word counts."""
    if not words or not len(found):
        return 0.0
    text = f" {' '.join(words)} "
    at: dict[int, float] = {}
    spared = []
    for end, (n, w) in found.iter(text):
        if w == -math.inf:
            spared.append((end - n, end))
        else:
            at[end - n + 1] = max(w, at.get(end - n + 1, 0.0))
    spared.sort()
    total, reach, i = 0.0, -1, 0
    for p in sorted(at):  # both are walked once
        while i < len(spared) and spared[i][0] <= p:
            reach = max(reach, spared[i][1])
            i += 1
        if p > reach:
            total += at[p]
    return total


def feature(total: float, n: int) -> float:
    """The weight per hundred words, on a log scale."""
    return math.log1p(100.0 * total / (n + 50.0))


def _weighed(lexicon, back: bool):
    """(row, text) to the sum of weights and the number of words, the text too if back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _automaton(lexicon.value)
        for batch in pieces(batches):
            total, n = [], []
            for text in batch.column(1).to_pylist():
                words = folded(text or "")
                n.append(len(words))
                total.append(weigh(words, found))
            out = [batch.column(0), pa.array(total, pa.float64()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays([*out, batch.column(1)] if back else out, ["row", "total", "n", "text"][: 3 + back])

    return run


def beginnings(word: str) -> list[str]:
    """What may be an entry at the start of a word."""
    return [word[:k] for k in range(SHORT, min(LONG, len(word)) + 1)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(y, text) to the documents of each class that have a beginning, summed per piece."""
    for batch in pieces(batches):
        docs = (Counter(), Counter())
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            docs[y].update({t for w in set(folded(text or "")) for t in beginnings(w)})
        term = list(docs[0] | docs[1])
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.string()), *(pa.array([docs[y][t] for t in term], pa.int64()) for y in (1, 0))], ["term", "a", "c"])


def _sketch(words: list[str]) -> int:
    """The least hash of a text's three-word shingles, which copies and most near copies share."""
    return min((zlib.crc32(" ".join(words[i : i + 3]).encode()) for i in range(max(1, len(words) - 2))), default=0)


def _before(wanted):
    """(y, text) to the distinct (beginning, hash of the word before it, sketch) of toxic documents, for wanted beginnings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            met: set[tuple[str, int, int]] = set()
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = folded(text or "") if y else []
                own = {(t, zlib.crc32(v.encode())) for v, w in zip(["", *words], words) for t in beginnings(w) if t in wanted.value}
                sketch = _sketch(words) if own else 0
                met |= {(t, v, sketch) for t, v in own}
            rows = list(met)
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], k) for j, k in enumerate((pa.string(), pa.int64(), pa.int64()))], ["term", "prev", "sketch"])

    return run


def _phrases(weights):
    """(y, text) to the documents of each class that have a two-word phrase around an entry, summed per piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            docs = (Counter(), Counter())
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = folded(text or "")
                met = set()
                for i, w in enumerate(words):
                    entry = max((t for t in beginnings(w) if t in weights.value), key=lambda t: weights.value[t], default=None)
                    if entry is not None:
                        met |= {(entry, " ".join(words[j : j + 2])) for j in (i - 1, i) if 0 <= j < len(words) - 1}
                docs[y].update(met)
            keys = list(docs[0] | docs[1])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([k[j] for k in keys], pa.string()) for j in (0, 1)), *(pa.array([docs[y][k] for k in keys], pa.int64()) for y in (1, 0))],
                ["entry", "phrase", "a", "c"],
            )

    return run


def surprise(a: float, c: float, share: float) -> float:
    """Log likelihood ratio of a toxic and c clean cases against the share of toxic rows."""
    n = a + c
    return a * math.log(a / (n * share)) + (c * math.log(c / (n * (1 - share))) if c else 0.0)


def entries(cases: dict[str, tuple[int, int]], share: float, least: float) -> dict[str, float]:
    """Of word beginnings with (toxic, clean) cases, the ones of at least that surprise, with their weights.

    A beginning goes if a longer one has nearly its toxic cases and at most half its
    clean ones; a longer one goes if a kept shorter one weighs as much.
    """
    odds = lambda a, c: math.log((a + 0.5) / share) - math.log((c + 0.5) / (1 - share))
    sure = {t: odds(a, c) for t, (a, c) in cases.items() if a > c and surprise(a, c, share) >= least}
    sure = {t: w for t, w in sure.items() if w >= WEIGHT}
    loose = set()
    for t in sure:
        a, c = cases[t]
        for k in range(SHORT, len(t)):
            p = t[:k]
            if p in sure and a >= 0.9 * cases[p][0] and c <= 0.5 * cases[p][1] and cases[p][1]:
                loose.add(p)
    out: dict[str, float] = {}
    for t in sorted(set(sure) - loose, key=lambda t: (len(t), t)):
        if not any(out.get(t[:k], -math.inf) >= sure[t] - 0.5 for k in range(SHORT, len(t))):
            out[t] = sure[t]
    return out


def _candidates(sample: DataFrame, share: float) -> tuple[dict[str, tuple[int, int]], float]:
    """Beginnings that may be entries with their (toxic, clean) cases, and the surprise asked for.

    Toxic cases are documents, but no more than distinct words before the beginning or
    distinct sketches of the documents, of which copies of a document add none. These
    are looked at only for beginnings that are surprising by documents. All are terms of
    the bounded sample.
    """
    spark = sample.sparkSession
    tally = in_arrow(sample.select("y", "text"), _counted, "term string, a long, c long")
    terms = stored(tally.groupBy("term").agg(F.sum("a").alias("a"), F.sum("c").alias("c")).where(F.col("a") >= CASES), "terms")
    least = math.log(max(1, terms.count()) / CHANCE)
    a, c = F.col("a").cast("double"), F.col("c").cast("double")
    ratio = a * F.log(a / ((a + c) * share)) + F.when(c > 0, c * F.log(c / ((a + c) * (1 - share)))).otherwise(0.0)
    found = {r["term"]: (r["a"], r["c"]) for r in terms.where((a > c) & (ratio >= least)).collect()}
    before = in_arrow(sample.select("y", "text"), _before(spark.sparkContext.broadcast(frozenset(found))), "term string, prev long, sketch long")
    heads = {r["term"]: r["n"] for r in before.groupBy("term").agg(F.least(F.count_distinct("prev"), F.count_distinct("sketch")).alias("n")).collect()}
    return {t: (min(a, heads.get(t, 0)), c) for t, (a, c) in found.items() if heads.get(t, 0)}, least


def _learned_exceptions(sample: DataFrame, weights: dict[str, float], cases: dict[str, tuple[int, int]]) -> tuple[str, ...]:
    """Phrases around an entry that are clean far more often than the entry is."""
    held = sample.sparkSession.sparkContext.broadcast(weights)
    tally = in_arrow(sample.select("y", "text"), _phrases(held), "entry string, phrase string, a long, c long")
    rows = tally.groupBy("entry", "phrase").agg(F.sum("a").alias("a"), F.sum("c").alias("c")).where("c > 2 AND c > a").collect()  # of the sample
    out = set()
    for r in rows:
        a, c = cases[r["entry"]]
        if surprise(r["c"], r["a"], (c + 0.5) / (a + c + 1)) >= SPARED:
            out.add(r["phrase"])
    return tuple(sorted(out))


def learn(sample: DataFrame, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """A lexicon from rows (id, text, y); exceptions: phrases beside the learned ones.

    Without toxic or clean rows, or a sure entry, it is empty and rejects nothing.
    """
    size = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return Lexicon({}, exceptions, 1.0, -10.0)
    cases, least = _candidates(sample, n1 / (n0 + n1))
    weights = entries(cases, n1 / (n0 + n1), least)
    if not weights:
        return Lexicon({}, exceptions, 1.0, -10.0)
    raw = Lexicon(weights, tuple(sorted({*exceptions, *_learned_exceptions(sample, weights, cases)})))
    rows = weighed(sample, raw, "y").select("row.y", "total", "n").collect()
    x = np.array([feature(r["total"], r["n"]) for r in rows])
    y = np.array([r["y"] for r in rows], float)
    a, b = 1.0, -1.0
    for _ in range(200):  # Newton steps on the ridge-damped likelihood
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((p - y) * x).sum() + 1e-3 * a, (p - y).sum() + 1e-3 * b])
        s = p * (1 - p)
        h = np.array([[(s * x * x).sum() + 1e-3, (s * x).sum()], [(s * x).sum(), s.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return Lexicon(weights, raw.exceptions, float(a), min(float(b), -0.5))  # without a match no text is toxic


def weighed(docs: DataFrame, lexicon: Lexicon, *cols: str, text_col: str = "text", back: bool = False) -> DataFrame:
    """(row struct of cols, total, n) per row of docs, with the text as it was if back."""
    spark = docs.sparkSession
    held = docs.select(F.struct(*cols).alias("row"), F.col(text_col).alias("text"))
    kind = held.schema["row"].dataType.simpleString()
    return in_arrow(held, _weighed(spark.sparkContext.broadcast(lexicon), back), f"row {kind}, total double, n long" + ", text string" * back)


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted, total, n_words) per row; a null or empty text weighs nothing.

    Rows without an id and rows that repeat one are scored like any other; columns but
    the id are left out.
    """
    out = weighed(docs, lexicon, id_col, text_col=text_col)
    x = F.log1p(100.0 * F.col("total") / (F.col("n") + 50.0))
    p = 1 / (1 + F.exp(-(lexicon.slope * x + lexicon.offset)))
    return out.select(f"row.{id_col}", p.alias("score"), "total", F.col("n").alias("n_words")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def train(docs: DataFrame, labels: DataFrame, keep=None, per_class: int = PER_CLASS) -> Lexicon:
    """The lexicon learned from a bounded sample of labels.toxic (keep: which ids)."""
    return learn(stored(labelled_sample(docs, labels, "toxic", F.lit(True) if keep is None else keep, per_class), "toxic_sample"))


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    """A toxicity score for every document, learned outside fold 0 of 5."""
    from lakeloom.session import table

    docs = table(spark, sf_dir, "documents")
    lexicon = train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return score(docs, lexicon).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")
