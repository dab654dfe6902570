"""Language by cross-parsing entropy.

Each language has a suffix automaton of a bounded sample of its labelled text. A
document is parsed into the longest phrases that occur in that text; the language
whose parse needs the fewest phrases, normalised by the logarithm of its sample's
length and by the document's length, wins.

A greedy parse never needs suffix links: at a missing transition a phrase ends and
the next begins at the root. So an automaton becomes one table of next state and
break bit, and all documents of a piece step through it together. A long text steps
through in blocks side by side: blocks whose beginning state turns out to be another
than was assumed are parsed again from it, until all agree, so the phrases are those
of one parse of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import fold, held_out, in_arrow, pieces, stored

#: Languages at most (those with most learning rows); documents and symbols of the sample of each; symbols of a block.
LANGUAGES, SAMPLE_DOCS, SAMPLE_SYMBOLS, BLOCK = 128, 64, 16_000, 4096
#: Characters of a document that may enter the sample, from a hashed place on.
SAMPLE_CHARS = 4 * SAMPLE_SYMBOLS // SAMPLE_DOCS
#: Sharpness of the score: a softmax of the entropies in bits per symbol.
SHARPNESS = 4.0

_BLANK = 1  # symbol of any run of characters that are no letters; 0: a letter not in any sample


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _squeezed(points: np.ndarray) -> np.ndarray:
    """Code points with each run of non-letters as one space."""
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:1] = letter[:1]
    out = np.where(letter, points, 32)
    return out[keep]


def automaton(symbols: list[int], size: int) -> np.ndarray:
    """Table [state * size + symbol] of 2 * next state + break bit, from a suffix automaton."""
    moves, link, length = [{}], [-1], [0]
    last = 0
    for c in symbols:
        cur = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = cur
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    start = np.ones(size, np.int32)  # back to the root, a phrase ends
    for c, t in moves[0].items():
        start[c] = 2 * t + 1
    table = np.tile(start, (len(moves), 1))
    for s, m in enumerate(moves):
        if m:
            table[s, list(m)] = 2 * np.fromiter(m.values(), np.int32, len(m))
    return table.reshape(-1)


@dataclass(frozen=True)
class Languages:
    """Names, the joined tables with each one's root, symbol numbers, and sample lengths."""

    names: list[str]
    table: np.ndarray
    roots: np.ndarray
    symbols: dict[int, int]
    lengths: np.ndarray

    @property
    def size(self) -> int:
        return len(self.symbols) + 2


def shares(lengths: list[int], most: int) -> list[int]:
    """How much of each text to take for most in all: equal shares, and what short texts leave is dealt to the others."""
    out, left = [0] * len(lengths), most
    order = sorted(range(len(lengths)), key=lambda i: lengths[i])
    for k, i in enumerate(order):
        out[i] = min(lengths[i], left // (len(order) - k))
        left -= out[i]
    return out


def learn(sample: list[tuple[str, str]], symbols: int = SAMPLE_SYMBOLS) -> Languages | None:
    """Automata from (language, text) rows; each language takes up to that many symbols, of all its texts alike.

    Equal texts of a language count once. A language without a letter is left out.
    """
    texts: dict[str, list[np.ndarray]] = {}
    for lang, text in sorted(set(sample)):
        texts.setdefault(lang, []).append(np.append(_squeezed(_points(text)), 32))
    body = {}
    for k, v in sorted(texts.items()):
        x = np.concatenate([t[:n] for t, n in zip(v, shares([len(t) for t in v], symbols))])
        if (x != 32).any():
            body[k] = x
    if not body:
        return None
    known = sorted({int(p) for x in body.values() for p in np.unique(x)} - {32})
    number = {p: i + 2 for i, p in enumerate(known)}
    tables, roots, at = [], [], 0
    for x in body.values():
        t = automaton([_BLANK if p == 32 else number[p] for p in x.tolist()], len(known) + 2)
        tables.append(t + 2 * at)
        roots.append(at)
        at += len(t) // (len(known) + 2)
    return Languages(list(body), np.concatenate(tables).astype(np.int32), np.array(roots, np.int64), number, np.array([len(x) for x in body.values()], float))


def parse(langs: Languages, texts: list[np.ndarray]) -> np.ndarray:
    """Phrases of each text under each language; texts are symbol arrays."""
    blocks = [(d, t[i : i + BLOCK]) for d, t in enumerate(texts) for i in range(0, len(t), BLOCK)]
    out = np.zeros((len(texts), len(langs.names)), np.int64)
    if not blocks:
        return out
    owner = np.array([d for d, _ in blocks])
    inner = np.append(False, owner[1:] == owner[:-1])  # blocks that go on where the one before ends
    begin = np.repeat(langs.roots[:, None], len(blocks), 1)
    end, count = begin.copy(), np.zeros_like(begin)
    todo = np.arange(len(blocks))
    while len(todo):
        todo = todo[np.argsort([-len(blocks[j][1]) for j in todo], kind="stable")]
        end[:, todo], count[:, todo] = _stepped(langs, [blocks[j][1] for j in todo], begin[:, todo])
        met = begin.copy()
        met[:, 1:] = np.where(inner[1:], end[:, :-1], begin[:, 1:])
        todo = np.flatnonzero((met != begin).any(0))
        begin = met
    np.add.at(out, owner, count.T + ~inner[:, None])
    return out


def _stepped(langs: Languages, blocks: list[np.ndarray], state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State after each block (longest first) and phrases that end in it, under each language."""
    lengths = np.array([len(b) for b in blocks])
    steps = np.zeros((lengths[0], len(blocks)), np.int32)
    for j, b in enumerate(blocks):
        steps[: len(b), j] = b
    state, count = state.copy(), np.zeros_like(state)
    live = len(blocks)
    for i in range(lengths[0]):
        while live and lengths[live - 1] <= i:
            live -= 1
        v = langs.table[state[:, :live] * langs.size + steps[i, :live]]
        count[:, :live] += v & 1
        state[:, :live] = v >> 1
    return state, count


def _predicted(langs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Languages | None = langs.value
        number = np.zeros(0x110000, np.uint8 if held is None or held.size < 256 else np.uint32)
        if held is not None:
            number[32] = _BLANK
            for p, s in held.symbols.items():
                number[p] = s
        for batch in pieces(batches, most=4 << 20):
            squeezed = [_squeezed(_points(t or "")) for t in batch.column(1).to_pylist()]
            n = np.array([int((x != 32).sum()) for x in squeezed])
            if held is None:
                names, conf = ["und"] * len(n), np.zeros(len(n))
            else:
                count = parse(held, [number[x] for x in squeezed])
                size = np.maximum([len(x) for x in squeezed], 1)
                bits = count * np.log2(held.lengths)[None, :] / size[:, None]
                best = bits.argmin(1)
                w = np.exp(-SHARPNESS * (bits - bits.min(1, keepdims=True)))
                conf = np.where(n > 0, 1 / w.sum(1), 0.0)
                names = [held.names[b] if m else "und" for b, m in zip(best, n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(conf, pa.float64())], ["id", "lang_pred", "score"])

    return run


def train(docs: DataFrame, keep: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Languages | None:
    """Automata from a bounded sample: per language the document of least hash in each of SAMPLE_DOCS buckets.

    Of a document at most SAMPLE_CHARS characters, from a hashed place on, reach the
    driver. Rows without a language or an id are not learned from; rows that repeat an
    id give one text. Of more than LANGUAGES languages those with most rows are learned.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = (rows if keep is None else rows.where(keep)).select(F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("h"), text.alias("text"))
    most = F.broadcast(rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).select("lang"))
    bucket = F.pmod(F.shiftrightunsigned("h", 8), F.lit(SAMPLE_DOCS)).alias("bucket")
    least = rows.select("lang", "h").join(most, "lang").groupBy("lang", bucket).agg(F.min("h").alias("h")).select("lang", "h")  # LANGUAGES times SAMPLE_DOCS
    at = F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1).cast("int") + 1
    cut = rows.join(F.broadcast(least), ["lang", "h"]).select("lang", "h", F.substring("text", at, F.lit(SAMPLE_CHARS)).alias("text"))
    sample = cut.groupBy("lang", "h").agg(F.min("text").alias("text"))
    return learn([(r["lang"], r["text"]) for r in stored(sample, "lang_sample").collect()])  # LANGUAGES times SAMPLE_DOCS rows


def predict(docs: DataFrame, langs: Languages | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) per row.

    A null text or one without a letter is `und` with score 0, as is every text if
    nothing was learned. Ties go to the language first in alphabetical order. Rows
    without an id and rows that repeat one are predicted like any other; columns but
    the id are left out.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    held = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = in_arrow(held, _predicted(docs.sparkSession.sparkContext.broadcast(langs)), f"id {kind}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)


def op4_language(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned outside fold 2 of 4."""
    from lakeloom.session import table

    docs = table(spark, sf_dir, "documents")
    langs = train(docs, fold("doc_id", 4) != 2)
    return predict(docs, langs).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")
