"""Quality by nearest-neighbour voting in a latent-semantic space.

A text's terms are its words (lower-cased, hashed to a fixed number of terms), pairs of
neighbouring byte classes (spelling, case, symbols) and a few shape counts (words equal
to the one before, words seen before in the text, capitals, symbols). Word terms are
weighted by their rarity in a bounded labelled sample. The sample's term vectors are
reduced by a truncated singular value decomposition; the reduced labelled vectors are
broadcast (their number is the bound). Every document is projected and compared with
all of them in blocks, and the labels of the nearest are weighted by cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import blank_table, buffers, fold, gram_hashes, held_out, in_arrow, labelled_sample, pieces, stored, word_bounds, word_hashes

#: Labelled rows per class in the sample; latent dimensions; neighbours that vote.
PER_CLASS, DIMENSIONS, NEIGHBOURS = 1500, 64, 15

#: Terms that words are hashed to, and their weight beside the others.
WORDS, WORD_WEIGHT = 4096, 1.0

#: Documents whose terms are held at once.
ROWS = 256

_CLASSES, _SHAPES = 64, 8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _classes() -> np.ndarray:
    """Byte to one of 64 classes: each small letter, capitals, digits, blanks, symbols, the rest."""
    t = np.zeros(256, np.int64)
    t[97:123] = np.arange(1, 27)
    t[65:91] = 27
    t[48:58] = 28
    t[32], t[10] = 29, 30
    for i, c in enumerate(b"!#$%&()*+,-./:;<=>?@[]_{|}~'\""):
        t[c] = 31 + i
    t[128:192], t[192:] = 61, 62
    return t


def terms(batch: pa.RecordBatch, column: int = 1) -> np.ndarray:
    """A row for each text: square roots of the shares of word terms and of pairs of byte classes, and the shape counts."""
    text, off = buffers(batch.column(column))
    n = batch.num_rows
    kind = _classes()[text]
    doc = np.repeat(np.arange(n), np.diff(off))
    pair = kind[:-1] * _CLASSES + kind[1:]
    same = doc[:-1] == doc[1:]
    cells = _CLASSES * _CLASSES
    grams = np.bincount(doc[:-1][same] * cells + pair[same], minlength=n * cells).reshape(n, cells)
    starts, ends, first = word_bounds(text, off, blank_table())
    h = word_hashes(text, starts, ends)
    said = word_hashes(_LOWER[text], starts, ends) % np.uint64(WORDS)
    words = np.bincount(np.repeat(np.arange(n), np.diff(first)) * WORDS + said.astype(np.int64), minlength=n * WORDS).reshape(n, WORDS)
    shapes = np.zeros((n, _SHAPES))
    if len(h):
        owner = np.repeat(np.arange(n), np.diff(first))
        head = kind[starts]
        tail = kind[ends - 1]
        repeat = np.zeros(len(h), bool)
        repeat[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
        big = (head == 27) & (kind[np.minimum(starts + 1, len(text) - 1)] == 27)
        order = np.lexsort((h, owner))
        again = np.zeros(len(h), bool)
        again[order[1:]] = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        three = gram_hashes(h, 3)
        inner = np.flatnonzero(owner[: len(three)] == owner[2:])  # windows within a text
        order = inner[np.lexsort((three[inner], owner[inner]))]
        gram_again = np.zeros(len(h), bool)
        gram_again[order[1:]] = (three[order][1:] == three[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        for j, hit in enumerate((repeat, big, tail >= 31, again, gram_again, ends - starts == 1)):
            shapes[:, j] = np.bincount(owner, weights=hit, minlength=n)
        shapes[:, 6] = np.diff(first)
        shapes /= np.maximum(np.diff(first), 1)[:, None]
    shapes[:, 7] = np.diff(off) == 0
    rates = [np.sqrt(x / np.maximum(x.sum(1), 1)[:, None]) for x in (words, grams)]
    return np.hstack([*rates, shapes]).astype(np.float32)


@dataclass(frozen=True)
class Space:
    """Term weights, the projection, and the labelled vectors with their labels."""

    mean: np.ndarray
    scale: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) * self.scale) @ self.basis
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        for i in range(0, piece.num_rows, ROWS):
            batch = piece.slice(i, ROWS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in terms(batch)], pa.binary())], ["y", "x"])


def learn(sample: DataFrame, dimensions: int = DIMENSIONS) -> Space | None:
    """The latent space of rows (id, text, y); None without rows.

    Rows are put in the order of their labels and terms, so that a tie of equal cosines
    goes alike however they came.
    """
    rows = in_arrow(sample.select("y", "text"), _counted, "y int, x binary").collect()  # bounded by the sample
    rows.sort(key=lambda r: (r["y"], r["x"]))
    if not rows:
        return None
    y = np.array([r["y"] for r in rows], np.float32)
    c = np.stack([np.frombuffer(r["x"], np.float32) for r in rows])
    del rows
    mean = c.mean(0)
    scale = np.ones(c.shape[1], np.float32)
    scale[:WORDS] = WORD_WEIGHT * np.log((1 + len(c)) / (1 + (c[:, :WORDS] > 0).sum(0))) / np.log(1 + len(c))
    scale[-_SHAPES:] = 1.0 / np.maximum(c[:, -_SHAPES:].std(0), 0.05) * 0.1
    c -= mean
    c *= scale
    k = min(dimensions, *c.shape)
    q = np.random.default_rng(7).standard_normal((c.shape[1], k + 8)).astype(np.float32)
    for _ in range(4):  # subspace iteration
        q, _ = np.linalg.qr(c.T @ (c @ q))
    _, _, vt = np.linalg.svd(c @ q, full_matrices=False)
    basis = (q @ vt.T)[:, :k].astype(np.float32)
    z = c @ basis
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
    return Space(mean, scale, basis, z.astype(np.float32), y)


def vote(space: Space, z: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """Share of label 1 among the k nearest, weighted by squared cosine.

    Cosines are taken to six places; of equal ones at the k-th place the first rows of
    the sample count. Labels count as they stand in the sample, which holds as many
    rows of either class as there are up to its bound.
    """
    sims = np.round(z @ space.vectors.T, 6)
    k = min(k, sims.shape[1])
    least = np.partition(sims, sims.shape[1] - k, axis=1)[:, sims.shape[1] - k, None]
    over, even = sims > least, sims == least
    near = over | (even & (np.cumsum(even, 1) <= k - over.sum(1)[:, None]))
    w = np.where(near, np.maximum(sims, 0) ** 2 + 1e-6, 0)
    return (w @ space.labels) / w.sum(1)


def _voted(space, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = space.value
        for batch in pieces(batches):
            if held is None:
                p = np.full(batch.num_rows, 0.5)
            else:
                p = np.concatenate([vote(held, held.project(terms(batch.slice(i, ROWS))), k) for i in range(0, batch.num_rows, ROWS)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p.astype(np.float64))], ["id", "score"])

    return run


def score(docs: DataFrame, space: Space | None, id_col: str = "doc_id", text_col: str = "text", k: int = NEIGHBOURS) -> DataFrame:
    """(id, score, predicted) per row; a null text is scored as an empty one.

    Without a labelled row every score is 0.5. Rows without an id and rows that repeat
    one are scored like any other; columns but the id are left out.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    held = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = in_arrow(held, _voted(docs.sparkSession.sparkContext.broadcast(space), k), f"id {kind}, score double")
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def train(docs: DataFrame, labels: DataFrame, keep=None, per_class: int = PER_CLASS) -> Space | None:
    """The space learned from a bounded sample of labels.quality (keep: which ids)."""
    return learn(stored(labelled_sample(docs, labels, "quality", F.lit(True) if keep is None else keep, per_class), "quality_sample"))


def op5_quality(spark, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned outside fold 1 of 3."""
    from lakeloom.session import table

    docs = table(spark, sf_dir, "documents")
    space = train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return score(docs, space).select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")
