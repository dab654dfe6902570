"""Repeated passages, by seed and extend.

Seeds are winnowed anchors: of the GRAM-word grams inside each window of SPAN words
the one with the least hash (leftmost of equals). Equal windows pick the same gram
at the same offset, so every repeat of SPAN words shares an anchor. An anchor owns a
run of neighbouring windows; the words they span are its context.

1. Rows get a key and are written once as a table bucketed by it, so texts are
   shuffled once. Anchors of all documents meet; one seen once is dropped. Where the
   whole context is equal, the match extends over all of it: all its windows repeat
   the first occurrence.
2. Anchors with several contexts are extended to both sides as far as they agree:
   every extension of SPAN words in all (so many to the left, the others to the right)
   meets its equals; only the first occurrence of each context takes part, as any
   window of a later one also stands in the first.
3. Matches that overlap or touch are merged into maximal repeats (SPAN words at least,
   as each window has), and their words are cut out.

Contexts are compared by a 64-bit hash beside their anchor's, windows by 128 bits;
the words themselves aren't shipped to be compared.

A group is read as a sorted stream with constant state. Equal keys of one piece of
input are combined before the shuffle, and a task remembers hot keys from piece to
piece, so neither a hot passage nor a document of one repeated word gathers anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import Runs, blank_table, bucketed, buffers, gram_hashes, in_arrow, mix, pieces, stored, word_bounds, word_hashes

SPAN, GRAM = 20, 5

#: Keys that a task remembers, and pieces for which a key met again is kept.
REMEMBERED, STAYS = 1 << 17, 64

_ROW = "k1 long, k2 long, id long, key long, a int, e int, kind int"
_SPAN, _SEED = 0, 1


def _rows(k1, k2, ids, key, a, e, kind) -> pa.RecordBatch:
    whole = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))
    return pa.RecordBatch.from_arrays(
        [*map(whole, (k1, k2, ids, key)), *(pa.array(x.astype(np.int32)) for x in (a, e, kind))],
        ["k1", "k2", "id", "key", "a", "e", "kind"],
    )


def _merged(ids, key, a, e) -> tuple:
    """Spans of a row that overlap or touch, as one."""
    order = np.lexsort((e, a, key))
    ids, key, a, e = (x[order] for x in (ids, key, a, e))
    if len(a):
        # ends rise with the starts, as all are windows or contexts of neighbouring anchors
        new = np.ones(len(a), bool)
        new[1:] = (key[1:] != key[:-1]) | (a[1:] > e[:-1])
        lead = np.flatnonzero(new)
        ids, key, a, e = ids[lead], key[lead], a[lead], np.maximum.reduceat(e, lead)
    return ids, key, a, e


class _Earlier:
    """Keys that a task has given out with their least places; hot ones stay, others are soon replaced."""

    def __init__(self, n: int = REMEMBERED):
        self.k1, self.k2, self.ids, self.a = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.used, self.stays = np.zeros(n, bool), np.zeros(n, np.int8)

    def covers(self, k1, k2, ids, a) -> np.ndarray:
        """Which rows (of different keys) stand after a row of their key that was given out before; the others are remembered."""
        at = (k1 ^ (k2 >> np.uint64(1))) % np.uint64(len(self.k1))
        met = self.used[at] & (self.k1[at] == k1) & (self.k2[at] == k2)
        done = met & ((self.ids[at] < ids) | ((self.ids[at] == ids) & (self.a[at] < a)))
        np.maximum(self.stays - 1, 0, out=self.stays)
        self.stays[at[met]] = STAYS
        put = ~done & (met | (self.stays[at] == 0))
        spot = at[put]
        self.k1[spot], self.k2[spot], self.ids[spot], self.a[spot], self.used[spot] = k1[put], k2[put], ids[put], a[put], True
        return done


def _combined(k1, k2, ids, key, a, e, before: _Earlier) -> Iterator[pa.RecordBatch]:
    """Of equal keys the least (id, a) goes on as a seed; later ones are covered already and come as merged spans."""
    order = np.lexsort((a, ids, k2, k1))
    k1, k2, ids, key, a, e = (x[order] for x in (k1, k2, ids, key, a, e))
    new = np.ones(len(k1), bool)
    new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
    lead = np.flatnonzero(new)
    first = lead[np.cumsum(new) - 1] if len(new) else np.zeros(0, int)
    later = (ids > ids[first]) | (a > a[first])
    later[lead] = before.covers(k1[lead], k2[lead], ids[lead], a[lead])
    spans = _merged(*(x[later] for x in (ids, key, a, e)))
    kinds = np.full(len(spans[0]), _SPAN), np.full(int((~later).sum()), _SEED)
    # spans only pass through the shuffle: any place will do
    yield _rows(mix(spans[1].view(np.uint64) * np.uint64(31) + spans[2].astype(np.uint64)), np.zeros(len(spans[0]), np.uint64), *spans, kinds[0])
    yield _rows(*(x[~later] for x in (k1, k2, ids, key, a, e)), kinds[1])


def _words(batch: pa.RecordBatch) -> tuple:
    text, off = buffers(batch.column(0))
    starts, ends, first = word_bounds(text, off, blank_table())
    return text, off, starts, ends, first


def _longs(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64)


def _seeds(span: int, gram: int):
    """(text, id, key) to anchors with the run of windows each owns."""
    wide = span - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = _Earlier()
        for batch in pieces(batches, 0):
            text, _, starts, ends, first = _words(batch)
            ids, key = _longs(batch, 1), _longs(batch, 2)
            n = len(starts) - span + 1
            if n <= 0:
                continue
            doc = np.repeat(np.arange(len(ids)), np.diff(first))
            h1 = word_hashes(text, starts, ends)
            g = gram_hashes(h1, gram)
            least = g[:n].copy()
            for d in range(1, wide):
                np.minimum(least, g[d : d + n], out=least)
            own = np.zeros(n, np.int64)
            for d in range(wide - 1, -1, -1):
                own[g[d : d + n] == least] = d
            at = np.flatnonzero(doc[:n] == doc[span - 1 :])
            if not len(at):
                continue
            seed = at + own[at]
            begin = np.ones(len(at), bool)
            begin[1:] = seed[1:] != seed[:-1]
            lo = np.flatnonzero(begin)
            hi = np.concatenate([lo[1:], [len(at)]]) - 1
            a, b, p = at[lo], at[hi] + span, seed[lo]
            context = Runs(word_hashes(text, starts, ends, second=True)).of(a, b) + (p - a).astype(np.uint64)
            base = first[doc[a]]
            yield from _combined(g[p], mix(context), ids[doc[a]], key[doc[a]], a - base, b - base, before)

    return run


def _windows(span: int):
    """(text, id, key, runs) to one seed per window of the runs [a, e)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = _Earlier()
        for batch in pieces(batches, 0):
            text, _, starts, ends, first = _words(batch)
            ids, key = _longs(batch, 1), _longs(batch, 2)
            runs = batch.column(3)
            if not len(runs.flatten()):
                continue
            doc = np.repeat(np.arange(len(ids)), np.diff(runs.offsets.to_numpy()))
            lo = runs.flatten().field("a").to_numpy() + first[doc]
            hi = runs.flatten().field("e").to_numpy() + first[doc]
            many = hi - lo - span + 1
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            doc = np.repeat(doc, many)
            one = Runs(word_hashes(text, starts, ends)).of(at, at + span)
            two = Runs(word_hashes(text, starts, ends, second=True)).of(at, at + span)
            a = at - first[doc]
            yield from _combined(one, two, ids[doc], key[doc], a, a + span, before)

    return run


def _cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (k1, k2, id, a): later rows of a key become spans.

    First rows come out as seeds again where their k1 has several k2. The state is
    the first row of the key under way and, if it is the first key of its k1, the
    row itself until a second key is seen.
    """
    last = None  # k1, k2, id, a of the key under way
    pending = None  # its row, not given out yet
    for batch in batches:
        k1, k2, ids, key, a, e, kind = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        row = np.stack([ids, key, a.astype(np.int64), e.astype(np.int64)])
        done = kind == _SPAN
        spans, seeds = [row[:, done]], []
        k1, k2, row = k1[~done], k2[~done], row[:, ~done]
        n = len(k1)
        if n:
            new_k1, new = np.ones(n, bool), np.ones(n, bool)
            new_k1[1:] = k1[1:] != k1[:-1]
            new[1:] = new_k1[1:] | (k2[1:] != k2[:-1])
            if last is not None:
                new_k1[0] = k1[0] != last[0]
                new[0] = new_k1[0] or k2[0] != last[1]
            group = np.cumsum(new) - 1
            keys = np.flatnonzero(new)
            fid, fa = row[0][keys], row[2][keys]
            if len(keys) == 0 or keys[0] > 0:
                fid, fa = np.append(last[2], fid), np.append(last[3], fa)
                group = group + 1
            later = (row[0] > fid[group]) | ((row[0] == fid[group]) & (row[2] > fa[group]))
            spans.append(row[:, later])
            seeds.append(row[:, ~later & ~new])  # rows of a repeated id
            if len(keys):
                inner = ~new_k1[keys]  # not the first key of its k1
                several = inner.copy()
                several[:-1] |= inner[1:]
                if inner[0] and pending is not None:
                    seeds.append(pending)
                seeds.append(row[:, keys[several]])
                z = keys[-1]
                last = (k1[z], k2[z], row[0][z], row[2][z])
                pending = None if several[-1] else row[:, z : z + 1]
        for found, k in ((spans, _SPAN), (seeds, _SEED)):
            rows = [x for x in found if x.shape[1]]
            if rows:
                i, w, x, y = np.concatenate(rows, axis=1)
                i, w, x, y = _merged(i, w, x, y) if k == _SPAN else (i, w, x, y)
                yield _rows(i, i, i, w, x, y, np.full(len(i), k)).select(["key", "a", "e", "kind"])


def _met(rows: DataFrame) -> DataFrame:
    """Equal keys brought together and read in order."""
    dealt = rows.repartition("k1").sortWithinPartitions("k1", "k2", "id", "a")
    return in_arrow(dealt, _cover, "key long, a int, e int, kind int")


def spans(held: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(key, spans array<struct<a,e>>): word ranges to remove from rows (key, id, text), for keys that have any.

    A range holds windows of span words whose words also start earlier: under a
    smaller id, or earlier under the same id.
    """
    texts = held.where("id IS NOT NULL").select("text", "id", "key")
    met = stored(_met(in_arrow(texts, _seeds(span, gram), _ROW)), "seeds")
    runs = met.where(F.col("kind") == _SEED).groupBy("key").agg(F.collect_set(F.struct("a", "e")).alias("runs"))
    extended = _met(in_arrow(texts.join(runs, "key").select("text", "id", "key", "runs"), _windows(span), _ROW))
    more = stored(extended.where(F.col("kind") == _SPAN), "extended")
    both = met.where(F.col("kind") == _SPAN).union(more)
    return both.groupBy("key").agg(F.collect_set(F.struct("a", "e")).alias("spans"))


def _cut(joined: bool):
    """(text, row, spans) to what is left of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0):
            text, off, starts, ends, first = _words(batch)
            n = len(starts)
            depth = np.zeros(n + 1, np.int64)
            runs = batch.column(2)
            flat = runs.flatten()
            if len(flat):
                doc = np.repeat(np.arange(batch.num_rows), np.diff(runs.offsets.to_numpy()))
                np.add.at(depth, flat.field("a").to_numpy() + first[doc], 1)
                np.add.at(depth, flat.field("e").to_numpy() + first[doc], -1)
            gone = np.cumsum(depth[:-1]) > 0
            removed = np.add.reduceat(np.append(gone, False), first[:-1]) * (np.diff(first) > 0) if len(first) > 1 else []
            left = []
            body = text.tobytes()
            for d in range(batch.num_rows):
                a, b = int(first[d]), int(first[d + 1])
                if joined:
                    s, e = starts[a:b], ends[a:b]
                    if removed[d]:
                        s, e = s[~gone[a:b]], e[~gone[a:b]]
                    left.append(b" ".join([body[x:y] for x, y in zip(s.tolist(), e.tolist())]))
                elif not removed[d]:
                    left.append(body[off[d] : off[d + 1]])
                else:  # each kept word with the blanks after it
                    stop = np.append(starts[a + 1 : b], off[d + 1])
                    keep = ~gone[a:b]
                    left.append(b"".join([body[x:y] for x, y in zip(starts[a:b][keep].tolist(), stop[keep].tolist())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(np.diff(first).astype(np.int64)), pa.array(np.asarray(removed, np.int64)), pa.array(left, pa.binary()).cast(pa.string())],
                ["row", "n_words", "n_removed", "kept_text"],
            )

    return run


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, gram: int = GRAM, joined: bool = False) -> DataFrame:
    """docs with n_words, n_removed (long) and kept_text.

    kept_text has the kept words joined by one space if joined; otherwise an
    untouched text comes back as it was (null as empty) and a cut one keeps the
    blanks that follow its kept words. Null and empty texts have no words. A null id
    is never cut and never counts as an earlier copy. Of rows that repeat an id only
    an earlier start counts as earlier, whichever row it is in. Ids are integers.
    Columns of docs keep their names; three that clash with the results are replaced.
    """
    cols = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    whole = F.struct(*[F.col(f"`{c}`") for c in cols if c != text_col]).alias("row")
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), whole)
    held = bucketed(rows, "texts", "key")
    met = held.join(spans(held, span, gram), "key", "left").select("text", "row", "spans")
    kind = rows.schema["row"].dataType.simpleString()
    out = in_arrow(met, _cut(joined), f"row {kind}, n_words long, n_removed long, kept_text string")
    return out.select(*[F.col(f"row.`{c}`") if c != text_col else F.col("kept_text").alias(c) for c in cols], "n_words", "n_removed", "kept_text")


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a 20-word window seen earlier are cut."""
    from lakeloom.session import table

    out = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), joined=True)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (
  SELECT doc_id, i, array_to_string(ws[i:i+19], ' ') AS g FROM (
    SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d WHERE len(ws) >= 20)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS nth FROM w) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM (SELECT doc_id, i, unnest(range(0, 20)) AS j FROM again)),
place AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM place ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""
