"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint is cut into two segments of 32 bits. Of two fingerprints that differ
in at most two bits, one segment differs in at most one. Each segment is indexed
under its 32 variants with one bit left out, so such a pair meets under an equal
key, where it is verified on all 64 bits. Work is done on distinct fingerprints;
documents join their class at the end.

Inside a bucket only a spanning set of the verified links is kept (every member
linked to the least member of its part), so rows stay linear in the bucket. A
bucket beyond PAIRS members looks its neighbours up by flipping bits instead of
comparing pairs; both ways are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import blank_table, buffers, in_arrow, stored, word_bounds
from lakeloom.llm.components import components

#: Members of a bucket up to which all its pairs are compared at once.
PAIRS = 512

#: Shingles of a document that are hashed at once.
SHINGLES = 65_536

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


#: The five primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


_LOW = np.uint64(0x0101010101010101)  # the lowest bit of each byte


def _rotated(x: np.ndarray, k: int) -> np.ndarray:
    return (x << np.uint64(k)) | (x >> np.uint64(64 - k))


def xxh64(body: np.ndarray, begin: np.ndarray, stop: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of body[begin:stop] (bytes), elementwise: together under 32 bytes, one by one beyond."""
    held = np.concatenate([body, np.zeros(8, np.uint8)])
    eight, four = (np.ndarray(len(body) + 1, kind, held, strides=(1,)) for kind in ("<u8", "<u4"))
    left = stop - begin
    h = left.astype(np.uint64) + np.uint64((seed + int(_P5)) % (1 << 64))
    live = np.flatnonzero(left < 32)
    at, left, x = begin[live], left[live], h[live]
    for _ in range(3):
        i = np.flatnonzero(left >= 8)
        x[i] = _rotated(x[i] ^ (_rotated(eight[at[i]] * _P2, 31) * _P1), 27) * _P1 + _P4
        at[i] += 8
        left[i] -= 8
    i = np.flatnonzero(left >= 4)
    x[i] = _rotated(x[i] ^ (four[at[i]].astype(np.uint64) * _P1), 23) * _P2 + _P3
    at[i] += 4
    left[i] -= 4
    for _ in range(3):
        i = np.flatnonzero(left > 0)
        x[i] = _rotated(x[i] ^ (held[at[i]].astype(np.uint64) * _P5), 11) * _P1
        at[i] += 1
        left[i] -= 1
    x = (x ^ (x >> np.uint64(33))) * _P2
    x = (x ^ (x >> np.uint64(29))) * _P3
    h[live] = x ^ (x >> np.uint64(32))
    long = np.flatnonzero(stop - begin >= 32)
    if len(long):
        view = memoryview(body)
        h[long] = np.fromiter((xxhash.xxh64_intdigest(view[x:y], seed) for x, y in zip(begin[long].tolist(), stop[long].tolist())), np.uint64, len(long))
    return h


def _fingerprints(width: int):
    """Batches of (id, text) to (id, fp): fp is the signed form of the 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_word = blank_table()
        for batch in batches:
            text, off = buffers(batch.column(1))
            text = _LOWER[text]
            starts, ends, first = word_bounds(text, off, is_word)
            # words of the batch with one space after each
            at = np.concatenate([[0], np.cumsum(ends - starts + 1)]).astype(np.int64)
            joined = np.full(int(at[-1]), 32, np.uint8)
            spot = np.ones(len(joined), bool)
            spot[at[1:] - 1] = False
            joined[spot] = text[is_word[text]]
            begin, stop = at[:-1], at[1:] - 1
            size = np.diff(first)
            n = np.where(size > 0, np.maximum(1, size - width + 1), 0)  # shingles of each document
            base = np.concatenate([[0], np.cumsum(n)])
            ones = np.zeros((batch.num_rows, 64), np.int64)
            for k in range(0, int(base[-1]), SHINGLES):
                some = np.arange(k, min(k + SHINGLES, int(base[-1])))
                docs = np.arange(*(np.searchsorted(base, (some[0], some[-1]), "right") + (-1, 0)))
                doc = np.repeat(docs, np.minimum(base[docs + 1], some[-1] + 1) - np.maximum(base[docs], k))
                word = some - base[doc] + first[doc]
                h = xxh64(joined, begin[word], stop[word + np.minimum(width, size[doc]) - 1], 42)
                # bits are counted in bytes, eight at a time, over at most 255 shingles of a document
                lead = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
                place = np.arange(len(doc)) - np.repeat(lead, np.diff(np.append(lead, len(doc))))
                cut = np.flatnonzero(place % 255 == 0)
                count = np.empty((len(cut), 8, 8), np.int64)
                for j in range(8):
                    count[:, :, j] = np.add.reduceat((h >> np.uint64(j)) & _LOW, cut).view(np.uint8).reshape(-1, 8)
                np.add.at(ones, doc[cut], count.reshape(-1, 64))
            fps = np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").reshape(-1).view(np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp bigint) per row of docs.

    Shingles of width lower-cased (A-Z) words, repeats included; a bit is set if it
    is set in over half of their XXH64 hashes (seed 42). Fewer words: one shingle of
    them all. Null, empty or blank text: 0.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("fp", T.LongType())])
    return in_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), _fingerprints(width), schema)


def _parts(v: np.ndarray) -> np.ndarray:
    """For fingerprints of one bucket, the index of the first member of each one's part."""
    n = len(v)
    if n <= PAIRS:
        i, j = np.nonzero(np.triu(np.bitwise_count(v[:, None] ^ v[None, :]) <= 2, 1))
    else:
        order = np.argsort(v)
        ranked = v[order]
        one = np.uint64(1) << np.arange(64, dtype=np.uint64)
        found = []
        for f in np.concatenate([one, (one[:, None] | one[None, :])[np.triu_indices(64, 1)]]):
            got = np.minimum(np.searchsorted(ranked, v ^ f), n - 1)
            hit = np.flatnonzero(ranked[got] == v ^ f)
            found.append((hit, order[got[hit]]))
        i, j = (np.concatenate(x) for x in zip(*found))
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, fp) to spanning links (a, b) of verified neighbours, bucket by bucket."""

    def emit(keys: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        begin = np.concatenate([[0], cut])
        stop = np.concatenate([cut, [len(keys)]])
        a, b = [], []
        pair = np.flatnonzero(stop - begin == 2)
        x, y = v[begin[pair]], v[begin[pair] + 1]
        near = np.bitwise_count(x ^ y) <= 2
        a.append(x[near]), b.append(y[near])
        for i in np.flatnonzero(stop - begin > 2):
            m = v[begin[i] : stop[i]]
            r = _parts(m)
            w = np.flatnonzero(r != np.arange(len(m)))
            a.append(m[w]), b.append(m[r[w]])
        a, b = (np.concatenate(z).view(np.int64) for z in (a, b))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    held_k, held_v = [], []  # the last bucket so far may go on in the next batch
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(0).to_numpy(zero_copy_only=False)
        v = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        last = int(np.searchsorted(k, k[-1]))
        if last or (held_k and held_k[-1][0] != k[0]):
            ready_k = np.concatenate([*held_k, k[:last]])
            ready_v = np.concatenate([*held_v, v[:last]])
            held_k, held_v = [], []
            if len(ready_k):
                yield emit(ready_k, ready_v)
        held_k.append(k[last:])
        held_v.append(v[last:])
    if held_k:
        yield emit(np.concatenate(held_k), np.concatenate(held_v))


def links(fps: DataFrame) -> DataFrame:
    """Spanning links (a, b) among the distinct fingerprints of a column fp, within two bits.

    The links keep the connected parts of the whole link graph; not every pair is
    listed.
    """
    halves = F.array(
        F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)),
        F.shiftrightunsigned("fp", 32),
    )
    # key: segment number, left-out bit, segment without that bit
    keyed = fps.select("fp", F.posexplode(halves).alias("seg", "half")).select(
        "fp", "seg", "half", F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("i"), F.lit(~(1 << i)).cast("long").alias("m")) for i in range(32)])).alias("w")
    )
    key = F.shiftleft(F.col("seg").cast("long") * 32 + F.col("w.i"), 32).bitwiseOR(F.col("half").bitwiseAND(F.col("w.m")))
    variants = keyed.select(key.alias("key"), "fp")
    dealt = variants.repartition("key").sortWithinPartitions("key")
    return in_arrow(dealt, _bucket_links, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id_col, fp, component_id): component_id is the least id reachable over links.

    Documents link where their fingerprints differ in two bits or fewer; equal
    fingerprints, those of empty texts among them, link too. Repeated ids keep their
    rows. Rows without an id link like any other, but give no component its id; where
    no row of a component has one it is null. An empty table gives an empty table.
    Other columns are left out.
    """
    fps = stored(fingerprints(docs, id_col, text_col, width), "fingerprints")
    firsts = stored(fps.groupBy("fp").agg(F.min("id").alias("first")), "firsts")
    parts = components(links(firsts.select("fp")))
    # a part per fingerprint, the least id of a part, then the fingerprint's documents
    held = firsts.join(parts, firsts["fp"] == parts["node"], "left").select("fp", "first", F.coalesce("component", "fp").alias("part"))
    least = held.groupBy("part").agg(F.min("first").alias("component_id"))
    classes = held.join(least, "part").select("fp", "component_id")
    return fps.join(classes, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    from lakeloom.session import table

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
