"""Operators against plain Python: every word, phrase and score by definition, and the cases that break things."""

import collections
import math
import random
import time

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lakeloom.llm import common, decontaminate, language_id, lm_scoring, mixing, quality_knn, registry, simhash, substring_dedup, toxicity, warc_zip
from lakeloom.llm import recurrent_lm as lm


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def thue_morse(k):
    s = "a"
    for _ in range(k):
        s += s.translate({97: "b", 98: "a"})
    return s, s.translate({97: "b", 98: "a"})


# words and samples


def test_word_hashes_tell_words_apart():
    words = [w for k in range(12) for w in thue_morse(k)]
    words += [f"{i:x}" for i in range(3000)] + ["x" * n for n in range(1, 80)] + ["é" * n for n in range(1, 40)] + ["ab\x00", "ab", "ab\x00\x00"]
    words = sorted(set(words))
    text, off = common.buffers(pa.array([" ".join(words)]))
    starts, ends, _ = common.word_bounds(text, off, common.blank_table())
    assert len(starts) == len(words)
    for second in (False, True):
        h = common.word_hashes(text, starts, ends, second)
        assert len(set(h.tolist())) == len(words)
        alone = [int(common.word_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w.encode())]), second)[0]) for w in words[::97]]
        assert alone == h[::97].tolist()
    assert not len(common.word_hashes(text[:0], starts[:0], ends[:0]))


def test_samples_are_bounded_for_repeated_ids(spark):
    docs = frame(spark, [(1, f"t{i}") for i in range(300)] + [(i, "x") for i in range(2, 40)] + [(None, "y")])
    labels = frame(spark, [(i, i % 2) for i in range(40)] * 3 + [(None, 1), (5, None), (7, 0)], "doc_id long, toxic int")
    got = common.labelled_sample(docs, labels, "toxic", F.lit(True), 5).collect()
    assert len(got) <= 10 and len({r["id"] for r in got}) == len(got) and all(r["id"] is not None for r in got)
    everything = common.labelled_sample(docs, labels, "toxic", F.lit(True), 100).collect()
    assert {r["id"]: r["y"] for r in everything} == {i: 0 if i == 7 else i % 2 for i in range(1, 40)}


def test_held_out_is_never_null(spark):
    rows = frame(spark, [(1, ""), (None, "")]).select(common.held_out("doc_id", 4, 2).alias("h")).collect()
    assert rows[1]["h"] is True and rows[0]["h"] in (True, False)


# repeated passages


def cut(rows):
    """(n_words, n_removed, kept) per row: a window is gone if its words start earlier, by id and then place."""
    first = {}
    words = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in words:
        for p in range(len(w) - 19) if i is not None else ():
            k = tuple(w[p : p + 20])
            first[k] = min(first.get(k, (i, p)), (i, p))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for p in range(len(w) - 19) if i is not None else ():
            if first[tuple(w[p : p + 20])] < (i, p):
                gone[p : p + 20] = [True] * 20
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=repr)


def cut_by_spark(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup.dedup(df, joined=True).collect()), key=repr)


def test_words_that_once_collided_are_kept(spark):
    one, two = thue_morse(10)
    head = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{head} {one}"), (2, f"{head} {two}"), (3, f"{head} {one}")]
    got = cut_by_spark(frame(spark, rows))
    assert got == cut(rows) and [r[2] for r in got] == [0, 0, 20]
    assert lm_scoring.counts(frame(spark, rows[:2])).count() == 22


@pytest.mark.parametrize("seed", range(4))
def test_dedup_of_small_alphabets_and_repeated_ids(spark, monkeypatch, seed):
    monkeypatch.setattr(substring_dedup, "REMEMBERED", 64)
    rng = random.Random(seed)
    passages = [" ".join(rng.choices("abc", k=rng.randint(18, 70))) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices("abcdefgh", k=rng.randint(0, 40))) for _ in range(rng.randint(0, 4))]
        rows.append((rng.choice([i, i, 7, 90]), rng.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(None, passages[0]), (None, None), (500, "a " * 3000), (501, None), (502, "")]
    assert cut_by_spark(frame(spark, rows).repartition(5)) == cut(rows)


def test_repeated_id_with_a_long_and_a_short_text(spark):
    rng = random.Random(2)
    long, passage = " ".join(f"x{rng.random()}" for _ in range(400)), " ".join(f"p{i}" for i in range(30))
    rows = [(1, passage), (5, f"{long} {passage}"), (5, "short one"), (6, "other " + long[:400]), (7, f"end {passage}")]
    assert cut_by_spark(frame(spark, rows)) == cut(rows)


def test_hot_keys_are_remembered():
    seen = substring_dedup._Earlier(16)
    u, i = (lambda *x: np.array(x, np.uint64)), (lambda *x: np.array(x, np.int64))
    assert seen.covers(u(5), u(1), i(10), i(3)).tolist() == [False]
    assert seen.covers(u(5, 5), u(1, 2), i(11, 11), i(0, 0)).tolist() == [True, False]
    assert seen.covers(u(5), u(1), i(10), i(2)).tolist() == [False]  # earlier than what was met: goes on
    assert seen.covers(u(5), u(1), i(10), i(3)).tolist() == [True]
    for k in range(100, 140):  # others don't push it out soon
        seen.covers(u(k), u(1), i(1), i(1))
    assert seen.covers(u(5), u(1), i(10), i(3)).tolist() == [True]


def test_dedup_matches_sql(spark, tmp_path):
    rng = random.Random(5)
    shared = " ".join(f"s{i}" for i in range(40))
    rows = [(i, " ".join([" ".join(f"w{rng.randint(0, 50)}" for _ in range(rng.randint(0, 60))), shared[: rng.randint(0, 200)]])) for i in range(80)] + [(200, None), (201, "  ")]
    df = frame(spark, rows)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(registry.ORACLES["op6_substring_dedup"])
    got = substring_dedup.op6_substring_dedup(spark, str(tmp_path))
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(want.fetchall())


# near duplicates


def test_rows_without_ids_link_others(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(9, text), (None, text), (None, "alone here now"), (4, text), (7, "by itself " * 9), (7, "by itself " * 9)]
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [(False, 4, 4), (False, 7, 7), (False, 7, 7), (False, 9, 4), (True, 0, 0), (True, 0, 4)]


def test_links_through_a_row_without_an_id(spark, monkeypatch):
    fps = {1: 0b0, None: 0b11, 3: 0b1111}
    table = frame(spark, list(fps.items()), "id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *a: table)
    got = simhash.near_duplicates(frame(spark, [(1, "")])).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, None: 1, 3: 1}


def test_hashes_of_many_are_those_of_each():
    rng = np.random.default_rng(4)
    body = rng.integers(0, 256, 5000).astype(np.uint8)
    begin = rng.integers(0, 4900, 3000)
    stop = begin + rng.integers(0, 70, 3000)
    stop[:64] = begin[:64] + np.arange(64)
    for seed in (0, 42, 2**63 + 5):
        want = [xxhash.xxh64_intdigest(body[a:b].tobytes(), seed) for a, b in zip(begin, stop)]
        assert simhash.xxh64(body, begin, stop, seed).tolist() == want
    assert len(simhash.xxh64(body, begin[:0], stop[:0], 1)) == 0


def test_shingles_are_hashed_in_blocks(spark, monkeypatch):
    df = frame(spark, [(1, " ".join(f"w{i % 37}" for i in range(500))), (2, "a b"), (3, "")])
    want = sorted(map(tuple, simhash.fingerprints(df).collect()))
    monkeypatch.setattr(simhash, "SHINGLES", 7)
    assert sorted(map(tuple, simhash.fingerprints(df).collect())) == want


# archives


def test_archives_are_read_by_as_many_tasks_as_their_bytes_make(spark, monkeypatch):
    monkeypatch.setattr(warc_zip, "RECORDS", 40)
    monkeypatch.setattr(warc_zip, "RANGE", 20_000)
    rng = random.Random(1)
    rows = [(i, None, "".join(rng.choices("abcdefghijklmnop", k=2000)), 1) for i in range(200)] + [(None, "u", "x", 1)] + [(300 + i, "u", None, 2) for i in range(50)]
    pages = frame(spark, rows, "page_id long, url string, html string, digest int").repartition(4)
    manifest = warc_zip.write(pages)
    size = manifest.agg(F.sum("bytes")).first()[0]
    back = warc_zip.read(manifest)
    assert back.rdd.getNumPartitions() == -(-size // 20_000) > 5
    assert {r["page_id"]: r["payload"] for r in back.collect()} == {i: h or "" for i, _, h, _ in rows if i is not None}


# mixing


def test_mixing_replaces_a_column_named_copy(spark):
    out = mixing.mix(frame(spark, [(i, "a", "x") for i in range(100)], "doc_id long, source string, copy string"))
    assert out.columns == ["doc_id", "source", "copy"] and dict(out.dtypes)["copy"] == "int"


# language model


def tiny(seed=0):
    """A model of 3 classes of 4 members, state 5, in double precision."""
    rng = np.random.default_rng(seed)
    r = lambda *s: rng.standard_normal(s) * 0.7
    return {"e": r(13, 15), "u": r(5, 15), "b": r(15), "c": r(5, 3), "cb": r(3), "w": r(3, 5, 4), "wb": r(3, 4)}


def naive(p, text, h=None, start=True):
    """Log probability of each word, and the states, one word at a time."""
    n = len(p["u"])
    h = np.zeros(n) if h is None else h
    out, prev = [], 12 if start else None
    sig = lambda x: 1 / (1 + np.exp(-x))
    for w in text:
        x, g = p["e"][prev] + p["b"], h @ p["u"]
        z, r = sig(x[:n] + g[:n]), sig(x[n : 2 * n] + g[n : 2 * n])
        h = (1 - z) * np.tanh(x[2 * n :] + r * g[2 * n :]) + z * h
        k, j = w // 4, w % 4
        a, b = h @ p["c"] + p["cb"], h @ p["w"][k] + p["wb"][k]
        out.append(a[k] - np.log(np.exp(a).sum()) + b[j] - np.log(np.exp(b).sum()))
        prev = w
    return np.array(out), h


def test_forward_pass_by_hand(monkeypatch):
    monkeypatch.setattr(lm, "BLOCK", 3)
    monkeypatch.setattr(lm, "GATHERED", 7)
    rng = np.random.default_rng(4)
    p = tiny()
    texts = [rng.integers(0, 12, n) for n in (1, 40, 0, 13, 13, 2)]
    got = lm.log10_likelihood(lm.Model(p), texts)
    assert np.allclose(got, [naive(p, t)[0].sum() / np.log(10) for t in texts])


def test_gradients_by_differences():
    rng = np.random.default_rng(6)
    p = tiny(1)
    tgt = rng.integers(0, 12, (6, 3))
    inp = np.vstack([rng.integers(0, 12, (1, 3)), tgt[:-1]])
    inp[0, 0] = inp[3, 1] = 12  # lanes that start anew
    real = np.ones((6, 3), bool)
    real[5, 2] = False
    h = rng.standard_normal((3, 5)) * 0.5

    def loss():
        total, n = 0.0, len(p["u"])
        sig = lambda x: 1 / (1 + np.exp(-x))
        for lane in range(3):
            s = h[lane]
            for t in range(6):
                s = np.zeros(n) if inp[t, lane] == 12 else s
                x, g = p["e"][inp[t, lane]] + p["b"], s @ p["u"]
                z, r = sig(x[:n] + g[:n]), sig(x[n : 2 * n] + g[n : 2 * n])
                s = (1 - z) * np.tanh(x[2 * n :] + r * g[2 * n :]) + z * s
                if real[t, lane]:
                    k, j = divmod(int(tgt[t, lane]), 4)
                    a, b = s @ p["c"] + p["cb"], s @ p["w"][k] + p["wb"][k]
                    total -= a[k] - np.log(np.exp(a).sum()) + b[j] - np.log(np.exp(b).sum())
        return total / real.sum()

    grad, _ = lm.gradients(p, tgt, inp, real, h)
    for name, v in p.items():
        flat, own = v.reshape(-1), grad[name].reshape(-1)
        for i in rng.choice(len(flat), min(12, len(flat)), replace=False):
            held = flat[i]
            flat[i] = held + 1e-5
            up = loss()
            flat[i] = held - 1e-5
            down = loss()
            flat[i] = held
            assert abs((up - down) / 2e-5 - own[i]) < 1e-6, name


def test_frequent_words_are_found():
    rng = np.random.default_rng(3)
    words = np.unique(np.concatenate([rng.integers(0, 2**63, 500).astype(np.uint64), np.arange(30, dtype=np.uint64) + (np.uint64(9) << np.uint64(50))]))
    held = lm_scoring._Tables(words, np.arange(len(words)), np.arange(len(words)), np.ones(64), 1, 1, 1)
    probe = np.concatenate([words, words + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
    at, known = held.find(probe)
    assert (known == np.isin(probe, words)).all() and (words[at[known]] == probe[known]).all()
    none = lm_scoring._Tables(words[:0], words[:0], words[:0], np.ones(64), 1, 1, 1)
    assert not none.find(probe)[1].any()


# language


def phrases(sample, text):
    """Greedy parse of text into the longest phrases that occur in sample."""
    n, cur = 1, ()
    for s in text:
        if any(sample[i : i + len(cur) + 1] == (*cur, s) for i in range(len(sample) - len(cur))):
            cur = (*cur, s)
        else:
            n, cur = n + 1, (s,) if s in sample else ()
    return n


def squeezed(t):
    return "".join(c if c.isalpha() else " " for c in t.lower()) if t else ""


def single_blanks(t):
    out = ""
    for c in squeezed(t):
        out += "" if c == " " and (out[-1:] == " " or not out) else c
    return out


@pytest.mark.parametrize("block", [3, 7, 4096])
def test_language_of_whole_texts_by_hand(spark, monkeypatch, block):
    monkeypatch.setattr(language_id, "BLOCK", block)
    rng = random.Random(block)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randint(1, 6)))
    sample = [(lang, " ".join(word(letters) for _ in range(25))) for lang, letters in (("xx", "abcde"), ("yy", "abxyz")) for _ in range(3)]
    sample += [("ww", t) for lang, t in sample if lang == "xx"]  # as good as xx everywhere: a tie
    langs = language_id.learn(sample)
    known = {}
    for name in ("ww", "xx", "yy"):
        known[name] = tuple("".join(single_blanks(t) + " " for lang, t in sorted(set(sample)) if lang == name))
    assert langs.names == ["ww", "xx", "yy"] and langs.lengths.tolist() == [len(known[n]) for n in langs.names]
    texts = [" ".join(word(rng.choice(["abcde", "abxyz", "abq"])) for _ in range(rng.randint(1, 30))) for _ in range(25)] + [None, "", "1!", "日本", "a" * 200]
    rows = {r["doc_id"]: r for r in language_id.predict(frame(spark, [(i, t, "q", 3) for i, t in enumerate(texts)], "doc_id long, text string, lang_pred string, score int"), langs).collect()}
    for i, t in enumerate(texts):
        x = single_blanks(t)
        if not any(c.isalpha() for c in x):
            assert (rows[i]["lang_pred"], rows[i]["score"]) == ("und", 0.0)
            continue
        bits = [phrases(known[n], x) * math.log2(len(known[n])) / len(x) for n in langs.names]
        assert rows[i]["lang_pred"] == langs.names[int(np.argmin(bits))] != "xx"
        assert rows[i]["score"] == pytest.approx(1 / sum(math.exp(-4 * (b - min(bits))) for b in bits))


def test_language_sample_is_shared_and_bounded(spark, monkeypatch):
    assert language_id.shares([5, 100, 100, 0], 45) == [5, 20, 20, 0] and language_id.shares([1, 2], 10) == [1, 2] and language_id.shares([], 3) == []
    monkeypatch.setattr(language_id, "LANGUAGES", 2)
    rows = [(i, f"{'abcdefgh'[i % 8]}{i} " * 400, ["en", "fr", "zz"][i % 3 if i < 90 else 0]) for i in range(200)]
    rows += [(1, f"again {i}", "fr") for i in range(100)] + [(None, "no id", "en"), (300, None, "en"), (301, "", "fr")]
    df = frame(spark, rows, "doc_id long, text string, lang string")
    got = language_id.train(df)
    assert got.names == ["en", "fr"] and (got.lengths <= language_id.SAMPLE_SYMBOLS).all()
    sent = []
    monkeypatch.setattr(language_id, "learn", lambda s: sent.extend(s))
    language_id.train(df)
    assert len(sent) <= 2 * language_id.SAMPLE_DOCS and max(len(t) for _, t in sent) <= language_id.SAMPLE_CHARS
    assert len({lang + t[:3] for lang, t in sent}) > 20


def test_language_of_a_very_long_text(spark):
    langs = language_id.learn([("en", "the cat sat on the mat and the dog ran"), ("fr", "le chat dort et le chien court dans la rue")])
    df = frame(spark, [(1, "the cat and the dog " * 60_000), (2, "le chien et le chat")])
    assert {r["doc_id"]: r["lang_pred"] for r in language_id.predict(df, langs).collect()} == {1: "en", 2: "fr"}


# quality


def test_terms_by_hand():
    texts = ["The the cat cat sat. Sat", "", None, "é é ÉÉ!!", "x" * 30, "a b c a b c a b c"]
    got = quality_knn.terms(pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], ["i", "t"]))
    kinds = quality_knn._classes()
    for row, t in zip(got, texts):
        raw = (t or "").encode()
        words = raw.split()
        n = max(1, len(words))
        want = np.zeros(quality_knn.WORDS)
        for w in words:
            low = bytes(b + 32 if 65 <= b <= 90 else b for b in w)
            want[int(common.word_hashes(np.frombuffer(low, np.uint8), np.array([0]), np.array([len(low)]))[0]) % quality_knn.WORDS] += 1
        assert np.allclose(row[: quality_knn.WORDS], np.sqrt(want / n), atol=1e-6)
        pairs = np.zeros(64 * 64)
        for a, b in zip(raw, raw[1:]):
            pairs[kinds[a] * 64 + kinds[b]] += 1
        assert np.allclose(row[quality_knn.WORDS : -8], np.sqrt(pairs / max(1, pairs.sum())), atol=1e-6)
        grams = [tuple(words[i - 2 : i + 1]) for i in range(2, len(words))]
        shape = [
            sum(a == b for a, b in zip(words, words[1:])),
            sum(kinds[w[0]] == 27 and len(w) > 1 and kinds[w[1]] == 27 for w in words),
            sum(kinds[w[-1]] >= 31 for w in words),
            sum(w in words[:i] for i, w in enumerate(words)),
            sum(g in grams[:i] for i, g in enumerate(grams)),
            sum(len(w) == 1 for w in words),
            len(words),
        ]
        assert np.allclose(row[-8:-1], np.array(shape) / n if words else 0, atol=1e-6) and row[-1] == (not raw)


def test_projection_and_vote_by_hand(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["good", "fine", "prose", "text"] if i % 2 else ["spam", "buy", "BUY", "$$$"], k=20)), i % 2) for i in range(60)]
    sample = frame(spark, rows, "id long, text string, y int")
    space = quality_knn.learn(sample, 5)
    x = np.concatenate([quality_knn.terms(pa.RecordBatch.from_arrays([pa.array([0]), pa.array([t])], ["i", "t"])) for _, t, _ in rows])
    c = (x - x.mean(0)) * space.scale
    _, s, vt = np.linalg.svd(c.astype(float), full_matrices=False)
    z = c @ vt[:5].T
    assert s[4] > 1.001 * s[5]  # so the space of five dimensions is one
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    own = space.project(x)
    assert np.allclose(own @ own.T, z @ z.T, atol=2e-2)  # the same space, whatever its axes
    again = quality_knn.learn(sample.orderBy(F.rand(1)).repartition(7), 5)
    assert (again.vectors == space.vectors).all() and (again.labels == space.labels).all()


def test_ties_go_to_the_first_rows_of_the_sample():
    v = np.array([[1, 0], [1, 0], [1, 0], [0, 1]], np.float32)
    for labels, want in (([1, 0, 0, 0], 0.5), ([0, 1, 1, 1], 0.5), ([1, 1, 0, 0], 1.0)):
        space = quality_knn.Space(np.zeros(2), np.ones(2), np.eye(2), v, np.array(labels, np.float32))
        assert quality_knn.vote(space, np.array([[1.0, 0.0]]), 2)[0] == pytest.approx(want)
    assert quality_knn.vote(space, np.array([[1.0, 0.0]]), 9)[0] == pytest.approx(0.666666, abs=1e-5)


def test_quality_of_long_texts_and_clashing_columns(spark, sf_dir):
    d, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    space = quality_knn.train(d, labels, per_class=50)
    df = frame(spark, [(1, "a fine day of prose " * 50_000, 9, "p"), (1, "x", 9, "p"), (None, None, 9, "p")], "doc_id long, text string, score int, predicted string")
    rows = quality_knn.score(df, space).collect()
    assert len(rows) == 3 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert quality_knn.score(df.limit(0), space).count() == 0


# toxicity


def weighed(words, lexicon):
    """Of the entries that a word begins with the heaviest, unless the word begins inside an exception."""
    spared = set()
    for phrase in lexicon.exceptions:
        own = phrase.split(" ")
        for i in range(len(words) - len(own) + 1):
            if words[i : i + len(own)] == own:
                spared |= set(range(i, i + len(own)))
    return sum(max((w for e, w in lexicon.weights.items() if words[i].startswith(e)), default=0.0) for i in range(len(words)) if i not in spared)


def test_matching_by_hand():
    rng = random.Random(7)
    for _ in range(200):
        word = lambda: "".join(rng.choices("ab", k=rng.randint(1, 5)))
        lexicon = toxicity.Lexicon({word(): rng.randint(1, 9) / 2 for _ in range(4)}, tuple({" ".join(word() for _ in range(rng.randint(1, 3))) for _ in range(4)} - set()))
        lexicon = toxicity.Lexicon(lexicon.weights, tuple(p for p in lexicon.exceptions if " " in p))
        words = [word() for _ in range(rng.randint(0, 40))]
        assert toxicity.weigh(words, toxicity._automaton(lexicon)) == pytest.approx(weighed(words, lexicon)), (words, lexicon)


def test_matching_takes_linear_time():
    lexicon = toxicity.Lexicon({"trash": 2.0}, ("trash can",))
    found = toxicity._automaton(lexicon)
    began = time.process_time()
    assert toxicity.weigh(["trash", "can", "trash"] * 100_000, found) == 200_000.0
    assert time.process_time() - began < 5


def test_learned_lexicon_by_hand(spark):
    rng = random.Random(11)
    plain = [f"{c}{v}{d}" for c in "bdfgklmn" for v in "aeiou" for d in ("rest", "lum", "nor")]
    rows = []
    for i in range(480):
        words = rng.choices(plain, k=30)
        y = int(i % 6 == 0)
        if y:
            words.insert(rng.randrange(30), "zorgling")
        elif i % 96 == 1:
            words[5:7] = ["zorgling", "festival"]
        rows.append((i, " ".join(words), y))
    rows += [(1000 + i, "quibbled " + rows[0][1] + " quibbles", 1) for i in range(12)]  # copies of one toxic text
    lexicon = toxicity.learn(frame(spark, rows, "id long, text string, y int"))
    assert set(lexicon.weights) == {"zorg"} and "zorgling festival" in lexicon.exceptions
    # by direct count
    share = sum(y for *_, y in rows) / len(rows)
    a = sum(y and " zorgling" in " " + t for _, t, y in rows)
    c = sum(not y and "zorgling" in t for _, t, y in rows)
    heads = {("", *t.split())[t.split().index("zorgling")] for _, t, y in rows if y and "zorgling" in t}
    sketches = {toxicity._sketch(toxicity.folded(t)) for _, t, y in rows if y and "zorgling" in t}
    a = min(a, len(heads), len(sketches))
    assert lexicon.weights["zorg"] == pytest.approx(math.log((a + 0.5) / share) - math.log((c + 0.5) / (1 - share)))
    scored = {r["doc_id"]: r for r in toxicity.score(frame(spark, [(1, "the zorgling festival", 2, "n"), (2, "a Z0RGLING!", 2, "n"), (None, None, 2, "n"), (2, "fine " * 200_000, 2, "n")], "doc_id long, text string, total int, n_words string"), lexicon).collect()}
    assert scored[1]["predicted"] == 0 and scored[1]["total"] == 0 and len(scored) == 3
    few = toxicity.learn(frame(spark, rows[:12], "id long, text string, y int"))
    assert few.weights == {} and toxicity.learn(frame(spark, [], "id long, text string, y int")).weights == {}


# the pipeline's stages by hand


def test_stages_by_hand(spark, monkeypatch, tmp_path):
    rng = random.Random(13)
    w = [f"w{i}" for i in range(300)]
    say = lambda n: " ".join(rng.choices(w, k=n))
    passage, item, copy = say(45), say(25), say(80)
    rows = [(i, say(rng.randint(1, 90)), "en", f"s{i % 3}", 5) for i in range(60)]
    rows += [(100 + i, f"{say(12)}\n{passage} {say(9)}", "en", "s0", 5) for i in range(6)] + [(200 + i, copy, "en", None, 5) for i in range(5)]
    rows += [(300 + i, f"{say(20)} IDIOT {say(3)}" if i < 4 else f"{say(400)} idiots", "en", "s1", 5) for i in range(6)]
    rows += [(400 + i, f"{say(5)} {item.upper()} {say(5)}", "en", "s2", 5) for i in range(3)] + [(500, None, "en", "s1", 5), (501, "", None, "s1", 5), (None, passage, "en", "s1", 5), (502, passage, "en", "s1", 5)]
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    docs = frame(spark, rows, kinds)
    frame(spark, [(1, item), (2, say(30)), (3, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, [(1, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    lexicon = toxicity.Lexicon({"idiot": 4.0}, (), 4.0, -6.0)
    monkeypatch.setattr(toxicity, "train", lambda *a, **k: lexicon)
    stages = dict(corpus_pipeline.STAGES)
    plain = lambda df: sorted(map(tuple, df.select(*corpus_pipeline.COLUMNS).collect()), key=repr)

    toxic = lambda t: 1 / (1 + math.exp(-(4 * math.log1p(100 * weighed(toxicity.folded(t or ""), lexicon) / (len(toxicity.folded(t or "")) + 50)) - 6))) >= 0.5
    want = [r for r in rows if not toxic(r[1])]
    assert 0 < len(rows) - len(want) < 6
    assert plain(stages["toxicity"](spark, docs, str(tmp_path))) == sorted(want, key=repr)

    spans = cut([(r[0], r[1]) for r in rows])
    cut_docs = stages["substring_dedup"](spark, docs, str(tmp_path))
    got = sorted((r["doc_id"], " ".join((r["text"] or "").split())) for r in cut_docs.where("doc_id IS NOT NULL").collect())
    assert got == sorted((i, t) for i, n, gone, t in spans if i is not None and not (gone and gone == n))
    untouched = {(i, t) for i, n, gone, t in spans if not gone}
    assert {r["doc_id"]: r["text"] for r in cut_docs.collect() if (r["doc_id"], " ".join((r["text"] or "").split())) in untouched} == {r[0]: r[1] or "" for r in rows if (r[0], " ".join((r[1] or "").split())) in untouched}
    assert all(r["n_chars"] == len(r["text"]) for r in cut_docs.collect() if (r["doc_id"], " ".join((r["text"] or "").split())) not in untouched)

    own = item.split()
    windows = {tuple(own[i : i + 10]) for i in range(16)}
    dirty = lambda t: any(tuple(x[i : i + 10]) in windows for x in [(t or "").lower().split()] for i in range(len(x) - 9))
    assert sum(dirty(r[1]) for r in rows) == 3
    assert plain(stages["decontamination"](spark, docs, str(tmp_path))) == sorted((r for r in rows if not dirty(r[1])), key=repr)

    size = collections.Counter(r[3] for r in rows)
    weight = {s: math.sqrt(n) for s, n in size.items()}
    mean = {s: weight[s] * len(rows) / (sum(weight.values()) * size[s]) for s in size}
    import hashlib

    copies = collections.Counter()
    for r in rows:
        u = int(hashlib.md5(f"20240:{'null' if r[0] is None else r[0]}:1".encode()).hexdigest()[:13], 16) / 2**52
        k, p = 0, math.exp(-mean[r[3]])
        total = p
        while total <= u:
            k += 1
            p *= mean[r[3]] / k
            total += p
        copies[r[0]] += k
    mixed = stages["mixing"](spark, docs, str(tmp_path))
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {i: n for i, n in copies.items() if n}
    assert all(set(r) == set(range(1, len(r) + 1)) for (r,) in mixed.groupBy("doc_id").agg(F.sort_array(F.collect_list("copy"))).select("sort_array(collect_list(copy), true)").collect())


def test_decontamination_takes_rows_without_ids_and_clashing_columns(spark):
    item = " ".join(f"i{k}" for k in range(12))
    docs = frame(spark, [(1, item, 3, "x"), (None, item, 3, "x"), (1, "other", 3, "x"), (2, None, 3, "x")], "doc_id long, text string, n_hit int, items string")
    rows = decontaminate.contamination(docs, frame(spark, [(5, item), (None, item)], "item_id long, text string")).collect()
    hits = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_hit"]) for r in rows)
    assert hits == [(False, 1, 1, 0), (False, 1, 12, 12), (False, 2, 0, 0), (True, 0, 12, 12)]


def test_run_leaves_only_its_result(spark):
    small, before = "/root/testdata/sf0.001", len(common._MADE)
    out = corpus_pipeline.run(spark, small)
    assert len(common._MADE) == before + 1 and out.columns == [*corpus_pipeline.COLUMNS, "copy"]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, small), "t")
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)
