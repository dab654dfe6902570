"""The corpus operators against brute force, and on the cases that break things."""

import collections
import io
import math
import random
import struct
import zipfile
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lakeloom.llm import (
    common,
    components,
    decontaminate,
    language_id,
    lm_scoring,
    mixing,
    quality_knn,
    quality_rules,
    registry,
    simhash,
    substring_dedup,
    toxicity,
    warc_zip,
)
from lakeloom.llm import recurrent_lm as lm

WORDS = [f"w{i}" for i in range(400)]


def text(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


@pytest.fixture(scope="module")
def docs(spark):
    """Copies, near copies, shared passages, nulls, blanks, repeats of an id, clashing extra columns."""
    rng = random.Random(3)
    passage, base = text(rng, 60), text(rng, 200)
    rows = [(i, text(rng, rng.randint(1, 150))) for i in range(60)]
    rows += [(100 + i, base) for i in range(8)]
    rows += [(120 + i, base.replace("w7 ", f"x{i} ", 1) + f" end{i}") for i in range(8)]
    rows += [(140 + i, text(rng, 20) + "\n" + passage + " \t" + text(rng, 25)) for i in range(10)]
    rows += [(160, None), (161, ""), (162, " \n\t "), (163, "one"), (164, "a " * 500), (165, "zz " * 45), (None, base), (166, "Ünïcödé ﬀ 日本 語"), (167, text(rng, 30_000))]
    rows += [(5, rows[5][1]), (168, "A B C 　 d")]
    return spark.createDataFrame([(i, t, "en", "s" + str((i or 0) % 3), 1, 9, "x", "y") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, n_words int, fail_bits string, fp string")


def plain(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def against_sql(name, spark, frames):
    con = duckdb.connect()
    for t, df in frames.items():
        con.register(t, df.toPandas().astype(object).where(lambda x: x.notna(), None))
    return con.sql(registry.ORACLES[name])


def same(got, want, ids):
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    order = [want.columns.index(c) for c in cols]
    a = sorted(tuple(map(str, (r[c] for c in cols))) for r in got.collect())
    b = sorted(tuple(str(r[i]) for i in order) for r in want.fetchall())
    assert a == b


# quality rules


def test_rules_match_sql(spark, tmp_path, docs):
    keep = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).select("doc_id", "text")
    keep.write.parquet(f"{tmp_path}/documents.parquet")
    same(quality_rules.op1_quality_rules(spark, str(tmp_path)), against_sql("op1_quality_rules", spark, {"documents": keep}), ["doc_id"])
    same(quality_rules.quality_ablation(spark, str(tmp_path)), against_sql("quality_ablation", spark, {"documents": keep}), ["rule"])


def test_policies_and_ablation(spark, docs):
    led = quality_rules.ledger(docs).cache()
    assert led.count() == docs.count()
    loose = quality_rules.apply_policy(led, quality_rules.Policy("v2", ("few_words",)))
    assert loose.where("kept <> (n_words >= 50)").count() == 0
    rows = {r["rule"]: r for r in quality_rules.ablation(led).collect()}
    bits = [r["fail_bits"] for r in led.collect()]
    for i, rule in enumerate(quality_rules.RULES):
        r = rows[rule.name]
        assert r["n_failed"] == sum(b >> i & 1 for b in bits)
        assert r["n_failed_only_this"] == sum(b == 1 << i for b in bits)
        assert r["n_kept_without"] == sum(b & ~(1 << i) == 0 for b in bits)
    assert {r["n_failed"] for r in quality_rules.ablation(led.limit(0)).collect()} == {0}
    with pytest.raises(KeyError):
        quality_rules.mask(quality_rules.Policy("v3", ("nothing",)))


# SimHash


def fingerprint(t, width=3):
    w = (t or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + width]), 42) for i in range(max(1, len(w) - width + 1))]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def grouped(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in links:
        root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(n)]


def test_simhash_matches_brute_force(spark, docs):
    rows = [(i, t) for i, t in plain(docs) if i is not None]
    fps = [fingerprint(t) for _, t in rows]
    part = grouped(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    least = collections.defaultdict(lambda: 1 << 60)
    for (i, _), p in zip(rows, part):
        least[p] = min(least[p], i)
    want = sorted((i, fps[k], least[part[k]]) for k, (i, _) in enumerate(rows))
    got = simhash.near_duplicates(docs.where("doc_id IS NOT NULL")).collect()
    assert sorted((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got) == want


@pytest.mark.parametrize("pairs", [512, 1])
def test_buckets_by_pairs_and_by_lookup(pairs, monkeypatch):
    monkeypatch.setattr(simhash, "PAIRS", pairs)
    rng = np.random.default_rng(1)
    v = np.unique(np.concatenate([rng.integers(0, 2**63, 20).astype(np.uint64), np.uint64(1) << np.arange(40, dtype=np.uint64), np.array([0, 7, 31], np.uint64)]))
    want = grouped(len(v), [(i, j) for i in range(len(v)) for j in range(i) if (int(v[i]) ^ int(v[j])).bit_count() <= 2])
    assert simhash._parts(v).tolist() == want


def test_links_meet_on_any_two_bits(spark):
    base = 0x123456789ABCDEF
    for a, b in ((0, 1), (0, 63), (31, 32), (40, 41)):
        other = base ^ (1 << a) ^ (1 << b)
        signed = [x - (1 << 64) if x >> 63 else x for x in (base, other)]
        assert simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).count() == 1
    assert simhash.links(spark.createDataFrame([(base,), (base ^ 7,)], "fp long")).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 40)] + [(7, 7), (3, 4)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{1000 + i: 1000 for i in range(40)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# repeated passages


def test_substring_dedup_matches_brute_force(spark, docs):
    rows = sorted((i, t) for i, t in plain(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])))
    seen, want = set(), {}
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for p in range(len(w) - 19):
            k = b" ".join(w[p : p + 20])
            if k in seen:
                gone[p : p + 20] = [True] * 20
            seen.add(k)
        want[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    one = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup.dedup(one, joined=True).collect()}
    assert got == want
    assert sum(v[1] > 0 for v in want.values()) > 20


def test_substring_dedup_keeps_blanks_columns_and_odd_ids(spark, docs):
    out = substring_dedup.dedup(docs)
    assert set(docs.columns) <= set(out.columns) and out.count() == docs.count()
    for r in out.join(docs.where("doc_id < 60 AND doc_id <> 5").select("doc_id", F.col("text").alias("was")), "doc_id").collect():
        assert r["n_removed"] > 0 or r["kept_text"] == (r["was"] or "")
    twice = out.where("doc_id = 5").collect()
    assert len(twice) == 2 and all(r["n_removed"] == 0 for r in twice)
    assert out.where("doc_id IS NULL").first()["n_removed"] == 0


# decontamination


def test_decontamination_matches_sql(spark, tmp_path, docs):
    rng = random.Random(9)
    d = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).select("doc_id", "text")
    rows = {r["doc_id"]: r["text"] for r in d.collect()}
    w = rows[141].split()
    items = [(1, " ".join(w[22:50]).upper()), (2, text(rng, 40)), (3, "zz, ZZ; zz"), (4, None), (5, "..."), (6, " ".join(rows[100].split()[:10])), (10, " ".join(rows[100].split()[:11])), (7, "Ünïcödé ﬀ"), (8, "zz " * 12), (9, "w1")]
    b = spark.createDataFrame(items, "item_id long, text string")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    b.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = decontaminate.op2_decontaminate(spark, str(tmp_path))
    same(got, against_sql("op2_decontaminate", spark, {"documents": d, "benchmark": b}), ["doc_id"])


def test_decontamination_in_slices_and_empty(spark, docs, monkeypatch):
    b = spark.createDataFrame([(1, " ".join(plain(docs)[62][1].split()[3:30]))], "item_id long, text string")
    want = sorted(map(str, decontaminate.contamination(docs, b).collect()))
    monkeypatch.setattr(decontaminate, "SENT", 5)
    monkeypatch.setattr(decontaminate, "PLACES", 2)
    assert sorted(map(str, decontaminate.contamination(docs, b).collect())) == want
    assert decontaminate.contamination(docs, b.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(docs.limit(0), b).count() == 0


# archives


def test_archives_match_sql(spark, tmp_path):
    big = "<html>" + "x" * 200 + "é</html>"
    rows = [(5, "http://a/ b\n", big), (2, "u", big), (9, None, big), (3, "u", "short"), (4, "u", "short"), (6, "u", None), (7, "u", ""), (8, "u", "y" * 5_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    same(warc_zip.op7_warc(spark, str(tmp_path)), against_sql("op7_warc", spark, {"pages": pages}), ["page_id"])
    back = {r["page_id"]: r["payload"] for r in warc_zip.read(warc_zip.write(pages)).collect()}
    assert back == {5: None, 2: big, 9: None, 3: "short", 4: "short", 6: "", 7: "", 8: "y" * 5_000_000}
    assert warc_zip.read(warc_zip.write(pages.limit(0))).count() == 0


def test_archives_roll_over(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc_zip, "RECORDS", 3)
    folder = "file://" + str(tmp_path / "a")
    done = [b.to_pylist() for b in warc_zip._written(folder)(iter([__import__("pyarrow").RecordBatch.from_pylist([{"page_id": i, "url": "u", "payload": str(i), "digest": "d", "refers_to": None} for i in range(8)])]))]
    assert sum(len(x) for x in done) == 3 and sum(r["records"] for x in done for r in x) == 8


def test_zip_directory_and_zip64():
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        with z.open("a", "w", force_zip64=True) as f:
            f.write(b"hello")
        z.writestr("dir/b", b"there", compress_type=zipfile.ZIP_DEFLATED)
    raw = body.getvalue()
    found = warc_zip.members(io.BytesIO(raw), len(raw))
    assert found["a"][0] == 0 and raw[found["a"][1] : found["a"][1] + found["a"][2]] == b"hello" and found["dir/b"][0] == 8
    # the same directory told through ZIP64 records only
    end = raw.rfind(b"PK\x05\x06")
    n, size, start = struct.unpack("<10xHII", raw[end : end + 20])
    wide = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, size, start)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, end, 1)
    short = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    told = raw[:end] + wide + locator + short
    assert warc_zip.members(io.BytesIO(told), len(told)) == found
    with pytest.raises(ValueError):
        warc_zip.members(io.BytesIO(b"no archive"), 10)


# mixing


def test_mixing_matches_sql(spark, tmp_path, docs):
    d = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).select("doc_id", "text", "lang", "source", "n_chars")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    same(mixing.op8_mixing(spark, str(tmp_path)), against_sql("op8_mixing", spark, {"documents": d}), ["doc_id", "copy"])


def test_mixing_meets_targets_and_odd_sources(spark):
    d = spark.range(40_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "a").when(F.col("id") % 10 < 9, "b").alias("source"))
    t = spark.createDataFrame([("a", 0.6), ("b", 0.2), (None, 0.2), ("none", 5.0)], "source string, weight double")
    got = {r["source"]: r["n"] for r in mixing.sizes(mixing.mix(d, t)).collect()}
    for source, share in (("a", 0.6), ("b", 0.2), (None, 0.2)):
        assert abs(got[source] - 40_000 * share) < 5 * math.sqrt(40_000 * share)
    one = mixing.mix(d.limit(200), spark.createDataFrame([("a", 1.0), ("b", -1.0)], "source string, weight double"), wanted=200_000)
    n = one.count()
    assert abs(n - 200_000) < 5 * math.sqrt(200_000) and one.where("source <> 'a'").count() == 0
    assert mixing.mix(d.limit(0)).count() == 0
    assert mixing.mix(d, t, seed=1).exceptAll(mixing.mix(d.repartition(3), t, seed=1)).count() == 0


# learned operators


def test_lm_is_a_distribution_and_gradients_train_it():
    rng = np.random.default_rng(0)
    counts = np.array([50, 30, 20, 5, 1])
    m = lm.new_model(counts, np.zeros(lm.SHAPES))
    texts = [np.array([0, 1, 2, 3] * 6 + [4]) for _ in range(40)]
    trainer = lm.Trainer(m)
    for i in range(60):
        trainer.run(texts, 8, 8, 1e-2 * (1 - i / 70), 1e-2 * (1 - (i + 1) / 70))
    trained = lm.Model(trainer.p)
    before, after = lm.log10_likelihood(m, texts[:1])[0], lm.log10_likelihood(trained, texts[:1])[0]
    assert after > before + 8  # the order of words is learned
    prefix = np.array([0, 1])
    every = [*range(5), *range(lm.VOCABULARY, lm.VOCABULARY + lm.SHAPES)]
    p = lm.log10_likelihood(trained, [np.append(prefix, w) for w in every]) - lm.log10_likelihood(trained, [prefix])[0]
    assert abs((10.0**p).sum() - 1) < 1e-3
    mixed = [rng.integers(0, 5, n) for n in (1, 70, 3, 33)] + [np.zeros(0, np.int64)]
    alone = [lm.log10_likelihood(trained, [t])[0] for t in mixed]
    assert np.allclose(lm.log10_likelihood(trained, mixed), alone, atol=1e-3)


def test_lm_scoring_base_and_odd_texts(spark, docs, monkeypatch):
    monkeypatch.setattr(lm_scoring, "FREQUENT", 50)
    keep = F.coalesce(F.col("doc_id") % 7 != 2, F.lit(True))
    got, tables = lm_scoring.fit_and_score(docs, keep)
    tok = [(i, (t or "").encode().lower().split() + [b"\x00end"]) for i, t in plain(docs)]
    c = collections.Counter(w for i, ws in tok if i is None or i % 7 != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    assert (tables.total, tables.distinct) == (n, v)
    want = sorted((i if i is not None else -1, len(ws), sum(c[w] > 0 for w in ws), round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 4)) for i, ws in tok)
    rows = got.collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in rows) == want
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    none, empty = lm_scoring.fit_and_score(docs.limit(3), F.lit(False))
    assert empty.total == 0 and all(math.isfinite(r["score"]) for r in none.collect())
    assert lm_scoring.fit_and_score(docs.limit(0), F.lit(True))[0].count() == 0


def test_lm_learns_from_every_training_text(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "FIRST_TOKENS", 200)
    rng = random.Random(8)
    rows = [(i, " ".join("a b c d".split() * 40)) for i in range(400)]
    mixed = [(i, " ".join(rng.sample(t.split(), 160))) for i, t in rows]
    scores = []
    for texts in (rows, mixed):  # same counts; the text that is scored is the same
        df = spark.createDataFrame([rows[0], *texts[1:]], "doc_id long, text string")
        scores.append(lm_scoring.fit_and_score(df, F.lit(True))[0].where("doc_id = 0").first()["score"])
    assert scores[0] > scores[1] + 0.1


def test_lm_parts_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "PART_TOKENS", 4000)
    monkeypatch.setattr(lm_scoring, "HELD_TOKENS", 1500)
    monkeypatch.setattr(lm_scoring, "TOGETHER", 2)
    rng = random.Random(9)
    df = spark.createDataFrame([(i, text(rng, rng.randint(0, 150))) for i in range(300)], "doc_id long, text string")
    one, two = (lm_scoring.fit_and_score(df.repartition(n), F.lit(True))[1] for n in (1, 5))
    assert all(np.allclose(one.model.p[k], two.model.p[k]) for k in one.model.p)  # however the files are cut
    same = lm.unpacked(lm.packed(one.model), one.model)
    assert all((same.p[k] == v).all() for k, v in one.model.p.items())


def test_automaton_finds_longest_matches():
    rng = random.Random(5)
    train = [rng.randint(1, 4) for _ in range(300)]
    table = language_id.automaton(train, 6)
    joined = bytes(train)
    for _ in range(20):
        probe = [rng.randint(1, 5) for _ in range(80)]
        phrases, i = 1, 0
        cur = b""
        for s in probe:
            if cur + bytes([s]) in joined:
                cur += bytes([s])
            else:
                phrases += 1
                cur = bytes([s]) if bytes([s]) in joined else b""
        state, count = 0, 1
        for s in probe:
            v = table[state * 6 + s]
            state, count = v >> 1, count + (v & 1)
        assert count == phrases


def test_language_of_tables_and_odd_texts(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    langs = language_id.train(d, common.fold("doc_id", 4) != 2)
    got = language_id.predict(d, langs).join(d.select("doc_id", "lang"), "doc_id").where(common.fold("doc_id", 4) == 2)
    assert got.where("lang = lang_pred").count() >= 0.98 * got.count()
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !? 34"), (None, "日本語"), (4, "the and of that")], "doc_id long, text string")
    rows = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(odd, langs).collect()}
    assert rows[1] == rows[2] == rows[3] == ("und", 0.0) and rows[None][0] in langs.names and rows[4][0] == "en"
    assert language_id.train(d.limit(0)) is None
    assert {r["lang_pred"] for r in language_id.predict(odd, None).collect()} == {"und"}


def test_quality_on_held_out_rows(spark, sf_dir):
    d, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    space = quality_knn.train(d, labels, common.fold("doc_id", 3) != 1)
    got = quality_knn.score(d, space).join(labels, "doc_id").where(common.fold("doc_id", 3) == 1)
    assert got.where("predicted = quality").count() >= 0.95 * got.count()
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "x")], "doc_id long, text string")
    assert all(0 <= r["score"] <= 1 for r in quality_knn.score(odd, space).collect())
    assert {r["score"] for r in quality_knn.score(odd, quality_knn.train(d, labels.limit(0))).collect()} == {0.5}


def test_votes_are_exact_neighbours():
    rng = np.random.default_rng(2)
    v = rng.standard_normal((200, 8)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    space = quality_knn.Space(np.zeros(8), np.ones(8), np.eye(8, dtype=np.float32), v, (rng.random(200) > 0.5).astype(np.float32))
    z = v[:5]
    for i, p in enumerate(quality_knn.vote(space, z, 7)):
        s = v @ z[i]
        near = np.argsort(-s)[:7]
        w = np.maximum(s[near], 0) ** 2 + 1e-6
        assert abs(p - (w * space.labels[near]).sum() / w.sum()) < 1e-5


def test_toxicity_folding_exceptions_and_odd_texts(spark):
    assert toxicity.folded("1D10T, mоrоn! tr@sh") == ["idiot", "moron", "trash"]
    lex = toxicity.Lexicon({"idiot": 5.0, "trash": 4.0}, ("trash can",), 4.0, -2.0)
    found = toxicity._automaton(lex)
    assert toxicity.weigh(toxicity.folded("an id1ots trash"), found) == 9.0
    assert toxicity.weigh(toxicity.folded("the trash can"), found) == 0.0
    assert toxicity.weigh(toxicity.folded("nontrash"), found) == 0.0
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "you IDIOT"), (None, "fine day")], "doc_id long, text string")
    rows = {r["doc_id"]: r["predicted"] for r in toxicity.score(odd, lex).collect()}
    assert rows == {1: 0, 2: 0, 3: 1, None: 0}
    assert toxicity.score(odd, toxicity.Lexicon({}, (), 1.0, -10.0)).where("predicted = 1").count() == 0


def test_toxicity_on_held_out_rows(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    lex = toxicity.train(d, labels, common.fold("doc_id", 5) != 0)
    got = toxicity.score(d, lex).join(labels, "doc_id").where(common.fold("doc_id", 5) == 0)
    assert got.where("predicted = toxic").count() >= 0.96 * got.count()
    assert got.where("predicted = 1 AND toxic = 1").count() >= 0.8 * got.where("toxic = 1").count()
    assert not toxicity.train(d, labels.limit(0)).weights


# helpers and the pipeline


def test_words_and_hashes_are_alike_in_every_piece():
    import pyarrow as pa

    texts = ["aa bb", "", None, "cc", "bb x aa", " ", "dd" * 50]
    text, off = common.buffers(pa.array(texts))
    starts, ends, first = common.word_bounds(text, off, common.blank_table())
    words = [bytes(text[a:b]) for a, b in zip(starts, ends)]
    want = [(t or "").encode().split() for t in texts]
    assert words == [w for ws in want for w in ws]
    assert np.diff(first).tolist() == [len(w) for w in want]
    h = common.word_hashes(text, starts, ends)
    seen = {}
    assert all(seen.setdefault(w, x) == x for w, x in zip(words, h)) and len(set(seen.values())) == len(seen)
    runs = common.Runs(h)
    assert runs.of(np.array([0]), np.array([1]))[0] == runs.of(np.array([5]), np.array([6]))[0] or words[0] != words[5]


def test_pipeline_stages(spark, sf_dir):
    small = "/root/testdata/sf0.001"
    d = spark.read.parquet(f"{small}/documents.parquet")
    lexicon = toxicity.train(d, spark.read.parquet(f"{small}/labels.parquet"), common.fold("doc_id", 5) != 0)
    toxic = {r["doc_id"] for r in toxicity.score(d, lexicon).where("predicted = 1").collect()}
    rows = {r["doc_id"]: r for r in d.collect()}
    one = corpus_pipeline.STAGES[0][1](spark, d, small).cache()
    assert {r["doc_id"] for r in one.collect()} == set(rows) - toxic
    two = corpus_pipeline.STAGES[1][1](spark, one, small).cache()
    fps = {r["doc_id"]: fingerprint(r["text"]) for r in one.collect()}
    ids = sorted(fps)
    part = grouped(len(ids), [(i, j) for i in range(len(ids)) for j in range(i) if (fps[ids[i]] ^ fps[ids[j]]).bit_count() <= 2])
    assert {r["doc_id"] for r in two.collect()} == {ids[p] for p in set(part)}
    three = corpus_pipeline.STAGES[2][1](spark, two, small).cache()
    assert three.columns == list(corpus_pipeline.COLUMNS)
    seen = collections.Counter()
    for r in three.collect():
        w = r["text"].encode().split()
        assert r["n_chars"] is not None
        for k in {b" ".join(w[p : p + 20]) for p in range(len(w) - 19)}:
            seen[k] += 1
    assert not seen or max(seen.values()) <= 2  # a cut may join words into a window that is elsewhere
    four = corpus_pipeline.STAGES[3][1](spark, three, small).cache()
    hit = decontaminate.contamination(three, spark.read.parquet(f"{small}/benchmark.parquet")).where("n_hit > 0")
    assert {r["doc_id"] for r in four.collect()} == {r["doc_id"] for r in three.collect()} - {r["doc_id"] for r in hit.collect()}
    five = corpus_pipeline.STAGES[4][1](spark, four, small)
    assert five.columns == [*corpus_pipeline.COLUMNS, "copy"] and five.count() > 0


def test_pipeline_stages_take_odd_documents(spark, docs):
    d = docs.select(*corpus_pipeline.COLUMNS, F.lit(1).alias("total"))
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, d, "/root/testdata/sf0.001")
        assert out.count() > 0
        assert stage(spark, d.limit(0), "/root/testdata/sf0.001").count() == 0
        d = common.stored(out, "t")


def test_folds_are_crc32(spark):
    got = spark.range(20).select("id", common.fold("id", 7).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 7 for r in got)


def test_registry_names():
    assert {n.split("_")[0] for n in registry.QUERIES if n != "quality_ablation"} == {f"op{i}" for i in range(1, 11)}


@pytest.mark.parametrize("size", [0.05, 40.0])
def test_softmax_without_a_search_for_the_greatest_score(size):
    rng = np.random.default_rng(5)
    h = rng.uniform(-1, 1, (300, 8)).astype(np.float32)
    weight, bias = (rng.standard_normal((8, 20)) * size).astype(np.float32), rng.standard_normal(20).astype(np.float32)
    bias[3] = lm._NEVER
    shifted, near = lm._shifted(weight, bias)
    assert bool(near) == (size < 1)  # of large weights every row is searched
    scores = h.astype(float) @ weight + bias
    want = scores - scores.max(1, keepdims=True)
    want -= np.log(np.exp(want).sum(1, keepdims=True))
    pick = np.where((at := rng.integers(0, 20, 300)) == 3, 4, at)
    assert lm._log_share(h, weight, shifted, bool(near), pick) == pytest.approx(want[np.arange(300), pick], rel=1e-4, abs=1e-4)
    x = (h @ weight + shifted).astype(np.float32)
    total = lm._exponentials(x, bool(near))
    assert x / total[:, None] == pytest.approx(np.exp(want), abs=1e-5)


def test_gates_at_their_ends_and_texts_of_many_lengths():
    """Steps over planes against the gates as written; far scores neither overflow nor warn."""
    rng, n = np.random.default_rng(4), 5
    u, x, h = rng.standard_normal((n, 3 * n)).astype(np.float32), (rng.standard_normal((40, 3 * n)) * 60).astype(np.float32), rng.uniform(-1, 1, (40, n)).astype(np.float32)
    g = (h @ u).astype(float)
    z, r = (0.5 + 0.5 * np.tanh((x + g)[:, i * n : (i + 1) * n] / 2) for i in (0, 1))
    c = np.tanh(x[:, 2 * n :] + r * g[:, 2 * n :])
    out = np.empty_like(h)
    with np.errstate(all="raise", under="ignore"):
        lm._step(lm._planes(u), lm._planes(x), h, out)
    assert np.allclose(out, z * h + (1 - z) * c, atol=1e-5)
    model = lm.new_model(np.arange(lm.VOCABULARY, 0, -1.0), np.ones(lm.SHAPES))
    texts = [rng.integers(0, lm.START, k) for k in (3, 0, 700, 1, 40, 40, 9)]
    assert np.allclose(lm.log10_likelihood(model, texts), [lm.log10_likelihood(model, [t])[0] for t in texts], rtol=1e-5, atol=1e-3)
