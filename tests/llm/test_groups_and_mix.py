"""SimHash groups, mixing, language-model scores and the pipeline."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tabprep.llm import lm_model, lm_scoring, simhash
from tabprep.llm.lm_queries import held_out, op4_lm_scores
from tabprep.llm.lm_scoring import score_texts
from tabprep.llm.mixing import Level, mix_sources
from tabprep.llm.simhash_queries import op8_simhash
from tabprep.llm.subwords import byte_bpe


def lower_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain_fingerprint(text):
    words = lower_words(text)
    grams = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(points, near):
    parent = {p: p for p in points}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in near:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {p: root(p) for p in points}


def near_pairs(points, radius=4):
    x = np.array(sorted(points), np.uint64)
    for k in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[k + 1 :] ^ x[k]) <= radius):
            yield int(x[k]), int(x[k + 1 + j])


def test_fingerprints_and_groups_of_the_table(spark, folder):
    bodies = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t) for i, t in bodies.items()}
    group = components(set(prints.values()), near_pairs(set(prints.values())))
    least = defaultdict(lambda: 1 << 62)
    for i, p in prints.items():
        least[group[p]] = min(least[group[p]], i)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op8_simhash(spark, folder).collect()}
    assert found == {i: (f"{p:016x}", least[group[p]]) for i, p in prints.items()}


@pytest.mark.parametrize("leaf", [8, 64, 4096])
def test_vantage_trees_keep_every_component(leaf):
    rng = np.random.default_rng(0)
    points = set(map(int, rng.integers(0, 2**64, 200, dtype=np.uint64)))
    points |= {int(x) << 20 for x in rng.integers(0, 2**14, 400)}
    for p in sorted(points)[:60]:
        for _ in range(20):
            points.add(p ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(1, 8), replace=False)))
    links = simhash.vantage_links(np.array(sorted(points), np.uint64), leaf=leaf)
    assert all(bin(a ^ b).count("1") <= 4 for a, b in links)
    assert components(points, links) == components(points, near_pairs(points))


def test_links_in_spark_find_crowded_and_lone_groups(spark):
    rng = np.random.default_rng(1)
    points = {int(x) for x in rng.integers(-(2**63), 2**63, 300)} | {0, -1, 1, 15, 31, 2**62}
    for centre in (12345, -(2**60)):
        points |= {centre ^ sum(1 << int(k) for k in rng.choice(60, rng.integers(1, 7), replace=False)) for _ in range(400)}
    df = spark.createDataFrame([(p,) for p in points], "fingerprint long").repartition(7)
    found = {r["fingerprint"]: r["label"] for r in simhash.fingerprint_labels(df).collect()}
    unsigned = {p: p & (2**64 - 1) for p in points}
    want = components(set(unsigned.values()), near_pairs(set(unsigned.values())))
    groups, own = defaultdict(set), defaultdict(set)
    for p in points:
        groups[want[unsigned[p]]].add(p)
        own[found[p]].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, own.values()))


def test_near_duplicates_with_odd_rows(spark, docs_of):
    long = " ".join(f"w{k}" for k in range(400))
    rows = [(5, long), (3, long), (3, long), (7, long.replace("w7 ", "x7 ", 1)), (None, long), (9, None), (8, ""), (None, "q"), (2, "other text here")]
    docs = docs_of(rows).withColumn("fingerprint", F.lit("x"))
    found = simhash.group_near_duplicates(docs).collect()
    assert sorted(((r["doc_id"], r["component_id"]) for r in found), key=str) == sorted(
        [(5, 3), (3, 3), (3, 3), (7, 3), (None, 3), (9, 8), (8, 8), (None, None), (2, 2)], key=str
    )
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(3, long), (8, ""), (None, "q"), (2, "other text here")], key=str)
    assert simhash.group_near_duplicates(docs.limit(0)).count() == simhash.drop_near_duplicates(docs.limit(0)).count() == 0


def test_shortage_goes_to_siblings_first(spark, docs_of):
    def leaf(first, n, lang, source):
        return docs_of([(first + k, "a b c d e f g h i j") for k in range(n)], lang, source)

    docs = leaf(0, 100, "en", "a").unionByName(leaf(1000, 10, "en", "b")).unionByName(leaf(2000, 100, "de", "c"))
    levels = [Level("l", F.col("lang"), {}), Level("s", F.col("source"), {})]
    found = mix_sources(docs, levels, share=(1, 2), epochs=2)
    # 2100 words, half of them: 525 for each language; source b can give 200 of its 262.
    assert {(r["l"], r["s"]): r["sum"] for r in found.groupBy("l", "s").agg(F.sum("n_tokens").alias("sum")).collect()} == {
        ("en", "a"): 320, ("en", "b"): 200, ("de", "c"): 520,
    }
    assert found.where("s = 'b'").groupBy("epoch").count().count() == 2
    assert found.drop("l", "s", "epoch", "n_tokens").columns == docs.columns


def test_mix_of_odd_rows(spark, docs_of):
    docs = docs_of([(1, None), (None, "a b"), (None, "a b"), (2, "c"), (2, "c")], None, None).withColumn("epoch", F.lit("x"))
    found = mix_sources(docs, share=(1, 1), epochs=1)
    assert Counter(r["doc_id"] for r in found.collect()) == {1: 1, None: 2, 2: 2}
    assert {(r["domain"], r["lang"], r["source"]) for r in found.collect()} == {("library", "(none)", "(none)")}
    assert mix_sources(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mix_sources(docs, [Level("l", F.col("lang"), {"en": 0})])


def test_model_gradients():
    rng = np.random.default_rng(0)
    p = {n: v.astype(float) for n, v in lm_model.start().items()}
    vocabulary = lm_model.Vocabulary.of(np.arange(lm_model.IDS)[::-1].astype(float))
    before = rng.integers(0, lm_model.IDS, (3, lm_model.LENGTH))
    where = np.sort(rng.choice(3 * lm_model.LENGTH, 60, replace=False))
    targets = np.append(rng.integers(0, 4000, 55), [40_000] * 5)
    _, grad = lm_model.gradients(p, vocabulary, before, targets, where)
    for name, g in grad.items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        loss = []
        for step in (1e-5, -1e-5):
            moved = {n: v.copy() for n, v in p.items()}
            moved[name][at] += step
            loss.append(lm_model.gradients(moved, vocabulary, before, targets, where)[0])
        assert g[at] == pytest.approx((loss[0] - loss[1]) / 2e-5, rel=1e-3)


def test_model_probabilities_sum_to_one_and_look_back_only():
    p, rng = lm_model.start(), np.random.default_rng(0)
    vocabulary = lm_model.Vocabulary.of(rng.integers(0, 50, lm_model.IDS).astype(float))
    before = np.repeat(rng.integers(0, lm_model.IDS, (1, lm_model.LENGTH)), 64, axis=0)
    total = 0.0
    for k in range(0, lm_model.IDS, 64):
        ids = np.arange(k, min(k + 64, lm_model.IDS))
        where = np.arange(len(ids)) * lm_model.LENGTH + 9
        total += np.exp(lm_model.log_probabilities(p, vocabulary, before[: len(ids)], ids, where)).sum()
    assert total == pytest.approx(1, abs=1e-3)
    other = before.copy()
    other[:, 10:] = 17
    args = (np.arange(64), np.arange(64) * lm_model.LENGTH + 9)
    assert np.allclose(lm_model.log_probabilities(p, vocabulary, before, *args), lm_model.log_probabilities(p, vocabulary, other, *args), atol=1e-5)


def test_extreme_logits_give_finite_probabilities():
    rng = np.random.default_rng(1)
    vocabulary = lm_model.Vocabulary.of(rng.integers(0, 50, lm_model.IDS).astype(float))
    before = rng.integers(0, lm_model.IDS, (8, lm_model.LENGTH))
    args = (rng.integers(0, lm_model.IDS, 64), np.arange(64) * 4)
    for scale in (1e-6, 30.0, 3000.0):
        p = {n: v * np.float32(scale) if n in "QKUM" else v for n, v in lm_model.start().items()}
        p["c"] = p["c"] - np.float32(500)
        found = lm_model.log_probabilities(p, vocabulary, before, *args)
        loss, grad = lm_model.gradients(p, vocabulary, before, *args)
        assert np.isfinite(found).all() and (found <= 1e-3).all() and np.isfinite(loss)
        assert all(np.isfinite(g).all() for g in grad.values())


def test_every_id_is_scored_once():
    ids = [np.arange(n) + 5 for n in (1, 31, 32, 33, 56, 57, 200)]
    windows = lm_model.Windows(ids)
    _, targets, _, scored = windows.take(slice(None))
    got = [sorted(targets[windows.text == k][scored[windows.text == k]].tolist()) for k in range(len(ids))]
    assert got == [x.tolist() for x in ids]


def test_base_scores_are_exact_and_the_model_learns(spark, folder):
    bodies = {r["doc_id"]: lower_words(r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in bodies}
    counts = Counter(w for i, ws in bodies.items() if not out[i] for w in ws)
    ends = sum(not o for o in out.values())
    n, v = sum(counts.values()) + ends, len(counts) + 1
    length = [0.0, 0.0]
    for r in op4_lm_scores(spark, folder).collect():
        ws = bodies[r["doc_id"]]
        cs = [counts[w] for w in ws] + [ends]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (out[r["doc_id"]], len(ws) + 1, n)
        assert r["n_known"] == sum(c > 0 for c in cs)
        assert r["base_score"] == pytest.approx(sum(math.log10((c + 1) / (n + v + 1)) for c in cs))
        if r["held_out"]:
            length[0] += r["score"]
            length[1] += sum(len(encoded(w)) for w in ws) * math.log10(1 / lm_model.IDS)
    assert length[0] > 0.6 * length[1]  # far from knowing nothing, on texts it has not seen


def encoded(word):
    from tabprep.llm.subwords import byte_bpe, encoder

    return encoder(*byte_bpe())[" " + word][::4]


def test_every_window_of_every_training_text_trains(spark, docs_of):
    rng = np.random.default_rng(3)
    bodies = [" ".join(f"w{x}" for x in rng.integers(0, 50, n)) for n in (0, 1, 5, 40, 300, 30, 30, 30)]
    vocabulary, params = byte_bpe(), lm_model.start()
    ids = [lm_scoring._subwords(b.encode(), vocabulary, lm_model.END)[0] for b in bodies]
    train = docs_of(enumerate(bodies)).selectExpr("text", "xxhash64(doc_id) AS seed")
    classes = lm_model.Vocabulary.of(np.bincount(np.concatenate(ids), minlength=lm_model.IDS))
    trained = lm_scoring._copies(train, "text", "seed", params, classes, 3, vocabulary).collect()
    assert sum(r["weight"] for r in trained) == len(lm_model.Windows(ids))
    assert all((np.frombuffer(r["params"], "<f4") != lm_model.flat(params)).any() for r in trained)
    assert lm_model.KNOWN == 4032


def test_no_text_is_left_out_by_its_first_words(spark, docs_of):
    """Copies of one text were all in or all out; left out, the model knew nothing of them."""
    for first in ("one", "two", "three", "four", "five"):
        rows = [(i, f"{first} short text that stands here in many copies") for i in range(1500)]
        best = score_texts(docs_of(rows), F.lit(False)).agg(F.min("score")).first()[0]
        assert best > -6, first


def test_scores_of_odd_texts(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "a　b c"), (3, "a　b c"), (None, "x"), (4, "A x")]
    docs = docs_of(rows).withColumn("score", F.lit("x")).withColumn("block", F.lit(1))
    found = score_texts(docs, F.col("doc_id") == 4).collect()
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in found), key=str)
    assert got == sorted([(1, False, 1, 1, 10), (2, False, 1, 1, 10), (3, False, 3, 3, 10), (3, False, 3, 3, 10), (4, True, 3, 2, 10), (None, False, 2, 2, 10)], key=str)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    nothing = score_texts(docs, F.lit(True)).collect()
    assert {r["train_tokens"] for r in nothing} == {0} and all(r["base_score"] == 0 for r in nothing)
    assert score_texts(docs.limit(0), held_out()).count() == 0


def test_pipeline_against_a_plain_version(spark, folder):
    """Each stage on what the one before it kept."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, folder)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near duplicates", "personal data", "source mix", "packing"]
    from tabprep.llm.quality_queries import op9_quality

    want = {r["doc_id"] for r in op9_quality(spark, folder).where("kept").collect()}
    now = {r["doc_id"]: r for r in kept.collect()}
    assert set(now) == want and kept.columns == docs.columns

    lone = corpus_pipeline.STAGES[1][1](spark, kept, folder)
    prints = {i: plain_fingerprint(r["text"]) for i, r in now.items()}
    group = components(set(prints.values()), near_pairs(set(prints.values())))
    least = {}
    for i in sorted(prints):
        least.setdefault(group[prints[i]], i)
    rows = {r["doc_id"]: r for r in lone.collect()}
    assert set(rows) == set(least.values()) and lone.columns == docs.columns

    clean = corpus_pipeline.STAGES[2][1](spark, lone, folder)
    from tabprep.llm.pii_spans import base_spans, masked

    for r in clean.collect():
        spans = base_spans(rows[r["doc_id"]]["text"])
        assert r["text"] == masked(rows[r["doc_id"]]["text"], spans) and r["n_chars"] == len(r["text"])
        assert not base_spans(r["text"])

    mixed = corpus_pipeline.STAGES[3][1](spark, clean, folder)
    assert mixed.columns == docs.columns
    words = {r["doc_id"]: len(lower_words(r["text"])) for r in clean.collect()}
    taken = Counter(r["doc_id"] for r in mixed.collect())
    total = sum(words.values())
    assert set(taken) <= set(words) and max(taken.values()) <= 2
    # Leaves of one or two documents often cannot fill their budget with whole ones.
    assert 0.5 * total < sum(n * words[i] for i, n in taken.items()) <= 0.8 * total

    pieces = corpus_pipeline.STAGES[4][1](spark, mixed, folder).collect()
    assert Counter(r["doc_id"] for r in pieces if r["start"] == 0) == taken
    assert len(corpus_pipeline.run(spark, folder).collect()) == len(pieces)
