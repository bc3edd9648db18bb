"""Packing, substring removal, personal data, quality rules: against plain versions, and odd input."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tabprep.llm import pii, quality
from tabprep.llm.packing import best_fit_decreasing, pack_documents
from tabprep.llm.packing_queries import op6_packing
from tabprep.llm.pii_queries import op7_pii
from tabprep.llm.pii_spans import base_spans, masked
from tabprep.llm.subwords import byte_bpe, byte_bpe_special, encoder
from tabprep.llm.substrings import remove_repeated

ODD = ["", None, "  \n", "a", "word " * 3000, "　 x \x85\n y", "don't stop\r\n\r\n now  ", "<|endoftext|> \xa0 \n b", "a <|endoftext|> b", "<|endoftext|><|endoftext|>x"]


def texts(spark, folder):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


def exact_ids(bodies):
    import public_tokenizers
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [x.ids for x in known.encode_batch([b or "" for b in bodies], add_special_tokens=False)]


def test_cached_pieces_give_the_tokenizers_ids(spark, folder):
    bodies = [*texts(spark, folder).values(), *ODD]
    own = encoder(*byte_bpe(), byte_bpe_special())
    assert [np.frombuffer(own.ids(b or ""), "<u4").tolist() for b in bodies] == exact_ids(bodies)


def test_best_fit_takes_the_tightest_window():
    rng = np.random.default_rng(0)
    for window in (1, 7, 64, 1000):
        lengths = rng.integers(1, window + 1, 300).tolist()
        left, want = [], 0
        for n in sorted(lengths, reverse=True):
            fits = [c for c in left if c >= n]
            if fits:
                left.remove(min(fits))
                left.append(min(fits) - n)
            else:
                left.append(window - n)
                want += 1
        places = best_fit_decreasing(lengths, window)
        assert len({n for n, _ in places}) == want
        for number in range(want):
            at = 0
            for offset, n in sorted((o, n) for (w, o), n in zip(places, lengths) if w == number):
                assert offset == at
                at += n
            assert at <= window


def check_pieces(rows, bodies):
    """Every id in one piece, sequences gapless and at most 1024 long."""
    ids = {k: [*x, 0] for k, x in zip(bodies, exact_ids(bodies.values()))}
    by_doc, by_sequence = {}, {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert by_doc.keys() == ids.keys()
    for spans, whole in [(by_doc[k], len(ids[k])) for k in ids] + [(s, None) for s in by_sequence.values()]:
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == whole if whole is not None else at <= 1024
    return by_sequence


def test_packing_is_whole_and_tight(spark, folder):
    sequences = check_pieces(op6_packing(spark, folder).collect(), texts(spark, folder))
    used = [sum(n for _, n in s) for s in sequences.values()]
    assert sum(1024 - u for u in used) < 0.02 * sum(used)


def test_packing_odd_texts(spark, docs_of):
    docs = docs_of(list(enumerate(ODD)))
    rows = pack_documents(docs, block_tokens=500).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_pieces(rows, dict(enumerate(ODD)))
    again = docs_of([(None, "a"), (1, "b"), (1, "b")]).withColumn("start", F.lit("x"))
    assert Counter(r["doc_id"] for r in pack_documents(again).collect()) == {None: 1, 1: 2}
    assert pack_documents(docs.limit(0)).count() == 0


def removed_plainly(rows, size):
    words = [(i, (t or "").split()) for i, t in rows]
    seen = Counter(tuple(w[k : k + size]) for _, w in words for k in range(len(w) - size + 1))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k : k + size])] > 1:
                gone |= set(range(k, k + size))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def test_substrings_over_blocks_and_buckets(spark, docs_of):
    rng = np.random.default_rng(2)
    shared = [" ".join(f"s{k}" for k in rng.integers(0, 9999, 12)) for _ in range(5)]
    rows = []
    for i in range(80):
        parts = [" ".join(f"w{k}" for k in rng.integers(0, 99999, rng.integers(0, 30)))]
        parts += [shared[k] for k in rng.integers(0, 5, rng.integers(0, 3))]
        rows.append((i, "\n".join(parts)))
    rows += [(80, None), (81, ""), (82, " \t"), (83, "x y z " * 40), (84, "one row"), (84, "one row"), (None, shared[0])]
    docs = docs_of(rows).withColumn("kept", F.lit("clash")).withColumn("bucket", F.lit(1))
    for block_bytes, bucket_bytes in ((1 << 20, 1 << 20), (500, 300)):
        found = remove_repeated(docs, window=8, block_bytes=block_bytes, bucket_bytes=bucket_bytes).collect()
        assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found), key=str) == removed_plainly(rows, 8)
        for r in found:
            assert sum(int(b) - int(a) for a, b in (x.split("-") for x in r["removed"].split(",") if x)) == r["n_removed"]
    assert remove_repeated(docs.limit(0)).count() == 0


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = [int(d) for d in m[0] if d in "0123456789"]
            doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
            if (
                kind == "email"
                or (kind == "ip" and all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")))
                or (kind == "card" and 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0)
                or (kind == "phone" and 8 <= len(digits) <= 15)
            ):
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_are_those_of_the_patterns(spark, folder):
    rng = np.random.default_rng(3)
    alphabet = list("a1.@+- (4)5\n0é")
    bodies = ["".join(rng.choice(alphabet, rng.integers(0, 50))) for _ in range(4000)]
    for body in [*texts(spark, folder).values(), *bodies, "1" * 5000 + ".1.1.1"]:
        assert base_spans(body or "") == plain_spans(body or "")


def test_loose_spans_are_added_where_labelers_agree(spark, docs_of):
    strict = "mail me.{0}@mail.example.com or call +1 (504) 555-37{1:02d} now, server 10.0.0.{0}"
    rows = [(i, "email me, " + strict.format(i, i)) for i in range(60)]
    rows += [(60, "email: jo (at) mail (dot) example (dot) com thanks"), (61, "version 5046-55-1234 of it"), (62, None), (63, "")]
    docs = docs_of(rows).withColumn("spans", F.lit("x")).withColumn("n_ip", F.lit(0))
    found = {r["doc_id"]: r for r in pii.find_personal_data(docs).collect()}
    assert found[60]["spans"] == "email:7:43" and found[60]["n_email"] == 0 and found[60]["base"] == ""
    assert found[60]["masked"] == "email: [EMAIL] thanks"
    assert found[61]["spans"] == found[62]["spans"] == found[63]["spans"] == found[62]["masked"] == ""
    assert (found[5]["n_email"], found[5]["n_ip"], found[5]["n_phone"]) == (1, 1, 1)
    assert pii.find_personal_data(docs.limit(0)).count() == 0


def test_query_of_personal_data_against_plain_patterns(spark, folder):
    bodies = texts(spark, folder)
    found = {r["doc_id"]: r for r in op7_pii(spark, folder).collect()}
    assert found.keys() == bodies.keys()
    for i, body in bodies.items():
        base = plain_spans(body or "")
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        r = found[i]
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in base) for k in ("email", "ip", "card", "phone")]
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert {s for s in text.split(",") if s} <= set(r["spans"].split(","))


def test_sample_holds_every_pattern_whatever_the_hot_vector(spark, docs_of):
    hot = [(i, "write to jo.doe@mail.example.com today") for i in range(3000)]
    rows = hot + [(9000 + i, f"call +1 (504) 555-37{i % 100:02d} or order {i} 5046-55-1234") for i in range(200)]
    rows += [(9999, "email jo (at) mail (dot) com"), (9999, "email jo (at) mail (dot) com"), (10000, "x" * 1_200_000 + " a@b.cd")]
    docs = docs_of(rows)
    for sample in (3, 50, 20_000):
        model = pii.fit_spans(docs, sample=sample)
        assert len(model.weights) > 30
        found = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(docs, model=model).collect()}
        assert found[0] == "email:9:32" and found[10000] == "email:1200001:1200007"


def test_reliabilities_are_found_from_votes():
    rng = np.random.default_rng(4)
    truth = rng.random(20_000) < 0.3
    good = [0.9, 0.8, 0.7]
    votes = [np.where(rng.random(len(truth)) < g, truth, ~truth) * 2 - 1 for g in good]
    post, shares = pii.estimate_reliability(Counter(zip(*(v.tolist() for v in votes))))
    for g, (yes, no) in zip(good, shares):
        assert abs(yes[2] - g) < 0.05 and abs(no[0] - g) < 0.05
    assert post[(1, 1, 1)] > 0.9 and post[(-1, -1, -1)] < 0.05
    assert pii.estimate_reliability({}) == ({}, [])


def test_masks_of_overlapping_spans():
    assert masked("abcdefgh", [("card", 1, 4), ("phone", 3, 6), ("ip", 1, 2)]) == "a[CARD]gh"


def test_quality_of_odd_texts(spark, docs_of):
    prose = " ".join(f"the word{k} of thing{k}" for k in range(40))
    rows = [(1, prose), (2, None), (3, ""), (4, "a b c d e " * 4), (5, prose.replace(" ", " ### ")), (5, prose)]
    docs = docs_of(rows).withColumn("kept", F.lit(7)).withColumn("words", F.lit("x"))
    found = sorted((r["doc_id"], r["n_words"], r["n_repeat_words"], r["base_failed"], r["kept"]) for r in quality.judge_quality(docs).collect())
    assert found == [
        (1, 160, 0, False, True), (2, 0, 0, True, False), (3, 0, 0, True, False), (4, 20, 20, True, False),
        (5, 160, 0, False, True), (5, 319, 0, False, False),
    ]
    assert quality.judge_quality(docs).where("kept").count() == 2
    assert quality.judge_quality(docs.limit(0)).count() == 0


def test_hash_of_kept_words(spark, folder):
    from tabprep.llm.substring_queries import op5_substring_dedup

    bodies = texts(spark, folder)
    for r in op5_substring_dedup(spark, folder).where("n_removed = 0").collect():
        assert r["kept_sha256"] == hashlib.sha256(" ".join(re.findall(r"[^\x20\x09-\x0D]+", bodies[r["doc_id"]] or "")).encode()).hexdigest()
