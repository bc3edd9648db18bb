"""Periodic runs against a search of every period at every place."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tabprep.llm import runs
from tabprep.llm.run_queries import op13_runs
from tabprep.llm.runs import find_runs


def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            stop = end + q
            if end > at and stop - at >= max(6, 4 * q):
                if not any(all(words[k] == words[k + p] for k in range(at, stop - p)) for p in range(1, q)):
                    out.append((at, q, stop - at))
            at = end + 1
    return sorted(out)


def plain_collapse(words, found):
    gone = {k for s, q, n in found for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def made_periodic(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_query_equals_a_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    small = [(r["doc_id"], r["text"]) for r in docs if len(words_of(r["text"])) <= 1500]
    assert len(small) > 150
    got = {r["doc_id"]: r for r in op13_runs(spark, folder).collect()}
    assert len(got) == len(docs)
    some = 0
    for i, text in small:
        words = made_periodic(i, words_of(text))
        found = plain_runs(words)
        some += bool(found)
        best = max(found, key=lambda r: (r[2] / r[1], -r[0], -r[1]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, q, n in found)
        want = (len(found), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4))
        r = got[i]
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == want
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(plain_collapse(words, found).encode()).hexdigest()
    assert some > 10


def random_texts(seed, n=120):
    rng = random.Random(seed)
    for _ in range(n):
        size, kinds = rng.choice([0, 1, 5, 6, 7, 20, 60, 200]), rng.choice([1, 2, 3, 50])
        words = [str(rng.randrange(kinds)) for _ in range(size)]
        for _ in range(2 if size > 10 else 0):
            a = rng.randrange(size)
            p, end = rng.randint(1, max(1, (size - a) // 3)), rng.randint(a, size)
            for k in range(a, end):
                words[k] = words[a + (k - a) % p]
        yield words


@pytest.mark.parametrize("tile", [1, 2, 16])
def test_random_texts_with_small_tiles(spark, monkeypatch, tile):
    monkeypatch.setattr(runs, "TILE", tile)
    texts = [" ".join(w) for w in random_texts(tile)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for r in find_runs(df).collect():
        words = texts[r["id"]].split()
        found = plain_runs(words)
        assert [(x["start"], x["period"], x["length"]) for x in r["runs"]] == found
        assert r["collapsed"] == plain_collapse(words, found)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "ab " * 9), (4, "ab " * 9), (4, "ab " * 9), (5, "ö\x0bö\tö ö ö  ö")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"runs": F.lit("r"), "text_key": F.lit("k")})
    got = find_runs(df)
    assert got.columns == ["doc_id", "text", "runs_", "text_key", "runs", "collapsed"]
    found = sorted((r["doc_id"] or 0, r["collapsed"], len(r["runs"])) for r in got.collect())
    assert found == [(0, "ab", 1), (1, "", 0), (2, "", 0), (3, "", 0), (4, "ab", 1), (4, "ab", 1), (5, "ö", 1)]
    assert find_runs(df.limit(0)).count() == 0


def test_very_long_texts_are_whole(spark):
    """A megabyte of one word, and a period that only a whole text shows."""
    rng = random.Random(5)
    unit = [str(rng.randrange(1000)) for _ in range(30_000)]
    df = spark.createDataFrame([(1, "ha " * 400_000), (2, "x " + " ".join(unit * 4) + " y")], "id long, text string")
    got = {r["id"]: r for r in find_runs(df).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 1, 400_000)] and got[1]["collapsed"] == "ha"
    assert [tuple(r) for r in got[2]["runs"]] == [(1, 30_000, 120_000)]
    assert got[2]["collapsed"] == " ".join(["x", *unit, "y"])
