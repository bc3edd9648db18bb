"""Whitening against moments in Python numbers and a plain eigensystem."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tabprep.llm import whitening
from tabprep.llm.whitening import chunk_moments, whiten
from tabprep.llm.whitening_queries import op11_whitening


def plain_moments(x):
    rows = [list(map(int, r)) for r in x]
    dims = range(len(rows[0]))
    return (
        len(rows),
        [sum(r[i] for r in rows) for i in dims],
        [[sum(r[i] * r[j] for r in rows) for j in dims] for i in dims],
    )


@pytest.mark.parametrize("low, high", [(999_900, 1_000_100), (-5, 6), (7, 8), (-(1 << 62), 1 << 62)])
@pytest.mark.parametrize("rows", [1, 63, 64, 200])
def test_planes_give_exact_moments(low, high, rows):
    x = np.random.default_rng(rows).integers(low, high, (rows, 5))
    assert tuple(chunk_moments(x)) == plain_moments(x)


def test_query_equals_a_plain_version(spark, folder):
    table = pq.read_table(f"{folder}/embeddings.parquet").to_pylist()
    rows = {
        r["vec_id"]: [math.floor(64.0 * float(c)) + 1_000_000 for c in r["embedding"]]
        for r in table
        if r["embedding"] is not None and all(c is not None and math.isfinite(c) for c in r["embedding"])
    }
    fit = {tuple(x) for x in rows.values()}
    n, sums, products = plain_moments(sorted(fit))
    dims = len(sums)
    v = np.array([[(n * products[i][j] - sums[i] * sums[j]) / n**2 for j in range(dims)] for i in range(dims)])
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    found = {}
    for r in op11_whitening(spark, folder).collect():
        found[r["vec_id"], r["component"]] = r
    assert found.keys() == {(i, c) for i in rows for c in range(1, 17)}
    sign = {}
    for (i, c), r in found.items():
        centred = [n * a - s for a, s in zip(rows[i], sums)]
        assert (r["n"], r["deviation"]) == (n, sum(d * d for d in centred))
        want = np.array(centred) / n @ axes[:, c - 1] / math.sqrt(values[c - 1])
        sign.setdefault(c, 1 if want * r["whitened"] > 0 else -1)
        assert r["whitened"] == pytest.approx(sign[c] * want, abs=1e-8)
        assert r["explained"] == pytest.approx(values[c - 1] / np.trace(v), rel=1e-9)
        assert r["identity_error"] < 1e-9


def test_chunks_and_partitions_change_no_integer(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(k, rng.standard_normal(4).tolist()) for k in range(500)]
    df = spark.createDataFrame(rows + rows[:100], "vec_id long, embedding array<double>")
    whole = sorted((r["vec_id"], r["component"], r["n"], r["deviation"]) for r in whiten(df).collect())
    monkeypatch.setattr(whitening, "CHUNK_ROWS", 7)
    parts = sorted((r["vec_id"], r["component"], r["n"], r["deviation"]) for r in whiten(df.repartition(5)).collect())
    assert parts == whole and len(whole) == 600 * 4 and whole[0][2] == 500


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 0.0]), (2, [1.0, 3.0]), (2, [1.0, 3.0]), (None, [2.0, 6.1]), (4, [1.0, 1.0])]
    rows += [(5, None), (6, []), (7, [1.0]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"n": F.lit("x"), "x": F.lit(0)})
    got = whiten(df).collect()
    want = sorted((i, c) for i in (0, 1, 2, 2, 4) for c in (1, 2))
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == want
    assert {r["n"] for r in got} == {4}
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0])], "vec_id long, embedding array<double>")
    assert {(r["component"], r["deviation"]) for r in whiten(huge).collect()} == {(1, None)}
    assert whiten(df.where("vec_id = 2")).count() == 0 and whiten(df.limit(0)).count() == 0
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 1.0]) for k in range(9)], "vec_id long, embedding array<double>")
    assert {r["component"] for r in whiten(line).collect()} == {1}
