import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tabprep.llm.neighbours import nearest_neighbours
from tabprep.llm.neighbour_queries import op2_neighbours


def brute(ids, vectors, queries, k):
    out = {}
    for q in queries:
        order = sorted((j for j in range(len(ids)) if j != q), key=lambda j: (-float(vectors[j] @ vectors[q]), ids[j]))
        out[ids[q]] = [ids[j] for j in order[:k]]
    return out


def test_recall_on_the_table(spark, folder):
    table = pq.read_table(f"{folder}/embeddings.parquet").to_pandas()
    x = np.stack(table["embedding"]).astype(float)
    ids = table["vec_id"].tolist()
    truth = brute(ids, x, [k for k, i in enumerate(ids) if i % 20 == 0], 20)
    found = {}
    for r in op2_neighbours(spark, folder).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert found.keys() == truth.keys() and all(sorted(f) == list(range(1, 21)) for f in found.values())
    hits = sum(v in truth[q] for q, f in found.items() for v, _ in f.values())
    assert hits >= 0.9 * 20 * len(truth)
    place = {i: k for k, i in enumerate(ids)}
    assert all(s == pytest.approx(x[place[q]] @ x[place[v]], abs=1e-12) for q, f in found.items() for v, s in f.values())


def test_odd_vectors_ties_and_unequal_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (3, [2.0, 0.0]), (2, [2.0, 0.0]), (5, [0.0, 9.0]), (None, [0.5, 0.0]), (0, [1.0, 0.0])]
    rows += [(20, None), (40, [0.0, 0.0]), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [1.0]), (120, [None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest_neighbours(df.withColumn("score", F.lit("x")), F.col("vec_id") % 20 == 0, k=20)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect() if r["rank"] < 4)
    assert got == sorted([(0, 1, 2, 2.0), (0, 2, 3, 2.0), (0, 3, 0, 1.0)] * 2)
    assert found.count() == 10
    assert nearest_neighbours(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_shards_change_nothing_that_is_verified(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.standard_normal(8).tolist()) for k in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = np.array([v for _, v in rows])
    truth = brute(list(range(300)), x, range(0, 300, 20), 5)
    for shard_rows in (40, 1000):
        found = nearest_neighbours(df, F.col("vec_id") % 20 == 0, k=5, shard_rows=shard_rows, share=0.0001).collect()
        assert sum(r["vec_id"] in truth[r["query_id"]] for r in found) >= 0.95 * 75
