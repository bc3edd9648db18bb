import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabprep.functions.hashing import unit_interval
from tabprep.operators import split

NAMES, WEIGHTS = ("train", "validation", "test"), (0.6, 0.2, 0.2)


@pytest.fixture
def keyed(spark):
    return spark.range(20_000).select("id", (F.col("id") % 7).alias("k"))


def test_share_is_the_head_of_md5(spark):
    row = spark.range(5, 6).select(unit_interval([F.col("id")], 42).alias("u")).first()
    assert row["u"] == int(hashlib.md5(b"42|5").hexdigest()[:8], 16) / 2**32


def test_part_follows_the_share(keyed):
    marked = split.assign_parts(keyed, ["id", "k"], WEIGHTS, NAMES).withColumn(
        "u", unit_interval([F.col("id"), F.col("k")])
    )
    wrong = F.col("part") != F.when(F.col("u") < 0.6, "train").when(F.col("u") < 0.8, "validation").otherwise("test")
    assert marked.filter(wrong).count() == 0


def test_parts_are_disjoint_complete_and_near_their_weights(keyed):
    parts = split.split_parts(keyed, ["id"], WEIGHTS, NAMES)
    ids = Counter(r["id"] for p in parts for r in p.collect())
    assert len(ids) == 20_000 and set(ids.values()) == {1}
    for part, weight in zip(parts, WEIGHTS):
        assert part.count() / 20_000 == pytest.approx(weight, abs=0.02)


def test_layout_does_not_matter(keyed):
    one = split.assign_parts(keyed, ["id"]).orderBy("id").collect()
    assert one == split.assign_parts(keyed.repartition(13, "k"), ["id"]).orderBy("id").collect()
    assert one != split.assign_parts(keyed, ["id"], seed=7).orderBy("id").collect()


def test_equal_keys_stay_together(keyed):
    assert split.assign_parts(keyed, ["k"]).groupBy("k").agg(F.countDistinct("part").alias("n")).filter("n > 1").count() == 0


def test_folds_of_a_part_are_even(keyed):
    train = split.split_parts(keyed, ["id"])[0]
    sizes = [r["count"] for r in split.assign_folds(train, ["id"], 3).groupBy("fold").count().collect()]
    assert len(sizes) == 3 and max(sizes) - min(sizes) < 0.1 * sum(sizes) / 3


def test_splitting_needs_no_shuffle(keyed):
    plan = split.assign_folds(split.assign_parts(keyed, ["id"]), ["id"])
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_random_split_is_there_too(keyed):
    train, test = split.random_split(keyed)
    assert train.count() + test.count() == 20_000


def test_one_weight_per_name(keyed):
    with pytest.raises(ValueError):
        split.assign_parts(keyed, ["id"], (0.5, 0.5), ("a", "b", "c"))
