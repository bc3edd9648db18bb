import json
import random
from math import isqrt
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.columns import ColumnRoles
from tabprep.operators import features, models
from tabprep.plans import scan_queries
from tabprep.session import CHECKPOINT_KEY, shared_path, shared_root
from tabprep.sources import quoted_csv, tables, versions


def test_inferred_csv(spark, root):
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, None)], "id int, name string, amount double")
    out = tables.read_csv(spark, tables.write_csv(df, f"{root}/csv"))
    assert out.dtypes == df.dtypes
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", 1.5), (2, None, None)]


def test_multiline_csv_keeps_texts(spark, root):
    texts = ['two\nlines', 'a "quoted", word', "  blanks  ", 'ends with "', "crlf\r\nline", "comma, tab\t", "'"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    path = tables.write_csv(df, f"{root}/csv", rows_per_file=2)
    out = tables.read_multiline_csv(spark, path)
    assert {r["id"]: r["text"] for r in out.collect()} == dict(enumerate(texts))


@pytest.fixture
def small_splits(spark):
    """Splits of 64 bytes, so that fields, records and the header go on over many of them."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {k: spark.conf.get(k, None) for k in keys}
    for key, value in zip(keys, ("64b", "1b", "1")):
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def odd_texts(n):
    rng = random.Random(n)
    pieces = ["word", '"', '""', "\n", "\r\n", ",", " ", "\t", "ä", "", "x" * 70, "\n\n", '"\n"', '\n,"']
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))) for _ in range(n)]


@pytest.mark.parametrize("files", [1, 3])
def test_quoted_csv_in_splits_equals_the_reader_of_whole_files(spark, root, small_splits, files):
    texts = odd_texts(120)
    df = spark.createDataFrame([(k, t, None if k % 5 else t[::-1]) for k, t in enumerate(texts)], "id int, text string, `b c` string")
    path = tables.write_csv(df.repartition(files), f"{root}/csv")
    whole = tables.read_multiline_csv(spark, path, df.schema)
    split = quoted_csv.read_quoted_csv(spark, path, df.schema)
    assert split.schema == whole.schema
    rows = lambda d: sorted(map(repr, d.collect()))
    assert rows(split) == rows(whole) and split.count() == 120
    lines = quoted_csv._lines(spark, path)
    assert lines.select("_file", "_block").distinct().count() > 40
    states = quoted_csv.split_states(lines)
    assert states.where("_inside").count() > 5 and states.where("_open_block is not null").count() > 30


def test_quoted_csv_of_one_large_file_is_read_by_many_tasks(spark, root):
    text = 'a "quoted" text, with\ntwo lines '
    df = spark.range(0, 60_000, 1, 1).select("id", F.concat(F.lit(text * 10), F.col("id").cast("string")).alias("text"))
    path = tables.write_csv(df, f"{root}/csv")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2m")
    try:
        assert tables.read_multiline_csv(spark, path, df.schema).rdd.getNumPartitions() == 1
        assert quoted_csv._lines(spark, path).rdd.getNumPartitions() > 8
        found = quoted_csv.read_quoted_csv(spark, path, df.schema)
        assert found.join(df, ["id", "text"]).count() == 60_000 == found.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quoted_csv_of_odd_files(spark, root):
    for name, body in {"header": "id,text\n", "empty": "", "end": 'id,text\r\n1,"a\r\nb"\r\n\r\n2,c'}.items():
        Path(root, name).mkdir()
        Path(root, name, "x.csv").write_bytes(body.encode())
    read = lambda name: [tuple(r) for r in quoted_csv.read_quoted_csv(spark, f"{root}/{name}", "id int, text string").collect()]
    assert read("header") == read("empty") == []
    assert sorted(read("end")) == [(1, "a\r\nb"), (2, "c")]


def test_overwrite_replaces_rows_and_columns(spark, root):
    path = f"{root}/table"
    tables.overwrite_table(spark.range(10), path)
    tables.overwrite_table(spark.range(3).withColumn("x", F.lit("y")), path)
    assert tables.read_table(spark, path).columns == ["id", "x"] and tables.read_table(spark, path).count() == 3


def test_inline_rows_are_a_local_relation(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    df = tables.rows_frame(spark, [(1, "x"), (None, None)], schema)
    assert df.schema == schema and [tuple(r) for r in df.collect()] == [(1, "x"), (None, None)]
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()


def test_schema_listing(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, `b c` string")
    assert [tuple(r) for r in tables.describe_schema(df).collect()] == [(0, "a", "int", 2), (1, "b c", "string", 1)]


def test_layout_of_a_kept_frame_depends_on_its_rows_alone(spark):
    def layout(df, **options):
        parts = tables.spread(df, **options).select("id", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m"))
        return sorted(map(tuple, parts.collect()))

    one, many = spark.range(0, 1000, 1, 1), spark.range(0, 1000, 1, 23).orderBy(F.desc("id"))
    assert layout(one) == layout(many)
    assert {p for _, p, _ in layout(one)} == {0}
    assert layout(one, partitions=3) == layout(many, partitions=3)
    assert {p for _, p, _ in layout(many, partitions=3)} == {0, 1, 2}


def test_partitions_follow_rows_and_width_and_not_the_layout(spark, monkeypatch):
    df = spark.range(0, 10_000, 1, 3).select("id", F.lit("x" * 100).alias("t"))
    size = 10_000 * 116
    assert tables.kept_partitions(df) == tables.kept_partitions(df.repartition(11)) == isqrt(size // tables.KEPT_UNIT) == 2
    monkeypatch.setattr(tables, "KEPT_UNIT", 1000)
    assert tables.kept_partitions(df) == 34
    monkeypatch.setattr(tables, "KEPT_MOST_BYTES", 20_000)
    assert tables.kept_partitions(df) == 58
    assert tables.kept_partitions(df.limit(0)) == 1


def test_copies_of_one_row_use_all_partitions(spark, monkeypatch):
    monkeypatch.setattr(tables, "_COPIES", 100)
    same = spark.range(0, 5000, 1, 4).select(F.lit(7).alias("id"), F.lit("x").alias("t"))
    few = spark.range(50).select("id", F.lit("y").alias("t"))

    def layout(df):
        with tables.kept(df, 8) as held:
            rows = held.select("id", "t", F.spark_partition_id().alias("p")).collect()
        return [tuple(r) for r in rows]

    first, again = layout(same.union(few)), layout(few.union(same.repartition(3)))
    assert first == again and len(first) == 5050
    sizes = [sum(p == k and t == "x" for _, t, p in first) for k in range(8)]
    assert sizes == [625] * 8


def test_quoted_csv_is_written_by_all_tasks_of_the_scan(spark, root, monkeypatch):
    folder, target = f"{root}/tables", f"{root}/quoted"
    text = F.concat(F.lit('a "q",\nline '), F.col("id").cast("string"), F.lit("\n\nend "))
    names = ["lang", "source"]
    docs = spark.range(0, 300, 1, 3).select(F.col("id").alias("doc_id"), text.alias("text"), *[F.lit("x").alias(n) for n in names], F.lit(5).alias("n_chars"))
    docs.write.parquet(f"{folder}/documents.parquet")
    monkeypatch.setattr(scan_queries, "shared_path", lambda *_: target)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "256MB")  # a task per file
    try:
        found = scan_queries.csv_quoted_splits(spark, folder)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, docs.collect()))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert len(list(Path(target).glob("part-*.csv"))) == 3


def test_copies_are_told_before_rows_move(spark, monkeypatch):
    monkeypatch.setattr(tables, "KEPT_UNIT", 2_000)
    same = spark.range(0, 20_000, 1, 4).select((F.col("id") % 4 / 3).cast("int").alias("id"), F.lit("x").alias("t"))
    n = tables.kept_partitions(same)
    want = tables.spread_copies(same, n).select("id", F.spark_partition_id()).collect()
    with monkeypatch.context() as patch:
        patch.setattr(tables, "spread", lambda *_: pytest.fail("all copies of a row go to one task"))
        with tables.kept(same) as held:
            assert held.select("id", F.spark_partition_id()).collect() == want and n > 4
        with tables.kept(same, 8) as held:
            assert held.count() == 20_000
    monkeypatch.setattr(tables, "spread_copies", lambda *_: pytest.fail("no row has copies"))
    with tables.kept(spark.range(20_000)) as held:
        assert held.count() == 20_000
    with tables.kept(same.limit(0)) as held:
        assert held.count() == 0


def test_forest_is_the_same_on_two_layouts(spark, monkeypatch):
    monkeypatch.setattr(tables, "KEPT_UNIT", 2_000)
    i = F.col("id")
    df = spark.range(0, 3000, 1, 2).select(
        (i % 97).cast("double").alias("x"), F.concat(F.lit("k"), i % 13).alias("k"), ((i * 31) % 101 + i % 13).cast("double").alias("y")
    )
    forest = models.forest_regressor("y", numTrees=3, maxDepth=4)
    fits = [models.fit_trees(d, ColumnRoles(["k"], ["x"]), forest) for d in (df, df.repartition(7).orderBy(F.desc("x")))]
    assert fits[0].stages[-1].toDebugString.split("\n")[1:] == fits[1].stages[-1].toDebugString.split("\n")[1:]


def test_stored_frames_stay_where_they_are_read(spark):
    """Least squares and measures follow no layout, so no row of their frames is moved unless too few tasks hold them."""
    rows = spark.range(0, 80_000, 1, 8).select("id", F.when(F.col("id") % 9 > 0, F.col("id")).alias("k"))
    with tables.stored(rows) as held:
        assert held.storageLevel.useMemory and "Exchange" not in held._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, held.collect())) == sorted(map(tuple, rows.collect()))
    assert not held.storageLevel.useMemory
    # One partition of 16 MB, most of its rows equal: dealt over the cores in turn.
    lone = spark.range(0, 1_000_000, 1, 1).select((F.col("id") % 10 == 0).cast("long").alias("a"), F.lit(1).alias("b"))
    with tables.stored(lone) as held:
        sizes = [r["count"] for r in held.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 1_000_000 and len(sizes) > 1 and max(sizes) < 1.1 * min(sizes)
    with tables.stored(rows.limit(0)) as held:
        assert held.count() == 0


def test_formula_fits_move_no_rows(spark):
    """The same line as from a pipeline, over nulls and copies, and vectors are made once for all passes."""
    rows = [(None if i % 11 == 0 else "abc"[i % 3], float(i % 7), 2.0 * (i % 7) + i % 3) for i in range(500)] * 2
    df = spark.createDataFrame(rows, "c string, x double, y double").repartition(8)
    with_pipeline = models.fit_stages(df, features.formula_stage("y ~ .", label="y", handle_invalid="skip"), models.linear_regression("y"))
    model = models.fit_formula(df, "y ~ .", "y")
    assert [type(s) for s in model.stages] == [type(s) for s in with_pipeline.stages]
    a, b = (m.stages[-1] for m in (model, with_pipeline))
    assert max(abs(a.coefficients.toArray() - b.coefficients.toArray())) < 1e-9 and abs(a.intercept - b.intercept) < 1e-9
    assert a.summary.numInstances == b.summary.numInstances == len([r for r in rows if r[0]])


def test_kept_frames_are_released(spark):
    with tables.kept(spark.range(100)) as df:
        assert df.count() == 100 and df.storageLevel.useMemory
    assert not df.storageLevel.useMemory
    filled = spark.range(5)
    assert tables.materialize(filled) == 5
    filled.unpersist()


def test_shared_paths_follow_the_session(spark):
    root = shared_root(spark)
    assert root == spark.conf.get(CHECKPOINT_KEY, root).rstrip("/")
    first, second = shared_path(spark, "x"), shared_path(spark, "x")
    assert first.startswith(root) and first != second


class ClusterWithoutFolder:
    """Looks like a session on a cluster whose shared folder is not set."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "yarn"
        applicationId = "app"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(ClusterWithoutFolder)


def test_versions(spark, root):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0)], "id int, price double")
    assert versions.latest_version(spark, root) is None
    assert versions.overwrite_version(df, root) == 0
    assert versions.overwrite_version(df.filter("id = 1").withColumn("extra", F.lit("e")), root, merge_schema=True) == 1
    assert versions.read_version(spark, root, 0).schema == df.schema
    assert sorted(tuple(r) for r in versions.read_version(spark, root, 0).collect()) == [(1, 10.0), (2, 20.0)]
    assert [tuple(r) for r in versions.read_version(spark, root).collect()] == [(1, 10.0, "e")]
    every = versions.read_all_versions(spark, root).orderBy("_version", "id").collect()
    assert [(r["_version"], r["id"], r["extra"]) for r in every] == [(0, 1, None), (0, 2, None), (1, 1, "e")]
    assert [
        (r["version"], r["operation"], r["n_rows"], r["n_columns"])
        for r in versions.history(spark, root).orderBy("version").collect()
    ] == [(0, "CREATE", 2, 2), (1, "OVERWRITE", 1, 3)]


def test_schema_change_needs_consent(spark, root):
    versions.overwrite_version(spark.range(3), root)
    with pytest.raises(ValueError, match="merge_schema"):
        versions.overwrite_version(spark.range(3).withColumn("x", F.lit(1)), root)
    assert versions.latest_version(spark, root) == 0


def test_unfinished_version_is_invisible(spark, root):
    """A write that died before its commit row: readers skip it, the next write replaces it."""
    versions.overwrite_version(spark.range(3), root)
    spark.range(99).write.parquet(f"{root}/data/_version=1")
    assert versions.read_version(spark, root).count() == 3
    assert versions.read_all_versions(spark, root).count() == 3
    with pytest.raises(versions.VersionNotFound):
        versions.read_version(spark, root, 1)
    assert versions.overwrite_version(spark.range(5), root) == 1
    assert versions.read_version(spark, root, 1).count() == 5


def test_reading_one_version_prunes_the_others(spark, root):
    for n in (3, 4):
        versions.overwrite_version(spark.range(n), root)
    plan = versions.read_all_versions(spark, root).filter("_version = 1")
    assert "PartitionFilters: [isnotnull(_version" in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count() == 4
    assert json.loads(versions.commits(spark, root).first()["schema_json"])["fields"][0]["name"] == "id"
