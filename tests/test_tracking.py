import random

import pytest
from pyspark.sql import functions as F

from tabprep.operators import features, models, registry, tracking
from tabprep.sources.tables import rows_frame


@pytest.fixture
def log(spark, root):
    log = tracking.RunLog(spark, root)
    log.record("rent", "one", {"data_version": 0, "data_path": "p"}, {"rmse": 3.0, "r2": 0.1})
    log.record("rent", "two", {"data_version": 1, "data_path": "p"}, {"rmse": 2.0})
    log.flush()
    log.record("sale", "three", {"data_version": 1, "data_path": "q"}, {"rmse": 1.0})
    log.flush()
    return log


def test_runs_are_appended_and_pivoted(log):
    wide = tracking.search_runs(log.runs(), log.params(), log.metrics(), ["data_version", "data_path"], ["rmse", "r2"])
    rows = {r["run_name"]: r for r in wide.collect()}
    assert set(rows) == {"one", "two", "three"}
    assert (rows["one"]["param_data_version"], rows["one"]["metric_r2"]) == ("0", 0.1)
    assert rows["two"]["metric_r2"] is None
    found = tracking.with_params(wide, data_version="1", data_path="p")
    assert [r["run_name"] for r in found.collect()] == ["two"]
    best = tracking.best_runs(wide, "param_data_version", "metric_rmse").collect()
    assert {r["param_data_version"]: r["metric_rmse"] for r in best} == {"0": 3.0, "1": 1.0}


def test_experiments_and_latest(log):
    assert {tuple(r) for r in tracking.experiments(log.runs()).collect()} == {("rent", 2), ("sale", 1)}
    assert tracking.latest_run(log.runs()).first()["run_name"] == "three"


def test_nothing_is_written_twice(log):
    log.flush()
    assert log.runs().count() == 3 and log.metrics().count() == 4


def test_logged_model_comes_back_with_its_example(spark, root):
    df = spark.range(50).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 + 1).alias("y"))
    model = models.fit_stages(df, features.assembler_stage(["x"]), models.linear_regression("y"))
    log = tracking.RunLog(spark, root)
    run = log.record("e", "line", models.estimator_params(model), {}, model, (df, ["x"]))
    log.flush()
    scored = models.score(log.load_model(run), df)
    assert scored.filter(F.abs(F.col("prediction") - F.col("y")) > 1e-6).count() == 0
    assert sorted(r["x"] for r in spark.read.parquet(f"{root}/examples/{run}").collect()) == [0, 1, 2, 3, 4]
    with pytest.raises(LookupError):
        log.load_model("nothing")


def test_registry_life_cycle(spark, root):
    reg = registry.ModelRegistry(spark, root)
    assert reg.register("lr", "run-a") == 1
    reg.transition("lr", {1: "Staging"})
    reg.describe("lr", "forecasts prices")
    assert reg.get("lr", 1)["stage"] == "Staging"
    assert reg.register("lr", "run-b", "Staging", "first words") == 2
    reg.describe("lr", "log price", version=2)
    reg.transition("lr", {2: "Production", 1: "Archived"})
    rows = {r["version"]: r for r in reg.search("lr").collect()}
    assert {v: r["stage"] for v, r in rows.items()} == {1: "Archived", 2: "Production"}
    assert rows[2]["description"] == "log price" and rows[1]["description"] is None
    assert {r["model_description"] for r in rows.values()} == {"forecasts prices"}
    assert registry.latest_versions(reg.events()).first()["latest_version"] == 2
    assert [r["version"] for r in registry.in_stage(reg.events(), "Production").collect()] == [2]
    with pytest.raises(ValueError):
        reg.transition("lr", {1: "Live"})
    with pytest.raises(LookupError):
        reg.transition("lr", {1: "None", 3: "Staging"})
    with pytest.raises(LookupError):
        reg.get("lr", 3)

    reg.register("other", "run-c")
    reg.delete("lr")
    assert reg.search("lr").count() == 0 and reg.search("other").count() == 1
    assert reg.register("lr", "run-d") == 1
    row = reg.get("lr", 1)
    assert (row["stage"], row["source"], row["model_description"]) == ("None", "run-d", None)


def test_versions_compare_as_numbers(spark):
    events = spark.range(1, 12).select(
        F.col("id").alias("seq"), F.lit("m").alias("name"), F.col("id").alias("version"),
        F.lit("register").alias("kind"), F.lit("r").alias("value"),
    )
    assert registry.latest_versions(events).first()["latest_version"] == 11


def random_events(spark, n, names=4):
    rng = random.Random(n)
    rows = []
    for seq in range(1, n + 1):
        kind = rng.choice(["register"] * 4 + ["stage"] * 4 + ["describe"] * 3 + ["delete"])
        version = None if kind == "delete" or (kind == "describe" and rng.random() < 0.4) else rng.randint(1, 3)
        value = None if rng.random() < 0.1 else rng.choice(registry.STAGES) if kind == "stage" else f"{kind} {seq}"
        rows.append((seq, f"m{rng.randrange(names)}", version, kind, value))
    return rows


def replayed(rows):
    """The state by going through the events one by one."""
    live, notes = {}, {}
    for _, name, version, kind, value in rows:
        if kind == "delete":
            live = {k: v for k, v in live.items() if k[0] != name}
            notes.pop(name, None)
        elif kind == "register":
            live[name, version] = [value, "None", None]
        elif version is None:
            notes[name] = value if value is not None else notes.get(name)
        elif (name, version) in live and value is not None:
            live[name, version][1 if kind == "stage" else 2] = value
    return sorted((n, v, *map(str, s), str(notes.get(n))) for (n, v), s in live.items())


def state(events):
    return sorted((r["name"], r["version"], *(str(r[c]) for c in ("source", "stage", "description", "model_description"))) for r in registry.versions(events).collect())


def test_states_equal_a_replay_and_survive_compaction(spark):
    for n in (40, 150):
        rows = random_events(spark, n)
        for cut in (0, n // 3, n):
            old, new = (rows_frame(spark, part, registry.EVENTS) for part in (rows[:cut], rows[cut:]))
            kept = registry.compacted(old)
            assert state(kept.unionByName(new)) == replayed(rows) == state(old.unionByName(new))
            assert kept.count() <= 3 * 4 * 3 + 4


def test_versions_are_hashed_and_not_sorted(spark, root):
    rows_frame(spark, random_events(spark, 100), registry.EVENTS).write.parquet(f"{root}/log")
    events = spark.read.parquet(f"{root}/log")
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (registry._marks(events), registry.versions(events))]
    assert all("SortAggregate" not in p and "HashAggregate" in p for p in plans)


def test_snapshot_and_tail(spark, root):
    reg = registry.ModelRegistry(spark, root)
    reg.register("a", "run-1", "Staging", "first")
    reg.register("b", "run-2")
    reg.transition("a", {1: "Production"})
    reg.delete("b")
    before = state(reg.events())
    assert reg.compact() == reg._last_seq() == 6
    assert state(reg.events()) == before and reg.events().count() == 3
    assert reg.register("b", "run-3") == 1 and reg._last_seq() == 7
    reg.transition("a", {1: "Archived"})
    assert reg.get("a", 1)["stage"] == "Archived" and reg.get("b", 1)["source"] == "run-3"
    # A snapshot that is not in the table yet does not count.
    rows_frame(spark, [], registry.EVENTS).write.parquet(f"{root}/model_states/half")
    assert reg.get("a", 1)["description"] == "first"
    reg.delete("a")
    reg.delete("b")
    assert reg.compact() == 10 and reg.events().count() == 0 and reg.register("a", "run-9") == 1 and reg._last_seq() == 11


def test_pivot_finds_keys_itself(spark):
    runs = spark.createDataFrame([(r, "e", r, "t", None) for r in ("r1", "r2", "r3")], tracking.RUNS)
    params = spark.createDataFrame([("r1", "a", "1"), ("r1", "a", "2"), ("r2", "b", "x"), ("r2", "n", None)], tracking.PARAMS)
    metrics = spark.createDataFrame([("r1", "a", 0.5), ("r2", "z", float("nan"))], tracking.METRICS)
    wide = tracking.search_runs(runs, params, metrics)
    assert wide.columns == [*runs.columns, "param_a", "param_b", "metric_a", "metric_z"]
    rows = {r["run_id"]: r for r in wide.collect()}
    assert (rows["r1"]["param_a"], rows["r1"]["param_b"], rows["r1"]["metric_a"]) == ("2", None, 0.5)
    assert rows["r2"]["param_b"] == "x" and rows["r2"]["metric_z"] != rows["r2"]["metric_z"] and rows["r3"]["metric_a"] is None
    one = tracking.with_values(runs.where("run_id = 'r2'"), params, metrics, ["b"], ["a"])
    assert [(r["param_b"], r["metric_a"]) for r in one.collect()] == [("x", None)]
    nothing = tracking.search_runs(runs, params.limit(0), metrics.limit(0))
    assert nothing.columns == runs.columns and nothing.count() == 3
