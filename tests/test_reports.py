"""Event logs, request logs, job history and the model."""

from __future__ import annotations

import json
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import diagnostics as D, model, request_log
from millrace.session import scratch_path
from millrace.sources.eventlog import read_event_logs


def _task(stage, task, took, read=0, records=0, launch=1000):
    return {"Event": "SparkListenerTaskEnd", "Stage ID": stage,
            "Task Info": {"Task ID": task, "Launch Time": launch, "Finish Time": launch + took},
            "Task Metrics": {"Shuffle Read Metrics": {"Remote Bytes Read": read, "Local Bytes Read": 0,
                                                      "Total Records Read": records}}}


PLAN = ("== Physical Plan ==\nAdaptiveSparkPlan isFinalPlan=true\n+- == Final Plan ==\n   Scan a Batched: true, rest\n"
        "   Exchange x, [plan_id=12]\n+- == Initial Plan ==\n   Other\n\n(1) Scan")
EVENTS = [
    {"Event": "SparkListenerApplicationStart", "Timestamp": 1000},
    {"Event": "SparkListenerStageSubmitted", "Stage Info": {"Stage ID": 3, "Stage Name": "parquet at X.java:0"}},
    *[_task(3, i, 1000) for i in range(9)], _task(3, 9, 16900, 2_000_000, 18), _task(3, 10, 500, 2_000_000, 7, 900),
    _task(4, 11, 250), {"Event": "SparkListenerTaskEnd", "Stage ID": 5, "Task Info":
                        {"Task ID": 12, "Launch Time": 0, "Finish Time": 10}},
    {"Event": "org.x.SparkListenerSQLAdaptiveExecutionUpdate", "executionId": 2, "physicalPlanDescription": "isFinalPlan=false"},
    {"Event": "org.x.SparkListenerSQLAdaptiveExecutionUpdate", "executionId": 2, "physicalPlanDescription": PLAN},
    {"Event": "SparkListenerApplicationEnd", "Timestamp": 112900}]


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("logs")
    (folder / "app-1").write_text("\n".join(map(json.dumps, EVENTS)))
    return read_event_logs(spark, str(folder))


def test_summary(log):
    got = {r["stage"]: r for r in D.stage_summary(log).collect()}
    assert (got[3]["tasks"], got[3]["min"], got[3]["median"], got[3]["max"]) == (11, 0.5, 1.0, 16.9)
    assert got[3]["max_to_median"] == pytest.approx(16.9) and got[3]["shuffle_mb"] == 4.0
    assert (got[4]["p25"], got[4]["p75"], got[5]["tasks"]) == (0.25, 0.25, 1)
    assert [r["stage"] for r in D.skewed_stages(D.stage_summary(log)).collect()] == [3]


def test_largest_read_takes_the_earlier_of_equals(log):
    assert [tuple(r) for r in D.largest_reads(log).collect()] == [("app-1", 3, 2_000_000, 7, 0.5)]


def test_run_time_plan_and_names(log):
    assert [tuple(r) for r in D.run_times(log).collect()] == [("app-1", 111.9)]
    assert D.final_plans(log).first()["plan"] == ("AdaptiveSparkPlan isFinalPlan=true\n+- == Final Plan ==\n"
                                                  "   Scan a\n   Exchange x")
    assert [tuple(r) for r in D.stage_names(log).collect()] == [("app-1", 3, "parquet")]


JOB = """
import sys
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").appName("job").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", sys.argv[1]).config("spark.eventLog.compress", "false")
         .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.range(100000).groupBy(F.col("id") % 10).count().write.parquet(sys.argv[2])
spark.stop()
"""


def test_log_of_a_real_run(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    subprocess.run([sys.executable, "-c", JOB, str(logs), str(tmp_path / "out")], check=True, timeout=180,
                   capture_output=True)
    log = read_event_logs(spark, str(logs))
    assert D.stage_summary(log).agg(F.sum("tasks")).first()[0] >= 3
    assert D.run_times(log).first()["seconds"] > 0
    plan = D.final_plans(log).first()["plan"]
    assert "== Final Plan ==" in plan and "== Initial Plan ==" not in plan and "HashAggregate" in plan


def test_request_log(spark):
    lines = spark.createDataFrame([("10:00:00  200  v1 pod-a 150ms",), ("10:00:01  200  v1 pod-a 50ms",),
                                   ("10:00:02  ERR  timeout",), ("summary: 2 answered, 1 failed",)], "value string")
    requests = request_log.parse_requests(lines)
    assert tuple(request_log.totals(requests).first()) == (4, 2, 1, 1)
    got = {r["pod"]: (r["answered"], r["failed"], r["rejected"], r["mean_ms"], r["max_ms"]) for r in request_log.by_pod(requests).collect()}
    assert got == {"pod-a": (2, 0, 0, 100.0, 150), None: (0, 1, 1, None, None)}
    assert [tuple(r) for r in request_log.dead_letters(requests).collect()] == [("summary: 2 answered, 1 failed", 1)]


# ---------------------------------------------------------------- model
def _frame(spark):
    chance = np.random.default_rng(3)
    x, z = chance.normal(size=120), chance.normal(size=120) * 3 + 5
    group = chance.integers(0, 3, size=120)
    y = 2 * x - z + np.array([0.0, 4.0, -2.0])[group] + chance.normal(size=120) * 0.1
    rows = [(float(a), float(b), "abc"[g], float(t)) for a, b, g, t in zip(x, z, group, y)]
    return spark.createDataFrame(rows, "x double, z double, g string, y double"), x, z, group, y


def test_ridge_equals_the_closed_form(spark):
    frame, x, z, group, y = _frame(spark)
    fitted = model.fit_ridge(frame, ["x", "z"], "g", "y", alpha=1.0)
    design = np.column_stack([(x - x.mean()) / x.std(), (z - z.mean()) / z.std(), *[group == i for i in range(3)]])
    centred = design - design.mean(axis=0)
    weights = np.linalg.solve(centred.T @ centred + np.eye(5), centred.T @ (y - y.mean()))
    want = centred @ weights + y.mean()
    scored = fitted.transform(frame).select("x", "prediction").collect()
    got = {r["x"]: r["prediction"] for r in scored}
    assert [got[float(a)] for a in x] == pytest.approx(list(want), abs=1e-8)


def test_saved_model_ignores_an_unknown_category(spark):
    frame = _frame(spark)[0]
    path = scratch_path(spark, "model")
    model.save(model.fit_ridge(frame, ["x", "z"], "g", "y"), path)
    scored = model.load(path).transform(frame.limit(5).withColumn("g", F.lit("never seen")))
    assert scored.count() == 5 and scored.where("prediction IS NULL").count() == 0


def test_constant_number_is_harmless(spark):
    frame = _frame(spark)[0].withColumn("c", F.lit(4.0))
    with_it = model.fit_ridge(frame, ["x", "c"], None, "y").transform(frame).select("x", "prediction")
    without = model.fit_ridge(frame, ["x"], None, "y").transform(frame).select("x", "prediction")
    pairs = with_it.join(without.withColumnRenamed("prediction", "p"), "x")
    assert pairs.where(F.abs(F.col("prediction") - F.col("p")) > 1e-8).count() == 0


def test_boosted_trees_beat_the_mean(spark):
    frame = _frame(spark)[0]
    train, test = model.hash_split(frame, ["x", "z"])
    assert train.count() + test.count() == 120
    error = model.mean_absolute_error(model.fit_boosted(train, ["x", "z"], "g", "y", rounds=10).transform(test), "y").first()
    flat = test.agg(F.avg(F.abs(F.col("y") - train.agg(F.avg("y")).scalar()))).first()[0]
    assert error["mae"] < flat


def test_more_trees_fit_the_train_rows_better(spark):
    frame = _frame(spark)[0]

    def left(rounds):
        fitted = model.fit_boosted(frame, ["x", "z"], "g", "y", rounds=rounds)
        return fitted.transform(frame).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0]

    spread = frame.agg(F.var_pop("y")).first()[0]
    errors = [left(n) for n in (1, 5, 20)]
    assert spread > errors[0] > errors[1] > errors[2]


def test_boosting_on_the_given_table_fits_better_than_the_mean(spark):
    from millrace.plans.reports import o4_boosted_trees
    row = o4_boosted_trees(spark, "/root/testdata/sf0.001").first()
    assert row["left_of_train"] < row["spread_of_train"] and row["n"] > 0


def _by_rows(frame, numeric, category, label, rounds, bins):
    """The same trees, grown by Spark on every row; up to 10,000 rows it looks at all of them for cuts."""
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import GBTRegressor
    stages = model.feature_stages(model.training_facts(frame, numeric, category, label), category)
    trees = GBTRegressor(featuresCol="features", labelCol=label, maxIter=rounds, stepSize=0.1, maxDepth=3, maxBins=bins, seed=7)
    return Pipeline(stages=[*stages, trees]).fit(frame)


def test_trees_of_cells_are_those_of_the_rows(spark):
    chance = np.random.default_rng(11)
    n = 3000
    x = np.where(chance.random(n) < 0.3, 2.0, chance.normal(size=n))  # one value spans several shares, the others are single
    z = chance.integers(0, 50, size=n)  # more values than bins, each many times
    y = 3 * np.sin(2 * x) + 0.1 * z + chance.normal(size=n)
    group = chance.integers(0, 3, size=n)
    frame = spark.createDataFrame([(float(a), float(b), "abc"[g], float(t + g)) for a, b, g, t in zip(x, z, group, y)], "x double, z double, g string, y double")
    for bins in (5, 32):
        rows = _by_rows(frame, ["x", "z"], "g", "y", 8, bins).transform(frame).select("x", "z", "g", F.col("prediction").alias("by_rows"))
        scored = model.fit_boosted(frame, ["x", "z"], "g", "y", rounds=8, bins=bins).transform(rows)
        assert scored.where(F.abs(F.col("prediction") - F.col("by_rows")) > 1e-9).count() == 0


def test_rounds_read_cells_however_often_rows_repeat(spark, monkeypatch):
    seen = []

    class Watched(model.GBTRegressor):
        def _fit(self, dataset):
            seen.append(dataset.count())
            return super()._fit(dataset)

    monkeypatch.setattr(model, "GBTRegressor", Watched)
    frame = _frame(spark)[0]
    few = model.fit_boosted(frame, ["x", "z"], "g", "y", rounds=3).transform(frame).select("x", "prediction")
    often = frame.crossJoin(spark.range(20).select())
    many = model.fit_boosted(often, ["x", "z"], "g", "y", rounds=3).transform(frame).select("x", F.col("prediction").alias("p"))
    assert seen[0] == seen[1] <= 120
    assert few.join(many, "x").where(F.abs(F.col("prediction") - F.col("p")) > 1e-9).count() == 0


def test_a_value_of_one_row_in_many_is_cut_off(spark):
    rows = spark.range(40_000).select(F.when(F.col("id") == 77, 1.0).otherwise(0.0).alias("x"), F.when(F.col("id") == 77, 500.0).otherwise(1.0).alias("y"))
    scored = model.fit_boosted(rows, ["x"], None, "y", rounds=1, depth=1).transform(rows)
    got = {r["x"]: r["prediction"] for r in scored.groupBy("x").agg(F.first("prediction").alias("prediction")).collect()}
    assert got == pytest.approx({0.0: 1.0, 1.0: 500.0})


def test_rows_that_are_all_alike_are_predicted_by_their_mean(spark):
    frame = spark.createDataFrame([(2.0, "a", float(i)) for i in range(5)], "x double, g string, y double")
    scored = model.fit_boosted(frame, ["x"], "g", "y", rounds=2).transform(frame)
    assert [r["prediction"] for r in scored.collect()] == pytest.approx([2.0] * 5)


def test_a_missing_number_is_refused_by_the_trees(spark):
    frame = _frame(spark)[0]
    fitted = model.fit_boosted(frame, ["x", "z"], "g", "y", rounds=1)
    for missing in (None, float("nan")):
        with pytest.raises(Exception, match="(?i)null|nan"):
            fitted.transform(frame.withColumn("z", F.lit(missing).cast("double"))).select("prediction").collect()


def test_boosted_error_is_that_of_a_hundred_trees_on_all_columns(spark, tmp_path):
    import duckdb
    from millrace.plans.registry import ORACLES
    from millrace.plans.reports import o4_o5_boosted_error
    chance = np.random.default_rng(5)
    rows = []
    for i in range(2000):
        quantity, discount, tax, flag = float(chance.integers(1, 51)), float(chance.random()), int(chance.integers(0, 9)) / 100, "ANR"[chance.integers(0, 3)]
        price = 900 * tax * (flag == "R") + 40 * (discount > 0.6) * (flag != "A") + 0.05 * quantity + float(chance.normal())
        rows.append((i, i % 7, i % 97, quantity, discount, tax, flag, price))
    lines = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_discount double, l_tax double, "
                                        "l_returnflag string, l_extendedprice double")
    lines.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    row = o4_o5_boosted_error(spark, str(tmp_path)).first()
    assert row["mae_of_trees"] < row["mae"] / 5 and row["left_by_trees"] < row["left_by_mean"] / 5  # one cut on one number sees none of it
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
        answer = con.execute(ORACLES["o4_o5_boosted_error"])
        want = dict(zip([d[0] for d in answer.description], answer.fetchone()))
    assert row.asDict() == pytest.approx(want, abs=0.002)


def test_quartiles_leave_nothing_in_the_shared_folder(spark):
    import os
    from millrace.operators.aggregates import exclusive_quartiles
    from millrace.session import shared_root

    def files():
        root = shared_root(spark).removeprefix("file:")
        return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names}

    before = files()
    rows = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.col("id") * 37 % 1009).cast("double").alias("v"))
    found = exclusive_quartiles(rows, ["g"], "v").collect()
    assert len(found) == 3 and files() == before


def test_too_many_categories_are_refused(spark, monkeypatch):
    monkeypatch.setattr(model, "MAX_CATEGORIES", 2)
    frame = spark.createDataFrame([(1.0, c, 2.0) for c in "abc"], "x double, g string, y double")
    with pytest.raises(ValueError, match="more than 2 values"):
        model.training_facts(frame, ["x"], "g", "y")


def test_split_is_repeatable(spark):
    frame = _frame(spark)[0]
    first = sorted(r["x"] for r in model.hash_split(frame, ["x"])[0].collect())
    again = sorted(r["x"] for r in model.hash_split(frame.repartition(7), ["x"])[0].collect())
    assert first == again
