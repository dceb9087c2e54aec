from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.operators import gate, profiling, runlog, scoring


@pytest.fixture
def slices(spark):
    rows = [("a", 1, 1), ("a", 1, 0), ("b", 0, 0), ("b", 1, 1)]
    df = spark.createDataFrame(rows, "s string, label int, prediction int")
    return profiling.sliced_accuracy(df, "s", "label", "prediction")


def test_slice_gate(spark, slices):
    assert gate.slice_gate(slices).first()["result"] == "fail"
    assert gate.slice_gate(slices, threshold=0.5).first()["result"] == "pass"
    assert gate.slice_gate(slices, mode="compat").first()["result"] == "pass"
    assert gate.slice_gate(None, spark=spark).first()["result"] == "none"
    assert gate.slice_gate(slices.where("false")).first()["result"] == "none"
    with pytest.raises(ValueError):
        gate.slice_gate(slices, mode="loose")


@pytest.mark.parametrize(
    ("values", "decision"),
    [(["1", "1", "none"], "accept"), (["1", "0"], "reject"), (["1", "fail"], "reject"), (["1", None], "reject")],
)
def test_decision(spark, values, decision):
    rows = [("v", f"c{i}", v, None) for i, v in enumerate(values)]
    assert gate.decide(spark.createDataFrame(rows, gate.CHECK_SCHEMA)).first()["decision"] == decision


def test_description_length(spark):
    texts = {"none": None, "twenty": "x" * 20, "enough": "x" * 21}
    got = {v: gate.description_check(spark, v, t).first()["value"] for v, t in texts.items()}
    assert got == {"none": "0", "twenty": "0", "enough": "1"}


def test_signature(spark):
    df = spark.createDataFrame([("1", "x", None), ("2", "3", 1)], "k string, x string, n int")
    schema = T.StructType(
        [T.StructField("k", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("n", T.IntegerType()), T.StructField("z", T.StringType())]
    )
    rows = {r["column"]: (r["n_null"], r["n_bad"], r["ok"]) for r in scoring.check_signature(df, schema).collect()}
    assert rows == {"k": (0, 0, True), "x": (0, 1, False), "n": (1, 0, True), "z": (None, None, False)}
    assert gate.signature_check("v", df, schema).first()["value"] == "0"
    assert gate.signature_check("v", df, None).first()["value"] == "0"


def test_quality_gate_counts_unknown_as_broken(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    row = gate.quality_gate(df, {"positive": "x > 0", "always": F.lit(True)}).collect()
    assert [(r["rule"], r["n_failed"], r["ok"]) for r in row] == [("positive", 2, False), ("always", 0, True)]


def test_latest_and_best(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    rows = [
        ("r1", "m", day(1), "FINISHED", 0.5),
        ("r2", "m", day(3), "FINISHED", None),
        ("r3", "m", day(2), "FINISHED", 0.7),
        ("r4", "m", day(1), "FAILED", 0.9),
        ("r5", "k", None, "FINISHED", float("nan")),
        ("r0", "m", day(1), "FINISHED", 0.7),
    ]
    log = spark.createDataFrame(rows, "run_id string, name string, date timestamp, status string, f1 double")
    assert runlog.latest_run(log, "m").first()["run_id"] == "r2"
    assert runlog.latest_run(log, "other").isEmpty()
    assert runlog.best_run(log, "f1").first()["run_id"] == "r0"
    assert runlog.best_run(log, "f1", status=None).first()["run_id"] == "r4"
    assert [r["run_id"] for r in runlog.latest_per_key(log, ["name"], ["date", "run_id"]).collect()] == ["r2"]
    assert runlog.latest_per_key(log, ["name"], ["date"]).columns == log.columns


def test_log_grows_columns_and_forgets_names(spark, tmp_path):
    path = str(tmp_path / "log")
    assert runlog.read_log(spark, path).isEmpty()
    runlog.log_run(spark, path, "a", {})
    runlog.log_run(spark, path, "a", {"val_f1": 0.5, "trials": 3, "kept": True, "note": "x", "gone": None})
    runlog.log_run(spark, path, "b", {"val_f1": 0.25})
    log = runlog.read_log(spark, path)
    assert set(log.columns) == {"name", "date", "val_f1", "trials", "kept", "note"}
    assert log.where("val_f1 is null").count() == 1
    runlog.reset_runs(spark, path, "a")
    assert [r["name"] for r in runlog.read_log(spark, path).collect()] == ["b"]


def test_get_or_train_trains_once(spark, tmp_path):
    calls = []

    def train():
        calls.append(1)
        return {"val_f1": float("nan"), "run_id": f"r{len(calls)}"}

    path = str(tmp_path / "log")
    assert runlog.get_or_train(spark, path, "m", train).first()["run_id"] == "r1"
    assert runlog.get_or_train(spark, path, "m", train).first()["run_id"] == "r1"
    assert runlog.get_or_train(spark, path, "m", train, force=True).first()["run_id"] == "r2"
    assert len(calls) == 2


def test_tags_keep_the_newest_value(spark, tmp_path):
    from datetime import datetime, timezone

    from riskflow.operators import tags

    path = str(tmp_path / "tags")
    assert tags.tags_wide(tags.read_tags(spark, path), ["a"]).count() == 0
    at = [datetime(2024, 1, d, tzinfo=timezone.utc) for d in (1, 2, 3)]
    tags.set_tags(spark, path, "v1", {"a": True, "b": 0.5, "c": None}, at[1])
    tags.set_tags(spark, path, "v1", {"a": "old", "b": "older"}, at[0])
    tags.set_tags(spark, path, "v2", {"a": "x"}, at[0])
    tags.set_tags(spark, path, "v2", {"a": None, "b": "y"}, at[2])
    wide = {r["version"]: (r["a"], r["b"], r["c"]) for r in tags.tags_wide(tags.read_tags(spark, path), ["a", "b", "c"]).collect()}
    assert wide == {"v1": ("1", "0.5", None), "v2": (None, "y", None)}
    assert tags.tag_values(spark, path, "v1", ["a", "z"]) == {"a": "1", "z": None}


def test_validation_reads_tags_and_scores_once(spark, tmp_path, monkeypatch):
    from riskflow import workflow
    from riskflow.operators import gate, scoring, tags, training

    rows = spark.range(400).select("id", (F.col("id") % 2).cast("int").alias("x"), (F.col("id") % 2).cast("double").alias("label"), F.when(F.col("id") % 4 < 2, "l").otherwise("r").alias("side"))
    model = training.fit_pipeline(rows, training.FeatureSpec(binary=["x"]), C=1.0, balance=True)
    scoring.save_model(model, scoring.signature(rows, ["x"]), str(tmp_path / "model"))
    rows.write.parquet(str(tmp_path / "features"))
    path = str(tmp_path / "tags")
    tags.set_tags(spark, path, "v1", {"slice_cols": "side", "description": "says which side a row is on"})
    calls = []
    monkeypatch.setattr(gate, "score", lambda *a, **k: calls.append(1) or scoring.score(*a, **k))
    plan = workflow.RiskTable(key="id", label="label")
    checks, decision = workflow.validate(spark, "v1", str(tmp_path / "features"), str(tmp_path / "model"), None, plan, tags=path)
    assert {r["check"]: r["value"] for r in checks.collect()} == {"has_description": "1", "has_signature": "1", "predicts": "1", "slice_test": "pass"}
    assert [tuple(r) for r in decision.collect()] == [("v1", "accept", 0)]
    assert len(calls) == 1
    assert tags.tag_values(spark, path, "v1", ["decision", "slice_test_detail"]) == {"decision": "accept", "slice_test_detail": "2 slices"}
    with pytest.raises(ValueError, match="v9"):
        workflow.review(spark, "v9", path)
