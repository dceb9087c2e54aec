"""From a raw CSV with spaced headers to scored rows."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import functions as F

from riskflow import incident_columns as names
from riskflow import workflow
from riskflow.operators.training import FeatureSpec


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    draw = random.Random(8)
    path = tmp_path_factory.mktemp("raw") / "incidents.csv"
    with open(path, "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow([c.replace("_", " ").title() for c in names.KEPT] + ["Pipe Wall Thickness (mm)", " Note "])
        for i in range(400):
            harmful = i % 5 == 0
            row = []
            for c in names.KEPT:
                if c == names.KEY:
                    value = 10_000 + i
                elif c == "injury_count":
                    value = int(harmful)
                elif c == "fatality_count":
                    value = 0
                elif c == "cause_category":
                    value = draw.choice("XY") if harmful else draw.choice("ABC")
                elif c in names.BINARY:
                    value = draw.choice(["Yes", "No"])
                elif c.startswith("volume") or c.startswith("incident_r") or c.startswith("incident_t"):
                    value = draw.randrange(40)
                else:
                    value = draw.choice(["north", "south", "west"])
                row.append("" if c == "location" and i % 10 == 9 else value)
            writer.writerow([*row, "", "x"])
    return str(path)


def test_from_file_to_scores(spark, raw, tmp_path):
    at = {k: str(tmp_path / k) for k in ("raw", "clean", "features", "domain", "model", "log", "scored", "again")}
    # a few of the features, to keep the fit short
    few = FeatureSpec(binary=["sensitive_area"], numeric=["volume_released", "incident_range"], one_hot=["cause_category"])
    table = workflow.RiskTable(features=few)
    bronze = workflow.ingest(spark, raw, at["raw"])
    assert "pipe_wall_thickness_mm" in bronze.columns and "note" in bronze.columns

    summary = workflow.clean(spark, at["raw"], at["clean"], table).first()
    assert (summary["rows_before"], summary["rows_after"], summary["positives_before"]) == (400, 360, 80)

    features = workflow.build_features(spark, at["clean"], at["features"], at["domain"], table)
    assert len(features.columns) == 28 and features.count() == 360
    assert {f.dataType.simpleString() for f in features.schema} == {"bigint"}
    assert features.agg(F.max(names.KEY)).first()[0] == 359

    grid = [{"family": "logistic", "C": 1.0, "penalty": "l1", "max_iter": 15}]
    run = workflow.train(spark, at["features"], at["model"], at["log"], "incidents", table, grid, stratify=True).first()
    assert run["status"] == "FINISHED" and run["val_f1"] > 0.9
    again = workflow.train(spark, at["features"], at["model"], at["log"], "incidents", table, grid).first()
    assert again["date"] == run["date"]

    checks, decision = workflow.validate(
        spark, "v1", at["features"], at["model"], "Predicts whether an incident does harm.", table, "cause_category"
    )
    assert decision.first()["decision"] == "accept", checks.collect()

    scored = workflow.score(spark, at["features"], at["model"], at["scored"], table)
    assert scored.columns == [names.KEY, "prediction"] and scored.count() == 360
    assert len(spark.read.parquet(at["scored"]).columns) == 29

    new = spark.read.parquet(at["clean"]).limit(20)
    coded = workflow.encode_new(spark, workflow.label_rows(new, table), at["domain"])
    assert coded.exceptAll(features).isEmpty()

    later = workflow.retrain(spark, at["features"], at["again"], at["log"], "incidents", table, grid).first()
    assert later["date"] > run["date"]


def test_defaults_leave_out_key_and_causes():
    used = workflow.RiskTable().features.columns()
    assert names.KEY not in used and not set(names.CAUSES) & set(used)
    assert "incident_type" not in used
    assert len(names.KEPT) == 37 and len(names.DROPPED) == 10 and len(names.NUMERIC) == 26
