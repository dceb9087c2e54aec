"""Association, group folds, mergeable profiles, foreign models, halving search and the quarantine stream."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.operators import association, folds, foreign, scoring, sketches, training
from riskflow.streaming import quarantine
from riskflow.streaming.scoring import read_arriving

# ------------------------------------------------------------- association


def entropies(pairs):
    n, cells = len(pairs), Counter(pairs)
    a, b = Counter(x for x, _ in pairs), Counter(y for _, y in pairs)
    entropy = -sum(k / n * math.log(k / n) for k in b.values())
    left = -sum(k / n * math.log(k / a[x]) for (x, _), k in cells.items())
    phi = sum(k * k / (a[x] * b[y]) for (x, y), k in cells.items()) - 1
    smaller = min(len(a), len(b)) - 1
    return entropy, left, math.sqrt(max(phi, 0) / smaller) if smaller else None


def test_association_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(600):  # a third of the rows share a value, some have none
        a = "hot" if i % 3 == 0 else None if i % 7 == 0 else f"a{rng.integers(0, 5)}"
        rows.append((i, a, int(rng.integers(0, 3)) if a != "hot" else 1, float("nan") if i % 11 == 0 else float(i % 4)))
    df = spark.createDataFrame(rows, "id int, a string, b int, c double")
    got = {(r["source"], r["target"]): r for r in association.association_matrix(df, ["a", "b", "c", "id"]).collect()}
    assert len(got) == 6
    column = {"id": 0, "a": 1, "b": 2, "c": 3}
    for (s, t), r in got.items():
        clean = [tuple(None if v != v else v for v in (x[column[s]], x[column[t]])) for x in rows]
        entropy, left, v = entropies(clean)
        assert (r["entropy"], r["conditional_entropy"], r["cramers_v"]) == pytest.approx((entropy, left, v), abs=2e-6)


def test_a_copy_of_the_label_explains_it(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("label"), F.concat(F.lit("x"), F.col("id") % 2).alias("copy"), F.lit(1).alias("one"))
    got = {r["source"]: (r["explained"], r["cramers_v"]) for r in association.association_with(df, "label").collect()}
    assert got == {"copy": (1.0, 1.0), "one": (0.0, None)}
    assert association.association(df, [("label", "one")]).first()["explained"] is None
    assert association.association_with(df.limit(0), "label").count() == 0


# ------------------------------------------------------------- folds


def test_folds_keep_groups_and_balance(spark):
    rows = spark.range(3_000).select("id", F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 211).alias("g"))
    got = folds.with_folds(rows, "g", 4).collect()
    assert len(got) == 3_000 and {r["fold"] for r in got if r["g"] is None} == {None}
    by_group = {}
    for r in got:
        if r["g"] is not None:
            by_group.setdefault(r["g"], set()).add(r["fold"])
    assert all(len(f) == 1 for f in by_group.values())
    assert set().union(*by_group.values()) <= {0, 1, 2, 3}
    even = folds.with_folds(spark.range(1_000).select((F.col("id") % 200).alias("g")), "g", 4).groupBy("fold").count().collect()
    assert all(abs(r["count"] - 250) <= 10 for r in even) and len(even) == 4
    again = {(r["id"], r["fold"]) for r in folds.with_folds(rows.repartition(7), "g", 4).collect()}
    assert again == {(r["id"], r["fold"]) for r in got}
    with pytest.raises(ValueError):
        folds.with_folds(rows, "g", 0)


def test_cross_validation_uses_models_of_the_other_folds(spark):
    rows = spark.range(400).select("id", (F.col("id") % 40).alias("g"), (F.col("id") % 2).cast("int").alias("x"), (F.col("id") % 2).alias("label"))
    seen = []

    def fit(train):
        seen.append({r["g"] for r in train.select("g").distinct().collect()})
        return training.fit_pipeline(train, training.FeatureSpec(binary=["x"]), C=1.0, balance=True)

    got = folds.cross_validate(rows, "label", training.FeatureSpec(binary=["x"]), "g", 3, fit=fit)
    assert sorted(r["fold"] for r in got.collect()) == [0, 1, 2]
    assert sum(r["n"] for r in got.collect()) == 400 and all(r["accuracy"] == 1.0 for r in got.collect())
    assert set.intersection(*seen) == set() and all(len(s) < 40 for s in seen)


# ------------------------------------------------------------- sketches


def test_merged_profile_equals_that_of_the_whole(spark, tmp_path):
    df = spark.range(5_000).select(
        (F.col("id") % 3).alias("day"),
        F.when(F.col("id") % 10 != 0, F.col("id") * 3.5).alias("x"),
        F.when(F.col("day") == 1, None).otherwise(F.lit(1_000_000) + F.col("id") % 7).cast("int").alias("y"),
        F.concat(F.lit("t"), F.col("id") % 1234).alias("s"),
    )
    path = str(tmp_path / "sketches")
    for day in (0, 1, 2, 1):  # the second one is delivered again
        sketches.add_delivery(df.where(F.col("day") == day), path, ["x", "y", "s"], f"day {day}")
    got = {r["column"]: r for r in sketches.merged_profile(sketches.read_deliveries(spark, path), (0.1, 0.5)).collect()}
    exact = df.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("x", "y") for f in (F.count, F.min, F.max, F.avg, F.stddev_samp)]).first()
    for c in ("x", "y"):
        assert got[c]["n"] == exact[f"count_{c}"] and got[c]["n"] + got[c]["n_null"] == 5_000 and got[c]["n_deliveries"] == 3
        assert (got[c]["min"], got[c]["max"]) == (exact[f"min_{c}"], exact[f"max_{c}"])
        assert (got[c]["mean"], got[c]["std"]) == pytest.approx((exact[f"avg_{c}"], exact[f"stddev_samp_{c}"]), rel=1e-9)
        errors = sketches.rank_errors(df, c, [(0.1, got[c]["p10"]), (0.5, got[c]["p50"])]).collect()
        assert all(e["error"] <= 0.01 for e in errors)
    assert abs(got["x"]["n_distinct"] - 4_500) <= 0.05 * 4_500 and got["y"]["n_distinct"] == 7
    assert abs(got["s"]["n_distinct"] - 1_234) <= 0.05 * 1_234 and (got["s"]["mean"], got["s"]["p50"]) == (None, None)


# ------------------------------------------------------------- foreign models


def test_foreign_model_sees_the_types_of_its_signature(spark, tmp_path):
    def predict(columns):
        assert columns["a"].dtype.kind in "if"
        return columns["a"] * 2.0 + np.array([0 if t is None else len(t) for t in columns["t"]])

    contract = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("t", T.StringType())])
    foreign.save_foreign(foreign.ForeignModel(predict, contract), str(tmp_path / "model"))
    model = foreign.load_foreign(spark, str(tmp_path / "model"))
    df = spark.createDataFrame([(1, "3", "xy"), (2, "no", "x"), (3, None, None), (4, "5", None)], "id int, a string, t string")
    got = {r["id"]: r["prediction"] for r in foreign.score_foreign(model, df.withColumn("prediction", F.lit("old"))).collect()}
    assert got == {1: 8.0, 2: None, 3: None, 4: 10.0}
    assert foreign.score_foreign(model, df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="t"):
        foreign.score_foreign(model, df.drop("t"))


# ------------------------------------------------------------- halving


def test_halving_finds_the_winner_of_the_full_grid(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(1200, 2))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (draw.random(1200) < 0.05)).astype(float)  # no line tells them apart, a tree does
    df = spark.createDataFrame([(i, float(a), float(b), float(l)) for i, ((a, b), l) in enumerate(zip(x, y))], "id int, a double, b double, label double")
    grid = [
        {"family": "logistic", "C": 1.0, "penalty": "l2"},
        {"family": "decision_tree", "max_depth": 6},
        {"family": "logistic", "C": 0.1, "penalty": "l1"},
        {"family": "decision_tree", "max_depth": 1},
    ]
    spec = training.FeatureSpec(numeric=["a", "b"])
    full = training.search(df, "label", spec, "id", grid)
    quick = training.search_halving(df, "label", spec, "id", grid)
    assert quick.best["run_id"] == full.best["run_id"] == "trial-001"
    assert quick.best["val_f1"] == full.best["val_f1"]
    rows = {r["run_id"]: (r["status"], r["share"]) for r in quick.trials.collect()}
    assert len(rows) == 4 and rows["trial-001"] == ("FINISHED", 1.0)
    assert sorted(s for _, s in rows.values()) == [0.25, 0.25, 0.5, 1.0]
    assert quick.model.transform(df).count() == 1200
    with pytest.raises(ValueError):
        training.search_halving(df, "label", spec, "id", grid, shares=(0.5, 0.9))


# ------------------------------------------------------------- quarantine


CONTRACT = T.StructType([T.StructField("x", T.IntegerType(), False), T.StructField("note", T.StringType())])


def test_breaches_are_named(spark):
    df = spark.createDataFrame([("1", None), ("1.5", "a"), (None, "b"), ("zz", None)], "x string, note string")
    reason = quarantine.contract_breaches(df, CONTRACT)
    assert [r[0] for r in df.select(reason).collect()] == [None, "x is no int", "x is missing", "x is no int"]
    assert df.select(quarantine.contract_breaches(df.drop("note"), CONTRACT)).first()[0] == "note is absent"
    number = spark.createDataFrame([(1.0,), (1.5,), (float("nan"),)], "x double")
    only = T.StructType(CONTRACT.fields[:1])
    assert [r[0] for r in number.select(quarantine.contract_breaches(number, only)).collect()] == [None, "x is no int", "x is missing"]


def test_a_restart_gives_each_row_once(spark, tmp_path, monkeypatch):
    rows = spark.range(200).select("id", (F.col("id") % 2).cast("int").alias("x"), (F.col("id") % 2).cast("double").alias("label"))
    model = training.fit_pipeline(rows, training.FeatureSpec(binary=["x"]), C=1.0, balance=True)
    source, sink, aside = (str(tmp_path / n) for n in ("in", "sink", "aside"))
    text = F.when(F.col("id") % 5 == 0, "bad").otherwise((F.col("id") % 2).cast("string"))
    arriving = spark.range(0, 100).select("id", text.alias("x"), F.lit("n").alias("note"))
    for lo in (0, 50):
        arriving.where((F.col("id") >= lo) & (F.col("id") < lo + 50)).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = read_arriving(spark, source, arriving.schema, max_files=1)
        quarantine.score_or_set_aside(model, stream, CONTRACT, sink, aside, str(tmp_path / "check")).awaitTermination()

    calls = []
    plain = quarantine.split_by_contract

    def breaks_after_the_first_sink(*args):
        good, bad = plain(*args)
        calls.append(1)
        return (good, bad.withColumn("id", F.raise_error(F.lit("lost")).cast("bigint"))) if len(calls) == 2 else (good, bad)

    monkeypatch.setattr(quarantine, "split_by_contract", breaks_after_the_first_sink)
    with pytest.raises(Exception, match="lost"):
        run()
    assert spark.read.parquet(sink).count() == 80  # both batches, the second one's refuse is not written yet
    run()
    run()
    scored, refused = spark.read.parquet(sink).collect(), spark.read.parquet(aside).collect()
    assert sorted(r["id"] for r in scored) == [i for i in range(100) if i % 5]
    assert all(r["prediction"] == r["id"] % 2 for r in scored)
    assert sorted((r["id"], r["x"], r["contract_breach"]) for r in refused) == [(i, "bad", "x is no int") for i in range(0, 100, 5)]
    assert {r["batch"] for r in scored} == {0, 1}
