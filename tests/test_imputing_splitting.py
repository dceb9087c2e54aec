from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from riskflow.operators import imputing, splitting


def column(df, col):
    return [r[col] for r in df.orderBy("id").collect()]


@pytest.fixture
def gapped(spark):
    rows = [(0, "a", 1.0), (1, "a", None), (2, "a", 3.0), (3, "b", float("nan")), (4, "b", 10.0), (5, "c", None), (6, None, None)]
    return spark.createDataFrame(rows, "id int, g string, x double")


def test_mean_median_mode_literal(gapped):
    mean = 14 / 3
    assert column(imputing.impute(gapped, ["x"]), "x") == pytest.approx([1, mean, 3, mean, 10, mean, mean])
    assert column(imputing.impute(gapped, ["x"], "median"), "x") == [1, 3, 3, 3, 10, 3, 3]
    assert column(imputing.impute(gapped, ["x"], "mode"), "x") == [1, 1, 3, 1, 10, 1, 1]
    assert column(imputing.impute(gapped, ["x"], "literal", value=0.0), "x") == [1, 0, 3, 0, 10, 0, 0]
    assert column(imputing.impute(gapped, ["g"], "mode"), "g")[-1] == "a"


@pytest.mark.parametrize(("strategy", "inside", "outside"), [("mean", 2.0, 14 / 3), ("median", 2.0, 3.0), ("mode", 1.0, 1.0)])
def test_group_statistics_fall_back(gapped, strategy, inside, outside):
    got = column(imputing.impute(gapped, ["x"], strategy, by=["g"]), "x")
    assert got == pytest.approx([1, inside, 3, 10, 10, outside, outside])


def test_nothing_to_impute_from(gapped):
    empty = gapped.where("g = 'c'")
    for strategy in ("mean", "median", "mode"):
        with pytest.raises(ValueError, match="x"):
            imputing.impute(empty, ["x"], strategy)
    with pytest.raises(ValueError, match="g"):
        imputing.impute(gapped, ["g"], "mean")


def test_standardize(spark):
    df = spark.createDataFrame([(0, 1.0, 5.0), (1, 3.0, 5.0)], "id int, x double, y double")
    out = imputing.standardize(df, ["x", "y"])
    assert column(out, "x") == [-1.0, 1.0] and column(out, "y") == [0.0, 0.0]


def slot(key, seed, slots=10_000):
    return int(hashlib.md5(f"{key}|{seed}".encode()).hexdigest()[:8], 16) % slots


def test_split_depends_on_key_and_seed_alone(spark):
    ids = spark.range(3000).withColumnRenamed("id", "k")
    parts = {r["k"]: r["split"] for r in splitting.with_split(ids, "k", 3).collect()}
    for k, part in parts.items():
        s = slot(k, 3)
        assert part == ("train" if s < 6000 else "val" if s < 8000 else "test")
    shares = [sum(p == n for p in parts.values()) / 3000 for n in splitting.SPLIT_NAMES]
    assert shares == pytest.approx([0.6, 0.2, 0.2], abs=0.03)


def test_split_needs_no_shuffle(spark, plan):
    assert "Exchange" not in plan(splitting.with_split(spark.range(10), "id"))


def test_stratified_split_serves_rare_labels(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 400 == 0, 1).when(F.col("id") == 7, None).otherwise(0).alias("label"))
    out = splitting.with_split(df, "id", stratify="label")
    assert out.columns == ["id", "label", "split"] and out.count() == 4000
    counts = {(r["label"], r["split"]): r["count"] for r in out.groupBy("label", "split").count().collect()}
    assert (counts[1, "train"], counts[1, "val"], counts[1, "test"]) == (6, 2, 2)
    assert abs(counts[0, "train"] - 0.6 * 3989) <= 1


def test_class_weights(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 0), (3, 1), (4, None)], "id int, label int")
    out = splitting.with_class_weight(df, "label")
    assert column(out, "weight") == pytest.approx([2 / 3, 2 / 3, 2 / 3, 2.0, None])
    assert out.agg(F.sum("weight")).first()[0] == pytest.approx(4.0)


def test_sample_and_hold_out(spark):
    ids = spark.range(500).repartition(7)
    first = [r["id"] for r in splitting.sample_n(ids, 20, "id", 1).collect()]
    again = [r["id"] for r in splitting.sample_n(ids.repartition(3), 20, "id", 1).collect()]
    assert first == again and len(set(first)) == 20
    assert splitting.sample_n(ids, 900, "id").count() == 500
    kept, held = splitting.hold_out(ids, "id", 0.25, 9)
    assert kept.count() + held.count() == 500 and kept.join(held, "id").isEmpty()
    assert held.count() == sum(slot(k, 9) < 2500 for k in range(500))
