from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.operators import profiling


@pytest.fixture
def mixed(spark):
    rows = [(1, 1.0, "a"), (2, float("nan"), None), (3, None, "b"), (4, 5.0, "a")]
    return spark.createDataFrame(rows, "k int, x double, s string")


def test_null_profile_counts_nan(mixed):
    rows = {r["column"]: r for r in profiling.null_profile(mixed, 0.4).collect()}
    assert (rows["x"]["n_null"], rows["x"]["null_share"], rows["x"]["keep"]) == (2, 0.5, False)
    assert (rows["s"]["n_null"], rows["s"]["keep"]) == (1, True)
    assert profiling.rows_with_null(mixed).first()["n_rows_with_null"] == 2


def test_profile_of_empty_table(mixed):
    row = profiling.null_profile(mixed.where("false")).where("column = 'x'").first()
    assert (row["n_rows"], row["null_share"]) == (0, 0.0)
    row = profiling.profile_numeric(mixed.where("false"), ["x"]).first()
    assert (row["n"], row["n_distinct"], row["p50"]) == (0, 0, None)


def test_quantiles_match_numpy(spark):
    draw = np.random.default_rng(3)
    values = [float(v) for v in draw.integers(0, 40, 501)]
    df = spark.createDataFrame([(("a", "b")[i % 2], v) for i, v in enumerate(values)], "g string, x double")
    shares = [0.0, 0.1, 0.5, 0.77, 1.0]
    for group in ((), ("g",)):
        rows = profiling.quantiles(df, ["x"], shares, group).collect()
        assert len(rows) == len(shares) * (2 if group else 1)
        for r in rows:
            mine = [v for i, v in enumerate(values) if not group or ("a", "b")[i % 2] == r["g"]]
            assert math.isclose(r["value"], float(np.quantile(mine, r["share"])), abs_tol=1e-9)


def test_profile_numeric_exact_and_sketched(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("x"))
    exact = profiling.profile_numeric(df, ["x"], [0.5]).first()
    assert (exact["n"], exact["n_distinct"], exact["p50"], exact["min"], exact["max"]) == (100, 100, 50.5, 1.0, 100.0)
    sketched = profiling.profile_numeric(df, ["x"], [0.5], exact=False).first()
    assert abs(sketched["p50"] - 50) <= 1 and abs(sketched["n_distinct"] - 100) <= 10


def test_whole_profile_covers_all_columns(mixed):
    rows = {r["column"]: r for r in profiling.profile(mixed, exact=True).collect()}
    assert set(rows) == {"k", "x", "s"}
    assert rows["s"]["n_distinct"] == 2 and rows["s"]["first_value"] == "a"


def test_whole_profile_of_wide_numbers_and_complex_columns(spark):
    big = 2**53
    rows = [(big, [1], {"a": 1}, (1, None), b"x"), (big + 1, [1, 2], {"a": 2}, (None, 1), b"x"), (big + 1, None, None, None, None)]
    df = spark.createDataFrame(rows, "id long, a array<int>, m map<string,int>, s struct<p:int,q:int>, b binary")
    df = df.withColumn("d", F.expr("cast(id as decimal(30,2)) + 0.25"))
    for exact in (True, False):
        got = {r["column"]: r for r in profiling.profile(df, exact=exact).collect()}
        assert set(got) == set(df.columns)
        assert [got["id"][f] for f in ("n_distinct", "min_value", "max_value")] == [2, str(big), str(big + 1)]
        assert got["d"]["n_distinct"] == 2 and got["d"]["max_value"] == f"{big + 1}.25"
        assert [(got[c]["n"], got[c]["n_null"], got[c]["n_distinct"]) for c in "amsb"] == [(2, 1, 2), (2, 1, 2), (2, 1, 2), (2, 1, 1)]


def test_value_counts_breaks_ties_by_value(mixed):
    assert [tuple(r) for r in profiling.value_counts(mixed, "s", 2).collect()] == [("a", 2), (None, 1)]


def test_sliced_accuracy(spark):
    rows = [("a", 1, 1), ("a", 1, 0), ("b", 0, 0), ("b", 1, 1)]
    df = spark.createDataFrame(rows, "s string, label int, prediction int")
    got = {r["s"]: (r["acc"], r["obs"], r["pct_acc"]) for r in profiling.sliced_accuracy(df, "s", "label", "prediction").collect()}
    assert got == {"a": (1, 2, 0.5), "b": (2, 2, 1.0)}
    assert profiling.sliced_accuracy(df, ["s"], "label", "prediction", min_obs=3).isEmpty()


def test_leakage_report_flags_causes_and_keys(spark):
    df = spark.range(200).select(
        "id", (F.col("id") % 10 == 0).cast("int").alias("label"), (F.col("id") % 10).alias("cause"), F.lit(1).alias("flat")
    )
    rows = {r["column"]: r for r in profiling.leakage_report(df, "label").collect()}
    assert rows["id"]["looks_like_key"] and not rows["cause"]["looks_like_key"]
    assert rows["cause"]["gives_away_label"] and not rows["flat"]["gives_away_label"]
    assert rows["flat"]["purity"] == rows["flat"]["base_purity"] == 0.9
