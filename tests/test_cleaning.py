from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskflow.operators import cleaning

COUNTS = [(1, 0), (0, 0), (None, 1), (None, 0), (None, None)]


@pytest.fixture
def counts(spark):
    return spark.createDataFrame([(i, *c) for i, c in enumerate(COUNTS)], "id int, injury int, fatality int")


def test_header(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" Lead Space", "A B (mm)", "a b  (MM)"])
    assert cleaning.normalize_header(df).columns == ["lead_space", "a_b_mm", "a_b_mm_2"]
    assert cleaning.normalized_names([" Lead Space", "A B"], extra=False) == ["lead_space", "a_b"]


def test_header_never_repeats_a_name():
    assert cleaning.normalized_names(["a", "A", "a_2", "%"]) == ["a", "a_2", "a_2_2", "column"]


def test_any_positive_keeps_rows_known_to_be_positive(counts):
    kept = cleaning.where_any_positive(counts, ["injury", "fatality"])
    assert sorted(r["id"] for r in kept.collect()) == [0, 2]


def test_any_positive_treats_nan_as_unknown(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0), (3, 0.0)], "id int, x double")
    assert [r["id"] for r in cleaning.where_any_positive(df, ["x"]).collect()] == [2]


def test_binary_label(counts):
    rows = cleaning.with_binary_label(counts, ["injury", "fatality"]).orderBy("id").collect()
    assert [r["label"] for r in rows] == [1, 0, 1, 0, 0]


def test_positive_rate(counts):
    row = cleaning.positive_rate(counts, ["injury", "fatality"]).first()
    assert (row["n_rows"], row["n_positive"], row["positive_pct"]) == (5, 2, 40.0)
    empty = cleaning.positive_rate(counts.where("false"), ["injury", "fatality"]).first()
    assert (empty["n_rows"], empty["positive_pct"]) == (0, None)


def test_drop_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, s string")
    assert [r["x"] for r in cleaning.drop_missing(df, ["x"]).orderBy("x").collect()] == [1.0, 2.0]
    assert cleaning.drop_missing(df).count() == df.na.drop().count() == 1
    assert cleaning.drop_missing(df, how="all").count() == df.na.drop(how="all").count() == 4
    assert cleaning.drop_missing(df, thresh=2).count() == df.na.drop(thresh=2).count() == 1
    with pytest.raises(ValueError):
        cleaning.drop_missing(df, how="some")


def test_drop_missing_reaches_the_scan(spark, sf_dir, plan):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")
    text = plan(cleaning.drop_missing(df, ["o_orderkey"]))
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_numbers_and_categories(spark):
    df = spark.createDataFrame([("12",), (" 12 ",), ("x",), (None,)], "v string")
    assert [r["v"] for r in cleaning.to_numeric(df, ["v"]).collect()] == [12.0, 12.0, None, None]
    assert cleaning.as_category(spark.range(1), ["id"]).schema["id"].dataType.simpleString() == "string"


def test_select_and_drop(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert cleaning.select_columns(df, ["c", "a"]).columns == ["c", "a"]
    assert cleaning.drop_columns(df, ["b", "z"]).columns == ["a", "c"]
    assert cleaning.rename(df, {"a": "x", "z": "y"}).columns == ["x", "b", "c"]
    with pytest.raises(ValueError, match="z"):
        cleaning.select_columns(df, ["a", "z"])


def test_reduction_summary(counts):
    row = cleaning.reduction_summary(counts, ["injury", "fatality"], ["injury", "fatality"]).first()
    assert (row["rows_before"], row["rows_after"]) == (5, 2)
    assert (row["positives_before"], row["positives_after"], row["positives_kept"]) == (2, 1, 0.5)


def test_correct_flag_with_unknown_prediction(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 0.0), (1, None)], "label int, prediction double")
    rows = cleaning.with_correct(df, "label", "prediction").agg(F.collect_list("correct")).first()[0]
    assert sorted(rows) == [0, 0, 1]
