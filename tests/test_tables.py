from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.sources import tables


def test_csv_with_and_without_schema(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    (tmp_path / "in.csv").write_text("Incident Number, Pipe (mm),note\n1,2.5,a\n2,,\n")
    inferred = tables.read_csv(spark, path)
    assert [f.dataType.simpleString() for f in inferred.schema] == ["int", "double", "string"]
    assert inferred.columns[0] == "Incident Number"
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("s", T.StringType())])
    with pytest.raises(Exception):
        tables.read_csv(spark, path, schema).collect()  # names in the file differ


def test_overwrite_with_other_columns(spark, tmp_path):
    target = str(tmp_path / "t")
    tables.write_table(spark.range(3), target)
    tables.write_table(spark.range(2).select(F.col("id").alias("k"), F.lit("x").alias("s")), target)
    back = tables.read_table(spark, target)
    assert back.columns == ["k", "s"] and back.count() == 2


def test_catalogue_table(spark):
    tables.ensure_schema(spark, "risk_test")
    tables.ensure_schema(spark, "risk_test")
    tables.ensure_table(spark, "risk_test.log", T.StructType([T.StructField("name", T.StringType())]))
    tables.ensure_table(spark, "risk_test.log", T.StructType([T.StructField("other", T.StringType())]))
    assert tables.read_table(spark, "risk_test.log").columns == ["name"]
    tables.write_table(spark.range(4), "risk_test.log")
    assert tables.read_table(spark, "risk_test.log").count() == 4


def test_append_evolving(spark, tmp_path):
    target = str(tmp_path / "t")
    tables.append_evolving(spark.range(1).select(F.col("id").alias("a")), target)
    tables.append_evolving(spark.range(1).select(F.col("id").alias("a"), F.lit("x").alias("b")), target)
    assert sorted((r["a"], r["b"] or "") for r in tables.read_evolving(spark, target).collect()) == [(0, ""), (0, "x")]


def test_delete_keeps_unknown_rows_and_old_versions(spark, tmp_path):
    target = str(tmp_path / "t")
    tables.delete_where(spark, target, F.col("s") == "x")  # no table, no error
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, s string")
    assert tables.write_versioned(df, target) == 1
    tables.delete_where(spark, target, F.col("s") == "x")
    assert sorted(r["k"] for r in tables.read_versioned(spark, target).collect()) == [2, 3]
    assert tables.current_version(spark, target) == 2


def test_unfinished_version_is_not_read(spark, tmp_path):
    target = tmp_path / "t"
    tables.write_versioned(spark.range(3), str(target))
    spark.range(9).write.parquet(str(target / "v=2"))
    (target / "v=2" / "_SUCCESS").unlink()
    assert tables.current_version(spark, str(target)) == 1
    assert tables.read_versioned(spark, str(target)).count() == 3
    assert tables.write_versioned(spark.range(1), str(target)) == 2


def test_key_check(spark, tmp_path):
    good = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    bad = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, s string")
    assert tables.key_check(good, "k").first().asDict() == {
        "n_rows": 2, "n_null_keys": 0, "n_duplicate_keys": 0, "key_ok": True,
    }
    assert tables.key_check(bad, "k").first().asDict() == {
        "n_rows": 3, "n_null_keys": 1, "n_duplicate_keys": 1, "key_ok": False,
    }
    tables.write_feature_table(good, str(tmp_path / "f"), "k")
    with pytest.raises(ValueError, match="not a key"):
        tables.write_feature_table(bad, str(tmp_path / "f"), "k")
    assert tables.read_table(spark, str(tmp_path / "f")).count() == 2


def test_preview_and_schema(spark):
    assert [r["id"] for r in tables.preview(spark.range(10), 2, [F.desc("id")]).collect()] == [9, 8]
    assert tables.schema_rows(spark.range(1)).first()["type"] == "bigint"


def test_files_whose_types_differ_are_read_as_the_widest(spark, tmp_path):
    path = str(tmp_path / "mixed")
    parts = [
        "SELECT 1 AS id, true AS v, 5 AS n, named_struct('a', 1) AS s, DATE'2024-01-02' AS d",
        "SELECT 2 AS id, 0.25D AS v, 6L AS n, named_struct('a', 2.5D, 'b', 'x') AS s, TIMESTAMP'2024-01-02 03:00:00' AS d",
        "SELECT 3L AS id, CAST(1.50 AS DECIMAL(5,2)) AS v, CAST(7.25 AS DECIMAL(4,2)) AS n",
        "SELECT 4 AS id, 'many' AS n, array(1, 2) AS extra",
        "SELECT 5 AS id, 9 AS n, 'none' AS extra",
    ]
    for part in parts:
        tables.append_evolving(spark.sql(part), path)
    got = tables.read_evolving(spark, path)
    kinds = {f.name: f.dataType.simpleString() for f in got.schema}
    assert kinds == {"id": "bigint", "v": "double", "n": "string", "s": "struct<a:double,b:string>", "d": "timestamp", "extra": "string"}
    rows = {r["id"]: r for r in got.collect()}
    assert [rows[i]["v"] for i in range(1, 6)] == [1.0, 0.25, 1.5, None, None]
    assert [rows[i]["n"] for i in range(1, 6)] == ["5", "6", "7.25", "many", "9"]
    assert (rows[1]["s"]["a"], rows[1]["s"]["b"], rows[2]["s"]["b"], rows[3]["s"]) == (1.0, None, "x", None)
    assert [rows[4]["extra"], rows[5]["extra"]] == ["[1,2]", "none"]


def test_files_that_agree_are_merged_by_spark_itself(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "plain")
    for n in (1, 2, 3):
        tables.append_evolving(spark.range(n).withColumn(f"c{n}", F.lit(n)), path)
    monkeypatch.setattr(tables, "_mergeable", lambda *_: 1 / 0)
    assert tables.read_evolving(spark, path).count() == 6
    assert len(tables.data_files(spark, path)) >= 3


def test_the_key_is_checked_on_the_source(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (float("nan"), "c")], "k double, v string")
    assert tuple(tables.key_check(rows, "k").first()) == (3, 1, 0, False)
    read = []
    monkeypatch.setattr(tables, "key_check", lambda df, key: read.append(df) or spark.sql("SELECT true AS key_ok"))
    tables.write_feature_table(rows, str(tmp_path / "t"), "k", source=rows.select("k"))
    assert read[0].columns == ["k"] and spark.read.parquet(str(tmp_path / "t")).count() == 3
