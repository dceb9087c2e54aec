from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskflow.operators import encoding


def codes(df, col="v"):
    return [r[col] for r in df.orderBy("id").collect()]


def frame(spark, values, kind):
    return spark.createDataFrame(list(enumerate(values)), f"id int, v {kind}")


@pytest.mark.parametrize(
    ("values", "kind", "expected"),
    [
        (["b", "a", "c", "a"], "string", [1, 0, 2, 0]),
        ([10, 2, 1], "int", [2, 1, 0]),
        ([10.5, None, float("nan"), -0.0, 0.0], "double", [1, None, None, 0, 0]),
        ([True, False, None], "boolean", [1, 0, None]),
        ([dt.date(2024, 1, 2), dt.date(2023, 1, 1)], "date", [1, 0]),
        (["Z", "a", "é", "z"], "string", [0, 1, 3, 2]),
    ],
)
def test_codes_follow_the_order_of_the_values(spark, values, kind, expected):
    df = frame(spark, values, kind)
    domain = encoding.fit_label_encoder(df, ["v"])
    assert codes(encoding.encode(df, domain)) == expected
    assert codes(encoding.encode(df, domain, max_broadcast_rows=0)) == expected


def test_values_outside_the_domain(spark):
    domain = encoding.fit_label_encoder(frame(spark, ["a", "b", "c"], "string"), ["v"])
    new = frame(spark, ["d", "a", None], "string")
    for limit in (None, 0):
        assert codes(encoding.encode(new, domain, max_broadcast_rows=limit)) == [None, 0, None]
        assert codes(encoding.encode(new, domain, unknown="code", max_broadcast_rows=limit)) == [3, 0, None]
    with pytest.raises(Exception, match="not fitted"):
        encoding.encode(new, domain, unknown="error").collect()
    with pytest.raises(ValueError):
        encoding.encode(new, domain, unknown="skip")


def test_all_columns_in_place_and_back(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    domain = encoding.fit_label_encoder(orders)
    coded = encoding.encode(orders, domain)
    assert coded.columns == orders.columns
    assert {f.dataType.simpleString() for f in coded.schema} == {"bigint"}
    back = encoding.decode(coded, domain)
    assert back.schema == orders.schema
    assert back.exceptAll(orders).isEmpty() and orders.exceptAll(back).isEmpty()


def test_domain_survives_saving(spark, tmp_path):
    df = frame(spark, [3, 1, 2], "int")
    encoding.fit_label_encoder(df, ["v"]).save(str(tmp_path / "domain"))
    domain = encoding.LabelDomain.load(spark, str(tmp_path / "domain"))
    assert codes(encoding.encode(df, domain)) == [2, 0, 1]
    assert domain.values("v") == [1, 2, 3]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.text(max_size=3), st.integers(0, 20).map(str)), min_size=1, max_size=30))
def test_decode_undoes_encode(spark, values):
    df = frame(spark, values, "string")
    domain = encoding.fit_label_encoder(df, ["v"])
    coded = encoding.encode(df, domain)
    present = sorted({v for v in values if v is not None}, key=lambda v: v.encode("utf-8", "surrogatepass"))
    assert codes(coded) == [None if v is None else present.index(v) for v in values]
    assert codes(encoding.decode(coded, domain)) == values


def test_hot_value_and_nulls_are_spread(spark, plan):
    """A third of the rows share a value, a third have none: no task may get them all."""
    n = 24_000
    value = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id"))
    df = spark.range(0, n, 1, 8).select("id", value.cast("bigint").alias("v"))
    domain = encoding.fit_label_encoder(df, ["v"])
    changed = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        coded = encoding.encode(df, domain, max_broadcast_rows=0)
        text = plan(coded)
        rows = coded.select("id", "v", F.spark_partition_id().alias("task")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert any("_spread" in line for line in text.splitlines() if "hashpartitioning" in line)
    assert len(rows) == n
    present = sorted({7} | {i for i in range(n) if i % 3 == 2})
    place = {v: i for i, v in enumerate(present)}
    for r in rows:
        want = {0: place[7], 1: None, 2: place.get(r["id"])}[r["id"] % 3]
        assert r["v"] == want
    per_task: dict[int, int] = {}
    for r in rows:
        per_task[r["task"]] = per_task.get(r["task"], 0) + 1
    assert max(per_task.values()) < n / 3


def test_a_hot_value_the_domain_lacks_is_spread(spark):
    n = 24_000
    fitted = encoding.fit_label_encoder(spark.range(0, n).select(F.col("id").alias("v")), ["v"])
    value = F.when(F.col("id") % 3 == 0, F.lit(-5)).otherwise(F.col("id"))
    new = spark.range(0, n, 1, 8).select("id", value.cast("bigint").alias("v"))
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        coded = encoding.encode(new, fitted, max_broadcast_rows=0)
        rows = coded.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.count("v").alias("known")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(r["n"] for r in rows) == n and sum(r["known"] for r in rows) == n - n // 3
    assert max(r["n"] for r in rows) < n / 4


def test_one_hot(spark):
    domain = encoding.fit_label_encoder(frame(spark, ["a", "b"], "string"), ["v"])
    new = frame(spark, ["a", "b", "z", None], "string")
    out = encoding.one_hot(new, ["v"], domain).orderBy("id").collect()
    assert [(r["v_a"], r["v_b"], r["v_unknown"]) for r in out] == [(1, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 1)]
    binary = encoding.fit_label_encoder(frame(spark, [0, 1], "int"), ["v"])
    out = encoding.one_hot(frame(spark, [0, 1, 7], "int"), ["v"], binary, drop="first", unknown="ignore")
    assert out.columns == ["id", "v", "v_1"]
    assert codes(out, "v_1") == [0, 1, 0]


def test_one_hot_keeps_a_value_called_unknown(spark):
    out = encoding.one_hot(frame(spark, ["unknown", "a", None], "string"), ["v"]).orderBy("id").collect()
    assert [(r["v_a"], r["v_unknown"], r["v_unknown_"]) for r in out] == [(0, 1, 0), (1, 0, 0), (0, 0, 1)]
    clash = spark.createDataFrame([("b_c", "c")], "a string, a_b string")
    with pytest.raises(ValueError, match="a_b_c"):
        encoding.one_hot(clash, ["a", "a_b"], unknown="ignore")


def test_one_hot_stage_bears_many_values_and_a_new_type(spark):
    from riskflow.operators.stages import OneHotFeatures

    many = spark.range(5000).select(F.col("id").alias("v"))
    model = OneHotFeatures(inputCols=["v"], outputCol="f").fit(many)
    assert len(model.feature_names()) == 5001
    now = spark.createDataFrame([(7.0,), (7.5,), (None,), (-0.0,)], "v double")
    rows = [r["f"] for r in model.transform(now).collect()]
    assert [r.index(1.0) for r in rows] == [7, 5000, 5000, 0] and all(sum(r) == 1 for r in rows)


def test_frequency(spark):
    df = frame(spark, ["a", "b", "a", None], "string")
    assert codes(encoding.frequency_encode(df, ["v"]), "v_n") == [2, 1, 2, 0]


def test_types_without_an_order_are_refused(spark):
    with pytest.raises(TypeError, match="array"):
        encoding.fit_label_encoder(spark.sql("SELECT array(1) AS v"))


def _shuffles(text):
    return [line for line in text.splitlines() if "hashpartitioning" in line and "Arguments" in line]


def test_several_large_columns_share_their_shuffles(spark, plan):
    """Three large columns: their entries meet the domain once, the wide rows are shuffled once."""
    n = 6_000
    rows = spark.range(0, n, 1, 4).select(
        "id",
        (F.col("id") * 7 % 5003).alias("a"),
        F.concat(F.lit("v"), F.col("id") % 4001).alias("b"),
        F.when(F.col("id") % 3 == 0, F.lit(0.5)).when(F.col("id") % 3 == 1, F.col("id") / 7).alias("c"),
    )
    domain = encoding.fit_label_encoder(rows, ["a", "b", "c"])
    names = {"a": "bigint", "b": "string", "c": "double"}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        coded = encoding.encode(rows, domain, max_broadcast_rows=0)
        wide = [line for line in _shuffles(plan(coded)) if "_row" in line]
        got = {r["id"]: (r["a"], r["b"], r["c"]) for r in coded.collect()}
        back = encoding.decode(coded, domain, max_broadcast_rows=0)
        assert [f.dataType.simpleString() for f in back.schema][1:] == list(names.values())
        assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(wide) == 2  # the stored rows, and the folded codes
    plain = {r["id"]: (r["a"], r["b"], r["c"]) for r in encoding.encode(rows, domain).collect()}
    assert got == plain and len(got) == n


def test_large_columns_of_which_one_has_only_hot_values(spark):
    rows = spark.range(3_000).select("id", (F.col("id") % 2).alias("a"), (F.col("id") * 11 % 2999).cast("int").alias("b"))
    domain = encoding.fit_label_encoder(rows, ["a", "b"])
    new = rows.withColumn("a", F.when(F.col("id") % 5 == 0, F.lit(9)).otherwise(F.col("a"))).withColumn("b", F.col("b").cast("double") + 0.5 * (F.col("id") % 2))
    large, small = (
        {r["id"]: (r["a"], r["b"]) for r in encoding.encode(new, domain, max_broadcast_rows=limit).collect()} for limit in (0, None)
    )
    assert large == small and large[0] == (None, 0) and large[1] == (1, None)


def test_few_values_stop_at_the_limit(spark):
    df = spark.createDataFrame([("b", 2.5), ("a", 10.0), (None, float("nan")), ("é", -0.0)], "s string, d double")
    assert encoding.few_values(df, ["s", "d"], 6) == {"s": ["a", "b", "é"], "d": ["0.0", "2.5", "10.0"]}
    assert encoding.few_values(df, ["s", "d"], 5) is None
    assert encoding.few_values(df.limit(0), ["s"], 5) == {"s": []}


SPARSE = [("", "indicator"), ("", "ignore"), ("first", "indicator"), ("first", "ignore")]


@pytest.mark.parametrize(("drop", "unknown"), SPARSE)
def test_sparse_one_hot_has_the_slots_of_the_dense_one(spark, tmp_path, drop, unknown):
    from pyspark.ml.functions import vector_to_array

    from riskflow.operators.stages import OneHotFeatures, OneHotFeaturesModel

    fitted = spark.createDataFrame(
        [("unknown", 1.0), ("b", 2.5), ("a", None), ("unknown_", float("nan"))], "s string, d double"
    )
    now = spark.createDataFrame([("a", 1), ("z", 2), (None, None), ("unknown_", 7), ("b", 1)], "s string, d int")
    now = now.withColumn("id", F.monotonically_increasing_id())
    found = {}
    for limit in (100, 0):
        model = OneHotFeatures(inputCols=["s", "d"], outputCol="f", drop=drop, unknown=unknown, maxDense=limit).fit(fitted)
        model.write().overwrite().save(str(tmp_path / f"model{limit}"))
        model = OneHotFeaturesModel.load(str(tmp_path / f"model{limit}"))
        out = model.transform(now).orderBy("id")
        assert out.columns == ["s", "d", "id", "f"]
        slots = [list(r["f"]) for r in (out if limit else out.withColumn("f", vector_to_array("f"))).collect()]
        names = {r["slot"]: r["feature"] for r in model.feature_table().collect()}
        found[limit] = slots, names, model.n_slots()
    assert found[0] == found[100]
    with pytest.raises(ValueError, match="feature_table"):
        model.feature_names()


def test_sparse_one_hot_names_no_slot_on_the_driver(spark):
    from riskflow.operators.stages import FeatureVector, OneHotFeatures

    many = spark.range(5000).select("id", (F.col("id") * 7 % 5000).alias("v"), (F.col("id") % 3).cast("string").alias("s"))
    model = OneHotFeatures(inputCols=["s", "v"], outputCol="f", drop="first", maxDense=256).fit(many)
    now = many.union(spark.createDataFrame([(5000, None, "z")], "id bigint, v bigint, s string"))
    out = model.transform(now)
    assert len(out.schema["f"].json()) < 1000
    rows = {r["id"]: r["f"] for r in out.collect()}
    assert all(r.size == 3 + 5000 and set(r.values) <= {1.0} for r in rows.values())
    slots = {i: list(r.indices) for i, r in rows.items()}
    assert slots[5000] == [2, 5002] and slots[0] == [] and slots[1] == [0, 3 + 6] and slots[2] == [1, 3 + 13] and slots[3] == [3 + 20]
    # classifiers still hear that each slot holds 0 or 1
    joined = FeatureVector(inputCols=["f"], outputCol="g").transform(out)
    assert len(joined.schema["g"].metadata["ml_attr"]["attrs"]["binary"]) == 5003


def test_modes_of_several_columns(spark):
    from riskflow.operators import imputing

    rows = [("x", 1, 1.5, True), ("x", 2, 1.5, None), ("y", 2, None, False), (None, None, 0.5, False), ("y", None, 0.5, True)]
    df = spark.createDataFrame(rows, "g string, i int, d double, b boolean")
    assert imputing.fit_impute(df, ["g", "i", "d", "b"], "mode") == {"g": "x", "i": 2, "d": 0.5, "b": False}
    filled = imputing.impute(df, ["i", "d"], "mode", by=["g"])
    assert filled.schema["i"].dataType.simpleString() == "int"
    got = {(r["g"], r["i"], r["d"]) for r in filled.collect()}
    assert got == {("x", 1, 1.5), ("x", 2, 1.5), ("y", 2, 0.5), (None, 2, 0.5)}
