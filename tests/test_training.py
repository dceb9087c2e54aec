from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.operators import explaining, gate, scoring, splitting, training
from riskflow.streaming.scoring import read_arriving, score_stream


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(11)
    x = draw.normal(size=(400, 3))
    y = (draw.random(400) < 1 / (1 + np.exp(-(1.5 * x[:, 0] - 0.5 * x[:, 1] - 0.7)))).astype(float)
    w = np.where(y == 1, 2.0, 0.5)
    return x, y, w


@pytest.fixture(scope="module")
def table(spark, rows):
    x, y, w = rows
    data = [(i, *map(float, x[i]), ("red", "blue")[i % 2], float(y[i]), float(w[i])) for i in range(len(y))]
    return spark.createDataFrame(data, "id int, a double, b double, c double, colour string, label double, w double").cache()


SPEC = training.FeatureSpec(binary=["colour"], numeric=["a", "b"], one_hot=["colour"])


def proximal_gradient(x, y, w, C, steps=40_000):
    """Minimise sum|beta| + C * sum(w * log loss), intercept free."""
    beta, intercept = np.zeros(x.shape[1]), 0.0
    design = np.column_stack([x, np.ones(len(y))])
    step = 1.0 / (C * np.linalg.norm(design * np.sqrt(w)[:, None], 2) ** 2 / 4)
    for _ in range(steps):
        residual = w * (1 / (1 + np.exp(-(x @ beta + intercept))) - y)
        beta = beta - step * C * (x.T @ residual)
        intercept -= step * C * residual.sum()
        beta = np.sign(beta) * np.maximum(np.abs(beta) - step, 0)
    return beta, intercept


def test_penalty_equals_the_c_form(table, rows):
    x, y, w = rows
    beta, intercept = proximal_gradient(x, y, w, training.DEFAULT_C)
    model = training.fit_logistic(training.assemble(table, ["a", "b", "c"]), weight="w")
    assert model.coefficients.toArray() == pytest.approx(beta, abs=1e-4)
    assert model.intercept == pytest.approx(intercept, abs=1e-4)


def test_prepared_features(spark, table):
    model = Pipeline(stages=training.preprocess_stages(SPEC)).fit(table)
    assert training.feature_names(model) == ["colour_red", "a", "b", "colour_blue", "colour_red", "colour_unknown"]
    new = spark.createDataFrame([("red", "x", None), ("green", "1", 2.0)], "colour string, a string, b double")
    out = [r[0] for r in model.transform(new).select(vector_to_array("features")).collect()]
    mean, std = table.agg(F.avg("a"), F.stddev_pop("a")).first()
    assert out[0] == pytest.approx([1, 0, 0, 0, 1, 0])  # a bad number and a null sit on the mean
    assert out[1][0] == 0 and out[1][1] == pytest.approx((1 - mean) / std) and out[1][3:] == [0, 0, 1]
    with pytest.raises(ValueError, match="colour"):
        model.transform(new.drop("colour"))


def test_imputed_rows_lower_the_deviation(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (None,)], "x double")
    model = training.NumericFeatures(inputCols=["x"], outputCol="v").fit(df)
    filled = np.array([1, 3, 2, 2.0])
    assert model.fitted()["scales"][0] == pytest.approx(filled.std())


def test_model_and_signature_survive_saving(table, tmp_path):
    model = training.fit_pipeline(table, SPEC, weight="w", C=1.0)
    scoring.save_model(model, scoring.signature(table, SPEC.columns()), str(tmp_path / "m"))
    again, schema = scoring.load_model(str(tmp_path / "m"))
    assert isinstance(again, PipelineModel) and schema.names == ["colour", "a", "b"]
    assert scoring.score(model, table).exceptAll(scoring.score(again, table)).isEmpty()
    scored = scoring.score(again, table.withColumn("extra", F.lit(1)), "risk")
    assert scored.columns == [*table.columns, "extra", "risk"]


def test_scoring_stays_in_the_jvm(table, plan):
    text = plan(scoring.score(training.fit_pipeline(table, SPEC, weight="w"), table))
    assert "EvalPython" not in text and "InPandas" not in text and "InArrow" not in text


def test_search_takes_the_highest_f1(table):
    grid = [
        {"family": "logistic", "C": 1e-6, "penalty": "l1"},
        {"family": "logistic", "C": 1.0, "penalty": "l2", "max_iter": 15},
        {"family": "decision_tree", "max_depth": 2},
        {"family": "nonsense"},
    ]
    found = training.search(table, "label", SPEC, "id", grid, stratify=True, refit=True)
    trials = {r["run_id"]: r for r in found.trials.collect()}
    assert trials["trial-003"]["status"] == "FAILED" and "nonsense" in trials["trial-003"]["detail"]
    finished = [r for r in trials.values() if r["status"] == "FINISHED"]
    assert len(finished) == 3
    assert found.best["val_f1"] == max(r["val_f1"] for r in finished)
    assert found.best["run_id"] != "trial-000"
    assert found.model.transform(table).where("prediction = label").count() > 240


def test_search_respects_limits(table):
    found = training.search(table, "label", SPEC, "id", max_trials=2, timeout_s=-1)
    assert {r["status"] for r in found.trials.collect()} == {"SKIPPED"} and found.model is None
    assert found.trials.count() == len(training.DEFAULT_GRID) and found.metrics.count() == 0


def test_no_entry_of_a_grid_is_lost(table):
    grid = [{"family": "nonsense"}] * 24 + [{"family": "decision_tree", "max_depth": 1}]
    found = training.search(table, "label", SPEC, "id", grid)
    assert found.trials.count() == 25 and found.best["run_id"] == "trial-024"
    names = {r["name"] for r in found.metrics.collect()}
    assert {"train_f1", "val_accuracy", "test_recall"} <= names
    few = training.search(table, "label", SPEC, "id", grid, max_trials=2)
    assert [r["status"] for r in few.trials.orderBy("run_id").collect()] == ["FAILED"] * 2 + ["SKIPPED"] * 23


def test_stream_gives_each_row_once(spark, table, tmp_path):
    model = training.fit_pipeline(table, SPEC, weight="w", C=1.0)
    source, sink, progress = (str(tmp_path / p) for p in ("in", "out", "progress"))
    schema = T.StructType([table.schema[c] for c in ("id", "a", "b", "colour")])
    for start in (0, 200):
        part = table.where(F.col("id").between(start, start + 199)).select("id", "a", "b", "colour")
        part.coalesce(1).write.mode("append").parquet(source)
        score_stream(model, read_arriving(spark, source, schema), sink, progress).awaitTermination()
        assert spark.read.parquet(sink).count() == start + 200
    batch = scoring.score(model, table).select("id", "prediction")
    assert spark.read.parquet(sink).select("id", "prediction").exceptAll(batch).isEmpty()


def test_checks_of_a_good_and_a_broken_table(spark, table):
    model = training.fit_pipeline(table, SPEC, weight="w", C=1.0)
    schema = scoring.signature(table, SPEC.columns())
    text = "Predicts the label from two numbers and a colour."
    good = gate.run_checks("v1", model, table, schema, "label", "colour", text)
    bad = gate.run_checks("v2", model, table.drop("a"), schema, "label", None, "short")
    wide = {r["version"]: r for r in gate.checks_wide(good.unionByName(bad)).collect()}
    assert [wide["v1"][c] for c in gate.CHECKS] == ["1", "1", "1", "pass"]
    assert [wide["v2"][c] for c in gate.CHECKS] == ["0", "0", "0", "fail"]
    decisions = {r["version"]: r["decision"] for r in gate.decide(good.unionByName(bad)).collect()}
    assert decisions == {"v1": "accept", "v2": "reject"}


def linear_setup(spark, n):
    draw = np.random.default_rng(n)
    weights = [float(v) for v in draw.normal(size=n)]
    names = [f"f{i}" for i in range(n)]
    data = [(i, *[float(v) for v in draw.normal(size=n)]) for i in range(40)]
    df = spark.createDataFrame(data, "k int, " + ", ".join(f"{c} double" for c in names))
    margin = F.lit(0.3)
    for c, w in zip(names, weights):
        margin = margin + F.col(c) * w
    return df, names, dict(zip(names, weights)), lambda d: d.withColumn("prediction", margin)


@pytest.mark.parametrize(("n", "coalitions"), [(1, 10), (2, 10), (4, 500), (9, 60)])
def test_kernel_shap_of_a_linear_model(spark, n, coalitions):
    df, names, weights, score = linear_setup(spark, n)
    background, examples = df.where("k < 25"), df.where("k >= 35")
    phis = explaining.kernel_shap(score, background, examples, names, "k", coalitions, seed=1)
    means = background.agg(*[F.avg(c).alias(c) for c in names]).first().asDict()
    exact = {r["k"]: r for r in explaining.linear_phi(examples, weights, means).collect()}
    rows = phis.collect()
    assert len(rows) == 5 * n
    for r in rows:
        assert r["phi"] == pytest.approx(exact[r["k"]][f"phi_{r['feature']}"], abs=1e-8)
    sums = phis.groupBy("k").agg(F.sum("phi").alias("s"), F.first("score").alias("f"), F.first("base").alias("b"))
    assert all(r["s"] == pytest.approx(r["f"] - r["b"]) for r in sums.collect())
    ranked = [r["feature"] for r in explaining.importance(phis).collect()]
    assert sorted(ranked) == sorted(names)


def test_kernel_shap_adds_up_for_any_model(spark, table):
    model = training.fit_pipeline(table, SPEC, weight="w", C=1.0)
    background = splitting.sample_n(table, 20, "id", 1)
    examples = splitting.sample_n(table, 10, "id", 2)
    phis = explaining.kernel_shap(model.transform, background, examples, ["a", "b", "colour"], "id")
    sums = phis.groupBy("id").agg(F.sum("phi").alias("s"), F.first("score").alias("f"), F.first("base").alias("b")).collect()
    assert len(sums) == 10
    assert all(r["s"] == pytest.approx(r["f"] - r["b"]) and r["f"] in (0.0, 1.0) for r in sums)


def test_kernel_shap_samples_a_large_background(spark):
    df, names, _, score = linear_setup(spark, 2)
    wide = spark.range(2000).select(F.col("id").alias("k"), F.lit(1.0).alias("f0"), F.lit(1.0).alias("f1"))
    phis = explaining.kernel_shap(score, wide, df, names, "k", n_background=5, n_examples=7)
    assert phis.select("k").distinct().count() == 7
    with pytest.raises(ValueError, match="at least one row"):
        explaining.kernel_shap(score, wide.limit(0), df, names, "k")


def test_kernel_shap_keeps_microseconds_and_tells_equal_keys_apart(spark):
    moment = "CAST('2024-05-06 07:08:09.123456' AS TIMESTAMP) AS t"
    same = spark.sql(f"SELECT 1 AS k, {moment}, 1.0D AS x UNION ALL SELECT 1, CAST('2024-05-06 07:08:09.123456' AS TIMESTAMP), 3.0D")
    micros = F.unix_micros("t") % 1000000
    phis = explaining.kernel_shap(lambda d: d.withColumn("prediction", micros + F.col("x")), same.where("x = 1"), same, ["t", "x"], "k")
    found = sorted((r["feature"], round(r["phi"], 6)) for r in phis.collect())
    assert found == [("t", 0.0), ("t", 0.0), ("x", 0.0), ("x", 2.0)]


def test_balanced_fit_equals_the_weighted_one(spark, table):
    from riskflow.operators import splitting

    weighted = splitting.with_class_weight(table, "label")
    one = training.fit_pipeline(weighted, SPEC, weight="weight", C=1.0)
    two = training.fit_pipeline(table, SPEC, C=1.0, balance=True)
    got = [{r["feature"]: r["coefficient"] for r in training.coefficient_table(m).collect()} for m in (one, two)]
    assert got[0].keys() == got[1].keys()
    assert all(abs(got[0][k] - got[1][k]) < 1e-6 for k in got[0])


def test_sparse_features_train_the_same_model(spark, table, monkeypatch, tmp_path):
    dense = training.fit_pipeline(table, SPEC, C=1.0, balance=True)
    monkeypatch.setattr(training, "MAX_DENSE", 0)
    wide = training.fit_pipeline(table, SPEC, C=1.0, balance=True)
    scoring.save_model(wide, scoring.signature(table, SPEC.columns()), str(tmp_path / "wide"))
    again, _ = scoring.load_model(str(tmp_path / "wide"))
    got = [{r["feature"]: r["coefficient"] for r in training.coefficient_table(m).collect()} for m in (dense, again)]
    assert got[0].keys() == got[1].keys()
    assert all(abs(got[0][k] - got[1][k]) < 1e-6 for k in got[0])
    rows = [sorted(map(str, scoring.score(m, table).collect())) for m in (dense, again)]
    assert rows[0] == rows[1]
