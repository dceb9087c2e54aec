"""Training on the executors: weighted L1 logistic regression, whole pipelines, model search."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.columns import hash_slot, quoted, require
from riskflow.operators.encoding import few_values
from riskflow.operators.evaluation import evaluate, prefixed
from riskflow.operators.splitting import with_split
from riskflow.operators.stages import (
    ColumnSelector,
    FeatureVector,
    NumericFeatures,
    NumericFeaturesModel,
    OneHotFeatures,
    OneHotFeaturesModel,
)
from riskflow.plans.shared import materialize

# fixed values: the regularisation constant and the seed of the reference trial
DEFAULT_C = 0.17557554126131178
DEFAULT_SEED = 62545389
#: One-hot values of a stage beyond which its features are sparse vectors.
MAX_DENSE = 256


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns enter the model, by the way they are prepared; vectors are joined in this order."""

    binary: Sequence[str] = ()
    numeric: Sequence[str] = ()
    one_hot: Sequence[str] = ()

    def columns(self) -> list[str]:
        return list(dict.fromkeys([*self.binary, *self.numeric, *self.one_hot]))


def preprocess_stages(spec: FeatureSpec, out: str = "features") -> list:
    """Column selector, one stage per way of preparation, and the stage that joins the parts."""
    stages: list = [ColumnSelector(inputCols=spec.columns())]
    parts = []
    if spec.binary:
        binary = OneHotFeatures(
            inputCols=list(spec.binary), outputCol="_binary", drop="first", unknown="ignore", maxDense=MAX_DENSE
        )
        stages.append(binary)
        parts.append("_binary")
    if spec.numeric:
        stages.append(NumericFeatures(inputCols=list(spec.numeric), outputCol="_numeric"))
        parts.append("_numeric")
    if spec.one_hot:
        one_hot = OneHotFeatures(
            inputCols=list(spec.one_hot), outputCol="_one_hot", unknown="indicator", maxDense=MAX_DENSE
        )
        stages.append(one_hot)
        parts.append("_one_hot")
    if not parts:
        raise ValueError("no feature columns given")
    stages.append(FeatureVector(inputCols=parts, outputCol=out))
    return stages


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Combine columns into one vector column; the others pass through."""
    require(df, cols)
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


def logistic(
    total_weight: float,
    C: float = DEFAULT_C,
    penalty: str = "l1",
    features: str = "features",
    label: str = "label",
    weight: str | None = None,
    max_iter: int = 100,
    tol: float = 1e-6,
) -> LogisticRegression:
    """Estimator whose penalty equals that of the form ``penalty(w) + C * sum(weight * loss)``.

    Spark divides the loss by the sum of the weights, hence regParam = 1 / (C * sum).
    """
    mix = {"l1": 1.0, "l2": 0.0, "none": 0.0}[penalty]
    estimator = LogisticRegression(
        featuresCol=features,
        labelCol=label,
        elasticNetParam=mix,
        regParam=0.0 if penalty == "none" else 1.0 / (C * total_weight),
        standardization=False,
        maxIter=max_iter,
        tol=tol,
    )
    return estimator.setWeightCol(weight) if weight else estimator


def total_weight(df: DataFrame, weight: str | None = None) -> float:
    row = df.agg(F.sum(quoted(weight)) if weight else F.count(F.lit(1))).first()
    if not row[0]:
        raise ValueError("no rows to train on")
    return float(row[0])


def fit_logistic(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    weight: str | None = None,
    C: float = DEFAULT_C,
    penalty: str = "l1",
    max_iter: int = 100,
    tol: float = 1e-6,
):
    """Fit on a table that has a vector column already."""
    return logistic(total_weight(df, weight), C, penalty, features, label, weight, max_iter, tol).fit(df)


def build_pipeline(spec: FeatureSpec, classifier) -> Pipeline:
    return Pipeline(stages=[*preprocess_stages(spec), classifier])


@dataclass
class Preparation:
    """Fitted stages, the weight of a row as an expression, and the sum of the weights."""

    stages: list
    weight: Column
    weight_sum: float

    def transform(self, df: DataFrame) -> DataFrame:
        return PipelineModel(stages=self.stages).transform(df)


def prepare(
    df: DataFrame, spec: FeatureSpec, label: str | None = None, weight: str | None = None, balance: bool = False
) -> Preparation:
    """Fit the stages before the classifier by two jobs, as long as no column has too many values.

    One finds the values of all one-hot columns; the other, one row per class, has the numbers'
    statistics, the class counts and the sum of the weights. ``balance`` weighs rows so that every
    class of ``label`` has the same total; rows without a label then weigh nothing.
    """
    stages = preprocess_stages(spec)
    one_hots = [s for s in stages if isinstance(s, OneHotFeatures)]
    names = list(dict.fromkeys(c for s in one_hots for c in s.getInputCols()))
    require(df, spec.columns())
    texts = few_values(df, names, MAX_DENSE * len(one_hots)) if names else {}
    numbers = next((s for s in stages if isinstance(s, NumericFeatures)), None)
    known_weight = F.lit(1.0) if balance or not weight else F.col(quoted(weight)).cast("double")
    aggs = numbers.aggregates() if numbers else [F.count(F.lit(1)).alias("rows")]
    grouped = df.groupBy(F.col(quoted(label)).alias("_class")) if balance else df.groupBy()
    rows = grouped.agg(*aggs, F.sum(known_weight).alias("_weight")).collect()
    if not sum(r["rows"] for r in rows):
        raise ValueError("no rows to train on")
    row_weight, weight_sum = known_weight, sum(r["_weight"] or 0.0 for r in rows)
    if balance:
        classes = [r for r in rows if r["_class"] is not None]
        weight_sum = float(sum(r["rows"] for r in classes))
        row_weight = F.lit(0.0)
        for r in classes:
            share = F.lit(weight_sum / (len(classes) * r["rows"]))
            row_weight = F.when(F.col(quoted(label)) == F.lit(r["_class"]), share).otherwise(row_weight)
    fitted = []
    for stage in stages:
        if stage is numbers:
            fitted.append(stage.model_of(_merged(rows, len(stage.getInputCols()))))
        elif isinstance(stage, OneHotFeatures):
            own = None if texts is None else {c: texts[c] for c in stage.getInputCols()}
            if own is None:
                own = few_values(df, stage.getInputCols(), MAX_DENSE)
            elif sum(map(len, own.values())) > MAX_DENSE:
                own = None
            fitted.append(stage.model_of(df, own))
        else:
            fitted.append(stage)
    return Preparation(fitted, row_weight, weight_sum)


def _merged(rows: Sequence[Row], n_columns: int) -> dict[str, float]:
    """Counts, means and population variances of all groups together."""
    out: dict[str, float] = {"rows": sum(r["rows"] for r in rows)}
    for i in range(n_columns):
        parts = [(r[f"n{i}"], r[f"m{i}"], r[f"v{i}"]) for r in rows if r[f"n{i}"]]
        n = sum(p[0] for p in parts)
        mean = sum(k * m for k, m, _ in parts) / n if n else None
        spread = sum(k * (v + (m - mean) ** 2) for k, m, v in parts) / n if n else None
        out |= {f"n{i}": n, f"m{i}": mean, f"v{i}": spread}
    return out


def _fit(df: DataFrame, spec: FeatureSpec, label: str, classifier: Callable, weight: str | None, balance: bool) -> PipelineModel:
    """Stages and classifier; the prepared features are stored once, and all the optimiser reads."""
    found = prepare(df, spec, label, weight, balance)
    weighted = found.transform(df.withColumn("_weight", found.weight))
    if balance:
        weighted = weighted.where(F.col(quoted(label)).isNotNull())
    stored = materialize(weighted.select(F.col(quoted(label)).alias(label), "_weight", "features"), "prepared")
    return PipelineModel(stages=[*found.stages, classifier(found.weight_sum).fit(stored)])


def fit_pipeline(
    df: DataFrame,
    spec: FeatureSpec,
    label: str = "label",
    weight: str | None = None,
    C: float = DEFAULT_C,
    penalty: str = "l1",
    balance: bool = False,
) -> PipelineModel:
    """Selector, preparation and classifier as one model, by three scans of ``df``.

    ``balance`` gives every class the same total weight, without a weight column.
    """
    return _fit(
        df, spec, label, lambda total: logistic(total, C, penalty, label=label, weight="_weight"), weight, balance
    )


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the slots of the feature vector, in order."""
    names: list[str] = []
    for stage in model.stages:
        if isinstance(stage, (NumericFeaturesModel, OneHotFeaturesModel)):
            names += stage.feature_names()
    return names


def coefficient_table(model: PipelineModel) -> DataFrame:
    """(feature, coefficient) rows of a fitted logistic model, the intercept included.

    The coefficients are on the driver anyway; names of values kept as a table join them there.
    """
    spark = SparkSession.active()
    fitted = model.stages[-1]
    stages = [s for s in model.stages if isinstance(s, (NumericFeaturesModel, OneHotFeaturesModel))]
    intercept = [("(intercept)", float(fitted.intercept))]
    if not any(isinstance(s, OneHotFeaturesModel) and s.domain() is not None for s in stages):
        rows = [(n, float(c)) for n, c in zip(feature_names(model), fitted.coefficients.toArray())]
        return spark.createDataFrame(rows + intercept, "feature string, coefficient double")
    names, begin = [], 0
    for stage in stages:
        if isinstance(stage, OneHotFeaturesModel):
            table, width = stage.feature_table(), stage.n_slots()
        else:
            width = len(stage.feature_names())
            table = spark.createDataFrame(list(enumerate(stage.feature_names())), "slot bigint, feature string")
        names.append(table.withColumn("slot", F.col("slot") + begin))
        begin += width
    values = pa.table({"slot": pa.array(range(begin), pa.int64()), "coefficient": pa.array(fitted.coefficients.toArray())})
    named = reduce(DataFrame.unionByName, names).join(spark.createDataFrame(values), "slot")
    return named.select("feature", "coefficient").unionByName(
        spark.createDataFrame(intercept, "feature string, coefficient double")
    )


# --- model search ------------------------------------------------------------

# fixed values: a small grid around the trial above
DEFAULT_GRID = (
    {"family": "logistic", "C": DEFAULT_C, "penalty": "l1"},
    {"family": "logistic", "C": 1.0, "penalty": "l1"},
    {"family": "logistic", "C": 1.0, "penalty": "l2"},
    {"family": "decision_tree", "max_depth": 3},
    {"family": "random_forest", "max_depth": 5, "trees": 20},
)

TRIAL_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("params", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("train_f1", T.DoubleType()),
        T.StructField("val_f1", T.DoubleType()),
        T.StructField("test_f1", T.DoubleType()),
        T.StructField("detail", T.StringType()),
    ]
)


@dataclass
class SearchResult:
    trials: DataFrame
    model: PipelineModel | None
    best: dict | None
    metrics: DataFrame | None = field(default=None)


def _classifier(trial: Mapping[str, object], weight_sum: float, label: str, weight: str | None, seed: int):
    family = trial["family"]
    if family == "logistic":
        return logistic(
            weight_sum,
            float(trial.get("C", DEFAULT_C)),
            str(trial.get("penalty", "l1")),
            label=label,
            weight=weight,
            max_iter=int(trial.get("max_iter", 100)),
        )
    common = {"featuresCol": "features", "labelCol": label, "seed": seed, "maxDepth": int(trial.get("max_depth", 5))}
    if weight:
        common["weightCol"] = weight
    if family == "decision_tree":
        return DecisionTreeClassifier(**common)
    if family == "random_forest":
        return RandomForestClassifier(numTrees=int(trial.get("trees", 20)), **common)
    raise ValueError(f"unknown model family {family!r}")


def _prepared_parts(
    df: DataFrame, label: str, spec: FeatureSpec, key: str, seed: int, stratify: bool
) -> tuple[DataFrame, Preparation, DataFrame]:
    """(labelled rows, stages fitted on the training part, stored features of all parts).

    The stored table has the label, ``split``, ``weight``, ``slot`` (0..9999, a hash of the key) and ``features``.
    """
    require(df, [label, key, *spec.columns()])
    labelled = df.where(F.col(quoted(label)).isNotNull())
    labelled = labelled.withColumn(label, F.col(quoted(label)).cast("double"))
    parts = with_split(labelled, key, seed, stratify=label if stratify else None)
    in_train = F.col("split") == "train"
    preparation = prepare(parts.where(in_train), spec, label, balance=True)
    # only training rows weigh other than 1
    weighted = parts.withColumn("weight", F.when(in_train, preparation.weight).otherwise(F.lit(1.0)))
    weighted = weighted.withColumn("slot", hash_slot(F.col(quoted(key)), seed + 1))
    # stored, not cached: all trials read it, and it outlives the executors
    columns = [label, "split", "weight", "slot", "features"]
    return labelled, preparation, materialize(preparation.transform(weighted).select(*columns), "prepared")


def search(
    df: DataFrame,
    label: str,
    spec: FeatureSpec,
    key: str,
    grid: Sequence[Mapping[str, object]] = DEFAULT_GRID,
    max_trials: int | None = None,
    timeout_s: float | None = None,
    parallelism: int = 2,
    seed: int = 0,
    stratify: bool = False,
    refit: bool = False,
) -> SearchResult:
    """Fit one model per grid entry and keep the one with the highest F1 on the validation part.

    Rows are split by the hash of their key and weighted so that classes count the same
    in training. The prepared features are stored for all trials. Entries past ``max_trials``, and
    those whose turn comes after ``timeout_s``, are reported as SKIPPED; there is no limit by
    default. ``metrics`` has (run_id, name, value) of every finished trial, train weighted, the
    other parts not. With ``refit`` the winner is trained again on all rows.
    """
    labelled, preparation, prepared = _prepared_parts(df, label, spec, key, seed, stratify)
    train = prepared.where(F.col("split") == "train")
    weight_sum = preparation.weight_sum
    start = time.monotonic()

    def run(index: int, trial: Mapping[str, object]):
        row = {
            "run_id": f"trial-{index:03d}",
            "family": str(trial["family"]),
            "params": json.dumps({k: v for k, v in trial.items() if k != "family"}, sort_keys=True),
            "status": "SKIPPED",
        }
        if (max_trials is not None and index >= max_trials) or (timeout_s is not None and time.monotonic() - start > timeout_s):
            return row, None, []
        try:
            fitted = _classifier(trial, weight_sum, label, "weight", seed).fit(train)
            # only training rows have a weight other than 1
            found = prefixed(evaluate(fitted.transform(prepared), label, "prediction", weight="weight")).collect()
        except (PySparkException, ValueError) as error:
            return {**row, "status": "FAILED", "detail": str(error)}, None, []
        values = {r["name"]: r["value"] for r in found}
        scores = {f"{p}_f1": values.get(f"{p}_f1", 0.0) for p in ("train", "val", "test")}
        named = [(row["run_id"], name, value) for name, value in sorted(values.items())]
        return {**row, "status": "FINISHED", **scores}, fitted, named

    chosen = list(grid)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        outcomes = list(pool.map(run, range(len(chosen)), chosen))

    spark = df.sparkSession
    rows = [{f.name: row.get(f.name) for f in TRIAL_SCHEMA} for row, _, _ in outcomes]
    trials = spark.createDataFrame([tuple(r.values()) for r in rows], TRIAL_SCHEMA)
    measured = [m for _, _, named in outcomes for m in named]
    metrics = spark.createDataFrame(measured, "run_id string, name string, value double")
    finished = [(row, fitted) for row, fitted, _ in outcomes if fitted is not None]
    if not finished:
        return SearchResult(trials, None, None, metrics)
    best, fitted = min(finished, key=lambda o: (-o[0]["val_f1"], o[0]["run_id"]))
    model = PipelineModel(stages=[*preparation.stages, fitted])
    if refit:
        settings = {"family": best["family"], **json.loads(best["params"])}
        model = _fit(
            labelled, spec, label, lambda total: _classifier(settings, total, label, "_weight", seed), None, balance=True
        )
    return SearchResult(trials, model, best, metrics)


def search_halving(
    df: DataFrame,
    label: str,
    spec: FeatureSpec,
    key: str,
    grid: Sequence[Mapping[str, object]] = DEFAULT_GRID,
    shares: Sequence[float] = (0.25, 0.5, 1.0),
    parallelism: int = 2,
    seed: int = 0,
    stratify: bool = False,
) -> SearchResult:
    """search() with less effort: entries meet growing shares of the training rows, the better half goes on.

    The shares are nested, by a hash of the key, and the last must be 1. After each but the last,
    the half (rounded up) with the highest validation F1 stays, ties by the order of the grid; entries that
    fail on a share go on, as that may be too small for them. ``trials`` has every entry once, with
    ``share`` the last one it met, its status (``STOPPED`` for those that did not go on) and validation F1
    there; the model is the best of those that met all rows.
    """
    if not shares or shares[-1] != 1.0 or list(shares) != sorted(set(shares)):
        raise ValueError("shares must rise and end with 1")
    _, preparation, prepared = _prepared_parts(df, label, spec, key, seed, stratify)
    val = prepared.where(F.col("split") == "val")
    rows = [
        {"run_id": f"trial-{i:03d}", "family": str(t["family"]), "params": json.dumps({k: v for k, v in t.items() if k != "family"}, sort_keys=True)}
        for i, t in enumerate(grid)
    ]
    alive, fitted = list(range(len(rows))), {}
    for share in shares:
        train = prepared.where((F.col("split") == "train") & (F.col("slot") < round(share * 10_000)))
        weight_sum = preparation.weight_sum if share == 1.0 else float(train.agg(F.sum("weight")).first()[0] or 0.0)

        def run(index: int):
            try:
                model = _classifier(grid[index], weight_sum, label, "weight", seed).fit(train)
                return model, evaluate(model.transform(val), label, "prediction", by=None).first()["f1"], None
            except (PySparkException, ValueError, ZeroDivisionError) as error:
                return None, None, str(error)

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            outcomes = dict(zip(alive, pool.map(run, alive)))
        for index, (model, f1, detail) in outcomes.items():
            status = "FAILED" if model is None else "FINISHED"
            rows[index] |= {"status": status, "share": share, "val_f1": f1, "detail": detail}
            fitted[index] = model
        if share == 1.0:
            break
        ranked = sorted((i for i in alive if fitted[i] is not None), key=lambda i: (-rows[i]["val_f1"], i))
        ahead = ranked[: (len(ranked) + 1) // 2]
        for index in ranked[len(ahead) :]:
            rows[index]["status"] = "STOPPED"
        alive = sorted([*ahead, *(i for i in alive if fitted[i] is None)])
    schema = "run_id string, family string, params string, status string, share double, val_f1 double, detail string"
    names = [part.split()[0] for part in schema.split(", ")]
    trials = df.sparkSession.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
    finished = [i for i in alive if rows[i]["status"] == "FINISHED"]
    if not finished:
        return SearchResult(trials, None, None)
    best = min(finished, key=lambda i: (-rows[i]["val_f1"], i))
    return SearchResult(trials, PipelineModel(stages=[*preparation.stages, fitted[best]]), rows[best])


def probability_of_one(df: DataFrame, out: str = "score", column: str = "probability") -> DataFrame:
    """The probability of label 1 as a plain number."""
    return df.withColumn(out, vector_to_array(column)[1])
