"""Trained models. Results depend on an optimiser, so most have no SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow import workflow
from riskflow.operators import cleaning, evaluation, explaining, folds, foreign, gate, runlog, scoring, splitting, training
from riskflow.operators import tags as tag_store
from riskflow.plans.shared import new_path
from riskflow.queries.evaluation import SCORED, scored
from riskflow.queries.registry import incidents, query, rounded, table
from riskflow.queries.splitting import FOLDS_SQL, split_sql
from riskflow.queries.tables import ORDER_SCHEMA
from riskflow.streaming.quarantine import score_or_set_aside
from riskflow.streaming.scoring import read_arriving, score_stream

SPEC = training.FeatureSpec(binary=["quality"], numeric=["n_chars"], one_hot=["lang", "source"])
LINE_SPEC = training.FeatureSpec(binary=["l_linestatus"], numeric=["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
ORDER_SPEC = training.FeatureSpec(numeric=["o_totalprice"], one_hot=["o_orderpriority"])


def labelled(spark, sf_dir):
    rows = cleaning.drop_missing(incidents(spark, sf_dir))
    return rows.withColumn("label", F.col("toxic").cast("double")).drop("toxic")


def _orders_model(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("label", (F.col("o_orderstatus") == "F").cast("double"))
    return training.fit_pipeline(orders, ORDER_SPEC, C=1.0, balance=True), orders


def _incident_model(spark, sf_dir):
    rows = splitting.with_split(labelled(spark, sf_dir), "doc_id")
    return training.fit_pipeline(rows.where(F.col("split") == "train"), SPEC, C=1.0, balance=True), rows


@query("train_logistic")
def train_logistic(spark, sf_dir):
    """Weighted L1 logistic regression over all lines: returned or not."""
    lineitem = table(spark, sf_dir, "lineitem").withColumn("label", (F.col("l_returnflag") == "R").cast("double"))
    model = training.fit_pipeline(lineitem, LINE_SPEC, balance=True)
    return training.coefficient_table(model)


# One 0/1 feature: the optimum of the weighted L1 problem with C = 1 is known. With the weighted
# positives of each side, p1 = (positives of x=1 - sign) / weight of x=1 and p0 = (positives of
# x=0 + sign) / weight of x=0, unless that would turn the slope's sign; then the slope is 0.
_BINARY = """
  r AS (SELECT o_orderkey, (o_orderpriority <= '2-HIGH')::INT AS x, (o_orderstatus = 'F')::INT AS y FROM orders),
  n AS (SELECT count(*)::DOUBLE AS n, sum(y)::DOUBLE AS pos FROM r),
  g AS (SELECT sum(w) FILTER (x = 1) AS w1, sum(w) FILTER (x = 0) AS w0, coalesce(sum(w) FILTER (x = 1 AND y = 1), 0) AS y1,
               coalesce(sum(w) FILTER (x = 0 AND y = 1), 0) AS y0
        FROM (SELECT x, y, CASE WHEN y = 1 THEN n / (2 * pos) ELSE n / (2 * (n - pos)) END AS w FROM r, n)),
  s AS (SELECT *, CASE WHEN (y1 - 1) / w1 > (y0 + 1) / w0 THEN 1 WHEN (y1 + 1) / w1 < (y0 - 1) / w0 THEN -1 ELSE 0 END AS sign FROM g),
  p AS (SELECT CASE WHEN sign = 0 THEN (y1 + y0) / (w1 + w0) ELSE (y1 - sign) / w1 END AS p1,
               CASE WHEN sign = 0 THEN (y1 + y0) / (w1 + w0) ELSE (y0 + sign) / w0 END AS p0 FROM s)"""


def _binary_model(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumns(
        {
            "label": (F.col("o_orderstatus") == "F").cast("double"),
            "urgent": (F.col("o_orderpriority") <= "2-HIGH").cast("int"),
        }
    )
    spec = training.FeatureSpec(binary=["urgent"])
    return training.fit_pipeline(orders, spec, C=1.0, balance=True), orders


@query(
    "train_logistic_binary",
    f"""WITH {_BINARY} SELECT 'urgent_1' AS feature, round(ln(p1 / (1 - p1)) - ln(p0 / (1 - p0)), 3) + 0.0 AS coefficient FROM p
        UNION ALL SELECT '(intercept)', round(ln(p0 / (1 - p0)), 3) + 0.0 FROM p""",
)
def train_logistic_binary(spark, sf_dir):
    """Coefficients against the closed form of the optimum."""
    model, _ = _binary_model(spark, sf_dir)
    found = training.coefficient_table(model)
    return found.select("feature", (F.round("coefficient", 3) + 0.0).alias("coefficient"))


_BINARY_PREDICTION = f"""(WITH {_BINARY} SELECT o_orderkey, CASE WHEN (CASE WHEN x = 1 THEN p1 ELSE p0 END) > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction,
                         y FROM r, p)"""


@query("score_batch_binary", f"SELECT o_orderkey, prediction FROM {_BINARY_PREDICTION}")
def score_batch_binary(spark, sf_dir):
    """A stored, reloaded model's predictions, as written."""
    model, rows = _binary_model(spark, sf_dir)
    path = new_path(spark, "model")
    scoring.save_model(model, scoring.signature(rows, ["urgent"]), path)
    again, _ = scoring.load_model(path)
    return scoring.score_to_table(again, rows, "o_orderkey", new_path(spark, "predictions"))


@query(
    "evaluate_binary",
    f"""SELECT count(*) FILTER (y = 1 AND prediction = 1) AS tp, count(*) FILTER (y = 0 AND prediction = 1) AS fp,
               count(*) FILTER (y = 0 AND prediction = 0) AS tn, count(*) FILTER (y = 1 AND prediction = 0) AS fn FROM {_BINARY_PREDICTION}""",
)
def evaluate_binary(spark, sf_dir):
    """Train, score and measure in one go."""
    model, rows = _binary_model(spark, sf_dir)
    return evaluation.evaluate(model.transform(rows), "label", "prediction", by=None).select("tp", "fp", "tn", "fn")


@query("train_and_evaluate")
def train_and_evaluate(spark, sf_dir):
    """Label, clean, split, weigh, fit, score, and measure each part."""
    model, rows = _incident_model(spark, sf_dir)
    result = training.probability_of_one(model.transform(rows))
    return evaluation.evaluate(result, "label", "prediction", "score")


@query("model_search")
def model_search(spark, sf_dir):
    found = training.search(labelled(spark, sf_dir), "label", SPEC, "doc_id", stratify=True)
    return found.trials.drop("detail")


@query("score_batch")
def score_batch(spark, sf_dir):
    """A stored and reloaded model over the whole table, written with its prediction."""
    model, rows = _orders_model(spark, sf_dir)
    path = new_path(spark, "model")
    scoring.save_model(model, scoring.signature(rows, ORDER_SPEC.columns()), path)
    again, _ = scoring.load_model(path)
    target = new_path(spark, "predictions")
    scoring.score_to_table(again, rows, "o_orderkey", target)
    return spark.read.parquet(target)


@query("predicts_check", "SELECT 'v1' AS version, 'predicts' AS \"check\", '1' AS value, count(*) || ' of ' || count(*) || ' rows scored' AS detail FROM orders")
def predicts_check(spark, sf_dir):
    model, rows = _orders_model(spark, sf_dir)
    return gate.predicts_check("v1", model, rows)


@query("validation_checks")
def validation_checks(spark, sf_dir):
    """All checks of a trained model version, one row each."""
    model, rows = _incident_model(spark, sf_dir)
    schema = scoring.signature(rows, SPEC.columns())
    description = "Predicts whether a document is toxic from its length, language and source."
    return gate.run_checks("v1", model, rows, schema, "label", "lang", description)


@query("kernel_shap")
def kernel_shap(spark, sf_dir):
    """Attribution of the predicted class, background from train, examples from validation."""
    rows = splitting.with_split(labelled(spark, sf_dir), "doc_id")
    train = splitting.with_class_weight(rows.where(F.col("split") == "train"), "label")
    model = training.fit_pipeline(train, SPEC, weight="weight", C=1.0)
    features = SPEC.columns()
    background = splitting.sample_n(train, 100, "doc_id", training.DEFAULT_SEED)
    examples = splitting.sample_n(rows.where(F.col("split") == "val"), 100, "doc_id", training.DEFAULT_SEED)
    phis = explaining.kernel_shap(model.transform, background, examples, features, "doc_id")
    return phis.select("doc_id", "feature", "phi")


@query(
    "get_or_train",
    "SELECT 'documents' AS name, count(*) AS n_rows FROM labels JOIN documents USING (doc_id)",
)
def get_or_train(spark, sf_dir):
    """The second call finds the run the first one logged."""
    path = new_path(spark, "log")

    def train():
        row = evaluation.evaluate(scored(spark, sf_dir), "label", "prediction", by=None).first()
        return {"status": "FINISHED", "val_f1": row["f1"], "n_rows": row["n"]}

    runlog.get_or_train(spark, path, "documents", train)
    return runlog.get_or_train(spark, path, "documents", train).select("name", F.col("n_rows").cast("bigint").alias("n_rows"))


@query("stream_score")
def stream_score(spark, sf_dir):
    """The order table as a stream, scored once, read back."""
    model, _ = _orders_model(spark, sf_dir)
    # a stream wants a folder; as a glob the path may also be a single file
    rows = read_arriving(spark, f"{sf_dir}/orders.parque[t]", ORDER_SCHEMA)
    sink, checkpoint = new_path(spark, "scored"), new_path(spark, "progress")
    score_stream(model, rows, sink, checkpoint).awaitTermination()
    return spark.read.parquet(sink)


@query("stream_score_binary", f"SELECT o_orderkey, prediction FROM {_BINARY_PREDICTION}")
def stream_score_binary(spark, sf_dir):
    """The stream's predictions against the closed form of the optimum."""
    model, _ = _binary_model(spark, sf_dir)
    arriving = read_arriving(spark, f"{sf_dir}/orders.parque[t]", ORDER_SCHEMA)
    rows = arriving.withColumn("urgent", (F.col("o_orderpriority") <= "2-HIGH").cast("int"))
    sink, checkpoint = new_path(spark, "scored"), new_path(spark, "progress")
    score_stream(model, rows, sink, checkpoint).awaitTermination()
    return spark.read.parquet(sink).select("o_orderkey", "prediction")


def _urgent_orders(spark, sf_dir):
    """One 0/1 feature, and a label that equals it for seven of ten rows."""
    urgent = F.col("o_orderpriority") <= "2-HIGH"
    return table(spark, sf_dir, "orders").withColumns(
        {"urgent": urgent.cast("int"), "label": (urgent != (F.col("o_orderkey") % 10 < 3)).cast("double")}
    )


URGENT = """(SELECT *, (o_orderpriority <= '2-HIGH')::INT AS x, ((o_orderpriority <= '2-HIGH') <> (o_orderkey % 10 < 3))::INT AS y FROM orders)"""

# The search over two penalties of a one-feature model whose label is the feature for seven of ten
# rows: no penalty cancels the slope.
_SEARCHED = f"""
  a AS (SELECT o_orderkey, (o_orderpriority <= '2-HIGH')::INT AS x,
               ((o_orderpriority <= '2-HIGH') <> (o_orderkey % 10 < 3))::INT AS y, {split_sql('o_orderkey')} AS split FROM orders),
  n AS (SELECT count(*)::DOUBLE AS n, sum(y)::DOUBLE AS pos FROM a WHERE split = 'train'),
  w AS (SELECT a.*, CASE WHEN split <> 'train' THEN 1.0::DOUBLE WHEN y = 1 THEN n / (2 * pos) ELSE n / (2 * (n - pos)) END AS w FROM a, n),
  g AS (SELECT sum(w) FILTER (x = 1) AS w1, sum(w) FILTER (x = 0) AS w0, coalesce(sum(w) FILTER (x = 1 AND y = 1), 0) AS y1,
               coalesce(sum(w) FILTER (x = 0 AND y = 1), 0) AS y0 FROM w WHERE split = 'train'),
  c AS (SELECT * FROM (VALUES ('trial-000', 1.0::DOUBLE), ('trial-001', 0.1::DOUBLE)) c(run_id, c)),
  s AS (SELECT run_id, c, g.*, CASE WHEN (y1 - 1 / c) / w1 > (y0 + 1 / c) / w0 THEN 1 WHEN (y1 + 1 / c) / w1 < (y0 - 1 / c) / w0 THEN -1 ELSE 0 END AS sign FROM g, c),
  p AS (SELECT run_id, CASE WHEN sign = 0 THEN (y1 + y0) / (w1 + w0) ELSE (y1 - sign / c) / w1 END AS p1,
               CASE WHEN sign = 0 THEN (y1 + y0) / (w1 + w0) ELSE (y0 + sign / c) / w0 END AS p0 FROM s),
  f AS (SELECT run_id, split, coalesce(2 * sum(w) FILTER (y = 1 AND hit) / nullif(2 * sum(w) FILTER (y = 1 AND hit)
               + sum(w) FILTER (y <> hit::INT), 0), 0) AS f1
        FROM (SELECT run_id, w.*, CASE WHEN x = 1 THEN p1 ELSE p0 END > 0.5 AS hit FROM w, p) GROUP BY run_id, split)"""


@query(
    "model_search_binary",
    f"""WITH {_SEARCHED} SELECT run_id, 'logistic' AS family, 'FINISHED' AS status,
        round(coalesce(max(f1) FILTER (split = 'train'), 0), 6) AS train_f1, round(coalesce(max(f1) FILTER (split = 'val'), 0), 6) AS val_f1,
        round(coalesce(max(f1) FILTER (split = 'test'), 0), 6) AS test_f1 FROM f GROUP BY run_id""",
)
def model_search_binary(spark, sf_dir):
    """A search whose trials have a closed form."""
    orders = _urgent_orders(spark, sf_dir)
    grid = [{"family": "logistic", "C": c, "penalty": "l1"} for c in (1.0, 0.1)]
    found = training.search(orders, "label", training.FeatureSpec(binary=["urgent"]), "o_orderkey", grid)
    return rounded(found.trials.select("run_id", "family", "status", "train_f1", "val_f1", "test_f1"), 6, "train_f1", "val_f1", "test_f1")


_SLICED = f"""(SELECT o_orderpriority, count(*) FILTER (WHERE y = prediction) / count(*) AS a
               FROM {_BINARY_PREDICTION} JOIN orders USING (o_orderkey) GROUP BY 1)"""


@query(
    "gate_roundtrip",
    f"""WITH t AS (SELECT CASE WHEN min(a) >= 0.55 THEN 'pass' ELSE 'fail' END AS slice_test FROM {_SLICED})
        SELECT 'v1' AS version, '1' AS has_description, '1' AS has_signature, '1' AS predicts, slice_test,
               CASE WHEN slice_test = 'pass' THEN 'accept' ELSE 'reject' END AS decision,
               (CASE WHEN slice_test = 'pass' THEN 0 ELSE 1 END)::VARCHAR AS n_failed FROM t
        UNION ALL SELECT 'v2', '0', '1', '1', 'none', 'reject', '1' FROM t""",
)
def gate_roundtrip(spark, sf_dir):
    """Tags say how a version is checked, checks and decision become tags; the second version has no slices."""
    model, rows = _binary_model(spark, sf_dir)
    features, path, tags = new_path(spark, "features"), new_path(spark, "model"), new_path(spark, "tags")
    rows.write.parquet(features)
    scoring.save_model(model, scoring.signature(rows, ["urgent"]), path)
    tag_store.set_tags(spark, tags, "v1", {"slice_cols": "o_orderstatus", "description": "Is an order finished?"})
    tag_store.set_tags(spark, tags, "v1", {"slice_cols": "o_orderpriority"})  # the newer one holds
    tag_store.set_tags(spark, tags, "v2", {"slice_cols": "o_orderstatus", "description": "short"})
    tag_store.set_tags(spark, tags, "v2", {"slice_cols": None})
    plan = workflow.RiskTable(key="o_orderkey", label="label")
    for version in ("v1", "v2"):
        workflow.validate(spark, version, features, path, None, plan, tags=tags)
    return tag_store.tags_wide(tag_store.read_tags(spark, tags), [*gate.CHECKS, "decision", "n_failed"])


@query(
    "search_halving_binary",
    f"""WITH v AS (SELECT round(2 * count(*) FILTER (x = 1 AND y = 1) / (2 * count(*) FILTER (x = 1 AND y = 1) + count(*) FILTER (x <> y)), 6) AS f1
                   FROM {URGENT} WHERE {split_sql('o_orderkey')} = 'val')
        SELECT run_id, status, share, f1 AS val_f1 FROM v, (VALUES ('trial-000', 'FINISHED', 1.0::DOUBLE), ('trial-001', 'STOPPED', 0.5::DOUBLE),
          ('trial-002', 'STOPPED', 0.25::DOUBLE), ('trial-003', 'STOPPED', 0.25::DOUBLE)) t(run_id, status, share)""",
)
def search_halving_binary(spark, sf_dir):
    """Four entries with the same predictions: the order of the grid decides who goes on."""
    grid = [{"family": "logistic", "C": c, "penalty": p} for c in (1.0, 0.1) for p in ("l1", "l2")]
    spec = training.FeatureSpec(binary=["urgent"])
    found = training.search_halving(_urgent_orders(spark, sf_dir), "label", spec, "o_orderkey", grid)
    return rounded(found.trials.select("run_id", "status", "share", "val_f1"), 6, "val_f1")


@query(
    "cross_validated",
    f"""SELECT fold, count(*) FILTER (x = 1 AND y = 1) AS tp, count(*) FILTER (x = 1 AND y = 0) AS fp, count(*) FILTER (x = 0 AND y = 0) AS tn,
               count(*) FILTER (x = 0 AND y = 1) AS fn, count(*) AS n, round((count(*) FILTER (x = y)) / count(*), 6) AS accuracy
        FROM {URGENT} JOIN {FOLDS_SQL} USING (o_custkey) GROUP BY fold""",
)
def cross_validated(spark, sf_dir):
    """Each fold measured by a model of the other four; the feature is what every one of them predicts."""
    spec = training.FeatureSpec(binary=["urgent"])
    found = folds.cross_validate(_urgent_orders(spark, sf_dir), "label", spec, "o_custkey", 5)
    return rounded(found.select("fold", "tp", "fp", "tn", "fn", "n", "accuracy"), 6, "accuracy")


def _numpy_logistic(columns):
    import numpy as np

    margin = -0.2 + columns["length_k"] * 0.1 + columns["quality"] * -0.1
    return 1 / (1 + np.exp(-margin))


@query("foreign_model_score", f"SELECT doc_id, score, prediction FROM {SCORED}")
def foreign_model_score(spark, sf_dir):
    """The fixed model as a stored numpy function, over Arrow batches."""
    rows = cleaning.drop_missing(incidents(spark, sf_dir)).withColumn("length_k", F.col("n_chars") / 1000)
    contract = T.StructType([T.StructField("length_k", T.DoubleType()), T.StructField("quality", T.IntegerType())])
    path = new_path(spark, "foreign")
    foreign.save_foreign(foreign.ForeignModel(_numpy_logistic, contract), path)
    result = foreign.score_foreign(foreign.load_foreign(spark, path), rows, "score").withColumn("score", F.round("score", 6))
    return result.select("doc_id", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("prediction"))


@query(
    "stream_quarantine",
    f"""SELECT o_orderkey, o_orderkey % 10 < 2 AS set_aside, CASE WHEN o_orderkey % 10 >= 2 THEN prediction END AS prediction,
               CASE o_orderkey % 10 WHEN 0 THEN 'urgent is no int' WHEN 1 THEN 'urgent is missing' END AS contract_breach
        FROM {_BINARY_PREDICTION}""",
)
def stream_quarantine(spark, sf_dir):
    """A stream in which a fifth of the rows breaks the model's contract."""
    model, _ = _binary_model(spark, sf_dir)
    contract = T.StructType([T.StructField("urgent", T.IntegerType(), False)])
    arriving = read_arriving(spark, f"{sf_dir}/orders.parque[t]", ORDER_SCHEMA)
    turn = F.col("o_orderkey") % 10
    urgent = F.when(turn == 0, "n/a").when(turn != 1, (F.col("o_orderpriority") <= "2-HIGH").cast("int").cast("string"))
    sink, aside, checkpoint = (new_path(spark, name) for name in ("scored", "aside", "progress"))
    score_or_set_aside(model, arriving.withColumn("urgent", urgent), contract, sink, aside, checkpoint).awaitTermination()
    good = spark.read.parquet(sink).select("o_orderkey", F.lit(False).alias("set_aside"), "prediction")
    bad = spark.read.parquet(aside).select("o_orderkey", F.lit(True).alias("set_aside"), "contract_breach")
    return good.unionByName(bad, allowMissingColumns=True)
