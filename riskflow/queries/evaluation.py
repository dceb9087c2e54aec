"""Metrics, curves and attribution on scores of a fixed model."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskflow.operators import cleaning, evaluation, explaining, profiling, scoring, splitting
from riskflow.queries.registry import INCIDENTS, incidents, query, rounded, table
from riskflow.queries.splitting import split_sql

# labelled documents, label = toxic, scored by a logistic model with given coefficients
SCORED = f"""(
  SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM (
    SELECT doc_id, lang, source, quality, toxic AS label,
           round(1 / (1 + exp(-(-0.2 + n_chars / 1000.0 * 0.1 + quality * -0.1))), 6) AS score
    FROM {INCIDENTS} WHERE toxic IS NOT NULL))"""

# lines, label = returned, scored the same way
LINES = """(
  SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM (
    SELECT l_linestatus, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
           round(1 / (1 + exp(-(0.4 + l_quantity * -0.02 + l_discount * 3.0))), 6) AS score
    FROM lineitem))"""


def scored(spark, sf_dir):
    rows = cleaning.drop_missing(incidents(spark, sf_dir)).withColumn("length_k", F.col("n_chars") / 1000)
    result = scoring.score_fixed(rows, -0.2, {"length_k": 0.1, "quality": -0.1})
    return result.select("doc_id", "lang", "source", "quality", F.col("toxic").alias("label"), "score", "prediction")


def lines(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_linestatus", "l_linenumber", "l_returnflag", "l_quantity", "l_discount")
    result = scoring.score_fixed(rows, 0.4, {"l_quantity": -0.02, "l_discount": 3.0})
    label = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    return result.withColumn("label", label).select("l_linestatus", "l_linenumber", "label", "score", "prediction")


@query("fixed_model_score", f"SELECT doc_id, score, prediction FROM {SCORED}")
def fixed_model_score(spark, sf_dir):
    return scored(spark, sf_dir).select("doc_id", "score", "prediction")


@query("correct_flag", f"SELECT doc_id, CASE WHEN label = prediction THEN 1 ELSE 0 END AS correct FROM {SCORED}")
def correct_flag(spark, sf_dir):
    return cleaning.with_correct(scored(spark, sf_dir), "label", "prediction").select("doc_id", "correct")


@query(
    "confusion",
    f"""SELECT l.v AS label, p.v AS prediction,
        (SELECT count(*) FROM {LINES} s WHERE s.label = l.v AND s.prediction = p.v) AS n
        FROM (VALUES (0), (1)) l(v), (VALUES (0), (1)) p(v)""",
)
def confusion(spark, sf_dir):
    return evaluation.confusion(lines(spark, sf_dir), "label", "prediction")


@query(
    "confusion_any_label",
    """SELECT label, prediction, count(*) AS n FROM (
         SELECT l_discount AS label, round(l_quantity / 50, 1) AS prediction FROM lineitem)
       GROUP BY label, prediction
       UNION ALL SELECT l.v, p.v, 0 FROM (VALUES (0.5::DOUBLE), (1.9::DOUBLE)) l(v), (VALUES (0.5::DOUBLE), (1.9::DOUBLE)) p(v)""",
)
def confusion_any_label(spark, sf_dir):
    """Fractional labels stay apart, classes that do not occur are there with 0."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_discount").alias("label"), F.round(F.col("l_quantity") / 50, 1).alias("prediction")
    )
    return evaluation.confusion(rows, "label", "prediction", classes=(0.5, 1.9))


def _metrics_sql(rows: str, by: str) -> str:
    return f"""WITH c AS (
      SELECT {by}, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
             count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
             count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
             count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) AS n,
             avg(CASE WHEN label = 1 THEN -ln(score) ELSE -ln(1 - score) END) AS loss
      FROM {rows} GROUP BY {by})
    SELECT {by}, tp, fp, tn, fn, n, round((tp + tn) / n, 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision",
           round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
           round(loss, 6) AS log_loss FROM c"""


_METRICS = ("accuracy", "precision", "recall", "f1", "log_loss")


@query(
    "metrics_by_split",
    _metrics_sql(f"(SELECT *, {split_sql('doc_id')} AS split FROM {SCORED})", "split"),
)
def metrics_by_split(spark, sf_dir):
    parts = splitting.with_split(scored(spark, sf_dir), "doc_id")
    return rounded(evaluation.evaluate(parts, "label", "prediction", "score"), 6, *_METRICS)


@query("metrics_by_status", _metrics_sql(LINES, "l_linestatus"))
def metrics_by_status(spark, sf_dir):
    found = evaluation.evaluate(lines(spark, sf_dir), "label", "prediction", "score", by="l_linestatus")
    return rounded(found, 6, *_METRICS)


@query(
    "metrics_weighted",
    f"""WITH w AS (SELECT label, prediction, CASE WHEN label = 1 THEN n / (2 * np) ELSE n / (2 * (n - np)) END AS w
                   FROM {LINES}, (SELECT count(*) AS n, sum(label) AS np FROM {LINES})),
             c AS (SELECT sum(w) FILTER (WHERE label = 1 AND prediction = 1) AS tp, sum(w) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
                          sum(w) FILTER (WHERE label = 0 AND prediction = 0) AS tn, sum(w) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
                          sum(w) AS n FROM w)
        SELECT round((tp + tn) / n, 6) AS accuracy, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""",
)
def metrics_weighted(spark, sf_dir):
    weighted = splitting.with_class_weight(lines(spark, sf_dir), "label")
    found = evaluation.evaluate(weighted, "label", "prediction", by=None, weight="weight")
    return rounded(found.select("accuracy", "f1"), 6, "accuracy", "f1")


@query(
    "metrics_side_by_side",
    f"""WITH m AS ({_metrics_sql(f"(SELECT *, {split_sql('doc_id')} AS split FROM {SCORED})", "split")}),
             u AS (SELECT split, 'accuracy' AS metric, accuracy AS v FROM m UNION ALL SELECT split, 'f1', f1 FROM m)
        SELECT metric, max(v) FILTER (WHERE split = 'train') AS train, max(v) FILTER (WHERE split = 'val') AS val,
               max(v) FILTER (WHERE split = 'test') AS test FROM u GROUP BY metric""",
)
def metrics_side_by_side(spark, sf_dir):
    parts = splitting.with_split(scored(spark, sf_dir), "doc_id")
    metrics = evaluation.evaluate(parts, "label", "prediction")
    return rounded(evaluation.side_by_side(metrics, names=["accuracy", "f1"]), 6, "train", "val", "test")


def _curve_sql(rows: str) -> str:
    return f"""(SELECT score AS threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
                       sum(pos) OVER () AS p, sum(neg) OVER () AS n
                FROM (SELECT score, sum(label)::DOUBLE AS pos, sum(1 - label)::DOUBLE AS neg FROM {rows} GROUP BY score)
                WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


@query(
    "roc_curve",
    f"SELECT threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM {_curve_sql(LINES)}",
)
def roc_curve(spark, sf_dir):
    return rounded(evaluation.roc_curve(lines(spark, sf_dir), "label", "score"), 6, "fpr", "tpr")


@query(
    "roc_curve_binned",
    f"""SELECT threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr
        FROM {_curve_sql(f"(SELECT floor(score * 50) / 50.0::DOUBLE AS score, label FROM {LINES})")}""",
)
def roc_curve_binned(spark, sf_dir):
    return rounded(evaluation.roc_curve(lines(spark, sf_dir), "label", "score", bins=50), 6, "fpr", "tpr")


@query(
    "pr_curve",
    f"""SELECT threshold, round(tp / (tp + fp), 6) AS "precision", round(tp / p, 6) AS recall FROM {_curve_sql(SCORED)}""",
)
def pr_curve(spark, sf_dir):
    return rounded(evaluation.pr_curve(scored(spark, sf_dir), "label", "score"), 6, "precision", "recall")


@query(
    "roc_auc",
    f"""SELECT round(sum(neg * (tp - pos / 2)) / (max(p) * max(n)), 6) AS roc_auc,
        round(sum(pos * tp / (tp + fp)) / max(p), 6) AS average_precision FROM {_curve_sql(LINES)}""",
)
def roc_auc(spark, sf_dir):
    return rounded(evaluation.areas(lines(spark, sf_dir), "label", "score"), 6, "roc_auc", "average_precision")


@query(
    "sliced_accuracy",
    f"""SELECT l_linestatus, l_linenumber, count(*) FILTER (WHERE label = prediction) AS acc, count(*) AS obs,
        round(count(*) FILTER (WHERE label = prediction) / count(*), 6) AS pct_acc FROM {LINES} GROUP BY ALL""",
)
def sliced_accuracy(spark, sf_dir):
    slices = profiling.sliced_accuracy(lines(spark, sf_dir), "l_linestatus, l_linenumber", "label", "prediction")
    return rounded(slices, 6, "pct_acc")


@query(
    "linear_attribution",
    """WITH m AS (SELECT avg(l_quantity) AS q, avg(l_extendedprice) AS e, avg(l_discount) AS d FROM lineitem)
       SELECT 'l_quantity' AS feature, round(avg(abs((l_quantity - q) * -0.02)), 6) AS importance FROM lineitem, m
       UNION ALL SELECT 'l_extendedprice', round(avg(abs((l_extendedprice - e) * 0.00001)), 6) FROM lineitem, m
       UNION ALL SELECT 'l_discount', round(avg(abs((l_discount - d) * 3.0)), 6) FROM lineitem, m""",
)
def linear_attribution(spark, sf_dir):
    coefficients = {"l_quantity": -0.02, "l_extendedprice": 0.00001, "l_discount": 3.0}
    return rounded(explaining.linear_attribution(table(spark, sf_dir, "lineitem"), coefficients), 6, "importance")


@query(
    "kernel_shap_linear",
    """WITH bg AS (SELECT * FROM part ORDER BY md5(p_partkey || '|1'), p_partkey LIMIT 100),
            ex AS (SELECT * FROM part ORDER BY md5(p_partkey || '|2'), p_partkey LIMIT 100),
            m AS (SELECT avg(p_size) AS s, avg(p_retailprice) AS r, avg(p_partkey % 7) AS k FROM bg)
       SELECT p_partkey, 'size' AS feature, round(0.5 * (p_size - s), 4) AS phi FROM ex, m
       UNION ALL SELECT p_partkey, 'price', round(-0.01 * (p_retailprice - r), 4) FROM ex, m
       UNION ALL SELECT p_partkey, 'rest', round(2.0 * (p_partkey % 7 - k), 4) FROM ex, m""",
)
def kernel_shap_linear(spark, sf_dir):
    """Kernel SHAP of a linear score equals coefficient * (x - background mean)."""
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_size").cast("double").alias("size"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_partkey") % 7).cast("double").alias("rest"),
    )
    background = splitting.sample_n(part, 100, "p_partkey", 1)
    examples = splitting.sample_n(part, 100, "p_partkey", 2)
    linear = F.lit(1.5) + F.col("size") * 0.5 - F.col("price") * 0.01 + F.col("rest") * 2.0
    phis = explaining.kernel_shap(
        lambda df: df.withColumn("prediction", linear), background, examples, ["size", "price", "rest"], "p_partkey"
    )
    return rounded(phis.select("p_partkey", "feature", "phi"), 4, "phi")
