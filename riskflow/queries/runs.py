"""The event table read as a log of runs: name = event_type, date = ts, metric = value."""

from __future__ import annotations

from datetime import timezone

from pyspark.sql import functions as F

from riskflow.operators import runlog
from riskflow.plans.shared import new_path
from riskflow.queries.registry import query, table
from riskflow.sources.tables import append_versioned, read_versioned


def _log(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("name"),
        F.col("ts").alias("date"),
        F.when(F.col("user_id") % 3 == 0, F.lit("FAILED")).otherwise(F.lit("FINISHED")).alias("status"),
        F.nullif("value", F.lit(0.0)).alias("val_f1"),
    )


_LOG = """(SELECT event_id AS run_id, event_type AS name, ts AS date, CASE WHEN user_id % 3 = 0 THEN 'FAILED' ELSE 'FINISHED' END AS status,
           nullif(value, 0) AS val_f1 FROM events)"""


@query("latest_run", f"SELECT * FROM {_LOG} WHERE name = 'purchase' ORDER BY date DESC, run_id LIMIT 1")
def latest_run(spark, sf_dir):
    return runlog.latest_run(_log(spark, sf_dir), "purchase", ties="run_id")


@query(
    "latest_per_key",
    f"""SELECT name, status, run_id, date, val_f1 FROM
        (SELECT *, row_number() OVER (PARTITION BY name, status ORDER BY date DESC, run_id DESC) AS k FROM {_LOG}) WHERE k = 1""",
)
def latest_per_key(spark, sf_dir):
    return runlog.latest_per_key(_log(spark, sf_dir), ["name", "status"], ["date", "run_id"])


@query(
    "best_run",
    f"SELECT * FROM {_LOG} WHERE status = 'FINISHED' ORDER BY val_f1 DESC NULLS LAST, run_id LIMIT 1",
)
def best_run(spark, sf_dir):
    return runlog.best_run(_log(spark, sf_dir), "val_f1")


@query(
    "reset_runs",
    f"""SELECT name, date, run_id, CAST(NULL AS DOUBLE) AS val_f1 FROM {_LOG} WHERE status = 'FAILED' AND name <> 'click'
        UNION ALL SELECT name, date, run_id, val_f1 FROM {_LOG} WHERE status = 'FINISHED' AND name <> 'click'""",
)
def reset_runs(spark, sf_dir):
    """A log that gained a column on the way, with the runs of one name forgotten."""
    log = _log(spark, sf_dir)
    path = new_path(spark, "runs")
    append_versioned(log.where(F.col("status") == "FAILED").select("name", "date", "run_id"), path)
    append_versioned(log.where(F.col("status") == "FINISHED").select("name", "date", "run_id", "val_f1"), path)
    runlog.reset_runs(spark, path, "click")
    return read_versioned(spark, path)


@query(
    "mixed_metric_log",
    """SELECT 'whole' AS name, count(*)::DOUBLE AS metric FROM events UNION ALL SELECT 'share', avg((value > 50)::INT) FROM events""",
)
def mixed_metric_log(spark, sf_dir):
    """A metric that is an integer in one run and a fraction in the next."""
    row = table(spark, sf_dir, "events").agg(
        F.count("*").alias("n"), F.avg(F.when(F.col("value") > 50, 1).when(F.col("value").isNotNull(), 0)).alias("s")
    ).first()
    path = new_path(spark, "runs")
    runlog.log_run(spark, path, "whole", {"metric": row["n"]})
    runlog.log_run(spark, path, "share", {"metric": row["s"]})
    return runlog.read_log(spark, path).select("name", "metric")


@query(
    "mixed_type_log",
    """SELECT 'any' AS name, CASE WHEN count(*) > 0 THEN 'true' ELSE 'false' END AS metric, NULL::DOUBLE AS share FROM events
       UNION ALL SELECT 'count', (count(*) * 1.0::DOUBLE)::VARCHAR, 1.0::DOUBLE FROM events
       UNION ALL SELECT 'kind', min(event_type), round(avg((value > 50)::INT), 6) FROM events""",
)
def mixed_type_log(spark, sf_dir):
    """A metric that is a truth value, a number and a text; another that is a truth value and a number."""
    row = table(spark, sf_dir, "events").agg(
        F.count("*").alias("n"), F.min("event_type").alias("kind"), F.round(F.avg((F.col("value") > 50).cast("int")), 6).alias("share")
    ).first()
    path = new_path(spark, "runs")
    runlog.log_run(spark, path, "any", {"metric": row["n"] > 0})
    runlog.log_run(spark, path, "count", {"metric": row["n"], "share": True})
    runlog.log_run(spark, path, "kind", {"metric": row["kind"], "share": row["share"]})
    return runlog.read_log(spark, path).select("name", "metric", "share")


@query(
    "logged_moment",
    "SELECT event_type AS name, max(ts) AS date, count(*) AS n FROM events GROUP BY event_type",
)
def logged_moment(spark, sf_dir):
    """The time stamp of a run, as logged: here of the newest event of each kind."""
    newest = table(spark, sf_dir, "events").groupBy("event_type").agg(F.max("ts").alias("ts"), F.count("*").alias("n"))
    path = new_path(spark, "runs")
    for row in newest.collect():  # five kinds
        runlog.log_run(spark, path, row["event_type"], {"n": row["n"]}, row["ts"].replace(tzinfo=timezone.utc))
    log = runlog.read_log(spark, path)
    return log.select("name", F.col("date").cast("timestamp_ntz").alias("date"), F.col("n").cast("bigint").alias("n"))
