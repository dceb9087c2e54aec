"""Row cleaning, labels and rates on the incident view."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskflow.operators import cleaning
from riskflow.queries.registry import INCIDENTS, incidents, query, table

CAUSES = ["quality", "toxic"]


@query("any_positive", f"SELECT doc_id, quality, toxic FROM {INCIDENTS} WHERE quality > 0 OR toxic > 0")
def any_positive(spark, sf_dir):
    return cleaning.where_any_positive(incidents(spark, sf_dir), CAUSES).select("doc_id", *CAUSES)


@query(
    "binary_label",
    f"SELECT doc_id, CASE WHEN toxic > 0 OR quality > 0 THEN 1 ELSE 0 END AS label FROM {INCIDENTS}",
)
def binary_label(spark, sf_dir):
    return cleaning.with_binary_label(incidents(spark, sf_dir), CAUSES).select("doc_id", "label")


@query(
    "positive_rate",
    f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE quality > 0 OR toxic > 0) AS n_positive,
        round(count(*) FILTER (WHERE quality > 0 OR toxic > 0) * 100.0::DOUBLE / count(*), 4) AS positive_pct
        FROM {INCIDENTS}""",
)
def positive_rate(spark, sf_dir):
    return cleaning.positive_rate(incidents(spark, sf_dir), CAUSES)


@query(
    "drop_missing",
    f"SELECT * FROM {INCIDENTS} WHERE quality IS NOT NULL AND toxic IS NOT NULL",
)
def drop_missing(spark, sf_dir):
    return cleaning.drop_missing(incidents(spark, sf_dir))


@query(
    "drop_mostly_missing",
    f"SELECT doc_id, quality, toxic FROM {INCIDENTS} WHERE quality IS NOT NULL OR toxic IS NOT NULL",
)
def drop_mostly_missing(spark, sf_dir):
    kept = cleaning.drop_missing(incidents(spark, sf_dir), CAUSES, how="all")
    return kept.select("doc_id", *CAUSES)


@query(
    "reduction_summary",
    f"""WITH c AS (
          SELECT count(*) AS rows_before,
                 count(*) FILTER (WHERE quality IS NOT NULL AND toxic IS NOT NULL) AS rows_after,
                 count(*) FILTER (WHERE toxic > 0) AS positives_before,
                 count(*) FILTER (WHERE toxic > 0 AND quality IS NOT NULL) AS positives_after
          FROM {INCIDENTS})
        SELECT *, round(rows_after / rows_before, 6) AS rows_kept,
               round(positives_after / positives_before, 6) AS positives_kept,
               round(positives_before / rows_before, 6) AS rate_before,
               round(positives_after / rows_after, 6) AS rate_after
        FROM c""",
)
def reduction_summary(spark, sf_dir):
    rows = incidents(spark, sf_dir)
    return cleaning.reduction_summary(rows, rows.columns, ["toxic"])


@query("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, sf_dir):
    return cleaning.row_count(table(spark, sf_dir, "lineitem"))


@query(
    "to_numeric",
    """SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN props ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS amount
       FROM events""",
)
def to_numeric(spark, sf_dir):
    mixed = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.col("value").cast("string"))
    events = table(spark, sf_dir, "events").select("event_id", mixed.alias("amount"))
    return cleaning.to_numeric(events, ["amount"])


@query("as_category", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders")
def as_category(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return cleaning.as_category(orders, ["o_custkey"])
