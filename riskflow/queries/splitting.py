"""Splits, weights, samples and hold-outs."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskflow.operators import cleaning, folds, splitting
from riskflow.queries.registry import INCIDENTS, incidents, query, rounded, table


def slot_sql(key: str, seed: int = 0) -> str:
    return f"CAST('0x' || substr(md5({key} || '|{seed}'), 1, 8) AS BIGINT) % 10000"


def split_sql(key: str, seed: int = 0) -> str:
    slot = slot_sql(key, seed)
    return f"CASE WHEN {slot} < 6000 THEN 'train' WHEN {slot} < 8000 THEN 'val' ELSE 'test' END"


@query("split_rows", f"SELECT o_orderkey, {split_sql('o_orderkey')} AS split FROM orders")
def split_rows(spark, sf_dir):
    return splitting.with_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "split_counts",
    f"SELECT {split_sql('o_orderkey')} AS split, count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum FROM orders GROUP BY 1",
)
def split_counts(spark, sf_dir):
    rows = splitting.with_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query(
    "split_filter",
    f"SELECT o_orderkey, o_totalprice FROM orders WHERE {split_sql('o_orderkey')} = 'val'",
)
def split_filter(spark, sf_dir):
    """One part of a split, the split column dropped again."""
    rows = splitting.with_split(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")
    return rows.where(F.col("split") == "val").drop("split")


@query(
    "split_stratified",
    f"""WITH l AS (SELECT doc_id, CASE WHEN toxic > 0 THEN 1 ELSE 0 END AS label FROM {INCIDENTS}),
             r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(doc_id || '|0'), doc_id) - 1 AS k,
                          count(*) OVER (PARTITION BY label) AS n FROM l)
        SELECT doc_id, label, CASE WHEN floor(k * 10000 / n) < 6000 THEN 'train'
               WHEN floor(k * 10000 / n) < 8000 THEN 'val' ELSE 'test' END AS split FROM r""",
)
def split_stratified(spark, sf_dir):
    labelled = cleaning.with_binary_label(incidents(spark, sf_dir), ["toxic"]).select("doc_id", "label")
    return splitting.with_split(labelled, "doc_id", stratify="label")


@query(
    "class_weight",
    f"""WITH l AS (SELECT doc_id, CASE WHEN toxic > 0 THEN 1 ELSE 0 END AS label FROM {INCIDENTS})
        SELECT doc_id, label, round(count(*) OVER () / ((SELECT count(DISTINCT label) FROM l) * count(*) OVER (PARTITION BY label)), 6)
               AS weight FROM l""",
)
def class_weight(spark, sf_dir):
    labelled = cleaning.with_binary_label(incidents(spark, sf_dir), ["toxic"]).select("doc_id", "label")
    return rounded(splitting.with_class_weight(labelled, "label"), 6, "weight")


@query("sample_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey || '|62545389'), o_orderkey LIMIT 100")
def sample_n(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return splitting.sample_n(orders, 100, "o_orderkey", 62545389)


@query(
    "hold_out",
    f"SELECT o_orderkey, CASE WHEN {slot_sql('o_orderkey', 7)} < 1000 THEN 'held' ELSE 'kept' END AS part FROM orders",
)
def hold_out(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    kept, held = splitting.hold_out(orders, "o_orderkey", 0.1, 7)
    return kept.withColumn("part", F.lit("kept")).unionByName(held.withColumn("part", F.lit("held")))


FOLDS_SQL = """(SELECT o_custkey, n, least((5 * (2 * upto - n)) // (2 * total), 4)::INT AS fold FROM
  (SELECT *, sum(n) OVER (ORDER BY h, o_custkey)::BIGINT AS upto, sum(n) OVER ()::BIGINT AS total FROM
    (SELECT o_custkey, count(*) AS n, md5(o_custkey || '|0') AS h FROM orders GROUP BY o_custkey)))"""


@query("fold_counts", f"SELECT fold, sum(n)::BIGINT AS n_rows, count(*) AS n_groups, sum(o_custkey)::BIGINT AS key_sum FROM {FOLDS_SQL} GROUP BY fold")
def fold_counts(spark, sf_dir):
    """Five folds of orders that keep the orders of a customer together."""
    rows = folds.with_folds(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", 5)
    per_group = rows.groupBy("fold", "o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return per_group.groupBy("fold").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_groups"), F.sum("o_custkey").alias("key_sum")
    )
