"""Scans, sinks, headers and projections."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.operators import cleaning
from riskflow.plans.shared import new_path
from riskflow.queries.registry import query, table
from riskflow.sources import tables as src


@query("scan_select", "SELECT p_partkey, p_name, p_retailprice FROM part")
def scan_select(spark, sf_dir):
    return cleaning.select_columns(src.read_table(spark, f"{sf_dir}/part.parquet"), ["p_partkey", "p_name", "p_retailprice"])


@query("drop_columns", "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part")
def drop_columns(spark, sf_dir):
    return cleaning.drop_columns(table(spark, sf_dir, "part"), ["p_name", "p_type", "not_there"])


@query(
    "rename",
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def rename(spark, sf_dir):
    return cleaning.rename(table(spark, sf_dir, "orders"), {"o_orderkey": "order_id", "o_custkey": "customer_id"})


@query(
    "normalize_header",
    "SELECT o_orderkey AS order_key, o_custkey AS customer_key_mm, o_orderstatus AS status, "
    "o_totalprice AS total_price, o_orderdate AS status_2, o_orderpriority AS order_priority FROM orders",
)
def normalize_header(spark, sf_dir):
    spaced = table(spark, sf_dir, "orders").toDF(
        " Order Key", "Customer  Key (mm)", "Status", "Total Price ", "STATUS", "order_priority"
    )
    return cleaning.normalize_header(spaced)


@query("preview", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def preview(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return src.preview(orders, 10, [F.desc("o_totalprice"), "o_orderkey"])


@query("filter_equal", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def filter_equal(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderstatus")


@query("write_readback", "SELECT * FROM orders")
def write_readback(spark, sf_dir):
    target = new_path(spark, "orders")
    src.write_table(table(spark, sf_dir, "orders"), target)
    return src.read_table(spark, target)


@query("table_by_name", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def table_by_name(spark, sf_dir):
    """A catalogue table, written twice with different columns; the second one stays."""
    schema = f"riskflow_{uuid.uuid4().hex}"
    src.ensure_schema(spark, schema, location=new_path(spark, "schema"))
    customers = table(spark, sf_dir, "customer")
    name = f"{schema}.customers"
    src.write_table(customers.select("c_custkey", "c_name"), name)
    src.write_table(customers.select("c_custkey", "c_mktsegment", "c_acctbal"), name)
    return src.read_table(spark, name)


@query("csv_scan", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def csv_scan(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    target = new_path(spark, "csv")
    part.write.option("header", True).csv(target)
    return src.read_csv(spark, target, part.schema)


@query(
    "append_evolving",
    "SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS segment, CAST(NULL AS DOUBLE) AS balance FROM supplier "
    "UNION ALL SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer",
)
def append_evolving(spark, sf_dir):
    target = new_path(spark, "evolving")
    src.append_evolving(
        table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), target
    )
    src.append_evolving(
        table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("balance"),
        ),
        target,
    )
    return src.read_evolving(spark, target)


@query(
    "delete_where",
    "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders WHERE o_orderstatus <> 'F'",
)
def delete_where(spark, sf_dir):
    """Rows whose status is unknown stay."""
    target = new_path(spark, "versioned")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    src.write_versioned(orders, target)
    src.delete_where(spark, target, F.col("status") == "F")
    return src.read_versioned(spark, target)


_KEY_SQL = """
SELECT '{name}' AS source_table, CAST(sum(n) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_null_keys,
       count(*) FILTER (WHERE n > 1) AS n_duplicate_keys, count(*) FILTER (WHERE n > 1) = 0 AS key_ok
FROM (SELECT count(*) AS n FROM {name} GROUP BY {key})
"""


@query(
    "feature_key_check",
    _KEY_SQL.format(name="lineitem", key="l_orderkey, l_linenumber")
    + " UNION ALL "
    + _KEY_SQL.format(name="orders", key="o_orderkey"),
)
def feature_key_check(spark, sf_dir):
    lineitem = src.key_check(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    orders = src.key_check(table(spark, sf_dir, "orders"), "o_orderkey")
    cols = ["source_table", *lineitem.columns]
    return (
        lineitem.withColumn("source_table", F.lit("lineitem"))
        .unionByName(orders.withColumn("source_table", F.lit("orders")))
        .select(*cols)
    )


@query("feature_table", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def feature_table(spark, sf_dir):
    target = new_path(spark, "features")
    features = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    src.write_feature_table(features, target, "o_orderkey")
    return src.read_table(spark, target)


ORDER_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)
