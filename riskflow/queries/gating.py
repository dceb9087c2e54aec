"""Input contract, quality rules and the promotion gate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.operators import gate, profiling, scoring
from riskflow.queries.evaluation import LINES, SCORED, lines, scored
from riskflow.queries.registry import incidents, INCIDENTS, query, rounded, table

_SIGNATURE = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("props", T.DoubleType()),
        T.StructField("value", T.IntegerType()),
        T.StructField("absent", T.StringType()),
    ]
)


@query(
    "signature_check",
    """SELECT 'event_id' AS "column", 'bigint' AS expected, count(*) - count(event_id) AS n_null, 0::BIGINT AS n_bad, TRUE AS ok FROM events
       UNION ALL SELECT 'props', 'double', count(*) - count(props), count(props) - count(TRY_CAST(props AS DOUBLE)),
                        count(props) = count(TRY_CAST(props AS DOUBLE)) FROM events
       UNION ALL SELECT 'value', 'int', count(*) - count(value), count(*) FILTER (value <> trunc(value)),
                        count(*) FILTER (value <> trunc(value)) = 0 FROM events
       UNION ALL SELECT 'absent', 'string', NULL, NULL, FALSE""",
)
def signature_check(spark, sf_dir):
    return scoring.check_signature(table(spark, sf_dir, "events"), _SIGNATURE)


def _gate_sql(rows: str, slices: str, passes: str) -> str:
    return f"""SELECT CASE WHEN {passes} THEN 'pass' ELSE 'fail' END AS result, round(min(a), 6) AS worst,
               round(max(a), 6) AS best, count(*) AS n_slices
        FROM (SELECT count(*) FILTER (WHERE label = prediction) / count(*) AS a FROM {rows} GROUP BY {slices})"""


@query("slice_gate", _gate_sql(LINES, "l_linestatus", "min(a) >= 0.55"))
def slice_gate(spark, sf_dir):
    slices = profiling.sliced_accuracy(lines(spark, sf_dir), "l_linestatus", "label", "prediction")
    return rounded(gate.slice_gate(slices), 6, "worst", "best")


@query("slice_gate_compat", _gate_sql(LINES, "l_linestatus", "max(a) > 0"))
def slice_gate_compat(spark, sf_dir):
    slices = profiling.sliced_accuracy(lines(spark, sf_dir), "l_linestatus", "label", "prediction")
    return rounded(gate.slice_gate(slices, mode="compat"), 6, "worst", "best")


_DESCRIPTIONS = {"lang-lax": "Predicts whether a document is toxic.", "source-strict": "Too short."}


def _checks(spark, sf_dir):
    """Two versions: sliced by language with a low bar, by source with a high one."""
    rows = scored(spark, sf_dir)
    inputs = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType())])
    parts = []
    for version, slices, bar in (("lang-lax", "lang", 0.05), ("source-strict", "source", 0.95)):
        parts += [
            gate.signature_check(version, rows, inputs),
            gate.slice_check(version, rows, slices, "label", threshold=bar),
            gate.description_check(spark, version, _DESCRIPTIONS[version]),
            rows.agg(F.count(F.lit(1)).alias("_n"), F.count("prediction").alias("_s")).select(
                *gate.check_row(
                    version,
                    "predicts",
                    gate.flag(F.col("_n") == F.col("_s")),
                    F.concat(F.col("_s").cast("string"), F.lit(" rows scored")),
                )
            ),
        ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _slice_value(slices: str, bar: float) -> str:
    return f"""(SELECT CASE WHEN min(a) >= {bar} THEN 'pass' ELSE 'fail' END FROM
               (SELECT count(*) FILTER (WHERE label = prediction) / count(*) AS a FROM {SCORED} GROUP BY {slices}))"""


_WIDE = f"""(SELECT 'lang-lax' AS version, '1' AS has_description, '1' AS has_signature,
             (SELECT CASE WHEN count(*) = count(prediction) THEN '1' ELSE '0' END FROM {SCORED}) AS predicts,
             {_slice_value('lang', 0.05)} AS slice_test
             UNION ALL SELECT 'source-strict', '0', '1',
             (SELECT CASE WHEN count(*) = count(prediction) THEN '1' ELSE '0' END FROM {SCORED}), {_slice_value('source', 0.95)})"""


@query("checks_wide", f"SELECT * FROM {_WIDE}")
def checks_wide(spark, sf_dir):
    return gate.checks_wide(_checks(spark, sf_dir))


@query(
    "decide",
    f"""WITH f AS (SELECT version, (has_description = '0')::BIGINT + (has_signature = '0')::BIGINT + (predicts = '0')::BIGINT
                          + (slice_test = 'fail')::BIGINT AS n_failed FROM {_WIDE})
        SELECT version, CASE WHEN n_failed = 0 THEN 'accept' ELSE 'reject' END AS decision, n_failed FROM f""",
)
def decide(spark, sf_dir):
    return gate.decide(_checks(spark, sf_dir))


@query(
    "quality_gate",
    f"""SELECT 'has_labels' AS rule, count(*) AS n_rows, count(*) FILTER (WHERE NOT coalesce(quality >= 0 AND toxic >= 0, FALSE)) AS n_failed,
               count(*) FILTER (WHERE NOT coalesce(quality >= 0 AND toxic >= 0, FALSE)) = 0 AS ok FROM {INCIDENTS}
        UNION ALL SELECT 'known_language', count(*), count(*) FILTER (WHERE lang NOT IN ('de', 'en', 'es', 'fr')),
               count(*) FILTER (WHERE lang NOT IN ('de', 'en', 'es', 'fr')) = 0 FROM {INCIDENTS}
        UNION ALL SELECT 'not_tiny', count(*), count(*) FILTER (WHERE n_chars < 20), count(*) FILTER (WHERE n_chars < 20) = 0 FROM {INCIDENTS}""",
)
def quality_gate(spark, sf_dir):
    rules = {
        "has_labels": "quality >= 0 AND toxic >= 0",
        "known_language": F.col("lang").isin("de", "en", "es", "fr"),
        "not_tiny": F.col("n_chars") >= 20,
    }
    return gate.quality_gate(incidents(spark, sf_dir), rules)


@query(
    "description_checks",
    """SELECT p_name AS version, 'has_description' AS "check", CASE WHEN length(p_name || ' ' || p_type) >= 21 THEN '1' ELSE '0' END AS value,
       length(p_name || ' ' || p_type) || ' characters' AS detail FROM part""",
)
def description_checks(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    versions = part.select(F.col("p_name").alias("version"), F.concat_ws(" ", "p_name", "p_type").alias("description"))
    return gate.description_checks(versions)
