"""Profiles and frequency tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskflow.operators import association, cleaning, profiling, sketches
from riskflow.plans.shared import new_path
from riskflow.queries.registry import INCIDENTS, incidents, query, rounded, table


def _union(template: str, cols: list[str]) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in cols)


_ALL = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]
_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "null_profile",
    _union(
        f"""SELECT '{{c}}' AS "column", count(*) AS n_rows, count(*) - count({{c}}) AS n_null,
            round((count(*) - count({{c}})) / count(*), 6) AS null_share,
            (count(*) - count({{c}})) / count(*) <= 0.5 AS keep FROM {INCIDENTS}""",
        _ALL,
    ),
)
def null_profile(spark, sf_dir):
    return profiling.null_profile(incidents(spark, sf_dir), 0.5)


@query(
    "rows_with_null",
    f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE quality IS NULL OR toxic IS NULL) AS n_rows_with_null
        FROM {INCIDENTS}""",
)
def rows_with_null(spark, sf_dir):
    return profiling.rows_with_null(incidents(spark, sf_dir))


@query(
    "profile_numeric",
    _union(
        """SELECT '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS n_null, min({c}) AS min, max({c}) AS max,
           round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
           round((avg({c} * {c} * {c}) - 3 * avg({c}) * avg({c} * {c}) + 2 * pow(avg({c}), 3))
                 / pow(avg({c} * {c}) - avg({c}) * avg({c}), 1.5), 4) AS skew,
           count(DISTINCT {c}) AS n_distinct, round(quantile_cont({c}, 0.25), 4) AS p25,
           round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75
           FROM lineitem""",
        _MEASURES,
    ),
)
def profile_numeric(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select(*_MEASURES)
    profile = profiling.profile_numeric(lineitem, _MEASURES, [0.25, 0.5, 0.75])
    profile = profile.select("column", "n", "n_null", "min", "max", "mean", "std", "skew", "n_distinct", "p25", "p50", "p75")
    return rounded(profile, 4, "mean", "std", "skew", "p25", "p50", "p75")


@query(
    "profile_string",
    _union(
        """SELECT '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS n_null,
           CAST(min(length({c})) AS INTEGER) AS min_length, CAST(max(length({c})) AS INTEGER) AS max_length,
           min({c}) AS min, max({c}) AS max, count(DISTINCT {c}) AS n_distinct FROM part""",
        ["p_name", "p_brand", "p_type"],
    ),
)
def profile_string(spark, sf_dir):
    return profiling.profile_string(table(spark, sf_dir, "part"), ["p_name", "p_brand", "p_type"])


@query("profile_all_columns")
def profile_all_columns(spark, sf_dir):
    """The whole-table profile with sketched distinct counts and quantiles."""
    return profiling.profile(table(spark, sf_dir, "orders"))


@query(
    "profile_wide_ids",
    """SELECT 'id' AS "column", count(id) AS n, count(*) - count(id) AS n_null, CAST(min(id) AS VARCHAR) AS min_value,
       CAST(max(id) AS VARCHAR) AS max_value, count(DISTINCT id) AS n_distinct
       FROM (SELECT o_orderkey + 9007199254740992 AS id FROM orders)""",
)
def profile_wide_ids(spark, sf_dir):
    """Ids above 2^53, which a double cannot tell apart."""
    ids = table(spark, sf_dir, "orders").selectExpr("o_orderkey + 9007199254740992 AS id")
    return profiling.profile(ids, exact=True).select("column", "n", "n_null", "min_value", "max_value", "n_distinct")


@query("value_counts", "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 10")
def value_counts(spark, sf_dir):
    return profiling.value_counts(table(spark, sf_dir, "part"), "p_brand", 10)


@query("class_counts", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def class_counts(spark, sf_dir):
    return profiling.class_counts(table(spark, sf_dir, "lineitem"), "l_returnflag")


@query(
    "group_quantiles",
    """SELECT event_type, 'value' AS "column", 0.5::DOUBLE AS share, round(quantile_cont(value, 0.5), 6) AS value FROM events GROUP BY 1
       UNION ALL
       SELECT event_type, 'value', 0.9::DOUBLE, round(quantile_cont(value, 0.9), 6) FROM events GROUP BY 1""",
)
def group_quantiles(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return rounded(profiling.quantiles(events, ["value"], [0.5, 0.9], ["event_type"]), 6, "value")


_LABELLED = f"""(SELECT *, CASE WHEN quality > 0 OR toxic > 0 THEN 1 ELSE 0 END AS label FROM {INCIDENTS}
                 WHERE quality IS NOT NULL AND toxic IS NOT NULL)"""


@query(
    "leakage_report",
    "WITH cells AS ("
    + _union(
        f"SELECT '{{c}}' AS col, CAST({{c}} AS VARCHAR) AS v, label, count(*) AS n FROM {_LABELLED} GROUP BY ALL", _ALL
    )
    + f"""), vals AS (SELECT col, v, sum(n) AS n, max(n) AS top FROM cells GROUP BY ALL),
      base AS (SELECT max(n) / sum(n) AS b FROM (SELECT count(*) AS n FROM {_LABELLED} GROUP BY label)),
      rep AS (SELECT col, count(*) AS n_distinct, round(count(*) / sum(n), 6) AS distinct_share,
                     round(sum(top) / sum(n), 6) AS purity FROM vals GROUP BY col)
      SELECT col AS "column", n_distinct, distinct_share, purity, round(b, 6) AS base_purity,
             distinct_share >= 0.9 AS looks_like_key, purity >= 0.999 AND round(b, 6) < 0.999 AS gives_away_label
      FROM rep, base""",
)
def leakage_report(spark, sf_dir):
    rows = cleaning.drop_missing(incidents(spark, sf_dir))
    labelled = cleaning.with_binary_label(rows, ["quality", "toxic"])
    return profiling.leakage_report(labelled, "label")



_PAIRS = [("lang", "source"), ("source", "lang"), ("quality", "toxic"), ("lang", "toxic"), ("doc_id", "source"), ("copy", "toxic"), ("one", "lang")]
_PAIR_ROWS = f"(SELECT *, CASE toxic WHEN 1 THEN 'yes' WHEN 0 THEN 'no' END AS copy, 1 AS one FROM {INCIDENTS})"


def _association_sql(source: str, target: str) -> str:
    return f"""SELECT '{source}' AS source, '{target}' AS target, n, n_source, n_target, round(entropy, 6) + 0.0 AS entropy,
      round(left_over, 6) + 0.0 AS conditional_entropy,
      CASE WHEN n_target > 1 THEN round(1 - left_over / entropy, 6) END AS explained,
      CASE WHEN least(n_source, n_target) > 1 THEN round(sqrt(greatest(phi - 1, 0) / (least(n_source, n_target) - 1)), 6) END AS cramers_v
    FROM (SELECT sum(c)::BIGINT AS n, count(DISTINCT coalesce('=' || a::VARCHAR, '')) AS n_source, count(DISTINCT coalesce('=' || b::VARCHAR, '')) AS n_target,
                 greatest(-sum(c / t * ln(cb / t)), 0) AS entropy, greatest(-sum(c / t * ln(c / ca)), 0) AS left_over, sum(c * c / (ca * cb)) AS phi
          FROM (SELECT a, b, c::DOUBLE AS c, sum(c) OVER (PARTITION BY a)::DOUBLE AS ca, sum(c) OVER (PARTITION BY b)::DOUBLE AS cb,
                       sum(c) OVER ()::DOUBLE AS t
                FROM (SELECT {source} AS a, {target} AS b, count(*) AS c FROM {_PAIR_ROWS} GROUP BY ALL)))"""


@query("association_pairs", " UNION ALL ".join(_association_sql(a, b) for a, b in _PAIRS))
def association_pairs(spark, sf_dir):
    """What columns tell of each other: a relabelled copy of the label among them."""
    copy = F.when(F.col("toxic") == 1, "yes").when(F.col("toxic") == 0, "no")
    return association.association(incidents(spark, sf_dir).withColumns({"copy": copy, "one": F.lit(1)}), _PAIRS)


@query(
    "profile_merged",
    """SELECT c AS "column", n, 0::BIGINT AS n_null, 7::BIGINT AS n_deliveries, lo AS min, hi AS max, round(mean, 6) AS mean,
              round(std, 4) AS std, TRUE AS distinct_ok, TRUE AS quantiles_ok
       FROM (SELECT 'l_partkey' AS c, count(*) AS n, min(l_partkey)::DOUBLE AS lo, max(l_partkey)::DOUBLE AS hi, avg(l_partkey) AS mean, stddev_samp(l_partkey) AS std FROM lineitem
             UNION ALL SELECT 'l_quantity', count(*), min(l_quantity), max(l_quantity), avg(l_quantity), stddev_samp(l_quantity) FROM lineitem
             UNION ALL SELECT 'l_extendedprice', count(*), min(l_extendedprice), max(l_extendedprice), avg(l_extendedprice), stddev_samp(l_extendedprice) FROM lineitem)""",
)
def profile_merged(spark, sf_dir):
    """Seven deliveries sketched and stored, one of them twice; merged numbers against those of the whole table.

    Distinct counts may be 5 % off, ranks of quantiles 1 %.
    """
    lines, cols = table(spark, sf_dir, "lineitem"), ["l_partkey", "l_quantity", "l_extendedprice"]
    path, shares = new_path(spark, "sketches"), (0.05, 0.5, 0.95)
    sketches.add_delivery(lines.where("l_linenumber <= 4"), path, cols, F.col("l_linenumber"))
    sketches.add_delivery(lines.where("l_linenumber >= 4"), path, cols, F.col("l_linenumber"))
    merged = sketches.merged_profile(sketches.read_deliveries(spark, path), shares).collect()  # one row per column
    exact = lines.agg(*[F.countDistinct(c).alias(c) for c in cols]).first()
    rows = []
    for r in merged:
        c = r["column"]
        errors = sketches.rank_errors(lines, c, [(s, r[f"p{s * 100:g}"]) for s in shares]).collect()
        rows.append((c, abs(r["n_distinct"] - exact[c]) <= 0.05 * exact[c], all(e["error"] <= 0.01 for e in errors)))
    judged = spark.createDataFrame(rows, "column string, distinct_ok boolean, quantiles_ok boolean")
    whole = sketches.merged_profile(sketches.read_deliveries(spark, path), shares).join(judged, "column")
    whole = whole.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 4)})
    return whole.select("column", "n", "n_null", "n_deliveries", "min", "max", "mean", "std", "distinct_ok", "quantiles_ok")
