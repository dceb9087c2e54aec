"""Encoders, imputers and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskflow.operators import cleaning, encoding, imputing, stages, training
from riskflow.queries.registry import INCIDENTS, incidents, query, rounded, table

_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _code(col: str, over: str = "") -> str:
    return f"dense_rank() OVER ({over}ORDER BY {col}) - 1"


@query("label_encode", "SELECT " + ", ".join(f"{_code(c)} AS {c}" for c in _ORDER_COLS) + " FROM orders")
def label_encode(spark, sf_dir):
    """Every column of a table, the key included."""
    orders = table(spark, sf_dir, "orders")
    return encoding.encode(orders, encoding.fit_label_encoder(orders))


@query(
    "label_encode_features",
    f"""SELECT {_code('doc_id')} AS doc_id, {_code('lang')} AS lang, {_code('source')} AS source,
        {_code('n_chars')} AS n_chars, {_code('label')} AS label
        FROM (SELECT *, CASE WHEN quality > 0 OR toxic > 0 THEN 1 ELSE 0 END AS label FROM {INCIDENTS}
              WHERE quality IS NOT NULL AND toxic IS NOT NULL)""",
)
def label_encode_features(spark, sf_dir):
    """The feature table: clean rows, label, causes dropped, all columns encoded."""
    rows = cleaning.drop_missing(incidents(spark, sf_dir))
    rows = cleaning.drop_columns(cleaning.with_binary_label(rows, ["quality", "toxic"]), ["quality", "toxic"])
    return encoding.encode(rows, encoding.fit_label_encoder(rows))


@query(
    "label_encode_numeric",
    f"SELECT p_partkey, {_code('p_size')} AS p_size, {_code('p_retailprice')} AS p_retailprice FROM part",
)
def label_encode_numeric(spark, sf_dir):
    """Numbers are ordered as numbers, not as text."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    return encoding.encode(part, encoding.fit_label_encoder(part, ["p_size", "p_retailprice"]))


@query(
    "label_encode_shuffled",
    f"SELECT l_orderkey, {_code('l_partkey')} AS l_partkey, {_code('l_returnflag')} AS l_returnflag FROM lineitem",
)
def label_encode_shuffled(spark, sf_dir):
    """The way large domains take: a shuffle join, hot values answered first."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    domain = encoding.fit_label_encoder(lineitem, ["l_partkey", "l_returnflag"])
    return encoding.encode(lineitem, domain, max_broadcast_rows=0)


@query("label_decode", "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part")
def label_decode(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    domain = encoding.fit_label_encoder(part, ["p_brand", "p_size", "p_retailprice"])
    return encoding.decode(encoding.encode(part, domain), domain)


@query(
    "encode_unseen",
    f"""WITH fitted AS (SELECT DISTINCT n_chars FROM {INCIDENTS} WHERE quality IS NOT NULL),
             coded AS (SELECT n_chars, {_code('n_chars')} AS code FROM fitted)
        SELECT d.doc_id, d.n_chars, c.code AS n_chars_code,
               coalesce(c.code, (SELECT count(*) FROM fitted)) AS n_chars_or_next
        FROM documents d LEFT JOIN coded c ON d.n_chars = c.n_chars""",
)
def encode_unseen(spark, sf_dir):
    """Codes fitted on the labelled documents, used on all documents."""
    rows = incidents(spark, sf_dir)
    domain = encoding.fit_label_encoder(cleaning.drop_missing(rows), ["n_chars"])
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    coded = encoding.encode(documents, domain, suffix="_code")
    return encoding.encode(coded, domain, unknown="code", suffix="_or_next")


@query(
    "one_hot_indicator",
    """SELECT doc_id, lang, CASE WHEN lang = 'de' THEN 1 ELSE 0 END AS lang_de, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS lang_en,
       CASE WHEN lang = 'es' THEN 1 ELSE 0 END AS lang_es, CASE WHEN lang = 'fr' THEN 1 ELSE 0 END AS lang_fr,
       CASE WHEN lang IN ('de', 'en', 'es', 'fr') THEN 0 ELSE 1 END AS lang_unknown FROM documents""",
)
def one_hot_indicator(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return encoding.one_hot(documents, ["lang"])


@query(
    "one_hot_drop_first",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS "l_linestatus_O" FROM lineitem""",
)
def one_hot_drop_first(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    return encoding.one_hot(lineitem, ["l_linestatus"], drop="first", unknown="ignore", keep=False)


@query(
    "frequency_encode",
    """SELECT p_partkey, count(*) OVER (PARTITION BY p_brand) AS p_brand_n, count(*) OVER (PARTITION BY p_type) AS p_type_n
       FROM part""",
)
def frequency_encode(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return encoding.frequency_encode(part, ["p_brand", "p_type"]).drop("p_brand", "p_type")


@query(
    "impute_mean",
    f"""SELECT doc_id, round(coalesce(quality, avg(quality) OVER ()), 6) AS quality,
        round(coalesce(toxic, avg(toxic) OVER ()), 6) AS toxic FROM {INCIDENTS}""",
)
def impute_mean(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("doc_id", "quality", "toxic")
    return rounded(imputing.impute(rows, ["quality", "toxic"], "mean"), 6, "quality", "toxic")


_GAPPED = "(SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price FROM orders)"


def _gapped(spark, sf_dir):
    price = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", price.alias("price"))


@query(
    "impute_median",
    f"SELECT o_orderkey, o_orderstatus, round(coalesce(price, (SELECT quantile_cont(price, 0.5) FROM {_GAPPED})), 6) AS price FROM {_GAPPED}",
)
def impute_median(spark, sf_dir):
    return rounded(imputing.impute(_gapped(spark, sf_dir), ["price"], "median"), 6, "price")


@query(
    "impute_mode",
    f"""SELECT doc_id, coalesce(quality, (SELECT quality FROM labels GROUP BY 1 ORDER BY count(*) DESC, quality LIMIT 1)) AS quality,
        coalesce(toxic, (SELECT toxic FROM labels GROUP BY 1 ORDER BY count(*) DESC, toxic LIMIT 1)) AS toxic
        FROM {INCIDENTS}""",
)
def impute_mode(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("doc_id", "quality", "toxic")
    return imputing.impute(rows, ["quality", "toxic"], "mode")


@query(
    "impute_literal",
    f"SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic FROM {INCIDENTS}",
)
def impute_literal(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("doc_id", "quality", "toxic")
    return imputing.impute(rows, ["quality", "toxic"], "literal", value=-1)


@query(
    "impute_group_mean",
    f"SELECT doc_id, lang, round(coalesce(quality, avg(quality) OVER (PARTITION BY lang)), 6) AS quality FROM {INCIDENTS}",
)
def impute_group_mean(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("doc_id", "lang", "quality")
    return rounded(imputing.impute(rows, ["quality"], "mean", by=["lang"]), 6, "quality")


@query(
    "impute_group_median",
    f"""WITH g AS (SELECT o_orderstatus, quantile_cont(price, 0.5) AS m FROM {_GAPPED} GROUP BY 1)
        SELECT o_orderkey, o_orderstatus, round(coalesce(price, m), 6) AS price FROM {_GAPPED} JOIN g USING (o_orderstatus)""",
)
def impute_group_median(spark, sf_dir):
    return rounded(imputing.impute(_gapped(spark, sf_dir), ["price"], "median", by=["o_orderstatus"]), 6, "price")


@query(
    "impute_group_mode",
    f"""WITH c AS (SELECT lang, quality, count(*) AS n FROM {INCIDENTS} WHERE quality IS NOT NULL GROUP BY ALL),
             g AS (SELECT lang, first(quality ORDER BY n DESC, quality) AS m FROM c GROUP BY lang)
        SELECT doc_id, lang, coalesce(quality, m) AS quality FROM {INCIDENTS} LEFT JOIN g USING (lang)""",
)
def impute_group_mode(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("doc_id", "lang", "quality")
    return imputing.impute(rows, ["quality"], "mode", by=["lang"])


@query(
    "standardize",
    """SELECT l_orderkey, l_linenumber,
         round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) AS l_quantity,
         round((l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER (), 6) AS l_extendedprice
       FROM lineitem""",
)
def standardize(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    scaled = imputing.standardize(lineitem, ["l_quantity", "l_extendedprice"])
    return rounded(scaled, 6, "l_quantity", "l_extendedprice")


@query(
    "assemble_features",
    f"""WITH i AS (SELECT *, coalesce(quality, (SELECT avg(quality) FROM labels)) AS q FROM {INCIDENTS})
        SELECT doc_id, CASE WHEN toxic = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS v0,
               round((n_chars - avg(n_chars) OVER ()) / stddev_pop(n_chars) OVER (), 6) AS v1,
               round((q - avg(q) OVER ()) / stddev_pop(q) OVER (), 6) AS v2,
               CASE WHEN lang = 'de' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS v3,
               CASE WHEN lang = 'en' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS v4,
               CASE WHEN lang = 'es' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS v5,
               CASE WHEN lang = 'fr' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS v6, 0.0::DOUBLE AS v7
        FROM i""",
)
def assemble_features(spark, sf_dir):
    """Two-valued, numeric and one-hot parts as one vector, shown slot by slot."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    rows = incidents(spark, sf_dir)
    spec = training.FeatureSpec(binary=["toxic"], numeric=["n_chars", "quality"], one_hot=["lang"])
    prepared = Pipeline(stages=training.preprocess_stages(spec)).fit(rows).transform(rows)
    slots = prepared.select("doc_id", vector_to_array("features").alias("_v"))
    return slots.select("doc_id", *[F.round(F.col("_v")[i], 6).alias(f"v{i}") for i in range(8)])


@query(
    "one_hot_unknown_value",
    """SELECT doc_id, (v IS NOT DISTINCT FROM 'en')::INT AS v_en, (v IS NOT DISTINCT FROM 'es')::INT AS v_es,
              (v IS NOT DISTINCT FROM 'unknown')::INT AS v_unknown, (v IS NULL)::INT AS v_unknown_
       FROM (SELECT doc_id, CASE lang WHEN 'fr' THEN 'unknown' WHEN 'de' THEN NULL ELSE lang END AS v FROM documents)""",
)
def one_hot_unknown_value(spark, sf_dir):
    """A category that is called unknown beside values that are missing."""
    lang = F.when(F.col("lang") == "fr", "unknown").when(F.col("lang") != "de", F.col("lang"))
    documents = table(spark, sf_dir, "documents").select("doc_id", lang.alias("v"))
    return encoding.one_hot(documents, ["v"]).drop("v")


@query(
    "one_hot_widened",
    """SELECT l_orderkey, l_linenumber, (l_linenumber % 7)::BIGINT AS slot FROM lineitem""",
)
def one_hot_widened(spark, sf_dir):
    """Fitted on integers, applied to the same numbers as doubles: the slot of each value stays."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_linenumber") % 7).cast("bigint").alias("v"))
    model = stages.OneHotFeatures(inputCols=["v"], outputCol="f").fit(lines)
    names = F.lit(model.feature_names())
    wide = model.transform(lines.withColumn("v", F.col("v").cast("double")))
    name = F.element_at(names, F.array_position("f", 1.0).cast("int"))
    return wide.select("l_orderkey", "l_linenumber", F.regexp_extract(name, "v_(.*)", 1).try_cast("bigint").alias("slot"))


_PAIR = "l_partkey || '-' || l_suppkey || '-' || l_quantity::INT"


@query(
    "one_hot_many_values",
    f"""SELECT l_orderkey, l_linenumber, (dense_rank() OVER (ORDER BY {_PAIR}) - 1)::BIGINT AS slot,
               (SELECT count(DISTINCT {_PAIR}) + 1 FROM lineitem)::BIGINT AS width FROM lineitem""",
)
def one_hot_many_values(spark, sf_dir):
    """About as many values as rows: sparse vectors, slots from a join, no value on the driver."""
    pair = F.concat_ws("-", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", pair.alias("pair"))
    coded = stages.OneHotFeatures(inputCols=["pair"], outputCol="f", maxDense=256).fit(lines).transform(lines)
    # a vector's own form: its width and the places of its values
    vector = F.from_json(F.to_json(F.struct("f")), "f struct<size: bigint, indices: array<bigint>>").getField("f")
    return coded.select("l_orderkey", "l_linenumber", vector["indices"][0].alias("slot"), vector["size"].alias("width"))
