"""The whole way from a raw file to scored rows, table by table.

Each step reads the table the step before has written, so a step can be run again
on its own. Targets are catalogue names or folders.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow import incident_columns as names
from riskflow.operators import cleaning, encoding, gate, runlog, scoring, training
from riskflow.operators import tags as tag_store
from riskflow.sources import tables


@dataclass(frozen=True)
class RiskTable:
    """What the columns of an incident table are for.

    Key and label causes are left out of the features unless ``features`` names them:
    the causes define the label, and a key says nothing about new rows.
    """

    key: str = names.KEY
    causes: Sequence[str] = names.CAUSES
    kept: Sequence[str] = names.KEPT
    dropped: Sequence[str] = names.DROPPED
    label: str = "is_harmful"
    features: training.FeatureSpec = field(
        default_factory=lambda: training.FeatureSpec(
            binary=names.BINARY,
            numeric=[c for c in names.NUMERIC if c not in (names.KEY, *names.CAUSES)],
            one_hot=[c for c in names.ONE_HOT if c not in names.CAUSES],
        )
    )


def ingest(spark: SparkSession, source: str, target: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV to a table with clean column names."""
    tables.write_table(cleaning.normalize_header(tables.read_csv(spark, source, schema)), target)
    return tables.read_table(spark, target)


def clean(spark: SparkSession, source: str, target: str, table: RiskTable) -> DataFrame:
    """Keep the useful columns and the complete rows; returns what that cost, as one row."""
    rows = cleaning.select_columns(tables.read_table(spark, source), table.kept)
    tables.write_table(cleaning.drop_missing(rows), target)
    return cleaning.reduction_summary(rows, table.kept, table.causes)


def label_rows(rows: DataFrame, table: RiskTable) -> DataFrame:
    return cleaning.drop_columns(cleaning.with_binary_label(rows, table.causes, table.label), table.dropped)


def build_features(spark: SparkSession, source: str, target: str, domain_path: str, table: RiskTable) -> DataFrame:
    """Label, drop, and encode every column; the codes are kept for later data."""
    rows = label_rows(tables.read_table(spark, source), table)
    domain = encoding.fit_label_encoder(rows)
    domain.save(domain_path)
    # codes stand for values one to one, so the key holds after encoding if it does before
    tables.write_feature_table(encoding.encode(rows, domain), target, table.key, source=rows)
    return tables.read_table(spark, target)


def encode_new(spark: SparkSession, rows: DataFrame, domain_path: str, unknown: str = "null") -> DataFrame:
    """Later rows in the codes of the feature table."""
    domain = encoding.LabelDomain.load(spark, domain_path)
    present = [c for c in domain.families if c in rows.columns]
    return encoding.encode(rows, domain, present, unknown)


def train(
    spark: SparkSession,
    features: str,
    model_path: str,
    log_path: str,
    name: str,
    table: RiskTable,
    grid: Sequence[Mapping[str, object]] = training.DEFAULT_GRID,
    force: bool = False,
    **options,
) -> DataFrame:
    """Search, keep the best model, log the run; a logged run is used again unless forced."""

    def run() -> dict[str, object]:
        rows = tables.read_table(spark, features)
        found = training.search(rows, table.label, table.features, table.key, grid, **options)
        if found.model is None:
            return {"status": "FAILED"}
        scoring.save_model(found.model, scoring.signature(rows, table.features.columns()), model_path)
        best = {k: v for k, v in found.best.items() if k != "detail"}
        return {**best, "model_path": model_path, "table": features}

    return runlog.get_or_train(spark, log_path, name, run, force)


def retrain(spark: SparkSession, *args, **options) -> DataFrame:
    """Search again on the table as it is now; the winner is fitted on all its rows."""
    return train(spark, *args, force=True, refit=True, **options)


def validate(
    spark: SparkSession,
    version: str,
    features: str,
    model_path: str,
    description: str | None,
    table: RiskTable,
    slice_cols: str | Sequence[str] | None = None,
    tags: str | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """(checks, decision) of a stored model on a feature table.

    With ``tags``, the path of a tag table, what is not given here is read from the version's tags
    ``slice_cols`` and ``description``; checks and decision are appended to the table once, and
    what is returned is read from it, so that the model scores the features once.
    """
    given = tag_store.tag_values(spark, tags, version, ["slice_cols", "description"]) if tags else {}
    slice_cols = slice_cols or given.get("slice_cols")
    description = description or given.get("description")
    model, schema = scoring.load_model(model_path)
    rows = tables.read_table(spark, features)
    checks = gate.run_checks(version, model, rows, schema, table.label, slice_cols, description, **options)
    if tags is None:
        return checks, gate.decide(checks)
    tag_store.store_checks(checks, tags)
    return review(spark, version, tags)


def review(spark: SparkSession, version: str, tags: str) -> tuple[DataFrame, DataFrame]:
    """(checks, decision) from the stored checks of a version; the decision becomes a tag as well."""
    known = tag_store.read_tags(spark, tags).where(F.col("version") == version)
    checks = tag_store.stored_checks(known, gate.CHECKS)
    decided = gate.decide(checks).first()
    if decided is None:
        raise ValueError(f"no checks of {version} are stored")
    tag_store.set_tags(spark, tags, version, {"decision": decided["decision"], "n_failed": decided["n_failed"]})
    now = tag_store.tags_wide(tag_store.read_tags(spark, tags).where(F.col("version") == version), ["decision", "n_failed"])
    return checks, now.select("version", "decision", F.col("n_failed").cast("bigint").alias("n_failed"))


def score(spark: SparkSession, features: str, model_path: str, target: str, table: RiskTable) -> DataFrame:
    """Write all feature columns with the prediction; returns (key, prediction)."""
    model, _ = scoring.load_model(model_path)
    rows = tables.read_table(spark, features)
    return scoring.score_to_table(model, rows, table.key, target)
