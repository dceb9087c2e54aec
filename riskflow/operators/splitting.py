"""Repeatable splits, class weights, samples and hold-outs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions.columns import hash_slot, key_hash, quoted, require
from riskflow.plans.lookup import lookup_join
from riskflow.plans.ordering import with_positions
from riskflow.plans.shared import materialize

SPLIT_NAMES = ("train", "val", "test")
SPLIT_WEIGHTS = (6000, 2000, 2000)


def _assign(slot, weights: Sequence[int], names: Sequence[str]):
    """Name of the part whose range of slots holds ``slot``."""
    edge = 0
    choice = None
    for weight, name in zip(weights[:-1], names[:-1]):
        edge += weight
        test = slot < edge
        choice = F.when(test, F.lit(name)) if choice is None else choice.when(test, F.lit(name))
    return F.lit(names[-1]) if choice is None else choice.otherwise(F.lit(names[-1]))


def with_split(
    df: DataFrame,
    key: str,
    seed: int = 0,
    weights: Sequence[int] = SPLIT_WEIGHTS,
    names: Sequence[str] = SPLIT_NAMES,
    out: str = "split",
    stratify: str | None = None,
) -> DataFrame:
    """Add the part (train, val, test) a row belongs to.

    The part depends on the key and the seed alone, so it needs no shuffle and never
    changes when rows are added. With ``stratify`` each label is cut by the rank of
    its hashed keys, which keeps even rare labels in all parts.
    """
    require(df, [key])
    total = sum(weights)
    if stratify is None:
        return df.withColumn(out, _assign(hash_slot(F.col(quoted(key)), seed, total), weights, names))
    return _stratified(df, key, seed, weights, names, out, stratify)


def _stratified(df, key, seed, weights, names, out, stratify) -> DataFrame:
    """Cut each label where its hashed keys reach the wanted shares.

    Only (label, hash, key) is sorted. The cuts are one row per label, and telling
    the part of a row is a comparison with them.
    """
    total = sum(weights)
    spot = F.struct(key_hash(F.col(quoted(key)), seed).alias("hash"), F.col(quoted(key)).alias("key"))
    slim = df.select(F.col(quoted(stratify)).alias("_class"), spot.alias("_spot")).where(F.col("_class").isNotNull())
    slim = slim.where(F.col("_spot.key").isNotNull())
    ranked = with_positions(slim, ["_spot"], ["_class"], out="_rank", few_groups=True, size="_size")
    slot = F.floor(F.col("_rank") * total / F.col("_size"))
    edges = [sum(weights[: i + 1]) for i in range(len(weights) - 1)]
    cuts = ranked.groupBy("_class").agg(
        F.count(F.lit(1)).alias("_class_rows"),
        *[F.min(F.when(slot >= edge, F.col("_spot"))).alias(f"_cut{i}") for i, edge in enumerate(edges)],
    )
    cut_names = [f"_cut{i}" for i in range(len(edges))]
    cuts = materialize(cuts, "cuts")
    placed = lookup_join(df, cuts, [(stratify, "_class")], ["_class_rows", *cut_names], weight=None)
    choice = F.lit(names[-1])
    for name, cut in reversed(list(zip(names, cut_names))):
        choice = F.when(F.col(cut).isNull() | (spot < F.col(cut)), F.lit(name)).otherwise(choice)
    # rows without a label or without a key are cut by their hash alone, as without strata
    plain = _assign(hash_slot(F.col(quoted(key)), seed, total), weights, names)
    result = F.when(F.col(quoted(stratify)).isNull() | F.col(quoted(key)).isNull(), plain).otherwise(choice)
    return placed.withColumn(out, result).drop("_class_rows", *cut_names)


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Weight rows / (classes * rows of the class): every class gets the same total."""
    require(df, [label])
    counts = materialize(
        df.where(F.col(quoted(label)).isNotNull())
        .groupBy(F.col(quoted(label)).alias("_class"))
        .agg(F.count(F.lit(1)).alias("_class_rows")),
        "classes",
    )
    totals = counts.agg(F.coalesce(F.sum("_class_rows"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("classes")).first()
    weighted = counts.withColumn(
        out, F.lit(float(totals["rows"])) / (F.lit(float(totals["classes"])) * F.col("_class_rows"))
    )
    return lookup_join(df, weighted, [(label, "_class")], [out], weight="_class_rows")


def sample_n(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """The n rows with the smallest key hash: a random-looking sample that repeats exactly."""
    require(df, [key])
    hashed = df.withColumn("_hash", key_hash(F.col(quoted(key)), seed))
    return hashed.orderBy("_hash", quoted(key)).limit(n).drop("_hash")


def hold_out(df: DataFrame, key: str, share: float, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(kept, held back). Both are filters on the key hash, so no join is needed to tell them apart."""
    require(df, [key])
    held = hash_slot(F.col(quoted(key)), seed) < round(share * 10_000)
    held = F.coalesce(held, F.lit(False))
    return df.where(~held), df.where(held)
