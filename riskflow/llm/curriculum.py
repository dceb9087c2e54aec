"""Mix sources to target weights by a curriculum that changes over training.

A source's share is its target number of words, capped at a multiple of what it has;
what is cut off is shared again by weight (one level lets every source reach
``min(cap, level * weight)``). Over training time t in 0..1 a source's weight is
``target * (1 + slope * (2t - 1))``; its integral from 0 to t is the demand so far. A
document that starts after c words of its source is read when the demand reaches c:
inverting the integral gives its position, and a range sort by position gives the
training order.

DataFrame functions only. Running sums over a source are taken within range partitions
and shifted by the sums of the partitions before, so a source may hold any share of the
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.llm.grouping import join_groups
from riskflow.plans.shared import materialize

CAP = 3
WEIGHTS = (1, 2, 3)
#: How a source's weight changes over training, by its place: falling, steady, rising.
SLOPES = (-0.5, 0.0, 0.5)

_WORD = "[^\\x20\\x09-\\x0D]+"


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def _cycle(rank: Column, values: tuple) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(rank - 1, F.lit(len(values))) + 1).cast("int"))


def source_targets(sized: DataFrame) -> DataFrame:
    """One row per source: source_key, n_rows, source_size, weight, slope, target.

    Sources count by code point, null last. The windows run over one row per source.
    """
    sources = sized.groupBy("source", "source_key").agg(F.count("*").alias("n_rows"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    sources = materialize(sources.withColumn("rank", rank), "sources").withColumns(
        {"weight": _cycle(F.col("rank"), WEIGHTS).cast("bigint"), "slope": _cycle(F.col("rank"), SLOPES)}
    )
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"]
    # from the source that meets its cap first: words left and weight left when its turn comes
    turn = F.struct((F.col("source_size") * CAP / F.col("weight")).alias("ratio"), F.col("rank"))
    order = W.orderBy(turn)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(0, W.unboundedFollowing)
    turns = sources.withColumn(
        "level",
        (F.lit(total) - CAP * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(after),
    ).withColumn("capped", CAP * F.col("source_size") < F.col("level") * F.col("weight"))
    # the first that stays below its cap knows what all before it have taken
    level = turns.where("not capped").agg(F.min_by("level", turn).alias("level"))
    reached = F.least(F.col("source_size") * F.lit(float(CAP)), F.col("common.level") * F.col("weight"))
    return turns.drop("level", "capped").crossJoin(F.broadcast(level.alias("common"))).select(
        "source_key", "n_rows", "source_size", "weight", "slope", F.coalesce(reached, F.lit(0.0)).alias("target")
    )


def _position(demand: Column) -> Column:
    """Time when the demand, as a share of the target, is reached."""
    slope = F.col("slope")
    root = F.sqrt((1 - slope) * (1 - slope) + 4 * slope * demand)
    return F.when(slope == 0, demand).otherwise((root - (1 - slope)) / (2 * slope))


def mix_sources(documents: DataFrame, key: str | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken, position and what places each pass.

    ``documents`` needs ``doc_id``, ``source`` and ``text``; one row is returned for each of
    its rows. size counts words, 0 for a null text. A source's passes run through its
    documents in an order that depends on doc_id alone; the last pass ends, within a
    document if need be, where the target is met, so that the words taken from a source
    differ from its target by less than one. ``first`` is where a document begins in its
    source, ``position`` the time of its first reading, null if it is never read. Null
    sources are one source, ties and repeated rows are all counted, no rows give no rows.
    ``key`` names a unique integer column that is carried along, for rows whose doc_id is
    null or repeated, and decides between ties.
    """
    keys = [key] if key else []
    sized = materialize(
        documents.select(
            *keys,
            F.col("doc_id").cast("bigint"),
            F.col("source").cast("string").alias("source"),
            F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("source_key"),
            count_words(F.col("text")).alias("size"),
            F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("turn"),
        ),
        "sized",
    )
    targets = materialize(source_targets(sized), "targets")
    order = ["source_key", "turn", "doc_id", "size", *keys]
    placed = materialize(
        sized.drop("source").repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "placed"
    )
    parts = placed.groupBy("source_key", "part").agg(F.sum("size").alias("part_size"))
    earlier = W.partitionBy("source_key").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("source_key", "part", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("before"))
    inside = W.partitionBy("source_key", "part").orderBy(*order[1:]).rowsBetween(W.unboundedPreceding, -1)
    started = placed.join(parts, ["source_key", "part"]).withColumn(
        "first", F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.col("before")
    )
    mixed = join_groups(started.drop("part", "before"), targets, "source_key", "n_rows")
    wanted = F.floor(F.col("target") + 0.5)
    passes = F.when(F.col("source_size") > 0, F.expr("floor(target + 0.5) div source_size")).otherwise(0).cast("bigint")
    rest = wanted - F.col("passes") * F.col("source_size")
    return (
        mixed.withColumn("passes", passes)
        .withColumn("last", F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("first"))).cast("bigint"))
        .withColumn("taken", F.col("passes") * F.col("size") + F.col("last"))
        .withColumn("position", F.when(F.col("taken") > 0, _position(F.col("first") / F.col("target"))))
        .select(
            *keys, "doc_id", "size", "source_size", "target", "taken", "position", "first", "passes", "last", "slope",
        )
    )


def readings(mixed: DataFrame, key: str | None = None) -> DataFrame:
    """(key, doc_id, pass, words, position): one row for each time a document is read."""
    keys = [key] if key else []
    times = F.col("passes") + F.when(F.col("last") > 0, 1).otherwise(0)
    each = mixed.where(F.col("taken") > 0).select(
        "*", F.explode(F.sequence(F.lit(1), times.cast("int"))).alias("pass")
    )
    demand = ((F.col("pass") - 1) * F.col("source_size") + F.col("first")) / F.col("target")
    words = F.when(F.col("pass") <= F.col("passes"), F.col("size")).otherwise(F.col("last"))
    return each.select(*keys, "doc_id", "pass", words.alias("words"), _position(demand).alias("position"))
