"""Row positions and running sums over a total order, without a one-task window.

A window with no partition key, or with one hot key, pulls its rows into one
task. Here the rows are range-partitioned by the order itself, so each task
holds one stretch of it. Only a summary with one row per stretch and group goes
through a window, and it gives every stretch its starting value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.plans.lookup import broadcast_if_small
from riskflow.plans.shared import materialize

#: Rows of a summary that are fetched; more are stored.
MAX_FETCHED = 100_000

_STRETCH = "_stretch"
_SEQUENCE = "_sequence"


def _same_stretch(left: DataFrame, right: DataFrame, group: Sequence[str]) -> Column:
    pairs = [left[g].eqNullSafe(right[f"_g{i}"]) for i, g in enumerate(group)]
    return reduce(lambda a, b: a & b, pairs, left[_STRETCH] == right[f"_{_STRETCH}"])


def _attach_offsets(
    stored: DataFrame,
    group: Sequence[str],
    totals: Sequence[Column],
    offsets: Mapping[str, Column],
    few_groups: bool,
) -> DataFrame:
    """Join each row with values computed from the stretches of its group.

    The summary has at most (tasks of the sort + groups) rows. When the groups are said to be few it
    is fetched once, as it would be worked out anew by every use of the result; otherwise, and if
    they turn out to be many, it is stored and measured.
    """
    spans = stored.groupBy(*group, _STRETCH).agg(*totals)
    named = spans.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col(_STRETCH).alias(f"_{_STRETCH}"),
        *[c.alias(name) for name, c in offsets.items()],
    )
    fetched = named.limit(MAX_FETCHED + 1).toArrow() if few_groups or not group else None
    if fetched is not None and fetched.num_rows <= MAX_FETCHED:
        named = stored.sparkSession.createDataFrame(fetched, named.schema)
        small = F.broadcast(named)
    else:
        named = materialize(named, "stretches")
        small = broadcast_if_small(named)
    joined = stored.join(small, _same_stretch(stored, named, group), "left")
    return joined.drop(*[f"_g{i}" for i in range(len(group))], f"_{_STRETCH}")


def _before(group: Sequence[str]):
    return W.partitionBy(*group).orderBy(_STRETCH).rowsBetween(W.unboundedPreceding, -1)


def with_positions(
    df: DataFrame,
    order: Sequence[str | Column],
    group: Sequence[str] = (),
    out: str = "position",
    few_groups: bool = False,
    size: str | None = None,
) -> DataFrame:
    """Add the 0-based position of each row within its group, in the given order.

    ``size`` names a further column with the rows of the group.

    The order must be total within a group for the result to be repeatable.
    ``few_groups`` says that the number of groups does not grow with the data.
    """
    ordered = df.orderBy(*group, *order).withColumn(_SEQUENCE, F.monotonically_increasing_id())
    # the upper 31 bits of the generated id are the partition, the lower 33 the row in it
    ordered = ordered.withColumn(_STRETCH, F.shiftright(_SEQUENCE, 33))
    stored = materialize(ordered, "ordered")
    placed = _attach_offsets(
        stored,
        group,
        [F.min(_SEQUENCE).alias("_first"), F.count(F.lit(1)).alias("_rows")],
        {
            "_first": F.col("_first"),
            "_prior": F.coalesce(F.sum("_rows").over(_before(group)), F.lit(0)),
            **({size: F.sum("_rows").over(W.partitionBy(*group))} if size else {}),
        },
        few_groups,
    )
    position = F.col(_SEQUENCE) - F.col("_first") + F.col("_prior")
    return placed.withColumn(out, position).drop(_SEQUENCE, _STRETCH, "_first", "_prior")


def running_sums(
    df: DataFrame,
    order: Sequence[str | Column],
    sums: Mapping[str, str],
    group: Sequence[str] = (),
    totals: Mapping[str, str] | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """Add inclusive running sums ``{output: input column}`` within each group.

    ``totals`` adds sums over the whole group, which cost nothing more. Input columns
    must not be null; the order must be total within a group.
    """
    totals = dict(totals or {})
    ordered = df.orderBy(*group, *order).withColumn(_STRETCH, F.spark_partition_id())
    stored = materialize(ordered, "ordered")
    inputs = sorted({*sums.values(), *totals.values()})
    whole = W.partitionBy(*group)
    placed = _attach_offsets(
        stored,
        group,
        [F.sum(source).alias(f"_sum_{source}") for source in inputs],
        {
            **{f"_from_{out}": F.sum(f"_sum_{source}").over(_before(group)) for out, source in sums.items()},
            **{out: F.sum(f"_sum_{source}").over(whole) for out, source in totals.items()},
        },
        few_groups,
    )
    within = W.partitionBy(*group, _STRETCH).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    running = [
        (F.coalesce(F.col(f"_from_{out}"), F.lit(0)) + F.sum(source).over(within)).alias(out)
        for out, source in sums.items()
    ]
    return placed.select(*df.columns, *running, *totals)
