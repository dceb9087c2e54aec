"""Feature attribution: exact for a linear margin, sampled coalitions for any model.

Kernel SHAP is the weighted least-squares form of Lundberg and Lee (2017). The
coalitions and their weights are the same for all examples, so the solution is a
fixed matrix applied to the mean scores: on the rows it is a plain weighted sum.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable, Mapping, Sequence
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions.columns import quoted, require

#: Rows sampled by default, as background and to be explained.
SAMPLE_ROWS = 100
#: Timestamps keep their microseconds on the way through the plan.
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def linear_attribution(df: DataFrame, coefficients: Mapping[str, float]) -> DataFrame:
    """Per feature: mean absolute phi, where phi = coefficient * (x - mean of x).

    Rows are ranked by importance, ties by name.
    """
    names = list(coefficients)
    require(df, names)
    means = df.agg(*[F.avg(quoted(c)).alias(f"_{i}") for i, c in enumerate(names)]).first()
    sums = df.agg(
        *[
            F.avg(F.abs((F.col(quoted(c)) - F.lit(means[f"_{i}"])) * F.lit(float(coefficients[c])))).alias(f"_{i}")
            for i, c in enumerate(names)
        ]
    )
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"_{i}").alias("importance")) for i, c in enumerate(names)]
    return (
        sums.select(F.explode(F.array(*rows)).alias("_r"))
        .select("_r.*")
        .orderBy(F.desc("importance"), "feature")
    )


def linear_phi(df: DataFrame, coefficients: Mapping[str, float], means: Mapping[str, float]) -> DataFrame:
    """phi of every feature of every row, as columns ``phi_<feature>``."""
    return df.withColumns(
        {f"phi_{c}": (F.col(quoted(c)) - F.lit(means[c])) * F.lit(float(w)) for c, w in coefficients.items()}
    )


def coalitions(n_features: int, n_coalitions: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """0/1 rows and their weights, without the empty and the full coalition.

    All coalitions with their kernel weight when they are few enough; otherwise
    sizes are drawn by their total kernel weight, and each draw brings its complement.
    """
    if n_features < 2:
        return np.zeros((0, n_features), dtype=int), np.zeros(0)
    sizes = np.arange(1, n_features)
    size_weight = (n_features - 1) / (sizes * (n_features - sizes))
    if 2**n_features - 2 <= n_coalitions:
        rows = [r for r in itertools.product((0, 1), repeat=n_features) if 0 < sum(r) < n_features]
        masks = np.array(rows)
        counts = masks.sum(axis=1)
        return masks, np.array([size_weight[k - 1] / comb(n_features, k) for k in counts])
    draw = np.random.default_rng(seed)
    share = size_weight / size_weight.sum()
    weight: dict[tuple[int, ...], float] = {}
    for _ in range(max(1, n_coalitions // 2)):
        size = draw.choice(sizes, p=share)
        mask = np.zeros(n_features, dtype=int)
        mask[draw.choice(n_features, size=size, replace=False)] = 1
        for row in (mask, 1 - mask):
            key = tuple(int(v) for v in row)
            weight[key] = weight.get(key, 0.0) + 1.0
    return np.array(list(weight)), np.array(list(weight.values()))


def solution_matrix(masks: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(matrix, slope): phi[:-1] = matrix @ (y - slope * total), with y and total less the base.

    The last feature takes what is left, which makes the phis add up to the total.
    """
    design = masks[:, :-1] - masks[:, -1:]
    scaled = design * weights[:, None]
    matrix = np.linalg.pinv(design.T @ scaled) @ scaled.T
    return matrix, masks[:, -1].astype(float)


def kernel_shap(
    score: Callable[[DataFrame], DataFrame],
    background: DataFrame,
    examples: DataFrame,
    features: Sequence[str],
    key: str,
    n_coalitions: int = 500,
    seed: int = 0,
    prediction: str = "prediction",
    n_background: int = SAMPLE_ROWS,
    n_examples: int = SAMPLE_ROWS,
) -> DataFrame:
    """Attribution of each example's prediction to its features: (key, feature, phi, base, score).

    ``score`` adds the prediction column to a DataFrame. ``n_background`` rows of the
    background are sampled; they travel with the plan as a constant, as do the coalitions.
    ``n_examples`` rows of the examples are explained. Examples that share a key but not their
    features are explained each, equal ones once. Each example is
    unfolded into one row per coalition and background row, scored, and folded back.
    """
    names = list(features)
    require(examples, [key, *names])
    require(background, names)
    drawn = [F.xxhash64(F.lit(seed), *[F.col(quoted(c)) for c in names]), *[F.col(quoted(c)) for c in names]]
    rows = background.select(*[F.col(quoted(c)) for c in names]).orderBy(*drawn).limit(n_background).collect()
    if not rows:
        raise ValueError("the background needs at least one row")
    examples = examples.orderBy(F.xxhash64(F.lit(seed), F.col(quoted(key))), *drawn).limit(n_examples)

    masks, weights = coalitions(len(names), n_coalitions, seed)
    matrix, slope = solution_matrix(masks, weights) if len(masks) else (np.zeros((0, 0)), np.zeros(0))
    # the last two terms are all features and none
    none = [0.0] * max(len(names) - 1, 0)
    terms = [{"mask": [int(v) for v in mask], "solve": [float(v) for v in matrix[:, i]]} for i, mask in enumerate(masks)]
    terms.append({"mask": [1] * len(names), "solve": none})
    terms.append({"mask": [0] * len(names), "solve": none})

    spark = examples.sparkSession
    # constants of the plan: their size depends on the parameters, not on the data
    base_rows = spark.createDataFrame(rows, background.select(*names).schema)
    packed = base_rows.select(F.to_json(F.collect_list(F.struct(*names)), _EXACT).alias("j")).first()["j"]
    row_type = "array<struct<" + ",".join(
        f"`{f.name}`:{f.dataType.simpleString()}" for f in background.select(*names).schema
    ) + ">>"
    mask_type, solve_type = "array<array<int>>", "array<array<double>>"
    mask_text = json.dumps([t["mask"] for t in terms])
    unfolded = examples.select(
        F.struct(F.col(quoted(key)).alias("key"), F.xxhash64(*[F.col(quoted(c)) for c in names]).alias("row")).alias("_key"),
        *[F.col(quoted(c)).alias(f"_x{i}") for i, c in enumerate(names)],
        F.posexplode(F.from_json(F.lit(mask_text), mask_type)).alias("_term", "_mask"),
    )
    # a sample is one partition: spread it before it grows, on the keys it is folded by
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    unfolded = unfolded.repartition(tasks, "_key", "_term")
    unfolded = unfolded.withColumn("_b", F.explode(F.from_json(F.lit(packed), row_type, _EXACT)))
    mixed = unfolded.select(
        "_key",
        "_term",
        *[
            F.when(F.col("_mask")[i] == 1, F.col(f"_x{i}")).otherwise(F.col(f"_b.`{c}`")).alias(c)
            for i, c in enumerate(names)
        ],
    )
    means = score(mixed).groupBy("_key", "_term").agg(F.avg(F.col(prediction).cast("double")).alias("_y"))

    solve_text = json.dumps([t["solve"] for t in terms])
    solved = means.withColumn("_solve", F.from_json(F.lit(solve_text), solve_type)[F.col("_term")])
    full, empty = len(terms) - 2, len(terms) - 1
    sums = solved.groupBy("_key").agg(
        F.max(F.when(F.col("_term") == full, F.col("_y"))).alias("score"),
        F.max(F.when(F.col("_term") == empty, F.col("_y"))).alias("base"),
        *[F.sum(F.col("_solve")[j] * F.col("_y")).alias(f"_a{j}") for j in range(len(names) - 1)],
    )
    # the base and the slope enter with constant factors
    total = F.col("score") - F.col("base")
    phis = [
        F.col(f"_a{j}") - F.col("base") * F.lit(float(matrix[j].sum())) - total * F.lit(float(matrix[j] @ slope))
        for j in range(len(names) - 1)
    ]
    last = total
    for phi in phis:
        last = last - phi
    phis.append(last)
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), p.alias("phi")) for c, p in zip(names, phis)])
    return sums.select(F.col("_key.key").alias(key), F.explode(entries).alias("_e"), "base", "score").select(
        key, "_e.feature", "_e.phi", "base", "score"
    )


def importance(phis: DataFrame) -> DataFrame:
    """Features by mean absolute phi, largest first."""
    return (
        phis.groupBy("feature")
        .agg(F.avg(F.abs("phi")).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )
