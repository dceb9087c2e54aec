"""Hard negatives by segment summary filtering: inner products bounded from means and deviations.

A vector is cut into segments; of each segment its mean and its deviation (the length of what is
left after the mean is taken away) are stored beside it. The inner product of two
segments of m components is m times the product of the means, plus or minus at most the
product of the deviations. Summed over segments this bounds a score from both sides. Every
pair is bounded with few segments first; what a bound cannot rule out is bounded again with
more and shorter segments, and only what is then still open is multiplied out.

Both steps are one search: of the rows with the same (or another) label as the anchor, the
first k with a score inside a window. Anchors are taken in blocks of bounded bytes, the one thing
that is sent to all tasks; rows stay where they are and each task keeps k rows per
window. So that tasks do not all send k rows for every window, rows are dealt by a hash into
levels, each FACTOR times the size of all before, and the k-th score found in one level is
what a row of the next has to reach: a level adds about FACTOR * k rows to a window,
however many tasks it has.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.plans.shared import materialize, new_path

#: Segments by which pairs are bounded, coarse first.
SEGMENTS = (4, 16)
#: Bytes of anchors that are searched for together.
ANCHOR_BYTES = 32 << 20
#: Rows of the first level, and how many times the rows before a further level has.
FIRST_LEVEL = 2048
FACTOR = 3
#: Anchors and rows that are compared at a time.
TILE_ANCHORS = 256
TILE_ROWS = 2048
#: Where more than this share of a tile is open, the whole tile is worked out at once.
DENSE = 0.05

_LOWEST = np.iinfo(np.int64).min
_HIGHEST = np.iinfo(np.int64).max
_STORED = "vec_id bigint, label bigint, anchor boolean, row bigint, level int, vector array<bigint>, means array<double>, deviations array<double>"
_HIT = pa.schema([("window", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def segment_borders(width: int, segments: int) -> np.ndarray:
    """Where up to ``segments`` segments of about equal length begin, and the end."""
    return np.unique(np.linspace(0, width, min(segments, width) + 1).astype(np.int64))


def summaries(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """(means, deviations) of each row's segments; a deviation is a root of a sum of squares."""
    vectors = vectors.astype(np.float64)
    if not vectors.shape[1]:
        empty = np.zeros((len(vectors), 0))
        return empty, empty
    borders = segment_borders(vectors.shape[1], segments)
    sizes = np.diff(borders)
    means = np.add.reduceat(vectors, borders[:-1], axis=1) / sizes
    left = vectors - np.repeat(means, sizes, axis=1)
    return means, np.sqrt(np.add.reduceat(left * left, borders[:-1], axis=1))


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    """Lists as rows of a matrix; shorter ones end in zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width).astype(kind)
    out = np.zeros((len(lengths), width), kind)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _summarise(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = _matrix(batch.column("vector"), width, np.int64)
        parts = [summaries(vectors, n) for n in SEGMENTS]
        means = np.concatenate([m for m, _ in parts], axis=1)
        deviations = np.concatenate([d for _, d in parts], axis=1)
        places = pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * means.shape[1])
        lists = [pa.ListArray.from_arrays(places, pa.array(x.ravel())) for x in (means, deviations)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=[*batch.schema.names, "means", "deviations"])


@dataclass
class Vectors:
    """Rows with their summaries, as matrices."""

    rows: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    means: list[np.ndarray]
    deviations: list[np.ndarray]

    @classmethod
    def of(cls, batch: pa.RecordBatch | pa.Table, width: int) -> Vectors:
        if isinstance(batch, pa.Table):
            batch = batch.combine_chunks().to_batches()[0]
        sizes = [len(segment_borders(width, n)) - 1 if width else 0 for n in SEGMENTS]
        cuts = np.cumsum(sizes)[:-1]
        means = _matrix(batch.column("means"), sum(sizes), np.float64)
        deviations = _matrix(batch.column("deviations"), sum(sizes), np.float64)
        return cls(
            batch.column("row").to_numpy(),
            batch.column("label").to_numpy(),
            _matrix(batch.column("vector"), width, np.int64),
            np.split(means, cuts, axis=1),
            np.split(deviations, cuts, axis=1),
        )

    def slice(self, lo: int, hi: int) -> Vectors:
        return Vectors(
            self.rows[lo:hi],
            self.labels[lo:hi],
            self.vectors[lo:hi],
            [m[lo:hi] for m in self.means],
            [d[lo:hi] for d in self.deviations],
        )


def score_bounds(one: Vectors, other: Vectors, level: int, pairs: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores of all pairs, or of some, at one level of segments."""
    width = one.vectors.shape[1]
    sizes = np.diff(segment_borders(width, SEGMENTS[level])).astype(np.float64) if width else np.zeros(0)
    mean, deviation = one.means[level] * sizes, one.deviations[level]
    if pairs is None:
        middle, around = mean @ other.means[level].T, deviation @ other.deviations[level].T
    else:
        a, b = pairs
        middle = np.einsum("ij,ij->i", mean[a], other.means[level][b])
        around = np.einsum("ij,ij->i", deviation[a], other.deviations[level][b])
    # rounding of the sums, and of means and deviations
    slack = 1.0 + 1e-9 * (np.abs(middle) + around)
    return middle - around - slack, middle + around + slack


def exact_scores(one: np.ndarray, other: np.ndarray, pairs: tuple | None = None) -> np.ndarray:
    """Integer inner products of all pairs, or of some."""
    most = float(np.abs(one).max(initial=0)) * float(np.abs(other).max(initial=0)) * max(one.shape[1], 1)
    kind = np.float64 if most < 2.0**53 else np.int64  # sums below 2**53 are exact in doubles
    one, other = one.astype(kind), other.astype(kind)
    found = one @ other.T if pairs is None else np.einsum("ij,ij->i", one[pairs[0]], other[pairs[1]])
    return found.astype(np.int64)


@dataclass
class Windows:
    """What is searched: of each window its anchor (a place in the block), and the scores it allows.

    Windows are sorted by anchor. ``other_label`` says whether rows need another label than the
    anchor, ``k`` how many rows a window takes.
    """

    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    k: int
    other_label: bool


def _span(bounds: np.ndarray, fill: int, reduce, anchor: np.ndarray, n: int) -> np.ndarray:
    """The least or greatest bound among each anchor's windows."""
    out = np.full(n, fill, np.float64)
    reduce.at(out, anchor, bounds.astype(np.float64))
    return out


class Search:
    """Runs windows over batches of rows and keeps the k first rows of each."""

    def __init__(self, anchors: Vectors, windows: Windows) -> None:
        self.anchors, self.windows = anchors, windows
        self.first = np.searchsorted(windows.anchor, np.arange(len(anchors.rows) + 1))
        self.low = windows.low.copy()  # rises to the k-th score found
        self.hits = [np.zeros(0, np.int64) for _ in range(4)]  # window, row, vec_id, score
        self.null = np.zeros(0, dtype=bool)

    def add(self, rows: Vectors, vec_ids: np.ndarray, null: np.ndarray) -> None:
        n = len(self.anchors.rows)
        for lo in range(0, n, TILE_ANCHORS):
            hi = min(lo + TILE_ANCHORS, n)
            if self.first[hi] > self.first[lo]:
                self._tile(lo, hi, rows, vec_ids, null)

    def _open(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """The scores that any window of each anchor in lo..hi-1 would take."""
        w = slice(self.first[lo], self.first[hi])
        anchor = self.windows.anchor[w] - lo
        low = _span(self.low[w], np.inf, np.minimum, anchor, hi - lo)
        high = _span(self.windows.high[w], -np.inf, np.maximum, anchor, hi - lo)
        return low, high

    def _tile(self, lo: int, hi: int, rows: Vectors, vec_ids: np.ndarray, null: np.ndarray) -> None:
        anchors = self.anchors.slice(lo, hi)
        least, most = self._open(lo, hi)
        same = anchors.labels[:, None] == rows.labels[None, :]
        open_ = ~same if self.windows.other_label else same & (anchors.rows[:, None] != rows.rows[None, :])
        a, b = None, None
        for level in range(len(SEGMENTS)):
            if a is None:
                lower, upper = score_bounds(anchors, rows, level)
                open_ &= (upper >= least[:, None]) & (lower <= most[:, None])
                if np.count_nonzero(open_) <= DENSE * open_.size:
                    a, b = np.nonzero(open_)
            else:
                lower, upper = score_bounds(anchors, rows, level, (a, b))
                kept = (upper >= least[a]) & (lower <= most[a])
                a, b = a[kept], b[kept]
        if a is None:
            all_scores = exact_scores(anchors.vectors, rows.vectors)
            a, b = np.nonzero(open_ & (all_scores >= least[:, None]) & (all_scores <= most[:, None]))
            scores = all_scores[a, b]
        else:
            scores = exact_scores(anchors.vectors, rows.vectors, (a, b))
        self._keep(a + lo, b, scores, rows, vec_ids, null)

    def _keep(self, a, b, scores, rows: Vectors, vec_ids, null) -> None:
        """Pairs, sorted by anchor, into the windows that take them."""
        many = self.first[a + 1] - self.first[a]
        pair = np.repeat(np.arange(len(a)), many)
        window = np.repeat(self.first[a] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        score = scores[pair]
        good = (score >= self.low[window]) & (score <= self.windows.high[window])
        pair, window = pair[good], window[good]
        if not len(pair):
            return
        at = b[pair]
        hits = [np.concatenate(x) for x in zip(self.hits, (window, rows.rows[at], vec_ids[at], scores[pair]))]
        self.null = np.concatenate([self.null, null[at]])
        order = np.lexsort((hits[1], hits[2], self.null, -hits[3], hits[0]))
        window = hits[0][order]
        turn = np.arange(len(window)) - np.searchsorted(window, window)
        order = order[turn < self.windows.k]
        self.hits, self.null = [h[order] for h in hits], self.null[order]
        turn = turn[turn < self.windows.k]
        full = turn == self.windows.k - 1
        self.low[self.hits[0][full]] = np.maximum(self.low[self.hits[0][full]], self.hits[3][full])


def _run_search(anchors: Vectors, windows: Windows, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(anchors, windows)
        for batch in batches:
            for lo in range(0, batch.num_rows, TILE_ROWS):
                part = batch.slice(lo, TILE_ROWS)
                ids = part.column("vec_id")
                null = ids.is_null().to_numpy(zero_copy_only=False)
                search.add(Vectors.of(part, width), ids.fill_null(0).to_numpy(), null)
        window, row, vec_id, score = search.hits
        yield pa.RecordBatch.from_arrays(
            [pa.array(window), pa.array(row), pa.array(vec_id, mask=search.null), pa.array(score)], schema=_HIT
        )

    return run


def _top(hits: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("row"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _first_in_windows(stored: DataFrame, levels: int, anchors: Vectors, windows: Windows, width: int, label: str) -> DataFrame:
    """window, row, vec_id, score, rank: the first k rows of each window, level by level."""
    best = None
    columns = ["row", "vec_id", "label", "vector", "means", "deviations"]
    for level in range(levels):
        rows = stored.where(F.col("level") == level).select(*columns)
        hits = rows.mapInArrow(_run_search(anchors, windows, width), "window bigint, row bigint, vec_id bigint, score bigint")
        if best is not None:
            hits = hits.unionByName(best.drop("rank"))
        best = materialize(_top(hits, windows.k), f"{label}_{level}")
        if level + 1 < levels:
            # one row per window at most, and windows belong to the block
            reached = best.where(F.col("rank") == windows.k).select("window", "score").toArrow()
            low = windows.low.copy()
            low[reached["window"].to_numpy()] = np.maximum(low[reached["window"].to_numpy()], reached["score"].to_numpy())
            windows = Windows(windows.anchor, low, windows.high, windows.k, windows.other_label)
    return best


def _prepare(rows: DataFrame, anchor: Column, scale: int) -> tuple[DataFrame, int, int]:
    """(stored rows with integer vectors and summaries, longest vector, levels)."""
    vector = F.col("embedding").cast("array<double>")
    whole = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    usable = rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.transform(vector, lambda x: F.floor(x * F.lit(float(scale)))).alias("vector"),
        F.coalesce(whole, F.lit(False)).alias("_whole"),
    ).where("_whole and label is not null").drop("_whole")
    size = usable.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width")).first()
    n, width = size["n"], size["width"]
    shares = []  # of all rows, up to and including each level
    share = FIRST_LEVEL / max(n, 1)
    while share < 1:
        shares.append(share)
        share *= FACTOR + 1
    slot = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(1 << 30))
    level = F.lit(len(shares))
    for i, part in reversed(list(enumerate(shares))):
        level = F.when(slot < int(part * (1 << 30)), F.lit(i)).otherwise(level)
    numbered = usable.withColumn("row", F.monotonically_increasing_id()).withColumn("level", level)
    numbered = numbered.select("vec_id", "label", "anchor", "row", "level", "vector")
    summed = numbered.mapInArrow(lambda batches: _summarise(batches, width), _STORED)
    path = new_path(rows.sparkSession, "vectors")
    summed.write.partitionBy("level").parquet(path)
    return rows.sparkSession.read.schema(summed.schema).parquet(path), width, len(shares) + 1


def mine_hard_negatives(
    rows: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` needs ``vec_id``, ``embedding`` and ``label``; other columns are not looked at.
    ``anchor`` is a condition on its columns. Components become floor(scale * x); a score is an
    integer inner product, which has to fit 64 bits. Higher scores come first, equal ones by smaller
    vec_id, null last. For each anchor and each of its first ``positives`` other rows of the same label,
    the first ``negatives`` rows of another label with
    ``low * positive_score <= 100 * score <= high * positive_score``.

    Rows with a null label, a null vector, or a null or non-finite component take no part. A shorter
    vector counts as ending in zeros, an empty one scores 0. A positive with a negative score has no
    negatives. Every row counts for itself: a repeated anchor row gives its lines again, and is a
    positive of its copies. Empty tables give no rows.
    """
    stored, width, levels = _prepare(rows, anchor, scale)
    chosen = materialize(stored.where("anchor").drop("anchor", "level"), "anchors")
    many = chosen.count()
    blocks = many * max(width, 1) * 24 // ANCHOR_BYTES + 1
    found = None
    for block in range(blocks):
        table = chosen.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).toArrow()
        if not table.num_rows:
            continue
        ids = table["vec_id"].to_pylist()
        anchors = Vectors.of(table, width)
        n = len(ids)
        every = Windows(np.arange(n), np.full(n, _LOWEST), np.full(n, _HIGHEST), positives, False)
        near = _first_in_windows(stored, levels, anchors, every, width, "positives")
        near = near.orderBy("window", "rank").toArrow()  # ``positives`` rows an anchor of the block
        score = near["score"].to_numpy()
        windows = Windows(
            near["window"].to_numpy(),
            np.array([-((-low * int(s)) // 100) for s in score], np.int64),
            np.array([(high * int(s)) // 100 for s in score], np.int64),
            negatives,
            True,
        )
        far = _first_in_windows(stored, levels, anchors, windows, width, "negatives")
        names = pa.table(
            {
                "window": pa.array(np.arange(len(score))),
                "anchor_id": pa.array([ids[i] for i in windows.anchor.tolist()], pa.int64()),
                "positive_id": near["vec_id"],
                "positive_score": near["score"],
            }
        )
        # one row for each window of the block
        named = far.join(F.broadcast(rows.sparkSession.createDataFrame(names)), "window")
        part = named.select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
        found = part if found is None else found.unionByName(part)
    if found is None:
        schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return rows.sparkSession.createDataFrame([], schema)
    return found
