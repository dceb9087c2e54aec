"""Near-duplicate documents: universal hash minima, banding, verification, components.

A document is the set of its distinct word shingles. Documents with equal sets are one
class at once. For every class ``minima`` universal hashes of the shingles give a
signature; its bands are bucket keys. Inside a bucket pairs of classes are compared,
first by their signatures, then by their full sets, until every pair of the bucket that
is not already connected has been compared:

1. each class with the smallest class of its buckets, which settles most groups of
   copies at one comparison a member,
2. in buckets of up to SMALL classes that still hold several components, the classes
   outside the largest component with all others, pair by pair,
3. in larger ones the same, but no pair becomes a row: classes that share such buckets
   are a cluster, cut into chunks of CHUNK_BYTES of sets; each two chunks meet in one
   task, which counts common shingles and returns only links that join components.

So a group of copies costs one comparison a member, a dense group of texts just below
the threshold is spread over many bounded tasks, and no link is lost to a cap. With 36
bands of 5 rows, a pair at similarity 0.8 misses all bands with probability 6e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.components import components
from riskflow.llm.grouping import join_groups, maybe_among
from riskflow.llm.words import column_words, mix, text_blocks
from riskflow.plans.shared import materialize, working_tables

BANDS = 36
ROWS = 5
#: How far below the threshold a signature's estimate may lie, in standard deviations.
SLACK = 5.0
#: Minima of the longer signature by which pairs are screened.
SCREEN = 512
#: Classes of a bucket whose open pairs become rows, and bytes of sets in a chunk of a cluster.
SMALL = 16
CHUNK_BYTES = 8 << 20

_FACTORS = mix(np.arange(1, 4097, dtype=np.uint64)).astype(np.uint32)


def _universal(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of n hashes a*x + b modulo 2**32."""
    return (_FACTORS[:n] | np.uint32(1))[:, None], _FACTORS[n : 2 * n][:, None]


def _shingles(hashes: np.ndarray, begin: int, end: int, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of the words begin..end."""
    words = hashes[begin:end]
    size = min(k, len(words))
    if size == 0:
        return words
    value = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        value = mix(value + words[i : len(words) - size + 1 + i])
    value.sort()
    return value[np.append(True, value[1:] != value[:-1])]


def _signature(shingles: np.ndarray, minima: int) -> np.ndarray:
    """Smallest value of each universal hash over the shingles, in blocks that stay in cache."""
    a, b = _universal(minima)
    x = shingles.astype(np.uint32)
    least = np.full(minima, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(x), 1024):
        np.minimum(least, (a * x[i : i + 1024] + b).min(axis=1), out=least)
    return least


def _band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    grid = signature.reshape(bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + grid[:, i])
    return key.view(np.int64)


def _set_print(shingles: np.ndarray) -> bytes:
    """16 bytes that name a set: two sums of differently mixed members, and its size."""
    one = int(np.add.reduce(mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5))))
    two = int(np.add.reduce(mix(shingles + np.uint64(len(shingles)))))
    return one.to_bytes(8, "little") + two.to_bytes(8, "little")


def _document_prints(k: int, bands: int, rows: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("print", pa.binary()), ("bands", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, 1):
            hashes, starts = column_words(batch.column(1))
            sizes, prints, keys = [], [], []
            for i in range(batch.num_rows):
                shingles = _shingles(hashes, starts[i], starts[i + 1], k)
                sizes.append(len(shingles))
                prints.append(_set_print(shingles))
                keys.append(
                    _band_keys(_signature(shingles, bands * rows), bands, rows).tobytes() if len(shingles) else b""
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(keys, pa.binary())],
                schema=schema,
            )

    return run


def _document_sets(k: int, minima: int):
    """(print, lowest bytes of the minima, set) of each text; whole sets of 64-bit hashes."""
    schema = pa.schema([("print", pa.binary()), ("signature", pa.binary()), ("members", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, 0):
            hashes, starts = column_words(batch.column(0))
            out: dict[str, list] = {"print": [], "signature": [], "members": []}
            for i in range(batch.num_rows):
                shingles = _shingles(hashes, starts[i], starts[i + 1], k)
                out["print"].append(_set_print(shingles))
                out["signature"].append(_signature(shingles, minima).astype(np.uint8).tobytes())
                out["members"].append(shingles.view(np.int64))
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return run


def _expand_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per band key of each class."""
    for batch in batches:
        raw = b"".join(batch.column(2).to_pylist())
        keys = pa.array(np.frombuffer(raw, dtype=np.int64))
        each = len(keys) // max(batch.num_rows, 1)
        take = pa.array(np.repeat(np.arange(batch.num_rows), each))
        yield pa.RecordBatch.from_arrays(
            [keys, batch.column(0).take(take), batch.column(1).take(take)], names=["key", "class_id", "print"]
        )


def _alike(threshold: float, minima: int, slack: float):
    """Pairs whose signatures agree enough for the threshold to be possible."""
    least = threshold - slack * (threshold * (1 - threshold) / minima) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint8).reshape(-1, minima)
            two = np.frombuffer(b"".join(batch.column("signature_b").to_pylist()), np.uint8).reshape(-1, minima)
            keep = pa.array(np.flatnonzero((one == two).mean(axis=1) >= least))
            yield batch.select(["class_a", "print", "class_b", "print_b"]).take(keep)

    return run


def _chunk_links(percent: int):
    """Links between the classes of two chunks of a cluster, one for each class and component."""

    def links(x: list[np.ndarray], y: list[np.ndarray], rows: np.ndarray, x_comp, y_comp) -> Iterator[tuple[int, int]]:
        sizes = np.array([len(s) for s in y])
        tokens = np.concatenate(y)
        owners = np.repeat(np.arange(len(y)), sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, owners = tokens[order], owners[order]
        for i in rows.tolist():
            low, high = np.searchsorted(tokens, x[i]), np.searchsorted(tokens, x[i], side="right")
            many = high - low
            spot = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
            shared = np.bincount(owners[spot], minlength=len(y))
            near = (100 * shared >= percent * (len(x[i]) + sizes - shared)) & (y_comp != x_comp[i])
            found = np.flatnonzero(near)
            for j in found[np.unique(y_comp[found], return_index=True)[1]].tolist():
                yield i, j

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        left = rows[rows["chunk"] == rows["low"]].reset_index(drop=True)
        right = rows[rows["chunk"] == rows["high"]].reset_index(drop=True)
        out: list[tuple[int, int]] = []
        if len(left) and len(right):
            a = [np.asarray(m, np.int64) for m in left["members"]]
            b = [np.asarray(m, np.int64) for m in right["members"]]
            a_comp, b_comp = left["component"].to_numpy(np.int64), right["component"].to_numpy(np.int64)
            a_id, b_id = left["class_id"].to_numpy(np.int64), right["class_id"].to_numpy(np.int64)
            main = int(rows["main"].iloc[0])
            for i, j in links(a, b, np.flatnonzero(a_comp != main), a_comp, b_comp):
                out.append((int(a_id[i]), int(b_id[j])))
            if rows["low"].iloc[0] != rows["high"].iloc[0]:
                for j, i in links(b, a, np.flatnonzero(b_comp != main), b_comp, a_comp):
                    out.append((int(b_id[j]), int(a_id[i])))
        return pd.DataFrame(out, columns=["class_a", "class_b"], dtype="int64")

    return run


def near_duplicates(
    documents: DataFrame,
    shingle_words: int = 5,
    threshold: float = 0.8,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``documents``.

    ``documents`` needs ``doc_id`` and ``text``; other columns are not looked at. A text
    with fewer words than a shingle is one shingle; a null, empty or blank text has an
    empty set, links with nothing and is its own component. Rows that repeat a doc_id
    count as one document with several texts. Rows without a doc_id take the component
    of their equal set, null if it has none, and are not kept. No rows give no rows.
    """
    prints = materialize(
        documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
            _document_prints(shingle_words, bands, rows),
            "doc_id bigint, n_shingles bigint, print binary, bands binary",
        ),
        "prints",
    )
    filled = prints.where("n_shingles > 0")
    with working_tables(documents.sparkSession):
        named = materialize(_named_classes(documents, filled, shingle_words, threshold), "named", lasting=True)
    result = join_groups(filled.select("doc_id", "n_shingles", "print"), named, "print", "n_rows")
    empty = prints.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return (
        result.select("doc_id", "n_shingles", "component_id")
        .unionByName(empty)
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def _named_classes(documents: DataFrame, filled: DataFrame, shingle_words: int, threshold: float) -> DataFrame:
    """(print, n_rows, component_id) of each class of equal sets; what it stores on the way is needed for this alone."""
    classes = materialize(
        filled.groupBy("print").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n_rows")), "classes"
    )
    # one row of each class carries its bands: the one with the class's own id
    heads = filled.join(
        classes.select("print", "class_id").where("class_id is not null"), "print"
    ).where("doc_id = class_id")
    keys = materialize(
        heads.select("class_id", "print", "bands")
        .dropDuplicates(["print"])
        .mapInArrow(_expand_bands, "key bigint, class_id bigint, print binary"),
        "bands",
    )
    buckets = keys.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("class_id", "print")).alias("other"))
    members = materialize(keys.join(buckets.where("n > 1"), "key"), "members")
    candidates = members.select("class_id").distinct()
    # texts without a partner are kept out of the shuffle
    texts = maybe_among(
        documents.select(F.col("doc_id").cast("bigint"), "text"), "doc_id", candidates.select(F.col("class_id").alias("id"))
    ).where("_maybe")
    sets = materialize(
        # an inner join with distinct ids: a semi-join would be moved below the filter
        texts.join(candidates, F.col("doc_id") == F.col("class_id"))
        .select("text")
        .mapInArrow(_document_sets(shingle_words, SCREEN), "print binary, signature binary, members array<bigint>"),
        "sets",
    )
    percent = round(threshold * 100)
    compare = _comparison(sets, percent, _alike(threshold, SCREEN, SLACK))
    first = compare(_named(members.where("class_id <> other.class_id")))
    component = materialize(components(first, "class_a", "class_b"), "components")
    placed = materialize(_open_buckets(members, component), "open")
    links = first.unionByName(compare(_small_bucket_pairs(placed.where(F.col("n") <= SMALL))))
    large = placed.where(F.col("n") > SMALL).select("key", "class_id", "print", "component")
    if not large.isEmpty():
        links = links.unionByName(materialize(_cluster_links(large, sets, percent), "similar"))
    component = components(links, "class_a", "class_b")
    return classes.join(component, F.col("class_id") == F.col("node"), "left").select(
        "print", "n_rows", F.coalesce("component", "class_id").alias("component_id")
    )


def _comparison(sets: DataFrame, percent: int, alike):
    """A function from pairs to those of them that are similar, each side's data joined by its print."""
    signatures = sets.select("print", "signature")
    whole = sets.select("print", "members")

    def compare(pairs: DataFrame) -> DataFrame:
        possible = materialize(
            pairs.join(signatures, "print")
            .join(signatures.toDF("print_b", "signature_b"), "print_b")
            .mapInArrow(alike, "class_a bigint, print binary, class_b bigint, print_b binary"),
            "pairs",
        )
        both = possible.join(whole, "print").join(whole.toDF("print_b", "members_b"), "print_b")
        # in the JVM, pair by pair: whole sets of many pairs at once would fill a batch
        shared = F.size(F.array_intersect("members", "members_b"))
        near = shared * (100 + percent) >= (F.size("members") + F.size("members_b")) * percent
        return materialize(both.where(near).select("class_a", "class_b"), "similar")

    return compare


def _open_buckets(members: DataFrame, component: DataFrame) -> DataFrame:
    """Members of buckets with several components, with their component and the bucket's largest."""
    placed = members.drop("other").join(component, F.col("class_id") == F.col("node"), "left").select(
        "key", "n", "class_id", "print", F.coalesce("component", "class_id").alias("component")
    )
    sizes = placed.groupBy("key", "component").agg(F.count("*").alias("rows"))
    open_keys = sizes.groupBy("key").agg(
        F.count("*").alias("several"), F.max(F.struct("rows", "component")).getField("component").alias("main")
    )
    return placed.join(open_keys.where("several > 1").drop("several"), "key")


def _small_bucket_pairs(placed: DataFrame) -> DataFrame:
    """Pairs of classes of different components, at least one of them outside the bucket's largest."""
    others = placed.select("key", F.struct("class_id", "print", "component").alias("other"))
    pairs = placed.where("component <> main").join(others, "key").where("component <> other.component")
    return _named(pairs)


def _cluster_links(large: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links inside the clusters that large buckets make, found chunk against chunk."""
    heads = large.groupBy("key").agg(F.min("class_id").alias("head"))
    cluster = components(large.join(heads, "key"), "class_id", "head")
    classes = large.select("class_id", "print", "component").distinct()
    grouped = materialize(
        classes.join(cluster.toDF("class_id", "cluster"), "class_id").join(sets.select("print", "members"), "print"),
        "clusters",
    )
    by_component = grouped.groupBy("cluster", "component").agg(
        F.count("*").alias("rows"), F.sum(F.size("members") * 8).alias("bytes")
    )
    sizes = by_component.groupBy("cluster").agg(
        F.max(F.struct("rows", "component")).getField("component").alias("main"),
        (F.floor(F.sum("bytes") / CHUNK_BYTES) + 1).alias("chunks"),
    )
    chunked = grouped.join(sizes, "cluster").withColumn("chunk", F.pmod(F.xxhash64("class_id"), F.col("chunks")))
    met = chunked.withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    met = met.select(
        "cluster", "main", "class_id", "component", "members", "chunk",
        F.least("chunk", "partner").alias("low"), F.greatest("chunk", "partner").alias("high"),
    )
    return met.groupBy("cluster", "low", "high").applyInPandas(_chunk_links(percent), "class_a bigint, class_b bigint")


def _named(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.col("class_id").alias("class_a"),
        "print",
        F.col("other.class_id").alias("class_b"),
        F.col("other.print").alias("print_b"),
    ).distinct()
