"""Exact duplicates of whole texts through a minimal perfect hash over known digests.

What an earlier delivery holds becomes an index: its distinct digests are dealt to
shards, and each shard gets a minimal perfect hash (levels of bits; a key stays at the
first level where it is alone) with one slot per digest. A slot holds the whole digest,
the winner's id and the number of rows. A new delivery first collapses to its distinct
digests; each looks up one slot and compares all 32 bytes. Members join the group of
their slot, nonmembers form groups among themselves.

Shards are bounded by SHARD_DIGESTS on average, whatever the size of a group of copies:
copies are counted before anything is dealt out, and the rows meet their group's line
through join_groups.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.grouping import join_groups, nullable
from riskflow.llm.words import mix
from riskflow.plans.shared import materialize

SHARD_DIGESTS = 200_000
#: Bits per key and level, and levels at most; keys past the last level are searched in order.
GAMMA = 1.5
LEVELS = 40

INDEX = "shard int, sizes array<int>, bits binary, digests binary, winners binary, counts binary"
GROUPS = "digest binary, keep_id bigint, group_size bigint"
#: Stands for "no id" in a slot.
NO_ID = np.iinfo(np.int64).min


def _halves(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit numbers of each 32-byte digest."""
    words = np.ascontiguousarray(digests).view(np.uint64)
    return words[:, 0], words[:, 1]


def _place(one: np.ndarray, two: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(one + np.uint64(level) * (two | np.uint64(1))) % np.uint64(size)).astype(np.int64)


def build_hash(digests: np.ndarray) -> tuple[list[int], list[np.ndarray], np.ndarray]:
    """(bits per level, the levels' bits, slot of each digest) for distinct digests."""
    one, two = _halves(digests)
    open_keys = np.arange(len(digests))
    slots = np.zeros(len(digests), np.int64)
    sizes, levels, base = [], [], 0
    while len(open_keys) and len(sizes) < LEVELS:
        size = int(GAMMA * len(open_keys)) + 1
        at = _place(one[open_keys], two[open_keys], len(sizes), size)
        bits = np.bincount(at, minlength=size) == 1
        placed = bits[at]
        rank = np.cumsum(bits) - 1
        slots[open_keys[placed]] = base + rank[at[placed]]
        base += int(bits.sum())
        open_keys = open_keys[~placed]
        sizes.append(size)
        levels.append(bits)
    slots[open_keys] = base + np.arange(len(open_keys))
    return sizes, levels, slots


def find_slots(sizes: list[int], levels: list[np.ndarray], stored: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Slot of each digest, -1 for nonmembers. A slot counts only if all its bytes are equal."""
    one, two = _halves(digests)
    found = np.full(len(digests), -1, np.int64)
    open_keys = np.arange(len(digests))
    base = 0
    for level, (size, bits) in enumerate(zip(sizes, levels)):
        at = _place(one[open_keys], two[open_keys], level, size)
        hit = bits[at]
        rank = np.cumsum(bits) - 1
        found[open_keys[hit]] = base + rank[at[hit]]
        base += int(bits.sum())
        open_keys = open_keys[~hit]
    for slot in range(base, len(stored)):  # keys that no level could tell apart
        found[open_keys[(digests[open_keys] == stored[slot]).all(axis=1)]] = slot
    member = np.flatnonzero(found >= 0)
    wrong = (stored[found[member]] != digests[member]).any(axis=1)
    found[member[wrong]] = -1
    return found


def _digest_array(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, 32)


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    digests = _digest_array(rows["digest"])
    sizes, levels, slots = build_hash(digests)
    order = np.argsort(slots)
    ids = rows["keep_id"].astype("Int64").fillna(NO_ID).to_numpy(np.int64)
    return pd.DataFrame(
        {
            "shard": [int(rows["shard"].iloc[0])],
            "sizes": [sizes],
            "bits": [b"".join(np.packbits(bits).tobytes() for bits in levels)],
            "digests": [digests[order].tobytes()],
            "winners": [ids[order].tobytes()],
            "counts": [rows["group_size"].to_numpy(np.int64)[order].tobytes()],
        }
    )


def _unpack_levels(sizes: list[int], raw: bytes) -> list[np.ndarray]:
    levels, at = [], 0
    for size in sizes:
        n = (size + 7) // 8
        levels.append(np.unpackbits(np.frombuffer(raw, np.uint8)[at : at + n])[:size].astype(bool))
        at += n
    return levels


def _look_up(fresh: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """All groups of a shard: its slots with what the new rows add, and the nonmembers."""
    ids = fresh["keep_id"].astype("Int64").fillna(NO_ID).to_numpy(np.int64)
    counts = fresh["group_size"].to_numpy(np.int64)
    names = list(fresh["digest"])
    if len(index):
        line = index.iloc[0]
        stored = np.frombuffer(line["digests"], np.uint8).reshape(-1, 32)
        winners = np.frombuffer(line["winners"], np.int64).copy()
        sizes = np.frombuffer(line["counts"], np.int64).copy()
        if len(fresh):
            levels = _unpack_levels(list(line["sizes"]), line["bits"])
            slot = find_slots(list(line["sizes"]), levels, stored, _digest_array(fresh["digest"]))
            member = np.flatnonzero(slot >= 0)
            at = slot[member]
            sizes[at] += counts[member]
            both = (winners[at] != NO_ID) & (ids[member] != NO_ID)
            winners[at] = np.where(both, np.minimum(winners[at], ids[member]), np.maximum(winners[at], ids[member]))
            rest = np.flatnonzero(slot < 0)
            ids, counts, names = ids[rest], counts[rest], [names[i] for i in rest]
        ids, counts = np.concatenate([winners, ids]), np.concatenate([sizes, counts])
        names = [stored[i].tobytes() for i in range(len(stored))] + names
    return pd.DataFrame({"digest": names, "keep_id": nullable(ids, ids == NO_ID), "group_size": counts})


def digests(documents: DataFrame) -> DataFrame:
    """(doc_id, digest): SHA-256 of the text in UTF-8, each run of white space as one space."""
    text = F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+", " ")
    return documents.select(F.col("doc_id").cast("bigint"), F.unhex(F.sha2(text, 256)).alias("digest"))


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))


def _sharded(groups: DataFrame, shards: int) -> DataFrame:
    return groups.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int"))


def build_index(groups: DataFrame, shards: int) -> DataFrame:
    """One line per shard from distinct (digest, keep_id, group_size)."""
    return _sharded(groups, shards).groupBy("shard").applyInPandas(_build_shard, INDEX)


def exact_duplicates(history: DataFrame, delivery: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of both tables.

    Both need ``doc_id`` and ``text``; other columns are not looked at. A null text counts
    as empty. keep_id is the smallest doc_id of the equal texts, null if none of them has
    one; rows without doc_id count in group_size and are never kept. Rows that repeat
    both doc_id and text stand for one document and get the same line. Either table may
    be empty.
    """
    old = materialize(digests(history), "digests")
    new = materialize(digests(delivery), "digests")
    known = materialize(_grouped(old), "groups")
    fresh = materialize(_grouped(new), "groups")
    shards = max(known.count(), fresh.count()) // SHARD_DIGESTS + 1
    index = materialize(build_index(known, shards), "index")
    groups = materialize(
        _sharded(fresh, shards).groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(_look_up, GROUPS),
        "groups",
    )
    joined = join_groups(old.unionByName(new), groups, "digest", "group_size")
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def split_deliveries(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(history, delivery): the rows below the middle of the id range, and all others."""
    ids = documents.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).first()
    middle = F.lit(None if ids["a"] is None else (ids["a"] + ids["b"]) // 2)
    early = F.coalesce(F.col("doc_id") <= middle, F.lit(False))
    return documents.where(early), documents.where(~early)
