"""Language-model scores from a sharded n-gram trie with Elias-Fano levels.

The model is a bigram model over words: ``P(w | u) = (c(u w) + M P(w)) / (c(u) + M)``, with
``P(w)`` by relative frequency and the Good-Turing share of unseen tokens for the one
unknown word; it adds up to one over the known words and the unknown one. The trie is
kept from the last word back: its first level holds words with their counts, its second
each word's predecessors. Dividing by ``M / (c(u) + M)``, what a seen pair adds is
``log(c(u w) / M + P(w))``, which depends on the node alone; the factor itself is added
where u is met as a word. So each token is answered by the one shard that holds its last
word, and no table of contexts is shipped.

A shard's words and pointers, and the predecessors relative to their word, are monotone
sequences in Elias-Fano form (byte-aligned low parts, unary high parts); probabilities
are quantised to one byte. Levels are flat buffers that are viewed in place. A predecessor
is found by a successor search in its word's range.

Texts go to the shards as sorted, counted blobs, one per Arrow batch and shard; no row is
made for a token. Words with at least one token in HOT_SHARE are spread over sub-shards by
their predecessor; there are at most HOT_SHARE of them, and their counts are broadcast.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.grouping import nullable
from riskflow.llm.words import column_words, mix, text_blocks
from riskflow.plans.shared import materialize

#: Bytes of text per shard, tokens of a hot word, its sub-shards, and the prior's weight M.
SHARD_BYTES = 40 << 20
HOT_SHARE = 1000
SUB_SHARDS = 64
PRIOR = 200.0

END = np.uint64(0x9E3779B97F4A7C16)
BEGIN = np.uint64(0xC2B2AE3D27D4EB50)
BLOB = "shard int, batch string, blob binary"


# ---------------------------------------------------------------- Elias-Fano


def encode(values: np.ndarray) -> tuple[int, int, bytes, bytes]:
    """(length, bytes of a low part, low parts, unary high parts) of a monotone sequence."""
    n = len(values)
    if not n:
        return 0, 0, b"", b""
    top = int(values[-1])
    low = min(range(8), key=lambda b: n * 8 * b + n + (top >> (8 * b)))
    high = (values >> np.uint64(8 * low)).astype(np.int64)
    bits = np.zeros(int(high[-1]) + n, bool)
    bits[high + np.arange(n)] = True
    lows = values.astype("<u8").view(np.uint8).reshape(n, 8)[:, :low]
    return n, low, np.ascontiguousarray(lows).tobytes(), np.packbits(bits).tobytes()


def decode(coded: tuple[int, int, bytes, bytes]) -> np.ndarray:
    """The sequence again, as unsigned 64-bit integers."""
    n, low, lows, highs = coded
    if not n:
        return np.zeros(0, np.uint64)
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(highs, np.uint8)))[:n]
    full = np.zeros((n, 8), np.uint8)
    full[:, :low] = np.frombuffer(lows, np.uint8).reshape(n, low)
    high = (ones - np.arange(n)).astype(np.uint64)
    return full.view("<u8").ravel() | (high << np.uint64(8 * low))


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one byte per value, the 256 values they stand for): half by rank, half evenly over the range."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(256, np.float32)
    ranks = np.quantile(values, np.linspace(0, 1, 128), method="nearest")
    book = np.unique(np.concatenate([ranks, np.linspace(values.min(), values.max(), 128)]).astype(np.float32))
    middle = (book[1:] + book[:-1]) / 2
    return np.searchsorted(middle, values).astype(np.uint8), np.pad(book, (0, 256 - len(book)), mode="edge")


# ---------------------------------------------------------------- texts to blobs


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token, its predecessor, text number, tokens per text): words, then one end."""
    words, starts = column_words(column)
    n = len(column)
    sizes = np.diff(starts) + 1
    total = len(words) + n
    last = np.cumsum(sizes) - 1
    token = np.empty(total, np.uint64)
    is_word = np.ones(total, bool)
    is_word[last] = False
    token[is_word] = words
    token[last] = END
    before = np.empty(total, np.uint64)
    before[1:] = token[:-1]
    before[last - sizes + 1] = BEGIN
    return token, before, np.repeat(np.arange(n), sizes), sizes


def _small(values: np.ndarray) -> np.ndarray:
    top = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if top < 256 else np.uint16 if top < 65536 else np.uint32)


class Sharding:
    """Which shard answers a token."""

    def __init__(self, shards: int, hot: dict[int, int]) -> None:
        self.shards = np.uint64(shards)
        self.hot = np.array(sorted(hot), np.uint64)
        self.hot_counts = np.array([hot[int(w)] for w in self.hot], np.int64)

    def hot_place(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.searchsorted(self.hot, words)
        inside = np.minimum(place, max(len(self.hot) - 1, 0))
        return inside, (self.hot[inside] == words) if len(self.hot) else np.zeros(len(words), bool)

    def units(self, token: np.ndarray, before: np.ndarray) -> np.ndarray:
        """A number per word, and per sub-shard of a hot word, from which the shard follows."""
        unit = token.copy()
        _, hot = self.hot_place(token)
        unit[hot] = mix(token[hot] + (before[hot] % np.uint64(SUB_SHARDS)) + np.uint64(1))
        return unit


def _blobs(sharding: Sharding, token, before, owner) -> Iterator[tuple[int, bytes]]:
    """Per shard: words, pairs per word, predecessors, occurrences per pair, and the text of each."""
    unit = sharding.units(token, before)
    order = np.argsort(unit, kind="stable")
    ranked = unit[order]
    lead = np.append(True, ranked[1:] != ranked[:-1]) if len(ranked) else np.zeros(0, bool)
    distinct = ranked[lead]
    shard = (mix(distinct) % sharding.shards).astype(np.int64)
    # number the units shard by shard
    by_shard = np.argsort(shard, kind="stable")
    place = np.empty(len(distinct), np.uint64)
    place[by_shard] = np.arange(len(distinct), dtype=np.uint64)
    number = np.empty(len(unit), np.uint64)
    number[order] = place[np.cumsum(lead) - 1]
    word_of = token[order[lead]][by_shard]
    shard = shard[by_shard]
    key = (number << np.uint64(32)) | (before & np.uint64(0xFFFFFFFF))
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(key)))
    pair = key[first]
    pair_unit = (pair >> np.uint64(32)).astype(np.int64)
    pairs = np.bincount(pair_unit, minlength=len(word_of))
    text = owner[order]
    unit_cuts = np.searchsorted(shard, np.arange(int(sharding.shards) + 1))
    pair_cuts = np.searchsorted(pair_unit, unit_cuts)
    token_cuts = np.append(first, len(key))[pair_cuts]
    for s in range(int(sharding.shards)):
        u, p, t = (slice(c[s], c[s + 1]) for c in (unit_cuts, pair_cuts, token_cuts))
        yield s, word_of[u], _small(pairs[u]), (pair[p] & np.uint64(0xFFFFFFFF)).astype(np.uint32), _small(times[p]), _small(text[t])


def _emit(sharding: Sharding | None, with_texts: bool, shards: int):
    """Blobs of each batch: counted words where there is no sharding yet, else counted pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        task = f"{context.partitionId()}" if context else "0"
        for number, batch in enumerate(text_blocks(batches, 1)):
            token, before, owner, sizes = _tokens(batch.column(1))
            rows = []
            if sharding is None:
                token.sort()
                first = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else token[:0]
                words, counts = token[first.astype(np.int64)], np.diff(np.append(first, len(token)).astype(np.int64))
                shard = (mix(words) % np.uint64(shards)).astype(np.int64)
                for s in range(shards):
                    own = shard == s
                    rows.append((s, pickle.dumps((words[own], _small(counts[own])), 5)))
            else:
                for s, words, pairs, preds, times, texts in _blobs(sharding, token, before, owner):
                    blob = (words, pairs, preds, times, texts) if with_texts else (words, pairs, preds, times)
                    if with_texts and s == 0:  # one shard brings the documents themselves
                        ids = batch.column(0)
                        blob += ((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), sizes),)
                    rows.append((s, pickle.dumps(blob, 5)))
            name = f"{task}-{number}"
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([s for s, _ in rows], pa.int32()),
                    pa.array([name] * len(rows), pa.string()),
                    pa.array([b for _, b in rows], pa.binary()),
                ],
                names=["shard", "batch", "blob"],
            )

    return run


# ---------------------------------------------------------------- counts and tries


def _word_totals(rows: pd.DataFrame) -> pd.DataFrame:
    """Tokens, words, words seen once of a shard, and the words with one token in HOT_SHARE of it."""
    parts = [pickle.loads(b) for b in rows["blob"]]
    words = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1].astype(np.int64) for p in parts])
    order = np.argsort(words, kind="stable")
    words, counts = words[order], counts[order]
    if not len(words):
        return pd.DataFrame({"tokens": [0], "words": [0], "once": [0], "hot": [[]], "hot_counts": [[]]})
    first = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
    totals = np.add.reduceat(counts, first)
    hot = np.flatnonzero(totals * HOT_SHARE >= totals.sum())
    return pd.DataFrame(
        {
            "tokens": [int(totals.sum())],
            "words": [len(first)],
            "once": [int((totals == 1).sum())],
            "hot": [words[first][hot].view(np.int64).tolist()],
            "hot_counts": [totals[hot].tolist()],
        }
    )


class Weights:
    """The numbers that turn counts into log10 probabilities."""

    def __init__(self, tokens: int, words: int, once: int) -> None:
        self.tokens, self.words = tokens, words
        self.unseen = min(max(once, 1) / max(tokens, 1), 0.5) if tokens else 1.0

    def word(self, counts: np.ndarray) -> np.ndarray:
        """log10 P(w); a count of 0 is the unknown word."""
        known = counts * (1 - self.unseen) / max(self.tokens, 1)
        return np.log10(np.where(counts > 0, known, self.unseen))

    def pair(self, counts: np.ndarray, word_log: np.ndarray) -> np.ndarray:
        return np.log10(counts / PRIOR + 10**word_log)

    def context(self, counts: np.ndarray) -> np.ndarray:
        return np.log10(PRIOR / (counts + PRIOR))

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.tokens + self.words + 1))


def _build(sharding: Sharding, weights: Weights):
    """The trie of a shard from its counted pairs."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [pickle.loads(b) for b in rows["blob"]]
        words = np.concatenate([p[0] for p in parts])
        pairs = np.concatenate([p[1].astype(np.int64) for p in parts])
        preds = np.concatenate([p[2] for p in parts])
        times = np.concatenate([p[3].astype(np.int64) for p in parts])
        level = np.sort(words)
        level = level[np.append(True, level[1:] != level[:-1])] if len(level) else level
        key = (np.repeat(np.searchsorted(level, words), pairs).astype(np.uint64) << np.uint64(32)) | preds
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        counts = np.add.reduceat(times, first) if len(first) else times
        key = key[first]
        owner = (key >> np.uint64(32)).astype(np.int64)
        totals = np.bincount(owner, counts, len(level)).astype(np.int64)
        place, hot = sharding.hot_place(level)
        totals[hot] = sharding.hot_counts[place[hot]]
        pointers = np.searchsorted(owner, np.arange(len(level) + 1)).astype(np.uint64)
        codes, book = quantise(weights.pair(counts, weights.word(totals)[owner]))
        trie = {
            "words": encode(level),
            "totals": _small(totals).tobytes(),
            "totals_type": str(_small(totals).dtype),
            "pointers": encode(pointers),
            "predecessors": encode(key),
            "codes": codes.tobytes(),
            "book": book.tobytes(),
        }
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "trie": [pickle.dumps(trie, 5)]})

    return run


class Trie:
    """A shard's levels, opened."""

    def __init__(self, raw: bytes | None) -> None:
        trie = pickle.loads(raw) if raw is not None else {}
        self.words = decode(trie.get("words", (0, 0, b"", b"")))
        self.totals = np.frombuffer(trie.get("totals", b""), trie.get("totals_type", "uint8")).astype(np.int64)
        self.pointers = decode(trie.get("pointers", (0, 0, b"", b""))).astype(np.int64)
        self.predecessors = decode(trie.get("predecessors", (0, 0, b"", b"")))
        self.codes = np.frombuffer(trie.get("codes", b""), np.uint8)
        self.book = np.frombuffer(trie.get("book", b""), np.float32)

    def nodes(self, words: np.ndarray) -> np.ndarray:
        """Node of each word, -1 where there is none."""
        at = np.searchsorted(self.words, words)
        known = at < len(self.words)
        known[known] = self.words[at[known]] == words[known]
        return np.where(known, at, -1)

    def pair_logs(self, nodes: np.ndarray, preds: np.ndarray) -> np.ndarray:
        """Quantised logs of (node, predecessor), NaN where the pair is not in the trie."""
        out = np.full(len(nodes), np.nan)
        seen = np.flatnonzero(nodes >= 0)
        wanted = (nodes[seen].astype(np.uint64) << np.uint64(32)) | preds[seen]
        # the successor of the wanted value; a hit lies between the word's own pointers
        at = np.searchsorted(self.predecessors, wanted)
        hit = at < self.pointers[nodes[seen] + 1]
        hit[hit] = self.predecessors[at[hit]] == wanted[hit]
        out[seen[hit]] = self.book[self.codes[at[hit]]]
        return out


def _answer(sharding: Sharding, weights: Weights):
    """A shard's part of each document's sums, batch by batch."""

    def run(texts: pd.DataFrame, tries: pd.DataFrame) -> pd.DataFrame:
        if not len(texts):
            return pd.DataFrame()
        trie = Trie(tries["trie"].iloc[0] if len(tries) else None)
        out: dict[str, list] = {"batch": [], "part": []}
        for name, raw in zip(texts["batch"], texts["blob"]):
            blob = pickle.loads(raw)
            words, pairs, preds, times, owner = blob[:5]
            nodes = trie.nodes(words)
            counts = np.zeros(len(words), np.int64)
            counts[nodes >= 0] = trie.totals[nodes[nodes >= 0]]
            place, hot = sharding.hot_place(words)
            counts[hot] = sharding.hot_counts[place[hot]] if len(sharding.hot) else 0
            of_pair = np.repeat(np.arange(len(words)), pairs.astype(np.int64))
            word_log = weights.word(counts)
            log = trie.pair_logs(nodes[of_pair], preds.astype(np.uint64))
            unseen = np.isnan(log)
            log[unseen] = word_log[of_pair[unseen]]
            # the word's own factor as a context, unless it ends the text
            log += np.where(words == END, 0.0, weights.context(counts))[of_pair]
            repeat = times.astype(np.int64)
            owner = owner.astype(np.int64)
            n = int(owner.max()) + 1 if len(owner) else 0
            part = (
                np.bincount(owner, np.repeat(log, repeat), n),
                np.bincount(owner, np.repeat(weights.base(counts)[of_pair], repeat), n),
                np.bincount(owner, np.repeat(counts[of_pair] > 0, repeat), n).astype(np.uint32),
                blob[5] if len(blob) > 5 else None,
            )
            out["batch"].append(name)
            out["part"].append(pickle.dumps(part, 5))
        return pd.DataFrame(out, columns=["batch", "part"])

    return run


def _add_up(weights: Weights, documents: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [pickle.loads(p) for p in rows["part"]]
        ids, null, sizes = next(p[3] for p in parts if p[3] is not None)
        n = len(ids)
        score = np.full(n, float(weights.context(np.array(documents))))  # the context before a first word
        base, known = np.zeros(n), np.zeros(n, np.int64)
        for a, b, c, _ in parts:
            score[: len(a)] += a
            base[: len(b)] += b
            known[: len(c)] += c
        return pd.DataFrame({"doc_id": nullable(ids, null), "n_tokens": sizes, "n_known": known, "base_score": base, "score": score})

    return run


def score_texts(documents: DataFrame, training: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for each row of ``documents``.

    Both tables need ``doc_id`` and ``text``; other columns are not looked at. Tokens are
    the words and one end; null, empty and blank texts are the end alone. Scores are
    log10 probabilities of the whole text; base_score is add-one smoothing of single
    tokens. Rows may repeat and doc_id may be null, rows never meet. Without training
    texts every token is unknown. No documents give no rows.
    """
    texts = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    learnt = training.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    shards = size // SHARD_BYTES + 1
    totals = materialize(
        learnt.mapInArrow(_emit(None, False, shards), BLOB)
        .groupBy("shard")
        .applyInPandas(_word_totals, "tokens bigint, words bigint, once bigint, hot array<bigint>, hot_counts array<bigint>"),
        "word_totals",
    )
    sums = totals.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "words", "once"))).first()
    weights = Weights(sums["tokens"], sums["words"], sums["once"])
    hot_rows = (
        totals.select(F.explode(F.arrays_zip("hot", "hot_counts")).alias("h"))
        .select("h.hot", "h.hot_counts")
        .where(F.col("hot_counts") * HOT_SHARE >= F.lit(sums["tokens"]))
        .collect()
    )
    hot = {r["hot"] % (1 << 64): r["hot_counts"] for r in hot_rows}
    n_learnt = learnt.count()
    sharding = Sharding(shards, hot)
    tries = materialize(
        learnt.mapInArrow(_emit(sharding, False, shards), BLOB)
        .groupBy("shard")
        .applyInPandas(_build(sharding, weights), "shard int, trie binary"),
        "tries",
    )
    parts = (
        texts.mapInArrow(_emit(sharding, True, shards), BLOB)
        .groupBy("shard")
        .cogroup(tries.groupBy("shard"))
        .applyInPandas(_answer(sharding, weights), "batch string, part binary")
    )
    scored = parts.groupBy("batch").applyInPandas(
        _add_up(weights, n_learnt),
        "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double",
    )
    return scored.withColumn("train_tokens", F.lit(sums["tokens"]).cast("bigint"))
