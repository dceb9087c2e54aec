"""Ranked lexical search: the highest-scoring documents of each item, by the Best Position Algorithm.

Documents are scored by integer term weights. Documents stay where they are: each task
turns stretches of its documents into an index of the items' terms, in which a term's
postings stand twice: by falling impact, to be read from the top, and by document, for
direct accesses. An item reads its terms' impact lists in step. Each document met is
looked up in all the item's lists at once, and the places it holds there count as seen.
The best position of a list is the last one before which every place is seen, whether it was
read or looked up. No unseen document can score more than the impacts at the best
positions together, so an item stops when that is strictly below its k-th score. The
k best of one stretch are the starting point of the next, a task sends on the k best
of all its documents, and a last window keeps the k best of those.

Items are taken in blocks of BLOCK_TERMS terms, the one thing that is sent to all tasks.
A block reads the documents twice: for the terms' document counts, and to search.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.llm.words import string_buffers, text_blocks, word_tokens
from riskflow.plans.shared import materialize

#: Terms of items that are searched for together, repeats counted.
BLOCK_TERMS = 1_000_000
#: Bytes of text that are indexed together.
STRETCH_BYTES = 24 << 20
#: Positions of each list that are read first; each further step reads twice as many.
FIRST_STEP = 16

_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_STATISTICS = pa.schema([("term", pa.int64()), ("n", pa.int64())])
_FOUND = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def text_terms(text: str | None) -> list[bytes]:
    """The terms of one text in order, repeats included."""
    raw, offsets = string_buffers(pa.array([text], pa.large_string()))
    return [t for tokens, _ in word_tokens(raw, offsets, _TERM) for t in tokens.to_pylist()]


@dataclass
class Items:
    """A block of items: their distinct terms, and of each item its terms' numbers with repeats."""

    item_ids: list
    terms: pa.Array
    numbers: list[np.ndarray]
    repeats: list[np.ndarray]

    @classmethod
    def of(cls, rows: list[tuple]) -> Items:
        """From (item_id, text) rows."""
        counted = [Counter(text_terms(text)) for _, text in rows]
        terms = sorted(set().union(*counted))
        number = {t: i for i, t in enumerate(terms)}
        return cls(
            [item for item, _ in rows],
            pa.array(terms, pa.binary()),
            [np.fromiter((number[t] for t in c), np.int64, len(c)) for c in counted],
            [np.fromiter(c.values(), np.int64, len(c)) for c in counted],
        )


def _count_terms(column: pa.Array, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms of each text, then number, text and occurrences of each item term in each text)."""
    raw, offsets = string_buffers(column)
    lengths = np.zeros(len(column), np.int64)
    pairs = []
    for tokens, begin in word_tokens(raw, offsets, _TERM):
        owner = np.searchsorted(offsets, begin, side="right") - 1
        lengths += np.bincount(owner, minlength=len(column))
        number = pc.fill_null(pc.index_in(tokens, value_set=terms), -1).to_numpy().astype(np.int64)
        known = number >= 0
        pairs.append(number[known] * len(column) + owner[known])
    key, times = np.unique(np.concatenate(pairs) if pairs else np.zeros(0, np.int64), return_counts=True)
    return lengths, key // max(len(column), 1), key % max(len(column), 1), times


def _statistics(terms: pa.Array):
    """(-2, documents with terms), (-1, their terms) and (term number, documents holding it), once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, words = 0, 0
        held = np.zeros(len(terms), np.int64)
        for batch in text_blocks(batches, "text"):
            lengths, number, _, _ = _count_terms(batch.column(1), terms)
            total += int((lengths > 0).sum())
            words += int(lengths.sum())
            held += np.bincount(number, minlength=len(terms))
        numbers = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append([-2, -1], numbers)), pa.array(np.append([total, words], held[numbers]))], schema=_STATISTICS
        )

    return run


@dataclass
class Corpus:
    """What a score needs of all documents: their number, their terms, and each item term's weight."""

    documents: int
    words: int
    weights: np.ndarray

    def impacts(self, number: np.ndarray, times: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The impact of terms that stand ``times`` times in documents of ``length`` terms."""
        norm = 75 + (25 * length * self.documents) // self.words
        return self.weights[number] * ((1_000_000_000 * times) // (1000 * times + 12 * norm))


@dataclass
class Index:
    """Postings of a stretch of documents: by impact within each term, and by document within each term."""

    doc_ids: pa.Array
    n_docs: int
    first: np.ndarray  # where a term's list begins
    doc: np.ndarray  # by impact
    impact: np.ndarray
    key: np.ndarray  # term * n_docs + document, rising
    place: np.ndarray  # where that posting stands by impact
    seen: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.seen = np.zeros(len(self.doc), dtype=bool)

    @classmethod
    def of(cls, parts: list[tuple], corpus: Corpus) -> Index:
        """From (ids, lengths, number, text, times) of consecutive blocks."""
        n_docs = sum(len(p[0]) for p in parts)
        base = np.cumsum([0, *(len(p[0]) for p in parts)])
        length = np.concatenate([p[1] for p in parts])
        number = np.concatenate([p[2] for p in parts])
        doc = np.concatenate([p[3] + b for p, b in zip(parts, base)])
        impact = corpus.impacts(number, np.concatenate([p[4] for p in parts]), length[doc])
        order = np.lexsort((doc, -impact, number))
        key = (number * n_docs + doc)[order]
        by_key = np.argsort(key, kind="stable")
        first = np.searchsorted(number[order], np.arange(len(corpus.weights) + 1))
        return cls(pa.concat_arrays([p[0] for p in parts]), n_docs, first, doc[order], impact[order], key[by_key], by_key)

    def look_up(self, terms: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and whether there is one, for each term (row) and document (column)."""
        wanted = terms[:, None] * self.n_docs + docs[None, :]
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        return self.place[at], self.key[at] == wanted


class Best:
    """The k best (score, doc_id) of one item; equal scores by rising doc_id, null last."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.score = np.zeros(0, np.int64)
        self.doc_id = np.zeros(0, np.int64)
        self.null = np.zeros(0, dtype=bool)

    def add(self, score: np.ndarray, doc_id: np.ndarray, null: np.ndarray) -> None:
        good = score > 0
        if self.full():
            good &= score >= self.kth()
        if not good.any():
            return
        score = np.concatenate([self.score, score[good]])
        doc_id = np.concatenate([self.doc_id, doc_id[good]])
        null = np.concatenate([self.null, null[good]])
        top = np.lexsort((doc_id, null, -score))[: self.k]
        self.score, self.doc_id, self.null = score[top], doc_id[top], null[top]

    def full(self) -> bool:
        return len(self.score) == self.k

    def kth(self) -> int:
        return int(self.score[-1])


def best_positions(index: Index, terms: np.ndarray, repeats: np.ndarray, best: Best, ids: np.ndarray, null: np.ndarray) -> int:
    """Run one item over a stretch; gives the number of documents it looked up.

    ``ids`` and ``null`` are the stretch's doc_ids as numbers.
    """
    first, stop = index.first[terms], index.first[terms + 1]
    there = stop > first
    terms, repeats, first, stop = terms[there], repeats[there], first[there], stop[there]
    if not len(terms):
        return 0
    met = np.zeros(index.n_docs, dtype=bool)
    at = first.copy()  # next place to read
    unseen = first.copy()  # next place that is neither read nor looked up
    step, looked = FIRST_STEP, 0
    while True:
        upto = np.minimum(at + step, stop)
        read = np.concatenate([index.doc[a:b] for a, b in zip(at.tolist(), upto.tolist())])
        new = np.unique(read[~met[read]])
        met[new] = True
        if len(new):
            looked += len(new)
            place, found = index.look_up(terms, new)
            index.seen[place[found]] = True
            best.add((np.where(found, index.impact[place], 0) * repeats[:, None]).sum(axis=0), ids[new], null[new])
        bound = 0
        for i, (lo, hi) in enumerate(zip(unseen.tolist(), stop.tolist())):
            lo = max(lo, int(upto[i]))
            while lo < hi and index.seen[lo]:
                gap = int(np.argmin(index.seen[lo : lo + 256]))
                lo += gap or (min(256, hi - lo) if index.seen[lo] else 0)
            unseen[i] = lo = min(lo, hi)
            if lo < hi:
                bound += int(index.impact[lo - 1]) * int(repeats[i])
        if bound == 0 or (best.full() and bound < best.kth()):
            break
        at, step = upto, step * 2
    for a, b in zip(first.tolist(), stop.tolist()):
        index.seen[a:b] = False
    return looked


def _search(items: Items, corpus: Corpus, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items.item_ids]

        def finish(parts: list[tuple]) -> None:
            index = Index.of(parts, corpus)
            if not len(index.doc):
                return
            null = index.doc_ids.is_null().to_numpy(zero_copy_only=False)
            ids = index.doc_ids.fill_null(0).to_numpy()
            for i, terms in enumerate(items.numbers):
                best_positions(index, terms, items.repeats[i], best[i], ids, null)

        parts, size = [], 0
        for batch in text_blocks(batches, "text"):
            parts.append((batch.column(0), *_count_terms(batch.column(1), items.terms)))
            size += batch.column(1).nbytes
            if size >= STRETCH_BYTES:
                finish(parts)
                parts, size = [], 0
        if parts:
            finish(parts)
        for i, b in enumerate(best):
            if len(b.score):
                n = len(b.score)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, i)),
                        pa.array([items.item_ids[i]] * n, pa.int64()),
                        pa.array(b.doc_id, mask=b.null),
                        pa.array(b.score),
                    ],
                    schema=_FOUND,
                )

    return run


def _item_blocks(items: DataFrame) -> Iterator[tuple[list[tuple], bool]]:
    """(rows of a block of items, whether there are several)."""
    # a term has at least one byte, and a separator stands between two
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    most = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0)).alias("n")).first()["n"] // 2
    blocks = most // BLOCK_TERMS + 1
    if blocks == 1:
        yield [tuple(r) for r in rows.collect()], False
        return
    rows = materialize(rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "items")
    for block in range(blocks):
        yield [tuple(r) for r in rows.where(F.col("block") == block).drop("block").collect()], True


def rank_documents(documents: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id, score: the k highest-scoring documents of each item, score above 0.

    ``documents`` needs ``doc_id`` and ``text``, ``items`` ``item_id`` and ``text``; other columns
    are not looked at. Terms are runs of ASCII letters, digits and characters outside ASCII, A-Z
    lower-cased. rank counts from 1; equal scores stand by rising doc_id, null last. A null or empty
    text has no terms: such a document is found by no item and does not count among the
    documents, such an item finds none. Every row is a document or an item of its own:
    repeated documents all take places, repeated items get their places each. Empty tables give no
    rows. Texts may be of any length.
    """
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for rows, many in _item_blocks(items):
        block = Items.of(rows)
        counted = texts.mapInArrow(_statistics(block.terms), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
        known = {r["term"]: r["n"] for r in counted.collect()}
        n, words = known.get(-2, 0), known.get(-1, 0)
        weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * known.get(t, 0) + 1))) for t in range(len(block.terms))]
        corpus = Corpus(n, max(words, 1), np.array(weights, np.int64))
        best = texts.mapInArrow(_search(block, corpus, k), "item bigint, item_id bigint, doc_id bigint, score bigint")
        order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        part = ranked.select("item_id", "rank", "doc_id", "score")
        part = materialize(part, "ranked") if many else part
        found = part if found is None else found.unionByName(part)
    return found
