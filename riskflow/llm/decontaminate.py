"""Benchmark passages inside documents, found by an embedding of edit distance.

Documents and items are sequences of words. A document holds an item if some run of its
words is within ``share`` of the item's length in edits (insert, delete, replace a word).

Every word of every document starts an item-sized window. Windows that cannot match are
passed over without loss: k edits leave all but qk of an item's runs of q words, so a
window with fewer runs that occur in any item is too far away. The others are embedded by CGK
random walks: at each step a walk copies the word it stands on and moves on or waits as
a random bit of (step, word) says. Sequences a few edits apart fall into step again, so
their walks differ in few places, and keys of a few sampled places agree with good
chance. ``WALKS`` walks with ``SAMPLES`` keys each give the recall; what meets an item's
key is verified by the exact edit distance. Items so short that the share allows them no
edit have nothing to be near to: their words are looked for as they are.

Items are a stated query set. They go to the tasks in blocks of at most about
BLOCK_WORDS words, each block against all documents; documents are never shuffled.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.curriculum import count_words
from riskflow.llm.words import column_words, mix, text_blocks
from riskflow.plans.shared import materialize

SHARE = 0.2
BLOCK_WORDS = 1_000_000
WALKS = 16
SAMPLES = 4
PLACES = 3
#: Windows of items up to so many times longer share one length.
CLASS_STEP = 1.1
#: Bits of the filter of runs of words, for each run.
FILTER_BITS = 64
#: Lengths of runs; the first that leaves an item at least one run after its edits is used.
RUNS = (3, 2, 1)

SCHEMA = "doc_id bigint, item_id bigint, start bigint, edits bigint, item_words bigint"


def _runs(words: np.ndarray, q: int) -> np.ndarray:
    """A print of the q words from each position on."""
    n = max(len(words) - q + 1, 0)
    value = words[:n]
    for i in range(1, q):
        value = mix(value * np.uint64(3) + words[i : i + n])
    return value


def walk(windows: np.ndarray, seed: int, steps: int) -> np.ndarray:
    """CGK walks over the rows of ``windows``; its last column is padding, never left."""
    n, width = windows.shape
    row, at = np.arange(n), np.zeros(n, np.int64)
    out = np.empty((n, steps), np.uint64)
    for t in range(steps):
        word = windows[row, at]
        out[:, t] = word
        salt = mix(np.array([seed * 65536 + t + 1], np.uint64))
        at = np.minimum(at + (mix(word + salt) >> np.uint64(63)).astype(np.int64), width - 1)
    return out


def window_keys(windows: np.ndarray, length: int) -> np.ndarray:
    """Keys of each window, WALKS * SAMPLES in a row."""
    steps = 2 * length
    keys = np.empty((len(windows), WALKS * SAMPLES), np.uint64)
    for w in range(WALKS):
        walked = walk(windows, w + 1, steps)
        for s in range(SAMPLES):
            column = w * SAMPLES + s
            spot = np.random.default_rng([length, w, s]).integers(0, steps, PLACES)
            key = np.full(len(windows), length * 4096 + column, np.uint64)
            for p in spot:
                key = mix(key * np.uint64(31) + walked[:, p])
            keys[:, column] = key
    return keys


def _windows(words: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    """``length`` words from each begin, and padding from ``end`` on and in the last column."""
    at = begin[:, None] + np.arange(length + 1)
    inside = (at < end[:, None]) & (np.arange(length + 1) < length)
    out = np.zeros(at.shape, np.uint64)
    out[inside] = words[at[inside]]
    return out


class Items:
    """A block of items as the tasks use it."""

    def __init__(self, ids: list[int], texts: list[str], share: float) -> None:
        words, starts = column_words(pa.array(texts, pa.large_string()))
        self.share = share
        known = [(i, words[a:b]) for i, a, b in zip(ids, starts[:-1], starts[1:]) if b > a]
        self.items = [(i, w) for i, w in known if int(share * len(w))]
        self.exact = self._by_length([(i, w) for i, w in known if not int(share * len(w))])
        lengths = sorted({len(w) for _, w in self.items})
        self.classes: list[tuple[int, int]] = []  # window length, most edits
        of_length = {}
        for n in lengths:
            if not self.classes or n >= self.classes[-1][0] * CLASS_STEP:
                self.classes.append((n, 0))
            self.classes[-1] = (self.classes[-1][0], int(share * n))
            of_length[n] = len(self.classes) - 1
        members: list[list[np.ndarray]] = [[] for _ in self.classes]
        for _, w in self.items:
            members[of_length[len(w)]].append(w)
        self.filters = [self._filter(w, self._run_length(c)) for w, c in zip(members, self.classes)]
        keys, owners = [], []
        for number, (_, w) in enumerate(self.items):
            length = self.classes[of_length[len(w)]][0]
            one = _windows(w, np.array([0]), np.array([len(w)]), length)
            keys.append(window_keys(one, length)[0])
            owners.append(np.full(WALKS * SAMPLES, number))
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[order]
        self.owners = (np.concatenate(owners) if owners else np.zeros(0, np.int64))[order]

    @staticmethod
    def _by_length(items: list[tuple[int, np.ndarray]]) -> dict[int, tuple[np.ndarray, list[tuple[int, np.ndarray]]]]:
        """Length to (prints in order, items in that order)."""
        found = {}
        for n in {len(w) for _, w in items}:
            mine = [(i, w) for i, w in items if len(w) == n]
            prints = np.concatenate([_runs(w, n) for _, w in mine])
            order = np.argsort(prints, kind="stable")
            found[n] = prints[order], [mine[k] for k in order]
        return found

    def _exact_matches(self, words: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """verified() for items that allow no edits: the first place in each text."""
        for n, (prints, items) in self.exact.items():
            runs = _runs(words, n)
            low, high = np.searchsorted(prints, runs), np.searchsorted(prints, runs, side="right")
            at = np.flatnonzero(high > low)
            text = np.searchsorted(starts, at, side="right") - 1
            whole = at + n <= starts[text + 1]
            at, text = at[whole], text[whole]
            # the first place of each text and print
            _, first = np.unique(low[at] * len(starts) + text, return_index=True)
            for spot, t in zip(at[first].tolist(), text[first].tolist()):
                for item_id, item in items[low[spot] : high[spot]]:
                    if (words[spot : spot + n] == item).all():
                        yield t, item_id, spot - int(starts[t]), 0, n

    @staticmethod
    def _run_length(size: tuple[int, int]) -> int:
        return next((q for q in RUNS if size[0] - q + 1 - q * size[1] > 0), RUNS[-1])

    @staticmethod
    def _filter(items: list[np.ndarray], q: int) -> tuple[np.uint64, np.ndarray]:
        """(shift, bits): which prints of q words occur in the items, by their upper bits."""
        runs = np.concatenate([_runs(w, q) for w in items])
        shift = 64 - max(14, int(np.ceil(np.log2(len(runs) * FILTER_BITS))))
        bits = np.zeros(1 << (64 - shift), bool)
        bits[(runs >> np.uint64(shift)).astype(np.int64)] = True
        return np.uint64(shift), bits

    def _starts(self, runs: np.ndarray, starts: np.ndarray, number: int) -> np.ndarray:
        """Where a window of a class holds enough runs of q words of the class's items."""
        length, edits = self.classes[number]
        q = self._run_length(self.classes[number])
        need = length - q + 1 - q * edits
        shift, bits = self.filters[number]
        hit = bits[(runs >> shift).astype(np.int64)]
        n = len(hit)
        if np.count_nonzero(hit) < need:
            return np.zeros(0, np.int64)
        inner = starts[(starts > 0) & (starts < n + q - 1)]
        for i in range(1, q):  # no run over the end of a text
            over = inner - i
            hit[over[(over >= 0) & (over < n)]] = False
        seen = np.zeros(n + 1, np.int32)
        np.cumsum(hit, out=seen[1:])
        span = length + edits - q + 1
        full = seen[span:] - seen[:-span] if n >= span else seen[:0]
        rest = seen[n] - seen[len(full) : n]
        return np.flatnonzero(np.concatenate([full, rest]) >= need)

    def candidates(self, words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, item numbers) whose keys meet, each pair once."""
        spots, items = [], []
        runs = {q: _runs(words, q) for q in {self._run_length(c) for c in self.classes}}
        for number, size in enumerate(self.classes):
            length = size[0]
            begin = self._starts(runs[self._run_length(size)], starts, number)
            for block in range(0, len(begin), 8192):
                at = begin[block : block + 8192]
                end = starts[np.searchsorted(starts, at, side="right")]
                keys = window_keys(_windows(words, at, end, length), length).ravel()
                low, high = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, side="right")
                many = high - low
                hit = np.repeat(np.arange(len(keys)), many)
                inside = np.arange(len(hit)) - np.repeat(np.cumsum(many) - many, many)
                spots.append(at[hit // (WALKS * SAMPLES)])
                items.append(self.owners[low[hit] + inside])
        if not spots:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        both = np.concatenate(spots) * len(self.items) + np.concatenate(items)
        both.sort()
        both = both[np.append(True, np.diff(both) > 0)] if len(both) else both
        return both // max(len(self.items), 1), both % max(len(self.items), 1)

    def verified(self, words: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(text number, item id, start in the text, edits, item's words): the best of each pair."""
        yield from self._exact_matches(words, starts)
        spots, numbers = self.candidates(words, starts)
        order = np.argsort(numbers, kind="stable")
        spots, numbers = spots[order], numbers[order]
        cuts = np.flatnonzero(np.diff(numbers)) + 1
        for part in np.split(np.arange(len(numbers)), cuts):
            if not len(part):
                continue
            item_id, item = self.items[numbers[part[0]]]
            most = int(self.share * len(item))
            at = spots[part]
            text = np.searchsorted(starts, at, side="right") - 1
            edits = _edit_distances(item, words, at, starts[text + 1], most)
            best: dict[int, tuple[int, int]] = {}
            for t, a, e in zip(text.tolist(), at.tolist(), edits.tolist()):
                if e <= most and (t not in best or (e, a) < best[t]):
                    best[t] = (e, a)
            for t, (e, a) in best.items():
                yield t, item_id, a - int(starts[t]), e, len(item)


def _edit_distances(item: np.ndarray, words: np.ndarray, at: np.ndarray, end: np.ndarray, most: int) -> np.ndarray:
    """Least edits from the item to any run of words from ``at``, in blocks of windows."""
    out = np.empty(len(at), np.int64)
    width = len(item) + most
    step = np.arange(width + 1)
    for block in range(0, len(at), 2048):
        window = _windows(words, at[block : block + 2048], end[block : block + 2048], width)[:, :width]
        # k edits leave all but k words of the item, so most windows need no closer look
        near = np.flatnonzero(np.isin(window, item).sum(axis=1) >= len(item) - most)
        out[block : block + 2048] = most + 1
        if not len(near):
            continue
        window = window[near]
        row = np.broadcast_to(step, (len(window), width + 1)).copy()
        for i, word in enumerate(item):
            new = row + 1
            np.minimum(new[:, 1:], row[:, :-1] + (window != word), out=new[:, 1:])
            row = np.minimum.accumulate(new - step, axis=1) + step
        out[block + near] = row.min(axis=1)
    return out


_blocks: dict[str, Items] = {}


def _items(packed, number: str) -> Items:
    if number not in _blocks:
        _blocks.clear()
        _blocks[number] = pickle.loads(packed.value)
    return _blocks[number]


def _keep_clean(packed, number: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _items(packed, number)
        for batch in text_blocks(batches, "text"):
            words, starts = column_words(batch.column(batch.schema.get_field_index("text")))
            clean = np.ones(batch.num_rows, bool)
            clean[[r[0] for r in items.verified(words, starts)]] = False
            yield batch.filter(pa.array(clean))

    return run


def _search(packed, number: str):
    schema = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _items(packed, number)
        for batch in text_blocks(batches, "text"):
            words, starts = column_words(batch.column(1))
            rows = list(items.verified(words, starts))
            ids = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array([r[c] for r in rows], pa.int64()) for c in range(1, 5))], schema=schema)

    return run


def find_passages(documents: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, item_id, start, edits, item_words: one row per document row and item it holds.

    ``documents`` needs ``doc_id`` and ``text``, ``benchmark`` ``item_id`` and ``text``; other
    columns are not looked at. start is the number of words before the best match (fewest
    edits, then the first). Items of so few words that ``share`` allows no edit (up to four at 0.2) match
    exactly; items without words, null ones among them, and null or empty documents match nothing. A document row without doc_id gives rows
    without doc_id. Repeated items give a row each, repeated documents too. Empty tables
    give no rows.
    """
    texts = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    found = None
    for packed, many in _item_blocks(benchmark, share):
        part = texts.mapInArrow(_search(packed, uuid.uuid4().hex), SCHEMA)
        if many:
            part = materialize(part, "passages")
            packed.unpersist()
        found = part if found is None else found.unionByName(part)
    return found


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """The rows of ``documents`` for which find_passages() finds no item, unchanged; a pass per block of items.

    Rows with a null or empty text stay, repeated rows stay or go together, columns of any name pass
    through. Without items all rows stay; an empty table gives no rows.
    """
    kept = documents
    for packed, many in _item_blocks(benchmark, share):
        kept = kept.mapInArrow(_keep_clean(packed, uuid.uuid4().hex), documents.schema)
        if many:
            kept = materialize(kept, "clean")
            packed.unpersist()
    return kept


def _item_blocks(benchmark: DataFrame, share: float):
    """(broadcast block of items, whether there are several)."""
    spark = benchmark.sparkSession
    queries = benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    total = queries.agg(F.coalesce(F.sum(count_words(F.col("text"))), F.lit(0)).alias("n")).first()["n"]
    blocks = total // BLOCK_WORDS + 1
    queries = queries.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    if blocks > 1:
        queries = materialize(queries, "items")
    for block in range(blocks):
        rows = queries.where(F.col("block") == block).select("item_id", "text").collect()
        items = Items([r["item_id"] for r in rows], [r["text"] for r in rows], share)
        yield spark.sparkContext.broadcast(pickle.dumps(items)), blocks > 1
