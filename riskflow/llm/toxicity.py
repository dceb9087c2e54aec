"""Toxicity by a gap-weighted subsequence kernel, a support vector machine and Nyström landmarks.

A word's features are its subsequences of three letters or digits (its two ends count
too, other ASCII signs are passed over), each weighted by DECAY to the power of the stretch it spans, so that inserted
characters and gaps lower a match but do not end it. The kernel of two words is the
normalised product of their features. The machine is trained in the space that the
landmarks span; its decision is a sum of kernels with landmarks, and as the kernel is a
product of explicit features, that sum is one table of weights, which every task gets.

Labels are given for documents. Which words of a toxic text are to blame is found first:
greedily, the words and word beginnings that most toxic texts have and clean texts nearly
never, where a text counts less with every word that already explains it. Near copies
would make every word of theirs look guilty, so of these one is learnt from. Runs of single characters are also read as one
word. A document's score is a logistic function of its two highest word margins.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.words import string_buffers, text_blocks, word_places

#: Bounds of the training sample: labelled texts of each kind, bytes of one.
TOXIC_TEXTS = 3000
CLEAN_TEXTS = 6000
TEXT_BYTES = 1 << 16
#: Words and texts handled together while fitting.
BLOCK = 4096
#: Words the machine learns from, of each kind, and landmarks.
TRAIN_WORDS = 4000
LANDMARKS = 128
DECAY = 0.7
SPAN = 6
#: Bytes of a word looked at together; longer words are read in overlapping pieces.
PIECE = 24
STEMS = (4, 5, 6)
COST = 4.0
#: What a toxic text still counts for after each word that explains it.
EXPLAINED = 0.7

_GAPS = [(i, j) for i in range(1, SPAN) for j in range(1, SPAN) if i + j <= SPAN]


def _classes() -> np.ndarray:
    """One of 64 kinds for each byte: letters, digits, other signs, parts of longer characters."""
    kinds = np.full(256, 37, np.int32)
    for i in range(26):
        kinds[[ord("a") + i, ord("A") + i]] = 1 + i
    kinds[ord("0") : ord("9") + 1] = np.arange(27, 37)
    kinds[0x80:0xC0] = 38 + (np.arange(0x80, 0xC0) & 15)
    kinds[0xC0:] = 54 + (np.arange(0xC0, 0x100) & 7)
    return kinds


_KIND = _classes()
_SIGN = _KIND == 37
_BEGIN, _END = 62, 63
_TRIM = ".,;:!?\"'()[]{}|*#$%&-_/<>~=+"


def word_codes(raw: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(matrix of character kinds with the word's ends marked, word of each row)."""
    lo, hi = (int(begin[0]), int(stop[-1])) if len(begin) else (0, 0)
    solid = ~_SIGN[raw[lo:hi]]
    before = np.zeros(hi - lo + 1, np.int64)
    np.cumsum(solid, out=before[1:])
    raw, begin, stop = raw[lo:hi][solid], before[begin - lo], before[stop - lo]
    length = stop - begin
    step = PIECE // 2
    pieces = np.maximum(1, -(-(length - step) // step))
    owner = np.repeat(np.arange(len(begin)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = begin[owner] + nth * step
    last = np.minimum(first + PIECE, stop[owner])
    at = first[:, None] + np.arange(PIECE)
    inside = at < last[:, None]
    out = np.zeros((len(owner), PIECE + 2), np.int32)
    out[:, 1 : PIECE + 1][inside] = _KIND[raw[at[inside]]] if len(raw) else 0
    out[nth == 0, 0] = _BEGIN
    ends = last == stop[owner]
    out[ends, (last - first)[ends] + 1] = _END
    return out, owner


def features(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(feature numbers, where there is one, weight) for each pair of gaps."""
    n = codes.shape[1]
    for i, j in _GAPS:
        a, b, c = codes[:, : n - i - j], codes[:, i : n - j], codes[:, i + j :]
        yield (a << 12) | (b << 6) | c, (a > 0) & (b > 0) & (c > 0), DECAY ** (i + j)


def margins(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The product of each row's normalised features with a table of weights."""
    total, norm = np.zeros(len(codes), np.float32), np.zeros(len(codes), np.float32)
    for number, valid, weight in features(codes):
        total += weight * np.where(valid, table[number], 0).sum(axis=1)
        norm += weight**2 * valid.sum(axis=1)
    return total / np.sqrt(np.maximum(norm, 1e-9))


def _entries(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, weight) of normalised feature vectors."""
    rows, numbers, weights = [], [], []
    norm = np.zeros(len(codes))
    for number, valid, weight in features(codes):
        row, column = np.nonzero(valid)
        rows.append(row)
        numbers.append(number[row, column])
        weights.append(np.full(len(row), weight))
        norm += weight**2 * valid.sum(axis=1)
    row = np.concatenate(rows)
    return row, np.concatenate(numbers), np.concatenate(weights) / np.sqrt(np.maximum(norm[row], 1e-9))


@dataclass
class Model:
    table: np.ndarray
    bias: float
    doc_weights: np.ndarray

    def scores(self, top: np.ndarray, size: np.ndarray) -> np.ndarray:
        z = _doc_features(top, size) @ self.doc_weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _doc_features(top: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(top)), top, np.log1p(size) / 10])


def _joined_runs(raw: np.ndarray, begin: np.ndarray, stop: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(text, word) for each run of three or more single characters."""
    single = np.flatnonzero(stop - begin == 1)
    if len(single) < 3:
        return
    cut = np.flatnonzero((np.diff(single) > 1) | (np.diff(text[single]) > 0)) + 1
    bounds = np.concatenate([[0], cut, [len(single)]])
    for k in np.flatnonzero(np.diff(bounds) >= 3).tolist():
        run = single[bounds[k] : bounds[k + 1]]
        yield int(text[run[0]]), raw[begin[run]].tobytes()


def top_margins(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray]:
    """(two highest margins of distinct words, number of words) of each text; -2 stands for no word."""
    n = len(offsets) - 1
    hashes, begin, stop = word_places(raw, offsets)
    text = np.searchsorted(offsets, begin, side="right") - 1
    size = np.bincount(text, minlength=n)
    order = np.argsort(hashes, kind="stable")
    lead = np.append(True, np.diff(hashes[order]) > 0) if len(order) else np.zeros(0, bool)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(lead) - 1
    distinct = np.sort(order[lead])
    score = np.full(len(distinct), -2.0, np.float32)
    for block in range(0, len(distinct), 1 << 15):
        part = distinct[block : block + (1 << 15)]
        codes, owner = word_codes(raw, begin[part], stop[part])
        np.maximum.at(score, number[part][owner], margins(codes, table) + bias)
    top = np.full((n, 2), -2.0)
    # by text, then from the highest margin down; equal words stand together
    value = score[number]
    ranked = np.lexsort((number, -value, text))
    fresh = np.append(True, (np.diff(text[ranked]) > 0) | (np.diff(number[ranked]) != 0)) if len(ranked) else ranked
    ranked = ranked[fresh.astype(bool)] if len(ranked) else ranked
    owner = text[ranked]
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    for k in (0, 1):
        rows = ranked[place == k]
        top[text[rows], k] = value[rows]
    for where, word in _joined_runs(raw, begin, stop, text):
        letters = np.frombuffer(word, np.uint8)
        codes, _ = word_codes(letters, np.array([0]), np.array([len(letters)]))
        margin = float(margins(codes, table).max()) + bias
        if margin > top[where, 0]:
            top[where] = margin, top[where, 0]
        elif margin > top[where, 1]:
            top[where, 1] = margin
    return top, size


def _fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Squared-hinge support vector machine by Newton steps; the last weight is the bias."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.ones(x.shape[1])
    ridge[-1] = 1e-6
    for _ in range(30):
        slack = 1 - y * (x @ w)
        on = slack > 0
        gradient = ridge * w - 2 * COST * x[on].T @ (weight[on] * y[on] * slack[on])
        hessian = np.diag(ridge) + 2 * COST * (x[on].T * weight[on]) @ x[on]
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + 0.1 * w
        hessian = (x.T * (p * (1 - p))) @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-7:
            break
    return w


def _keys(words: set[str]) -> set[str]:
    """Words, and word beginnings marked by a final ``*``."""
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


def blamed_words(toxic: list[str], clean: list[str]) -> list[str]:
    """Words and word beginnings that explain the toxic texts, best first. One text's words are held at a time."""
    number: dict[str, int] = {}
    names: list[str] = []
    holders: list[list[int]] = []
    for i, text in enumerate(toxic):
        for k in _keys(text_words(text)):
            at = number.setdefault(k, len(names))
            if at == len(names):
                names.append(k)
                holders.append([])
            holders[at].append(i)
    for at, texts in enumerate(holders):  # what one text has explains no other
        if len(texts) == 1:
            number.pop(names[at])
    good: Counter[str] = Counter()
    for text in clean:
        good.update(k for k in _keys(text_words(text)) if k in number)
    share = max(len(toxic), 1) / max(len(clean), 1)
    # a key counts if it has far more toxic texts than clean ones let expect
    usable = {k: len(holders[at]) for k, at in number.items() if len(holders[at]) >= 20 * share * good[k]}
    chosen: list[str] = []
    value = np.ones(len(toxic))
    members = {k: np.array(holders[number[k]]) for k in usable}
    # values only fall, so the first key of the queue whose gain is still true is the best
    queue = [(-float(usable[k]), k.endswith("*"), k) for k in usable]
    heapq.heapify(queue)
    least = max(1.5, len(toxic) / 1000)
    while queue:
        gain, stem, key = heapq.heappop(queue)
        now = -float(value[members[key]].sum())
        if now > gain + 1e-9:
            heapq.heappush(queue, (now, stem, key))
            continue
        if -now < least:
            break
        chosen.append(key)
        value[members[key]] *= EXPLAINED
    return chosen


def text_words(text: str) -> set[str]:
    return {w.strip(_TRIM) for w in text.lower().split()} - {""}


def distinct_texts(texts: list[str]) -> list[int]:
    """One of each group of near copies: those that share no pair of word minima with an earlier text."""
    seen: set[tuple[int, int, int]] = set()
    kept = []
    for i, text in enumerate(texts):
        words = text_words(text)
        if len(words) >= 8:
            values = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
            least = [int((values * np.uint64(2 * k + 1) * np.uint64(2654435761) % np.uint64(4294967291)).min()) for k in range(1, 17)]
            keys = {(k, least[k], least[k + 1]) for k in range(0, 16, 2)}
            if keys & seen:
                continue
            seen |= keys
        kept.append(i)
    return kept


def stretched(words: list[str], rng: np.random.Generator) -> list[str]:
    """Each word with one strange character put inside, as evaders of a filter do."""
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    out = []
    for word in words:
        at = int(rng.integers(1, max(len(word), 2)))
        out.append(word[:at] + letters[int(rng.integers(len(letters)))] + word[at:])
    return out


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = string_buffers(pa.array(words, pa.large_string()))
    codes, owner = word_codes(raw, offsets[:-1], offsets[1:])
    lead = np.append(True, np.diff(owner) > 0) if len(owner) else np.zeros(0, bool)
    return codes[lead], owner[lead]


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    """A model from labelled texts. Without texts of both kinds every score is the share of toxic ones."""
    empty = np.zeros(1 << 18, np.float32)
    if not toxic.any() or toxic.all():
        share = float(np.clip(toxic.mean(), 0.01, 0.99)) if len(toxic) else 0.01
        return Model(empty, 0.0, np.array([np.log(share / (1 - share)), 0, 0, 0]))
    kept = distinct_texts(texts)
    bad_texts, good_texts = [texts[i] for i in kept if toxic[i]], [texts[i] for i in kept if not toxic[i]]
    chosen = blamed_words(bad_texts, good_texts)
    whole = {k for k in chosen if not k.endswith("*")}
    stems = tuple(k[:-1] for k in chosen if k.endswith("*"))
    counts: Counter[str] = Counter()
    for text in bad_texts:
        counts.update(w for w in text_words(text) if w in whole or (stems and w.startswith(stems)))
    good: set[str] = set()
    for text in good_texts:
        good |= text_words(text)
    # ties by the word: the order in which a set gives its words differs from run to run
    common = sorted(counts, key=lambda w: (-counts[w], w))
    positives = [w for w in common[:TRAIN_WORDS] if w not in good] or common[:10]
    if not positives:
        share = float(toxic.mean())
        return Model(empty, 0.0, np.array([np.log(share / (1 - share)), 0, 0, 0]))
    rng = np.random.default_rng(0)
    positives += stretched(positives, rng)
    ordered = sorted(good)
    negatives = [ordered[i] for i in rng.permutation(len(ordered))[:TRAIN_WORDS]]
    table, bias = empty, 0.0
    for attempt in range(3):
        words = positives + negatives
        y = np.concatenate([np.ones(len(positives)), -np.ones(len(negatives))])
        codes, _ = _letters(words)
        # landmarks: the best blamed words, the hardest clean ones, and some of all
        middle = [*range(min(LANDMARKS // 2, len(positives)))]
        rest = len(positives) + np.arange(len(negatives))
        if attempt:
            rest = rest[::-1]
        middle += rest[: LANDMARKS - len(middle)].tolist()
        row, number, part = _entries(codes)
        mark_row, mark_number, mark_part = _entries(codes[middle])
        kernel = np.zeros((len(codes), len(middle)))
        line = np.zeros(1 << 18)
        for m in range(len(middle)):
            own = mark_row == m
            line[:] = 0
            np.add.at(line, mark_number[own], mark_part[own])
            kernel[:, m] = np.bincount(row, part * line[number], len(codes))
        values, vectors = np.linalg.eigh(kernel[middle])
        keep = values > 1e-4
        root = vectors[:, keep] / np.sqrt(values[keep])
        weight = np.where(y > 0, 0.5 / len(positives), 0.5 / len(negatives)) * len(y)
        w = _fit_svm(kernel @ root, y, weight)
        share = (root @ w[:-1])[mark_row] * mark_part
        table = np.bincount(mark_number, share, 1 << 18).astype(np.float32)
        bias = float(w[-1])
        # clean words the machine takes for toxic join the next round
        score = np.concatenate([margins(_letters(ordered[i : i + BLOCK])[0], table) for i in range(0, len(ordered), BLOCK)])
        hard = [ordered[i] for i in np.argsort(-score)[: TRAIN_WORDS // 3]]
        negatives = list(dict.fromkeys(negatives + hard[::-1]))
    found = [
        top_margins(*string_buffers(pa.array(texts[i : i + BLOCK // 8], pa.large_string())), table, bias)
        for i in range(0, len(texts), BLOCK // 8)
    ]
    rows = _doc_features(np.concatenate([top for top, _ in found]), np.concatenate([size for _, size in found]))
    return Model(table, bias, _fit_logistic(rows, toxic.astype(float)))


def training_sample(documents: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray]:
    """At most TOXIC_TEXTS + CLEAN_TEXTS distinct labelled texts of at most TEXT_BYTES, by hash of the id."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("bigint").alias("id"))
    known = known.agg((F.max("toxic") > 0).alias("toxic_label"))
    turn = [F.xxhash64("id"), F.col("id")]
    ids = known.where("toxic_label").orderBy(*turn).limit(TOXIC_TEXTS)
    ids = ids.unionByName(known.where("not toxic_label").orderBy(*turn).limit(CLEAN_TEXTS))
    rows = (
        documents.where(F.octet_length("text") <= TEXT_BYTES)
        .join(F.broadcast(ids), F.col("doc_id").cast("bigint") == F.col("id"))
        .select(F.col("text").cast("string"), "toxic_label")
        .toArrow()
    )
    found: dict[str, bool] = {}
    for text, label in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
        found[text] = found.get(text, False) or label
    ordered = sorted(found)
    return ordered, np.array([found[t] for t in ordered], bool)


def _score(packed):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = packed.value
        for batch in text_blocks(batches, 1):
            raw, offsets = string_buffers(batch.column(1))
            top, size = top_margins(raw, offsets, model.table, model.bias)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(top, size))], schema=schema)

    return run


def score_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of ``documents``.

    ``documents`` needs ``doc_id`` and ``text``, ``labels`` ``doc_id`` and ``toxic``; other
    columns are not looked at. Only the text decides a score; labels of documents whose
    crc32(doc_id) mod 5 is 0 are never learnt from. A null, empty or blank text gets the
    score of a text without words. A null doc_id is not held out and has no label; rows
    may repeat; the largest label of a document counts. Without labels of both kinds
    every document gets one low score.
    """
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary")), F.lit(5))
    learnt = labels.where(F.pmod(F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary")), F.lit(5)) != 0)
    model = fit(*training_sample(documents, learnt))
    packed = documents.sparkSession.sparkContext.broadcast(model)
    scored = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        _score(packed), "doc_id bigint, score double"
    )
    return scored.select(
        "doc_id",
        F.coalesce(remainder == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def _keep_clean(packed):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = packed.value
        for batch in text_blocks(batches, "text"):
            raw, offsets = string_buffers(batch.column(batch.schema.get_field_index("text")).cast(pa.large_string()))
            yield batch.filter(pa.array(model.scores(*top_margins(raw, offsets, model.table, model.bias)) < 0.5))

    return run


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` that score_toxicity() predicts 0 for, in one pass, unchanged."""
    learnt = labels.where(F.pmod(F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary")), F.lit(5)) != 0)
    packed = documents.sparkSession.sparkContext.broadcast(fit(*training_sample(documents, learnt)))
    return documents.mapInArrow(_keep_clean(packed), documents.schema)
