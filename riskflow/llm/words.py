"""Words of many texts at once, as 64-bit hashes, with numpy and Arrow inside Arrow batches.

A word is ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased. The words of a stretch are
cut out as one Arrow array, whose distinct values are hashed one by one (XXH3, 64 bits).
The hash depends on the word alone, never on where it stands or how texts are batched.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

#: Bytes looked at together. Larger texts are cut at white space, words stay whole.
SPAN = 1 << 20
#: Bytes of text that a task works on together.
BLOCK = 6 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SOLID = ~_SPACE
try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # not the GNU C library
    _TRIM = None
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit integers (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null rows have no bytes."""
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def release_memory() -> None:
    """Give memory that Arrow and the C library hold unused back; workers live on for other tasks."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def text_blocks(batches: Iterator[pa.RecordBatch], column: str | int) -> Iterator[pa.RecordBatch]:
    """Parts of batches with about BLOCK bytes of text each, a longer text on its own.

    They bound what a task holds, whatever the size of Arrow's batches.
    """
    for batch in batches:
        at = batch.schema.get_field_index(column) if isinstance(column, str) else column
        _, offsets = string_buffers(batch.column(at))
        begin = 0
        while begin < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[begin] + BLOCK, side="right")) - 1
            stop = min(max(stop, begin + 1), batch.num_rows)
            yield batch.slice(begin, stop - begin)
            begin = stop
        release_memory()


def _spans(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of about SPAN bytes that end where a text or a word ends."""
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        stop = at + SPAN
        if stop >= end:
            yield at, end
            return
        border = int(offsets[np.searchsorted(offsets, stop, side="right") - 1])
        if border <= at:  # one text is longer than the span
            border = int(offsets[np.searchsorted(offsets, at, side="right")])
            step = stop
            while step < border:
                blank = np.flatnonzero(_SPACE[raw[step : min(step + SPAN, border)]])
                if len(blank):
                    border = step + int(blank[0])
                    break
                step += SPAN
        yield at, border
        at = border


def word_tokens(
    raw: np.ndarray, offsets: np.ndarray, solid: np.ndarray = _SOLID, letters: np.ndarray = _LOWER
) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(words as an Arrow array of bytes, first byte of each), about SPAN bytes at a time.

    ``solid`` says of each byte whether it belongs to a word (ASCII white space must not),
    ``letters`` what it is written as.
    """
    for lo, hi in _spans(raw, offsets):
        part = raw[lo:hi]
        word = solid[part]
        first = word.copy()
        first[1:] &= ~word[:-1]
        borders = offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi)] - lo
        first[borders] = word[borders]
        begin = np.flatnonzero(first)
        kept = letters[part[word]]
        at = np.cumsum(word, dtype=np.int32)[begin] - 1
        places = np.append(at, len(kept)).astype(np.int32)
        tokens = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(places), pa.py_buffer(kept)])
        yield tokens, begin + lo


def token_lengths(tokens: pa.Array) -> np.ndarray:
    """Bytes of each value of an Arrow array of bytes that starts its buffers."""
    return np.diff(np.frombuffer(tokens.buffers()[1], np.int32)[: len(tokens) + 1])


def word_places(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, byte after the last) of all words in order."""
    hashes, firsts, stops = [], [], []
    for tokens, begin in word_tokens(raw, offsets):
        coded = tokens.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        prints = np.fromiter(map(xxh3_64_intdigest, distinct), np.uint64, len(distinct))
        hashes.append(prints[coded.indices.to_numpy()])
        firsts.append(begin)
        stops.append(begin + token_lengths(tokens))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(firsts), np.concatenate(stops)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, position of each text's first word and the total)."""
    hashes, firsts, _ = word_places(raw, offsets)
    return hashes, np.searchsorted(firsts, offsets).astype(np.int64)


def column_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """word_hashes() of an Arrow string column."""
    return word_hashes(*string_buffers(column))


def hash_words(words: list[str]) -> np.ndarray:
    """The hashes of single words."""
    return column_words(pa.array(words, pa.large_string()))[0]
