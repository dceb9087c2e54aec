"""Token counts of whole texts, as a byte-level BPE tokenizer of the ``tokenizers`` library gives them.

Arrow batches go in, lengths come out; token ids never leave the encoder. Texts are cut
into units where a cut cannot change a token: before ASCII white space that follows a
character that is no white space, and between an ASCII letter and most ASCII punctuation.
There the pre-tokenizer of a byte-level BPE always cuts too, and no special token of such
a file has these neighbours. A worker encodes
each distinct unit once, in batches of about equal bytes, and adds up lengths, so that
neither a very long text nor many short ones make a batch large.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.words import string_buffers

#: Bytes looked at together, bytes encoded in one call, and units a worker remembers.
SPAN = 1 << 20
CALL_BYTES = 1 << 19
REMEMBERED = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SOLID = np.zeros(256, dtype=bool)
_SOLID[0x21:0x7F] = True
_SOLID[0x80:] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in "!#$%&()*+,-./:;=?"]] = True
# fixed values: the first bytes of white space outside ASCII, and their second bytes
_LEAD = np.isin(np.arange(256), [0xE1, 0xE2, 0xE3])
_MIDDLE = np.isin(np.arange(256), [0x80, 0x81, 0x9A])
_LATIN = np.isin(np.arange(256), [0x85, 0xA0])


def safe_cuts(raw: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Positions in lo+1..hi-1 where a text may be cut."""
    back = max(lo - 3, 0)
    part = raw[back:hi]
    space = np.flatnonzero(_SPACE[part])
    space = space[space > lo - back]
    before = part[space - 1]
    good = _SOLID[before]
    wide = np.flatnonzero(good & (before >= 0x80))
    at = space[wide]
    second = part[np.maximum(at - 2, 0)]
    third = part[np.maximum(at - 3, 0)]
    blank = (_LATIN[before[wide]] & (second == 0xC2)) | (_MIDDLE[second] & _LEAD[third])
    good[wide[blank]] = False
    mark = np.flatnonzero(_MARK[part])
    mark = mark[mark > lo - back]
    mark = mark[_LETTER[part[mark - 1]]]
    return np.sort(np.concatenate([space[good], mark])) + back


def unit_spans(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """(starts of consecutive units, end of the last one), about SPAN bytes at a time."""
    at, end = int(offsets[0]), int(offsets[-1])
    borders = offsets[np.append(np.diff(offsets) > 0, True)]
    while at < end:
        size = SPAN
        while True:
            stop = min(at + size, end)
            cuts = safe_cuts(raw, at, stop)
            inner = borders[np.searchsorted(borders, at, "right") : np.searchsorted(borders, stop)]
            starts = np.sort(np.concatenate([cuts, inner]))
            starts = starts[np.append(True, np.diff(starts) > 0)] if len(starts) else starts
            if stop == end or len(starts):
                break
            size *= 2
        starts = np.concatenate([[at], starts]).astype(np.int64)
        if stop == end:
            yield starts, end
            return
        yield starts[:-1], int(starts[-1])
        at = int(starts[-1])


class Lengths:
    """Token counts of units, remembered by their bytes."""

    def __init__(self, file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(file)
        self.encoder.no_truncation()
        self.encoder.no_padding()
        self.known: dict[bytes, int] = {}

    def _encode(self, units: list[str]) -> Iterator[int]:
        call, size = [], 0
        for unit in units:
            call.append(unit)
            size += len(unit) + 16
            if size >= CALL_BYTES:
                yield from (len(e) for e in self.encoder.encode_batch_fast(call, add_special_tokens=False))
                call, size = [], 0
        yield from (len(e) for e in self.encoder.encode_batch_fast(call, add_special_tokens=False))

    def of(self, raw: np.ndarray, starts: np.ndarray, end: int) -> np.ndarray:
        """The token count of each unit."""
        lo = int(starts[0])
        places = pa.py_buffer((np.append(starts, end) - lo).astype(np.int32))
        units = pa.Array.from_buffers(pa.binary(), len(starts), [None, places, pa.py_buffer(raw[lo:end])])
        coded = units.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        new = [unit for unit in distinct if unit not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {unit: self.known[unit] for unit in distinct if unit in self.known}
        self.known.update(zip(new, self._encode([unit.decode() for unit in new])))
        counts = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        return counts[coded.indices.to_numpy()]


_lengths: dict[str, Lengths] = {}


def _count(file: str):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if file not in _lengths:
            _lengths[file] = Lengths(file)
        lengths = _lengths[file]
        for batch in batches:
            raw, offsets = string_buffers(batch.column(1))
            tokens = np.zeros(batch.num_rows, np.int64)
            for starts, end in unit_spans(raw, offsets):
                owner = np.searchsorted(offsets, starts, side="right") - 1
                tokens += np.bincount(owner, lengths.of(raw, starts, end), batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(tokens)], schema=schema
            )

    return run


def count_tokens(documents: DataFrame, file: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row for each row of ``documents``.

    ``documents`` needs ``doc_id`` and ``text``, other columns are not looked at; ``file``
    is a byte-level BPE file of the ``tokenizers`` library at a place that every executor
    has, such as an installed package. No special tokens are added; special strings
    inside a text are handled as the library does. A null or empty text has no bytes and
    no tokens. Rows may repeat, doc_id may be null: rows never meet.
    """
    counted = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        _count(file), "doc_id bigint, n_bytes bigint, n_tokens bigint"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
