"""Byte-pair encoding of whole texts by forced-boundary splitting, and decoding.

Two bytes that stand side by side inside no token of the vocabulary are never merged, so a
word may be cut between them: no merge crosses the cut, and merges on one side change
nothing on the other. (A byte-level vocabulary writes each byte as one character.) Each word of the pre-tokenizer is split at all such pairs, the
fragments are encoded one by one, and their ids are put together again. Words that differ
share their fragments, and a worker remembers what it has encoded.

Texts reach the normalizer and the pre-tokenizer in units between ASCII white space: that
belongs to no word, and no rule of these files looks past it. A task works through the
distinct units of a few MB of text at a time; ids are gathered with numpy.

It is for files of the ``tokenizers`` library with a byte-level BPE without prefix space, whose
pre-tokenizer never joins across ASCII white space and drops it, and without a decoder, such as
``word_bpe_49k.json``; ``Codec`` refuses others.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.words import release_memory, string_buffers, text_blocks, word_tokens

#: New units that go through the library's steps in one call.
CALL_UNITS = 2048
#: Ids that are decoded together.
BLOCK_IDS = 1 << 20
#: Units, words and fragments a worker remembers of each kind, and the longest that are remembered.
REMEMBERED = 3 << 17
LONGEST = 256

_AS_IT_IS = np.arange(256, dtype=np.uint8)
_SOLID = np.ones(256, dtype=bool)
_SOLID[[0x20, *range(0x09, 0x0E)]] = False


class Recent:
    """Remembers up to REMEMBERED keys; when half of that is new, what was not used since is forgotten."""

    def __init__(self) -> None:
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(key) > LONGEST:
            return
        if 2 * len(self.young) >= REMEMBERED:
            self.old, self.young = self.young, {}
        self.young[key] = value


class Codec:
    """Encodes units of text with a file of the ``tokenizers`` library."""

    def __init__(self, file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        with open(file, encoding="utf-8") as source:
            stated = json.load(source)
        model = stated["model"]
        self._require(stated, model)
        whole = Tokenizer.from_file(file)
        self.normalizer, self.pre_tokenizer = whole.normalizer, whole.pre_tokenizer
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        # the end of a word is written into its last character; fragments before it have none
        self.last = BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=self.suffix or None)
        self.inner = BPE(vocab=model["vocab"], merges=merges)
        self.special = [(t["content"], t["id"]) for t in stated["added_tokens"]]
        self.joined = self._joined_pairs(model["vocab"])
        self.units, self.words, self.fragments = Recent(), Recent(), Recent()

    @staticmethod
    def _require(stated: dict, model: dict) -> None:
        steps = (stated.get("pre_tokenizer") or {}).get("pretokenizers") or [stated.get("pre_tokenizer") or {}]
        byte_level = [s for s in steps if s.get("type") == "ByteLevel"]
        fits = (
            model.get("type") == "BPE"
            and not any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback", "ignore_merges", "continuing_subword_prefix"))
            and len(byte_level) == 1
            and not byte_level[0].get("add_prefix_space")
            and any(s.get("type") == "Split" and s.get("behavior") == "Removed" for s in steps)
            and stated.get("decoder") is None
            and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in stated["added_tokens"])
        )
        if not fits:
            raise ValueError("only byte-level BPE files that drop white space and have no decoder are handled")

    def _joined_pairs(self, vocab: dict[str, int]) -> set[str]:
        """The pairs of bytes, as two characters of the alphabet, that stand side by side inside a token."""
        joined = set()
        for token in vocab:
            body = token[: -len(self.suffix)] if self.suffix and token.endswith(self.suffix) else token
            joined.update(map(add, body, body[1:]))
        return joined

    def split(self, word: str) -> list[str]:
        """The fragments of a word that is written in the byte-level alphabet."""
        if self.joined.issuperset(map(add, word, word[1:])):
            return [word]
        cuts = [i for i, pair in enumerate(map(add, word, word[1:]), 1) if pair not in self.joined]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]

    def _fragment(self, fragment: str) -> list[int]:
        """The ids of a fragment that does not end a word."""
        found = self.fragments.get(fragment)
        if found is None:
            found = [t.id for t in self.inner.tokenize(fragment)]
            self.fragments.put(fragment, found)
        return found

    def _word(self, word: str) -> tuple[int, ...]:
        found = self.words.get(word)
        if found is None:
            *inner, end = self.split(word)
            found = [i for fragment in inner for i in self._fragment(fragment)]
            found = tuple(found + [t.id for t in self.last.tokenize(end)])
            self.words.put(word, found)
        return found

    def _plain(self, text: str, out: list[int]) -> None:
        for word, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(text)):
            out += self._word(word)

    def _alone(self, text: str) -> list[int]:
        """Ids of a unit; special strings are taken out first, from the left, the first listed at a tie."""
        out: list[int] = []
        while text:
            spots = [(at, i) for i, (content, _) in enumerate(self.special) if (at := text.find(content)) >= 0]
            if not spots:
                self._plain(text, out)
                break
            at, i = min(spots)
            self._plain(text[:at], out)
            out.append(self.special[i][1])
            text = text[at + len(self.special[i][0]) :]
        return out

    def _together(self, units: list[str]) -> list[list[int]]:
        """Ids of units without white space or special strings, by one call to the library's steps."""
        parts = self.normalizer.normalize_str("\n".join(units)).split(" ")
        if len(parts) != len(units):
            return [self._alone(unit) for unit in units]
        starts = np.cumsum([0, *(len(p) + 1 for p in parts[:-1])])
        words = self.pre_tokenizer.pre_tokenize_str(" ".join(parts))
        out: list[list[int]] = [[] for _ in units]
        owners = np.searchsorted(starts, [at for _, (at, _) in words], side="right") - 1
        for (word, _), owner in zip(words, owners.tolist()):
            out[owner] += self._word(word)
        return out

    def _encode_units(self, units: list[bytes]) -> Iterator[list[int]]:
        for at in range(0, len(units), CALL_UNITS):
            call = units[at : at + CALL_UNITS]
            together = b"\n".join(call).decode()
            texts = together.split("\n")
            # no unit holds white space; Python's includes all that a pattern's does
            if together.split() == texts and not any(content in together for content, _ in self.special):
                yield from self._together(texts)
            else:
                yield from (self._alone(unit.decode()) for unit in call)

    def of_units(self, units: np.ndarray) -> list[bytes]:
        """The ids of each of some distinct units, given as bytes, as the bytes of 32-bit integers."""
        found = [self.units.get(u) for u in units]
        new = [u for u, ids in zip(units, found) if ids is None]
        if new:
            fresh = {}
            for unit, ids in zip(new, self._encode_units(new)):
                fresh[unit] = np.array(ids, np.int32).tobytes()
                self.units.put(unit, fresh[unit])
            found = [fresh[u] if ids is None else ids for u, ids in zip(units, found)]
        return found

    def encode(self, column: pa.Array) -> pa.Array:
        """The ids of each text as an Arrow list."""
        raw, offsets = string_buffers(column)
        counts = np.zeros(len(column), np.int64)
        ids = [np.zeros(0, np.int32)]
        for units, begin in word_tokens(raw, offsets, _SOLID, _AS_IT_IS):
            coded = units.dictionary_encode()
            found = self.of_units(coded.dictionary.to_numpy(zero_copy_only=False))
            size = np.fromiter(map(len, found), np.int64, len(found)) // 4
            flat = np.frombuffer(b"".join(found), np.int32)
            code = coded.indices.to_numpy()
            many = size[code]
            start = (np.cumsum(size) - size)[code]
            # positions in flat: each unit's start, counted on within the unit
            ids.append(flat[np.repeat(start - (np.cumsum(many) - many), many) + np.arange(many.sum())])
            owner = np.searchsorted(offsets, begin, side="right") - 1
            counts += np.bincount(owner, many, len(column)).astype(np.int64)
        places = np.append(0, np.cumsum(counts)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(places), pa.array(np.concatenate(ids)))


def vocabulary(file: str) -> list[str | None]:
    """The text of each id."""
    with open(file, encoding="utf-8") as source:
        stated = json.load(source)
    texts = {i: t for t, i in stated["model"]["vocab"].items()} | {t["id"]: t["content"] for t in stated["added_tokens"]}
    return [texts.get(i) for i in range(max(texts) + 1)]


_codecs: dict[str, Codec] = {}
_vocabularies: dict[str, pa.Array] = {}


def encode_texts(documents: DataFrame, file: str) -> DataFrame:
    """doc_id, ids: the token ids of every row's whole text, one row for each row of ``documents``.

    ``documents`` needs ``doc_id`` and ``text``, other columns are not looked at; ``file`` is at a
    place that every executor has, such as an installed package. The ids are those of the
    library without added special tokens, truncation or padding; a special token's string inside a
    text is that token, as is the library's default. A null, empty or blank text has an empty
    list. Rows may repeat, doc_id may be null: rows never meet. An empty table gives no rows.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codecs.get(file) or _codecs.setdefault(file, Codec(file))
        for batch in text_blocks(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), codec.encode(batch.column(1))], schema=schema)

    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, ids array<int>")


def decode_ids(encoded: DataFrame, file: str) -> DataFrame:
    """The columns of ``encoded`` and ``decoded``: the text of ``ids``, special tokens shown.

    Tokens stand with one space between them, as the library has it for a file without decoder;
    an id that the file does not have is left out, as there. Null ids give null, none an empty text.
    ``encoded`` must not have a column ``decoded``.
    """
    schema = encoded.withColumn("decoded", F.lit(None).cast("string")).schema
    place = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if file not in _vocabularies:
            _vocabularies[file] = pa.array(vocabulary(file), pa.string())
        for batch in batches:
            for part in _id_blocks(batch, place):
                decoded = _decoded(part.column(place), _vocabularies[file])
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=[*part.schema.names, "decoded"])
            release_memory()

    return encoded.mapInArrow(run, schema)


def _id_blocks(batch: pa.RecordBatch, place: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about BLOCK_IDS ids each, a longer list on its own."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(place)), 0).to_numpy())
    begin = 0
    while begin < batch.num_rows:
        so_far = ends[begin - 1] if begin else 0
        stop = min(max(int(np.searchsorted(ends, so_far + BLOCK_IDS, side="right")), begin + 1), batch.num_rows)
        yield batch.slice(begin, stop - begin)
        begin = stop


def _decoded(column: pa.Array, texts: pa.Array) -> pa.Array:
    """The text of each list of ids."""
    ids = column.flatten()
    known = pc.and_(pc.greater_equal(ids, 0), pc.less(ids, len(texts)))
    tokens = texts.take(pc.if_else(known, ids, None))
    lists = pa.ListArray.from_arrays(_list_offsets(column), tokens)
    if tokens.null_count:
        lists = _without_nulls(lists)
    return pc.if_else(column.is_valid(), pc.binary_join(lists, " "), None)


def _list_offsets(column: pa.Array) -> pa.Array:
    """Offsets into ``column.flatten()``; a null list has no values."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    return pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32))


def _without_nulls(lists: pa.Array) -> pa.Array:
    values = lists.values
    kept = np.append(0, np.cumsum(values.is_valid().to_numpy(zero_copy_only=False)))
    return pa.ListArray.from_arrays(pa.array(kept[lists.offsets.to_numpy()].astype(np.int32)), values.drop_null())
