"""Hard negatives, ranked search and the BPE codec against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm import bpe_codec, hard_negatives, lexical_search, queries
from riskflow.llm.bpe_codec import Codec, decode_ids, encode_texts
from riskflow.llm.hard_negatives import mine_hard_negatives
from riskflow.llm.lexical_search import rank_documents
from riskflow.llm.queries import tokenizer_file
from riskflow.llm.words import column_words

from llm.brute import words
from llm.conftest import LONG, PLAIN, ROWS

ITEM = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.LongType())])
VECTOR = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())]
)


def by_null(value):
    return (value is None, value)


# ------------------------------------------------------------- word hashes


def thue_morse(size):
    text = "a"
    while len(text) < size:
        text += text.translate(str.maketrans("ab", "ba"))
    return text


@pytest.mark.parametrize("size", [1024, 4096])
def test_words_that_a_polynomial_confuses_have_hashes_of_their_own(size):
    one = thue_morse(size)
    hashes, _ = column_words(pa.array([one, one.translate(str.maketrans("ab", "ba"))]))
    assert len(set(hashes.tolist())) == 2


# ------------------------------------------------------------- hard negatives


def brute_negatives(rows, is_anchor, k=5, many=10):
    usable = []
    for vec_id, vector, label in rows:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            usable.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    found = []
    for i, (anchor_id, one, label) in enumerate(usable):
        if anchor_id is None or not is_anchor(anchor_id):
            continue
        scored = [(-sum(a * b for a, b in zip(one, v)), by_null(v_id), l) for j, (v_id, v, l) in enumerate(usable) if j != i]
        scored.sort()
        for score, (_, positive), _ in [s for s in scored if s[2] == label][:k]:
            fits = [s for s in scored if s[2] != label and 30 * -score <= 100 * -s[0] <= 90 * -score]
            found += [(anchor_id, positive, r, s[1][1], -score, -s[0]) for r, s in enumerate(fits[:many], 1)]
    return sorted(found, key=str)


def lines(df):
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=str)


def test_negatives_match_brute_force_over_levels_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "FIRST_LEVEL", 16)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", 2000)
    monkeypatch.setattr(hard_negatives, "TILE_ANCHORS", 3)
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 50)
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1, (6, 20))
    rows = []
    for i in range(400):  # a third of the rows have one label, and groups of rows are copies
        label = 0 if i % 3 == 0 else int(rng.integers(1, 6))
        vector = centres[label] + rng.normal(0, 0.6, 20) if i % 11 else centres[1] + 0.25
        rows.append((i, [float(np.float32(x)) for x in vector], label))
    df = spark.createDataFrame(rows, VECTOR)
    for dense in (0.05, 1.0):
        monkeypatch.setattr(hard_negatives, "DENSE", dense)
        got = lines(mine_hard_negatives(df, F.col("vec_id") % 20 == 0))
        assert got and got == brute_negatives(rows, lambda i: i % 20 == 0)


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-300, 300, (40, 37))
    parts = [hard_negatives.summaries(vectors, n) for n in hard_negatives.SEGMENTS]
    rows = hard_negatives.Vectors(np.arange(40), np.zeros(40, np.int64), vectors, [m for m, _ in parts], [d for _, d in parts])
    exact = hard_negatives.exact_scores(vectors, vectors)
    assert (exact == vectors @ vectors.T).all()
    widths = []
    for level in range(len(hard_negatives.SEGMENTS)):
        lower, upper = hard_negatives.score_bounds(rows, rows, level)
        assert (lower <= exact).all() and (exact <= upper).all()
        a, b = np.nonzero(np.ones((40, 40), bool))
        some = hard_negatives.score_bounds(rows, rows, level, (a, b))
        assert np.allclose(some[0], lower.ravel()) and np.allclose(some[1], upper.ravel())
        widths.append((upper - lower).mean())
    assert widths[1] < widths[0]


def test_large_products_stay_whole():
    big = np.array([[2**30, 2**30 + 1, -7]])
    assert hard_negatives.exact_scores(big, big).tolist() == [[2**60 + (2**30 + 1) ** 2 + 49]]


def test_negatives_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1),
        (1, [1.0, 0.25], 1),
        (2, [0.5, 0.5], 2),
        (3, [0.5, 0.5], 2),
        (4, None, 1),
        (5, [1.0, None], 1),
        (6, [nan, 1.0], 2),
        (7, [inf, 1.0], 2),
        (8, [1.0, 1.0], None),
        (9, [0.75], 2),
        (10, [], 1),
        (None, [0.5, 0.5], 2),
        (None, [1.0, 0.5], 1),
        (11, [-1.0, -1.0], 1),
    ]
    df = spark.createDataFrame(rows, VECTOR).withColumns({c: F.lit(-1) for c in ("row", "level", "window", "score", "rank", "vector", "means")})
    expected = brute_negatives(rows, lambda i: i == 0)
    assert lines(mine_hard_negatives(df, F.col("vec_id") == 0)) == expected and expected
    twice = spark.createDataFrame(rows + rows[:1], VECTOR)
    assert lines(mine_hard_negatives(twice, F.col("vec_id") == 0)) == brute_negatives(rows + rows[:1], lambda i: i == 0)
    assert lines(mine_hard_negatives(df, F.col("vec_id") == 99)) == []
    assert mine_hard_negatives(spark.createDataFrame([], VECTOR), F.lit(True)).count() == 0


# ------------------------------------------------------------- ranked search


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute_ranks(documents, items, k=20):
    held = [(doc_id, Counter(terms(text))) for doc_id, text in documents]
    held = [(doc_id, c) for doc_id, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    found = []
    for item_id, text in items:
        wanted = Counter(terms(text))
        scored = []
        for doc_id, c in held:
            m = 75 + (25 * sum(c.values()) * n) // total
            score = sum(
                times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, times in wanted.items()
                if t in c
            )
            if score > 0:
                scored.append((-score, by_null(doc_id)))
        found += [(item_id, r, d, -s) for r, (s, (_, d)) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=str)


def ranks(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_ranks_match_brute_force_with_stops(spark, texts, monkeypatch):
    monkeypatch.setattr(lexical_search, "STRETCH_BYTES", 1 << 14)
    monkeypatch.setattr(lexical_search, "FIRST_STEP", 2)
    rows = [(r["doc_id"], r["text"]) for r in texts.select("doc_id", "text").collect()]
    rng = random.Random(4)
    items = [(i, " ".join(rng.sample(words(rows[i * 3][1]) or ["x"], 1) * 2 + words(rows[i * 3][1])[:9])) for i in range(30)]
    df = spark.createDataFrame(items, "item_id long, text string")
    assert ranks(rank_documents(texts, df, 3)) == brute_ranks(rows, items, 3)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 200)
    assert ranks(rank_documents(texts, df)) == brute_ranks(rows, items)


def test_an_item_stops_before_it_has_met_all_documents():
    rng = random.Random(8)
    documents = [(i, " ".join(["hot"] * (i % 50) + [f"w{rng.randrange(500)}" for _ in range(60)])) for i in range(3000)]
    items = lexical_search.Items.of([(1, "hot")])
    column = pa.array([t for _, t in documents], pa.large_string())
    lengths, number, owner, times = lexical_search._count_terms(column, items.terms)
    corpus = lexical_search.Corpus(3000, int(lengths.sum()), np.array([700]))
    index = lexical_search.Index.of([(pa.array(range(3000)), lengths, number, owner, times)], corpus)
    best = lexical_search.Best(20)
    looked = lexical_search.best_positions(index, items.numbers[0], items.repeats[0], best, np.arange(3000), np.zeros(3000, bool))
    assert 20 <= looked < 600 and best.full()
    assert not index.seen.any()


def test_ranks_of_odd_rows(spark, odd_documents, no_documents):
    items = [(1, "Quick ONE idiot"), (None, "one one"), (2, None), (3, ""), (1, "word5x5"), (4, "??? --")]
    df = spark.createDataFrame([(*i, 0) for i in items], ITEM)
    assert ranks(rank_documents(odd_documents, df)) == brute_ranks([r[:2] for r in ROWS], items)
    assert rank_documents(no_documents, df).count() == 0
    assert rank_documents(odd_documents, df.limit(0)).count() == 0


# ------------------------------------------------------------- BPE


ODD = [
    "",
    " \n",
    "a<|endoftext|>b <|ENDOFTEXT|> x<|startoftext|><|endoftext|>",
    "It's DON'T x'S 're ſ'ſ",
    "é" * 300 + " ÀÉ Å ́x é   \x1c\x85x  y",
    "中文字符測試한국어 тест ΣΑΣ ΌΣΟΣ.",
    "\U0001f600\U0001f600 a\U0001f600b a\x00b İI ﬃ ẞ",
    "x" * 5000,
    thue_morse(1024) + " " + thue_morse(1024).translate(str.maketrans("ab", "ba")),
]


@pytest.fixture(scope="module")
def word_file():
    return tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library(word_file):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_file)


def test_codec_gives_the_library_s_ids(word_file, library, monkeypatch):
    rng = random.Random(1)
    alphabet = "aAbBéñß'’.,-!<|>endoftext \t\n 　中😀0١Σσς̧́İ\x1c\x85​한"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert Codec(word_file).encode(pa.array(texts)).to_pylist() == expected
    monkeypatch.setattr("riskflow.llm.words.SPAN", 1 << 8)
    monkeypatch.setattr(bpe_codec, "REMEMBERED", 64)
    monkeypatch.setattr(bpe_codec, "CALL_UNITS", 7)
    monkeypatch.setattr(bpe_codec, "BLOCK_IDS", 5)
    assert Codec(word_file).encode(pa.array(texts)).to_pylist() == expected


def test_no_merge_crosses_a_forced_boundary(word_file):
    codec = Codec(word_file)
    spots = Counter(len(codec.split(w)) for w in ("the", "ä¸ŃæĸĩåŃĹç¬¦æ¸¬è©¦", "qzxjqvkwz", "x"))
    assert spots[1] and any(n > 1 for n in spots)
    for word in ("ä¸ŃæĸĩåŃĹç¬¦æ¸¬è©¦", "qzxjqvkwz"):
        assert "".join(codec.split(word)) == word
        assert list(codec._word(word)) == [t.id for t in codec.last.tokenize(word)]


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        Codec(tokenizer_file("byte_bpe_50k.json"))


def test_round_trip_of_odd_rows(spark, odd_documents, no_documents, word_file, library):
    coded = decode_ids(encode_texts(odd_documents, word_file), word_file)
    got = sorted(((r["doc_id"], r["ids"], r["decoded"]) for r in coded.collect()), key=str)
    expected = []
    for doc_id, text, *_ in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, ids, library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(expected, key=str)
    assert encode_texts(no_documents, word_file).count() == 0


def test_decoding_skips_unknown_ids_and_keeps_null_lists(spark, word_file, library):
    lists = [[1, 999_999, 2], [], None, [-1], [49407, 5]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "n int, ids array<int>")
    got = {r["n"]: r["decoded"] for r in decode_ids(df, word_file).collect()}
    assert got == {0: library.decode([1, 2]), 1: "", 2: None, 3: "", 4: library.decode([49407, 5], skip_special_tokens=False)}


def test_round_trip_query(spark, sf_dir, texts, library):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op13_bpe_round_trip(spark, sf_dir).collect()}
    for row in texts.limit(60).collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        assert got[row["doc_id"]] == (len(ids), *digests)


# ------------------------------------------------------------- words that a polynomial confuses, in the operators


def test_confusable_words_are_told_apart(spark, library):
    from tokenizers import Tokenizer

    from riskflow.llm.near_dedup import near_duplicates
    from riskflow.llm.token_counts import count_tokens

    one = thue_morse(1024)
    two = one.translate(str.maketrans("ab", "ba"))
    df = spark.createDataFrame([(1, one), (2, two), (3, f"{one} {PLAIN}"), (4, f"{two} {PLAIN}")], "doc_id long, text string")
    file = tokenizer_file("byte_bpe_50k.json")
    counts = {r["doc_id"]: r["n_tokens"] for r in count_tokens(df, file).collect()}
    whole = Tokenizer.from_file(file)
    assert counts == {r["doc_id"]: len(whole.encode(r["text"], add_special_tokens=False).ids) for r in df.collect()}
    groups = {r["doc_id"]: r["component_id"] for r in near_duplicates(df, shingle_words=2).collect()}
    assert groups[1] == 1 and groups[2] == 2


# ------------------------------------------------------------- short benchmark items


def test_short_items_are_found_as_they_are(spark):
    from riskflow.llm.decontaminate import drop_contaminated, find_passages

    documents = [(1, f"{PLAIN} The secret answer is here, the secret answer is"), (2, "the secret"), (3, "answer is the secret"), (4, None), (5, f"x {thue_morse(1024)}")]
    other = thue_morse(1024).translate(str.maketrans("ab", "ba"))
    items = [(10, "the secret answer is"), (11, "SECRET"), (12, "the secret"), (12, "the secret"), (13, ""), (14, None), (15, other), (None, "secret answer")]
    df = spark.createDataFrame(documents, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    expected = []
    for doc_id, text in documents:
        held = words(text)
        for item_id, item in items:
            wanted = words(item)
            at = [i for i in range(len(held) - len(wanted) + 1) if wanted and held[i : i + len(wanted)] == wanted]
            expected += [(doc_id, item_id, at[0], 0, len(wanted))] if at else []
    assert sorted(map(tuple, find_passages(df, asked).collect()), key=str) == sorted(expected, key=str)
    assert sorted(r["doc_id"] for r in drop_contaminated(df, asked).collect()) == [4, 5]
