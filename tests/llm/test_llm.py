"""The training-data operators against brute force, and on odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskflow.llm import decontaminate, exact_dedup, html_text, ngram_trie, toxicity
from riskflow.llm.components import components
from riskflow.llm.curriculum import mix_sources, readings
from riskflow.llm.decontaminate import find_passages
from riskflow.llm.exact_dedup import exact_duplicates, split_deliveries
from riskflow.llm.host_reputation import judge_urls
from riskflow.llm.html_text import common_lines, main_texts, page_lines
from riskflow.llm.near_dedup import near_duplicates
from riskflow.llm.ngram_trie import score_texts
from riskflow.llm.quality import judge_quality
from riskflow.llm.queries import URL_RULES, tokenizer_file
from riskflow.llm.token_counts import count_tokens
from riskflow.llm.toxicity import score_toxicity
from riskflow.llm.words import column_words
from riskflow.plans import lookup

from llm.brute import fewest_edits, near_groups, words
from llm.conftest import PLAIN, ROWS


def ids(df):
    return sorted((r["doc_id"] for r in df.collect()), key=lambda x: (x is None, x))


ALL_IDS = sorted((r[0] for r in ROWS), key=lambda x: (x is None, x))


# ------------------------------------------------------------- words, components


def test_words_match_the_pattern_whatever_the_span(monkeypatch):
    texts = [r[1] for r in ROWS] + ["A\x1cB c\x0bd", "x" * 5000, None]
    hashes, starts = column_words(pa.array(texts))
    flat = [w for t in texts for w in words(t)]
    assert np.diff(starts).tolist() == [len(words(t)) for t in texts]
    seen = {}
    assert all(seen.setdefault(w, h) == h for w, h in zip(flat, hashes.tolist()))
    assert len(set(seen.values())) == len(seen)
    monkeypatch.setattr("riskflow.llm.words.SPAN", 1 << 10)
    again, places = column_words(pa.array(texts))
    assert (again == hashes).all() and (places == starts).all()


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(20, 40)] + [(100, k) for k in range(101, 120)] + [(5, 5), (None, 3), (41, 40)]
    got = dict(components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect())
    assert got == {**{i: 20 for i in range(20, 42)}, **{k: 100 for k in range(100, 120)}}


# ------------------------------------------------------------- near duplicates


def test_near_duplicates_match_brute_force(spark, texts):
    rows = [(r["doc_id"], r["text"]) for r in texts.select("doc_id", "text").collect()]
    expected = near_groups(rows, 2)
    got = near_duplicates(texts, shingle_words=2).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_dense_groups_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr("riskflow.llm.near_dedup.SMALL", 4)
    monkeypatch.setattr("riskflow.llm.near_dedup.CHUNK_BYTES", 4096)
    rng = random.Random(3)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(80):  # similarities on both sides of the threshold
        text = list(base)
        for _ in range(rng.randint(0, 5)):
            text[rng.randrange(60)] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df, shingle_words=2).collect()}
    assert got == near_groups(rows, 2)


def test_near_duplicates_of_odd_rows(odd_documents, no_documents):
    got = near_duplicates(odd_documents).collect()
    assert sorted((r["doc_id"] for r in got), key=lambda x: (x is None, x)) == ALL_IDS
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_id[2]["component_id"] == 1 and not by_id[2]["kept"]
    assert all(by_id[i]["kept"] and by_id[i]["n_shingles"] == 0 for i in (3, 4, 5))
    assert sorted(r["component_id"] or -1 for r in got if r["doc_id"] is None) == [-1, 6]
    assert near_duplicates(no_documents).count() == 0


# ------------------------------------------------------------- exact duplicates


def test_minimal_hash_finds_members_only():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 256, (3000, 32), dtype=np.uint8)
    sizes, levels, slots = exact_dedup.build_hash(keys[:2000])
    assert sorted(slots.tolist()) == list(range(2000))
    stored = np.empty((2000, 32), np.uint8)
    stored[slots] = keys[:2000]
    found = exact_dedup.find_slots(sizes, levels, stored, keys)
    assert (found[:2000] == slots).all() and (found[2000:] == -1).all()


def test_exact_duplicates_of_odd_rows(odd_documents, no_documents):
    got = exact_duplicates(*split_deliveries(odd_documents)).collect()
    assert sorted((r["doc_id"] for r in got), key=lambda x: (x is None, x)) == ALL_IDS
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert (by_id[2]["keep_id"], by_id[2]["group_size"], by_id[2]["kept"]) == (1, 2, False)
    assert (by_id[4]["keep_id"], by_id[3]["group_size"], by_id[5]["group_size"]) == (3, 3, 1)
    assert by_id[6]["group_size"] == 3
    assert exact_duplicates(no_documents, no_documents).count() == 0
    assert exact_duplicates(no_documents, odd_documents).count() == len(ROWS)


# ------------------------------------------------------------- tokens


def test_token_counts_are_the_librarys(odd_documents, no_documents, texts, monkeypatch):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokenizer_file())
    for df in (odd_documents, texts):
        got = sorted((r["n_bytes"], r["n_tokens"]) for r in count_tokens(df, tokenizer_file()).collect())
        rows = [r["text"] or "" for r in df.select("text").collect()]
        assert got == sorted((len(t.encode()), len(encoder.encode(t, add_special_tokens=False).ids)) for t in rows)
    assert count_tokens(no_documents, tokenizer_file()).count() == 0


def test_cuts_never_change_counts(monkeypatch):
    from tokenizers import Tokenizer

    from riskflow.llm import token_counts

    encoder = Tokenizer.from_file(tokenizer_file())
    rng = random.Random(7)
    signs = ["a", "bc", "é", "ß", " ", "  ", "\n", "\t", " ", " ", "　", "\x1c", "\x85", "12", "'s", "'", "<|endoftext|>", "日", "!", "A.", " "]
    rows = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(3000)]
    monkeypatch.setattr(token_counts, "SPAN", 64)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows)], names=["doc_id", "text"])
    got = next(token_counts._count(tokenizer_file())(iter([batch]))).column(2).to_pylist()
    assert got == [len(encoder.encode(t, add_special_tokens=False).ids) for t in rows]


# ------------------------------------------------------------- passages


def test_passages_match_brute_force_and_recall(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [(r["item_id"], words(r["text"])) for r in benchmark.collect()]
    rng = random.Random(11)
    rows, exact = [], []
    for n in range(200):
        item_id, item = rng.choice(items)
        text = list(item)
        for _ in range(rng.randint(0, int(len(item) * 0.3))):
            at = rng.randrange(len(text))
            choice = rng.random()
            if choice < 0.4:
                text[at] = f"other{rng.randrange(999)}"
            elif choice < 0.7:
                text.insert(at, "more")
            elif len(text) > 1:
                del text[at]
        whole = [f"pre{i}" for i in range(rng.randint(0, 40))] + text + ["post"] * rng.randint(0, 9)
        rows.append((n, " ".join(whole)))
        edits = fewest_edits(item, whole)
        if edits <= int(0.2 * len(item)):
            exact.append((n, item_id, edits))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in find_passages(df, benchmark).collect()}
    hits = [e for e in exact if got.get(e[:2]) == e[2]]
    assert len(hits) >= 0.95 * len(exact) and len(exact) > 60
    text_of = dict(rows)
    item_of = dict(items)
    assert all(fewest_edits(item_of[i], text_of[n].split()) == e for (n, i), e in got.items())


def test_passages_of_odd_rows(spark, odd_documents, no_documents):
    benchmark = spark.createDataFrame([(1, PLAIN), (2, None), (None, PLAIN), (3, "too few words"), (4, "")], "item_id long, text string")
    got = find_passages(odd_documents, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(d, i) for d in (1, 2, 8) for i in (1, None)}
    assert find_passages(no_documents, benchmark).count() == 0
    assert find_passages(odd_documents, benchmark.limit(0)).count() == 0


def test_blocks_of_items_find_the_same(spark, texts, sf_dir, monkeypatch):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole = {tuple(r) for r in find_passages(texts, benchmark).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 300)
    assert {tuple(r) for r in find_passages(texts, benchmark).collect()} == whole and whole


# ------------------------------------------------------------- language model


def test_elias_fano_round_trip():
    rng = np.random.default_rng(2)
    for top in (1, 300, 1 << 40):
        values = np.sort(rng.integers(0, top, 500).astype(np.uint64))
        assert (ngram_trie.decode(ngram_trie.encode(values)) == values).all()
    assert len(ngram_trie.decode(ngram_trie.encode(np.zeros(0, np.uint64)))) == 0


def test_scores_match_brute_force(texts, monkeypatch):
    import math
    from collections import Counter

    monkeypatch.setattr(ngram_trie, "SHARD_BYTES", 200_000)
    learnt = texts.where("doc_id % 3 > 0")
    got = {r["doc_id"]: r for r in score_texts(texts, learnt).collect()}
    docs = {r["doc_id"]: [*words(r["text"]), "\0"] for r in texts.collect()}
    one, two, n = Counter(), Counter(), 0
    for i, t in docs.items():
        if i % 3:
            one.update(t)
            two.update(zip(["\1", *t], t))
            n += 1
    total, kinds = sum(one.values()), len(one)
    unseen = sum(1 for c in one.values() if c == 1) / total
    for i, t in docs.items():
        base = sum(math.log10((one[w] + 1) / (total + kinds + 1)) for w in t)
        model = 0.0
        for u, w in zip(["\1", *t], t):
            p = one[w] * (1 - unseen) / total if one[w] else unseen
            before = n if u == "\1" else one[u]
            model += math.log10((two[u, w] + ngram_trie.PRIOR * p) / (before + ngram_trie.PRIOR))
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(one[w] > 0 for w in t), total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(model, rel=0.02)  # probabilities are one byte each


def test_scores_of_odd_rows(odd_documents, no_documents):
    got = score_texts(odd_documents, odd_documents).collect()
    assert sorted((r["doc_id"] for r in got), key=lambda x: (x is None, x)) == ALL_IDS
    assert all(r["n_tokens"] == 1 for r in got if r["doc_id"] in (3, 4, 5))
    assert score_texts(no_documents, odd_documents).count() == 0
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in score_texts(odd_documents, no_documents).collect())


# ------------------------------------------------------------- toxicity


@pytest.fixture(scope="module")
def insults():
    rng = random.Random(5)
    plain = ["".join(rng.choices("abcdeilmnorstu", k=rng.randint(3, 8))) for _ in range(1500)]
    texts, toxic = [], []
    for i in range(900):
        body = rng.choices(plain, k=rng.randint(5, 60))
        bad = i % 3 == 0
        if bad:
            for _ in range(rng.randint(1, 3)):
                body.insert(rng.randrange(len(body)), rng.choice(["idiot", "moron", "wretchkin", "wretchery", "wretchums"]))
        texts.append(" ".join(body))
        toxic.append(bad)
    return texts, np.array(toxic)


def test_toxicity_learns_and_bears_gaps(insults):
    texts, toxic = insults
    model = toxicity.fit(texts[:600], toxic[:600])
    top, size = toxicity.top_margins(*toxicity.string_buffers(pa.array(texts[600:])), model.table, model.bias)
    guess = model.scores(top, size) >= 0.5
    assert (guess == toxic[600:]).mean() > 0.97
    odd = ["some i-d-i-o-t here", "some i d i o t here", "some IDIOT! here", "some wretchling here", "some moroon here"]
    top, size = toxicity.top_margins(*toxicity.string_buffers(pa.array(odd)), model.table, model.bias)
    assert (model.scores(top, size) >= 0.5).sum() >= 4
    top, size = toxicity.top_margins(*toxicity.string_buffers(pa.array(["", "  "])), model.table, model.bias)
    assert (model.scores(top, size) < 0.5).all()


def test_toxicity_of_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 0), (8, 1), (8, None), (None, 1), (6, 0)], "doc_id long, toxic int")
    got = score_toxicity(odd_documents, labels).collect()
    assert sorted((r["doc_id"] for r in got), key=lambda x: (x is None, x)) == ALL_IDS
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert score_toxicity(no_documents, labels).count() == 0
    assert score_toxicity(odd_documents, labels.limit(0)).count() == len(ROWS)


# ------------------------------------------------------------- quality


def test_quality_keeps_trusted_and_drops_junk(spark, texts, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = judge_quality(texts, labels.where("quality = 1")).join(labels, "doc_id")
    share = {r["quality"]: r["s"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("s")).collect()}
    assert share[1] > 0.9 and share[0] < 0.5


def test_quality_of_odd_rows(spark, odd_documents, no_documents):
    trusted = spark.createDataFrame([(1,), (2,), (6,), (7,), (None,), (9,)], "doc_id long")
    got = judge_quality(odd_documents, trusted).collect()
    assert sorted((r["doc_id"] for r in got), key=lambda x: (x is None, x)) == ALL_IDS
    assert all(r["perplexity"] is None and not r["kept"] for r in got if r["doc_id"] in (3, 4))
    assert judge_quality(no_documents, trusted).count() == 0
    assert sum(r["kept"] for r in judge_quality(odd_documents, trusted.limit(0)).collect()) == len(ROWS) - 3


def test_quality_learns_from_every_trusted_text_of_its_half(spark, monkeypatch):
    """Some 23,000 are learnt from; the last 3,000 of them by hash alone know how the rare texts read."""
    hashed = spark.range(46_000).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("h"))
    learns = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0
    last = hashed.where(learns).orderBy("h").offset(20_000).first()["h"]
    text = F.when(learns & (F.col("h") >= last), "zqzqzqzqzqzqzqzq").otherwise("abababababababab")
    documents = hashed.select("doc_id", text.alias("text"), F.lit("en").alias("lang"))
    rare = spark.createDataFrame([(-1, "zqzqzqzqzqzqzqzq", "en")], documents.schema)
    trusted, documents = documents.select("doc_id"), documents.union(rare).repartition(4)

    def found():
        return {r["doc_id"]: (r["perplexity"], r["threshold"], r["kept"]) for r in judge_quality(documents, trusted).collect()}

    sent = found()
    assert len(sent) == 46_001 and sent[-1][0] < 3
    monkeypatch.setattr(lookup, "MAX_BROADCAST_ROWS", 0)
    assert found() == sent


# ------------------------------------------------------------- pages


def test_page_structure():
    page = (
        '<html><head><title>no</title><style>p{}</style></head><body><nav>menu<ul><li>a</nav><div class="ad box">buy<div>x</div>y</div>'
        '<header>top</header><div id=cookie-notice>cookies</div><article class="post"><header><h1>T &amp; u</h1></header><p>a<b>b</b>c\n d'
        '<script>var a="</p>"</script><p>e<aside>no</aside>f &#8212;&nbsp;g<form>mail</form><section id="comments">zz</section></article>'
        "<footer>end</footer></body>"
    )
    assert [line for line, own in page_lines(page) if own] == ["T & u", "abc d", "e", "f — g"]
    assert all(own for _, own in page_lines(page))
    assert page_lines("") == [] and page_lines("<p>a &am") == [("a &am", False)]
    assert page_lines("<nav>m<article><p>kept</article>") == [("kept", True)]


def test_common_lines():
    assert common_lines([1, 2, 3, 4, 5], [1, 9, 3, 5]) == [1, 3, 5]
    rng = random.Random(4)
    for _ in range(50):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(12))] for _ in "ab")
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        found = common_lines(a, b)
        assert len(found) == best[-1][-1]
        it = iter(a)
        assert all(x in it for x in found)


def test_lines_shared_with_the_nearest_page_go(spark, monkeypatch):
    page = "<div>Site</div><div>Log in</div><div>{}</div><div>Terms</div>"
    rows = [(i, f"http://h.example/{d}/{i}", page.format(f"text {i}")) for i, d in [(1, "a"), (2, "a"), (3, "b"), (4, "b")]]
    rows += [(5, None, page.format("alone")), (6, "http://k.example/", None), (7, "nourl", "<p>x"), (None, "http://h.example/a/1", "<p>y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit(1), "text": F.lit(2)})
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in main_texts(df).collect()}
    assert all(got[i] == (f"text {i}", 6) for i in (1, 2, 3, 4))
    assert got[5][0] == "Site\nLog in\nalone\nTerms"
    assert got[6] == ("", 0) and got[7] == ("x", 1) and got[None] == ("y", 1)
    assert main_texts(df.limit(0)).count() == 0


@pytest.mark.parametrize("partitions", [1, 7])
def test_pages_are_compared_whatever_their_template_and_past_their_copies(spark, partitions):
    bare = "<div>Site</div><div>Log in</div><div>{}</div><div>Terms</div>"
    full = "<nav>Site</nav><div class=ad>Log in</div><article><p>{}</article><footer>Terms</footer>"
    rows = [(1, "http://mixed.example/a/1", bare.format("one")), (2, "http://mixed.example/a/2", full.format("two"))]
    rows += [(10 + i, f"http://copies.example/a/{10 + i}", bare.format("copied")) for i in range(20)]
    rows += [(40, "http://copies.example/b/1", bare.format("other")), (41, "http://copies.example/c/1", "")]
    rows += [(50 + i, f"http://same.example/{i}", bare.format("same")) for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r["page_id"]: r["text"] for r in main_texts(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    assert got[1] == "one" and got[2] == "two"
    assert [got[10 + i] for i in range(20)] == ["copied"] * 20
    assert got[40] == "other" and got[41] == ""
    assert all("same" in got[50 + i] for i in range(3))


def test_every_page_of_a_host_is_aligned(spark, sf_dir, monkeypatch):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").withColumn("url", F.concat(F.lit("http://one.example/"), "page_id"))
    seen = []
    join = html_text.join_groups
    monkeypatch.setattr(html_text, "join_groups", lambda *a: seen.append(join(*a)) or seen[0])
    assert main_texts(pages).count() == pages.count()
    assert seen[0].select("page_id").distinct().count() == pages.select("page_id").distinct().count()


def test_articles_come_out_whole(spark, sf_dir):
    import html
    import re

    for r in main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet")).join(
        spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html"), "page_id"
    ).collect():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>?", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside))
        assert r["text"] == "\n".join(b for b in blocks if b)


# ------------------------------------------------------------- urls


def test_rules_and_reputation(spark):
    urls = {
        1: ("HTTP://A.Example.NET/en/x?q", "example.net/en/", "allow"),
        2: ("http://a.example.net/de/", "net/", "block"),
        3: ("http://example.com/de/1", "example.com/de/", "block"),
        4: ("http://notexample.com/de/1", None, "allow"),
        5: ("http://x.org/fr/", "org/fr/", "allow"),
        6: ("http://bad.org/1", None, "block"),
        7: (None, None, "allow"),
        8: ("no url", None, "allow"),
        9: ("http://x.net", None, "allow"),
    }
    rows = [(i, u) for i, (u, _, _) in urls.items()] + [(100 + i, f"http://bad.org/{i}") for i in range(200)]
    rows += [(400 + i, f"http://good{i % 9}.com/{i}") for i in range(400)]
    labels = [(100 + i, 1) for i in range(200)] + [(400 + i, 0) for i in range(400)] + [(None, 1), (400, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit(1), "rule": F.lit(2)})
    outcome = spark.createDataFrame(labels, "page_id long, outcome int")
    got = {r["page_id"]: r for r in judge_urls(pages, outcome, URL_RULES).collect()}
    assert {i: (got[i]["rule"], got[i]["verdict"]) for i in urls} == {i: v[1:] for i, v in urls.items()}
    assert (got[1]["host"], got[1]["path"]) == ("a.example.net", "/en/x") and got[7]["host"] == got[8]["path"] == ""
    assert judge_urls(pages.limit(0), outcome, URL_RULES).count() == 0
    assert {r["verdict"] for r in judge_urls(pages, outcome.limit(0), []).collect()} == {"allow"}


# ------------------------------------------------------------- mixing


def test_mix_meets_targets_with_caps(spark):
    rng = random.Random(1)
    rows = [(i, " w" * rng.randint(0, 9), rng.choice(["a", "b", None, "d"]) if i % 3 else "c") for i in range(300)]
    rows += [(300 + i, "x " * 2000, "z") for i in range(3)] + [(None, None, "a"), (500, "", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"size": F.lit(1), "first": F.lit(2)})
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    order = sorted(s for s in size if s is not None) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, still, left = {}, set(order), sum(size.values())
    while True:
        level = left / sum(weight[s] for s in still)
        over = [s for s in still if level * weight[s] > 3 * size[s]]
        for s in over:
            target[s] = 3 * size[s]
            left -= target[s]
            still.discard(s)
        if not over:
            break
    target.update({s: level * weight[s] for s in still})
    source = {i: s for i, _, s in rows}
    mixed = mix_sources(df)
    taken = dict.fromkeys(order, 0)
    for r in mixed.collect():
        assert r["target"] == pytest.approx(target[source[r["doc_id"]]]) and 0 <= r["taken"] <= 3 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[s] - target[s]) < 1 for s in order)
    times = readings(mixed).collect()
    assert sum(r["words"] for r in times) == sum(taken.values())
    assert all(0 <= r["position"] <= 1 for r in times)
    assert sorted(map(tuple, mix_sources(df).collect()), key=str) == sorted(map(tuple, mixed.collect()), key=str)


def test_mix_of_odd_rows(odd_documents, no_documents):
    assert ids(mix_sources(odd_documents)) == ALL_IDS
    assert mix_sources(no_documents).count() == 0


# ------------------------------------------------------------- pipeline


def test_each_stage_keeps_clean_rows(spark, texts, sf_dir):
    docs = texts
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.materialize(stage(spark, docs, sf_dir), name)
        assert kept.columns == texts.columns
        before, after = docs.count(), kept.count()
        assert 0.8 * before < after <= before
        docs = kept
    assert docs.select("text").distinct().count() == docs.count()
    assert find_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert set(texts.columns) < set(last.columns) and last.count() > 0


def test_keys_of_rows_from_files_need_no_copy_and_are_unique(spark, texts, sf_dir):
    many = corpus_pipeline.materialize(texts.repartition(7), "many")
    for docs in (texts, many):
        keyed = corpus_pipeline._keyed(docs, "rows")
        assert keyed.columns == [*docs.columns, corpus_pipeline.KEY]
        assert set(docs.inputFiles()) <= set(keyed.inputFiles())
        assert keyed.select(corpus_pipeline.KEY).distinct().count() == docs.count() == keyed.count()
        assert sorted(map(tuple, keyed.collect())) == sorted(map(tuple, keyed.collect()))
    path = f"{sf_dir}/documents.parquet"
    twice = spark.read.parquet(path, path)
    for docs in (twice, texts.unionByName(texts), texts.where("doc_id > 5")):
        keyed = corpus_pipeline._keyed(docs, "rows")
        assert not set(keyed.inputFiles()) & set(texts.inputFiles())
        assert keyed.select(corpus_pipeline.KEY).distinct().count() == docs.count()


def test_stages_take_odd_rows(spark, odd_documents, no_documents, sf_dir):
    for df in (odd_documents, no_documents):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, df, sf_dir).count() <= max(3 * df.count(), 0)


def test_stages_tell_rows_apart_whose_ids_are_null_or_repeated(spark, sf_dir):
    rng = random.Random(5)
    plain = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(30)]
    copies = [plain[0], plain[0], plain[1], plain[2]]
    near = [plain[i] + " more" for i in (3, 4, 4, 5)]
    toxic = ["you idiot " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))]
    held = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text").limit(2).collect()]
    texts = plain + copies + near + toxic + [f"before {t} after" for t in held]
    # a third null, a third with one id, the first of equal texts among them
    odd = [(None if i % 3 == 0 else 7 if i % 3 == 1 else 10**6 + i, t, "ab"[i % 2]) for i, t in enumerate(texts)]
    odd.append((7, plain[7], "a"))
    known = [(10**6 + i, t, s) for i, (_, t, s) in enumerate(odd)]
    odd, known = (spark.createDataFrame(rows, "doc_id long, text string, source string") for rows in (odd, known))

    def kept(stage, df):
        return sorted(r["text"] for r in stage(spark, df, sf_dir).select("text").collect())

    stages = dict(corpus_pipeline.STAGES)
    for name in ("toxicity", "exact_dedup", "decontamination"):
        assert kept(stages[name], odd) == kept(stages[name], known)
    assert kept(stages["exact_dedup"], odd) == sorted(set(texts))
    left = kept(stages["near_dedup"], odd)
    assert len(left) == len(kept(stages["near_dedup"], known)) == len({t.removesuffix(" more") for t in texts})
    assert {t.removesuffix(" more") for t in left} == {t.removesuffix(" more") for t in texts}
    mixed = stages["mixing"](spark, odd, sf_dir).collect()
    same = stages["mixing"](spark, known, sf_dir).collect()
    for source in "ab":
        assert sum(r["words"] for r in mixed if r["source"] == source) == sum(r["words"] for r in same if r["source"] == source)
    # no text is read more often than its rows are passed
    size = {t: len(t.split()) for t in texts}
    assert all(r["words"] <= size[r["text"]] and r["pass"] <= 3 for r in mixed)
    assert {r["doc_id"] for r in mixed} >= {None, 7}
