"""The registered queries of this package: name to query, and name to SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm.bpe_codec import decode_ids, encode_texts
from riskflow.llm.curriculum import mix_sources
from riskflow.llm.decontaminate import find_passages
from riskflow.llm.exact_dedup import exact_duplicates, split_deliveries
from riskflow.llm.hard_negatives import mine_hard_negatives
from riskflow.llm.host_reputation import judge_urls
from riskflow.llm.html_text import main_texts
from riskflow.llm.lexical_search import rank_documents
from riskflow.llm.near_dedup import near_duplicates
from riskflow.llm.ngram_trie import score_texts
from riskflow.llm.quality import judge_quality
from riskflow.llm.token_counts import count_tokens
from riskflow.llm.toxicity import score_toxicity

Query = Callable[[SparkSession, str], DataFrame]

#: (host, path, verdict), as the task gives them.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """The place of a public tokenizer's file; the package is installed on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled as good are the trusted text."""
    trusted = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return judge_quality(_table(spark, sf_dir, "documents"), trusted)


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=2)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(_table(spark, sf_dir, "pages"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), tokenizer_file())


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(*split_deliveries(_table(spark, sf_dir, "documents")))


OP6_SQL = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY text_sha256)
SELECT n.doc_id, g.keep_id, g.group_size, coalesce(n.doc_id = g.keep_id, false) AS kept, n.text_sha256
FROM n JOIN g ON n.text_sha256 = g.text_sha256
"""


def op7_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled page is bad if its label's quality is 0."""
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("outcome"))
    return judge_urls(_table(spark, sf_dir, "pages"), labels, URL_RULES)


OP7_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), '') AS raw,
         coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages
), u AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM p
), l AS (
  SELECT doc_id, max(1 - quality) AS outcome FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), h AS (
  SELECT host, count(outcome) AS n, coalesce(sum(outcome), 0) AS bad, split_part(host, '.', -1) AS suffix,
         CASE WHEN contains(host, '.') THEN split_part(host, '.', -2) || '.' || split_part(host, '.', -1) ELSE host END AS domain
  FROM u LEFT JOIN l ON u.page_id = l.doc_id GROUP BY host
), w AS (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1.0)::DOUBLE AS p FROM h),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT p FROM w) AS p FROM h GROUP BY suffix),
sk AS (SELECT 1 / least(greatest(coalesce((sum(power(bad - n * p, 2) / (p * (1 - p))) - sum(n)) / nullif(sum(n * (n - 1)), 0), 0.5), 0.0001), 0.5) - 1 AS k FROM s),
sp AS (SELECT suffix, m AS p, m * (1 - m) / (t + 1) AS v FROM (SELECT suffix, (p * k + bad) / (n + k) AS m, n + k AS t FROM s, sk)),
d AS (SELECT h.domain, h.suffix, sum(n) AS n, sum(bad) AS bad, any_value(sp.p) AS p, any_value(sp.v) AS v FROM h JOIN sp ON h.suffix = sp.suffix GROUP BY h.suffix, h.domain),
dk AS (SELECT 1 / least(greatest(coalesce((sum(power(bad - n * p, 2) / (p * (1 - p))) - sum(n)) / nullif(sum(n * (n - 1)), 0), 0.5), 0.0001), 0.5) - 1 AS k FROM d),
dp AS (SELECT domain, m AS p, m * (1 - m) / (t + 1) + (k / t) * (k / t) * v AS v FROM (SELECT domain, (p * k + bad) / (n + k) AS m, n + k AS t, k, v FROM d, dk)),
hp AS (SELECT h.host, h.n, h.bad, dp.p, dp.v FROM h JOIN dp ON h.domain = dp.domain),
hk AS (SELECT 1 / least(greatest(coalesce((sum(power(bad - n * p, 2) / (p * (1 - p))) - sum(n)) / nullif(sum(n * (n - 1)), 0), 0.5), 0.0001), 0.5) - 1 AS k FROM hp),
b AS (SELECT host, m - 1.645 * sqrt(m * (1 - m) / (t + 1) + (k / t) * (k / t) * v) AS bound FROM (SELECT host, (p * k + bad) / (n + k) AS m, n + k AS t, k, v FROM hp, hk)),
r AS (SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) AS r(rule_host, rule_path, verdict)),
j AS (
  SELECT u.*, b.bound,
         (SELECT arg_max(r.rule_host || r.rule_path || ' ' || r.verdict, length(r.rule_host || r.rule_path)) FROM r
          WHERE ('.' || u.host) LIKE ('%.' || r.rule_host) AND starts_with(u.path, r.rule_path)) AS hit
  FROM u JOIN b ON u.host = b.host
)
SELECT page_id, host, path, split_part(hit, ' ', 1) AS rule,
       coalesce(split_part(hit, ' ', 2), CASE WHEN bound > 0.25 THEN 'block' ELSE 'allow' END) AS verdict
FROM j
"""


def op8_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In training order: by the position of a document's first reading, then those that are never read."""
    mixed = mix_sources(_table(spark, sf_dir, "documents"))
    placed = mixed.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"))
    return placed.orderBy(F.asc_nulls_last("position"), "doc_id")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS turn,
         coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM d GROUP BY source
), w AS (SELECT *, ((rank - 1) % 3 + 1)::BIGINT AS weight, (SELECT sum(size) FROM d)::BIGINT AS total FROM s),
t AS (
  SELECT *, (total - 3 * coalesce(sum(source_size) OVER (ORDER BY source_size * 3 / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(weight) OVER (ORDER BY source_size * 3 / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level
  FROM w
), l AS (SELECT level FROM t WHERE NOT (3 * source_size < level * weight) ORDER BY source_size * 3 / weight, rank LIMIT 1),
g AS (
  SELECT source, source_size, ((rank - 1) % 3 - 1) * 0.5::DOUBLE AS slope,
         coalesce(least(source_size * 3.0::DOUBLE, (SELECT level FROM l) * weight), 0.0::DOUBLE) AS target FROM t
), p AS (
  SELECT d.*, g.source_size, g.slope, g.target, floor(g.target + 0.5)::BIGINT AS wanted,
         (coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY turn, doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS first
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
), q AS (SELECT *, CASE WHEN source_size > 0 THEN wanted // source_size ELSE 0 END AS passes FROM p),
r AS (SELECT *, (passes * size + greatest(0, least(size, wanted - passes * source_size - first)))::BIGINT AS taken FROM q)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken > 0 THEN round(CASE WHEN slope = 0 THEN first / target
            ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * (first / target)) - (1 - slope)) / (2 * slope) END, 9) END AS position
FROM r
"""


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, with the items and where they begin."""
    return find_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the documents whose crc32(doc_id) mod 7 is not 2, scores all."""
    documents = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))
    scored = score_texts(documents, documents.where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh vector are moved on by one; every hundredth vector is an anchor."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return mine_hard_negatives(rows, F.col("vec_id") % 100 == 0)


OP11_SQL = r"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), a AS (SELECT * FROM e WHERE vec_id % 100 = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, e.vec_id, e.label, list_dot_product(a.v, e.v)::BIGINT AS score
  FROM a, e WHERE a.vec_id <> e.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INT AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND s.label <> s.anchor_label
  WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents of each benchmark item."""
    return rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row_key, doc_id, text FROM documents),
t AS (SELECT row_key, doc_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
p AS (SELECT row_key, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM t GROUP BY row_key, term),
l AS (SELECT row_key, sum(tf)::BIGINT AS n FROM p GROUP BY row_key),
c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM l),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY term),
b AS (SELECT row_number() OVER () AS item, item_id, text FROM benchmark),
i AS (SELECT item, item_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM b),
q AS (SELECT item, any_value(item_id) AS item_id, term, count(*) AS times FROM i GROUP BY item, term),
s AS (
  SELECT q.item, any_value(q.item_id) AS item_id, p.row_key, any_value(p.doc_id) AS doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // words)))))::BIGINT AS score
  FROM q JOIN p ON q.term = p.term JOIN w ON p.term = w.term JOIN l ON p.row_key = l.row_key, c GROUP BY q.item, p.row_key
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank FROM s WHERE score > 0
) WHERE rank <= 20
"""


def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every text and of what they decode to."""
    file = tokenizer_file("word_bpe_49k.json")
    coded = decode_ids(encode_texts(_table(spark, sf_dir, "documents"), file), file)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_html_extraction": op4_html_extraction,
    "op5_token_counts": op5_token_counts,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_url_reputation": op7_url_reputation,
    "op8_curriculum_mix": op8_curriculum_mix,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_lexical_search": op12_lexical_search,
    "op13_bpe_round_trip": op13_bpe_round_trip,
}

SQL: dict[str, str] = {
    "op6_exact_dedup": OP6_SQL,
    "op7_url_reputation": OP7_SQL,
    "op8_curriculum_mix": OP8_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_lexical_search": OP12_SQL,
}
