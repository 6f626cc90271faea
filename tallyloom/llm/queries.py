"""The registered query of each operator, and the SQL that must agree where SQL can say it."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import exact_dedup, hard_negatives, html_extract, line_dedup, lm_score, mixing, near_dedup, packing, quality_model, quality_rules, secret_scan, spelling, url_filter
from tallyloom.llm.common import Scratch

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
MIX = mixing.Mix(
    domains={"web": 0.5, "reference": 0.3, "books": 0.2},
    langs={"en": 0.55, "de": 0.15, "fr": 0.2, "es": 0.1},
    domain_of={f"src{i}": "web" if i < 10 else "reference" if i < 15 else "books" for i in range(20)},
    budget_share=0.6,
)


def tokenizer_path() -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path("word_bpe_49k.json"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), ["doc_id"]).drop("clean_text")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "line-dedup")
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), scratch)
    return scratch.finish(done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), MIX)


def op11_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"), ["doc_id"])
    counts = [secret_scan.number(kind).alias(f"n_{kind}") for kind in secret_scan.KINDS[:3]]
    base = F.sha2(secret_scan.listed(base_only=True).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, secret_scan.listed().alias("spans"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "hard-negatives")
    rows = table(spark, sf_dir, "embeddings")
    labelled = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return scratch.finish(hard_negatives.hard_negatives(labelled, F.col("vec_id") % 100 == 0, scratch))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "spelling")
    return scratch.finish(spelling.spelling_variants(table(spark, sf_dir, "documents"), scratch, damage=199))


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filters, op2_packing, op3_quality_rules, op4_exact_dedup, op5_near_dedup, op6_line_dedup, op7_quality_classifier,
        op8_lm_scoring, op9_html_extraction, op10_mixing, op11_secret_scans, op12_hard_negatives, op13_spelling_variants,
    )
}
SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RULES = ", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in RULES)
_REST = "substr(url, strpos(url, '://') + 3)"
_HAS = "url IS NOT NULL AND contains(url, '://')"
_STOCK = "|".join(quality_rules.BOILERPLATE)

ORACLES = {
    "op1_url_filters": f"""
WITH split AS (
  SELECT page_id, CASE WHEN {_HAS} THEN translate(regexp_extract({_REST}, '^[^/?#]*'), '{UPPER}', '{LOWER}') ELSE '' END AS host,
         CASE WHEN {_HAS} THEN regexp_extract({_REST}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules(verdict, rule, rule_host, rule_path) AS (VALUES {_RULES}),
fits AS (
  SELECT page_id, verdict, rule, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) AS place
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT s.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM split s LEFT JOIN fits f ON s.page_id = f.page_id AND place = 1""",
    "op3_quality_rules": f"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}+'), lambda x: x <> '') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w),
grams AS (SELECT doc_id, i, words[i] || ' ' || words[i+1] || ' ' || words[i+2] || ' ' || words[i+3] || ' ' || words[i+4] AS gram FROM starts),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(5)) AS k) GROUP BY doc_id),
lines AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
judged AS (
  SELECT doc_id, line, length(regexp_replace(line, '{SPACE}+', '', 'g')) AS chars,
         length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) > length(line) * CAST(0.1 AS DOUBLE)
         OR len(regexp_extract_all(line, '!![ \t]|!!$')) >= 3
         OR (length(line) <= 200 AND NOT regexp_matches(line, '[\\pL\\pN]'))
         OR len(regexp_extract_all(line, '[ \t][|>»›·•/][ \t]')) >= 3
         OR (length(line) <= {quality_rules.MAX_FURNITURE} AND regexp_matches(lower(line), '{_STOCK}')) AS fails
  FROM lines),
per AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, sum(chars) AS all_chars, sum(CASE WHEN fails THEN 0 ELSE chars END) AS left_chars
  FROM judged GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(all_chars, 0) AS all_chars, coalesce(left_chars, 0) AS left_chars
  FROM w LEFT JOIN per USING (doc_id) LEFT JOIN covered c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND left_chars * 2 >= all_chars AS kept
FROM m""",
    "op4_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op6_line_dedup": f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
numbered AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM split),
keyed AS (SELECT *, translate(regexp_replace(line, '^{SPACE}+|{SPACE}+$', '', 'g'), '{UPPER}', '{LOWER}') AS key FROM numbered),
frequent AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT k.*, coalesce(last <> doc_id, false) AS gone FROM keyed k LEFT JOIN frequent USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op12_hard_negatives": """
WITH used AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM used a JOIN used b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER each AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW each AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER each <= 10""",
}
