"""The queries opN_<name> over the documents and pages tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgrid.llm import byte_bpe, exact_dedup, language_id, line_dedup, lm_scoring, merkle, packing, pii, simhash, url_filter
from loomgrid.llm.common import hash_remainder, table

#: Fixed rules of the URL query.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, RULES, url_filter.link_edges(pages))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn("held_out", hash_remainder(F.col("doc_id"), 5) == 0)
    models = language_id.fit_languages(documents.where("NOT held_out"))
    return language_id.identify_languages(documents, models, keep=["doc_id", "held_out"])


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edit_trial(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return pii.find_personal_data(documents, pii.fit_field(documents))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_url_filter, op2_exact_dedup, op3_lm_score, op4_packing, op5_simhash, op6_language_id, op7_line_dedup, op8_byte_bpe, op9_fingerprints, op10_pii)}


def _attribute(name: str) -> str:
    """The value of a tag's attribute, quoted or not; empty if it has none."""
    find = rf'''(?is)\b{name}\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))'''
    return " || ".join(f"coalesce(regexp_extract(tag, '{find}', {k}), '')" for k in (1, 2, 3))


def _host(url: str) -> str:
    rest = f"CASE WHEN strpos({url}, '://') > 0 THEN substr({url}, strpos({url}, '://') + 3) ELSE '' END"
    return f"translate(regexp_extract({rest}, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _part(url: str, pattern: str) -> str:
    return f"regexp_extract(CASE WHEN strpos({url}, '://') > 0 THEN substr({url}, strpos({url}, '://') + 3) ELSE '' END, '{pattern}', 1)"


def _without_dots(path: str) -> str:
    plain = f"regexp_extract({path}, '^[^?#]*')"
    done = f"""list_reduce(list_prepend(CAST([] AS VARCHAR[]), list_transform(string_split(substr({plain}, 2), '/'), lambda x: [x])),
      lambda a, b: CASE b[1] WHEN '..' THEN a[1:len(a) - 1] WHEN '.' THEN a ELSE list_concat(a, b) END)"""
    return f"""CASE WHEN regexp_matches({plain}, '^/(.*/)?\\.\\.?(/|$)') THEN '/' || array_to_string({done}, '/')
      || CASE WHEN regexp_matches({plain}, '/\\.\\.?$') AND len({done}) > 0 THEN '/' ELSE '' END || regexp_extract({path}, '(?s)^[^?#]*(.*)$', 1) ELSE {path} END"""


def _key(url: str) -> str:
    rest = _part(url, "^[^/?#]*([^#]*)")
    return f"{_host(url)} || " + _without_dots(f"(CASE WHEN starts_with({rest}, '/') THEN {rest} ELSE '/' || {rest} END)")


_PATH = "^[^/?#]*([^?#]*)"
URL_SQL = rf"""
WITH RECURSIVE tags AS (
  SELECT url, unnest(regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM pages WHERE url IS NOT NULL
), values_of AS (
  SELECT url, replace(trim(CASE
    WHEN starts_with(lower(tag), '<link') THEN CASE WHEN regexp_matches(lower({_attribute("rel")}), '(^|\s)canonical(\s|$)') THEN {_attribute("href")} END
    WHEN lower({_attribute("http-equiv")}) = 'refresh' THEN regexp_extract({_attribute("content")}, '(?is)^[^;,]*[;,]\s*url\s*=\s*[''"]?([^''"]*)', 1) END), '&amp;', '&') AS target,
    'http://' || {_host("url")} AS root, {_part("url", _PATH)} AS path FROM tags
), whole AS (
  SELECT url AS source, CASE WHEN regexp_matches(target, '^(?i)https?://') THEN target WHEN starts_with(target, '//') THEN 'http:' || target
    WHEN target = '' OR regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') OR starts_with(target, '#') THEN NULL
    WHEN starts_with(target, '/') THEN root || target
    ELSE root || CASE WHEN path LIKE '%/%' THEN regexp_extract(path, '(?s)^(.*/)', 1) ELSE '/' END || target END AS target FROM values_of
), links AS (
  SELECT source, regexp_extract(target, '^[^:]*://[^/?#]*') || {_without_dots("regexp_extract(target, '(?s)^[^:]*://[^/?#]*(.*)$', 1)")} AS target FROM whole
), edges AS (
  SELECT {_key("source")} AS a, {_key("target")} AS b FROM links WHERE target IS NOT NULL
), both_ways AS (
  SELECT a, b FROM edges UNION SELECT b, a FROM edges
), reach AS (
  SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a
), urls AS (
  SELECT page_id, url FROM pages UNION ALL SELECT NULL, source FROM links WHERE target IS NOT NULL UNION ALL SELECT NULL, target FROM links WHERE target IS NOT NULL
), named AS (
  SELECT row_number() OVER () AS place, page_id, {_host("url")} AS host, {_part("url", _PATH)} AS path, CASE WHEN {_host("url")} <> '' THEN {_key("url")} END AS key FROM urls
), rules(rule, rule_host, rule_path, decision) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
         ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), fitting AS (
  SELECT place, rule, decision, row_number() OVER (PARTITION BY place ORDER BY length(rule) DESC, decision, rule) AS k
  FROM named JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
), judged AS (
  SELECT n.*, rule, decision FROM named n LEFT JOIN fitting f ON n.place = f.place AND k = 1
), votes AS (
  SELECT r.a AS key, min(decision) AS verdict FROM reach r JOIN judged j ON j.key = r.b WHERE decision IS NOT NULL GROUP BY 1
)
SELECT page_id, host, path, rule, coalesce(decision, verdict, 'allow') AS verdict, decision IS NULL AND verdict IS NOT NULL AS propagated
FROM judged j LEFT JOIN votes v ON v.key = j.key WHERE page_id IS NOT NULL
"""

DEDUP_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM texts
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": URL_SQL, "op2_exact_dedup": DEDUP_SQL}
