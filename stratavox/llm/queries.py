"""The queries over the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, fingerprints, licenses, lines, packing, quality, simhash, suffixes, toxicity
from .common import read


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffixes.drop_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    kept = lines.drop_common_lines(docs, least_docs=10, least_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), words=3, radius=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("f0")), 16, "0").alias("fingerprint"), "component_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(read(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.format_conversations(read(spark, sf_dir, "conversations"))
    return turns.select("*", F.length("rendered").cast("long").alias("n_chars"), F.sha2("rendered", 256).alias("rendered_sha256")).drop("rendered")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), threshold=0.7)


QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_best_fit_packing, op3_fingerprints, op4_suffix_dedup, op5_line_dedup, op6_simhash, op7_quality_rules, op8_license_scan, op9_chat_format, op10_toxicity)}

LINES_SQL = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nth FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, c.key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

QUALITY_SQL = r"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
win AS (
  SELECT doc_id, p, words[p] AS a, words[p + 1] AS b, words[p + 2] AS c
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS p FROM doc)),
again AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM win) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p + k) AS n FROM again, (SELECT unnest(range(0, 3)) AS k) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(words) AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words,
         len(lines) AS n_lines,
         len(regexp_extract_all(text, '\p{Lu}')) AS n_upper,
         len(regexp_extract_all(text, '[0-9]')) AS n_digits
  FROM doc d LEFT JOIN covered c ON d.doc_id = c.doc_id),
f AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
           + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
           + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
           + CASE WHEN 2 * n_upper > word_chars THEN 8 ELSE 0 END
           + CASE WHEN 2 * n_dup_lines > n_lines THEN 16 ELSE 0 END
           + CASE WHEN 2 * n_digits > word_chars THEN 32 ELSE 0 END
           + CASE WHEN word_chars > 20 * n_words THEN 64 ELSE 0 END)::BIGINT AS failed FROM m)
SELECT *, failed & 3 <> 0 AS base_failed, failed = 0 AS kept FROM f
"""

def _canonical_sql(text: str) -> str:
    out = f"regexp_replace(lower({text}), '(?m)^[^\\n\\p{{L}}]*(copyright\\b|\\(c\\)|©|all rights reserved)[^\\n]*$', '', 'g')"
    forms = [p for p in licenses.EQUIVALENT if "(?=" not in p[0]]
    for pattern, form in forms:
        out = f"regexp_replace({out}, '{pattern.replace(chr(39), chr(39) * 2)}', '{form}', 'g')"
    # RE2 has no look-ahead: a version number is matched with its first digits instead.
    out = f"regexp_replace({out}, '\\bversion ([0-9])', 'v\\1', 'g')"
    out = f"regexp_replace({out}, '\\bv([0-9]+)\\.0\\b', 'v\\1', 'g')"
    out = f"regexp_replace({out}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
    return f"regexp_replace({out}, ' *\\n[ \\n]*', chr(10), 'g')"


def _licenses_sql() -> str:
    known = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in licenses.KNOWN)
    return f"""
WITH given AS (SELECT * FROM (VALUES {known}) AS t(license, text)),
known AS (SELECT sha256(trim(replace(c, chr(10), ' '))) AS k, min(license) AS license FROM (SELECT license, {_canonical_sql("text")} AS c FROM given) GROUP BY 1),
doc AS (SELECT doc_id, {_canonical_sql("coalesce(text, '')")} AS c FROM documents),
whole AS (SELECT doc_id, sha256(trim(replace(c, chr(10), ' '))) AS digest FROM doc),
line AS (SELECT doc_id, unnest(string_split(c, chr(10))) AS line FROM doc),
found AS (SELECT doc_id, license FROM line JOIN known ON sha256(trim(line)) = k WHERE trim(line) <> '')
SELECT w.doc_id, w.digest, any_value(k.license) AS text_license,
       coalesce(string_agg(DISTINCT f.license, ',' ORDER BY f.license), '') AS line_licenses, count(f.license) AS n_license_lines
FROM whole w LEFT JOIN known k ON w.digest = k.k LEFT JOIN found f ON w.doc_id = f.doc_id GROUP BY w.doc_id, w.digest
"""


ORACLE_SQL: dict[str, str] = {"op5_line_dedup": LINES_SQL, "op7_quality_rules": QUALITY_SQL, "op8_license_scan": _licenses_sql()}
