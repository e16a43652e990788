"""Quality rules over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm import quality


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return quality.judged(docs).select(
        F.col("_doc.doc_id").alias("doc_id"),
        *["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "words_left", "kept"],
    )


QUERIES = (op7_quality_rules,)

ORACLES = {
    "op7_quality_rules": r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS text, text AS content,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 6)) AS pos, words FROM docs WHERE len(words) >= 8
), keyed AS (
  SELECT doc_id, pos, array_to_string(words[pos:pos + 7], ' ') AS win FROM windows
), twice AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, win) AS n FROM keyed) WHERE n >= 2
), repeats AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - pos, 8)))::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, pos, lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, source, content, n_words, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')) AS line
  FROM (SELECT doc_id, source, content, len(words) AS n_words, unnest(string_split(lower(text), chr(10))) AS line FROM docs)
), hashed AS (
  SELECT *, ('0x' || substr(md5(line), 1, 15))::BIGINT AS hash, len(string_split(line, ' ')) AS line_words FROM lines WHERE line <> ''
), hosts AS (
  SELECT source, count(DISTINCT content) AS hosted FROM docs GROUP BY source
), often AS (
  SELECT source, line, hosted FROM (SELECT source, line, count(DISTINCT content) AS n FROM hashed GROUP BY source, line) JOIN hosts USING (source)
  WHERE n >= 10 AND (n > 0.02 * hosted OR n >= 100)
), found AS (
  SELECT * FROM hashed JOIN often USING (source, line)
), bodies AS (
  SELECT doc_id, CASE WHEN any_value(n_words) - sum(line_words) < 0.3 * any_value(n_words) THEN 'hash ' || min(hash) ELSE 'text ' || any_value(content) END AS body
  FROM found GROUP BY doc_id
), removed AS (
  SELECT source, line FROM (SELECT source, line, hosted, count(DISTINCT body) AS n FROM found JOIN bodies USING (doc_id) GROUP BY source, line, hosted)
  WHERE n >= 10 AND (n > 0.02 * hosted OR n >= 100)
), gone AS (
  SELECT doc_id, sum(line_words)::BIGINT AS words_gone FROM found JOIN removed USING (source, line) GROUP BY doc_id
), measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (SELECT count(*) - count(DISTINCT l) FROM unnest(string_split(text, chr(10))) AS t(l)
      WHERE regexp_matches(l, '[^\x20\x09-\x0D]'))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, len(words) - coalesce(words_gone, 0) AS words_left
  FROM docs LEFT JOIN repeats USING (doc_id) LEFT JOIN gone USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured
)
SELECT *, NOT base_failed AND words_left >= 0.3 * n_words AS kept FROM judged
"""
}
