"""All pages through WARC archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clinlake.llm import warc


def op2_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the record of every page says after the round trip."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = (op2_warc_normaliser,)

ORACLES = {
    "op2_warc_normaliser": """
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_page FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM firsts
"""
}
