"""Queries over archives and exact copies."""

from __future__ import annotations

from eventstats.llm.common import table
from eventstats.llm.exact_dedup import BATCHES, DigestIndex, exact_dedup
from eventstats.llm.registry import query
from eventstats.llm.warc import read_archives, resolve_revisits, write_archives

WARC_ORACLE = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), f AS (
  SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first_id FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM f
"""


@query("op1_warc", WARC_ORACLE)
def op1_warc(spark, sf_dir):
    """Write every page to archives, read them all back, and say what each record holds."""
    index = write_archives(table(spark, sf_dir, "pages"))
    records = resolve_revisits(read_archives(index))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


DEDUP_ORACLE = r"""
WITH d AS (
  SELECT doc_id,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


@query("op10_exact_dedup", DEDUP_ORACLE)
def op10_exact_dedup(spark, sf_dir):
    """All documents through a new index, in ranges of ascending ids: who stays, in which group."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = table(spark, sf_dir, "documents")
    return exact_dedup(docs, DigestIndex(spark, buckets=buckets), batches=BATCHES)
