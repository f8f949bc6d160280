"""The query over near duplicates."""

from __future__ import annotations

from eventstats.llm.common import table
from eventstats.llm.ngram_join import near_duplicates
from eventstats.llm.registry import query

NEAR_ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [list_aggregate(words, 'string_agg', ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: list_aggregate(words[i:i + 4], 'string_agg', ' '))) END AS grams
  FROM w
), e AS (SELECT doc_id, len(grams) AS n, md5_number(unnest(grams)) AS gram FROM s),
g AS (SELECT gram FROM e GROUP BY gram HAVING count(*) > 1),
f AS (SELECT e.* FROM e SEMI JOIN g USING (gram)),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM f AS a JOIN f AS b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.grams) AS BIGINT) AS n_shingles, c.component_id FROM s JOIN c ON s.doc_id = c.a
"""


@query("op5_ngram_join", NEAR_ORACLE)
def op5_ngram_join(spark, sf_dir):
    """The component of near copies of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")
