"""The query over damaged conversations."""

from __future__ import annotations

from eventstats.llm.common import crc32_sql, table
from eventstats.llm.conversation_repair import damage, repair_conversations
from eventstats.llm.registry import query

_KEY = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
REPAIR_ORACLE = rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql(_KEY)} % 20 AS f FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN f = 1 THEN '' WHEN f = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(0, CASE WHEN f = 0 THEN 0 WHEN f = 3 THEN 2 ELSE 1 END)) AS copy
  FROM raw
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
    right(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'), 1) AS ending, left(role, 1) AS initial
  FROM damaged
), faults AS (
  SELECT *, CASE WHEN ending = '' THEN 'b' WHEN seen > 1 THEN 'd' WHEN ending NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS previous
  FROM numbered
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (previous IS NOT NULL AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
), inserts(st, letters, into_st, added) AS (
  VALUES (0, '', 0, []), (1, '', 1, []), (2, '', 2, []), (3, '', 3, []), (0, 'I', 2, ['user:']), (1, 'I', 2, ['user:']),
    (3, 'I', 2, ['user:']), (2, 'I', 3, ['assistant:']), (0, 'II', 3, ['user:', 'assistant:']),
    (1, 'II', 3, ['user:', 'assistant:']), (3, 'II', 3, ['user:', 'assistant:']), (2, 'II', 2, ['assistant:', 'user:'])
), edits(st, letter, initial, into_st, target) AS (
  VALUES (0, 'D', NULL, 0, NULL), (1, 'D', NULL, 1, NULL), (2, 'D', NULL, 2, NULL), (3, 'D', NULL, 3, NULL),
    (0, 'K', 's', 1, NULL), (0, 'K', 'u', 2, NULL), (1, 'K', 'u', 2, NULL), (2, 'K', 'a', 3, NULL), (3, 'K', 'u', 2, NULL),
    (0, 'R', NULL, 2, 'user'), (1, 'R', NULL, 2, 'user'), (2, 'R', NULL, 3, 'assistant'), (3, 'R', NULL, 2, 'user')
), paths AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS st, 0 AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS fixed FROM conversations
  UNION ALL
  SELECT * FROM (
    SELECT p.conv_id, f.pos, e.into_st AS st,
      p.cost + 5 * length(i.letters) + CASE e.letter WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
        + CASE WHEN e.letter <> 'D' AND f.fault = 't' THEN 5 ELSE 0 END AS cost,
      p.audit || i.letters || e.letter AS audit,
      list_concat(p.fixed, i.added, CASE e.letter WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text] ELSE [e.target || ':' || f.text] END) AS fixed
    FROM paths AS p JOIN faults AS f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.pos = p.pos + 1
      JOIN inserts AS i ON i.st = p.st
      JOIN edits AS e ON e.st = i.into_st AND (e.initial IS NULL OR e.initial = f.initial) AND (e.letter = 'D' OR f.fault NOT IN ('b', 'd'))
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, pos, st ORDER BY cost, audit) = 1
), ends AS (
  SELECT * FROM (
  SELECT p.conv_id, p.cost + 5 * length(i.letters) AS cost, p.audit || i.letters AS audit, list_concat(p.fixed, i.added) AS fixed
  FROM paths AS p JOIN inserts AS i ON i.st = p.st AND i.into_st IN (0, 3)
  WHERE p.pos = (SELECT count(*) FROM faults AS f WHERE f.conv_id IS NOT DISTINCT FROM p.conv_id)
  ) QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1
)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(e.cost AS BIGINT) AS cost, e.audit,
  sha256(coalesce(list_aggregate(e.fixed, 'string_agg', chr(10)), '')) AS repaired_sha256
FROM ends AS e LEFT JOIN counts AS c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query("op12_conversation_repair", REPAIR_ORACLE)
def op12_conversation_repair(spark, sf_dir):
    """Damage all conversations, then find their faults and the cheapest repair."""
    rows = damage(table(spark, sf_dir, "conversations"))
    return repair_conversations(rows, present="present").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
