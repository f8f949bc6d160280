"""Queries over repeats inside and across documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventstats.llm.common import crc32_sql, table
from eventstats.llm.periodic_runs import detect_runs
from eventstats.llm.registry import query
from eventstats.llm.substring_dedup import remove_repeated_windows

WINDOWS_ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT doc_id, unnest(range(0, len(words) - 19)) AS start, words FROM d WHERE len(words) >= 20
), w AS (
  SELECT doc_id, start, md5_number(list_aggregate(words[start + 1:start + 20], 'string_agg', ' ')) AS gram FROM s
), later AS (
  SELECT doc_id, start FROM w QUALIFY row_number() OVER (PARTITION BY gram ORDER BY doc_id, start) > 1
), gone AS (
  SELECT doc_id, list(DISTINCT place) AS places
  FROM (SELECT doc_id, unnest(range(start, start + 20)) AS place FROM later) GROUP BY doc_id
), marked AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(0, len(words))) AS place FROM d
), kept AS (
  SELECT m.doc_id, string_agg(word, ' ' ORDER BY m.place) AS kept
  FROM marked AS m ANTI JOIN (SELECT doc_id, unnest(places) AS place FROM gone) AS g
    ON m.doc_id = g.doc_id AND m.place = g.place
  GROUP BY m.doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(len(g.places), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN gone AS g ON d.doc_id = g.doc_id LEFT JOIN kept AS k ON d.doc_id = k.doc_id
"""


@query("op13_substring_dedup", WINDOWS_ORACLE)
def op13_substring_dedup(spark, sf_dir):
    """Every document without the windows of twenty words that occur earlier."""
    found = remove_repeated_windows(table(spark, sf_dir, "documents"))
    size = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", size.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


RUNS_ORACLE = rf"""
WITH t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    {crc32_sql("CAST(doc_id AS VARCHAR)")} AS h
  FROM documents
), p AS (
  SELECT doc_id, words, len(words) AS n, CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a, h // 10 AS g
  FROM t
), q AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM p
), d AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN words
    ELSE list_transform(range(0, n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS words
  FROM q
), g AS (
  SELECT doc_id, unnest(range(0, n - 4)) AS i, words FROM d WHERE n >= 5
), g5 AS (
  SELECT doc_id, i, md5_number(list_aggregate(words[i + 1:i + 5], 'string_agg', ' ')) AS gram FROM g
), f AS (
  SELECT * FROM g5 SEMI JOIN (SELECT doc_id, gram FROM g5 GROUP BY doc_id, gram HAVING count(*) > 1) AS r USING (doc_id, gram)
), pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM f AS x JOIN f AS y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i
), islands AS (
  SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length FROM (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs
  ) GROUP BY doc_id, q, island HAVING count(*) + 4 >= 3 * q
), runs AS (
  SELECT * FROM islands AS x WHERE NOT EXISTS (
    SELECT 1 FROM islands AS y WHERE y.doc_id = x.doc_id AND y.q < x.q
      AND y.start <= x.start AND y.start + y.length >= x.start + x.length)
), best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, q) = 1
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS text
  FROM runs GROUP BY doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS place FROM runs
), marked AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(0, n)) AS place FROM d
), kept AS (
  SELECT m.doc_id, string_agg(word, ' ' ORDER BY m.place) AS kept FROM marked AS m ANTI JOIN gone AS g
    ON m.doc_id = g.doc_id AND m.place = g.place GROUP BY m.doc_id
)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, b.length, b.q AS period,
  1000 * b.length // b.q AS exponent_milli, sha256(coalesce(l.text, '')) AS runs_sha256,
  sha256(coalesce(k.kept, '')) AS collapsed_sha256
FROM d LEFT JOIN best AS b ON d.doc_id = b.doc_id LEFT JOIN listed AS l ON d.doc_id = l.doc_id
  LEFT JOIN kept AS k ON d.doc_id = k.doc_id
"""


@query("op11_periodic_runs", RUNS_ORACLE)
def op11_periodic_runs(spark, sf_dir):
    """The periodic runs of every document, a tenth of them with planted repeats."""
    found = detect_runs(table(spark, sf_dir, "documents"), plant=True)
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"], r["period"])))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.select("doc_id", "runs", "collapsed", best.alias("best"), lines.alias("lines")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best")["start"].alias("start"),
        (-F.col("best")["n"]).alias("length"),
        F.col("best")["period"].alias("period"),
        F.expr("(-best.n * 1000) div best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
