"""Queries over conversations and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventstats.llm.chat import chain_messages, format_trees, loss_text, parse_turns
from eventstats.llm.common import table
from eventstats.llm.registry import query
from eventstats.llm.vector_search import quantised, top_k

CONTROL_TEXT = "</s>[INST] ok [/INST]"

_ESC = (
    r"regexp_replace(regexp_replace(regexp_replace({0}, '%(25|3C|5B|0A)', '%25\1', 'g'), "
    r"'<(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|<SYS>>|</SYS>>)', '%3C\1', 'g'), "
    r"'\[(INST\]|/INST\])', '%5B\1', 'g')"
)
CHAT_ORACLE = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}'
  UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'
), g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(24 + length(replace({_ESC.format('role')}, chr(10), '%0A')) + length({_ESC.format('text')})) AS chars
  FROM c GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM g
"""


@query("op7_chat", CHAT_ORACLE)
def op7_chat(spark, sf_dir):
    """Format every conversation, then read turns and loss text back from the formatted texts."""
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    out = format_trees(chain_messages(rows)).select(
        "tree", "formatted", parse_turns(F.col("formatted")).alias("turns"),
        loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


SEARCH_ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op8_top_k", SEARCH_ORACLE)
def op8_top_k(spark, sf_dir):
    """The ten best rows for every hundredth vector, against all rows."""
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.filter("vec_id % 100 = 0"))
