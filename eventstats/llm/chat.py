"""Reply trees as chat texts (operator 7), with DataFrame functions only.

A table of messages with parents is a forest. Iterative self-joins enumerate the path of every
leaf up to its root; each round doubles the distance that pointers reach, so a tree of depth d
takes about log2(d) rounds. The branches of a tree are ranked by score, and each chosen path is
formatted as one conversation with the spans of text that count in the loss.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventstats.llm.common import stored

#: The marks of a turn, and strings that chat models take as control strings.
TURN_OPEN = "<|im_start|>"
TURN_CLOSE = "<|im_end|>\n"
_ESCAPES = (
    (r"%(25|3C|5B|0A)", "%25"),
    (r"<(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|<SYS>>|</SYS>>)", "%3C"),
    (r"\[(INST\]|/INST\])", "%5B"),
)
_UNESCAPES = (("%3C", "<"), ("%5B", "["), ("%0A", "\n"), ("%25", "%"))


def escape(text: Column) -> Column:
    """Break every control string by percent-encoding its first character, reversibly."""
    return reduce(lambda c, rule: F.regexp_replace(c, rule[0], rule[1] + "$1"), _ESCAPES, text)


def unescape(text: Column) -> Column:
    return reduce(lambda c, rule: F.replace(c, F.lit(rule[0]), F.lit(rule[1])), _UNESCAPES, text)


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("%0A"))


def _key(tree: Column) -> Column:
    """The tree as text that joins like a value also when it is null."""
    return F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit("null"))


def leaf_paths(nodes: DataFrame) -> DataFrame:
    """``tree, leaf, node, back``: every node of every root-to-leaf path, counted from the leaf.

    ``nodes`` has ``tree, node, parent``; ``node`` is unique within its tree. A parent that is
    null or not in the tree makes a root. Messages on a circle have no root and no path.
    """
    nodes = nodes.select("tree", "node", "parent")
    ids = nodes.select("tree", F.col("node").alias("up"))
    links = nodes.filter("parent is not null").select("tree", "node", F.col("parent").alias("up"))
    links = stored(links.join(ids, ["tree", "up"], "left_semi").select("tree", "node", "up"), "links")
    inner = links.select("tree", F.col("up").alias("node")).distinct()
    leaves = nodes.select("tree", "node").join(inner, ["tree", "node"], "left_anti")
    paths = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("back"))
    size = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    reach, pointers = 1, links
    while reach < size and pointers.limit(1).count():
        higher = paths.join(pointers, ["tree", "node"]).select(
            "tree", "leaf", F.col("up").alias("node"), (F.col("back") + reach).alias("back")
        )
        paths = stored(paths.unionByName(higher), "paths")
        again = pointers.select("tree", F.col("node").alias("up"), F.col("up").alias("higher"))
        pointers = pointers.join(again, ["tree", "up"]).select("tree", "node", F.col("higher").alias("up"))
        pointers, reach = stored(pointers, "pointers"), 2 * reach
    roots = nodes.select("tree", "node").join(links, ["tree", "node"], "left_anti")
    rooted = paths.join(roots, ["tree", "node"], "left_semi").select("tree", "leaf")
    return paths.join(rooted, ["tree", "leaf"], "left_semi")


def format_trees(
    messages: DataFrame, branches: int = 1, loss_roles: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """One row per chosen path: ``tree, leaf, branch, score, formatted, loss_spans``.

    ``messages`` has ``tree, node, parent, role, text, score``; other columns are not read. A
    path scores the sum of its messages, null scores as 0; the ``branches`` best paths of each
    tree are kept, ties going to the smaller leaf. A turn is the open mark, the role, a newline,
    the text, and the close mark; control strings in roles and texts are escaped. Null roles and
    texts are empty. ``loss_spans`` are (start, length) in characters of ``formatted``, one for
    each text with a role in ``loss_roles``, also for empty ones. No message, no row.
    """
    keyed = messages.select(_key(F.col("tree")).alias("tree"), "node", "parent", F.col("tree").alias("_tree"),
                            F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text"),
                            F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    paths = leaf_paths(keyed)
    scored = paths.join(keyed.select("tree", "node", "score"), ["tree", "node"])
    ranked = (
        scored.groupBy("tree", "leaf")
        .agg(F.sum("score").alias("path_score"))
        .withColumn("branch", F.row_number().over(
            Window.partitionBy("tree").orderBy(F.desc("path_score"), "leaf")))
        .filter(F.col("branch") <= branches)
    )
    chosen = stored(paths.join(ranked, ["tree", "leaf"]), "chosen-paths")
    turns = chosen.join(keyed.drop("score", "parent"), ["tree", "node"])
    head = F.concat(F.lit(TURN_OPEN), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    turns = turns.select(
        "tree", "leaf", "branch", "path_score", "_tree", "back", F.col("role").isin(*loss_roles).alias("in_loss"),
        F.length(head).cast("long").alias("head_chars"), F.length(body).cast("long").alias("body_chars"),
        F.concat(head, body, F.lit(TURN_CLOSE)).alias("turn"),
    )
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("back"))
    turns = turns.withColumn(
        "start", F.sum(F.length("turn")).over(before) - F.length("turn") + F.col("head_chars"))
    packed = turns.groupBy("tree", "leaf").agg(
        F.first("_tree").alias("_tree"), F.first("branch").alias("branch"), F.first("path_score").alias("score"),
        F.array_sort(F.collect_list(F.struct("start", "body_chars", "in_loss", "turn"))).alias("t"),
    )
    spans = F.transform(F.filter("t", lambda x: x["in_loss"]),
                        lambda x: F.struct(x["start"].alias("start"), x["body_chars"].alias("length")))
    return packed.select(
        F.col("_tree").alias("tree"), "leaf", "branch", "score",
        F.array_join("t.turn", "").alias("formatted"), spans.alias("loss_spans"),
    )


def chain_messages(rows: DataFrame) -> DataFrame:
    """Rows ``conv_id, turn, role, text`` as trees in which each row answers the one before.

    Rows go by turn, then role and text, nulls first, so repeated turns have an order too.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("node"))
    return numbered.select(
        F.col("conv_id").alias("tree"), "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"),
    )


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, unescaped: array of (role, text)."""
    parts = F.split(formatted, TURN_CLOSE.replace("|", r"\|"), -1)
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        cut = F.locate("\n", part)
        role = F.substring(part, F.lit(len(TURN_OPEN) + 1), cut - F.lit(len(TURN_OPEN) + 1))
        return F.struct(unescape(role).alias("role"),
                        unescape(F.substring(part, cut + 1, F.length(part))).alias("text"))

    return F.transform(parts, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    texts = F.transform(spans, lambda s: unescape(
        F.substring(formatted, s["start"].cast("int") + 1, s["length"].cast("int"))))
    return F.array_join(texts, "")
