"""Mixing sources to target weights by balanced sampling with the cube method (operator 2).

Every document of a source is taken target / size times on average: the whole part always, the
rest as an inclusion probability. The flight phase moves the probabilities of three documents at a
time along the null space of the two constraints, number of documents and number of words, until
one of the three is in or out; it keeps both totals. Documents that are long for their source are
drawn first, and the chance of the others makes up the difference in words. Flight runs in blocks
of a source; the two or fewer undecided documents of each block meet again in the next round. As
soon as a source is one block, together with short documents kept back for it, its last documents
land where the total of words is nearest to the target.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventstats.llm.common import WORDS, stored, text_or_empty

#: Documents that one task balances at a time.
BLOCK = 4096
#: No source gives more than so many times its size.
MAX_REPEATS = 3
#: A document is long if it has more words than so many average ones and than a block's share.
LONG = 4
_EPS = 1e-9


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORDS)).cast("long")


def source_targets(rows: DataFrame, repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, documents, target`` from ``source, size``.

    Sources by code point, null last, weigh 1, 2, 3, repeating, and share the sum of all sizes.
    Targets stop at ``repeats`` times the size of their source; what is above goes to the others
    by weight. With the sources in the order of limit / weight, those up to some place are at
    their limit and the rest share one level. The windows see one row per source.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = sums.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1)
    limit = (F.col("source_size") * repeats).cast("double")
    weighted = weighted.withColumn("cap", limit).withColumn("ratio", limit / F.col("weight"))
    ordered = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    onwards = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onwards)
    leveled = weighted.withColumn("level", level).withColumn("place", F.row_number().over(ordered))
    open_ = F.when(F.col("cap") > F.col("weight") * F.col("level"), F.struct("place", "level"))
    shared = F.min(open_).over(every)
    target = F.when(shared.isNull() | (F.col("place") < shared["place"]), F.col("cap")).otherwise(
        F.col("weight") * shared["level"])
    return leveled.select("source", "source_size", "documents", target.alias("target"))


def flight(sizes: list[int], chances: list[float], seed: str) -> list[float]:
    """Move chances to 0 or 1 in threes; at most two stay between. Both totals are kept.

    A document much longer than the others hardly moves and stays; see ``draw_long``.
    """
    chances = list(chances)
    waiting: list[int] = []
    for unit in range(len(sizes)):
        waiting.append(unit)
        if len(waiting) < 3:
            continue
        a, b, c = waiting
        step = (sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b])
        if not any(step):
            step = (1, -1, 0)
        up = down = float("inf")
        for unit_, move in zip(waiting, step):
            if move:
                more, less = (1 - chances[unit_]) / abs(move), chances[unit_] / abs(move)
                up, down = min(up, more if move > 0 else less), min(down, less if move > 0 else more)
        draw = zlib.crc32(f"{seed}:{unit}".encode()) / 2**32
        by = up if draw * (up + down) < down else -down
        for unit_, move in zip(waiting, step):
            chances[unit_] += by * move
            if chances[unit_] < _EPS or chances[unit_] > 1 - _EPS:
                chances[unit_] = float(round(chances[unit_]))
        waiting = [u for u in waiting if 0 < chances[u] < 1]
        if len(waiting) == 3:  # rounding left the nearest one just inside
            last = min(waiting, key=lambda u: min(chances[u], 1 - chances[u]))
            chances[last] = float(round(chances[last]))
            waiting.remove(last)
    return chances


def draw_long(sizes: list[int], chances: list[float], short: int, rate: float, seed: str) -> list[float]:
    """Decide all long documents of a source, of whose other words, ``short``, it takes the ``rate``.

    Flight leaves two at most, which move against each other; the last one is drawn if the others
    can make up for either outcome, else it goes where they come nearest to it.
    """
    chances = flight(sizes, chances, seed)
    rest = [i for i, p in enumerate(chances) if 0 < p < 1]
    draw = zlib.crc32(f"{seed}:long".encode()) / 2**32
    if len(rest) == 2:
        a, b = rest
        up = min((1 - chances[a]) * sizes[a], chances[b] * sizes[b])
        down = min(chances[a] * sizes[a], (1 - chances[b]) * sizes[b])
        by = up if draw * (up + down) < down else -down
        chances[a] += by / sizes[a]
        chances[b] -= by / sizes[b]
        draw = zlib.crc32(f"{seed}:last".encode()) / 2**32
    for i in rest:
        if chances[i] < _EPS or chances[i] > 1 - _EPS:
            chances[i] = float(round(chances[i]))
            continue
        more, less = (1 - chances[i]) * sizes[i], chances[i] * sizes[i]
        lacks = max(0.0, more - rate * short), max(0.0, less - (1 - rate) * short)
        taken = draw < chances[i] if lacks[0] == lacks[1] else lacks[0] < lacks[1]
        rate = min(1.0, max(0.0, rate - (more if taken else -less) / short)) if short else rate
        chances[i] = float(taken)
    return chances


def land(sizes: list[int], wanted: list[float], chances: list[float]) -> list[float]:
    """Decide the last undecided ones so that the words taken are nearest to the expected.

    Where these are long documents, others of the block change sides, longest first, as long as
    that brings the total nearer to the ``wanted`` one.
    """
    rest = [i for i, p in enumerate(chances) if 0 < p < 1]
    words = sum(sizes[i] * chances[i] for i in rest)
    count = sum(chances[i] for i in rest)

    def error(choice: int) -> tuple[float, float]:
        taken = [i for j, i in enumerate(rest) if choice >> j & 1]
        return abs(sum(sizes[i] for i in taken) - words), abs(len(taken) - count)

    best = min(range(1 << len(rest)), key=error)
    chances = list(chances)
    for j, i in enumerate(rest):
        chances[i] = float(best >> j & 1)
    over = sum(n * (p - w) for n, p, w in zip(sizes, chances, wanted))
    for i in sorted(set(range(len(sizes))) - set(rest), key=lambda i: (-sizes[i], i)):
        if chances[i] == (over > 0) and 0 < sizes[i] < abs(over):
            chances[i] = 1.0 - chances[i]
            over += sizes[i] * (2 * chances[i] - 1)
    return chances


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
        block: int = BLOCK, repeats: int = MAX_REPEATS) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies``: how often the mix takes each row.

    Null texts and texts without words have size 0; their copies count for nothing. Null is a
    source of its own. Repeated rows are drawn separately. Draws depend only on the rows, so
    reruns agree. An empty table gives no rows; sources without words have target 0.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"))
    # Equal rows are numbered, so that they go to different blocks; which is which makes no difference.
    rows = rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("_n")).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    rows = stored(rows.drop("_n"), "sizes")
    targets = stored(source_targets(rows, repeats), "targets")
    t = targets.select(F.col("source").alias("_s"), "source_size", "documents", "target")
    units = rows.join(t, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(repeats)))).otherwise(0.0)
    units = units.withColumn("whole", F.floor(rate + _EPS)).withColumn(
        "chance", F.greatest(rate - F.col("whole"), F.lit(0.0)))
    units = units.withColumn("chance", F.when((F.col("chance") < _EPS) | (F.col("size") == 0), 0.0).otherwise(F.col("chance")))
    most = targets.agg(F.max("documents")).first()[0] or 0
    columns = units.columns
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in units.schema)

    def draw(part: pa.Table) -> pa.Table:
        part = part.sort_by([("size", "descending"), ("doc_id", "ascending"), ("copy", "ascending")])
        sizes, chances = part["size"].to_pylist(), part["chance"].to_pylist()
        short = part["source_size"][0].as_py() - sum(sizes)
        moved = draw_long(sizes, chances, short, chances[0], f"long:{part['source'][0].as_py()}:{part['doc_id'][0].as_py()}")
        return part.set_column(part.schema.get_field_index("chance"), "chance", pa.array(moved, pa.float64()))

    def round_of(undecided: DataFrame, blocks: Column, number: int) -> DataFrame:
        spread = undecided.withColumn("_block", F.pmod(F.xxhash64("doc_id", "size", "copy", F.lit(number)), blocks))
        spread = spread.withColumn("_last", blocks == 1)

        def balance(part: pa.Table) -> pa.Table:
            last = part["_last"][0].as_py()
            part = part.drop_columns(["_block", "_last"]).sort_by([("size", "descending"), ("doc_id", "ascending"), ("copy", "ascending")])
            sizes, chances = part["size"].to_pylist(), part["chance"].to_pylist()
            moved = flight(sizes, chances, f"{number}:{part['source'][0].as_py()}:{part['doc_id'][0].as_py()}:{part['copy'][0].as_py()}")
            moved = land(sizes, chances, moved) if last else moved
            place = part.schema.get_field_index("chance")
            return part.set_column(place, "chance", pa.array(moved, pa.float64()))

        return stored(spread.groupBy("source", "_block").applyInArrow(balance, kinds), "flight")

    # At most a block of long documents in a source; the chance of its others makes up for their draw.
    is_long = ((F.col("chance") > 0) & (F.col("size") * block > F.col("source_size"))
               & (F.col("size") * F.col("documents") > LONG * F.col("source_size")))
    units = stored(units, "units")
    long = stored(units.filter(is_long).groupBy("source").applyInArrow(draw, kinds), "long")
    shift = long.groupBy(F.col("source").alias("_s")).agg(
        F.sum(F.col("size") * F.col("chance")).alias("_taken"), F.sum("size").alias("_words"))
    level = F.col("chance") + (F.col("chance") * F.col("_words") - F.col("_taken")) / F.greatest(
        F.col("source_size") - F.col("_words"), F.lit(1))
    level = F.when(level < _EPS, 0.0).when(level > 1 - _EPS, 1.0).otherwise(level)
    others = units.filter(~is_long).join(shift, F.col("source").eqNullSafe(F.col("_s")), "left")
    others = others.withColumn("chance", F.when((F.col("chance") > 0) & F.col("_s").isNotNull(), level).otherwise(F.col("chance")))
    others = stored(others.select(*columns), "others")
    open_ = (F.col("chance") > 0) & (F.col("chance") < 1)
    decided = [long, others.filter(~open_)]
    undecided, number = others.filter(open_), 0
    # About half a block of short documents of every source waits for the round in which it lands.
    waits = (F.col("size") * F.col("documents") <= F.col("source_size")) & (
        F.pmod(F.xxhash64("doc_id", "size", "copy", F.lit("waits")), F.col("documents")) < block // 2)
    while True:
        # A source with n documents fills n / block blocks; each leaves two documents at most.
        left = F.ceil(F.col("documents") * F.lit((2 / block) ** number))
        blocks = F.greatest(F.lit(1), F.ceil(left / block))
        flies = (blocks == 1) | ~waits
        moved = round_of(undecided.filter(flies), blocks, number)
        decided.append(moved.filter(~open_))
        if most * (2 / block) ** number <= block:
            break
        undecided, number = moved.filter(open_).unionByName(undecided.filter(~flies)), number + 1
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    return out.select(*columns[:3], "source_size", "target",
                      (F.col("whole") + F.col("chance")).cast("long").alias("copies"))


def apply_mix(docs: DataFrame, mixed: DataFrame, doc_id: str = "doc_id", source: str = "source",
              text: str = "text") -> DataFrame:
    """The documents as often as the mix takes them, with all their columns.

    Rows that repeat id, source and size are matched in the order of their texts.
    """
    keys = [F.col(doc_id).alias("_id"), F.col(source).alias("_source"), word_count(text).alias("_size")]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    left = docs.select(*keys, row)
    right = mixed.select(F.col("doc_id").alias("_i"), F.col("source").alias("_s"), F.col("size").alias("_n"), "copies")
    repeated = mixed.groupBy("doc_id", "source", "size").count().filter("count > 1").limit(1).count() > 0
    same = (F.col("_id").eqNullSafe(F.col("_i")) & F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_size") == F.col("_n")))
    if repeated:
        left = left.withColumn("_o", F.row_number().over(Window.partitionBy("_id", "_source", "_size").orderBy(F.to_json("_row"))))
        right = right.withColumn("_p", F.row_number().over(Window.partitionBy("_i", "_s", "_n").orderBy("copies")))
        same = same & (F.col("_o") == F.col("_p"))
    taken = left.join(right.filter("copies > 0").hint("shuffle_hash"), same)
    return taken.select("_row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("_row.*")
