"""Exact top-k search by inner product with a pivot-distance index (operator 8).

Vectors get one more coordinate that makes all of them equally long; then the largest inner
product is the smallest distance. Every vector is keyed by its nearest pivot and the distance to
it, and the vectors of a pivot are cut into annuli by distance. A query first searches the annulus
it falls into, which bounds its k-th best score; then it visits, pivot by pivot and outwards from
its own distance, the annuli that the triangle inequality cannot rule out. Visiting is by joins:
queries are sent to cells in blocks, each cell is scored by one small matrix product.

Pivots are fitted on a bounded sample; every vector is indexed, and the bounds are exact, so the
result does not depend on the sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventstats.llm.common import stored

#: Pivots, and the number of sampled vectors they are chosen from.
PIVOTS = 16
SAMPLE = 2000
#: Vectors that a cell should hold; cells are split further where distances repeat.
CELL_ROWS = 4096
#: Queries that one task sends to a part of a cell, about.
ASKED_ROWS = 8192
#: Slack for rounding in distances, as a share of the largest length.
SLACK = 1e-9


def quantised(vectors: DataFrame, scale: int = 1024, column: str = "embedding") -> DataFrame:
    """``vec_id, v``: each component x as floor(scale * x); unusable vectors are left out."""
    x = F.col(column).cast("array<double>")
    usable = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    v = F.transform(x, lambda e: F.floor(e * F.lit(float(scale))).cast("long"))
    return vectors.filter(F.col(column).isNotNull() & F.col("vec_id").isNotNull()).filter(
        F.coalesce(usable, F.lit(False))
    ).select("vec_id", v.alias("v"))


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Farthest-first pivots from a sample of at most ``sample`` vectors by hash of the id."""
    ids = vectors.select(F.xxhash64("vec_id").alias("h"), "vec_id").orderBy("h", "vec_id").limit(sample)
    rows = vectors.join(F.broadcast(ids.select("vec_id").distinct()), "vec_id", "left_semi")
    found = sorted((r["vec_id"], list(r["v"])) for r in rows.limit(2 * sample).collect())
    points = np.array([v for _, v in found], dtype=np.float64)
    if not len(points):
        return points.reshape(0, 0)
    chosen = [points[np.argmax(np.einsum("ij,ij->i", points, points))]]
    far = np.linalg.norm(points - chosen[0], axis=1)
    while len(chosen) < min(pivots, len(points)) and far.max() > 0:
        chosen.append(points[np.argmax(far)])
        far = np.minimum(far, np.linalg.norm(points - chosen[-1], axis=1))
    return np.array(chosen)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, pivots: int = PIVOTS, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest inner products of every query.

    ``vectors`` and ``queries`` are ``vec_id, v`` with integer components and no nulls. A query
    never finds rows with its own id. Ties go to the smaller id; with fewer than k candidates
    all are given. Vectors are compared with queries of the same number of components only;
    repeated rows count each. Empty tables give no rows. Components so large that a square sum
    leaves 64 bits are an error (ARITHMETIC_OVERFLOW), not a wrong score.
    """
    found = []
    for size, in vectors.select(F.size("v")).distinct().collect():
        same = F.size("v") == size
        found.append(_top_k(vectors.filter(same), queries.filter(same), k, pivots, cell_rows))
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _top_k(vectors: DataFrame, queries: DataFrame, k: int, pivots: int, cell_rows: int) -> DataFrame:
    spark = vectors.sparkSession
    centres = choose_pivots(vectors, pivots)
    square = F.aggregate("v", F.lit(0).cast("long"), lambda a, e: a + e * e)
    longest = vectors.select(F.max(square)).first()[0] or 0
    if not centres.size:  # vectors without components: every score is 0
        centres = np.zeros((1, 0))
    # The added coordinate of a vector is sqrt(longest - |v|^2); pivots lie in the plane where it is 0.
    slack = SLACK * (longest + 1) + 1e-6

    def to_pivots(x: np.ndarray, total: float) -> np.ndarray:
        d2 = total - 2 * x @ centres.T + np.einsum("ij,ij->i", centres, centres)
        return np.sqrt(np.maximum(d2, 0))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1)).astype(np.float64).reshape(len(batch), centres.shape[1])
            d = to_pivots(x, float(longest))  # |v|^2 plus the added coordinate squared
            near = d.argmin(axis=1) if len(x) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(near.astype(np.int32)),
                 pa.array(d[np.arange(len(x)), near])], ["vec_id", "v", "pivot", "far"])

    index = stored(vectors.mapInArrow(key, "vec_id long, v array<long>, pivot int, far double"), "pivot-index")
    # Annuli by approximate quantiles of the distance: any cut is right, even ones are fast.
    sizes = index.groupBy("pivot").agg(
        F.count("*").alias("n"), F.percentile_approx("far", [i / 64 for i in range(1, 64)], 1000).alias("q"))
    step = F.greatest(F.lit(1), F.floor(F.lit(64) * cell_rows / F.col("n")).cast("int"))
    cuts = F.array_distinct(F.filter("q", lambda x, i: (i + 1) % step == 0))
    sizes = F.broadcast(sizes.select(F.col("pivot").alias("p"), cuts.alias("cuts")))  # a row per pivot
    index = index.join(sizes, F.col("pivot") == F.col("p")).withColumn(
        "annulus", F.size(F.filter("cuts", lambda c: c < F.col("far")))).drop("p", "cuts")
    cells = index.groupBy("pivot", "annulus").agg(
        F.count("*").alias("n"), F.min("far").alias("low"), F.max("far").alias("high"))
    cells = stored(cells.withColumn("parts", F.ceil(F.col("n") / (2 * cell_rows)).cast("int")), "cells")
    parts = cells.select("pivot", "annulus", "parts")
    index = stored(
        index.join(parts, ["pivot", "annulus"]).withColumn(
            "part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")),
        "cell-index",
    )
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")).distinct()

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1)).astype(np.float64).reshape(len(batch), centres.shape[1])
            norm = np.einsum("ij,ij->i", x, x)
            d = np.sqrt(np.maximum(norm[:, None] - 2 * x @ centres.T + np.einsum("ij,ij->i", centres, centres), 0))
            rows, count = len(x), len(centres)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), count)),
                 pa.array(np.repeat(norm, count)), pa.array(np.tile(np.arange(count, dtype=np.int32), rows)),
                 pa.array(d.ravel())], ["query_id", "norm", "pivot", "away"])

    asked = stored(asked, "queries")
    away = stored(asked.mapInArrow(distances, "query_id long, norm double, pivot int, away double"), "query-pivots")

    def visit(pairs: DataFrame) -> DataFrame:
        """The k best of each (query, cell) pair, as ``query_id, vec_id, score``."""
        turns = F.ceil(F.count("*") / ASKED_ROWS).cast("int")
        asks = F.broadcast(pairs.groupBy("pivot", "annulus").agg(turns.alias("turns")))  # 64 cells a pivot at most
        sent = pairs.join(asked, "query_id").join(parts, ["pivot", "annulus"]).join(asks, ["pivot", "annulus"])
        sent = sent.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
            "pivot", "annulus", "part", F.pmod(F.xxhash64("query_id"), F.col("turns")).cast("int").alias("turn"), "query_id", "q")
        cell = ["pivot", "annulus", "part", "turn"]
        met = index.join(asks, ["pivot", "annulus"]).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
        return met.select(*cell, "vec_id", "v").groupBy(*cell).cogroup(sent.groupBy(*cell)).applyInArrow(
            lambda left, right: _score(left, right, k), "query_id long, vec_id long, score long")

    def best(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    # First the annulus nearest to each query at its nearest pivot.
    gap = F.greatest(F.col("low") - F.col("away"), F.col("away") - F.col("high"), F.lit(0.0))
    ways = away.join(F.broadcast(cells), "pivot").withColumn("gap", gap)  # 64 cells a pivot at most
    nearest = Window.partitionBy("query_id").orderBy("gap", "away", "pivot", "annulus")
    first = ways.withColumn("o", F.row_number().over(nearest)).filter("o = 1").select("query_id", "pivot", "annulus")
    seeds = stored(best(visit(stored(first, "first-cells"))), "seeds")
    worst = seeds.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("score"))
    bound = worst.filter(F.col("n") == k).select("query_id", "score")
    # |q - v|^2 = |q|^2 + longest - 2 q.v: farther than the k-th best cannot enter.
    radius2 = F.col("norm") + F.lit(float(longest)) - 2 * F.col("score")
    near = F.col("score").isNull() | (F.col("gap") * F.col("gap") <= F.greatest(radius2, F.lit(0.0)) + slack)
    rest = ways.join(bound, "query_id", "left").filter(near).join(first, ["query_id", "pivot", "annulus"], "left_anti")
    more = visit(stored(rest.select("query_id", "pivot", "annulus"), "further-cells"))
    every = seeds.select("query_id", "vec_id", "score").unionByName(more)
    return best(every).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _score(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    if not left.num_rows or not right.num_rows:
        return schema.empty_table()
    left, right = left.combine_chunks(), right.combine_chunks()
    ids = left["vec_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    x = _matrix(left["v"].combine_chunks())[order]
    asked, q = right["query_id"].to_numpy(), _matrix(right["q"].combine_chunks())
    out: list[list[np.ndarray]] = [[], [], []]
    for at in range(0, len(asked), 256):
        block = q[at : at + 256]
        top = int(np.abs(block).max(initial=0)) * int(np.abs(x).max(initial=0)) * max(x.shape[1], 1)
        exact = top < 1 << 52  # float64 products and sums are then whole numbers
        scores = (block.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64) if exact else block @ x.T
        for row, query in zip(scores, asked[at : at + 256]):
            other = ids != query
            mine, names = row[other], ids[other]
            if len(mine) > k:
                limit = np.partition(mine, len(mine) - k)[len(mine) - k]
                above = np.flatnonzero(mine > limit)
                ties = np.flatnonzero(mine == limit)[: k - len(above)]  # ids are sorted
                pick = np.concatenate([above, ties])
                mine, names = mine[pick], names[pick]
            out[0].append(np.full(len(mine), query))
            out[1].append(names)
            out[2].append(mine)
    return pa.table([np.concatenate(c).astype(np.int64) for c in out], schema=schema)
