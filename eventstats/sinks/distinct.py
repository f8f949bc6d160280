"""Distinct counts that add up over batches.

A distinct count of a batch cannot be added to that of another, but what it was counted from can be
merged. Whole numbers are kept as bitmaps (one row for each 32,768 neighbouring numbers that a group
has any of), other texts as themselves, and approximate counts as HyperLogLog sketches. Merging is
idempotent: a value in many batches, or a batch that is replayed, counts once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventstats.operators.stats import StatSpec, parse_targets, split_agg
from eventstats.sinks.batched import BatchTable

_BUCKET, _TEXT, _BITS, _SKETCH = "_bucket", "_text", "_bits", "_sketch"
_STATE = (_BUCKET, _TEXT, _BITS, _SKETCH)
#: Logarithm of the registers of a sketch: 4,096, a standard error of 1.6 %.
SKETCH_SIZE = 12


def distinct_states(df: DataFrame, spec: StatSpec) -> DataFrame:
    """What the distinct counts of ``spec`` are made of: its dimensions and names, and the state.

    Aggregates are ``column:countDistinct`` (exact) and ``column:approxCountDistinct``. Null values
    count for nothing, but a group of only nulls is there, with 0.
    """
    if spec.where and spec.where.strip():
        df = df.filter(spec.where)
    parts = []
    for text in dict.fromkeys(a.strip() for a in spec.aggs):
        column, method = split_agg(text)
        if method == "countDistinct":
            parts.append(_exact(df, spec, column))
        elif method == "approxCountDistinct":
            parts.append(_sketched(df, spec, column))
        else:
            raise ValueError(f"{text!r} is not a distinct count")
    return reduce(lambda a, b: a.unionByName(b), parts)


def merge_states(states: DataFrame) -> DataFrame:
    """States of the same group put together; the result can be merged again."""
    names = [c for c in states.columns if c not in (_BITS, _SKETCH)]
    bits, sketch = F.col(_BITS), F.col(_SKETCH)
    merged = states.groupBy(*names).agg(
        F.when(F.count(bits) > 0, F.bitmap_or_agg(bits)).alias(_BITS),
        F.when(F.count(sketch) > 0, F.hll_union_agg(sketch)).alias(_SKETCH),
    )
    return merged.select(*states.columns)


def count_states(states: DataFrame) -> DataFrame:
    """One row per group: its names and dimensions, and the distinct ``value``."""
    value = (
        F.when(F.col(_SKETCH).isNotNull(), F.hll_sketch_estimate(_SKETCH))
        .when(F.col(_BITS).isNotNull(), F.bitmap_count(_BITS))
        .when(F.col(_TEXT).isNotNull(), F.lit(1))
        .otherwise(F.lit(0))
    )
    names = [c for c in states.columns if c not in _STATE]
    merged = merge_states(states).withColumn("value", value.cast("bigint"))
    return merged.groupBy(*names).agg(F.sum("value").alias("value"))


class DistinctTable:
    """Distinct counts of batches, by batch; ``run`` names the checkpoint the batch ids belong to."""

    def __init__(self, spark: SparkSession, path: str, run: str = "0"):
        self.table = BatchTable(spark, path, run)

    def add_batch(self, df: DataFrame, spec: StatSpec, batch_id: int) -> None:
        """Store the states of a batch; writing a batch again replaces them."""
        self.table.write_batch(distinct_states(df, spec), batch_id)

    def current(self) -> DataFrame:
        """Distinct counts over all batches, in the columns of ``statistics``."""
        rows = self.table.read()
        if rows is None:
            raise ValueError(f"no batch was written to {self.table.path}")
        return count_states(rows)

    def compact(self, upto: int) -> None:
        self.table.fold(upto, merge_states)


def _exact(df: DataFrame, spec: StatSpec, column: str) -> DataFrame:
    """Whole numbers in their usual form become bits, all else stays text."""
    number = F.col(column).try_cast("bigint")
    plain = number.cast("string") == F.col(column).cast("string")
    number = F.when(plain, number)
    text = F.when(number.isNull(), F.col(column).cast("string"))
    rows = df.withColumns(
        {_BUCKET: F.bitmap_bucket_number(number), _TEXT: text, _BITS: F.bitmap_bit_position(number)}
    )
    bits = F.when(F.count(_BITS) > 0, F.bitmap_construct_agg(_BITS)).alias(_BITS)
    return _grouped(rows, spec, f"{column}:countDistinct", [_BUCKET, _TEXT], [bits], {_SKETCH: "binary"})


def _sketched(df: DataFrame, spec: StatSpec, column: str) -> DataFrame:
    sketch = F.hll_sketch_agg(F.col(column).cast("string"), F.lit(SKETCH_SIZE)).alias(_SKETCH)
    return _grouped(
        df, spec, f"{column}:approxCountDistinct", [], [sketch],
        {_BUCKET: "bigint", _TEXT: "string", _BITS: "binary"})


def _grouped(
    rows: DataFrame, spec: StatSpec, agg: str, state_keys: list[str], aggs: list[Column], absent: dict[str, str]
) -> DataFrame:
    """All dimension lists in one pass; each list is grouped by the keys of the state too."""
    targets = parse_targets(spec)
    dims = list(dict.fromkeys(d for t in targets for d in t.dims))
    sets = list(dict.fromkeys(frozenset(t.dims) for t in targets))
    lists = [[*[d for d in dims if d in s], *state_keys] for s in sets]
    everything = [*dims, *state_keys]
    if everything:
        grouped = rows.groupingSets(lists, *everything).agg(*aggs, F.grouping_id(*everything).alias("_set"))
    else:  # a constant key keeps an empty input empty
        grouped = rows.groupBy(F.lit(0).alias("_all")).agg(*aggs).withColumn("_set", F.lit(0))

    def set_id(members) -> int:
        left_out = [d not in members for d in dims] + [False] * len(state_keys)
        return sum(1 << (len(left_out) - 1 - i) for i, out in enumerate(left_out) if out)

    cases = None
    for members in sets:
        names = F.array(*[
            F.struct(
                F.lit(t.key).alias("key"), F.lit(t.key_name).alias("keyName"),
                F.lit(t.data_type).alias("data_type"), F.lit(t.value_type).alias("value_type"),
                F.lit(t.cycle).alias("cycle"), F.lit(agg).alias("agg"),
            )
            for t in targets if frozenset(t.dims) == members
        ])
        here = F.col("_set") == set_id(members)
        cases = F.when(here, names) if cases is None else cases.when(here, names)
    state = [F.col(c) if c not in absent else F.lit(None).cast(absent[c]).alias(c) for c in _STATE]
    return grouped.select(*dims, *state, F.inline(cases))
