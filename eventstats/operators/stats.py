"""Counting over many dimension lists in one pass.

A target is a list of dimension labels (``"L2:T1:T2"``), optionally with its own data type,
value type and cycle (``"L2:T1#visits#users#minute_1"``). All targets become one GROUPING
SETS aggregation, so the input is scanned and shuffled once however many there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# What a statistic is called when it has no dimension.
NO_DIMENSION = "NONE"
NO_DIMENSION_LABEL = "L0"

METHODS = ("count", "countDistinct", "approxCountDistinct", "sum")
ADDITIVE = ("count", "sum")


@dataclass(frozen=True)
class StatSpec:
    """One compute step: what to count, over which dimension lists, under which names."""

    labels: Mapping[str, str]
    targets: Sequence[str]
    aggs: Sequence[str]
    data_type: str = ""
    value_type: str = ""
    cycle: str = ""
    excludes: Sequence[str] = ()
    where: str | None = None
    none_value: str = NO_DIMENSION
    rsd: float = 0.05


@dataclass(frozen=True)
class _Target:
    dims: tuple[str, ...]
    key: str
    key_name: str
    data_type: str
    value_type: str
    cycle: str


@dataclass
class _Output:
    """An aggregate column of the pass and the annotation of its rows."""

    target: _Target
    agg: str
    value: str
    present: str | None = field(default=None)


def statistics(df: DataFrame, *specs: StatSpec) -> DataFrame:
    """One row per target, group and aggregate.

    Columns: every dimension used (null where a target does not use it), ``value, key,
    keyName, data_type, value_type, cycle, agg``. An empty frame has no statistics.
    Steps that only add (counts, sums) share one pass, each under its own ``where``.
    """
    if not specs:
        raise ValueError("no statistic given")
    additive = [s for s in specs if all(split_agg(a)[1] in ADDITIVE for a in s.aggs)]
    passes = ([additive] if additive else []) + [[s] for s in specs if s not in additive]
    results = [_one_pass(df, group) for group in passes]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)


def parse_targets(spec: StatSpec) -> list[_Target]:
    """Targets in order, exact repeats removed."""
    parsed = []
    for text in dict.fromkeys(t.strip() for t in spec.targets):
        levels, *overrides = [part.strip() for part in text.split("#")]
        labels = [label.strip() for label in levels.split(":")]
        shown = [label for label in labels if label not in spec.excludes]
        names = [_column(spec, label) for label in shown]
        values = [
            overrides[i] if i < len(overrides) else default
            for i, default in enumerate((spec.data_type, spec.value_type, spec.cycle))
        ]
        for name, value in zip(("data_type", "value_type", "cycle"), values):
            if not value:
                raise ValueError(f"{name} of target {text!r} is empty")
        columns = [_column(spec, label) for label in labels]
        parsed.append(
            _Target(
                tuple(dict.fromkeys(c for c in columns if c != spec.none_value)),
                ",".join(shown) or NO_DIMENSION_LABEL,
                ",".join(names) or NO_DIMENSION,
                *values,
            )
        )
    return parsed


def _column(spec: StatSpec, label: str) -> str:
    if label == NO_DIMENSION:
        return spec.none_value
    if label not in spec.labels:
        raise ValueError(f"unknown dimension label {label!r}")
    column = spec.labels[label]
    return spec.none_value if column == NO_DIMENSION else column


def split_agg(text: str) -> tuple[str, str]:
    column, _, method = text.strip().partition(":")
    method = method.partition(":")[0].strip()
    if method not in METHODS:
        raise ValueError(f"unknown aggregate {text!r}; methods are {METHODS}")
    return column.strip(), method


def _aggregate(column: Column, method: str, rsd: float) -> Column:
    if method == "count":
        return F.count(column)
    if method == "countDistinct":
        return F.count_distinct(column)
    if method == "approxCountDistinct":
        return F.approx_count_distinct(column, rsd)
    return F.sum(column)


def _one_pass(df: DataFrame, specs: Sequence[StatSpec]) -> DataFrame:
    alone = len(specs) == 1
    wheres = [s.where.strip() if s.where and s.where.strip() else None for s in specs]
    if all(wheres):
        df = df.filter(" OR ".join(f"({w})" for w in wheres))

    aggregates: dict[str, Column] = {}
    outputs: list[_Output] = []
    for n, (spec, where) in enumerate(zip(specs, wheres)):
        guarded = where is not None and not alone
        present = f"_n{n}" if guarded else None
        if guarded:
            aggregates[present] = F.count_if(F.expr(where))
        for m, text in enumerate(dict.fromkeys(a.strip() for a in spec.aggs)):
            column, method = split_agg(text)
            source = F.when(F.expr(where), F.col(column)) if guarded else F.col(column)
            name = f"_v{n}_{m}"
            aggregates[name] = _aggregate(source, method, spec.rsd)
            outputs += [
                _Output(target, f"{column}:{method}", name, present)
                for target in parse_targets(spec)
            ]

    dims = list(dict.fromkeys(d for o in outputs for d in o.target.dims))
    sets = {_set_id(dims, o.target.dims): o.target.dims for o in outputs}
    grouped = _grouping_sets(df, dims, [sets[i] for i in sorted(sets)], aggregates)
    value_type = "double" if _has_fraction(grouped, outputs) else "bigint"

    by_set: dict[int, list[_Output]] = {}
    for o in outputs:
        by_set.setdefault(_set_id(dims, o.target.dims), []).append(o)
    rows = None
    for set_id, members in by_set.items():
        array = F.array(*[_statistic(o, value_type) for o in members])
        condition = F.col("_set") == set_id
        rows = F.when(condition, array) if rows is None else rows.when(condition, array)
    result = grouped.select(*dims, F.inline(rows))
    return result.filter("_present").drop("_present")


def _grouping_sets(
    df: DataFrame,
    dims: list[str],
    sets: Sequence[tuple[str, ...]],
    aggregates: dict[str, Column],
) -> DataFrame:
    """The aggregates per grouping set, with ``_set``: one bit per dimension left out."""
    aggs = [col.alias(name) for name, col in aggregates.items()]
    if len(sets) == 1:
        # One list needs no row expansion. The constant key keeps an empty input empty.
        only = dims or [F.lit(0).alias("_all")]
        return df.groupBy(*only).agg(*aggs).withColumn("_set", F.lit(0))
    return df.groupingSets([list(s) for s in sets], *dims).agg(
        *aggs, F.grouping_id(*dims).cast("bigint").alias("_set")
    )


def _set_id(dims: Sequence[str], members: Sequence[str]) -> int:
    return sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in members)


def _has_fraction(grouped: DataFrame, outputs: Sequence[_Output]) -> bool:
    fractional = (T.FloatType, T.DoubleType, T.DecimalType)
    return any(isinstance(grouped.schema[o.value].dataType, fractional) for o in outputs)


def _statistic(o: _Output, value_type: str) -> Column:
    return F.struct(
        F.col(o.value).cast(value_type).alias("value"),
        F.lit(o.target.key).alias("key"),
        F.lit(o.target.key_name).alias("keyName"),
        F.lit(o.target.data_type).alias("data_type"),
        F.lit(o.target.value_type).alias("value_type"),
        F.lit(o.target.cycle).alias("cycle"),
        F.lit(o.agg).alias("agg"),
        (F.col(o.present) > 0 if o.present else F.lit(True)).alias("_present"),
    )
