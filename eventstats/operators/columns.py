"""Projection, filter and column-edit operators. Every function is ``DataFrame -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from eventstats.functions import normalize_time, time_bucket
from eventstats.sources.schemas import parse_fields


def select_then_where(
    df: DataFrame, select: Sequence[str] | None = None, where: str | None = None
) -> DataFrame:
    """Select SQL expressions, then filter; the filter sees the aliases. Neither: identity."""
    if select:
        df = df.selectExpr(*select)
    if where and where.strip():
        df = df.filter(where)
    return df


def add_fields(df: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    """Add columns, overwriting those that exist."""
    return df.withColumns(dict(fields))


def update_field(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Replace a column's value; a column that does not exist is not added."""
    return df.withColumn(name, value) if name in df.columns else df


def rename_replace(
    df: DataFrame, old: str, new: str, fn: Callable[[Column], Column]
) -> DataFrame:
    """Replace ``old`` by ``new = fn(old)``, in the same place."""
    return df.select(*[fn(F.col(c)).alias(new) if c == old else F.col(c) for c in df.columns])


def remove_fields(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def evolve(df: DataFrame, add: Sequence[str] = (), remove: Sequence[str] = ()) -> DataFrame:
    """Drop columns, add missing ``name[:type]`` columns as nulls, sort columns by name."""
    gone = {name.strip() for name in remove}
    kept = {c: F.col(c) for c in df.columns if c not in gone}
    for field in parse_fields(add):
        if field.name not in kept:
            kept[field.name] = F.lit(None).cast(field.dataType).alias(field.name)
    return df.select(*[kept[name] for name in sorted(kept)])


def enhance_time(
    df: DataFrame,
    time_col: str = "time",
    intervals: Sequence[int] = (1,),
    prefix: str = "time_minute_",
    default_offset: str = "+08:00",
    observe: Observation | str | None = None,
) -> DataFrame:
    """Normalise the event time, drop rows without a valid one, add bucket start and end.

    The time comes out of a generator so that the filter on it does not compute it again.
    ``observe`` counts the rows with an ``invalid_time`` and the ``valid`` ones on the way.
    """
    time = F.explode(F.array(normalize_time(F.col(time_col), default_offset)))
    others = [c for c in df.columns if c != time_col]
    timed = df.select(*others, time.alias(time_col)).select(*df.columns)
    valid = F.col(time_col).isNotNull()
    if observe is not None:
        counts = F.count_if(~valid).alias("invalid_time"), F.count_if(valid).alias("valid")
        timed = timed.observe(observe, *counts)
    timed = timed.filter(valid)
    return timed.withColumns(_bucket_columns(time_col, intervals, prefix))


def label_times(
    df: DataFrame,
    time_col: str = "time",
    intervals: Sequence[int] = (1,),
    prefix: str = "time_minute_",
    labels_col: str = "labels",
) -> DataFrame:
    """Write bucket start and end into a map column, keeping its other entries."""
    buckets = _bucket_columns(time_col, intervals, prefix)
    added = F.create_map(*[part for name, col in buckets.items() for part in (F.lit(name), col)])
    old = F.coalesce(F.col(labels_col), F.create_map().cast("map<string,string>"))
    fresh = F.map_filter(old, lambda key, _: ~key.isin(*buckets))
    return df.withColumn(labels_col, F.map_concat(fresh, added))


def _bucket_columns(time_col: str, intervals: Sequence[int], prefix: str) -> dict[str, Column]:
    columns = {}
    for minutes in intervals:
        start, end = time_bucket(F.col(time_col), minutes)
        columns[f"{prefix}{minutes}_start"] = start
        columns[f"{prefix}{minutes}_end"] = end
    return columns
