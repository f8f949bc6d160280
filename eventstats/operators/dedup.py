"""Repeat detection: first row of a key per time bucket, and keys seen in the batch before.

The input is evaluated once and never joined with itself. Rows meet by key and minute, which splits
a key that holds much of the data, and the first of each minute is marked. Only those first rows, at
most one a minute and key, are then compared by key over the wider buckets; the others go along
spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventstats.functions import BUCKET_WIDTHS, bucket_label
from eventstats.operators.lookups import salted_join

_BUCKET, _HEAD = "_bucket", "_head"
#: Rows of a key are gathered by this interval first.
_CHUNK = "minutely"


def flag_name(keys: Sequence[str], interval: str) -> str:
    return "_".join([*keys, interval, "duplicate_flag"])


def flag_duplicates(
    df: DataFrame,
    keys: Sequence[str] = ("user_id",),
    intervals: Sequence[str] = ("daily",),
    time_col: str = "time",
    tiebreak: Sequence[str] | None = ("event_id",),
) -> DataFrame:
    """Add one flag per interval: 0 on the first row of (keys, bucket), 1 on later rows.

    Rows are ordered by time, then by ``tiebreak``, which together with key and time must
    identify a row. ``tiebreak=None`` is for rows without an id: ties are broken by a hash of all
    columns, so only rows that are alike in every column can change places. A row whose first key
    is blank cannot be a repeat: its flags are 0.
    """
    intervals = widest_last(intervals)
    order = _order(df, time_col, tiebreak)
    blank = has_no_key(keys)
    time = F.col(time_col)
    # Blank keys would meet in one task; a hash of their order spreads them.
    own = F.xxhash64(*order)
    minute = Window.partitionBy(*keys, _bucket(time, _CHUNK), F.when(blank, own)).orderBy(*order)
    out = df.withColumn(_HEAD, ~blank & F.lag(F.lit(1)).over(minute).isNull())
    wider = [i for i in intervals if i != _CHUNK]
    repeat = {_CHUNK: F.lit(0)}
    if wider:
        heads = Window.partitionBy(
            *keys, _bucket(time, wider[-1]), F.when(~F.col(_HEAD), own)
        ).orderBy(*order)
        repeat |= {i: _same_bucket_as_before(time_col, i, heads) for i in wider}
    return out.withColumns(
        {
            flag_name(keys, i): F.when(blank, 0).when(F.col(_HEAD), repeat[i]).otherwise(1)
            for i in intervals
        }
    ).drop(_HEAD)


def _order(df: DataFrame, time_col: str, tiebreak: Sequence[str] | None) -> list[Column]:
    if tiebreak is not None:
        return [F.col(c) for c in dict.fromkeys([time_col, *tiebreak])]
    maps = {f.name for f in df.schema if "map<" in f.dataType.simpleString()}
    columns = [F.to_json(c) if c in maps else F.col(c) for c in df.columns]  # maps have no hash
    return [F.col(time_col), F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)]


def flag_specs(
    df: DataFrame,
    specs: Sequence[tuple[Sequence[str], Sequence[str]]],
    time_col: str = "time",
    tiebreak: Sequence[str] | None = ("event_id",),
) -> DataFrame:
    """Flags for several (keys, intervals) pairs; each pair is independent of the others."""
    for keys, intervals in specs:
        df = flag_duplicates(df, keys, intervals, time_col, tiebreak)
    return df


def drop_repeats(
    df: DataFrame,
    keys: Sequence[str] = ("user_id",),
    interval: str = "daily",
    time_col: str = "time",
    tiebreak: Sequence[str] | None = ("event_id",),
) -> DataFrame:
    """Keep the rows whose flag would be 0."""
    name = flag_name(keys, interval)
    flagged = flag_duplicates(df, keys, [interval], time_col, tiebreak)
    return flagged.filter(F.col(name) == 0).drop(name)


def first_rows(
    df: DataFrame,
    keys: Sequence[str],
    intervals: Sequence[str],
    time_col: str,
    order: Sequence[str],
) -> DataFrame:
    """First row of each (keys, finest bucket), with ``_repeat_<interval>`` 0 or 1.

    Buckets nest, so the first row of a day is also the first of its minute: coarser
    intervals only have to look at the finest interval's first rows, in time order.
    """
    finest = intervals[0]
    names = list(dict.fromkeys([*keys, *order]))
    rows = df.filter(~has_no_key(keys)).select(*names)
    firsts = (
        rows.groupBy(*keys, _bucket(F.col(time_col), finest).alias(_BUCKET))
        .agg(F.min(F.struct(*order)).alias("_o"))
        .select(*keys, _BUCKET, *[F.col("_o")[c].alias(c) for c in order if c not in keys])
        .withColumn(f"_repeat_{finest}", F.lit(0))
    )
    if len(intervals) > 1:
        window = Window.partitionBy(*keys).orderBy(*order)
        firsts = firsts.withColumns(
            {f"_repeat_{i}": _same_bucket_as_before(time_col, i, window) for i in intervals[1:]}
        )
    return firsts


def widest_last(intervals: Sequence[str]) -> list[str]:
    for i in intervals:
        if i not in BUCKET_WIDTHS:
            raise ValueError(f"unknown interval {i!r}; use one of {sorted(BUCKET_WIDTHS)}")
    return sorted(dict.fromkeys(intervals), key=lambda i: -BUCKET_WIDTHS[i])


def has_no_key(keys: Sequence[str]) -> Column:
    return F.coalesce(F.col(keys[0]).cast("string"), F.lit("")) == ""


def _bucket(time: Column, interval: str) -> Column:
    return F.coalesce(bucket_label(time, interval), F.lit(""))


def _same_bucket_as_before(time_col: str, interval: str, window) -> Column:
    label = _bucket(F.col(time_col), interval)
    return F.coalesce((F.lag(label).over(window) == label).cast("int"), F.lit(0))


def drop_seen_in_previous_batch(
    df: DataFrame, previous_keys: DataFrame, key: str, salts: int = 16
) -> DataFrame:
    """Keep rows whose key (an SQL expression) is not in the batch before; repeats inside
    the batch stay. ``previous_keys`` has the key values in its only column."""
    previous = previous_keys.toDF("_key").distinct()
    keyed = df.withColumn("_key", F.expr(key))
    return salted_join(keyed, previous, ["_key"], "left_anti", salts).drop("_key")


def drop_seen_in_adjacent_batch(
    df: DataFrame, key: str, batch_col: str, salts: int = 16
) -> DataFrame:
    """The same over a table that holds many batches, numbered in ``batch_col``."""
    keyed = df.withColumn("_key", F.expr(key))
    previous = keyed.select("_key", (F.col(batch_col) + 1).alias(batch_col)).distinct()
    return salted_join(keyed, previous, ["_key", batch_col], "left_anti", salts).drop("_key")
