"""Tumbling event-time windows with bounded lateness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from eventstats.sinks.batched import BatchTable


def tumbling_counts(
    stream: DataFrame, ts_col: str, length: str, dims: Sequence[str], lateness: str
) -> DataFrame:
    """Rows per window and dimensions. Rows later than ``lateness`` are left out:
    divide them off by ``Lateness`` and add their ``window_counts`` to the totals.

    Watermarks need an instant, so a wall-clock time is read as UTC and the window bounds
    are turned back into wall-clock times; the session time zone plays no part.
    """
    stream, start, end = _instants(stream, ts_col)
    return _counted(stream.withWatermark(ts_col, lateness), ts_col, length, dims, start, end)


def window_counts(batch: DataFrame, ts_col: str, length: str, dims: Sequence[str]) -> DataFrame:
    """The same rows for a batch, without a watermark: for what came too late for one."""
    batch, start, end = _instants(batch, ts_col)
    return _counted(batch, ts_col, length, dims, start, end)


def _instants(df: DataFrame, ts_col: str) -> tuple[DataFrame, Column, Column]:
    """The frame with an instant for its time, and the bounds of a window in the time's own type."""
    start, end = F.col("window.start"), F.col("window.end")
    if isinstance(df.schema[ts_col].dataType, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        seconds = (F.col(ts_col) - epoch).cast("bigint")
        df = df.withColumn(ts_col, F.timestamp_seconds(seconds))
        start, end = [
            epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.unix_seconds(bound))
            for bound in (start, end)
        ]
    return df, start, end


def _counted(
    df: DataFrame, ts_col: str, length: str, dims: Sequence[str], start: Column, end: Column
) -> DataFrame:
    return (
        df.groupBy(F.window(ts_col, length), *dims)
        .agg(F.count(F.lit(1)).alias("value"))
        .select(start.alias("start"), end.alias("end"), *dims, "value")
    )


def latest_windows(table: BatchTable, dims: Sequence[str]) -> DataFrame:
    """Newest value of each window from a table of update-mode batches.

    Counts only grow, so the newest value is the greatest.
    """
    rows = table.read()
    return rows.groupBy("start", "end", *dims).agg(F.max("value").alias("value"))
