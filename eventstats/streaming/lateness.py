"""Rows behind the watermark, kept apart instead of dropped.

State that expires, be it Spark's own or a table of keys, gives wrong answers to rows that come
after it has expired. ``Lateness`` draws the line that Spark draws, the greatest event time of the
batches before less a delay, and divides a micro-batch at it: what is on time may go to operators
with bounded state, and the late rows go to a table of their own. Together they are all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eventstats.functions import bucket_label
from eventstats.sinks.batched import BatchTable


class Lateness:
    """The watermark of a stream, remembered by batch, so that a replay divides its rows alike.

    ``delay`` is an interval ("3 days"). Event times may be timestamps or text that casts to one;
    rows without a time are on time, as no bucket is known that they could miss.
    """

    def __init__(
        self, spark: SparkSession, path: str, delay: str, time_col: str = "time", run: str = "0"
    ):
        self.table = BatchTable(spark, path, run)
        self.delay = delay
        self.time_col = time_col

    def watermark(self, batch_id: int) -> str | None:
        """The line for a batch, as text, from the batches before it; None for the first."""
        before = self.table.read(before=batch_id)
        if before is None:
            return None
        line = F.max("greatest") - F.expr(f"INTERVAL {self.delay}")
        return before.agg(line.cast("string").alias("line")).first()["line"]

    def split(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """The rows on time and the late rows. The batch is read once for its greatest time."""
        time = self._time()
        self.table.write_batch(batch.agg(F.max(time).alias("greatest")), batch_id)
        line = self.watermark(batch_id)
        if line is None:
            return batch, batch.limit(0)
        late = F.coalesce(time <= F.lit(line).cast("timestamp_ntz"), F.lit(False))
        return batch.filter(~late), batch.filter(late)

    def oldest(self, intervals: Sequence[str], batch_id: int) -> dict[str, str]:
        """For ``SeenKeys.compact``: the first bucket of each interval that a later batch can meet."""
        line = self.watermark(batch_id)
        if line is None:
            return {}
        spark = self.table.spark
        buckets = [bucket_label(F.lit(line), i).alias(i) for i in intervals]
        return spark.range(1).select(*buckets).first().asDict()

    def _time(self) -> Column:
        return F.col(self.time_col).try_cast("timestamp_ntz")


def first_per_key(stream: DataFrame, keys: Sequence[str], time_col: str, delay: str) -> DataFrame:
    """One row of each key that comes within ``delay`` of it, by Spark's state store.

    State goes ``delay`` after its row, so repeats of a key must not lie further apart, and rows
    behind the watermark are dropped: divide them off by ``Lateness`` first, with a delay no longer
    than this one. A wall-clock time is read as UTC; the session time zone plays no part.
    """
    kind = stream.schema[time_col].dataType
    if isinstance(kind, T.TimestampNTZType):
        seconds = (F.col(time_col) - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("bigint")
        stream = stream.withColumn("_instant", F.timestamp_seconds(seconds))
    else:
        stream = stream.withColumn("_instant", F.col(time_col))
    marked = stream.withWatermark("_instant", delay)
    return marked.dropDuplicatesWithinWatermark(list(keys)).drop("_instant")
