"""What a stream remembers between batches, kept as replay-safe tables of keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventstats.functions import bucket_label
from eventstats.operators.dedup import (
    drop_seen_in_previous_batch,
    first_rows,
    flag_name,
    has_no_key,
    widest_last,
)
from eventstats.sinks.batched import BatchTable

_PLACE = ("interval", "period")


class SeenKeys:
    """Repeat flags across batches: the first row to arrive of (keys, bucket) gets 0.

    Each batch stores only the keys it met first. Keys of the batch are found by partial
    aggregation, compared with the stored ones key by key, and the flags return to the rows
    by a join on row identity, so no key's rows are gathered in one task.

    Stored keys lie in one directory per interval and period (the day of a bucket, or the
    whole bucket when it is longer), and a batch reads only the periods it has events of.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str] = ("user_id",),
        intervals: Sequence[str] = ("daily",),
        time_col: str = "time",
        tiebreak: Sequence[str] = ("event_id",),
        run: str = "0",
    ):
        """``run`` names the stream checkpoint; keys of other runs count as met."""
        self.table = BatchTable(spark, path, run)
        self.keys = list(keys)
        self.intervals = widest_last(intervals)
        self.time_col = time_col
        self.order = [time_col, *[c for c in tiebreak if c != time_col]]
        self.identity = list(dict.fromkeys([*self.keys, *self.order]))

    def flag_batch(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The batch with its flag columns. Replaying a batch gives the same flags."""
        self.table.write_batch(self._new_keys(batch, batch_id), batch_id, *_PLACE)
        blank = has_no_key(self.keys)
        names = {i: flag_name(self.keys, i) for i in self.intervals}
        stored = self.table.read_batch(batch_id)
        if stored is None:  # every key of the batch was met before
            return batch.withColumns(
                {name: F.when(blank, 0).otherwise(1) for name in names.values()}
            )
        marks = stored.groupBy(*self.identity).agg(
            *[F.max(F.col("interval") == i).alias(f"_first_{i}") for i in self.intervals]
        )
        marks = marks.withColumnsRenamed({c: f"_m_{c}" for c in self.identity})
        on = reduce(
            lambda a, b: a & b, [batch[c].eqNullSafe(marks[f"_m_{c}"]) for c in self.identity]
        )
        flags = {
            name: F.when(blank | F.col(f"_first_{i}"), 0).otherwise(1) for i, name in names.items()
        }
        return batch.join(marks, on, "left").select(
            *[batch[c] for c in batch.columns], *[c.alias(n) for n, c in flags.items()]
        )

    def first_of_batch(
        self, batch: DataFrame, batch_id: int, interval: str | None = None
    ) -> DataFrame:
        """Only the rows whose flag is 0 for ``interval``, without flag columns."""
        name = flag_name(self.keys, interval or self.intervals[0])
        return self.flag_batch(batch, batch_id).filter(F.col(name) == 0).select(*batch.columns)

    def compact(self, upto: int, oldest: Mapping[str, str] | None = None) -> None:
        """Fold batches into one part; ``oldest`` gives, per interval, the first bucket to
        keep (older buckets can no longer get events)."""

        def fold(rows: DataFrame) -> DataFrame:
            for interval, bucket in (oldest or {}).items():
                rows = rows.filter((F.col("interval") != interval) | (F.col("bucket") >= bucket))
            return rows

        self.table.fold(upto, fold, *_PLACE)

    def _new_keys(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """(interval, bucket, keys) met for the first time, with the identity of their row."""
        firsts = first_rows(batch, self.keys, self.intervals, self.time_col, self.order)
        entries = F.array(
            *[
                F.struct(
                    F.lit(i).alias("interval"),
                    bucket_label(F.col(self.time_col), i).alias("bucket"),
                    F.col(f"_repeat_{i}").alias("_repeat"),
                )
                for i in self.intervals
            ]
        )
        met = (
            firsts.select(*self.identity, F.inline(entries))
            .filter(F.col("_repeat") == 0)
            .drop("_repeat")
            .withColumn("period", F.concat(F.lit("p"), F.substring("bucket", 1, 10)))
        )
        seen = self.table.read(before=batch_id)
        if seen is None:
            return met
        # A few rows: the days of this batch. They become a partition filter.
        places = met.select(*_PLACE).distinct().collect()
        wanted = [
            (F.col("interval") == i)
            & F.col("period").isin([p["period"] for p in places if p["interval"] == i])
            for i in sorted({p["interval"] for p in places})
        ]
        if not wanted:
            return met
        names = [*_PLACE, "bucket", *self.keys]
        seen = seen.filter(reduce(lambda a, b: a | b, wanted)).select(*names)
        seen = seen.withColumnsRenamed({c: f"_s_{c}" for c in names})
        on = reduce(lambda a, b: a & b, [met[c].eqNullSafe(seen[f"_s_{c}"]) for c in names])
        return met.join(seen, on, "left_anti")


class PreviousBatch:
    """Drop rows whose key was in the batch before; repeats within a batch stay."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.table = BatchTable(spark, path)
        self.key = key

    def keep_new(self, batch: DataFrame, batch_id: int) -> DataFrame:
        keys = batch.select(F.expr(self.key).alias("_key")).distinct()
        self.table.write_batch(keys, batch_id)
        previous = self.table.read_batch(batch_id - 1)
        if previous is None:
            return batch
        return drop_seen_in_previous_batch(batch, previous, self.key)
