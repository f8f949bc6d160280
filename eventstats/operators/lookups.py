"""Lookup joins: enrich events from keyed tables.

A lookup is a left join on one text key. Rows whose key is empty, or whose condition does
not hold, get a null join key and so never match. A table that is measured and found small
is broadcast; a larger one is joined by shuffle with a salted key, so that one key that
holds a large share of the events is spread over many tasks. A large table that many batches
use is bucketed and sorted once (``BucketedDimension``); joins then shuffle only the events.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, functions as F

from eventstats.functions import (
    blank_default,
    course_process,
    first_non_empty,
    null_to_empty,
    url_domain,
)
from eventstats.functions.values import is_user_number

# A rule turns the matched row (a struct, null without a match) into columns to set.
Rule = Callable[[Column], Mapping[str, Column]]

_KEY, _FOUND, _SALT = "_lookup_key", "_found", "_salt"
#: Bytes a row takes in a hash table beyond its own: the key once more, as a row, and the slots.
_HASHED = 56


class Dimension:
    """A lookup table: its key and the columns taken from it."""

    def __init__(
        self,
        df: DataFrame,
        key: str,
        columns: Sequence[str] = (),
        broadcast_bytes: int = 64 << 20,
    ):
        self.key = key
        self.columns = list(columns)
        self.broadcast_bytes = broadcast_bytes
        self.source = df.select(key, *[c for c in self.columns if c != key]).filter(
            F.coalesce(F.col(key).cast("string"), F.lit("")) != ""
        )

    @cached_property
    def rows(self) -> DataFrame:
        """One row per key: the key and a struct. Of several rows the greatest one counts."""
        found = F.struct(F.lit(True).alias("exists"), *[F.col(c) for c in self.columns])
        return self.source.groupBy(F.col(self.key).cast("string").alias(_KEY)).agg(
            F.max(found).alias(_FOUND)
        )

    @cached_property
    def _measured(self) -> tuple[int, int]:
        """Rows' bytes and the same with the hash table: one distributed aggregate per table object."""

        def length(c: str) -> Column:
            return F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))

        width = sum((length(c) + F.lit(16) for c in self.source.columns), F.lit(16))
        held = width + length(self.key) + F.lit(_HASHED)
        sums = self.source.agg(F.sum(width.cast("bigint")), F.sum(held.cast("bigint"))).first()
        return sums[0] or 0, sums[1] or 0

    @property
    def size_bytes(self) -> int:
        """Measured size of keys and columns."""
        return self._measured[0]

    @property
    def held_bytes(self) -> int:
        """Measured size of the hash table that a broadcast builds in the driver."""
        return self._measured[1]

    def is_small(self) -> bool:
        return self.held_bytes <= self.broadcast_bytes

    def persist(self) -> Dimension:
        """Keep the table's columns on the executors, for a source that is slow to read. A
        stream that must see changes makes a new Dimension per batch and drops the old one."""
        self.source.persist()
        return self

    def unpersist(self) -> None:
        self.source.unpersist()


class BucketedDimension(Dimension):
    """A lookup table stored in buckets, sorted by key, at a path that all machines share.

    Every key is stored once for each of ``salts``, so a key that holds much of the events is still
    spread over as many buckets, and no batch has to repeat the table. Take at least as many buckets
    as shuffle partitions: with fewer, Spark shuffles both sides. The table is as it was when it was
    built; make a new one when its source has changed, and ``drop`` the old one.
    """

    def __init__(self, dim: Dimension, path: str, buckets: int = 200, salts: int = 8):
        super().__init__(dim.source, dim.key, dim.columns, dim.broadcast_bytes)
        self.spark = dim.source.sparkSession
        self.salts = salts
        self.name = f"lookup_{uuid.uuid4().hex}"
        copies = dim.rows.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        (
            copies.repartition(buckets, _KEY, _SALT)
            .write.bucketBy(buckets, _KEY, _SALT)
            .sortBy(_KEY, _SALT)
            .option("path", path)
            .format("parquet")
            .saveAsTable(self.name)
        )

    def join(self, left: DataFrame) -> DataFrame:
        """Add the found struct to rows that carry the join key.

        Rows without a key get one that no table has, a different one in every task.
        """
        task = F.spark_partition_id()
        none = F.concat(F.lit("\0"), task.cast("string"))
        keyed = left.withColumns({_SALT: F.pmod(task, F.lit(self.salts)), _KEY: F.coalesce(_KEY, none)})
        return keyed.join(self.spark.table(self.name).hint("merge"), [_KEY, _SALT], "left")

    def drop(self) -> None:
        """Forget the table; the files at its path are the caller's."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def lookup_rules(
    df: DataFrame,
    dim: Dimension,
    key: str,
    rules: Sequence[Rule],
    condition: Column | None = None,
    strategy: str = "auto",
    salts: int = 16,
) -> DataFrame:
    """Join once, then apply the rules one after another.

    ``strategy`` is "auto" (broadcast if the table's hash table is within the limit, else by buckets
    if the table has them, else by shuffle), "broadcast" (fails if the rows alone are beyond the
    limit), "bucketed" or "shuffle".
    """
    if strategy not in ("auto", "broadcast", "bucketed", "shuffle"):
        raise ValueError(f"unknown lookup strategy {strategy!r}")
    in_buckets = isinstance(dim, BucketedDimension)
    if strategy == "bucketed" and not in_buckets:
        raise ValueError("the lookup table has no buckets")
    if strategy == "broadcast" and dim.size_bytes > dim.broadcast_bytes:
        raise ValueError(f"lookup table of {dim.size_bytes} bytes is over the broadcast limit")
    small = strategy == "broadcast" or strategy == "auto" and dim.is_small()

    names = df.columns
    usable = null_to_empty(F.col(key).cast("string")) != ""
    if condition is not None:
        usable = usable & F.coalesce(condition, F.lit(False))
    left = df.withColumn(_KEY, F.when(usable, F.col(key).cast("string")))
    if small:
        joined = left.join(F.broadcast(dim.rows), _KEY, "left")
    elif in_buckets and strategy != "shuffle":
        joined = dim.join(left)
    else:
        joined = salted_join(left, dim.rows, [_KEY], "left", salts, nulls_match=False)
    joined = joined.select(*names, _FOUND)
    for rule in rules:
        joined = joined.withColumns(dict(rule(F.col(_FOUND))))
    return joined.drop(_FOUND)


def lookup_join(
    df: DataFrame,
    dim: Dimension,
    key: str,
    columns: Sequence[str] | Mapping[str, str] | None = None,
    condition: Column | None = None,
    defaults: Mapping[str, str] | None = None,
    strategy: str = "auto",
    salts: int = 16,
) -> DataFrame:
    """Add columns of the lookup table; ``columns`` may rename (table name -> new name).

    Without a match the columns are null, or the value given in ``defaults``.
    """
    wanted = columns if columns is not None else dim.columns
    names = dict(wanted) if isinstance(wanted, Mapping) else {c: c for c in wanted}
    defaults = defaults or {}

    def rule(found: Column) -> dict[str, Column]:
        return {
            new: F.when(found.isNull(), F.lit(defaults[new])).otherwise(found[old])
            if new in defaults
            else found[old]
            for old, new in names.items()
        }

    return lookup_rules(df, dim, key, [rule], condition, strategy, salts)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    salts: int,
    nulls_match: bool = True,
) -> DataFrame:
    """Join on ``keys`` that spreads each left key over ``salts`` tasks.

    The salt of a left row comes from the task that holds it, which spreads exact copies as
    well and does not change when a task is run again. The right side, one row per key, is
    repeated once per salt. With ``nulls_match=False`` a null key matches nothing and its
    rows are spread over all tasks. Spark's adaptive skew join may split further. The hint keeps
    the join a shuffle: Spark's estimate counts neither the copies for the salts nor what the
    file's compression saves, so the right side could look small enough to be sent to the driver.
    """
    right = right.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    right = right.withColumnsRenamed({k: f"_r{k}" for k in [*keys, _SALT]})
    task = F.spark_partition_id()
    salt = F.pmod(task, F.lit(salts))
    if not nulls_match:
        missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        salt = F.when(missing, -1 - task).otherwise(salt)
    left = left.withColumn(_SALT, salt)
    on = left[_SALT] == right[f"_r{_SALT}"]
    for k in keys:
        other = right[f"_r{k}"]
        on = on & (left[k].eqNullSafe(other) if nulls_match else left[k] == other)
    return left.join(right.hint("merge"), on, how).drop(_SALT, *[f"_r{k}" for k in [*keys, _SALT]])


# --- rules -------------------------------------------------------------------------------


def device_rule(found: Column) -> dict[str, Column]:
    """Repair referer, spam and user id from the device row (``channel, event, uid``)."""
    referer, spam, user_id = F.col("origin_referer"), F.col("spam"), F.col("user_id")

    def filled(col: Column, other: Column) -> Column:
        return F.when(null_to_empty(col) != "", col).otherwise(
            first_non_empty(other, F.lit("unknown"))
        )

    matched = found.isNotNull()
    return {
        "origin_referer": F.when(matched, url_domain(filled(referer, found["channel"]))).otherwise(
            blank_default(url_domain(referer), "unknown")
        ),
        "spam": F.when(matched, filled(spam, found["event"])).otherwise(
            blank_default(spam, "unknown")
        ),
        "user_id": F.when(
            matched & ~is_user_number(user_id), first_non_empty(found["uid"], user_id)
        ).otherwise(user_id),
    }


def user_rule(found: Column) -> dict[str, Column]:
    return {"date_joined": null_to_empty(found["date_joined"])}


def course_rule(now: Column | None = None) -> Rule:
    """Course columns and progress at ``now``; '' in all of them without a match."""

    def rule(found: Column) -> dict[str, Column]:
        process = course_process(
            found["course_type"], found["status"], found["start"], found["end"], now
        )
        values = {
            "course_type": found["course_type"],
            "course_owner": found["owner"],
            "course_status": found["status"],
            "course_start": found["start"],
            "course_end": found["end"],
            "course_process": process.cast("string"),
        }
        return {n: F.when(found.isNull(), F.lit("")).otherwise(c) for n, c in values.items()}

    return rule


def enrich_device(df: DataFrame, devices: Dimension, key: str = "uuid", **join) -> DataFrame:
    """Look devices up for events that lack a referer or a spam source."""
    needed = (null_to_empty(F.col("origin_referer")) == "") | (null_to_empty(F.col("spam")) == "")
    return lookup_rules(df, devices, key, [device_rule], condition=needed, **join)


def enrich_user(df: DataFrame, users: Dimension, key: str = "user_id", **join) -> DataFrame:
    """Add ``date_joined`` of numeric users, '' for the others."""
    known = is_user_number(F.col(key))
    return lookup_rules(df, users, key, [user_rule], condition=known, **join)


def enrich_course(
    df: DataFrame, courses: Dimension, key: str = "course_id", now: Column | None = None, **join
) -> DataFrame:
    return lookup_rules(df, courses, key, [course_rule(now)], **join)


def existence_flag(
    df: DataFrame,
    finished: Dimension,
    key: str = "course_id",
    now: Column | None = None,
    **join,
) -> DataFrame:
    """``course_exist_flag`` (0/1) and ``course_process`` (int) given a list of finished courses.

    Needs the course columns of ``enrich_course``.
    """

    def rule(found: Column) -> dict[str, Column]:
        exists = found.isNotNull()
        return {
            "course_exist_flag": exists.cast("int"),
            "course_process": course_process(
                F.col("course_type"),
                F.col("course_status"),
                F.col("course_start"),
                F.col("course_end"),
                now,
                finished=exists,
            ),
        }

    return lookup_rules(df, finished, key, [rule], **join)
