"""Helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of white space and runs of anything else, by ASCII white space only.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in a folder that driver and executors share.

    That is the folder of ``spark.checkpoint.dir``; where it is unset, the checkpoint folder
    of the context. In a session on one machine the warehouse serves as well; on a cluster it
    may be a folder of the driver's own, so there one of the two has to be set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """The frame written to the shared folder as Parquet and read again.

    This cuts the lineage: rows are computed once, and a lost executor takes none of them along.
    ``by`` is a column that partitions the folder, for later reads of some of its values.
    """
    path = shared_folder(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Inner join of ``rows`` with one row for each value of ``key``, which tells the ``size`` of its group.

    Groups with more rows than a fourth of a shuffle partition's share are split off: there are at
    most four times as many as shuffle partitions, so they are broadcast, and their rows stay where
    they are. The others are shuffled by the key. Both frames should be stored: they are read twice.
    """
    spark = rows.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = max(rows.count() // (4 * width), 1)
    heavy = groups.filter(F.col(size) > least)
    light = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(
        groups.filter(F.col(size) <= least).hint("merge"), key)
    return rows.join(F.broadcast(heavy), key).unionByName(light)


_HELD: dict = {}


def worker_state(key: tuple, make):
    """What a Python worker keeps from task to task, for one operator at a time.

    Workers outlive stages. What another operator left is dropped, so that the tables and caches of
    the stages of a pipeline do not add up.
    """
    if key not in _HELD:
        drop_worker_state()
        _HELD[key] = make()
    return _HELD[key]


def drop_worker_state() -> None:
    """Let go what an operator keeps in this Python worker, and give back what was freed."""
    _HELD.clear()
    release_memory()


def leaving_nothing(run):
    """A function for applyInArrow that keeps nothing in its Python worker, neither its own nor another's."""

    def whole(part: pa.Table) -> pa.Table:
        drop_worker_state()
        out = run(part)
        release_memory()
        return out

    return whole


def stream_leaving_nothing(run):
    """The same for mapInArrow."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        yield from run(batches)
        release_memory()

    return whole


def release_memory() -> None:
    """Give memory that was freed back to the system, where the C library can.

    It keeps what many arrays of middle size left behind, and the driver or a Python worker would carry
    the peak of one step through all that follow.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def local_ids(spark: SparkSession, ids: list[int], name: str = "doc_id") -> DataFrame:
    """A frame of the driver's own ids. Of a list of rows Spark would make an RDD that needs Python workers."""
    return spark.createDataFrame(pa.table({name: pa.array(ids, pa.int64())}))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fold_of(doc_id: Column, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the CRC-32 of a text of ASCII characters."""
    start, table = 4294967295, "xor(x >> 1, 3988292384 * (x & 1))"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii(({text})[i]) AS BIGINT))"
    bits = "CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])"
    byte = f"list_reduce({bits}, lambda x, y: {table}, xor(c, b))"
    return f"xor(list_reduce({codes}, lambda c, b: {byte}, CAST({start} AS BIGINT)), {start})"
