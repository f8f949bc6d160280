"""Table plug-ins that SQL can call: Python table functions that choose their own partitioning.

    register(spark)
    SELECT * FROM grouped_rows(TABLE(events), 'host', 'event_id', 100)

A flow step calls one with ``method: "table-function"``, ``name`` and ``args``. Rows are given to
Python one by one, partition by partition and in order, so a partition needs no memory of its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import LongType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn


class GroupedRows:
    """All columns of a table, and ``group_no`` and ``place``: the rows of each key in groups of a size.

    Arguments: the table, the key column, the column to order by, the rows of a group. A column that
    the table does not have, a size below 1, and columns named like the results are errors.
    """

    @staticmethod
    def analyze(table: AnalyzeArgument, key: AnalyzeArgument, order: AnalyzeArgument, size: AnalyzeArgument) -> AnalyzeResult:
        names = table.dataType.fieldNames()
        for column in (key.value, order.value):
            if column not in names:
                raise ValueError(f"no column {column!r} in the table")
        if {"group_no", "place"} & set(names):
            raise ValueError("the table has a column named group_no or place")
        if size.value is None or size.value < 1:
            raise ValueError("the size must be at least 1")
        schema = StructType(list(table.dataType.fields)).add("group_no", LongType()).add("place", LongType())
        return AnalyzeResult(
            schema=schema, partitionBy=[PartitioningColumn(key.value)], orderBy=[OrderingColumn(order.value)])

    def __init__(self) -> None:
        self.seen = 0

    def eval(self, row, key: str, order: str, size: int):
        yield (*row, self.seen // size, self.seen % size)
        self.seen += 1


def register(spark: SparkSession) -> None:
    spark.udtf.register("grouped_rows", udtf(GroupedRows))


def apply_table_function(df: DataFrame, name: str, args: Sequence[object] = ()) -> DataFrame:
    """Call a registered table function on a frame; ``args`` are texts and numbers."""
    if not name.isidentifier():
        raise ValueError(f"{name!r} is not the name of a function")
    marks = "".join(f", :a{i}" for i in range(len(args)))
    values = {f"a{i}": value for i, value in enumerate(args)}
    return df.sparkSession.sql(f"SELECT * FROM {name}(TABLE({{rows}}){marks})", args=values, rows=df)
