"""Tables from JSON text and lookup tables from parquet, JDBC or any other Spark source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from eventstats.sources.schemas import schema_from_string


def json_to_table(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """JSON line files -> table with an inferred schema; unreadable lines give nulls."""
    table = spark.read.json(path, samplingRatio=sampling_ratio)
    return table.drop("_corrupt_record")


def table_from_json(df: DataFrame, schema: str | StructType, value_col: str = "value") -> DataFrame:
    """JSON text -> table with a declared schema. A missing field is a null column."""
    if isinstance(schema, str):
        schema = schema_from_string(schema)
    return df.select(F.from_json(value_col, schema).alias("row")).select("row.*")


def read_dimension(
    spark: SparkSession,
    source: str,
    key: str,
    columns: Sequence[str],
    computed: Mapping[str, str] | None = None,
    where: str | None = None,
    kind: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Key and chosen columns of a lookup table.

    ``computed`` adds SQL expressions (for example times moved to another clock). ``kind``
    is a file format or ``"jdbc"``; for JDBC the options carry url, driver and, for a large
    table, the partition column and bounds that let Spark read it in parallel.
    """
    reader = spark.read.format(kind).options(**(options or {}))
    table = reader.option("dbtable", source).load() if kind == "jdbc" else reader.load(source)
    if where:
        table = table.filter(where)
    exprs = [f"{expr} AS `{name}`" for name, expr in (computed or {}).items()]
    return table.selectExpr(*dict.fromkeys([key, *columns]), *exprs)
