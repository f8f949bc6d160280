"""Log sources: text lines of JSON from Kafka or from files, as a stream or as a batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_options(
    brokers: str,
    topics: Sequence[str],
    max_offsets_per_trigger: int | None = None,
    starting_offsets: str = "latest",
) -> dict[str, str]:
    """Options of the Kafka source for any number of topics, with an optional rate limit."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(t.strip() for t in topics),
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_log_stream(
    spark: SparkSession,
    kind: str = "files",
    path: str | None = None,
    schema=None,
    name_glob: str | None = None,
    max_files_per_trigger: int | None = None,
    brokers: str | None = None,
    topics: Sequence[str] = (),
    max_offsets_per_trigger: int | None = None,
    starting_offsets: str = "latest",
    partitions: int | None = None,
) -> DataFrame:
    """Unbounded log input.

    ``kind="kafka"`` gives ``value`` and a ``row_id`` made of topic, partition and offset.
    ``kind="files"`` watches a directory of text files, or of parquet files when a schema
    is given. ``partitions`` spreads a small number of large inputs over more tasks.
    """
    if kind == "kafka":
        options = kafka_options(brokers, topics, max_offsets_per_trigger, starting_offsets)
        stream = (
            spark.readStream.format("kafka")
            .options(**options)
            .load()
            .selectExpr(
                "CAST(value AS STRING) AS value",
                "concat_ws('-', topic, partition, offset) AS row_id",
            )
        )
    elif kind == "files":
        reader = spark.readStream
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        if name_glob:
            reader = reader.option("pathGlobFilter", name_glob)
        stream = reader.text(path) if schema is None else reader.schema(schema).parquet(path)
    else:
        raise ValueError(f"unknown stream kind {kind!r}")
    return stream.repartition(partitions) if partitions else stream


def union_streams(sources: Mapping[str, DataFrame], label: str = "source") -> DataFrame:
    """Several streams as one, with the name of the stream a row came by.

    The parts are read by one query with one checkpoint, so their micro-batches go together and a
    restart goes on in each. Keep the names and their order from start to start: the checkpoint
    knows the parts by their places.
    """
    if not sources:
        raise ValueError("no stream given")
    parts = [df.withColumn(label, F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def spread(df: DataFrame, *columns: str, at_least: int | None = None) -> DataFrame:
    """Shuffle a scan only when fewer of its splits hold rows than there are cores.

    One small file is one task whatever the cluster size, and so is a large one that is a single row
    group: Spark cuts it into many splits, and the one with the group's middle gets all rows. A large
    input with rows in more splits than cores is left as it is. The splits are counted by a scan that
    reads no column. ``columns`` should identify a row.
    """
    wanted = at_least or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= wanted:
        filled = df.select(F.spark_partition_id().alias("split")).distinct().count()
        if filled >= wanted:
            return df
    return df.repartition(wanted, *columns)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """One ``value`` row per line of the text files under ``path``."""
    return spark.read.text(path)
