from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F, types as T

from eventstats import operators as op
from eventstats import sources
from eventstats.sinks import elasticsearch_options, jdbc_options
from tests.conftest import plan_of

RULES = op.LogRules(platforms=(("app/", "phone"),))


def lines(spark, *documents):
    texts = [d if isinstance(d, str) or d is None else json.dumps(d) for d in documents]
    return spark.createDataFrame(list(enumerate(texts)), "id int, value string")


def rows_of(df):
    return {r["id"]: r for r in df.collect()}


def test_format_log_edge_cases(spark):
    df = lines(
        spark,
        {"uid": 5, "event": {"uid": 7, "username": "a"}, "agent": "app/1", "time": "t"},
        {"uid": "5", "event": "text", "username": "top", "context": {"user_id": "9"}},
        {"event": None, "origin_referer": None, "spam": None, "context": {"course_id": "c"}},
        {},
        '{"uid": "5", "ev',
        "",
        None,
        "not json",
    )
    got = rows_of(op.format_log(df, RULES, keep=["id"]))
    assert sorted(got) == [0, 1, 2, 3]
    assert (got[0]["user_id"], got[0]["username"], got[0]["platform"]) == ("7", "a", "phone")
    assert (got[1]["user_id"], got[1]["username"]) == ("9", "top")
    assert (got[2]["origin_referer"], got[2]["spam"], got[2]["course_id"]) == ("", "", "c")
    assert set(got[3].asDict().values()) == {3, "", "web", "unknown"}


def test_format_log_keeps_malformed_rows_on_request(spark):
    df = lines(spark, {"uid": 5}, "not json", {"event": "text"})
    got = rows_of(op.format_log(df, RULES, keep=["id"], on_error="keep"))
    assert {i: r["is_malformed"] for i, r in got.items()} == {0: False, 1: True, 2: False}
    assert [r["id"] for r in op.malformed_rows(df).collect()] == [1]
    with pytest.raises(ValueError):
        op.format_log(df, RULES, on_error="guess")


def test_format_log_strict_ids(spark):
    df = lines(
        spark,
        {"event": {"uid": 7}},
        {"event": {"uid": "7", "username": "n"}},
        {"event": {"uid": -1}, "context": {"user_id": 0}, "uid": 3},
        {"event": {"uuid": "e"}, "uuid": "top"},
    )
    got = rows_of(
        op.format_log(df, RULES, keep=["id"], user_id_policy="strict", uuid_from_event=True)
    )
    assert [got[i]["user_id"] for i in range(4)] == ["7", "n", "3", "e"]
    assert got[3]["uuid"] == "e"
    plain = rows_of(op.format_log(df, RULES, keep=["id"]))
    assert plain[3]["uuid"] == "top"


def test_format_log_basic(spark):
    df = lines(
        spark,
        {"event": {"uid": 7}},
        {"event": {"uid": -1, "user_id": 4}},
        {"event": {"uid": "x", "user_id": None}},
    )
    got = rows_of(op.format_log_basic(df, keep=["id"]))
    assert [got[i]["user_id"] for i in range(3)] == [7, 4, None]


def test_a_line_is_parsed_once(spark):
    df = lines(spark, {"uid": 5})
    canonical = op.enhance_time(op.format_log(df, RULES, keep=["id"])).filter("host = 'a'")
    plan = plan_of(canonical)
    assert plan.count("from_json") == 1
    assert plan.count("unix_seconds(") == 1


def test_enhance_time_drops_and_buckets(spark):
    df = spark.createDataFrame(
        [(1, "2015-09-22T16:01:01+00:00"), (2, "x"), (3, None)], "id int, time string"
    )
    got = op.enhance_time(df, intervals=(1, 30)).collect()
    assert [r.asDict() for r in got] == [
        {
            "id": 1,
            "time": "2015-09-23 00:01:01",
            "time_minute_1_start": "2015-09-23 00:01:00",
            "time_minute_1_end": "2015-09-23 00:01:59",
            "time_minute_30_start": "2015-09-23 00:00:00",
            "time_minute_30_end": "2015-09-23 00:29:59",
        }
    ]


def test_label_times_keeps_other_labels(spark):
    df = spark.createDataFrame(
        [("2015-09-23 00:01:01", {"a": "1", "time_minute_1_end": "old"}), ("2015-09-23 00:01:01", None)],
        "time string, labels map<string,string>",
    )
    got = [r["labels"] for r in op.label_times(df).collect()]
    times = {
        "time_minute_1_start": "2015-09-23 00:01:00",
        "time_minute_1_end": "2015-09-23 00:01:59",
    }
    assert got == [{"a": "1", **times}, times]


def test_column_edits(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    assert op.rename_replace(df, "x", "z", F.upper).collect()[0].asDict() == {"z": "A", "y": "b"}
    assert op.update_field(df, "q", F.lit(1)).columns == ["x", "y"]
    assert op.remove_fields(df, "x", "q").columns == ["y"]
    assert op.add_fields(df, {"x": F.lit(1), "w": F.lit(2)}).collect()[0].asDict() == {
        "x": 1, "y": "b", "w": 2,
    }
    assert op.select_then_where(df).collect() == df.collect()
    assert op.select_then_where(df, ["x AS z"], "z = 'b'").count() == 0


def test_evolve(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    got = op.evolve(df, add=["n:long", "x:integer", "a"], remove=["y", "none"])
    assert got.dtypes == [("a", "string"), ("n", "bigint"), ("x", "string")]
    assert got.collect()[0].asDict() == {"a": None, "n": None, "x": "a"}


def test_schema_from_string():
    schema = sources.schema_from_string("b, a:long, d: decimal", map_fields=["labels"])
    assert schema == T.StructType(
        [
            T.StructField("a", T.LongType()),
            T.StructField("b", T.StringType()),
            T.StructField("d", T.DecimalType(10, 0)),
            T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        ]
    )
    with pytest.raises(ValueError):
        sources.schema_from_string("a:number")
    with pytest.raises(ValueError):
        sources.schema_from_string("labels", map_fields=["labels"])


def test_json_tables(spark, tmp_path):
    path = str(tmp_path / "lines")
    lines(spark, {"a": 1, "b": {"c": "x"}}, "broken {").select("value").write.text(path)
    table = sources.json_to_table(spark, path)
    assert table.dtypes == [("a", "bigint"), ("b", "struct<c:string>")]
    assert sorted(r["a"] or 0 for r in table.collect()) == [0, 1]
    declared = sources.table_from_json(sources.read_json_lines(spark, path), "a:long, z")
    assert declared.dtypes == [("a", "bigint"), ("z", "string")]


def test_source_and_sink_options(spark):
    assert sources.kafka_options("h:1", ["a", " b"], 100) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "a,b",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "100",
    }
    assert jdbc_options("jdbc:x", "t", "drv", fetchsize="5") == {
        "url": "jdbc:x", "dbtable": "t", "batchsize": "1000", "fetchsize": "5", "driver": "drv",
    }
    assert elasticsearch_options("n", "i/t")["es.write.operation"] == "upsert"
    with pytest.raises(ValueError):
        sources.read_log_stream(spark, kind="socket")


def test_spread_only_widens_small_inputs(spark):
    one = spark.range(0, 100, 1, 1)
    assert sources.spread(one, "id").rdd.getNumPartitions() == 8
    many = spark.range(0, 100, 1, 20)
    assert "Exchange" not in plan_of(sources.spread(many, "id"))


def test_spread_sees_splits_without_rows(spark, tmp_path):
    """One row group in many splits is one task's work."""
    spark.range(5000).coalesce(1).write.option("compression", "none").parquet(str(tmp_path / "one"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        one = spark.read.parquet(str(tmp_path / "one"))
        assert one.rdd.getNumPartitions() >= 8
        rows = sources.spread(one, "id")
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 5000 and len(sizes) == 8 and max(sizes) < 1000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
