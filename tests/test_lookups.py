from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventstats import operators as op
from eventstats.operators.lookups import lookup_rules, salted_join
from tests.conftest import plan_of

DEVICES = [
    ("d1", "chan", "edm1", "11"),
    ("d2", "", None, ""),
    ("d3", "http://c.org/x", "edm3", "33"),
    ("", "never", "never", "never"),
    (None, "never", "never", "never"),
]
# uuid, origin_referer, spam, user_id -> origin_referer, spam, user_id
DEVICE_CASES = {
    ("d1", "", "", "5"): ("chan", "edm1", "5"),
    ("d1", "", "s", "x"): ("chan", "s", "11"),
    ("d1", "http://r.org/p", "", "-1"): ("r.org", "edm1", "11"),
    ("d1", " ", "", "5"): (" ", "edm1", "5"),
    ("d2", "", "", "x"): ("unknown", "unknown", "x"),
    ("d3", "", "", "5"): ("c.org", "edm3", "5"),
    ("d3", "http://r.org", "", "5"): ("http://r.org", "edm3", "5"),
    # no match: unknown device, empty key, or nothing to repair
    ("d9", "", " ", "x"): ("unknown", "unknown", "x"),
    ("d9", " ", "s", "x"): (" ", "s", "x"),
    ("", "http://r.org/p", "", "x"): ("r.org", "unknown", "x"),
    ("d1", "http://r.org/p", "s", "x"): ("r.org", "s", "x"),
    ("d1", None, None, "5"): ("chan", "edm1", "5"),
}


def devices(spark, **options):
    df = spark.createDataFrame(DEVICES, "uuid string, channel string, event string, uid string")
    return op.Dimension(df, "uuid", ["channel", "event", "uid"], **options)


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_enrich_device(spark, strategy):
    rows = [(i, *case) for i, case in enumerate(DEVICE_CASES)]
    df = spark.createDataFrame(
        rows, "id int, uuid string, origin_referer string, spam string, user_id string"
    )
    out = op.enrich_device(df, devices(spark), strategy=strategy)
    got = {r["id"]: (r["origin_referer"], r["spam"], r["user_id"]) for r in out.collect()}
    want = dict(enumerate(DEVICE_CASES.values()))
    # The referer ' ' is blank, so the no-match branch calls it unknown.
    want[list(DEVICE_CASES).index(("d9", " ", "s", "x"))] = ("unknown", "s", "x")
    assert got == want
    assert out.columns == df.columns


def test_enrich_user(spark):
    users = spark.createDataFrame(
        [("5", "2020-01-01 00:00:00"), ("6", None), ("-1", "x"), ("n", "x")],
        "id string, date_joined string",
    )
    df = spark.createDataFrame([("5",), ("6",), ("7",), ("-1",), ("n",), ("",)], "user_id string")
    out = op.enrich_user(df, op.Dimension(users, "id", ["date_joined"]))
    got = {r["user_id"]: r["date_joined"] for r in out.collect()}
    assert got == {"5": "2020-01-01 00:00:00", "6": "", "7": "", "-1": "", "n": "", "": ""}


def test_existence_flag(spark):
    course = "course_type string, course_status string, course_start string, course_end string"
    df = spark.createDataFrame(
        [("a", "0", "0", "2020-01-01 00:00:00", None), ("b", "0", "0", "2020-01-01 00:00:00", None),
         ("a", "1", "0", None, None), ("a", "", "", "", "")],
        "course_id string, " + course,
    )
    finished = op.Dimension(spark.createDataFrame([("a",), ("a",)], "course_id string"), "course_id")
    out = op.existence_flag(df, finished)
    got = [(r["course_exist_flag"], r["course_process"]) for r in out.collect()]
    assert got == [(1, 1), (0, 0), (1, 0), (1, -1)]


def test_one_row_per_key_and_renamed_columns(spark):
    dim = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", None)], "k string, v string")
    df = spark.createDataFrame([("a", "old"), ("b", "old"), ("c", "old")], "k string, v string")
    out = op.lookup_join(df, op.Dimension(dim, "k", ["v"]), "k", {"v": "w"}, defaults={"w": "none"})
    assert sorted((r["k"], r["v"], r["w"]) for r in out.collect()) == [
        ("a", "old", "2"), ("b", "old", None), ("c", "old", "none"),
    ]


def test_strategy_follows_the_measured_size(spark):
    df = spark.createDataFrame([("d1",)], "uuid string")
    small = op.lookup_join(df, devices(spark), "uuid", ["uid"])
    assert "BroadcastHashJoin" in plan_of(small)
    tight = devices(spark, broadcast_bytes=10)
    assert tight.size_bytes > 10
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = op.lookup_join(df, tight, "uuid", ["uid"])
        assert "SortMergeJoin" in plan_of(large)
        assert [r["uid"] for r in large.collect()] == ["11"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        op.lookup_join(df, tight, "uuid", ["uid"], strategy="broadcast")
    with pytest.raises(ValueError):
        op.lookup_join(df, tight, "uuid", ["uid"], strategy="guess")


def test_the_limit_holds_for_the_hash_table_not_only_for_its_rows(spark):
    table = spark.range(1000).selectExpr("concat('d', id) AS uuid", "concat('', id) AS uid")
    df = spark.range(2000).selectExpr("id", "concat('d', id) AS uuid")
    limit = op.Dimension(table, "uuid", ["uid"]).size_bytes
    dim = op.Dimension(table, "uuid", ["uid"], broadcast_bytes=limit)
    assert dim.held_bytes > limit
    by_size, by_name = (op.lookup_join(df, dim, "uuid", strategy=s) for s in ("auto", "broadcast"))
    assert "Broadcast" not in plan_of(by_size) and "BroadcastHashJoin" in plan_of(by_name)
    assert sorted(by_size.collect()) == sorted(by_name.collect())
    assert by_size.filter("uid IS NOT NULL").count() == 1000
    assert op.Dimension(table, "uuid", ["uid"], broadcast_bytes=dim.held_bytes).is_small()


def test_a_hot_key_is_spread_over_tasks(spark):
    """A third of the rows share one key and a third have none; no task gets either third."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        n = 9000
        df = spark.range(0, n, 1, 32).selectExpr(
            "id", "CASE id % 3 WHEN 0 THEN 'd1' WHEN 1 THEN '' ELSE concat('u', id) END AS uuid"
        )
        out = op.lookup_join(df, devices(spark), "uuid", ["uid"], strategy="shuffle")
        sizes = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in sizes) == n
        assert max(r["count"] for r in sizes) < n * 0.3
        assert out.filter("uid = '11'").count() == n // 3
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_join_matches_null_keys_only_when_asked(spark):
    left = spark.createDataFrame([(None,), ("a",)], "k string")
    right = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    joined = salted_join(left, right, ["k"], "left", 4)
    assert sorted(r["v"] for r in joined.collect()) == [1, 2]
    joined = salted_join(left, right, ["k"], "left", 4, nulls_match=False)
    assert {r["v"] for r in joined.collect()} == {None, 2}


def test_salted_join_sends_no_table_to_the_driver(spark, tmp_path):
    """The file looks small, and at run time the table is; its copies for the salts stay in a shuffle."""
    spark.range(500).selectExpr("concat('d', id) AS uuid", "concat('', id) AS uid").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    df = spark.range(2000).selectExpr("id", "CASE WHEN id % 5 > 0 THEN concat('d', id) END AS uuid")
    out = op.lookup_join(df, op.Dimension(table, "uuid", ["uid"], broadcast_bytes=0), "uuid")
    got = {r["id"]: r["uid"] for r in out.collect()}
    assert got == {i: str(i) if i < 500 and i % 5 else None for i in range(2000)}
    assert "SortMergeJoin" in plan_of(out) and "Broadcast" not in plan_of(out)


def test_rules_see_the_columns_set_before(spark):
    df = spark.createDataFrame([("d1",)], "uuid string")
    rules = [
        lambda found: {"a": found["uid"]},
        lambda found: {"b": F.concat("a", found["channel"])},
    ]
    assert lookup_rules(df, devices(spark), "uuid", rules).collect()[0]["b"] == "11chan"


def test_unused_lookups_leave_the_plan(spark):
    df = spark.createDataFrame([("d1", "5", "c")], "uuid string, user_id string, course_id string")
    users = op.Dimension(
        spark.createDataFrame([("5", "x")], "id string, date_joined string"), "id", ["date_joined"]
    )
    assert "Join" not in plan_of(op.enrich_user(df, users).select("course_id"))


def test_bucketed_table_is_not_shuffled(spark, tmp_path):
    """Two joins, one exchange of the events each; null, blank and unknown keys; a hot key is spread."""
    table = spark.createDataFrame([(f"k{i}", i) for i in range(500)] + [("k0", -1), (None, 3), ("", 4)], "k string, v int")
    dim = op.BucketedDimension(op.Dimension(table, "k", ["v"], broadcast_bytes=0), str(tmp_path / "t"), buckets=16, salts=4)
    rows = [("k7" if i % 3 == 0 else f"k{i % 700}" if i % 7 else None if i % 2 else "", i) for i in range(4000)]
    df = spark.createDataFrame(rows, "key string, n int").repartition(8)
    found = op.lookup_join(df, dim, "key", ["v"])  # "auto": too large to broadcast, so by buckets
    want = {f"k{i}": i for i in range(500)}
    assert sorted((r["n"], r["key"], r["v"]) for r in found.collect()) == sorted((n, k, want.get(k)) for k, n in rows)
    plan = plan_of(op.lookup_join(found, dim, "key", {"v": "w"}))
    assert plan.count("SortMergeJoin") == 2 and plan.count("Bucketed: true") == 2
    assert plan.count("hashpartitioning") == 2
    sizes = found.filter("key = 'k7'").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1
    dim.drop()
    with pytest.raises(ValueError):
        op.lookup_join(df, op.Dimension(table, "k", ["v"]), "key", strategy="bucketed")
