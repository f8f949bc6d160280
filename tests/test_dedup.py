from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from eventstats import operators as op
from eventstats.functions import BUCKET_WIDTHS
from eventstats.operators.dedup import (
    drop_seen_in_adjacent_batch,
    drop_seen_in_previous_batch,
)
from tests.conftest import plan_of

SCHEMA = "event_id bigint, user_id string, kind string, time string"


def sample(n=2000, seed=1):
    """Random events; a third of them belong to one user and some have no user."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = rng.choice(["hot", "", None, f"u{rng.randrange(20)}", f"u{rng.randrange(200)}"])
        if i % 3 == 0:
            user = "hot"
        day, hour, minute = rng.randrange(1, 4), rng.randrange(3), rng.randrange(4)
        time = f"2024-0{rng.choice([1, 2])}-0{day} 0{hour}:0{minute}:0{rng.randrange(3)}"
        rows.append((i, user, rng.choice(["a", "b", None]), time))
    return rows


def brute_force(rows, keys, interval):
    at = {"event_id": 0, "user_id": 1, "kind": 2, "time": 3}
    seen, flags = set(), {}
    for row in sorted(rows, key=lambda r: (r[3], r[0])):
        key = tuple(row[at[k]] for k in keys)
        if not key[0]:
            flags[row[0]] = 0
            continue
        bucket = (key, row[3][: BUCKET_WIDTHS[interval]])
        flags[row[0]] = int(bucket in seen)
        seen.add(bucket)
    return flags


@pytest.fixture(scope="module")
def rows():
    return sample()


@pytest.fixture(scope="module")
def events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(8, "event_id").persist()


@pytest.mark.parametrize(
    "keys, intervals",
    [
        (["user_id"], ["daily"]),
        (["user_id"], ["yearly", "minutely", "hourly", "daily", "monthly", "all"]),
        (["user_id", "kind"], ["all"]),
        (["user_id", "kind"], ["daily", "hourly"]),
    ],
)
def test_flags_equal_brute_force(events, rows, keys, intervals):
    out = op.flag_duplicates(events, keys, intervals).collect()
    assert len(out) == len(rows)
    for interval in intervals:
        name = op.flag_name(keys, interval)
        assert {r["event_id"]: r[name] for r in out} == brute_force(rows, keys, interval)


def test_flags_without_ids(spark, events, rows):
    """Ties may go either way, so compare how many first rows each key and bucket has."""
    intervals = ["minutely", "daily", "all"]
    copies = events.drop("event_id", "kind").unionByName(events.drop("event_id", "kind"))
    out = op.flag_duplicates(copies, ["user_id"], intervals, tiebreak=None)
    assert out.count() == 2 * len(rows)
    for interval in intervals:
        name = op.flag_name(["user_id"], interval)
        bucket = F.substring("time", 1, BUCKET_WIDTHS[interval])
        named = out.filter("user_id <> ''")
        firsts = named.groupBy("user_id", bucket).agg(F.sum(1 - F.col(name)).alias("n"))
        assert firsts.filter("n <> 1").count() == 0
        late = named.groupBy("user_id", bucket).agg(
            F.min(F.when(F.col(name) == 0, F.col("time"))).alias("first"), F.min("time").alias("min")
        )
        assert late.filter("first <> min").count() == 0
    blank = out.filter("coalesce(user_id, '') = ''")
    assert blank.filter("user_id_daily_duplicate_flag <> 0").count() == 0


def test_independent_specs(events, rows):
    out = op.flag_specs(events, [(["user_id", "kind"], ["daily"]), (["user_id"], ["daily"])])
    got = {r["event_id"]: r["user_id_daily_duplicate_flag"] for r in out.collect()}
    assert got == brute_force(rows, ["user_id"], "daily")


def test_drop_repeats(events, rows):
    kept = {r["event_id"] for r in op.drop_repeats(events, ["user_id"], "hourly").collect()}
    flags = brute_force(rows, ["user_id"], "hourly")
    assert kept == {i for i, flag in flags.items() if flag == 0}


def test_no_task_gets_a_hot_key(spark, events, rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        flagged = op.flag_duplicates(events)
        sizes = flagged.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < len(rows) * 0.25
        assert "Join" not in plan_of(flagged)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unknown_interval(events):
    with pytest.raises(ValueError):
        op.flag_duplicates(events, intervals=["weekly"])


def test_unused_flags_leave_the_plan(events):
    plan = plan_of(op.flag_duplicates(events).select("event_id"))
    assert "Window" not in plan and "hashpartitioning(user_id" not in plan


def test_flags_evaluate_their_input_once(events):
    parsed = events.withColumn("kind", F.from_json(F.col("kind"), "a string")["a"])
    specs = [(["user_id", "kind"], ["daily", "all"]), (["user_id"], ["hourly"])]
    plan = plan_of(op.flag_specs(parsed, specs))
    assert plan.count("from_json") == 1 and "Join" not in plan


def test_ties_without_ids_and_maps(spark):
    """Rows alike but for a map are told apart; blank and null keys are never repeats."""
    rows = [("u", "2024-01-01 00:00:00", {"a": str(i)}) for i in range(5)]
    rows += [("", "2024-01-01 00:00:00", None), (None, None, None), ("v", None, None), ("v", None, {})]
    df = spark.createDataFrame(rows, "user_id string, time string, labels map<string,string>")
    out = op.flag_duplicates(df, ["user_id"], ["daily", "minutely"], tiebreak=None).collect()
    flags = sorted((r["user_id"] or "", r["user_id_daily_duplicate_flag"]) for r in out)
    assert flags == [("", 0), ("", 0), ("u", 0), *[("u", 1)] * 4, ("v", 0), ("v", 1)]
    assert all(r["user_id_daily_duplicate_flag"] == r["user_id_minutely_duplicate_flag"] for r in out)


def test_previous_batch(spark):
    batch = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    before = spark.createDataFrame([("A",), ("A",), ("x",)], "k string")
    kept = drop_seen_in_previous_batch(batch, before, "upper(k)")
    assert sorted(r["v"] for r in kept.collect()) == [3, 4]
    with_null = before.unionByName(spark.createDataFrame([(None,)], "k string"))
    kept = drop_seen_in_previous_batch(batch, with_null, "upper(k)")
    assert [r["v"] for r in kept.collect()] == [3]
    assert kept.columns == ["k", "v"]


def test_adjacent_batches_equal_brute_force(events, rows):
    batches = events.withColumn("batch", F.substring("time", 16, 1).cast("int"))
    kept = drop_seen_in_adjacent_batch(batches, "user_id", "batch").collect()
    keys = {}
    for row in rows:
        keys.setdefault(int(row[3][15]), set()).add(row[1])
    want = {r[0] for r in rows if r[1] not in keys.get(int(r[3][15]) - 1, set())}
    assert {r["event_id"] for r in kept} == want


def test_keys_of_the_batch_before_are_not_sent_to_the_driver(spark):
    batches = spark.range(600).selectExpr("id", "concat('u', id % 7) AS user_id", "id div 5 AS batch")
    kept = drop_seen_in_adjacent_batch(batches, "user_id", "batch")
    want = {i for i in range(600) if i < 5 or not any(j % 7 == i % 7 for j in range(i // 5 * 5 - 5, i // 5 * 5))}
    assert {r["id"] for r in kept.collect()} == want
    assert "SortMergeJoin" in plan_of(kept) and "Broadcast" not in plan_of(kept)
