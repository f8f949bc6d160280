"""Views over the test tables that have the shapes of the log and its lookup tables.

Whole tables, never samples. Remainders of ``event_id`` plant the edge cases: broken JSON,
invalid times, missing fields, unusable user ids.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventstats.operators import (
    Dimension,
    LogRules,
    enhance_time,
    enrich_course,
    enrich_device,
    enrich_user,
    flag_duplicates,
    format_log,
)
from eventstats.sources import read_dimension, spread

RULES = LogRules(
    platforms=(
        ("app android/", "android"),
        ("app androidTV/", "androidTV"),
        ("app IOS/", "iPhone"),
        ("app-iPad IOS/", "iPad"),
    ),
    register_types=("account.created",),
    enrollment_types=("course.enrollment.activated",),
)
AS_OF = "2024-02-15 00:00:00"

# 'yyyy-MM-ddTHH:mm:ss.SSSSSS' of a timestamp_ntz whatever the session time zone is.
ISO_TEXT = (
    "concat(substr(CAST(ts AS STRING), 1, 10), 'T', substr(CAST(ts AS STRING), 12, 8), '.', "
    "rpad(substr(CAST(ts AS STRING), 21), 6, '0'))"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_k(events: DataFrame) -> DataFrame:
    return events.selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_k(spread(table(spark, sf_dir, "events"), "event_id"))


def to_tracking_json(ev: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Events as raw log lines, with columns to carry along; works on a batch and on a stream."""
    lines = ev.selectExpr(
        "event_id",
        *keep,
        f"""to_json(named_struct(
        'uid', CAST(user_id AS STRING),
        'time', CASE WHEN event_id % 50 = 7 THEN 'bad-time' ELSE concat({ISO_TEXT}, '+00:00') END,
        'username', concat('user', user_id),
        'uuid', CASE WHEN event_id % 6 < 4 THEN concat('dev-', user_id) ELSE '' END,
        'event_type', CASE event_type WHEN 'signup' THEN 'account.created'
                        WHEN 'purchase' THEN 'course.enrollment.activated'
                        WHEN 'view' THEN concat('/courses/course-', k, '/courseware/w1')
                        ELSE concat('page.', event_type) END,
        'agent', CASE event_id % 6 WHEN 0 THEN 'app android/2.1' WHEN 1 THEN 'app androidTV/1.0'
                   WHEN 2 THEN 'app IOS/3.0' WHEN 3 THEN 'app-iPad IOS/3.0'
                   WHEN 4 THEN 'Mozilla/5.0' ELSE NULL END,
        'origin_referer', CASE event_id % 4 WHEN 0 THEN ''
                   WHEN 1 THEN concat('http://ref', k % 5, '.example.org/p/', k)
                   WHEN 2 THEN concat('https://ref', k % 5, '.example.org') ELSE NULL END,
        'spam', CASE WHEN event_id % 3 = 0 THEN concat('edm', k % 4) ELSE '' END,
        'host', concat('h', event_id % 3),
        'event', named_struct(
           'uid', CASE event_id % 7 WHEN 0 THEN '-1' WHEN 1 THEN concat('!dev-', user_id)
                    WHEN 2 THEN '' ELSE CAST(user_id AS STRING) END,
           'uuid', CASE WHEN event_id % 14 = 2 THEN concat('dev-', user_id) END,
           'username', CASE WHEN event_id % 7 = 0 THEN concat('user', user_id) END,
           'course_id', CASE WHEN event_type IN ('view', 'purchase') THEN concat('course-', k) END),
        'context', named_struct(
           'user_id', CASE WHEN event_id % 7 = 1 THEN CAST(user_id AS STRING)
                           WHEN event_id % 14 = 0 THEN '-1' END,
           'course_id', CASE WHEN event_type = 'click' THEN concat('course-', k) END)
        )) AS js""",
    )
    return lines.selectExpr(
        "event_id",
        *keep,
        "CASE WHEN event_id % 97 = 0 THEN substr(js, 1, 20) ELSE js END AS value",
    )


def tracking_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_tracking_json(events(spark, sf_dir))


def to_canonical(lines: DataFrame) -> DataFrame:
    return format_log(lines, RULES, keep=["event_id"])


def to_tracking(lines: DataFrame, intervals=(1,)) -> DataFrame:
    """Log lines -> canonical events with normalised time and bucket columns."""
    return enhance_time(to_canonical(lines), intervals=intervals)


def tracking(spark: SparkSession, sf_dir: str, intervals=(1,)) -> DataFrame:
    return to_tracking(tracking_json(spark, sf_dir), intervals)


def device_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_dimension(
        spark,
        f"{sf_dir}/customer.parquet",
        "c_custkey",
        [],
        computed={
            "uuid": "concat('dev-', c_custkey)",
            "channel": "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE lower(c_mktsegment) END",
            "event": "CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('edm', c_custkey % 5) END",
            "uid": "concat('', c_custkey)",
        },
    ).drop("c_custkey")


def auth_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_dimension(
        spark,
        f"{sf_dir}/customer.parquet",
        "c_custkey",
        [],
        computed={
            "id": "concat('', c_custkey)",
            "date_joined": "concat('2024-01-', lpad(concat('', 1 + c_custkey % 30), 2, '0'), "
            "' 08:00:00')",
        },
    ).drop("c_custkey")


def course_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    def day(missing: int, day_of_month: int) -> str:
        return (
            f"CASE WHEN p_partkey % {missing} = 0 THEN NULL ELSE "
            f"concat('2024-0', 1 + p_partkey % 3, '-{day_of_month} 00:00:00') END"
        )

    return read_dimension(
        spark,
        f"{sf_dir}/part.parquet",
        "p_partkey",
        [],
        computed={
            "course_id": "concat('course-', p_partkey)",
            "course_type": "concat('', p_size % 3)",
            "owner": "p_brand",
            "status": "CASE WHEN p_partkey % 4 = 0 THEN '-1' ELSE '0' END",
            "start": day(11, 10),
            "end": day(10, 25),
        },
    ).drop("p_partkey")


def finished_courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").filter("p_partkey % 6 = 0")
    return parts.selectExpr("concat('course-', p_partkey) AS course_id")


def new_devices(spark: SparkSession, sf_dir: str) -> Dimension:
    """The device table as it is now, not measured yet."""
    return Dimension(device_info(spark, sf_dir), "uuid", ["channel", "event", "uid"])


devices = lru_cache(new_devices)


@lru_cache
def users(spark: SparkSession, sf_dir: str) -> Dimension:
    return Dimension(auth_user(spark, sf_dir), "id", ["date_joined"])


@lru_cache
def courses(spark: SparkSession, sf_dir: str) -> Dimension:
    return Dimension(
        course_meta(spark, sf_dir), "course_id", ["course_type", "owner", "status", "start", "end"]
    )


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def add_lookups(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device, user and course columns."""
    df = enrich_device(df, devices(spark, sf_dir))
    df = enrich_user(df, users(spark, sf_dir))
    return enrich_course(df, courses(spark, sf_dir), now=as_of())


def flagged(spark: SparkSession, sf_dir: str, intervals=("daily", "minutely")) -> DataFrame:
    return flag_duplicates(tracking(spark, sf_dir), ["user_id"], intervals)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything the metrics need: time buckets, repeat flags, lookups."""
    return add_lookups(flagged(spark, sf_dir), spark, sf_dir)
