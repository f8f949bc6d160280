"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventstats import functions as fn
from workload import inputs
from workload.oracle import sql
from workload.registry import query

# The same instant written in eight ways; every row is valid.
_SPARK_TIMES = f"""CASE event_id % 8
  WHEN 0 THEN concat({inputs.ISO_TEXT}, '+00:00')
  WHEN 1 THEN concat({inputs.ISO_TEXT}, '+00')
  WHEN 2 THEN concat(substr({inputs.ISO_TEXT}, 1, 19), 'Z')
  WHEN 3 THEN replace(substr({inputs.ISO_TEXT}, 1, 19), 'T', ' ')
  WHEN 4 THEN {inputs.ISO_TEXT}
  WHEN 5 THEN concat({inputs.ISO_TEXT}, '-05:30')
  WHEN 6 THEN concat(substr({inputs.ISO_TEXT}, 1, 23), '+0800')
  ELSE concat('"', substr({inputs.ISO_TEXT}, 1, 19), '+09:00"') END"""
_SHIFTS = """CASE event_id % 8 WHEN 0 THEN 480 WHEN 1 THEN 480 WHEN 2 THEN 480 WHEN 3 THEN 0
  WHEN 4 THEN 0 WHEN 5 THEN 810 WHEN 6 THEN 0 ELSE -60 END"""


@query(
    "normalize_time",
    f"""SELECT event_id,
  strftime(ts + ({_SHIFTS}) * INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS cst FROM events""",
)
def normalize_time(spark, sf_dir):
    ev = inputs.table(spark, sf_dir, "events").selectExpr("event_id", f"{_SPARK_TIMES} AS t")
    return ev.select("event_id", fn.normalize_time(F.col("t")).alias("cst"))


@query(
    "normalize_time_invalid",
    """SELECT event_id, CASE WHEN event_id % 8 = 7 THEN 1 ELSE 0 END AS valid FROM events""",
)
def normalize_time_invalid(spark, sf_dir):
    text = f"""CASE event_id % 8 WHEN 0 THEN 'bad-time' WHEN 1 THEN '' WHEN 2 THEN NULL
      WHEN 3 THEN substr({inputs.ISO_TEXT}, 1, 10) WHEN 4 THEN concat({inputs.ISO_TEXT}, '+')
      WHEN 5 THEN concat('2024-13', substr({inputs.ISO_TEXT}, 8))
      WHEN 6 THEN concat('on ', {inputs.ISO_TEXT}) ELSE {inputs.ISO_TEXT} END"""
    ev = inputs.table(spark, sf_dir, "events").selectExpr("event_id", f"{text} AS t")
    return ev.select(
        "event_id", fn.normalize_time(F.col("t")).isNotNull().cast("int").alias("valid")
    )


def _bucket_sql(n: int) -> str:
    start = f"time_bucket(INTERVAL {n} MINUTE, ts + INTERVAL 8 HOUR)"
    end = f"({start} + INTERVAL {n} MINUTE - INTERVAL 1 SECOND)"
    fmt = "'%Y-%m-%d %H:%M:%S'"
    return f"strftime({start}, {fmt}) AS m{n}_start, strftime({end}, {fmt}) AS m{n}_end"


@query(
    "time_bucket",
    sql(f"SELECT event_id, {', '.join(_bucket_sql(n) for n in (1, 5, 10, 30))} FROM tracking",
        "tracking"),
)
def time_bucket(spark, sf_dir):
    df = inputs.tracking(spark, sf_dir, intervals=(1, 5, 10, 30))
    return df.select(
        "event_id",
        *[
            F.col(f"time_minute_{n}_{end}").alias(f"m{n}_{end}")
            for n in (1, 5, 10, 30)
            for end in ("start", "end")
        ],
    )


@query(
    "bucket_key",
    sql(
        """SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y%m%d%H%M') AS minutely,
  strftime(ts + INTERVAL 8 HOUR, '%Y%m%d%H') AS hourly,
  strftime(ts + INTERVAL 8 HOUR, '%Y%m%d') AS daily,
  strftime(ts + INTERVAL 8 HOUR, '%Y%m') AS monthly,
  strftime(ts + INTERVAL 8 HOUR, '%Y') AS yearly FROM tracking""",
        "tracking",
    ),
)
def bucket_key(spark, sf_dir):
    labels = ("minutely", "hourly", "daily", "monthly", "yearly")
    return inputs.tracking(spark, sf_dir).select(
        "event_id", *[fn.bucket_key(F.col("time"), i).alias(i) for i in labels]
    )


@query(
    "time_millis",
    sql(
        """SELECT event_id, CAST(epoch_ms(date_trunc('second', ts)) AS BIGINT) AS ms, time AS text,
  strftime(ts + INTERVAL 8 HOUR, '%Y%m%d_%H%M') AS compact FROM tracking""",
        "tracking",
    ),
)
def time_millis(spark, sf_dir):
    df = inputs.tracking(spark, sf_dir).select(
        "event_id", fn.text_to_millis(F.col("time")).alias("ms")
    )
    return df.select(
        "event_id",
        "ms",
        fn.millis_to_text(F.col("ms")).alias("text"),
        fn.millis_to_text(F.col("ms"), "yyyyMMdd_HHmm").alias("compact"),
    )


@query(
    "url_domain",
    r"""SELECT page_id, CASE WHEN regexp_full_match(url, 'http(s?)://(.*?)/.*')
  THEN regexp_extract(url, '^https?://(.*?)/.*$', 1) ELSE url END AS domain FROM pages""",
)
def url_domain(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages")
    return pages.select("page_id", fn.url_domain(F.col("url")).alias("domain"))


@query(
    "is_int32",
    """SELECT event_id, CASE WHEN event_id % 8 IN (0, 6) THEN 1 ELSE 0 END AS ok FROM events""",
)
def is_int32(spark, sf_dir):
    text = """CASE event_id % 8 WHEN 0 THEN CAST(user_id AS STRING)
      WHEN 1 THEN concat('!dev-', user_id) WHEN 2 THEN '' WHEN 3 THEN concat(' ', user_id, ' ')
      WHEN 4 THEN concat(user_id, '.0') WHEN 5 THEN concat('99999999999', user_id)
      WHEN 6 THEN concat('-', user_id) ELSE NULL END"""
    ev = inputs.table(spark, sf_dir, "events").selectExpr("event_id", f"{text} AS t")
    return ev.select("event_id", fn.is_int32(F.col("t")).cast("int").alias("ok"))


@query(
    "blank_default",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type ELSE 'unknown' END AS v
FROM events""",
)
def blank_default(spark, sf_dir):
    text = "CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN '' WHEN 2 THEN '  ' END"
    ev = inputs.table(spark, sf_dir, "events").selectExpr("event_id", f"{text} AS t")
    return ev.select("event_id", fn.blank_default(F.col("t"), "unknown").alias("v"))


@query(
    "strip_quotes",
    """SELECT event_id, CASE event_id % 3 WHEN 2 THEN '"' || event_type ELSE event_type END AS v
FROM events""",
)
def strip_quotes(spark, sf_dir):
    text = """CASE event_id % 3 WHEN 0 THEN concat('"', event_type, '"') WHEN 1 THEN event_type
      ELSE concat('""', event_type, '"') END"""
    ev = inputs.table(spark, sf_dir, "events").selectExpr("event_id", f"{text} AS t")
    return ev.select("event_id", fn.strip_quotes(F.col("t")).alias("v"))


@query("course_process", sql("SELECT course_id, process FROM course_state", "course_state"))
def course_process(spark, sf_dir):
    process = fn.course_process(
        F.col("course_type"), F.col("status"), F.col("start"), F.col("end"), inputs.as_of()
    )
    return inputs.course_meta(spark, sf_dir).select("course_id", process.alias("process"))


@query(
    "doc_id",
    sql(
        """SELECT md5('{"host":"' || host || '","platform":"' || platform || '","spam":"' || spam
  || '"}') AS id, count(*) AS n FROM tracking GROUP BY ALL""",
        "tracking",
    ),
)
def doc_id(spark, sf_dir):
    groups = inputs.to_canonical(inputs.tracking_json(spark, sf_dir))
    groups = inputs.enhance_time(groups).groupBy("platform", "host", "spam").count()
    return groups.select(fn.doc_id("spam", "host", "platform").alias("id"), F.col("count").alias("n"))


@query(
    "typed_cast",
    sql(
        """SELECT event_id, k AS as_int, k AS as_interger, CAST(k AS BIGINT) AS as_long,
  CAST(k * 4 AS BIGINT) AS quadruple, CAST(k AS VARCHAR) AS as_text FROM ev""",
        "ev",
    ),
)
def typed_cast(spark, sf_dir):
    text = F.col("k").cast("string")
    return inputs.events(spark, sf_dir).select(
        "event_id",
        fn.typed_cast(text, "int").alias("as_int"),
        fn.typed_cast(text, "interger").alias("as_interger"),
        fn.typed_cast(text, "long").alias("as_long"),
        (fn.typed_cast(F.concat(text, F.lit(".0")), "double") * 4).cast("bigint").alias("quadruple"),
        fn.typed_cast(text, "other").alias("as_text"),
    )


def _round_half_up(unit: int, places: int) -> str:
    scaled = (
        f"CAST(floor(CAST(CAST(CAST(ms AS FLOAT) / CAST({unit} AS FLOAT) AS FLOAT) AS DOUBLE) "
        f"* {10 ** places} + 0.5) AS BIGINT)"
    )
    return (
        f"({scaled} // {10 ** places}) || '.' || "
        f"lpad(CAST({scaled} % {10 ** places} AS VARCHAR), {places}, '0')"
    )


@query(
    "duration_text",
    f"""SELECT event_id, CASE WHEN ms < 1000 THEN ms || ' ms'
  WHEN ms < 60000 THEN {_round_half_up(1000, 1)} || ' s'
  WHEN ms < 3600000 THEN {_round_half_up(60000, 1)} || ' m'
  ELSE {_round_half_up(3600000, 2)} || ' h' END AS v
FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_id % 1000
  WHEN 1 THEN 1000 + (event_id * 37) % 59000 WHEN 2 THEN 60000 + (event_id * 7919) % 3540000
  ELSE 3600000 + (event_id * 104729) % 90000000 END AS ms FROM events)""",
)
def duration_text(spark, sf_dir):
    ev = inputs.table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """CASE event_id % 4 WHEN 0 THEN event_id % 1000
          WHEN 1 THEN 1000 + (event_id * 37) % 59000 WHEN 2 THEN 60000 + (event_id * 7919) % 3540000
          ELSE 3600000 + (event_id * 104729) % 90000000 END AS ms""",
    )
    return ev.select("event_id", fn.duration_text(F.col("ms")).alias("v"))


@query(
    "json_path",
    sql(
        """SELECT event_id, CAST(k AS VARCHAR) AS k, CASE WHEN event_id % 97 <> 0
  AND event_type IN ('view', 'purchase') THEN 'course-' || k END AS course_id FROM ev""",
        "ev",
    ),
)
def json_path(spark, sf_dir):
    lines = inputs.to_tracking_json(inputs.events(spark, sf_dir), keep=("props",))
    return lines.select(
        "event_id",
        fn.json_path(F.col("props"), "$.k").alias("k"),
        fn.json_path(F.col("value"), "$.event.course_id").alias("course_id"),
    )


@query(
    "shift_hours",
    """SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS cst FROM events""",
)
def shift_hours(spark, sf_dir):
    ev = inputs.table(spark, sf_dir, "events")
    shifted = fn.shift_hours(F.col("ts"), 8).cast("string")
    return ev.select("event_id", F.substring(shifted, 1, 19).alias("cst"))
