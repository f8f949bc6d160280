"""Lookup joins and repeat detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventstats import operators as op
from eventstats.operators.dedup import drop_seen_in_adjacent_batch
from eventstats.operators.lookups import device_rule, lookup_rules
from eventstats.streaming import shared_dir
from workload import inputs
from workload.oracle import sql
from workload.registry import query


@query(
    "lookup_join",
    sql(
        """SELECT event_id, t.uuid, d.channel, d.uid AS device_user,
  CASE WHEN d.uuid IS NULL THEN 'none' ELSE d.event END AS event
FROM tracking t LEFT JOIN device_info d ON t.uuid = d.uuid AND t.uuid <> ''""",
        "tracking",
        "device_info",
    ),
)
def lookup_join(spark, sf_dir):
    df = inputs.tracking(spark, sf_dir).select("event_id", "uuid")
    return op.lookup_join(
        df,
        inputs.devices(spark, sf_dir),
        "uuid",
        {"channel": "channel", "event": "event", "uid": "device_user"},
        defaults={"event": "none"},
    )


@query(
    "lookup_join_conditional",
    sql(
        """SELECT event_id, d.channel FROM tracking t LEFT JOIN device_info d
  ON t.uuid = d.uuid AND t.uuid <> '' AND t.spam = '' AND t.platform <> 'iPad'""",
        "tracking",
        "device_info",
    ),
)
def lookup_join_conditional(spark, sf_dir):
    df = inputs.tracking(spark, sf_dir)
    joined = op.lookup_join(
        df,
        inputs.devices(spark, sf_dir),
        "uuid",
        ["channel"],
        condition=(F.col("spam") == "") & (F.col("platform") != "iPad"),
    )
    return joined.select("event_id", "channel")


@query(
    "enrich_device",
    sql("SELECT event_id, uuid, origin_referer, spam, user_id FROM with_device", "with_device"),
)
def enrich_device(spark, sf_dir):
    df = op.enrich_device(inputs.tracking(spark, sf_dir), inputs.devices(spark, sf_dir))
    return df.select("event_id", "uuid", "origin_referer", "spam", "user_id")


@query(
    "enrich_user",
    sql(
        """SELECT event_id, user_id, coalesce(date_joined, '') AS date_joined FROM tracking
LEFT JOIN auth_user ON user_id = id AND regexp_full_match(user_id, '[0-9]+')""",
        "tracking",
        "auth_user",
    ),
)
def enrich_user(spark, sf_dir):
    df = op.enrich_user(inputs.tracking(spark, sf_dir), inputs.users(spark, sf_dir))
    return df.select("event_id", "user_id", "date_joined")


_COURSE_COLUMNS = (
    "course_type", "course_owner", "course_status", "course_start", "course_end", "course_process"
)


@query(
    "enrich_course",
    sql(
        f"SELECT event_id, course_id, {', '.join(_COURSE_COLUMNS)} FROM enriched",
        "enriched",
    ),
)
def enrich_course(spark, sf_dir):
    df = op.enrich_course(
        inputs.tracking(spark, sf_dir), inputs.courses(spark, sf_dir), now=inputs.as_of()
    )
    return df.select("event_id", "course_id", *_COURSE_COLUMNS)


@query(
    "existence_flag",
    sql(
        """, finished AS (SELECT concat('course-', p_partkey) AS course_id FROM part
  WHERE p_partkey % 6 = 0)
SELECT event_id, t.course_id, CASE WHEN f.course_id IS NULL THEN 0 ELSE 1 END AS course_exist_flag,
  CASE WHEN c.course_type = '1' THEN CASE WHEN status = '-1' THEN 1 ELSE 0 END
       WHEN c.course_type = '0' THEN
         CASE WHEN status = '-1' OR "start" IS NULL OR "start" > '2024-02-15 00:00:00' THEN -1
              WHEN f.course_id IS NOT NULL OR "end" < '2024-02-15 00:00:00' THEN 1 ELSE 0 END
       ELSE -1 END AS course_process
FROM tracking t LEFT JOIN course_meta c ON t.course_id = c.course_id
LEFT JOIN finished f ON t.course_id = f.course_id""",
        "tracking",
        "course_meta",
    ),
)
def existence_flag(spark, sf_dir):
    df = op.enrich_course(
        inputs.tracking(spark, sf_dir), inputs.courses(spark, sf_dir), now=inputs.as_of()
    )
    finished = op.Dimension(inputs.finished_courses(spark, sf_dir), "course_id")
    flagged = op.existence_flag(df, finished, now=inputs.as_of())
    return flagged.select("event_id", "course_id", "course_exist_flag", "course_process")


@query(
    "lookup_chain",
    sql(
        """SELECT event_id, origin_referer, spam, user_id,
  CASE WHEN event_id % 6 < 4 AND d.uuid IS NOT NULL AND c THEN 1 ELSE 0 END AS known_device
FROM (SELECT w.*, (t.origin_referer = '' OR t.spam = '') AS c FROM with_device w
      JOIN tracking t USING (event_id)) x LEFT JOIN device_info d ON x.uuid = d.uuid""",
        "with_device",
    ),
)
def lookup_chain(spark, sf_dir):
    """Two rules over one device lookup."""
    df = inputs.tracking(spark, sf_dir)
    needed = (F.col("origin_referer") == "") | (F.col("spam") == "")
    chained = lookup_rules(
        df,
        inputs.devices(spark, sf_dir),
        "uuid",
        [lambda found: {"known_device": found.isNotNull().cast("int")}, device_rule],
        condition=needed,
    )
    return chained.select("event_id", "origin_referer", "spam", "user_id", "known_device")


@query(
    "lookup_broadcast_vs_shuffle",
    sql(
        """SELECT event_id, coalesce(date_joined, '') AS by_broadcast,
  coalesce(date_joined, '') AS by_shuffle FROM tracking
LEFT JOIN auth_user ON user_id = id AND regexp_full_match(user_id, '[0-9]+')""",
        "tracking",
        "auth_user",
    ),
)
def lookup_broadcast_vs_shuffle(spark, sf_dir):
    df = inputs.tracking(spark, sf_dir).select("event_id", "user_id")
    users = inputs.users(spark, sf_dir)
    small = op.enrich_user(df, users, strategy="broadcast").withColumnRenamed(
        "date_joined", "by_broadcast"
    )
    both = op.enrich_user(small, users, strategy="shuffle")
    return both.select("event_id", "by_broadcast", F.col("date_joined").alias("by_shuffle"))


@query(
    "lookup_bucketed",
    sql(
        """SELECT event_id, channel, coalesce(date_joined, '') AS date_joined FROM tracking t
LEFT JOIN auth_user ON user_id = id AND regexp_full_match(user_id, '[0-9]+')
LEFT JOIN device_info d ON t.uuid = d.uuid""",
        "tracking",
        "auth_user",
        "device_info",
    ),
)
def lookup_bucketed(spark, sf_dir):
    """Two tables bucketed and sorted once; their joins shuffle the events only."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    users, devices = (
        op.BucketedDimension(dim, shared_dir(spark, "lookup"), buckets)
        for dim in (inputs.users(spark, sf_dir), inputs.devices(spark, sf_dir))
    )
    df = inputs.tracking(spark, sf_dir).select("event_id", "user_id", "uuid")
    df = op.enrich_user(df, users, strategy="bucketed")
    df = op.lookup_join(df, devices, "uuid", ["channel"], strategy="bucketed")
    return df.select("event_id", "channel", "date_joined")


# --- repeats -------------------------------------------------------------------------------

_LENGTHS = {"minutely": 16, "hourly": 13, "daily": 10, "monthly": 7, "yearly": 4, "all": 0}


def _flag_sql(interval: str, keys: str = "user_id", blank: str = "user_id") -> str:
    return f"""CASE WHEN {blank} = '' OR row_number() OVER (PARTITION BY {keys},
  substr(time, 1, {_LENGTHS[interval]}) ORDER BY time, event_id) = 1 THEN 0 ELSE 1 END"""


@query(
    "dedup_flag_daily",
    sql(
        f"""SELECT event_id, user_id, {_flag_sql('daily')} AS user_id_daily_duplicate_flag
FROM tracking""",
        "tracking",
    ),
)
def dedup_flag_daily(spark, sf_dir):
    df = inputs.tracking(spark, sf_dir).select("event_id", "user_id", "time")
    return op.flag_duplicates(df).drop("time")


_FIVE = ("minutely", "hourly", "daily", "monthly", "yearly")


@query(
    "dedup_flag_intervals",
    sql(
        "SELECT event_id, "
        + ", ".join(f"{_flag_sql(i)} AS user_id_{i}_duplicate_flag" for i in _FIVE)
        + " FROM tracking",
        "tracking",
    ),
)
def dedup_flag_intervals(spark, sf_dir):
    df = inputs.tracking(spark, sf_dir).select("event_id", "user_id", "time")
    return op.flag_duplicates(df, intervals=_FIVE).drop("time", "user_id")


@query(
    "dedup_flag_all_time",
    sql(
        f"""SELECT event_id, {_flag_sql('all', 'uuid', 'uuid')} AS uuid_all_duplicate_flag
FROM tracking""",
        "tracking",
    ),
)
def dedup_flag_all_time(spark, sf_dir):
    df = inputs.tracking(spark, sf_dir).select("event_id", "uuid", "time")
    return op.flag_duplicates(df, ["uuid"], ["all"]).drop("time", "uuid")


@query(
    "dedup_flag_two_keys",
    sql(
        f"""SELECT event_id,
  {_flag_sql('daily', 'user_id, event_group')} AS user_id_event_group_daily_duplicate_flag,
  {_flag_sql('monthly', 'user_id, event_group')} AS user_id_event_group_monthly_duplicate_flag,
  {_flag_sql('hourly')} AS user_id_hourly_duplicate_flag
FROM tracking""",
        "tracking",
    ),
)
def dedup_flag_two_keys(spark, sf_dir):
    df = inputs.tracking(spark, sf_dir).select("event_id", "user_id", "event_group", "time")
    specs = [(["user_id", "event_group"], ["daily", "monthly"]), (["user_id"], ["hourly"])]
    return op.flag_specs(df, specs).drop("time", "user_id", "event_group")


@query(
    "dedup_blank_key",
    sql(
        """SELECT user_id_daily_duplicate_flag, user_id_minutely_duplicate_flag,
  count(*) AS n FROM flagged WHERE user_id = '' GROUP BY ALL""",
        "flagged",
    ),
)
def dedup_blank_key(spark, sf_dir):
    flags = ("user_id_daily_duplicate_flag", "user_id_minutely_duplicate_flag")
    blank = inputs.flagged(spark, sf_dir).filter(F.col("user_id") == "")
    return blank.groupBy(*flags).agg(F.count(F.lit(1)).alias("n"))


@query(
    "dedup_drop",
    sql(
        "SELECT event_id, user_id FROM flagged WHERE user_id_daily_duplicate_flag = 0", "flagged"
    ),
)
def dedup_drop(spark, sf_dir):
    df = inputs.tracking(spark, sf_dir).select("event_id", "user_id", "time")
    return op.drop_repeats(df).drop("time")


@query(
    "adjacent_batch_dedup",
    sql(
        """, b AS (SELECT *, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS batch FROM tracking)
SELECT event_id, uuid FROM b WHERE NOT EXISTS (SELECT 1 FROM b p
  WHERE p.batch = b.batch - 1 AND p.uuid = b.uuid)""",
        "tracking",
    ),
)
def adjacent_batch_dedup(spark, sf_dir):
    """Hours as batches: rows whose device was not seen in the hour before."""
    df = inputs.tracking(spark, sf_dir).select("event_id", "uuid", "time")
    hour = """datediff(to_date(substr(time, 1, 10)), DATE'1970-01-01') * 24L
      + CAST(substr(time, 12, 2) AS BIGINT)"""
    batches = df.withColumn("batch", F.expr(hour))
    return drop_seen_in_adjacent_batch(batches, "uuid", "batch").select("event_id", "uuid")


@query(
    "distinct_keys",
    sql("SELECT DISTINCT user_id, event_group FROM tracking", "tracking"),
)
def distinct_keys(spark, sf_dir):
    return inputs.tracking(spark, sf_dir).select("user_id", "event_group").distinct()
