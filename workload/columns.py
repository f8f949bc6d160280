"""Sources, projections, filters, column edits and log formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventstats import functions as fn
from eventstats import operators as op
from eventstats import sources
from eventstats.streaming import shared_dir
from workload import inputs
from workload.oracle import CANONICAL, sql
from workload.registry import query

# --- sources -----------------------------------------------------------------------------


def _write_lines(spark, sf_dir) -> str:
    path = shared_dir(spark, "lines")
    inputs.tracking_json(spark, sf_dir).select("value").write.text(path)
    return path


_LINE_FIELDS = """CASE WHEN event_id % 97 <> 0 THEN CAST(user_id AS VARCHAR) END AS uid,
  CASE WHEN event_id % 97 <> 0 THEN 'h' || (event_id % 3) END AS host,
  CASE WHEN event_id % 97 <> 0 AND event_type IN ('view', 'purchase')
       THEN 'course-' || k END AS course_id"""


@query(
    "read_json_lines",
    sql(f"SELECT {_LINE_FIELDS}, count(*) AS n FROM ev GROUP BY ALL", "ev"),
)
def read_json_lines(spark, sf_dir):
    lines = sources.read_json_lines(spark, _write_lines(spark, sf_dir))
    fields = [
        fn.json_path(F.col("value"), path).alias(name)
        for name, path in (("uid", "$.uid"), ("host", "$.host"), ("course_id", "$.event.course_id"))
    ]
    return lines.groupBy(*fields).agg(F.count(F.lit(1)).alias("n"))


@query(
    "union_inputs",
    sql(f"""SELECT CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS input,
  {_LINE_FIELDS}, count(*) AS n FROM ev GROUP BY ALL""", "ev"),
)
def union_inputs(spark, sf_dir):
    """Two inputs of lines, each in a folder of its own, read as one."""
    lines = inputs.tracking_json(spark, sf_dir)
    path = shared_dir(spark, "two-inputs")
    halves = F.when(F.col("event_id") % 2 == 0, "even").otherwise("odd").alias("input")
    lines.select(halves, "value").write.partitionBy("input").text(path)
    parts = [
        sources.read_json_lines(spark, f"{path}/input={name}").withColumn("input", F.lit(name))
        for name in ("even", "odd")
    ]
    fields = [
        fn.json_path(F.col("value"), p).alias(name)
        for name, p in (("uid", "$.uid"), ("host", "$.host"), ("course_id", "$.event.course_id"))
    ]
    return parts[0].unionByName(parts[1]).groupBy("input", *fields).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "json_to_table",
    sql(f"SELECT {_LINE_FIELDS}, count(*) AS n FROM ev GROUP BY ALL", "ev"),
)
def json_to_table(spark, sf_dir):
    table = sources.json_to_table(spark, _write_lines(spark, sf_dir))
    return table.groupBy("uid", "host", F.col("event.course_id").alias("course_id")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "declared_schema",
    sql(
        """SELECT CASE WHEN event_id % 97 <> 0 THEN 'user' || user_id END AS username,
  CASE WHEN event_id % 97 <> 0 THEN CAST(user_id AS BIGINT) END AS uid,
  CAST(NULL AS VARCHAR) AS absent, count(*) AS n FROM ev GROUP BY ALL""",
        "ev",
    ),
)
def declared_schema(spark, sf_dir):
    lines = inputs.tracking_json(spark, sf_dir)
    bare = lines.select(F.regexp_replace("value", r'^\{"uid":"([0-9]+)"', r'{"uid":$1').alias("value"))
    table = sources.table_from_json(bare, "username, uid:long, absent")
    return table.groupBy("absent", "uid", "username").agg(F.count(F.lit(1)).alias("n"))


@query("dimension_scan", sql("SELECT uuid, channel, event, uid FROM device_info", "device_info"))
def dimension_scan(spark, sf_dir):
    return inputs.device_info(spark, sf_dir).select("uuid", "channel", "event", "uid")


# --- projections and filters ---------------------------------------------------------------


@query(
    "select_expr",
    sql("SELECT event_id, upper(host) AS site, length(user_id) AS size FROM tracking", "tracking"),
)
def select_expr(spark, sf_dir):
    return op.select_then_where(
        inputs.tracking(spark, sf_dir),
        ["event_id", "upper(host) AS site", "CAST(length(user_id) AS BIGINT) AS size"],
    )


@query(
    "where_expr",
    sql(
        """SELECT event_id, platform FROM tracking
WHERE platform <> 'web' AND course_id <> ''""",
        "tracking",
    ),
)
def where_expr(spark, sf_dir):
    df = op.select_then_where(
        inputs.tracking(spark, sf_dir), where="platform <> 'web' AND course_id <> ''"
    )
    return df.select("event_id", "platform")


@query(
    "select_then_where",
    sql(
        """SELECT event_id, substr(time, 1, 10) AS day, host || '/' || platform AS place
FROM tracking WHERE substr(time, 1, 10) >= '2024-01-10' AND host || '/' || platform <> 'h1/web'""",
        "tracking",
    ),
)
def select_then_where(spark, sf_dir):
    return op.select_then_where(
        inputs.tracking(spark, sf_dir),
        ["event_id", "substr(time, 1, 10) AS day", "concat(host, '/', platform) AS place"],
        "day >= '2024-01-10' AND place <> 'h1/web'",
    )


@query(
    "pred_in_list",
    sql(
        """SELECT event_id, event_type FROM tracking
WHERE event_type IN ('account.created', 'page.click') AND host = 'h1'""",
        "tracking",
    ),
)
def pred_in_list(spark, sf_dir):
    return op.select_then_where(
        inputs.tracking(spark, sf_dir),
        ["event_id", "event_type", "host"],
        "event_type IN ('account.created', 'page.click') AND host = 'h1'",
    ).drop("host")


@query(
    "pred_like",
    sql(
        """SELECT event_id, event_type FROM tracking
WHERE event_type LIKE '/courses/%/courseware/%'""",
        "tracking",
    ),
)
def pred_like(spark, sf_dir):
    return op.select_then_where(
        inputs.tracking(spark, sf_dir),
        ["event_id", "event_type"],
        "event_type LIKE '/courses/%/courseware/%'",
    )


@query(
    "pred_prefix_not",
    sql(
        """SELECT event_id, user_id FROM tracking
WHERE substr(user_id, 1, 1) <> 'u' AND user_id <> ''""",
        "tracking",
    ),
)
def pred_prefix_not(spark, sf_dir):
    return op.select_then_where(
        inputs.tracking(spark, sf_dir),
        ["event_id", "user_id"],
        "substr(user_id, 1, 1) <> 'u' AND user_id <> ''",
    )


@query(
    "add_fields",
    sql(
        """SELECT event_id, 'H' || host AS host, substr(time, 1, 7) AS month FROM tracking""",
        "tracking",
    ),
)
def add_fields(spark, sf_dir):
    df = inputs.tracking(spark, sf_dir).select("event_id", "host", "time")
    return op.add_fields(
        df,
        {"host": F.concat(F.lit("H"), "host"), "month": F.substring("time", 1, 7)},
    ).drop("time")


@query(
    "update_field",
    sql("SELECT event_id, coalesce(nullif(spam, ''), 'none') AS spam FROM tracking", "tracking"),
)
def update_field(spark, sf_dir):
    df = inputs.tracking(spark, sf_dir).select("event_id", "spam")
    df = op.update_field(df, "spam", fn.blank_default(F.col("spam"), "none"))
    return op.update_field(df, "not_there", F.lit(1))


@query(
    "rename_replace_field",
    sql(
        """SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'android' WHEN 1 THEN 'androidTV'
  WHEN 2 THEN 'iPhone' WHEN 3 THEN 'iPad' ELSE 'web' END AS platform
FROM events WHERE event_id % 97 <> 0""",
    ),
)
def rename_replace_field(spark, sf_dir):
    basic = op.format_log_basic(inputs.tracking_json(spark, sf_dir), keep=["event_id"])
    return op.rename_replace(
        basic.select("event_id", "agent"),
        "agent",
        "platform",
        lambda agent: fn.platform_of(agent, inputs.RULES.platforms),
    )


@query(
    "remove_field",
    sql("SELECT event_id, user_id, host FROM tracking", "tracking"),
)
def remove_field(spark, sf_dir):
    df = inputs.tracking(spark, sf_dir).select("event_id", "user_id", "host", "spam", "time")
    return op.remove_fields(df, "spam", "time", "not_there")


@query(
    "evolve_schema",
    sql(
        """SELECT event_id, host, CAST(NULL AS BIGINT) AS visits, CAST(NULL AS VARCHAR) AS note
FROM tracking""",
        "tracking",
    ),
)
def evolve_schema(spark, sf_dir):
    df = inputs.tracking(spark, sf_dir).select("event_id", "host", "spam", "time")
    return op.evolve(df, add=["visits:long", "note", "host:integer"], remove=["spam", "time"])


@query(
    "map_labels",
    sql(
        """SELECT event_id, platform AS seen_on, substr(time, 1, 16) || ':00' AS m1_start,
  substr(time, 1, 16) || ':59' AS m1_end,
  substr(time, 1, 14) || CASE WHEN substr(time, 15, 2) < '30' THEN '00:00' ELSE '30:00' END AS m30_start,
  substr(time, 1, 14) || CASE WHEN substr(time, 15, 2) < '30' THEN '29:59' ELSE '59:59' END AS m30_end
FROM tracking""",
        "tracking",
    ),
)
def map_labels(spark, sf_dir):
    df = inputs.tracking(spark, sf_dir).withColumn(
        "labels", F.create_map(F.lit("seen_on"), F.col("platform"))
    )
    labels = op.label_times(df, intervals=(1, 30))
    return labels.select(
        "event_id",
        F.col("labels")["seen_on"].alias("seen_on"),
        F.col("labels")["time_minute_1_start"].alias("m1_start"),
        F.col("labels")["time_minute_1_end"].alias("m1_end"),
        F.col("labels")["time_minute_30_start"].alias("m30_start"),
        F.col("labels")["time_minute_30_end"].alias("m30_end"),
    )


# --- log formats ---------------------------------------------------------------------------


@query("format_log", sql(f"SELECT {CANONICAL}, event_group FROM tracking", "tracking"))
def format_log(spark, sf_dir):
    df = inputs.to_canonical(inputs.tracking_json(spark, sf_dir))
    return op.enhance_time(df).drop("time_minute_1_start", "time_minute_1_end")


@query("format_log_no_group", sql(f"SELECT {CANONICAL} FROM tracking", "tracking"))
def format_log_no_group(spark, sf_dir):
    rules = op.LogRules(inputs.RULES.platforms, event_groups=False)
    df = op.format_log(inputs.tracking_json(spark, sf_dir), rules, keep=["event_id"])
    return op.enhance_time(df).drop("time_minute_1_start", "time_minute_1_end")


@query(
    "format_log_basic",
    sql(
        """SELECT event_id, CASE WHEN event_id % 7 NOT IN (0, 1, 2) AND user_id > 0
  THEN CAST(user_id AS INT) END AS user_id, 'user' || user_id AS username,
  CASE event_id % 6 WHEN 0 THEN 'app android/2.1' WHEN 1 THEN 'app androidTV/1.0'
  WHEN 2 THEN 'app IOS/3.0' WHEN 3 THEN 'app-iPad IOS/3.0' WHEN 4 THEN 'Mozilla/5.0'
  ELSE '' END AS agent, 'h' || (event_id % 3) AS host FROM ev WHERE event_id % 97 <> 0""",
        "ev",
    ),
)
def format_log_basic(spark, sf_dir):
    basic = op.format_log_basic(inputs.tracking_json(spark, sf_dir), keep=["event_id"])
    return basic.select("event_id", "user_id", "username", "agent", "host")


_STRICT_NAME = """CASE WHEN event_id % 7 = 0 THEN 'user' || user_id
  WHEN event_id % 14 = 2 THEN 'dev-' || user_id ELSE '' END"""


@query(
    "format_log_strict_uid",
    sql(
        f"""SELECT event_id, CASE WHEN user_id NOT IN (0, -1) THEN CAST(user_id AS VARCHAR)
  ELSE {_STRICT_NAME} END AS numbers, {_STRICT_NAME} AS texts,
  CASE WHEN event_id % 14 = 2 OR event_id % 6 < 4 THEN 'dev-' || user_id ELSE '' END AS uuid
FROM ev WHERE event_id % 97 <> 0""",
        "ev",
    ),
)
def format_log_strict_uid(spark, sf_dir):
    """Quoted ids never count; the same lines with bare numbers do.

    Both forms of a line are formatted in one pass and meet again by partial aggregation.
    """
    bare = F.regexp_replace("value", r'"(uid|user_id)":"(-?[0-9]+)"', '"$1":$2')
    forms = F.array(
        F.struct(F.lit(True).alias("bare"), bare.alias("value")),
        F.struct(F.lit(False).alias("bare"), F.col("value")),
    )
    lines = inputs.tracking_json(spark, sf_dir).select("event_id", F.inline(forms))
    rows = op.format_log(
        lines, inputs.RULES, keep=["event_id", "bare"], user_id_policy="strict", uuid_from_event=True
    )
    return rows.groupBy("event_id").agg(
        F.max(F.when(F.col("bare"), F.col("user_id"))).alias("numbers"),
        F.max(F.when(~F.col("bare"), F.col("user_id"))).alias("texts"),
        F.max(F.when(F.col("bare"), F.col("uuid"))).alias("uuid"),
    )


@query("resolve_user_id", sql("SELECT event_id, user_id FROM tracking", "tracking"))
def resolve_user_id(spark, sf_dir):
    paths = ("$.event.uid", "$.context.user_id", "$.event.username", "$.event.uuid")
    parts = [fn.json_path(F.col("value"), path) for path in paths]
    return (
        inputs.tracking_json(spark, sf_dir)
        .filter(fn.normalize_time(fn.json_path(F.col("value"), "$.time")).isNotNull())
        .select("event_id", fn.resolve_user_id(*parts).alias("user_id"))
    )


@query(
    "platform_of",
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'android' WHEN 1 THEN 'androidTV'
  WHEN 2 THEN 'iPhone' WHEN 3 THEN 'iPad' ELSE 'web' END AS platform FROM events""",
)
def platform_of(spark, sf_dir):
    ev = inputs.table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """CASE event_id % 6 WHEN 0 THEN 'app android/2.1' WHEN 1 THEN 'app androidTV/1.0'
          WHEN 2 THEN 'app IOS/3.0' WHEN 3 THEN 'app-iPad IOS/3.0'
          WHEN 4 THEN concat('Mozilla app android/', user_id) END AS agent""",
    )
    return ev.select(
        "event_id", fn.platform_of(F.col("agent"), inputs.RULES.platforms).alias("platform")
    )


@query(
    "event_group",
    sql("SELECT event_group, event_type, count(*) AS n FROM tracking GROUP BY ALL", "tracking"),
)
def event_group(spark, sf_dir):
    rules = inputs.RULES
    group = fn.event_group(F.col("event_type"), rules.register_types, rules.enrollment_types)
    df = inputs.tracking(spark, sf_dir).groupBy(group.alias("event_group"), "event_type")
    return df.agg(F.count(F.lit(1)).alias("n"))


@query("malformed_rows", "SELECT event_id FROM events WHERE event_id % 97 = 0")
def malformed_rows(spark, sf_dir):
    return op.malformed_rows(inputs.tracking_json(spark, sf_dir)).select("event_id")
