"""Counting over dimension lists, and the shipped metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventstats import functions as fn
from eventstats import operators as op
from eventstats.operators import StatSpec, statistics
from eventstats.plans import Flow, metrics
from workload import inputs
from workload.oracle import sql, stat_sql
from workload.registry import query

LABELS = {
    "L0": "NONE",
    "L1": "host",
    "L2": "platform",
    "L3.1": "origin_referer",
    "L3.2": "spam",
    "T1": "start_date",
    "T2": "end_date",
}
TIMES = ["start_date", "end_date"]


def spec(targets, aggs=("user_id:count",), **other) -> StatSpec:
    names = {"data_type": "activity", "value_type": "visits", "cycle": "minute_1", **other}
    return StatSpec(labels=LABELS, targets=targets, aggs=list(aggs), **names)


def timed(spark, sf_dir):
    return metrics.with_period(inputs.tracking(spark, sf_dir))


_TIMED = """(SELECT *, substr(time, 1, 16) || ':00' AS start_date,
  substr(time, 1, 16) || ':59' AS end_date FROM tracking)"""


@query(
    "count_by_dims",
    sql(stat_sql("tracking", [("L1,L2", "host,platform", ["host", "platform"])],
                 ["host", "platform"], "activity", "visits"), "tracking"),
)
def count_by_dims(spark, sf_dir):
    return statistics(inputs.tracking(spark, sf_dir), spec(["L1:L2"]))


@query(
    "count_distinct_by_dims",
    sql(
        stat_sql(
            "tracking",
            [("L1,L2", "host,platform", ["host", "platform"]), ("L2", "platform", ["platform"])],
            ["host", "platform"], "activity", "visits",
            value="count(DISTINCT user_id)", agg="user_id:countDistinct",
        ),
        "tracking",
    ),
)
def count_distinct_by_dims(spark, sf_dir):
    return statistics(
        inputs.tracking(spark, sf_dir), spec(["L1:L2", "L2"], ["user_id:countDistinct"])
    )


@query("approx_distinct_by_dims")
def approx_distinct_by_dims(spark, sf_dir):
    return statistics(
        inputs.tracking(spark, sf_dir), spec(["L2", "L1"], ["user_id:approxCountDistinct"])
    )


@query(
    "approx_distinct_error",
    sql(
        """SELECT platform, 'near' AS estimate FROM tracking GROUP BY platform
UNION ALL SELECT host, 'near' FROM tracking GROUP BY host""",
        "tracking",
    ),
)
def approx_distinct_error(spark, sf_dir):
    """Per group, whether the estimate is within four standard errors of the exact count."""
    rows = inputs.tracking(spark, sf_dir)
    counts = [
        statistics(rows, spec(["L2", "L1"], [f"user_id:{method}"])).select(
            F.coalesce("platform", "host").alias("platform"), F.col("value").alias(method)
        )
        for method in ("countDistinct", "approxCountDistinct")
    ]
    limit = 4 * spec(["L1"]).rsd * F.col("countDistinct")
    near = F.abs(F.col("countDistinct") - F.col("approxCountDistinct")) <= limit
    return counts[0].join(counts[1], "platform").select(
        "platform", F.when(near, "near").otherwise("far").alias("estimate")
    )


@query(
    "count_global",
    sql(stat_sql("tracking", [("NONE", "NONE", [])], [], "activity", "visits"), "tracking"),
)
def count_global(spark, sf_dir):
    return statistics(inputs.tracking(spark, sf_dir), spec(["NONE"]))


@query(
    "count_distinct_global",
    sql(
        stat_sql("tracking", [("L0", "NONE", [])], [], "activity", "visits",
                 value="count(DISTINCT user_id)", agg="user_id:countDistinct"),
        "tracking",
    ),
)
def count_distinct_global(spark, sf_dir):
    return statistics(inputs.tracking(spark, sf_dir), spec(["L0"], ["user_id:countDistinct"]))


@query(
    "sum_by_dims",
    """SELECT o_orderstatus, CAST(NULL AS VARCHAR) AS o_orderpriority,
  CAST(sum(l_linenumber) AS BIGINT) AS "value", 'S' AS "key", 'o_orderstatus' AS "keyName",
  'lines' AS data_type, 'sum' AS value_type, 'total' AS "cycle", 'l_linenumber:sum' AS agg
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderstatus
UNION ALL SELECT NULL, o_orderpriority, CAST(sum(l_linenumber) AS BIGINT), 'P',
  'o_orderpriority', 'lines', 'sum', 'total', 'l_linenumber:sum'
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority""",
)
def sum_by_dims(spark, sf_dir):
    lines = inputs.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    orders = inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority"
    )
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return statistics(
        joined,
        StatSpec({"S": "o_orderstatus", "P": "o_orderpriority"}, ["S", "P"], ["l_linenumber:sum"],
                 "lines", "sum", "total"),
    )


_DIMS = ["host", "platform", "origin_referer", "spam", "start_date", "end_date"]
_SETS = [
    ("L0", "NONE", TIMES),
    ("L1", "host", ["host", *TIMES]),
    ("L2", "platform", ["platform", *TIMES]),
    ("L3.1", "origin_referer", ["origin_referer", *TIMES]),
    ("L3.2", "spam", ["spam", *TIMES]),
]
_TARGETS = ["L0:T1:T2", "L1:T1:T2", "L2:T1:T2", "L3.1:T1:T2", "L3.2:T1:T2"]


@query(
    "stats_grouping_sets",
    sql(stat_sql(_TIMED, _SETS, _DIMS, "activity", "visits"), "tracking"),
)
def stats_grouping_sets(spark, sf_dir):
    return statistics(timed(spark, sf_dir), spec(_TARGETS, excludes=["T1", "T2"]))


_TWO = [("L1", "host", ["host"]), ("L2", "platform", ["platform"])]


@query(
    "stats_multi_agg",
    sql(
        stat_sql("tracking", _TWO, ["host", "platform"], "activity", "visits")
        + "\nUNION ALL\n"
        + stat_sql("tracking", _TWO, ["host", "platform"], "activity", "visits",
                   value="count(DISTINCT uuid)", agg="uuid:countDistinct"),
        "tracking",
    ),
)
def stats_multi_agg(spark, sf_dir):
    return statistics(
        inputs.tracking(spark, sf_dir), spec(["L1", "L2"], ["user_id:count", "uuid:countDistinct"])
    )


@query(
    "stats_overrides",
    sql(
        stat_sql("tracking", [("L1", "host", ["host"])], ["host", "platform"],
                 "activity", "visits")
        + "\nUNION ALL\n"
        + stat_sql("tracking", [("L2", "platform", ["platform"])], ["host", "platform"],
                   "new_account", "users", "total")
        + "\nUNION ALL\n"
        + stat_sql("tracking", [("L2", "platform", ["platform"])], ["host", "platform"],
                   "activity", "visits"),
        "tracking",
    ),
)
def stats_overrides(spark, sf_dir):
    """Two targets share one grouping set under different names."""
    return statistics(
        inputs.tracking(spark, sf_dir), spec(["L1", "L2#new_account#users#total", "L2"])
    )


@query(
    "stats_annotated",
    sql(
        stat_sql(
            _TIMED,
            [("L2", "platform", ["platform", *TIMES]), ("L0", "NONE", TIMES), ("L0", "NONE", [])],
            ["platform", *TIMES], "activity", "visits",
        ),
        "tracking",
    ),
)
def stats_annotated(spark, sf_dir):
    """Labels left out of the names; a target left without labels is called L0 / NONE."""
    return statistics(
        timed(spark, sf_dir), spec(["L2:T1:T2", "T1:T2", "L0"], excludes=["T1", "T2"])
    )


@query(
    "stats_plugin",
    sql(
        """SELECT platform, CAST(count(*) AS BIGINT) AS "value",
  CAST(count(DISTINCT user_id) AS BIGINT) AS users, 1 AS set_id FROM tracking GROUP BY platform""",
        "tracking",
    ),
)
def stats_plugin(spark, sf_dir):
    """A compute step given by the caller's own function."""

    def own(df):
        return df.groupBy("platform").agg(
            F.count(F.lit(1)).alias("value"), F.count_distinct("user_id").alias("users")
        )

    step = {"id": 1, "type": "compute", "method": "plugin", "fn": own}
    flow = Flow({"sets": [{"id": 1, "computes": [step]}]})
    return flow.apply(inputs.tracking(spark, sf_dir))


@query(
    "union_stats",
    sql(
        stat_sql("tracking", [("L1", "host", ["host"])], ["host", "platform"],
                 "activity", "visits")
        + "\nUNION ALL\n"
        + stat_sql("tracking", [("L2", "platform", ["platform"])], ["host", "platform"],
                   "devices", "users", value="count(DISTINCT uuid)", agg="uuid:countDistinct"),
        "tracking",
    ),
)
def union_stats(spark, sf_dir):
    df = inputs.tracking(spark, sf_dir)
    visits = statistics(df, spec(["L1"]))
    devices = statistics(
        df, spec(["L2"], ["uuid:countDistinct"], data_type="devices", value_type="users")
    )
    return visits.unionByName(devices, allowMissingColumns=True)


# --- metrics -------------------------------------------------------------------------------

_DAY = "user_id_daily_duplicate_flag = 0"
_MINUTE = "user_id_minutely_duplicate_flag = 0"
_LOGIN = "substr(time, 1, 10) <> substr(date_joined, 1, 10)"
_COURSEWARE = "event_type LIKE '/courses/%/courseware/%'"
_VISIT_SETS = _SETS[:3] + [
    ("L3.2.1", "origin_referer", ["origin_referer", *TIMES]),
    ("L3.2.2", "spam", ["spam", *TIMES]),
]
_COURSE_SETS = _VISIT_SETS + [
    ("L5", "course_type", ["course_type", *TIMES]),
    ("L6", "course_process", ["course_process", *TIMES]),
    ("L7", "course_id", ["course_id", *TIMES]),
]
_COURSE_DIMS = [*_DIMS, "course_type", "course_process", "course_id"]

KPIS = {
    "new_accounts": (_SETS, _DIMS, "create_account", "users",
                     f"event_type = 'account.created' AND {_DAY}"),
    "login_visits": (_VISIT_SETS, _DIMS, "login_account", "visits", _LOGIN),
    "login_users": (_VISIT_SETS, _DIMS, "login_account", "users", f"{_LOGIN} AND {_MINUTE}"),
    "active_visits": (_VISIT_SETS, _DIMS, "active_account", "visits", "TRUE"),
    "active_users": (_VISIT_SETS, _DIMS, "active_account", "users", _MINUTE),
    "enrol_visits": (_COURSE_SETS, _COURSE_DIMS, "enrollment_state", "visits", "TRUE"),
    "enrol_users": (_COURSE_SETS, _COURSE_DIMS, "enrollment_state", "users", _MINUTE),
    "courseware_visits": (_VISIT_SETS, _DIMS, "access_courseware", "visits", _COURSEWARE),
    "courseware_users": (_VISIT_SETS, _DIMS, "access_courseware", "users",
                         f"{_COURSEWARE} AND {_MINUTE}"),
}


def kpi_sql(name: str, dims: list[str] | None = None) -> str:
    sets, own_dims, data_type, value_type, where = KPIS[name]
    return stat_sql("enriched", sets, dims or own_dims, data_type, value_type, where=where)


def _register_kpi(name: str) -> None:
    @query(f"kpi_{name}", sql(kpi_sql(name), "enriched"))
    def kpi(spark, sf_dir):
        return metrics.compute(
            inputs.enriched(spark, sf_dir), name, register_types=inputs.RULES.register_types
        )


for _name in KPIS:
    _register_kpi(_name)


@query(
    "kpi_all",
    sql("\nUNION ALL\n".join(kpi_sql(name, _COURSE_DIMS) for name in KPIS), "enriched"),
)
def kpi_all(spark, sf_dir):
    """The nine metrics over one scan and one shuffle of the enriched events."""
    return metrics.compute(
        inputs.enriched(spark, sf_dir), register_types=inputs.RULES.register_types
    )


_SAMPLE = """(SELECT t.*, CAST(e.user_id AS VARCHAR) AS uid, t.time_minute_1_start AS start_date,
  t.time_minute_1_end AS end_date FROM with_device t JOIN events e USING (event_id)
  WHERE t.event_type = 'account.created' AND event_id % 7 NOT IN (1, 2))"""


@query(
    "kpi_xml_sample",
    sql(
        stat_sql(_SAMPLE, [("NONE", "NONE", []), ("L2", "platform", ["platform", *TIMES])],
                 ["platform", *TIMES, "origin_referer"], "create_account", "visits",
                 value="count(uid)", agg="uid:count")
        + "\nUNION ALL\n"
        + stat_sql(_SAMPLE, [("L3.1", "origin_referer", ["origin_referer", *TIMES])],
                   ["platform", *TIMES, "origin_referer"], "new_account", "users", "minute1",
                   value="count(uid)", agg="uid:count"),
        "with_device",
    ),
)
def kpi_xml_sample(spark, sf_dir):
    """New accounts with a usable id: filter, platform, time and device steps, then counts."""
    fields = (
        "time string, uid string, uuid string, event struct<uid string>, event_type string, "
        "agent string, origin_referer string, spam string"
    )
    plugin = {"type": "enhance", "method": "plugin"}
    stat = StatSpec(
        LABELS,
        ["NONE", "L2:T1:T2", "L3.1:T1:T2#new_account#users#minute1"],
        ["uid:count"],
        "create_account",
        "visits",
        "minute_1",
        excludes=["T1", "T2"],
    )
    devices = inputs.devices(spark, sf_dir)
    flow = Flow(
        {
            "sets": [
                {
                    "id": 1,
                    "prepares": [
                        {"id": 1, "type": "filter", "method": "spark-sql",
                         "select": ["event_id", f"inline(array(from_json(value, '{fields}')))"],
                         "where": "substr(event.uid, 1, 1) <> '!' AND event.uid <> '' "
                         "AND event_type IN ('account.created')"},
                        {"id": 2, "type": "filter", "method": "spark-sql",
                         "select": ["event_id", "time", "uid", "uuid", "event_type", "agent",
                                    "origin_referer", "spam"]},
                        {"id": 3, **plugin,
                         "fn": lambda df: op.rename_replace(
                             df, "agent", "platform",
                             lambda a: fn.platform_of(a, inputs.RULES.platforms))},
                        {"id": 4, **plugin,
                         "fn": lambda df: metrics.with_period(op.enhance_time(df))},
                        {"id": 5, **plugin,
                         "fn": lambda df: op.enrich_device(
                             df.withColumn("user_id", F.col("uid")), devices)},
                    ],
                    "computes": [
                        {"id": 7, "type": "compute", "method": "spark-sql", "stat": stat}
                    ],
                }
            ]
        }
    )
    return flow.apply(inputs.tracking_json(spark, sf_dir)).drop("set_id")
