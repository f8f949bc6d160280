"""Flows and the plug-in surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventstats import operators as op
from eventstats.plans import Flow, apply_rows_in_batches, metrics, record_udf, run_step
from eventstats.plans.table_functions import register
from workload import inputs
from workload.oracle import sql
from workload.registry import query
from workload.stats import KPIS, kpi_sql, spec, stat_sql

_PLUGIN = {"type": "enhance", "method": "plugin"}


def kpi_flow(spark, sf_dir) -> Flow:
    """The shipped job as one flow: all prepare steps and all nine metrics."""
    known = metrics.specs(register_types=inputs.RULES.register_types)
    return Flow(
        {
            "format": [{"id": 1, **_PLUGIN, "fn": inputs.to_canonical}],
            "prepares": [
                {"id": 1, **_PLUGIN, "fn": op.enhance_time},
                {"id": 2, **_PLUGIN,
                 "fn": lambda df: op.flag_duplicates(df, ["user_id"], ["daily", "minutely"])},
                {"id": 10, **_PLUGIN, "fn": metrics.with_period},
                {"id": 3, **_PLUGIN,
                 "fn": lambda df: inputs.add_lookups(df, spark, sf_dir)},
            ],
            "sets": [
                {"id": 1, "computes": [
                    {"id": i, "type": "compute", "method": "spark-sql", "stat": stat}
                    for i, stat in enumerate(known.values(), 1)]}
            ],
        }
    )


_COURSE_DIMS = KPIS["enrol_visits"][1]


@query(
    "flow_full",
    sql("\nUNION ALL\n".join(kpi_sql(name, _COURSE_DIMS) for name in KPIS), "enriched"),
)
def flow_full(spark, sf_dir):
    flow = kpi_flow(spark, sf_dir)
    return flow.apply(inputs.tracking_json(spark, sf_dir)).drop("set_id")


@query(
    "flow_steps",
    sql(
        stat_sql("(SELECT * FROM tracking WHERE host <> 'h2' AND length(user_id) > 2)",
                 [("L2", "platform", ["platform"])], ["platform"], "activity", "visits"),
        "tracking",
    ),
)
def flow_steps(spark, sf_dir):
    """Filter, enhance and compute steps, by SQL and by function."""
    steps = [
        {"id": 1, "type": "filter", "method": "spark-sql", "where": "host <> 'h2'"},
        {"id": 2, "type": "filter", "method": "plugin",
         "fn": lambda df: df.filter(F.length("user_id") > 2)},
        {"id": 3, "type": "enhance", "method": "spark-sql",
         "select": ["user_id", "upper(platform) AS site", "platform"]},
        {"id": 4, "type": "compute", "method": "spark-sql", "stat": spec(["L2"]),
         "where": "site <> ''"},
    ]
    df = inputs.tracking(spark, sf_dir)
    for step in steps:
        df = run_step(df, step)
    return df


@query(
    "flow_disabled_step",
    sql(
        stat_sql("(SELECT * FROM tracking WHERE platform <> 'web')",
                 [("L1", "host", ["host"])], ["host"], "activity", "visits"),
        "tracking",
    ),
)
def flow_disabled_step(spark, sf_dir):
    """Disabled steps and sets do nothing; ids sort as numbers, so 10 runs after 2."""
    flow = Flow(
        {
            "format": [
                {"id": 2, **_PLUGIN, "fn": lambda df: df.limit(0)},
                {"id": 1, **_PLUGIN, "fn": inputs.to_canonical},
            ],
            "prepares": [
                {"id": 10, "type": "filter", "method": "spark-sql", "where": "place <> 'web'"},
                {"id": 2, "type": "enhance", "method": "spark-sql",
                 "select": ["*", "platform AS place"]},
                {"id": 1, **_PLUGIN, "fn": op.enhance_time},
                {"id": 3, "enabled": False, "type": "filter", "method": "spark-sql",
                 "where": "host = 'h0'"},
            ],
            "sets": [
                {"id": 1, "computes": [
                    {"id": 1, "type": "compute", "method": "spark-sql", "stat": spec(["L1"])},
                    {"id": 2, "enabled": False, "type": "compute", "method": "spark-sql",
                     "stat": spec(["L2"])}]},
                {"id": 2, "enabled": False, "computes": [
                    {"id": 1, "type": "compute", "method": "spark-sql", "stat": spec(["L2"])}]},
            ],
        }
    )
    return flow.apply(inputs.tracking_json(spark, sf_dir)).drop("set_id")


@query(
    "plugin_table",
    sql(
        """SELECT event_id, CASE WHEN spam = '' THEN 'direct' ELSE spam END AS spam
FROM tracking WHERE platform <> 'web'""",
        "tracking",
    ),
)
def plugin_table(spark, sf_dir):
    def direct(df):
        return df.withColumn("spam", F.when(F.col("spam") == "", "direct").otherwise(F.col("spam")))

    df = run_step(
        inputs.tracking(spark, sf_dir).filter("platform <> 'web'"), {"id": 1, **_PLUGIN, "fn": direct}
    )
    return df.select("event_id", "spam")


@query(
    "plugin_record_udf",
    sql("SELECT event_id, host || ':' || reverse(user_id) AS tag FROM tracking", "tracking"),
)
def plugin_record_udf(spark, sf_dir):
    tag = record_udf(lambda host, user_id: f"{host}:{user_id[::-1]}", "string")
    df = inputs.tracking(spark, sf_dir)
    return df.select("event_id", tag("host", "user_id").alias("tag"))


@query(
    "batched_partition_udf",
    sql(
        """SELECT event_id, CAST(length(user_id) AS BIGINT) AS size FROM tracking""",
        "tracking",
    ),
)
def batched_partition_udf(spark, sf_dir):
    def sizes(frame):
        return frame.assign(size=frame["user_id"].str.len())[["event_id", "size"]]

    df = inputs.tracking(spark, sf_dir).select("event_id", "user_id")
    return apply_rows_in_batches(df, sizes, "event_id bigint, size bigint", 50)


@query(
    "plugin_udtf",
    sql(
        """SELECT event_id, host, (row_number() OVER w - 1) // 50 AS group_no, (row_number() OVER w - 1) % 50 AS place
FROM tracking WINDOW w AS (PARTITION BY host ORDER BY event_id)""",
        "tracking",
    ),
)
def plugin_udtf(spark, sf_dir):
    """A flow step that calls a table function, which chooses its partitioning and order itself."""
    register(spark)
    step = {"id": 1, "type": "enhance", "method": "table-function", "name": "grouped_rows",
            "args": ["host", "event_id", 50]}
    return run_step(inputs.tracking(spark, sf_dir).select("event_id", "host"), step)
