"""Additive, multi-field and routed sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventstats import functions as fn
from eventstats.operators import statistics
from eventstats.plans import metrics
from eventstats.sinks import (
    BatchTable,
    BulkFiles,
    DistinctTable,
    TallyTable,
    forward_changed,
    print_rows,
    read_bulk_files,
    read_routed,
    typed_values,
    write_routed,
)
from eventstats.streaming import shared_dir
from workload import inputs
from workload.oracle import sql, stat_sql
from workload.registry import query
from workload.stats import spec

_SETS = [("L1", "host", ["host"]), ("L2", "platform", ["platform"])]
_COUNTS = stat_sql("tracking", _SETS, ["host", "platform"], "activity", "visits")


# The month of events in three parts, as ranges that the scan can skip files by.
THIRDS = (
    "ts < TIMESTAMP_NTZ'2024-01-11'",
    "ts >= TIMESTAMP_NTZ'2024-01-11' AND ts < TIMESTAMP_NTZ'2024-01-21'",
    "ts >= TIMESTAMP_NTZ'2024-01-21'",
)


def _third(spark, sf_dir, part: str, targets=("L1", "L2")):
    """Counts of the events of some days; the days are chosen before anything is parsed."""
    events = inputs.with_k(inputs.table(spark, sf_dir, "events").filter(part))
    return statistics(inputs.to_tracking(inputs.to_tracking_json(events)), spec(list(targets)))


def _add_thirds(spark, sf_dir, tally: TallyTable, replay: bool = False) -> None:
    """The events as three batches by day."""
    for batch_id, part in enumerate(THIRDS):
        counts = _third(spark, sf_dir, part)
        for _ in range(2 if replay else 1):
            tally.add_statistics(counts, batch_id)


@query("sink_upsert_add", sql(_COUNTS, "tracking"))
def sink_upsert_add(spark, sf_dir):
    """Totals from a compacted part and the increments after it."""
    tally = TallyTable(spark, shared_dir(spark, "tally"))
    _add_thirds(spark, sf_dir, tally)
    tally.compact(1)
    return tally.current().drop("doc_id")


@query("sink_replay_idempotent", sql(_COUNTS, "tracking"))
def sink_replay_idempotent(spark, sf_dir):
    """Every batch written twice counts once."""
    tally = TallyTable(spark, shared_dir(spark, "tally"))
    _add_thirds(spark, sf_dir, tally, replay=True)
    return tally.current().drop("doc_id")


@query("sink_fold_crash", sql(_COUNTS, "tracking"))
def sink_fold_crash(spark, sf_dir):
    """A fold that holds part of the rows and was never marked as done counts for nothing."""
    tally = TallyTable(spark, shared_dir(spark, "tally"))
    _add_thirds(spark, sf_dir, tally)
    cut_short = f"{tally.table.path}/folded/{tally.table.run}/upto=2/cut-short"
    rows = tally.table.read_batch(0).filter("host = 'h0'")
    unmarked = rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    unmarked.parquet(cut_short)
    return tally.current().drop("doc_id")


@query("sink_new_checkpoint", sql(_COUNTS, "tracking"))
def sink_new_checkpoint(spark, sf_dir):
    """A second stream checkpoint starts at batch 0 again, also after a fold, and adds."""
    path = shared_dir(spark, "tally")
    first, second = (TallyTable(spark, path, run=run) for run in ("first", "second"))
    first.add_statistics(_third(spark, sf_dir, THIRDS[0]), 0)
    first.add_statistics(_third(spark, sf_dir, THIRDS[1]), 1)
    first.compact(1)
    first.remove_replaced(grace_seconds=0)
    second.add_statistics(_third(spark, sf_dir, THIRDS[2]), 0)
    return second.current().drop("doc_id")


@query(
    "sink_added_dimension",
    sql(
        stat_sql("(SELECT * FROM tracking WHERE day(ts) <= 10)", _SETS[:1], ["host", "platform"],
                 "activity", "visits")
        + "\nUNION ALL\n"
        + stat_sql("(SELECT * FROM tracking WHERE day(ts) > 10)",
                   [("L1,L2", "host,platform", ["host", "platform"])], ["host", "platform"],
                   "activity", "visits"),
        "tracking",
    ),
)
def sink_added_dimension(spark, sf_dir):
    """Later batches count by one more dimension; their documents stay apart from the older."""
    tally = TallyTable(spark, shared_dir(spark, "tally"))
    for batch_id, (part, target) in enumerate(zip(THIRDS, ("L1", "L1:L2", "L1:L2"))):
        tally.add_statistics(_third(spark, sf_dir, part, [target]), batch_id)
    return tally.current().drop("doc_id")


@query(
    "sink_changed_documents",
    sql(
        """SELECT user_id, CAST(count(*) AS BIGINT) AS "value" FROM tracking
WHERE user_id IN (SELECT user_id FROM tracking WHERE day(ts) > 20) GROUP BY user_id""",
        "tracking",
    ),
)
def sink_changed_documents(spark, sf_dir):
    """What an outside store gets with the last batch: new totals of the documents in it."""
    tally = TallyTable(spark, shared_dir(spark, "tally"))
    store = BatchTable(spark, shared_dir(spark, "store"))
    add = forward_changed(tally, store.write_batch)
    for batch_id, part in enumerate(THIRDS):
        events = inputs.with_k(inputs.table(spark, sf_dir, "events").filter(part))
        rows = inputs.to_tracking(inputs.to_tracking_json(events))
        add(rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("value")), batch_id)
    return store.read_batch(len(THIRDS) - 1).drop("doc_id")


_DISTINCT = dict(value="count(DISTINCT user_id)", agg="user_id:countDistinct")
_USER_SETS = [*_SETS, ("L0", "NONE", []), ("L1,L2", "host,platform", ["host", "platform"])]


def _add_users(spark, sf_dir, method: str, targets) -> DistinctTable:
    """Three batches, the second written twice, the first two folded."""
    users = DistinctTable(spark, shared_dir(spark, "users"))
    for batch_id, part in [*enumerate(THIRDS), (1, THIRDS[1])]:
        events = inputs.with_k(inputs.table(spark, sf_dir, "events").filter(part))
        rows = inputs.to_tracking(inputs.to_tracking_json(events))
        users.add_batch(rows, spec(targets, [f"user_id:{method}"]), batch_id)
    users.compact(1)
    return users


@query(
    "sink_distinct_users",
    sql(stat_sql("tracking", _USER_SETS, ["host", "platform"], "activity", "visits", **_DISTINCT),
        "tracking"),
)
def sink_distinct_users(spark, sf_dir):
    """Distinct users over three batches, equal to those of the whole table."""
    return _add_users(spark, sf_dir, "countDistinct", ["L1", "L2", "L0", "L1:L2"]).current()


@query(
    "sink_distinct_sketch",
    sql("SELECT platform, 'near' AS estimate FROM tracking GROUP BY platform", "tracking"),
)
def sink_distinct_sketch(spark, sf_dir):
    """Sketches added over three batches: within four standard errors (1.6 %) of the exact count."""
    about = _add_users(spark, sf_dir, "approxCountDistinct", ["L2"]).current()
    exact = statistics(inputs.tracking(spark, sf_dir), spec(["L2"], ["user_id:countDistinct"]))
    both = about.select("platform", F.col("value").alias("about")).join(
        exact.select("platform", "value"), "platform")
    near = F.abs(F.col("about") - F.col("value")) <= F.lit(4 * 0.016) * F.col("value") + 1
    return both.select("platform", F.when(near, "near").otherwise("far").alias("estimate"))


@query(
    "console_rows",
    sql("SELECT event_group, CAST(count(*) AS BIGINT) AS n FROM tracking GROUP BY ALL", "tracking"),
)
def console_rows(spark, sf_dir):
    """Rows printed on the way pass through unchanged."""
    counts = inputs.tracking(spark, sf_dir).groupBy("event_group").agg(F.count(F.lit(1)).alias("n"))
    return print_rows(counts, rows=5)


@query(
    "reject_text_values",
    sql("""SELECT 'text' AS value_type, true AS rejected, CAST(count(*) AS BIGINT) AS n FROM tracking
UNION ALL SELECT 'long', false, CAST(count(*) AS BIGINT) FROM tracking""", "tracking"),
)
def reject_text_values(spark, sf_dir):
    """A value declared as text cannot be added up; the same counts declared as long can."""
    counts = inputs.tracking(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))
    out = None
    for type_name in ("text", "long"):
        try:
            rows, rejected = typed_values(counts, {"n": type_name}), False
        except ValueError:
            rows, rejected = counts, True
        rows = rows.select(
            F.lit(type_name).alias("value_type"), F.lit(rejected).alias("rejected"), "n"
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "sink_multi_sum",
    """SELECT l_returnflag, l_linestatus, CAST(sum(l_linenumber) AS BIGINT) AS line_sum,
  CAST(count(*) AS BIGINT) AS line_count FROM lineitem GROUP BY ALL""",
)
def sink_multi_sum(spark, sf_dir):
    """Two summed fields per document, added over three batches."""
    lines = inputs.table(spark, sf_dir, "lineitem")
    tally = TallyTable(
        spark, shared_dir(spark, "tally"), {"line_sum": "long", "line_count": "long"}
    )
    parts = ("l_linenumber <= 2", "l_linenumber IN (3, 4)", "l_linenumber > 4")
    for batch_id, part in enumerate(parts):
        documents = lines.filter(part).select(
            "l_returnflag",
            "l_linestatus",
            F.col("l_linenumber").cast("string").alias("line_sum"),
            F.lit("1").alias("line_count"),
        )
        tally.add_batch(documents, batch_id)
    return tally.current().drop("doc_id")


@query(
    "sink_routed",
    sql(
        """SELECT host AS "index", event_group AS "type", platform, count(*) AS n
FROM tracking WHERE host = 'h1' GROUP BY ALL""",
        "tracking",
    ),
)
def sink_routed(spark, sf_dir):
    """Rows name their destination; reading one destination opens only its directories."""
    rows = inputs.tracking(spark, sf_dir).select(
        F.col("host").alias("index"), F.col("event_group").alias("type"), "platform"
    )
    table = BatchTable(spark, shared_dir(spark, "routed"))
    write_routed(table, rows, 0)
    return (
        read_routed(table, index="h1")
        .groupBy("index", "type", "platform")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "raw_data_column",
    sql(
        """SELECT host, "value", '{"host":"' || host || '","value":' || "value" || '}' AS raw_data
FROM (SELECT host, count(*) AS "value" FROM tracking GROUP BY host)""",
        "tracking",
    ),
)
def raw_data_column(spark, sf_dir):
    tally = TallyTable(spark, shared_dir(spark, "tally"))
    counts = inputs.tracking(spark, sf_dir).groupBy("host").agg(F.count(F.lit(1)).alias("value"))
    tally.add_batch(counts, 0)
    return tally.with_raw_data().drop("doc_id")


@query("sink_bulk_files", sql(_COUNTS, "tracking"))
def sink_bulk_files(spark, sf_dir):
    """Statistics as bulk files of a search index, by a Python data source, read back.

    What a failed task leaves behind is in no manifest: a file of such a task is planted.
    """
    folder = shared_dir(spark, "bulk")
    spark.dataSource.register(BulkFiles)
    counts = statistics(inputs.tracking(spark, sf_dir), spec(["L1", "L2"]))
    documents = counts.withColumn("doc_id", fn.doc_id(*[c for c in counts.columns if c != "value"]))
    documents.write.format("bulk_files").options(path=folder, index="stats").mode("append").save()
    documents.limit(1).write.json(f"{folder}/part-of-a-failed-task")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in counts.schema)
    return read_bulk_files(spark, folder, fields).select(*counts.columns)
