"""Structured Streaming queries. Each runs its stream to the end and returns what it wrote."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from eventstats.operators import (
    Dimension,
    StatSpec,
    flag_duplicates,
    lookup_join,
    statistics,
)
from eventstats.plans import Flow, metrics
from eventstats.sinks import BatchTable, TallyTable
from eventstats.sources import read_log_stream, spread, union_streams
from eventstats.streaming import (
    Lateness,
    PreviousBatch,
    SeenKeys,
    first_per_key,
    latest_windows,
    run_stream,
    shared_dir,
    tumbling_counts,
    window_counts,
)
from workload import inputs
from workload.oracle import CANONICAL, sql, stat_sql
from workload.registry import query
from workload.stats import LABELS, TIMES, kpi_sql, spec

# The month of events in three arrivals.
ARRIVALS = ("day(ts) <= 10", "day(ts) BETWEEN 11 AND 20", "day(ts) > 20")
_BATCH_SQL = "CASE WHEN day(ts) <= 10 THEN 0 WHEN day(ts) <= 20 THEN 1 ELSE 2 END"


def in_place(spark, sf_dir, **options) -> DataFrame:
    """The events table as a stream, read where it is."""
    schema = inputs.table(spark, sf_dir, "events").schema
    return read_log_stream(
        spark, path=sf_dir, schema=schema, name_glob="events.parquet", **options
    )


def lines_of(stream: DataFrame) -> DataFrame:
    return inputs.to_tracking_json(inputs.with_k(stream))


def run_arrivals(
    spark,
    sf_dir: str,
    on_batch: Callable[[DataFrame, int], None],
    arrivals: Sequence[str] = ARRIVALS,
) -> None:
    """Let the events arrive part by part; every part is one run on the same checkpoint."""
    events = spread(inputs.table(spark, sf_dir, "events"), "event_id")
    landing, checkpoint = shared_dir(spark, "landing"), shared_dir(spark, "checkpoint")
    for part in arrivals:
        events.filter(part).write.mode("append").parquet(landing)
        run_stream(read_log_stream(spark, path=landing, schema=events.schema), on_batch, checkpoint)


def tracking_of(batch: DataFrame) -> DataFrame:
    return inputs.to_tracking(lines_of(batch))


@query("stream_file_source", sql(f"SELECT {CANONICAL}, event_group FROM tracking", "tracking"))
def stream_file_source(spark, sf_dir):
    out = BatchTable(spark, shared_dir(spark, "out"))
    stream = lines_of(in_place(spark, sf_dir, partitions=8))

    def on_batch(batch, batch_id):
        rows = inputs.to_tracking(batch).drop("time_minute_1_start", "time_minute_1_end")
        out.write_batch(rows, batch_id)

    run_stream(stream, on_batch, shared_dir(spark, "checkpoint"))
    return out.read()


@query(
    "stream_rate_limited",
    """SELECT event_type, CAST(count(*) AS BIGINT) AS "value" FROM events GROUP BY event_type""",
)
def stream_rate_limited(spark, sf_dir):
    """One file per micro-batch."""
    events = inputs.table(spark, sf_dir, "events")
    landing = shared_dir(spark, "landing")
    events.repartition(3, "event_id").write.parquet(landing)
    tally = TallyTable(spark, shared_dir(spark, "tally"))
    stream = read_log_stream(spark, path=landing, schema=events.schema, max_files_per_trigger=1)
    run_stream(
        stream,
        lambda batch, batch_id: tally.add_batch(
            batch.groupBy("event_type").agg(F.count(F.lit(1)).alias("value")), batch_id
        ),
        shared_dir(spark, "checkpoint"),
    )
    return tally.current().drop("doc_id")


_COUNTS = StatSpec(
    LABELS, ["L1", "L2", "L0"], ["user_id:count"], "activity", "visits", "minute_1"
)
_COUNT_SETS = [("L1", "host", ["host"]), ("L2", "platform", ["platform"]), ("L0", "NONE", [])]
_COUNT_SQL = stat_sql("tracking", _COUNT_SETS, ["host", "platform"], "activity", "visits")


@query("stream_flow", sql(kpi_sql("active_visits"), "enriched"))
def stream_flow(spark, sf_dir):
    """The whole flow per micro-batch: format, time, device lookup, counts, additive sink."""
    plugin = {"type": "enhance", "method": "plugin"}
    flow = Flow(
        {
            "format": [{"id": 1, **plugin, "fn": inputs.to_canonical}],
            "prepares": [
                {"id": 1, **plugin, "fn": inputs.enhance_time},
                {"id": 2, **plugin,
                 "fn": lambda df: inputs.enrich_device(df, inputs.new_devices(spark, sf_dir))},
                {"id": 3, **plugin, "fn": metrics.with_period},
            ],
            "sets": [
                {"id": 1, "computes": [
                    {"id": 1, "type": "compute", "method": "spark-sql",
                     "stat": metrics.specs()["active_visits"]}]}
            ],
        }
    )
    tally = TallyTable(spark, shared_dir(spark, "tally"))
    step = flow.on_batch({1: tally.add_statistics})
    run_arrivals(spark, sf_dir, lambda batch, batch_id: step(lines_of(batch), batch_id))
    return tally.current().drop("doc_id")


@query(
    "empty_batch",
    """SELECT CAST(0 AS BIGINT) AS statistics, CAST(count(*) AS BIGINT) AS "value" FROM events""",
)
def empty_batch(spark, sf_dir):
    """A batch without rows has no statistics and leaves the totals as they are."""
    totals = TallyTable(spark, shared_dir(spark, "tally"))
    none = BatchTable(spark, shared_dir(spark, "none"))

    def on_batch(batch, batch_id):
        totals.add_batch(batch.groupBy().agg(F.count(F.lit(1)).alias("value")), 2 * batch_id)
        nothing = inputs.to_tracking(lines_of(batch.filter("ts IS NULL")))
        none.write_batch(statistics(nothing, _COUNTS), batch_id)

    run_stream(in_place(spark, sf_dir), on_batch, shared_dir(spark, "checkpoint"))
    found = none.read().select(F.lit(1).alias("statistic"), F.lit(0).cast("bigint").alias("value"))
    both = totals.current().select(F.lit(0).alias("statistic"), "value").unionByName(found)
    return both.agg(
        F.sum("statistic").cast("bigint").alias("statistics"), F.sum("value").alias("value")
    )


@query(
    "multi_statistics",
    sql(
        "SELECT 1 AS set_id, * FROM (" + _COUNT_SQL + ")\nUNION ALL\nSELECT 2 AS set_id, * FROM ("
        + stat_sql("tracking", [("L2", "platform", ["platform"])], ["host", "platform"],
                   "courseware", "visits", where="event_group = 'access_courseware'")
        + ")",
        "tracking",
    ),
)
def multi_statistics(spark, sf_dir):
    """Two sets with their own steps and sinks over one shared, persisted frame."""
    plugin = {"type": "enhance", "method": "plugin"}
    flow = Flow(
        {
            "format": [{"id": 1, **plugin, "fn": inputs.to_canonical}],
            "prepares": [{"id": 1, **plugin, "fn": inputs.enhance_time}],
            "sets": [
                {"id": 1, "computes": [
                    {"id": 1, "type": "compute", "method": "spark-sql", "stat": _COUNTS}]},
                {"id": 2,
                 "prepares": [{"id": 1, "type": "filter", "method": "spark-sql",
                               "where": "event_group = 'access_courseware'"}],
                 "computes": [
                    {"id": 1, "type": "compute", "method": "spark-sql",
                     "stat": spec(["L2"], data_type="courseware")}]},
            ],
        }
    )
    tallies = {i: TallyTable(spark, shared_dir(spark, f"tally{i}")) for i in (1, 2)}
    run_stream(
        lines_of(in_place(spark, sf_dir)),
        flow.on_batch({i: t.add_statistics for i, t in tallies.items()}),
        shared_dir(spark, "checkpoint"),
    )
    one, two = [t.current().withColumn("set_id", F.lit(i)) for i, t in tallies.items()]
    return one.unionByName(two, allowMissingColumns=True).drop("doc_id")


@query(
    "flow_step_sinks",
    sql(
        "SELECT 1 AS step_id, * FROM ("
        + stat_sql("tracking", [("L1", "host", ["host"])], ["host", "platform"], "activity", "visits")
        + ")\nUNION ALL\nSELECT 2 AS step_id, * FROM ("
        + stat_sql("(SELECT * FROM tracking WHERE platform <> 'web')",
                   [("L2", "platform", ["platform"])], ["host", "platform"], "activity", "visits")
        + ")",
        "tracking",
    ),
)
def flow_step_sinks(spark, sf_dir):
    """Two compute steps of one set write to tables of their own; the second has an output hook."""
    plugin = {"type": "enhance", "method": "plugin"}
    compute = {"type": "compute", "method": "spark-sql"}
    flow = Flow(
        {
            "format": [{"id": 1, **plugin, "fn": inputs.to_canonical}],
            "prepares": [{"id": 1, **plugin, "fn": inputs.enhance_time}],
            "sets": [{"id": 1, "computes": [
                {"id": 1, **compute, "stat": spec(["L1"])},
                {"id": 2, **compute, "stat": spec(["L2"]),
                 "output": lambda df: df.filter("platform <> 'web'")},
            ]}],
        }
    )
    tallies = {i: TallyTable(spark, shared_dir(spark, f"tally{i}")) for i in (1, 2)}
    on_batch = flow.on_batch({}, {(1, i): t.add_statistics for i, t in tallies.items()})
    run_arrivals(spark, sf_dir, lambda batch, batch_id: on_batch(lines_of(batch), batch_id))
    one, two = [t.current().withColumn("step_id", F.lit(i)) for i, t in tallies.items()]
    return one.unionByName(two, allowMissingColumns=True).drop("doc_id")


@query(
    "stream_dedup_flags",
    sql(
        """SELECT day, flag, count(*) AS n FROM (
  SELECT substr(time, 1, 10) AS day, CASE WHEN user_id = '' OR row_number() OVER (
    PARTITION BY user_id, substr(time, 1, 10) ORDER BY time, event_id) = 1 THEN 0 ELSE 1 END
    AS flag FROM tracking) GROUP BY ALL""",
        "tracking",
    ),
)
def stream_dedup_flags(spark, sf_dir):
    """Daily repeat flags over three micro-batches, counted per day."""
    out = BatchTable(spark, shared_dir(spark, "out"))
    seen = SeenKeys(spark, shared_dir(spark, "seen"))

    def on_batch(batch, batch_id):
        rows = tracking_of(batch).select("event_id", "user_id", "time").persist()
        try:
            out.write_batch(seen.flag_batch(rows, batch_id), batch_id)
        finally:
            rows.unpersist()

    run_arrivals(spark, sf_dir, on_batch)
    day = F.substring("time", 1, 10).alias("day")
    flag = F.col("user_id_daily_duplicate_flag").alias("flag")
    return out.read().groupBy(day, flag).agg(F.count(F.lit(1)).alias("n"))


@query(
    "dedup_flag_no_id",
    sql(
        """SELECT platform, substr(time, 1, 10) AS day, CAST(count(*) AS BIGINT) AS n,
  CAST(count(DISTINCT CASE WHEN user_id <> '' THEN user_id END)
    + count(CASE WHEN user_id = '' THEN 1 END) AS BIGINT) AS firsts
FROM (SELECT 'all' AS platform, user_id, time FROM tracking) GROUP BY ALL""",
        "tracking",
    ),
)
def dedup_flag_no_id(spark, sf_dir):
    """Daily flags of rows without ids: which tied row is first is open, the numbers are not."""
    rows = inputs.tracking(spark, sf_dir).select(F.lit("all").alias("platform"), "user_id", "time")
    flagged = flag_duplicates(rows, ["user_id"], ["daily"], tiebreak=None)
    first = F.col("user_id_daily_duplicate_flag") == 0
    return flagged.groupBy("platform", F.substring("time", 1, 10).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(first).alias("firsts")
    )


@query(
    "stream_lookup_refresh",
    sql(
        f"""SELECT event_id, CASE WHEN d.uuid IS NOT NULL
  THEN concat('v', {_BATCH_SQL}, '-', coalesce(d.channel, 'none')) END AS channel
FROM tracking t LEFT JOIN device_info d ON t.uuid = d.uuid""",
        "tracking", "device_info",
    ),
)
def stream_lookup_refresh(spark, sf_dir):
    """The lookup table changes between micro-batches and outgrows its limit after the first.

    A ``Dimension`` per batch reads the table as it is now and measures it anew: broadcast in
    the first batch, a shuffle later.
    """
    out = BatchTable(spark, shared_dir(spark, "out"))

    def on_batch(batch, batch_id):
        version = inputs.device_info(spark, sf_dir).select(
            "uuid", F.concat(F.lit(f"v{batch_id}-"), F.coalesce("channel", F.lit("none"))).alias("channel")
        )
        devices = Dimension(version, "uuid", ["channel"], broadcast_bytes=64 << 20 if batch_id == 0 else 0)
        found = lookup_join(tracking_of(batch).select("event_id", "uuid"), devices, "uuid")
        out.write_batch(found.select("event_id", "channel"), batch_id)

    run_arrivals(spark, sf_dir, on_batch)
    return out.read()


@query(
    "stream_dedup_drop",
    sql(
        """SELECT DISTINCT user_id, substr(time, 1, 7) AS month FROM tracking WHERE user_id <> ''
UNION ALL SELECT user_id, substr(time, 1, 7) FROM tracking WHERE user_id = ''""",
        "tracking",
    ),
)
def stream_dedup_drop(spark, sf_dir):
    """Only the first event of a user per month goes on, and all events without a user."""
    out = BatchTable(spark, shared_dir(spark, "out"))
    seen = SeenKeys(spark, shared_dir(spark, "seen"), intervals=["monthly"])

    def on_batch(batch, batch_id):
        rows = tracking_of(batch).select("event_id", "user_id", "time").persist()
        try:
            out.write_batch(seen.first_of_batch(rows, batch_id), batch_id)
        finally:
            rows.unpersist()

    run_arrivals(spark, sf_dir, on_batch)
    return out.read().select("user_id", F.substring("time", 1, 7).alias("month"))


@query(
    "stream_adjacent_batch",
    sql(
        f""", b AS (SELECT *, {_BATCH_SQL} AS batch, user_id || substr(time, 12, 4) AS uk
  FROM tracking)
SELECT event_id, batch FROM b WHERE NOT EXISTS (
  SELECT 1 FROM b p WHERE p.batch = b.batch - 1 AND p.uk = b.uk)""",
        "tracking",
    ),
)
def stream_adjacent_batch(spark, sf_dir):
    """Rows whose key, an expression, was not in the micro-batch before."""
    out = BatchTable(spark, shared_dir(spark, "out"))
    memory = PreviousBatch(
        spark, shared_dir(spark, "keys"), "concat(user_id, substr(time, 12, 4))"
    )

    def on_batch(batch, batch_id):
        rows = tracking_of(batch).select("event_id", "user_id", "time").persist()
        try:
            kept = memory.keep_new(rows, batch_id).withColumn("batch", F.lit(batch_id))
            out.write_batch(kept.select("event_id", "batch"), batch_id)
        finally:
            rows.unpersist()

    run_arrivals(spark, sf_dir, on_batch)
    return out.read()


_TUMBLING_SQL = """SELECT strftime(time_bucket(INTERVAL 10 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS start_time,
  event_type, CAST(count(*) AS BIGINT) AS "value" FROM events GROUP BY ALL"""


@query("stream_tumbling", _TUMBLING_SQL)
def stream_tumbling(spark, sf_dir):
    """Ten-minute windows kept by Spark's own state, under a watermark."""
    out = BatchTable(spark, shared_dir(spark, "out"))
    counts = tumbling_counts(in_place(spark, sf_dir), "ts", "10 minutes", ["event_type"], "1 hour")
    run_stream(counts, out.write_batch, shared_dir(spark, "checkpoint"), output_mode="update")
    return latest_windows(out, ["event_type"]).select(
        F.col("start").cast("string").alias("start_time"), "event_type", "value"
    )


@query(
    "stream_late_additive",
    sql(stat_sql(
        "(SELECT *, substr(time, 1, 16) || ':00' AS start_date, substr(time, 1, 16) || ':59' "
        "AS end_date FROM tracking)",
        [("L2", "platform", ["platform", *TIMES])], ["platform", *TIMES], "activity", "visits"),
        "tracking"),
)
def stream_late_additive(spark, sf_dir):
    """The oldest days arrive last and still add to their own buckets."""
    tally = TallyTable(spark, shared_dir(spark, "tally"))
    counts = spec(["L2:T1:T2"], excludes=["T1", "T2"])

    def on_batch(batch, batch_id):
        tally.add_statistics(statistics(metrics.with_period(tracking_of(batch)), counts), batch_id)

    run_arrivals(spark, sf_dir, on_batch, arrivals=ARRIVALS[::-1])
    return tally.current().drop("doc_id")


@query("stream_restart", sql(_COUNT_SQL, "tracking"))
def stream_restart(spark, sf_dir):
    """Several runs on one checkpoint, the last without new input, equal one run."""
    tally = TallyTable(spark, shared_dir(spark, "tally"))

    def on_batch(batch, batch_id):
        tally.add_statistics(statistics(tracking_of(batch), _COUNTS), batch_id)

    run_arrivals(spark, sf_dir, on_batch, arrivals=(*ARRIVALS, "ts IS NULL"))
    return tally.current().drop("doc_id")


@query("stream_union_inputs", sql(f"SELECT {CANONICAL}, event_group, CASE host WHEN 'h0' THEN 'a' ELSE 'b' END AS source FROM tracking", "tracking"))
def stream_union_inputs(spark, sf_dir):
    """Two folders in one query; after a restart on its checkpoint one of them has a new file."""
    lines = inputs.tracking_json(spark, sf_dir)
    folders = {name: shared_dir(spark, f"landing-{name}") for name in ("a", "b")}
    out, checkpoint = BatchTable(spark, shared_dir(spark, "out")), shared_dir(spark, "checkpoint")

    def run():
        streams = {n: read_log_stream(spark, path=p, schema=lines.schema) for n, p in folders.items()}

        def on_batch(batch, batch_id):
            rows = inputs.enhance_time(inputs.format_log(batch, inputs.RULES, keep=["event_id", "source"]))
            out.write_batch(rows.drop("time_minute_1_start", "time_minute_1_end"), batch_id)

        run_stream(union_streams(streams), on_batch, checkpoint)

    lines.filter("event_id % 3 = 0").write.mode("append").parquet(folders["a"])
    lines.filter("event_id % 3 = 1").write.mode("append").parquet(folders["b"])
    run()
    lines.filter("event_id % 3 = 2").write.mode("append").parquet(folders["b"])
    run()
    return out.read()


# Arrivals of which the last two hold rows behind the watermark, and the lines they meet.
LATE_ARRIVALS = (
    "day(ts) BETWEEN 5 AND 15",
    "day(ts) > 15 AND event_id % 5 <> 0 OR day(ts) = 3",
    "day(ts) < 5 AND day(ts) <> 3 OR day(ts) > 15 AND event_id % 5 = 0",
)
_LATE_SQL = sql(
    f""", arrived AS (
  SELECT *, CASE {' '.join(f'WHEN {a} THEN {i}' for i, a in enumerate(LATE_ARRIVALS))} END AS arrival FROM tracking
), divided AS (
  SELECT *, coalesce(CAST(time AS TIMESTAMP) <= (SELECT max(CAST(time AS TIMESTAMP)) FROM arrived AS b WHERE b.arrival < a.arrival)
    - INTERVAL 3 DAY, false) AS late FROM arrived AS a
)""",
    "tracking",
)


@query(
    "stream_dedup_state",
    _LATE_SQL + """
SELECT 'first' AS kind, user_id, substr(time, 1, 10) AS day, CAST(1 AS BIGINT) AS n FROM divided
WHERE NOT late AND user_id <> '' GROUP BY ALL
UNION ALL SELECT 'late', user_id, substr(time, 1, 10), count(*) FROM divided WHERE late GROUP BY ALL
UNION ALL SELECT 'all', '', '', count(*) FROM divided""",
)
def stream_dedup_state(spark, sf_dir):
    """Users a day by Spark's state store, which forgets; rows too late for it go to a table."""
    on_time = shared_dir(spark, "on-time")
    late, kept = BatchTable(spark, shared_dir(spark, "late")), BatchTable(spark, shared_dir(spark, "kept"))
    rows_in, lateness = BatchTable(spark, shared_dir(spark, "in")), Lateness(spark, shared_dir(spark, "lines"), "3 days")
    checkpoint, schema = shared_dir(spark, "checkpoint"), "event_id bigint, user_id string, day string, ts timestamp_ntz"

    def divide(batch, batch_id):
        rows = tracking_of(batch).select("event_id", "user_id", "time").persist()
        try:
            in_time, too_late = lateness.split(rows, batch_id)
            late.write_batch(too_late, batch_id)
            day, ts = F.substring("time", 1, 10).alias("day"), F.col("time").cast("timestamp_ntz").alias("ts")
            in_time.select("event_id", "user_id", day, ts).write.mode("overwrite").parquet(f"{on_time}/batch-{batch_id}")
            rows_in.write_batch(rows.agg(F.count(F.lit(1)).alias("n")), batch_id)
        finally:
            rows.unpersist()
        stream = read_log_stream(spark, path=f"{on_time}/*", schema=schema).filter("user_id <> ''")
        run_stream(first_per_key(stream, ["user_id", "day"], "ts", "4 days"), kept.write_batch, checkpoint)

    run_arrivals(spark, sf_dir, divide, LATE_ARRIVALS)
    day = F.substring("time", 1, 10).alias("day")
    first = kept.read().select(F.lit("first").alias("kind"), "user_id", "day", F.lit(1).cast("bigint").alias("n"))
    gone = late.read().groupBy(F.lit("late").alias("kind"), "user_id", day).agg(F.count(F.lit(1)).alias("n"))
    total = rows_in.read().agg(F.sum("n").alias("n")).select(
        F.lit("all").alias("kind"), F.lit("").alias("user_id"), F.lit("").alias("day"), "n")
    return first.unionByName(gone).unionByName(total)


@query(
    "stream_dedup_expiring",
    _LATE_SQL + """
SELECT event_id, late, CASE WHEN late THEN NULL WHEN user_id = '' OR row_number() OVER (
    PARTITION BY late, user_id, substr(time, 1, 10) ORDER BY arrival, time, event_id) = 1 THEN 0 ELSE 1 END AS flag
FROM divided""",
)
def stream_dedup_expiring(spark, sf_dir):
    """Daily flags whose memory is cut at the watermark after every batch; late rows get no flag."""
    seen, out = SeenKeys(spark, shared_dir(spark, "seen")), BatchTable(spark, shared_dir(spark, "out"))
    lateness = Lateness(spark, shared_dir(spark, "lines"), "3 days")

    def on_batch(batch, batch_id):
        if batch_id:  # the batch before is done: what no later row can meet goes
            seen.compact(batch_id - 1, lateness.oldest(seen.intervals, batch_id))
        rows = tracking_of(batch).select("event_id", "user_id", "time").persist()
        try:
            in_time, too_late = lateness.split(rows, batch_id)
            flagged = seen.flag_batch(in_time, batch_id).withColumn("late", F.lit(False))
            out.write_batch(flagged.unionByName(too_late.withColumn("late", F.lit(True)), allowMissingColumns=True), batch_id)
        finally:
            rows.unpersist()

    run_arrivals(spark, sf_dir, on_batch, LATE_ARRIVALS)
    return out.read().select("event_id", "late", F.col("user_id_daily_duplicate_flag").alias("flag"))


@query(
    "flow_observed",
    """SELECT 'rows_in' AS counter, CAST(count(*) AS BIGINT) AS "value" FROM events
UNION ALL SELECT 'malformed', count(*) FROM events WHERE event_id % 97 = 0
UNION ALL SELECT 'invalid_time', count(*) FROM events WHERE event_id % 97 <> 0 AND event_id % 50 = 7
UNION ALL SELECT 'valid', count(*) FROM events WHERE event_id % 97 <> 0 AND event_id % 50 <> 7""",
)
def flow_observed(spark, sf_dir):
    """Counts taken while three micro-batches are written, without a pass of their own."""
    out, tally = BatchTable(spark, shared_dir(spark, "out")), TallyTable(spark, shared_dir(spark, "tally"))

    def on_batch(batch, batch_id):
        lines, times = Observation(), Observation()
        rows = inputs.format_log(lines_of(batch), inputs.RULES, keep=["event_id"], observe=lines)
        out.write_batch(inputs.enhance_time(rows, observe=times), batch_id)
        counted = [(name, value) for name, value in {**lines.get, **times.get}.items()]
        tally.add_batch(spark.createDataFrame(counted, "counter string, value long"), batch_id)

    run_arrivals(spark, sf_dir, on_batch)
    return tally.current().drop("doc_id")


@query("stream_tumbling_late", _TUMBLING_SQL)
def stream_tumbling_late(spark, sf_dir):
    """The windows over three batches, two of them with rows behind the watermark.

    What Spark's state would drop is divided off first and added by a table of totals, so the
    result is that of all rows.
    """
    on_time, checkpoint = shared_dir(spark, "on-time"), shared_dir(spark, "checkpoint")
    out, late = BatchTable(spark, shared_dir(spark, "out")), TallyTable(spark, shared_dir(spark, "late"))
    lateness = Lateness(spark, shared_dir(spark, "lines"), "1 hour", "ts")
    schema = inputs.table(spark, sf_dir, "events").schema

    def divide(batch, batch_id):
        in_time, too_late = lateness.split(batch, batch_id)
        in_time.write.mode("overwrite").parquet(f"{on_time}/batch-{batch_id}")
        late.add_batch(window_counts(too_late, "ts", "10 minutes", ["event_type"]), batch_id)
        stream = read_log_stream(spark, path=f"{on_time}/*", schema=schema)
        counts = tumbling_counts(stream, "ts", "10 minutes", ["event_type"], "1 hour")
        run_stream(counts, out.write_batch, checkpoint, output_mode="update")

    run_arrivals(spark, sf_dir, divide, LATE_ARRIVALS)
    windows = latest_windows(out, ["event_type"]).unionByName(late.current().drop("doc_id"))
    start = F.col("start").cast("string").alias("start_time")
    return windows.groupBy(start, "event_type").agg(F.sum("value").alias("value"))
