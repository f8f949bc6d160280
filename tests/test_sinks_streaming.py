from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from eventstats.functions import BUCKET_WIDTHS
from eventstats.sinks import BatchTable, TallyTable, print_rows, read_routed, typed_values, write_routed
from eventstats.sources import read_log_stream
from eventstats.streaming import (
    PreviousBatch,
    SeenKeys,
    latest_windows,
    run_stream,
    shared_dir,
    tumbling_counts,
)
from tests.conftest import plan_of
from tests.test_dedup import SCHEMA, brute_force, sample


@pytest.fixture
def path(tmp_path):
    return lambda: str(tmp_path / uuid.uuid4().hex)


def counts(spark, *rows):
    return spark.createDataFrame(list(rows), "host string, value bigint")


def totals(tally):
    return {r["host"]: r["value"] for r in tally.current().collect()}


def test_tally_adds_replays_and_compacts(spark, path):
    tally = TallyTable(spark, path())
    with pytest.raises(ValueError):
        tally.current()
    tally.add_batch(counts(spark, ("a", 1), ("a", 2), ("b", 5)), 0)
    tally.add_batch(counts(spark, ("a", 10), (None, 7)), 1)
    assert totals(tally) == {"a": 13, "b": 5, None: 7}
    tally.add_batch(counts(spark, ("a", 20)), 1)
    assert totals(tally) == {"a": 23, "b": 5}
    tally.compact(0)
    assert totals(tally) == {"a": 23, "b": 5}
    tally.add_batch(counts(spark, ("b", 1)), 2)
    tally.compact(1)
    tally.compact(1)
    tally.add_batch(counts(spark, ("b", 2)), 2)
    assert totals(tally) == {"a": 23, "b": 7}
    assert len({r["doc_id"] for r in tally.current().collect()}) == 2
    raw = {r["raw_data"] for r in tally.with_raw_data().collect()}
    assert raw == {'{"host":"a","value":23}', '{"host":"b","value":7}'}


def test_tally_of_several_fields(spark, path):
    tally = TallyTable(spark, path(), {"n": "interger", "x": "double"})
    df = spark.createDataFrame([("a", "1", "0.5"), ("a", "2", "0.25")], "k string, n string, x string")
    tally.add_batch(df, 0)
    tally.add_batch(df, 1)
    got = tally.current().collect()[0]
    assert (got["n"], got["x"]) == (6, 1.5)


def test_text_cannot_be_added_up(spark, path):
    with pytest.raises(ValueError):
        typed_values(counts(spark, ("a", 1)), {"host": "string"})


def test_batch_table_reads_only_the_batches_asked_for(spark, path):
    table = BatchTable(spark, path())
    assert table.read() is None and table.read_batch(0) is None
    for i in range(5):
        table.write_batch(counts(spark, (f"b{i}", i)), i)
    table.fold(1, lambda rows: rows)

    def hosts(df):
        return sorted(r["host"] for r in df.collect())

    assert hosts(table.read()) == ["b0", "b1", "b2", "b3", "b4"]
    assert hosts(table.read(before=4)) == ["b0", "b1", "b2", "b3"]
    assert hosts(table.read(before=2)) == ["b0", "b1"]
    assert hosts(table.read(before=1)) == ["b0"]
    assert hosts(table.read_batch(3)) == ["b3"]
    assert "batch_id" not in table.read().columns


def test_a_fold_that_was_cut_short_is_not_read(spark, path):
    root = path()
    tally = TallyTable(spark, root)
    for i in range(3):
        tally.add_batch(counts(spark, ("a", 1), ("b", 2)), i)
    half = f"{root}/folded/run=0/upto=2/half"
    counts(spark, ("a", 1)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(half)
    assert totals(tally) == {"a": 3, "b": 6}


def test_folding_rows_twice(spark, path):
    table = BatchTable(spark, path())
    table.write_batch(counts(spark, ("a", 1), ("a", 1)), 0)
    for _ in range(2):
        table.fold(0, lambda rows: rows)
    assert table.read().count() == 2


@pytest.mark.parametrize("folded", [False, True])
def test_a_new_checkpoint_adds(spark, path, folded):
    root = path()
    first = TallyTable(spark, root, run="first")
    first.add_batch(counts(spark, ("a", 1)), 0)
    first.add_batch(counts(spark, ("a", 2)), 1)
    if folded:
        first.compact(1)
    second = TallyTable(spark, root, run="s/2")
    second.add_batch(counts(spark, ("a", 100)), 0)
    assert totals(first) == totals(second) == {"a": 103}
    second.compact(0)
    assert totals(first) == totals(second) == {"a": 103}


def test_an_added_dimension_keeps_documents_apart(spark, path):
    tally = TallyTable(spark, path())
    tally.add_batch(counts(spark, ("a", 1)), 0)
    wider = spark.createDataFrame([("a", "web", 4), ("a", "app", 8)], "host string, platform string, value bigint")
    tally.add_batch(wider, 1)
    want = {("a", None, 1), ("a", "web", 4), ("a", "app", 8)}
    for upto in (None, 0, 1):
        if upto is not None:
            tally.compact(upto)
        got = tally.current().select("host", "platform", "value", "doc_id").collect()
        assert {tuple(r)[:3] for r in got} == want and len({r["doc_id"] for r in got}) == 3


def test_a_column_of_another_type_is_an_error(spark, path):
    table = BatchTable(spark, path())
    table.write_batch(counts(spark, ("a", 1)), 0)
    table.fold(0, lambda rows: rows)
    table.write_batch(spark.createDataFrame([("a", "x")], "host string, value string"), 1)
    with pytest.raises(ValueError, match="value"):
        table.read()


def test_a_missing_batch_is_an_error(spark, path):
    table = BatchTable(spark, path())
    for i in (0, 1, 3):
        table.write_batch(counts(spark, ("a", 1)), i)
    assert table.read(before=2).count() == 2
    with pytest.raises(ValueError, match=r"\[2\]"):
        table.read()
    table.fold(1, lambda rows: rows)
    with pytest.raises(ValueError, match=r"\[2\]"):
        table.read()


def test_routed_rows(spark, path):
    table = BatchTable(spark, path())
    rows = [("i", "01", 1), ("i", "1", 2), ("j", "01", 3)]
    df = spark.createDataFrame(rows, "index string, type string, n int")
    write_routed(table, df, 0)
    one = read_routed(table, index="i", type="01")
    assert [tuple(r) for r in one.collect()] == [("i", "01", 1)]
    assert one.columns == df.columns
    assert "PartitionFilters: [isnotnull(_to_index" in plan_of(one)


def test_print_rows_passes_the_frame_through(spark, capsys):
    df = counts(spark, ("a", 1))
    assert print_rows(df) is df
    assert "a" in capsys.readouterr().out


def test_shared_dir_uses_the_configured_folder(spark):
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def batches_of(spark, rows, n=4):
    df = spark.createDataFrame(rows, SCHEMA)
    return [df.filter(F.col("event_id") % n == i) for i in range(n)]


@pytest.mark.parametrize("keys", [["user_id"], ["user_id", "kind"]])
def test_seen_keys_over_batches(spark, path, keys):
    """Every key and bucket has its first row in the earliest batch that holds it."""
    intervals = ["daily", "minutely", "all"]
    rows = sample(600, seed=2)
    seen = SeenKeys(spark, path(), keys, intervals)
    flags = {}
    for batch_id, batch in enumerate(batches_of(spark, rows)):
        flagged = seen.flag_batch(batch, batch_id)
        first = [r.asDict() for r in flagged.collect()]
        again = [r.asDict() for r in seen.flag_batch(batch, batch_id).collect()]
        assert sorted(map(str, first)) == sorted(map(str, again))
        flags.update({r["event_id"]: r for r in first})
        if batch_id == 1:
            seen.compact(1)
    for interval in intervals:
        # Arrival order: batch first, then time, then id.
        order = sorted(rows, key=lambda r: (r[0] % 4, r[3], r[0]))
        at, met = {"user_id": 1, "kind": 2}, set()
        name = "_".join([*keys, interval, "duplicate_flag"])
        for row in order:
            key = tuple(row[at[k]] for k in keys)
            bucket = (key, row[3][: BUCKET_WIDTHS[interval]])
            want = int(bool(key[0]) and bucket in met)
            met.add(bucket)
            assert flags[row[0]][name] == want


def test_one_batch_equals_the_batch_operator(spark, path):
    rows = sample(500, seed=3)
    out = SeenKeys(spark, path()).flag_batch(spark.createDataFrame(rows, SCHEMA), 0)
    got = {r["event_id"]: r["user_id_daily_duplicate_flag"] for r in out.collect()}
    assert got == brute_force(rows, ["user_id"], "daily")


def test_seen_keys_read_only_the_days_of_the_batch(spark, path):
    seen = SeenKeys(spark, path(), intervals=["daily", "minutely"])
    for day in (1, 2, 3):
        df = spark.createDataFrame([(day, "u", "a", f"2024-01-0{day} 00:00:00")], SCHEMA)
        seen.flag_batch(df, day)
    late = spark.createDataFrame([(9, "u", "a", "2024-01-01 00:00:30")], SCHEMA)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # else the plan text is cut
    try:
        new = seen._new_keys(late, 4)
        filters = plan_of(new).split("PartitionFilters: [")[1].split("PushedFilters")[0]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "p2024-01-01" in filters and "p2024-01-02" not in filters
    assert new.count() == 0


def test_seen_keys_forget_closed_buckets(spark, path):
    seen = SeenKeys(spark, path())
    old = spark.createDataFrame([(1, "u", "a", "2024-01-01 00:00:00")], SCHEMA)
    new = spark.createDataFrame([(2, "u", "a", "2024-01-02 00:00:00")], SCHEMA)
    seen.flag_batch(old, 0)
    seen.flag_batch(new, 1)
    seen.compact(1, oldest={"daily": "2024-01-02"})
    assert [r["bucket"] for r in seen.table.read().collect()] == ["2024-01-02"]
    assert seen.first_of_batch(new.withColumn("event_id", F.lit(3)), 2).count() == 0


def test_previous_batch_memory(spark, path):
    memory = PreviousBatch(spark, path(), "k")

    def kept(batch_id, *keys):
        df = spark.createDataFrame([(k,) for k in keys], "k string")
        return sorted(r["k"] for r in memory.keep_new(df, batch_id).collect())

    assert kept(0, "a", "a", "b") == ["a", "a", "b"]
    assert kept(1, "a", "c") == ["c"]
    assert kept(1, "a", "c") == ["c"]
    assert kept(2, "a", "b", "c") == ["b"]


def test_stream_of_text_files_restarts_where_it_stopped(spark, path):
    landing, checkpoint = path(), path()
    out = BatchTable(spark, path())
    for part in (["one", "two"], ["three"]):
        spark.createDataFrame([(v,) for v in part], "value string").write.mode("append").text(landing)
        run_stream(read_log_stream(spark, path=landing), out.write_batch, checkpoint)
    assert sorted(r["value"] for r in out.read().collect()) == ["one", "three", "two"]
    assert [r["value"] for r in out.read_batch(1).collect()] == ["three"]


def test_tumbling_windows_in_wall_clock_time(spark, path):
    landing = path()
    rows = [("2024-03-10 02:31:00", "a"), ("2024-03-10 02:39:59", "a"), ("2024-03-10 02:40:00", "b")]
    df = spark.createDataFrame(rows, "t string, k string")
    df = df.select(F.col("t").cast("timestamp_ntz").alias("ts"), "k")
    df.write.parquet(landing)
    out = BatchTable(spark, path())
    stream = read_log_stream(spark, path=landing, schema=df.schema)
    counts = tumbling_counts(stream, "ts", "10 minutes", ["k"], "1 hour")
    run_stream(counts, out.write_batch, path(), output_mode="update")
    got = {(r["s"], r["k"]): r["value"] for r in latest_windows(out, ["k"]).select(
        F.col("start").cast("string").alias("s"), "k", "value").collect()}
    assert got == {("2024-03-10 02:30:00", "a"): 2, ("2024-03-10 02:40:00", "b"): 1}


def test_changed_documents_have_their_totals(spark, path):
    tally = TallyTable(spark, path())
    for batch_id, rows in enumerate(([("a", 1), ("b", 2)], [("b", 5), (None, 1)])):
        tally.add_batch(spark.createDataFrame(rows, "host string, value long"), batch_id)
    changed = tally.changed(1)
    assert {(r.host, r.value) for r in changed.collect()} == {("b", 7), (None, 1)}
    ids = {r.host: r.doc_id for r in tally.current().collect()}
    assert all(ids[r.host] == r.doc_id for r in changed.collect())
    with pytest.raises(ValueError, match="not written"):
        tally.changed(2)


def test_changed_after_an_added_dimension(spark, path):
    tally = TallyTable(spark, path())
    tally.add_batch(spark.createDataFrame([("a", 1)], "host string, value long"), 0)
    later = spark.createDataFrame([("a", "web", 3), ("a", None, 4)], "host string, platform string, value long")
    tally.add_batch(later, 1)
    assert {(r.platform, r.value) for r in tally.changed(1).collect()} == {("web", 3), (None, 5)}


def test_replaced_parts_go_after_a_while(spark, path):
    tally = TallyTable(spark, path())
    for batch_id in range(5):
        tally.add_batch(spark.createDataFrame([("a", 1)], "host string, value long"), batch_id)
        if batch_id in (2, 3):
            tally.compact(batch_id)
    assert tally.remove_replaced() == 0  # readers may still use them
    assert tally.remove_replaced(grace_seconds=0) == 4  # one fold, batches 0 to 2
    assert tally.remove_replaced(grace_seconds=0) == 0
    assert [r.value for r in tally.current().collect()] == [5]
    assert tally.table.read_batch(3).count() == 1


def test_stream_compacts_by_itself(spark, path):
    lines, checkpoint, done = path(), path(), []
    tally = TallyTable(spark, path())

    def on_batch(batch, batch_id):
        counts = batch.groupBy(F.col("value").alias("word")).agg(F.count(F.lit(1)).alias("value"))
        tally.add_batch(counts, batch_id)

    def compact(upto):
        done.append(upto)
        tally.compact(upto)
        tally.remove_replaced(grace_seconds=0)

    for _ in range(5):
        spark.createDataFrame([("a",)], "value string").write.mode("append").text(lines)
        stream = spark.readStream.text(lines)
        run_stream(stream, on_batch, checkpoint, compact=compact, compact_every=2)
    assert done == [1, 3]
    assert [(r.word, r.value) for r in tally.current().collect()] == [("a", 5)]


def test_distinct_counts_add_up(spark, tmp_path):
    """Numbers, texts, look-alikes, nulls, replays, a second run and a fold, against sets."""
    import random

    from eventstats.operators import StatSpec
    from eventstats.sinks import DistinctTable

    rng = random.Random(4)
    texts = ["7", "07", "7.0", " 7", "-3", "x", "", "9223372036854775807", "9223372036854775808"]
    rows = [(rng.choice(["a", "b"]), rng.choice(["p", None]), rng.choice([str(rng.randrange(90_000)), *texts, None]), i % 3)
            for i in range(3000)] + [("c", "p", None, 0)]
    df = spark.createDataFrame(rows, "host string, platform string, user string, batch int")
    labels = {"L0": "NONE", "L1": "host", "L2": "platform"}
    spec = StatSpec(labels, ["L1", "L1:L2", "L0"], ["user:countDistinct", "user:approxCountDistinct"], "d", "v", "c")
    path = str(tmp_path / "users")
    first, second = DistinctTable(spark, path, "one"), DistinctTable(spark, path, "two")
    for batch in (0, 1, 1):
        first.add_batch(df.filter(f"batch = {batch}"), spec, batch)
    second.add_batch(df.filter("batch = 2"), spec, 0)
    first.compact(1)
    got = {(r["key"], r["host"], r["platform"], r["agg"]): r["value"] for r in second.current().collect()}
    want = {}
    for host, platform, user, _ in rows:
        for key in (("L1", host, None), ("L1,L2", host, platform), ("L0", None, None)):
            want.setdefault(key, set()).update([user] if user is not None else [])
    assert {k[:3]: v for k, v in got.items() if k[3] == "user:countDistinct"} == {k: len(v) for k, v in want.items()}
    for key, users in want.items():
        assert abs(got[(*key, "user:approxCountDistinct")] - len(users)) <= 0.08 * len(users)
    empty = DistinctTable(spark, str(tmp_path / "empty"))
    empty.add_batch(df.limit(0), spec, 0)
    assert empty.current().count() == 0
    with pytest.raises(ValueError):
        first.add_batch(df, StatSpec(labels, ["L1"], ["user:count"], "d", "v", "c"), 5)


def test_bulk_files(spark, tmp_path):
    """Commits by manifest: a task that fails once, a replayed batch, an overwrite, an abort, odd text."""
    from pyspark.sql.types import Row

    from eventstats.sinks import BulkFiles, committed_files, read_bulk_files
    from eventstats.sinks.bulk import _StreamWriter, _TableWriter

    spark.dataSource.register(BulkFiles)
    path = str(tmp_path / "bulk")
    df = spark.createDataFrame([(str(i), 'line\n"é"', i) for i in range(50)], "doc_id string, text string, n long").repartition(3)
    writer = df.write.format("bulk_files").options(path=path, index="i")
    writer.mode("append").save()
    writer.mode("append").save()
    got = read_bulk_files(spark, path, "text string, n long").collect()
    assert len(got) == 100 and {(r["_index"], r["_id"], r["text"]) for r in got} == {("i", str(i), 'line\n"é"') for i in range(50)}
    writer.mode("overwrite").save()
    assert read_bulk_files(spark, path, "n long").count() == 50
    df.limit(0).write.format("bulk_files").options(path=str(tmp_path / "none"), index="i").mode("append").save()
    assert committed_files(str(tmp_path / "none")) == [] and committed_files(str(tmp_path / "absent")) == []

    rows = [Row("a", "x", 1), Row("b", "y", 2)]
    stream = _StreamWriter(df.schema, {"path": str(tmp_path / "stream"), "index": "i"})
    failed = stream.write(iter(rows))  # an attempt whose task was lost before it could report
    first, again = stream.write(iter(rows)), stream.write(iter(rows[:1]))
    stream.commit([first, None], 0)
    stream.commit([again], 0)
    assert [f.rpartition("/")[2] for f in committed_files(str(tmp_path / "stream"))] == again.files != failed.files
    table = _TableWriter(df.schema, {"path": str(tmp_path / "gone"), "index": "i"})
    table.abort([table.write(iter(rows)), None])
    assert not list((tmp_path / "gone").glob("part-*"))
    with pytest.raises(ValueError):
        _TableWriter(df.drop("doc_id").schema, {"path": path, "index": "i"})


def test_late_rows_are_kept_apart(spark, tmp_path):
    """The line of a batch comes from the batches before it; replays and rows without a time."""
    from eventstats.streaming import Lateness

    def rows(*times):
        return spark.createDataFrame([(t,) for t in times], "time string")

    lateness = Lateness(spark, str(tmp_path / "lines"), "2 hours")
    batches = [rows("2024-01-01 10:00:00", None), rows("2024-01-01 07:59:59", "2024-01-01 08:00:00", "2024-01-01 08:00:01", None, "bad"),
               rows("2024-01-01 08:00:01", "2024-01-01 08:00:00")]
    found = []
    for batch_id in (0, 1, 1, 2):
        on_time, late = lateness.split(batches[batch_id], batch_id)
        found.append((on_time.count(), sorted(r["time"] for r in late.collect())))
    behind = ["2024-01-01 07:59:59", "2024-01-01 08:00:00"]
    assert found == [(2, []), (3, behind), (3, behind), (1, behind[1:])]
    assert lateness.oldest(["daily", "hourly", "all"], 2) == {"daily": "2024-01-01", "hourly": "2024-01-01 08", "all": ""}
    assert lateness.oldest(["daily"], 0) == {}


def test_counts_on_the_way(spark):
    from pyspark.sql import Observation

    from eventstats.operators import LogRules, enhance_time, format_log

    lines = ['{"time": "2024-01-01T00:00:00+00:00"}', '{"time": "x"}', "{broken", '{"event": 5}']
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    seen, times = Observation(), Observation()
    out = enhance_time(format_log(df, LogRules(), observe=seen), observe=times)
    assert out.count() == 1
    assert seen.get == {"rows_in": 4, "malformed": 1} and times.get == {"invalid_time": 2, "valid": 1}
