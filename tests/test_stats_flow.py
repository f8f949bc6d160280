from __future__ import annotations

from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventstats.operators import StatSpec, statistics
from eventstats.operators.stats import parse_targets
from eventstats.plans import Flow, apply_rows_in_batches, metrics, record_udf, run_step
from tests.conftest import plan_of

LABELS = {"L0": "NONE", "A": "a", "B": "b", "B2": "b", "T": "t"}
ROWS = [("x", "1", "m", "u1", 1), ("x", "2", "m", "u1", 2), ("y", "1", None, "u2", 3),
        ("y", None, "m", None, 4), (None, "1", "m", "u1", 5)]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, "a string, b string, t string, u string, n int")


def spec(targets, aggs=("u:count",), **other):
    names = {"data_type": "d", "value_type": "v", "cycle": "c", **other}
    return StatSpec(LABELS, targets, list(aggs), **names)


def rows_of(result, *columns):
    return Counter(tuple(r[c] for c in columns) for r in result.collect())


def test_counts_per_target(df):
    got = statistics(df, spec(["A", "A:B", "L0"]))
    assert got.columns == ["a", "b", "value", "key", "keyName", "data_type", "value_type", "cycle", "agg"]
    assert dict(got.dtypes)["value"] == "bigint"
    assert rows_of(got, "key", "keyName", "a", "b", "value") == Counter(
        [
            ("A", "a", "x", None, 2), ("A", "a", "y", None, 1), ("A", "a", None, None, 1),
            ("A,B", "a,b", "x", "1", 1), ("A,B", "a,b", "x", "2", 1), ("A,B", "a,b", "y", "1", 1),
            ("A,B", "a,b", "y", None, 0), ("A,B", "a,b", None, "1", 1),
            ("L0", "NONE", None, None, 4),
        ]
    )


def test_all_targets_share_one_shuffle(df):
    plan = plan_of(statistics(df, spec(["A", "A:B", "L0", "T"])))
    assert plan.count("Exchange") == 1 and plan.count("Expand") == 1
    assert "Expand" not in plan_of(statistics(df, spec(["A:B", "B:A"])))


def test_same_columns_in_another_order_are_one_set(df):
    got = statistics(df, spec(["A:B", "B:A", "L0"]))
    assert rows_of(got.filter("a = 'x' AND b = '1'"), "key", "value") == Counter(
        [("A,B", 1), ("B,A", 1)]
    )


def test_overrides_excludes_and_defaults():
    targets = parse_targets(
        spec(["A:T#d2#v2#c2", "T", " A ", "NONE", "A:T#d3", "A"], excludes=["T"])
    )
    assert [(t.key, t.key_name, t.data_type, t.value_type, t.cycle) for t in targets] == [
        ("A", "a", "d2", "v2", "c2"),
        ("L0", "NONE", "d", "v", "c"),
        ("A", "a", "d", "v", "c"),
        ("NONE", "NONE", "d", "v", "c"),
        ("A", "a", "d3", "v", "c"),
    ]


@pytest.mark.parametrize(
    "bad",
    [
        spec(["A"], ["u:median"]),
        spec(["A"], ["u"]),
        spec(["Z"]),
        spec(["A"], data_type=""),
        spec(["A#"]),
    ],
)
def test_bad_specs_are_refused(df, bad):
    with pytest.raises(ValueError):
        statistics(df, bad)


def test_several_aggregates(df):
    got = statistics(df, spec(["A"], ["u:count", "u:countDistinct", "n:sum"]))
    assert rows_of(got.filter("a = 'x'"), "agg", "value") == Counter(
        [("u:count", 2), ("u:countDistinct", 1), ("n:sum", 3)]
    )


def test_sum_of_fractions(df):
    got = statistics(df.withColumn("n", F.col("n") / 2), spec(["L0"], ["n:sum"]))
    assert got.collect()[0]["value"] == 7.5


def test_approximate_distinct(spark):
    df = spark.range(20000).selectExpr("'x' AS a", "id % 5000 AS u")
    got = statistics(df, spec(["A"], ["u:approxCountDistinct"])).collect()[0]["value"]
    assert abs(got - 5000) < 500


def test_empty_input_has_no_statistics(df):
    none = df.filter("a = 'nobody'")
    assert statistics(none, spec(["L0"])).count() == 0
    assert statistics(none, spec(["L0", "A"])).count() == 0
    assert statistics(none, spec(["L0", "A"]), spec(["B"], where="n > 1")).count() == 0


def test_merged_steps_equal_separate_steps(df):
    steps = [
        spec(["A", "L0"]),
        spec(["A:B"], where="n > 1", data_type="late"),
        spec(["B"], ["n:sum"], where="a = 'x'", data_type="x"),
        spec(["A"], ["u:countDistinct"], data_type="users"),
    ]
    merged = statistics(df, *steps)
    columns = ["a", "b", "value", "key", "data_type", "agg"]
    want = Counter()
    for step in steps:
        alone = statistics(df, step)
        for c in ("a", "b"):
            if c not in alone.columns:
                alone = alone.withColumn(c, F.lit(None).cast("string"))
        want += rows_of(alone, *columns)
    assert rows_of(merged, *columns) == want


def test_merged_filters_reach_the_input(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(ROWS, "a string, b string, t string, u string, n int").write.parquet(path)
    table = spark.read.parquet(path)
    plan = plan_of(statistics(table, spec(["A"], where="n = 1"), spec(["B"], where="n = 2")))
    assert "PushedFilters: [Or(EqualTo(n,1),EqualTo(n,2))]" in plan
    assert "ReadSchema: struct<a:string,b:string,u:string,n:int>" in plan


def test_metric_names_and_enrolment_option():
    known = metrics.specs()
    assert len(known) == 9 and known["enrol_visits"].where is None
    assert metrics.specs(enrollment_only=True)["enrol_visits"].where == "event_group = 'enrollment'"
    assert "O\\'Neil" in metrics.specs(register_types=["O'Neil"])["new_accounts"].where


PLUGIN = {"type": "enhance", "method": "plugin"}


def test_steps_run_by_number(df):
    seen = []

    def note(n):
        return {"id": n, **PLUGIN, "fn": lambda d: seen.append(n) or d}

    flow = Flow(
        {
            "format": [note(20), note(3)],
            "prepares": [note(10), note(2), {**note(5), "enabled": False}],
            "sets": [{"id": 1, "prepares": [note(12), note(11)], "computes": [
                {"id": 1, "type": "compute", "method": "spark-sql", "stat": spec(["A"])}]}],
        }
    )
    flow.apply(df)
    assert seen == [3, 2, 10, 11, 12]


def test_unknown_steps_are_refused(df):
    for step in ({"type": "sort", "method": "plugin"}, {"type": "filter", "method": "xml"}, {}):
        with pytest.raises(ValueError):
            run_step(df, step)


def test_sets_do_not_see_each_other(df):
    compute = {"id": 1, "type": "compute", "method": "spark-sql", "stat": spec(["L0"])}
    only_x = {"id": 1, "type": "filter", "method": "spark-sql", "where": "a = 'x'"}
    flow = Flow({"sets": [
        {"id": 1, "prepares": [only_x], "computes": [compute]},
        {"id": 2, "computes": [compute, {**compute, "id": 2, "select": ["u", "n"], "where": "n > 2"}]},
    ]})
    got = rows_of(flow.apply(df), "set_id", "value")
    assert got == Counter([(1, 2), (2, 4), (2, 2)])


def test_record_udf(df):
    tag = record_udf(lambda a, n: None if a is None else a * n, "string")
    got = {r["n"]: r["v"] for r in df.select("n", tag("a", "n").alias("v")).collect()}
    assert got == {1: "x", 2: "xx", 3: "yyy", 4: "yyyy", 5: None}


def test_rows_in_batches(spark):
    df = spark.range(0, 25, 1, 2)
    out = apply_rows_in_batches(
        df, lambda f: pd.DataFrame({"n": [len(f)], "s": [int(f["id"].sum())]}), "n int, s bigint", 5
    )
    got = out.collect()
    assert sum(r["s"] for r in got) == sum(range(25))
    assert Counter(r["n"] for r in got) == Counter({5: 4, 2: 1, 3: 1})
    with pytest.raises(ValueError):
        apply_rows_in_batches(df, lambda f: f, "id bigint", 0)


def test_step_sinks_and_output_hooks(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "host string")
    own = {"type": "compute", "method": "plugin", "fn": lambda d: d.groupBy("host").count()}
    steps = [
        {"id": 1, **own},
        {"id": 2, **own, "output": lambda d: d.filter("count > 1")},
        {"id": 3, **own, "enabled": False},
    ]
    got = {}

    def sink(name):
        def keep(rows, batch_id):
            got[name] = sorted(map(tuple, rows.collect()))

        return keep

    flow = Flow({"sets": [{"id": 1, "computes": steps}]})
    flow.on_batch({1: sink("set")}, {(1, 2): sink("step")})(df, 0)
    assert got == {"set": [("a", 2), ("b", 1)], "step": [("a", 2)]}
    flow.on_batch({}, {(1, 1): sink("one"), (1, 2): sink("two")})(df, 0)
    assert got["one"] == [("a", 2), ("b", 1)] and got["two"] == [("a", 2)]


def test_table_function(spark):
    """Groups of rows by key, from a flow step and from SQL; nulls, ties, wrong arguments, no rows."""
    from eventstats.plans.table_functions import apply_table_function, register

    register(spark)
    rows = [(k, i % 4, "x") for k in ("a", "b", None) for i in range(7)]
    df = spark.createDataFrame(rows, "k string, n int, text string").repartition(3)
    out = apply_table_function(df, "grouped_rows", ["k", "n", 3]).collect()
    found = {}
    for r in sorted(out, key=lambda r: (r["k"] or "", r["group_no"], r["place"])):
        found.setdefault(r["k"], []).append((r["group_no"], r["place"], r["n"]))
    order = [0, 0, 1, 1, 2, 2, 3]
    assert found == {k: [(i // 3, i % 3, n) for i, n in enumerate(order)] for k in ("a", "b", None)}
    df.createOrReplaceTempView("rows_of_test")
    assert spark.sql("SELECT * FROM grouped_rows(TABLE(rows_of_test), 'k', 'n', 100) WHERE group_no = 0").count() == 21
    assert apply_table_function(df.limit(0), "grouped_rows", ["k", "n", 3]).count() == 0
    for args in (["none", "n", 3], ["k", "n", 0]):
        with pytest.raises(Exception, match="no column|at least 1"):
            apply_table_function(df, "grouped_rows", args).collect()
    with pytest.raises(ValueError):
        apply_table_function(df, "grouped_rows(); DROP", [])
