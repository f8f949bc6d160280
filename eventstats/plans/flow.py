"""Declarative flows: format, prepare steps, statistic sets.

A flow is a dict of steps; applying it gives DataFrames, so the same flow serves a batch
table and every micro-batch of a stream.

    {"format": [step, ...], "prepares": [step, ...],
     "sets": [{"id": 1, "prepares": [step, ...], "computes": [step, ...]}, ...]}

A step has ``id``, ``type`` (filter, enhance or compute), ``method`` (spark-sql or plugin)
and ``enabled`` (default true). Its other entries depend on type and method:

    spark-sql              select: list of expressions, where: predicate
    compute / spark-sql    select, where, and stat: StatSpec
    plugin                 fn: DataFrame -> DataFrame
    table-function         name of a registered table function, args after the table

A compute step may have ``output``, a DataFrame -> DataFrame applied to its result on the way
to the sink, and a sink of its own (see ``Flow.on_batch``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DataType, StructType

from eventstats.operators.columns import select_then_where
from eventstats.operators.stats import statistics
from eventstats.plans.table_functions import apply_table_function

Sink = Callable[[DataFrame, int], None]

STEP_TYPES = ("filter", "enhance", "compute")
STEP_METHODS = ("spark-sql", "plugin", "table-function")


def run_step(df: DataFrame, step: Mapping) -> DataFrame:
    kind, method = step.get("type"), step.get("method")
    if kind not in STEP_TYPES or method not in STEP_METHODS:
        raise ValueError(f"unsupported step {step.get('id')!r}: type {kind!r}, method {method!r}")
    if method == "plugin":
        return df.transform(step["fn"])
    if method == "table-function":
        return apply_table_function(df, step["name"], step.get("args", ()))
    df = select_then_where(df, step.get("select"), step.get("where"))
    return statistics(df, step["stat"]) if kind == "compute" else df


def enabled(steps: Iterable[Mapping]) -> list[Mapping]:
    """Enabled steps in ascending numeric id."""
    return sorted((s for s in steps if s.get("enabled", True)), key=lambda s: int(s["id"]))


class Flow:
    def __init__(self, spec: Mapping):
        self.spec = spec

    def prepare(self, df: DataFrame) -> DataFrame:
        """The first enabled format step, then the shared prepare steps."""
        steps = enabled(self.spec.get("format", []))[:1] + enabled(self.spec.get("prepares", []))
        return reduce(run_step, steps, df)

    def results(self, prepared: DataFrame) -> dict[int, DataFrame]:
        """Statistics of every enabled set, by set id, over an already prepared frame."""
        return {
            int(s["id"]): self._set_result(prepared, s) for s in enabled(self.spec["sets"])
        }

    def apply(self, df: DataFrame) -> DataFrame:
        """All sets' statistics as one frame with the set's id in ``set_id``."""
        results = [
            r.withColumn("set_id", F.lit(set_id))
            for set_id, r in self.results(self.prepare(df)).items()
        ]
        if not results:
            return no_statistics(df).withColumn("set_id", F.lit(None).cast("int"))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)

    def on_batch(
        self,
        sinks: Mapping[int, Sink],
        step_sinks: Mapping[tuple[int, int], Sink] | None = None,
    ) -> Sink:
        """A ``foreachBatch`` function: prepare once, give every set's result to its sink.

        ``step_sinks`` names, by set id and step id, compute steps whose results go elsewhere;
        the set's sink gets the rest, and is not needed when no step is left for it. The
        prepared frame is kept only when several results read it.
        """
        outputs = []
        for one_set in enabled(self.spec["sets"]):
            set_id, steps = int(one_set["id"]), enabled(one_set["computes"])
            apart = [s for s in steps if (set_id, int(s["id"])) in (step_sinks or {})]
            rest = [s for s in steps if s not in apart]
            outputs += [(one_set, [s], step_sinks[set_id, int(s["id"])]) for s in apart]
            if rest or not apart:
                outputs.append((one_set, rest, sinks[set_id]))
        shared = len(outputs) > 1

        def run(batch: DataFrame, batch_id: int) -> None:
            prepared = self.prepare(batch)
            if shared:
                prepared.persist()
            try:
                for one_set, steps, sink in outputs:
                    sink(self._set_result(prepared, one_set, steps), batch_id)
            finally:
                if shared:
                    prepared.unpersist()

        return run

    @staticmethod
    def _set_result(
        prepared: DataFrame, one_set: Mapping, steps: Sequence[Mapping] | None = None
    ) -> DataFrame:
        """Compute steps see the set's prepared frame, not each other's results. Plain SQL
        computes that add up and read the same columns share one pass."""
        df = reduce(run_step, enabled(one_set.get("prepares", [])), prepared)
        shared: dict[tuple, list] = {}
        results = []
        for step in enabled(one_set["computes"]) if steps is None else steps:
            plain = step.get("method") == "spark-sql" and step.get("type") == "compute"
            if plain and not step.get("where") and not step.get("output"):
                shared.setdefault(tuple(step.get("select") or ()), []).append(step["stat"])
            else:
                result = run_step(df, step)
                results.append(result.transform(step["output"]) if step.get("output") else result)
        for select, stats in shared.items():
            results.append(statistics(select_then_where(df, list(select)), *stats))
        if not results:
            return no_statistics(df)
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)


def no_statistics(df: DataFrame) -> DataFrame:
    """What a set without an enabled compute step gives: the columns of statistics, no rows."""
    texts = ("key", "keyName", "data_type", "value_type", "cycle", "agg")
    return df.sparkSession.createDataFrame([], "value long, " + ", ".join(f"{t} string" for t in texts))


def record_udf(fn: Callable[..., object], returns: DataType | str):
    """A column function from a per-record Python function, run over Arrow batches.

    Prefer column expressions; this is for logic that only exists in Python.
    """

    @F.pandas_udf(returns)
    def apply(*columns: pd.Series) -> pd.Series:
        return pd.Series([fn(*values) for values in zip(*columns)], dtype="object")

    return apply


def apply_rows_in_batches(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: StructType | str,
    batch_rows: int,
) -> DataFrame:
    """Give each partition's rows to ``fn`` in groups of at most ``batch_rows`` rows."""
    if batch_rows < 1:
        raise ValueError("batch_rows must be at least 1")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            while len(held) >= batch_rows:
                yield fn(held.iloc[:batch_rows].reset_index(drop=True))
                held = held.iloc[batch_rows:]
        if held is not None and len(held):
            yield fn(held.reset_index(drop=True))

    return df.mapInPandas(run, schema)
