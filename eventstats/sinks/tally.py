"""Additive results: each batch adds its values to documents named by their dimensions.

Nothing is read and written back. A batch is stored as increments under its batch id, so a
replay replaces its own increments, and late events simply add to their old document.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventstats.functions import doc_id, raw_data, typed_cast
from eventstats.functions.values import CAST_TYPES
from eventstats.sinks.batched import BatchTable

ID = "doc_id"
_ROUTE = "_to_"


def typed_values(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast value fields by configured type name; only numbers can be added up."""
    for name, type_name in types.items():
        if CAST_TYPES.get(type_name.strip().lower(), "string") == "string":
            raise ValueError(f"value {name!r} of type {type_name!r} cannot be added up")
    return df.withColumns({n: typed_cast(F.col(n), t) for n, t in types.items()})


class TallyTable:
    """Documents with summed values. ``values`` maps each summed field to its type name;
    all other fields make up the document and its id."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        values: Mapping[str, str] | None = None,
        run: str = "0",
    ):
        """``run`` names the stream checkpoint that the batch ids belong to."""
        self.values = dict(values or {"value": "long"})
        self.table = BatchTable(spark, path, run)

    def add_batch(self, df: DataFrame, batch_id: int) -> None:
        """Store the batch's increments, already summed per document."""
        self.table.write_batch(self._summed(typed_values(df, self.values)), batch_id)

    def add_statistics(self, df: DataFrame, batch_id: int) -> None:
        """The same for rows that are one per document already, such as ``statistics()``
        gives: saves the shuffle."""
        self.table.write_batch(typed_values(df, self.values), batch_id)

    def current(self) -> DataFrame:
        """Documents with ``doc_id`` and their values so far."""
        rows = self.table.read()
        if rows is None:
            raise ValueError(f"no batch was written to {self.table.path}")
        documents = self._summed(rows)
        return documents.withColumn(ID, doc_id(*self._fields(documents)))

    def changed(self, batch_id: int) -> DataFrame:
        """Documents that a batch of this run touched, with ``doc_id`` and their totals so far.

        Totals replace totals in an outside store, so writing them again does no harm.
        """
        batch, rows = self.table.read_batch(batch_id), self.table.read()
        if batch is None or rows is None:
            raise ValueError(f"batch {batch_id} was not written to {self.table.path}")
        batch = batch.unionByName(rows.limit(0), allowMissingColumns=True)
        fields = self._fields(rows)
        touched = batch.select(*fields).distinct().withColumnsRenamed({c: f"_t_{c}" for c in fields})
        on = [rows[c].eqNullSafe(touched[f"_t_{c}"]) for c in fields] or [F.lit(True)]
        documents = self._summed(rows.join(touched, reduce(lambda a, b: a & b, on), "left_semi"))
        return documents.withColumn(ID, doc_id(*fields))

    def with_raw_data(self, name: str = "raw_data") -> DataFrame:
        """Current documents with a JSON copy of themselves."""
        documents = self.current()
        fields = [c for c in documents.columns if c != ID]
        return documents.withColumn(name, raw_data(*fields))

    def compact(self, upto: int) -> None:
        self.table.fold(upto, self._summed)

    def remove_replaced(self, grace_seconds: float = 3600) -> int:
        """Delete what folds have replaced; see ``BatchTable.remove_replaced``."""
        return self.table.remove_replaced(grace_seconds)

    def _fields(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if c not in self.values and c != ID]

    def _summed(self, df: DataFrame) -> DataFrame:
        sums = [F.sum(name).cast(df.schema[name].dataType).alias(name) for name in self.values]
        return df.groupBy(*self._fields(df)).agg(*sums)


def forward_changed(
    tally: TallyTable, write: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """A batch sink that adds statistics to ``tally`` and gives the new totals of the documents
    it touched to ``write``: an outside store that can only replace still adds up."""

    def run(df: DataFrame, batch_id: int) -> None:
        tally.add_statistics(df, batch_id)
        write(tally.changed(batch_id), batch_id)

    return run


def write_routed(
    table: BatchTable,
    df: DataFrame,
    batch_id: int,
    destination: Sequence[str] = ("index", "type"),
) -> None:
    """Write a batch whose rows name their own destination, one directory per destination.

    The directories are named by marked copies of the columns, because Spark would read a
    directory called ``type=01`` as the number 1.
    """
    copies = {_ROUTE + name: _route(F.col(name).cast("string")) for name in destination}
    table.write_batch(df.withColumns(copies), batch_id, *copies)


def read_routed(table: BatchTable, **destination: str) -> DataFrame | None:
    """Rows of one destination; only its directories are read."""
    rows = table.read()
    if rows is None:
        return None
    for name, value in destination.items():
        rows = rows.filter(F.col(_ROUTE + name) == _route(F.lit(value)))
    return rows.drop(*[c for c in rows.columns if c.startswith(_ROUTE)])


def _route(value: Column) -> Column:
    return F.concat(F.lit("_"), value)
