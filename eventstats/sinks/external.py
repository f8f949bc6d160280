"""Writers for outside stores. Options are built here; the connector is the user's."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame


def jdbc_options(
    url: str, table: str, driver: str | None = None, batch_size: int = 1000, **properties: str
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size), **properties}
    if driver:
        options["driver"] = driver
    return options


def elasticsearch_options(nodes: str, resource: str, id_field: str = "doc_id") -> dict[str, str]:
    """Options of the Spark connector for idempotent upserts by document id.

    An upsert replaces: write totals, such as ``forward_changed`` gives, not increments.
    """
    return {
        "es.nodes": nodes,
        "es.resource": resource,
        "es.mapping.id": id_field,
        "es.write.operation": "upsert",
    }


def write_external(
    kind: str, options: Mapping[str, str], mode: str = "append"
) -> Callable[[DataFrame, int], None]:
    """A batch sink for ``foreachBatch`` or ``Flow.on_batch``."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.format(kind).options(**options).mode(mode).save()

    return write
