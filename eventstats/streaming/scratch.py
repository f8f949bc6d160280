from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new directory under the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, a session on one machine takes its warehouse; on a cluster the warehouse
    may be a folder of the driver's own, so there the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or "cluster" in master:
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
