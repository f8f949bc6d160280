"""A parquet table written one batch at a time, safe to replay.

    <path>/batches/run=R/batch_id=N/        rows of batch N; writing N again replaces them
    <path>/folded/run=R/upto=N/<unique>/    rows that replace batches 0..N of the run

A run is one stream checkpoint: batch ids start again at 0 with a new one, and its batches
stand beside those of other runs. Readers use the newest fold of each run and the batches
after it. A directory counts once Spark has marked its job as done; a fold goes to a
directory of its own and removes nothing, so a fold that was cut short is never read.

Columns that a later batch adds are null in earlier rows; one name with two types is an
error, and so is a batch missing between two others. Write every batch, also an empty one.
``remove_replaced`` deletes what folds have replaced, when no reader can use it any more.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_DONE = "_SUCCESS"


class BatchTable:
    def __init__(self, spark: SparkSession, path: str, run: str = "0"):
        self.spark = spark
        self.path = path.rstrip("/")
        self.run = "run=" + quote(run, safe="")

    def write_batch(self, df: DataFrame, batch_id: int, *partition_by: str) -> None:
        self._write(df, f"batches/{self.run}/batch_id={batch_id}", partition_by)

    def read_batch(self, batch_id: int) -> DataFrame | None:
        """Rows of one batch of this run, None when it was never written."""
        path = f"{self.path}/batches/{self.run}/batch_id={batch_id}"
        return self._load([path], path) if self._done(path) else None

    def read(self, before: int | None = None) -> DataFrame | None:
        """Rows of all runs; of this run only batches before ``before``, if that is given.

        None when there are none yet.
        """
        root = f"{self.path}/*"
        runs = {p.split("/")[-2] for p in self._done(f"{root}/run=*/batch_id=*")}
        runs |= {p.split("/")[-3] for p in self._done(f"{root}/run=*/upto=*/*")}
        parts = []
        for run in sorted(runs):
            parts += self._parts(run, before if run == self.run else None)
        return reduce(_united, parts) if parts else None

    def fold(
        self, upto: int, fn: Callable[[DataFrame], DataFrame], *partition_by: str
    ) -> None:
        """Replace batches 0..upto of this run by ``fn`` of their rows. Only fold batches
        that are done."""
        parts = self._parts(self.run, upto + 1)
        if parts:
            name = f"folded/{self.run}/upto={upto}/{uuid.uuid4().hex}"
            self._write(fn(reduce(_united, parts)), name, partition_by)

    def remove_replaced(self, grace_seconds: float = 3600) -> int:
        """Delete older folds and folded batches of this run; gives the number of directories.

        Nothing goes before the newest fold is ``grace_seconds`` old, so that readers that began
        before it can end. The last folded batch stays for those who compare with it.
        """
        folds = self._done(f"{self.path}/folded/{self.run}/upto=*/*")
        if not folds:
            return 0
        newest = self._newest(folds)
        if time.time() - folds[newest] / 1000 < grace_seconds:
            return 0
        upto = _upto(newest)
        batches = self._done(f"{self.path}/batches/{self.run}/batch_id=*")
        gone = [p for p in folds if p != newest]
        gone += [p for p in batches if int(p.rpartition("=")[2]) < upto]
        for path in gone:
            jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(self._hadoop_conf()).delete(jpath, True)
        return len(gone)

    @staticmethod
    def _newest(folds: dict[str, int]) -> str | None:
        return max(folds, key=lambda p: (_upto(p), folds[p], p), default=None)

    def _write(self, df: DataFrame, name: str, partition_by: Sequence[str]) -> None:
        """Rebalancing gives each directory few files, and a large one several tasks."""
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        writer = df.write.mode("overwrite").partitionBy(*partition_by)
        writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        writer.parquet(f"{self.path}/{name}")

    def _parts(self, run: str, before: int | None) -> list[DataFrame]:
        """The newest fold of a run and the batches after it."""
        folds = self._done(f"{self.path}/folded/{run}/upto=*/*")
        usable = {p: t for p, t in folds.items() if before is None or _upto(p) < before}
        fold = self._newest(usable)

        root = f"{self.path}/batches/{run}"
        ids = {int(p.rpartition("=")[2]): p for p in self._done(f"{root}/batch_id=*")}
        after = -1 if fold is None else _upto(fold)
        wanted = sorted(i for i in ids if i > after and (before is None or i < before))
        if wanted:
            first = wanted[0] if fold is None else after + 1
            missing = sorted(set(range(first, wanted[-1])) - set(wanted))
            if missing:
                raise ValueError(f"batches {missing[:10]} are missing in {root}")
        parts = [self._load([fold], fold)] if fold else []
        if wanted:
            batches = self._load([ids[i] for i in wanted], root)
            parts.append(batches if batches is None else batches.drop("batch_id"))
        return [p for p in parts if p is not None]

    def _done(self, pattern: str) -> dict[str, int]:
        """Directories whose write is complete, with the time of their mark."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/{_DONE}")
        found = path.getFileSystem(self._hadoop_conf()).globStatus(path)
        return {str(s.getPath().getParent()): s.getModificationTime() for s in found or []}

    def _hadoop_conf(self):
        return self.spark._jsparkSession.sessionState().newHadoopConf()

    def _load(self, paths: list[str], base: str) -> DataFrame | None:
        try:
            reader = self.spark.read.option("basePath", base).option("mergeSchema", True)
            return reader.parquet(*paths)
        except AnalysisException as error:
            if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # no rows and no files
                return None
            raise


def _upto(fold: str) -> int:
    return int(fold.split("/")[-2].removeprefix("upto="))


def _united(a: DataFrame, b: DataFrame) -> DataFrame:
    odd = [f.name for f in b.schema if f.name in a.columns and a.schema[f.name].dataType != f.dataType]
    if odd:
        raise ValueError(f"columns {odd} changed their types")
    return a.unionByName(b, allowMissingColumns=True)
