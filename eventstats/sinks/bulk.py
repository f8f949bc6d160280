"""A Python data source that writes documents as bulk files of a search index.

    spark.dataSource.register(BulkFiles)
    df.write.format("bulk_files").option("path", folder).option("index", "stats").mode("append").save()
    stream.writeStream.format("bulk_files").option("path", folder)...

Every document is two lines, an action that names the index and the document's id, and the document.
A task writes files of its own, each small enough for one bulk request; the driver commits by a
manifest that lists the files of all tasks, one manifest for each batch of a stream or each write
of a table. Files that no manifest names are those of tasks that failed or were run twice: readers
do not see them. A batch that is replayed replaces its manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

_MANIFESTS = "_manifests"
#: A file is closed once it has so many bytes.
FILE_BYTES = 8 << 20


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]
    documents: int


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, whatever store it is in, and the path there."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path)


class _Files:
    """What both writers share: writing a task's file, a manifest, and removing files."""

    def __init__(self, schema: StructType, options: dict, overwrite: bool = False) -> None:
        for name in ("path", "index"):
            if not options.get(name):
                raise ValueError(f"option {name!r} is missing")
        self.path, self.index = options["path"].rstrip("/"), options["index"]
        self.id_field = options.get("id", "doc_id")
        self.action = options.get("action", "index")
        self.names = [f.name for f in schema.fields]
        self.overwrite = overwrite
        if self.id_field not in self.names:
            raise ValueError(f"no column {self.id_field!r} for the document's id")

    def write(self, iterator: Iterator[Row]) -> _Written:
        store, folder = _opened(self.path)
        store.create_dir(folder, recursive=True)
        files, count, rows = [], 0, iter(iterator)
        for row in rows:
            files.append(f"part-{uuid.uuid4().hex}.ndjson")
            with store.open_output_stream(f"{folder}/{files[-1]}") as out:
                size = 0
                while row is not None:
                    data = self._lines(row)
                    out.write(data)
                    size, count = size + len(data), count + 1
                    row = next(rows, None) if size < FILE_BYTES else None
        return _Written(files, count)

    def _lines(self, row: Row) -> bytes:
        document = dict(zip(self.names, row))
        target = {"_index": self.index, "_id": document.pop(self.id_field)}
        return (json.dumps({self.action: target}) + "\n" + json.dumps(document, default=str) + "\n").encode()

    def _commit(self, messages: list, name: str) -> None:
        written = [m for m in messages if m is not None]
        store, folder = _opened(self.path)
        manifests = f"{folder}/{_MANIFESTS}"
        store.create_dir(manifests, recursive=True)
        old = store.get_file_info(fs.FileSelector(manifests)) if self.overwrite else []
        content = {"files": [f for m in written for f in m.files], "documents": sum(m.documents for m in written)}
        draft = f"{manifests}/.{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as out:
            out.write(json.dumps(content).encode())
        store.move(draft, f"{manifests}/{name}")  # a manifest is there whole or not at all
        for info in old:
            store.delete_file(info.path)

    def _abort(self, messages: list) -> None:
        store, folder = _opened(self.path)
        for message in messages:
            for file in message.files if message is not None else ():
                store.delete_file(f"{folder}/{file}")


class _TableWriter(_Files, DataSourceWriter):
    def commit(self, messages: list) -> None:
        self._commit(messages, f"write-{uuid.uuid4().hex}")

    def abort(self, messages: list) -> None:
        self._abort(messages)


class _StreamWriter(_Files, DataSourceStreamWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self._commit(messages, f"batch-{batchId}")

    def abort(self, messages: list, batchId: int) -> None:
        self._abort(messages)


class BulkFiles(DataSource):
    """Options: ``path`` (shared by all machines), ``index``, ``id`` (``doc_id``), ``action`` (``index``)."""

    @classmethod
    def name(cls) -> str:
        return "bulk_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _TableWriter(schema, self.options, overwrite)

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return _StreamWriter(schema, self.options)


def committed_files(path: str) -> list[str]:
    """The files that manifests name: what a loader may send."""
    store, folder = _opened(path.rstrip("/"))
    selector = fs.FileSelector(f"{folder}/{_MANIFESTS}", allow_not_found=True)
    files: list[str] = []
    for info in sorted(store.get_file_info(selector), key=lambda i: i.path):
        if not info.base_name.startswith("."):
            with store.open_input_stream(info.path) as content:
                files += json.loads(content.read())["files"]
    return [f"{path.rstrip('/')}/{f}" for f in files]


def read_bulk_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Committed documents as ``_index, _id`` and the fields of ``schema``.

    A line and the one before it make a document, so files, which are small, are read whole.
    """
    files = committed_files(path)
    if not files:
        return spark.createDataFrame([], f"_index string, _id string, {schema}")
    lines = spark.read.text(files, wholetext=True)
    pairs = lines.select(F.split(F.col("value"), "\n").alias("lines")).select(
        F.posexplode("lines").alias("at", "line"), "lines")
    action = F.element_at("lines", F.col("at")).alias("action")
    pairs = pairs.filter("at % 2 = 1").select(action, "line")
    target = F.from_json("action", "map<string, struct<_index: string, _id: string>>")
    return pairs.select(F.map_values(target)[0].alias("t"), F.from_json("line", schema).alias("d")).select("t.*", "d.*")
