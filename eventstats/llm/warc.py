"""Dictionary-compressed WARC archives (operator 1).

A Zstandard dictionary is trained on a bounded sample of the records. Every archive file begins
with a skippable frame that holds the dictionary; each record follows as a frame of its own,
compressed with it, so that any record can be read alone from its offset. Records whose payload
another record has already are written as ``revisit`` records without it.

Tasks write their files through ``pyarrow.fs`` to the given folder (any URI that pyarrow knows),
under names that no other attempt uses. The index of records is the frame that the writer
returns and stores: files of lost attempts are in no index, so they are never read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventstats.llm.common import shared_folder, stored

#: Fixed values of the archive format.
DICTIONARY_MAGIC = 0x184D2A5D
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads below this many bytes are always written in full.
MIN_REVISIT_BYTES = 100
#: The dictionary is trained on at most so many records, each cut to so many bytes.
SAMPLE_RECORDS = 1000
SAMPLE_BYTES = 16 << 10
DICTIONARY_BYTES = 64 << 10
#: A task begins a new file when one has reached this size.
FILE_BYTES = 64 << 20

INDEX_SCHEMA = "page_id long, file string, offset long, length long"
READ_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary"
)


def plan_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, size, refers_to``: which pages are revisits of which.

    Of pages with equal payloads of at least ``min_bytes`` bytes the smallest ``page_id`` is the
    response. Pages with a null id, and rows that repeat the smallest id, are responses too. The
    smallest ids are found by partial aggregation over digests; only digests that occur more
    than once are joined back, by a join that adaptive execution can split at a hot digest.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    digests = pages.select("page_id", payload.alias("payload")).select(
        "page_id", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("size")
    )
    firsts = (
        digests.filter((F.col("size") >= min_bytes) & F.col("page_id").isNotNull())
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id"))
        .filter("last_id > first_id")
        .select(F.col("digest").alias("_digest"), "first_id")
    )
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn(
        "size", F.octet_length("payload").cast("long")
    )
    first = F.when(F.col("page_id") > F.col("first_id"), F.col("first_id"))
    return rows.join(firsts, F.col("digest") == F.col("_digest"), "left").select(
        "page_id", "url", "payload", "digest", "size", first.alias("refers_to")
    )


def train_dictionary(
    pages: DataFrame, records: int = SAMPLE_RECORDS, size: int = DICTIONARY_BYTES
) -> bytes:
    """A dictionary from a sample spread by a hash of the id; empty if there is too little text.

    Ids are chosen first, so that the driver gets ``records`` times ``SAMPLE_BYTES`` at most.
    """
    usable = pages.filter("page_id is not null and html <> ''")
    ids = usable.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(records).collect()
    chosen = usable.filter(F.col("page_id").isin([r[0] for r in ids]))
    cut = F.substring("html", 1, SAMPLE_BYTES).alias("t")
    texts = chosen.groupBy("page_id").agg(F.min(cut).alias("t")).orderBy("page_id").select("t")
    samples = [row[0].encode()[:SAMPLE_BYTES] for row in texts.collect()]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few or too short samples for a dictionary
        return b""


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One record, not compressed. Control characters in an address are percent-encoded."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url) if url else ""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if refers_to is not None else payload)
    lines = [
        VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}:{digest}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if target:
        lines.insert(4, f"WARC-Target-URI: {target}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}:{digest}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload (what follows the HTTP header) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _page_of(value: str | None) -> int | None:
    number = (value or "").removeprefix("<urn:page:").partition(":")[0]
    return int(number) if number else None


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    min_bytes: int = MIN_REVISIT_BYTES,
    file_bytes: int = FILE_BYTES,
    date: str = "1970-01-01T00:00:00Z",
    level: int = 3,
) -> DataFrame:
    """Write a record for each row of ``pages``; return the stored index of records.

    ``pages`` has ``page_id, url, html``; other columns are not read. Null html is an empty
    payload, a null address is left out, a null id is written as an empty id. Every row gives a
    record, also repeated ones. An empty table gives an empty index and no file.
    """
    folder = (folder or shared_folder(pages.sparkSession, "warc")).rstrip("/")
    dictionary = train_dictionary(pages)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frame = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary
        used = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=level, dict_data=used)
        fs, base = pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        fs.create_dir(base, recursive=True)
        out, name, at = None, None, 0
        try:
            for batch in batches:
                index = []
                for row in zip(*(column.to_pylist() for column in batch.columns)):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name = f"{uuid.uuid4().hex}.warc.zst"
                        out, at = fs.open_output_stream(f"{base}/{name}"), len(frame)
                        out.write(frame)
                    data = compressor.compress(record_bytes(*row, date))
                    out.write(data)
                    index.append((row[0], name, at, len(data)))
                    at += len(data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*index) if index else [[]] * 4,
                     (pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                    ["page_id", "file", "offset", "length"],
                )
        finally:
            if out is not None:
                out.close()

    records = plan_records(pages, min_bytes).select("page_id", "url", "payload", "digest", "refers_to")
    index = stored(records.mapInArrow(write, INDEX_SCHEMA), "warc-index")
    return index.withColumn("folder", F.lit(folder))


def iterate_archive(stream, file: str) -> Iterator[bytes]:
    """The records of one archive, in order, decompressed with the dictionary it brings."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError(f"{file} does not begin with a dictionary frame")
    data = stream.read(size)
    used = zstandard.ZstdCompressionDict(data) if data else None
    decompressor = zstandard.ZstdDecompressor(dict_data=used)
    rest = b""
    while True:
        frame = decompressor.decompressobj()
        record = []
        while not frame.eof:
            rest = rest or stream.read(1 << 20)
            if not rest:
                if record:
                    raise ValueError(f"{file} ends within a record")
                return
            record.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else b""
        yield b"".join(record)


def read_archives(index: DataFrame, payloads: bool = False) -> DataFrame:
    """All records of the archives that the index names, one task's share of files at a time.

    Payload size and digest of responses are taken from the payload itself; a revisit has the
    digest of its header and no size, see ``resolve_revisits``. ``payloads=False`` leaves the payload column null.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, base = pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
                rows, held = [], 0
                with fs.open_input_stream(f"{base}/{file}") as stream:
                    for data in iterate_archive(stream, file):
                        fields, payload = parse_record(data)
                        full = fields["WARC-Type"] == "response"
                        rows.append((
                            _page_of(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"),
                            fields["WARC-Type"], _page_of(fields.get("WARC-Refers-To")),
                            len(payload) if full else None,
                            hashlib.sha256(payload).hexdigest()
                            if full
                            else fields["WARC-Payload-Digest"].removeprefix("sha256:"),
                            payload if payloads and full else None,
                        ))
                        held += len(payload) if payloads else 200
                        if held >= 8 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                yield _batch(rows)

    spread = index.sparkSession.sparkContext.defaultParallelism
    files = index.select("folder", "file").distinct().repartition(max(spread, 1))
    return files.mapInArrow(read, READ_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    columns = list(zip(*rows)) or [[]] * 7
    names = [part.split()[0] for part in READ_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Give revisits the payload size of the response with the id and digest they refer to.

    A response may be named by any number of revisits: the join is of narrow rows, and adaptive
    execution can split it at a hot response.
    """
    narrow = stored(records.drop("payload"), "warc-records")
    responses = narrow.filter("record_type = 'response'")
    targets = (
        responses.filter("page_id is not null")
        .groupBy(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"))
        .agg(F.first("payload_bytes").alias("_bytes"))
    )
    same = (F.col("refers_to") == F.col("_id")) & (F.col("payload_digest") == F.col("_digest"))
    visits = narrow.filter("record_type = 'revisit'").join(targets, same, "left")
    visits = visits.withColumn("payload_bytes", F.col("_bytes")).drop("_id", "_bytes", "_digest")
    return responses.unionByName(visits)
