"""Byte-level BPE encoding and decoding by overlapping chunks (operator 3).

Long texts are cut into overlapping chunks that are pre-tokenised in parallel. Two neighbours
agree from the first boundary that both have in their overlap, because a match of the pattern
depends only on the text from its start on. The text is cut at these boundaries, save those behind
white space, whose matches look at what follows. The pieces are encoded in parallel, and the ids of
a text are put together in order. A text no longer than a chunk is a single piece. Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
import heapq
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventstats.llm.common import stored, worker_state

#: Characters that a chunk advances by, and that it shares with the next one.
CHUNK = 32 << 10
OVERLAP = 1 << 10
#: A boundary this near to the end of a cut text may be moved by what follows.
LOOKAHEAD = 3
#: Entries of each of the two generations of a worker's cache of encoded pre-tokens, and the longest
#: pre-token it keeps.
CACHE_ENTRIES = 160_000
CACHE_CHARS = 64
#: Up to so many bytes a scan for the lowest rank is faster than a heap.
SCAN_BYTES = 48


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a .tiktoken file, present on every machine at the same path."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=8)
def compiled(pattern: str):
    return regex.compile(pattern)


def encode_pretoken(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge adjacent parts, lowest rank first and leftmost among equals, until none can be."""
    if data in ranks:
        return [ranks[data]]
    if len(data) <= SCAN_BYTES:
        return _encode_by_scan(data, ranks)
    end = len(data)
    after = list(range(1, end + 1))  # where the part that begins here ends
    before = list(range(-1, end - 1))
    alive = [True] * end
    heap = [(r, i, i + 2) for i in range(end - 1) if (r := ranks.get(data[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, left, stop = heapq.heappop(heap)
        right = after[left] if alive[left] else end
        if right >= end or after[right] != stop:
            continue
        alive[right] = False
        after[left] = stop
        if stop < end:
            before[stop] = left
            if (r := ranks.get(data[left : after[stop]])) is not None:
                heapq.heappush(heap, (r, left, after[stop]))
        if left and (r := ranks.get(data[before[left] : stop])) is not None:
            heapq.heappush(heap, (r, before[left], stop))
    out, at = [], 0
    while at < end:
        out.append(ranks[data[at : after[at]]])
        at = after[at]
    return out


def _little_endian(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def _encode_by_scan(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for short data; ``pairs`` holds the rank of each two neighbours."""
    none = len(ranks) + (1 << 30)
    parts = [data[i : i + 1] for i in range(len(data))]
    pairs = [ranks.get(data[i : i + 2], none) for i in range(len(data) - 1)]
    while pairs and (lowest := min(pairs)) < none:
        i = pairs.index(lowest)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


class PretokenCache(dict):
    """Pre-token to ids as little-endian 32-bit bytes, in two generations, so memory is bounded.

    A full generation becomes the old one, and the old one goes; what is met again in the old one
    moves to the new one, so frequent pre-tokens stay.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        super().__init__()
        self.ranks = ranks
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        out = self.old.get(piece)
        if out is None:
            out = _little_endian(encode_pretoken(piece.encode(), self.ranks))
            if len(piece) > CACHE_CHARS:
                return out
        if len(self) >= CACHE_ENTRIES:
            self.old = dict(self)
            self.clear()
        self[piece] = out
        return out


class _Encoder:
    """What a worker needs of a vocabulary, kept from task to task."""

    def __init__(self, vocabulary: str, pattern: str) -> None:
        self.cache, self.find = PretokenCache(load_ranks(vocabulary)), compiled(pattern).findall
        self._bytes: dict[int, bytes] | None = None

    @property
    def bytes(self) -> dict[int, bytes]:
        if self._bytes is None:
            self._bytes = {i: b for b, i in self.cache.ranks.items()}
        return self._bytes

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.cache.__getitem__, self.find(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _encoder(vocabulary: str, pattern: str = "") -> _Encoder:
    return worker_state(("byte_bpe", vocabulary, pattern), lambda: _Encoder(vocabulary, pattern))


def _encode_rows(vocabulary: str, pattern: str, decoded: bool, rows: int = 256):
    """A function for mapInArrow: replaces the last column, a text, by ``n_tokens, ids``.

    With ``decoded`` the ids are decoded again in the same task, as a further column.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, pattern)
        for batch in batches:
            for at in range(0, len(batch), rows):
                part = batch.slice(at, rows)
                ids = [encoder.encode(t or "") for t in part.columns[-1].to_pylist()]
                columns = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                names = ["n_tokens", "ids"]
                if decoded:
                    columns.append(pa.array(map(encoder.decode, ids), pa.binary()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], [*part.schema.names[:-1], *names])

    return run


def chunk_bounds(text: str, pattern: str, last: bool, overlap: int, first: bool) -> tuple[list[int], list[int]]:
    """Boundaries of a chunk in the overlaps with the chunk before and with the chunk after.

    Those behind white space are left out: matches of white space may depend on the character behind
    them, so a piece that ends there could fall apart otherwise than in the whole text.
    """
    ends = [m.end() for m in compiled(pattern).finditer(text) if not text[m.end() - 1].isspace()]
    head = [] if first else [e for e in ends if e <= overlap]
    safe = len(text) - LOOKAHEAD
    tail = [] if last else [e for e in ends if len(text) - overlap < e <= safe]
    return head, tail


def _pieces(long: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """``key, piece, text``: long texts (``key, text``) cut where their chunks resynchronise."""
    count = F.ceil(F.length("text") / F.lit(chunk)).cast("int")
    chunks = long.select("key", "text", F.explode(F.sequence(F.lit(0), count - 1)).alias("no"), count.alias("chunks"))
    chunks = chunks.select(
        "key", "no", (F.col("no") == F.col("chunks") - 1).alias("last"),
        F.substring("text", F.col("no") * chunk + 1, F.lit(chunk + overlap)).alias("part"),
    ).repartition("key", "no")

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                chunk_bounds(t, pattern, last, overlap, no == 0)
                for no, last, t in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))
            ]
            positions = pa.list_(pa.int64())
            start = batch.column(1).to_pylist()
            heads = [[p + no * chunk for p in h] for no, (h, _) in zip(start, found)]
            tails = [[p + no * chunk for p in t] for no, (_, t) in zip(start, found)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(heads, positions), pa.array(tails, positions)],
                ["key", "no", "head", "tail"])

    found = chunks.mapInArrow(bounds, "key long, no int, head array<long>, tail array<long>")
    order = Window.partitionBy("key").orderBy("no")  # as many rows as the text has chunks
    both = F.array_intersect(F.lag("tail").over(order), "head")
    cuts = found.select("key", "no", F.array_min(both).alias("cut"))
    cuts = cuts.groupBy("key").agg(
        # Where two chunks share no boundary there is no cut, and their pieces are one.
        F.sort_array(F.collect_set(F.when(F.col("no") == 0, F.lit(0).cast("long")).otherwise(F.col("cut")))).alias("cuts"))
    stops = F.concat(F.slice("cuts", 2, F.greatest(F.size("cuts") - 1, F.lit(0))), F.array(F.length("text").cast("long")))
    cut = long.join(cuts, "key").select("key", "text", F.posexplode(F.arrays_zip(F.col("cuts").alias("a"), stops.alias("b"))))
    a, b = F.col("col")["a"].cast("int"), F.col("col")["b"].cast("int")
    return cut.select("key", F.col("pos").alias("piece"), F.substring("text", a + 1, b - a).alias("text"))


def encode_documents(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    decoded: bool = False,
) -> DataFrame:
    """``doc_id, n_tokens, ids`` for every row; ``ids`` are little-endian unsigned 32-bit.

    With ``decoded`` the bytes that the ids decode to follow, without a second pass of Python.

    Special tokens are ordinary text. Null and empty texts have no tokens. Every row gives a
    row, also repeated ones and those with a null id; other columns are not read. Texts of any
    length are encoded whole. An empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    is_long = F.coalesce(F.length("text") > chunk, F.lit(False))
    kind = docs.schema[doc_id].dataType.simpleString()
    values = "n_tokens long, ids binary" + ", decoded binary" * decoded
    run = _encode_rows(vocabulary, pattern, decoded)
    short = rows.filter(~is_long).mapInArrow(run, f"doc_id {kind}, {values}")
    long = stored(rows.filter(is_long).withColumn("key", F.monotonically_increasing_id()), "long-texts")
    pieces = _pieces(long.select("key", "text"), pattern, chunk, overlap).repartition("key", "piece")
    ids = pieces.mapInArrow(run, f"key long, piece int, {values}")

    def join(part: pa.Table) -> pa.Table:
        part = part.sort_by("piece")
        binary = ["ids", *["decoded"] * decoded]
        whole = {c: pa.array([b"".join(part[c].to_pylist())], pa.binary()) for c in binary}
        total = pa.array([sum(part["n_tokens"].to_pylist())], pa.int64())
        return pa.table({"key": part["key"][:1], "n_tokens": total, **whole})

    joined = ids.groupBy("key").applyInArrow(join, f"key long, {values}")
    return short.unionByName(long.select("key", "doc_id").join(joined, "key").drop("key"))


def decode_documents(encoded: DataFrame, vocabulary: str, rows: int = 256) -> DataFrame:
    """Add ``decoded``, the bytes of ``ids``; null stays null. An unknown id is an error."""
    names = [c for c in encoded.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        for batch in batches:
            for at in range(0, len(batch), rows):
                part = batch.slice(at, rows)
                ids = part.column(names.index("ids")).to_pylist()
                texts = [x if x is None else encoder.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], [*names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*names).schema)
    return encoded.select(*names).mapInArrow(run, f"{fields}, decoded binary")
