"""Removal of word windows that occur earlier, behind a count-min prefilter (operator 13).

First pass: every task counts the fingerprints of its windows in a count-min sketch of two rows whose
counters stop at two; the sketches are shuffled by segments and added up. What is left of the sum is
one bit a counter, "two or more". A counter is never less than the count of a window that falls on
it, so a window that is repeated anywhere always has both bits.

Second pass: windows with both bits are grouped exactly, by 96 bits of their fingerprints. A task
first drops what it can decide alone: of its equal windows only the earliest goes on. So a passage
that a third of all documents hold is met once a task and not once a document. The others come back
to their documents as word spans.

The sketch is sized by the bytes of the texts up to ``MAX_CELLS`` counters; beyond that more windows
pass the prefilter for nothing, which costs time and never changes a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventstats.llm.common import stored

#: Words of a window.
WINDOW = 20
#: Counters of both rows together: so many a byte of text, rounded up to a power of two, and at most
#: so many (a bit each in the broadcast: 64 MB).
CELLS_PER_BYTE = 0.6
MAX_CELLS = 1 << 29
MIN_CELLS = 1 << 18
#: Counters of a segment of the sketch, the unit that is shuffled and merged.
SEGMENT = 1 << 16
#: Words that a task works on at a time.
CHUNK_WORDS = 2 << 20
#: Bytes of text for each group of the exact pass and for each group of returned spans.
GROUP_BYTES = 8 << 20
#: Words whose codes a worker remembers.
CACHE_WORDS = 200_000

LAST_ID = (1 << 63) - 1


class _WordCodes(dict):
    """Word (bytes) to a 64-bit code; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = code = xxhash.xxh64_intdigest(word)
        return code


def _mixed(left: np.ndarray, right: np.ndarray, seed: int) -> np.ndarray:
    out = left * np.uint64(0x9E3779B97F4A7C15 + 2 * seed) + right
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93 + 2 * seed)
    out ^= out >> np.uint64(29)
    return out


def fingerprints(codes: np.ndarray, window: int, seed: int) -> np.ndarray:
    """A 64-bit fingerprint of every ``window`` consecutive codes, by doubling."""
    found, done, power, size = None, 0, codes, 1
    while True:
        if window & size:
            if found is None:
                found = power
            else:
                n = len(codes) - done - size + 1
                found = _mixed(found[:n], power[done : done + n], seed)
            done += size
        if done == window:
            return found
        power = _mixed(power[: len(power) - size], power[size:], seed)
        size *= 2


class _Chunk:
    """Windows of some documents: ``doc`` (its place), ``start`` (word) and two fingerprints each."""

    def __init__(self, docs: list, parts: list[np.ndarray], window: int) -> None:
        self.docs = docs
        sizes = np.array([len(p) for p in parts], np.int64)
        counts = np.maximum(sizes - window + 1, 0)
        codes = np.concatenate([*parts, np.zeros(window, np.uint64)])
        self.doc = np.repeat(np.arange(len(parts), dtype=np.int64), counts)
        self.start = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        at = self.start + np.repeat(np.cumsum(sizes) - sizes, counts)
        self.a = fingerprints(codes, window, 1)[at]
        self.b = fingerprints(codes, window, 2)[at]


def _chunks(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[_Chunk]:
    """Batches whose last column is the text, as bytes, in chunks of about ``CHUNK_WORDS``."""
    codes = _WordCodes()
    docs, parts, words = [], [], 0
    for batch in batches:
        keys = list(zip(*(c.to_pylist() for c in batch.columns[:-1]))) or [()] * len(batch)
        for key, text in zip(keys, batch.columns[-1]):
            found = (text.as_py() or b"").split()
            if len(found) < window:
                continue
            docs.append(key)
            parts.append(np.fromiter(map(codes.__getitem__, found), np.uint64, len(found)))
            words += len(found)
            if words >= CHUNK_WORDS:
                yield _Chunk(docs, parts, window)
                docs, parts, words = [], [], 0
    if docs:
        yield _Chunk(docs, parts, window)


def _cells(a: np.ndarray, b: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The counter of each window in the first row and in the second."""
    mask = np.uint64(cells // 2 - 1)
    return (a & mask).astype(np.uint32), ((b & mask) + np.uint64(cells // 2)).astype(np.uint32)


def pack_gaps(sorted_cells: np.ndarray, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gaps between sorted distinct cells as bytes, and where the bytes of each segment end.

    A gap of 255 or more is that many bytes 255 and one byte for the rest. The first cell of a
    segment counts from the segment's begin. ``segments`` are the segments to list, ascending.
    """
    cells = sorted_cells.astype(np.int64)
    segment = cells // SEGMENT
    gaps = np.diff(cells, prepend=0)
    first = np.append(True, segment[1:] != segment[:-1])[: len(cells)]
    gaps[first] = cells[first] % SEGMENT
    escapes = gaps // 255
    ends = np.cumsum(escapes + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, 255, np.uint8)
    out[ends - 1] = gaps % 255
    last = np.searchsorted(segment, segments, side="right")
    return out, np.append(0, ends)[last]


def unpack_gaps(data: bytes) -> np.ndarray:
    """The places within a segment that ``pack_gaps`` wrote."""
    steps = np.frombuffer(data, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != 255]


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer(np.append(0, ends).astype(np.int32).tobytes())
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, offsets, pa.py_buffer(data.tobytes())])


def _sketch(cells: int, window: int):
    """For mapInArrow: texts to ``segment, once, twice``, cells counted at least once and twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, window):
            found = np.concatenate(_cells(chunk.a, chunk.b, cells))
            del chunk
            found.sort()
            first = np.append(True, found[1:] != found[:-1])
            again = np.append(~first[1:], False) & first
            once, twice = found[first], found[again]
            segments = np.unique(once // np.uint32(SEGMENT)).astype(np.int64)
            columns = [_binary(*pack_gaps(x, segments)) for x in (once, twice)]
            yield pa.RecordBatch.from_arrays([pa.array(segments.astype(np.int32)), *columns], ["segment", "once", "twice"])

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over rows sorted by segment: the counters that reach two, a bit each."""
    now, counts = None, np.zeros(SEGMENT, np.uint8)

    def packed():
        return pa.RecordBatch.from_arrays(
            [pa.array([now], pa.int32()), pa.array([np.packbits(counts >= 2).tobytes()], pa.binary())], ["segment", "bits"])

    for batch in batches:
        for segment, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
            if segment != now:
                if now is not None:
                    yield packed()
                now, counts = segment, np.zeros(SEGMENT, np.uint8)
            for part in (once, twice):
                at = unpack_gaps(part)
                counts[at] = np.minimum(counts[at] + 1, 2)
    if now is not None:
        yield packed()


def repeated_cells(texts: DataFrame, cells: int, window: int = WINDOW) -> bytes:
    """The merged sketch of all windows of ``texts`` (one column of bytes), a bit for each cell."""
    rows = texts.mapInArrow(_sketch(cells, window), "segment int, once binary, twice binary")
    width = max(min(cells // SEGMENT, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))), 1)
    rows = rows.repartition(width, "segment").sortWithinPartitions("segment")
    bits = bytearray(cells // 8)
    for segment, part in rows.mapInArrow(_merged, "segment int, bits binary").collect():  # cells / 8 bytes at most
        bits[segment * (SEGMENT // 8) : (segment + 1) * (SEGMENT // 8)] = part
    return bytes(bits)


def _planes(values: np.ndarray) -> bytes:
    """The bytes of an integer array, all lowest bytes first: what is zero or alike packs well."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unplanes(data: memoryview, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _pack(*arrays: np.ndarray) -> bytes:
    sizes = np.array([len(x) for x in arrays], np.int64)
    return sizes.tobytes() + b"".join(map(_planes, arrays))


def _unpack(data: bytes, kinds: tuple) -> list[np.ndarray]:
    sizes = np.frombuffer(data, np.int64, len(kinds))
    out, at, view = [], 8 * len(kinds), memoryview(data)
    for size, kind in zip(sizes, kinds):
        end = at + int(size) * np.dtype(kind).itemsize
        out.append(_unplanes(view[at:end], kind) if size else np.zeros(0, kind))
        at = end
    return out


#: What a blob of windows holds (fingerprint, second fingerprint, place of the document, start;
#: then the documents' id and mark), and a blob of spans (id, mark, start).
WINDOWS = (np.uint64, np.uint32, np.uint32, np.uint32, np.int64, np.int64)
STARTS = (np.int64, np.int64, np.uint32)


def _return_rows(ids: np.ndarray, marks: np.ndarray, starts: np.ndarray, groups: int) -> pa.RecordBatch:
    """Starts of repeated windows as blobs by a hash of their document; the parts are negative."""
    code = _mixed(ids.astype(np.uint64), marks.astype(np.uint64), 3)
    part = (code % np.uint64(groups)).astype(np.int64)
    order = np.lexsort((starts, marks, ids, part))
    part, ids, marks, starts = (x[order] for x in (part, ids, marks, starts))
    edges = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
    blobs = [
        _pack(np.diff(ids[a:b], prepend=0), np.diff(marks[a:b], prepend=0), starts[a:b].astype(np.uint32))
        for a, b in zip(edges, np.append(edges[1:], len(part)))
    ]
    return pa.RecordBatch.from_arrays([pa.array((-1 - part[edges]).astype(np.int32)), pa.array(blobs, pa.binary())], ["part", "data"])


def _earliest(keys: tuple[np.ndarray, ...], order_by: tuple[np.ndarray, ...]) -> np.ndarray:
    """Which rows are not the first of their key; ``order_by`` is given from the least significant."""
    order = np.lexsort((*order_by, *reversed(keys)))
    same = np.ones(max(len(order) - 1, 0), bool)
    for key in keys:
        k = key[order]
        same &= k[1:] == k[:-1]
    later = np.zeros(len(order), bool)
    later[order[1:]] = same
    return later


def _candidates(shared, cells: int, groups: int, window: int):
    """For mapInArrow over ``id, mark, text``: windows that may be repeated, as ``part, data``.

    Parts from 0 are groups of fingerprints; negative ones hold what this task found repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)

        def known(cell):
            return bits[cell >> np.uint32(3)] >> (np.uint32(7) - (cell & np.uint32(7))).astype(np.uint8) & 1 == 1

        for chunk in _chunks(batches, window):
            first, second = _cells(chunk.a, chunk.b, cells)
            may = np.flatnonzero(known(first))
            may = may[known(second[may])]
            if not len(may):
                continue
            ids = np.array([d[0] for d in chunk.docs], np.int64)
            marks = np.array([d[1] for d in chunk.docs], np.int64)
            a, b, doc, start = chunk.a[may], chunk.b[may].astype(np.uint32), chunk.doc[may], chunk.start[may]
            later = _earliest((a, b), (start, marks[doc], ids[doc]))
            # A repeated row with the same id and text is the same document and repeats nothing.
            if len(set(chunk.docs)) < len(chunk.docs):
                twin = _earliest((a, b, ids[doc], marks[doc], start), ())
                keep = ~twin
                a, b, doc, start, later = (x[keep] for x in (a, b, doc, start, later))
                later = _earliest((a, b), (start, marks[doc], ids[doc]))
            if later.any():
                yield _return_rows(ids[doc[later]], marks[doc[later]], start[later], groups)
            a, b, doc, start = (x[~later] for x in (a, b, doc, start))
            part = (a >> np.uint64(40)).astype(np.int64) * groups >> 24
            order = np.argsort(part, kind="stable")
            edges = np.flatnonzero(np.append(True, part[order][1:] != part[order][:-1]))
            blobs = []
            for x, y in zip(edges, np.append(edges[1:], len(order))):
                at = order[x:y]
                used, place = np.unique(doc[at], return_inverse=True)
                blobs.append(_pack(a[at], b[at], place.astype(np.uint32), start[at].astype(np.uint32), ids[used], marks[used]))
            yield pa.RecordBatch.from_arrays([pa.array(part[order][edges].astype(np.int32)), pa.array(blobs, pa.binary())], ["part", "data"])

    return run


def _exact(groups: int):
    """For applyInArrow by part: the windows of one group of fingerprints that are not the first."""

    def run(rows: pa.Table) -> pa.Table:
        if rows["part"][0].as_py() < 0:
            return rows
        found = [_unpack(x.as_py(), WINDOWS) for x in rows["data"]]
        a, b, start = (np.concatenate([f[i] for f in found]) for i in (0, 1, 3))
        ids = np.concatenate([f[4][f[2]] for f in found])
        marks = np.concatenate([f[5][f[2]] for f in found])
        order = np.argsort(a, kind="stable")
        again = np.zeros(len(a), bool)
        same = a[order][1:] == a[order][:-1]
        again[order[1:]] |= same
        again[order[:-1]] |= same
        a, b, start, ids, marks = (x[again] for x in (a, b, start, ids, marks))
        # Tasks may hold the same document, as a repeated row: it is one.
        one = ~_earliest((a, b, ids, marks, start), ())
        a, b, start, ids, marks = (x[one] for x in (a, b, start, ids, marks))
        later = _earliest((a, b), (start, marks, ids))
        out = _return_rows(ids[later], marks[later], start[later], groups)
        return pa.Table.from_batches([out])

    return run


def _spans(window: int):
    """For applyInArrow by part: ``id, mark, spans`` for each document; spans are merged, as 32-bit pairs."""

    def run(rows: pa.Table) -> pa.Table:
        found = [_unpack(x.as_py(), STARTS) for x in rows["data"]]
        ids = np.concatenate([np.cumsum(f[0]) for f in found])
        marks = np.concatenate([np.cumsum(f[1]) for f in found])
        starts = np.concatenate([f[2] for f in found]).astype(np.int64)
        order = np.lexsort((starts, marks, ids))
        ids, marks, starts = ids[order], marks[order], starts[order]
        new = np.append(True, (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1]))
        begin = new | np.append(True, starts[1:] > starts[:-1] + window)
        at = np.flatnonzero(begin)
        pairs = np.stack([starts[at], starts[np.append(at[1:], len(starts)) - 1] + window], axis=1).astype("<u4")
        first = np.flatnonzero(new[at])
        spans = [pairs[x:y].tobytes() for x, y in zip(first, np.append(first[1:], len(pairs)))]
        return pa.table({"id": ids[at][first], "mark": marks[at][first], "spans": pa.array(spans, pa.binary())})

    return run


def _apply(names: list[str]):
    """For mapInArrow over ``..., text, spans``: number of words, removed spans and the words that stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                counts, kept, removed = [], [], []
                for text, spans in zip(part.columns[-2].to_pylist(), part.columns[-1].to_pylist()):
                    words = (text or b"").split()
                    pairs = np.frombuffer(spans or b"", "<u4").reshape(-1, 2).tolist()
                    counts.append(len(words))
                    removed.append([{"start": s, "end": e} for s, e in pairs])
                    for s, e in reversed(pairs):
                        del words[s:e]
                    kept.append(b" ".join(words).decode())
                spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-2], pa.array(counts, pa.int64()), pa.array(removed, spans_type), pa.array(kept, pa.string())],
                    [*names, "n_words", "removed", "kept"])

    return run


def _power_of_two(least: float) -> int:
    return 1 << max(int(np.ceil(np.log2(max(least, 1)))), 0)


def remove_repeated_windows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, max_cells: int = MAX_CELLS
) -> DataFrame:
    """``doc_id, n_words, removed, kept`` for every row: word spans that occur earlier, and the rest.

    A word goes if a window of ``window`` words that covers it also starts earlier: in a document of
    smaller id, or earlier in the same one. ``removed`` lists maximal spans (``start``, ``end``
    after the last word); ``kept`` is the words that stay, joined by one space.

    Words are runs of anything but ASCII white space. Null texts have none; texts with fewer words
    than a window stay whole. Null ids come after all others, and rows of one id (or of none) are
    ordered by a hash of the text. Rows repeated with the same id and text are one document: they
    get the same result and repeat nothing by themselves. Texts are read whole, however long, one
    at a time. Other columns, whatever their names, are not read. An empty table gives no rows.
    """
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    total = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = min(max(_power_of_two(CELLS_PER_BYTE * total), MIN_CELLS), max_cells)
    groups = min(_power_of_two(total / GROUP_BYTES), 1 << 22)

    rows = given.select("doc_id", _id(F.col("doc_id")).alias("id"), F.xxhash64("text").alias("mark"), "text")
    several = stored(given.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null").select("doc_id"), "several")
    if several.limit(1).count():
        several = several.select(_id(F.col("doc_id")).alias("id"), F.lit(True).alias("marked"))
        rows = rows.join(several.hint("merge"), "id", "left").select(
            "doc_id", "id", F.when(F.col("marked"), F.col("mark")).otherwise(F.lit(0)).alias("mark"), "text")
    else:
        rows = rows.withColumn("mark", F.lit(0).cast("long"))

    shared = docs.sparkSession.sparkContext.broadcast(repeated_cells(given.select("text"), cells, window))
    blobs = rows.select("id", "mark", "text").mapInArrow(_candidates(shared, cells, groups, window), "part int, data binary")
    later = blobs.groupBy("part").applyInArrow(_exact(groups), "part int, data binary")
    found = later.groupBy("part").applyInArrow(_spans(window), "id long, mark long, spans binary")
    joined = rows.join(stored(found, "repeated-spans").hint("merge"), ["id", "mark"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(
        _apply(["doc_id"]), "doc_id long, n_words long, removed array<struct<start: long, end: long>>, kept string")


def _id(doc_id: Column) -> Column:
    return F.coalesce(doc_id, F.lit(LAST_ID))

