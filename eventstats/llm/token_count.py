"""Token counts by byte-pair merging with a heap and a linked list (operator 4).

The symbols of a pre-token are a doubly linked list; a heap holds the adjacent pairs that have a
merge, lowest rank first. Each merge takes one symbol away, so the count is the number of initial
symbols less the merges; no ids are made. Counts of short pre-tokens are kept in a bounded cache.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The pattern of byte-level pre-tokenisers; a fixed value of the format.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

CACHE_ENTRIES = 500_000
CACHE_CHARS = 64


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class MergeCounter(dict):
    """Pre-token to number of tokens, for a byte-level BPE in a tokenizers .json file."""

    def __init__(self, merges: list, special: list[str]) -> None:
        super().__init__()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        symbols = byte_symbols()
        self.number = {s: i for i, s in enumerate(symbols)}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            merged = self.number.setdefault(a + b, len(self.number))
            self.pairs.setdefault((self.number[a], self.number[b]), (rank, merged))
        self.find = regex.compile(BYTE_LEVEL).findall
        special = sorted(special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def merge_count(self, data: bytes) -> int:
        """Initial symbols less merges."""
        symbol = list(data)
        end = len(symbol)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        pairs = self.pairs
        heap = [(*found, i, symbol[i], symbol[i + 1]) for i in range(end - 1) if (found := pairs.get((symbol[i], symbol[i + 1])))]
        heapq.heapify(heap)
        # Entries are (rank, merged, place, left symbol, right symbol); ranks are unique per
        # pair, so equal ranks are the same pair and go from left to right.
        merges = 0
        while heap:
            _, merged, at, left, right = heapq.heappop(heap)
            other = after[at]
            if symbol[at] != left or other >= end or symbol[other] != right:
                continue
            merges += 1
            symbol[at], symbol[other] = merged, -1
            after[at] = follows = after[other]
            if follows < end:
                before[follows] = at
                if found := pairs.get((merged, symbol[follows])):
                    heapq.heappush(heap, (*found, at, merged, symbol[follows]))
            if (prior := before[at]) >= 0:
                if found := pairs.get((symbol[prior], merged)):
                    heapq.heappush(heap, (*found, prior, symbol[prior], merged))
        return end - merges

    def __missing__(self, piece: str) -> int:
        # Numbers 0 to 255 are the bytes themselves: ``number`` lists them in byte order.
        count = self.merge_count(piece.encode())
        if len(piece) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[piece] = count
        return count

    def count(self, text: str) -> int:
        """Tokens of a text; a special string within it is one token, as the library has it."""
        if self.special is None:
            return sum(map(self.__getitem__, self.find(text)))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.find(p))) for p in parts)


@lru_cache(maxsize=2)
def load_counter(path: str) -> MergeCounter:
    """A counter for a byte-level BPE file, present on every machine at the same path."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    before = spec["pre_tokenizer"] or {}
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or spec["normalizer"]:
        raise ValueError(f"{path} is not a plain byte-level tokenizer")
    return MergeCounter(spec["model"]["merges"], [t["content"] for t in spec["added_tokens"]])


def count_tokens(
    docs: DataFrame, vocabulary: str, limit: int = 1024, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    Null counts as the empty text: no bytes, no tokens. Repeated rows and null ids give a row
    each; other columns are not read; texts of any length are counted whole; an empty table
    gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load_counter(vocabulary)
        for batch in batches:
            counts = [counter.count(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.octet_length(whole).cast("long").alias("n_bytes"), whole.alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    counted = rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
