"""Periodic runs of words, by descending-LCP Kruskal (operator 11).

A run of period q that is k times as long holds two suffixes q words apart whose longest common
prefix is its length less q. So the suffixes of a text are united into classes by falling LCP, with
union-find over ordered sets of positions; whenever two positions become neighbours in a set at a
distance that the LCP covers often enough, they seed a run of that distance. The seed whose left
neighbours differ is the run from its first word to its last.

Only suffixes whose first ``SEED`` words occur again in the same text can seed anything, so the rest
is left out before sorting; of a run of such suffixes each is a symbol, and LCPs are counted in
symbols. Sorting doubles the compared length, for all texts of a task's batch at once.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run is at least so many words long, and at least so many times its period.
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: The LCP of a seed is never smaller: LEAST_WORDS less a period of one word.
SEED = 5
#: Words that a task works on at a time.
CHUNK_WORDS = 1 << 20


class _Numbers(dict):
    """Word (bytes) to its number, by first occurrence."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """From which word on, and by which period, the words of a document are replaced; None: not at all.

    A tenth of the ids is chosen by CRC-32; a document without id or without words is left alone.
    """
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def repeat_planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with the planted repeats: word i from ``a`` on becomes word ``a + (i - a) % p``."""
    where = planted(doc_id, len(words))
    if where is None:
        return words
    a, p = where
    rest = len(words) - a
    return words[:a] + (words[a : a + p] * (rest // p + 1))[:rest]


def repeated_grams(codes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """A symbol for the ``SEED`` words from each place: equal ones of a text share a number from 1.

    What occurs once in its text, or reaches into the next text, is 0. Grams are first told apart by
    64-bit hashes, then those that share one are compared word by word.
    """
    n = len(codes) - SEED + 1
    out = np.zeros(len(codes), np.int64)
    if n <= 0:
        return out
    mixed = owner[:n].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(SEED):
        mixed = (mixed ^ codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    inside = np.flatnonzero(owner[:n] == owner[SEED - 1 :])
    order = inside[np.argsort(mixed[inside], kind="stable")]
    same = mixed[order][1:] == mixed[order][:-1]
    for k in range(SEED):
        same &= codes[order + k][1:] == codes[order + k][:-1]
    same &= owner[order][1:] == owner[order][:-1]
    new = np.append(True, ~same)[: len(order)]
    number = np.cumsum(new)
    again = np.bincount(number)[number] > 1
    out[order[again]] = number[again]
    return out


def sorted_suffixes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places with a symbol (not 0) in suffix order, and the LCP of each with the one before it.

    A suffix ends at the next 0, and no two ends are alike. Only ties are sorted again when the
    compared length doubles. The rank of a tie is the place of its first member in the order. The
    ranks of every length are kept, so that LCPs are read off them from the longest length down.
    """
    real = symbols > 0
    place = np.flatnonzero(real | np.append(False, real[:-1]))  # of each stretch of zeros one is enough
    symbols, end = np.append(symbols[place], 0), len(place)
    order = np.flatnonzero(symbols)
    order = order[np.argsort(symbols[order], kind="stable")]
    rank = np.zeros(end + 1, np.int64)
    found = symbols[order]
    step = np.append(True, found[1:] != found[:-1])[: len(order)]
    rank[order] = np.maximum.accumulate(np.where(step, np.arange(len(order)), 0)) + 1
    rounds, length = [rank], 1
    while True:
        ranked = rank[order]
        same = ranked[1:] == ranked[:-1]
        where = np.flatnonzero(np.append(same, False)[: len(order)] | np.append(False, same)[: len(order)])
        if not len(where):
            break
        rows = order[where]
        follow = rank[rows + length]
        follow = np.where(follow == 0, -rows - 1, follow)
        inner = np.lexsort((follow, rank[rows]))
        rows, follow = rows[inner], follow[inner]
        group = rank[rows]
        order[where] = rows
        step = np.append(True, (group[1:] != group[:-1]) | (follow[1:] != follow[:-1]))
        rank = rank.copy()
        rank[rows] = np.maximum.accumulate(np.where(step, where, 0)) + 1
        rounds.append(rank)
        length *= 2
    left, right = order[:-1].copy(), order[1:].copy()
    common = np.zeros(len(left), np.int64)
    for level in range(len(rounds) - 1, -1, -1):
        equal = (rounds[level][left] == rounds[level][right]) & (symbols[left] > 0)
        for x in (left, right, common):
            x[equal] += 1 << level
    return place[order], np.append(0, common)[: len(order)]


class _Classes:
    """Union-find over places; each class has its places in order."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}
        self.members: dict[int, list[int]] = {}

    def find(self, place: int) -> int:
        root = place
        while (up := self.parent.get(root, root)) != root:
            root = up
        while (up := self.parent.get(place, place)) != root:
            self.parent[place] = root
            place = up
        return root

    def unite(self, a: int, b: int) -> list[tuple[int, int]]:
        """Join two classes; the pairs of places that became neighbours."""
        a, b = self.find(a), self.find(b)
        large, small = self.members.pop(a, [a]), self.members.pop(b, [b])
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        self.parent[b] = a
        other = set(small)
        if len(small) * 16 > len(large):
            large = sorted(large + small)
            pairs = [(x, y) for x, y in zip(large, large[1:]) if (x in other) != (y in other)]
        else:
            pairs = []
            for place in small:
                insort(large, place)
            for place in small:
                at = bisect_left(large, place)
                if at and large[at - 1] not in other:
                    pairs.append((large[at - 1], place))
                if at + 1 < len(large) and large[at + 1] not in other:
                    pairs.append((place, large[at + 1]))
        self.members[a] = large
        return pairs


def find_runs(codes: np.ndarray, owner: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs ``place, length, period`` of the texts that lie one after the other in ``codes``."""
    symbols = repeated_grams(codes, owner)
    order, lcp = sorted_suffixes(symbols)
    lcp = lcp + np.where(lcp > 0, SEED - 1, 0)  # symbols to words
    by_lcp = np.argsort(-lcp, kind="stable")
    by_lcp = by_lcp[lcp[by_lcp] >= SEED]
    classes, found = _Classes(), []
    for a, b, common in zip(order[by_lcp - 1].tolist(), order[by_lcp].tolist(), lcp[by_lcp].tolist()):
        for x, y in classes.unite(a, b):
            q = y - x
            if q * (LEAST_PERIODS - 1) <= common and q + common >= LEAST_WORDS:
                if not x or owner[x - 1] != owner[x] or codes[x - 1] != codes[y - 1]:
                    found.append((x, q + common, q))
    return found


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """For each text its runs ``start, length, period`` by start and period."""
    number = _Numbers()
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.uint64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(texts)), sizes)
    begins = np.cumsum(sizes) - sizes
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for place, length, period in find_runs(flat, owner):
        text = int(owner[place])
        out[text].append((place - int(begins[text]), length, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()
    return b" ".join([words[i] for i in kept])


def detect_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plant: bool = False) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row.

    A run is a stretch of words with smallest period ``q`` (words q apart are identical) that is at
    least ``LEAST_WORDS`` and ``LEAST_PERIODS`` times q long and that no neighbouring word extends.
    ``runs`` lists them (``start, length, period``, in words from 0) by start and period;
    ``collapsed`` is the text without what a run holds after its first period, words joined by one
    space. With ``plant``, repeats are first planted by ``repeat_planted``.

    Words are runs of anything but ASCII white space; null and empty texts have none and no runs.
    Texts are read whole, however long, each in one task. Rows stand alone: repeated rows and null
    ids give a row each (nothing is planted without an id). Other columns, whatever their names,
    are not read. An empty table gives no rows.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    given = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(part: pa.RecordBatch, texts: list[list[bytes]]) -> pa.RecordBatch:
            runs = runs_of_texts(texts)
            spans = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
            rest = [collapsed(t, r).decode() for t, r in zip(texts, runs)]
            return pa.RecordBatch.from_arrays(
                [part.columns[0], pa.array([len(t) for t in texts], pa.int64()), pa.array(spans, run_type), pa.array(rest, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])

        for batch in batches:
            texts, words, at = [], 0, 0
            for i, (key, value) in enumerate(zip(batch.columns[0].to_pylist(), batch.columns[1])):
                found = value.as_py().split()
                texts.append(repeat_planted(found, key) if plant else found)
                words += len(found)
                if words >= CHUNK_WORDS or i + 1 == len(batch):
                    yield result(batch.slice(at, len(texts)), texts)
                    texts, words, at = [], 0, i + 1

    return given.mapInArrow(
        run, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
