"""Language identification by words with back-off to character n-grams (operator 9).

A known word gives each language its smoothed log frequency there. An unseen word falls back to
its character n-grams of the longest order of which any is known, then to shorter ones, at a
discount per step. A text goes to the language with the largest sum.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled documents that the model is fitted on, about so many in all, in equal shares for the
#: languages, by hash of id and text; all of a language if it has fewer.
TRAIN_DOCS = 12_000
#: Orders of character n-grams.
ORDERS = (4, 3, 2, 1)
BACKOFF = 0.4
SMOOTHING = 0.5

_WORD = re.compile(r"[^\W\d_]+")
#: Cells (words times languages) of a worker's table of evidence.
CACHE_CELLS = 1_200_000
#: Cells up to which a table of the model is laid out in full.
DENSE_CELLS = 4_000_000


class _LogShares:
    """Smoothed log shares of keys in each language, of which only those seen are stored."""

    def __init__(self, rows: list[tuple[str, int, int]], languages: int) -> None:
        """``rows`` are key, language and count; a key's rows need not be together."""
        self.index: dict[str, int] = {}
        key = np.array([self.index.setdefault(k, len(self.index)) for k, _, _ in rows], np.int64)
        language = np.array([i for _, i, _ in rows], np.int64)
        code, place = np.unique(key * languages + language, return_inverse=True)
        count = np.bincount(place, weights=[n for _, _, n in rows], minlength=len(code)) if len(rows) else np.zeros(0)
        total = np.bincount(code % languages, weights=count, minlength=languages) if languages else np.zeros(0)
        self.floor = np.log(SMOOTHING / (total + SMOOTHING * (len(self.index) + 1)))
        self.language = (code % max(languages, 1)).astype(np.int32)
        self.more = np.log((count + SMOOTHING) / SMOOTHING).astype(np.float32)
        self.begin = np.searchsorted(code, np.arange(len(self.index) + 1) * languages)

        self.dense: np.ndarray | None = None

    def rows(self, places: list[int]) -> np.ndarray:
        """The log shares of keys by their places; with few languages they are laid out once."""
        if self.dense is None and len(self.index) * len(self.floor) <= DENSE_CELLS:
            key = np.repeat(np.arange(len(self.index)), np.diff(self.begin))
            self.dense = np.tile(self.floor, (len(self.index), 1))
            self.dense[key, self.language] += self.more
        if self.dense is not None:
            return self.dense[places]
        out = np.tile(self.floor, (len(places), 1))
        for row, at in enumerate(places):
            span = slice(self.begin[at], self.begin[at + 1])
            out[row, self.language[span]] += self.more[span]
        return out


@dataclass
class LanguageModel:
    languages: list[str]
    words: _LogShares
    grams: dict[int, _LogShares]

    def evidence(self, word: str) -> np.ndarray:
        """Log frequencies of a word in each language, by back-off where it is unseen."""
        if (known := self.words.index.get(word)) is not None:
            return self.words.rows([known])[0]
        marked = f"^{word}$"
        discount = 0.0
        for order in ORDERS:
            discount += np.log(BACKOFF)
            table = self.grams[order]
            found = [at for i in range(len(marked) - order + 1) if (at := table.index.get(marked[i : i + order])) is not None]
            if found:
                return table.rows(found).sum(axis=0) / len(found) + discount
        return np.zeros(len(self.languages))


def fit(labelled: DataFrame, docs: int = TRAIN_DOCS) -> LanguageModel:
    """Fit on ``doc_id, text, lang``; rows with a null text or language teach nothing.

    Word counts are a distributed aggregation over the whole texts of the sample. All its words
    reach the driver: the sample bounds them. Null ids and repeated rows count like others. An
    empty table gives a model without languages.
    """
    usable = labelled.filter("text is not null and lang is not null")
    sizes = usable.groupBy("lang").count().collect()
    spark = labelled.sparkSession
    shares = spark.createDataFrame(
        [(r["lang"], min(1.0, docs / len(sizes) / r["count"])) for r in sizes], "lang string, share double")
    mark = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    chosen = usable.join(F.broadcast(shares), "lang").filter(mark < F.col("share"))
    counted = (
        chosen.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]+"), 0)).alias("word"))
        .groupBy("lang", "word").agg(F.count("*").alias("n"))
    )
    rows = counted.collect()
    languages = sorted({r["lang"] for r in rows})
    place = {name: i for i, name in enumerate(languages)}
    found = [(word, place[lang], n) for lang, word, n in rows]
    grams = {order: Counter() for order in ORDERS}
    for word, i, n in found:
        marked = f"^{word}$"
        for order, counts in grams.items():
            for at in range(len(marked) - order + 1):
                counts[marked[at : at + order], i] += n
    size = len(languages)
    tables = {order: _LogShares([(k, i, n) for (k, i), n in c.items()], size) for order, c in grams.items()}
    return LanguageModel(languages, _LogShares(found, size), tables)


class _Rows(dict):
    """Word to row of a growing table of evidence; emptied when it is full."""

    def __init__(self, model: LanguageModel) -> None:
        super().__init__()
        self.model = model
        self.table = np.zeros((1024, len(model.languages)))

    def __missing__(self, word: str) -> int:
        row = len(self)
        if row == len(self.table):
            self.table = np.vstack([self.table, np.zeros_like(self.table)])
        self.table[row] = self.model.evidence(word)
        self[word] = row
        return row

    def total(self, words: list[str]) -> np.ndarray:
        if len(self) * len(self.model.languages) > CACHE_CELLS:
            self.clear()
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.bincount(rows, minlength=len(self)) @ self.table[: len(self)] if len(rows) > 4 * len(self) else self.table[rows].sum(axis=0)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row, from whole texts.

    A text that is null or has no letter is ``und`` with score 0, as is every text if the model
    knows no language. The score is the share of the likeliest language, evidence taken as
    independent. Ties go to the first language by name. Rows stand alone: repeated rows and null
    ids give a row each, very long texts are read whole, an empty table gives no rows. Other columns,
    whatever their names, are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        rows = _Rows(model)
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                words = _WORD.findall(text.lower()) if text and model.languages else []
                if not any(map(str.isalpha, "".join(words))):
                    found.append(("und", 0.0))
                    continue
                total = rows.total(words)
                best = int(total.argmax())
                found.append((model.languages[best], float(1 / np.exp(np.minimum(total - total[best], 0)).sum())))
            labels, scores = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
