"""Toxicity by a bidirectional gated recurrent network with attention pooling (operator 6).

A word enters the network as an embedding of itself beside the mean embedding of its character
n-grams (bytes, with marks at both ends). Two gated recurrent layers read a window of words in
both directions, attention pools their states, and a text scores as its highest window; windows
overlap and cover the whole text. A window also sees how telling the second most telling word of its
whole text is, because one such word occurs in clean texts by chance. Training is numpy only, on a
bounded sample of labelled texts.
Labels are of texts, so a window of a toxic text counts as toxic only if it is the text's highest
or already scores high; all windows of clean texts are clean.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventstats.llm.common import local_ids, stored, worker_state

#: Labelled texts that the network is fitted on, by hash of the id: so many of each label.
TRAIN_TOXIC = 1500
TRAIN_CLEAN = 3000
TRAIN_BYTES = 64 << 20
#: Words in a window, and words that the next window begins later.
WINDOW = 48
STRIDE = 32
#: Width of the embeddings and of a recurrent state.
WIDTH, STATE = 8, 8
#: Words and n-grams get an embedding if one text in so many has them (3 to 8 texts); others get zeros.
TEXTS_PER_MINIMUM = 400
#: Every so manieth text of the sample is not trained on but sets the cut between the labels.
CALIBRATE_EVERY = 10
CUT = 0.7
GRAMS = (6, 8)
EPOCHS = 4
#: A word or n-gram starts as telling if toxic texts have it oftener than chance by so many deviations,
#: fewer where few toxic texts are known.
TELLING = 4
#: Weight of a text's evidence beside the logit of its highest window.
EVIDENCE_WEIGHT = 3.0
#: Words that a task keeps the inputs of.
CACHE_WORDS = 100_000
#: Words whose n-grams are hashed or looked up at once.
BLOCK_WORDS = 20_000

_TOKEN = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def gram_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of the character n-grams of all words, and where each word's begin.

    The words of a block lie in one byte array, so that all its n-grams are hashed at once. The
    n-gram of a word shorter than it goes on into the words that follow, also past a block's end.
    """
    codes, begins, total = [], [], 0
    for i in range(0, max(len(words), 1), BLOCK_WORDS):
        end = i + BLOCK_WORDS
        code, begin = _gram_codes(words[i:end], b"".join(map(_marked, words[end : end + max(GRAMS)])))
        codes.append(code)
        begins.append(begin + total)
        total += len(code)
    return np.concatenate(codes), np.concatenate(begins)


def _marked(word: str) -> bytes:
    return b"\x02" + word.encode() + b"\x03"


def _gram_codes(words: list[str], after: bytes) -> tuple[np.ndarray, np.ndarray]:
    parts = [_marked(w) for w in words]
    sizes = np.array([len(p) for p in parts], np.int64)
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(parts) + after + b"\0" * max(GRAMS), np.uint8).astype(np.uint64)
    counts = [np.maximum(sizes - n + 1, 1 if n == GRAMS[0] else 0) for n in GRAMS]
    total = np.sum(counts, axis=0)
    begins = np.cumsum(total) - total
    out = np.empty(int(total.sum()), np.uint64)
    offset = begins.copy()
    for n, count in zip(GRAMS, counts):
        inner = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(starts, count) + inner
        code = np.full(len(at), n, np.uint64)
        for k in range(n):
            code = (code ^ data[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
        out[np.repeat(offset, count) + inner] = code
        offset += count
    return out, begins


def spans(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions of all spans that begin at ``begins``, one span after the other."""
    return np.arange(int(counts.sum())) + np.repeat(begins - np.cumsum(counts) + counts, counts)


def sums_by_row(where: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers in ``where``, ascending, and the sum of the rows of each."""
    order = np.argsort(where, kind="stable")
    found = where[order]
    first = np.flatnonzero(np.append(True, found[1:] != found[:-1])[: len(found)])
    return found[first], np.add.reduceat(values[order], first, axis=0)


def text_evidence(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The evidence of all words of each of the texts that lie one after the other, less for long texts."""
    total = np.append(0, np.cumsum(np.maximum(values, 0), dtype=np.float64))
    ends = np.cumsum(sizes)
    return np.log1p(np.maximum(total[ends] - total[ends - sizes], 0)) - 0.3 * np.log(np.maximum(sizes, 1))


def window_starts(n: int) -> np.ndarray:
    """Where the windows of a text of ``n`` words begin; at least one, the last reaches the end."""
    return np.arange(0, max(n - WINDOW, 0) + STRIDE, STRIDE)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Weights. ``f`` and ``b`` are the two directions; gates are update, reset and candidate."""

    p: dict[str, np.ndarray] = field(default_factory=dict)
    vocabulary: dict[str, int] = field(default_factory=dict)
    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    #: A text's logit: of its highest window by ``scale``, its evidence by ``weight``, and ``shift``.
    scale: float = 1.0
    weight: float = 0.0
    shift: float = 0.0
    #: How telling words and n-grams were found to be before training, by their rows.
    word_evidence: np.ndarray = field(default_factory=lambda: np.zeros(1, np.float32))
    gram_evidence: np.ndarray = field(default_factory=lambda: np.zeros(1, np.float32))
    mark: str = ""

    @classmethod
    def new(cls, vocabulary: dict[str, int], codes: np.ndarray, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *s, by=0.3: (rng.standard_normal(s) * by).astype(np.float32)
        p = {"words": draw(len(vocabulary) + 1, WIDTH, by=0.05), "grams": draw(len(codes) + 1, WIDTH, by=0.05)}
        p["words"][0] = p["grams"][0] = 0
        for d in "fb":
            p["W" + d], p["U" + d] = draw(2 * WIDTH, 3 * STATE), draw(STATE, 3 * STATE)
            p["c" + d] = np.zeros(3 * STATE, np.float32)
        p["att"], p["out"] = draw(2 * STATE), draw(2 * STATE)
        p["bias"] = np.zeros(1, np.float32)
        return cls(p, vocabulary, codes)

    def rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Embedding rows of words and of their n-grams, row 0 where there is none, and begins."""
        found, begins = gram_codes(words)
        grams = np.zeros(len(found), np.int64)
        if len(self.codes):
            for i in range(0, len(found), 8 * BLOCK_WORDS):
                part = found[i : i + 8 * BLOCK_WORDS]
                place = np.minimum(np.searchsorted(self.codes, part), len(self.codes) - 1)
                grams[i : i + len(part)] = np.where(self.codes[place] == part, place + 1, 0)
        return np.array([self.vocabulary.get(w, 0) for w in words], np.int64), grams, begins

    def inputs(self, words: np.ndarray, grams: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Embedding and mean n-gram embedding of each word, side by side."""
        counts = np.diff(np.append(begins, len(grams)))
        mean = np.add.reduceat(self.p["grams"][grams], begins, axis=0) / counts[:, None]
        return np.hstack([self.p["words"][words], mean]).astype(np.float32)

    def evidence(self, words: np.ndarray, grams: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """How telling each word is, by itself and by the mean of its n-grams."""
        counts = np.diff(np.append(begins, len(grams)))
        return self.word_evidence[words] + np.add.reduceat(self.gram_evidence[grams], begins) / counts

    def run(self, xs: dict[str, np.ndarray], mask: np.ndarray, keep: bool = False):
        """Logits of windows. ``xs[d]``: (window, word, gate inputs); ``mask``: real words."""
        rows, steps = mask.shape
        states = np.empty((rows, steps, 2 * STATE), np.float32)
        kept: dict[str, list] = {"f": [], "b": []}
        for d, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
            h = np.zeros((rows, STATE), np.float32)
            side = slice(0, STATE) if d == "f" else slice(STATE, 2 * STATE)
            for t in order:
                x, g = xs[d][:, t], h @ self.p["U" + d]
                zr = _sigmoid(x[:, : 2 * STATE] + g[:, : 2 * STATE])
                z, r = zr[:, :STATE], zr[:, STATE:]
                n = np.tanh(x[:, 2 * STATE :] + r * g[:, 2 * STATE :])
                m = mask[:, t, None]
                if keep:
                    kept[d].append((t, h, z, r, n, g[:, 2 * STATE :], m))
                h = h + m * (1 - z) * (n - h)
                states[:, t, side] = h
        a = np.where(mask, states @ self.p["att"], -30)
        a = np.exp(a - a.max(axis=1, keepdims=True)) * mask
        a /= np.maximum(a.sum(axis=1, keepdims=True), 1e-9)
        pooled = np.einsum("nt,nts->ns", a, states)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        return (logit, states, a, pooled, kept) if keep else logit

    def project(self, x: np.ndarray) -> dict[str, np.ndarray]:
        return {d: x @ self.p["W" + d] + self.p["c" + d] for d in "fb"}

    def gradients(self, x: np.ndarray, at: np.ndarray, mask: np.ndarray, label: np.ndarray, weight: np.ndarray):
        """Gradients of the weighted cross entropy. ``x``: inputs of words; ``at``: word of each place."""
        logit, states, a, pooled, kept = self.run({d: v[at] for d, v in self.project(x).items()}, mask, keep=True)
        g = {k: np.zeros_like(v) for k, v in self.p.items() if k not in ("words", "grams")}
        dl = ((_sigmoid(logit) - label) * weight).astype(np.float32)
        g["bias"][0], g["out"] = dl.sum(), pooled.T @ dl
        dpool = dl[:, None] * self.p["out"]
        da = np.einsum("ns,nts->nt", dpool, states)
        ds = a * (da - (a * da).sum(axis=1, keepdims=True))
        g["att"] = np.einsum("nt,nts->s", ds, states)
        dstates = a[:, :, None] * dpool[:, None, :] + ds[:, :, None] * self.p["att"]
        dx = np.zeros_like(x)
        for d in "fb":
            side = slice(0, STATE) if d == "f" else slice(STATE, 2 * STATE)
            U, W = self.p["U" + d], self.p["W" + d]
            dh = np.zeros((len(at), STATE), np.float32)
            dgate = np.empty((*at.shape, 3 * STATE), np.float32)
            for t, h, z, r, n, gn, m in reversed(kept[d]):
                dh = dh + dstates[:, t, side]
                dn = dh * m * (1 - z) * (1 - n * n)
                dz = dh * m * (h - n) * z * (1 - z)
                dr = dn * gn * r * (1 - r)
                dg = np.hstack([dz, dr, dn * r])
                g["U" + d] += h.T @ dg
                dh = dh * (1 - m * (1 - z)) + dg @ U.T
                dgate[:, t] = np.hstack([dz, dr, dn])
            used, total = sums_by_row(at.ravel(), dgate.reshape(-1, 3 * STATE))
            g["W" + d], g["c" + d] = x[used].T @ total, total.sum(axis=0)
            dx[used] += total @ W.T
        return g, dx


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Network | None:
    """Fit a network; None unless both labels occur. The same texts give the same network.

    Of equal texts one is used, so that copies do not make their words look telling. A fifth of
    the texts is kept apart to choose the cut, unless that leaves too few of a label.
    """
    pairs = sorted(dict(zip(texts, labels)).items(), key=lambda p: (zlib.crc32(p[0].encode()), p[0]))
    apart = pairs[::CALIBRATE_EVERY]
    rest = [p for i, p in enumerate(pairs) if i % CALIBRATE_EVERY]
    if min(sum(v for _, v in rest), sum(1 - v for _, v in rest), sum(v for _, v in apart)) < 1:
        apart, rest = pairs, pairs
    texts = [t for t, _ in rest]
    y = np.array([v for _, v in rest], np.int64)
    if not 0 < y.sum() < len(y):
        return None
    rng = np.random.default_rng(seed)
    number: dict[str, int] = {}
    docs = [np.array([number.setdefault(w, len(number)) for w in tokens(t)], np.int32) for t in texts]
    words = list(number) or ["-"]
    net = Network.new(*_common(docs, words), seed)
    rows, grams, begins = net.rows(words)
    counts = np.diff(np.append(begins, len(grams)))
    _start_from_counts(net, docs, y, rows, grams, begins, counts)
    evidence = net.evidence(rows, grams, begins)

    starts = [window_starts(len(d)) for d in docs]
    owner = np.repeat(np.arange(len(docs)), [len(s) for s in starts])
    places = np.concatenate(starts)[:, None].astype(np.int32) + np.arange(WINDOW, dtype=np.int32)
    sizes = np.array([len(d) for d in docs])
    flat = np.concatenate([*docs, np.zeros(WINDOW + STRIDE, np.int32)])
    mask = places < sizes[owner][:, None]
    places += (np.cumsum(sizes) - sizes)[owner][:, None].astype(np.int32)
    places[~mask] = len(flat) - 1
    at = flat[places]
    del places, flat
    toxic = y[owner] == 1
    first = np.searchsorted(owner, np.arange(len(docs)))
    speed: dict[str, np.ndarray] = {k: np.full_like(v, 1e-6) for k, v in net.p.items()}

    def score_all() -> np.ndarray:
        inputs = np.empty((len(rows), 2 * WIDTH), np.float32)
        for i in range(0, len(rows), BLOCK_WORDS):
            part = np.arange(i, min(i + BLOCK_WORDS, len(rows)))
            span = spans(begins[part], counts[part])
            inputs[part] = net.inputs(rows[part], grams[span], np.cumsum(counts[part]) - counts[part])
        gates = net.project(inputs)
        del inputs
        return np.concatenate([
            net.run({d: v[at[i : i + 1024]] for d, v in gates.items()}, mask[i : i + 1024])
            for i in range(0, len(at), 1024)])

    scores = np.concatenate([  # the first round picks by evidence alone
        np.where(mask[i : i + 1024], evidence[at[i : i + 1024]], -9).max(axis=1) - 9 for i in range(0, len(at), 1024)])
    for epoch in range(epochs):
        highest = np.maximum.reduceat(scores, first)[owner] == scores
        positive = np.flatnonzero(toxic & (highest | (scores > 0)))
        hard = np.flatnonzero(~toxic & highest)
        other = rng.permutation(np.flatnonzero(~toxic))[: max(2 * len(positive), len(hard))]
        chosen = rng.permutation(np.concatenate([positive, hard, other]))
        share = len(positive) / max(len(chosen), 1)
        for i in range(0, len(chosen), 256):
            pick = chosen[i : i + 256]
            used, local = np.unique(at[pick], return_inverse=True)
            local = local.reshape(len(pick), WINDOW)
            span = spans(begins[used], counts[used])
            x = net.inputs(rows[used], grams[span], np.cumsum(counts[used]) - counts[used])
            label = toxic[pick].astype(np.float32)
            weight = np.where(label == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6)) / len(pick)
            g, dx = net.gradients(x, local, mask[pick], label, weight.astype(np.float32))
            for name, value in g.items():
                speed[name] += value * value
                net.p[name] -= 0.1 * value / np.sqrt(speed[name])
            dgram = np.repeat(dx[:, WIDTH:] / counts[used][:, None], counts[used], axis=0)
            for name, where, value in (("words", rows[used], dx[:, :WIDTH]), ("grams", grams[span], dgram)):
                hit, total = sums_by_row(where, value)
                speed[name][hit] += total * total
                net.p[name][hit] -= 0.05 * total / np.sqrt(speed[name][hit])
                net.p[name][0] = 0
        scores = score_all()
    net.weight = EVIDENCE_WEIGHT
    found = score_texts([t for t, _ in apart], net, _Gates(net))
    cut = _cut(np.log(found / (1 - found)), np.array([v for _, v in apart]))
    net.shift = float(np.log(CUT / (1 - CUT)) - cut)
    net.mark = f"{zlib.crc32(repr((cut, len(pairs), len(words))).encode()):08x}"
    return net


def _common(docs: list[np.ndarray], words: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Words and n-gram codes that enough texts have to be worth an embedding."""
    least = min(max(len(docs) // TEXTS_PER_MINIMUM, 3), 8)
    codes, begins = gram_codes(words)
    counts = np.diff(np.append(begins, len(codes)))
    texts = np.zeros(len(words), np.int64)
    distinct, row = np.unique(codes, return_inverse=True)
    gram_texts = np.zeros(len(distinct), np.int64)
    for doc in docs:
        used = np.unique(doc)
        texts[used] += 1
        if len(used):
            gram_texts[np.unique(row[spans(begins[used], counts[used])])] += 1
    kept = np.flatnonzero(texts >= least)
    return {words[w]: i + 1 for i, w in enumerate(kept)}, distinct[gram_texts >= least]


def _start_from_counts(net: Network, docs, y, rows, grams, begins, counts) -> None:
    """Start one dimension of both tables from how much oftener toxic texts have the word or n-gram."""
    for name in ("words", "grams"):
        seen = np.zeros((2, len(net.p[name])))
        for doc, label in zip(docs, y):
            used = np.unique(doc)
            if not len(used):
                continue
            found = rows[used] if name == "words" else grams[spans(begins[used], counts[used])]
            seen[label, np.unique(found)] += 1
        expected = seen.sum(axis=0) * y.mean()
        seen[:, 0] = expected[0] = 0
        over = (seen[1] - expected) / np.sqrt(expected + 1)
        least = min(TELLING, np.sqrt(y.sum()) / 3)
        found = np.where(over > least, np.minimum(over, 15), np.minimum(over, 0)) / 4
        net.p[name][:, 0] = found
        setattr(net, name[:-1] + "_evidence", found.astype(np.float32))


#: The cut lies this far up from the logit that most clean texts stay below to the median of toxic ones,
#: so some wrong labels do not move it; the way counts as at least so long.
CLEAN_BELOW = 0.95
CUT_IN_GAP = 0.3
LEAST_GAP = 4.0


def _cut(logits: np.ndarray, y: np.ndarray) -> float:
    """The logit that divides the labels."""
    low, high = np.quantile(logits[y == 0], CLEAN_BELOW), np.median(logits[y == 1])
    return float(low + CUT_IN_GAP * max(high - low, LEAST_GAP))


class _Gates(dict):
    """Word to row of a table of gate inputs and evidence; the table is bounded and doubles as it fills."""

    def __init__(self, net: Network) -> None:
        super().__init__()
        self.net = net
        self.table = np.zeros((1024, 6 * STATE + 1), np.float32)

    def rows(self, words: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self]
        if new and len(self) + len(new) > CACHE_WORDS:
            self.clear()
            new = list(dict.fromkeys(words))
        at = len(self)
        if at + len(new) > len(self.table):
            table = np.zeros((max(2 * len(self.table), at + len(new)), self.table.shape[1]), np.float32)
            table[:at] = self.table[:at]
            self.table = table
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            found = self.net.rows(part)
            gates = self.net.project(self.net.inputs(*found))
            place = slice(at + i, at + i + len(part))
            self.table[place] = np.hstack([gates["f"], gates["b"], self.net.evidence(*found)[:, None]])
        self.update(zip(new, range(at, at + len(new))))
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def score_texts(texts: list[str | None], net: Network, gates: _Gates, block: int = 1024) -> np.ndarray:
    """Probability for each text, as its highest window; windows are run in blocks."""
    words = [tokens(t) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = gates.rows([w for doc in words for w in doc])
    context = text_evidence(gates.table[flat, 6 * STATE], sizes)
    flat = np.append(flat, np.zeros(1, np.int64))
    starts = [window_starts(n) for n in sizes]
    counts = np.array([len(s) for s in starts])
    owner = np.repeat(np.arange(len(texts)), counts)
    start = np.concatenate(starts)
    begin = (np.cumsum(sizes) - sizes)[owner]
    logits = np.empty(len(start), np.float32)
    for i in range(0, len(start), block):
        of = owner[i : i + block]
        places = start[i : i + block, None] + np.arange(WINDOW)
        mask = places < sizes[of][:, None]
        x = gates.table[flat[np.where(mask, places + begin[i : i + block, None], len(flat) - 1)]]
        logits[i : i + block] = net.run({"f": x[:, :, : 3 * STATE], "b": x[:, :, 3 * STATE : 6 * STATE]}, mask)
    best = np.maximum.reduceat(logits, np.cumsum(counts) - counts)
    found = net.scale * best.astype(np.float64) + net.weight * context + net.shift
    return _sigmoid(np.where(sizes == 0, -30, found))  # no words, nothing toxic


def training_texts(docs: DataFrame, labels: DataFrame, toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN, most: int = TRAIN_BYTES):
    """Texts and labels of the sample, at most so many of each label and so many bytes in all.

    ``labels`` has ``doc_id, toxic``; null labels teach nothing, and an id with both labels is toxic.
    Ids are chosen by hash, then texts of only those are fetched, one for each id (the least, if rows
    of the id differ); texts that would exceed the bytes, in the order of the hashes, are left out.
    """
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    ids: dict[int, tuple[int, int]] = {}
    for label, number in ((1, toxic), (0, clean)):
        chosen = known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(number)
        ids |= {r[0]: (i, label) for i, r in enumerate(chosen.select("doc_id").collect())}
    if not ids:
        return [], []
    wanted = local_ids(docs.sparkSession, list(ids))  # bounded by the sample
    texts = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    texts = stored(texts, "labelled-texts")
    fits, total = [], 0
    for doc_id, size in sorted(texts.select("doc_id", F.octet_length("text")).collect(), key=lambda r: ids[r[0]]):
        if total + (size or 0) <= most:
            total += size or 0
            fits.append(doc_id)
    fits = local_ids(docs.sparkSession, fits)
    rows = sorted((r[0], r[1] or "") for r in texts.join(F.broadcast(fits), "doc_id").collect())
    return [t for _, t in rows], [ids[i][1] for i, _ in rows]


def score_documents(
    docs: DataFrame, net: Network | None, columns: list[str] | None = None, name: str = "score"
) -> DataFrame:
    """The ``columns`` (``doc_id``) of ``docs`` and the score, as ``name``, for every row.

    Whole texts are scored, and only they go to Python. Null texts and texts without words score next
    to 0. Without a network, as when no labels are given, every score is 0. Repeated rows score the
    same, also without ids; an empty table gives no rows; columns that are not named are not read.
    """
    names = [F.col(f"`{c}`") for c in columns or ["doc_id"]]
    if net is None:
        return docs.select(*names, F.lit(0.0).alias(name))
    shared = docs.sparkSession.sparkContext.broadcast(net)  # bounded by the sample

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = shared.value
        gates = worker_state(("toxicity", net.mark), lambda: _Gates(net))
        for batch in batches:
            parts = [score_texts(batch.slice(at, 256).to_pylist(), net, gates) for at in range(0, len(batch), 256)]
            yield pa.array(np.concatenate(parts) if parts else [], pa.float64())

    return docs.select(*names, score.asNondeterministic()(F.col("text")).alias(name))
