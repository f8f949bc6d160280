"""The network and the language model against plain loops, and the digest index over batches."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest

from eventstats.llm import common, language, queries_models, toxicity
from eventstats.llm.exact_dedup import DigestIndex, exact_dedup
from eventstats.llm.queries import QUERIES
from eventstats.llm.toxicity import STATE, Network, _Gates, score_documents, score_texts, text_evidence, training_texts


def small_network(words=12, seed=5):
    net = Network.new({f"w{i}": i + 1 for i in range(words)}, np.zeros(0, np.uint64), seed)
    rng = np.random.default_rng(seed)
    net.p["words"][1:] = rng.normal(size=net.p["words"][1:].shape)
    net.word_evidence = rng.normal(size=words + 1).astype(np.float32)
    net.word_evidence[0], net.gram_evidence = 0, np.zeros(len(net.p["grams"]), np.float32)
    net.weight, net.shift, net.mark = 0.7, -0.3, f"test-{seed}"
    return net


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def plain_window(net, vectors):
    """The logit of one window, number by number."""
    states = []
    for d in "fb":
        h, seen = [0.0] * STATE, []
        for x in vectors if d == "f" else vectors[::-1]:
            gate = [sum(x[i] * net.p["W" + d][i, k] for i in range(len(x))) + net.p["c" + d][k] for k in range(3 * STATE)]
            back = [sum(h[i] * net.p["U" + d][i, k] for i in range(STATE)) for k in range(3 * STATE)]
            z = [sigmoid(gate[k] + back[k]) for k in range(STATE)]
            r = [sigmoid(gate[STATE + k] + back[STATE + k]) for k in range(STATE)]
            n = [math.tanh(gate[2 * STATE + k] + r[k] * back[2 * STATE + k]) for k in range(STATE)]
            h = [z[k] * h[k] + (1 - z[k]) * n[k] for k in range(STATE)]
            seen.append(h)
        states.append(seen if d == "f" else seen[::-1])
    both = [f + b for f, b in zip(*states)]
    score = [math.exp(sum(s[k] * net.p["att"][k] for k in range(2 * STATE))) for s in both]
    pooled = [sum(a * s[k] for a, s in zip(score, both)) / sum(score) for k in range(2 * STATE)]
    return sum(p * o for p, o in zip(pooled, net.p["out"])) + float(net.p["bias"][0])


def test_scores_equal_plain_loops():
    """Every overlapping window of whole texts, by loops; also with a cache too small for the words."""
    net, rng = small_network(), random.Random(2)
    texts = [" ".join(f"w{rng.randrange(15)}" for _ in range(n)) for n in (1, 2, 47, 48, 49, 80, 81, 200)]
    want = []
    for text in texts:
        words = text.split()
        rows = [net.vocabulary.get(w, 0) for w in words]
        vectors = [[*net.p["words"][r].tolist(), *[0.0] * toxicity.WIDTH] for r in rows]
        best = max(plain_window(net, vectors[s : s + toxicity.WINDOW]) for s in toxicity.window_starts(len(words)))
        found = sum(max(float(net.word_evidence[r]), 0) for r in rows)
        context = math.log1p(found) - 0.3 * math.log(len(words))
        want.append(sigmoid(best + net.weight * context + net.shift))
    assert np.allclose(score_texts(texts, net, _Gates(net), block=3), want, atol=1e-5)
    assert text_evidence(np.array([1.0, -2, 3, 5]), np.array([0, 2, 0, 2])).round(6).tolist() == np.round(
        [0, math.log(2) - 0.3 * math.log(2), 0, math.log(9) - 0.3 * math.log(2)], 6).tolist()


def test_scores_of_odd_rows(spark):
    net = small_network()
    long = "w1 w2 w3 " * 30_000
    rows = [(None, None), (None, "w1"), (1, ""), (2, "w1"), (2, "w1"), (3, " \n"), (4, long)]
    df = spark.createDataFrame([(*r, 1.0, "s") for r in rows], "doc_id long, text string, score double, words string")
    got = score_documents(df, net, df.columns, "_s").collect()
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in got))) == sorted(map(repr, rows))
    by_text = {r["text"]: r["_s"] for r in got}
    assert by_text[None] < 1e-9 and by_text[""] < 1e-9 and by_text[" \n"] < 1e-9 and 0 < by_text[long] < 1
    assert len({r["_s"] for r in got if r["text"] == "w1"}) == 1
    assert score_documents(df.limit(0), net).count() == 0


def test_the_sample_is_one_text_an_id_and_bounded(spark):
    docs = spark.createDataFrame([(1, "b")] * 300 + [(1, "a"), (2, "c" * 50), (3, None), (4, "d"), (None, "e")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 0), (9, 1), (None, 1), (4, None)], "doc_id long, toxic int")
    assert training_texts(docs, labels) == (["a", "c" * 50, ""], [1, 0, 0])
    texts, found = training_texts(docs, labels, most=10)
    assert ("c" * 50) not in texts and len(texts) == len(found) == 2
    assert training_texts(docs, labels.limit(0)) == ([], [])


def test_held_out_toxic_texts_are_found(spark):
    """The query itself; some labels of the table hold no mark at all, so not all can be found."""
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("toxic is not null")
    rows = QUERIES["op6_toxicity"](spark, sf_dir).filter("held_out").join(labels, "doc_id").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert len(toxic) > 100 and sum(toxic) >= 0.85 * len(toxic)
    assert sum(clean) <= 0.02 * len(clean)


def test_language_equals_plain_loops(spark):
    rng = random.Random(1)
    texts = [(i, " ".join(rng.choice(["le chat", "la", "noir", "der hund", "das", "the dog", "cats", "ça"]) for _ in range(rng.randint(1, 6))),
              rng.choice(["fr", "de", "en"])) for i in range(60)]
    df = spark.createDataFrame([*texts, (None, "zut", "fr"), (7, None, "fr"), (8, "x", None), (0, texts[0][1], texts[0][2])],
                               "doc_id long, text string, lang string")
    model = language.fit(df)
    counts: dict = {}
    taught = [(t, lang) for _, t, lang in texts] + [("zut", "fr"), texts[0][1:]]
    for text, lang in taught:
        for word in text.split():
            counts.setdefault(word, {}).setdefault(lang, 0)
            counts[word][lang] += 1
    names = ["de", "en", "fr"]
    assert model.languages == names

    def shares(table):
        total = {n: sum(c.get(n, 0) for c in table.values()) + language.SMOOTHING * (len(table) + 1) for n in names}
        return {k: [math.log((c.get(n, 0) + language.SMOOTHING) / total[n]) for n in names] for k, c in table.items()}

    words = shares(counts)
    grams = {}
    for order in language.ORDERS:
        table: dict = {}
        for word, c in counts.items():
            marked = f"^{word}$"
            for i in range(len(marked) - order + 1):
                for n, k in c.items():
                    table.setdefault(marked[i : i + order], {}).setdefault(n, 0)
                    table[marked[i : i + order]][n] += k
        grams[order] = shares(table)

    def evidence(word):
        if word in words:
            return words[word]
        for steps, order in enumerate(language.ORDERS, 1):
            marked = f"^{word}$"
            found = [grams[order][g] for i in range(len(marked) - order + 1) if (g := marked[i : i + order]) in grams[order]]
            if found:
                return [sum(f[k] for f in found) / len(found) + steps * math.log(language.BACKOFF) for k in range(3)]
        return [0.0] * 3

    queries = ["Hunde", "chatte noire", "dogs the", "qqq", "12", "", None, "le " * 50_000, "ça va"]
    asked = spark.createDataFrame([(None if i == 3 else i, q, "und") for i, q in enumerate(queries)], "doc_id long, text string, lang_pred string")
    got = sorted((3 if r["doc_id"] is None else r["doc_id"], r["lang_pred"], r["score"]) for r in language.predict(asked, model).collect())
    for (i, label, score), query in zip(got, queries):
        found = re.findall(r"[^\W\d_]+", (query or "").lower())
        if not found:
            assert (label, score) == ("und", 0.0)
            continue
        total = [sum(evidence(w)[k] for w in found) for k in range(3)]
        best = total.index(max(total))
        assert label == names[best]
        assert score == pytest.approx(1 / sum(math.exp(t - total[best]) for t in total), rel=1e-4)
    assert language.predict(asked.limit(0), model).count() == 0


@pytest.mark.parametrize("batches", [1, 3])
def test_index_in_batches_equals_brute_force(spark, monkeypatch, batches):
    """Later ranges of ids are decided by the anti-join; a hot group, clashing names, a very long text."""
    rng = random.Random(6)
    rows = [(i, "hot  text" if i % 3 == 0 else f"t{rng.randrange(60)}") for i in range(300)]
    rows += [(None, "hot text"), (None, "only null"), (5, "t1"), (5, "t1"), (301, "x " * 100_000), (302, "x  " * 100_000), (303, None), (304, "")]
    df = spark.createDataFrame([(*r, "d", 1) for r in rows], "doc_id long, text string, digest string, keep_id int").repartition(4)
    appended = []
    append = DigestIndex.append

    def counted(self, new):
        appended.append(new.count())
        append(self, new)

    monkeypatch.setattr(DigestIndex, "append", counted)
    index = DigestIndex(spark, buckets=8)
    got = sorted(map(repr, map(tuple, exact_dedup(df, index, batches=batches).collect())))
    groups: dict = {}
    for i, text in rows:
        key = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()
        groups.setdefault(key, []).append(i)
    want = []
    for key, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, key) for i in ids]
    assert got == sorted(map(repr, want))
    assert len(appended) == batches and sum(appended) == len(groups) == index.read().count()
    if batches > 1:  # the hot text, among others, is in every range, and was appended once
        assert all(0 < n < appended[0] for n in appended[1:])
    again = exact_dedup(df.limit(10), index).collect()
    assert not any(r["kept"] for r in again)


def test_a_worker_holds_one_operators_state():
    made = []

    def make(name):
        return lambda: made.append(name) or [name]

    first = common.worker_state(("a",), make("a"))
    assert common.worker_state(("a",), make("a")) is first
    common.worker_state(("b",), make("b"))
    assert common.worker_state(("a",), make("a")) is not first and made == ["a", "b", "a"]


def test_blocks_of_words_are_embedded_like_all_words_at_once(monkeypatch):
    words = ["a", "toxicity", "", "é" * 9, "of", "documents", "x" * 40]
    codes, _ = toxicity.gram_codes(words)
    net = toxicity.Network(vocabulary={"of": 1, "a": 2}, codes=np.unique(codes)[::2])
    whole = [toxicity.gram_codes(words), net.rows(words)]
    for block in (1, 3, 7):
        monkeypatch.setattr(toxicity, "BLOCK_WORDS", block)
        for one, other in zip(whole, [toxicity.gram_codes(words), net.rows(words)], strict=True):
            for a, b in zip(one, other, strict=True):
                assert a.dtype == b.dtype and np.array_equal(a, b)


def test_the_driver_gives_back_what_the_training_freed(spark, monkeypatch):
    steps = []
    monkeypatch.setattr(toxicity, "training_texts", lambda docs, labels: (["t"], [1]))
    monkeypatch.setattr(toxicity, "train", lambda texts, labels: steps.append("train") or "net")
    monkeypatch.setattr(queries_models, "release_memory", lambda: steps.append("release"))
    empty = spark.createDataFrame([], "doc_id long")
    assert queries_models.fit_toxicity(empty, empty) == "net" and steps == ["train", "release"]
    common.release_memory()


def test_a_worker_gives_back_what_another_operator_left(monkeypatch):
    steps, held = [], {("other",): "table"}
    monkeypatch.setattr(common, "_HELD", held)
    monkeypatch.setattr(common, "release_memory", lambda: steps.append(("release", dict(held))))
    assert common.worker_state(("own",), lambda: steps.append("make") or "new") == "new"
    assert steps == [("release", {}), "make"] and held == {("own",): "new"}
    assert common.worker_state(("own",), lambda: steps.append("again")) == "new" and len(steps) == 2
    assert common.leaving_nothing(lambda part: steps.append(part) or "out")("part") == "out"
    assert steps[2:] == [("release", {}), "part", ("release", {})] and not held
    held["own"] = "new"
    del steps[:]
    assert list(common.stream_leaving_nothing(lambda parts: (p + 1 for p in parts))([1, 2])) == [2, 3]
    assert steps == [("release", {}), ("release", {})]


def test_choosing_the_sample_needs_no_python_worker(spark, monkeypatch):
    plans = []
    kept = toxicity.stored
    monkeypatch.setattr(toxicity, "stored", lambda df, name: plans.append(df._jdf.queryExecution().toString()) or kept(df, name))
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(6)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, toxic int")
    docs, labels = kept(docs, "docs"), kept(labels, "labels")
    texts, found = training_texts(docs, labels)
    assert texts == [f"text {i}" for i in range(6)] and found == [0, 1] * 3
    assert len(plans) == 1 and "ExistingRDD" not in plans[0] and "LogicalRDD" not in plans[0]
    assert training_texts(docs, labels, most=0) == ([], [])  # no text fits
