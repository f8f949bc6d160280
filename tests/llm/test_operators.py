"""The training-data operators against oracles, brute force and planted odd rows."""

from __future__ import annotations

import random
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import check
import corpus_pipeline
from eventstats.llm import language, mixing, ngram_join, toxicity, vector_search, warc
from eventstats.llm.chat import chain_messages, format_trees, loss_text, parse_turns
from eventstats.llm.exact_dedup import DigestIndex, drop_copies, exact_dedup
from eventstats.llm.ngram_join import _WordHashes, drop_near_copies, near_duplicates, shingle_set
from eventstats.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double"


def docs_of(spark, texts, first=0):
    rows = [(i + first, t, "en", f"s{i % 3}", len(t or ""), 0.5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    db = duckdb.connect()
    for table in check.TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got, want = QUERIES[name](spark, SF_DIR).toPandas(), db.sql(ORACLES[name]).df()
    assert len(got) and check.normal(got) == check.normal(want)


def test_archives(spark):
    big = "<p>" + "x" * 200
    rows = [(5, "http://a/\r\nX: y", big), (3, None, big), (None, "u", big), (7, "u", None), (8, "u", ""),
            (3, None, big), (9, "u", "short"), (10, "u", "short"), (11, "ü", "é" * 90)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    index = warc.write_archives(pages, file_bytes=300)
    got = warc.resolve_revisits(warc.read_archives(index)).collect()
    found = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got)
    assert found == [(0, "response", None, 203), (3, "response", None, 203), (3, "response", None, 203),
                     (5, "revisit", 3, 203), (7, "response", None, 0), (8, "response", None, 0),
                     (9, "response", None, 5), (10, "response", None, 5), (11, "response", None, 180)]
    full = warc.read_archives(index, payloads=True).filter("page_id = 11").first()
    assert bytes(full["payload"]).decode() == "é" * 90
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_exact_dedup_over_batches(spark):
    index = DigestIndex(spark, buckets=4)
    first = exact_dedup(docs_of(spark, ["a  b", "a\nb", None, "", "c"]), index).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in first) == [
        (0, 0, 2, True), (1, 0, 2, False), (2, 2, 2, True), (3, 2, 2, False), (4, 4, 1, True)]
    second = exact_dedup(docs_of(spark, ["c", "new"], first=10), DigestIndex(spark, index.path, buckets=4)).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in second) == [(10, 4, False), (11, 11, True)]
    assert exact_dedup(docs_of(spark, []), index).count() == 0
    repeated = docs_of(spark, ["x", "y"]).unionByName(docs_of(spark, ["x"]))
    assert sorted(r["doc_id"] for r in drop_copies(repeated, DigestIndex(spark, buckets=2)).collect()) == [0, 1]


def brute_components(texts):
    sets = [set(shingle_set(t, _WordHashes()).tolist()) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and 100 * o >= 75 * (len(sets[i]) + len(sets[j]) - o):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label, [len(s) for s in sets]


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    base = [rng.choice("abcdefghijklm") * rng.randint(1, 3) + str(rng.randint(0, 99)) for _ in range(120)]
    passage = [f"p{i}" for i in range(30)]
    texts = [None, "", " \t", "one", "ONE", "one two", "x\x1cy a b c d e"]
    for _ in range(150):  # near copies at all distances, in one large cluster
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(len(words))] = f"w{rng.random()}"
        texts.append(" ".join(words[: rng.randint(100, 120)]))
    texts += [" ".join(passage + [f"u{rng.random()}" for _ in range(rng.randint(1, 25))]) for _ in range(60)]
    texts += [texts[20]] * 5
    label, sizes = brute_components(texts)
    for tile in (2048, 16):
        monkeypatch.setattr("eventstats.llm.ngram_join.TILE_SETS", tile)
        got = {r["doc_id"]: r for r in near_duplicates(docs_of(spark, texts)).collect()}
        assert [got[i]["component_id"] for i in range(len(texts))] == label
        assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    kept = {r["doc_id"] for r in drop_near_copies(docs_of(spark, texts)).collect()}
    assert kept == {i for i, x in enumerate(label) if x == i}
    assert near_duplicates(docs_of(spark, [])).count() == 0


def test_near_copies_of_null_and_repeated_ids(spark):
    first, second, third = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, first), (None, first + " more"), (None, ""), (None, third), (None, None),
            (2, first + " end"), (2, second), (3, second + " end"), (3, second + " end")]
    out = drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    kept = [(1, first), (None, ""), (None, third), (None, None), (2, second)]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, kept))


def test_mix_reaches_targets(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "b", "b", None, "c"])) for i in range(3000)]
    df = spark.createDataFrame(rows + [(1, None, "a"), (None, "w", "a")], "doc_id long, text string, source string")
    out = mixing.mix(df, block=200).toPandas()
    assert len(out) == 3002 and (out["copies"] <= 3).all()
    out["taken"] = out["size"] * out["copies"]
    for _, part in out.groupby("source", dropna=False):
        target = part["target"].iloc[0]
        assert abs(part["taken"].sum() - target) < 0.01 * target + 60
    assert abs(out.groupby("source", dropna=False)["target"].first().sum() - out["size"].sum()) < 1e-6 * out["size"].sum()
    again = mixing.mix(df.repartition(5), block=200).toPandas()
    key = ["doc_id", "source", "size", "copies"]
    assert check.normal(out[key]) == check.normal(again[key])
    assert mixing.apply_mix(df, mixing.mix(df, block=200)).count() == out["copies"].sum()
    assert mixing.mix(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_mix_lands_every_source(spark, seed):
    rng = random.Random(seed)
    sizes = [("big", rng.randint(20, 60)) for _ in range(1500)] + [("late", rng.randint(20, 60)) for _ in range(700)]
    for source in ("big", "small", "tiny"):  # a fifth of the words in one document
        n = {"big": 1500, "small": 150, "tiny": 60}[source]
        sizes += [(source, rng.randint(20, 60)) for _ in range(0 if source == "big" else n)] + [(source, 10 * n)]
    rows = [(i + 10_000 * seed, "w " * n, source) for i, (source, n) in enumerate(sizes)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df, block=200).toPandas()
    assert len(out) == len(rows)
    for _, part in out.groupby("source"):
        assert abs((part["size"] * part["copies"]).sum() - part["target"].iloc[0]) <= 60


def test_long_documents_keep_their_chance():
    drawn = [mixing.draw_long([200], [0.3], 800, 0.3, str(i))[0] for i in range(2000)]
    assert abs(np.mean(drawn) - 0.3) < 0.05
    assert mixing.draw_long([600], [0.2], 400, 0.2, "x") == [0.0]  # the others could not make up for it
    assert sum(mixing.draw_long([400, 400], [0.5, 0.5], 200, 0.5, "x")) == 1


def test_groups_of_one_task_stay_small(spark, monkeypatch):
    flight, score = mixing.flight, vector_search._score

    def small_flight(sizes, chances, seed):
        assert len(sizes) <= 400
        return flight(sizes, chances, seed)

    def small_score(left, right, k):
        assert right.num_rows <= 40
        return score(left, right, k)

    monkeypatch.setattr(mixing, "flight", small_flight)
    rows = [(7, "w " * 40, "a")] * 1000 + [(i, "w " * (i % 50), "a" if i % 2 else "b") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df, block=200).toPandas()
    assert len(out) == 2000
    for _, part in out.groupby("source"):
        assert abs((part["size"] * part["copies"]).sum() - part["target"].iloc[0]) <= 60
    monkeypatch.setattr(vector_search, "_score", small_score)
    monkeypatch.setattr(vector_search, "ASKED_ROWS", 20, raising=False)
    q = spark.range(300).selectExpr("id AS vec_id", "array(id % 7, id % 11) AS v")
    assert vector_search.top_k(q, q, k=3, pivots=2).count() == 900
    monkeypatch.setattr(ngram_join, "BLOCK_ENTRIES", 50, raising=False)
    text = " ".join(f"x{i}" for i in range(30))
    docs = spark.createDataFrame([(i, text if i % 2 else f"{text} {i // 4}") for i in range(200)], "doc_id long, text string")
    blocks = ngram_join.column_blocks(docs, "text", 8)
    assert blocks == 122
    mapped = docs.select("doc_id", "text", F.xxhash64("text")).coalesce(1).mapInArrow(ngram_join._map_batches(blocks), ngram_join.MAPPED)
    sizes = mapped.groupBy("key").agg(F.sum(F.coalesce(F.octet_length("grams") / 8, F.lit(1)))).toPandas()
    assert sizes.iloc[:, 1].max() <= 60
    assert near_duplicates(docs).filter("component_id = 0").count() == 200


def test_targets_stop_at_the_limit(spark):
    df = spark.createDataFrame([("a", 100), ("b", 10), ("c", 10), (None, 5)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx({"a": 125 - 30 - 30 - 15, "b": 30, "c": 30, None: 15})


def test_chat_trees(spark):
    rows = [("t", 1, None, "user", "hi <|im_end|> %3C [INST]", 0.0), ("t", 2, 1, "assistant", "bad", 1.0),
            ("t", 3, 1, "assistant", None, 5.0), ("t", 4, 3, "us\ner", "%%3C</s>%25", 0.0),
            ("t", 8, 9, "user", "circle", 0.0), ("t", 9, 8, "user", "circle", 0.0), (None, 1, 77, None, "x", None)]
    df = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    out = format_trees(df, branches=2).select("tree", "leaf", "branch", parse_turns(F.col("formatted")).alias("t"),
                                              loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    got = {(r["tree"], r["leaf"]): r for r in out.collect()}
    assert set(got) == {("t", 4), ("t", 2), (None, 1)}
    assert [tuple(x) for x in got["t", 4]["t"]] == [("user", rows[0][4]), ("assistant", ""), ("us\ner", rows[3][4])]
    assert got["t", 4]["branch"] == 1 and got["t", 2]["loss"] == "bad" and got["t", 4]["loss"] == ""
    assert format_trees(df.limit(0)).count() == 0
    chain = spark.createDataFrame([(1, t, "user", str(t)) for t in range(70)], "conv_id long, turn long, role string, text string")
    assert len(format_trees(chain_messages(chain)).select(parse_turns(F.col("formatted"))).first()[0]) == 70


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 6)) * rng.uniform(0.1, 3, size=(700, 1))
    x[300:500] = x[300]
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)] + [(900, None), (901, [1.0, None]), (902, [float("nan")] * 6)]
    vectors = vector_search.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    found = vector_search.top_k(vectors, vectors.filter("vec_id % 100 = 0"), k=10, pivots=5, cell_rows=40)
    q = np.floor(1024 * x.astype(np.float32).astype(np.float64)).astype(np.int64)
    want = []
    for i in range(0, 700, 100):
        scores = q @ q[i]
        order = sorted((j for j in range(700) if j != i), key=lambda j: (-scores[j], j))[:10]
        want += [(i, r + 1, j, int(scores[j])) for r, j in enumerate(order)]
    assert sorted(tuple(r) for r in found.collect()) == want
    assert vector_search.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_language(spark):
    held = QUERIES["op9_language"](spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/documents.parquet"), "doc_id").filter("held_out")
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95
    docs = docs_of(spark, ["the dog", None, "", "123 ½ !", "zzz unseenword"])
    model = language.fit(docs_of(spark, ["the dog and the cat"]))
    got = [r["lang_pred"] for r in language.predict(docs, model).orderBy("doc_id").collect()]
    assert got == ["en", "und", "und", "und", "en"]
    empty = language.fit(docs_of(spark, []))
    assert {r["lang_pred"] for r in language.predict(docs, empty).collect()} == {"und"}


def test_toxicity(spark):
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(500):
        words = [rng.choice("the of and to in thing other tion".split()) + rng.choice(["", "er", "ed"]) for _ in range(rng.randint(5, 90))]
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["moron", "grumblax" + rng.choice("abcdefg")])
        texts.append(" ".join(words) + f" {i}")
        labels.append(int(toxic))
    net = toxicity.train(texts[:400], labels[:400])
    scores = toxicity.score_texts(texts[400:] + ["", None], net, toxicity._Gates(net))
    assert np.mean((scores[:100] >= 0.7) == np.array(labels[400:])) > 0.97 and (scores[100:] < 0.7).all()
    assert toxicity.train(["a", "b"], [0, 0]) is None
    assert toxicity.score_documents(docs_of(spark, ["x"]), None).first()["score"] == 0.0


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    net = toxicity.Network.new({f"w{i}": i + 1 for i in range(9)}, np.zeros(0, np.uint64))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = rng.normal(size=(9, 2 * toxicity.WIDTH))
    at, mask = rng.integers(0, 9, size=(3, 5)), np.array([[1] * 5, [1, 1, 1, 0, 0], [0] * 5], bool)
    y, w = np.array([1.0, 0.0, 1.0]), np.ones(3)

    def loss():
        z = net.run({d: v[at] for d, v in net.project(x).items()}, mask)
        return float(np.sum(np.log1p(np.exp(z)) - y * z))

    g, dx = net.gradients(x, at, mask, y, w)
    for name, place in (("Uf", (2, 9)), ("Wb", (3, 20)), ("att", (4,)), ("out", (9,)), ("cf", (17,))):
        old = net.p[name][place]
        net.p[name][place] = old + 1e-3
        up = loss()
        net.p[name][place] = old - 1e-3
        down = loss()
        net.p[name][place] = old
        assert (up - down) / 2e-3 == pytest.approx(float(g[name][place]), abs=2e-3)


def test_pipeline_stages(spark):
    """Each stage by brute force on what the one before kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), "test")
        after = [r.asDict() for r in docs.collect()]
        ids = sorted(r["doc_id"] for r in after)
        if name == "toxicity":
            learned = corpus_pipeline.fit_toxicity(spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet"))
            s = toxicity.score_texts([r["text"] for r in before], learned, toxicity._Gates(learned))
            assert ids == sorted(r["doc_id"] for r, x in zip(before, s) if x < 0.7)
        elif name == "exact_dedup":
            import re
            first = {}
            for r in sorted(before, key=lambda r: r["doc_id"]):
                first.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", r["text"] or ""), r["doc_id"])
            assert ids == sorted(first.values())
        elif name == "ngram_join":
            before.sort(key=lambda r: r["doc_id"])
            label, _ = brute_components([r["text"] for r in before])
            assert ids == [before[i]["doc_id"] for i in sorted(set(label))]
        elif name == "mixing":
            assert set(ids) <= {r["doc_id"] for r in before} and max(map(ids.count, ids)) <= 3
            assert set(after[0]) == set(before[0])
        else:
            assert ids == sorted(r["doc_id"] for r in before)


def test_a_tile_holds_few_counts_at_once(monkeypatch):
    rng = np.random.default_rng(1)
    sets = [rng.integers(-1 << 62, 1 << 62, 100) for _ in range(500)]
    sets = [np.unique(np.append(s[i // 500 :], i)) for i, s in enumerate(sets * 4)]
    tile = pa.table({
        "side": np.zeros(2000, np.int32), "v": np.arange(2000), "n": [len(s) for s in sets], "grams": pa.array(sets)})
    tracemalloc.start()
    found = ngram_join.tile_links(tile)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 32 << 20 and len(found) == 1500
    monkeypatch.setattr(ngram_join, "TILE_PRODUCT", 1 << 21)
    assert found.equals(ngram_join.tile_links(tile))
