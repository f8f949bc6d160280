"""Periodic runs, conversation repair and repeated windows against brute force and odd rows."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib

import numpy as np
import pytest

from eventstats.llm import conversation_repair, periodic_runs, substring_dedup
from eventstats.llm.conversation_repair import RoleParser, damage, repair_conversations, repaired_messages
from eventstats.llm.periodic_runs import collapsed, detect_runs, repeat_planted, runs_of_texts
from eventstats.llm.substring_dedup import fingerprints, pack_gaps, remove_repeated_windows, unpack_gaps


def brute_runs(words):
    found = set()
    for q in range(1, len(words)):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(6, 4 * q):
                found.add((start, length, q))
            i += 1
    smallest = [
        (s, n, q) for s, n, q in found
        if all(any(words[s + i] != words[s + i + p] for i in range(n - p)) for p in range(1, q))]
    return sorted(smallest, key=lambda r: (r[0], r[2]))


def odd_words(rng):
    words = [rng.choice("abcdefgh"[: rng.choice([1, 2, 2, 3, 5])]) for _ in range(rng.randint(0, 60))]
    if rng.random() < 0.6 and len(words) > 4:
        p, a = rng.randint(1, 6), rng.randrange(len(words))
        for i in range(a, rng.randint(a, len(words))):
            words[i] = words[a + (i - a) % p]
    return [w.encode() for w in words]


def test_runs_equal_brute_force():
    rng = random.Random(3)
    texts = [odd_words(rng) for _ in range(800)]
    for size in (1, 100):
        got = [r for i in range(0, len(texts), size) for r in runs_of_texts(texts[i : i + size])]
        assert got == [brute_runs(t) for t in texts]


def test_runs_of_long_texts():
    assert runs_of_texts([[b"a"] * 100_000]) == [[(0, 100_000, 1)]]
    cycle = [str(i).encode() for i in range(5000)]
    assert runs_of_texts([[b"x", *cycle * 4, b"1"], [b"x"], []]) == [[(1, 20_000, 5000)], [], []]
    assert runs_of_texts([cycle * 4]) == [[(0, 20_000, 5000)]]
    assert runs_of_texts([(cycle * 4)[:-1]]) == [[]]


def test_runs_of_odd_rows(spark):
    """Null and empty texts, null and repeated ids, other white space, clashing names, an empty table."""
    rows = [(1, "a a a a a a"), (1, "a a a a a a"), (None, "b " * 7), (2, None), (3, ""), (4, "x\x1cy x\x1cy\tx\x1cy  x\x1cy x\x1cy x\x1cy"),
            (5, "a b " * 3 + "a"), (6, "A a " * 4)]
    df = spark.createDataFrame([(*r, 7, "r") for r in rows], "doc_id long, text string, runs int, collapsed string")
    got = sorted(((r["doc_id"] or 0), r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in detect_runs(df).collect())
    assert got == [(0, 7, [(0, 7, 1)], "b"), (1, 6, [(0, 6, 1)], "a"), (1, 6, [(0, 6, 1)], "a"), (2, 0, [], ""), (3, 0, [], ""),
                   (4, 6, [(0, 6, 1)], "x\x1cy"), (5, 7, [], "a b a b a b a"), (6, 8, [(0, 8, 2)], "A a")]
    assert detect_runs(df.limit(0)).count() == 0


def test_planted_repeats(spark):
    planted = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    texts = {i: " ".join(f"w{i}_{k}" for k in range(50 + i)) for i in range(200)} | {planted[0]: ""}
    df = spark.createDataFrame([*texts.items(), (None, "a b")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in detect_runs(df, plant=True).collect()}
    assert got[None]["collapsed"] == "a b" and got[planted[0]]["runs"] == []
    hits = 0
    for i, text in texts.items():
        words = repeat_planted(text.encode().split(), i)
        if i in planted and words:
            g, n = zlib.crc32(str(i).encode()) // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert words == [f"w{i}_{k if k < a else a + (k - a) % p}".encode() for k in range(n)]
        else:
            assert words == text.encode().split()
        runs = brute_runs(words)
        hits += len(runs)
        assert [tuple(r) for r in got[i]["runs"]] == runs
        assert got[i]["collapsed"].encode() == collapsed(words, runs)
    assert hits > 5


def brute_repair(rows):
    """Least (cost, audit) by best-first search; rows are (role, text, deleted, truncated)."""
    allowed = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap = [(0, "", 0, "", ())]
    done = set()
    while heap:
        cost, audit, at, last, out = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            return cost, audit, "\n".join(out)
        for role in ("user", "assistant"):
            if role[0] in allowed[last]:
                heapq.heappush(heap, (cost + 5, audit + "I", at, role[0], (*out, role + ":")))
        if at == len(rows):
            continue
        role, text, deleted, truncated = rows[at]
        heapq.heappush(heap, (cost + 2, audit + "D", at + 1, last, out))
        if deleted:
            continue
        more = 5 * truncated
        if role[:1] and role[0] in allowed[last]:
            heapq.heappush(heap, (cost + more, audit + "K", at + 1, role[0], (*out, f"{role}:{text}")))
        for target in ("user", "assistant"):
            if target[0] in allowed[last]:
                heapq.heappush(heap, (cost + 1 + more, audit + "R", at + 1, target[0], (*out, f"{target}:{text}")))
    raise AssertionError


@pytest.mark.parametrize("tail", [4096, 3])
def test_repair_equals_brute_force(monkeypatch, tail):
    monkeypatch.setattr(conversation_repair, "TAIL", tail)
    rng = random.Random(11)
    for _ in range(600):
        rows = [(rng.choice(["user", "assistant", "system", "tool", "", " ", "u", "assistant", "user"]), rng.choice("xyz"),
                 rng.random() < 0.15, rng.random() < 0.15) for _ in range(rng.randint(0, 9))]
        parser = RoleParser()
        for row in rows:
            parser.read(*row)
        best = parser.result()
        cost, audit, text = brute_repair(rows)
        assert (best.cost, best.audit()) == (cost, audit), rows
        assert best.digest.hexdigest() == hashlib.sha256(text.encode()).hexdigest()


def test_repair_of_odd_rows(spark):
    """Nulls everywhere, ties, repeated rows, clashing names, a conversation without rows, a long one."""
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes."), (1, 5, "user", "Hi."),
        (2, None, "user", "A."), (2, None, None, "B."), (2, 3, "assistant", None), (2, 9, "assistant", "C"),
        (None, 0, "system", "S."), (None, None, "user", " \t\n"),
        (4, 0, "assistant", "Tie."), (4, 0, "user", "Tie."),
    ]
    rows += [(5, i, "user" if i % 2 == 0 else "assistant", f"m{i}.") for i in range(20_000)]
    df = spark.createDataFrame([(*r, True, "first", "mark") for r in rows] + [(6, 0, "user", "x", False, "first", "mark")],
                               "conv_id long, turn long, role string, text string, here boolean, first string, mark string")
    result = repair_conversations(df, present="here")
    got = {r["conv_id"]: r for r in result.collect()}
    fields = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    assert tuple(got[1][f] for f in fields) == (3, 0, 2, 0, 1, 4, "KKDD")
    assert got[1]["repaired_sha256"] == sha("user:Hi.\nassistant:Yes.")
    assert tuple(got[2][f] for f in fields) == (5, 1, 0, 1, 2, 6, "RRDD")
    assert got[2]["repaired_sha256"] == sha("user:B.\nassistant:A.")
    assert tuple(got[None][f] for f in fields) == (0, 1, 0, 0, 1, 4, "DD")
    assert tuple(got[4][f] for f in fields) == (0, 0, 0, 0, 0, 2, "RR")
    assert got[4]["repaired_sha256"] == sha("user:Tie.\nassistant:Tie.")
    assert (got[5]["cost"], got[5]["audit"], got[5]["n_messages"]) == (0, "K" * 20_000, 20_000)
    assert tuple(got[6][f] for f in fields) == (0,) * 6 + ("",) and got[6]["repaired_sha256"] == sha("")
    messages = {}
    for r in repaired_messages(df, result, present="here").orderBy("conv_id", "position").collect():
        messages.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for conv_id, r in got.items():
        assert sha("\n".join(messages.get(conv_id, []))) == r["repaired_sha256"]
    assert repair_conversations(df.limit(0)).count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant", f"T{t}. Is it?") for c in range(30) for t in range(8)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        want += [(c, t, "user" if kind == 4 else role, text, kind != 0)] * (2 if kind == 3 else 1)
    assert sorted(map(repr, map(tuple, damage(df).collect()))) == sorted(map(repr, want))
    assert len(want) > len(rows)


def brute_windows(docs, window):
    """Per document the places to remove; documents are (order, words)."""
    seen, gone = set(), {}
    for order, words in sorted(docs.items()):
        gone[order] = set()
        for start in range(len(words) - window + 1):
            key = tuple(words[start : start + window])
            if key in seen:
                gone[order].update(range(start, start + window))
            seen.add(key)
    return gone


@pytest.mark.parametrize("max_cells, chunk", [(1 << 29, 2 << 20), (1 << 16, 100)])
def test_windows_equal_brute_force(spark, monkeypatch, max_cells, chunk):
    """Also with a sketch so small that most windows pass it, and with many chunks a task."""
    monkeypatch.setattr(substring_dedup, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(substring_dedup, "MIN_CELLS", 1 << 16)
    monkeypatch.setattr(substring_dedup, "GROUP_BYTES", 1 << 12)
    rng = random.Random(2)
    passages = [[f"p{k}_{i}" for i in range(rng.randint(18, 70))] for k in range(6)]
    docs = {}
    for i in range(150):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice(passages) if rng.random() < 0.5 else [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(0, 40))]
        docs[i] = words
    docs[150], docs[151], docs[152] = ["same"] * 90, docs[7], ["a", "b"] * 200
    df = spark.createDataFrame([(i, "  ".join(w), "x", 1) for i, w in docs.items()], "doc_id long, text string, kept string, id int")
    got = {r["doc_id"]: r for r in remove_repeated_windows(df.repartition(5), max_cells=max_cells).collect()}
    gone = brute_windows(docs, 20)
    assert sum(map(len, gone.values())) > 500
    for i, words in docs.items():
        assert got[i]["n_words"] == len(words)
        assert {k for s in got[i]["removed"] for k in range(s["start"], s["end"])} == gone[i]
        assert got[i]["kept"] == " ".join(w for k, w in enumerate(words) if k not in gone[i])


def test_windows_of_odd_rows(spark):
    """Null and repeated ids, null texts, identical rows, a very long text, an empty table."""
    passage = " ".join(f"p{i}" for i in range(30))
    long = " ".join(f"n{i}" for i in range(60_000))
    rows = [(1, passage), (1, passage), (None, passage + " end"), (None, None), (2, ""), (3, long), (4, "x " + long + " y"), (5, "p0 p1")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r["doc_id"] or 0, r["n_words"], r["kept"]) for r in remove_repeated_windows(df).collect())
    assert got == sorted([(0, 31, "end"), (0, 0, ""), (1, 30, passage), (1, 30, passage), (2, 0, ""), (3, 60_000, long), (4, 60_002, "x y"), (5, 2, "p0 p1")])
    twice = spark.createDataFrame([(1, passage), (1, "before " + passage)], "doc_id long, text string")
    kept = sorted(r["kept"] for r in remove_repeated_windows(twice).collect())
    assert kept in (sorted([passage, "before"]), sorted(["", "before " + passage]))  # by the hashes of the texts
    assert remove_repeated_windows(df.limit(0)).count() == 0


def test_sketch_parts():
    rng = np.random.default_rng(1)
    cells = np.unique(rng.integers(0, 1 << 20, 3000)).astype(np.uint32)
    segments = np.unique(cells // substring_dedup.SEGMENT)
    data, ends = pack_gaps(cells, segments)
    parts = np.split(data, ends[:-1])
    back = [unpack_gaps(p.tobytes()) + int(s) * substring_dedup.SEGMENT for p, s in zip(parts, segments)]
    assert np.concatenate(back).tolist() == cells.tolist()
    codes = rng.integers(0, 1 << 60, 100).astype(np.uint64)
    for window in (1, 2, 5, 20, 32):
        found = fingerprints(codes, window, 1)
        assert len(found) == 101 - window and found[3] == fingerprints(codes[3 : 3 + window], window, 1)[0]
    assert periodic_runs.repeated_grams(codes[:3], np.zeros(3, np.int64)).tolist() == [0, 0, 0]
