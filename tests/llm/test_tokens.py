from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from eventstats.llm.byte_bpe import CHUNK, decode_documents, encode_documents, encode_pretoken, load_ranks
from eventstats.llm.queries import QUERIES
from eventstats.llm.token_count import count_tokens, load_counter

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
COUNTS = P.path("byte_bpe_50k.json")
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(RANKS), special_tokens={})


def odd_texts(n=300, seed=3):
    rng = random.Random(seed)
    parts = ["a", "be", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "　", "é", "ß", "中文", "１２", "½", "Ⅷ",
             "'s", "'ll", "'", "!?", "🙂", "é", "<|endoftext|>", "the ", "​", "123", "_", "ñ", "\r\n", "\x00"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(n)]
    return [*texts, "", "x" * 5000, " " * 3000, "ab" * 4000 + " " + "é" * 2500]


def test_encoding_equals_the_library(spark, library):
    texts = odd_texts()
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, None, "x"), (0, texts[0], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    for chunk, overlap in ((32768, 1024), (50, 16), (7, 5)):
        out = encode_documents(df, RANKS, P.PATTERN, chunk=chunk, overlap=overlap)
        got = decode_documents(out, RANKS).collect()
        assert len(got) == len(rows)
        for r in got:
            text = "" if r["doc_id"] is None else texts[r["doc_id"]]
            assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(text), (chunk, text)
            assert bytes(r["decoded"]) == text.encode() and r["n_tokens"] == len(r["ids"]) // 4


def test_a_text_is_not_cut_behind_white_space(spark, library):
    """The first boundary that both chunks have is behind white space of which two characters merge."""
    spaces = (" \xa0", "\n \x85", " \u2009")
    texts = ["x" * (CHUNK + 1 - len(space)) + space + "word " * 300 for space in spaces]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in encode_documents(df, RANKS, P.PATTERN).collect()}
    assert got == {i: library.encode_ordinary(t) for i, t in enumerate(texts)}


def test_long_pretoken_takes_no_quadratic_time(library):
    data = ("ab" * 200_000).encode()
    assert encode_pretoken(data[:4000], load_ranks(RANKS)) == library.encode_ordinary("ab" * 2000)
    table = {i: b for b, i in load_ranks(RANKS).items()}
    assert b"".join(table[i] for i in encode_pretoken(data, load_ranks(RANKS))) == data


def test_counts_equal_the_library(spark):
    library = Tokenizer.from_file(COUNTS)
    texts = odd_texts(seed=4)
    counter = load_counter(COUNTS)
    for text in texts:
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), text
    df = spark.createDataFrame([(None, None), (1, ""), (2, "word " * 2000), (2, "word " * 2000)], "doc_id long, text string")
    got = sorted((r[0] or 0, *r[1:]) for r in count_tokens(df, COUNTS).collect())
    assert got == [(0, 0, 0, False), (1, 0, 0, False)] + [(2, 10000, len(library.encode("word " * 2000).ids), True)] * 2


def test_queries_equal_the_libraries(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = QUERIES["op3_byte_bpe"](spark, SF_DIR).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()
    other = Tokenizer.from_file(COUNTS)
    counts = QUERIES["op4_token_count"](spark, SF_DIR).collect()
    assert len(counts) == len(docs)
    for r in counts:
        n = len(other.encode(docs[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 1024) and r["n_bytes"] == len(docs[r["doc_id"]].encode())


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert encode_documents(df, RANKS, P.PATTERN).count() == 0 and count_tokens(df, COUNTS).count() == 0
