"""Queries over tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from eventstats.llm.byte_bpe import encode_documents
from eventstats.llm.common import table
from eventstats.llm.registry import query
from eventstats.llm.token_count import count_tokens


def digests(docs):
    """Encode and decode whole texts; digests of the ids and of the decoded bytes."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode_documents(docs, vocabulary, public_tokenizers.PATTERN, decoded=True)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op3_byte_bpe")
def op3_byte_bpe(spark, sf_dir):
    """All documents to ids and back."""
    return digests(table(spark, sf_dir, "documents"))


@query("op4_token_count")
def op4_token_count(spark, sf_dir):
    """Tokens of every document."""
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
