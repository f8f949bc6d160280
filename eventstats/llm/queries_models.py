"""Queries over mixes and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventstats.llm import language, mixing, toxicity
from eventstats.llm.common import fold_of, release_memory, table
from eventstats.llm.registry import query


@query("op2_mix")
def op2_mix(spark, sf_dir):
    """How many words of every document the mix takes."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op9_language")
def op9_language(spark, sf_dir):
    """The language of every document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold_of(F.col("doc_id"), 5) == 0
    model = language.fit(docs.filter(~held_out))
    return language.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def fit_toxicity(docs, labels):
    """A network learned from the labelled documents outside the held-out third."""
    learn = fold_of(F.col("doc_id"), 3) != 1
    net = toxicity.train(*toxicity.training_texts(docs.filter(learn), labels.filter(learn)))
    release_memory()  # the texts and arrays of the training
    return net


@query("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    """The toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_documents(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
