"""Exact dedup against a persistent digest index (operator 10).

The index is a table of one row per distinct text, ``digest, keep_id, added_by``, bucketed and sorted
by digest. A new batch is reduced to one row per digest, compared with the index by a sort-merge
anti-join that needs no shuffle of the index, and what is new is appended to it. A table can be fed
in several batches of ascending ids: later ones are decided by what earlier ones left in the index.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstats.llm.common import SPACES, join_groups, shared_folder, stored, text_or_empty

#: Ranges of ids in which a query feeds its table to the index.
BATCHES = 3


def text_digest(text: str = "text") -> Column:
    """SHA-256 of the text with every run of ASCII white space made one space; null is empty."""
    return F.sha2(F.regexp_replace(text_or_empty(text), SPACES, " ").cast("binary"), 256)


class DigestIndex:
    """A bucketed and sorted table of digests at a path that all executors share.

    ``buckets`` is fixed when the index is made: take about one bucket per 100 MB that the index
    will reach (a row takes some 50 bytes). Opening the same path again, also in another
    session, finds the rows that are there. One writer at a time: appends are not transactions.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 64) -> None:
        self.spark = spark
        self.path = path or shared_folder(spark, "digest-index")
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest STRING, keep_id BIGINT, added_by STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS "
            f"LOCATION '{self.path}'"
        )
        self.buckets = int(buckets)

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def append(self, rows: DataFrame) -> None:
        """Add rows whose digests the index does not hold; one task and one file per bucket."""
        (
            rows.select("digest", "keep_id", "added_by")
            .repartition(self.buckets, "digest")
            .write.bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .format("parquet")
            .mode("append")
            .saveAsTable(self.name)
        )


def id_batches(rows: DataFrame, batches: int) -> Column:
    """The batch of each row, by about equal ranges of ascending ``doc_id``; null ids come last."""
    share = [i / batches for i in range(1, batches)]
    cuts = rows.agg(F.percentile_approx("doc_id", share)).first()[0] if share else None
    batch = F.lit(0)
    for cut in sorted(set(cuts or [])):
        batch = batch + (F.col("doc_id") > cut).cast("int")
    return F.when(F.col("doc_id").isNull(), F.lit(batches - 1)).otherwise(batch)


def exact_dedup(
    docs: DataFrame, index: DigestIndex, doc_id: str = "doc_id", text: str = "text", batches: int = 1
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the smallest id stays, unless the index had the text before the call: then the
    id there stays and the whole group goes. Digests that are new are appended. With ``batches`` the
    rows go through the index in so many ranges of ascending ids; the result is the same.
    ``group_size`` counts the rows of the call.

    Null and empty texts are one group. A null id stays only if its whole group has none. Rows
    repeated with the same id are counted in ``group_size`` and all are kept or all dropped. Texts of
    any length are digested whole. Other columns of ``docs``, whatever their names, are not read. An
    empty table gives no rows.
    """
    digests = docs.select(F.col(doc_id).alias("doc_id"), text_digest(text).alias("text_sha256"))
    rows = stored(digests, "digests")
    parted = rows.withColumn("batch", id_batches(rows, batches))
    groups = parted.groupBy("batch", F.col("text_sha256").alias("digest")).agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("size")
    )
    groups = stored(groups, "digest-groups", by="batch")
    run = uuid.uuid4().hex
    for batch in range(batches):
        now = groups.filter(F.col("batch") == batch)
        fresh = now.hint("merge").join(index.read().hint("merge"), "digest", "left_anti")
        new = fresh.select("digest", F.col("first_id").alias("keep_id"), F.lit(run).alias("added_by"))
        index.append(stored(new, "new-digests"))
    sizes = groups.groupBy("digest").agg(F.sum("size").alias("group_size"))
    decided = sizes.hint("merge").join(index.read().hint("merge"), "digest").select(
        F.col("digest").alias("text_sha256"), "keep_id", "group_size", (F.col("added_by") != run).alias("seen"))
    joined = join_groups(rows, stored(decided, "kept-digests"), "text_sha256", "group_size")
    kept = ~F.col("seen") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def drop_copies(
    docs: DataFrame, index: DigestIndex, doc_id: str = "doc_id", text: str = "text", batches: int = 1
) -> DataFrame:
    """The documents that stay, with all their columns: one row of each distinct new text.

    Only ids and digests decide; each text is shuffled once, by its id. Rows repeated with the
    same id and text give one row, the first of them by the JSON of all columns.
    """
    kept = stored(
        exact_dedup(docs, index, doc_id, text, batches)
        .filter("kept")
        .groupBy(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_digest"))
        .agg(F.count("*").alias("_rows")),
        "kept-rows",
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    marked = docs.select(
        row.alias("_row"), F.col(doc_id).alias("_id"), text_digest(text).alias("_digest")
    )
    same = F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_digest") == F.col("_kept_digest"))
    out = marked.join(kept.select("_kept_id", "_kept_digest").hint("shuffle_hash"), same, "left_semi")
    if kept.filter("_rows > 1").limit(1).count():
        first = F.min_by("_row", F.to_json("_row"))
        out = out.groupBy("_id", "_digest").agg(first.alias("_row"))
    return out.select("_row.*")
