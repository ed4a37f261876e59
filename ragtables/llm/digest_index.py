"""Exact deduplication against a persistent index of digests.

The index is a table bucketed and sorted by digest, with a row per distinct text:
digest, id of the row that stays, and the batch that brought it. A batch is reduced
to its distinct digests first, so copies are combined before any shuffle; the new
ones are found by a sort-merge anti-join, whose index side is read bucket by bucket
without a shuffle, and appended as a batch of their own.

An index is a folder. Any session opens it by its path; a batch number is written
once, so that repeating an interrupted append does not add its rows twice.

Defined cases: null text equals empty text; rows with equal text and equal id are one
document in two rows, of which neither row is a copy of the other by id, and both
carry the same result; a null id stays only where no row with an id has the text; an
empty batch appends nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ragtables.llm.base import free_name, put
from ragtables.sources.storage import exists, is_complete, materialize

BUCKETS = 64
BUCKET_ROWS = 4_000_000


def digest(text: Column) -> Column:
    """sha256 of the text with each run of white space as one space."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.sha2(spaced.cast("binary"), 256)


class DigestIndex:
    """An index at a path of the shared storage."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        id_type: str = "bigint",
        buckets: int | None = None,
        expected_rows: int = 0,
    ) -> None:
        """Opens the index, or makes it with ``buckets``, by default one for each
        ``BUCKET_ROWS`` that are expected and ``BUCKETS`` at least. The number is kept
        beside the index; one that is opened has the number it was made with."""
        self.spark, self.path = spark, path.rstrip("/")
        layout = f"{self.path}_layout"
        if not is_complete(spark, layout):
            if exists(spark, self.path):
                raise ValueError(f"{self.path} is there, but not how many buckets it has")
            wanted = buckets or max(BUCKETS, -(-expected_rows // BUCKET_ROWS))
            row = spark.createDataFrame([(wanted,)], "buckets int")
            row.coalesce(1).write.mode("overwrite").parquet(layout)
        self.buckets = buckets = spark.read.parquet(layout).first()["buckets"]
        self.name = f"digests_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest string, keep_id {id_type}, batch string)"
            f" USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS"
            f" LOCATION '{self.path}'"
        )

    def table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The rows of ``batch`` (``digest, keep_id``) whose digest is not indexed."""
        return batch.hint("merge").join(self.table().hint("merge"), "digest", "left_anti")

    def append(self, batch: DataFrame, name: str) -> None:
        """Adds rows with new digests, bucketed and sorted. ``name`` tells the batch;
        a batch that is already in is left alone."""
        marker = f"{self.path}_batches/{name}"
        if exists(self.spark, marker):
            return
        new = materialize(self.unseen(batch).select("digest", "keep_id", F.lit(name).alias("batch")))
        new.repartition(self.buckets, "digest").write.insertInto(self.name)
        new.select(F.lit(name).alias("batch")).limit(1).write.parquet(marker)

    def drop(self) -> None:
        """Forgets the table; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def deduplicate(
    docs: DataFrame, index: DigestIndex, batch: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Dedups ``docs`` among themselves and against the index, and adds what is new.

    Returns a row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.
    ``keep_id`` is the indexed row with that text (of this or an earlier batch),
    ``group_size`` counts the rows of this batch with it.
    """
    rows = materialize(
        docs.select(F.col(f"`{doc_id}`").alias("doc_id"), digest(F.col(f"`{text}`")).alias("digest"))
    )
    groups = materialize(
        rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    index.append(groups.select("digest", "keep_id"), batch)
    # Stored, so that the join below is not bound to the buckets: Spark may then split a
    # digest that very many rows share.
    stays = materialize(
        groups.select("digest", "group_size").join(
            index.table().select("digest", "keep_id", "batch").hint("merge"), "digest"
        )
    )
    return rows.join(stays, "digest").select(
        F.col("doc_id").alias(doc_id),
        "keep_id",
        "group_size",
        ((F.col("batch") == batch) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def distinct_documents(docs: DataFrame, index: DigestIndex, batch: str) -> DataFrame:
    """The rows of ``docs`` (``doc_id, text``, and what else there is) whose text is
    new to the index, one row of each."""
    keep_id, kept_digest, own_digest = (free_name(docs, n) for n in ("keep_id_", "digest_", "own_digest_"))
    kept = deduplicate(docs, index, batch).filter("kept")
    keys = kept.select(
        F.col("doc_id").alias(keep_id), F.col("text_sha256").alias(kept_digest)
    ).distinct()
    marked = put(docs, **{own_digest: digest(F.col("text"))})
    same = F.col("doc_id").eqNullSafe(F.col(keep_id)) & (F.col(own_digest) == F.col(kept_digest))
    found = marked.join(keys, same, "left_semi").dropDuplicates(["doc_id", own_digest])
    return found.drop(own_digest)
