"""Exact dedup (operator 9): a persistent digest index, bucketed and sorted by hash.

The index is a Parquet table in the shared folder with one row per distinct
text: ``digest`` (SHA-256 of the normalised text) and ``keep_id``, the row that
stands for it.  It is bucketed and sorted by ``digest``, so a batch is compared
with it by a sort-merge anti-join that moves the batch's digests only.  Digests
that the index lacks are appended; those it has keep their first owner.

Edge cases: null text counts as empty; letters other than A-Z keep their case;
a null id loses to any other id of its group (a group of null ids keeps one with
a null ``keep_id``); repeated rows form one group; an empty batch appends
nothing; extra columns are ignored here and kept by :func:`kept_rows`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import ascii_lower, fresh, hot_join, stage

BUCKETS = 64


class DigestIndex:
    """The digest index at ``path`` (reopened with the ``buckets`` it was made with), or a new one."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = BUCKETS):
        self.spark, self.path = spark, path or fresh(spark, "digest-index")
        self.buckets = int(buckets)
        self.table = f"wardline_digests_{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE TABLE {self.table} (digest STRING, keep_id BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{self.path}'")

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, groups: DataFrame) -> None:
        """Add the digests that the index does not hold yet."""
        fresh_rows = groups.select("digest", "keep_id").join(
            self.read().select("digest").hint("merge"), "digest", "left_anti")
        # Staged first: an append must not read the table it writes.  A bucket is never
        # split over tasks, whatever their number, so an append adds one file a bucket;
        # by two ranges a bucket, the cut points of the sample give each a task of its own.
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))
        (stage(fresh_rows, "new-digests").repartitionByRange(2 * self.buckets, bucket)
         .write.insertInto(self.table))


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``digest``: SHA-256 (hex) of the text with A-Z in lower case."""
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.sha2(ascii_lower(F.coalesce(F.col(text), F.lit(""))), 256).alias("digest"))


def dedup(docs: DataFrame, index: DigestIndex | None = None, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Within the batch the largest id of equal texts stays, unless an earlier
    batch put the text into ``index``: then that row's id stays and the whole
    group is dropped.  ``group_size`` counts the batch's rows.
    """
    index = index or DigestIndex(docs.sparkSession)
    rows = stage(digests(docs, doc_id, text), "digests")
    groups = stage(rows.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    index.append(groups)
    # Buckets of the index are already placed by digest: only the groups move.
    owners = stage(groups.select("digest", "group_size").join(
        index.read().hint("merge"), "digest"), "owners")
    return hot_join(rows, owners, "digest", "group_size", rows.count()).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def kept_rows(docs: DataFrame, index: DigestIndex | None = None, doc_id: str = "doc_id",
              text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that share both the kept id and the text are one row (any of them).
    """
    kept = stage(dedup(docs, index, doc_id, text).where("kept").select(
        F.col("doc_id").alias("_wardline_id"), F.col("text_sha256").alias("_wardline_keep")), "kept")
    keep = kept.distinct()
    marked = docs.withColumn("_wardline_digest", F.sha2(ascii_lower(F.coalesce(F.col(text), F.lit(""))), 256))
    hit = (F.col("_wardline_digest") == F.col("_wardline_keep")) & F.col(doc_id).cast("long").eqNullSafe(F.col("_wardline_id"))
    out = marked.join(keep, hit, "left_semi")
    if kept.count() != keep.count():
        out = out.dropDuplicates(["_wardline_digest"])
    return out.drop("_wardline_digest")
