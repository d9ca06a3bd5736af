"""Exact deduplication against a persistent digest index.

The index is a Parquet table, bucketed and sorted by the SHA-256 digest of the
normalised text. A batch of documents is first reduced to one row per digest
(partial sums before the shuffle, so a text that fills a third of the batch is
one row per task), then meets the index in a sort-merge anti-join that reads
the index bucket by bucket without shuffling it, and what is new is appended.

Defined results: null text counts as empty. Of equal texts the smallest
``doc_id`` stays; a null id stays only if the group has no other. Rows that
repeat an id and its text are copies like any other, and one of them stays.
An empty batch gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinomill.llm.common import SPACES
from kinomill.session import cut_lineage

SCHEMA = "digest binary, keep_id bigint, copies bigint, batch string"


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with each run of white space as one space, as binary."""
    normal = F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")
    return F.unhex(F.sha2(normal.cast("binary"), 256))


@dataclass(frozen=True)
class DigestIndex:
    """A digest index at a folder; open the same folder again to go on with it."""

    spark: SparkSession
    path: str
    buckets: int
    name: str

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int = 64) -> DigestIndex:
        """Open or create. ``buckets`` must be the number the index was created with: it is part of the path."""
        location = f"{path.rstrip('/')}/digests-{buckets}"
        name = f"digests_{uuid.uuid4().hex}"
        spark.sql(
            f"create table {name} ({SCHEMA}) using parquet "
            f"clustered by (digest) sorted by (digest) into {buckets} buckets location '{location}'"
        )
        return cls(spark, location, buckets, name)

    def rows(self) -> DataFrame:
        """The index as it is now, in buckets."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def unseen(self, groups: DataFrame, batch: str | None = None) -> DataFrame:
        """Rows of ``groups`` (one per digest) whose digest no other batch brought."""
        known = self.rows()
        if batch is not None:
            known = known.where(~F.col("batch").eqNullSafe(F.lit(batch)))
        return groups.hint("merge").join(known.select("digest"), "digest", "left_anti")

    def append(self, groups: DataFrame, batch: str) -> None:
        """Add the digests of ``groups`` that are new. Adding the same batch twice changes nothing."""
        # Dealt as the buckets are: a task writes one file, not one per bucket.
        fresh = self.unseen(groups).select("digest", "keep_id", "copies", F.lit(batch).alias("batch")).repartition(self.buckets, "digest")
        fresh.write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").option(
            "path", self.path
        ).saveAsTable(self.name)

    def lookup(self) -> DataFrame:
        """The index for joins with uneven sides: read without its buckets, so that Spark can split hot digests."""
        return self.spark.read.schema(SCHEMA).parquet(self.path)


def rows_by_digest(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per digest and id: (digest, doc_id, n)."""
    digests = docs.select(F.col(id_column).alias("doc_id"), text_digest(F.col(text_column)).alias("digest"))
    return digests.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n"))


def groups_of(rows: DataFrame) -> DataFrame:
    """One row per digest: the id that stays and the number of rows."""
    return rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("copies"))


def batch_name(rows: DataFrame) -> str:
    """A name from the batch's rows alone: the same rows, in any order, have the same one."""
    row_hash = F.xxhash64("digest", "doc_id", "n").cast("decimal(38,0)")
    count, total = rows.agg(F.sum("n"), F.sum(row_hash)).first()
    return f"{count or 0}:{total or 0}"


def deduplicate(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """Add a batch to the index; one row per document of the batch.

    A batch that the index has already, by its name or (without one) by its rows, gives the same result again: a job that died
    before it stored its result can be repeated.

    Returns doc_id, keep_id, group_size, kept and digest. A document that
    repeats an earlier batch is not kept and carries that batch's keep_id;
    group_size counts the rows of the batch that brought the text in.
    """
    # What this batch brings is fixed before it is appended, so a repeated task still sees the index as it was.
    rows = cut_lineage(rows_by_digest(docs))
    name = batch or batch_name(rows)
    fresh = cut_lineage(index.unseen(groups_of(rows), name).select("digest", F.lit(True).alias("new")))
    index.append(groups_of(rows), name)
    # One row per digest of the batch, written, so that the join with all rows is of two sides that Spark can split.
    batch = rows.select("digest").distinct()
    groups = cut_lineage(batch.join(index.lookup(), "digest").join(fresh, "digest", "left"))
    joined = rows.join(groups, "digest")
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy")
    stays = F.col("new").isNotNull() & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return joined.select("*", copy).select(
        "doc_id", "keep_id", F.col("copies").alias("group_size"), stays.alias("kept"), "digest"
    )


def keep_first(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` whose text is new to the index, one per text, with all their columns."""
    kept = cut_lineage(deduplicate(docs, index, batch))
    chosen = kept.where("kept").select(F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest"))
    marked = docs.withColumn("__digest", text_digest(F.col("text")))
    found = marked.join(
        chosen, marked["doc_id"].eqNullSafe(chosen["kept_id"]) & (marked["__digest"] == chosen["kept_digest"]), "left_semi"
    )
    # Only rows that repeat both id and text are still there more than once.
    again = kept.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not again.isEmpty():
        found = found.dropDuplicates(["doc_id", "__digest"])
    return found.drop("__digest")
