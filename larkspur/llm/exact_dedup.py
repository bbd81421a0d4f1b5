"""Exact deduplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest. A batch of documents is reduced
to one row per digest, the digests that the index already holds are removed by a sort-merge
anti-join, and the rest is appended. Texts never enter a shuffle, only their 32-byte digests.

The index keeps digests, the ids of the registered rows and the batches they came with, but nothing that belongs to one
run, so a batch that is sent again, whole and under any partitioning, gives the same rows and appends nothing.

Defined cases: null texts count as empty (and equal each other); an empty batch appends
nothing; of rows that repeat both text and doc_id one row stays; rows without a doc_id lose
against rows with one; extra columns pass through untouched; a text may have any length, only its digest is kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.llm.shared import new_path, shielded, text_or_empty, written

#: A digest with more than 1/HOT of a batch's rows is joined by broadcast; there are fewer than HOT of them.
HOT = 1000


def digest(text) -> F.Column:
    return F.unhex(F.sha2(text_or_empty(text), 256))


class DigestIndex:
    """A persistent table ``(digest, keep_id, copies, batch)``, bucketed and sorted by digest.

    ``path`` names an index that outlives the session; without it a new one is made in the
    shared folder. ``buckets`` must stay the same for one path.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 64):
        self.spark, self.buckets = spark, buckets
        self.path = path or new_path(spark, "digest-index")
        self.name = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT, copies BIGINT, batch STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )

    def close(self) -> None:
        """Takes the table out of the session's catalog; its files and the results of ``ingest`` stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def compacted(self, path: str | None = None) -> DigestIndex:
        """The same index in a new place with one file for each bucket, however many batches it has taken in."""
        new = DigestIndex(self.spark, path, self.buckets)
        new._append(self.rows())
        return new

    def _append(self, rows: DataFrame) -> None:
        columns = rows.select("digest", "keep_id", "copies", "batch")
        columns.repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.name)

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def ingest(self, docs: DataFrame, batch: str | None = None) -> DataFrame:
        """Registers a batch; returns ``doc_id, digest, row, keep_id, group_size, kept`` per document.

        Of equal texts inside the batch the largest doc_id stays; a text that an earlier batch
        registered is dropped and keep_id names the registered row. ``group_size`` counts the
        batch's rows plus those registered before. A repeated call with the same ``batch``
        (after a failure) gives the same result and appends nothing twice.
        """
        batch = batch or uuid.uuid4().hex
        staged = written(
            docs.select(
                F.col("doc_id").cast("long").alias("doc_id"), digest("text").alias("digest")
            ).withColumn("row", F.monotonically_increasing_id()),
            "digests",
        )
        groups = staged.groupBy("digest").agg(
            F.max("doc_id").alias("keep_id"),
            F.max_by("row", F.struct(F.coalesce("doc_id", F.lit(-(2**63))), -F.col("row"))).alias("keep_row"),
            F.count("*").alias("copies"),
        )
        held = self.rows().select("digest").hint("merge")
        fresh = groups.join(held, "digest", "left_anti").withColumn("batch", F.lit(batch))
        self._append(fresh)
        own = F.col("batch") == batch
        lookup = (
            groups.select("digest", F.col("copies").alias("in_batch"), F.col("keep_row").alias("own_row"))
            .join(self.rows().hint("merge"), "digest")
            .select(
                "digest",
                "keep_id",
                "in_batch",
                F.when(own, F.col("in_batch")).otherwise(F.col("copies") + F.col("in_batch")).alias("group_size"),
                F.when(own, F.col("own_row")).alias("keep_row"),
            )
        )
        # fewer than HOT digests pass this limit, whatever the batch's size
        limit = staged.count() / HOT
        hot = F.broadcast(lookup.where(F.col("in_batch") > limit))
        in_hot = staged.join(hot, "digest")
        in_cold = staged.join(hot.select("digest"), "digest", "left_anti").join(
            lookup.where(F.col("in_batch") <= limit).hint("merge"), "digest"
        )
        return in_hot.unionByName(in_cold).select(
            "doc_id",
            "digest",
            "row",
            "keep_id",
            "group_size",
            F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
        )


@shielded("__digest", "__id", "__n", "__keep_id", "__keep_digest")
def deduplicate(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    own = index or DigestIndex(docs.sparkSession)
    keep = own.ingest(docs).where("kept").select(
        F.col("doc_id").alias("__keep_id"), F.col("digest").alias("__keep_digest")
    )
    if index is None:
        own.close()
    rows = docs.withColumn("__digest", digest(docs["text"])).withColumn("__id", docs["doc_id"].cast("long"))
    hits = rows.join(
        keep, (F.col("__digest") == F.col("__keep_digest")) & F.col("__id").eqNullSafe(F.col("__keep_id")), "left_semi"
    )
    one = Window.partitionBy("__digest", "__id").orderBy(F.lit(1))
    return hits.withColumn("__n", F.row_number().over(one)).where("__n = 1").select(*docs.columns)
