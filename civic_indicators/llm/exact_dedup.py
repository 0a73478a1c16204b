"""Operator 5: exact dedup against a persistent digest index.

The index is a table bucketed and sorted by digest, one row per distinct text.
New data is reduced to one row per digest (pre-aggregated, so a text that a
third of all rows share stays one row per task), compared with the index by a
sort-merge anti-join that needs no shuffle of the index, and appended.

Texts are equal when identical after lower-casing A-Z only (null counts as
empty). Of the rows of one call, the one with the largest ``doc_id`` stays; a
null id loses against any id; rows equal in id and text count as one. A text
that an earlier batch brought stays dropped, its ``keep_id`` is the earlier one.
An empty table gives an empty result; extra columns are carried along.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_indicators.llm.common import fresh, lower_ascii, q, shared_dir


def text_digest(text: Column) -> Column:
    """SHA-256 (lowercase hex) of the normalised text."""
    return F.sha2(lower_ascii(F.coalesce(text, F.lit(""))).cast("binary"), 256)


class DigestIndex:
    """Digests of all texts seen so far, at ``path`` (default: in the shared folder).

    ``buckets`` is the production parameter that sets the parallelism of the
    anti-join; it stays the same for the life of an index.
    """

    COLUMNS = "digest STRING, keep_id BIGINT, group_size BIGINT"

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 64):
        self.spark, self.buckets = spark, buckets
        self.path = path or f"{shared_dir(spark)}/digest-index-{uuid.uuid4().hex}"
        self.table = f"digest_index_{uuid.uuid4().hex}"
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
        # The files outlive the session; this session's catalog learns of them here.
        spark.sql(f"CREATE TABLE {self.table} ({self.COLUMNS}, batch STRING) USING parquet PARTITIONED BY (batch) "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'")
        spark.sql(f"MSCK REPAIR TABLE {self.table}")

    def entries(self) -> DataFrame:
        """All entries (digest, keep_id, group_size, batch)."""
        return self.spark.table(self.table)

    def add(self, docs: DataFrame, batch: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
        """Append the new texts of ``docs`` under the name ``batch``; returns this batch's entries.

        Running a batch again replaces what it left before.
        """
        if not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"batch name {batch!r}: letters, digits, - and _ only")
        self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION (batch = '{batch}')")
        left = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch={batch}")  # the table's files are its own
        left.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(left, True)
        new = (docs.select(text_digest(q(text)).alias("digest"), q(doc_id).cast("bigint").alias("id"))
               .groupBy("digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
        new = new.repartition(self.buckets, "digest").hint("merge").join(self.entries().select("digest"), "digest", "left_anti")
        (new.withColumn("batch", F.lit(batch)).write.mode("append").format("parquet")
         .partitionBy("batch").bucketBy(self.buckets, "digest").sortBy("digest")
         .option("path", self.path).saveAsTable(self.table))
        return self.entries().where(F.col("batch") == batch)


def exact_groups(docs: DataFrame, index: DigestIndex | None = None, batch: str = "b0",
                 text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``group_size`` counts the rows of the batch that brought the text first.
    """
    index = index or DigestIndex(docs.sparkSession)
    index.add(docs, batch, text, doc_id)
    own = docs.select(q(doc_id).cast("bigint").alias("doc_id"), text_digest(q(text)).alias("text_sha256"))
    # Read as plain files, so that both sides are shuffled for the join and adaptive execution can
    # split the document side at a hot digest.
    found = index.spark.read.schema(f"{index.COLUMNS}, batch STRING").parquet(index.path)
    found = found.select(F.col("digest").alias("text_sha256"), "keep_id", "group_size", "batch")
    out = own.join(found, "text_sha256", "left")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("batch") == batch)
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def drop_exact(docs: DataFrame, index: DigestIndex | None = None, batch: str = "b0",
               text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose text is new, one per text, all columns kept."""
    index = index or DigestIndex(docs.sparkSession, buckets=int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    new = index.add(docs, batch, text, doc_id).select("digest")
    dig, row = fresh(docs, "_digest", "_row")
    hashable = [q(c) for c, t in docs.dtypes if "map<" not in t and t != "variant"]
    # One row per text, chosen before the shuffle as far as a task sees it; equal ids
    # are decided by the other columns, so a retried task chooses alike.
    order = F.struct(q(doc_id).cast("bigint"), q(text), F.xxhash64(*hashable))
    one = (docs.groupBy(text_digest(q(text)).alias(dig)).agg(F.max_by(F.struct(*[q(c) for c in docs.columns]), order).alias(row))
           .join(new.withColumnRenamed("digest", dig), dig, "left_semi"))
    return one.select(*[F.col(row).getField(c).alias(c) for c in docs.columns])
