"""Curated and quarantine sinks.

Both go through Spark's file commit protocol: task output is written to a
staging folder and only moved into place when the job commits, so a lost
executor re-runs its tasks without leaving partial files. With
``partitionOverwriteMode=dynamic`` a rerun replaces only the partitions it
writes (one year, one run date), which makes reruns idempotent.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_indicators.functions.dates import stamp_date

STATUS = "_status"
CURRENT = "CURRENT"
# Rows per output file: bounds file size without an extra shuffle (a task
# that holds many rows of one partition value rolls over to a new file).
MAX_RECORDS_PER_FILE = 5_000_000


def write_curated(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  mode: str = "overwrite", max_records_per_file: int = MAX_RECORDS_PER_FILE) -> None:
    """Curated Parquet, optionally partitioned (e.g. by year); replaces the partitions that ``df`` has.

    ``publish`` replaces the whole table."""
    w = (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
           .option("maxRecordsPerFile", max_records_per_file))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (), keep: int = 2,
            max_records_per_file: int = MAX_RECORDS_PER_FILE) -> str:
    """The whole curated table as a new version, published at once.

    The version is written to a folder of its own below ``path``; then the pointer file
    ``CURRENT`` is replaced by one rename, so readers (``published``) see the old table or the
    new one, never half of it, and no partition of an earlier version stays. A job that
    fails before the rename leaves the old table. The last ``keep`` versions stay for readers
    that have begun on them. Returns the version's folder.
    """
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    name = f"version-{stamp}-{uuid.uuid4().hex[:8]}"
    w = df.write.option("maxRecordsPerFile", max_records_per_file)
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{path.rstrip('/')}/{name}")
    fresh = jvm.org.apache.hadoop.fs.Path(root, f"{CURRENT}.{name}")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(name.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(fs.makeQualified(fresh), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(root, CURRENT)), options)
    versions = sorted(x.getPath().getName() for x in fs.listStatus(root) if x.isDirectory() and x.getPath().getName().startswith("version-"))
    for old in versions[:-keep] if keep else []:
        if old != name:
            fs.delete(jvm.org.apache.hadoop.fs.Path(root, old), True)
    return f"{path.rstrip('/')}/{name}"


def is_published(spark: SparkSession, path: str) -> bool:
    """Whether ``publish`` has published a table at ``path``."""
    pointer = spark._jvm.org.apache.hadoop.fs.Path(path, CURRENT)
    return pointer.getFileSystem(spark._jsc.hadoopConfiguration()).exists(pointer)


def published(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``publish`` has published last."""
    jvm = spark._jvm
    pointer = jvm.org.apache.hadoop.fs.Path(path, CURRENT)
    stream = pointer.getFileSystem(spark._jsc.hadoopConfiguration()).open(pointer)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        name = reader.readLine()
    finally:
        reader.close()
    return spark.read.parquet(f"{path.rstrip('/')}/{name}")


def write_quarantine(df: DataFrame, path: str, run_date: str | _dt.date | None = None) -> None:
    """Rejected rows under ``run_date=<date>``; a rerun replaces that day only."""
    (df.withColumn("run_date", stamp_date(run_date))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
       .partitionBy("run_date").parquet(path))


def write_split(df: DataFrame, rejected: Column, path: str,
                run_date: str | _dt.date | None = None) -> None:
    """Valid and rejected rows in one scan and one write, partitioned by status.

    Cheaper than two filtered writes: the source is read once and no cache is
    needed. ``rejected`` is evaluated null-safe (null -> valid).
    """
    status = F.when(F.coalesce(rejected, F.lit(False)), F.lit("rejected")).otherwise(F.lit("valid"))
    (df.withColumn(STATUS, status).withColumn("run_date", stamp_date(run_date))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
       .partitionBy("run_date", STATUS).parquet(path))
