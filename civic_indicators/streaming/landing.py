"""Incremental registration over a landing folder (Structured Streaming).

New register files dropped into a landing folder are picked up by the file
source; every step of the registration flow is narrow, so the very same
lazy plan runs per micro-batch. Each batch's valid and rejected rows are
written under ``_batch=<id>`` with dynamic partition overwrite: a batch
replayed after a failure replaces its own output instead of duplicating it,
and the stream's checkpoint (in the shared checkpoint folder) records which
files were consumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from civic_indicators.plans import registration as R
from civic_indicators.sources.sinks import STATUS

BATCH = "_batch"


def _write_batch(batch: DataFrame, batch_id: int, out: str, rules: R.RegistrationRules,
                 year: int | None) -> None:
    df, reject = R.prepare(batch, rules)
    flagged = F.coalesce(reject, F.lit(False))
    valid = df.filter(~flagged)
    if year is not None:
        valid = valid.filter(F.col(R.YEAR) == F.lit(year))
    curated = R.classify(valid, rules).withColumn(BATCH, F.lit(batch_id))
    (curated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH).parquet(f"{out}/curated"))
    rejected = df.filter(flagged).withColumn(BATCH, F.lit(batch_id)).withColumn(STATUS, F.lit("rejected"))
    (rejected.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH).parquet(f"{out}/quarantine"))


def registration_stream(spark: SparkSession, landing: str, schema: StructType | str, out: str,
                        checkpoint: str, fmt: str = "parquet", year: int | None = None,
                        rules: R.RegistrationRules = R.RegistrationRules(),
                        available_now: bool = True, max_files_per_trigger: int | None = None,
                        **options) -> StreamingQuery:
    """Start the incremental registration flow; returns the running query.

    ``available_now=True`` processes what has landed and stops (a scheduled
    run); otherwise it keeps watching the folder.
    """
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(landing)
    writer = (raw.writeStream
                 .foreachBatch(lambda b, i: _write_batch(b, i, out, rules, year))
                 .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def curated_rows(spark: SparkSession, out: str) -> DataFrame:
    """All curated rows written so far (for panels and audits)."""
    return spark.read.parquet(f"{out}/curated")
