"""L5 kept up to date: panels as mergeable partial counts, of which only new files are counted.

A store (one published table, see ``sources.publish``) holds, batch by batch, the files that
were counted and their partial counts. ``update`` compares it with the landing folder by path,
modification time and length, counts the files it does not know in one new batch, and publishes the
store again at once; ``totals`` adds the batches up. A job that fails leaves the store as it was,
and the next run counts the same files again, so no file counts twice.

A file that was changed or removed takes its batch with it: the batch's counts are dropped and its
other files are counted again in the new batch. The counts must add up over files, as the
registration panels' do (a row belongs to one file); per-person results do not.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_indicators.functions.cols import col
from civic_indicators.sources.sinks import is_published, publish, published

BATCH, FILE = "_batch", ("_file", "_modified", "_length")
PANEL_KEYS = ("cohort", "year", "month", "indicator")


def landed(spark: SparkSession, folder: str) -> DataFrame:
    """(file, modified, length) of every file below ``folder``; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.col("path").alias(FILE[0]), F.col("modificationTime").alias(FILE[1]), F.col("length").alias(FILE[2]))


def _literal(path: str) -> str:
    """A path to read as it stands, with no character taken as a pattern."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def update(spark: SparkSession, folder: str, store: str, partial: Callable[[list[str]], DataFrame], value: str = "value") -> int:
    """Count the files of ``folder`` that ``store`` does not hold yet; returns how many were read.

    ``partial`` takes a list of paths and returns their counts: key columns and ``value``. Without
    new, changed or removed files nothing is written.
    """
    now = landed(spark, folder)
    live, gone = None, False
    todo = now
    if is_published(spark, store):
        state = published(spark, store)
        known = state.where(F.col(FILE[0]).isNotNull()).select(BATCH, *FILE)
        stale = known.join(now, list(FILE), "left_anti").select(BATCH).distinct()
        gone = not stale.isEmpty()
        live = state.join(stale, BATCH, "left_anti") if gone else state
        todo = now.join(live.where(F.col(FILE[0]).isNotNull()).select(*FILE), list(FILE), "left_anti")
    todo = todo.collect()  # the paths of a scan are listed on the driver in any case
    if not todo and not gone:
        return 0
    parts = [] if live is None else [live]
    if todo:
        batch = F.lit(uuid.uuid4().hex).alias(BATCH)
        parts.append(partial([_literal(r[0]) for r in todo]).select("*", batch))
        parts.append(spark.createDataFrame(todo, now.schema).select("*", batch))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    publish(out.withColumn(value, F.col(value).cast("bigint")), store)
    return len(todo)


def totals(spark: SparkSession, store: str, keys: Sequence[str] = PANEL_KEYS, value: str = "value") -> DataFrame:
    """The batches of a store added up: ``keys`` and ``value``."""
    counts = published(spark, store).where(F.col(FILE[0]).isNull())
    return counts.groupBy(*[col(k).alias(k) for k in keys]).agg(F.sum(value).alias(value))
