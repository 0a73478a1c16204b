"""The corpus pipeline: five operators one after the other over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps; ``run``
writes each stage's result as Parquet in the shared folder and reads it as the next
one's input, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civic_indicators.llm.common import stage
from civic_indicators.llm.decontaminate import drop_contaminated
from civic_indicators.llm.exact_dedup import drop_exact
from civic_indicators.llm.mixing import mix
from civic_indicators.llm.near_dedup import NearDedup, drop_near
from civic_indicators.llm.quality import keep_quality
from civic_indicators.llm.queries import MIXTURE, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near(docs, NearDedup(k=5, pct=80))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs, MIXTURE)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", decontaminate), ("mixing", mixture)]

#: The quality classifier, the sketches and the tiling have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
