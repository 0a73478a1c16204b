"""Civic indicators on Spark.

Lazy DataFrame / Column building blocks for public-service registers: header
normalisation, text and date cleaning, quarantine, population classification
from free text, per-person integration and monthly indicator panels.

Everything is expressed with Spark's built-in SQL functions so Catalyst can
prune, push down and code-generate the whole plan; no Python UDF is used.
"""

from civic_indicators.session import checkpoint_dir, cluster_conf, get_spark, materialize

__all__ = ["get_spark", "checkpoint_dir", "cluster_conf", "materialize"]
