"""SparkSession construction and cluster-level settings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# A generated method over 8,000 bytes of bytecode is never compiled by the JVM, only interpreted: wide
# projections then run operator by operator, each in methods of its own that are small enough.
COMPILED = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Settings every job relies on: UTC wall clock (dates are civil dates, not
# instants), ANSI casts (strict parsing raises, lenient parsing uses try_*),
# adaptive execution (runtime broadcast conversion, partition coalescing and
# skew-join splitting).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    **COMPILED,
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "civic_indicators",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Return a session with the base settings; reuses an active session."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on an already running session
                pass
    return spark


def compiled(spark: SparkSession) -> SparkSession:
    """The session, set so that wide projections run as compiled code."""
    for k, v in COMPILED.items():
        spark.conf.set(k, v)
    return spark


def cluster_conf(input_bytes: int, executor_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized from the input volume, for a cluster run.

    Shuffle partitions are chosen so that a partition of the widest shuffle
    (at most about the input size) holds ~``target_partition_bytes`` and fits
    an executor task's memory without spilling; adaptive execution then
    coalesces the small ones and splits skewed ones. Scan splits use the same
    target. At 100 TB and 256 MB this gives ~400k shuffle partitions.
    """
    parts = max(executor_cores * 2, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        # Planning-time broadcast uses file-size estimates (compressed bytes):
        # keep it small; the runtime conversion measures the shuffled side.
        "spark.sql.autoBroadcastJoinThreshold": str(10 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files under some paths, in any file system Spark reads."""
    total = 0
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        total += p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    return total


def size_session(spark: SparkSession, *paths: str) -> None:
    """Apply ``cluster_conf`` for the volume of some input paths to a session."""
    for k, v in cluster_conf(input_bytes(spark, *paths), spark.sparkContext.defaultParallelism).items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    ``fallback`` is only used when the session has none *and* runs in local
    mode (tests on one machine); on a cluster a machine-local folder would be
    wrong, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if fallback:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for this cluster")
        if "://" not in fallback:
            os.makedirs(fallback, exist_ok=True)
        sc.setCheckpointDir(fallback)
        return sc.getCheckpointDir()
    return None


def materialize(df, eager: bool = True):
    """Cut a long lineage with a reliable checkpoint in the shared folder the
    cluster names in ``spark.checkpoint.dir`` (never an executor-local one),
    so a lost executor does not force recomputation from the sources. Used
    when several reports read the same cleaned rows."""
    if checkpoint_dir(df.sparkSession) is None:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before materializing")
    return df.checkpoint(eager=eager)
