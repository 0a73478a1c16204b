"""Shared helpers: staged tables, folds, fixed-size filters, word hashes, components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
LOW32 = np.uint64(0xFFFFFFFF)
_S32, _S33, _S29 = np.uint64(32), np.uint64(33), np.uint64(29)
_M1, _M2, _M3 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- Spark side

def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only in local mode (tests) a temporary folder stands in for an unset one.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="civic-llm-")
        sc.setCheckpointDir(named)
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def stage(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut,
    and a lost executor re-reads files instead of recomputing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names not used by ``df`` (case-insensitively), made from ``names``."""
    used = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in used:
            n = "_" + n
        used.add(n.lower())
        out.append(n)
    return out


def q(name: str) -> Column:
    """A top-level column by its exact name (dots and backticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null for a null id)."""
    return F.crc32(doc_id.cast("string")) % F.lit(n)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, everything else untouched."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bounded_ids(labels: DataFrame, limit: int, *cols: str) -> DataFrame:
    """At most ``limit`` rows in the order of a hash of the id: a stable, bounded sample."""
    return labels.select("doc_id", *cols).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


# ------------------------------------------------------------- fixed filter

class BitFilter:
    """Approximate membership in a fixed number of bits (a Bloom filter).

    Its size is a parameter, so it may be broadcast whatever the input's size; a
    full filter lets more keys through and never loses one.
    """

    CHUNK = 4096  # bytes; what bitmap_or_agg takes

    def __init__(self, bits: np.ndarray, probes: int):
        self.bits, self.probes = bits, probes

    @staticmethod
    def _slots(keys: np.ndarray, n_bits: int, probes: int) -> np.ndarray:
        a = mix(keys.astype(np.uint64))
        b = mix(a ^ _M3) | np.uint64(1)
        k = np.arange(probes, dtype=np.uint64)[:, None]
        return (a[None, :] + k * b[None, :]) & np.uint64(n_bits - 1)

    @classmethod
    def build(cls, keys: DataFrame, column: str, log2_bits: int = 24, probes: int = 4) -> BitFilter:
        """From a bigint column, in parallel: each task fills its own bits, chunks are OR-ed by Spark."""
        n_bits, chunk = 1 << log2_bits, cls.CHUNK

        def fill(batches):
            own = np.zeros(n_bits >> 3, np.uint8)
            for b in batches:
                k = b.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                s = np.unique(cls._slots(k, n_bits, probes))
                np.bitwise_or.at(own, (s >> np.uint64(3)).astype(np.int64), np.uint8(1) << (s & np.uint64(7)).astype(np.uint8))
            used = [i for i in range(0, len(own), chunk) if own[i:i + chunk].any()]
            if used:
                yield pa.record_batch({"chunk": pa.array(used, pa.int64()), "bits": pa.array([own[i:i + chunk].tobytes() for i in used], pa.binary())})

        parts = keys.select(q(column).cast("bigint")).mapInArrow(fill, "chunk bigint, bits binary")
        merged = parts.groupBy("chunk").agg(F.bitmap_or_agg("bits").alias("bits"))
        bits = np.zeros(n_bits >> 3, np.uint8)
        for r in merged.collect():  # n_bits / 8 bytes in all
            bits[r.chunk:r.chunk + chunk] |= np.frombuffer(bytes(r.bits), np.uint8)[:len(bits) - r.chunk]
        return cls(bits, probes)

    def has(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, bool)
        s = self._slots(keys, len(self.bits) << 3, self.probes)
        hit = (self.bits[(s >> np.uint64(3)).astype(np.int64)] >> (s & np.uint64(7)).astype(np.uint8)) & np.uint8(1)
        return hit.all(axis=0)


def maybe_in(df: DataFrame, column: str, keys: DataFrame, key: str, log2_bits: int = 24) -> Column:
    """A boolean column: the bigint ``column`` may be among ``keys`` (never false for one that is)."""
    spark = df.sparkSession
    built = BitFilter.build(keys, key, log2_bits)
    shared = spark.sparkContext.broadcast((built.bits, built.probes))

    @F.pandas_udf("boolean")
    def has(x: pd.Series) -> pd.Series:
        got = BitFilter(*shared.value).has(x.fillna(0).to_numpy(dtype=np.int64).view(np.uint64))
        return pd.Series(got & x.notna().to_numpy())

    return has(q(column).cast("bigint"))


# ------------------------------------------------------------------ hashing

def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (a bijection), element by element."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _S33)) * _M1
        x = (x ^ (x >> _S33)) * _M2
        return x ^ (x >> _S33)


class WordHashes(dict):
    """64-bit hash of a word (bytes), remembered; the memory is emptied when full."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the A-Z-lowered text, in UTF-8."""
    return (text or "").encode("utf-8", "replace").lower().split()


def hash_words(ws: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word windows, in order; the whole sequence if shorter."""
    n = len(h)
    if n == 0:
        return h
    k = min(k, n)
    with np.errstate(over="ignore"):
        acc = h[:n - k + 1] + np.uint64(k)
        for j in range(1, k):
            acc = (acc ^ (acc >> _S29)) * _M3 + h[j:n - k + 1 + j]
    return mix(acc)


# --------------------------------------------------------------- components

def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id): the smallest id reachable, for every id of an edge with another id.

    Alternating large and small stars; each round's edges are staged with a mark on those that
    the round has moved, and the rounds end when none is: every id then hangs on its least one.
    A hub's minimum is pre-aggregated and its edges meet it in a splittable join.
    """
    x, y = q(a).cast("bigint"), q(b).cast("bigint")
    e = stage(edges.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).where("a <> b"), "edges")
    while True:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b"), F.col("a")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").groupBy(F.col("v").alias("a"), F.col("m").alias("b"))
                 .agg(F.max(F.expr("m < u")).alias("moved")))
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.max("moved").alias("moved"))
        # An edge with b <> m moves whatever large says; reading its mark keeps both uses of large one shuffle.
        small = large.join(low.select("a", "m"), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"), F.expr("moved or b > m").alias("moved"))
        e = stage(small.union(low.select("a", F.col("m").alias("b"), "moved")).groupBy("a", "b").agg(F.max("moved").alias("moved")), "edges")
        if e.where("moved").isEmpty():
            break
    return e.select(F.col("a").alias("id"), F.col("b").alias("component_id")).union(
        e.select(F.col("b"), F.col("b")).distinct())


def without(docs: DataFrame, ids: DataFrame, column: str, log2_bits: int = 24) -> DataFrame:
    """``docs`` less the rows whose ``column`` is in ``ids`` (one bigint column).

    Rows that a fixed-size filter rules out pass where they are; only the others,
    about as many as ``ids``, are shuffled for the exact anti-join. Null keys stay.
    """
    key, flag = fresh(docs, "_key", "_flag")
    gone = ids.select(F.col(ids.columns[0]).cast("bigint").alias(key)).where(f"{key} is not null").distinct()
    marked = docs.withColumn(flag, F.coalesce(maybe_in(docs, column, gone, key, log2_bits), F.lit(False)))
    clear = marked.where(~F.col(flag)).drop(flag)
    left = marked.where(F.col(flag)).drop(flag).join(gone, q(column).cast("bigint") == F.col(key), "left_anti")
    return clear.unionByName(left)
