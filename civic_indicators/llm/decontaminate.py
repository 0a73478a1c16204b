"""Operator 7: benchmark decontamination by greedy string tiling.

Tokens are A-Z-lowered words without punctuation at their ends. A tile is a run of at
least ``min_tile`` tokens that a document and an item share; the item is covered by
marking the longest common run of unmarked tokens on both sides, again and again, so
passages are found whatever their order. An item of fewer tokens is one tile whole.

* Seeds: windows of ``min_tile`` tokens. A fixed-size filter of the benchmark's
  windows, broadcast, lets each task keep only the parts of a document that some
  window of the benchmark may cover; every tile lies wholly in such parts. They
  meet the items through a join on the window's hash.
* A pair goes on if its shared windows can reach the coverage at all.
* Tiling: the length of the longest common run is found by bisection over Karp-Rabin
  hashes of all windows of a length, matches of that length are compared token by
  token and marked, and the search repeats below it, down to ``min_tile``.
* A document is contaminated by an item when tiles cover ``coverage`` of its tokens.

Null and empty texts and items match nothing; rows of one id are one document; an
empty table on either side gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civic_indicators.llm.common import BitFilter, WordHashes, hash_words, q, shingle_hashes, stage, without, words

EDGES = b".,;:!?\"'()[]{}<>*%&$#|-_"


class TokenHashes(WordHashes):
    """Hash of a word without the punctuation at its ends; 0 for a word of nothing else."""

    def __missing__(self, word: bytes) -> int:
        bare = word.strip(EDGES)
        if not bare:
            self[word] = 0
            return 0
        h = super().__missing__(bare)
        self[word] = h
        return h


def tokens(text: str | None, known: TokenHashes) -> np.ndarray:
    h = hash_words(words(text), known)
    return h[h != 0]


@dataclass(frozen=True)
class TilingParams:
    min_tile: int = 5
    coverage: float = 0.5
    filter_log2_bits: int = 24


def _rolling(x: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = np.zeros(len(at), np.uint64)
        for j in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + x[at + j]
        return h


def tile(item: np.ndarray, doc: np.ndarray, least: int) -> list[int]:
    """Lengths of the tiles that cover ``item`` by runs of ``doc``, longest first; 0 in ``doc`` breaks runs."""
    fi, fd = item != 0, doc != 0
    tiles: list[int] = []

    def common(n: int):
        run_i, run_d = np.cumsum(np.r_[0, fi]), np.cumsum(np.r_[0, fd])
        ai = np.flatnonzero(run_i[n:] - run_i[:-n] == n) if len(item) >= n else np.zeros(0, np.int64)
        ad = np.flatnonzero(run_d[n:] - run_d[:-n] == n) if len(doc) >= n else np.zeros(0, np.int64)
        hi, hd = _rolling(item, ai, n), _rolling(doc, ad, n)
        return ai, ad, hi, hd, np.isin(hi, hd)

    top = min(len(item), len(doc))
    while top >= least:
        lo, hi_ = least - 1, top
        while lo < hi_:  # the longest common run: a common run of n holds one of n - 1
            mid = (lo + hi_ + 1) // 2
            lo, hi_ = (mid, hi_) if common(mid)[4].any() else (lo, mid - 1)
        if lo < least:
            break
        ai, ad, hi, hd, hit = common(lo)
        before = len(tiles)
        for a, h in zip(ai[hit], hi[hit]):
            if not fi[a:a + lo].all():
                continue
            for d in ad[hd == h]:
                if fd[d:d + lo].all() and (item[a:a + lo] == doc[d:d + lo]).all():
                    fi[a:a + lo] = fd[d:d + lo] = False
                    tiles.append(lo)
                    break
        top = lo if len(tiles) > before else lo - 1
    return tiles


def contaminated(docs: DataFrame, benchmark: DataFrame, p: TilingParams = TilingParams(), text: str = "text",
                 doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per contaminated pair: doc_id, item_id, item_tokens, matched_tokens, coverage, tiles, longest."""
    k = p.min_tile

    def item_rows(batches):
        known = TokenHashes()
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = tokens(t, known)
                if i is not None and len(x):
                    w = shingle_hashes(x, k)
                    yield pa.record_batch({"item_id": pa.array([i] * len(w), pa.int64()), "n": pa.array([len(x)] * len(w), pa.int32()),
                                           "w": pa.array(w.view(np.int64)), "x": pa.array([x.tobytes() if j == 0 else None for j in range(len(w))], pa.binary())})

    items = stage(benchmark.select(q(item_id).cast("bigint"), q(item_text)).mapInArrow(item_rows, "item_id bigint, n int, w bigint, x binary"), "items")
    short = sorted(r.n for r in items.where(f"n < {k}").select("n").distinct().collect())  # at most k - 1 values
    spark = docs.sparkSession
    built = BitFilter.build(items, "w", p.filter_log2_bits)
    shared = spark.sparkContext.broadcast((built.bits, built.probes))

    def seeds(batches):
        known, known_windows = TokenHashes(), BitFilter(*shared.value)
        for b in batches:
            ids, xs, ws = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = tokens(t, known)
                if i is None or not len(x):
                    continue
                cover, hits = np.zeros(len(x) + 1, np.int64), []
                for n in {*short, k}:
                    if len(x) >= n:
                        w = shingle_hashes(x, n)
                        at = np.flatnonzero(known_windows.has(w))
                        hits.append(w[at])
                        np.add.at(cover, at, 1)
                        np.add.at(cover, at + n, -1)
                got = np.unique(np.concatenate(hits)) if hits else np.zeros(0, np.uint64)
                if len(got):
                    inside = np.cumsum(cover[:-1]) > 0
                    part = np.where(inside, x, np.uint64(0))
                    part = part[inside | np.r_[False, inside[:-1]]]  # parts with a 0 between them
                    ids.append(i)
                    xs.append(part.tobytes())
                    ws.append(got.view(np.int64))
            if ids:
                yield pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "d": pa.array(xs, pa.binary()), "ws": pa.array(ws, pa.list_(pa.int64()))})

    found = stage(docs.select(q(doc_id).cast("bigint"), q(text)).mapInArrow(seeds, "doc_id bigint, d binary, ws array<bigint>")
                  .withColumn("part", F.xxhash64("d")), "seeds")
    shared_windows = found.select("doc_id", "part", F.explode("ws").alias("w")).join(items.select("item_id", "n", "w"), "w")
    pairs = (shared_windows.groupBy("doc_id", "part", "item_id", "n").agg(F.count(F.lit(1)).alias("hits"))
             .where(F.expr(f"hits * least(n, {k}) >= {p.coverage} * n")))

    def run(batches):
        for b in batches:
            cols = {c: [] for c in ("doc_id", "item_id", "item_tokens", "matched_tokens", "coverage", "tiles", "longest")}
            for i, j, d, x in zip(*(b.column(c).to_pylist() for c in ("doc_id", "item_id", "d", "x"))):
                item = np.frombuffer(x, np.uint64)
                got = tile(item, np.frombuffer(d, np.uint64), min(k, len(item)))
                if got and sum(got) >= p.coverage * len(item):
                    for c, v in zip(cols, (i, j, len(item), sum(got), sum(got) / len(item), len(got), max(got))):
                        cols[c].append(v)
            yield pa.record_batch({c: pa.array(v, pa.float64() if c == "coverage" else pa.int64()) for c, v in cols.items()})

    both = (pairs.join(found.select("doc_id", "part", "d"), ["doc_id", "part"])
            .join(items.where("x is not null").select("item_id", "x"), "item_id"))
    # Few bytes a pair but much work: spread by number, which adaptive execution does not merge again.
    both = both.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id", "item_id")
    out = both.select("doc_id", "item_id", "d", "x").mapInArrow(
        run, "doc_id bigint, item_id bigint, item_tokens bigint, matched_tokens bigint, coverage double, tiles bigint, longest bigint")
    return out.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("item_tokens", "matched_tokens", "coverage", "tiles", "longest")])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, p: TilingParams = TilingParams(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the contaminated documents, all columns kept."""
    return without(docs, stage(contaminated(docs, benchmark, p, text, doc_id).select("doc_id").distinct(), "leaks"), doc_id)
