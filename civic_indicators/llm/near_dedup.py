"""Operator 1: near-duplicate groups by fast similarity sketching, banding and exact verification.

Sketch. A text's set of k-word shingles (64-bit hashes) is thrown into ``coords``
bins in rounds: in round i every shingle is hashed anew to a bin and a value, and a
bin keeps the smallest (round, value) it ever gets; after ``coords`` rounds each
still empty bin j gets, in a round of its own, the smallest value of all shingles.
So every coordinate fills, after few rounds for texts of ordinary length, and the
share of equal coordinates estimates the Jaccard similarity with the concentration
of independent samples.

Banding. ``rows`` coordinates make a band, and texts that share a band's bucket are
candidates. With the default 48 bands of 7 a pair at similarity 0.8 is missed with
probability 1.2e-5, less above.

Verification is exact, on the full shingle sets: 100 * |A and B| >= pct * |A or B|.

No bucket is expanded into all its pairs. Texts with equal sets are one class from the
start. Then come rounds: every bucket names a leader, picked by a hash of the round among
the classes of its smallest component, and each class of another component is checked
against a few of the leaders of its buckets, whom it has not met yet; between rounds a
component goes to the least one it has a verified link with. After the rounds all links
make components, once. So a group of near copies becomes one component after few rounds,
each with a number of pairs proportional to the classes. What is left in a bucket are
classes of different components that are not linked to the leaders they met; only their
pairs, one from either component, are all checked in the end, so no link is lost. In
buckets of up to ``pairwise`` such classes the pairs are rows of a join; larger buckets
are cut into blocks of about ``block`` shingles, and blocks are compared with blocks inside
a task, each pair in the first bucket it shares, so only links become rows.

Results: a null or blank text has an empty set and no link; a null id is linked
with nothing and kept; rows of one id are one document; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civic_indicators.llm.common import (LOW32, MASK, WordHashes, components, fresh, hash_words, maybe_in, mix, q,
                                         shingle_hashes, stage, without, words)


@dataclass(frozen=True)
class NearDedup:
    """Parameters: shingle width, similarity in percent, bands and rows of the sketch."""

    k: int = 5
    pct: int = 80
    bands: int = 48
    rows: int = 7
    star_rounds: int = 3
    yield_: int = 10  # a round that links fewer than one candidate in so many is the last
    leaders: int = 4
    pairwise: int = 64
    block: int = 200_000

    @property
    def coords(self) -> int:
        return self.bands * self.rows


def _seeds(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def sketches(flat: np.ndarray, owner: np.ndarray, n_sets: int, t: int) -> np.ndarray:
    """Fast similarity sketches, one row of ``t`` values per set.

    ``flat``: the sets' hashes one after the other; ``owner``: each hash's set; no set is empty.
    """
    seeds = _seeds(2 * t)
    out = np.full(n_sets * t, MASK)
    a, d, own = flat, owner * t, owner
    t64, s32 = np.uint64(t), np.uint64(32)
    for i in range(t):
        h = mix(a ^ seeds[i])
        np.minimum.at(out, d + (((h >> s32) * t64) >> s32).astype(np.int64), (np.uint64(i) << s32) | (h & LOW32))
        open_ = (out.reshape(n_sets, t) == MASK).any(axis=1)
        if not open_.any():
            break
        keep = open_[own]
        a, d, own = a[keep], d[keep], own[keep]
    out = out.reshape(n_sets, t)
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    ends = np.r_[starts[1:], len(owner)]
    for s in np.flatnonzero((out == MASK).any(axis=1)):
        bins = np.flatnonzero(out[s] == MASK)
        h = mix(flat[None, starts[s]:ends[s]] ^ seeds[t + bins][:, None]) & LOW32
        out[s, bins] = ((bins + t).astype(np.uint64) << s32) | h.min(axis=1)
    return out


def band_keys(sk: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit bucket key per band."""
    x = sk.reshape(len(sk), bands, rows)
    with np.errstate(over="ignore"):
        acc = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), x.shape[:2]).copy()
        for j in range(rows):
            acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + x[:, :, j])
    return acc


def _set(text: str | None, k: int, known: WordHashes) -> np.ndarray:
    return np.unique(shingle_hashes(hash_words(words(text), known), k))


def signatures(docs: DataFrame, p: NearDedup, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n, d1, d2, bands): set size, 128-bit digest of the set, bucket keys."""
    schema = "doc_id bigint, n bigint, d1 bigint, d2 bigint, bands array<bigint>"

    def run(batches):
        known = WordHashes()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            i = 0
            while i < len(ids):
                sets, first, size = [], i, 0
                while i < len(ids) and size < 300_000 and len(sets) < 400:
                    s = _set(texts[i].as_py(), p.k, known)
                    sets.append(s)
                    size += len(s)
                    i += 1
                n = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(n)
                d = np.zeros((2, len(sets)), np.uint64)
                keys = [None] * len(sets)
                if len(full):
                    flat = np.concatenate([sets[j] for j in full])
                    owner = np.repeat(np.arange(len(full)), n[full])
                    starts = np.r_[0, np.cumsum(n[full])[:-1]]
                    with np.errstate(over="ignore"):
                        for r in (0, 1):
                            d[r, full] = np.add.reduceat(mix(flat ^ np.uint64(0xA5A5A5A5 + r)), starts)
                    bk = band_keys(sketches(flat, owner, len(full), p.coords), p.bands, p.rows).view(np.int64)
                    for j, row in zip(full, bk):
                        keys[j] = row
                yield pa.record_batch({"doc_id": ids.slice(first, i - first), "n": pa.array(n),
                                       "d1": pa.array(d[0].view(np.int64)), "d2": pa.array(d[1].view(np.int64)),
                                       "bands": pa.array(keys, pa.list_(pa.int64()))})

    return docs.select(q(doc_id).cast("bigint"), q(text)).mapInArrow(run, schema)


def shingle_sets(docs: DataFrame, k: int, text: str, doc_id: str) -> DataFrame:
    """(id, s): the sorted shingle hashes of each text, packed."""
    def run(batches):
        known = WordHashes()
        for batch in batches:
            for i in range(0, len(batch), 256):
                part = batch.slice(i, 256)
                yield pa.record_batch({"id": part.column(0), "s": pa.array(
                    [_set(x, k, known).tobytes() for x in part.column(1).to_pylist()], pa.binary())})

    return docs.select(q(doc_id).cast("bigint"), q(text)).mapInArrow(run, "id bigint, s binary")


def verified(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """The pairs (a, b, any more columns) whose full sets reach the similarity."""
    cols = pairs.columns

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("s").to_pylist(), batch.column("s2").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if 100 * min(len(x), len(y)) < pct * max(len(x), len(y)):
                    keep.append(False)
                    continue
                both = np.sort(np.concatenate([x, y]), kind="stable")  # two sorted runs: merged
                inter = int((both[1:] == both[:-1]).sum())
                keep.append(100 * inter >= pct * (len(x) + len(y) - inter))
            yield batch.select(cols).filter(pa.array(keep, pa.bool_()))

    one = pairs.join(sets.select(F.col("id").alias("a"), "s"), "a")
    two = one.join(sets.select(F.col("id").alias("b"), F.col("s").alias("s2")), "b")
    return two.select(*cols, "s", "s2").mapInArrow(run, pairs.schema)


def _block_links(rows: list[tuple], lo: int, hi: int, bucket: int, pct: int) -> list[tuple[int, int]]:
    """Links between the classes of two blocks (or of one) of a bucket; rows: (block, rep, component, set, bands)."""
    one, two = [r for r in rows if r[0] == lo], [r for r in rows if r[0] == hi]
    if not one or not two:
        return []
    rep, comp = (np.array([r[k] for r in two], np.int64) for k in (1, 2))
    size = np.array([len(r[3]) for r in two])
    flat, owner = np.concatenate([r[3] for r in two]), np.repeat(np.arange(len(two)), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    bands = np.stack([r[4] for r in two])
    out = []
    for _, a, c, s, b in one:
        same = bands == b[None]
        first = same.argmax(axis=1)
        todo = (comp != c) & (b[first] == bucket) & same.any(axis=1) & (100 * np.minimum(size, len(s)) >= pct * np.maximum(size, len(s)))
        if lo == hi:
            todo &= rep < a
        if not todo.any():
            continue
        left, n = np.searchsorted(flat, s), np.searchsorted(flat, s, "right")
        n = n - left
        at = np.repeat(left - (np.cumsum(n) - n), n) + np.arange(n.sum())
        inter = np.bincount(owner[at], minlength=len(two))
        hit = todo & (100 * inter >= pct * (size + len(s) - inter))
        out += [(a, int(x)) for x in rep[hit]]
    return out


def blockwise(placed: DataFrame, big: DataFrame, sets: DataFrame, classes: DataFrame, p: NearDedup) -> DataFrame:
    """Links (a, b) between classes of different components in large buckets; ``big``: (bucket, m), m its shingles."""
    rows = placed.join(big, "bucket").withColumn("blocks", F.ceil(F.col("m") / p.block))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    rows = rows.select("bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "rep", "component_id")
    rows = rows.join(sets, F.col("rep") == F.col("id")).join(classes.select(F.col("rep").alias("_rep"), "bands"), F.col("rep") == F.col("_rep"))
    rows = rows.select("bucket", "lo", "hi", "own", "rep", "component_id", "s", "bands").repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")

    def run(batches):
        key, held = None, []
        for batch in batches:
            cols = [batch.column(c) for c in ("bucket", "lo", "hi", "own", "rep", "component_id", "s", "bands")]
            for i in range(len(batch)):
                now = tuple(c[i].as_py() for c in cols[:3])
                if now != key:
                    yield from done(key, held)
                    key, held = now, []
                held.append((*(c[i].as_py() for c in cols[3:6]), np.frombuffer(cols[6][i].as_py(), np.uint64), cols[7][i].values.to_numpy()))
        yield from done(key, held)

    def done(key, held):
        links = _block_links(held, key[1], key[2], key[0], p.pct) if held else []
        if links:
            yield pa.record_batch({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return rows.mapInArrow(run, "a bigint, b bigint")


def _twice(up: DataFrame) -> DataFrame:
    """(id, into) followed twice where the first ``into`` goes on itself."""
    on = up.select(F.col("id").alias("_id"), F.col("into").alias("_into"))
    return stage(up.join(on, F.col("into") == F.col("_id"), "left").select("id", F.coalesce("_into", "into").alias("into")), "moves")


def _roots(links: DataFrame, a: str, b: str) -> DataFrame:
    """(id, into) for the ids that the links join to a smaller one."""
    return stage(components(links, a, b).where("id <> component_id").select("id", F.col("component_id").alias("into")), "moves")


def near_groups(docs: DataFrame, p: NearDedup = NearDedup(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, class_id."""
    sig = stage(signatures(docs, p, text, doc_id), "sig")
    own = sig.where("n > 0 and doc_id is not null")
    classes = stage(own.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands")), "classes")
    member = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    # Buckets of one class are gone from here on.
    shared = member.groupBy("bucket").agg(F.min("rep").alias("lead"), F.max("rep").alias("last")).where("lead <> last")
    member = stage(member.join(shared.select("bucket"), "bucket", "left_semi"), "members")
    ids = member.select("rep").distinct()
    texts = docs.where(q(doc_id).isNotNull() & maybe_in(docs, doc_id, ids, "rep"))
    sets = stage(shingle_sets(texts.join(ids.select(F.col("rep").alias(fresh(docs, "_rep")[0])),
                                         q(doc_id).cast("bigint") == F.col(fresh(docs, "_rep")[0]), "left_semi"),
                              p.k, text, doc_id), "sets")
    placed, found, checked = member.withColumn("component_id", F.col("rep")), None, None

    def mixed(rows: DataFrame) -> DataFrame:
        """The rows of buckets that still hold more than one component."""
        two = rows.groupBy("bucket").agg(F.min("component_id").alias("lo"), F.max("component_id").alias("hi")).where("lo <> hi")
        return stage(rows.join(two.select("bucket"), "bucket", "left_semi"), "placed")

    def moved(rows: DataFrame, move: DataFrame, column: str) -> DataFrame:
        return rows.join(move, F.col(column) == F.col("id"), "left").withColumn(column, F.coalesce("into", column)).drop("id", "into")

    for turn in range(p.star_rounds):
        lead = placed.groupBy("bucket").agg(F.min_by(F.struct("rep", "n", "component_id"), F.struct("component_id", F.xxhash64("rep", F.lit(turn)))).alias("lead"))
        cand = (placed.join(lead, "bucket").where("component_id <> lead.component_id")
                .where(F.expr(f"100 * least(n, lead.n) >= {p.pct} * greatest(n, lead.n)"))
                .select(F.col("rep").alias("a"), F.col("lead.rep").alias("b"), F.col("component_id").alias("ca"), F.col("lead.component_id").alias("cb")))
        if checked is not None:
            cand = cand.join(checked, ["a", "b"], "left_anti")
        # A few leaders a class and turn; the others come later, if still apart.
        some = F.slice(F.array_sort(F.collect_set(F.struct(F.xxhash64("a", "b", F.lit(turn)).alias("o"), "b", "cb"))), 1, p.leaders)
        cand = stage(cand.groupBy("a", "ca").agg(some.alias("s")).select("a", "ca", F.inline("s")).select("a", "b", "ca", "cb"), "pairs")
        checked = cand.select("a", "b") if checked is None else checked.union(cand.select("a", "b"))
        new = stage(verified(cand, sets, p.pct), "links")
        n_new, n_cand = new.count(), cand.count()
        if n_new:
            found = new.select("a", "b") if found is None else found.union(new.select("a", "b"))
        # Where leaders hardly find links any more, the buckets are for the exact comparison of the rest.
        if n_new * p.yield_ < n_cand:
            break
        if n_new and turn + 1 < p.star_rounds:
            # Between turns a component goes to the least one it is linked with, and on to where that one goes.
            up = new.groupBy(F.col("ca").alias("id")).agg(F.min("cb").alias("into"))
            placed = mixed(moved(placed, _twice(up), "component_id"))
    # All links so far make components; those of a bucket are now the only ones that may still be apart.
    comp = None if found is None else _roots(found, "a", "b")
    placed = mixed(member.withColumn("component_id", F.col("rep")) if comp is None else moved(member.withColumn("component_id", F.col("rep")), comp, "component_id"))
    # The rest: pairs of a bucket that lie in different components, each once.
    big = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("m"))
    big = stage(big.where(f"classes > {p.pairwise}").select("bucket", "m"), "big")
    small = placed.join(big.select("bucket"), "bucket", "left_anti")
    x, y = small.alias("x"), small.alias("y")
    rest = (x.join(y, F.expr("x.bucket = y.bucket and x.component_id > y.component_id and "
                             f"100 * least(x.n, y.n) >= {p.pct} * greatest(x.n, y.n)"))
            .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), F.col("x.component_id").alias("ca"), F.col("y.component_id").alias("cb")).distinct())
    if checked is not None:
        rest = rest.join(checked.union(checked.select("b", "a")), ["a", "b"], "left_anti")
    late = verified(stage(rest, "pairs"), sets, p.pct).select("ca", "cb")
    if not big.isEmpty():
        own = placed.select("rep", "component_id").distinct()
        blocks = blockwise(placed, big, sets, classes, p)
        blocks = blocks.join(own.select(F.col("rep").alias("a"), F.col("component_id").alias("ca")), "a").join(
            own.select(F.col("rep").alias("b"), F.col("component_id").alias("cb")), "b")
        late = late.union(blocks.select("ca", "cb"))
    late = stage(late, "links")
    if not late.isEmpty():
        # A component that the late links join to a smaller one takes its classes along.
        move = _roots(late, "ca", "cb")
        comp = move if comp is None else moved(comp.withColumnRenamed("id", "rep").withColumnRenamed("into", "component_id"), move, "component_id").select(
            F.col("rep").alias("id"), F.col("component_id").alias("into")).union(move)
    if comp is None:
        comp = classes.select(F.col("rep").alias("id"), F.col("rep").alias("into")).limit(0)
    comp = comp.withColumnRenamed("into", "component_id")
    by_class = classes.select("d1", "d2", "n", "rep").join(comp, classes.rep == comp.id, "left").select(
        "d1", "d2", "n", F.col("rep").alias("class_id"), F.coalesce("component_id", "rep").alias("component_id"))
    by_class = stage(by_class, "byclass")
    out = sig.select("doc_id", "n", "d1", "d2").join(by_class, ["d1", "d2", "n"], "left")
    cid = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), cid.alias("component_id"),
                      cid.eqNullSafe(F.col("doc_id")).alias("kept"),
                      F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("class_id", "doc_id")).alias("class_id"))


def drop_near(docs: DataFrame, p: NearDedup = NearDedup(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that are not the smallest id of their group."""
    gone = stage(near_groups(docs, p, text, doc_id).where(~F.col("kept")).select("doc_id"), "gone")
    return without(docs, gone, doc_id)
