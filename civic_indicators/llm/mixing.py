"""Operator 2: mixing sources to target weights by hierarchical budgeting.

Documents hang on a tree of ``levels`` (domain, language, source). The token budget is
handed down: a node's children share its tokens by their weights; a child whose subtree
has less to give (its tokens times ``max_epochs``) keeps what it has, and its shortage
goes to its siblings by their weights. Only what all siblings together cannot give is
missing at the parent, whose own siblings take it; a parent's offer is what its subtree
can give, so shortages move sideways before they move up.

A leaf with an allocation of a tokens out of t takes a // t full epochs and, of one
more epoch, the prefix of a % t tokens: documents in the order of a seeded hash of
(seed, epoch, id), up to the last that fits; of rows equal in id and text, as many as fit.

Tokens are words ``[^\\x20\\x09-\\x0D]+``. Null text: no tokens; null level: the name
``(none)``; null id: the text "null" in the hash. A weight of 0 takes nothing, unnamed
children weigh ``default_weight``. Rows equal in id are ordered by the MD5 of the text;
which of the rows equal in both are taken is open. An empty table gives an empty result.
The extra columns of ``docs`` are carried along.

No leaf is ordered in one task: tokens are summed per leaf and hash bucket, running sums
go over the buckets, and only the one bucket that holds a leaf's cut is ordered, copies
counted first; the copies at the cut are numbered partition by partition.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civic_indicators.llm.common import fresh, q, stage


@dataclass(frozen=True)
class MixParams:
    """``levels``: SQL expressions over the documents' columns, root first; ``weights``: whole numbers by
    path from the root; ``budget``: tokens, or None for ``share`` (numerator, denominator) of all tokens."""

    levels: tuple[str, ...]
    weights: Mapping[tuple[str, ...], int] = field(default_factory=dict)
    default_weight: int = 1
    budget: int | None = None
    share: tuple[int, int] = (1, 2)
    max_epochs: int = 4
    seed: str = "mix-1"
    bucket_digits: int = 3  # hash buckets per leaf: 16 to this power


def n_tokens(text: Column) -> Column:
    """Words of a text: starts of runs of anything but ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint")


def _digest(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(q(text), F.lit(""))))


def _weight(p: MixParams, cols: list[str]) -> Column:
    own = {k: w for k, w in p.weights.items() if len(k) == len(cols)}
    out = F.lit(p.default_weight)
    for path, w in sorted(own.items()):
        hit = F.lit(True)
        for c, v in zip(cols, path):
            hit = hit & (F.col(c) == v)
        out = F.when(hit, F.lit(w)).otherwise(out)
    return out.cast("bigint")


def _share(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """Each child's ``give`` of its parent's ``offer``, from ``w`` and ``cap``: min(cap, level * w) where the
    level is the largest of (offer - caps before) / (weights from here on), children by cap / w."""
    keys = [c for c in nodes.columns if c.startswith("_l")]
    part = Window.partitionBy(*(parents or [F.lit(0)]))
    order = part.orderBy(F.col("cap") / F.col("w"), *keys)
    live = nodes.where("w > 0")
    live = live.withColumn("lam", (F.col("offer") - (F.sum("cap").over(order) - F.col("cap")))
                           / (F.sum("w").over(part) - F.sum("w").over(order) + F.col("w")))
    return live.withColumn("give", F.least(F.col("cap").cast("double"), F.max("lam").over(part) * F.col("w"))).drop("lam")


def allocate(leaves: DataFrame, p: MixParams) -> DataFrame:
    """(level columns, t, alloc) for each leaf, from its tokens ``t``."""
    cols = [f"_l{i}" for i in range(len(p.levels))]
    leaves = leaves.withColumn("cap", F.col("t") * p.max_epochs)
    tokens = leaves.agg(F.sum("t")).first()[0] or 0
    total = float(p.budget) if p.budget is not None else tokens * p.share[0] / p.share[1]
    offers = None
    for i in range(len(cols)):
        nodes = leaves.groupBy(*cols[:i + 1]).agg(F.sum("cap").alias("cap")).withColumn("w", _weight(p, cols[:i + 1]))
        nodes = nodes.join(offers, cols[:i]) if i else nodes.withColumn("offer", F.lit(total))
        offers = stage(_share(nodes, cols[:i]).select(*cols[:i + 1], F.col("give").alias("offer")), "offers")
    return leaves.select(*cols, "t").join(offers, cols, "left").select(*cols, "t", F.floor(F.coalesce("offer", F.lit(0.0))).cast("bigint").alias("alloc"))


def mix(docs: DataFrame, p: MixParams, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The columns of ``docs`` plus mix_tokens, mix_epoch and one mix_level_i per level, a row per
    epoch a document is in; a name that ``docs`` has already gets underscores in front."""
    cols = [f"_l{i}" for i in range(len(p.levels))]
    path = [F.coalesce(F.expr(e).cast("string"), F.lit("(none)")).alias(c) for c, e in zip(cols, p.levels)]
    ident = F.coalesce(q(doc_id).cast("string"), F.lit("null"))
    items = stage(docs.select(*path, ident.alias("id"), n_tokens(q(text)).alias("n"), _digest(text).alias("x")), "items")
    leaves = stage(items.groupBy(*cols).agg(F.sum("n").alias("t")), "leaves")
    plan = allocate(leaves, p).withColumn("full", F.when(F.col("t") > 0, F.floor(F.col("alloc") / F.col("t"))).otherwise(0).cast("bigint"))
    plan = stage(plan.select(*cols, "full", (F.col("alloc") - F.col("full") * F.col("t")).alias("rest")), "plan")

    def key(full: Column, i: Column) -> Column:
        return F.md5(F.concat_ws("|", F.lit(p.seed), full.cast("string"), i))

    some = items.join(plan.where("rest > 0"), cols).withColumn("h", key(F.col("full"), F.col("id")))
    some = some.withColumn("bucket", F.substring("h", 1, p.bucket_digits))
    buckets = some.groupBy(*cols, "bucket", "rest").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*cols).orderBy("bucket")
    buckets = stage(buckets.withColumn("after", F.sum("n").over(upto)).withColumn("before", F.col("after") - F.col("n")), "buckets")
    # The cut's bucket: the first whose end is beyond the rest.
    cut = buckets.where("after > rest").groupBy(*cols).agg(F.min(F.struct("bucket", "before")).alias("c")).select(*cols, "c.bucket", "c.before")
    # Rows equal in id and text are one entry of c copies: those before the cut fit whole, the one at it k times.
    same = some.join(cut, [*cols, "bucket"]).groupBy(*cols, "before", "rest", "h", "x").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n"))
    same = same.withColumn("after", F.col("before") + F.sum(F.col("c") * F.col("n")).over(Window.partitionBy(*cols).orderBy("h", "x")))
    fits = F.expr("(rest - after + c * n) div nullif(n, 0)")
    ends = same.groupBy(*cols).agg(F.max(F.when(F.expr("after <= rest"), F.struct("h", "x"))).alias("last"),
                                   F.min(F.when(F.expr("after > rest"), F.struct("h", "x", fits.alias("k")))).alias("part"))
    plan = stage(plan.join(cut.select(*cols, "bucket"), cols, "left").join(ends, cols, "left"), "cuts")

    names = fresh(docs, *[f"_m{i}" for i in range(len(cols))], "_full", "_rest", "_bucket", "_last", "_part", "_h", "_x", "_slice", "_before")
    lv, (full, rest, bucket, last_, part, h, x, slice_, before) = names[:len(cols)], names[len(cols):]
    cuts = plan.select(*[F.col(c).alias(n) for c, n in zip([*cols, "full", "rest", "bucket", "last", "part"], names)])
    own = docs.select("*", *[e.alias(n) for e, n in zip(path, lv)]).join(cuts, lv)
    own = own.withColumn(h, key(F.col(full), ident)).withColumn(x, _digest(text))
    # In the prefix: below the cut's bucket, or in it and not after the last that fits.
    place = F.struct(F.col(h).alias("h"), F.col(x).alias("x"))
    inside = (F.col(rest) > 0) & (F.col(bucket).isNull() | (F.substring(h, 1, p.bucket_digits) < F.col(bucket))
                                  | F.coalesce(place <= F.col(last_), F.lit(False)))
    n = fresh(own, "_times")[0]
    times = F.col(full) + F.when(inside, 1).otherwise(0)
    if plan.where("part.k > 0").isEmpty():
        own = own.withColumn(n, times)
    else:
        at = F.coalesce((F.col(f"{part}.k") > 0) & (F.col(f"{part}.h") == F.col(h)) & (F.col(f"{part}.x") == F.col(x)), F.lit(False))
        copies = stage(own.where(at).withColumn(slice_, F.spark_partition_id()), "copies")
        slices = copies.groupBy(*lv, slice_).agg(F.count(F.lit(1)).alias(before))
        slices = slices.withColumn(before, F.sum(before).over(Window.partitionBy(*lv).orderBy(slice_)) - F.col(before))
        rank = F.col(before) + F.row_number().over(Window.partitionBy(*lv, slice_).orderBy(F.lit(0)))
        copies = copies.join(slices, [*lv, slice_]).withColumn(n, F.col(full) + F.when(rank <= F.col(f"{part}.k"), 1).otherwise(0))
        own = own.where(~at).withColumn(n, times).unionByName(copies.drop(slice_, before))
    own = own.where(F.col(n) > 0)
    out = fresh(docs, *[f"mix_level_{i}" for i in range(len(cols))], "mix_tokens", "mix_epoch")
    return own.select(*[q(c) for c in docs.columns], *[F.col(c).alias(o) for c, o in zip(lv, out)], n_tokens(q(text)).alias(out[-2]),
                      F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)).alias(out[-1]))
