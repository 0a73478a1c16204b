"""Operator 13: Order MinHash document fingerprints, in SQL functions only.

K-mers. A text is cut into phrases: up to three words of at most six letters and the word
that follows them (words are runs without ASCII white space; a code point of a script written
without spaces is a phrase by itself). Where a phrase ends depends on the words near it only, so an
edit moves few phrases. ``k`` phrases in a row are a k-mer, all of them in a text that has
fewer. The j-th time that a k-mer occurs it is numbered j, so that repeats count: the pairs
(k-mer, j) are a set.

Selection. Every pair is hashed to one of ``coords`` bins and to a value in it. A bin selects
the two pairs of least value. Short texts throw each pair anew in further rounds, until
``throws`` throws are made; a bin prefers earlier rounds, so texts of different length still
agree on what they share.

Order. The selected pairs of a bin are put back into the order of the text, and the tuple is
hashed to 16 bits. So a coordinate is equal in two texts if the same k-mers are selected and
stand in the same order: with one pair a bin (plain MinHash) moved passages would not show,
with two they do, which makes the share of equal coordinates follow the edit distance.

A fingerprint is a string of 4 hex digits a coordinate, "" for a text without words. Equal
texts have equal fingerprints. ``likeness`` is the share of equal coordinates.

``edit_likeness`` compares each document with the next one in falling order of doc_id, and
with its own text whose last half is replaced by the start of the next. The next document is
found block by block (64 ids a block) behind one shuffle of the texts by block; only the last
document of a block looks beyond it, in a join.

Results: a null text counts as empty. Rows of one id are one document, with the smallest of
their texts. A row with a null id keeps its fingerprint, but has no place in the order: its
other values are null. A table of one document has itself as the next one. An empty table
gives an empty result; extra columns are ignored. A text needs some hundred bytes of memory a
word while its row is worked on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civic_indicators.llm.common import fresh, q, stage

#: Scripts that are written without spaces.
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
OTHER = rf"[{UNSPACED}]|[^\x20\x09-\x0D{UNSPACED}]++"
MAY_BE_UNSPACED = r"[\u0E00-\x{10FFFF}]"
PHRASE = r"(?:[^\x20\x09-\x0D]{1,6}+[\x20\x09-\x0D]++){0,3}[^\x20\x09-\x0D]++"

#: Low bits of a throw: the position in the text. Texts of more phrases wrap around, in order only.
POSITION_BITS = 24
POSITION = (1 << POSITION_BITS) - 1
BLOCK_BITS = 6
FAN_BITS = 12


@dataclass(frozen=True)
class OrderMinHash:
    """Parameters: phrases a k-mer, 2 ** log2_coords bins of two pairs each, least number of throws (below 512)."""

    k: int = 1
    log2_coords: int = 6
    throws: int = 500

    @property
    def coords(self) -> int:
        return 1 << self.log2_coords

    @property
    def bin_shift(self) -> int:
        return 64 - self.log2_coords

    @property
    def round_shift(self) -> int:
        return self.bin_shift - 9


def _long(x) -> Column:
    return F.lit(x).cast("bigint")


def _upto(n: Column) -> Column:
    """0 .. n-1 (n at least 1), as bigint."""
    return F.sequence(_long(0), n.cast("bigint") - 1)


def _at(array: Column, i: Column) -> Column:
    return F.coalesce(F.get(array, i), _long(0))  # never null, so that arrays of longs sort as primitives


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def phrases(text: Column) -> Column:
    """The phrases of a text; the costly pattern is used only where a text has letters of other scripts."""
    t = F.coalesce(text, F.lit(""))
    other = (F.octet_length(t) > F.length(t)) & t.rlike(MAY_BE_UNSPACED)
    return F.when(other, F.regexp_extract_all(t, F.lit(OTHER), F.lit(0))).otherwise(F.regexp_extract_all(t, F.lit(PHRASE), F.lit(0)))


def _repeats(array: Column, i: Column, same) -> Column:
    """How many elements just before the i-th of a sorted array are ``same`` as it: one, two, then by halving steps."""
    far = F.aggregate(F.sequence(F.length(F.bin(F.size(array))), F.lit(0), F.lit(-1)), F.lit(0), lambda d, b: d + F.when(
        same(i - d - F.call_function("shiftleft", F.lit(1), b)), F.call_function("shiftleft", F.lit(1), b)).otherwise(0))
    return F.when(~same(i - 2), 1).when(~same(i - 3), 2).otherwise(far).cast("bigint")


def with_fingerprint(df: DataFrame, text: str, out: str, p: OrderMinHash = OrderMinHash()) -> DataFrame:
    """``df`` with the fingerprint of its column ``text`` as a further column ``out``.

    Each step is a column of its own that is used more than once, so that the optimizer keeps
    the steps apart and nothing is computed again for every element.
    """
    w, pos, pair, ball, pick = fresh(df, "_phrases", "_kmers", "_pairs", "_throws", "_picks")
    keep = [q(c) for c in df.columns]
    W, P, H, B, S = (q(c) for c in (w, pos, pair, ball, pick))
    low, empty = _long(POSITION), F.array().cast("array<bigint>")

    df = df.select(*keep, phrases(q(text)).alias(w))
    # K-mers, sorted by their hash and then by position, in one long each.
    kmer = F.transform(_upto(F.greatest(F.size(W) - (p.k - 1), F.lit(1))), lambda i: F.xxhash64(
        *[F.get(W, i + j) for j in range(p.k)]).bitwiseAND(_long(~POSITION)).bitwiseOR(i.bitwiseAND(low)))
    df = df.select(*keep, F.sort_array(F.when(F.size(W) > 0, kmer).otherwise(empty)).alias(pos))

    # Pairs: equal k-mers stand together, so a k-mer's number is that of equal ones before.
    # In one long each: bin, 9 bits for the round, value, position.
    def hash_of(x: Column) -> Column:
        return F.shiftright(x, POSITION_BITS)

    here = _long(~POSITION & ~(0x1FF << p.round_shift))

    def numbered(x: Column, i: Column) -> Column:
        def same(j: Column) -> Column:
            return (j >= 0) & (hash_of(_at(P, j)) == hash_of(x))

        first = F.when(hash_of(_at(P, i - 1).bitwiseXOR(x)) != 0, F.xxhash64(hash_of(x)))
        return first.otherwise(F.xxhash64(hash_of(x), _repeats(P, i, same))).bitwiseAND(here).bitwiseOR(x.bitwiseAND(low))

    df = df.select(*keep, P, F.transform(P, numbered).alias(pair))

    # Throws: the pairs themselves, and where they are few the same pairs anew in further rounds.
    def again(t: Column) -> Column:
        return _with(F.call_function("shiftleft", t, F.lit(p.round_shift)), lambda at: F.transform(H, lambda v: F.xxhash64(
            hash_of(v), t).bitwiseAND(here).bitwiseOR(at.bitwiseOR(v.bitwiseAND(low)))))

    n = F.size(H).cast("bigint")
    more = F.flatten(F.transform(F.sequence(_long(1), F.ceil(_long(p.throws) / n).cast("bigint") - 1), again))
    throws = F.when(n == 0, empty).when(n * 2 > p.throws, H).otherwise(F.concat(H, more))
    df = df.select(*keep, F.sort_array(throws).alias(ball))
    # The first two of each bin.
    two = F.filter(B, lambda x, i: (i < 2) | (F.shiftright(_at(B, i - 2).bitwiseXOR(x), p.bin_shift) != 0))
    df = df.select(*keep, two.alias(pick))

    def digits(a: Column, b: Column) -> Column:
        """A coordinate: the pairs of a bin, null where there is none, hashed in the order of the text."""
        v = F.when(a.bitwiseAND(low) > b.bitwiseAND(low), F.xxhash64(hash_of(b), hash_of(a))).otherwise(F.xxhash64(hash_of(a), hash_of(b)))
        return F.substring(F.hex(v.bitwiseOR(_long(-1 << 63))), 13, 4)

    def by_bin(c: Column) -> Column:  # bins sort as signed numbers
        return _with(F.filter(S, lambda x: F.shiftright(x, p.bin_shift) == c - p.coords // 2), lambda g: digits(F.get(g, F.lit(0)), F.get(g, F.lit(1))))

    all_full = F.zip_with(F.filter(S, lambda x, i: i % 2 == 0), F.filter(S, lambda x, i: i % 2 == 1), digits)
    found = F.when(F.size(S) == 2 * p.coords, all_full).otherwise(F.transform(_upto(_long(p.coords)), by_bin))
    return df.select(*keep, F.when(F.size(S) > 0, F.array_join(found, "")).otherwise("").alias(out))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal coordinates of two fingerprints, 0 to 1; null if either is null."""
    n = (F.length(a) / 4).cast("int")
    same = F.size(F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.substr(a, i * 4 + 1, F.lit(4)) == F.substr(b, i * 4 + 1, F.lit(4))))
    return F.when(a.isNull() | b.isNull(), None).when(a == b, 1.0).when((n == 0) | (F.length(a) != F.length(b)), 0.0).otherwise(same / n)


def fingerprints(docs: DataFrame, p: OrderMinHash = OrderMinHash(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and fingerprint of every row of ``docs``; nothing is shuffled."""
    own = docs.select(q(doc_id).cast("bigint").alias("doc_id"), q(text).alias("text"))
    return with_fingerprint(own, "text", "fingerprint", p).drop("text")


def _group(k: Column, bits: int) -> Column:
    return F.shiftright(k, bits)


def next_below(keys: DataFrame, low: int, high: int) -> DataFrame:
    """(k, below) for distinct bigints ``k`` between low and high: the largest smaller key, null for the least.

    Within groups of at most 2 ** FAN_BITS keys by a window, across groups by the groups' own keys.
    """
    if high - low < 1 << FAN_BITS:
        return keys.select("k", F.lead("k").over(Window.partitionBy(F.lit(0)).orderBy(F.desc("k"))).alias("below"))
    near = keys.select("k", F.lead("k").over(Window.partitionBy(_group(F.col("k"), FAN_BITS)).orderBy(F.desc("k"))).alias("below"))
    groups = keys.groupBy(_group(F.col("k"), FAN_BITS).alias("g")).agg(F.max("k").alias("top"))
    above = next_below(groups.select(F.col("g").alias("k")), low >> FAN_BITS, high >> FAN_BITS)
    above = above.join(groups, F.col("below") == F.col("g")).select(F.col("k").alias("g"), "top")
    return near.withColumn("g", _group(F.col("k"), FAN_BITS)).join(above, "g", "left").select("k", F.coalesce("below", "top").alias("below"))


def edit_likeness(docs: DataFrame, p: OrderMinHash = OrderMinHash(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, a row per document."""
    own = docs.select(q(doc_id).cast("bigint").alias("doc_id"), F.coalesce(q(text), F.lit("")).alias("text"))
    unplaced = with_fingerprint(own.where("doc_id is null"), "text", "fingerprint", p).select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.lit(None).cast("string").alias("edited_sha256"), "fingerprint",
        F.lit(None).cast("string").alias("edited_fingerprint"), F.lit(None).cast("double").alias("near_edited"), F.lit(None).cast("double").alias("near_next"))
    low, high = own.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None:
        return unplaced
    # One row per id: ids that occur once pass where they are.
    placed = own.where("doc_id is not null")
    repeated = stage(placed.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    once = placed.join(repeated, "doc_id", "left_anti").unionByName(
        placed.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text")))
    # Of each block the least id, and the id that follows it: the largest of the next lower block, or of all.
    block = _group(F.col("doc_id"), BLOCK_BITS)
    blocks = placed.groupBy(block.alias("k")).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    lower = next_below(blocks.select("k"), low >> BLOCK_BITS, high >> BLOCK_BITS).join(blocks.select("k", "least"), "k")
    ends = lower.join(blocks.select(F.col("k").alias("below"), "most"), "below", "left").select(
        F.col("least").alias("end"), F.coalesce("most", _long(high)).alias("follower"))
    ends = stage(ends, "ends")
    # The only shuffle of whole texts.
    window = Window.partitionBy("block").orderBy(F.desc("doc_id"))
    marked = with_fingerprint(once, "text", "fingerprint", p).withColumn("block", block)
    marked = marked.select("doc_id", "text", "fingerprint", F.lead("text").over(window).alias("next_text"),
                           F.lead("fingerprint").over(window).alias("next_print"), F.lag("doc_id").over(window).alias("before"))
    first = marked.where("before is null").select(F.col("doc_id").alias("follower"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    last = marked.where("next_print is null").select("doc_id", "text", "fingerprint").join(ends, F.col("doc_id") == F.col("end")).join(first, "follower")
    names = ["doc_id", "text", "fingerprint", "next_text", "next_print"]
    pairs = marked.where("next_print is not null").select(*names).unionByName(last.select(*names))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half))
    pairs = pairs.select("doc_id", n.cast("bigint").alias("n_chars"), "fingerprint", "next_print", edited.alias("edited"))
    pairs = pairs.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "next_print", "edited")
    pairs = with_fingerprint(pairs, "edited", "edited_fingerprint", p)
    out = pairs.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"))
    return out.unionByName(unplaced)
