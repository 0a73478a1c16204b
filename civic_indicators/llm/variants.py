"""Operator 11: spelling variants of the corpus vocabulary by asymmetric q-chunks.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. Of
a pair, the shorter word (of equal ones either) contributes two disjoint chunks, its first and
its last q = length // 2 code points; the other word contributes its positional grams of that q.
One edit leaves a chunk whole, at most one place off, so the words meet under (length, chunk,
gram) within shift one. Of the grams within shift one only the first and the last are kept: an
edit behind the first chunk leaves that at the start, one before the last chunk leaves that at the end.

The words that meet under a key are verified on what is left of them beside the chunk. That is not
done pair by pair: equal rests after one position is taken out differ by one replacement, and a
longer rest with one position taken out that equals a shorter one differs by one insertion. So
a group costs its words times their length, and only near words are pairs.

A group of more than ``group`` words is not verified in one task: its words' rests are
chunked anew under the group's key, again and again until groups are small or rests have one
code point (then the alphabet bounds them). No group is capped.

Each word's form is its near word of largest number of occurrences (ties: smallest in
code-point order) if that is at least ``ratio`` times its own; its root is the end of the chain
of forms, found by pointer doubling.

Results: null and empty texts have no words; a null id counts as the text "null"; repeated rows
count again; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civic_indicators.llm.common import lower_ascii, q, stage

LETTERS = r"[A-Za-zÀ-ÿ]"


@dataclass(frozen=True)
class Variants:
    """Parameters: shortest word, fewest occurrences, factor between a form and its variant, words verified in one group."""

    min_length: int = 7
    min_count: int = 2
    ratio: int = 10
    group: int = 2000
    misspell: int = 31


def corpus_words(docs: DataFrame, p: Variants = Variants(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row ``word`` per run of letters, A-Z lower-cased, that is long enough.

    With ``misspell`` (0: none) a run loses one code point where that number divides the crc32 of "id:run".
    """
    run = F.explode(F.regexp_extract_all(q(text), F.lit(f"{LETTERS}{{{p.min_length},}}"), F.lit(0))).alias("run")
    runs = docs.select(F.coalesce(q(doc_id).cast("string"), F.lit("null")).alias("id"), run).select("id", lower_ascii(F.col("run")).alias("w"))
    if not p.misspell:
        return runs.select(F.col("w").alias("word"))
    h = F.crc32(F.concat("id", F.lit(":"), "w").cast("binary"))
    runs = runs.select("w", h.alias("h")).withColumn("at", (F.col("h") % F.length("w")).cast("int"))
    less = F.concat(F.substr("w", F.lit(1), F.col("at")), F.substr("w", F.col("at") + 2))
    return runs.select(F.when(F.col("h") % p.misspell == 0, less).otherwise(F.col("w")).alias("word")).where(F.length("word") >= p.min_length)


def vocabulary(words: DataFrame, p: Variants = Variants()) -> DataFrame:
    """(word, n) of the words that occur often enough."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= p.min_count)


def keyed(items: DataFrame) -> DataFrame:
    """(key, role, rest, word) of items (scope, role, s, word): the two chunks, or the two grams, of each.

    Role 0 is the shorter word of a pair, role 1 the one that is longer by one code point.
    """
    size, whole = F.length("s"), F.length("s") - F.col("role")
    of = items.withColumn("q", F.floor(whole / 2).cast("int"))

    def part(number: int, gram, rest):
        return F.struct(F.xxhash64("scope", whole, F.lit(number), gram).alias("key"), rest.alias("rest"))

    n = F.col("q")
    parts = F.array(part(1, F.substr("s", F.lit(1), n), F.substr("s", n + 1)),
                    part(2, F.substr("s", size - n + 1, n), F.substr("s", F.lit(1), size - n)))
    return of.select("role", "word", F.explode(parts).alias("p")).select("p.key", "role", "p.rest", "word")


def one_edit(x: str, y: str) -> bool:
    """Whether the words differ by exactly one inserted, deleted or replaced code point."""
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1 or x == y:
        return False
    i = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), len(x))
    return x[i + (len(x) == len(y)):] == y[i + 1:]


def group_links(members: list[tuple[int, str, str]]) -> set[tuple[str, str]]:
    """The near pairs of a group of (role, rest, word); words that meet by a clash of keys are told apart."""
    without, exact = defaultdict(list), defaultdict(list)
    found = set()
    for role, rest, word in members:
        if role == 0:
            exact[rest].append(word)
            for i in range(len(rest)):
                same = without[i, rest[:i] + rest[i + 1:]]
                found.update((min(x, word), max(x, word)) for x in same if x != word)
                same.append(word)
    for role, rest, word in members:
        if role == 1:
            for less in {rest[:i] + rest[i + 1:] for i in range(len(rest))}:
                found.update((min(x, word), max(x, word)) for x in exact.get(less, ()))
    return {(x, y) for x, y in found if one_edit(x, y)}


def verified(rows: DataFrame) -> DataFrame:
    """(a, b), a < b: the near pairs within each key."""
    def run(batches):
        key, members = None, []

        def links():
            found = group_links(members) if len(members) > 1 else ()
            if found:
                yield pa.record_batch([pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.string())], ["a", "b"])

        for batch in batches:
            for k, role, rest, word in zip(*(batch.column(c).to_pylist() for c in ("key", "role", "rest", "word"))):
                if k != key:
                    yield from links()
                    key, members = k, []
                members.append((role, rest, word))
        yield from links()

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a string, b string")


def near_words(vocab: DataFrame, p: Variants = Variants()) -> DataFrame:
    """(a, b), a < b: all pairs of near words of ``vocab``, each once."""
    roles = F.explode(F.array(F.lit(0), F.lit(1))).alias("role")
    items = vocab.select(F.lit(0).cast("bigint").alias("scope"), roles, F.col("word").alias("s"), "word")
    links = []
    while True:
        rows = keyed(items)
        # Groups of one word, and of longer words only, are gone before anything is sorted.
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("role").alias("least"), F.max(F.length("rest") - F.col("role")).alias("left"))
        large = stage(sizes.where((F.col("n") > p.group) & (F.col("least") == 0) & (F.col("left") > 1)).select("key"), "large")
        links.append(stage(verified(rows.join(large, "key", "left_anti")), "near"))
        if large.isEmpty():
            break
        items = stage(rows.join(large, "key", "left_semi").select(F.col("key").alias("scope"), "role", F.col("rest").alias("s"), "word"), "items")
    return reduce(DataFrame.union, links).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain, for (word, form) without cycles."""
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("then"))
        now = stage(now.join(further, "root", "left").select("word", F.coalesce("then", "root").alias("root"), F.col("then").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(words: DataFrame, p: Variants = Variants()) -> DataFrame:
    """word, form, root, n, n_near, form_n of each distinct word of ``words`` (one row per occurrence)."""
    vocab = stage(vocabulary(words, p), "vocabulary")
    links = stage(near_words(vocab, p), "links")
    both = links.select(F.col("a").alias("word"), F.col("b").alias("near")).union(links.select("b", "a"))
    near = both.join(vocab.select(F.col("word").alias("near"), F.col("n").alias("m")), "near")
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    told = vocab.join(best, "word", "left").withColumn("is_form", F.coalesce(-F.col("best.m") >= p.ratio * F.col("n"), F.lit(False)))
    told = stage(told.select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(F.col("is_form"), F.col("best.near")).alias("form"),
                             F.when(F.col("is_form"), -F.col("best.m")).alias("form_n")), "forms")
    ends = roots(told.where("form is not null").select("word", "form"))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, p: Variants = Variants(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``variants`` of the words of whole texts."""
    return variants(corpus_words(docs, p, text, doc_id), p)


def variants_sql(p: Variants = Variants()) -> str:
    """``spelling_variants`` of ``documents`` in DuckDB SQL; the crc32 is folded over the bytes from its rule."""
    return rf"""WITH RECURSIVE bits AS (SELECT i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) t(i) UNION ALL
            SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
        tab AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
        runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), 'null') AS id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
        coded AS (SELECT w, hex(encode(id || ':' || w)) AS x FROM runs WHERE length(w) >= {p.min_length}),
        hashed AS (SELECT w, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(x), 2), lambda i: CAST('0x' || x[i:i+1] AS BIGINT))),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM coded, tab),
        words AS (SELECT CASE WHEN h % {p.misspell} = 0 THEN w[1:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word FROM hashed),
        v AS MATERIALIZED (SELECT word, count(*) AS n FROM words WHERE length(word) >= {p.min_length} GROUP BY word HAVING count(*) >= {p.min_count}),
        cut AS MATERIALIZED (SELECT word, i, word[1:i - 1] || word[i + 1:] AS less FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
        near AS (SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
            UNION SELECT word, less FROM cut SEMI JOIN v ON cut.less = v.word UNION SELECT less, word FROM cut SEMI JOIN v ON cut.less = v.word),
        told AS MATERIALIZED (SELECT v.word, v.n, count(near) AS n_near, arg_min(near, (-o.n, near)) AS best, max(o.n) AS m
            FROM v LEFT JOIN near ON near.word = v.word LEFT JOIN v o ON o.word = near.near GROUP BY v.word, v.n),
        forms AS MATERIALIZED (SELECT word, CASE WHEN m >= {p.ratio} * n THEN best END AS form, n, n_near, CASE WHEN m >= {p.ratio} * n THEN m END AS form_n FROM told),
        chain AS (SELECT word, word AS root, form AS next FROM forms UNION ALL
            SELECT c.word, c.next, f.form FROM chain c JOIN forms f ON f.word = c.next)
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, root FROM chain WHERE next IS NULL) USING (word)"""
