"""Operator 4: language by interpolated Kneser-Ney character models.

One model per language over the letters of words, each word between boundary marks
(contexts do not cross words). N-grams up to ``order`` are counted by Spark over the
training words; the highest order and n-grams at a word's start keep their counts,
lower orders count the different letters before them, and every order gives up an
absolute discount to the next lower one, down to a uniform share.

The model is a table of n-gram hashes in sorted order with one log-probability per
language, and one of context hashes with the log back-off weights, searched by
bisection. A text's language is that of the lowest cross-entropy per character; its
score is the posterior share of that language over ``score_chars`` characters at that
rate. ``rejected`` marks texts whose cross-entropy lies above the level that all but
``reject_share`` of the language's training documents keep.

Models learn from a bounded sample, by a hash of the id: about ``per_language`` documents of
every language, fewer of each where they would be over ``sample_docs`` in all; no language
that has documents is left out for being rare. Every whole text is scored.
A null text or one without a letter is ``und`` with score 0, as is every text if
there is nothing to learn from; ties go to the first language in alphabetical order.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civic_indicators.llm.common import fold, mix, q

EDGE, STOP = "\x02", "\x03"  # before and after a word
_MUL = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class LangParams:
    order: int = 5
    per_language: int = 2_000
    sample_docs: int = 400_000
    discount: float = 0.75
    score_chars: int = 40
    reject_share: float = 0.01


def clean(token: str) -> str:
    return token if token.isalpha() else "".join(filter(str.isalpha, token))


def gram_hashes(chars: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the windows of n characters, by their last one (the first n - 1 places unset)."""
    with np.errstate(over="ignore"):
        acc = np.zeros(len(chars) - n + 1, np.uint64)
        for j in range(n):
            acc = acc * _MUL + chars[j:len(chars) - n + 1 + j] + np.uint64(1)
        return mix(acc + np.uint64(n) * _MUL)


def _hash(gram: str) -> int:
    return int(gram_hashes(np.frombuffer(gram.encode("utf-32-le"), np.uint32).astype(np.uint64), len(gram))[0])


def build(counts: pd.DataFrame, p: LangParams):
    """(languages, gram hashes, log-probabilities, context hashes, log back-off, floor) from (lang, gram, n)
    rows: the grams of ``order`` letters and the shorter ones at a word's start."""
    langs = sorted(counts.lang.unique())
    letters = {g[-1] for g in counts.gram}
    floor = -np.log(len(letters) + 1)
    per = []
    for lang in langs:
        own = counts[counts.lang == lang]
        c: dict[str, float] = dict(zip(own.gram, own.n.astype(float)))
        for k in range(p.order, 1, -1):  # continuation counts of the next lower order
            for g in [g for g in c if len(g) == k]:
                low = g[1:]
                if not low.startswith(EDGE):
                    c[low] = c.get(low, 0.0) + 1.0
        ctx: dict[str, list[float]] = {}
        for g, n in c.items():
            t = ctx.setdefault(g[:-1], [0.0, 0.0])
            t[0] += n
            t[1] += 1
        per.append((c, ctx))
    grams = sorted({g for c, _ in per for g in c}, key=lambda g: (len(g), g))
    contexts = sorted({h for _, ctx in per for h in ctx})
    at = {g: i for i, g in enumerate(grams)}
    prob = np.empty((len(grams), len(langs)))
    back = np.zeros((len(contexts), len(langs)))
    for j, (c, ctx) in enumerate(per):
        for i, h in enumerate(contexts):
            if h in ctx:
                back[i, j] = np.log(p.discount * ctx[h][1] / ctx[h][0])
        for i, g in enumerate(grams):
            h = g[:-1]
            low = prob[at[g[1:]], j] if len(g) > 1 and g[1:] in at else np.exp(floor)
            if h in ctx:
                total, kinds = ctx[h]
                prob[i, j] = max(c.get(g, 0.0) - p.discount, 0.0) / total + p.discount * kinds / total * low
            else:
                prob[i, j] = low
    gh = np.array([_hash(g) for g in grams], np.uint64)
    ch = np.array([_hash(h) if h else 0 for h in contexts], np.uint64)
    a, b = np.argsort(gh), np.argsort(ch)
    return langs, gh[a], np.log(prob[a]).astype(np.float32), ch[b], back[b].astype(np.float32), floor


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of the keys in a sorted table, -1 where absent."""
    i = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[i] == keys, i, -1)


def word_scores(ws: list[str], model, order: int) -> np.ndarray:
    """Log-probability of each word and its end, per language."""
    langs, gh, lp, ch, back, floor = model
    text = "".join(EDGE + w + STOP for w in ws)
    chars = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    lens = np.fromiter((len(w) + 2 for w in ws), np.int64, len(ws))
    owner = np.repeat(np.arange(len(ws)), lens)
    pos = np.arange(len(chars)) - np.repeat(np.cumsum(lens) - lens, lens)  # place within the word
    out = np.zeros((len(chars), len(langs)), np.float32)
    todo = pos > 0  # the opening mark is given
    hashes = {n: gram_hashes(chars, n) for n in range(1, order + 1) if n <= len(chars)}
    empty = _find(ch, np.zeros(1, np.uint64))[0]
    for n in range(order, 0, -1):
        if n not in hashes:
            continue
        at = np.flatnonzero(todo & (pos >= n - 1))
        found = _find(gh, hashes[n][at - n + 1])
        hit = found >= 0
        out[at[hit]] += lp[found[hit]]
        todo[at[hit]] = False
        miss = at[~hit]
        if n > 1:
            c = _find(ch, hashes[n - 1][miss - n + 1])
            out[miss[c >= 0]] += back[c[c >= 0]]
        else:
            out[miss] += (back[empty] if empty >= 0 else 0) + np.float32(floor)
            todo[miss] = False
    total = np.zeros((len(ws), len(langs)))
    np.add.at(total, owner, out)
    return total


class WordTable:
    """Scores of the words met so far in a task; emptied when full."""

    LIMIT = 300_000

    def __init__(self, model, order: int):
        self.model, self.order = model, order
        self.reset()

    def reset(self) -> None:
        self.at: dict[str, int] = {}
        self.lp = np.zeros((1024, len(self.model[0])))
        self.n = np.zeros(1024, np.int64)  # characters, 0 for a token without a letter

    def add(self, tokens: list[str]) -> None:
        first, end = len(self.at), len(self.at) + len(tokens)
        while end > len(self.n):
            self.lp, self.n = np.concatenate([self.lp, np.zeros_like(self.lp)]), np.concatenate([self.n, np.zeros_like(self.n)])
        ws = [clean(t) for t in tokens]
        full = [i for i, w in enumerate(ws) if w]
        if full:
            self.lp[first + np.array(full)] = word_scores([ws[i] for i in full], self.model, self.order)
        self.n[first:end] = [len(w) + 1 if w else 0 for w in ws]
        self.at.update(zip(tokens, range(first, end)))

    def texts(self, texts: list[str | None]) -> list[tuple[np.ndarray, int]]:
        """Log-probabilities per language and characters of whole texts; tokens new to the task are scored together."""
        counts = [Counter((t or "").lower().split()) for t in texts]
        if len(self.at) > self.LIMIT:
            self.reset()
        new = [t for t in set().union(*counts) if t not in self.at]
        if new:
            self.add(new)
        out = []
        for count in counts:
            i = np.fromiter(map(self.at.__getitem__, count), np.int64, len(count))
            c = np.fromiter(count.values(), np.int64, len(count))
            out.append((c @ self.lp[i], int(c @ self.n[i])) if len(i) else (np.zeros(len(self.model[0])), 0))
        return out


def score_texts(docs: DataFrame, model, p: LangParams, text: str, *keep):
    """Columns lang_pred, score, ce, kept columns first."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = docs.select(*keep, q(text).alias("_t"))

    @F.pandas_udf("lang_pred string, score double, ce double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = WordTable(shared.value, p.order)
        langs = shared.value[0]
        for t in batches:
            rows, got, part, size = [], [], [], 0
            for x in t:  # so many characters at a time, one text at least
                part.append(x)
                size += len(x or "")
                if size > 400_000:
                    got += table.texts(part)
                    part, size = [], 0
            for lp, n in got + (table.texts(part) if part else []):
                if n == 0:
                    rows.append(("und", 0.0, None))
                    continue
                rate = lp / n
                best = int(rate.argmax())
                rows.append((langs[best], float(1 / np.exp((rate - rate[best]) * p.score_chars).sum()), float(-rate[best])))
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "ce"])

    return out.withColumn("_r", run("_t")).select(*[c for c in out.columns if c != "_t"], "_r.lang_pred", "_r.score", "_r.ce")


def train(docs: DataFrame, p: LangParams = LangParams(), text: str = "text", lang: str = "lang"):
    """(model, reject levels), or None when no document has a language and a letter."""
    own = docs.select(q("doc_id").cast("bigint").alias("doc_id"), q(text).alias("text"), q(lang).cast("string").alias("lang")).where(
        "lang is not null and text is not null")
    sizes = own.groupBy("lang").count().collect()  # a row per language
    if not sizes:
        return None
    each = min(p.per_language, max(1, p.sample_docs // len(sizes)))
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r.lang, min(1.0, each / r["count"]))])
    some = own.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * float(1 << 20))

    def grams(batches):
        total: Counter = Counter()
        for b in batches:
            for t, lg in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for tok, n in Counter(t.lower().split()).items():
                    w = clean(tok)
                    if w:
                        w = EDGE + w + STOP
                        for k in range(2, p.order):  # at the start of the word
                            if k <= len(w):
                                total[lg, w[:k]] += n
                        for i in range(len(w) - p.order + 1):
                            total[lg, w[i:i + p.order]] += n
            if len(total) > 200_000:
                yield out(total)
                total = Counter()
        yield out(total)

    def out(total):
        return pa.record_batch({"lang": pa.array([k[0] for k in total], pa.string()), "gram": pa.array([k[1] for k in total], pa.string()),
                                "n": pa.array(list(total.values()), pa.int64())})

    counts = some.select("text", "lang").mapInArrow(grams, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    if not len(counts):
        return None
    model = build(counts, p)
    ce = score_texts(some, model, p, "text", F.col("lang")).where("ce is not null and lang_pred = lang")
    levels = {r.lang: r.level for r in ce.groupBy("lang").agg(F.percentile_approx("ce", 1 - p.reject_share, 10_000).alias("level")).collect()}
    return model, levels


def identify(docs: DataFrame, folds: int = 3, out: int = 1, p: LangParams = LangParams(), text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row of ``docs``."""
    got = train(docs.where(fold(q("doc_id").cast("bigint"), folds) != out), p, text, lang)
    doc_id = q("doc_id").cast("bigint").alias("doc_id")
    if got is None:
        scored = docs.select(doc_id, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    else:
        model, levels = got
        level = F.create_map(*[F.lit(x) for k, v in sorted(levels.items()) for x in (k, v)]) if levels else F.create_map().cast("map<string,double>")
        scored = score_texts(docs, model, p, text, doc_id).select(
            "doc_id", "lang_pred", "score", (F.col("ce").isNull() | (F.col("ce") > F.coalesce(F.try_element_at(level, F.col("lang_pred")), F.lit(0.0)))).alias("rejected"))
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == out).alias("held_out"), "lang_pred", "score", "rejected")
