"""Operator 10: toxicity by a subsequence string kernel machine with Nystroem landmarks.

Units are the words of a text, with punctuation inside them removed and runs of
single letters joined, so "i.d.i.o.t" and "i d i o t" are the unit "idiot"; each unit
is a string over 38 letter classes (digits that stand for letters are folded) between
two boundary marks.

The kernel of two units is the gap-weighted subsequence kernel of length 4: every
common, possibly gapped, run of four letters counts lambda ** (span in one + span in
the other), spans up to ``MAX_SPAN``, divided by both units' norms. Inserted or
swapped characters cost a factor per gap instead of the whole match.

Training. The distinct sentences of labelled documents carry their document's label,
clean if any clean document holds the same sentence, and hand it on to their units. A
linear SVM (squared hinge) on the units' Nystroem coordinates over landmark units learns to
tell units that lean clearly to toxic sentences from units that do not; those of the
former that it places among the latter are dropped and it is fitted again. The decision is linear in the
kernel, so it folds into one weight per letter run, and scoring needs no landmark.

A document scores by the decisions of its most toxic units over its whole text, a unit as
often as it occurs: by the largest and a quarter of the second, or by the second and a quarter
of the third, whichever a logistic fit explains the training documents better with. The
latter wins where clean documents hold single words that look like insults: one is not
believed, the same insult twice is. The fit maps the decision to a probability. Null and empty texts have
no unit and get the score of the least toxic unit; without both labels all scores are 0.
Several labels of one document: the largest counts; null labels do not count.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import nlargest

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civic_indicators.llm.common import bounded_ids, fold, q
from civic_indicators.llm.quality import fit_logistic

LAMBDA, MAX_SPAN, WIDTH, STRIDE = 0.5, 8, 32, 16
A = 40  # 38 letter classes, the boundary mark and the padding
# Characters written in place of letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_JUNK = re.compile(r"[\W_]+")
_SPACED = re.compile(r"(?<!\w)\w(?:[\W_]+\w(?!\w)){2,}")
_SENTENCE = re.compile(r"[.!?\n]+")
_FOLD = str.maketrans(LOOKALIKES)


def raw_units(text: str | None) -> Counter[str]:
    """The words of a text and its joined runs of single letters, lower case, with how often they occur."""
    t = (text or "").lower()
    found = Counter(t.split())
    found.update(_SPACED.findall(t))
    return found


def in_context(text: str | None) -> Iterator[tuple[str, str]]:
    """Each word, and each joined run, of a text with the words next to it."""
    t = (text or "").lower()
    w = t.split()
    for before, x, after in zip(["", *w], w, [*w[1:], ""]):
        yield x, f"{before} {after}"
    for x in _SPACED.findall(t):
        yield x, t


def unit(raw: str) -> str:
    return _JUNK.sub("", raw.translate(_FOLD))


def codes(units: list[str]) -> np.ndarray:
    """Letter classes between boundary marks, one padded row per unit of at most WIDTH letters."""
    lens = np.fromiter(map(len, units), np.int64, len(units))
    out = np.full((len(units), max(2, int(lens.max(initial=0))) + 2), A - 1, np.int64)
    flat = np.frombuffer("".join(units).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    rows = np.arange(len(units))
    out[:, 0] = out[rows, lens + 1] = A - 2
    out[np.repeat(rows, lens), np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens) + 1] = (
        np.where((flat >= 97) & (flat <= 122), flat - 97, 26 + flat % 12))
    return out


_GAPS = [(d, e, f) for d in range(1, MAX_SPAN) for e in range(1, MAX_SPAN) for f in range(1, MAX_SPAN) if d + e + f < MAX_SPAN]


def runs(c: np.ndarray):
    """(ids of the gapped letter runs, weight) for each triple of gaps: one column per start."""
    n = c.shape[1]
    for d, e, f in _GAPS:
        s = d + e + f
        if s < n:
            yield ((c[:, :n - s] * A + c[:, d:n - e - f]) * A + c[:, d + e:n - f]) * A + c[:, s:], LAMBDA ** (s + 1)


def _norms() -> np.ndarray:
    out = np.ones(WIDTH + 3)
    for n in range(4, WIDTH + 3):
        out[n] = np.sqrt(sum((n - sum(g)) * LAMBDA ** (2 * (sum(g) + 1)) for g in _GAPS if sum(g) < n))
    return out


NORM = _norms()


def lengths(c: np.ndarray) -> np.ndarray:
    return (c != A - 1).sum(1)


def fold_weights(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Sum of the runs' weights over each unit's norm; ``table`` has a value per run, 0 where padded."""
    out = np.zeros(len(c))
    for ids, weight in runs(c):
        out += weight * table[ids].sum(1)
    return out / NORM[lengths(c)]


class Landmarks:
    """Kernels to a few units, over the letter runs that these have."""

    def __init__(self, c: np.ndarray):
        found = [(ids, w) for ids, w in runs(c)]
        pad = (A - 1)
        valid = [((ids % A != pad) & (ids // A % A != pad) & (ids // A ** 2 % A != pad) & (ids // A ** 3 != pad)) for ids, _ in found]
        self.ids = np.unique(np.concatenate([i[v] for (i, _), v in zip(found, valid)]))
        self.table = np.zeros((len(self.ids) + 1, len(c)), np.float32)  # the last row: runs of no landmark
        for (ids, w), v in zip(found, valid):
            row, _ = np.nonzero(v)
            np.add.at(self.table, (np.searchsorted(self.ids, ids[v]), row), w)
        self.table /= NORM[lengths(c)].astype(np.float32)
        self.where = np.full(A ** 4, len(self.ids), np.int32)
        self.where[self.ids] = np.arange(len(self.ids))

    def kernel(self, c: np.ndarray) -> np.ndarray:
        out = np.zeros((len(c), self.table.shape[1]), np.float32)
        for ids, w in runs(c):
            at = self.where[ids]
            row, col = np.nonzero(at < len(self.ids))
            if len(row):
                np.add.at(out, row, np.float32(w) * self.table[at[row, col]])
        return out / NORM[lengths(c)][:, None].astype(np.float32)

    def folded(self, weights: np.ndarray) -> np.ndarray:
        """One value per letter run, so that a unit's decision is a sum over its runs."""
        g = np.zeros(A ** 4, np.float32)
        g[self.ids] = self.table[:-1] @ weights.astype(np.float32)
        return g


@dataclass(frozen=True)
class ToxicityParams:
    max_labelled: int = 4_000   # per label: the sample the machine is fitted on
    landmarks: int = 192
    max_units: int = 30_000     # per label
    ridge: float = 1e-4
    rounds: int = 3
    lean: float = 4.0           # standard errors above the usual share of toxic sentences
    clean_weight: float = 4.0


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Linear SVM with squared hinge loss, weighted, by Newton steps; last weight: offset."""
    x = np.hstack([x, np.ones((len(x), 1))])
    reg = ridge * weight.sum() * np.eye(x.shape[1])
    reg[-1, -1] *= 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(30):
        m = 1 - y * (x @ w)
        on = m > 0
        xa, wa = x[on], weight[on]
        new = np.linalg.solve((xa * wa[:, None]).T @ xa + reg, xa.T @ (wa * y[on]))
        if np.abs(new - w).max() < 1e-6:
            return new
        w = new
    return w


def fit_units(stats: pd.DataFrame, p: ToxicityParams) -> tuple[np.ndarray, float]:
    """Weights of the letter runs and offset, from (unit, toxic, clean) sentence counts."""
    stats = stats.drop_duplicates("unit").sort_values("unit").reset_index(drop=True)
    t, n = stats.toxic.to_numpy(float), stats.clean.to_numpy(float)
    if not t.sum() or not n.sum():
        return np.zeros(A ** 4, np.float32), -1.0
    c = codes(stats.unit.tolist())
    base = t.sum() / (t.sum() + n.sum())
    lean = (t - base * (t + n)) / np.sqrt(base * (1 - base) * (t + n) + 1)  # how far a unit leans to toxic sentences
    # Landmarks: two thirds from the units that lean most, each unlike those before; the rest the commonest.
    order = np.argsort(-lean, kind="stable")[:1500]
    near, chosen = np.zeros(len(order)), []
    for i in range(len(order)):
        if len(chosen) < 2 * p.landmarks // 3 and lean[order[i]] > 1 and near[i] < 0.7:
            chosen.append(order[i])
            near = np.maximum(near, Landmarks(c[order[i:i + 1]]).kernel(c[order])[:, 0])
    taken = set(chosen)
    chosen += [i for i in np.argsort(-(t + n), kind="stable")[:2 * p.landmarks] if i not in taken][:p.landmarks - len(chosen)]
    marks = Landmarks(c[chosen])
    kmm = marks.kernel(c[chosen]).astype(np.float64)
    val, vec = np.linalg.eigh((kmm + kmm.T) / 2)
    root = vec[:, val > 1e-5] / np.sqrt(val[val > 1e-5])
    x = np.concatenate([marks.kernel(c[i:i + 1000]) for i in range(0, len(c), 1000)]) @ root
    # Witnesses lean clearly to toxic sentences; the rest of a toxic sentence says nothing.
    pos, neg = lean >= p.lean, (n > 0) & (lean < 1)
    w = np.zeros(x.shape[1] + 1)
    for _ in range(p.rounds):
        use = pos | neg
        if not pos.any() or not neg.any():
            return np.zeros(A ** 4, np.float32), -1.0
        weight = np.where(pos, np.sqrt(t), np.sqrt(n))
        weight = np.where(pos, weight / weight[pos].sum(), p.clean_weight * weight / weight[neg].sum())
        w = svm(x[use], np.where(pos, 1.0, -1.0)[use], weight[use], p.ridge)
        kept = pos & (x @ w[:-1] + w[-1] > -0.5)
        if not kept.any() or (kept == pos).all():
            break
        pos = kept
    return marks.folded(root @ w[:-1]), float(w[-1])


def unit_scores(units: list[str], g: np.ndarray, offset: float) -> np.ndarray:
    """The machine's decision per unit; a long unit is scored in overlapping windows, the largest counts."""
    parts, owner = [], []
    for i, u in enumerate(units):
        if len(u) < 3:
            continue
        for j in range(0, max(1, len(u) - WIDTH + STRIDE), STRIDE) if len(u) > WIDTH else (0,):
            parts.append(u[j:j + WIDTH])
            owner.append(i)
    out = np.full(len(units), offset)
    if parts:
        order = np.argsort([len(x) for x in parts], kind="stable")
        got = np.empty(len(parts))
        for k in range(0, len(order), 4096):
            idx = order[k:k + 4096]
            got[idx] = fold_weights(g, codes([parts[i] for i in idx])) + offset
        best = np.full(len(units), -np.inf)
        np.maximum.at(best, owner, got)
        out = np.where(np.isfinite(best), best, out)
    return out


class UnitScores(dict):
    """Scores of the units met so far in a task; emptied when full."""

    LIMIT = 500_000

    def __init__(self, g, offset):
        super().__init__()
        self.g, self.offset = g, offset

    def best(self, texts: list[str | None]) -> list[tuple[float, float]]:
        """Each text's decisions; the units new to the task are scored together."""
        raw = [raw_units(t) for t in texts]
        if len(self) > self.LIMIT:
            self.clear()
        new = [r for r in set().union(*raw) if r not in self]
        if new:
            self.update(zip(new, unit_scores([unit(r) for r in new], self.g, self.offset).tolist()))
        return [self._of(x) for x in raw]

    def _of(self, found: Counter[str]) -> tuple[float, float]:
        return document_scores([s for s, n in nlargest(3, ((self[r], n) for r, n in found.items())) for _ in range(min(n, 3))], self.offset)


def document_scores(top: list[float], offset: float) -> tuple[float, float]:
    """From the largest decisions of a document's unit occurrences, in falling order: by the largest, by the second."""
    one, two, three = [min(max(x, 0.0), 1.0) for x in [*top, offset, offset, offset][:3]]
    order = min(max(top[0] if top else offset, -2.0), 2.0) / 100
    return one + two / 4 + order, two + three / 4 + order


def decisions(docs: DataFrame, model, text: str) -> Column:
    """An array: a document's score by its largest unit, and by its second."""
    shared = docs.sparkSession.sparkContext.broadcast(model[:2])

    @F.pandas_udf("array<double>")
    def best(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = None
        for t in batches:
            if known is None:
                known = UnitScores(*shared.value)
            out, part, size = [], [], 0
            for x in t:  # so many characters at a time, one text at least
                part.append(x)
                size += len(x or "")
                if size > 400_000:
                    out += known.best(part)
                    part, size = [], 0
            yield pd.Series(out + (known.best(part) if part else []), dtype="object")

    return best(q(text))


def train(docs: DataFrame, labels: DataFrame, p: ToxicityParams = ToxicityParams(), text: str = "text"):
    """(run weights, offset, slope, shift, 0 or 1: by the largest or by the second unit), or None without documents of both labels."""
    labelled = labels.where("y in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("y").cast("int").alias("y"))
    share = {r.y: r["count"] for r in labelled.groupBy("y").count().collect()}
    if len(share) < 2:
        return None
    sample = (bounded_ids(labelled.where("y = 1"), p.max_labelled, "y")
              .union(bounded_ids(labelled.where("y = 0"), p.max_labelled, "y")))
    own = docs.select(q("doc_id").cast("bigint").alias("doc_id"), q(text).alias("text")).join(F.broadcast(sample), "doc_id").select("text", "y")

    def sentences(batches):
        for b in batches:
            for i in range(0, len(b), 200):
                part = b.slice(i, 200)
                s, y = [], []
                for t, lab in zip(*(part.column(k).to_pylist() for k in range(2))):
                    own_s = {x for x in _SENTENCE.split((t or "").lower()) if x.strip()}
                    s += own_s
                    y += [lab] * len(own_s)
                yield pa.record_batch({"s": pa.array(s, pa.string()), "y": pa.array(y, pa.int32())})

    def units(batches):
        for b in batches:
            u, at, y = [], [], []
            for s, lab in zip(*(b.column(k).to_pylist() for k in range(2))):
                mine = {(unit(x), where) for x, where in in_context(s)}
                mine = [x for x in mine if 3 <= len(x[0]) <= WIDTH]
                u += [x for x, _ in mine]
                at += [where for _, where in mine]
                y += [lab] * len(mine)
            yield pa.record_batch({"unit": pa.array(u, pa.string()), "at": pa.array(at, pa.string()), "y": pa.array(y, pa.int32())})

    # A context counts once, so that copies of a passage, edited or not, don't make its words lean.
    each = own.mapInArrow(sentences, "s string, y int").groupBy("s").agg(F.min("y").alias("y"))
    stats = (each.mapInArrow(units, "unit string, at string, y int").groupBy("unit", "at").agg(F.min("y").alias("y")).groupBy("unit")
             .agg(F.sum("y").alias("toxic"), F.sum(F.lit(1) - F.col("y")).alias("clean")))
    few = (stats.where("toxic > 0").orderBy(F.desc("toxic"), "unit").limit(p.max_units)
           .union(stats.where("clean > 0").orderBy(F.desc("clean"), "unit").limit(p.max_units // 6))
           .union(stats.where("clean > 0").orderBy(F.xxhash64("unit"), "unit").limit(p.max_units))).toPandas()
    g, offset = fit_units(few, p)
    got = own.select(decisions(own, (g, offset), "text").alias("f"), "y").toPandas()
    y, f = got.y.to_numpy(float), np.array(got.f.tolist(), float).reshape(-1, 2)
    n1, n0 = max(1, y.sum()), max(1, (1 - y).sum())
    weight = np.where(y > 0, share[1] / n1, share[0] / n0)
    weight *= len(y) / max(weight.sum(), 1e-9)
    fits = [fit_logistic(f[:, k], y, weight) for k in (0, 1)]
    loss = [(weight * np.logaddexp(0, np.where(y > 0, -1, 1) * (f[:, k] * a + b))).sum() for k, (a, b) in enumerate(fits)]
    by = int(loss[1] < 0.9 * loss[0])
    return g, offset, *fits[by], by


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 3, out: int = 1, threshold: float = 0.7,
             p: ToxicityParams = ToxicityParams(), text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    y = labels.select(q("doc_id").cast("bigint").alias("doc_id"), q("toxic").alias("y"))
    own = fold(F.col("doc_id"), folds) != out
    model = train(docs.where(fold(q("doc_id").cast("bigint"), folds) != out), y.where(own), p, text)
    if model is None:
        score = F.lit(0.0)
    else:
        *_, a, b, by = model
        score = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), decisions(docs, model, text)[by] * a + F.lit(b)))))
    scored = docs.select(q("doc_id").cast("bigint").alias("doc_id"), score.alias("score"))
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == out).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
