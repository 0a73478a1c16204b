"""Operator 9: language-model scoring by online logistic context mixing.

A text is the sequence of its words and one end. Each token is coded as bits along a
Huffman tree of the training tokens: the commonest have a leaf each, the others share an
escape leaf, whose share includes what words met once say about unknown ones. Behind
it, a training word has its share of the rare tokens, and an unknown word is spelled,
byte by byte, along a second tree.

A bit is predicted by three predictors: the tree node's own share, and two counters in
fixed-size hashed tables, keyed by the node with the previous token and with the previous
two (in spelling: two and four bytes). The predictions are mixed in the logistic domain
by weights chosen by a gate (depth in the tree, or place in the spelling). The weights
start from values fitted to every bit of every training text, each bit's own count left out
(Newton steps on sums that each task gathers), and those of tokens are refined while a text is read, after every ``block`` tokens. Every bit of a code is
mixed, unless ``depth`` is set: bits deeper than that take the tree's share alone.

The sum of the log-probabilities over the tokens is the score. It stands beside the base
score and has the same events: all unknown words are one kind of token. Adding what it
takes to spell them gives the whole text's log-probability, from which the bits per byte
follow.

What is gathered covers every training text: token counts (by 64-bit token hash,
exact up to hash collisions), the counters' bit counts, which each task sums in
tables of a fixed size, and the sums the starting weights are fitted to. For the last
two and the scores, texts are read as token numbers from a table that is written once;
equal bytes after equal bytes in spelled words are one event, with how often it is met. Broadcast are only tables of fixed size: at most ``2**log2_words``
word counts, as many codes as ``2**log2_codes``, and the counters. Counts of rarer words
meet the texts that hold them through a join.

Null texts count as empty: one token, the end. Rows without an id are not learned
from. With nothing to learn from, the base score uses counts of 0 and the trees are those
of the bytes alone. Repeated rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civic_indicators.llm.common import fold, q, stage, words

END = b""  # the end token; no word is empty
LOG10 = np.log(10.0)
START = np.array([0.9, 0.1, 0.1, 0.0])  # weights before they are fitted: the tree's share, the two counters, the constant


@dataclass(frozen=True)
class LmParams:
    log2_words: int = 19
    log2_codes: int = 17
    log2_slots: int = 20
    depth: int | None = None
    block: int = 256
    fit_rounds: int = 2
    rate: float = 0.3


def huffman(counts: np.ndarray):
    """(parent, bit, weight) of the nodes of a Huffman tree; nodes below len(counts) are the leaves,
    the last node is the root. Two queues over the sorted counts."""
    n = len(counts)
    order = np.argsort(counts, kind="stable")
    w = np.zeros(2 * n - 1, np.float64)
    w[:n] = counts
    parent, bit = np.full(2 * n - 1, -1, np.int64), np.zeros(2 * n - 1, np.int8)
    leaf, made, weight = 0, n, w.tolist()
    queue, order = n, order.tolist()
    for made in range(n, 2 * n - 1):
        for b in (0, 1):
            if leaf < n and (queue >= made or weight[order[leaf]] <= weight[queue]):
                x = order[leaf]
                leaf += 1
            else:
                x = queue
                queue += 1
            parent[x], bit[x] = made, b
            weight[made] += weight[x]
    return parent, bit, np.array(weight)


def tree(counts: np.ndarray, depth: int | None = None):
    """Coding tables: nodes and bits from the root down to ``depth``, all levels if None (-1 beyond a leaf), the
    log of the share below that, and each inner node's log odds of a 1."""
    n = len(counts)
    parent, bit, weight = huffman(np.maximum(counts, 1e-9))
    level = np.zeros(2 * n - 1, np.int64)
    for x in range(2 * n - 3, -1, -1):
        level[x] = level[parent[x]] + 1
    depth = depth or max(int(level[:n].max()), 1)
    nodes, bits = np.full((n, depth), -1, np.int32), np.zeros((n, depth), np.int8)
    x = np.arange(n)
    stop = np.full(n, 2 * n - 2)
    live = level[:n] > 0
    while live.any():
        i = np.flatnonzero(live)
        up = parent[x[i]]
        d = level[up]
        stop[i[d == depth]] = up[d == depth]
        low = d < depth
        nodes[i[low], d[low]] = up[low] - n
        bits[i[low], d[low]] = bit[x[i]][low]
        x[i] = up
        live[i] = d > 0
    deep = np.where(level[:n] > depth, np.log(np.maximum(weight[:n], 1e-9)) - np.log(weight[stop]), 0.0)
    odds = np.zeros(n, np.float32)  # by inner node
    kids = np.flatnonzero(parent >= 0)
    sign = np.where(bit[kids] == 1, 1.0, -1.0)
    np.add.at(odds, parent[kids] - n, (sign * np.log(weight[kids])).astype(np.float32))
    return nodes, bits, deep, odds


def word_hash(w: bytes) -> int:
    return xxhash.xxh3_64_intdigest(w)


class Model:
    """The broadcast tables; token sequences and coding steps made from them."""

    def __init__(self, arrays: dict, p: LmParams):
        self.p = p
        self.__dict__.update(arrays)  # hashes, counts, symbol, escape, word tree w_*, byte tree b_*
        self.gates = p.depth + 4
        self.mask = np.uint32((1 << p.log2_slots) - 1)
        self.words = _by_level(self.w_nodes, self.w_bits, self.w_odds)
        self.bytes = _by_level(self.b_nodes, self.b_bits, self.b_odds)

    def slots(self, context: np.ndarray, node: np.ndarray, half: int) -> np.ndarray:
        """``node``: multiplied already, see _by_level; ``half``: where the table's part begins."""
        x = context ^ node
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(15)
        x &= self.mask
        if half:
            x += np.uint32(half)
        return x.astype(np.int64)

    def tokens(self, ident: np.ndarray, lens: np.ndarray):
        """Texts' tokens one after the other, by their places: leaf, contexts of one and of two tokens."""
        starts = np.cumsum(lens) - lens
        p1 = np.r_[-2, ident[:-1]]
        p2 = np.r_[-2, p1[:-1]]
        p1[starts] = -2
        p2[starts] = -2
        p2[starts[lens > 1] + 1] = -2
        leaf = self.symbol[ident]
        h1 = (p1.astype(np.uint32) + np.uint32(3)) * np.uint32(0xCC9E2D51)
        h1 ^= h1 >> np.uint32(16)
        h2 = (h1 * np.uint32(0x1B873593)) ^ ((p2.astype(np.uint32) + np.uint32(77)) * np.uint32(0xE6546B64))
        h2 ^= h2 >> np.uint32(13)
        return leaf, h1, h2

    def spelling(self, keys: np.ndarray):
        """Bytes of spelled words (see spelled): byte, contexts of two and of four bytes, gate."""
        b, gate, prev = keys >> 8 & 255, keys & 255, (keys >> 16).astype(np.uint32)
        h1 = ((prev & np.uint32(0xFFFF)) + np.uint32(257)) * np.uint32(0xCC9E2D51)
        h1 ^= h1 >> np.uint32(16)
        h2 = prev * np.uint32(0x1B873593) + np.uint32(5)
        h2 ^= h2 >> np.uint32(16)
        return b, h1, h2, self.p.depth + gate

    def steps(self, levels, leaf: np.ndarray, h1: np.ndarray, h2: np.ndarray, half: int):
        """The events in the order of their leaves, those of the longest codes first, and their steps, one a level:
        (how many, the first so many; bit; leaf; the tree's odds; slot 1; slot 2)."""
        rank, size, table = levels
        key = rank[leaf]
        order = np.argsort(key)
        leaf, h1, h2 = leaf[order].astype(np.int64), h1[order], h2[order]
        live = np.searchsorted(key[order], size)

        def each():
            for n, (node, bit, odds) in zip(live.tolist(), table):
                if not n:
                    return
                of = leaf[:n]
                at = node[of]
                yield n, bit[of], of, odds[of], self.slots(h1[:n], at, half), self.slots(h2[:n], at, half)

        return order, each()


def _by_level(nodes: np.ndarray, bits: np.ndarray, odds: np.ndarray):
    """Each leaf's rank, longest codes first; per level how many leaves have it; and per level and leaf: node (its
    part of the slots' hash), bit, the node's log odds."""
    long = (nodes >= 0).sum(1)
    rank = np.empty(len(nodes), np.int32)
    rank[np.argsort(-long, kind="stable")] = np.arange(len(nodes), dtype=np.int32)
    size, table = [], []
    for k in range(nodes.shape[1]):
        n = np.ascontiguousarray(nodes[:, k])
        if (n < 0).all():
            break
        size.append(int((long > k).sum()))
        table.append((n.astype(np.uint32) * np.uint32(0x9E3779B1), np.ascontiguousarray(bits[:, k]), np.where(n >= 0, odds[n], 0).astype(np.float32)))
    return rank, np.array(size, np.int32), table


def _left_out(odds: np.ndarray, at: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """A counter's log odds less the event itself, from ``left_out_odds``."""
    return odds[2 * at + bit]


def left_out_odds(counts: np.ndarray) -> np.ndarray:
    """Of every slot's counts (n, 2): the log odds less one event of bit 0, less one of bit 1."""
    less, all_ = np.log(np.maximum(counts - 1, 0) + np.float32(0.4)), np.log(counts + np.float32(0.4))
    out = np.empty_like(all_)
    np.subtract(all_[:, 1], less[:, 0], out=out[:, 0])
    np.subtract(less[:, 1], all_[:, 0], out=out[:, 1])
    return out.ravel()


def _code(w: np.ndarray, who: np.ndarray, step, tables, rate: float, cost: np.ndarray) -> None:
    """One step over events of the texts ``who``: mix by the weights of each one's text (or by the only ones there
    are), add the costs, move the weights down the gradient."""
    _, bit, _, s0, a, b = step
    s = (s0, tables[0][a], tables[1][b])
    v = w.take(who, axis=0) if w.ndim == 2 else w
    x = v[..., 3] * np.float32(-0.3)
    for j in range(3):
        x = x - v[..., j] * s[j]
    sign = (2 * bit - 1).astype(np.float32)
    x *= sign
    np.clip(x, -30, 30, out=x)
    e = np.exp(x, out=x)
    one = e + np.float32(1)
    cost += np.bincount(who, np.log(one), len(cost))
    if rate:
        sign *= e
        g = np.divide(sign, one, out=sign)
        sums = np.stack([*(np.bincount(who, g * s[j], len(cost)) for j in range(3)), 0.3 * np.bincount(who, g, len(cost))], 1)
        w += rate * sums / (np.bincount(who, minlength=len(cost)) + 32.0)[:, None]


def mix_texts(m: Model, tables, start: np.ndarray, ident: np.ndarray, lens: np.ndarray, most: int = 256) -> np.ndarray:
    """Log-probability of each text's tokens, escapes not spelled; each text refines its own weights from ``start``.
    Texts of like length are read side by side, ``most`` at a time."""
    leaf, h1, h2 = m.tokens(ident, lens)
    begin = np.cumsum(lens) - lens
    score = np.bincount(np.repeat(np.arange(len(lens)), lens), m.w_deep[leaf], minlength=len(lens))
    by_length = np.argsort(-lens, kind="stable")
    for i in range(0, len(lens), most):
        some = by_length[i:i + most]
        w = np.repeat(start[:, None].astype(np.float32), len(some), 1)  # by gate and text
        cost = np.zeros(len(some))
        for first in range(0, int(lens[some].max()), m.p.block):
            size = np.clip(lens[some] - first, 0, m.p.block)
            at = np.repeat(begin[some] + first - (np.cumsum(size) - size), size) + np.arange(size.sum())
            order, steps = m.steps(m.words, leaf[at], h1[at], h2[at], 0)
            who = np.repeat(np.arange(len(some)), size)[order]
            for k, step in enumerate(steps):
                _code(w[k], who[:step[0]], step, tables, m.p.rate, cost)
        score[some] -= cost
    return score


def spelled(text: np.ndarray) -> np.ndarray:
    """Every byte of words that end in a blank each, with what its prediction depends on: the four bytes before it in
    the word, itself (0 for the blank) and the gate by its place, in 32, 8 and 8 bits."""
    end = text == 32
    lens = np.diff(np.r_[-1, np.flatnonzero(end)])
    pos = np.arange(len(text)) - np.repeat(np.cumsum(lens) - lens, lens)
    b = np.where(end, 0, text).astype(np.int64)
    out = b << 8 | np.minimum(pos, 3)
    for k in (1, 2, 3, 4):
        out[k:] |= np.where(pos[k:] >= k, b[:-k], 0) << 8 * (k + 1)
    return out


def spelled_steps(m: Model, keys: np.ndarray):
    """The steps of spelled bytes, apart by gate: (gate, which bytes, step)."""
    b, h1, h2, gate = m.spelling(keys)
    for k in range(m.p.depth, m.gates):  # by place in the word
        pick = np.flatnonzero(gate == k)
        if len(pick):
            order, steps = m.steps(m.bytes, b[pick], h1[pick], h2[pick], 1 << m.p.log2_slots)
            for step in steps:
                yield k, pick[order[:step[0]]], step


def spell_words(m: Model, tables, w: np.ndarray, ws: list[bytes]) -> np.ndarray:
    """Log-probability of each word's spelling."""
    out = np.zeros(len(ws))
    w = w.astype(np.float32)
    for i in range(0, len(ws), 5_000):
        some = ws[i:i + 5_000]
        lens = np.fromiter(map(len, some), np.int64, len(some)) + 1
        keys = spelled(np.frombuffer(b"".join(x + b" " for x in some), np.uint8))
        who = np.repeat(np.arange(len(some)), lens)
        cost = -np.bincount(who, m.b_deep[keys >> 8 & 255], minlength=len(some))
        for k, at, step in spelled_steps(m, keys):
            _code(w[k], who[at], step, tables, 0.0, cost)
        out[i:i + 5_000] = -cost
    return out


def _slope(odds, w: np.ndarray, step, times: np.ndarray | None = None) -> np.ndarray:
    """Of the events of a step (``times`` so often each) under weights ``w``: the gradient of their log-probability (4)
    and its negative curvature (4 x 4), both as sums, and how many they are."""
    _, bit, _, s0, a, b = step
    s = np.empty((4, len(bit)), np.float32)
    s[0], s[1], s[2], s[3] = s0, _left_out(odds[0], a, bit), _left_out(odds[1], b, bit), 0.3
    x = -w.astype(np.float32) @ s
    np.clip(x, -30, 30, out=x)
    p = np.exp(x, out=x)
    p += np.float32(1)
    np.reciprocal(p, out=p)
    g, h = bit - p, p * (1 - p)
    if times is not None:
        g, h = g * times, h * times
    return np.r_[s @ g, ((s * h) @ s.T).ravel(), len(bit) if times is None else times.sum()]


SUMS = 21  # what _slope returns


def newton(w: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Each gate's weights after a Newton step, held near ``w`` as if by 32 more events; no weight moves by over 1
    (a node's own share says little in a tree whose bits are near even, so its weight is hardly determined)."""
    move = np.stack([np.linalg.solve(x[4:20].reshape(4, 4) + 2.0 * np.eye(4), x[:4]) for x in sums])
    return w + np.clip(move, -1.0, 1.0)


def fit(train: DataFrame, spelling: DataFrame, shared, counters, p: LmParams) -> np.ndarray:
    """Starting weights of every gate, fitted to all training texts with each event's own count left out."""
    gates = p.depth + 4
    w = START * np.ones((gates, 1))
    for _ in range(p.fit_rounds):
        now = w.copy()

        def out(sums):
            gate, place = np.nonzero(sums)
            return pa.record_batch({"gate": pa.array(gate, pa.int64()), "place": pa.array(place, pa.int64()), "x": pa.array(sums[gate, place])})

        def tokens(batches):
            m, sums = Model(shared.value, p), np.zeros((gates, SUMS))
            for leaf, h1, h2 in _token_runs(batches, m):
                for k, step in enumerate(m.steps(m.words, leaf, h1, h2, 0)[1]):
                    sums[k] += _slope(counters.value, now[k], step)
            yield out(sums)

        def letters(batches):
            m, sums = Model(shared.value, p), np.zeros((gates, SUMS))
            for keys, n in _spelled_runs(batches):
                for k, at, step in spelled_steps(m, keys):
                    sums[k] += _slope(counters.value, now[k], step, n[at].astype(np.float32))
            yield out(sums)

        total = np.zeros((gates, SUMS))
        schema = "gate bigint, place bigint, x double"
        got = train.select("ids").mapInArrow(tokens, schema).union(spelling.mapInArrow(letters, schema))
        for r in got.groupBy("gate", "place").agg(F.sum("x").alias("x")).collect():  # 21 numbers a gate
            total[r.gate, r.place] = r.x
        w = newton(w, total)
    return w


def _texts(ids: pa.Array, most: int = 400_000):
    """(rows from, to, places of all their tokens, lengths) over a column of ``ids``, by tokens (one text at least)."""
    raw = ids.to_pylist()
    lens = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
    ends, at = np.cumsum(lens), 0
    while at < len(raw):
        to = max(at + 1, int(np.searchsorted(ends, most + ends[at] - lens[at], "right")))
        yield at, to, np.frombuffer(b"".join(raw[at:to]), np.int32), lens[at:to]
        at = to


def _token_runs(batches, m: Model, most: int = 100_000):
    """Leaves and contexts of all tokens, so many at a time."""
    for batch in batches:
        for _, _, ident, lens in _texts(batch.column(0)):
            all_ = m.tokens(ident, lens)
            for i in range(0, len(ident), most):
                yield tuple(x[i:i + most] for x in all_)


def _spelled_runs(batches, most: int = 100_000):
    """Spelled bytes and how often each is met, so many at a time."""
    for batch in batches:
        keys, n = (batch.column(c).to_numpy() for c in (0, 1))
        for i in range(0, len(keys), most):
            yield keys[i:i + most], n[i:i + most]


class _Numbers(dict):
    """Words numbered as they are met; ``words`` has them in that order, a blank after each."""

    def __init__(self):
        super().__init__()
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self)
        self.words.append(word + b" ")
        return i


def coded_texts(own: DataFrame, shared) -> DataFrame:
    """Every text cut into tokens once: their places among the known words (-1 if rare) as 32-bit integers, the text's
    bytes, and the words met at most twice or too rare to be in the table of counts, a blank after each."""
    def run(batches):
        hashes = shared.value["hashes"]
        few = np.r_[shared.value["counts"] <= 2, True]  # the last for place -1
        number, place = _Numbers(), np.zeros(0, np.int32)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                some = batch.slice(at, 200)
                texts = some.column("t").to_pylist()
                if len(number) > 400_000:
                    number, place = _Numbers(), place[:0]
                ws = [np.fromiter(map(number.__getitem__, [*words(t), END]), np.int64) for t in texts]
                new = number.words[len(place):]
                h = np.fromiter((word_hash(w[:-1]) for w in new), np.uint64, len(new))
                order = np.argsort(h)  # keys in order are found faster
                i = np.searchsorted(hashes, h[order])
                i[i == len(hashes)] = 0
                found = np.empty(len(new), np.int32)
                found[order] = np.where(hashes[i] == h[order], i, -1) if len(hashes) else -1
                place = np.r_[place, found]
                ids = [place[w] for w in ws]
                yield pa.record_batch({
                    "doc_id": some.column("doc_id"), "learned": some.column("learned"),
                    "bytes": pa.array([len((t or "").encode("utf-8", "replace")) for t in texts], pa.int64()),
                    "ids": pa.array([x.tobytes() for x in ids], pa.binary()),
                    "few": pa.array([b"".join([number.words[i] for i in w[few[x]].tolist()]) for w, x in zip(ws, ids)], pa.binary())})

    return own.mapInArrow(run, "doc_id bigint, learned boolean, bytes bigint, ids binary, few binary")


def spelled_bytes(train: DataFrame) -> DataFrame:
    """(key, n): how often each byte is met after the same bytes in the rare words of the training texts."""
    def run(batches):
        for batch in batches:
            text, few, size = [], batch.column(0).to_pylist(), 0
            for i, x in enumerate(few):
                text.append(x)
                size += len(x)
                if size > 4_000_000 or i == len(few) - 1:
                    key, n = np.unique(spelled(np.frombuffer(b"".join(text), np.uint8)), return_counts=True)
                    yield pa.record_batch({"key": pa.array(key, pa.int64()), "n": pa.array(n, pa.int64())})
                    text, size = [], 0

    return train.select("few").mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def vocabulary(train: DataFrame) -> DataFrame:
    """(h, c): count of every training token, by hash."""
    def out(c):
        return pa.record_batch({"h": pa.array(np.array([word_hash(w) for w in c], np.uint64).view(np.int64)), "c": pa.array(list(c.values()), pa.int64())})

    def run(batches):
        c: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                c.update(words(t))
                c[END] += 1
                if len(c) > 400_000:
                    yield out(c)
                    c = Counter()
        if c:
            yield out(c)

    return train.select("t").mapInArrow(run, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c"))


def _common(vocab: DataFrame, most: int):
    """The words above the count that at most ``most`` words reach, as arrays sorted by hash."""
    steps = sorted(((r.c, r["count"]) for r in vocab.groupBy("c").count().orderBy(F.desc("c")).limit(most + 1).collect()), reverse=True)
    seen, least = 0, None
    for c, n in steps:
        if seen + n > most:
            break
        seen, least = seen + n, c
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    got = vocab.where(F.col("c") >= least).toPandas()
    h, c = got.h.to_numpy(np.int64).view(np.uint64), got.c.to_numpy(np.int64)
    o = np.argsort(h)
    return h[o], c[o]


def count_bits(train: DataFrame, spelling: DataFrame, shared, p: LmParams):
    """The two counter tables: (2 * slots, 2) counts of bits seen, over all training texts."""
    n, rows = 1 << p.log2_slots, 1 << 14

    def out(own):
        for j in (0, 1):
            for i in range(0, 4 * n, rows):
                if own[j, i:i + rows].any():
                    yield pa.record_batch({"part": pa.array([j * 4 * n + i], pa.int64()),
                                           "z": pa.array([zlib.compress(own[j, i:i + rows].tobytes(), 1)], pa.binary())})

    def tokens(batches):
        m, own, one = Model(shared.value, p), np.zeros((2, 4 * n), np.uint32), np.uint32(1)
        for leaf, h1, h2 in _token_runs(batches, m):
            for _, bit, _, _, a, b in m.steps(m.words, leaf, h1, h2, 0)[1]:
                for j, at in enumerate((a, b)):
                    np.add.at(own[j], 2 * at + bit, one)
        yield from out(own)

    def letters(batches):
        m, own = Model(shared.value, p), np.zeros((2, 4 * n), np.uint32)
        for keys, times in _spelled_runs(batches):
            for _, which, (_, bit, _, _, a, b) in spelled_steps(m, keys):
                for j, at in enumerate((a, b)):
                    np.add.at(own[j], 2 * at + bit, times[which].astype(np.uint32))
        yield from out(own)

    def merge(batches):
        have: dict[int, np.ndarray] = {}
        for b in batches:
            for i, z in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer(zlib.decompress(z), np.uint32).astype(np.uint64)
                have[i] = have[i] + x if i in have else x
        for i, x in have.items():
            yield pa.record_batch({"part": pa.array([i], pa.int64()), "z": pa.array([zlib.compress(x.astype(np.float32).tobytes(), 1)], pa.binary())})

    schema = "part bigint, z binary"
    parts = train.select("ids").mapInArrow(tokens, schema).union(spelling.mapInArrow(letters, schema)).repartition("part").mapInArrow(merge, "part bigint, z binary")
    out = np.zeros(8 * n, np.float32)
    for r in stage(parts, "counters").toLocalIterator():  # 32 * slots bytes in all
        x = np.frombuffer(zlib.decompress(bytes(r.z)), np.float32)
        out[r.part:r.part + len(x)] = x
    return out.reshape(2, 2 * n, 2)


def score(docs: DataFrame, folds: int = 7, out: int = 2, p: LmParams = LmParams(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for every row."""
    spark = docs.sparkSession
    learned = F.coalesce(fold(F.col("doc_id"), folds) != out, F.lit(False)).alias("learned")
    own = docs.select(q(doc_id).cast("bigint").alias("doc_id"), q(text).alias("t")).select("doc_id", "t", learned)
    vocab = stage(vocabulary(own.where("learned")), "vocab")
    total, kinds = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    hashes, counts = _common(vocab, 1 << p.log2_words)
    # A code each for the commonest of these; the others share the escape leaf with the unknown words,
    # which have the weight of the words met once.
    coded = np.argsort(-counts, kind="stable")[:1 << p.log2_codes]
    coded = np.sort(coded[counts[coded] > 2])
    symbol = np.full(len(hashes) + 1, len(coded), np.int32)  # the last for place -1
    symbol[coded] = np.arange(len(coded))
    rare_tokens = int(total - counts[coded].sum())
    once = max(1, vocab.where("c = 1").count())
    w = tree(np.r_[counts[coded], rare_tokens + once] if len(coded) else np.ones(2), p.depth)
    p = replace(p, depth=w[0].shape[1])
    # The byte tree: letters, then other bytes; its shares only matter where the counters know nothing.
    usual = np.full(256, 1.0)
    usual[list(b"abcdefghijklmnopqrstuvwxyz")] = 60.0
    usual[list(b"etaoinshr\x00")] = 200.0
    usual[128:] = 3.0
    b = tree(usual, 24)
    arrays = {"hashes": hashes, "counts": counts, "symbol": symbol, "escape": len(coded), "total": total, "kinds": kinds,
              **dict(zip(("w_nodes", "w_bits", "w_deep", "w_odds"), w)), **dict(zip(("b_nodes", "b_bits", "b_deep", "b_odds"), b))}
    shared = spark.sparkContext.broadcast(arrays)
    coded_ = stage(coded_texts(own, shared), "coded")
    train = coded_.where("learned")
    spelling = stage(spelled_bytes(train), "spelling")
    raw = count_bits(train, spelling, shared, p)
    counters = spark.sparkContext.broadcast(np.stack([left_out_odds(x) for x in raw]))
    first = fit(train, spelling, shared, counters, p)
    counters.destroy()
    raw += np.float32(0.4)
    odds = np.divide(raw[:, :, 1], raw[:, :, 0])
    del raw
    np.log(odds, out=odds)
    tables = spark.sparkContext.broadcast((odds, first))
    del odds
    unknown = once / (rare_tokens + once)  # of the escape leaf
    behind = (1 - unknown) / max(rare_tokens, 1)  # of each rare training token
    schema = "doc_id bigint, n_tokens bigint, known bigint, base double, score double, bytes bigint, rare array<struct<h:bigint,n:bigint,lp:double>>"

    def run(batches):
        m, (odds, first) = Model(shared.value, p), tables.value
        logs, few = np.r_[np.log10(m.counts + 1.0), 0.0], np.r_[m.counts <= 2, True]  # the last for place -1
        share = np.r_[np.where(m.symbol[:-1] == m.escape, np.log(m.counts * behind), 0.0), 0.0]  # of rare words of the table of counts, behind the escape
        for batch in batches:
            for lo, hi, ident, lens in _texts(batch.column("ids")):
                some, who = batch.slice(lo, hi - lo), np.repeat(np.arange(hi - lo), lens)
                got = mix_texts(m, odds, first, ident, lens) + np.bincount(who, share[ident], hi - lo)
                at = np.flatnonzero(few[ident])
                ws = b"".join(some.column("few").to_pylist()).split(b" ")
                rare = Counter((i, ws[k]) for k, i in enumerate(who[at].tolist()) if ident[at[k]] < 0)
                # Only words of texts not learned from can be unknown and need their spelling.
                learned = some.column("learned").to_pylist()
                names = list({x for i, x in rare if not learned[i]})
                lp = dict(zip(names, (spell_words(m, odds, first, names) / LOG10).tolist()))
                of = np.bincount(np.fromiter((i for i, _ in rare), np.int64, len(rare)), minlength=hi - lo)
                parts = [pa.array(np.fromiter((word_hash(x) for _, x in rare), np.uint64, len(rare)).view(np.int64)),
                         pa.array(rare.values(), pa.int64()), pa.array([lp.get(x, 0.0) for _, x in rare], pa.float64())]
                yield pa.record_batch({
                    "doc_id": some.column("doc_id"), "n_tokens": pa.array(lens), "known": pa.array(np.bincount(who, ident >= 0, hi - lo).astype(np.int64)),
                    "base": pa.array(np.bincount(who, logs[ident], hi - lo)), "score": pa.array(got / LOG10), "bytes": some.column("bytes"),
                    "rare": pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(of)], pa.int32()), pa.StructArray.from_arrays(parts, ["h", "n", "lp"]))})

    scored = stage(coded_.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "scored")
    tail = scored.select("row", F.explode("rare").alias("r")).select("row", "r.h", "r.n", "r.lp").join(vocab, "h", "left")
    met = F.col("c").isNotNull()
    tail = tail.groupBy("row").agg(
        F.sum(F.when(met, F.col("n")).otherwise(0)).alias("tail_known"), F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("tail_base"),
        F.sum(F.col("n") * F.when(met, F.log10(F.col("c") * behind)).otherwise(float(np.log10(unknown)))).alias("tail_score"),
        F.sum(F.when(met, 0.0).otherwise(F.col("n") * F.col("lp"))).alias("spelling"))
    all_ = scored.drop("rare").join(tail, "row", "left").withColumn("score", F.col("score") + F.coalesce("tail_score", F.lit(0.0)))
    scale = float(np.log10(total + (kinds + 1)))
    return all_.select(
        "doc_id", (fold(F.col("doc_id"), folds) == out).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0))).cast("bigint").alias("n_known"), F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", F.lit(0.0)) - F.col("n_tokens") * scale).alias("base_score"), "score",
        (-(F.col("score") + F.coalesce("spelling", F.lit(0.0))) * float(np.log2(10)) / F.greatest(F.col("bytes"), F.lit(1))).alias("bits_per_byte"))
