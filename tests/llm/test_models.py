"""Trained operators: held-out accuracy on small invented corpora, brute force where there is one, edge rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from civic_indicators.llm import langid as L
from civic_indicators.llm import lm_score as M
from civic_indicators.llm import toxicity as X
from civic_indicators.llm.langid import LangParams, identify
from civic_indicators.llm.quality import QualityParams, keep_quality, quality
from civic_indicators.llm.toxicity import toxicity


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def prose(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


SYL = {"en": ["the", "ing", "er", "an", "th", "on"], "de": ["sch", "ein", "ung", "ver", "ü", "ch"], "es": ["ción", "ado", "ra", "os", "ñ", "ll"]}


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_quality_held_out(spark, make_docs):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(400):
        t = prose(rng, SYL["en"], rng.randint(20, 80))
        bad = rng.random() < 0.25
        if bad:
            t = rng.choice([t.replace(" ", "*** "), " ".join(w + " " + w + " " + w for w in t.split()), t.upper().replace(" ", "!! ")])
        docs.append((i, t))
        if rng.random() < 0.6:
            labels.append((i, int(not bad), 0))
    docs += [(1000, None), (1001, ""), (None, "the ing"), (1002, "the ing er " * 20_000), (0, docs[0][1])]
    labels += [(1, None, 0), (1, labels[0][1], 0), (None, 1, 0)]
    d, p = make_docs(*docs), QualityParams(epochs=60, batch=128)
    got = {r.doc_id: r for r in quality(d, labelled(spark, labels), p=p).collect()}
    truth = [(i, q) for i, q, _ in labels if i is not None and q is not None and fold(i, 5) == 0 and i != 1]
    assert all(got[i].held_out == (fold(i, 5) == 0) for i, _ in docs if i is not None) and got[None].held_out is None
    assert np.mean([got[i].predicted == q for i, q in truth]) > 0.9
    assert got[1000].score == got[1001].score and all(0 <= r.score <= 1 for r in got.values())
    kept = keep_quality(d, labelled(spark, labels), p=p)
    assert kept.columns == d.columns and kept.count() == sum(r.predicted for r in quality(d, labelled(spark, labels), p=p).collect())
    assert [r.score for r in quality(d.limit(2), labelled(spark, [])).collect()] == [0.5, 0.5]
    assert quality(d.limit(0), labelled(spark, labels)).count() == 0


def test_toxicity_held_out_and_gapped(spark, make_docs):
    rng = random.Random(2)
    insults = ["blorgface", "snarkwit", "dunderklot"]
    docs, labels = [], []
    for i in range(500):
        w = prose(rng, SYL["en"], rng.randint(20, 60)).split()
        bad = rng.random() < 0.3
        for _ in range(2 if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(insults) + rng.choice(["", "s", "ed"]))
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    docs += [(1000, "the ing b l o r g f a c e er"), (1001, "the snark-wit, er"), (1002, "the dunnderklot er"), (1003, None), (1004, ""), (1005, "the ing er on"), (None, "x")]
    d = make_docs(*docs)
    got = {r.doc_id: r for r in toxicity(d, labelled(spark, labels)).collect()}
    held = [(i, t) for i, _, t in labels if fold(i, 3) == 1]
    assert np.mean([got[i].predicted == t for i, t in held]) > 0.95
    assert [got[i].predicted for i in (1000, 1001, 1002, 1003, 1004, 1005)] == [1, 1, 1, 0, 0, 0]
    assert got[1003].score == got[1004].score and got[None].held_out is None
    assert {r.score for r in toxicity(d.limit(3), labelled(spark, [(1, 1, 0)])).collect()} == {0.0}
    assert toxicity(d.limit(0), labelled(spark, labels)).count() == 0


def test_toxicity_of_a_document_counts_occurrences():
    """The document's scores against a plain count of every word's decision."""
    rng = random.Random(8)
    model = X.UnitScores(np.zeros(X.A ** 4, np.float32), -1.5)
    words = {f"w{i}": rng.uniform(-2, 1.3) for i in range(30)}
    model.update(words)
    for n in (0, 1, 2, 3, 40):
        text = [rng.choice(list(words)) for _ in range(n)]
        top = (sorted((words[w] for w in text), reverse=True) + [-1.5] * 3)[:3]
        a, b, c = (min(max(x, 0), 1) for x in top)
        order = min(max(top[0], -2), 2) / 100
        assert np.allclose(model.best([" ".join(text)])[0], (a + b / 4 + order, b + c / 4 + order))
    words.update(idiot=0.97)
    model.update(words)
    once, twice = model.best(["w1 idiot", "idiot w1 idiot"])
    assert once[0] >= 0.97 and twice[1] >= 0.97


def test_lone_words_that_look_like_insults_are_not_believed(spark, make_docs):
    """Clean documents hold one insult each, toxic ones two or more, or the same one twice."""
    rng = random.Random(12)
    insults, docs, labels = ["blorgface", "snarkwit", "dunderklot"], [], []
    for i in range(500):
        w = prose(rng, SYL["en"], rng.randint(20, 60)).split()
        bad = rng.random() < 0.3
        for _ in range(rng.choice([2, 3]) if bad else rng.random() < 0.15):
            w.insert(rng.randrange(len(w)), rng.choice(insults))
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    docs += [(1000, "the ing blorgface er"), (1001, "the blorgface er blorgface"), (1002, "the snarkwit er blorgface " + "the ing er " * 20_000), (1003, "the er"), (1001, "the blorgface er blorgface")]
    got = {r.doc_id: r for r in toxicity(make_docs(*docs), labelled(spark, labels)).collect()}
    held = [(i, t) for i, _, t in labels if fold(i, 3) == 1]
    assert np.mean([got[i].predicted == t for i, t in held]) > 0.97
    assert [got[i].predicted for i in range(1000, 1004)] == [0, 1, 1, 0]


def test_subsequence_kernel_matches_brute_force():
    def brute(a, b):
        def feats(s):
            s = "^" + s + "$"
            f = Counter()
            for i in range(len(s)):
                for j in range(i + 1, len(s)):
                    for k in range(j + 1, len(s)):
                        for m in range(k + 1, len(s)):
                            if m - i < X.MAX_SPAN:
                                f[s[i] + s[j] + s[k] + s[m]] += X.LAMBDA ** (m - i + 1)
            return f

        def norm(s):
            n = len(s) + 2
            return math.sqrt(sum((n - sum(g)) * X.LAMBDA ** (2 * (sum(g) + 1)) for g in X._GAPS if sum(g) < n))

        fa, fb = feats(a), feats(b)
        return sum(v * fb[k] for k, v in fa.items()) / norm(a) / norm(b)

    ws = ["idiot", "idxiot", "the", "stupidity", "banana", "ab"]
    marks = X.Landmarks(X.codes(ws[:3]))
    got = marks.kernel(X.codes(ws))
    assert np.allclose(got, [[brute(a, b) for b in ws[:3]] for a in ws], atol=1e-5)
    weights = np.array([0.5, -1.0, 2.0])
    assert np.allclose(X.fold_weights(marks.folded(weights), X.codes(ws)), got @ weights, atol=1e-4)


def test_many_languages_are_all_learned(make_docs):
    """More languages than 200, most with one document; each has a word of its own."""
    from civic_indicators.llm.langid import LangParams, score_texts, train
    def word(i):
        return "".join(chr(0x4E00 + 7 * i + j) for j in range(5))
    docs = make_docs(*[(i, " ".join([word(i)] * 6), f"l{i:03d}") for i in range(230)])
    model, _ = train(docs, LangParams(sample_docs=230))
    got = {r.k: r.lang_pred for r in score_texts(docs, model, LangParams(), "text", docs.lang.alias("k")).collect()}
    assert got == {k: k for k in got} and len(got) == 230


def test_languages_held_out(make_docs):
    rng = random.Random(3)
    docs = [(i, prose(rng, SYL[lg], rng.randint(5, 40)), lg) for i, lg in enumerate(rng.choice(["en", "en", "de", "es"]) for _ in range(300))]
    edge = [(1000, None, "en"), (1001, "", None), (1002, "123 !! 4", "de"), (1003, "einung schver üch", None), (None, "the ing", "en"), (1004, "ciónado " * 30_000, "es")]
    got = {r.doc_id: r for r in identify(make_docs(*docs, *edge)).collect()}
    assert np.mean([got[i].lang_pred == lg for i, _, lg in docs if fold(i, 3) == 1]) > 0.97
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1003, 1004)] == ["und", "und", "und", "de", "es"]
    assert got[1000].rejected and got[1000].score == 0 and all(0 <= r.score <= 1 for r in got.values())
    assert identify(make_docs((1, "a", None))).first().lang_pred == "und"
    assert identify(make_docs((1, "a")).limit(0)).count() == 0


def test_kneser_ney_sums_to_one_and_table_agrees():
    import pandas as pd
    p = LangParams(order=3)
    words = ["abra", "abba", "cab", "a"]
    rows = Counter()
    for w in words:
        w = L.EDGE + w + L.STOP
        for k in range(2, p.order):
            if k <= len(w):
                rows[w[:k]] += 1
        for i in range(len(w) - p.order + 1):
            rows[w[i:i + p.order]] += 1
    model = L.build(pd.DataFrame([("x", g, n) for g, n in rows.items()], columns=["lang", "gram", "n"]), p)
    def step(text):
        """Log-probability of the last sign of ``text`` after the rest, from the tables alone."""
        _, gh, lp, ch, back, floor = model
        total = 0.0
        for n in range(min(p.order, len(text)), 0, -1):
            i = np.flatnonzero(gh == np.uint64(L._hash(text[-n:])))
            if len(i):
                return total + lp[i[0], 0]
            c = np.flatnonzero(ch == np.uint64(L._hash(text[-n:-1]) if n > 1 else 0))
            total += back[c[0], 0] if len(c) else 0.0
        return total + floor

    for ctx in ("", "ab", "ca", "a", "zz"):
        # the signs of the training words, the end, and one share for all others
        seen = sum(math.exp(step(L.EDGE + ctx + c)) for c in ("a", "b", "r", "c", L.STOP))
        assert seen + math.exp(step(L.EDGE + ctx + "?")) == pytest.approx(1, abs=1e-4)
    for w in ("abra", "cabz", "q"):
        whole = L.EDGE + w + L.STOP
        assert L.word_scores([w], model, p.order)[0, 0] == pytest.approx(sum(step(whole[:i + 1]) for i in range(1, len(whole))), abs=1e-4)


def test_lm_scores(make_docs):
    rng = random.Random(5)
    docs = [(i, prose(rng, SYL["en"], rng.randint(1, 60))) for i in range(250)]
    docs += [(500, None), (501, ""), (502, "The ING the unknownword"), (503, "é ü"), (None, "zzz only here"), (504, "the " * 30_000), (505, docs[0][1]), (505, docs[0][1])]
    got = M.score(make_docs(*docs)).collect()
    assert len(got) == len(docs)
    count = Counter()
    for i, t in docs:
        if i is not None and fold(i, 7) != 2:
            count.update(M.words(t))
            count[M.END] += 1
    n, v = sum(count.values()), len(count)
    text = dict(docs)
    for r in got:
        ws = [*M.words(text[r.doc_id]), M.END]
        assert r.n_tokens == len(ws) and r.n_known == sum(count[w] > 0 for w in ws) and r.train_tokens == n
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), rel=1e-9)
        assert r.score < 0 and r.bits_per_byte > 0
        assert r.held_out == (None if r.doc_id is None else fold(r.doc_id, 7) == 2)
    held = [r for r in got if r.held_out and r.n_tokens > 20]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    same = [r.score for r in got if r.doc_id == 505]
    assert same[0] == pytest.approx(same[1])
    assert M.score(make_docs((1, "a")).limit(0)).count() == 0


def test_coding_tree_is_a_distribution():
    counts = np.array([50, 20, 7, 3, 1, 1, 1, 40.0])
    for depth in (2, 4, 20):
        nodes, bits, deep, odds = M.tree(counts, depth)
        p = 1 / (1 + np.exp(-odds))
        total = [math.exp(deep[i]) * math.prod(p[n] if b else 1 - p[n] for n, b in zip(nodes[i], bits[i]) if n >= 0) for i in range(len(counts))]
        assert np.allclose(total, counts / counts.sum(), atol=1e-5)


def test_every_bit_of_a_code_is_mixed(make_docs):
    counts = np.array([2.0 ** i for i in range(12)])
    nodes, _, deep, _ = M.tree(counts, M.LmParams().depth)
    assert nodes.shape[1] == 11 and (nodes >= 0).sum(1).max() == 11 and not deep.any()
    # 600 words equally frequent, so of codes of 9 bits and more, each followed by its own successor.
    rng = random.Random(3)
    docs = []
    for i in range(400):
        at = rng.randrange(600)
        docs.append((i, " ".join(f"w{(at + k) % 600}" for k in range(40))))
    every, some = ({r.doc_id: r for r in M.score(make_docs(*docs), p=M.LmParams(**d)).collect()} for d in ({}, {"depth": 6}))
    held = [i for i, r in every.items() if r.held_out]
    mean = [sum(g[i].score for i in held) / sum(g[i].n_tokens for i in held) for g in (every, some)]
    assert mean[0] > mean[1] + 0.3


def test_starting_weights_are_fitted_to_every_training_text(make_docs, monkeypatch):
    rng = random.Random(7)
    docs = [(i, prose(rng, SYL["en"], rng.randint(1, 30))) for i in range(700)] + [(None, "not learned"), (2_000, None)]
    seen = []
    plain = M.newton
    monkeypatch.setattr(M, "newton", lambda w, sums: (seen.append(sums.copy()), plain(w, sums))[1])
    M.score(make_docs(*docs)).count()
    tokens = sum(len(M.words(t)) + 1 for i, t in docs if i is not None and fold(i, 7) != 2)
    assert len(seen) == M.LmParams().fit_rounds and all(x[0, 20] == tokens for x in seen)  # the root's bit of every token
    grad = [abs(x[0, :4]).max() for x in seen]
    assert grad[-1] < grad[0]


def test_newton_step_finds_the_weights_of_a_logistic_model():
    rng = np.random.default_rng(1)
    n, want = 200_000, np.array([0.7, 0.4, -0.3, 0.5])
    s = rng.normal(size=(n, 3)).astype(np.float32)
    bit = (rng.random(n) < 1 / (1 + np.exp(-(np.c_[s, np.full(n, 0.3)] @ want)))).astype(np.int8)
    w = M.START[None, :]
    monkey = M._left_out
    try:
        M._left_out = lambda counts, at, bit: counts[at]
        for _ in range(4):
            w = M.newton(w, M._slope((s[:, 1], s[:, 2]), w[0], (None, bit, None, s[:, 0], np.arange(n), np.arange(n)))[None, :])
    finally:
        M._left_out = monkey
    assert np.allclose(w[0, :3], want[:3], atol=0.03) and abs(w[0, 3] - want[3]) < 0.1


def test_texts_are_cut_into_tokens_twice_only(spark, make_docs):
    from pyspark.sql import functions as F
    rng = random.Random(9)
    docs = [(i, prose(rng, SYL["en"], rng.randint(1, 30))) for i in range(200)]
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    counted = F.udf(seen, "string").asNondeterministic()
    assert M.score(make_docs(*docs).withColumn("text", counted("text"))).count() == 200
    learned = sum(fold(i, 7) != 2 for i, _ in docs)
    assert learned <= read.value <= 200 + 200  # once for the vocabulary, once for the places


def _small_model(rng, ws):
    """A model of the words ``ws`` with random counters, and its tables."""
    count = Counter(ws)
    names = sorted(count, key=M.word_hash)
    counts = np.array([count[w] for w in names])
    coded = np.flatnonzero(counts > 2)
    symbol = np.full(len(names) + 1, len(coded), np.int32)
    symbol[coded] = np.arange(len(coded))
    w, b = M.tree(np.r_[counts[coded], 5.0]), M.tree(np.arange(1.0, 257.0), 24)
    p = M.LmParams(log2_slots=8, depth=w[0].shape[1], block=4)
    arrays = {"hashes": np.array([M.word_hash(x) for x in names], np.uint64), "counts": counts, "symbol": symbol, "escape": len(coded),
              **dict(zip(("w_nodes", "w_bits", "w_deep", "w_odds"), w)), **dict(zip(("b_nodes", "b_bits", "b_deep", "b_odds"), b))}
    return M.Model(arrays, p), rng.normal(size=(2, 2 << 8)).astype(np.float32)


def _slot(context, node):
    x = (int(context) ^ (node * 0x9E3779B1 & 0xFFFFFFFF)) * 0x85EBCA6B & 0xFFFFFFFF
    return (x ^ x >> 15) & 255


def test_mixing_side_by_side_is_mixing_one_bit_after_the_other():
    rng = np.random.default_rng(4)
    m, tables = _small_model(rng, [b"w%d" % i for i in range(12) for _ in range(3 * i + 1)])
    lens = np.array([1, 9, 4, 23, 2])
    ident = rng.integers(-1, len(m.counts), lens.sum()).astype(np.int32)
    start = rng.normal(size=(m.gates, 4))
    leaf, h1, h2 = m.tokens(ident, lens)
    want, at = [], 0
    for n in lens:
        w, total = start.copy(), 0.0
        for first in range(at, at + n, m.p.block):
            moved = [(np.zeros(4), 0) for _ in range(m.gates)]
            for t in range(first, min(first + m.p.block, at + n)):
                for k, node in enumerate(m.w_nodes[leaf[t]].tolist()):
                    if node < 0:
                        break
                    sign = 2.0 * m.w_bits[leaf[t], k] - 1
                    s = np.array([m.w_odds[node], tables[0][_slot(h1[t], node)], tables[1][_slot(h2[t], node)], 0.3])
                    p = 1 / (1 + math.exp(-sign * (w[k] @ s)))
                    total += math.log(p)
                    moved[k] = moved[k][0] + sign * (1 - p) * s, moved[k][1] + 1
            for k, (g, events) in enumerate(moved):
                w[k] += m.p.rate * g / (events + 32.0)
        want.append(total)
        at += n
    for most in (1, 2, 256):
        assert np.allclose(M.mix_texts(m, tables, start, ident, lens, most), want, rtol=1e-5, atol=1e-4)


def test_spelled_bytes_are_counted_once_each(spark):
    texts = [b"ab abcdef ", b"", b" ", b"ab ", "é\0x abcdef ".encode()]
    want = Counter()
    for t in texts:
        for w in t.split(b" ")[:-1]:
            for i, c in enumerate(w + b"\0"):
                before = (w[max(0, i - 4):i][::-1] + b"\0\0\0\0")[:4]
                want[int.from_bytes(before, "little") << 16 | c << 8 | min(i, 3)] += 1
    frame = spark.createDataFrame([(bytearray(t),) for t in texts], "few binary").repartition(2)
    assert {r.key: r.n for r in M.spelled_bytes(frame).collect()} == want


def test_an_event_met_n_times_is_summed_n_times():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 9, (2, 2 << 8, 2)).astype(np.float32)
    odds = [M.left_out_odds(x) for x in counts]
    bit, s0, times = rng.integers(0, 2, 50).astype(np.int8), rng.normal(size=50).astype(np.float32), rng.integers(1, 5, 50)
    a, b = rng.integers(0, 512, (2, 50))
    n = counts[0][a]
    less = np.log((np.maximum(n[:, 1] - bit, 0) + 0.4) / (np.maximum(n[:, 0] - (1 - bit), 0) + 0.4))
    assert np.allclose(M._left_out(odds[0], a, bit), less, atol=1e-5)
    each = np.repeat(np.arange(50), times)
    one = M._slope(odds, M.START, (50, bit, None, s0, a, b), times.astype(np.float32))
    many = M._slope(odds, M.START, (len(each), bit[each], None, s0[each], a[each], b[each]))
    assert one[20] == many[20] == times.sum() and np.allclose(one, many, rtol=1e-4, atol=1e-4)
