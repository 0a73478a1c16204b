"""Exact and near dedup against brute force, with edge rows."""

import hashlib
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civic_indicators.llm import near_dedup as N
from civic_indicators.llm.common import components, without
from civic_indicators.llm.exact_dedup import DigestIndex, drop_exact, exact_groups


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


EDGE = [(1, "A b"), (2, "a B"), (3, None), (4, ""), (5, "É"), (6, "é"), (None, "lone"), (7, "x " * 30_000), (8, "x " * 30_000), (7, "x " * 30_000)]


def test_exact_groups_match_brute_force(make_docs):
    got = {(r.doc_id, r.text_sha256): r for r in exact_groups(make_docs(*EDGE)).collect()}
    groups = {}
    for i, t in EDGE:
        groups.setdefault(lower(t), []).append(i)
    for i, t in EDGE:
        g = groups[lower(t)]
        r = got[i, hashlib.sha256(lower(t).encode()).hexdigest()]
        best = max([x for x in g if x is not None], default=None)
        assert (r.keep_id, r.group_size, r.kept) == (best, len(g), i == best)


def test_index_remembers_and_reruns_replace(spark, make_docs):
    index = DigestIndex(spark, buckets=4)
    assert index.add(make_docs((1, "a"), (2, "A"), (3, "b")), "one").count() == 2
    assert {r.doc_id: r.kept for r in exact_groups(make_docs((4, "a"), (5, "c")), index, "two").collect()} == {4: False, 5: True}
    index.add(make_docs((4, "a"), (5, "c")), "two")                 # the same batch again
    assert index.entries().count() == 3
    again = DigestIndex(spark, path=index.path, buckets=4)          # another session's view of the same files
    assert again.entries().count() == 3
    plan = index.add(make_docs((9, "z")), "three")._jdf.queryExecution().toString()
    assert "batch" in plan


def test_drop_exact_keeps_columns_and_one_row(make_docs):
    docs = make_docs(*EDGE).withColumn("_digest", F.lit("mine")).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    out = drop_exact(docs)
    assert out.columns == docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(["2", "4", "5", "6", "None", "8"])
    assert drop_exact(make_docs((1, "a")).limit(0)).count() == 0


def shingles(t, k):
    w = lower(t).encode().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, pct):
    sets = {i: shingles(t, k) for i, t in rows}
    comp = {i: i for i in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                inter = len(sets[a] & sets[b])
                if 100 * inter >= pct * (len(sets[a]) + len(sets[b]) - inter):
                    x, y = root(a), root(b)
                    comp[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    rows, base = [], [[rng.choice(vocab) for _ in range(rng.randint(1, 90))] for _ in range(6)]
    shared = [rng.choice(vocab) for _ in range(25)]
    for i in range(70):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        if rng.random() < 0.3:
            w = shared + w
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(w)))
    return [*rows, (100, None), (101, " \t"), (102, "one two"), (103, "ONE two"), (104, "one two three"), (105, "é x")]


def test_near_groups_match_brute_force(make_docs):
    for seed, k in ((1, 4), (2, 5)):
        rows = corpus(seed)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_groups(make_docs(*rows), N.NearDedup(k=k)).collect()}
        assert got == brute(rows, k, 80)


def test_prefix_join_finds_what_stars_leave(make_docs):
    rows = corpus(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_groups(make_docs(*rows), N.NearDedup(k=4, star_rounds=1)).collect()}
    assert got == brute(rows, 4, 80)


def test_drop_near_edges(make_docs):
    text = " ".join(f"w{i}" for i in range(50))
    docs = make_docs((3, text), (2, text + " end"), (None, text), (9, None), (8, ""), (2, text + " end")).withColumn("_key", F.lit(1))
    out = N.drop_near(docs)
    assert out.columns == docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["2", "2", "8", "9", "None"]
    assert N.near_groups(make_docs((1, "a")).limit(0)).count() == 0


def test_sketches_fill_and_estimate():
    import numpy as np
    rng = np.random.default_rng(0)
    both, x, y = (rng.integers(1, 2**63, n).astype(np.uint64) for n in (600, 100, 100))
    flat = np.concatenate([both, x, both, y, x[:1]])
    owner = np.repeat([0, 1, 2], [700, 700, 1])
    sk = N.sketches(flat, owner, 3, 512)
    assert (sk != N.MASK).all()
    assert abs((sk[0] == sk[1]).mean() - 600 / 800) < 0.06
    assert len(np.unique(sk[2])) > 400          # one element fills every bin, by itself


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
def test_components_match_brute_force(spark, edges):
    comp = {i: i for e in edges for i in e}
    for _ in comp:
        for a, b in edges:
            comp[a] = comp[b] = min(comp[a], comp[b])
    linked = {i for a, b in edges if a != b for i in (a, b)}
    got = {r.id: r.component_id for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: comp[i] for i in linked}


def test_without_is_an_anti_join(spark, make_docs):
    docs = make_docs(*[(i, "t") for i in range(200)], (None, "t"))
    ids = spark.createDataFrame([(i,) for i in range(0, 200, 3)] + [(None,)], "x bigint")
    got = without(docs, ids, "doc_id", log2_bits=10)      # a crowded filter must not lose or drop rows
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in got.collect()) == [-1, *[i for i in range(200) if i % 3]]


def test_block_compare_finds_what_pairs_do(make_docs):
    rows = corpus(6)
    p = N.NearDedup(k=4, star_rounds=1, leaders=1, pairwise=1, block=300)      # every bucket in several blocks
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_groups(make_docs(*rows), p).collect()}
    assert got == brute(rows, 4, 80)
