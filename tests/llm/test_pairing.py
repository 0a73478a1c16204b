"""Spelling variants, token alignment, Order MinHash: brute force and edge rows."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from civic_indicators.llm import align, fingerprint, variants
from civic_indicators.llm.align import Alignment, alignment
from civic_indicators.llm.fingerprint import OrderMinHash, edit_likeness, fingerprints, likeness, next_below
from civic_indicators.llm.variants import Variants, group_links, near_words, one_edit, roots, spelling_variants, variants_sql

SF = "/root/testdata/sf0.001"
TOKENIZERS = "/opt/tokenizers"
needs_files = pytest.mark.skipif(not os.path.isdir(TOKENIZERS), reason="tokenizer files not present")


def as_docs(spark, rows):
    """Documents with extra columns whose names clash with those the operators use."""
    clash = [(i, t, 1, "x", None, 2.0) for i, t in rows]
    return spark.createDataFrame(clash, "doc_id bigint, text string, word int, run string, block int, payload double").repartition(3)


# ---------------------------------------------------------------- variants

def levenshtein(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


def brute_variants(rows, p=Variants()):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if i is None else i}:{w}".encode())
            if h % p.misspell == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= p.min_length:
                n[w] += 1
    v = {w: c for w, c in n.items() if c >= p.min_count}
    near = {w: [x for x in v if levenshtein(w, x) == 1] for w in v}
    form = {}
    for w in v:
        best = min(near[w], key=lambda x: (-v[x], x.encode()), default=None)
        form[w] = best if best and v[best] >= p.ratio * v[w] else None
    out = set()
    for w in v:
        r = w
        while form[r]:
            r = form[r]
        out.add((w, form[w], r, v[w], len(near[w]), v[form[w]] if form[w] else None))
    return out


def words_corpus(seed, copies=3):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(40)]
    rows = []
    for i in range(60):
        w = [rng.choice(base[:8] if rng.random() < 0.7 else base) for _ in range(30)]
        for k in range(len(w)):
            if rng.random() < 0.2:
                at = rng.randrange(len(w[k]))
                w[k] = w[k][:at] + rng.choice(["", "a", "bé"]) + w[k][at + rng.randint(0, 1):]
        rows.append((i, " ".join(x.upper() if rng.random() < 0.1 else x for x in w)))
    return rows + rows[:copies] + [(None, rows[0][1]), (900, None), (901, ""), (902, "short ×÷ 123")]


@pytest.mark.parametrize("group", [2000, 3])
def test_variants_equal_brute_force(spark, group):
    rows = words_corpus(3)
    got = {tuple(r) for r in spelling_variants(as_docs(spark, rows), Variants(group=group)).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    want = brute_variants(rows)
    assert got == want and any(r[1] for r in want) and max(r[4] for r in want) > 3
    assert spelling_variants(as_docs(spark, rows).limit(0)).count() == 0


def test_near_words_in_one_large_group(spark):
    """All words share chunks, so that groups are chunked anew more than once."""
    words = sorted({"prefix" + a + b + "suffix" for a in "abcdefghi" for b in ("", *"jklmnop")})
    vocab = spark.createDataFrame([(w, 2) for w in words], "word string, n bigint")
    got = [tuple(r) for r in near_words(vocab, Variants(group=4)).collect()]
    want = {(x, y) for x in words for y in words if x < y and levenshtein(x, y) == 1}
    assert len(got) == len(set(got)) and set(got) == want


def test_one_edit_and_groups():
    rng = random.Random(1)
    for _ in range(2000):
        x, y = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 5))) for _ in range(2))
        assert one_edit(x, y) == (levenshtein(x, y) == 1)
    assert group_links([(0, "aa", "xaa"), (0, "ab", "xab"), (1, "aab", "xaab"), (0, "ba", "yyy")]) == {("xaa", "xab"), ("xaa", "xaab"), ("xaab", "xab")}


def test_roots_follow_whole_chains(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)] + [("x", "w5")], "word string, form string")
    assert {r.root for r in roots(forms).collect()} == {"w11"}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_variants_sql(spark):
    con = duckdb.connect()
    con.read_parquet(f"{SF}/documents.parquet").create_view("documents")
    want = con.execute(variants_sql()).fetchall()
    got = spelling_variants(spark.read.parquet(f"{SF}/documents.parquet")).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert want and sorted(map(tuple, got), key=str) == sorted(want, key=str)


# --------------------------------------------------------------- alignment

def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    one = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/piece_bpe_32k.model")
    letters = align._byte_letters()
    told, count = [], Counter()
    for i, t in rows:
        a = one.encode(" " + t, add_special_tokens=False).ids if t else []
        b = two.encode(t) if t else []
        x = [bytes(letters[c] for c in one.id_to_token(k)) for k in a]
        y = [bytes([int(two.id_to_piece(k)[3:5], 16)]) if two.is_byte(k) else two.id_to_piece(k).replace("▁", " ").encode() for k in b]
        if not t or not b"".join(x) == b"".join(y) == (" " + t).encode():
            told.append((i, 0, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(k) for k in x]).tolist(), np.cumsum([len(k) for k in y]).tolist()
        links = [(a[j], b[k]) for j in range(len(a)) for k in range(len(b))
                 if max(ends_a[j] - len(x[j]), ends_b[k] - len(y[k])) < min(ends_a[j], ends_b[k])]
        groups, p, q = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            j, k = ends_a.index(e) + 1, ends_b.index(e) + 1
            groups.append(",".join(map(str, a[p:j])) + "|" + ",".join(map(str, b[q:k])))
            p, q = j, k
        count.update(set(links))
        told.append((i, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return sorted([(i, n, m, g, len(links), sum(count[k] == most[k[0]] for k in links), sum(count[k] for k in links), sha)
                   for i, n, m, g, links, sha in told], key=str)


ALIGNED = [(1, None), (2, ""), (3, "▁x"), (None, "hello world"), (5, "hello world <|endoftext|> </s>"), (5, "hello world <|endoftext|> </s>"),
           (6, " lead  space \n\n x\ttab "), (7, "日本語 　 é ﬁ \U0001f469‍\U0001f467"), (8, "antidisestablishmentarianism " * 40),
           (9, "a"), (10, " "), (11, "it's 12345 we'll, naïve résumé"), (12, "hello there world")]


@needs_files
@pytest.mark.parametrize("p", [Alignment(), Alignment(run_records=5, chunk_pairs=2, radix=4)])
def test_alignment_equals_brute_force(spark, p):
    got = sorted([tuple(r) for r in alignment(as_docs(spark, ALIGNED), p).collect()], key=str)
    assert got == brute_alignment(ALIGNED)
    assert alignment(as_docs(spark, ALIGNED).limit(0), p).count() == 0


@needs_files
@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_alignment_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 1500")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted([tuple(r) for r in alignment(docs.repartition(4), Alignment(run_records=4000, chunk_pairs=64, radix=8)).collect()], key=str)
    assert rows and got == brute_alignment(rows)


def test_alignment_invalid_utf8_has_no_tokens():
    class Any:
        bytes = [b" ", b"x"]
    assert align.Aligner(Any, Any)(b"\xff\xfe") is None


def test_packing_round_trip():
    rng = np.random.default_rng(2)
    for dtype in (np.uint8, np.uint32, np.int64, np.uint64):
        x = rng.integers(0, 200, rng.integers(0, 50)).astype(dtype)
        y, z = align.unpack(align.pack(x, x[::-1]))
        assert y.dtype == x.dtype and (y == x).all() and (z == x[::-1]).all()
    lengths = np.array([0, 3, 0, 2, 1])
    x = np.array([5, 9, 11, 2, 7, 4], np.int64)
    starts = (np.cumsum(lengths) - lengths)[lengths > 0]
    assert (align._sums(align._steps(x, starts), lengths) == x).all()


def test_merge_counts_over_many_chunks():
    rng = random.Random(4)
    n_b, chunks, want = 50, [], Counter()
    for run in range(9):
        have = sorted({rng.randrange(20) * n_b + rng.randrange(6) for _ in range(40)})
        docs = [rng.randint(1, 5) for _ in have]
        for c, d in zip(have, docs):
            want[c] += d
        for seq, i in enumerate(range(0, len(have), 7)):
            c = np.array(have[i:i + 7])
            chunks.append(align._Chunk(run, 0, seq, int(c[0]), align.pack(np.diff(c, prepend=c[0]).astype(np.uint64), np.array(docs[i:i + 7], np.uint32)), n_b))
    most = defaultdict(int)
    for c, d in want.items():
        most[c // n_b] = max(most[c // n_b], d)
    done = list(align.merge(iter(sorted(chunks, key=lambda c: (int(c.codes[0]), c.run, c.seq))), n_b))
    assert len(done) == len(chunks)
    for c in done:
        assert c.count.tolist() == [want[x] for x in c.codes.tolist()]
        assert c.best.tolist() == [want[x] == most[x // n_b] for x in c.codes.tolist()]


# ------------------------------------------------------------- Order MinHash

M64 = (1 << 64) - 1


def _hash(*parts):
    """Spark's xxhash64 of strings and longs."""
    seed = 42
    for x in parts:
        if x is not None:
            seed = xxhash.xxh64_intdigest(x.encode() if isinstance(x, str) else (x & M64).to_bytes(8, "little"), seed)
    return seed


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_print(text, p=OrderMinHash()):
    """By the definition: a counter of k-mers, and for every bin the least of all throws."""
    unit = re.findall(r"(?:[^ \t-\r]{1,6}(?![^ \t-\r])[ \t-\r]+){0,3}[^ \t-\r]+", text or "")
    if not unit:
        return ""
    seen, pairs = Counter(), []
    for i in range(max(len(unit) - p.k + 1, 1)):
        h = _signed(_hash(*unit[i:i + p.k])) >> 24
        pairs.append((_hash(h) if not seen[h] else _hash(h, seen[h]), i))
        seen[h] += 1
    value = (1 << p.round_shift) - 1 & ~0xFFFFFF
    bin_mask = M64 & ~((1 << p.bin_shift) - 1)
    rounds = max(-(-p.throws // len(pairs)), 1) if len(pairs) * 2 <= p.throws else 1
    bins = defaultdict(list)
    for t in range(rounds):
        for v, at in pairs:
            kept = (v & (bin_mask | value)) | at & 0xFFFFFF
            if t:
                kept = (_hash(_signed(kept) >> 24, t) & (bin_mask | value)) | t << p.round_shift | at & 0xFFFFFF
            bins[_signed(kept) >> p.bin_shift].append(_signed(kept))
    out = ""
    for c in range(-p.coords // 2, p.coords // 2):
        two = sorted(sorted(bins[c])[:2], key=lambda x: x & 0xFFFFFF)
        out += f"{_hash(*[x >> 24 for x in two]) & 0xFFFF:04X}"
    return out


def _texts(seed):
    rng = random.Random(seed)
    vocab = ["of", "the", "in"] + ["".join(rng.choice("abcdefé") for _ in range(rng.randint(2, 11))) for _ in range(300)]
    return [" ".join(rng.choice(vocab) for _ in range(n)) for n in (1, 2, 5, 40, 90, 200, 700, 3000)] + ["the the the the " * 300, "x", " \t\n", "", None,
                                                                                                   " tab\tline\n\n end "]


def test_fingerprints_equal_brute_force(spark):
    texts = _texts(5)
    got = {r.doc_id: r.fingerprint for r in fingerprints(as_docs(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute_print(t), (i, t and t[:40])
    k3 = OrderMinHash(k=3, log2_coords=5, throws=200)
    got = {r.doc_id: r.fingerprint for r in fingerprints(as_docs(spark, list(enumerate(texts))), k3).collect()}
    assert all(got[i] == brute_print(t, k3) for i, t in enumerate(texts))


def test_scripts_without_spaces(spark):
    docs = as_docs(spark, [(1, "日本語の文" * 30), (2, "日本語の文" * 29 + "猫"), (3, "กข" * 60)])
    f = {r.doc_id: r.fingerprint for r in fingerprints(docs).collect()}
    near = lambda a, b: np.mean([f[a][i:i + 4] == f[b][i:i + 4] for i in range(0, 256, 4)])
    assert near(1, 2) > 0.7 and near(1, 3) < 0.1


def test_order_counts(spark):
    words = [f"word{i:04d}" for i in range(400)]
    back = words[::-1]
    docs = as_docs(spark, [(1, " ".join(words)), (2, " ".join(back)), (3, " ".join(words[:-1] + ["other"]))])
    f = docs.crossJoin(F.broadcast(fingerprints(docs.where("doc_id = 1")).select(F.col("fingerprint").alias("first"))))
    got = {r.doc_id: r.x for r in fingerprint.with_fingerprint(f, "text", "p").select("doc_id", likeness(F.col("p"), F.col("first")).alias("x")).collect()}
    assert got[1] == 1.0 and got[2] < 0.1 and got[3] > 0.9


def brute_report(rows):
    own = {}
    for i, t in rows:
        if i is not None:
            own[i] = min(own.get(i, t or ""), t or "", key=str.encode)
    ids, out = sorted(own, reverse=True), set()
    near = lambda a, b: 1.0 if a == b else 0.0 if not a or not b else sum(a[i:i + 4] == b[i:i + 4] for i in range(0, len(a), 4)) / (len(a) // 4)
    for at, i in enumerate(ids):
        t, follow = own[i], own[ids[(at + 1) % len(ids)]]
        half = len(t) // 2
        new = t[:len(t) - half] + follow[:half]
        a, b, c = brute_print(t), brute_print(new), brute_print(follow)
        out.add((i, len(t), hashlib.sha256(new.encode()).hexdigest(), a, b, near(a, b), near(a, c)))
    return out | {(None, len(t or ""), None, brute_print(t), None, None, None) for i, t in rows if i is None}


def test_edit_likeness_equals_brute_force(spark):
    texts = _texts(9)
    ids = [0, 1, 63, 64, 65, 300, 301, 5000, -7, 10**12, 10**12 + 1, -(10**15), 66, 67]
    rows = list(zip(ids, texts)) + [(64, "a second text of one id"), (64, texts[3]), (None, "no id here"), (None, None), (68, texts[6]), (69, texts[6])]
    got = [tuple(r) for r in edit_likeness(as_docs(spark, rows)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_report(rows)
    assert edit_likeness(as_docs(spark, rows[:1])).first().near_next == 1.0
    assert edit_likeness(as_docs(spark, rows).limit(0)).count() == 0
    assert edit_likeness(as_docs(spark, [(None, "x")])).count() == 1


def test_edit_likeness_plan_is_native(spark):
    df = edit_likeness(as_docs(spark, [(i, f"text number {i}") for i in range(200)]))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_next_below(spark):
    rng = random.Random(6)
    keys = sorted({rng.randrange(-10**6, 10**6) for _ in range(500)} | {0, 1, 2, -10**9, 10**9})
    got = {r.k: r.below for r in next_below(spark.createDataFrame([(k,) for k in keys], "k bigint"), keys[0], keys[-1]).collect()}
    assert got == {k: (keys[i - 1] if i else None) for i, k in enumerate(keys)}
