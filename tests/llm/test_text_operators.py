"""Decontamination, mixing, personal data, HTML: brute force, round trips, edge rows."""

import datetime as dt
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from civic_indicators.llm import pii
from civic_indicators.llm.decontaminate import TilingParams, contaminated, drop_contaminated, tile
from civic_indicators.llm.html_text import extract, main_text
from civic_indicators.llm.mixing import MixParams, allocate, mix
from civic_indicators.llm.queries import mix_sql

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def naive_tiles(item, doc, least):
    free_i, free_d, out = [True] * len(item), [True] * len(doc), []
    while True:
        best = (0, 0, 0)
        for a in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while (a + n < len(item) and d + n < len(doc) and item[a + n] == doc[d + n] != 0 and free_i[a + n] and free_d[d + n]):
                    n += 1
                if n > best[0]:
                    best = (n, a, d)
        n, a, d = best
        if n < least:
            return out
        out.append(n)
        for j in range(n):
            free_i[a + j] = free_d[d + j] = False


def test_tiling_covers_as_the_naive_greedy():
    rng = random.Random(5)
    for _ in range(60):
        item = [rng.randint(1, 9) for _ in range(rng.randint(1, 18))]
        doc = [rng.randint(0, 9) for _ in range(rng.randint(1, 25))]
        got = tile(np.array(item, np.uint64), np.array(doc, np.uint64), 3)
        want = naive_tiles(item, doc, 3)
        assert got[:1] == want[:1] and got == sorted(got, reverse=True)
        assert sum(got) <= len(item)


def test_contaminated_pairs(spark, make_docs):
    w = ITEM.split()
    swapped = " ".join(w[10:] + ["noise"] * 3 + w[:10])
    docs = make_docs((1, "start " + ITEM.upper() + ", end"), (2, swapped), (3, " ".join(w[:6]) + " other words"), (4, None), (5, ""),
                     (6, "x " * 20_000 + ITEM), (None, ITEM), (7, "short one"), (1, "start " + ITEM.upper() + ", end"))
    bench = spark.createDataFrame([(10, ITEM, 1), (11, None, 1), (12, "", 1), (13, "short one", 1), (None, ITEM, 1)], "item_id bigint, text string, doc_id int")
    got = {(r.doc_id, r.item_id): r for r in contaminated(docs, bench).collect()}
    assert set(got) == {(1, 10), (2, 10), (6, 10), (7, 13)}
    assert got[2, 10].tiles == 2 and got[2, 10].coverage == 1.0 and got[1, 10].longest == 20
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "5", "None"]
    assert contaminated(docs, bench.limit(0)).count() == 0 and contaminated(docs.limit(0), bench).count() == 0
    assert contaminated(docs, bench, TilingParams(coverage=0.3)).where("doc_id = 3").count() == 1


def brute_mix(rows, p, domain):
    leaves = {}
    for i, t, lang, src in rows:
        leaves.setdefault((domain(src), lang or "(none)", src or "(none)"), []).append((i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), t or ""))
    tokens = {k: sum(n for _, n, _ in v) for k, v in leaves.items()}

    def cap(path):
        return sum(t for k, t in tokens.items() if k[:len(path)] == path) * p.max_epochs

    alloc = {}

    def give(path, offer):
        if len(path) == 3:
            alloc[path] = int(offer + 1e-9)
            return
        kids = sorted({k[:len(path) + 1] for k in tokens if k[:len(path)] == path})
        live = {k: p.weights.get(k, p.default_weight) for k in kids}
        live = {k: w for k, w in live.items() if w > 0}
        got = {}
        while live:
            level = (offer - sum(got.values())) / sum(live.values())
            full = [k for k, w in live.items() if cap(k) <= level * w]
            if not full:
                got.update({k: level * w for k, w in live.items()})
                break
            for k in full:
                got[k] = cap(k)
                del live[k]
        for k, v in got.items():
            give(k, v)

    total = p.budget if p.budget is not None else sum(tokens.values()) * p.share[0] / p.share[1]
    give((), total)
    out = []
    for leaf, a in alloc.items():
        t = tokens[leaf]
        full = a // t if t else 0
        for e in range(full):
            out += [(i, e) for i, _, _ in leaves[leaf]]
        rest, used = a - full * t, 0
        if rest:
            order = [(hashlib.md5(f"{p.seed}|{full}|{'null' if i is None else i}".encode()).digest(), hashlib.md5(t.encode()).digest(), i, n) for i, n, t in leaves[leaf]]
            for _, _, i, n in sorted(order, key=lambda x: x[:2]):
                if used + n > rest:
                    break
                used += n
                out.append((i, full))
    return sorted(out, key=str)


@pytest.mark.parametrize("share", [(1, 2), (9, 10), (3, 1)])
def test_mixture_matches_brute_force(make_docs, share):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40])), rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(300)]
    p = MixParams(levels=("CASE WHEN source IN ('a', 'b') THEN 'x' ELSE 'y' END", "lang", "source"),
                  weights={("x",): 1, ("y",): 3, ("x", "en"): 5, ("x", "de", "b"): 0}, share=share, max_epochs=2, bucket_digits=1)
    docs = make_docs(*rows).withColumn("_full", F.lit("mine"))
    got = mix(docs, p)
    assert got.columns[:len(docs.columns)] == docs.columns
    assert sorted(((r.doc_id, r.mix_epoch) for r in got.collect()), key=str) == brute_mix(rows, p, lambda s: "x" if s in ("a", "b") else "y")


def test_copies_at_the_cut_stay_within_the_budget(make_docs):
    rows = [(1, "a b c")] * 6 + [(2, "d e")] * 3
    for budget in (5, 12, 23):
        p = MixParams(levels=("'x'", "lang", "source"), budget=budget, max_epochs=1, bucket_digits=1)
        got = mix(make_docs(*rows), p).collect()
        assert sum(r.mix_tokens for r in got) <= budget
        assert sorted(((r.doc_id, r.mix_epoch) for r in got), key=str) == brute_mix([(i, t, "en", "src0") for i, t in rows], p, lambda s: "x")


@pytest.mark.parametrize("weights", [{}, {("web",): 2, ("web", "de"): 3}])
def test_mixture_sql_gives_the_same_rows(make_docs, weights):
    rng = random.Random(6)
    base = [(rng.choice([None, *range(30)]), " ".join(["w"] * rng.choice([0, 1, 3, 7])), rng.choice(["en", "de", None]), rng.choice(["a", "b"])) for _ in range(60)]
    rows = base + base[:20] * 3
    p = MixParams(levels=("CASE WHEN source = 'a' THEN 'web' ELSE 'other' END", "lang", "source"), weights=weights, share=(2, 3), max_epochs=2, bucket_digits=1)
    docs = make_docs(*rows)
    got = mix(docs, p).selectExpr("doc_id", "mix_level_0", "mix_level_1", "mix_level_2", "mix_tokens", "mix_epoch").collect()
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    want = con.execute(mix_sql(p)).fetchall()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sorted(((r[0], r[5]) for r in got), key=str) == brute_mix(rows, p, lambda s: "web" if s == "a" else "other")


def test_mixture_edges(make_docs):
    p = MixParams(levels=("source",), share=(1, 1))
    assert mix(make_docs((1, "a")).limit(0), p).count() == 0
    assert mix(make_docs((1, None), (2, "")), p).count() == 0            # no tokens, nothing to give
    assert mix(make_docs((1, "a b"), (1, "a b"), (None, "c")), p).count() == 3
    long = make_docs((1, "w " * 50_000), (2, "v"))
    assert mix(long, p).count() == 2
    leaves = make_docs((1, "a")).select(F.lit("s").alias("_l0"), F.lit(10).cast("bigint").alias("t"))
    assert allocate(leaves, MixParams(levels=("source",), budget=25)).first().alloc == 25


def luhn(d):
    return sum((int(c) * 2 - 9 * (int(c) > 4)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def test_pseudonyms(make_docs):
    card, bad = "4556737586899855", "4556737586899856"
    assert luhn(card) and not luhn(bad)
    texts = [f"pay {card} or 4556-7375-8689-9855 now", f"bad {bad} 999.1.1.1", "call +1 (988) 555-2485 / 988-555-2485", "ip 10.1.2.3, born 1987-03-04 or 04/03/1987",
             "x 31/02/2020 y 123-45-6789 z 000-45-6789", "Mail Ann.Lee@mail.example.org!", None, "", "v 1.2.3.4.5 and 2024-13-45", "7" * 30]
    got = {r.doc_id: r for r in pii.pseudonymise(make_docs(*enumerate(texts)), key="k").collect()}
    a, b = re.findall(r"\d[\d\-]{14,}\d", got[0].text)
    assert a == b.replace("-", "") != card and luhn(a) and re.fullmatch(r"(\d{4}-){3}\d{4}", b)
    assert got[1].text == texts[1] and got[1].n_found == 0
    p = re.findall(r"\d{3}\D{1,2}\d{3}-\d{4}", got[2].text)
    assert got[2].kinds == ["phone", "phone"] and len({re.sub(r"\D", "", x) for x in p}) == 1 and "+1 (" in got[2].text and "555-2485" not in got[2].text
    assert got[3].kinds == ["ip", "date", "date"] and "10.1.2.3" not in got[3].text
    iso, dmy = re.search(r"\d{4}-\d\d-\d\d", got[3].text)[0], re.search(r"\d\d/\d\d/\d{4}", got[3].text)[0]
    assert dt.date.fromisoformat(iso) == dt.datetime.strptime(dmy, "%d/%m/%Y").date() != dt.date(1987, 3, 4)
    assert got[4].kinds == ["ssn"] and "31/02/2020" in got[4].text and "000-45-6789" in got[4].text
    assert got[5].kinds == ["email"] and "Ann" not in got[5].text and got[5].text.endswith("@example.com!")
    assert got[6].text is None and got[7].text == "" and got[8].text == texts[8] and got[9].text == texts[9]
    assert {r.doc_id: r.text for r in pii.pseudonymise(make_docs(*enumerate(texts)), key="k").collect()} == {i: r.text for i, r in got.items()}


def test_cards_beside_numbers_and_all_date_orders(spark, make_docs):
    card, other = "4111 1111 1111 1111", "4556-7375-8689-9855"
    texts = [f"{card} 12/25", "4111111111111111 123 x", f"12 {card}", f"1234 {card} 99", f"{card} {other}", f"{card} 988-555-2485", f"{card} 123-45-6789",
             f"{card} 10.1.2.3", "born 12/25/2020", "5/3/1999, 05/03/1999 and 12-25-2020", "13/13/2020 0/1/2020", "4111111111111112 123", "12/25/1999 12/26/1999",
             "4111111111111111@example.com", "1 2 3 4 " * 100]
    got = {r.doc_id: r for r in pii.pseudonymise(make_docs(*enumerate(texts)), key="k").collect()}
    for i, tail in ((0, " 12/25"), (1, " 123 x")):
        assert got[i].kinds == ["card"] and got[i].text.endswith(tail) and luhn(re.sub(r"\D", "", got[i].text[:-len(tail)])) and "1111" not in got[i].text
    assert got[2].kinds == ["card"] and got[2].text == "12 " + got[0].text[:19]
    assert got[3].kinds == ["card"] and got[3].text == "1234 " + got[0].text[:19] + " 99"
    assert got[4].kinds == ["card", "card"] and got[4].text.startswith(got[0].text[:19] + " ") and luhn(got[4].text[20:].replace("-", "")) and other not in got[4].text
    assert [got[i].kinds for i in (5, 6, 7)] == [["card", "phone"], ["card", "ssn"], ["card", "ip"]]
    assert got[8].kinds == ["date"] and dt.datetime.strptime(got[8].text[5:], "%m/%d/%Y").day > 12 and got[8].text != texts[8]
    assert got[9].kinds == ["date"] * 3
    a, b = (dt.datetime.strptime(x, "%d/%m/%Y") for x in re.findall(r"\d+/\d+/\d+", got[9].text))
    assert a == b != dt.datetime(1999, 3, 5) and dt.datetime.strptime(got[9].text[-10:], "%m-%d-%Y").day > 12
    assert got[10].text == texts[10] and got[11].text == texts[11] and got[11].n_found == 0
    assert got[12].kinds == ["date", "date"] and len(set(got[12].text.split())) == 2
    assert got[13].kinds == ["email"] and len(got[14].text) == len(texts[14])
    late = sorted(str(r.d) for r in spark.range(88497).select(pii._late_day(F.col("id")).alias("d")).collect())
    days = (dt.date(1800, 1, 1) + dt.timedelta(i) for i in range(146097))
    assert late == [str(d) for d in days if d.day > 12]


def test_feistel_is_a_permutation(spark):
    lit = F.lit
    out = spark.range(189 * 7).select(pii.feistel(F.floor(F.col("id") / 7), F.col("id") % 7, lit(189).cast("bigint"), lit(7).cast("bigint"), "k", "t").alias("p"))
    assert sorted((r.p.l, r.p.r) for r in out.collect()) == [(i, j) for i in range(189) for j in range(7)]
    ten = spark.range(1000).select(pii.digits_permuted(F.lpad(F.col("id").cast("string"), 3, "0"), "k", "t").alias("d"))
    assert sorted(r.d for r in ten.collect()) == [f"{i:03d}" for i in range(1000)]


def test_main_text():
    page = ("<!DOCTYPE html><html><head><title>no</title><script>var a='</p>';</script></head><body class='has-sidebar'><header>Site</header>"
            "<nav><ul><li><a href=/>Home</a></li></ul></nav><div class='cookie-notice'>We use cookies</div><article><header><h1>Title &amp; more</h1></header>"
            "<p>One <b>bold<br>next</b> line &eacute;.<p>Short.<ul><li>a<li>b</ul><form><input>Name</form><div id=comments><p>A reader's long, long comment here.</p></div></article>"
            "<aside>Related</aside><div class='ad banner'>Buy</div><footer>&copy; 2020</footer></body></html>")
    assert main_text(page) == "Title & more\n\nOne bold next line é.\n\nShort.\n\na\n\nb"
    assert main_text(None) == main_text("") == main_text("<html><body><nav>x</nav></body></html>") == ""
    plain = ("<body><div class=menu>m</div><div><div><h2>Head</h2><p>" + "Long text of words, " * 30 + "</p><p>Again, " + "more words " * 30
             + "</p></div></div><div><a href=x>link one</a> <a href=y>link two</a></div>")
    got = main_text(plain)
    assert got.startswith("Head\n\nLong text") and "link" not in got and "m\n" not in got
    assert main_text("<article><p>cut off in a tag<p") == "cut off in a tag"
    assert main_text("<article><p>5 < 6 and &unknown; &am") == "5 < 6 and &unknown; &am"


def test_parts_named_by_class_do_not_take_the_article():
    text = "Long text of words, " * 30
    want = text.strip()
    for open_ in ("<div class='content with-sidebar'>", "<div id='page' class='has-header no-comments'>", "<section class='share-price'>", "<div class='two-col without_menu'>"):
        for tag in ("article", "div"):
            page = f"<body>{open_}<{tag}><p>{text}</p></{tag}><div class='related'><a href=x>More</a></div></{open_[1:].split()[0]}></body>"
            assert main_text(page) == want, page
    assert main_text(f"<body><article><h1>Head</h1><div class='share-price'><p>{text}</p></div><div class=ad>Buy</div></article></body>") == "Head\n\n" + want
    talk = "<div id=comments>" + "<article class=comment-body><p>A reader's view of it all.</p></article>" * 60 + "</div>"
    assert main_text(f"<body><article><p>{text}</p>{talk}</article></body>") == main_text(f"<body><article><p>{text}</p></article>{talk}</body>") == want
    assert main_text(f"<body><div class='share-price'><article><p>{text}</p>{talk}</article></div></body>") == want


def test_extract_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<p>é x</p>", 5), (2, None, None, 5), (1, "u", "<p>é x</p>", 5), (None, "v", "plain", 6), (4, "w", "<p>" + "word " * 40_000, 7)],
                                  "page_id bigint, url string, html string, text int")
    got = sorted((str(r.page_id), r.url or "", r.n_chars, r.text[:5]) for r in extract(pages).collect())
    assert got == [("1", "u", 3, "é x"), ("1", "u", 3, "é x"), ("2", "", 0, ""), ("4", "w", 199_999, "word "), ("None", "v", 5, "plain")]
    assert extract(pages.limit(0)).count() == 0


def test_deeply_nested_named_parts_are_quick():
    import time
    for depth in (3, 600):
        page = "<body>" + "<div class=ad>" * depth + "<p>some words here</p>" + "</div>" * depth
        start = time.time()
        assert main_text(page) == "some words here"
        assert time.time() - start < 5
