"""DataFrame operators: cleaning, integration and report aggregates."""

import pytest
from pyspark.sql import functions as F

from civic_indicators.operators import (
    PanelSpec, column_frequencies, daily_counts, distinct_concat, distinct_counts, distinct_with_null, drop_empty,
    first_values, indicator_panel, monthly_panels, null_sentinels, outer_merge, per_key, pivot_counts,
    preview, profile, recode, split_valid, sum_by, value_counts,
)
from civic_indicators.operators.clean import missing_any
from civic_indicators.sources import drop_columns, normalize_headers, rename_by_pattern, unique_names
from tests.conftest import rows


def test_unique_names_and_collisions(spark):
    assert unique_names(["NUMERO", "a", "NUMERO", "NUMERO"]) == ["NUMERO", "a", "NUMERO.1", "NUMERO.2"]
    df = spark.createDataFrame([(1, 2)], ["Número Documento", "Número documento"])
    with pytest.raises(ValueError):
        normalize_headers(df)
    df = spark.createDataFrame([(1, 2, 3)], ["Número Documento", "NUMERO.1", "Unnamed: 22"])
    out = drop_columns(rename_by_pattern(normalize_headers(df), "numero.1", "persona"), ["unnamed:_22"])
    assert out.columns == ["número_documento", "persona"]


def test_sentinels_and_recode(spark):
    df = spark.createDataFrame([("nan", 1), (" nan", 2), (None, 3)], "a string, n int")
    assert rows(null_sentinels(df), "a") == [(None,), (" nan",), (None,)]
    df = spark.createDataFrame([("técnico",), ("pfofesional",), ("otro",), (None,)], "e string")
    from civic_indicators.functions.patterns import EDUCATION_RECODE
    assert [r[0] for r in rows(recode(df, "e", EDUCATION_RECODE))] == ["tecnico", "universitario", "otro", None]


def test_drop_empty_and_quarantine_split(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", None), (3, None, "b"), (4, "a", "b"), (5, "nan", "b")],
                               "id int, t string, n string")
    assert sorted(r[0] for r in rows(drop_empty(df, ["t", "n"]), "id")) == [2, 3, 4, 5]
    df = null_sentinels(df)
    valid, rejected = split_valid(df, missing_any("t", "n"))
    assert sorted(r[0] for r in rows(valid, "id")) == [4]
    assert sorted(r[0] for r in rows(rejected, "id")) == [1, 2, 3, 5]
    assert valid.count() + rejected.count() == df.count()


def test_first_values_by_order(spark):
    df = spark.createDataFrame([("k", 3, "c", None), ("k", 1, None, None), ("k", 2, "b", None),
                                (None, 0, "z", "z"), ("j", 5, None, None)], "key string, o int, a string, b string")
    got = sorted(rows(first_values(df, "key", ["a", "b"], "o"), "key", "a", "b"))
    assert got == [("j", None, None), ("k", "b", None)]


def test_distinct_concat_is_ordered_and_partition_independent(spark):
    data = [("p", 1, "u"), ("p", 2, "u"), ("p", 3, "w"), ("p", 4, None), ("q", 1, None), ("p", 0, "v")]
    df = spark.createDataFrame(data, "key string, o int, v string")
    for n in (1, 3, 7):
        got = dict(rows(distinct_concat(df.repartition(n), "key", ["v"], "o"), "key", "v"))
        assert got == {"p": "v,u,w", "q": ""}


def test_per_key_combines_first_and_concat(spark):
    df = spark.createDataFrame([("p", 2, "x", "b"), ("p", 1, None, "a"), ("p", 3, "y", "a")],
                               "key string, o int, f string, c string")
    assert rows(per_key(df, "key", "o", first=["f"], concat=["c"]), "key", "f", "c") == [("p", "x", "a,b")]


def test_outer_merge_left_wins_unless_null(spark):
    left = spark.createDataFrame([("1", "l1", 10), ("2", None, 20), ("3", "l3", 30), (None, "ln", 40)],
                                 "k string, v string, only_l int")
    right = spark.createDataFrame([("2", "r2", "x"), ("3", "r3", "y"), ("4", "r4", "z")],
                                  "k string, v string, only_r string")
    got = sorted(rows(outer_merge(left, right, "k"), "k", "v", "only_l", "only_r"), key=str)
    assert got == sorted([("1", "l1", 10, None), ("2", "r2", 20, "x"), ("3", "l3", 30, "y"),
                          (None, "ln", 40, None), ("4", "r4", None, "z")], key=str)


def test_panel_counts(spark):
    spec = PanelSpec(sex_col="sexo", male="m", female="f", flags={"disability": "d"}, age_col="edad")
    df = spark.createDataFrame([("m", 28, "x", True), ("f", 29, None, True), (None, 59, "y", True),
                                ("m", 60, None, True), ("f", 0, None, True), ("m", 70, "z", False)],
                               "sexo string, edad int, d string, c boolean")
    got = dict(rows(indicator_panel(df, F.col("c"), spec), "indicator", "value"))
    assert got == {"men": 2, "women": 2, "disability": 2, "elders": 1, "adults": 1, "youth": 2}
    empty = dict(rows(indicator_panel(df, F.lit(False), spec), "indicator", "value"))
    assert set(empty.values()) == {0}


def test_monthly_panels_tag_each_cohort(spark):
    import datetime as dt
    spec = PanelSpec(sex_col="s", male="m", female="f", flags={}, age_col="a")
    df = spark.createDataFrame([("m", 30, dt.date(2025, 3, 2), "x"), ("f", 20, dt.date(2025, 3, 9), "x"),
                                ("m", 65, dt.date(2025, 4, 1), "y"), ("m", 65, None, "x")],
                               "s string, a int, d date, ch string")
    out = monthly_panels(df, {"x": F.col("ch") == "x", "all": F.lit(True)}, spec, "d")
    got = {(c, y, m, i): v for c, y, m, i, v in rows(out, "cohort", "year", "month", "indicator", "value")}
    assert got[("x", 2025, 3, "men")] == 1 and got[("x", 2025, 3, "women")] == 1
    assert got[("all", 2025, 4, "elders")] == 1 and ("x", 2025, 4, "men") not in got


def test_distinct_with_null_and_sums(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "e string, p int")
    assert df.agg(distinct_with_null("e")).first()[0] == 2
    assert df.filter("false").agg(distinct_with_null("e")).first()[0] == 0
    assert sorted(rows(sum_by(df, "e", "p"), "e", "total")) == [("a", 3)]


def test_distinct_counts_is_exact_without_expand(spark):
    # A third of all rows hold one value of v; w is null on as many; u has ties and repeats.
    data = [("g" if i % 5 else None, "hot" if i % 3 == 0 else f"v{i % 40}", None if i % 3 == 1 else i % 7, i % 2, i) for i in range(600)]
    df = spark.createDataFrame(data, "g string, v string, w int, u int, n bigint").repartition(7)
    got = distinct_counts(df, {"vs": "v", "ws": "w", "us": "u"}, by=["g"], sums={"total": "n"})
    plan = got._jdf.queryExecution().toString()
    assert "Expand" not in plan
    want = set()
    for g in ("g", None):
        own = [r for r in data if r[0] == g]
        want.add((g, *(len({r[k] for r in own}) for k in (1, 2, 3)), sum(r[4] for r in own)))
    assert set(map(tuple, got.collect())) == want
    assert tuple(distinct_counts(df.filter("false"), {"vs": "v", "ws": "w"}, sums={"total": "n"}).first()) == (0, 0, 0)
    assert tuple(distinct_counts(df, {"ws": "w"}).first()) == (8,)


def test_value_counts_and_frequencies(spark):
    df = spark.createDataFrame([("x", "1"), ("y", "1"), ("x", None), (None, "2")], "a string, b string")
    assert rows(value_counts(df, "a"), "a", "count") == [("x", 2), ("y", 1)]
    freq = {(c, v): n for c, v, n in rows(column_frequencies(df), "column", "value", "count")}
    assert freq == {("a", "x"): 2, ("a", "y"): 1, ("b", "1"): 2, ("b", "2"): 1}
    assert sum(n for (c, _), n in freq.items() if c == "a") == df.filter("a is not null").count()


def test_pivot_counts_drop_null_keys_and_fill_zero(spark):
    df = spark.createDataFrame([("18-28", "m", "Visual"), ("18-28", "m", "Física"), (None, "f", "Visual"),
                                ("29-39", None, "Visual"), ("29-39", "f", None), ("29-39", "f", "Visual")],
                               "r string, s string, d string")
    got = {(r, s): (v, f) for r, s, v, f in rows(pivot_counts(df, ["r", "s"], "d", ["Visual", "Física"]),
                                                  "r", "s", "Visual", "Física")}
    assert got == {("18-28", "m"): (1, 1), ("29-39", "f"): (1, 0)}


def test_profile_daily_counts_preview(spark):
    df = spark.createDataFrame([(1, "a", "2025-01-02"), (2, None, "2025-01-01"), (3, "c", "2025-01-02")],
                               "id int, t string, d string")
    prof = {c: (t, nn, n) for c, t, nn, n in rows(profile(df), "column", "type", "non_null", "rows")}
    assert prof["t"] == ("string", 2, 3) and prof["id"] == ("int", 3, 3)
    assert rows(daily_counts(df, "d", "2025-01-02"), "d", "count") == [("2025-01-01", 1), ("2025-01-02", 2)]
    assert [r[0] for r in rows(preview(df, "id", 2), "id")] == [1, 2]


def test_csv_scan_keeps_sheet_style_headers(spark, tmp_path):
    from civic_indicators.sources import scan
    path = tmp_path / "log.csv"
    path.write_text('MES,NUMERO,"Programa / Aliado\n(Si aplica)",NUMERO,\n'
                    'abril,1,x,100,\nmayo,2,"y, z",200,\n', encoding="utf-8")
    df = scan(spark, str(path), "csv", multiLine="true")
    assert df.columns == ["MES", "NUMERO", "Programa / Aliado\n(Si aplica)", "NUMERO.1", "Unnamed: 4"]
    assert sorted(rows(df, "NUMERO.1", "Programa / Aliado\n(Si aplica)")) == [("100", "x"), ("200", "y, z")]


def test_id_sets(spark):
    from civic_indicators.operators import drop_ids, keep_ids, mark_ids, union_ids
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "id int, v string")
    ids = union_ids(spark.createDataFrame([(1,), (3,)], "id int"), spark.createDataFrame([(3,), (None,)], "id int"))
    assert sorted(r[0] for r in rows(ids, "id") if r[0] is not None) == [1, 3]
    assert sorted(r[0] for r in rows(keep_ids(df, ids, "id"), "v")) == ["a", "c"]
    assert sorted(r[0] for r in rows(drop_ids(df, ids, "id"), "v")) == ["b", "d"]
    assert sorted(rows(mark_ids(df, ids, "id"), "v", "in_ids")) == [("a", True), ("b", False), ("c", True),
                                                                    ("d", False)]


def test_coalesce_join_other_join_types(spark):
    from civic_indicators.operators import coalesce_join
    left = spark.createDataFrame([("1", None, 10), ("2", "l2", 20)], "k string, v string, a int")
    right = spark.createDataFrame([("1", "r1", "x"), ("3", "r3", "y")], "k string, v string, b string")
    assert sorted(rows(coalesce_join(left, right, "k", "left"), "k", "v", "a", "b")) == [
        ("1", "r1", 10, "x"), ("2", "l2", 20, None)]
    assert rows(coalesce_join(left, right, "k", "inner"), "k", "v", "a", "b") == [("1", "r1", 10, "x")]
    assert len(rows(coalesce_join(left, right, "k"), "k")) == 3          # full outer


def test_named_cohorts_and_stamp(spark):
    import datetime as dt
    from civic_indicators.functions import stamp
    from civic_indicators.operators.cohorts import age_group, cohort
    df = spark.createDataFrame([(dt.date(2025, 4, 2), 1, "abril", 30), (dt.date(2024, 4, 9), 0, "abril", 61)],
                               "d date, placed int, m string, age int")
    got = rows(df.select(cohort("sent", "d", 4).alias("a"), cohort("sent", "d", 4, 2025).alias("b"),
                         cohort("placed", "placed", "m", "abril").alias("c"), age_group("age", 29, 60).alias("e")))
    assert got == [(True, True, True, True), (True, False, False, False)]
    assert rows(stamp(df, "2025-01-31").select(F.col("run_date").cast("string")).distinct()) == [("2025-01-31",)]


def test_disability_report_tables(spark):
    from civic_indicators.plans import placement as PL
    from tests.test_flows import placement_sheet
    report = PL.disability_report(PL.placement(placement_sheet(spark)), 4, "abril")
    assert set(report) == {"sent_with_disability", "sent_pivot", "placed_pivot", "posts_per_employer",
                           "placed_per_employer", "placed_per_vacancy"}
    assert report["sent_with_disability"].first()["count"] == 1
    assert rows(report["placed_per_employer"], "nombre_de_la_empresa", "count") == [("acme", 1)]


def test_fixture_rows_for_concat_and_panel_ages(spark):
    df = spark.createDataFrame([("p", 1, "u"), ("p", 2, "u"), ("p", 3, "w"), ("p", 4, None),
                                ("q", 1, None), ("q", 2, None)], "key string, o int, v string")
    assert dict(rows(distinct_concat(df, "key", ["v"], "o"), "key", "v")) == {"p": "u,w", "q": ""}
    spec = PanelSpec(sex_col="s", male="m", female="f", flags={}, age_col="a")
    ages = spark.createDataFrame([("m", 28), ("f", 29), ("m", 59), ("f", 60), ("m", 0)], "s string, a int")
    got = dict(rows(indicator_panel(ages, F.lit(True), spec), "indicator", "value"))
    assert (got["youth"], got["adults"], got["elders"]) == (2, 2, 1)


def test_per_key_holds_the_order_once_and_agrees_with_plain_python(spark):
    data = [("p", 1, 5, "x", None, "a", "u"), ("p", 0, 9, None, 7, "b", None), ("p", 0, 9, None, 7, "b", None), ("p", 2, 1, "z", 8, "a", "v"),
            ("q", None, 3, None, None, None, "v"), ("q", 4, None, None, 6, "c", "v"), ("r", 1, 1, None, None, None, None), (None, 0, 0, "n", 1, "n", "n")]
    df = spark.createDataFrame(data, "k string, o1 int, o2 int, f string, g int, c string, d string")
    for order in (["o1", "o2"], ["o2"]):
        out = per_key(df, "k", order, first=["f", "g", "o1", "o2"], concat=["c", "d"])
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "min_by" not in plan and plan.count("min(") == 1  # one row with its order per group, not an order per column
        at = [df.columns.index(c) for c in order]
        known = lambda r: len(at) > 1 or r[at[0]] is not None
        rank = lambda r: [(r[i] is not None, r[i] or 0) for i in at]
        want = []
        for k in ("p", "q", "r"):
            mine = sorted((r for r in data if r[0] == k), key=rank)
            first = [next((r[df.columns.index(c)] for r in mine if known(r) and r[df.columns.index(c)] is not None), None) for c in ("f", "g", "o1", "o2")]
            # a value is placed by its rows that have an order; one that has none comes first
            placed = lambda c: sorted({r[c] for r in mine if r[c] is not None}, key=lambda v: min(
                ((1, rank(r)) for r in mine if r[c] == v and known(r)), default=(0, [])))
            want.append((k, *first, ",".join(placed(5)), ",".join(placed(6))))
        assert sorted(rows(out)) == want


def test_per_key_first_value_without_an_order_of_its_own(spark):
    df = spark.createDataFrame([("p", 2, {"a": 1}, "x"), ("p", 1, {"b": 2}, "y")], "k string, o int, m map<string,int>, c string")
    assert rows(per_key(df, "k", "o", first=["m"], concat=["c"]), "k", "m", "c") == [("p", {"b": 2}, "y,x")]
