"""Column functions on the edge rows of each operator."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from civic_indicators.functions import (
    band, concat_present, day_text, digits_or_null, integral_or_null, iso_week, iso_year, latest,
    matches, null_if_in, parse_mixed_date, period, round_half_even, strip, to_number, to_ts,
)
from tests.conftest import rows


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}").orderBy("i")


def test_strip_removes_every_unicode_space(spark):
    df = one_col(spark, ["  a  ", " b ", "\tc\n", "\x1cd\x1f", None, " "])
    assert [r[0] for r in rows(df.select(strip("v")))] == ["a", "b", "c", "d", None, ""]


def test_strip_matches_python_strip_on_every_space(spark):
    from civic_indicators.functions.text import _EDGE_SPACE, WHITESPACE_CHARS
    assert all(ch.isspace() for ch in WHITESPACE_CHARS)
    assert {c for c in map(chr, range(0x3001)) if c.isspace()} == set(WHITESPACE_CHARS)
    values = [f"{a}x y{b}" for a in WHITESPACE_CHARS for b in WHITESPACE_CHARS[::3]] + ["", "  ", "a", None]
    df = one_col(spark, values)
    got = rows(df.select(strip("v"), F.regexp_replace("v", _EDGE_SPACE, "")))
    assert all(a == b for a, b in got)
    assert [r[0] for r in got[:-4]] == [v.strip() for v in values[:-4]]


def test_only_exact_sentinel_becomes_null(spark):
    df = one_col(spark, ["nan", " nan", None, ""])
    assert [r[0] for r in rows(df.select(null_if_in("v", ["nan"])))] == [None, " nan", None, ""]


def test_mixed_date_parser(spark):
    values = ["45678", "03-02-2025", "3-2-2025", "03/02/2025 10:20", "03/25/2025", "2025-02-03",
              "31-02-2025", "20250203", "hola", "", None, " 03.02.2025 ", "2025-02-03 08:00:00"]
    df = one_col(spark, values)
    got = [r[0] for r in rows(df.select(day_text(parse_mixed_date("v"))))]
    assert got == ["2025-01-21", "2025-02-03", "2025-02-03", "2025-02-03", "2025-03-25", "2025-02-03",
                   None, None, None, None, None, "2025-02-03", "2025-02-03"]
    swapped = [r[0] for r in rows(df.select(day_text(parse_mixed_date("v", iso_dayfirst=True))))]
    assert swapped[5] == "2025-03-02"


def test_mixed_date_parser_paths_agree(spark):
    values = ["45678", "03-02-2025", "3-2-2025", "03/02/2025 10:20", "03/25/2025", "2025-02-03", "31-02-2025",
              "20250203", "hola", "", None, "03.02.2025", "2025-02-03 08:00:00", "2025-02-03T08:00", "9999999999"]
    df = one_col(spark, values)
    for iso in (False, True):
        by_name = rows(df.select(parse_mixed_date("v", iso, trimmed=True)))
        by_col = rows(df.select(parse_mixed_date(F.col("v"), iso, trimmed=True)))
        assert by_name == by_col


def test_lenient_parse_is_month_first(spark):
    from civic_indicators.functions import to_ts_or_null
    df = one_col(spark, ["03/04/2025", "25/03/2025", "2025-03-04", "2025-03-04 10:00:00", "x", None])
    got = [r[0] for r in rows(df.select(day_text(to_ts_or_null("v"))))]
    assert got == ["2025-03-04", "2025-03-25", "2025-03-04", "2025-03-04", None, None]


def test_strict_parse_raises_on_bad_text(spark):
    df = one_col(spark, ["2025-02-03 10:00:00", "not a date"])
    with pytest.raises(Exception):
        df.select(to_ts("v")).collect()


def test_latest_ignores_nulls(spark):
    d1, d2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 3, 1)
    df = spark.createDataFrame([(0, None, d1), (1, d1, None), (2, None, None), (3, d1, d2)],
                               "i int, a timestamp, b timestamp").orderBy("i")
    assert [r[0] for r in rows(df.select(latest("a", "b")))] == [d1, d1, None, d2]


def test_iso_week_and_year(spark):
    df = spark.createDataFrame([(0, dt.date(2024, 12, 30)), (1, dt.date(2025, 1, 1)), (2, None)],
                               "i int, d date").orderBy("i")
    assert rows(df.select(iso_year("d"), iso_week("d"))) == [(2025, 1), (2025, 1), (None, None)]


def test_period_is_a_pushable_range(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(dt.date(2025, 3, 31),), (dt.date(2025, 4, 1),)], "d date").write.parquet(path)
    df = spark.read.parquet(path).filter(period("d", 2025, 3))
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,2025-03-01)" in plan and "LessThan(d,2025-04-01)" in plan


def test_age_bands_edges(spark):
    ages = [-1, 0, 1, 17, 18, 28, 29, 39, 40, 49, 50, 59, 60, 1999, 2000, None]
    df = one_col(spark, ages, "int")
    got = [r[0] for r in rows(df.select(band("v")))]
    assert got == [None, None, "< 18", "< 18", "18-28", "18-28", "29-39", "29-39", "40-49", "40-49",
                   "50-59", "50-59", "> 60", "> 60", None, None]


def test_half_even_rounding(spark):
    df = one_col(spark, ["0.5", "1.5", "2.5", "x", "nan", "3.5"])
    assert [r[0] for r in rows(df.select(round_half_even("v")))] == [0, 2, 2, None, None, 4]
    assert [r[0] for r in rows(df.select(to_number("v")))][:4] == [0.5, 1.5, 2.5, None]


def test_digits_only_ages(spark):
    df = one_col(spark, ["25", None, "25.0", "x", " 7"])
    assert [r[0] for r in rows(df.select(digits_or_null("v")))] == [25, 0, None, None, None]
    num = one_col(spark, [25.0, None, 25.5], "double")
    assert [r[0] for r in rows(num.select(integral_or_null("v")))] == [25, 0, None]


def test_concat_present(spark):
    df = spark.createDataFrame([(0, "a", "b"), (1, "a", None), (2, None, "b"), (3, None, None)],
                               "i int, a string, b string").orderBy("i")
    assert [r[0] for r in rows(df.select(concat_present("a", "b")))] == ["a, b", "a", "b", None]


def test_case_insensitive_match_folds_accents(spark):
    df = one_col(spark, ["FÍSICA", "física", None])
    assert [r[0] for r in rows(df.select(matches("v", "[ií]sic", ignore_case=True)))] == [True, True, False]
    assert [r[0] for r in rows(df.select(matches("v", "[ií]sic")))] == [False, True, False]
    assert df.select(F.lit(1)).count() == 3


def test_more_date_shapes_and_unparsed(spark):
    from civic_indicators.functions import day_text, parse_mixed_date, unparsed
    cells = {"2025-02-03 10:20:30.5": "2025-02-03", "3/4/25": "2025-04-03", "03-feb-2025": "2025-02-03", "03/02/2025 10:20:00 PM": "2025-02-03",
             "3 de febrero de 2025": "2025-02-03", "3 Jan 2025": "2025-01-03", "03/02/2025 10:20 a. m.": "2025-02-03", "pendiente": None, " ": None,
             "2025-02-03T10:20:30": "2025-02-03"}
    df = spark.createDataFrame([(k,) for k in cells], "v string")
    got = {r.v: (r.d, r.u) for r in df.select("v", day_text(parse_mixed_date("v")).alias("d"), unparsed("v").alias("u")).collect()}
    assert {k: v[0] for k, v in got.items()} == cells
    assert [k for k, v in got.items() if v[1]] == ["pendiente"]


def test_ages_and_person_numbers_that_are_none(spark):
    from civic_indicators.functions import round_half_even
    from civic_indicators.operators import person_key
    df = spark.createDataFrame([("3001234567", " "), ("2.5", "nan"), ("x", " 7 ")], "a string, k string")
    assert [tuple(r) for r in df.select(round_half_even("a"), person_key("k")).collect()] == [(None, None), (2, None), (None, "7")]


def test_text_without_digits_is_not_parsed_as_a_number(spark):
    from civic_indicators.functions.numbers import text_number, to_number
    cells = ["si", "", " ", "1", " 1.5 ", "1e3", "-2", "inf", "-Infinity", "+INF", "nan", "NaN", "0x1p3", "1d", "1,5", "٣", None]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = df.select(text_number("c").alias("a"), to_number("c").alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got] and sum(r.a is None for r in got) == 8


def test_strip_of_texts_with_and_without_edges(spark):
    from civic_indicators.functions.text import WHITESPACE_CHARS, clean, strip
    cells = [a + m + b for a in ("", " ", "\xa0", "\x1c", "!", "~", "\x7f", "é") for m in ("x", "", "a b") for b in ("", "\t", "\u2003", "!", "~", "\x7f", "É")]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = df.select(strip("c").alias("s"), clean("c", lower=True).alias("l")).collect()
    assert [r.s for r in got] == [c.strip(WHITESPACE_CHARS) for c in cells]
    assert [r.l for r in got] == [c.strip(WHITESPACE_CHARS).lower() for c in cells]


def test_wide_flows_run_as_compiled_code(spark):
    from civic_indicators.session import compiled
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    assert compiled(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
