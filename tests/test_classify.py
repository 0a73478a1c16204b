"""Population classification with the fixed report rules."""

from pyspark.sql import functions as F

from civic_indicators.functions import any_flag, flag, label_last_match, labels_all, matches
from civic_indicators.functions import patterns as P
from tests.conftest import rows


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string").orderBy("i")


def test_last_match_wins_and_rule_order_matters(spark):
    df = texts(spark, ["discapacidad visual", "FÍSICA", None, "ninguna", "Discapacidad Múltiple"])
    reg = [r[0] for r in rows(df.select(label_last_match("c", P.DISABILITY_REGISTRATION)))]
    gui = [r[0] for r in rows(df.select(label_last_match("c", P.DISABILITY_GUIDANCE)))]
    place = [r[0] for r in rows(df.select(label_last_match("c", P.DISABILITY_PLACEMENT)))]
    assert reg == ["Discapacidad", "Física", None, None, "Discapacidad"]
    assert gui == ["Visual", "Física", None, None, "Múltiple"]
    assert place == ["Visual", "Física", None, None, "Múltiple"]


def test_label_array_in_rule_order(spark):
    df = texts(spark, ["afro y gitano", "raizal", "ninguna", None, "indígena, negra"])
    got = [r[0] for r in rows(df.select(labels_all("c", P.ETHNIC_GROUPS)))]
    assert got == [["Afrodescendiente", "Gitano"], ["Raizal y/o Isleño"], None, None,
                   ["Afrodescendiente", "Indígenas"]]


def test_two_column_flags_are_null_safe(spark):
    df = spark.createDataFrame([(0, None, "Permiso Especial"), (1, "migrante", None),
                                (2, "v.c.a", "cc"), (3, "vocea", None), (4, None, None)],
                               "i int, c string, doc string").orderBy("i")
    mig = flag(P.MIGRANT_LABEL, matches("c", P.MIGRANT_CONDITION), matches("doc", P.MIGRANT_DOCUMENT_REGISTRATION))
    vca = flag(P.VCA_LABEL, matches("c", P.VCA_CONDITION))
    got = rows(df.select(mig.alias("m"), vca.alias("v")))
    assert got == [(P.MIGRANT_LABEL, None), (P.MIGRANT_LABEL, None), (None, "VCA"), (None, "VCA"), (None, None)]


def test_any_flag(spark):
    df = spark.createDataFrame([(0, None, None), (1, "x", None), (2, None, "y")],
                               "i int, a string, b string").orderBy("i")
    assert [r[0] for r in rows(df.select(any_flag("a", "b")))] == [False, True, True]


def test_name_and_column_paths_agree(spark):
    from pyspark.sql import functions as F
    df = texts(spark, ["discapacidad visual y física", "FÍSICA", "afro, gitano, raizal", "v.c.a", "Múltiple",
                       None, "", "indígena; víctima; vvg", "psicosocial auditiva"])
    for rules in (P.DISABILITY_REGISTRATION, P.DISABILITY_GUIDANCE, P.DISABILITY_PLACEMENT, P.ETHNIC_GROUPS):
        by_name = rows(df.select(label_last_match("c", rules).alias("a"), labels_all("c", rules).alias("b")))
        by_col = rows(df.select(label_last_match(F.col("c"), rules).alias("a"),
                                labels_all(F.col("c"), rules).alias("b")))
        assert by_name == by_col



def test_plain_patterns_use_substring_search(spark):
    from pyspark.sql import functions as F
    from civic_indicators.functions.text import is_plain
    assert is_plain("rein") and is_plain("indí") and not is_plain("v.c.a") and not is_plain("a|b")
    df = texts(spark, ["reincorporado", "REIN", None, "armado", "x.y"])
    for p in ("rein", "armado", "x.y", "REIN"):
        fast = [r[0] for r in rows(df.select(matches("c", p)))]
        slow = [r[0] for r in rows(df.select(F.coalesce(F.col("c").rlike(p), F.lit(False))))]
        assert fast == slow


# Labels of the lines of PHRASES by position, written out (registration, guidance, placement).
FIXED_LABELS = {
    "reg_grupos_etnicos": {0: "Afrodescendiente", 1: "Afrodescendiente", 2: "Raizal y/o Isleño", 3: "Indígenas", 4: "Afrodescendiente|Gitano"},
    "gui_grupos_etnicos": {0: "Afrodescendiente", 1: "Afrodescendiente", 2: "Raizal y/o Isleño", 3: "Indígenas", 4: "Afrodescendiente|Gitano"},
    "pla_etnias": {0: "grupo_etnico", 1: "grupo_etnico", 2: "grupo_etnico", 3: "grupo_etnico", 4: "grupo_etnico"},
    "reg_discapacidad": {5: "Discapacidad", 6: "Discapacidad", 7: "Visual", 8: "Auditiva", 9: "Múltiple", 10: "Sordoceguera", 11: "Psicosocial"},
    "gui_discapacidad": {5: "Cognitiva o Intelectual", 6: "Física", 7: "Visual", 8: "Auditiva", 9: "Múltiple", 10: "Sordoceguera", 11: "Psicosocial"},
    "pla_discapacidad": {5: "Cognitiva o Intelectual", 6: "Física", 7: "Visual", 8: "Auditiva", 9: "Múltiple", 10: "Sordoceguera", 11: "Psicosocial"},
    "reg_vca": {12: "VCA", 20: "VCA"}, "gui_vca": {12: "VCA", 20: "VCA"}, "pla_vca": {12: "vca", 13: "vca"},
    "reg_vvg": {14: "vvg"}, "gui_vvg": {14: "vvg"}, "pla_vvg": {14: "vvg", 15: "vvg"},
    "reg_migrante": {16: "Migrante o Retornado", 17: "Migrante o Retornado", 21: "Migrante o Retornado"},
    "gui_migrante": {16: "Migrante o Retornado", 17: "Migrante o Retornado", 22: "Migrante o Retornado"},
    "pla_migrante": {16: "Migrante y/o retronado", 17: "Migrante y/o retronado"},
    "reg_reincorporados": {18: "reincorporados"}, "gui_reincorporados": {18: "reincorporados"}, "pla_reincorporados": {18: "reincorporados"},
}


def test_fixed_rules_by_written_out_labels(spark):
    from civic_indicators.driver.queries import PHRASES
    from civic_indicators.plans import guidance as G
    from civic_indicators.plans import placement as PL
    from civic_indicators.plans import registration as R
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(PHRASES)], "i int, cond string, prog string, doc string")
    labels = [e.alias(f"{n}_{k}") for n, ls in (("reg", R.population_labels("cond", "prog", "doc")), ("gui", G.population_labels("cond", "prog", "doc")),
                                                ("pla", PL.population_labels("cond"))) for k, e in ls.items()]
    for r in df.select("i", *labels).collect():
        for name, want in FIXED_LABELS.items():
            got = r[name]
            assert ("|".join(got) if isinstance(got, list) else got) == want.get(r.i), (r.i, name)


def test_plain_words_equal_the_case_insensitive_pattern(spark):
    """Rules of plain words are substring tests of the lowered text; odd letters fall back to the pattern."""
    texts = ["ÉTé", "L'ÉTUDE", "straße", "STRASSE", "Kelvin \u212a", "\u0130stanbul", "d\u0131s", "mi\u017fs", "niÑo", "\u212bngstrom", "ÿ Ÿ", "µ Μ", "", None]
    rules = [("ét", "a"), ("ss|ist", "b"), ("ñ|k", "c"), ("dis", "d"), ("ß|ÿ", "e"), ("[aå]ng", "f"), ("µ", "g"), ("i", "h")]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    for one in rules:
        got = rows(df.select(label_last_match("c", [one]).alias("x"), F.when(F.col("c").rlike("(?iu)" + one[0]), one[1]).alias("y")))
        assert all(x == y for x, y in got), one
    assert [r[0] for r in rows(df.select(label_last_match("c", rules)))] == [r[0] for r in rows(df.select(label_last_match(F.col("c"), rules)))]
