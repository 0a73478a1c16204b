"""L3 placement flow and its reports (L4 vacancy summary, L6 inclusive
employers, L7 disability report). The flow is narrow (one stage); each
report is one small aggregate over it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civic_indicators.functions import patterns as P
from civic_indicators.functions.classify import any_flag, flag, label_last_match
from civic_indicators.functions.cols import col
from civic_indicators.functions.dates import iso_week, iso_year, month_of, to_ts_or_null
from civic_indicators.functions.numbers import band, digits_or_null, integral_or_null, text_number, to_number
from civic_indicators.functions.text import matches
from civic_indicators.operators.aggregate import (
    PanelSpec, distinct_counts, distinct_values, distinct_with_null, panels, pivot_counts, sum_by, value_counts,
)
from civic_indicators.operators.clean import (
    clean_text, drop_empty, null_sentinels, null_values, recode, replace_columns,
)
from civic_indicators.operators.cohorts import equals, in_month, placed, present
from civic_indicators.session import materialize
from civic_indicators.sources.headers import normalize_headers, rename

# FIXED VALUES: placement sheet columns (after header normalisation) and the
# text columns lower-cased and trimmed, as the source names them.
SENT_DATE = "fecha_envío_hojas_de_vida_a_la_empresa"
PUBLISHED = "fecha_de_publicacion_de_la_vacante"
POSTS = "puestos_de_trabajo_en_plataforma"
POSTS_RAW = "vacantes_solicitadas/puestos_de_trabajo_en_plataforma"
EMPLOYER = "nombre_de_la_empresa"
VACANCY = "nombre_de_la_vacante"
PROCESS = "código_proceso"
REG_MONTH = "mes_registro"
PLACED = "colocado"
PLACED_MONTH = "mes_de_colocación_en_plataforma"
CONDITION = "condicion"
EMPTY_ROW_KEYS = ("mes_registro", "gestión_vacante_", "población", "código_proceso")

TEXT_COLUMNS = (
    "mes_registro", "convenio", "gestión_vacante_", "población", "código_proceso",
    "nombre_de_la_empresa", "nombre_de_la_vacante", "nombre_del_candidato", "nivel_educativo",
    "formacion", "sexo", "barrio", "condicion", "gestor", "intermediador_",
    "llamada_/_convocatoria/_base_de_datos", "observación_intermediación", "observación_gestión",
    "observación_del_candidato", "mes_de_colocación_en_plataforma", "colocado",
    "semana_publicacion_vacante", "mes_publicacion_vacante", "tipo_de_vacante",
)


@dataclass(frozen=True)
class PlacementRules:
    """Cleaning and classification rules of the placement flow (defaults: fixed values)."""
    disability: Sequence[tuple[str, str]] = P.DISABILITY_PLACEMENT
    vca_condition: str = P.VCA_CONDITION_PLACEMENT
    vca_label: str = P.VCA_LABEL_PLACEMENT
    vvg_condition: str = P.VVG_CONDITION_PLACEMENT
    vvg_label: str = P.VVG_LABEL
    migrant_condition: str | tuple[str, ...] = P.MIGRANT_CONDITION_PLACEMENT
    migrant_label: str = P.MIGRANT_LABEL_PLACEMENT
    ethnic: Sequence[tuple[str, str]] = P.ETHNIC_GROUPS
    ethnic_label: str = P.ETHNIC_ANY_LABEL
    reintegrated_condition: str = P.REINTEGRATED_CONDITION
    reintegrated_label: str = P.REINTEGRATED_LABEL
    none_agreement: Sequence[str] = P.NONE_WORDS_AGREEMENT
    none_condition: Sequence[str] = P.NONE_WORDS_CONDITION
    education: Mapping[str, str] = field(default_factory=lambda: dict(P.EDUCATION_RECODE))
    age_bands: Sequence[tuple] = P.AGE_BANDS
    sentinels: Sequence[str] = P.SENTINELS


def placement(raw: DataFrame, rules: PlacementRules = PlacementRules(),
              text_columns: Sequence[str] = TEXT_COLUMNS, checkpoint: bool = False) -> DataFrame:
    """L3: cleaned, typed and labelled placement rows.

    ``checkpoint=True`` materialises the rows in the cluster's checkpoint
    folder, for runs that feed several reports from them.
    """
    rows = _placement(raw, rules, text_columns)
    return materialize(rows) if checkpoint else rows


def _placement(raw: DataFrame, rules: PlacementRules, text_columns: Sequence[str]) -> DataFrame:
    df = normalize_headers(raw)
    df = null_sentinels(df, rules.sentinels)
    df = replace_columns(df, {SENT_DATE: to_ts_or_null(SENT_DATE)})
    df = drop_empty(df, [c for c in EMPTY_ROW_KEYS if c in df.columns])
    df = clean_text(df, [c for c in text_columns if c in df.columns], lower=True)
    df = rename(df, {POSTS_RAW: POSTS})
    df = null_values(df, "convenio", rules.none_agreement)
    df = recode(df, "nivel_educativo", rules.education)
    age_type = dict(df.dtypes).get("edad", "string")
    age = digits_or_null("edad") if age_type == "string" else integral_or_null("edad")
    df = replace_columns(df, {"edad": age})
    df = null_values(df, CONDITION, rules.none_condition)
    types = dict(df.dtypes)
    if types.get(POSTS) == "string":  # a sheet landed as text; junk counts as missing
        df = replace_columns(df, {POSTS: to_number(POSTS)})
    if types.get(PUBLISHED) == "string":
        df = replace_columns(df, {PUBLISHED: to_ts_or_null(PUBLISHED)})
    pub = col(PUBLISHED)
    df = replace_columns(df, {
        "rango_de_edad": band("edad", rules.age_bands),
        "semana_publicacion_vacante": iso_week(pub),
        "mes_publicacion_vacante": F.coalesce(month_of(pub), F.lit(0)),
        "año_publicacion_vacante": iso_year(pub),
        PLACED: F.coalesce((text_number if dict(df.dtypes).get(PLACED) == "string" else to_number)(PLACED).try_cast("int"), F.lit(0)),
    })
    return replace_columns(df, population_labels(CONDITION, rules))


def population_labels(condition, rules: PlacementRules = PlacementRules()) -> dict:
    """The six population label columns of the placement flow (condition text only)."""
    c = condition
    ethnic_any = "|".join(p for p, _ in rules.ethnic)
    return {
        "discapacidad": label_last_match(c, rules.disability, ignore_case=True),
        "vca": flag(rules.vca_label, matches(c, rules.vca_condition)),
        "vvg": flag(rules.vvg_label, matches(c, rules.vvg_condition)),
        "migrante": flag(rules.migrant_label, matches(c, rules.migrant_condition)),
        "etnias": flag(rules.ethnic_label, matches(c, ethnic_any)),
        "reincorporados": flag(rules.reintegrated_label, matches(c, rules.reintegrated_condition)),
    }


PANEL = PanelSpec(
    sex_col="sexo", male="m", female="f",
    flags={"disability": "discapacidad", "vca": "vca", "vvg": "vvg", "migrant": "migrante",
           "ethnic": "etnias", "reintegrated": "reincorporados"},
    age_col="edad",
)


def sent(month: int, year: int | None = None) -> Column:
    """(b): CVs sent to employers in a month (any year unless given)."""
    return in_month(SENT_DATE, month, year)


def placed_in(month_name: str) -> Column:
    """(c): placed in a month given by name."""
    return placed(PLACED, PLACED_MONTH, month_name)


def vacancy_summary(rows: DataFrame, month_name: str, dedupe_key: str | None = None) -> DataFrame:
    """L4: employers and vacancy processes (null counted once as a value) and
    posts registered in a month.

    Posts are summed over candidate rows, as the report does (a vacancy with
    three candidates counts three times); ``dedupe_key='código_proceso'``
    counts each process's posts once (its largest value), via a per-process
    pre-aggregate.
    """
    sub = rows.filter(equals(REG_MONTH, month_name))
    if dedupe_key is None:
        one = distinct_counts(sub, {"employers": EMPLOYER, "processes": PROCESS}, sums={"posts": POSTS})
        return one.withColumn("posts", F.col("posts").cast("long"))
    posts = F.coalesce(F.sum(col(POSTS)), F.lit(0)).cast("long")
    # One pass over the rows: a row per (dedupe key, employer, process), whose shuffle both
    # results reuse; they are stacked and turned back to one row.
    per = (sub.groupBy(col(dedupe_key).alias("__k"), col(EMPLOYER).alias(EMPLOYER), col(PROCESS).alias("__p"))
           .agg(F.max(col(POSTS)).alias(POSTS)))
    counts = per.agg(distinct_with_null(EMPLOYER).alias("employers"), distinct_with_null("__p").alias("processes"))
    total = per.groupBy("__k").agg(F.max(col(POSTS)).alias(POSTS)).agg(posts.alias("posts"))
    both = counts.select("employers", "processes", F.lit(None).cast("long").alias("posts")).unionByName(
        total.select(F.lit(None).cast("long").alias("employers"), F.lit(None).cast("long").alias("processes"), "posts"))
    return both.agg(*[F.max(c).alias(c) for c in ("employers", "processes", "posts")])


def monthly_report(rows: DataFrame, month: int, month_name: str, year: int | None = None,
                   spec: PanelSpec = PANEL) -> DataFrame:
    """Sent and placed panels of one month, one pass: (cohort, indicator, value)."""
    return panels(rows, {"sent": sent(month, year), "placed": placed_in(month_name)}, spec)


def inclusive_employers(rows: DataFrame, month_name: str) -> DataFrame:
    """Employers that placed someone of a population group in the month."""
    f = any_flag("etnias", "migrante", "vca", "discapacidad") & placed_in(month_name)
    return distinct_values(rows, EMPLOYER, f)


def inclusive_employer_count(rows: DataFrame, month_name: str) -> DataFrame:
    f = any_flag("etnias", "migrante", "vca", "discapacidad") & placed_in(month_name)
    return rows.filter(f).agg(distinct_with_null(EMPLOYER).alias("employers"))


def disability_pivot(rows: DataFrame, cohort: Column, rules: PlacementRules = PlacementRules()) -> DataFrame:
    """(age band, sex) x disability label counts within a cohort, a column per
    label of the rules the rows were classified with."""
    labels = list(dict.fromkeys(label for _, label in rules.disability))
    return pivot_counts(rows, ["rango_de_edad", "sexo"], "discapacidad", labels, cohort)


def disability_posts(rows: DataFrame, month_name: str) -> DataFrame:
    """Posts per employer for vacancies registered in the month with a disability label."""
    return sum_by(rows, EMPLOYER, POSTS, equals(REG_MONTH, month_name) & present("discapacidad"), "posts")


def disability_placements(rows: DataFrame, month_name: str, by: str = EMPLOYER) -> DataFrame:  # noqa: D401
    """Placed people with a disability label per employer (or per vacancy)."""
    return value_counts(rows, by, placed_in(month_name) & present("discapacidad"))


def disability_report(rows: DataFrame, month: int, month_name: str, year: int | None = None,
                      rules: PlacementRules = PlacementRules()) -> dict[str, DataFrame]:
    """The disability report of a month, as named tables: CVs sent with a
    disability label, the sent and placed pivots, posts per employer and
    placements per employer and per vacancy."""
    from civic_indicators.operators.aggregate import count_flag
    return {
        "sent_with_disability": rows.agg(count_flag("discapacidad", sent(month, year)).alias("count")),
        "sent_pivot": disability_pivot(rows, sent(month, year), rules),
        "placed_pivot": disability_pivot(rows, placed_in(month_name), rules),
        "posts_per_employer": disability_posts(rows, month_name),
        "placed_per_employer": disability_placements(rows, month_name),
        "placed_per_vacancy": disability_placements(rows, month_name, VACANCY),
    }
