"""L2 guidance flow: counselling sessions + workshops + registrations +
counsellor log -> one row per session (and per workshop-only person).

Shuffle plan: each per-person aggregate is one two-level aggregation on the
person key (``per_key``). The full outer merge of sessions with workshops
runs as one left join that reads the workshops aggregate once
(``operators.integrate.outer_merge``), and the two enrichments compare keys
null-safely (``enrich``): in all three joins a person with a huge number of
sessions can be split by adaptive skew handling. Small aggregates are
broadcast by adaptive execution once their measured size allows it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civic_indicators.functions import patterns as P
from civic_indicators.functions.classify import flag, label_last_match, labels_all
from civic_indicators.functions.cols import col
from civic_indicators.functions.dates import month_of, to_ts, year_of
from civic_indicators.functions.numbers import band, round_half_even
from civic_indicators.functions.text import concat_present, matches
from civic_indicators.operators.aggregate import PanelSpec, indicator_panel, monthly_panels, panels
from civic_indicators.operators.clean import lower_strings, replace_columns
from civic_indicators.operators.cohorts import month_number_is
from civic_indicators.operators.integrate import enrich, outer_merge, per_key, person_key
from civic_indicators.sources.headers import (
    drop_columns, normalize_headers, rename, rename_by_pattern, with_unique_headers,
)

# FIXED VALUES: sheet columns and headers of the guidance sources, as the source names them.
KEY = "numerodocumento"
DATES = ("fechaagendamiento", "fechaejecucion", "fechaevaluacion")
STAFF = "usuarionombre"

# Headers of the other two sheets.
REG_KEY_HEADER = "Número Documento"
REG_PROGRAMME = "Programa de Gobierno"
REG_CONDITION = "Condiciones Especiales"
LOG_KEY_HEADER = "NUMERO.1"
LOG_DROP = ("Unnamed: 22",)
LOG_AGE = "EDAD"
LOG_POPULATION = "POBLACIÓN"
LOG_WORKSHOP = "TALLER FIS"


@dataclass(frozen=True)
class GuidanceRules:
    """Classification rules of the guidance flow (defaults: fixed values)."""
    ethnic: Sequence[tuple[str, str]] = P.ETHNIC_GROUPS
    disability: Sequence[tuple[str, str]] = P.DISABILITY_GUIDANCE
    vca_programme: str = P.VCA_PROGRAMME
    vca_condition: str = P.VCA_CONDITION
    vca_label: str = P.VCA_LABEL
    migrant_condition: str = P.MIGRANT_CONDITION
    migrant_document: str = P.MIGRANT_DOCUMENT_GUIDANCE
    migrant_label: str = P.MIGRANT_LABEL
    vvg_condition: str | tuple[str, ...] = P.VVG_CONDITION
    vvg_label: str = P.VVG_LABEL
    reintegrated_condition: str = P.REINTEGRATED_CONDITION
    reintegrated_label: str = P.REINTEGRATED_LABEL
    age_bands: Sequence[tuple] = P.AGE_BANDS


def _activity(df: DataFrame, suffix: str, staff: str, month: str, year: str,
              lower_cols: Sequence[str] | None = None) -> DataFrame:
    """Headers lower-cased, strict dates, string cells lower-cased, renames, month/year."""
    df = normalize_headers(df, spaces=False)
    df = replace_columns(df, {d: to_ts(d) for d in DATES})
    df = lower_strings(df, lower_cols)
    df = rename(df, {**{d: f"{d}_{suffix}" for d in DATES}, STAFF: staff})
    df = replace_columns(df, {KEY: person_key(KEY)})
    run = col(f"fechaejecucion_{suffix}")
    return replace_columns(df, {month: month_of(run), year: year_of(run)})


def sessions_table(sessions: DataFrame) -> DataFrame:
    return _activity(sessions, "orientacion", "orientador", "mes_orientado", "año_orientado")


def workshops_per_person(workshops: DataFrame, order: Sequence[str],
                         lower_cols: Sequence[str] | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """A1/A2 over workshops: first value of every column, programmes joined.

    ``lower_cols``: the string columns to lower-case (the sessions' headers).
    ``columns`` limits the output to the ones needed."""
    w = _activity(workshops, "taller", "tallerista", "mes_taller", "año_taller", lower_cols)
    concat = ["programagobierno"]
    first = [c for c in w.columns if c != KEY and c not in concat]
    return per_key(w, KEY, order, first=_only(first, columns), concat=concat)


def _only(cols: list[str], keep: Sequence[str] | None) -> list[str]:
    return cols if keep is None else [c for c in cols if c in set(keep)]


def registrations_per_person(registrations: DataFrame, order: Sequence[str],
                             columns: Sequence[str] | None = None) -> DataFrame:
    """A1/A2 over the register: first value per column, programme and
    conditions joined. ``columns`` limits the output to the ones needed."""
    r = rename_by_pattern(registrations, REG_KEY_HEADER, KEY)
    r = replace_columns(r, {KEY: person_key(KEY)})
    concat = [REG_PROGRAMME, REG_CONDITION]
    first = [c for c in r.columns if c != KEY and c not in concat]
    return per_key(r, KEY, order, first=_only(first, columns), concat=_only(concat, columns))


def counsellors_per_person(log: DataFrame, order: Sequence[str],
                           columns: Sequence[str] | None = None) -> DataFrame:
    """A1/A2 over the counsellor log (second NUMERO header is the person)."""
    g = rename_by_pattern(with_unique_headers(log), LOG_KEY_HEADER, KEY)
    g = drop_columns(g, LOG_DROP)
    g = lower_strings(g)
    g = replace_columns(g, {KEY: person_key(KEY)})
    concat = [LOG_POPULATION, LOG_WORKSHOP]
    first = [c for c in g.columns if c != KEY and c not in concat]
    return per_key(g, KEY, order, first=_only(first, columns), concat=_only(concat, columns))


def guidance(sessions: DataFrame, workshops: DataFrame, registrations: DataFrame,
             counsellors: DataFrame, *, workshop_order: Sequence[str],
             registration_order: Sequence[str], counsellor_order: Sequence[str],
             rules: GuidanceRules = GuidanceRules(), columns: Sequence[str] | None = None) -> DataFrame:
    """L2: the integrated table of guided people with age band and population labels.

    ``*_order`` name the columns giving each sheet's row order (its row
    number), which decides the "first" value per person. ``columns``: the
    result's columns that will be read; of the workshops only these are then
    gathered per person (columns met in both sheets count as read).
    """
    s = sessions_table(sessions)
    shared = normalize_headers(sessions, spaces=False).columns
    missing = set(shared) - set(normalize_headers(workshops, spaces=False).columns)
    if missing:
        raise ValueError(f"workshops sheet lacks the sessions headers {sorted(missing)}")
    wanted = None if columns is None else {*columns, *s.columns}
    w = workshops_per_person(workshops, workshop_order, shared, wanted)
    people = outer_merge(s, w, KEY)
    reg = registrations_per_person(registrations, registration_order, [REG_PROGRAMME, REG_CONDITION])
    log = counsellors_per_person(counsellors, counsellor_order, [LOG_AGE, LOG_POPULATION])
    people = enrich(people, reg, KEY, [REG_PROGRAMME, REG_CONDITION])
    people = enrich(people, log, KEY, [LOG_AGE, LOG_POPULATION])
    people = replace_columns(people, {REG_CONDITION: concat_present(REG_CONDITION, LOG_POPULATION)})
    people = drop_columns(people, [LOG_POPULATION])
    people = normalize_headers(people)
    return classify(people, rules)


def classify(people: DataFrame, rules: GuidanceRules = GuidanceRules()) -> DataFrame:
    people = replace_columns(people, {
        "edad": round_half_even("edad"),
        "condiciones_especiales": F.lower(col("condiciones_especiales")),
    })
    return replace_columns(people, {
        "rango_de_edad": band("edad", rules.age_bands),
        **population_labels("condiciones_especiales", "programa_de_gobierno", "tipodocumento", rules),
    })


def population_labels(condition, programme, document, rules: GuidanceRules = GuidanceRules()) -> dict:
    """The six population label columns of the guidance flow."""
    c = condition
    return {
        "grupos_etnicos": labels_all(c, rules.ethnic),
        "vca": flag(rules.vca_label, matches(programme, rules.vca_programme),
                    matches(c, rules.vca_condition)),
        "discapacidad": label_last_match(c, rules.disability, ignore_case=True),
        "migrante": flag(rules.migrant_label, matches(c, rules.migrant_condition),
                         matches(document, rules.migrant_document)),
        "vvg": flag(rules.vvg_label, matches(c, rules.vvg_condition)),
        "reincorporados": flag(rules.reintegrated_label, matches(c, rules.reintegrated_condition)),
    }


PANEL = PanelSpec(
    sex_col="sexo", male="m", female="f",
    flags={"disability": "discapacidad", "vca": "vca", "vvg": "vvg", "migrant": "migrante",
           "ethnic": "grupos_etnicos", "reintegrated": "reincorporados"},
    age_col="edad",
)


def guided_panel(people: DataFrame, month: int, year: int, spec: PanelSpec = PANEL) -> DataFrame:
    """(d): people guided in a month."""
    return indicator_panel(people, month_number_is("mes_orientado", month, "año_orientado", year), spec)


def workshop_panel(people: DataFrame, month: int, year: int, spec: PanelSpec = PANEL) -> DataFrame:
    """(e): people in a workshop in a month."""
    return indicator_panel(people, month_number_is("mes_taller", month, "año_taller", year), spec)


def month_panels(people: DataFrame, month: int, year: int, spec: PanelSpec = PANEL) -> DataFrame:
    """(d) + (e): guided and workshop panels of one month in one pass: (cohort, indicator, value)."""
    return panels(people, {"guided": month_number_is("mes_orientado", month, "año_orientado", year),
                           "workshop": month_number_is("mes_taller", month, "año_taller", year)}, spec)


def monthly(people: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """L5 for guidance: both cohorts per month of their own execution date."""
    t = F.lit(True)
    return monthly_panels(people, {"guided": t, "workshop": t}, spec,
                          {"guided": "fechaejecucion_orientacion", "workshop": "fechaejecucion_taller"})
