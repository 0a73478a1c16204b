"""L1 registration flow, its panels (L5) and the misdated audit.

One lazy plan from scan to labels: every step is a projection or a filter,
so the whole flow is a single narrow stage (no shuffle) until a panel
aggregates it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civic_indicators.functions import patterns as P
from civic_indicators.functions.classify import flag, label_last_match, labels_all
from civic_indicators.functions.cols import col
from civic_indicators.functions.dates import day_text, latest, parse_mixed_date, stamp, to_day
from civic_indicators.functions.text import matches, strip
from civic_indicators.operators.aggregate import PanelSpec, indicator_panel, monthly_panels
from civic_indicators.operators.clean import clean_text, missing_any, null_sentinels, replace_columns, split_valid
from civic_indicators.operators.cohorts import registration_cohort
from civic_indicators.sources.headers import normalize_headers


@dataclass(frozen=True)
class RegistrationRules:
    """Classification rules of the registration flow (defaults: fixed values)."""
    ethnic: Sequence[tuple[str, str]] = P.ETHNIC_GROUPS
    disability: Sequence[tuple[str, str]] = P.DISABILITY_REGISTRATION
    vca_programme: str = P.VCA_PROGRAMME
    vca_condition: str = P.VCA_CONDITION
    vca_label: str = P.VCA_LABEL
    migrant_condition: str = P.MIGRANT_CONDITION
    migrant_document: str = P.MIGRANT_DOCUMENT_REGISTRATION
    migrant_label: str = P.MIGRANT_LABEL
    vvg_condition: str | tuple[str, ...] = P.VVG_CONDITION
    vvg_label: str = P.VVG_LABEL
    reintegrated_condition: str = P.REINTEGRATED_CONDITION
    reintegrated_label: str = P.REINTEGRATED_LABEL
    sentinels: Sequence[str] = P.SENTINELS


# FIXED VALUES: register columns (after header normalisation), the text
# columns trimmed first, and the published cohorts, as the source names them.
DOC_NUMBER = "número_documento"
DOC_TYPE = "tipo_documento"
YEAR = "año"
REGISTERED = "fecha_registro"
UPDATED = "fecha_actualización"
ACTION = "fecha_accion"
ACTION_DATE = "fecha_accion_dia"          # DateType twin of the text date
CONDITION = "condiciones_especiales"
PROGRAMME = "programa_de_gobierno"
CHANNEL = "canal_de_registro"
RECORD_TYPE = "tipo_registro"
SEX = "género"
AGE = "edad"
LABELS = ("grupos_etnicos", "vca", "discapacidad", "migrante", "vvg", "reincorporados")

# Text columns cast and trimmed before anything else.
TEXT_COLUMNS = (
    "número_documento", "teléfono", "título_homologado", "ciudad_de_residencia", "email",
    "programa_de_gobierno", "fecha_actualización", "%_hoja_vida", "fecha_cambio_prestador",
    "vereda/localidad/centro_poblado", "celular",
)


def prepare(raw: DataFrame, rules: RegistrationRules = RegistrationRules(),
            text_columns: Sequence[str] = TEXT_COLUMNS) -> tuple[DataFrame, Column]:
    """Headers, trim, sentinels; returns the rows and the reject predicate."""
    df = normalize_headers(raw)
    df = clean_text(df, [c for c in text_columns if c in df.columns])
    df = null_sentinels(df, rules.sentinels)
    return df, missing_any(DOC_TYPE, DOC_NUMBER)


def classify(df: DataFrame, rules: RegistrationRules = RegistrationRules(),
             iso_dayfirst: bool = False) -> DataFrame:
    """Dates and population labels.

    Three projections (trim, parse, derive) so that each parser chain is
    generated once; Catalyst does not merge projections when that would
    repeat a non-trivial expression.
    """
    df = replace_columns(df, {"__reg": strip(col(REGISTERED).cast("string")),
                              "__upd": strip(col(UPDATED).cast("string"))})
    df = replace_columns(df, {"__reg": parse_mixed_date("__reg", iso_dayfirst, trimmed=True),
                              "__upd": parse_mixed_date("__upd", iso_dayfirst, trimmed=True)})
    reg, upd = col("__reg"), col("__upd")
    action = to_day(latest(reg, upd))
    exprs = {
        REGISTERED: day_text(reg),
        UPDATED: day_text(upd),
        ACTION_DATE: action,
        CONDITION: F.lower(col(CONDITION)),
    }
    df = replace_columns(df, exprs)
    df = replace_columns(df, {ACTION: day_text(col(ACTION_DATE))}).drop("__reg", "__upd")
    return replace_columns(df, population_labels(CONDITION, PROGRAMME, DOC_TYPE, rules))


def population_labels(condition, programme, document, rules: RegistrationRules = RegistrationRules()) -> dict:
    """The six population label columns of the registration flow, from the
    (lower-cased) condition text, the programme text and the document type."""
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


def registration(raw: DataFrame, year: int | None = None, run_date=None,
                 rules: RegistrationRules = RegistrationRules(),
                 text_columns: Sequence[str] = TEXT_COLUMNS,
                 iso_dayfirst: bool = False) -> tuple[DataFrame, DataFrame]:
    """L1: (valid, rejected). Rejected rows miss the document type or number
    (a 'nan' cell counts as missing) and carry ``run_date`` when one is given;
    valid rows of ``year`` get dates and labels."""
    df, reject = prepare(raw, rules, text_columns)
    valid, rejected = split_valid(df, reject)
    if run_date is not None:
        rejected = stamp(rejected, run_date)
    if year is not None:
        valid = valid.filter(F.coalesce(col(YEAR) == F.lit(year), F.lit(False)))
    return classify(valid, rules, iso_dayfirst), rejected


PANEL = PanelSpec(
    sex_col=SEX, male="M", female="F",
    flags={"disability": "discapacidad", "vca": "vca", "vvg": "vvg", "migrant": "migrante",
           "ethnic": "grupos_etnicos", "reintegrated": "reincorporados"},
    age_col=AGE,
)

# FIXED VALUES: the three published panels, (channel, record type).
COHORTS = {
    "self_registered_new": ("Autoregistro", "Registro_nuevo"),
    "agency_new": ("Agencia", "Registro_nuevo"),
    "agency_updated": ("Agencia", "Actualizacion"),
}


def cohort(name_or_pair, month: int | None = None, year: int | None = None,
           cohorts: Mapping[str, tuple[str, str]] = COHORTS) -> Column:
    channel, kind = cohorts[name_or_pair] if isinstance(name_or_pair, str) else name_or_pair
    return registration_cohort(ACTION_DATE, CHANNEL, channel, RECORD_TYPE, kind, month, year)


def panel(valid: DataFrame, name_or_pair, month: int, year: int, spec: PanelSpec = PANEL,
          cohorts: Mapping[str, tuple[str, str]] = COHORTS) -> DataFrame:
    """A6 for one cohort and month: (indicator, value)."""
    return indicator_panel(valid, cohort(name_or_pair, month, year, cohorts), spec)


def monthly(valid: DataFrame, spec: PanelSpec = PANEL,
            cohorts: Mapping[str, tuple[str, str]] = COHORTS) -> DataFrame:
    """Every cohort x (year, month) of the action date, long form."""
    preds = {name: cohort(name, cohorts=cohorts) for name in cohorts}
    return monthly_panels(valid, preds, spec, ACTION_DATE)


def misdated_audit(valid: DataFrame, cutoff: str) -> DataFrame:
    """Rows per action day at or before ``cutoff`` (late or misdated records).

    The cut-off is applied to the per-day groups (HAVING), not the rows: the
    day is derived from two parsed dates, so a row filter could not reach the
    files anyway, and Catalyst would copy both date parsers into it.
    """
    days = (valid.groupBy(col(ACTION).alias(ACTION))
                 .agg(F.count(F.lit(1)).alias("count"), F.max(col(ACTION_DATE)).alias("__day")))
    return (days.filter(F.col("__day") <= F.lit(cutoff).cast("date"))
                .orderBy(ACTION).select(ACTION, "count"))
