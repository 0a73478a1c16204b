"""Run the three report flows on landed sheets.

    python -m civic_indicators registration --input landing/registro --format csv \\
        --year 2025 --month 3 --curated out/registrados --quarantine out/revisar
    python -m civic_indicators guidance --sessions ... --workshops ... --registrations ... \\
        --counsellors ... --format csv --month 4 --year 2025
    python -m civic_indicators placement --input landing/intermediacion --format csv \\
        --month 4 --month-name abril

Each command prints its report tables whole, or writes them below ``--reports``,
and, where asked, writes the row-level outputs with the library's sinks. Shuffle
partitions and scan splits are sized from the volume of the inputs.
"""

from __future__ import annotations

import argparse
import re
import sys

from pyspark.sql import DataFrame

from civic_indicators.operators import panels, value_counts
from civic_indicators.plans import guidance as G
from civic_indicators.plans import placement as PL
from civic_indicators.plans import registration as R
from civic_indicators.session import checkpoint_dir, get_spark, size_session
from civic_indicators.sources import scan, sheets, write_curated, write_quarantine
from civic_indicators.sources.sheets import conform

ROW = "_fila"


def _show(title: str, df: DataFrame, reports: str | None = None) -> None:
    """The whole report: as Parquet under ``reports``, or printed row by row as it is read."""
    if reports:
        path = f"{reports.rstrip('/')}/{re.sub('[^a-z0-9]+', '_', title.lower()).strip('_')}"
        df.write.mode("overwrite").parquet(path)
        print(f"{title}: {path}")
        return
    print(f"\n== {title}\n" + "\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def run_registration(spark, a) -> None:
    raw = conform(scan(spark, a.input, a.format), sheets.REGISTRATIONS)
    valid, rejected = R.registration(raw, year=a.year, iso_dayfirst=a.iso_dayfirst)
    if a.quarantine:
        write_quarantine(rejected, a.quarantine, a.run_date)
    if a.curated:
        write_curated(valid, a.curated, ["año"])
        valid = spark.read.parquet(a.curated)          # reports read the written table
        if a.year is not None:
            valid = valid.filter(f"`año` = {int(a.year)}")  # partition pruning
    preds = {name: R.cohort(name, a.month, a.year) for name in R.COHORTS}
    _show(f"registration panels, {a.year}-{a.month:02d}", panels(valid, preds, R.PANEL), a.reports)
    _show("document types", value_counts(valid, "tipo_documento"), a.reports)
    if a.audit_cutoff:
        _show(f"records per day up to {a.audit_cutoff}", R.misdated_audit(valid, a.audit_cutoff), a.reports)


def run_guidance(spark, a) -> None:
    sessions = conform(scan(spark, a.sessions, a.format), sheets.SESSIONS)
    workshops = conform(scan(spark, a.workshops, a.format, row_order=ROW), sheets.WORKSHOPS)
    registrations = conform(scan(spark, a.registrations, a.format, row_order=ROW), sheets.PERSON_REGISTER, spaces=False)
    counsellors = conform(scan(spark, a.counsellors, a.format, row_order=ROW), sheets.COUNSELLOR_LOG, spaces=False)
    people = G.guidance(sessions, workshops, registrations, counsellors, workshop_order=[ROW],
                        registration_order=[ROW], counsellor_order=[ROW]).drop(ROW)
    if a.out:
        write_curated(people, a.out)
        people = spark.read.parquet(a.out)
    guided = people.filter(G.month_number_is("mes_orientado", a.month, "año_orientado", a.year))
    _show(f"guided sessions by sex, {a.year}-{a.month:02d}", value_counts(guided, "sexo"), a.reports)
    _show(f"guidance panels, {a.year}-{a.month:02d}", G.month_panels(people, a.month, a.year), a.reports)


def run_placement(spark, a) -> None:
    rows = PL.placement(conform(scan(spark, a.input, a.format), sheets.PLACEMENTS), checkpoint=checkpoint_dir(spark) is not None)
    if a.out:
        write_curated(rows, a.out)
        rows = spark.read.parquet(a.out)               # reports read the written table
    name, month = a.month_name, a.month
    _show(f"vacancies registered in {name}", PL.vacancy_summary(rows, name, dedupe_key=a.dedupe_key), a.reports)
    _show(f"sent in month {month} and placed in {name}", PL.monthly_report(rows, month, name, a.year), a.reports)
    _show("employers that placed population groups", PL.inclusive_employer_count(rows, name), a.reports)
    _show("their names", PL.inclusive_employers(rows, name), a.reports)
    _show("sent with a disability", PL.disability_report(rows, month, name, a.year)["sent_with_disability"], a.reports)
    _show("sent, by age band and sex x disability", PL.disability_pivot(rows, PL.sent(month, a.year)), a.reports)
    _show("placed, by age band and sex x disability", PL.disability_pivot(rows, PL.placed_in(name)), a.reports)
    _show("posts per employer (disability)", PL.disability_posts(rows, name), a.reports)
    _show("placements per employer (disability)", PL.disability_placements(rows, name), a.reports)
    _show("placements per vacancy (disability)", PL.disability_placements(rows, name, PL.VACANCY), a.reports)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="civic_indicators")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="command", required=True)

    r = sub.add_parser("registration")
    r.add_argument("--input", required=True)
    r.add_argument("--format", default="csv")
    r.add_argument("--year", type=int, required=True)
    r.add_argument("--month", type=int, required=True)
    r.add_argument("--curated")
    r.add_argument("--quarantine")
    r.add_argument("--run-date", dest="run_date")
    r.add_argument("--audit-cutoff", dest="audit_cutoff")
    r.add_argument("--iso-dayfirst", dest="iso_dayfirst", action="store_true")

    g = sub.add_parser("guidance")
    for name in ("sessions", "workshops", "registrations", "counsellors"):
        g.add_argument(f"--{name}", required=True)
    g.add_argument("--format", default="csv")
    g.add_argument("--year", type=int, required=True)
    g.add_argument("--month", type=int, required=True)
    g.add_argument("--out")

    pl = sub.add_parser("placement")
    pl.add_argument("--input", required=True)
    pl.add_argument("--format", default="csv")
    pl.add_argument("--month", type=int, required=True)
    pl.add_argument("--month-name", dest="month_name", required=True)
    pl.add_argument("--year", type=int, default=None)
    pl.add_argument("--dedupe-key", dest="dedupe_key", default=None)
    pl.add_argument("--out")
    for s in (r, g, pl):
        s.add_argument("--reports", help="write every report table whole below this folder instead of printing it")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = get_spark(a.master)
    size_session(spark, *[p for p in (getattr(a, n, None) for n in ("input", "sessions", "workshops", "registrations", "counsellors")) if p])
    {"registration": run_registration, "guidance": run_guidance, "placement": run_placement}[a.command](spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
