"""The three flows end to end on small invented registers, with the default
(fixed) rules of the reports."""

import datetime as dt

from pyspark.sql import functions as F

from civic_indicators.plans import guidance as G
from civic_indicators.plans import placement as PL
from civic_indicators.plans import registration as R
from civic_indicators.sources import write_curated, write_quarantine, write_split
from tests.conftest import rows

REG_COLS = ["No. ", "Número Documento", "Tipo Documento", "Año", "Fecha Registro", "Fecha Actualización",
            "Condiciones Especiales", "Programa de Gobierno", "Canal de Registro", "TIPO_REGISTRO", "Género",
            "Edad", "Teléfono"]
REG_ROWS = [
    (1, " 100 ", "Cédula de Ciudadanía", 2025, "45717", "", "Discapacidad Física", "nan", "Autoregistro",
     "Registro_nuevo", "M", 30, " 300 "),
    (2, "101", "Permiso por Protección Temporal", 2025, "03-03-2025", "10/03/2025 09:00", "Afro, víctima VCA",
     "Víctimas del conflicto armado", "Autoregistro", "Registro_nuevo", "F", 22, None),
    (3, "102", None, 2025, "05-03-2025", None, "", None, "Agencia", "Registro_nuevo", "F", 40, None),
    (4, "nan", "Cédula de Ciudadanía", 2025, "05-03-2025", None, "", None, "Agencia", "Registro_nuevo", "F", 40, None),
    (5, "103", "Cédula de Ciudadanía", 2024, "05-03-2024", None, "migrante", None, "Agencia", "Actualizacion", "M", 61, None),
    (6, "104", "Cédula de Ciudadanía", 2025, "2025-03-20", "hola", "violencia de género; reincorporado; gitano",
     None, "Agencia", "Actualizacion", "M", 61, None),
]


def register(spark):
    schema = ("no long, doc string, tipo string, anio int, freg string, fact string, cond string, prog string, "
              "canal string, treg string, genero string, edad int, tel string")
    return spark.createDataFrame(REG_ROWS, schema).toDF(*REG_COLS)


def test_registration_flow(spark):
    valid, rejected = R.registration(register(spark), year=2025, run_date="2025-04-01")
    assert sorted(r[0] for r in rows(rejected, "no._")) == [3, 4]
    assert {str(r[0]) for r in rows(rejected, "run_date")} == {"2025-04-01"}
    got = {r[0]: r[1:] for r in rows(valid, "no._", "fecha_accion", "grupos_etnicos", "vca", "discapacidad",
                                       "migrante", "vvg", "reincorporados", "teléfono")}
    assert set(got) == {1, 2, 6}
    # the generic rule is last in this flow, so it overrides "Física"
    assert got[1] == ("2025-03-01", None, None, "Discapacidad", None, None, None, "300")
    assert got[2] == ("2025-03-10", ["Afrodescendiente"], "VCA", None, "Migrante o Retornado", None, None, None)
    assert got[6] == ("2025-03-20", ["Gitano"], None, None, None, "vvg", "reincorporados", None)
    panel = dict(rows(R.panel(valid, "self_registered_new", 3, 2025), "indicator", "value"))
    assert panel == {"men": 1, "women": 1, "disability": 1, "vca": 1, "vvg": 0, "migrant": 1, "ethnic": 1,
                     "reintegrated": 0, "elders": 0, "adults": 1, "youth": 1}
    audit = rows(R.misdated_audit(valid, "2025-03-05"), "fecha_accion", "count")
    assert audit == [("2025-03-01", 1)]


def test_sinks_roundtrip(spark, tmp_path):
    raw = register(spark)
    df, reject = R.prepare(raw)
    write_split(df, reject, str(tmp_path / "split"), run_date="2025-01-31")
    back = spark.read.parquet(str(tmp_path / "split"))
    counts = dict(rows(back.groupBy("_status").count(), "_status", "count"))
    assert counts == {"valid": 4, "rejected": 2}
    assert rows(back.select(F.col("run_date").cast("string")).distinct()) == [("2025-01-31",)]
    valid, rejected = R.registration(raw)
    write_quarantine(rejected, str(tmp_path / "q"), "2025-02-01")
    write_quarantine(rejected, str(tmp_path / "q"), "2025-02-01")  # rerun replaces the day
    assert spark.read.parquet(str(tmp_path / "q")).count() == 2
    write_curated(valid.select("número_documento", "año"), str(tmp_path / "c"), ["año"])
    years = dict(rows(spark.read.parquet(str(tmp_path / "c")).groupBy("año").count(), "año", "count"))
    assert years == {2024: 1, 2025: 3}


def _activity(spark, keyed):
    schema = ("NumeroDocumento string, FechaAgendamiento string, FechaEjecucion string, FechaEvaluacion string, "
              "UsuarioNombre string, Sexo string, TipoDocumento string, ProgramaGobierno string, Fila int")
    return spark.createDataFrame(keyed, schema)


def test_guidance_flow(spark):
    ts = "2025-04-0{} 10:00:00"
    sessions = _activity(spark, [("1", ts.format(1), ts.format(2), ts.format(3), "Ana", "M", "CC", None, 1),
                                 ("2", ts.format(1), ts.format(2), ts.format(3), "Ana", "F", "PPT", "Jóvenes", 2)])
    workshops = _activity(spark, [("2", ts.format(4), ts.format(5), ts.format(6), "Luis", "F", "CC", "Mujeres", 1),
                                  ("2", ts.format(4), ts.format(5), ts.format(6), "Luis", "F", "CC", "Jóvenes", 2),
                                  ("3", ts.format(4), ts.format(5), ts.format(6), "Luis", "M", "DNI", "Mujeres", 3)])
    reg = spark.createDataFrame([(1, "1", "Víctimas del conflicto armado", "Indígena"),
                                 (2, "1", None, "discapacidad visual"), (3, "2", None, None)],
                                "n int, k string, p string, c string").toDF("No. ", "Número Documento",
                                                                           "Programa de Gobierno", "Condiciones Especiales")
    log = spark.createDataFrame([(1, "x", "1", "28.5", "Migrante", None), (2, "y", "1", "40", "Reincorporado", None),
                                 (3, "z", "3", "29.5", None, None)],
                                "f int, a string, b string, e string, p string, u string").toDF(
        "FILA", "NUMERO", "NUMERO", "EDAD", "POBLACIÓN", "Unnamed: 22")
    log = log.withColumn("TALLER FIS", F.lit("si"))
    people = G.guidance(sessions, workshops, reg, log, workshop_order=["fila"], registration_order=["No. "],
                        counsellor_order=["FILA"])
    got = {r[0]: r[1:] for r in rows(people, "numerodocumento", "orientador", "tallerista", "programagobierno",
                                       "edad", "rango_de_edad", "grupos_etnicos", "vca", "discapacidad",
                                       "migrante", "reincorporados", "condiciones_especiales")}
    assert set(got) == {"1", "2", "3"}
    assert got["1"] == ("ana", None, None, 28, "18-28", ["Indígenas"], "VCA", "Visual", "Migrante o Retornado",
                        "reincorporados", "indígena,discapacidad visual, migrante,reincorporado")
    assert got["2"][:4] == ("ana", "luis", "jóvenes", None)
    assert got["2"][8] == "Migrante o Retornado"          # ppt document type
    assert got["3"][:5] == (None, "luis", "mujeres", 30, "29-39")
    assert got["3"][8] == "Migrante o Retornado"          # dni document type
    panel = dict(rows(G.guided_panel(people, 4, 2025), "indicator", "value"))
    assert panel["men"] == 1 and panel["women"] == 1 and panel["youth"] == 1 and panel["disability"] == 1


def placement_sheet(spark):
    cols = ["Mes Registro", "Gestión Vacante ", "Población", "Código Proceso", "Nombre de la Empresa",
            "Nombre de la Vacante", "Vacantes Solicitadas/Puestos de Trabajo en Plataforma",
            "Fecha Envío Hojas de Vida a la Empresa", "Fecha de Publicacion de la Vacante", "Sexo", "Edad",
            "Condicion", "Convenio", "Nivel Educativo", "Colocado", "Mes de Colocación en Plataforma"]
    pub = dt.datetime(2024, 12, 30)
    data = [
        ("Abril", "g", "p", "1", "ACME ", "Cajero", 2, "2025-04-02", pub, "M", "25", "Discapacidad Física", "Ninguno",
         "Técnico", "1", "abril"),
        ("abril", "g", "p", "2", None, "Auxiliar", 3, "2025-04-03", pub, "F", None, "Víctima", "Sena",
         "pfofesional", "0", "abril"),
        (None, None, None, None, "X", "Y", 1, "2025-04-04", pub, "F", "30", None, None, None, None, None),
        ("mayo", "g", "p", "3", "ACME", "Cajero", 5, "nan", pub, "F", "61", "Migrante; afro", None, "bachiller",
         "1.0", "abril"),
    ]
    schema = ", ".join(f"c{i} {t}" for i, t in enumerate(["string"] * 6 + ["int", "string", "timestamp"]
                                                           + ["string"] * 7))
    return spark.createDataFrame(data, schema).toDF(*cols)


def test_placement_flow(spark):
    raw = placement_sheet(spark)
    out = PL.placement(raw)
    assert out.count() == 3
    got = {r[0]: r[1:] for r in rows(out, "código_proceso", "nombre_de_la_empresa", "edad", "rango_de_edad",
                                       "convenio", "nivel_educativo", "colocado", "semana_publicacion_vacante",
                                       "año_publicacion_vacante", "discapacidad", "vca", "migrante", "etnias")}
    assert got["1"] == ("acme", 25, "18-28", None, "tecnico", 1, 1, 2025, "Física", None, None, None)
    assert got["2"] == (None, 0, None, "sena", "universitario", 0, 1, 2025, None, "vca", None, None)
    assert got["3"] == ("acme", 61, "> 60", None, "educación media", 1, 1, 2025, None, None,
                        "Migrante y/o retronado", "grupo_etnico")
    summary = rows(PL.vacancy_summary(out, "abril"), "employers", "processes", "posts")
    assert summary == [(2, 2, 5)]
    report = dict(rows(PL.monthly_report(out, 4, "abril").filter("cohort = 'placed'"), "indicator", "value"))
    assert report["men"] == 1 and report["women"] == 1 and report["disability"] == 1 and report["migrant"] == 1
    assert sorted(rows(PL.inclusive_employers(out, "abril"))) == [("acme",)]
    pivot = rows(PL.disability_pivot(out, PL.placed_in("abril")), "rango_de_edad", "sexo", "Física", "Visual")
    assert pivot == [("18-28", "m", 1, 0)]
