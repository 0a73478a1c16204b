"""Declared columns of the five landed sheets, by normalised header.

A CSV sheet is read with its own headers (all text); ``conform`` checks that the
columns a flow needs are there and gives the typed ones their type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from civic_indicators.functions.cols import col
from civic_indicators.functions.numbers import to_number

# FIXED VALUES: headers after lower-casing (and spaces to underscores where the flow does so),
# with the types the reports use them as; the other columns of a sheet are text that is carried along.
REGISTRATIONS = {
    "número_documento": "string", "tipo_documento": "string", "año": "int", "fecha_registro": "string",
    "fecha_actualización": "string", "condiciones_especiales": "string", "programa_de_gobierno": "string",
    "canal_de_registro": "string", "tipo_registro": "string", "género": "string", "edad": "int",
}
SESSIONS = {
    "numerodocumento": "string", "fechaagendamiento": "string", "fechaejecucion": "string", "fechaevaluacion": "string",
    "usuarionombre": "string", "sexo": "string", "tipodocumento": "string", "programagobierno": "string",
}
WORKSHOPS = SESSIONS
PERSON_REGISTER = {"número documento": "string", "programa de gobierno": "string", "condiciones especiales": "string"}
COUNSELLOR_LOG = {"numero": "string", "numero.1": "string", "población": "string", "taller fis": "string", "edad": "string"}
PLACEMENTS = {
    "mes_registro": "string", "gestión_vacante_": "string", "población": "string", "código_proceso": "string",
    "nombre_de_la_empresa": "string", "nombre_de_la_vacante": "string", "sexo": "string", "edad": "string",
    "condicion": "string", "convenio": "string", "nivel_educativo": "string", "colocado": "string",
    "mes_de_colocación_en_plataforma": "string", "fecha_envío_hojas_de_vida_a_la_empresa": "string",
    "fecha_de_publicacion_de_la_vacante": "string", "vacantes_solicitadas/puestos_de_trabajo_en_plataforma|puestos_de_trabajo_en_plataforma": "string",
}


def conform(df: DataFrame, sheet: dict[str, str], spaces: bool = True) -> DataFrame:
    """``df`` with the declared columns typed (a cell that does not fit becomes null).

    A declared column that is missing is an error that names it; ``a|b`` declares a column that
    has either name. ``spaces``: whether the
    declared names have their spaces as underscores.
    """
    def norm(c: str) -> str:  # a header's trailing space may have been trimmed on landing
        c = c.lower().replace(" ", "_") if spaces else c.lower()
        return c.rstrip("_ ")

    have = {norm(c) for c in df.columns}
    missing = [c for c in sheet if not have & {norm(n) for n in c.split("|")}]
    if missing:
        raise ValueError(f"sheet lacks the columns {missing}")
    sheet = {norm(n): kind for c, kind in sheet.items() for n in c.split("|")}
    types = dict(df.dtypes)
    out = []
    for c in df.columns:
        kind = sheet.get(norm(c), "string")
        if kind != "string" and types[c] == "string":
            out.append(to_number(col(c)).try_cast(kind).alias(c))
        else:
            out.append(col(c))
    return df.select(*out)
