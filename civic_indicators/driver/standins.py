"""Stand-in inputs built from the driver tables.

The driver tables carry no register data, so each loader below only reshapes
driver rows into the *schema* a flow expects (sheet headers, text dates,
sentinels, nulls). None of them does any of the flows' work; the flows run
unchanged on any data of that schema. ``oracle.py`` builds the very same
inputs in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civic_indicators.driver.schemas import driver_table as table

# FIXED VALUES: Spanish month names, used by the placement sheet.
MONTHS = ("Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto",
          "Septiembre", "Octubre", "Noviembre", "Diciembre")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text_date_sql(ts: str, style: str) -> str:
    """Render a timestamp as sheet text in one of four styles (0-3)."""
    return (f"CASE WHEN {style} = 0 THEN CAST(datediff(to_date({ts}), DATE'1899-12-30') AS STRING) "
            f"WHEN {style} = 1 THEN date_format({ts}, 'dd-MM-yyyy') "
            f"WHEN {style} = 2 THEN date_format({ts}, 'dd/MM/yyyy HH:mm') "
            f"ELSE date_format({ts}, 'yyyy-MM-dd') END")


# The sheets below are written as SQL projections (one JVM call per sheet).

def register(spark: SparkSession, root: str) -> DataFrame:
    """Registration sheet (raw headers) from orders x customer."""
    o = table(spark, root, "orders")
    c = table(spark, root, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    key = "CAST(o_custkey AS STRING)"
    updated = "timestampadd(DAY, CAST(o_custkey % 45 AS INT), o_orderdate)"
    return j.selectExpr(
        f"o_orderkey AS {_q('No. ')}",
        f"CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'nan' "
        f"WHEN o_orderstatus = 'F' THEN concat(' ', {key}, char(160)) ELSE {key} END AS {_q('Número Documento')}",
        f"nullif(o_orderpriority, '4-NOT SPECIFIED') AS {_q('Tipo Documento')}",
        f"year(o_orderdate) AS {_q('Año')}",
        f"CASE WHEN o_orderkey % 4 = 2 THEN concat(date_format(o_orderdate, 'dd/MM/yyyy'), ' ', "
        f"lpad(CAST(o_orderkey % 24 AS STRING), 2, '0'), ':30') "
        f"ELSE {_text_date_sql('o_orderdate', 'o_orderkey % 4')} END AS {_q('Fecha Registro')}",
        f"CASE WHEN o_orderstatus = 'O' THEN CAST(NULL AS STRING) WHEN o_orderstatus = 'P' THEN 'sin fecha' "
        f"ELSE {_text_date_sql(updated, '(o_orderkey + 1) % 4')} END AS {_q('Fecha Actualización')}",
        f"concat_ws(', ', o_orderpriority, c_mktsegment) AS {_q('Condiciones Especiales')}",
        f"c_name AS {_q('Programa de Gobierno')}",
        f"o_orderstatus AS {_q('Canal de Registro')}",
        "c_mktsegment AS TIPO_REGISTRO",
        f"CASE WHEN c_nationkey % 3 = 0 THEN CAST(NULL AS STRING) WHEN c_nationkey % 3 = 1 THEN 'M' ELSE 'F' END "
        f"AS {_q('Género')}",
        f"CAST(CAST(floor(o_totalprice) AS BIGINT) % 90 AS INT) AS {_q('Edad')}",
        f"concat('  300 ', CAST(c_custkey % 1000 AS STRING), char(9)) AS {_q('Celular')}",
    )


def _activity_sql(ts: str, before: int, after: int) -> list[str]:
    fmt = "'yyyy-MM-dd HH:mm:ss'"
    return [f"date_format(timestampadd(DAY, -{before}, {ts}), {fmt}) AS FechaAgendamiento",
            f"date_format({ts}, {fmt}) AS FechaEjecucion",
            f"date_format(timestampadd(DAY, {after}, {ts}), {fmt}) AS FechaEvaluacion"]


def sessions(spark: SparkSession, root: str) -> DataFrame:
    """Counselling sessions sheet from orders (one row per session)."""
    return table(spark, root, "orders").selectExpr(
        "CAST(o_custkey AS STRING) AS NumeroDocumento",
        *_activity_sql("o_orderdate", 3, 2),
        "concat('Orientador ', o_orderstatus) AS UsuarioNombre",
        "CASE WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS Sexo",
        "o_orderpriority AS TipoDocumento",
        "nullif(o_orderstatus, 'P') AS ProgramaGobierno",
        "'Orientacion' AS Indicador",
        "CASE WHEN o_orderkey % 5 = 0 THEN CAST(NULL AS STRING) "
        "ELSE concat('Ciudad ', CAST(o_custkey % 7 AS STRING)) END AS Ciudad",
    )


WORKSHOP_ORDER = ("orden", "linea", "proveedor", "cantidad", "precio", "descuento", "impuesto",
                  "marca", "estado", "fechaejecucion_taller")


def workshops(spark: SparkSession, root: str) -> DataFrame:
    """Workshop attendance sheet from lineitem; same headers as the sessions
    sheet plus the sheet's own row-order columns."""
    return table(spark, root, "lineitem").selectExpr(
        "CAST(l_partkey AS STRING) AS NumeroDocumento",
        *_activity_sql("l_shipdate", 7, 1),
        "concat('Tallerista ', CAST(l_suppkey AS STRING)) AS UsuarioNombre",
        "CASE WHEN l_partkey % 2 = 0 THEN 'M' ELSE 'F' END AS Sexo",
        "nullif(l_returnflag, 'N') AS TipoDocumento",
        "concat(l_linestatus, '-', l_returnflag) AS ProgramaGobierno",
        "'Taller' AS Indicador",
        "CASE WHEN l_linenumber = 1 THEN CAST(NULL AS STRING) "
        "ELSE concat('Ciudad ', CAST(l_linenumber AS STRING)) END AS Ciudad",
        "l_orderkey AS Orden", "l_linenumber AS Linea", "l_suppkey AS Proveedor", "l_quantity AS Cantidad",
        "l_extendedprice AS Precio", "l_discount AS Descuento", "l_tax AS Impuesto", "l_returnflag AS Marca",
        "l_linestatus AS Estado",
    )


def counsellor_log(spark: SparkSession, root: str) -> DataFrame:
    """Counsellor log sheet from events: two 'NUMERO' headers (the second is
    the person) and a header-less column."""
    return table(spark, root, "events").selectExpr(
        "event_id AS FILA",
        "month(ts) AS MES",
        "CAST(event_id AS STRING) AS NUMERO",
        "CAST(user_id AS STRING) AS NUMERO",
        "date_format(ts, 'yyyy-MM-dd') AS FECHA",
        "concat('Psicologa ', CAST(user_id % 3 AS STRING)) AS ORIENTADOR",
        "CASE WHEN event_type = 'error' THEN 'desconocida' "
        "ELSE concat(CAST(CAST(floor(value) AS BIGINT) AS STRING), '.5') END AS EDAD",
        f"upper(event_type) AS {_q('POBLACIÓN')}",
        f"props AS {_q('TALLER FIS')}",
        f"CAST(NULL AS STRING) AS {_q('Unnamed: 22')}",
    )


def placement_sheet(spark: SparkSession, root: str) -> DataFrame:
    """Placement sheet (raw headers) from lineitem: one row per candidate sent."""
    months = "array(" + ", ".join(f"'{m}'" for m in MONTHS) + ")"
    first, n = "l_linenumber = 1", "l_returnflag = 'N'"
    return table(spark, root, "lineitem").selectExpr(
        f"CASE WHEN {first} AND {n} THEN CAST(NULL AS STRING) ELSE element_at({months}, month(l_shipdate)) END "
        f"AS {_q('Mes Registro')}",
        f"CASE WHEN {first} THEN CAST(NULL AS STRING) ELSE concat('Gestion ', l_linestatus) END AS {_q('Gestión Vacante ')}",
        f"CASE WHEN {n} THEN CAST(NULL AS STRING) ELSE l_returnflag END AS {_q('Población')}",
        f"CASE WHEN {first} AND {n} THEN 'nan' ELSE CAST(l_orderkey AS STRING) END AS {_q('Código Proceso')}",
        f"CASE WHEN l_suppkey % 10 = 0 THEN CAST(NULL AS STRING) ELSE concat('Proveedor ', CAST(l_suppkey AS STRING)) END "
        f"AS {_q('Nombre de la Empresa')}",
        f"concat('Cargo ', CAST(l_partkey % 50 AS STRING)) AS {_q('Nombre de la Vacante')}",
        f"concat('Candidato ', CAST(l_partkey AS STRING)) AS {_q('Nombre del Candidato')}",
        f"CAST(l_quantity AS INT) AS {_q('Vacantes Solicitadas/Puestos de Trabajo en Plataforma')}",
        f"CASE WHEN l_linestatus = 'O' AND l_linenumber = 2 THEN 'pendiente' ELSE date_format(l_shipdate, 'yyyy-MM-dd') END "
        f"AS {_q('Fecha Envío Hojas de Vida a la Empresa')}",
        f"timestampadd(DAY, -10, l_shipdate) AS {_q('Fecha de Publicacion de la Vacante')}",
        f"CASE WHEN l_returnflag = 'A' THEN 'M' WHEN l_returnflag = 'R' THEN 'F' ELSE ' F ' END AS Sexo",
        f"CASE WHEN l_linenumber = 3 THEN CAST(NULL AS STRING) WHEN l_linenumber = 4 THEN 'x' "
        f"ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) % 80 AS STRING) END AS Edad",
        f"CASE WHEN l_linenumber = 5 THEN 'Ninguna' "
        f"ELSE concat(l_returnflag, l_linestatus, ' tipo ', CAST(l_partkey % 7 AS STRING)) END AS Condicion",
        f"CASE WHEN l_tax = 0 THEN 'Ninguno' ELSE concat('Convenio ', l_linestatus) END AS Convenio",
        f"concat(l_returnflag, l_linestatus) AS {_q('Nivel Educativo')}",
        f"CASE WHEN l_linestatus = 'F' THEN '1' WHEN {n} THEN 'si' ELSE '0' END AS Colocado",
        f"element_at({months}, month(timestampadd(DAY, 20, l_shipdate))) AS {_q('Mes de Colocación en Plataforma')}",
    )
