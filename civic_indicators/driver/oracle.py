"""DuckDB oracle SQL for every registered query (tables are pre-registered
views). The stand-in inputs are rebuilt in SQL; the expected results are
written directly in SQL, independent of the Spark code path (for parsed
dates the oracle uses the true date the text was rendered from)."""

from __future__ import annotations

from civic_indicators.driver import queries as Q
from civic_indicators.driver.standins import MONTHS
from civic_indicators.functions.patterns import AGE_BANDS
from civic_indicators.functions.text import WHITESPACE_CLASS

WS = WHITESPACE_CLASS


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def m(x: str, pattern, i: bool = False) -> str:
    if isinstance(pattern, (tuple, list)):
        return "(" + " OR ".join(m(x, p, i) for p in pattern) + ")"
    flags = ", 'i'" if i else ""
    return f"coalesce(regexp_matches({x}, '{pattern}'{flags}), false)"


def last_match(x: str, rules, i: bool = True) -> str:
    whens = " ".join(f"WHEN {m(x, p, i)} THEN '{label}'" for p, label in reversed(list(rules)))
    return f"CASE {whens} END"


def all_labels(x: str, rules, i: bool = False) -> str:
    parts = ", ".join(f"CASE WHEN {m(x, p, i)} THEN '{label}' END" for p, label in rules)
    return f"NULLIF(concat_ws('|', {parts}), '')"


def flag(label: str, *preds: str) -> str:
    return f"CASE WHEN {' OR '.join(preds)} THEN '{label}' END"


def age_band(x: str) -> str:
    whens = []
    for lo, hi, label, lo_inc in AGE_BANDS:
        op = ">=" if lo_inc else ">"
        whens.append(f"WHEN {x} {op} {lo} AND {x} < {hi} THEN '{label}'")
    return f"CASE {' '.join(whens)} END"


def month_name(ts: str, lower: bool = False) -> str:
    names = ", ".join(f"'{n.lower() if lower else n}'" for n in MONTHS)
    return f"list_extract([{names}], month({ts}))"


def unpivot(src: str, cols: list[str], name: str = "indicator", value: str = "value") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS {name}, {c} AS {value} FROM {src}" for c in cols)


# ------------------------------------------------------------ registration
REG_ROWS = f"""
reg_src AS (
  SELECT o.o_orderkey AS row_id,
    CASE WHEN o.o_orderpriority = '5-LOW' AND o.o_orderstatus = 'P' THEN 'nan'
         WHEN o.o_orderstatus = 'F' THEN ' ' || CAST(o.o_custkey AS VARCHAR) || chr(160)
         ELSE CAST(o.o_custkey AS VARCHAR) END AS doc_raw,
    NULLIF(o.o_orderpriority, '4-NOT SPECIFIED') AS tipo_documento,
    CAST(year(o.o_orderdate) AS INTEGER) AS "año",
    o.o_orderdate AS reg_ts,
    CASE WHEN o.o_orderstatus IN ('O', 'P') THEN NULL
         ELSE o.o_orderdate + to_days(CAST(o.o_custkey % 45 AS INTEGER)) END AS upd_ts,
    o.o_orderpriority || ', ' || c.c_mktsegment AS cond_raw,
    c.c_name AS programa_de_gobierno,
    o.o_orderstatus AS canal_de_registro,
    c.c_mktsegment AS tipo_registro,
    CASE WHEN c.c_nationkey % 3 = 0 THEN NULL WHEN c.c_nationkey % 3 = 1 THEN 'M' ELSE 'F' END AS "género",
    CAST(CAST(floor(o.o_totalprice) AS BIGINT) % 90 AS INTEGER) AS edad,
    {strip("'  300 ' || CAST(c.c_custkey % 1000 AS VARCHAR) || chr(9)")} AS celular
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
reg_all AS (
  SELECT *, NULLIF({strip('doc_raw')}, 'nan') AS "número_documento",
    (tipo_documento IS NULL OR NULLIF({strip('doc_raw')}, 'nan') IS NULL) AS rejected
  FROM reg_src
),
reg_valid AS (
  SELECT "número_documento", tipo_documento, "año",
    strftime(reg_ts, '%Y-%m-%d') AS fecha_registro,
    strftime(upd_ts, '%Y-%m-%d') AS "fecha_actualización",
    strftime(greatest(reg_ts, upd_ts), '%Y-%m-%d') AS fecha_accion,
    CAST(greatest(reg_ts, upd_ts) AS DATE) AS fecha_accion_dia,
    lower(cond_raw) AS condiciones_especiales, programa_de_gobierno, canal_de_registro,
    tipo_registro, "género", edad, celular,
    {all_labels('lower(cond_raw)', Q.REG_RULES.ethnic)} AS grupos_etnicos,
    {flag('VCA', m('programa_de_gobierno', Q.REG_RULES.vca_programme), m('lower(cond_raw)', Q.REG_RULES.vca_condition))} AS vca,
    {last_match('lower(cond_raw)', Q.REG_RULES.disability)} AS discapacidad,
    {flag('Migrante o Retornado', m('lower(cond_raw)', Q.REG_RULES.migrant_condition), m('tipo_documento', Q.REG_RULES.migrant_document))} AS migrante,
    {flag('vvg', m('lower(cond_raw)', Q.REG_RULES.vvg_condition))} AS vvg,
    {flag('reincorporados', m('lower(cond_raw)', Q.REG_RULES.reintegrated_condition))} AS reincorporados
  FROM reg_all WHERE NOT rejected
)"""

PANEL_FLAGS = {"disability": "discapacidad", "vca": "vca", "vvg": "vvg", "migrant": "migrante",
               "ethnic": "grupos_etnicos", "reintegrated": "reincorporados"}
INDICATORS = ["men", "women", *PANEL_FLAGS, "elders", "adults", "youth"]


def panel_aggs(cohort: str, sex: str, male: str, female: str, flags: dict, age: str, prefix: str = "") -> list[str]:
    out = [f"count(*) FILTER (WHERE ({cohort}) AND {sex} = '{male}') AS {prefix}men",
           f"count(*) FILTER (WHERE ({cohort}) AND {sex} = '{female}') AS {prefix}women"]
    out += [f"count({c}) FILTER (WHERE {cohort}) AS {prefix}{n}" for n, c in flags.items()]
    out += [f"count({sex}) FILTER (WHERE ({cohort}) AND {age} >= 60) AS {prefix}elders",
            f"count({sex}) FILTER (WHERE ({cohort}) AND {age} >= 29 AND {age} < 60) AS {prefix}adults",
            f"count({sex}) FILTER (WHERE ({cohort}) AND {age} <= 28) AS {prefix}youth"]
    return out


def reg_cohort(name: str) -> str:
    ch, kind = Q.REG_COHORTS[name]
    return f"canal_de_registro = '{ch}' AND tipo_registro = '{kind}'"


def sql_indicator_panel() -> str:
    coh = (f"{reg_cohort('self_registered_new')} AND month(fecha_accion_dia) = {Q.REG_MONTH} "
           f"AND year(fecha_accion_dia) = {Q.REG_YEAR}")
    aggs = ", ".join(panel_aggs(coh, '"género"', "M", "F", PANEL_FLAGS, "edad"))
    return f"WITH {REG_ROWS}, wide AS (SELECT {aggs} FROM reg_valid) {unpivot('wide', INDICATORS)}"


def sql_monthly_panels() -> str:
    tagged = " UNION ALL ".join(
        f"SELECT '{name}' AS cohort, CAST(year(fecha_accion_dia) AS INTEGER) AS year, "
        f"CAST(month(fecha_accion_dia) AS INTEGER) AS month, * FROM reg_valid "
        f"WHERE {reg_cohort(name)} AND fecha_accion_dia IS NOT NULL" for name in Q.REG_COHORTS)
    aggs = ", ".join(panel_aggs("true", '"género"', "M", "F", PANEL_FLAGS, "edad"))
    wide = f"wide AS (SELECT cohort, year, month, {aggs} FROM ({tagged}) GROUP BY 1, 2, 3)"
    parts = [f"SELECT cohort, year, month, '{ind}' AS indicator, {ind} AS value FROM wide" for ind in INDICATORS]
    return f"WITH {REG_ROWS}, {wide} {' UNION ALL '.join(parts)}"


def sql_registration() -> str:
    cols = ", ".join(f'"{c}"' for c in Q.REG_OUT)
    return f"WITH {REG_ROWS} SELECT {cols} FROM reg_valid"


def sql_misdated_audit() -> str:
    return (f"WITH {REG_ROWS} SELECT fecha_accion, count(*) AS count FROM reg_valid "
            f"WHERE fecha_accion_dia <= DATE '{Q.AUDIT_CUTOFF}' GROUP BY fecha_accion")


def sql_quarantine_split() -> str:
    return (f"WITH {REG_ROWS} SELECT row_id, CASE WHEN rejected THEN 'rejected' ELSE 'valid' END AS status "
            f"FROM reg_all")


def sql_sink_roundtrip() -> str:
    return (f"WITH {REG_ROWS} SELECT 'split' AS dataset, CASE WHEN rejected THEN 'rejected' ELSE 'valid' END AS part, "
            f"count(*) AS rows FROM reg_all GROUP BY 2 UNION ALL "
            f"SELECT 'curated' AS dataset, CAST(\"año\" AS VARCHAR) AS part, count(*) AS rows FROM reg_valid GROUP BY 2")


# --------------------------------------------------------------- operators
SQL_SIMPLE = {
    "scan_headers": """SELECT c_custkey AS "número_cliente", c_name AS cliente, c_mktsegment AS segmento,
        c_mktsegment AS segmento_copia FROM customer""",
    "clean_text": f"SELECT conv_id, turn, lower(role) AS role, {strip('lower(text)')} AS text FROM conversations",
    "null_sentinels": """SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS status,
        CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN NULL ELSE o_orderpriority END AS priority,
        CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS note FROM orders""",
    "recode_fill": """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'CONSTRUCCION'
        WHEN 'MACHINERY' THEN 'MAQUINARIA' WHEN 'HOUSEHOLD' THEN 'SIN SEGMENTO' ELSE c_mktsegment END AS segment
        FROM customer""",
    "coerce_numbers": """SELECT p_partkey, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_no,
        CASE WHEN p_size > 40 THEN 0 ELSE p_size END AS size_or_zero,
        CAST(round_even(p_size / 2, 0) AS INTEGER) AS half_size,
        CAST(round_even(p_size + 0.5, 0) AS INTEGER) AS size_up,
        CAST(NULL AS DOUBLE) AS type_number FROM part""",
    "age_bands": f"SELECT {age_band('(p_size * 2 - 2)')} AS rango_de_edad, count(*) AS count FROM part GROUP BY 1",
    "drop_empty_rows": """SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS status,
        NULLIF(o_orderpriority, '5-LOW') AS priority FROM orders
        WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')""",
    "cohort_filter": """SELECT o_orderkey, o_custkey, CAST(floor(o_totalprice) AS BIGINT) % 90 AS age FROM orders
        WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1996-04-01'
        AND CAST(floor(o_totalprice) AS BIGINT) % 90 >= 29 AND CAST(floor(o_totalprice) AS BIGINT) % 90 < 60
        AND o_orderdate <= TIMESTAMP '1998-01-01'""",
    "masked_assign_concat": """SELECT o_orderkey,
        CASE WHEN o_orderstatus = 'F' THEN 'final' WHEN o_orderpriority = '1-URGENT' THEN 'urgente' END AS label,
        CASE WHEN o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW'
             THEN concat_ws(', ', NULLIF(o_orderstatus, 'P'), NULLIF(o_orderpriority, '5-LOW')) END AS joined
        FROM orders""",
    "parse_dates": """SELECT o_orderkey,
        CASE WHEN o_orderkey % 6 = 5 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS mixed,
        CASE WHEN o_orderkey % 6 = 5 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS lenient,
        strftime(o_orderdate, '%Y-%m-%d') AS strict FROM orders""",
    "date_parts": """SELECT l_orderkey, l_linenumber,
        strftime(greatest(l_shipdate, CASE WHEN l_linenumber % 2 = 0 THEN NULL
            ELSE l_shipdate + to_days(CAST(l_quantity - 25 AS INTEGER)) END), '%Y-%m-%d') AS latest_day,
        true AS text_roundtrip,
        CAST(month(l_shipdate) AS INTEGER) AS month, CAST(year(l_shipdate) AS INTEGER) AS year,
        CAST(week(l_shipdate) AS INTEGER) AS iso_week, CAST(isoyear(l_shipdate) AS INTEGER) AS iso_year
        FROM lineitem""",
    "label_last_match": f"SELECT doc_id, {last_match('text', Q.DOC_LABELS)} AS label FROM documents",
    "pattern_flags": f"""SELECT conv_id, turn, {flag('fr', m('text', 'eau|ç'))} AS fr,
        {flag('de', m('text', 'ß'), m('role', 'system'))} AS de, {flag('wild', m('text', 'v.e'))} AS wild,
        {flag('upper', m('text', 'ÜBER|ÉT', True))} AS upper FROM conversations""",
    "label_array": f"SELECT doc_id, {all_labels('text', Q.DOC_GROUPS)} AS groups FROM documents",
    "any_flag": f"""SELECT conv_id, turn, ({m('text', 'eau|ç')} OR {m('text', 'ñ')} OR {m('role', 'system')})
        AS any_flag FROM conversations""",
    "enrich_left": """SELECT o.o_orderkey, c.c_mktsegment, n.n_name FROM orders o
        LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "value_counts": "SELECT event_type, count(*) AS count FROM events GROUP BY 1",
    "column_frequencies": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {e} AS value, count(*) AS count FROM orders WHERE {e} IS NOT NULL GROUP BY 2" for c, e in (
            ("o_orderkey", "CAST(o_orderkey AS VARCHAR)"), ("o_custkey", "CAST(o_custkey AS VARCHAR)"), ("o_orderstatus", "o_orderstatus"),
            ("o_totalprice", "CAST(o_totalprice AS VARCHAR)"), ("o_orderdate", "strftime(o_orderdate, '%Y-%m-%d')"),
            ("o_orderpriority", "o_orderpriority"))),
    "id_sets": """WITH ids AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0 UNION SELECT c_custkey FROM customer WHERE c_nationkey < 5),
        o AS (SELECT o_orderkey, o_custkey IN (SELECT c_custkey FROM ids) AS hit FROM orders)
        SELECT CASE WHEN hit THEN 'kept' ELSE 'dropped' END AS part, o_orderkey FROM o
        UNION ALL SELECT 'marked_' || CASE WHEN hit THEN 'true' ELSE 'false' END, o_orderkey FROM o""",
    "unparsed_dates": """SELECT style, day, CAST(sum(bad) AS BIGINT) AS unparsed, count(*) AS rows FROM (
        SELECT o_orderkey % 7 AS style, CASE WHEN o_orderkey % 7 < 4 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
            CASE WHEN o_orderkey % 7 = 4 THEN 1 ELSE 0 END AS bad FROM orders) GROUP BY 1, 2""",
    "sorted_types": """SELECT event_type, count, CAST(row_number() OVER (ORDER BY count DESC, event_type) AS INTEGER) AS place
        FROM (SELECT event_type, count(*) AS count FROM events WHERE event_type IS NOT NULL GROUP BY 1)""",
    "person_keys": """SELECT person, count(*) AS rows, count(age) AS ages, max(age) AS oldest FROM (
        SELECT CASE WHEN o_orderkey % 5 > 1 THEN CAST(o_custkey AS VARCHAR) END AS person,
            CASE WHEN o_orderkey % 5 <> 3 THEN CAST(CASE WHEN (o_custkey % 90) % 2 = 0 THEN o_custkey % 90 ELSE o_custkey % 90 + 1 END AS INTEGER) END AS age
        FROM orders) GROUP BY 1""",
    "pivot_counts": f"""SELECT rango_de_edad, p_brand, {', '.join(f"count(*) FILTER (WHERE p_type = '{t}') AS {t}" for t in Q.TYPE_LABELS)}
        FROM (SELECT {age_band('(p_size * 2 - 2)')} AS rango_de_edad, p_brand, p_type FROM part)
        WHERE rango_de_edad IS NOT NULL AND p_brand IS NOT NULL AND p_type IS NOT NULL GROUP BY 1, 2""",
    "daily_counts": """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS count FROM events
        WHERE strftime(ts, '%Y-%m-%d') <= '2024-01-20' GROUP BY 1""",
    "table_profile": """SELECT * FROM (
        SELECT 'c_custkey' AS "column", 'bigint' AS type, count(c_custkey) AS non_null, count(*) AS rows FROM customer
        UNION ALL SELECT 'c_name', 'string', count(c_name), count(*) FROM customer
        UNION ALL SELECT 'c_nationkey', 'int', count(c_nationkey), count(*) FROM customer
        UNION ALL SELECT 'c_acctbal', 'double', count(c_acctbal), count(*) FROM customer
        UNION ALL SELECT 'c_mktsegment', 'string', count(NULLIF(c_mktsegment, 'HOUSEHOLD')), count(*) FROM customer)""",
    "preview": """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 5""",
}

LINE_ORDER_STRUCT = ("struct_pack(k0 := l_orderkey, k1 := l_linenumber, k2 := l_partkey, k3 := l_quantity, "
                     "k4 := l_extendedprice, k5 := l_discount, k6 := l_tax, k7 := l_returnflag, "
                     "k8 := l_linestatus, k9 := l_shipdate)")


def first_agg(c: str, order: str) -> str:
    return f"arg_min({c}, {order}) FILTER (WHERE {c} IS NOT NULL) AS {c}"


def sql_first_per_key() -> str:
    src = f"""SELECT l_suppkey, {LINE_ORDER_STRUCT} AS ord, NULLIF(l_returnflag, 'N') AS flag,
        NULLIF(l_linestatus, 'O') AS status, CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS discount,
        CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS tax,
        CASE WHEN l_quantity < 10 THEN NULL ELSE l_partkey END AS part,
        strftime(l_shipdate, '%Y-%m-%d') AS ship, l_quantity, l_linenumber FROM lineitem"""
    cols = ["flag", "status", "discount", "tax", "part", "ship", "l_quantity", "l_linenumber"]
    return (f"SELECT l_suppkey, {', '.join(first_agg(c, 'ord') for c in cols)} FROM ({src}) "
            f"WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey")


def ordered_concat(src: str, key: str, val: str, order: str, name: str) -> str:
    return (f"SELECT {key}, string_agg({val}, ',' ORDER BY seen) AS {name} FROM "
            f"(SELECT {key}, {val}, min({order}) AS seen FROM {src} WHERE {val} IS NOT NULL AND {key} IS NOT NULL "
            f"GROUP BY {key}, {val}) GROUP BY {key}")


def sql_distinct_concat() -> str:
    src = """(SELECT o_orderkey, o_custkey, NULLIF(o_orderpriority, '5-LOW') AS priorities,
        CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_orderstatus END AS statuses FROM orders)"""
    return f"""WITH s AS {src},
      k AS (SELECT DISTINCT o_custkey FROM s WHERE o_custkey IS NOT NULL),
      p AS ({ordered_concat('s', 'o_custkey', 'priorities', 'o_orderkey', 'priorities')}),
      t AS ({ordered_concat('s', 'o_custkey', 'statuses', 'o_orderkey', 'statuses')})
      SELECT k.o_custkey, coalesce(p.priorities, '') AS priorities, coalesce(t.statuses, '') AS statuses
      FROM k LEFT JOIN p ON k.o_custkey = p.o_custkey LEFT JOIN t ON k.o_custkey = t.o_custkey"""


def sql_outer_merge() -> str:
    return f"""WITH l AS (SELECT o_custkey AS person, o_orderkey, NULLIF(o_orderstatus, 'P') AS status,
          o_orderpriority AS priority FROM orders),
      li AS (SELECT l_partkey AS person, {LINE_ORDER_STRUCT} AS ord, l_linestatus AS status,
          l_returnflag AS priority, l_quantity AS quantity FROM lineitem),
      r AS (SELECT person, {first_agg('status', 'ord')}, {first_agg('priority', 'ord')},
          {first_agg('quantity', 'ord')} FROM li WHERE person IS NOT NULL GROUP BY person)
      SELECT coalesce(l.person, r.person) AS person, l.o_orderkey,
        coalesce(l.status, r.status) AS status, coalesce(l.priority, r.priority) AS priority, r.quantity
      FROM l FULL OUTER JOIN r ON l.person = r.person"""


# ---------------------------------------------------------------- placement
def _pl_cond():
    return ("CASE WHEN l_linenumber = 5 THEN NULL ELSE lower(l_returnflag || l_linestatus || ' tipo ' "
            "|| CAST(l_partkey % 7 AS VARCHAR)) END")


PL = Q.PLACE_RULES
PLACE_ROWS = f"""
pl0 AS (
  SELECT
    CASE WHEN l_linenumber = 1 AND l_returnflag = 'N' THEN NULL ELSE {month_name('l_shipdate', True)} END AS mes_registro,
    CASE WHEN l_linenumber = 1 THEN NULL ELSE lower('Gestion ' || l_linestatus) END AS "gestión_vacante_",
    CASE WHEN l_returnflag = 'N' THEN NULL ELSE lower(l_returnflag) END AS "población",
    CASE WHEN l_linenumber = 1 AND l_returnflag = 'N' THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS "código_proceso",
    CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE 'proveedor ' || CAST(l_suppkey AS VARCHAR) END AS nombre_de_la_empresa,
    'cargo ' || CAST(l_partkey % 50 AS VARCHAR) AS nombre_de_la_vacante,
    CAST(trunc(l_quantity) AS INTEGER) AS puestos_de_trabajo_en_plataforma,
    CASE WHEN l_linestatus = 'O' AND l_linenumber = 2 THEN NULL ELSE CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) END AS sent_ts,
    CASE l_returnflag WHEN 'A' THEN 'm' ELSE 'f' END AS sexo,
    CAST(CASE WHEN l_linenumber = 3 THEN 0 WHEN l_linenumber = 4 THEN NULL
         ELSE CAST(floor(l_extendedprice) AS BIGINT) % 80 END AS INTEGER) AS edad,
    {_pl_cond()} AS condicion,
    CASE WHEN l_tax = 0 THEN NULL ELSE lower('Convenio ' || l_linestatus) END AS convenio,
    lower(l_returnflag || l_linestatus) AS nivel_raw,
    CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS colocado,
    l_shipdate - INTERVAL 10 DAY AS pub,
    {month_name("l_shipdate + INTERVAL 20 DAY", True)} AS "mes_de_colocación_en_plataforma"
  FROM lineitem
),
pl AS (
  SELECT mes_registro, "gestión_vacante_", "código_proceso", nombre_de_la_empresa, nombre_de_la_vacante,
    puestos_de_trabajo_en_plataforma, sent_ts, strftime(sent_ts, '%Y-%m-%d') AS "fecha_envío_hojas_de_vida_a_la_empresa",
    sexo, edad, {age_band('edad')} AS rango_de_edad, condicion, convenio,
    CASE nivel_raw {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in PL.education.items())} ELSE nivel_raw END AS nivel_educativo,
    colocado, CAST(week(pub) AS INTEGER) AS semana_publicacion_vacante,
    CAST(month(pub) AS INTEGER) AS mes_publicacion_vacante, CAST(isoyear(pub) AS INTEGER) AS "año_publicacion_vacante",
    "mes_de_colocación_en_plataforma",
    {last_match('condicion', PL.disability)} AS discapacidad,
    {flag('vca', m('condicion', PL.vca_condition))} AS vca,
    {flag('vvg', m('condicion', PL.vvg_condition))} AS vvg,
    {flag('Migrante y/o retronado', m('condicion', PL.migrant_condition))} AS migrante,
    {flag('grupo_etnico', m('condicion', '|'.join(p for p, _ in PL.ethnic)))} AS etnias,
    {flag('reincorporados', m('condicion', PL.reintegrated_condition))} AS reincorporados
  FROM pl0
  WHERE NOT (mes_registro IS NULL AND "gestión_vacante_" IS NULL AND "población" IS NULL AND "código_proceso" IS NULL)
)"""

SENT = f"coalesce(month(sent_ts) = {Q.PLACE_MONTH}, false)"
PLACED = f"(colocado = 1 AND \"mes_de_colocación_en_plataforma\" = '{Q.PLACE_MONTH_NAME}')"
PLACE_FLAGS = {"disability": "discapacidad", "vca": "vca", "vvg": "vvg", "migrant": "migrante",
               "ethnic": "etnias", "reintegrated": "reincorporados"}


def dwn(c: str) -> str:
    return f"(count(DISTINCT {c}) + coalesce(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0))"


def sql_placement() -> str:
    cols = ", ".join(f'"{c}"' for c in Q.PLACE_OUT)
    return f"WITH {PLACE_ROWS} SELECT {cols} FROM pl"


def sql_distinct_with_null() -> str:
    return (f"WITH {PLACE_ROWS} SELECT mes_registro, {dwn('nombre_de_la_empresa')} AS employers, "
            f"{dwn('\"código_proceso\"')} AS processes, {dwn('nombre_de_la_vacante')} AS vacancies "
            f"FROM pl GROUP BY mes_registro")


def sql_distinct_counts() -> str:
    return ("WITH li AS (SELECT *, CASE WHEN l_linenumber > 2 THEN l_suppkey END AS supplier FROM lineitem) "
            f"SELECT l_returnflag, {dwn('l_partkey')} AS parts, {dwn('supplier')} AS suppliers, {dwn('l_shipdate')} AS days, "
            "CAST(sum(l_linenumber) AS BIGINT) AS lines FROM li GROUP BY l_returnflag")


def sql_distinct_values() -> str:
    return f"WITH {PLACE_ROWS} SELECT DISTINCT nombre_de_la_vacante FROM pl WHERE {SENT}"


def sql_sums() -> str:
    coh = f"mes_registro = '{Q.PLACE_MONTH_NAME}'"
    return (f"WITH {PLACE_ROWS} SELECT nombre_de_la_empresa, CAST(coalesce(sum(puestos_de_trabajo_en_plataforma), 0) AS BIGINT) AS posts "
            f"FROM pl WHERE {coh} AND nombre_de_la_empresa IS NOT NULL GROUP BY 1 UNION ALL "
            f"SELECT 'TOTAL', CAST(coalesce(sum(puestos_de_trabajo_en_plataforma) FILTER (WHERE {coh}), 0) AS BIGINT) FROM pl")


def sql_vacancy_summary() -> str:
    return (f"WITH {PLACE_ROWS} SELECT {dwn('nombre_de_la_empresa')} AS employers, {dwn('\"código_proceso\"')} AS processes, "
            f"CAST(coalesce(sum(puestos_de_trabajo_en_plataforma), 0) AS BIGINT) AS posts FROM pl "
            f"WHERE mes_registro = '{Q.PLACE_MONTH_NAME}'")


def sql_placement_panels() -> str:
    aggs = (panel_aggs(SENT, "sexo", "m", "f", PLACE_FLAGS, "edad", "c0__")
            + panel_aggs(PLACED, "sexo", "m", "f", PLACE_FLAGS, "edad", "c1__"))
    parts = [f"SELECT '{name}' AS cohort, '{ind}' AS indicator, c{i}__{ind} AS value FROM wide"
             for i, name in enumerate(["sent", "placed"]) for ind in INDICATORS]
    return f"WITH {PLACE_ROWS}, wide AS (SELECT {', '.join(aggs)} FROM pl) {' UNION ALL '.join(parts)}"


def sql_inclusive_employers() -> str:
    anyf = "coalesce(etnias, migrante, vca, discapacidad) IS NOT NULL"
    return f"WITH {PLACE_ROWS} SELECT DISTINCT nombre_de_la_empresa FROM pl WHERE {anyf} AND {PLACED}"


def sql_disability_report() -> str:
    cells = ", ".join(f"count(*) FILTER (WHERE discapacidad = '{l}') AS \"{l}\"" for l in Q.PLACE_LABELS)
    return (f"WITH {PLACE_ROWS} SELECT rango_de_edad, sexo, {cells} FROM pl WHERE {PLACED} "
            f"AND rango_de_edad IS NOT NULL AND sexo IS NOT NULL AND discapacidad IS NOT NULL GROUP BY 1, 2")


def sql_disability_report_sent() -> str:
    cells = ", ".join(f"count(*) FILTER (WHERE discapacidad = '{l}') AS \"{l}\"" for l in Q.PLACE_LABELS)
    return (f"WITH {PLACE_ROWS} SELECT rango_de_edad, sexo, {cells} FROM pl WHERE {SENT} "
            f"AND rango_de_edad IS NOT NULL AND sexo IS NOT NULL AND discapacidad IS NOT NULL GROUP BY 1, 2")


def sql_disability_placements() -> str:
    return (f"WITH {PLACE_ROWS} SELECT nombre_de_la_empresa, count(*) AS count FROM pl WHERE {PLACED} "
            f"AND discapacidad IS NOT NULL AND nombre_de_la_empresa IS NOT NULL GROUP BY 1")


# ----------------------------------------------------------------- guidance
GR = Q.GUIDE_RULES
WK_FIRST = ["fechaagendamiento_taller", "fechaejecucion_taller", "fechaevaluacion_taller", "tallerista",
            "sexo", "tipodocumento", "indicador", "ciudad", "orden", "linea", "proveedor", "cantidad",
            "precio", "descuento", "impuesto", "marca", "estado", "mes_taller", "año_taller"]
GUIDE_ROWS = f"""
sess AS (
  SELECT CAST(o_custkey AS VARCHAR) AS numerodocumento, lower('Orientador ' || o_orderstatus) AS orientador,
    CASE WHEN o_custkey % 2 = 0 THEN 'm' ELSE 'f' END AS sexo, lower(o_orderpriority) AS tipodocumento,
    lower(NULLIF(o_orderstatus, 'P')) AS programagobierno, 'orientacion' AS indicador,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'ciudad ' || CAST(o_custkey % 7 AS VARCHAR) END AS ciudad,
    CAST(month(o_orderdate) AS INTEGER) AS mes_orientado, CAST(year(o_orderdate) AS INTEGER) AS "año_orientado"
  FROM orders
),
wk AS (
  SELECT CAST(l_partkey AS VARCHAR) AS numerodocumento,
    l_shipdate - INTERVAL 7 DAY AS fechaagendamiento_taller, l_shipdate AS fechaejecucion_taller,
    l_shipdate + INTERVAL 1 DAY AS fechaevaluacion_taller,
    lower('Tallerista ' || CAST(l_suppkey AS VARCHAR)) AS tallerista,
    CASE WHEN l_partkey % 2 = 0 THEN 'm' ELSE 'f' END AS sexo, lower(NULLIF(l_returnflag, 'N')) AS tipodocumento,
    lower(l_linestatus || '-' || l_returnflag) AS programagobierno, 'taller' AS indicador,
    CASE WHEN l_linenumber = 1 THEN NULL ELSE 'ciudad ' || CAST(l_linenumber AS VARCHAR) END AS ciudad,
    l_orderkey AS orden, l_linenumber AS linea, l_suppkey AS proveedor, l_quantity AS cantidad,
    l_extendedprice AS precio, l_discount AS descuento, l_tax AS impuesto, l_returnflag AS marca,
    l_linestatus AS estado, CAST(month(l_shipdate) AS INTEGER) AS mes_taller,
    CAST(year(l_shipdate) AS INTEGER) AS "año_taller",
    struct_pack(k0 := l_orderkey, k1 := l_linenumber, k2 := l_suppkey, k3 := l_quantity, k4 := l_extendedprice,
      k5 := l_discount, k6 := l_tax, k7 := l_returnflag, k8 := l_linestatus, k9 := l_shipdate) AS ord
  FROM lineitem
),
wfirst AS (SELECT numerodocumento, {', '.join(first_agg(f'"{c}"', 'ord') for c in WK_FIRST)}
  FROM wk GROUP BY numerodocumento),
wcat AS ({ordered_concat('wk', 'numerodocumento', 'programagobierno', 'ord', 'programagobierno')}),
wp AS (SELECT f.*, coalesce(c.programagobierno, '') AS programagobierno FROM wfirst f
  LEFT JOIN wcat c ON f.numerodocumento = c.numerodocumento),
p0 AS (
  SELECT coalesce(s.numerodocumento, w.numerodocumento) AS numerodocumento, s.orientador, w.tallerista,
    s.mes_orientado, s."año_orientado", w.mes_taller, w."año_taller",
    coalesce(s.sexo, w.sexo) AS sexo, coalesce(s.tipodocumento, w.tipodocumento) AS tipodocumento,
    coalesce(s.ciudad, w.ciudad) AS ciudad, coalesce(s.programagobierno, w.programagobierno) AS programagobierno,
    w.orden
  FROM sess s FULL OUTER JOIN wp w ON s.numerodocumento = w.numerodocumento
),
rr AS (
  SELECT {strip("CASE WHEN o.o_orderpriority = '5-LOW' AND o.o_orderstatus = 'P' THEN 'nan' WHEN o.o_orderstatus = 'F' THEN ' ' || CAST(o.o_custkey AS VARCHAR) || chr(160) ELSE CAST(o.o_custkey AS VARCHAR) END")} AS numerodocumento,
    o.o_orderkey AS ord, c.c_name AS prog, o.o_orderpriority || ', ' || c.c_mktsegment AS cond
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
rk AS (SELECT DISTINCT numerodocumento FROM rr WHERE numerodocumento IS NOT NULL),
rp AS ({ordered_concat('rr', 'numerodocumento', 'prog', 'ord', 'prog')}),
rc AS ({ordered_concat('rr', 'numerodocumento', 'cond', 'ord', 'cond')}),
reg AS (SELECT k.numerodocumento, coalesce(rp.prog, '') AS prog, coalesce(rc.cond, '') AS cond FROM rk k
  LEFT JOIN rp ON k.numerodocumento = rp.numerodocumento LEFT JOIN rc ON k.numerodocumento = rc.numerodocumento),
cl AS (
  SELECT CAST(user_id AS VARCHAR) AS numerodocumento, event_id AS ord,
    CASE WHEN event_type = 'error' THEN 'desconocida' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '.5' END AS edad,
    lower(upper(event_type)) AS poblacion
  FROM events
),
ca AS (SELECT numerodocumento, {first_agg('edad', 'ord')} FROM cl GROUP BY numerodocumento),
cp AS ({ordered_concat('cl', 'numerodocumento', 'poblacion', 'ord', 'poblacion')}),
clog AS (SELECT a.numerodocumento, a.edad, coalesce(cp.poblacion, '') AS poblacion FROM ca a
  LEFT JOIN cp ON a.numerodocumento = cp.numerodocumento),
people AS (
  SELECT p0.*, r.prog AS programa_de_gobierno,
    lower(CASE WHEN r.cond IS NOT NULL OR c.poblacion IS NOT NULL THEN concat_ws(', ', r.cond, c.poblacion) END)
      AS condiciones_especiales,
    CAST(round_even(try_cast(c.edad AS DOUBLE), 0) AS INTEGER) AS edad
  FROM p0 LEFT JOIN reg r ON p0.numerodocumento = r.numerodocumento
  LEFT JOIN clog c ON p0.numerodocumento = c.numerodocumento
),
gp AS (
  SELECT *, {age_band('edad')} AS rango_de_edad,
    {all_labels('condiciones_especiales', GR.ethnic)} AS grupos_etnicos,
    {flag('VCA', m('programa_de_gobierno', GR.vca_programme), m('condiciones_especiales', GR.vca_condition))} AS vca,
    {last_match('condiciones_especiales', GR.disability)} AS discapacidad,
    {flag('Migrante o Retornado', m('condiciones_especiales', GR.migrant_condition), m('tipodocumento', GR.migrant_document))} AS migrante,
    {flag('vvg', m('condiciones_especiales', GR.vvg_condition))} AS vvg,
    {flag('reincorporados', m('condiciones_especiales', GR.reintegrated_condition))} AS reincorporados
  FROM people
)"""


def sql_guidance() -> str:
    cols = ", ".join(f'"{c}"' for c in Q.GUIDE_OUT)
    return f"WITH {GUIDE_ROWS} SELECT {cols} FROM gp"


def sql_guided_listing() -> str:
    return (f"WITH {GUIDE_ROWS} SELECT numerodocumento, orientador, discapacidad FROM gp "
            f"WHERE mes_orientado = {Q.GUIDE_MONTH} AND \"año_orientado\" = {Q.GUIDE_YEAR} "
            f"AND orientador IS NOT NULL AND discapacidad IS NOT NULL")


def sql_guidance_panels() -> str:
    flags = {"disability": "discapacidad", "vca": "vca", "vvg": "vvg", "migrant": "migrante",
             "ethnic": "grupos_etnicos", "reintegrated": "reincorporados"}
    g = f"coalesce(mes_orientado = {Q.GUIDE_MONTH} AND \"año_orientado\" = {Q.GUIDE_YEAR}, false)"
    w = f"coalesce(mes_taller = {Q.GUIDE_MONTH} AND \"año_taller\" = {Q.GUIDE_YEAR}, false)"
    aggs = (panel_aggs(g, "sexo", "m", "f", flags, "edad", "c0__")
            + panel_aggs(w, "sexo", "m", "f", flags, "edad", "c1__"))
    parts = [f"SELECT '{name}' AS cohort, '{ind}' AS indicator, c{i}__{ind} AS value FROM wide"
             for i, name in enumerate(["guided", "workshop"]) for ind in INDICATORS]
    return f"WITH {GUIDE_ROWS}, wide AS (SELECT {', '.join(aggs)} FROM gp) {' UNION ALL '.join(parts)}"


def sql_inclusive_employer_count() -> str:
    anyf = "coalesce(etnias, migrante, vca, discapacidad) IS NOT NULL"
    return f"WITH {PLACE_ROWS} SELECT {dwn('nombre_de_la_empresa')} AS employers FROM pl WHERE {anyf} AND {PLACED}"


def sql_disability_posts() -> str:
    return (f"WITH {PLACE_ROWS} SELECT nombre_de_la_empresa, CAST(coalesce(sum(puestos_de_trabajo_en_plataforma), 0) AS BIGINT) AS posts "
            f"FROM pl WHERE mes_registro = '{Q.PLACE_MONTH_NAME}' AND discapacidad IS NOT NULL "
            f"AND nombre_de_la_empresa IS NOT NULL GROUP BY 1")


def sql_disability_vacancies() -> str:
    return (f"WITH {PLACE_ROWS} SELECT nombre_de_la_vacante, count(*) AS count FROM pl WHERE {PLACED} "
            f"AND discapacidad IS NOT NULL AND nombre_de_la_vacante IS NOT NULL GROUP BY 1")


def sql_fixed_rules() -> str:
    def pick(j: int) -> str:
        return "CASE doc_id % 23 " + " ".join(f"WHEN {i} THEN '{p[j]}'" for i, p in enumerate(Q.PHRASES) if p[j] is not None) + " END"

    labels = sql_population_labels().split("FROM documents")[0]
    return (f"SELECT * EXCLUDE (any_population) FROM ({labels} FROM (SELECT doc_id, concat_ws(' ', text, {pick(0)}) AS text, "
            f"{pick(1)} AS source, {pick(2)} AS lang FROM documents))")


def sql_text_posts() -> str:
    posts = "CASE WHEN puestos_de_trabajo_en_plataforma = 13 THEN NULL ELSE puestos_de_trabajo_en_plataforma END"
    month = f"mes_registro = '{Q.PLACE_MONTH_NAME}'"
    return (f"WITH {PLACE_ROWS} SELECT 'deduped' AS what, '' AS name, CAST(coalesce(sum(most), 0) AS BIGINT) AS posts FROM "
            f"(SELECT max({posts}) AS most FROM pl WHERE {month} GROUP BY \"código_proceso\") "
            f"UNION ALL SELECT 'employer', nombre_de_la_empresa, CAST(coalesce(sum({posts}), 0) AS BIGINT) FROM pl "
            f"WHERE {month} AND discapacidad IS NOT NULL AND nombre_de_la_empresa IS NOT NULL GROUP BY 2")


def sql_vacancy_summary_dedup() -> str:
    m = f"mes_registro = '{Q.PLACE_MONTH_NAME}'"
    return (f"WITH {PLACE_ROWS} SELECT (SELECT {dwn('nombre_de_la_empresa')} FROM pl WHERE {m}) AS employers, "
            f"(SELECT {dwn('\"código_proceso\"')} FROM pl WHERE {m}) AS processes, "
            f"(SELECT CAST(coalesce(sum(p), 0) AS BIGINT) FROM (SELECT \"código_proceso\", "
            f"max(puestos_de_trabajo_en_plataforma) AS p FROM pl WHERE {m} GROUP BY 1)) AS posts")


def sql_guidance_monthly() -> str:
    flags = {"disability": "discapacidad", "vca": "vca", "vvg": "vvg", "migrant": "migrante",
             "ethnic": "grupos_etnicos", "reintegrated": "reincorporados"}
    tagged = (f"SELECT 'guided' AS cohort, \"año_orientado\" AS year, mes_orientado AS month, * FROM gp "
              f"WHERE mes_orientado IS NOT NULL UNION ALL "
              f"SELECT 'workshop' AS cohort, \"año_taller\" AS year, mes_taller AS month, * FROM gp "
              f"WHERE mes_taller IS NOT NULL")
    aggs = ", ".join(panel_aggs("true", "sexo", "m", "f", flags, "edad"))
    parts = [f"SELECT cohort, year, month, '{ind}' AS indicator, {ind} AS value FROM wide" for ind in INDICATORS]
    return (f"WITH {GUIDE_ROWS}, wide AS (SELECT cohort, year, month, {aggs} FROM ({tagged}) GROUP BY 1, 2, 3) "
            f"{' UNION ALL '.join(parts)}")


def sql_registration_panels() -> str:
    aggs = []
    for i, name in enumerate(Q.REG_COHORTS):
        coh = (f"{reg_cohort(name)} AND month(fecha_accion_dia) = {Q.REG_MONTH} "
               f"AND year(fecha_accion_dia) = {Q.REG_YEAR}")
        aggs += panel_aggs(coh, '"género"', "M", "F", PANEL_FLAGS, "edad", f"c{i}__")
    parts = [f"SELECT '{name}' AS cohort, '{ind}' AS indicator, c{i}__{ind} AS value FROM wide"
             for i, name in enumerate(Q.REG_COHORTS) for ind in INDICATORS]
    return f"WITH {REG_ROWS}, wide AS (SELECT {', '.join(aggs)} FROM reg_valid) {' UNION ALL '.join(parts)}"


def sql_population_labels() -> str:
    from civic_indicators.functions import patterns as P
    c = "lower(text)"
    reg = {
        "grupos_etnicos": all_labels(c, P.ETHNIC_GROUPS),
        "vca": flag(P.VCA_LABEL, m("source", P.VCA_PROGRAMME), m(c, P.VCA_CONDITION)),
        "discapacidad": last_match(c, P.DISABILITY_REGISTRATION),
        "migrante": flag(P.MIGRANT_LABEL, m(c, P.MIGRANT_CONDITION), m("lang", P.MIGRANT_DOCUMENT_REGISTRATION)),
        "vvg": flag(P.VVG_LABEL, m(c, P.VVG_CONDITION)),
        "reincorporados": flag(P.REINTEGRATED_LABEL, m(c, P.REINTEGRATED_CONDITION)),
    }
    gui = dict(reg, discapacidad=last_match(c, P.DISABILITY_GUIDANCE),
               migrante=flag(P.MIGRANT_LABEL, m(c, P.MIGRANT_CONDITION), m("lang", P.MIGRANT_DOCUMENT_GUIDANCE)))
    ethnic_any = "|".join(p for p, _ in P.ETHNIC_GROUPS)
    pla = {
        "discapacidad": last_match(c, P.DISABILITY_PLACEMENT),
        "vca": flag(P.VCA_LABEL_PLACEMENT, m(c, P.VCA_CONDITION_PLACEMENT)),
        "vvg": flag(P.VVG_LABEL, m(c, P.VVG_CONDITION_PLACEMENT)),
        "migrante": flag(P.MIGRANT_LABEL_PLACEMENT, m(c, P.MIGRANT_CONDITION_PLACEMENT)),
        "etnias": flag(P.ETHNIC_ANY_LABEL, m(c, ethnic_any)),
        "reincorporados": flag(P.REINTEGRATED_LABEL, m(c, P.REINTEGRATED_CONDITION)),
    }
    cols = ([f"{e} AS reg_{k}" for k, e in reg.items()] + [f"{e} AS gui_{k}" for k, e in gui.items()]
            + [f"{e} AS pla_{k}" for k, e in pla.items()])
    anyp = f"coalesce({pla['etnias']}, {pla['migrante']}, {pla['vca']}, {pla['discapacidad']}) IS NOT NULL"
    return f"SELECT doc_id, {', '.join(cols)}, {anyp} AS any_population FROM documents"


def oracle() -> dict[str, str]:
    out = dict(SQL_SIMPLE)
    out.update({
        "indicator_panel": sql_indicator_panel(),
        "monthly_panels": sql_monthly_panels(),
        "incremental_panels": sql_monthly_panels(),
        "registration": sql_registration(),
        "misdated_audit": sql_misdated_audit(),
        "quarantine_split": sql_quarantine_split(),
        "sink_roundtrip": sql_sink_roundtrip(),
        "first_per_key": sql_first_per_key(),
        "distinct_concat": sql_distinct_concat(),
        "outer_merge": sql_outer_merge(),
        "distinct_with_null": sql_distinct_with_null(),
        "distinct_counts": sql_distinct_counts(),
        "distinct_values": sql_distinct_values(),
        "sums": sql_sums(),
        "guidance": sql_guidance(),
        "guidance_panels": sql_guidance_panels(),
        "placement": sql_placement(),
        "vacancy_summary": sql_vacancy_summary(),
        "placement_panels": sql_placement_panels(),
        "inclusive_employers": sql_inclusive_employers(),
        "disability_report": sql_disability_report(),
        "disability_placements": sql_disability_placements(),
        "inclusive_employer_count": sql_inclusive_employer_count(),
        "disability_posts": sql_disability_posts(),
        "disability_vacancies": sql_disability_vacancies(),
        "vacancy_summary_dedup": sql_vacancy_summary_dedup(),
        "guidance_monthly": sql_guidance_monthly(),
        "registration_panels": sql_registration_panels(),
        "population_labels": sql_population_labels(),
        "disability_report_sent": sql_disability_report_sent(),
        "guided_listing": sql_guided_listing(),
        "text_posts": sql_text_posts(),
        "fixed_rules": sql_fixed_rules(),
        "sheet_folder": "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 <> 2 THEN o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders",
        "malformed_rows": """SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'too_many_cells' WHEN o_orderkey % 17 = 0 THEN 'too_few_cells'
            WHEN o_orderkey % 19 = 0 THEN 'rejected' ELSE 'valid' END AS kind, o_orderkey,
            CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 THEN o_orderpriority || ', "x"' END AS note FROM orders""",
        "published_table": f'WITH {REG_ROWS} SELECT "número_documento", "año", fecha_accion FROM reg_valid WHERE "año" <> {Q.REG_YEAR}',
        "coalesce_joins": """WITH l AS (SELECT c_custkey AS person, CASE WHEN c_nationkey % 3 <> 0 THEN c_mktsegment END AS segment, c_name FROM customer WHERE c_custkey % 5 <> 0),
            r AS (SELECT c_custkey AS person, lower(c_mktsegment) AS segment, c_acctbal AS balance FROM customer WHERE c_custkey % 2 = 0)
            """ + " UNION ALL ".join(f"SELECT '{how}' AS how, {'r' if how == 'right' else 'l'}.person AS person, coalesce(l.segment, r.segment) AS segment, c_name, balance "
                                     f"FROM l {how} JOIN r ON l.person = r.person" for how in ("left", "inner", "right")),
        "quarantine_rows": f"SELECT row_id, '2025-01-31' AS run_date FROM ({sql_quarantine_split()}) WHERE status = 'rejected'",
        "event_value_sums": """SELECT event_type, CAST(coalesce(sum(CAST(value AS DECIMAL(18, 2))), 0) AS DOUBLE) AS total
            FROM events WHERE ts < TIMESTAMP '2024-01-16' AND event_type IS NOT NULL GROUP BY 1
            UNION ALL SELECT 'ALL', CAST(coalesce(sum(CAST(value AS DECIMAL(18, 2))) FILTER (WHERE ts < TIMESTAMP '2024-01-16'), 0)
            AS DOUBLE) FROM events""",
    })
    return out
