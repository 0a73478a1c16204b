"""Queries registered with the driver: each takes (spark, sf_dir) and returns
a DataFrame over the *whole* driver tables. The flows and operators are the
library's own; only the stand-in inputs and rule sets are driver specific."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civic_indicators.driver import standins as S
from civic_indicators.driver.schemas import SCHEMAS, driver_table
from civic_indicators.functions import (
    any_flag, band, concat_present, day_from_text, day_text, digits_or_null, flag, iso_week, iso_year, label_last_match,
    labels_all, latest, matches, month_of, parse_mixed_date, period, round_half_even, to_day,
    to_number, to_ts, to_ts_or_null, unparsed, year_of,
)
from civic_indicators.operators import (
    assign_where, clean_text, column_frequencies, daily_counts, distinct_counts, distinct_values, distinct_with_null,
    drop_empty, empty_to_null, enrich, fill, lower_strings, null_sentinels,
    null_values, outer_merge, per_key, person_key, pivot_counts, preview, profile, project, recode, sort_by,
    sums, union_ids, value_counts, where_equals,
)
from civic_indicators.operators.aggregate import age_predicate
from civic_indicators.operators.cohorts import until
from civic_indicators.operators.clean import missing_any, split_valid
from civic_indicators.operators.integrate import coalesce_join, drop_ids, keep_ids, mark_ids
from civic_indicators.plans import guidance as G
from civic_indicators.plans import incremental as INC
from civic_indicators.plans import placement as PL
from civic_indicators.plans import registration as R
from civic_indicators.session import checkpoint_dir, compiled
from civic_indicators.sources import (
    drop_columns, normalize_headers, publish, published, rename, rename_by_pattern, scan, split_malformed, with_unique_headers,
    write_curated, write_quarantine, write_split,
)

# ------------------------------------------------------------------ rule sets
# Stand-in rules: the driver text has none of the register vocabulary, so the
# flows get patterns over the words the driver rows do contain. The flows'
# defaults stay the fixed values in functions/patterns.py.
REG_RULES = R.RegistrationRules(
    ethnic=(("urgent|high", "Prioritaria"), ("machin", "Maquinaria"), ("build|furni", "Obra"), ("ow", "Baja")),
    disability=(("e", "Letra E"), ("MEDIUM", "Media"), ("[hu]", "HU"), ("auto", "Auto")),
    vca_programme="[05]$", vca_condition="house.old",
    migrant_condition="furn|mach", migrant_document="URG",
    vvg_condition="high|low", reintegrated_condition="auto",
)
REG_COHORTS = {"self_registered_new": ("F", "BUILDING"), "agency_new": ("O", "BUILDING"),
               "agency_updated": ("O", "MACHINERY")}
REG_MONTH, REG_YEAR, AUDIT_CUTOFF = 3, 1996, "1995-02-01"

GUIDE_RULES = G.GuidanceRules(
    ethnic=(("urgent", "Urgente"), ("click", "Click"), ("signup", "Alta")),
    disability=(("e", "Generica"), ("purchase", "Compra"), ("error", "Error"), ("[0-9]-low", "Baja")),
    vca_programme="[27]$", vca_condition="hou.ehold",
    migrant_condition="view", migrant_document="urgent|^r$",
    vvg_condition="high", reintegrated_condition="auto",
)
GUIDE_MONTH, GUIDE_YEAR = 3, 1996

PLACE_RULES = PL.PlacementRules(
    disability=(("o", "Abierto"), ("f", "Final"), ("tipo [0-2]", "Bajo")),
    vca_condition="r. t", vvg_condition="n[fo]", migrant_condition="tipo 3|tipo 4",
    ethnic=(("^a", "A"), ("5", "Cinco")), reintegrated_condition="tipo 6",
    education={"af": "a final", "ro": "r abierto", "nf": "n final"},
)
PLACE_LABELS = ("Final", "Abierto", "Bajo")
PLACE_MONTH, PLACE_MONTH_NAME = 4, "abril"
MONTH_NAMES = ("ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic")

DOC_LABELS = (("the ", "Inglés"), ("ÜBER|sch", "Alemán"), ("ÉT|eau|ç", "Francés"),
              ("ción|ñ", "Español"), ("license", "Licencia"))
DOC_GROUPS = (("tion", "TION"), ("eau", "EAU"), ("ß|ü", "UMLAUT"), ("ñ", "ENYE"), ("[0-9]", "DIGITS"))
TYPE_LABELS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
SEGMENT_RECODE = {"BUILDING": "CONSTRUCCION", "MACHINERY": "MAQUINARIA"}


def _t(spark, root, name):
    return driver_table(spark, root, name)


# ------------------------------------------------------------- flows (inputs)
def registration_valid(spark: SparkSession, root: str) -> DataFrame:
    valid, _ = R.registration(S.register(spark, root), rules=REG_RULES)
    return valid


def guidance_people(spark: SparkSession, root: str) -> DataFrame:
    spark = compiled(spark)
    return G.guidance(S.sessions(spark, root), S.workshops(spark, root), S.register(spark, root),
                      S.counsellor_log(spark, root), workshop_order=S.WORKSHOP_ORDER,
                      registration_order=["No. "], counsellor_order=["FILA"], rules=GUIDE_RULES,
                      columns=(*GUIDE_OUT, "fechaejecucion_taller"))


def placement_rows(spark: SparkSession, root: str) -> DataFrame:
    return PL.placement(S.placement_sheet(compiled(spark), root), rules=PLACE_RULES)


REG_OUT = ("número_documento", "tipo_documento", "año", "fecha_registro", "fecha_actualización",
           "fecha_accion", "condiciones_especiales", "programa_de_gobierno", "canal_de_registro",
           "tipo_registro", "género", "edad", "celular", "grupos_etnicos", "vca", "discapacidad",
           "migrante", "vvg", "reincorporados")


def _joined(df: DataFrame, col: str, sep: str = "|") -> DataFrame:
    return df.withColumn(col, F.array_join(col, sep))


# --------------------------------------------------------------------- queries
def q_indicator_panel(spark, root):
    """One registration cohort, one month -> 11 indicators (long form)."""
    return R.panel(registration_valid(spark, root), "self_registered_new", REG_MONTH, REG_YEAR,
                   cohorts=REG_COHORTS)


def q_monthly_panels(spark, root):
    """The three registration cohorts for every month, long form."""
    return R.monthly(registration_valid(spark, root), cohorts=REG_COHORTS)


def q_incremental_panels(spark, root):
    """The monthly panels by increments: two landed months of files, one of them landed anew, a third later."""
    landing, store = _folder(spark, "landing"), _folder(spark, "panels")
    rows, third = S.register(spark, root), F.col("`No. `") % 3

    def counts(paths):
        valid, _ = R.registration(spark.read.parquet(*paths), rules=REG_RULES)
        return R.monthly(valid, cohorts=REG_COHORTS)

    rows.where(third == 0).write.parquet(f"{landing}/first")
    rows.where(third < 2).write.parquet(f"{landing}/second")
    INC.update(spark, landing, store, counts)
    rows.where(third == 1).write.mode("overwrite").parquet(f"{landing}/second")
    INC.update(spark, landing, store, counts)
    rows.where(third == 2).write.parquet(f"{landing}/third")
    INC.update(spark, landing, store, counts)
    return INC.totals(spark, store)


def q_registration(spark, root):
    """L1: valid registrations with dates and population labels."""
    return _joined(project(registration_valid(spark, root), REG_OUT), "grupos_etnicos")


def q_misdated_audit(spark, root):
    """Rows per action day at or before the cutoff."""
    return R.misdated_audit(registration_valid(spark, root), AUDIT_CUTOFF)


def q_quarantine_split(spark, root):
    """The register's rows, valid or rejected by the flow's own test, in one pass."""
    df, reject = R.prepare(S.register(spark, root), REG_RULES)
    return df.select(F.col("`no._`").alias("row_id"), F.when(reject, F.lit("rejected")).otherwise(F.lit("valid")).alias("status"))


def q_quarantine_rows(spark, root):
    """S7 + D9 + P13: the rejected rows as the quarantine sink holds them after a rerun of the same day."""
    base = checkpoint_dir(spark, fallback=f"/tmp/civic-ckpt-{uuid.uuid4().hex}")
    out = f"{base.rstrip('/')}/quarantine-{uuid.uuid4().hex}"
    _, rejected = R.registration(S.register(spark, root), rules=REG_RULES)
    for _ in range(2):
        write_quarantine(rejected, out, "2025-01-31")
    return spark.read.parquet(out).select(F.col("`no._`").alias("row_id"), F.col("run_date").cast("string").alias("run_date"))


# Register vocabulary, one line per document: condition, programme, document type.
PHRASES = (
    ("afrodescendiente", "Jóvenes", "cc"), ("palenquero", "Jóvenes", "cc"), ("raizal", "Jóvenes", "cc"), ("indígena", "Jóvenes", "cc"),
    ("gitano y mulato", "Jóvenes", "cc"), ("discapacidad cognitiva", "Jóvenes", "cc"), ("discapacidad física", "Jóvenes", "cc"),
    ("limitación visual", "Jóvenes", "cc"), ("limitación auditiva", "Jóvenes", "cc"), ("múltiple", "Jóvenes", "cc"),
    ("sordoceguera", "Jóvenes", "cc"), ("psicosocial", "Jóvenes", "cc"), ("vca", "Jóvenes", "cc"), ("víctima", "Jóvenes", "cc"),
    ("violencia de género", "Jóvenes", "cc"), ("mch", "Jóvenes", "cc"), ("migrante", "Jóvenes", "cc"), ("retornado", "Jóvenes", "cc"),
    ("reincorporado", "Jóvenes", "cc"), ("ninguna", "Jóvenes", "cc"), (None, "Conflicto armado", "cc"),
    ("ninguna", "Jóvenes", "Permiso por protección"), ("ninguna", "Jóvenes", "ppt"),
)


def q_fixed_rules(spark, root):
    """The three flows' fixed rules over whole documents, each with a line of register vocabulary at its end."""
    at = (F.col("doc_id") % len(PHRASES) + 1).cast("int")
    pick = lambda j: F.element_at(F.array(*[F.lit(p[j]) for p in PHRASES]), at)
    d = _t(spark, root, "documents").select("doc_id", F.lower(F.concat_ws(" ", "text", pick(0))).alias("cond"), pick(1).alias("prog"), pick(2).alias("doc"))
    out = d.select("doc_id", *[e.alias(f"{n}_{k}") for n, labels in (
        ("reg", R.population_labels("cond", "prog", "doc")), ("gui", G.population_labels("cond", "prog", "doc")),
        ("pla", PL.population_labels("cond"))) for k, e in labels.items()])
    for c in ("reg_grupos_etnicos", "gui_grupos_etnicos"):
        out = _joined(out, c)
    return out


def _folder(spark, name):
    """A new folder in the cluster's shared folder."""
    base = checkpoint_dir(spark, fallback=f"/tmp/civic-ckpt-{uuid.uuid4().hex}")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_sheet_folder(spark, root):
    """A folder of CSV exports whose columns stand in another order, or are missing, from file to file."""
    out, o = _folder(spark, "sheets"), _t(spark, root, "orders")
    key = F.col("o_orderkey") % 3
    for part, cols in ((0, ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]), (1, ["o_orderpriority", "o_orderstatus", "o_orderkey", "o_custkey"]),
                       (2, ["o_custkey", "o_orderkey", "o_orderpriority"])):
        o.where(key == part).select(*cols).write.mode("append").option("header", True).csv(out)
    df = scan(spark, out, "csv")
    return df.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("o_custkey").cast("long").alias("o_custkey"), "o_orderstatus", "o_orderpriority")


def q_malformed_rows(spark, root):
    """S1 + P13: CSV lines with too many or too few cells, rows without a customer, and the valid rest: every line once."""
    out, o = _folder(spark, "lines"), _t(spark, root, "orders")
    k = F.col("o_orderkey")
    whole = F.concat(k.cast("string"), F.lit(","), F.when(k % 19 == 0, "").otherwise(F.col("o_custkey").cast("string")), F.lit(',"'), F.col("o_orderpriority"), F.lit(', ""x"""'))
    line = F.when(k % 13 == 0, F.concat(whole, F.lit(",extra,"))).when(k % 17 == 0, F.concat(k.cast("string"), F.lit(",7"))).otherwise(whole)
    (o.select(line.alias("key,customer,note")).write.option("header", True).option("sep", "\x01").option("quote", "\x02")
     .option("escape", "\x02").csv(out))
    good, bad = split_malformed(scan(spark, out, "csv", malformed="_malformed", escape='"'), "_malformed")
    valid, rejected = split_valid(good, missing_any("customer"))
    row = lambda df, kind, key, note: df.select(kind.alias("kind"), key.cast("long").alias("o_orderkey"), note.cast("string").alias("note"))
    return (row(valid, F.lit("valid"), F.col("key"), F.col("note")).unionByName(row(rejected, F.lit("rejected"), F.col("key"), F.col("note")))
            .unionByName(row(bad, F.col("reason"), F.regexp_extract("line", "^[0-9]+", 0), F.lit(None))))


def q_published_table(spark, root):
    """The curated table published twice, the second time without a year: only the second version is read."""
    out = _folder(spark, "published")
    rows = registration_valid(spark, root).select("número_documento", "año", "fecha_accion")
    publish(rows, out, ["año"])
    publish(rows.where(F.col("año") != REG_YEAR), out, ["año"])
    return published(spark, out).select("número_documento", F.col("año").cast("int").alias("año"), "fecha_accion")


def q_coalesce_joins(spark, root):
    """Overlapping columns merged (left value unless null) under left, inner and right joins."""
    c = _t(spark, root, "customer")
    left = c.where(F.col("c_custkey") % 5 != 0).select(F.col("c_custkey").alias("person"), F.when(F.col("c_nationkey") % 3 != 0, F.col("c_mktsegment")).alias("segment"), "c_name")
    right = c.where(F.col("c_custkey") % 2 == 0).select(F.col("c_custkey").alias("person"), F.lower("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    out = None
    for how in ("left", "inner", "right"):
        one = coalesce_join(left, right, "person", how).select(F.lit(how).alias("how"), "person", "segment", "c_name", "balance")
        out = one if out is None else out.unionByName(one)
    return out


def q_id_sets(spark, root):
    """U1 + J5: orders of customers in either of two id sets, of the others, and all of them marked."""
    c = _t(spark, root, "customer")
    ids = union_ids(c.filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey")),
                    c.filter(F.col("c_nationkey") < 5).select(F.col("c_custkey").alias("o_custkey")))
    o = _t(spark, root, "orders").select("o_orderkey", "o_custkey")
    part = lambda df, name: df.select(F.lit(name).alias("part"), "o_orderkey")
    marked = mark_ids(o, ids, "o_custkey", "hit")
    return (part(keep_ids(o, ids, "o_custkey"), "kept").unionByName(part(drop_ids(o, ids, "o_custkey"), "dropped"))
            .unionByName(marked.select(F.concat(F.lit("marked_"), F.col("hit").cast("string")).alias("part"), "o_orderkey")))


def q_unparsed_dates(spark, root):
    """D3: cells that hold text but no date, per rendered shape (with the shapes of q_parse_dates and more)."""
    o = _t(spark, root, "orders")
    d, style = F.col("o_orderdate"), F.col("o_orderkey") % 7
    text = (F.when(style == 0, F.date_format(d, "yyyy-MM-dd HH:mm:ss.S")).when(style == 1, F.date_format(d, "d/M/yy"))
             .when(style == 2, F.concat(F.date_format(d, "dd-"), F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(d)), F.date_format(d, "-yyyy")))
             .when(style == 3, F.concat(F.date_format(d, "dd/MM/yyyy"), F.lit(" 10:20:00 PM")))
             .when(style == 4, F.lit("pendiente")).when(style == 5, F.lit(" ")))
    return o.select(style.alias("style"), day_text(parse_mixed_date(text)).alias("day"), unparsed(text).alias("bad")).groupBy("style", "day").agg(
        F.sum(F.col("bad").cast("int")).alias("unparsed"), F.count(F.lit(1)).alias("rows"))


def q_sorted_types(spark, root):
    """T1 + T2: event types by falling frequency, ties by name, with their place in that order."""
    counts = value_counts(_t(spark, root, "events"), "event_type", sort=False)
    ranked = counts.withColumn("place", F.row_number().over(Window.orderBy(F.desc("count"), "event_type")))
    return sort_by(ranked, "place")


def q_person_keys(spark, root):
    """Q18 + P10: person numbers as written in sheets (blank, sentinel, padded) and ages that overflow an int."""
    o = _t(spark, root, "orders")
    k = F.col("o_orderkey") % 5
    number = (F.when(k == 0, F.lit("  ")).when(k == 1, F.lit("nan")).when(k == 2, F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")))
               .otherwise(F.col("o_custkey").cast("string")))
    age = F.when(k == 3, F.lit("3001234567")).otherwise(F.concat((F.col("o_custkey") % 90).cast("string"), F.lit(".5")))
    rows = o.select("o_orderkey", person_key(number).alias("person"), round_half_even(age).alias("age"))
    return rows.groupBy("person").agg(F.count(F.lit(1)).alias("rows"), F.count("age").alias("ages"), F.max("age").alias("oldest"))


def q_text_posts(spark, root):
    """L4 + L7 on a placement sheet landed as text: posts '9' and '10', a junk cell and a junk publication date."""
    sheet = S.placement_sheet(spark, root)
    posts = [c for c in sheet.columns if "puestos" in c.lower()][0]
    pub = [c for c in sheet.columns if "publicacion" in c.lower().replace("ó", "o") and "fecha" in c.lower()][0]
    whole = F.col(f"`{posts}`").cast("double").cast("long").cast("string")
    text = sheet.withColumn(posts, F.when(whole == "13", F.lit("sin dato")).otherwise(whole)).withColumn(
        pub, F.coalesce(F.date_format(F.col(f"`{pub}`"), "dd/MM/yyyy"), F.lit("pronto")))
    rows = PL.placement(text, rules=PLACE_RULES)
    one = PL.vacancy_summary(rows, PLACE_MONTH_NAME, dedupe_key="código_proceso").select(
        F.lit("deduped").alias("what"), F.lit("").alias("name"), F.col("posts").cast("long").alias("posts"))
    per = PL.disability_posts(rows, PLACE_MONTH_NAME).select(F.lit("employer").alias("what"), F.col(PL.EMPLOYER).alias("name"), F.col("posts").cast("long").alias("posts"))
    return one.unionByName(per)


def q_sink_roundtrip(spark, root):
    """S6 + S7: valid/rejected written once (partitioned by status) and the
    curated rows partitioned by year, then read back and counted per part."""
    base = checkpoint_dir(spark, fallback=f"/tmp/civic-ckpt-{uuid.uuid4().hex}")
    out = f"{base.rstrip('/')}/sinks-{uuid.uuid4().hex}"
    df, reject = R.prepare(S.register(spark, root), REG_RULES)
    write_split(df, reject, f"{out}/split", run_date="2025-01-31")
    valid, _ = R.registration(S.register(spark, root), rules=REG_RULES)
    write_curated(valid.select("número_documento", "año", "fecha_accion"), f"{out}/curated", ["año"])
    split = spark.read.parquet(f"{out}/split").groupBy(
        F.lit("split").alias("dataset"), F.col("_status").alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    cur = spark.read.parquet(f"{out}/curated").groupBy(
        F.lit("curated").alias("dataset"), F.col("año").cast("string").alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    return split.unionByName(cur)


def q_scan_headers(spark, root):
    """A sheet with spaced, accented, repeated headers is scanned,
    de-duplicated, normalised, renamed and pruned."""
    c = scan(spark, f"{root.rstrip('/')}/customer.parquet", schema=SCHEMAS["customer"])
    sheet = c.select(F.col("c_custkey").alias("Número Cliente"), F.col("c_name").alias("Nombre Cliente"),
                     F.col("c_nationkey").alias("Región ID"), F.col("c_mktsegment").alias("Segmento"),
                     F.col("c_mktsegment").alias("Segmento"))
    df = normalize_headers(with_unique_headers(sheet))
    df = rename(df, {"nombre_cliente": "cliente"})
    df = rename_by_pattern(df, ".1", "_copia")
    return drop_columns(df, ["región_id"])


def q_clean_text(spark, root):
    """P2 + P3: conversation text trimmed (all Unicode spaces) and lower-cased."""
    df = lower_strings(_t(spark, root, "conversations"))
    return clean_text(df, ["text"], lower=True)


def q_null_sentinels(spark, root):
    """P1 + P4 + P7: 'nan' cells, listed words and '' become null."""
    o = _t(spark, root, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit("nan")).otherwise(F.col("o_orderstatus")).alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias("note"))
    o = null_sentinels(o)
    o = null_values(o, "priority", ["4-NOT SPECIFIED", "5-LOW"])
    return empty_to_null(o, ["note"])


def q_recode_fill(spark, root):
    """P5 + P6: dictionary recode, then fill of the values nulled."""
    c = _t(spark, root, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    c = recode(c, "segment", SEGMENT_RECODE)
    c = null_values(c, "segment", ["HOUSEHOLD"])
    return fill(c, {"segment": "SIN SEGMENTO"})


def q_coerce_numbers(spark, root):
    """Digits-only parse, numeric coercion and half-even rounding."""
    p = _t(spark, root, "part")
    return p.select(
        "p_partkey",
        digits_or_null(F.substring_index("p_brand", "#", -1)).alias("brand_no"),
        digits_or_null(F.when(F.col("p_size") > 40, F.lit(None).cast("string"))
                       .otherwise(F.col("p_size").cast("string"))).alias("size_or_zero"),
        round_half_even(F.col("p_size") / 2).alias("half_size"),
        round_half_even(F.concat(F.col("p_size").cast("string"), F.lit(".5"))).alias("size_up"),
        to_number(F.col("p_type")).alias("type_number"),
    )


def q_age_bands(spark, root):
    """Age bands of 2*size-2 (0 and out-of-range values -> null)."""
    p = _t(spark, root, "part").select(band(F.col("p_size") * 2 - 2).alias("rango_de_edad"))
    return p.groupBy("rango_de_edad").agg(F.count(F.lit(1)).alias("count"))


def q_drop_empty_rows(spark, root):
    """Rows empty on all key columns are dropped."""
    o = _t(spark, root, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    return drop_empty(o, ["status", "priority"])


def q_cohort_filter(spark, root):
    """Channel, month, age range and date cut-off."""
    o = _t(spark, root, "orders").withColumn("age", (F.floor("o_totalprice").cast("long") % 90))
    o = where_equals(o, {"o_orderstatus": "F"})
    o = o.filter(period("o_orderdate", 1996, 3) & age_predicate("age", 29, 60)
                 & until("o_orderdate", "1998-01-01"))
    return project(o, ["o_orderkey", "o_custkey", "age"])


def q_masked_assign_concat(spark, root):
    """P17 + P18: masked label assignment (later masks win) and null-aware concat."""
    o = _t(spark, root, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    o = assign_where(o, "label", F.col("o_orderpriority") == "1-URGENT", "urgente")
    o = assign_where(o, "label", F.col("o_orderstatus") == "F", "final")
    both = concat_present(F.nullif("o_orderstatus", F.lit("P")), F.nullif("o_orderpriority", F.lit("5-LOW")))
    return o.select("o_orderkey", "label", both.alias("joined"))


def q_parse_dates(spark, root):
    """Dates rendered as sheet text in six shapes, parsed back."""
    o = _t(spark, root, "orders")
    d = F.col("o_orderdate")
    style = F.col("o_orderkey") % 6
    serial = F.datediff(F.to_date(d), F.lit("1899-12-30").cast("date")).cast("string")
    text = (F.when(style == 0, serial)
             .when(style == 1, F.date_format(d, "d-M-yyyy"))
             .when(style == 2, F.concat(F.date_format(d, "dd/MM/yyyy"), F.lit(" 10:20")))
             .when(style == 3, F.date_format(d, "yyyy-MM-dd"))
             .when((style == 4) & (F.dayofmonth(d) > 12), F.date_format(d, "MM/dd/yyyy"))
             .when(style == 4, F.date_format(d, "dd.MM.yyyy"))
             .otherwise(F.lit(" sin dato ")))
    lenient = F.when(style == 5, F.lit("pendiente")).otherwise(F.date_format(d, "yyyy-MM-dd"))
    return o.select("o_orderkey",
                    day_text(parse_mixed_date(text)).alias("mixed"),
                    day_text(to_ts_or_null(lenient)).alias("lenient"),
                    day_text(to_ts(F.date_format(d, "yyyy-MM-dd HH:mm:ss"))).alias("strict"))


def q_date_parts(spark, root):
    """Latest of two dates, day text, month, year, ISO week/year."""
    li = _t(spark, root, "lineitem")
    other = F.when(F.col("l_linenumber") % 2 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
        F.timestamp_add("DAY", (F.col("l_quantity") - 25).cast("int"), F.col("l_shipdate")))
    last = to_day(latest("l_shipdate", other))
    s = F.col("l_shipdate")
    return li.select("l_orderkey", "l_linenumber",
                     day_text(last).alias("latest_day"),
                     (day_from_text(day_text(last)) == last).alias("text_roundtrip"),
                     month_of(s).alias("month"), year_of(s).alias("year"),
                     iso_week(s).alias("iso_week"), iso_year(s).alias("iso_year"))


def q_label_last_match(spark, root):
    """Last matching label over whole documents (case-insensitive, Unicode)."""
    d = _t(spark, root, "documents")
    return d.select("doc_id", label_last_match("text", DOC_LABELS).alias("label"))


def q_pattern_flags(spark, root):
    """One- and two-column pattern flags on conversation turns."""
    c = _t(spark, root, "conversations")
    return c.select("conv_id", "turn",
                    flag("fr", matches("text", "eau|ç")).alias("fr"),
                    flag("de", matches("text", "ß"), matches("role", "system")).alias("de"),
                    flag("wild", matches("text", "v.e")).alias("wild"),
                    flag("upper", matches("text", "ÜBER|ÉT", ignore_case=True)).alias("upper"))


def q_label_array(spark, root):
    """Every matching group per document, in rule order ('|'-joined)."""
    d = _t(spark, root, "documents")
    return d.select("doc_id", F.array_join(labels_all("text", DOC_GROUPS), "|").alias("groups"))


def q_any_flag(spark, root):
    """C4: any of three label columns present."""
    c = _t(spark, root, "conversations").select(
        "conv_id", "turn",
        flag("fr", matches("text", "eau|ç")).alias("fr"),
        flag("es", matches("text", "ñ")).alias("es"),
        flag("sys", matches("role", "system")).alias("sys"))
    return c.select("conv_id", "turn", any_flag("fr", "es", "sys").alias("any_flag"))


LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def q_first_per_key(spark, root):
    """A1: first non-null value of eight columns per supplier, in row order."""
    li = _t(spark, root, "lineitem").select(
        *LINE_ORDER, "l_suppkey",
        F.nullif("l_returnflag", F.lit("N")).alias("flag"),
        F.nullif("l_linestatus", F.lit("O")).alias("status"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("double")).otherwise(F.col("l_discount")).alias("discount"),
        F.when(F.col("l_tax") == 0, F.lit(None).cast("double")).otherwise(F.col("l_tax")).alias("tax"),
        F.when(F.col("l_quantity") < 10, F.lit(None).cast("long")).otherwise(F.col("l_partkey")).alias("part"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship"))
    cols = ["flag", "status", "discount", "tax", "part", "ship", "l_quantity", "l_linenumber"]
    return per_key(li, "l_suppkey", LINE_ORDER, first=cols)


def q_distinct_concat(spark, root):
    """A2: per customer, distinct priorities and statuses in first-seen order."""
    o = _t(spark, root, "orders").select(
        "o_orderkey", "o_custkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priorities"),
        F.when(F.col("o_custkey") % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_orderstatus")).alias("statuses"))
    return per_key(o, "o_custkey", "o_orderkey", concat=["priorities", "statuses"])


def q_outer_merge(spark, root):
    """J1 + J2: orders per customer full-outer-merged with parts' first line values."""
    left = _t(spark, root, "orders").select(
        F.col("o_custkey").alias("person"), "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.col("o_orderpriority").alias("priority"))
    li = _t(spark, root, "lineitem").select(*LINE_ORDER, F.col("l_partkey").alias("person"),
                                            F.col("l_linestatus").alias("status"),
                                            F.col("l_returnflag").alias("priority"),
                                            F.col("l_quantity").alias("quantity"))
    right = per_key(li, "person", LINE_ORDER, first=["status", "priority", "quantity"])
    return outer_merge(left, right, "person")


def q_enrich_left(spark, root):
    """J3 + J4: orders enriched with customer and nation columns (left joins)."""
    o = _t(spark, root, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    c = _t(spark, root, "customer")
    n = _t(spark, root, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    out = enrich(o, c, "c_custkey", ["c_mktsegment", "c_nationkey"])
    out = enrich(out, n, "c_nationkey", ["n_name"])
    return out.select("o_orderkey", "c_mktsegment", "n_name")


def q_distinct_with_null(spark, root):
    """Distinct employers / processes / vacancies per registration month, null counted once."""
    rows = placement_rows(spark, root)
    return rows.groupBy("mes_registro").agg(
        distinct_with_null("nombre_de_la_empresa").alias("employers"),
        distinct_with_null("código_proceso").alias("processes"),
        distinct_with_null("nombre_de_la_vacante").alias("vacancies"))


def q_distinct_counts(spark, root):
    """Distinct parts, suppliers (null on over a third of the rows) and ship days per return flag, and the
    sum of line numbers, in one pass."""
    li = _t(spark, root, "lineitem").selectExpr("l_returnflag", "l_partkey", "CASE WHEN l_linenumber > 2 THEN l_suppkey END AS supplier",
                                                "l_shipdate", "l_linenumber")
    return distinct_counts(li, {"parts": "l_partkey", "suppliers": "supplier", "days": "l_shipdate"}, by=["l_returnflag"],
                           sums={"lines": "l_linenumber"})


def q_distinct_values(spark, root):
    """Distinct vacancy names of CVs sent in the month."""
    return distinct_values(placement_rows(spark, root), "nombre_de_la_vacante", PL.sent(PLACE_MONTH))


def q_sums(spark, root):
    """A9 + A10: posts per employer for the month, plus the month total."""
    rows = placement_rows(spark, root)
    coh = F.col("mes_registro") == PLACE_MONTH_NAME
    out = sums(rows, "nombre_de_la_empresa", "puestos_de_trabajo_en_plataforma", coh, "posts", "TOTAL")
    return out.withColumn("posts", F.col("posts").cast("long"))


def q_event_value_sums(spark, root):
    """A9 + A10 on events: value per event type for the first half of the month,
    plus the overall filtered total (A9), summed exactly as decimals."""
    e = _t(spark, root, "events").select("event_type", "ts", F.col("value").cast("decimal(18,2)").alias("value"))
    first_half = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    return sums(e, "event_type", "value", first_half, "total", "ALL").withColumn("total", F.col("total").cast("double"))


def q_value_counts(spark, root):
    """A11 + T2: event types by frequency."""
    return value_counts(_t(spark, root, "events"), "event_type")


def q_column_frequencies(spark, root):
    """Value frequencies of every order column in one job (the time stamp as its day)."""
    return column_frequencies(_t(spark, root, "orders").withColumn("o_orderdate", day_text("o_orderdate")))


def q_pivot_counts(spark, root):
    """(age band, brand) x part type counts with the given label list."""
    p = _t(spark, root, "part").select(band(F.col("p_size") * 2 - 2).alias("rango_de_edad"),
                                       "p_brand", "p_type")
    return pivot_counts(p, ["rango_de_edad", "p_brand"], "p_type", TYPE_LABELS)


def q_daily_counts(spark, root):
    """A14 + T1: events per day up to a cutoff, in date order."""
    return daily_counts(_t(spark, root, "events"), "day", "2024-01-20", ts="ts")


def q_table_profile(spark, root):
    """Rows, type and non-null count of every customer column."""
    c = _t(spark, root, "customer")
    c = c.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("HOUSEHOLD")))
    return profile(c)


def q_preview(spark, root):
    """First five orders by key."""
    o = _t(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return preview(o, "o_orderkey", 5)


GUIDE_OUT = ("numerodocumento", "orientador", "tallerista", "mes_orientado", "año_orientado",
             "mes_taller", "año_taller", "sexo", "tipodocumento", "ciudad", "programagobierno",
             "orden", "programa_de_gobierno", "condiciones_especiales", "edad", "rango_de_edad",
             "grupos_etnicos", "vca", "discapacidad", "migrante", "vvg", "reincorporados")


def q_guidance(spark, root):
    """L2: sessions + workshops + registrations + counsellor log per person."""
    people = guidance_people(spark, root)
    return _joined(project(people, GUIDE_OUT), "grupos_etnicos")


def q_guidance_panels(spark, root):
    """A6 for guidance: guided and workshop cohorts of one month, one pass."""
    return G.month_panels(guidance_people(spark, root), GUIDE_MONTH, GUIDE_YEAR)


def q_guided_listing(spark, root):
    """P15 (i) + P19: people guided in the month by a named counsellor who carry a
    disability label, listed by person and counsellor."""
    from civic_indicators.operators.cohorts import cohort, present
    people = guidance_people(spark, root)
    f = cohort("with_counsellor", "mes_orientado", GUIDE_MONTH, "año_orientado", GUIDE_YEAR, "orientador")
    return project(people.filter(f & present("discapacidad")),
                   ["numerodocumento", "orientador", "discapacidad"])


PLACE_OUT = ("mes_registro", "gestión_vacante_", "código_proceso", "nombre_de_la_empresa",
             "puestos_de_trabajo_en_plataforma", "fecha_envío_hojas_de_vida_a_la_empresa", "sexo",
             "edad", "rango_de_edad", "condicion", "convenio", "nivel_educativo", "colocado",
             "semana_publicacion_vacante", "mes_publicacion_vacante", "año_publicacion_vacante",
             "discapacidad", "vca", "vvg", "migrante", "etnias", "reincorporados")


def q_placement(spark, root):
    """L3: cleaned and labelled placement rows."""
    rows = project(placement_rows(spark, root), PLACE_OUT)
    return rows.withColumn("fecha_envío_hojas_de_vida_a_la_empresa",
                           day_text("fecha_envío_hojas_de_vida_a_la_empresa"))


def q_vacancy_summary(spark, root):
    """L4: employers, processes and posts registered in the month."""
    return PL.vacancy_summary(placement_rows(spark, root), PLACE_MONTH_NAME)


def q_placement_panels(spark, root):
    """L5 for placement: sent and placed panels of the month (one pass)."""
    return PL.monthly_report(placement_rows(spark, root), PLACE_MONTH, PLACE_MONTH_NAME)


def q_inclusive_employers(spark, root):
    """Employers that placed people of a population group in the month."""
    return PL.inclusive_employers(placement_rows(spark, root), PLACE_MONTH_NAME)


def q_disability_report(spark, root):
    """(age band, sex) x disability for placed people of the month."""
    return PL.disability_pivot(placement_rows(spark, root), PL.placed_in(PLACE_MONTH_NAME), PLACE_RULES)


def q_disability_report_sent(spark, root):
    """(age band, sex) x disability for CVs sent in the month (any year)."""
    return PL.disability_pivot(placement_rows(spark, root), PL.sent(PLACE_MONTH), PLACE_RULES)


def q_disability_placements(spark, root):
    """Placed people with a disability label per employer."""
    return PL.disability_placements(placement_rows(spark, root), PLACE_MONTH_NAME)


def q_inclusive_employer_count(spark, root):
    """Number of such employers (a missing name counts once)."""
    return PL.inclusive_employer_count(placement_rows(spark, root), PLACE_MONTH_NAME)


def q_disability_posts(spark, root):
    """Posts per employer for vacancies of the month held by people with a disability label."""
    return PL.disability_posts(placement_rows(spark, root), PLACE_MONTH_NAME)


def q_disability_vacancies(spark, root):
    """Placed people with a disability label per vacancy name."""
    return PL.disability_placements(placement_rows(spark, root), PLACE_MONTH_NAME, PL.VACANCY)


def q_vacancy_summary_dedup(spark, root):
    """L4 with Q11's option: each vacancy process's posts counted once."""
    return PL.vacancy_summary(placement_rows(spark, root), PLACE_MONTH_NAME, dedupe_key="código_proceso")


def q_guidance_monthly(spark, root):
    """L5 for guidance: guided and workshop cohorts per month of their own dates."""
    return G.monthly(guidance_people(spark, root))


def q_registration_panels(spark, root):
    """A6 for the three registration cohorts of one month, one pass."""
    from civic_indicators.operators import panels
    valid = registration_valid(spark, root)
    preds = {n: R.cohort(n, REG_MONTH, REG_YEAR, REG_COHORTS) for n in REG_COHORTS}
    return panels(valid, preds, R.PANEL)


def q_population_labels(spark, root):
    """C1-C4 with the flows' own fixed rules over whole documents: the lower-cased
    text is the condition, the source the programme and the language the document type."""
    d = _t(spark, root, "documents").select("doc_id", F.lower("text").alias("cond"), "source", "lang")
    reg = R.population_labels("cond", "source", "lang")
    gui = G.population_labels("cond", "source", "lang")
    pla = PL.population_labels("cond")
    out = d.select("doc_id",
                   *[e.alias(f"reg_{k}") for k, e in reg.items()],
                   *[e.alias(f"gui_{k}") for k, e in gui.items()],
                   *[e.alias(f"pla_{k}") for k, e in pla.items()])
    out = out.withColumn("any_population", any_flag("pla_etnias", "pla_migrante", "pla_vca", "pla_discapacidad"))
    for c in ("reg_grupos_etnicos", "gui_grupos_etnicos"):
        out = _joined(out, c)
    return out


QUERIES = {
    "indicator_panel": q_indicator_panel,
    "monthly_panels": q_monthly_panels,
    "incremental_panels": q_incremental_panels,
    "registration": q_registration,
    "misdated_audit": q_misdated_audit,
    "quarantine_split": q_quarantine_split,
    "sink_roundtrip": q_sink_roundtrip,
    "scan_headers": q_scan_headers,
    "sheet_folder": q_sheet_folder,
    "malformed_rows": q_malformed_rows,
    "published_table": q_published_table,
    "coalesce_joins": q_coalesce_joins,
    "clean_text": q_clean_text,
    "null_sentinels": q_null_sentinels,
    "recode_fill": q_recode_fill,
    "coerce_numbers": q_coerce_numbers,
    "age_bands": q_age_bands,
    "drop_empty_rows": q_drop_empty_rows,
    "cohort_filter": q_cohort_filter,
    "masked_assign_concat": q_masked_assign_concat,
    "parse_dates": q_parse_dates,
    "date_parts": q_date_parts,
    "label_last_match": q_label_last_match,
    "pattern_flags": q_pattern_flags,
    "label_array": q_label_array,
    "any_flag": q_any_flag,
    "first_per_key": q_first_per_key,
    "distinct_concat": q_distinct_concat,
    "outer_merge": q_outer_merge,
    "enrich_left": q_enrich_left,
    "distinct_with_null": q_distinct_with_null,
    "distinct_counts": q_distinct_counts,
    "distinct_values": q_distinct_values,
    "sums": q_sums,
    "value_counts": q_value_counts,
    "column_frequencies": q_column_frequencies,
    "pivot_counts": q_pivot_counts,
    "daily_counts": q_daily_counts,
    "table_profile": q_table_profile,
    "preview": q_preview,
    "guidance": q_guidance,
    "guidance_panels": q_guidance_panels,
    "placement": q_placement,
    "vacancy_summary": q_vacancy_summary,
    "placement_panels": q_placement_panels,
    "inclusive_employers": q_inclusive_employers,
    "disability_report": q_disability_report,
    "disability_placements": q_disability_placements,
    "inclusive_employer_count": q_inclusive_employer_count,
    "disability_posts": q_disability_posts,
    "disability_vacancies": q_disability_vacancies,
    "vacancy_summary_dedup": q_vacancy_summary_dedup,
    "guidance_monthly": q_guidance_monthly,
    "registration_panels": q_registration_panels,
    "population_labels": q_population_labels,
    "disability_report_sent": q_disability_report_sent,
    "event_value_sums": q_event_value_sums,
    "guided_listing": q_guided_listing,
    "id_sets": q_id_sets,
    "unparsed_dates": q_unparsed_dates,
    "sorted_types": q_sorted_types,
    "person_keys": q_person_keys,
    "text_posts": q_text_posts,
    "fixed_rules": q_fixed_rules,
    "quarantine_rows": q_quarantine_rows,
}
