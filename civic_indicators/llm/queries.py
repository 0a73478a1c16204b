"""The registered queries of this subpackage: each operator, with production
parameters, over its whole table; and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_indicators.llm.align import alignment
from civic_indicators.llm.decontaminate import contaminated
from civic_indicators.llm.exact_dedup import exact_groups
from civic_indicators.llm.fingerprint import edit_likeness
from civic_indicators.llm.html_text import extract
from civic_indicators.llm.langid import identify
from civic_indicators.llm.lm_score import score
from civic_indicators.llm.mixing import MixParams, mix
from civic_indicators.llm.near_dedup import NearDedup, near_groups
from civic_indicators.llm.pii import pseudonymise
from civic_indicators.llm.quality import quality
from civic_indicators.llm.toxicity import toxicity
from civic_indicators.llm.variants import spelling_variants, variants_sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The mixture that is asked for: domains by source, languages within, sources within these.
MIXTURE = MixParams(
    levels=("CASE WHEN source IN ('src0', 'src1', 'src2', 'src3', 'src4') THEN 'web' "
            "WHEN source IN ('src5', 'src6', 'src7', 'src8', 'src9', 'src10', 'src11') THEN 'reference' ELSE 'other' END",
            "lang", "source"),
    weights={("web",): 5, ("reference",): 3, ("other",): 2,
             ("web", "en"): 4, ("web", "de"): 2, ("reference", "en"): 3, ("other", "es"): 2, ("other", "en"): 0,
             ("web", "en", "src0"): 3},
    share=(1, 2), max_epochs=4, seed="mix-1")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), NearDedup(k=4, pct=80))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), MIXTURE).selectExpr(
        "doc_id", "mix_level_0 AS domain", "mix_level_1 AS lang", "mix_level_2 AS source", "mix_tokens AS n_tokens", "mix_epoch AS epoch")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_found", F.array_join("kinds", ",").alias("kinds"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"))


def op13_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_likeness(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_near_dedup, op2_mixing, op3_quality, op4_langid, op5_exact_dedup,
                                   op6_pii, op7_decontamination, op8_html_text, op9_lm_score, op10_toxicity,
                                   op11_spelling_variants, op12_token_alignment, op13_order_minhash, pipeline)}

def mix_sql(p: MixParams) -> str:
    """``mix`` in DuckDB SQL: the shares level by level, then each leaf's prefix by a running sum."""
    cols = [f"l{i}" for i in range(len(p.levels))]
    share = f"{p.budget}" if p.budget is not None else f"(SELECT sum(t) FROM leaves) * {p.share[0]} / {p.share[1]}.0"
    out = [f"""d AS (SELECT doc_id, {', '.join(f"coalesce(CAST({e} AS VARCHAR), '(none)') AS {c}" for e, c in zip(p.levels, cols))},
            len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n, coalesce(CAST(doc_id AS VARCHAR), 'null') AS id, md5(coalesce(text, '')) AS x FROM documents)""",
           f"leaves AS (SELECT {', '.join(cols)}, CAST(sum(n) AS BIGINT) AS t FROM d GROUP BY {', '.join(cols)})"]
    for i in range(len(cols)):
        own, up = cols[:i + 1], cols[:i]
        named = " ".join(f"WHEN {' AND '.join(f"{c} = '{v}'" for c, v in zip(own, k))} THEN {w}" for k, w in p.weights.items() if len(k) == len(own))
        weight = f"CASE {named} ELSE {p.default_weight} END" if named else str(p.default_weight)
        part = f"PARTITION BY {', '.join(up)}" if up else ""
        offer = f"(SELECT give FROM g{i - 1} WHERE {' AND '.join(f'g{i - 1}.{c} = n{i}.{c}' for c in up)})" if up else share
        out.append(f"n{i} AS (SELECT * FROM (SELECT {', '.join(own)}, CAST(sum(t) * {p.max_epochs} AS BIGINT) AS cap, {weight} AS w FROM leaves GROUP BY {', '.join(own)}) WHERE w > 0)")
        out.append(f"o{i} AS (SELECT *, CAST({offer} AS DOUBLE) AS offer FROM n{i})")
        out.append(f"""s{i} AS (SELECT *, (offer - (sum(cap) OVER o - cap)) / (sum(w) OVER q - sum(w) OVER o + w) AS lam FROM o{i} WHERE offer IS NOT NULL
            WINDOW o AS ({part} ORDER BY CAST(cap AS DOUBLE) / w, {', '.join(own)}), q AS ({part}))""")
        out.append(f"g{i} AS (SELECT {', '.join(own)}, least(CAST(cap AS DOUBLE), max(lam) OVER ({part}) * w) AS give FROM s{i})")
    last = f"g{len(cols) - 1}"
    on = " AND ".join(f"x.{c} = y.{c}" for c in cols)
    out.append(f"plan AS (SELECT {', '.join(f'x.{c}' for c in cols)}, CAST(floor(floor(give) / t) AS BIGINT) AS f, CAST(floor(give) AS BIGINT) - CAST(floor(floor(give) / t) AS BIGINT) * t AS rest "
               f"FROM leaves x JOIN {last} y ON {on} WHERE t > 0)")
    out.append(f"run AS (SELECT x.*, f, rest, sum(n) OVER (PARTITION BY {', '.join(f'x.{c}' for c in cols)} ORDER BY md5('{p.seed}|' || f || '|' || id), x ROWS UNBOUNDED PRECEDING) AS upto FROM d x JOIN plan y ON {on})")
    return (f"WITH {', '.join(out)} SELECT doc_id, l0 AS domain, l1 AS lang, l2 AS source, CAST(n AS BIGINT) AS n_tokens, epoch FROM ("
            f"SELECT *, unnest(range(0, f + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)) AS epoch FROM run)")


ORACLE = {
    "op2_mixing": mix_sql(MIXTURE),
    "op11_spelling_variants": variants_sql(),
    "op5_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                   'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
             g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)""",
}
