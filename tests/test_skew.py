"""A key holding a third of all rows: the merge's join is split by adaptive
execution (a full outer join could not be), and the results stay whole."""

from pyspark.sql import functions as F

from civic_indicators.operators import enrich, outer_merge, per_key

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


def _with_conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_key_join_is_split_and_whole(spark):
    old = _with_conf(spark, SKEW_CONF)
    try:
        n = 30_000
        sessions = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("k"),
            F.col("id").alias("session"))
        workshops = spark.range(n).select((F.col("id") % 700).cast("string").alias("k"),
                                          F.col("id").alias("o"), (F.col("id") % 5).cast("string").alias("v"))
        workshops = workshops.unionByName(spark.range(50).select(F.lit("hot").alias("k"), F.col("id").alias("o"),
                                                                  F.lit("x").alias("v")))
        per_person = per_key(workshops, "k", "o", first=["v"])
        merged = outer_merge(sessions, per_person, "k", hot_keys=True)
        merged_rows = merged.collect()          # runs this Dataset's own adaptive plan
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan, plan[:plan.find("Initial Plan")]
        # whole results: every session once, plus the workshop-only people (keys 500..699)
        assert "isFinalPlan=true" in plan
        assert len(merged_rows) == n + 200
        hot = [r for r in merged_rows if r["k"] == "hot"]
        assert len(hot) == n // 3 and all(r["v"] == "x" for r in hot)
        enriched = enrich(sessions, per_person, "k", ["v"])
        assert len(enriched.collect()) == n
        assert "skew=true" in enriched._jdf.queryExecution().executedPlan().toString()
        from civic_indicators.operators import mark_ids
        marked = mark_ids(sessions, workshops.select("k"), "k")
        got = marked.collect()
        assert "skew=true" in marked._jdf.queryExecution().executedPlan().toString()
        assert len(got) == n and sum(r["in_ids"] for r in got) == sum(1 for r in got if r["k"] in
                                                                         {"hot"} | {str(i) for i in range(700)})
    finally:
        _restore(spark, old)
