"""Incremental registration over a landing folder."""

from civic_indicators.plans import registration as R
from civic_indicators.streaming.landing import curated_rows, registration_stream
from tests.test_flows import REG_ROWS, register


def test_landing_folder_is_processed_incrementally(spark, tmp_path):
    landing, out, ckpt = str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    first = register(spark)
    first.limit(3).write.mode("append").parquet(landing)
    schema = first.schema
    q = registration_stream(spark, landing, schema, out, ckpt)
    q.awaitTermination()
    assert curated_rows(spark, out).count() == 2          # rows 1, 2 valid; row 3 rejected
    # a second file lands; only it is processed on the next run
    spark.createDataFrame(REG_ROWS[3:], schema).write.mode("append").parquet(landing)
    q = registration_stream(spark, landing, schema, out, ckpt)
    q.awaitTermination()
    cur = curated_rows(spark, out)
    assert cur.count() == 4
    assert spark.read.parquet(f"{out}/quarantine").count() == 2
    panel = dict(R.panel(cur, "self_registered_new", 3, 2025).collect())
    assert panel["men"] == 1 and panel["women"] == 1


def test_replayed_batch_replaces_its_own_output(spark, tmp_path):
    from civic_indicators.streaming.landing import _write_batch
    out = str(tmp_path / "out")
    batch = register(spark)
    _write_batch(batch, 7, out, R.RegistrationRules(), None)
    _write_batch(batch, 7, out, R.RegistrationRules(), None)      # the same batch again after a failure
    _write_batch(batch.limit(1), 8, out, R.RegistrationRules(), None)
    cur = curated_rows(spark, out)
    assert cur.filter("_batch = 7").count() == 4 and cur.filter("_batch = 8").count() == 1
