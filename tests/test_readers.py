"""Scans, row order and cluster sizing."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from civic_indicators import cluster_conf
from civic_indicators.driver.queries import QUERIES
from civic_indicators.session import input_bytes
from civic_indicators.sources import scan

SF = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_filters_reach_the_scan_at_any_size(spark):
    plan = QUERIES["cohort_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_orderdate), EqualTo(o_orderstatus,F)" in plan
    assert "Exchange" not in plan
    plan = QUERIES["daily_counts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts," in plan


def test_row_order_of_a_folder_of_parts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\nx,0\n", encoding="utf-8")        # small, but first
    (tmp_path / "b.csv").write_text("k,v\n" + "".join(f"x,{i}\n" for i in range(1, 3000)), encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")            # several splits a file
    try:
        df = scan(spark, str(tmp_path), "csv", row_order="_fila")
        assert df.rdd.getNumPartitions() > 2
        assert [int(r.v) for r in df.orderBy("_fila").collect()] == list(range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_input_bytes(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x" * 100, encoding="utf-8")
    assert input_bytes(spark, str(tmp_path)) == 100


def test_cluster_conf_sizes_from_input():
    big = cluster_conf(100 * 2**40, executor_cores=8)
    assert int(big["spark.sql.shuffle.partitions"]) == 409_600            # 100 TB / 256 MB, no cap
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 << 20
    mid = cluster_conf(64 * 2**30, executor_cores=8)
    assert int(mid["spark.sql.shuffle.partitions"]) == 256                # 64 GB / 256 MB
    small = cluster_conf(10 << 20, executor_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16               # at least 2 per core


def test_conform_types_declared_columns_and_names_missing_ones(spark):
    from civic_indicators.sources.sheets import conform
    df = spark.createDataFrame([("2025", "x", "1"), ("dos mil", "y", "2")], "`Año` string, `Gestión Vacante` string, extra string")
    out = conform(df, {"año": "int", "gestión_vacante_": "string"})
    assert [tuple(r) for r in out.collect()] == [(2025, "x", "1"), (None, "y", "2")]
    with pytest.raises(ValueError, match="edad"):
        conform(df, {"edad": "int"})


def test_columns_follow_each_files_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("y,x\n20,10\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text('"y","z, ""q""",y\n200,7,300\n', encoding="utf-8")
    (tmp_path / "d.csv").write_text("", encoding="utf-8")
    with gzip.open(tmp_path / "e.csv.gz", "wt", encoding="utf-8") as f:
        f.write("y,x\n21,11\n")
    df = scan(spark, str(tmp_path), "csv", row_order="_fila", escape='"')
    assert df.columns == ["x", "y", 'z, "q"', "y.1", "_fila"]
    got = [tuple(r)[:4] for r in df.orderBy("_fila").collect()]
    assert got == [("1", "2", None, None), ("10", "20", None, None), (None, "200", "7", "300"), ("11", "21", None, None)]
    typed = scan(spark, str(tmp_path), "csv", schema="y int, x int, w string")
    assert sorted(map(tuple, typed.collect()), key=str) == sorted([(2, 1, None), (20, 10, None), (200, None, None), (21, 11, None)], key=str)


def test_one_header_keeps_the_plain_scan(spark, tmp_path):
    for n in "ab":
        (tmp_path / f"{n}.csv").write_text("x,y\n1,2\n", encoding="utf-8")
    plan = scan(spark, str(tmp_path), "csv").select("x")._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and plan.count("Scan csv") == 1
    assert "Location: InMemoryFileIndex(1 paths)" in plan
    assert scan(spark, str(tmp_path), "csv").count() == 2


def test_headers_with_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"x\n1",y\n1,2\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text('y,"x\n1"\n2,1\n', encoding="utf-8")
    df = scan(spark, str(tmp_path), "csv", multiLine="true")
    assert df.columns == ["x\n1", "y"] and [tuple(r) for r in df.collect()] == [("1", "2")] * 2


def test_malformed_records_go_to_the_quarantine(spark, tmp_path):
    from civic_indicators.sources import split_malformed
    (tmp_path / "a.csv").write_text('k,v\n1,a\n2\n3,"b,c"\n4,d,e\n5,\n6,"x,y",z\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("v,k,w\na,7,w\nb,8\n", encoding="utf-8")
    df = scan(spark, str(tmp_path), "csv", malformed="_bad", row_order="_fila")
    good, bad = split_malformed(df, "_bad")
    assert sorted((r.k, r.v, r.w) for r in good.fillna("-").collect()) == [("1", "a", "-"), ("3", "b,c", "-"), ("5", "-", "-"), ("7", "a", "w")]
    assert sorted((r.reason, r.line) for r in bad.collect()) == [
        ("too_few_cells", "2"), ("too_few_cells", "b,8"), ("too_many_cells", "4,d,e"), ("too_many_cells", '6,"x,y",z')]
    assert good.count() + bad.count() == 8
    with pytest.raises(ValueError, match="header"):
        scan(spark, str(tmp_path), "csv", header="false", malformed="_bad")


def test_publish_replaces_the_whole_table_at_once(spark, tmp_path):
    from civic_indicators.sources import publish, published
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2024), (2, 2025)], "k int, y int")
    first = publish(df, path, ["y"])
    reader = published(spark, path)
    publish(df.where("y = 2025"), path, ["y"])
    assert [tuple(r) for r in published(spark, path).collect()] == [(2, 2025)]
    assert reader.count() == 2 and os.path.isdir(first)          # a reader that had begun goes on
    with pytest.raises(Exception):
        publish(df.selectExpr("k", "y", "raise_error('no') AS z"), path, ["y"])
    assert [tuple(r) for r in published(spark, path).collect()] == [(2, 2025)]
    publish(df, path)
    assert published(spark, path).count() == 2 and not os.path.isdir(first)


def test_conform_takes_either_name(spark):
    from civic_indicators.sources.sheets import conform
    for name in ("a_long", "a"):
        assert conform(spark.createDataFrame([("3",)], f"{name} string"), {"a_long|a": "int"}).first()[0] == 3
    with pytest.raises(ValueError, match="a_long"):
        conform(spark.createDataFrame([("3",)], "b string"), {"a_long|a": "int"})


def test_increments_count_each_file_once(spark, tmp_path):
    from civic_indicators.plans import incremental as INC
    landing, store, read = tmp_path / "in", str(tmp_path / "store"), []

    def put(name, *months):
        landing.mkdir(exist_ok=True)
        (landing / name).write_text("".join(f"{m}\n" for m in months))

    def partial(paths):
        read.append(sorted(os.path.basename(p).replace("\\", "") for p in paths))
        return spark.read.text(paths).groupBy("value").count().select(F.col("value").alias("month"), F.col("count").alias("value"))

    def totals():
        return {r.month: r.value for r in INC.totals(spark, store, ["month"]).collect()}

    def update():
        return INC.update(spark, str(landing), store, partial)

    put("a [1].txt", "x", "x", "y")
    put("b.txt", "y")
    assert update() == 2 and totals() == {"x": 2, "y": 2}
    assert update() == 0 and len(read) == 1                      # nothing new: nothing read, nothing written
    put("c.txt", "x", "z")
    assert update() == 1 and read[-1] == ["c.txt"] and totals() == {"x": 3, "y": 2, "z": 1}
    put("b.txt", "z", "z", "z")                                  # landed anew: its batch is counted again
    assert update() == 2 and read[-1] == ["a [1].txt", "b.txt"] and totals() == {"x": 3, "y": 1, "z": 4}
    put("d.txt", "q")

    def fails(paths):
        return partial(paths).withColumn("value", F.raise_error(F.lit("no")).cast("bigint"))

    with pytest.raises(Exception):
        INC.update(spark, str(landing), store, fails)
    assert totals() == {"x": 3, "y": 1, "z": 4} and update() == 1 and totals()["q"] == 1
    (landing / "c.txt").unlink()
    assert update() == 0 and totals() == {"x": 2, "y": 1, "z": 3, "q": 1}
