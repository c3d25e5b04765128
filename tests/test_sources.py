import pytest
from pyspark.sql import functions as F

from scorefold.session import scratch_path, shared_root, staged
from scorefold.sources import readers, writers

SCHEMA = "ZIPCODE string, v double"


def test_campaign_csv_keeps_leading_zeros(spark):
    path = scratch_path(spark, "csv")
    writers.write_csv(spark.createDataFrame([("00501", 1.0), ("501", 2.0)], SCHEMA).repartition(2), path)
    df = readers.load_campaign(spark, path, SCHEMA, {"zipcode": "NCOA ADDR"})
    assert df.columns == ["NCOAADDR", "v"] and df.filter("NCOAADDR = '00501'").count() == 1
    zips = readers.read_zip_table(spark, path, SCHEMA, "ZIPCODE")
    assert {r[0] for r in zips.select("ZIPCODE").collect()} == {"00501"}
    assert readers.sampled_schema(spark, path, 1.0)["v"].dataType.simpleString() == "double"


def test_feature_list_and_selected_files(spark, tmp_path):
    (tmp_path / "list.csv").write_text("a_1\n b_2 \n")
    assert readers.read_feature_list(spark, str(tmp_path / "list.csv")) == ["a_1", "b_2"]
    for name in ("interim_tiny_1.csv", "interim_tiny_cali.csv", "interim_2.csv"):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text(f"n\n{name}\n")
    df = readers.read_selected_files(
        spark, str(tmp_path / "in"), "n string", ["interim", "tiny"], ["cali"], part="file_name")
    assert [r["n"] for r in df.collect()] == ["interim_tiny_1.csv"]
    assert readers.rows_to_frame(spark, [(1,)], "x int").count() == 1


def test_legacy_load_formats(spark):
    path = scratch_path(spark, "legacy")
    spark.range(3).write.parquet(path)
    df = readers.load_legacy(spark, path)
    assert df.columns == ["id", "N05_AT36", "N05_BR28", "N05_BC98", "N05_G046"]
    assert readers.read_columnar(spark, path, "parquet").count() == readers.read_columnar(spark, path).count() == 3


def test_compaction_keeps_rows_and_merges_files(spark):
    path = scratch_path(spark, "many")
    spark.range(1000).withColumn("p", F.col("id") % 2).repartition(10).write.partitionBy("p").parquet(path)
    found = writers.compact_partitions(spark, path, ["p"], sort_by=["id"], only=F.col("p") == 0)
    assert found["files_before"] == 10 and found["files_after"] < 10 and found["rows"] == 500
    again = spark.read.parquet(path)
    assert again.count() == again.distinct().count() == 1000
    assert writers.detail(again.filter("p = 1")).first()["files"] == 10


def test_audit_and_reports(spark):
    data, audit = scratch_path(spark, "d"), scratch_path(spark, "audit")
    spark.range(5).write.parquet(data)
    for op in ("write", "merge"):
        writers.record_load(spark, audit, "t", op, spark.read.parquet(data))
    lines = writers.history(spark, audit, "t").collect()
    assert [r["operation"] for r in lines] == ["merge", "write"] and all(r["rows"] == 5 and r["bytes"] > 0 for r in lines)


def test_tables(spark):
    writers.create_database(spark, "scores")
    writers.save_interim_sample(spark.range(50), "scores.sample", rows=20)
    assert readers.read_table(spark, "scores.sample").count() == 20
    assert writers.describe_table(spark, "scores.sample").filter("col_name = 'Provider'").count() == 1
    writers.drop_table(spark, "scores.sample")
    assert not spark.catalog.tableExists("scores.sample")


def test_staged_tables_live_in_the_shared_folder_and_go_away(spark):
    with staged(spark.range(4)) as df:
        assert shared_root(spark) in df.inputFiles()[0] and df.count() == 4
    with pytest.raises(Exception):
        df.count()
