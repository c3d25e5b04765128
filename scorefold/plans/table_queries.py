"""Reading and writing files and tables, compaction and the load audit."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from scorefold.operators.projection import read_name_map
from scorefold.plans.registry import query, with_rounded
from scorefold.session import scratch_path
from scorefold.sources import driver_tables as D
from scorefold.sources import readers, writers

_CUSTOMER = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
_NAMES = {"c_custkey": "PPPCL_CONSUMER_ID", "c_acctbal": "Balance"}
_ALL_CUSTOMERS = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
_RENAMED = _ALL_CUSTOMERS.replace("c_custkey,", 'c_custkey AS "PPPCL_CONSUMER_ID",').replace(
    "c_acctbal,", 'c_acctbal AS "Balance",'
)


def _csv_folder(spark, sf_dir, parts: int = 20) -> str:
    """The customers as a folder of CSV part files, as a campaign arrives."""
    path = scratch_path(spark, "campaign")
    writers.write_csv(D.table(spark, sf_dir, "customer").repartition(parts), path)
    return path


@query("SRC-01 SRC-08 SRC-09 SNK-01 PRJ-01", _RENAMED)
def csv_campaign(spark, sf_dir):
    """Part files under standard names; the name map is a control file of its own."""
    control = scratch_path(spark, "names")
    writers.write_csv(readers.rows_to_frame(spark, list(_NAMES.items()), "raw_lower STRING, final STRING"), control)
    names = read_name_map(readers.read_csv(spark, control, "raw_lower STRING, final STRING"))
    return readers.load_campaign(spark, _csv_folder(spark, sf_dir), _CUSTOMER, names)


@query(
    "SRC-02 SRC-05 PRJ-03",
    f"SELECT *, CAST(NULL AS DOUBLE) AS \"N05_AT36\", CAST(NULL AS DOUBLE) AS \"N05_BR28\", CAST(NULL AS DOUBLE) AS \"N05_BC98\", "
    f"CAST(NULL AS DOUBLE) AS \"N05_G046\" FROM ({_RENAMED})",
)
def legacy_load(spark, sf_dir):
    path = scratch_path(spark, "legacy")
    D.table(spark, sf_dir, "customer").write.parquet(path)
    return readers.load_legacy(spark, path, names=_NAMES)


@query("SRC-03 SRC-01", "SELECT count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer")
def inferred_csv(spark, sf_dir):
    """Types guessed by Spark, as for a sample file; campaigns give a schema."""
    df = readers.read_csv(spark, _csv_folder(spark, sf_dir))
    return df.agg(F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query(
    "SRC-04",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING' OR c_mktsegment = 'MACHINERY'",
)
def selected_files(spark, sf_dir):
    """Only files whose folder names a wanted segment and not an unwanted one."""
    path = scratch_path(spark, "segments")
    customers = D.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    writers.write_csv(customers.filter("c_mktsegment = 'BUILDING'"), f"{path}/interim_tiny_building")
    writers.write_csv(customers.filter("c_mktsegment = 'MACHINERY'"), f"{path}/interim_tiny_machinery")
    writers.write_csv(customers.filter("c_mktsegment = 'FURNITURE'"), f"{path}/interim_tiny_cali_furniture")
    return readers.read_selected_files(
        spark, f"{path}/*", "c_custkey BIGINT, c_mktsegment STRING", ["interim", "tiny"], ["cali"], part="file_path"
    )


@query("SRC-06 SNK-02 SNK-03 SNK-04", _ALL_CUSTOMERS)
def managed_table(spark, sf_dir):
    """Write a catalog table, read it back, and drop a second one."""
    database = f"scores_{uuid.uuid4().hex[:8]}"
    writers.create_database(spark, database)
    customers = D.table(spark, sf_dir, "customer")
    writers.write_table(customers, f"{database}.kept", path=scratch_path(spark, "kept"))
    writers.write_table(customers, f"{database}.dropped", path=scratch_path(spark, "dropped"))
    writers.drop_table(spark, f"{database}.dropped")
    return readers.read_table(spark, f"{database}.kept")


@query(
    "TBL-02",
    "SELECT column_name AS col_name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS data_type "
    "FROM (DESCRIBE SELECT * FROM customer)",
)
def described_table(spark, sf_dir):
    """The column rows of a table's description."""
    name = f"described_{uuid.uuid4().hex[:8]}"
    customers = D.table(spark, sf_dir, "customer")
    writers.write_table(customers, name, path=scratch_path(spark, name))
    return writers.describe_table(spark, name).where(F.col("col_name").isin(customers.columns)).select("col_name", "data_type")


@query("SRC-07", "SELECT lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS zipcode, c_acctbal FROM customer WHERE c_custkey < 100000")
def zip_table_file(spark, sf_dir):
    """A ZIP-level CSV file keeps the leading zeros of its key."""
    path = scratch_path(spark, "zip_table")
    keyed = D.table(spark, sf_dir, "customer").where("c_custkey < 100000").selectExpr("lpad(CAST(c_custkey AS STRING), 5, '0') AS zipcode", "c_acctbal")
    writers.write_csv(keyed, path)
    return readers.read_zip_table(spark, path, "zipcode STRING, c_acctbal DOUBLE")


@query("SNK-06 FLT-07", "SELECT least(count(*), 1000) AS sampled FROM lineitem")
def interim_sample(spark, sf_dir):
    """The first rows as a table; the limit is what this operator does."""
    name = f"interim_{uuid.uuid4().hex[:8]}"
    writers.save_interim_sample(D.table(spark, sf_dir, "lineitem"), name, rows=1000, path=scratch_path(spark, name))
    return readers.read_table(spark, name).agg(F.count("*").alias("sampled"))


@query("SNK-05", "SELECT c_mktsegment, count(*) AS \"count\" FROM customer GROUP BY 1")
def report_files(spark, sf_dir):
    path = scratch_path(spark, "reports")
    counted = D.table(spark, sf_dir, "customer").groupBy("c_mktsegment").count()
    writers.write_reports({"segments": counted}, path)
    return readers.read_csv(spark, f"{path}/segments", "c_mktsegment STRING, count BIGINT")


@query(
    "TBL-01",
    "SELECT l_returnflag, count(*) AS lines, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1",
)
def compacted_table(spark, sf_dir):
    """Many small files per partition, rewritten in place."""
    path = scratch_path(spark, "lines")
    lines = D.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    lines.repartition(12).write.partitionBy("l_returnflag").parquet(path)
    writers.compact_partitions(spark, path, ["l_returnflag"], sort_by=["l_orderkey"])
    return spark.read.parquet(path).groupBy("l_returnflag").agg(
        F.count("*").alias("lines"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query(
    "TBL-03",
    "SELECT 'lines' AS table_name, 'write' AS operation, count(*) AS rows FROM lineitem",
)
def load_history(spark, sf_dir):
    path, audit = scratch_path(spark, "lines"), scratch_path(spark, "audit")
    D.table(spark, sf_dir, "lineitem").write.parquet(path)
    writers.record_load(spark, audit, "lines", "write", spark.read.parquet(path))
    return writers.history(spark, audit, "lines").select("table_name", "operation", "rows")


@query("SRC-05 TBL-03", "SELECT CAST(1 AS BIGINT) AS files, count(*) AS rows FROM lineitem")
def table_detail(spark, sf_dir):
    df = readers.read_columnar(spark, f"{sf_dir}/lineitem.parquet")
    return writers.detail(df).select("files", "rows")


@query("SO-01 AG-05", "SELECT s_nationkey, count(*) AS \"count\" FROM supplier GROUP BY 1 ORDER BY 2 DESC, 1")
def ordered_counts(spark, sf_dir):
    counted = D.table(spark, sf_dir, "supplier").groupBy("s_nationkey").count()
    return counted.orderBy(F.col("count").desc(), "s_nationkey")


@query("SO-01", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC")
def salaries_descending(spark, sf_dir):
    return with_rounded(D.table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"), 2).orderBy(
        F.col("s_acctbal").desc()
    )
