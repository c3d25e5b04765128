"""Score files, managed tables, compaction and the load audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorefold.session import kept

AUDIT_SCHEMA = "table_name string, operation string, rows bigint, bytes bigint, at timestamp"


def write_csv(df: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """Replace a folder of CSV part files with header."""
    writer = df.write.mode("overwrite").option("header", True)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.csv(path)


def write_table(df: DataFrame, name: str, mode: str = "error", path: str | None = None) -> None:
    """Managed table, or an external one if ``path`` is given."""
    writer = df.write.mode(mode)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def save_interim_sample(df: DataFrame, name: str, rows: int = 100_000, path: str | None = None) -> None:
    """The first ``rows`` rows as a table."""
    write_table(df.limit(rows), name, path=path)


def write_reports(reports: dict[str, DataFrame], folder: str) -> None:
    """One CSV folder per report."""
    for name, df in reports.items():
        write_csv(df, f"{folder}/{name}")


# ----------------------------------------------------------------- maintenance


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE FORMATTED {name}")


def detail(df: DataFrame) -> DataFrame:
    """One row: files, bytes and rows behind a file-based DataFrame."""
    files = df.groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count("*").alias("n"))
    return files.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("file_size"), F.lit(0)).cast("bigint").alias("bytes"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
    )


def compact_partitions(
    spark: SparkSession, path: str, partition_columns: Sequence[str], sort_by: Sequence[str] = (), only=None
) -> dict[str, int]:
    """Rewrite small files of a partitioned Parquet folder.

    The rebalance hint makes adaptive execution cut files of the advisory
    size, splitting large partitions and merging small ones.  ``only`` is a
    predicate on partition columns.  The new files are first written beside the
    old ones, their rows are counted and hashed, and only equal ones replace them.
    """
    df = spark.read.parquet(path)
    chosen = df if only is None else df.filter(only)
    before = detail(chosen).first()

    def packed(rows: DataFrame) -> DataFrame:
        rows = rows.hint("rebalance", *partition_columns)
        return rows.sortWithinPartitions(*partition_columns, *sort_by) if sort_by else rows

    beside = kept(packed(chosen), "compacted")
    if content(beside) != content(chosen):
        raise RuntimeError(f"{path}: the rewritten rows differ from the old ones, which stay")
    (
        packed(beside).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_columns)
        .parquet(path)
    )
    again = spark.read.parquet(path)
    after = detail(again if only is None else again.filter(only)).first()
    return {"files_before": before["files"], "files_after": after["files"], "rows": after["rows"]}


def content(df: DataFrame) -> tuple:
    """Number of rows and the sum of their hashes: equal for equal rows in any order."""
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))).first())


def record_load(spark: SparkSession, audit_path: str, table_name: str, operation: str, data: DataFrame) -> None:
    """Append one line on a finished load to the audit folder."""
    found = detail(data).select(
        F.lit(table_name).alias("table_name"),
        F.lit(operation).alias("operation"),
        "rows",
        "bytes",
        F.current_timestamp().alias("at"),
    )
    found.write.mode("append").parquet(audit_path)


def history(spark: SparkSession, audit_path: str, table_name: str) -> DataFrame:
    """Recorded loads of a table, latest first."""
    audit = spark.read.schema(AUDIT_SCHEMA).parquet(audit_path)
    return audit.filter(F.col("table_name") == table_name).orderBy(F.col("at").desc())
