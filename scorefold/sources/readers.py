"""Campaign files, side tables and catalog tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorefold.functions import kernels as K
from scorefold.operators.projection import add_null_doubles, rename_columns

Schema = T.StructType | str


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: Schema | None = None, header: bool = True) -> DataFrame:
    """CSV file, directory or list of paths.

    Give a schema for large inputs: without one Spark reads the data once more
    to guess types, and ZIP codes and ids lose their leading zeros.
    """
    reader = spark.read.option("header", header)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path if isinstance(path, str) else list(path))


def sampled_schema(spark: SparkSession, path: str, share: float = 0.01) -> T.StructType:
    """Types guessed from a share of the rows, for writing a schema down once."""
    return spark.read.option("header", True).option("inferSchema", True).option("samplingRatio", share).csv(path).schema


def load_campaign(
    spark: SparkSession, path: str, schema: Schema | None = None, names: Mapping[str, str] | None = None
) -> DataFrame:
    """The applicant file of a campaign under standard names.

    ``names`` is the name map; None keeps the raw names.
    """
    df = read_csv(spark, path, schema)
    return df if names is None else rename_columns(df, names)


def load_legacy(
    spark: SparkSession,
    path: str,
    csv: bool = False,
    schema: Schema | None = None,
    names: Mapping[str, str] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Older loader: CSV or a columnar format, then the placeholder columns."""
    df = read_csv(spark, path, schema) if csv else spark.read.format(fmt).load(path)
    return add_null_doubles(df if names is None else rename_columns(df, names))


def read_selected_files(
    spark: SparkSession, path: str, schema: Schema, containing: Sequence[str] = (), without: Sequence[str] = (),
    part: str = "file_name",
) -> DataFrame:
    """CSV files below ``path`` chosen by words in their name; Spark does not open the others.

    ``part`` is "file_name" or, for words in folder names too, "file_path".
    """
    df = spark.read.schema(schema).option("header", True).csv(path)
    where = F.col(f"_metadata.{part}")
    for word in containing:
        df = df.filter(where.contains(word))
    for word in without:
        df = df.filter(~where.contains(word))
    return df


def read_zip_table(spark: SparkSession, path: str, schema: Schema, zip_column: str = "zipcode") -> DataFrame:
    """ZIP-level CSV whose key is kept as five-digit text."""
    return K.with_sql(read_csv(spark, path, schema), {zip_column: K.clean_zip(zip_column)})


def read_feature_list(spark: SparkSession, path: str) -> list[str]:
    """Feature names from a one-column file without header."""
    rows = read_csv(spark, path, "feature string", header=False).collect()
    return [r["feature"].strip() for r in rows]


def read_columnar(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Load a path in a given format, or in the session's default format."""
    return (spark.read.format(fmt) if fmt else spark.read).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def rows_to_frame(spark: SparkSession, rows: Sequence, schema: Schema) -> DataFrame:
    """Control data that already is on the driver."""
    return spark.createDataFrame(list(rows), schema)
