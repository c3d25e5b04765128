"""Inputs of the income model of version 4, computed where the data is."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from scorefold.functions import kernels as K
from scorefold.functions import rules
from scorefold.operators.features import one_hot, target_encode
from scorefold.operators.impute import fill_mode_median, fill_with, column_medians
from scorefold.operators.joins import append_by_clean_zip
from scorefold.session import kept


def income_v4_inputs(
    df: DataFrame,
    zip_table: DataFrame,
    encodings: Mapping[str, DataFrame],
    as_of: str,
    key: str = "PPPCL_CONSUMER_ID",
    zip_column: str = "NCOA_ADDR_ZipCode",
    side_zip: str = "RegionName",
    birth: str = "N05_S0Y2",
    one_hot_columns: Sequence[str] = rules.ONE_HOT_COLUMNS,
    required: Sequence[str] = rules.ONE_HOT_REQUIRED,
) -> DataFrame:
    """Age, ZIP data, filled gaps, target encodings and 0/1 columns.

    ``encodings`` maps a categorical column to its (value, mean) table; those
    columns are filled with their mode and every other one with its median,
    after which an encoded value that is unknown gets the median encoding.
    ``as_of`` is the SQL text of the date ages refer to.
    """
    df = K.with_sql(df, {"age": K.age_in_years(birth, as_of)}).drop(birth)
    # Computed once: modes, medians and the smallest categories are statistics of these rows.
    df = kept(append_by_clean_zip(df, zip_table, zip_column, side_zip).drop(zip_column), "income_inputs")
    others = [c for c in df.columns if c != key and c not in encodings]
    df = fill_mode_median(df, list(encodings), others)
    for column, means in encodings.items():
        df = target_encode(df, column, means).drop(column)
    encoded = [f"te_{c}" for c in encodings]
    df = fill_with(df, column_medians(df, encoded)) if encoded else df
    return one_hot(df, list(one_hot_columns), required)
