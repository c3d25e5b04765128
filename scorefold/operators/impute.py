"""Rule-driven imputation and whole-column statistics for missing values."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from scorefold.functions import kernels as K
from scorefold.functions import rules
from scorefold.operators import ranks
from scorefold.operators.projection import add_long_names
from scorefold.session import kept

# ---------------------------------------------------------------- rule tables


def imputed_columns(table=rules.NDI_IMPUTATION, suffix: str = "_Imputed") -> dict[str, str]:
    """Expressions of a (column, default, codes) table."""
    return {c + suffix: K.impute(c, default, codes) for c, default, codes in table}


def impute_by_rules(df: DataFrame, table=rules.NDI_IMPUTATION, suffix: str = "_Imputed") -> DataFrame:
    """Apply a rule table in one projection."""
    return K.with_sql(df, imputed_columns(table, suffix))


def impute_policy(df: DataFrame) -> DataFrame:
    """Credit-policy imputation and the high-utilisation proxy."""
    proxy = "V71_IN06S_Imputed - V71_ST06S_Imputed - V71_AU06S_Imputed"
    return K.with_layers(df, [imputed_columns(rules.POLICY_IMPUTATION), {"high_util_proxy": proxy}])


def limit_policy(df: DataFrame, table=rules.POLICY_LIMITS) -> DataFrame:
    """Credit-policy caps, floors and flags."""
    kinds = {
        "flag_above": lambda c, edge: K.flag(f"{c} > {edge}"),
        "flag_from": lambda c, edge: K.flag(f"{c} < {edge}", 0, 1),
        "cap": K.cap,
        "clip": K.clip,
    }
    return K.with_sql(df, {c: kinds[kind](c, *args) for c, kind, args in table})


def loan_columns() -> dict[str, str]:
    """Unsecured-loan columns under the names the credit model knows."""
    return {
        new: K.replace_sentinels(source, value) for new, source, value in rules.CREDIT_MODEL_LOAN_COLUMNS
    }


def impute_credit_model(df: DataFrame) -> DataFrame:
    """Inputs of the credit model: codes to 999, loan columns, long names."""
    cleaned = {c: K.replace_sentinels(c, 999.0) for c in rules.CREDIT_MODEL_999}
    return K.with_sql(df, cleaned | loan_columns()).transform(add_long_names)


def income_v3_inputs(df: DataFrame, model_columns: Sequence[str]) -> DataFrame:
    """Card interest estimate, then negative codes of the model's columns to NULL."""
    rate = K.scrub_rate(K.annual_rate("W49_ATTR08", "W49_ATTR07"))
    return K.with_layers(df, [{"CCIntEst": rate}, {c: K.negative_to_null(c) for c in model_columns}])


def fill_missing(df: DataFrame, value: float = 0) -> DataFrame:
    return df.na.fill(value)


# ------------------------------------------------------- modes and medians


def column_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Most frequent value per column, the smallest on a tie.

    Values are counted per (column, value) before anything is compared, so no
    task ever holds a column's whole value set.
    """
    counts = _long(df, columns).groupBy("name", "value").agg(F.count("*").alias("n"))
    best = counts.groupBy("name").agg(F.max(F.struct("n", -F.col("value"))).alias("best"))
    return {r["name"]: -r["best"][1] for r in best.collect()}


def column_medians(
    df: DataFrame, columns: Sequence[str], max_values: int = 1 << ranks.DIGIT_BITS, accuracy: int | None = None
) -> dict[str, float]:
    """Exact median per column; NULL and NaN do not count, a column without values has no entry.

    ``max_values`` bounds the counters per column that a round of
    ``ranks.values_at_ranks`` keeps.  ``accuracy`` is accepted for older callers
    and has no effect: the ranks are exact.
    """
    # The job that writes the columns once counts their values as well.
    counted = Observation()
    slim = df.select(*[_present(c).alias(c) for c in columns])
    slim = kept(slim.observe(counted, *[F.count(K.quoted(c)).alias(f"n{i}") for i, c in enumerate(columns)]), "median_columns")
    totals = counted.get
    wanted = {c: [(n - 1) // 2, n // 2] for c, n in ((c, totals[f"n{i}"]) for i, c in enumerate(columns)) if n}
    found = ranks.values_at_ranks(slim, wanted, int(math.log2(max_values)))
    return {c: (found[c, low] + found[c, high]) / 2 for c, (low, high) in wanted.items()}


def _present(name: str) -> Column:
    x = F.col(name).cast("double")
    return F.when(~F.isnan(x), x)


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, value) rows of the present values; NaN counts as missing."""
    slim = df.select(*[_present(c).alias(c) for c in columns])
    return slim.unpivot([], list(columns), "name", "value").filter(F.col("value").isNotNull())


def fill_with(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """NULL and NaN become the column's given value."""
    def filled(name: str, value: float) -> str:
        x = f"CAST({K.quoted(name)} AS DOUBLE)"
        return K.case([(f"{x} IS NULL OR isnan({x})", K.literal(float(value)))], x)

    return K.with_sql(df, {c: filled(c, v) for c, v in values.items()})


def fill_mode_median(df: DataFrame, mode_columns: Sequence[str], median_columns: Sequence[str]) -> DataFrame:
    """Mode for some columns, median for others; the statistics skip missing values."""
    values = column_modes(df, mode_columns) if mode_columns else {}
    if median_columns:
        values |= column_medians(df, median_columns)
    return fill_with(df, values)
