"""Renames, fixed projections, name rules and row selection."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorefold.functions import kernels as K
from scorefold.functions import rules


class ColumnError(ValueError):
    """Requested columns do not fit the DataFrame's schema."""


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    """Raise a readable error for missing columns (names ignore case, as in Spark)."""
    present = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in present]
    if missing:
        raise ColumnError(f"missing columns: {', '.join(missing)}")


def read_name_map(table: DataFrame, raw: str = "raw_lower", final: str = "final", names: Iterable[str] | None = None) -> dict[str, str]:
    """Name map {raw: final} from a two-column control table.

    With ``names``, only the rows for these columns leave Spark, however large the table is.
    """
    rows = table.select(F.trim(raw).alias("raw"), F.trim(final).alias("final"))
    if names is not None:
        wanted = table.sparkSession.createDataFrame([(n.lower(),) for n in names], "wanted string")
        rows = rows.join(wanted, F.col("raw") == F.col("wanted"), "left_semi")
    return {r["raw"]: r["final"] for r in rows.collect()}


# ------------------------------------------------------------------- renames


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Standard names: mapped by lower-cased name, white space removed; others lower-cased."""
    names = [
        re.sub(r"\s+", "", mapping[c.lower()]) if c.lower() in mapping else c.lower()
        for c in df.columns
    ]
    folded = [n.lower() for n in names]
    twice = sorted({n for n in folded if folded.count(n) > 1})
    if twice:
        raise ColumnError(f"names collide after renaming: {', '.join(twice)}")
    return df.toDF(*names)


def version_agnostic_name(name: str) -> str:
    """The name without its year suffix or model version."""
    for suffix in rules.YEAR_SUFFIXES:
        name = name.removesuffix(suffix)
    return rules.VERSION_AGNOSTIC_NAMES.get(name, name)


def rename_version_agnostic(df: DataFrame) -> DataFrame:
    renames = {c: version_agnostic_name(c) for c in df.columns}
    return df.withColumnsRenamed({old: new for old, new in renames.items() if old != new})


def bureau_code(long_name: str) -> str:
    """``V71_AT36S_mo_since_most_recent_dq`` -> ``V71_AT36S``."""
    return "_".join(long_name.split("_")[:2])


def add_long_names(df: DataFrame, long_names: Sequence[str] = rules.CREDIT_MODEL_LONG_NAMES) -> DataFrame:
    """Alias bureau codes under their long names in one projection."""
    return K.with_sql(df, {name: bureau_code(name) for name in long_names})


def add_approval_names(df: DataFrame) -> DataFrame:
    """Aliases the older approval model expects."""
    return K.with_sql(df, {"N05_S0_Y2": "N05_S0Y2", "W49_ATTR24": "epay01attr24"})


def add_null_doubles(df: DataFrame, columns: Sequence[str] = rules.NULL_DOUBLE_COLUMNS) -> DataFrame:
    return K.with_sql(df, {c: "CAST(NULL AS DOUBLE)" for c in columns})


# --------------------------------------------------------------- projections


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fixed projection with a check that names every missing column."""
    require_columns(df, columns)
    return df.select(*columns)


def column_union(*lists: Iterable[str]) -> list[str]:
    """Sorted union of column lists, the full output of a scoring run."""
    return sorted(set().union(*lists))


def prefixed(columns: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(c).alias(prefix + c) for c in columns]


def matching_columns(df: DataFrame, *words: str) -> list[str]:
    """Columns whose lower-cased name contains any of ``words``."""
    return [c for c in df.columns if any(w.lower() in c.lower() for w in words)]


def credit_model_inputs(df: DataFrame, long_names: Sequence[str] = rules.CREDIT_MODEL_LONG_NAMES) -> list[str]:
    """Bureau codes of the credit model that exist here, plus every loan attribute."""
    codes = list(dict.fromkeys(bureau_code(n) for n in long_names))
    present = set(df.columns)
    return [c for c in codes if c in present] + matching_columns(df, "epay")


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    return K.with_sql(df, {c: f"round({K.quoted(c)}, {digits})" for c in columns})


# ------------------------------------------------------------- new variables


def create_new_variables(df: DataFrame) -> DataFrame:
    """Selection tags, unsecured balance sums and the placeholder columns.

    The published name ``UnsecuredSummayBalanceBlend`` is spelt that way in
    existing output files.
    """
    by_trade = "V71_RE101S + V71_IN101S - V71_HR101S - V71_AU101S - V71_ST101S"
    by_lender = "epay01attr25 + epay01attr19"
    columns = {
        "RECENT_TAG": "previous6Tag1",
        "UnsecuredSummaryBalanceTUVars1": by_trade,
        "UnsecuredSummaryBalanceCustomVars": by_lender,
        "UnsecuredSummaryBalanceTUVars2": "V71_US101S + V71_BC101S",
        "UnsecuredSummayBalanceBlend": f"greatest({by_trade}, {by_lender})",
    }
    placeholders = {c: "CAST(NULL AS DOUBLE)" for c in rules.NULL_DOUBLE_COLUMNS}
    return K.with_sql(df.withColumnRenamed("RECENT_TAG", "eligible_last_month"), columns | placeholders)


# ------------------------------------------------------------- row selection


def between_times(
    df: DataFrame,
    column: str,
    start: datetime | date | str | None = None,
    end: datetime | date | str | None = None,
) -> DataFrame:
    """Rows with ``start <= column < end``; an absent bound does not restrict."""
    kind = df.schema[column].dataType.simpleString()
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start).cast(kind))
    if end is not None:
        df = df.filter(F.col(column) < F.lit(end).cast(kind))
    return df


def keep_ids(df: DataFrame, ids: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key is in ``ids``: a semi join instead of a literal list.

    Ids are reduced before the join, so an id that is listed very often costs
    one row; the join reuses the same shuffle.
    """
    return df.join(_distinct_keys(ids, key), key, "left_semi")


def drop_ids(df: DataFrame, ids: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``ids``."""
    return df.join(_distinct_keys(ids, key), key, "left_anti")


def _distinct_keys(ids: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return ids.select(*([key] if isinstance(key, str) else key)).distinct()


def has_value(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def hash_share(key: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) in steps of 1/10,000 that depends on the key and the seed alone."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10_000 / 10_000


def sample_range(
    df: DataFrame, column: str, start, end, fraction: float, seed: int, key: Sequence[str] | None = None
) -> DataFrame:
    """A random share of a time range; by a hash of ``key`` the same rows on any cluster."""
    rows = between_times(df, column, start, end)
    return rows.sample(fraction=fraction, seed=seed) if key is None else rows.filter(hash_share(key, seed) < fraction)


def apply_steps(df: DataFrame, steps: Iterable[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    for step in steps:
        df = df.transform(step)
    return df
