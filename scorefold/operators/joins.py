"""Joins with side tables: size checks, ZIP data, exact-key lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold.functions import kernels as K
from scorefold.functions import rules
from scorefold.session import kept

def join_dimension(df: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Equi join with a side table that is computed once.

    Written first, the side has a known size: Catalyst broadcasts it below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it above, where
    adaptive execution splits a key that holds a large share of ``df``.
    """
    return df.join(kept(dim, "dimension"), on, how)


# ------------------------------------------------------------------ ZIP data


def most_per_key(tables: Sequence[DataFrame], key: str) -> list[int]:
    """The largest key group of several side tables, in one job."""
    tagged = reduce(
        DataFrame.unionAll,
        [t.select(F.lit(i).alias("side"), F.col(key).cast("string").alias("key"))
         for i, t in enumerate(tables)],
    )
    found = {
        r["side"]: r["most"]
        for r in tagged.groupBy("side", "key").agg(F.count("*").alias("n"))
        .groupBy("side").agg(F.max("n").alias("most"))
        .collect()
    }
    return [found.get(i, 0) for i in range(len(tables))]


def zip_dimension(sides: Sequence[DataFrame], key: str = "zipcode") -> DataFrame:
    """One row per ZIP over side tables that each hold a ZIP at most once and share no other column."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    values = [c for c in stacked.columns if c != key]
    return stacked.filter(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in values]
    )


def append_zip_data(
    df: DataFrame,
    sides: Sequence[DataFrame],
    zip_column: str = "NCOA_ADDR_ZipCode",
    key: str = "zipcode",
    strict: bool = False,
) -> DataFrame:
    """Left join ZIP-level tables to applicants.

    Side tables with unique ZIPs are first folded into one dimension, so the
    applicants take part in a single join.  A side with repeated ZIPs fans out
    rows, as chained left joins do; ``strict`` refuses it.
    """
    # A column is known by its side, so that equal names of two sides stay apart.
    order = [(f"_zip{i}_{c}", c) for i, s in enumerate(sides) for c in s.columns if c != key]
    sides = [
        s.where(F.col(key).isNotNull()).select(key, *[F.col(c).alias(f"_zip{i}_{c}") for c in s.columns if c != key])
        for i, s in enumerate(sides)
    ]
    repeated = [i for i, most in enumerate(most_per_key(sides, key)) if most > 1]
    if repeated and strict:
        raise ValueError(f"side tables {repeated} hold a ZIP more than once")
    unique = [s for i, s in enumerate(sides) if i not in repeated]
    keyed = df.withColumnRenamed(zip_column, key)
    own = keyed.columns
    if unique:
        keyed = join_dimension(keyed, zip_dimension(unique, key), key)
    for i in repeated:
        keyed = join_dimension(keyed, sides[i], key)
    return keyed.select(*own, *[F.col(c).alias(name) for c, name in order]).withColumnRenamed(key, zip_column)


def append_zip_data_keeping_zip(
    df: DataFrame, sides: Sequence[DataFrame], zip_column: str = "NCOA_ADDR_ZipCode"
) -> DataFrame:
    """Older form: join on a copy of the ZIP column, which is then dropped."""
    own = df.columns
    joined = append_zip_data(df.withColumn("zip_join_key", F.col(zip_column)), sides, "zip_join_key")
    return joined.select(*own, *[c for c in joined.columns if c not in own and c != "zip_join_key"])


def standard_zip_tables(
    population: DataFrame, incomes: DataFrame, home_values: DataFrame, income: DataFrame, irs: DataFrame
) -> list[DataFrame]:
    """The five published ZIP tables cut to the columns a scoring run uses."""
    return [
        population,
        incomes,
        home_values.drop(*rules.HOME_VALUE_DROPPED),
        income.drop(*rules.INCOME_DROPPED),
        irs.withColumnRenamed("ZIPCODE", "zipcode").select("zipcode", *rules.IRS_COLUMNS),
    ]


def append_by_clean_zip(df: DataFrame, side: DataFrame, zip_column: str, side_zip: str) -> DataFrame:
    """Left join on five-digit ZIP text; both sides are cleaned, ``df`` keeps its column."""
    keyed = K.with_sql(side, {"zip_join_key": K.clean_zip(side_zip)}).drop(side_zip)
    cleaned = K.with_sql(df, {"zip_join_key": K.clean_zip(zip_column)})
    return join_dimension(cleaned, keyed, "zip_join_key").drop("zip_join_key")


# ---------------------------------------------------------- exact-key lookup


def lookup(
    df: DataFrame, table: DataFrame, keys: dict[str, str], columns: Sequence[str]
) -> DataFrame:
    """Left join ``columns`` of ``table`` where every ``df`` key equals its table key.

    ``keys`` maps the column of ``df`` to the key column of ``table``.
    """
    renamed = table.select(
        *[F.col(theirs).alias(f"lookup_{theirs}") for theirs in keys.values()], *columns
    )
    condition = reduce(
        lambda a, b: a & b, [F.col(ours) == F.col(f"lookup_{theirs}") for ours, theirs in keys.items()]
    )
    return df.join(renamed, condition, "left").drop(*[f"lookup_{k}" for k in keys.values()])


def join_scores(df: DataFrame, scores: DataFrame, key: str, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Bring score columns back by id, keeping one copy of the key."""
    return df.join(scores.select(key, *columns), key, how)
