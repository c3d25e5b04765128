"""Whole-table summaries computed in one pass."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorefold.session import kept


def _unfold(df: DataFrame, rows: list[Column]) -> DataFrame:
    """One row per struct of a one-row aggregate."""
    return df.select(F.inline(F.array(*rows)))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, count, mean, stddev, min, max) with numbers kept as numbers."""
    stats = {"count": F.count, "mean": F.mean, "stddev": F.stddev, "min": F.min, "max": F.max}
    slim = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    one = slim.agg(*[f(c).alias(f"{s}_{i}") for i, c in enumerate(columns) for s, f in stats.items()])
    return _unfold(one, [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{s}_{i}").alias(s) for s in stats])
        for i, c in enumerate(columns)
    ])


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (column, nulls); NaN of a floating-point column counts as missing."""
    columns = list(columns or df.columns)
    kinds = dict(df.dtypes)

    def missing(c: str) -> Column:
        gone = F.col(c).isNull()
        return gone | F.isnan(c) if kinds[c] in ("double", "float") else gone

    one = df.agg(*[F.count_if(missing(c)).alias(f"n_{i}") for i, c in enumerate(columns)])
    return _unfold(one, [
        F.struct(F.lit(c).alias("column"), F.col(f"n_{i}").alias("nulls"))
        for i, c in enumerate(columns)
    ])


_MOMENTS = ["n", "mean_i", "mean_j", "m2_i", "m2_j", "c"]


def pair_moments(df: DataFrame, columns: Sequence[str], block: int = 32) -> DataFrame:
    """(i, j, n, mean_i, mean_j, m2_i, m2_j, c) per pair of columns i <= j and task, over the rows where both are present.

    Means, sums of squared deviations and of their products come from products
    of matrices of values and of presence, block by block of columns; so one
    pass counts every pair, and a task keeps one state per pair of blocks.
    """
    slim = df.select(*[
        F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(columns)
    ])
    p = len(columns)
    blocks = [(a, min(a + block, p)) for a in range(0, p, block)]

    def moments(x: np.ndarray, here: np.ndarray, a: tuple, b: tuple) -> np.ndarray:
        """The six moments of two blocks over the rows of a batch, centred per pair."""
        xa, ma, xb, mb = x[:, slice(*a)], here[:, slice(*a)], x[:, slice(*b)], here[:, slice(*b)]
        n = ma.T @ mb
        some = np.maximum(n, 1)
        mean_i, mean_j = xa.T @ mb / some, ma.T @ xb / some
        return np.stack([n, mean_i, mean_j, (xa * xa).T @ mb - n * mean_i ** 2, ma.T @ (xb * xb) - n * mean_j ** 2,
                         xa.T @ xb - n * mean_i * mean_j])

    def added(s: np.ndarray, t: np.ndarray) -> np.ndarray:
        n = s[0] + t[0]
        share = t[0] / np.maximum(n, 1)
        di, dj, w = t[1] - s[1], t[2] - s[2], s[0] * share
        return np.stack([n, s[1] + di * share, s[2] + dj * share, s[3] + t[3] + di * di * w, s[4] + t[4] + dj * dj * w, s[5] + t[5] + di * dj * w])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, pivot = {}, None
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            here = ~np.isnan(x)
            if pivot is None:  # near the values, so that squares keep their digits
                pivot = np.where(here, x, 0).sum(axis=0) / np.maximum(here.sum(axis=0), 1)
            x, here = np.where(here, x - pivot, 0.0), here.astype(float)
            for k, a in enumerate(blocks):
                for b in blocks[k:]:
                    one = moments(x, here, a, b)
                    states[a, b] = added(states[a, b], one) if (a, b) in states else one
        for (a, b), s in states.items():
            i, j = (g.ravel() for g in np.meshgrid(range(*a), range(*b), indexing="ij"))
            keep = (i <= j) & (s[0].ravel() > 0)
            i, j = i[keep], j[keep]
            s = s.reshape(6, -1)[:, keep]
            s[1] += pivot[i]
            s[2] += pivot[j]
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *map(pa.array, s)], names=["i", "j", *_MOMENTS])

    return slim.mapInArrow(work, "i int, j int, " + ", ".join(f"{m} double" for m in _MOMENTS))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, each over the rows where both are present; NULL where one does not vary.

    The rows are read once, by ``pair_moments``; what tasks found is added up
    around the common means.
    """
    states = kept(pair_moments(df, columns), "pair_moments")
    means = states.groupBy("i", "j").agg(*[(F.sum(F.col("n") * F.col(m)) / F.sum("n")).alias(f"all_{m}") for m in ("mean_i", "mean_j")])
    di, dj = (F.col(m) - F.col(f"all_{m}") for m in ("mean_i", "mean_j"))
    total = states.join(means, ["i", "j"]).groupBy("i", "j").agg(
        F.sum(F.col("m2_i") + F.col("n") * di * di).alias("m2_i"), F.sum(F.col("m2_j") + F.col("n") * dj * dj).alias("m2_j"),
        F.sum(F.col("c") + F.col("n") * di * dj).alias("c"))
    r = F.when(F.col("i") == F.col("j"), F.when(F.col("m2_i") > 0, 1.0)).otherwise(
        F.try_divide("c", F.sqrt(F.col("m2_i")) * F.sqrt(F.col("m2_j"))))
    half = total.select("i", "j", r.alias("correlation"))
    both = half.unionAll(half.where("i < j").select("j", "i", "correlation"))
    every = df.sparkSession.createDataFrame(
        [(i, j, a, b) for i, a in enumerate(columns) for j, b in enumerate(columns)], "i int, j int, a string, b string")
    return every.join(both, ["i", "j"], "left").select("a", "b", "correlation")


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).count()


def share_of_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, percent): column totals in percent of the number of rows, from one pass."""
    one = df.agg(F.count("*").alias("total"), *[F.sum(c).alias(f"s_{i}") for i, c in enumerate(columns)])
    return _unfold(one, [
        F.struct(F.lit(c).alias("column"), (F.coalesce(F.col(f"s_{i}"), F.lit(0)) * 100 / F.col("total")).alias("percent"))
        for i, c in enumerate(columns)
    ])


def holds_for_all(df: DataFrame, condition: Column) -> DataFrame:
    """One row: does the condition hold for every row?  NULL counts as no."""
    return df.agg(F.every(F.coalesce(condition, F.lit(False))).alias("all_rows"))


def key_report(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys, missing keys and rows of the largest key."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    present = F.col(key).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count_if(present).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).cast("bigint").alias("null_keys"),
        F.max(F.when(present, F.col("n"))).alias("most_per_key"),
    )


def assert_unique_key(df: DataFrame, key: str) -> DataFrame:
    """Return ``df`` if every key is present and occurs once, else raise."""
    r = key_report(df, key).first()
    if r["null_keys"] or r["rows"] != r["distinct_keys"]:
        raise ValueError(f"{key} is not unique: {r.asDict()}")
    return df
