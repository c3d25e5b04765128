"""Comparing the scores of two runs of the same population.

``pairs`` lists (current column, legacy column).  Every report makes one pass
over its input; nothing but its small result ever leaves the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorefold.operators.aggregates import describe
from scorefold.session import kept

Pairs = Sequence[tuple[str, str]]
TOLERANCE = 1e-8


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing(c: Column) -> Column:
    return c.isNull() | F.isnan(c)


def close(a: str | Column, b: str | Column, tolerance: float = TOLERANCE, equal_nan: bool = False) -> Column:
    """|a - b| <= tolerance, never NULL.

    A missing value on either side is a mismatch, unless ``equal_nan`` accepts
    two of them; equal infinities match.
    """
    a, b = _column(a).cast("double"), _column(b).cast("double")
    same = (F.abs(a - b) <= tolerance) | ((a == b) & ~F.isnan(a))
    same = F.coalesce(same, F.lit(False))
    return same | (missing(a) & missing(b)) if equal_nan else same


def key_list(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def join_runs(current: DataFrame, legacy: DataFrame, key: str | Sequence[str], how: str = "inner",
              suffixes: tuple[str, str] = ("_DB", "_R")) -> DataFrame:
    """Join two runs by id, of one or several columns; shared column names get a suffix per side."""
    key = key_list(key)
    shared = {c for c in current.columns if c in set(legacy.columns)} - set(key)
    a = current.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    b = legacy.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return a.join(b, key, how)


def suffix_pairs(names: Pairs, suffixes: tuple[str, str] = ("_DB", "_R")) -> list[tuple[str, str]]:
    """Pairs as they are called after ``join_runs``."""
    return [(a + suffixes[0], b + suffixes[1]) if a == b else (a, b) for a, b in names]


# ------------------------------------------------------------- rows that agree

#: Bits a differing key gets in the table that both runs are held against, and bits of the whole table at most (128 MB).
BITS_PER_KEY, MAX_BITS = 8, 1 << 30
#: Bits of one bitmap as Spark builds it, and of the parts that a row is held against.
BITMAP, PART = 1 << 15, 1 << 11


def _values(columns: Sequence[str]) -> list[Column]:
    # Both zeros have one hash.
    return [F.col(c).cast("double") + F.lit(0.0) for c in columns]


def _any_missing(values: Sequence[Column]) -> Column:
    """NULL in one addend makes the sum NULL, NaN makes it NaN; opposite infinities too, which only costs a comparison."""
    return missing(sum(values[1:], values[0]))


def without_agreeing(current: DataFrame, legacy: DataFrame, key: str | Sequence[str], names: Pairs) -> tuple[DataFrame, DataFrame]:
    """Both runs without most of the rows that agree in every column and miss no value; no other row is lost.

    For runs with many columns that are to be joined (inner) for what differs:
    of every row a hash of its key and one of its values are shuffled first, and
    then only rows of keys with different hashes.  These keys are marked in a
    bounded table of bits by their hash; a key that shares a bit with another
    stays, which costs its shuffle and changes nothing.  Keys may repeat; runs
    whose keys differ in type are left as they are.
    """
    key = key_list(key)
    types = [dict(run.dtypes) for run in (current, legacy)]
    if any(types[0][k] != types[1][k] or "collate" in types[0][k] for k in key):
        return current, legacy
    place = F.xxhash64(*key)

    def hashed(run: DataFrame, columns: Sequence[str]) -> DataFrame:
        values = _values(columns)
        known = reduce(Column.__and__, [F.col(k).isNotNull() for k in key])
        return run.where(known).select(place.alias("place"), F.when(~_any_missing(values), F.xxhash64(*values)).alias("hash"))

    both = hashed(current, [a for a, _ in names]).unionAll(hashed(legacy, [b for _, b in names]))
    found = both.repartition("place").groupBy("place").agg(F.min("hash").alias("low"), F.max("hash").alias("high"), F.count_if(F.isnull("hash")).alias("missing"))
    differing = kept(found.where((F.col("missing") > 0) | (F.col("low") != F.col("high"))).select("place"), "differing")
    bits = BITMAP
    while bits < min(MAX_BITS, BITS_PER_KEY * differing.count()):
        bits *= 2
    bit = F.col("place").bitwiseAND(F.lit(bits - 1))
    maps = (
        differing.select(F.shiftright(bit, BITMAP.bit_length() - 1).alias("block"), bit.bitwiseAND(F.lit(BITMAP - 1)).alias("bit"))
        .repartition("block").groupBy("block").agg(F.bitmap_construct_agg("bit").alias("map"))
    )
    i = F.col("i")
    parts = kept(
        maps.select("block", "map", F.explode(F.sequence(F.lit(0), F.lit(BITMAP // PART - 1))).alias("i"))
        .select((F.col("block") * (BITMAP // PART) + i).alias("__part"), F.substring("map", i * (PART // 8) + 1, F.lit(PART // 8)).alias("__map")),
        "differing_bits")

    def marked(run: DataFrame) -> DataFrame:
        own = run.withColumn("__bit", place.bitwiseAND(F.lit(bits - 1)))
        at = F.col("__bit").bitwiseAND(F.lit(PART - 1))
        byte = F.conv(F.hex(F.substring("__map", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("long")
        held = own.join(F.broadcast(parts), F.shiftright("__bit", PART.bit_length() - 1) == F.col("__part"))
        return held.where(F.getbit(byte, at.bitwiseAND(F.lit(7))) == 1).select(*run.columns)

    return marked(current), marked(legacy)


# ------------------------------------------------------------------ mismatches


def mismatches(joined: DataFrame, key: str | Sequence[str], pair: tuple[str, str], tolerance: float = TOLERANCE) -> DataFrame:
    """Rows of one score that differ: (key, legacy, current)."""
    current, legacy = pair
    return joined.filter(~close(current, legacy, tolerance)).select(*key_list(key), legacy, current)


def all_mismatches(joined: DataFrame, key: str | Sequence[str], pairs: Pairs, tolerance: float = TOLERANCE) -> DataFrame:
    """Rows (key, score, legacy, current) over all scores from a single scan."""
    rows = F.array(*[
        F.struct(
            F.lit(current).alias("score"),
            F.col(legacy).cast("double").alias("legacy"),
            F.col(current).cast("double").alias("current"),
            close(current, legacy, tolerance).alias("same"),
        )
        for current, legacy in pairs
    ])
    differing = F.filter(rows, lambda r: ~r["same"])
    return joined.select(*key_list(key), F.inline(differing)).drop("same")


def verdicts(joined: DataFrame, pairs: Pairs, tolerance: float = TOLERANCE, equal_nan: bool = False) -> DataFrame:
    """Rows (score, all_close, mismatches) for every pair."""
    same = [close(a, b, tolerance, equal_nan) for a, b in pairs]
    one = joined.agg(
        *[F.every(s).alias(f"all_{i}") for i, s in enumerate(same)],
        *[F.count_if(~s).alias(f"n_{i}") for i, s in enumerate(same)],
    )
    return one.select(F.inline(F.array(*[
        F.struct(
            F.lit(current).alias("score"),
            F.coalesce(F.col(f"all_{i}"), F.lit(True)).alias("all_close"),
            F.col(f"n_{i}").alias("mismatches"),
        )
        for i, (current, _) in enumerate(pairs)
    ])))


GROUP = 16


def column_mismatches(joined: DataFrame, pairs: Pairs, tolerance: float = TOLERANCE, equal_nan: bool = False) -> DataFrame:
    """Rows (score, mismatches) for any number of shared columns, from one scan.

    Columns are taken ``GROUP`` at a time: where the hashes of both sides agree
    and no value is missing, the group has no mismatch and is not compared.  Only
    the differing columns of the other groups become rows, which are counted per
    task before the shuffle.
    """
    groups = []
    for i in range(0, len(pairs), GROUP):
        own = pairs[i:i + GROUP]
        a, b = _values([x for x, _ in own]), _values([y for _, y in own])
        unlike = (F.xxhash64(*a) != F.xxhash64(*b)) | _any_missing(a) | _any_missing(b)
        rows = F.array(*[F.struct(F.lit(x).alias("score"), close(x, y, tolerance, equal_nan).alias("same")) for x, y in own])
        groups.append(F.when(unlike, F.transform(F.filter(rows, lambda r: ~r["same"]), lambda r: r["score"])).otherwise(F.expr("cast(array() as array<string>)")))
    found = joined.select(F.explode(F.concat(*groups)).alias("score")).groupBy("score").agg(F.count("*").alias("mismatches"))
    every = joined.sparkSession.createDataFrame([(x,) for x, _ in pairs], "score string")
    return every.join(found, "score", "left").select("score", F.coalesce("mismatches", F.lit(0)).alias("mismatches"))


def rounded_equal(a: str, b: str, digits: int = 2) -> Column:
    """Equality after rounding; a missing value is unequal."""
    return F.coalesce(F.round(a, digits) == F.round(b, digits), F.lit(False))


def null_pattern_rows(joined: DataFrame, left: str, right: str) -> DataFrame:
    """Rows where ``left`` is missing and ``right`` is not."""
    return joined.filter(missing(F.col(left)) & ~missing(F.col(right)))


def without_differing(joined: DataFrame, key: str | Sequence[str], pair: tuple[str, str], tolerance: float = TOLERANCE) -> DataFrame:
    """Rows of ids that never differ in ``pair``, for comparing the rest again."""
    bad = mismatches(joined, key, pair, tolerance).select(*key_list(key)).distinct()
    return joined.join(bad, key_list(key), "left_anti")


def absolute_differences(joined: DataFrame, pairs: Pairs, missing_as: float | None = None) -> DataFrame:
    """Columns |current - legacy| named ``<legacy>_diff``."""
    def value(name: str) -> Column:
        c = F.col(name).cast("double")
        return c if missing_as is None else F.nanvl(F.coalesce(c, F.lit(missing_as)), F.lit(missing_as))

    return joined.select(*[
        F.abs(value(a) - value(b)).alias(b.removesuffix("_R") + "_diff") for a, b in pairs
    ])


def compare_descriptions(current: DataFrame, legacy: DataFrame, pairs: Pairs) -> DataFrame:
    """Summary statistics of both runs next to each other, one row per score."""
    names = F.create_map(*[F.lit(x) for a, b in pairs for x in (b, a)])
    left = describe(current, [a for a, _ in pairs]).withColumnRenamed("column", "score")
    right = describe(legacy, [b for _, b in pairs]).withColumn("score", names[F.col("column")])
    stats = ["count", "mean", "stddev", "min", "max"]
    return left.join(
        right.select("score", *[F.col(s).alias(f"legacy_{s}") for s in stats]), "score"
    ).select("score", *stats, *[f"legacy_{s}" for s in stats])


# ------------------------------------------------------------------ histograms


def bin_ranges(legacy: DataFrame, columns: Sequence[str], margin: float = 1e-4) -> dict[str, tuple[float, float]]:
    """Histogram range of every legacy score: minimum and maximum, widened by ``margin``."""
    slim = [F.col(c).cast("double") for c in columns]
    row = legacy.agg(*[
        f(F.when(~F.isnan(x), x)).alias(f"{n}{i}")
        for i, x in enumerate(slim) for n, f in (("low", F.min), ("high", F.max))
    ]).first()
    return {
        c: (row[f"low{i}"] - margin, row[f"high{i}"] + margin)
        for i, c in enumerate(columns) if row[f"low{i}"] is not None
    }


def _with_bin(df: DataFrame, bins: int) -> DataFrame:
    """Replace (value, low, high) by an equal-width ``bin``.

    0 ... bins-1 inside the range, -1 below it, ``bins`` above it, NULL if the
    value is missing.  The division only proposes a bin; comparing with the
    bin's own edges settles values on or next to an edge.  The steps are
    separate projections, so that each is evaluated once per row.
    """
    x, guess = F.col("value"), F.col("guess")
    inside = F.least(F.greatest(F.col("bin"), F.lit(0)), F.lit(bins - 1))
    return (
        df.withColumn("step", (F.col("high") - F.col("low")) / bins)
        .withColumn("guess", F.floor((x - F.col("low")) / F.col("step")))
        .withColumn("bin", guess
                    - F.when(x < guess * F.col("step") + F.col("low"), 1).otherwise(0)
                    + F.when(x >= (guess + 1) * F.col("step") + F.col("low"), 1).otherwise(0))
        .withColumn("bin", F.when(missing(x), None).when(x < F.col("low"), -1).when(x > F.col("high"), bins)
                    .otherwise(inside).cast("int"))
        .drop("value", "low", "high", "step", "guess")
    )


def _binned(df: DataFrame, columns: dict[str, str], ranges: dict[str, tuple[float, float]], side: str) -> DataFrame:
    """(score, value, low, high, side) rows; ``columns`` maps score name to this side's column."""
    rows = F.array(*[
        F.struct(
            F.lit(score).alias("score"), F.col(c).cast("double").alias("value"),
            F.lit(ranges[score][0]).alias("low"), F.lit(ranges[score][1]).alias("high"),
        )
        for score, c in columns.items()
    ])
    return df.select(F.inline(rows), F.lit(side).alias("side")).filter(~missing(F.col("value")))


def bin_differences(current: DataFrame, legacy: DataFrame, pairs: Pairs, bins: int = 100, margin: float = 1e-4) -> DataFrame:
    """Rows (score, bin, current_count, legacy_count, diff) for bins the legacy run fills.

    ``current_count`` and ``diff`` are NULL where the current run has no rows.
    Both runs are counted by one partial aggregate and one small shuffle.
    """
    by_legacy = bin_ranges(legacy, [b for _, b in pairs], margin)
    ranges = {a: by_legacy[b] for a, b in pairs if b in by_legacy}
    stacked = _binned(current, {a: a for a in ranges}, ranges, "current").unionAll(
        _binned(legacy, {a: b for a, b in pairs if a in ranges}, ranges, "legacy")
    )
    counted = _with_bin(stacked, bins).groupBy("score", "bin").agg(
        F.count(F.when(F.col("side") == "current", 1)).alias("n"),
        F.count(F.when(F.col("side") == "legacy", 1)).alias("legacy_count"),
    )
    n = F.when(F.col("n") > 0, F.col("n"))
    return counted.filter(F.col("legacy_count") > 0).select(
        "score", "bin", n.alias("current_count"), "legacy_count",
        F.abs(n - F.col("legacy_count")).alias("diff"),
    )


def bin_matrix(differences: DataFrame, scores: Sequence[str], bins: int = 100) -> DataFrame:
    """One row per bin 0 ... bins-1 and one ``<score>_diff`` column per score."""
    spread = differences.groupBy("bin").agg(*[
        F.max(F.when(F.col("score") == s, F.col("diff"))).cast("double").alias(f"{s}_diff") for s in scores
    ])
    spine = differences.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(spread, "bin", "left")


def moved_share(differences: DataFrame, run: DataFrame) -> DataFrame:
    """Rows (score, moved, percent): rows that changed bin, in percent of the rows of ``run``."""
    moved = F.coalesce(F.sum("diff"), F.lit(0))
    total = run.agg(F.count("*")).scalar()
    return differences.groupBy("score").agg(moved.alias("moved")).select("score", "moved", (F.col("moved") * 100 / total).alias("percent"))


def distribution(df: DataFrame, column: str, low: float, high: float, bins: int = 100) -> DataFrame:
    """Row count per bin of one score, in bin order."""
    values = df.select(F.col(column).cast("double").alias("value"), F.lit(low).alias("low"), F.lit(high).alias("high"))
    return _with_bin(values, bins).groupBy("bin").count().orderBy("bin")


