"""Expression kernels: imputation, clipping, ratios, dates, labels.

A kernel takes the SQL text of an expression, usually a column name, and
returns SQL text.  ``with_sql`` adds such expressions to a DataFrame.  Text is
used because a run adds hundreds of rule-driven columns: Spark parses one
expression much faster than a client can assemble its nodes one by one.
Everything stays inside whole-stage code generation.

Three encodings of "missing" are kept apart: SQL NULL, NaN, and the bureau's
negative codes -1 ... -6.  Spark sorts NaN above every number, so ``x > cap``
is true for NaN.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAN = "double('NaN')"
INF = "double('Infinity')"
SENTINELS = (-6, -5, -4, -3, -2, -1)


def literal(value) -> str:
    """SQL text of a Python value; floats keep their exact double value."""
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return NAN
        if math.isinf(value):
            return INF if value > 0 else f"(-{INF})"
        return f"{value!r}D"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(name: str) -> str:
    """A column by its exact name, also if the name contains a dot or a minus."""
    return f"`{name.replace('`', '``')}`"


def with_sql(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add or replace columns in one projection; all expressions see the old columns."""
    return df.withColumns({name: F.expr(sql) for name, sql in columns.items()})


def with_layers(df: DataFrame, layers: Iterable[Mapping[str, str]]) -> DataFrame:
    """Add columns layer by layer; a layer sees the columns of the layers before it."""
    for layer in layers:
        df = with_sql(df, layer)
    return df


def case(branches: Iterable[tuple[str, str]], otherwise: str | None = None) -> str:
    whens = " ".join(f"WHEN {condition} THEN {value}" for condition, value in branches)
    return f"CASE {whens} ELSE {otherwise} END" if otherwise is not None else f"CASE {whens} END"


# ---------------------------------------------------------------- imputation


def impute(x: str, default: float, codes: Mapping[int | tuple[int, ...], float] | None = None) -> str:
    """NULL or negative becomes ``default``; ``codes`` give a code its own value."""
    branches = []
    for code, value in (codes or {}).items():
        members = code if isinstance(code, tuple) else (code,)
        branches.append((f"{x} IN ({', '.join(map(str, members))})", literal(value)))
    branches.append((f"{x} IS NULL OR {x} < 0", literal(default)))
    return case(branches, x)


def replace_sentinels(x: str, value: float) -> str:
    """The codes -6 ... -1 become ``value``; NULL stays NULL."""
    return case([(f"{x} IN ({', '.join(map(str, SENTINELS))})", literal(value))], x)


def negative_to_null(x: str) -> str:
    return case([(f"{x} >= 0", x)])


def null_to(x: str, value) -> str:
    return f"coalesce({x}, {literal(value)})"


def value_to_nan(x: str, value) -> str:
    """``value`` becomes NaN, everything else a double; NULL stays NULL."""
    return case([(f"{x} = {literal(value)}", NAN)], f"CAST({x} AS DOUBLE)")


# ------------------------------------------------------------------ clipping


def cap(x: str, high: float) -> str:
    """Upper bound as CASE: NULL stays NULL (``least`` would drop it), NaN -> high."""
    return case([(f"{x} > {literal(high)}", literal(high))], x)


def floor_at(x: str, low: float) -> str:
    return case([(f"{x} < {literal(low)}", literal(low))], x)


def clip(x: str, low: float, high: float) -> str:
    return case([(f"{x} > {literal(high)}", literal(high)), (f"{x} < {literal(low)}", literal(low))], x)


def not_above(x: str, limit: float, value: float) -> str:
    """``x <= limit`` becomes ``value``."""
    return case([(f"{x} <= {literal(limit)}", literal(value))], x)


def positive_part(x: str) -> str:
    """max(x, 0) where a missing x counts as 0."""
    return case([(f"{x} > 0", x)], "0D")


def flag(condition: str, hit: int = 1, miss: int = 0) -> str:
    """A condition that is NULL counts as a miss."""
    return case([(condition, literal(hit))], literal(miss))


def ratio(numerator: str, denominator: str) -> str:
    """Division that gives NULL for a zero divisor."""
    return f"try_divide({numerator}, {denominator})"


def annual_rate(payment: str, balance: str) -> str:
    """Yearly rate implied by a monthly payment, less 12 points of principal."""
    return f"({ratio(payment, balance)} * 12 - 0.12D)"


def clip_apr(x: str) -> str:
    """An estimate above 1, below 0 or missing is unusable (0); else at most 0.25."""
    return case([(f"{x} IS NULL OR {x} > 1 OR {x} < 0", "0D"), (f"{x} > 0.25D", "0.25D")], x)


def scrub_rate(x: str, high: float = 0.30) -> str:
    """Negative, NaN, NULL and infinite rates become 0; the rest at most ``high``."""
    bad = f"{x} IS NULL OR isnan({x}) OR {x} < 0 OR {x} = {INF}"
    return case([(bad, "0D"), (f"{x} > {literal(high)}", literal(high))], x)


# ------------------------------------------------------------ dates and times


def parse_date(x: str, pattern: str) -> str:
    """A date in ``pattern``; text after the pattern's length is ignored, bad text -> NULL."""
    text = f"substring(CAST({x} AS STRING), 1, {len(pattern)})"
    return f"to_date(try_to_timestamp({text}, '{pattern}'))"


def whole_months_between(later: str, earlier: str) -> str:
    """Days / 30, truncated towards zero."""
    return f"CAST(datediff({later}, {earlier}) / 30 AS INT)"


def age_in_years(birth_yyyymm: str, as_of: str, missing: str = "196008") -> str:
    """Age on the date ``as_of`` from text starting with ``yyyyMM``; missing births use ``missing``."""
    text = f"coalesce(substring(CAST({birth_yyyymm} AS STRING), 1, 6), '{missing}')"
    return f"round(datediff({as_of}, {parse_date(text, 'yyyyMM')}) / 365)"


def epoch_seconds(ts: str) -> str:
    return f"CAST(unix_timestamp(CAST({ts} AS TIMESTAMP)) AS INT)"


def month_partition(ts: str) -> str:
    return f"date_format({ts}, 'yyyy-MM')"


def is_weekend(ts: str, zone: str = "America/New_York") -> str:
    """1 on Saturday and Sunday of the wall clock in ``zone``."""
    wall = f"convert_timezone(current_timezone(), '{zone}', CAST({ts} AS TIMESTAMP_NTZ))"
    return f"CAST(weekday({wall}) >= 5 AS INT)"


def ceil_to_minutes(ts: str, minutes: int) -> str:
    """Epoch second of the next multiple of ``minutes`` at or after ``ts``."""
    micros = f"unix_micros(CAST({ts} AS TIMESTAMP))"
    return f"CAST(({micros} + pmod(-{micros}, {minutes * 60_000_000}L)) div 1000000 AS INT)"


# ---------------------------------------------------------------- text, label


def clean_zip(x: str) -> str:
    """Five-digit ZIP text: a trailing ``.0`` goes, leading zeros come back."""
    return f"lpad(regexp_replace(trim(CAST({x} AS STRING)), '[.]0$', ''), 5, '0')"


def label_by_group(x: str, groups: Sequence[Iterable[str]]) -> str:
    """Index of the group that holds the value as a double; NaN if none does."""
    return case(
        [(f"{x} IN ({', '.join(map(literal, members))})", literal(float(i))) for i, members in enumerate(groups)], NAN
    )


def count_equal(columns: Sequence[str], value) -> str:
    """How many of ``columns`` equal ``value``; NULL does not."""
    return "(" + " + ".join(flag(f"{c} = {literal(value)}") for c in columns) + ")"


def tier(x: str, upper_bounds: Sequence[float]) -> str:
    """1-based index of the first bound above the score; past all, NULL or NaN -> last."""
    return case(
        [(f"{x} < {literal(bound)}", literal(i)) for i, bound in enumerate(upper_bounds, start=1)],
        literal(len(upper_bounds) + 1),
    )
