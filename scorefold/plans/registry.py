"""Named queries over the driver's tables, each with its check SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from scorefold.functions.kernels import quoted, with_sql
from scorefold.session import configure

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    covers: tuple[str, ...]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its own name; ``covers`` lists operator ids."""
    def register(run: Run) -> Run:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        REGISTRY[run.__name__] = Query(run.__name__, configured, tuple(covers.split()), sql)
        return run

    return register


def with_rounded(df: DataFrame, digits: int = 4, skip: Sequence[str] = (), finer: dict[str, int] | None = None) -> DataFrame:
    """Floating-point columns rounded, so that two engines agree on the last digits.

    ``finer`` gives columns their own number of digits: one at which no exact
    result lies half-way between two rounded values.
    """
    floats = [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in skip
    ]
    return with_sql(df, {c: f"round(CAST({quoted(c)} AS DOUBLE), {(finer or {}).get(c, digits)})" for c in floats})


# ------------------------------------------------------------------ check SQL


def num(x: float) -> str:
    """A DOUBLE literal with the exact value of ``x``."""
    text = repr(float(x))
    return text if "e" in text else f"{text}e0"


def imputed(c: str, default: float, codes: dict | None = None) -> str:
    whens = ""
    for code, value in (codes or {}).items():
        members = code if isinstance(code, tuple) else (code,)
        whens += f" WHEN {c} IN ({', '.join(map(str, members))}) THEN {num(value)}"
    return f"CASE{whens} WHEN {c} IS NULL OR {c} < 0 THEN {num(default)} ELSE {c} END"


def rnd(expr: str, name: str, digits: int = 4) -> str:
    """A rounded output column; adding zero turns -0.0 into 0.0."""
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0e0 AS \"{name}\""


def rnds(names: Sequence[str], digits: int = 4, finer: dict[str, int] | None = None) -> str:
    return ", ".join(rnd(f'"{n}"', n, (finer or {}).get(n, digits)) for n in names)
