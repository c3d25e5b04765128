"""Best-case income: the scoring steps run a second time on the same rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame

from scorefold.functions import kernels as K
from scorefold.functions import rules
from scorefold.operators.projection import apply_steps


def add_best_case_income(
    df: DataFrame,
    estimate: str = "PIE_Income_Estimation",
    reported: str = "lastreportedincome",
    output: str = rules.BEST_CASE_INCOME,
) -> DataFrame:
    """The larger of estimated and reported income; a missing one is skipped."""
    return K.with_sql(df, {output: f"greatest({estimate}, {reported})"})


def add_scenario(
    df: DataFrame,
    steps: Iterable[Callable[[DataFrame], DataFrame]],
    outputs: Sequence[str],
    prefix: str,
    where: str,
) -> DataFrame:
    """Run ``steps`` on ``df`` and keep only ``prefix + output`` columns of the result.

    Both scenarios are computed from one scan: rows outside ``where`` get NULL,
    as a left join with a separate run over the filtered rows would give.
    """
    # Steps may overwrite input columns, so the row's own values go along under names of their own.
    own = [f"{K.quoted('_own_' + c)} AS {K.quoted(c)}" for c in df.columns]
    copies = {f"_own_{c}": K.quoted(c) for c in df.columns}
    result = apply_steps(K.with_sql(df, copies | {"_in_scenario": f"coalesce({where}, FALSE)"}), steps)
    kept = [f"{K.case([('_in_scenario', K.quoted(c))])} AS {K.quoted(prefix + c)}" for c in outputs]
    return result.selectExpr(*own, *kept)
