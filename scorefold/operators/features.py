"""Features shared by the response, approval and funding models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold.functions import kernels as K
from scorefold.functions import rules
from scorefold.operators.joins import join_dimension


def _as_date(kinds: dict[str, str], column: str, pattern: str) -> str:
    """A column that already is a date passes, so the step can be applied twice."""
    return column if kinds[column.lower()] == "date" else K.parse_date(column, pattern)


def _months_since(as_of: str, applied: str) -> str:
    """A date equal to the stand-in for "never" counts as never."""
    never = f"{applied} = DATE '{rules.NEVER_APPLIED_DATE}'"
    return K.case([(never, K.literal(rules.NEVER_APPLIED_MONTHS))], K.whole_months_between(as_of, applied))


def recency_layers(df: DataFrame) -> list[dict[str, str]]:
    kinds = {name.lower(): kind for name, kind in df.dtypes}
    never = f"DATE '{rules.NEVER_APPLIED_DATE}'"
    onsite, partner = "months_since_last_onsite_application", "months_since_last_partner_application"
    return [
        {
            "CREDITASOFDATE": _as_date(kinds, "creditAsOfDate", "yyyyMMdd"),
            "LAST_ONSITE_APPLIED_DATE": f"coalesce({_as_date(kinds, 'last_applied_date', 'yyyy-MM-dd')}, {never})",
            "LAST_PARTNER_APPLIED_DATE":
                f"coalesce({_as_date(kinds, 'last_partner_applied_date', 'yyyy-MM-dd')}, {never})",
        },
        {
            onsite: _months_since("CREDITASOFDATE", "LAST_ONSITE_APPLIED_DATE"),
            partner: _months_since("CREDITASOFDATE", "LAST_PARTNER_APPLIED_DATE"),
        },
        {"months_since_last_application": K.case([(f"{partner} > {onsite}", onsite)], partner)},
    ]


def add_application_recency(df: DataFrame) -> DataFrame:
    """Months since the last application on the site, at a partner, and on either.

    ``CREDITASOFDATE`` and ``LAST_PARTNER_APPLIED_DATE`` replace the raw
    columns of the same name, because column names ignore case.
    """
    return K.with_layers(df, recency_layers(df))


def counter_columns() -> dict[str, str]:
    tags = [f"previous6Tag{i}" for i in range(1, 6)]
    return {f"PREVIOUS_COUNTER_{n}": K.value_to_nan(K.count_equal(tags[:n], "Y"), 0) for n in (5, 4, 3, 1)}


def add_selection_counters(df: DataFrame) -> DataFrame:
    """How often the consumer was selected in the last 5, 4, 3 and 1 campaigns; 0 becomes NaN."""
    return K.with_sql(df, counter_columns())


def funding_columns() -> dict[str, str]:
    """Cleaned and capped inputs of the funding model."""
    columns = {}
    for name, high in rules.FUNDING_PROCESSED:
        top = [] if high is None else [(f"{name} > {K.literal(high)}", K.literal(high))]
        columns[f"{name}_Processed"] = K.case([*top, (f"{name} IS NULL OR {name} < 0", "0D")], name)
    return columns | {
        "CCAprEst": K.clip_apr(K.annual_rate("W49_ATTR08", "W49_ATTR07")),
        "CCAprEst_revolving": K.clip_apr(K.annual_rate("V71_REAP01", "V71_RE101S")),
        "MeanIncome_Processed": K.clip("MeanIncome", *rules.MEAN_INCOME_RANGE),
        "no_student_trades": K.flag("V71_ST02S = -1"),
        "W55_PAYMNT08_FRM": K.impute(
            "W55_PAYMNT08", rules.MINIMUM_PAYMENT_DEFAULT, rules.MINIMUM_PAYMENT_CODES
        ),
        "MONTHS_SINCE_LAST_APPLICATION_ONSITE": K.value_to_nan(
            "months_since_last_onsite_application", rules.NEVER_APPLIED_MONTHS
        ),
    }


def add_funding_features(df: DataFrame) -> DataFrame:
    """Inputs of the funding model.  Needs the recency columns."""
    return K.with_sql(df, funding_columns())


def add_state_label(
    df: DataFrame, state: str = "NCOA_ADDR_State", output: str = "state_label_5_FR", groups=rules.STATE_LABEL_GROUPS
) -> DataFrame:
    """Group number of the state; NaN for states in no group."""
    return K.with_sql(df, {output: K.label_by_group(state, groups)})


def add_legacy_state_labels(df: DataFrame, state: str = "NCOA_ADDR_State") -> DataFrame:
    return K.with_sql(df, {
        "state_label_5": K.label_by_group(state, rules.LEGACY_STATE_LABEL_GROUPS),
        "state_label_5_FR_v6": K.label_by_group(state, rules.STATE_LABEL_GROUPS),
    })


def add_reusable_features(df: DataFrame) -> DataFrame:
    """Recency, counters, funding inputs and state label in one chain."""
    label = {"state_label_5_FR": K.label_by_group("NCOA_ADDR_State", rules.STATE_LABEL_GROUPS)}
    *dates, combined = recency_layers(df)
    return K.with_layers(df, [*dates, combined | counter_columns() | funding_columns() | label])


# ---------------------------------------------------- encodings of income v4


def target_encode(df: DataFrame, column: str, means: DataFrame, output: str | None = None) -> DataFrame:
    """Replace a value by its mean from a (value, mean) table; unknown values stay NULL."""
    output = output or f"te_{column}"
    side = means.select(F.col("value").alias(column), F.col("mean").alias(output))
    return join_dimension(df, side, column, "left")


def first_categories(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """The smallest present value of each column, from one aggregate."""
    slim = [F.col(c).cast("double") for c in columns]
    row = df.agg(*[F.min(F.when(~F.isnan(x), x)).alias(f"c{i}") for i, x in enumerate(slim)]).first()
    return {c: row[f"c{i}"] for i, c in enumerate(columns) if row[f"c{i}"] is not None}


def one_hot(df: DataFrame, columns: Sequence[str], required: Sequence[str] = rules.ONE_HOT_REQUIRED, drop_first: bool = True) -> DataFrame:
    """The 0/1 columns ``required``, named ``<column>_<value>``, in place of ``columns``.

    With ``drop_first`` the smallest value of a column in the data has no column
    of its own: its flag is constantly 0, like that of a value that never occurs.
    Any number of categories will do, for no list of them is made.
    """
    first = first_categories(df, columns) if drop_first else {}
    flags = {}
    for flag in required:
        name, _, value = flag.rpartition("_")
        dropped = name not in columns or first.get(name) == float(value)
        flags[flag] = "0" if dropped else K.flag(f"{K.quoted(name)} = {K.literal(float(value))}")
    return K.with_sql(df, flags).drop(*columns)
