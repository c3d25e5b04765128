"""Credit attributes of an application and the price tier of a score."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scorefold.functions import kernels as K
from scorefold.functions import rules
from scorefold.operators.tax import monthly_income


def attribute_aliases(**sources: str) -> dict[str, str]:
    """Attribute columns; keyword arguments replace a source column."""
    unknown = set(sources) - set(rules.ATTRIBUTE_SOURCES)
    if unknown:
        raise ValueError(f"unknown attributes: {', '.join(sorted(unknown))}")
    return rules.ATTRIBUTE_SOURCES | sources


def tradeline_ndi(income: str, housing: str) -> str:
    """Disposable income from payments as reported: only NULL becomes 0, negative codes stay."""
    return " - ".join([monthly_income(income), K.null_to("V71_REAP01", 0.0), K.null_to("V71_INAP01", 0.0), housing])


def add_tradeline_ndi(df: DataFrame, income: str, housing: str = "HPE_Housing_Payment_Estimation") -> DataFrame:
    ndi = tradeline_ndi(income, housing)
    return K.with_sql(df, {"MonthlyIncome": monthly_income(income), "Tradeline_NDI": ndi, "CPg_NDI": ndi})


def cleaned_inputs(aliases: dict[str, str]) -> dict[str, str]:
    """Inputs of the derived attributes without their negative codes."""
    return {
        "CPv5_5_SNC_RevolvingBalance": K.floor_at(aliases["CPg_RevolvingBalance"], 0.0),
        "CPv5_5_SNC_UILBalance": K.floor_at(aliases["CPg_UILBalance"], 0.0),
        "CPv5_5_SNC_NonMortgageMonthlyPayment": K.floor_at(aliases["CPg_NonMortgageMonthlyPayment"], 0.0),
        "CPv5_5_SNC_V71_BC03S": K.not_above("V71_BC03S", 0, -1.0),
        "CPv5_5_SNC_V71_BC25S": K.not_above("V71_BC25S", 0, -1.0),
        "CPv5_5_SNC_W55_TRV01": K.not_above("W55_TRV01", 1, 1.0),
        "CPv5_5_SNC_W55_TRV02": K.case(
            [("W55_TRV02 <= -1", "0D"), ("W55_TRV02 > 12", "12D")], "W55_TRV02"
        ),
    }


def derived_columns() -> dict[str, str]:
    """Ratios of balances, payments, income and the requested loan."""
    loan, balance, income = "CPg_RequestedLoanAmount", "CPg_UnsecuredSummaryBalance", "CPg_Income"
    extra = K.positive_part(f"({loan} - {balance})")
    bti = K.ratio(balance, income)
    dti = K.ratio("(CPv5_5_SNC_NonMortgageMonthlyPayment + CPg_HousingPayment)", income)
    new_cards = f"(1 - {K.ratio('CPv5_5_SNC_V71_BC25S', 'CPv5_5_SNC_V71_BC03S')})"
    # No balance, or an unknown one, makes the ratio infinite.
    ratio = K.case([(f"{balance} != 0", K.ratio(loan, balance))], K.INF)
    return {
        "CPg_LieDetectorRatio": ratio,
        "CPg_LieDetectorDiff": f"{loan} - {balance}",
        "CPg_LieDetectorHigh": K.case([(f"{ratio} >= 1", f"1 - {K.ratio(balance, loan)}")], "0D"),
        "CPg_NdiWithLieDetector": f"CPg_NDI - {extra} * {K.literal(rules.LIE_DETECTOR_PAYMENT_FACTOR)}",
        "CPg_MonthlyDti": f"{dti} * 12",
        "CPg_Bti": bti,
        "CPg_BtiWithLieDetector": f"{bti} + {K.ratio(extra, income)}",
        "CPg_PctNewBCTradesInPast12mo": K.cap(new_cards, 1.0),
        "CPg_OverlimitTrend": K.ratio("CPv5_5_SNC_W55_TRV02", "CPv5_5_SNC_W55_TRV01"),
        "CPg_W55_AGG910_UNF": K.flag("W55_AGG910 < 0"),
    }


def add_credit_attributes(
    df: DataFrame,
    income: str = "PIE_Income_Estimation",
    housing: str = "HPE_Housing_Payment_Estimation",
    **sources: str,
) -> DataFrame:
    """Aliases, tradeline disposable income, derived attributes and short names."""
    aliases = attribute_aliases(**({"CPg_Income": income, "CPg_HousingPayment": housing} | sources))
    cleaned = cleaned_inputs(aliases)
    balance = f"{cleaned['CPv5_5_SNC_RevolvingBalance']} + {cleaned['CPv5_5_SNC_UILBalance']}"
    ndi = tradeline_ndi(income, housing)
    first = aliases | cleaned | {
        "MonthlyIncome": monthly_income(income), "Tradeline_NDI": ndi, "CPg_NDI": ndi,
        "CPg_UnsecuredSummaryBalance": balance,
    }
    return K.with_layers(df, [first, derived_columns(), rules.ATTRIBUTE_SHORT_NAMES])


def apply_tier(df: DataFrame, score: str = "CM_Credit_Model_Score", output: str = "PricingTier_v6") -> DataFrame:
    """Price tier 1 (best) to 6; a missing score is tier 6."""
    return K.with_sql(df, {output: K.tier(score, rules.TIER_UPPER_BOUNDS)})
