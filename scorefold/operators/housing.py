"""Housing payment estimate: the larger of a rent and a mortgage regression."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scorefold.functions import kernels as K
from scorefold.functions import rules


def rent_estimate(income: str, median_rental: str) -> str:
    terms = [f"{income} * {K.literal(rules.RENT_INCOME_COEFFICIENT)}"]
    for name, weight in rules.RENT_COEFFICIENTS:
        x = K.null_to(name, rules.RENT_G208S_MISSING) if name == "V71_G208S" else name
        terms.append(f"{x} * {K.literal(weight)}")
    return f"{median_rental} * exp({' + '.join(terms)} + {K.literal(rules.RENT_INTERCEPT)})"


def mortgage_estimate(income: str) -> str:
    terms = [f"{income} * {K.literal(rules.MORTGAGE_INCOME_COEFFICIENT)}"]
    terms += [f"{K.null_to(name, 0.0)} * {K.literal(weight)}" for name, weight in rules.MORTGAGE_COEFFICIENTS]
    return f"{' + '.join(terms)} + {K.literal(rules.MORTGAGE_INTERCEPT)}"


def estimate_housing(
    df: DataFrame,
    income: str = "PIE_Income_Estimation",
    median_rental: str = "MedianRental",
    output: str = "HPE_Housing_Payment_Estimation",
    missing: str = "maximum",
) -> DataFrame:
    """Both estimates are held to the range [250, 10000]; the larger one is the payment.

    ``missing`` says what an estimate without inputs counts as: ``"maximum"``
    (10000, the deployed model's rule) or ``"skip"`` (the other estimate's
    mortgage is used, the older column form's rule).
    """
    if missing not in ("maximum", "skip"):
        raise ValueError("missing must be 'maximum' or 'skip'")
    low, high = rules.HOUSING_RANGE

    def held(x: str) -> str:
        x = K.clip(x, low, high)
        return K.null_to(x, high) if missing == "maximum" else x

    return K.with_layers(df, [
        {"_rent": rent_estimate(income, median_rental), "_mortgage": mortgage_estimate(income)},
        {output: K.case([(f"{held('_rent')} > {held('_mortgage')}", held("_rent"))], held("_mortgage"))},
    ]).drop("_rent", "_mortgage")
