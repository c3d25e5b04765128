"""Mortgage interest, federal, state and payroll taxes, disposable income."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold.functions import kernels as K
from scorefold.functions import rules
from scorefold.operators.impute import imputed_columns
from scorefold.session import kept


# ------------------------------------------------------------ mortgage, federal


def mortgage_columns(paid: str, term: str, amount: str) -> dict[str, str]:
    """Remaining payments of a mortgage from payments made, its term and amount."""
    left = f"({paid} - {term})"
    months = K.case([(f"{left} < 0", K.literal(float(rules.MORTGAGE_DEFAULT_MONTHS)))], left)
    return {"MortAmnt": amount, "NumMortPayRemaing": months}


def yearly_interest() -> str:
    """Yearly share of the interest still to pay; 0 if unknown or negative.

    With monthly rate r and n payments left, the payments on one dollar are
    n * r / (1 - (1 + r) ** -n), so a year's interest is 12 * (that - 1) / n.
    """
    rate = rules.MORTGAGE_MONTHLY_RATE
    payment = K.ratio(K.literal(rate), f"(1 - pow({K.literal(1 + rate)}, -NumMortPayRemaing))")
    share = f"12 * MortAmnt * ({payment} - {K.ratio('1D', 'NumMortPayRemaing')})"
    return f"greatest({K.null_to(share, 0.0)}, 0D)"


def taxable_income(income: str) -> str:
    reduced = K.case(
        [(f"{income} < {rules.PERSONAL_EXEMPTION_BELOW}", f"{income} - {rules.PERSONAL_EXEMPTION}")], income
    )
    return f"{reduced} - {rules.STANDARD_DEDUCTION} - {yearly_interest()}"


def federal_bracket_taxes(taxable: str = "TaxableIncome") -> dict[str, str]:
    """Tax due inside each federal bracket."""
    edges = [low for low, _ in rules.FEDERAL_BRACKETS] + [None]
    taxes = {}
    for i, (low, rate) in enumerate(rules.FEDERAL_BRACKETS):
        high = edges[i + 1]
        part = f"({taxable} - {low})" if low else taxable
        if high is not None:
            part = K.case([(f"{taxable} > {high}", K.literal(float(high - low)))], part)
        part = f"{part} * {K.literal(rate)}"
        taxes[f"federal_tax_brackets_{i + 1}"] = K.case([(f"{taxable} < {low}", "0D")], part) if low else part
    return taxes


def federal_columns() -> dict[str, str]:
    """FederalTax and its parts; only the first part can be negative, and then the tax is 0."""
    parts = federal_bracket_taxes()
    return parts | {"FederalTax": K.case([("TaxableIncome < 0", "0D")], " + ".join(parts.values()))}


def add_federal_tax(df: DataFrame, income: str) -> DataFrame:
    """Mortgage interest, taxable income and federal tax from imputed columns."""
    return K.with_layers(df, [
        mortgage_columns("W49_ATTR10_Imputed", "V71_MT21S_Imputed", "V71_MT101S_Imputed"),
        {"YearAvgMortInterest": yearly_interest(), "TaxableIncome": taxable_income(income)},
        federal_columns(),
    ])


# ------------------------------------------------------------------ state taxes


@dataclass(frozen=True)
class StateBrackets:
    """A state tax table turned into one row per state, with its brackets as an array.

    The tax is a fold over that array after a one-to-one join, so the applicant
    table is neither multiplied nor grouped, whatever the size of the table.
    """

    table: DataFrame
    deductions: bool = False

    @staticmethod
    def load(rows: DataFrame, deductions: bool = False) -> StateBrackets:
        """Group the control table by state, once for all uses.

        A bracket without a start, or without deductions where they count, holds no money.
        """
        less = "CAST(Standard_Deduction + Personal_Exemption AS DOUBLE)" if deductions else "0D"
        cells = rows.where("State IS NOT NULL").selectExpr(
            "CAST(State AS STRING) AS _state", f"{less} AS less", "CAST(DollarsPreviousTaxed AS DOUBLE) AS prev",
            "coalesce(CAST(MaximumTaxableDollars AS DOUBLE), DOUBLE('Infinity')) AS top", "CAST(Rates AS DOUBLE) AS rate")
        usable = "less IS NOT NULL AND prev IS NOT NULL"
        cell = "named_struct('less', less, 'prev', prev, 'top', top, 'rate', coalesce(rate, 0D))"
        return StateBrackets(kept(cells.groupBy("_state").agg(
            F.expr("min(less) AS _deduction"),
            F.expr(f"coalesce(bool_or({usable} AND rate IS NOT NULL), FALSE) AS _taxed"),
            F.expr(f"sort_array(collect_list(CASE WHEN {usable} THEN {cell} END)) AS _brackets"),
        ), "state_brackets"), deductions)


def bracket_money(base: str, previous: str, maximum: str) -> str:
    """Income inside a bracket: held to [0, maximum]; NULL if income or start is unknown."""
    over = f"({base} - {previous})"
    return K.case([(f"{over} > {maximum}", K.floor_at(maximum, 0.0))], K.floor_at(over, 0.0))


def _fold_layers(income: str) -> tuple[dict[str, str], dict[str, str]]:
    """Money per bracket, then tax and money over all; NULL for a state without a usable bracket."""
    money = bracket_money(f"({income} - b.less)", "b.prev", "b.top")
    total = "aggregate(_money, 0D, (s, m) -> s + {})"
    some = "size(_money) > 0"
    return {"_money": f"transform(_brackets, b -> named_struct('money', {money}, 'rate', b.rate))"}, {
        "StateTax_sum": K.case([(f"_taxed AND {some}", total.format("m.money * m.rate"))]),
        "Money_sum": K.case([(some, total.format("m.money"))]),
    }


def _state_sums_by_rejoin(
    df: DataFrame, rows: DataFrame, income: str, state: str, deductions: bool, key: str
) -> DataFrame:
    """Join every bracket, aggregate per consumer, join back, when a caller asks for it.

    Repeated ids add up and NULL ids disappear in this form.  States without an
    applicant, which a full join would add, have no id and leave again in the
    inner join; so the join is a left one, which can be split at a hot state.
    """
    base = "_income - Standard_Deduction - Personal_Exemption" if deductions else "_income"
    slim = df.select(key, F.col(income).alias("_income"), F.col(state).alias("State"))
    joined = slim.join(rows, "State", "left")
    sums = (
        K.with_layers(joined, [
            {"_base": base}, {"_money": bracket_money("_base", "DollarsPreviousTaxed", "MaximumTaxableDollars")}
        ])
        .groupBy(key)
        .agg(
            F.max("_base").alias("AfterDeduction_max"),
            F.sum(F.col("_money") * F.col("Rates")).alias("StateTax_sum"),
            F.sum("_money").alias("Money_sum"),
        )
    )
    return df.join(sums, key, "inner")


def payroll_columns(base: str) -> dict[str, str]:
    """Social security on income up to a ceiling, medicare on the money taxed."""
    ceiling, rate = rules.SOCIAL_SECURITY_CEILING, K.literal(rules.SOCIAL_SECURITY_RATE)
    full = K.literal(ceiling * rules.SOCIAL_SECURITY_RATE)
    return {
        "SSamt": K.case([(f"{base} > {ceiling}", full)], f"{base} * {rate}"),
        "Medamt": f"Money_sum * {K.literal(rules.MEDICARE_RATE)}",
    }


def state_tax_total(base: str) -> str:
    return " + ".join(["StateTax_sum", *payroll_columns(base).values()])


def add_state_sums(
    df: DataFrame, state_table: DataFrame | StateBrackets, income: str, state: str, deductions: bool, method: str,
    key: str, alongside: dict[str, str] | None = None,
) -> DataFrame:
    """State sums; ``alongside`` are further columns for the same projection."""
    if method == "rejoin":
        df = _state_sums_by_rejoin(df, state_table, income, state, deductions, key)
        return K.with_sql(df, alongside or {})
    prepared = state_table if isinstance(state_table, StateBrackets) else StateBrackets.load(state_table, deductions)
    if prepared.deductions != deductions:
        raise ValueError("the bracket table was loaded with another deductions setting")
    money, sums = _fold_layers(income)
    base = {"AfterDeduction_max": f"{income} - _deduction" if deductions else income}
    joined = df.join(prepared.table, F.col(state) == F.col("_state"), "left")
    return K.with_layers(joined, [money | base | (alongside or {}), sums]).drop(*money, *prepared.table.columns)


def add_state_tax(
    df: DataFrame,
    state_table: DataFrame | StateBrackets,
    income: str,
    state: str = "NCOA_ADDR_State",
    deductions: bool = False,
    method: str = "fold",
    key: str = "PPPCL_CONSUMER_ID",
) -> DataFrame:
    """State income tax plus payroll taxes; an unknown state gives NULL.

    ``method="fold"`` does not group the applicants and gives each row its own
    tax.  ``method="rejoin"`` is the join and aggregate form of the older library.
    """
    df = add_state_sums(df, state_table, income, state, deductions, method, key)
    base = "AfterDeduction_max"
    return K.with_sql(df, payroll_columns(base) | {"StateTax": state_tax_total(base)})


# ------------------------------------------------------------ disposable income


def monthly_income(income: str, state_tax: str = "StateTax") -> str:
    return f"({income} - FederalTax - ({state_tax})) / 12"


def calculate_ndi(
    df: DataFrame,
    state_table: DataFrame | StateBrackets,
    income: str = "PIE_Income_Estimation",
    state: str = "NCOA_ADDR_State",
    housing: str = "HPE_Housing_Payment_Estimation",
    preprocess: bool = True,
    deductions: bool = False,
    method: str = "fold",
    key: str = "PPPCL_CONSUMER_ID",
) -> DataFrame:
    """Net disposable income after taxes, debt payments and housing.

    Consumer ids are expected to be unique; the default method does not depend
    on them at all.
    """
    raw = imputed_columns(rules.NDI_IMPUTATION)
    imputed = raw if preprocess else {c: K.quoted(c) for c in raw}
    paid, term, amount = (
        imputed[c] if preprocess else K.null_to(c, 0.0)
        for c in ("W49_ATTR10_Imputed", "V71_MT21S_Imputed", "V71_MT101S_Imputed")
    )
    df = K.with_layers(df, [
        {key: f"CAST({key} AS STRING)", state: f"CAST({state} AS STRING)", "Income": income}
        | (imputed if preprocess else {})
        | mortgage_columns(paid, term, amount),
        {"YearAvgMortInterest": yearly_interest(), "TaxableIncome": taxable_income(income)},
    ])
    df = add_state_sums(
        df, state_table, income, state, deductions, method, key, alongside=federal_columns()
    )
    payments = [
        K.null_to("W49_ATTR06_Imputed", 0.0), K.null_to("W49_AUP1003_Imputed", 0.0), "V71_INAP01_Imputed",
        "V71_HIAP01_Imputed", "V71_REAP01_Imputed", housing,
    ]
    base = "AfterDeduction_max"
    monthly = monthly_income(income, state_tax_total(base))
    return K.with_sql(df, payroll_columns(base) | {
        "StateTax": state_tax_total(base),
        "MonthlyIncome": monthly,
        "NDI": " - ".join([monthly, *payments]),
    })
