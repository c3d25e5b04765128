"""Imputation, taxes, credit attributes and model features over applicants."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorefold.functions import kernels as K
from scorefold.functions import rules
from scorefold.operators import aggregates, credit, features, housing, impute, income, projection, tax
from scorefold.operators.joins import append_by_clean_zip, append_zip_data, append_zip_data_keeping_zip, standard_zip_tables
from scorefold.plans.registry import imputed, num, query, rnd, rnds, with_rounded
from scorefold.sources import driver_tables as D
from scorefold.sources.driver_tables import applicants, applicants_sql

ID = "PPPCL_CONSUMER_ID"
INCOME = "PIE_Income_Estimation"
HOUSING = "HPE_Housing_Payment_Estimation"

# ------------------------------------------------------------------ imputation

_NDI_RAW = [c for c, _, _ in rules.NDI_IMPUTATION]
_POLICY_RAW = [c for c, _, _ in rules.POLICY_IMPUTATION]


def _imputed_list(table) -> str:
    return ", ".join(f"{imputed(c, d, codes)} AS \"{c}_Imputed\"" for c, d, codes in table)


@query(
    "IMP-01 IMP-02 IMP-17 FN-08",
    f"SELECT {ID}, {_imputed_list(rules.NDI_IMPUTATION)} FROM ({applicants_sql([ID, *_NDI_RAW])})",
)
def impute_ndi(spark, sf_dir):
    return impute.impute_by_rules(applicants(spark, sf_dir, [ID, *_NDI_RAW])).drop(*_NDI_RAW)


@query(
    "IMP-15 IMP-01 IMP-02",
    f"SELECT {ID}, {_imputed_list(rules.POLICY_IMPUTATION)}, "
    '"V71_IN06S_Imputed" - "V71_ST06S_Imputed" - "V71_AU06S_Imputed" AS high_util_proxy '
    f"FROM ({applicants_sql([ID, *_POLICY_RAW])})",
)
def impute_policy(spark, sf_dir):
    return impute.impute_policy(applicants(spark, sf_dir, [ID, *_POLICY_RAW])).drop(*_POLICY_RAW)


def _limits_sql() -> str:
    parts = []
    for c, kind, args in rules.POLICY_LIMITS:
        q = f'"{c}"'
        expr = {
            "flag_above": lambda a: f"CASE WHEN {q} > {a} THEN 1 ELSE 0 END",
            "flag_from": lambda a: f"CASE WHEN {q} < {a} THEN 0 ELSE 1 END",
            "cap": lambda a: f"CASE WHEN {q} >= {a} THEN {num(a)} ELSE {q} END",
            "clip": lambda a, b: f"CASE WHEN {q} <= {a} THEN {num(a)} WHEN {q} >= {b} THEN {num(b)} ELSE {q} END",
        }[kind](*args)
        parts.append(f"{expr} AS {q}")
    return ", ".join(parts)


_LIMIT_RAW = [c.removesuffix("_Imputed") for c, _, _ in rules.POLICY_LIMITS if c != "NDI"]
_LIMIT_RULES = [t for t in rules.POLICY_IMPUTATION if t[0] in _LIMIT_RAW]


@query(
    "IMP-16 IMP-09 IMP-10",
    f"SELECT {ID}, {_limits_sql()} FROM (SELECT {ID}, {INCOME} / 12 - 3000 AS \"NDI\", "
    f"{_imputed_list(_LIMIT_RULES)} FROM ({applicants_sql([ID, INCOME, *_LIMIT_RAW])}))",
)
def cap_floor_policy(spark, sf_dir):
    df = applicants(spark, sf_dir, [ID, INCOME, *_LIMIT_RAW])
    df = impute.impute_by_rules(df, _LIMIT_RULES).withColumn("NDI", F.col(INCOME) / 12 - 3000)
    return impute.limit_policy(df).drop(INCOME, *_LIMIT_RAW)


_CODES = "(-6, -5, -4, -3, -2, -1)"


@query(
    "IMP-03",
    f"SELECT {ID}, "
    + ", ".join(f"CASE WHEN {c} IN {_CODES} THEN 999e0 ELSE {c} END AS {c}" for c in rules.CREDIT_MODEL_999)
    + f" FROM ({applicants_sql([ID, *rules.CREDIT_MODEL_999])})",
)
def sentinel_999(spark, sf_dir):
    df = applicants(spark, sf_dir, [ID, *rules.CREDIT_MODEL_999])
    return K.with_sql(df, {c: K.replace_sentinels(c, 999.0) for c in rules.CREDIT_MODEL_999})


_LOAN_RAW = [s for _, s, _ in rules.CREDIT_MODEL_LOAN_COLUMNS]
_LONG_CODES = list(dict.fromkeys(projection.bureau_code(n) for n in rules.CREDIT_MODEL_LONG_NAMES))
_CREDIT_RAW = list(dict.fromkeys(_LONG_CODES + list(rules.CREDIT_MODEL_999)))


@query(
    "DM-11 PRJ-06 PRJ-08 IMP-03",
    f"SELECT {ID}, "
    + ", ".join(
        (f"CASE WHEN {c} IN {_CODES} THEN 999e0 ELSE {c} END" if c in rules.CREDIT_MODEL_999 else c) + f' AS "{n}"'
        for n, c in ((n, projection.bureau_code(n)) for n in rules.CREDIT_MODEL_LONG_NAMES)
    )
    + ", "
    + ", ".join(
        f"CASE WHEN {s} IN {_CODES} THEN {num(v)} ELSE {s} END AS {n}" for n, s, v in rules.CREDIT_MODEL_LOAN_COLUMNS
    )
    + f" FROM ({applicants_sql([ID, *_CREDIT_RAW, *_LOAN_RAW])})",
)
def credit_model_inputs(spark, sf_dir):
    df = applicants(spark, sf_dir, [ID, *_CREDIT_RAW, *_LOAN_RAW])
    return impute.impute_credit_model(df).drop(*_CREDIT_RAW, *_LOAN_RAW)


_APR = "12 * W49_ATTR08 / nullif(W49_ATTR07, 0) - 0.12"


@query(
    "IMP-06 IMP-04 DM-21",
    f"SELECT {ID}, {rnd('CASE WHEN x IS NULL OR isnan(x) OR isinf(x) OR x < 0 THEN 0 WHEN x > 0.3 THEN 0.3 ELSE x END', 'CCIntEst')}, "
    "CASE WHEN W55_TRV01 >= 0 THEN W55_TRV01 END AS W55_TRV01, CASE WHEN V71_REAP01 >= 0 THEN V71_REAP01 END AS V71_REAP01 "
    f"FROM (SELECT *, {_APR} AS x FROM ({applicants_sql([ID, 'W49_ATTR07', 'W49_ATTR08', 'W55_TRV01', 'V71_REAP01'])}))",
)
def rate_scrub(spark, sf_dir):
    df = applicants(spark, sf_dir, [ID, "W49_ATTR07", "W49_ATTR08", "W55_TRV01", "V71_REAP01"])
    out = impute.income_v3_inputs(df, ["W55_TRV01", "V71_REAP01"])
    return with_rounded(out.drop("W49_ATTR07", "W49_ATTR08"))


def _apr_sql(pay: str, bal: str, name: str, digits: int = 4) -> str:
    x = f"({pay} / nullif({bal}, 0) * 12 - 0.12)"
    return rnd(f"CASE WHEN {x} IS NULL OR {x} > 1 OR {x} < 0 THEN 0 WHEN {x} > 0.25 THEN 0.25 ELSE {x} END", name, digits)


@query(
    "IMP-07 FN-01",
    f"SELECT {ID}, {_apr_sql('W49_ATTR08', 'W49_ATTR07', 'CCAprEst')}, "
    f"{_apr_sql('V71_REAP01', 'V71_RE101S', 'CCAprEst_revolving')} "
    f"FROM ({applicants_sql([ID, 'W49_ATTR07', 'W49_ATTR08', 'V71_REAP01', 'V71_RE101S'])})",
)
def apr_clip(spark, sf_dir):
    df = applicants(spark, sf_dir, [ID, "W49_ATTR07", "W49_ATTR08", "V71_REAP01", "V71_RE101S"])
    return with_rounded(df.selectExpr(
        ID,
        f"{K.clip_apr(K.annual_rate('W49_ATTR08', 'W49_ATTR07'))} AS CCAprEst",
        f"{K.clip_apr(K.annual_rate('V71_REAP01', 'V71_RE101S'))} AS CCAprEst_revolving",
    ))


@query(
    "IMP-05 IMP-14",
    f"SELECT {ID}, coalesce(V71_REAP01, 0) AS V71_REAP01, coalesce(W55_TRV02, 0) AS W55_TRV02 "
    f"FROM ({applicants_sql([ID, 'V71_REAP01', 'W55_TRV02'])})",
)
def fill_zero(spark, sf_dir):
    return impute.fill_missing(applicants(spark, sf_dir, [ID, "V71_REAP01", "W55_TRV02"]), 0)


# --------------------------------------------------------------------- housing

_HOUSING_RAW = ["MedianRental", INCOME, "V71_AT36S", "V71_G208S", "V71_BC03S", "W55_TRV14", "V71_RT35S", "V71_MT01S", "W49_ATTR09"]


def _held(x: str, missing: str) -> str:
    kept = f"CASE WHEN {x} > 10000 THEN 10000 WHEN {x} < 250 THEN 250 ELSE {x} END"
    return f"coalesce({kept}, 10000)" if missing == "maximum" else kept


def housing_sql(source: str, missing: str = "maximum") -> str:
    """All columns of ``source`` and the housing estimate."""
    rent = (
        f"MedianRental * exp({INCOME} * 5.017e-06 + V71_AT36S * (-0.0001028e0) + coalesce(V71_G208S, -5) * (-0.001778e0) "
        "+ V71_BC03S * (-0.01558e0) + W55_TRV14 * 0.007818e0 + V71_RT35S * 3.578e-05 - 0.897e0)"
    )
    mortgage = (
        f"{INCOME} * 0.003352e0 + coalesce(V71_MT01S, 0) * 17.987879e0 + coalesce(W49_ATTR09, 0) * 0.703487e0 + 32.807283e0"
    )
    return (
        f"SELECT * EXCLUDE (rent0, mort0), CASE WHEN {_held('rent0', missing)} > {_held('mort0', missing)} "
        f"THEN {_held('rent0', missing)} ELSE {_held('mort0', missing)} END AS {HOUSING} "
        f"FROM (SELECT *, {rent} AS rent0, {mortgage} AS mort0 FROM ({source}))"
    )


@query(
    "DM-02 ML-03 FN-03 IMP-09",
    f"SELECT {ID}, {rnd(HOUSING, HOUSING, 6)} FROM ({housing_sql(applicants_sql([ID, *_HOUSING_RAW]))})",
)
def housing_payment(spark, sf_dir):
    df = applicants(spark, sf_dir, [ID, *_HOUSING_RAW])
    return with_rounded(housing.estimate_housing(df).select(ID, HOUSING), 6)


@query(
    "DM-02",
    f"SELECT {ID}, {rnd(HOUSING, 'PHE_v2', 6)} FROM ({housing_sql(applicants_sql([ID, *_HOUSING_RAW]), 'skip')})",
)
def housing_payment_legacy(spark, sf_dir):
    df = applicants(spark, sf_dir, [ID, *_HOUSING_RAW])
    return with_rounded(housing.estimate_housing(df, output="PHE_v2", missing="skip").select(ID, "PHE_v2"), 6)


# ----------------------------------------------------------------------- taxes

_RATE = num(rules.MORTGAGE_MONTHLY_RATE)


def federal_sql(source: str, income: str) -> str:
    """Columns of ``source`` plus mortgage interest, taxable income and FederalTax."""
    pieces = [f"(CASE WHEN taxable > 9075 THEN 9075 ELSE taxable END) * 0.10e0"]
    edges = rules.FEDERAL_BRACKETS
    for i in range(1, len(edges)):
        low, rate = edges[i]
        inner = f"taxable - {low}"
        if i + 1 < len(edges):
            high = edges[i + 1][0]
            inner = f"CASE WHEN taxable > {high} THEN {high - low} ELSE taxable - {low} END"
        pieces.append(f"(CASE WHEN taxable < {low} THEN 0 ELSE ({inner}) * {num(rate)} END)")
    steps = [
        f"SELECT *, {_imputed_list(rules.NDI_IMPUTATION)} FROM ({source})",
        "SELECT *, CASE WHEN W49_ATTR10_Imputed - V71_MT21S_Imputed < 0 THEN 360 "
        "ELSE W49_ATTR10_Imputed - V71_MT21S_Imputed END AS months FROM ({})",
        f"SELECT *, pow(1 + {_RATE}, months) AS growth FROM ({{}})",
        f"SELECT *, V71_MT101S_Imputed * (({_RATE} * months * growth) / nullif(growth - 1, 0) - 1) AS total_interest FROM ({{}})",
        "SELECT *, greatest(coalesce(12 * total_interest / nullif(months, 0), 0), 0) AS interest FROM ({})",
        f"SELECT *, CASE WHEN {income} < 258250 THEN {income} - 4000 ELSE {income} END - 6300 - interest AS taxable FROM ({{}})",
        f"SELECT *, {' + '.join(pieces)} AS fed0 FROM ({{}})",
        "SELECT *, CASE WHEN fed0 < 0 THEN 0 ELSE fed0 END AS \"FederalTax\" FROM ({})",
    ]
    sql = steps[0]
    for step in steps[1:]:
        sql = step.format(sql)
    return sql


def state_sql(source: str, income: str, deductions: bool = False, key: str = ID) -> str:
    """Columns of ``source`` plus the state sums and StateTax."""
    base = f"s.{income}" + (" - b.Standard_Deduction - b.Personal_Exemption" if deductions else "")
    return (
        f"WITH src AS ({source}), br AS ({D.state_brackets_sql()}), j AS ("
        f"SELECT s.{key} AS k, {base} AS base, {base} - b.DollarsPreviousTaxed AS m0, b.MaximumTaxableDollars AS mx, b.Rates AS rate "
        "FROM src s LEFT JOIN br b ON s.NCOA_ADDR_State = b.State), "
        "c AS (SELECT *, CASE WHEN (CASE WHEN m0 > mx THEN mx ELSE m0 END) < 0 THEN 0 ELSE CASE WHEN m0 > mx THEN mx ELSE m0 END END AS money FROM j), "
        "g AS (SELECT k, max(base) AS \"AfterDeduction_max\", sum(money * rate) AS \"StateTax_sum\", sum(money) AS \"Money_sum\" FROM c GROUP BY k) "
        "SELECT src.*, g.* EXCLUDE (k), g.StateTax_sum + (CASE WHEN g.AfterDeduction_max > 113700 THEN 113700 * 0.062e0 "
        "ELSE g.AfterDeduction_max * 0.062e0 END) + g.Money_sum * 0.0145e0 AS \"StateTax\" "
        f"FROM src JOIN g ON src.{key} = g.k"
    )


def ndi_sql(source: str, income: str = INCOME, deductions: bool = False) -> str:
    taxed = state_sql(federal_sql(source, income), income, deductions)
    return (
        "SELECT *, \"MonthlyIncome\" - W49_ATTR06_Imputed - W49_AUP1003_Imputed - V71_INAP01_Imputed - V71_HIAP01_Imputed "
        f"- V71_REAP01_Imputed - {HOUSING} AS \"NDI\" FROM (SELECT *, ({income} - \"FederalTax\" - \"StateTax\") / 12 AS \"MonthlyIncome\" FROM ({taxed}))"
    )


_TAX_RAW = list(dict.fromkeys([ID, "NCOA_ADDR_State", *_HOUSING_RAW, *_NDI_RAW]))
_NDI_OUT = ["FederalTax", "StateTax", "MonthlyIncome", "NDI"]


def ndi_frame(spark, sf_dir, columns=(), income=INCOME, **options):
    needed = list(dict.fromkeys([*_TAX_RAW, *columns]))
    df = housing.estimate_housing(applicants(spark, sf_dir, needed))
    return tax.calculate_ndi(df, D.state_brackets(spark, sf_dir), income=income, **options)


def ndi_source_sql(columns=()) -> str:
    return housing_sql(applicants_sql(list(dict.fromkeys([*_TAX_RAW, *columns]))))


@query(
    "DM-07 FN-04",
    f"SELECT {ID}, {rnd('months', 'NumMortPayRemaing')}, {rnd('interest', 'YearAvgMortInterest', 3)} "
    f"FROM ({federal_sql(applicants_sql([ID, INCOME, *_NDI_RAW]), INCOME)})",
)
def mortgage_interest(spark, sf_dir):
    df = impute.impute_by_rules(applicants(spark, sf_dir, [ID, INCOME, *_NDI_RAW]))
    df = tax.add_federal_tax(df, INCOME)
    return df.select(
        ID, F.round("NumMortPayRemaing", 4).alias("NumMortPayRemaing"),
        F.round("YearAvgMortInterest", 3).alias("YearAvgMortInterest"),
    )


@query(
    "DM-04",
    f"SELECT {ID}, {rnd('taxable', 'TaxableIncome', 3)}, {rnd('FederalTax', 'FederalTax', 3)} "
    f"FROM ({federal_sql(applicants_sql([ID, INCOME, *_NDI_RAW]), INCOME)})",
)
def federal_tax(spark, sf_dir):
    df = impute.impute_by_rules(applicants(spark, sf_dir, [ID, INCOME, *_NDI_RAW]))
    return with_rounded(tax.add_federal_tax(df, INCOME).select(ID, "TaxableIncome", "FederalTax"), 3)


_STATE_OUT = ["AfterDeduction_max", "StateTax_sum", "Money_sum", "StateTax"]
_STATE_RAW = [ID, "NCOA_ADDR_State", INCOME]


@query(
    "DM-05 DM-06 JN-03 AG-01",
    f"SELECT {ID}, {rnds(_STATE_OUT)} FROM ({state_sql(applicants_sql(_STATE_RAW), INCOME)})",
)
def state_tax(spark, sf_dir):
    df = tax.add_state_tax(applicants(spark, sf_dir, _STATE_RAW), D.state_brackets(spark, sf_dir), INCOME)
    return with_rounded(df.select(ID, *_STATE_OUT))


@query(
    "JN-05 JN-03 AG-01",
    f"SELECT {ID}, {rnds(_STATE_OUT)} FROM ({state_sql(applicants_sql(_STATE_RAW), INCOME)})",
)
def state_tax_rejoin(spark, sf_dir):
    df = applicants(spark, sf_dir, _STATE_RAW)
    df = tax.add_state_tax(df, D.state_brackets(spark, sf_dir), INCOME, method="rejoin")
    return with_rounded(df.select(ID, *_STATE_OUT))


@query(
    "JN-04 JN-05",
    f"SELECT {ID}, {rnds(_STATE_OUT)} FROM ({state_sql(applicants_sql(_STATE_RAW), INCOME, deductions=True)})",
)
def state_tax_legacy(spark, sf_dir):
    df = applicants(spark, sf_dir, _STATE_RAW)
    df = tax.add_state_tax(
        df, D.state_brackets(spark, sf_dir), INCOME, deductions=True, method="rejoin"
    )
    return with_rounded(df.select(ID, *_STATE_OUT))


@query(
    "DM-03 DM-06 FN-07",
    f"SELECT {ID}, {rnds(_NDI_OUT, 6)} FROM ({ndi_sql(ndi_source_sql())})",
)
def ndi_base(spark, sf_dir):
    return with_rounded(ndi_frame(spark, sf_dir).select(ID, *_NDI_OUT), 6)


@query(
    "DM-03 JN-04",
    f"SELECT {ID}, {rnds(_NDI_OUT, 6)} FROM ({ndi_sql(ndi_source_sql(), deductions=True)})",
)
def ndi_legacy_deductions(spark, sf_dir):
    return with_rounded(ndi_frame(spark, sf_dir, deductions=True).select(ID, *_NDI_OUT), 6)


# ----------------------------------------------------------- credit attributes

_ATTRIBUTE_RAW = [
    "LAE_Loan_Amount_Estimation", *[f"epay01attr{i}" for i in range(19, 27)], "CEMP08_b_finscr", "V71_BC03S", "V71_BC25S",
    "W55_TRV01", "W55_TRV02", "W55_AGG910",
]


def attributes_sql(ndi: str, income: str = INCOME) -> str:
    """Columns of an NDI query plus the derived attributes under CPg_ names."""
    steps = [
        f"SELECT *, MonthlyIncome - coalesce(V71_REAP01, 0) - coalesce(V71_INAP01, 0) - {HOUSING} AS \"Tradeline_NDI\", "
        "(CASE WHEN epay01attr25 < 0 THEN 0 ELSE epay01attr25 END) + (CASE WHEN epay01attr19 < 0 THEN 0 ELSE epay01attr19 END) AS bal, "
        "CASE WHEN epay01attr24 < 0 THEN 0 ELSE epay01attr24 END AS nonmort, "
        "CASE WHEN V71_BC03S <= 0 THEN -1 ELSE V71_BC03S END AS bc03, CASE WHEN V71_BC25S <= 0 THEN -1 ELSE V71_BC25S END AS bc25, "
        "CASE WHEN W55_TRV01 <= 1 THEN 1 ELSE W55_TRV01 END AS trv01, "
        "CASE WHEN W55_TRV02 <= -1 THEN 0 WHEN W55_TRV02 > 12 THEN 12 ELSE W55_TRV02 END AS trv02 "
        f"FROM ({ndi})",
        "SELECT *, CASE WHEN bal <> 0 THEN LAE_Loan_Amount_Estimation / bal ELSE 'Infinity'::DOUBLE END AS ratio, "
        "LAE_Loan_Amount_Estimation - bal AS diff, CASE WHEN LAE_Loan_Amount_Estimation - bal > 0 THEN LAE_Loan_Amount_Estimation - bal ELSE 0 END AS extra "
        "FROM ({})",
        "SELECT *, bal AS \"CPg_UnsecuredSummaryBalance\", ratio AS \"CPg_LieDetectorRatio\", diff AS \"CPg_LieDetectorDiff\", "
        "CASE WHEN ratio >= 1 THEN 1 - bal / nullif(LAE_Loan_Amount_Estimation, 0) ELSE 0 END AS \"CPg_LieDetectorHigh\", "
        "\"Tradeline_NDI\" - extra * 0.01744269e0 AS \"CPg_NdiWithLieDetector\", "
        f"(nonmort + {HOUSING}) / nullif({income}, 0) * 12 AS \"CPg_MonthlyDti\", bal / nullif({income}, 0) AS \"CPg_Bti\", "
        f"bal / nullif({income}, 0) + extra / nullif({income}, 0) AS \"CPg_BtiWithLieDetector\", "
        "CASE WHEN 1 - bc25 / bc03 > 1 THEN 1 ELSE 1 - bc25 / bc03 END AS \"CPg_PctNewBCTradesInPast12mo\", "
        "trv02 / trv01 AS \"CPg_OverlimitTrend\", CASE WHEN W55_AGG910 < 0 THEN 1 ELSE 0 END AS \"CPg_W55_AGG910_UNF\" FROM ({})",
    ]
    sql = steps[0]
    for step in steps[1:]:
        sql = step.format(sql)
    return sql


_DERIVED = [
    "Tradeline_NDI", "CPg_UnsecuredSummaryBalance", "CPg_LieDetectorRatio", "CPg_LieDetectorDiff", "CPg_LieDetectorHigh",
    "CPg_NdiWithLieDetector", "CPg_MonthlyDti", "CPg_Bti", "CPg_BtiWithLieDetector", "CPg_PctNewBCTradesInPast12mo", "CPg_OverlimitTrend",
]
_FINER = {"Tradeline_NDI": 6, "CPg_NdiWithLieDetector": 2, "NdiWithLieDetector": 2}
_ALIAS_SQL = {
    "CPg_HousingPayment": HOUSING, "CPg_Income": INCOME, "CPg_RequestedLoanAmount": "LAE_Loan_Amount_Estimation",
    "CPg_RevolvingBalance": "epay01attr25", "CPg_UILBalance": "epay01attr19", "CPg_NonMortgageMonthlyPayment": "epay01attr24",
    "CPg_MaxUILUtilization": "epay01attr21", "CPg_DaysSinceOpenedUIL": "epay01attr20", "CPg_DaysSinceUILInquiry": "epay01attr26",
    "CPg_UILAccountsOpenedPast12mo": "epay01attr23", "CPg_OpenUILAccounts": "epay01attr22", "CPg_FicoScore": "CEMP08_b_finscr",
}


def attribute_frame(spark, sf_dir, columns=()):
    df = ndi_frame(spark, sf_dir, [*_ATTRIBUTE_RAW, *columns])
    return credit.add_credit_attributes(df)


@query(
    "DM-08",
    f"SELECT {ID}, {rnd('Tradeline_NDI', 'Tradeline_NDI', 6)} FROM ({attributes_sql(ndi_sql(ndi_source_sql(_ATTRIBUTE_RAW)))})",
)
def tradeline_ndi(spark, sf_dir):
    df = credit.add_tradeline_ndi(ndi_frame(spark, sf_dir), INCOME)
    return with_rounded(df.select(ID, "Tradeline_NDI"), 6)


@query(
    "DM-09 DM-10 PRJ-04 IMP-08 IMP-10",
    f"SELECT {ID}, {rnds(_DERIVED, 3, _FINER)}, CPg_W55_AGG910_UNF, {', '.join(rnd(s, n, 3) for n, s in _ALIAS_SQL.items())}, "
    f"NCOA_ADDR_State AS \"CPg_State\" FROM ({attributes_sql(ndi_sql(ndi_source_sql(_ATTRIBUTE_RAW)))})",
)
def credit_attributes(spark, sf_dir):
    df = attribute_frame(spark, sf_dir)
    return with_rounded(df.select(ID, *_DERIVED, "CPg_W55_AGG910_UNF", *_ALIAS_SQL, "CPg_State"), 3, finer=_FINER)


@query(
    "PRJ-05",
    f"SELECT {ID}, "
    + ", ".join(rnd(_ALIAS_SQL.get(src, f'"{src}"'), short, _FINER.get(short, 3)) for short, src in rules.ATTRIBUTE_SHORT_NAMES.items())
    + f" FROM ({attributes_sql(ndi_sql(ndi_source_sql(_ATTRIBUTE_RAW)))})",
)
def attribute_short_names(spark, sf_dir):
    return with_rounded(attribute_frame(spark, sf_dir).select(ID, *rules.ATTRIBUTE_SHORT_NAMES), 3, finer=_FINER)


# A stand-in score: the balance-to-income ratio spread over the tiers, NULL where it is unknown.
_STAND_IN_SCORE = "CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE CAST(c_custkey % 500 AS DOUBLE) / 1000 END"


def _tier_sql() -> str:
    whens = " ".join(f"WHEN s < {num(b)} THEN {i}" for i, b in enumerate(rules.TIER_UPPER_BOUNDS, 1))
    return f"CASE {whens} ELSE 6 END"


@query(
    "DM-12",
    f"SELECT c_custkey, {_tier_sql()} AS \"PricingTier_v6\" FROM (SELECT c_custkey, {_STAND_IN_SCORE} AS s FROM customer)",
)
def pricing_tier(spark, sf_dir):
    df = D.table(spark, sf_dir, "customer").selectExpr("c_custkey", f"{_STAND_IN_SCORE} AS CM_Credit_Model_Score")
    return credit.apply_tier(df).drop("CM_Credit_Model_Score")


@query(
    "AG-05 SO-01 SO-02",
    f"SELECT \"PricingTier_v6\", count(*) AS \"count\" FROM (SELECT {_tier_sql()} AS \"PricingTier_v6\" "
    f"FROM (SELECT {_STAND_IN_SCORE} AS s FROM customer)) GROUP BY 1 ORDER BY 2 DESC, 1",
)
def tier_counts(spark, sf_dir):
    df = D.table(spark, sf_dir, "customer").selectExpr(f"{_STAND_IN_SCORE} AS CM_Credit_Model_Score")
    counted = aggregates.count_by(credit.apply_tier(df), "PricingTier_v6")
    return counted.orderBy(F.col("count").desc(), "PricingTier_v6")


# -------------------------------------------------------------- model features

_DATES = ["creditAsOfDate", "last_applied_date", "last_partner_applied_date"]


def recency_sql(source: str) -> str:
    def months(c: str) -> str:
        d = f"CAST(coalesce({c}, '2010-01-01') AS DATE)"
        return (
            f"CASE WHEN {d} = DATE '2010-01-01' THEN 999 "
            f"ELSE CAST(trunc(date_diff('day', {d}, DATE '2001-12-31') / 30e0) AS INTEGER) END"
        )

    return (
        "SELECT *, CASE WHEN months_since_last_partner_application > months_since_last_onsite_application "
        "THEN months_since_last_onsite_application ELSE months_since_last_partner_application END AS months_since_last_application "
        f"FROM (SELECT *, {months('last_applied_date')} AS months_since_last_onsite_application, "
        f"{months('last_partner_applied_date')} AS months_since_last_partner_application FROM ({source}))"
    )


_MONTHS = [f"months_since_last_{x}application" for x in ("onsite_", "partner_", "")]


@query(
    "DM-13 FN-09 FN-10 FN-20 IMP-05",
    f"SELECT {ID}, {', '.join(_MONTHS)} FROM ({recency_sql(applicants_sql([ID, *_DATES]))})",
)
def app_recency(spark, sf_dir):
    return features.add_application_recency(applicants(spark, sf_dir, [ID, *_DATES])).select(ID, *_MONTHS)


_TAGS = [f"previous6Tag{i}" for i in range(1, 6)]


def _counter(n: int) -> str:
    total = " + ".join(f"CASE WHEN {t} = 'Y' THEN 1 ELSE 0 END" for t in _TAGS[:n])
    return f"CASE WHEN {total} = 0 THEN 'NaN'::DOUBLE ELSE CAST({total} AS DOUBLE) END AS \"PREVIOUS_COUNTER_{n}\""


_COUNTERS = [f"PREVIOUS_COUNTER_{n}" for n in (5, 4, 3, 1)]


@query(
    "DM-14 AG-15 IMP-11",
    f"SELECT {ID}, {', '.join(_counter(n) for n in (5, 4, 3, 1))} FROM ({applicants_sql([ID, *_TAGS])})",
)
def tag_counters(spark, sf_dir):
    return features.add_selection_counters(applicants(spark, sf_dir, [ID, *_TAGS])).select(ID, *_COUNTERS)


_FUNDING_RAW = [c for c, _ in rules.FUNDING_PROCESSED] + [
    "W49_ATTR07", "W49_ATTR08", "V71_REAP01", "V71_RE101S", "MeanIncome", "V71_ST02S", "W55_PAYMNT08",
]


def _processed(c: str, high: float | None) -> str:
    base = f"CASE WHEN {c} IS NULL OR {c} < 0 THEN 0 ELSE {c} END"
    return base if high is None else f"CASE WHEN {c} > {num(high)} THEN {num(high)} ELSE {base} END"



def funding_sql(digits: int = 4) -> str:
    columns = [rnd(_processed(c, h), f"{c}_Processed", digits) for c, h in rules.FUNDING_PROCESSED]
    columns += [
        _apr_sql("W49_ATTR08", "W49_ATTR07", "CCAprEst", digits),
        _apr_sql("V71_REAP01", "V71_RE101S", "CCAprEst_revolving", digits),
        rnd("CASE WHEN MeanIncome > 500000 THEN 500000 WHEN MeanIncome < 1000 THEN 1000 ELSE MeanIncome END", "MeanIncome_Processed"),
        "CASE WHEN V71_ST02S = -1 THEN 1 ELSE 0 END AS no_student_trades",
        rnd(imputed("W55_PAYMNT08", rules.MINIMUM_PAYMENT_DEFAULT, rules.MINIMUM_PAYMENT_CODES), "W55_PAYMNT08_FRM", max(digits, 5)),
        "CASE WHEN months_since_last_onsite_application = 999 THEN 'NaN'::DOUBLE "
        "ELSE CAST(months_since_last_onsite_application AS DOUBLE) END AS \"MONTHS_SINCE_LAST_APPLICATION_ONSITE\"",
    ]
    return ", ".join(columns)


_FUNDING_OUT = [f"{c}_Processed" for c, _ in rules.FUNDING_PROCESSED] + [
    "CCAprEst", "CCAprEst_revolving", "MeanIncome_Processed", "no_student_trades", "W55_PAYMNT08_FRM",
    "MONTHS_SINCE_LAST_APPLICATION_ONSITE",
]


@query(
    "DM-15 IMP-12 IMP-09",
    f"SELECT {ID}, {funding_sql(5)} FROM ({recency_sql(applicants_sql([ID, *_DATES, *_FUNDING_RAW]))})",
)
def funding_features(spark, sf_dir):
    df = features.add_application_recency(applicants(spark, sf_dir, [ID, *_DATES, *_FUNDING_RAW]))
    return with_rounded(features.add_funding_features(df).select(ID, *_FUNDING_OUT), 5)


def _label_sql(groups, name: str) -> str:
    whens = " ".join(
        f"WHEN NCOA_ADDR_State IN ({', '.join(repr(s) for s in g)}) THEN {float(i)}" for i, g in enumerate(groups)
    )
    return f"CAST(CASE {whens} ELSE 'NaN'::DOUBLE END AS DOUBLE) AS {name}"


@query(
    "DM-16 FN-19",
    f"SELECT {ID}, {_label_sql(rules.STATE_LABEL_GROUPS, 'state_label_5_FR')}, "
    f"{_label_sql(rules.LEGACY_STATE_LABEL_GROUPS, 'state_label_5')}, "
    f"{_label_sql(rules.STATE_LABEL_GROUPS, 'state_label_5_FR_v6')} FROM ({applicants_sql([ID, 'NCOA_ADDR_State'])})",
)
def state_label(spark, sf_dir):
    df = applicants(spark, sf_dir, [ID, "NCOA_ADDR_State"])
    return features.add_legacy_state_labels(features.add_state_label(df)).drop("NCOA_ADDR_State")


@query(
    "DM-19",
    f"SELECT {ID}, {', '.join(_MONTHS)}, {', '.join(_counter(n) for n in (5, 4, 3, 1))}, {funding_sql(5)}, "
    f"{_label_sql(rules.STATE_LABEL_GROUPS, 'state_label_5_FR')} "
    f"FROM ({recency_sql(applicants_sql([ID, 'NCOA_ADDR_State', *_DATES, *_TAGS, *_FUNDING_RAW]))})",
)
def reusable_features(spark, sf_dir):
    df = applicants(spark, sf_dir, [ID, "NCOA_ADDR_State", *_DATES, *_TAGS, *_FUNDING_RAW])
    df = features.add_reusable_features(df)
    return with_rounded(df.select(ID, *_MONTHS, *_COUNTERS, *_FUNDING_OUT, "state_label_5_FR"), 5)


# ------------------------------------------------- renames, projections, joins

_BALANCES = ["V71_RE101S", "V71_IN101S", "V71_HR101S", "V71_AU101S", "V71_ST101S", "epay01attr25", "epay01attr19", "V71_US101S", "V71_BC101S"]
_TRADE = "V71_RE101S + V71_IN101S - V71_HR101S - V71_AU101S - V71_ST101S"


@query(
    "DM-01 PRJ-02 PRJ-03 FN-02",
    f"SELECT {ID}, RECENT_TAG AS eligible_last_month, previous6Tag1 AS \"RECENT_TAG\", {_TRADE} AS \"UnsecuredSummaryBalanceTUVars1\", "
    "epay01attr25 + epay01attr19 AS \"UnsecuredSummaryBalanceCustomVars\", V71_US101S + V71_BC101S AS \"UnsecuredSummaryBalanceTUVars2\", "
    f"greatest({_TRADE}, epay01attr25 + epay01attr19) AS \"UnsecuredSummayBalanceBlend\", "
    + ", ".join(f"CAST(NULL AS DOUBLE) AS \"{c}\"" for c in rules.NULL_DOUBLE_COLUMNS)
    + f" FROM ({applicants_sql([ID, 'RECENT_TAG', 'previous6Tag1', *_BALANCES])})",
)
def new_variables(spark, sf_dir):
    df = applicants(spark, sf_dir, [ID, "RECENT_TAG", "previous6Tag1", *_BALANCES])
    return projection.create_new_variables(df).drop("previous6Tag1", *_BALANCES)


@query(
    "PRJ-01 FN-16 FN-20",
    "SELECT c_custkey AS \"PPPCL_CONSUMER_ID\", c_name AS \"CustomerName\", c_nationkey, c_acctbal AS \"AccountBalance\", "
    "c_mktsegment FROM customer",
)
def rename_vars(spark, sf_dir):
    names = {"c_custkey": "PPPCL_CONSUMER_ID", "c_name": "Customer Name", "c_acctbal": " Account\tBalance "}
    return projection.rename_columns(D.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("C_CustKey"), "c_name", F.col("c_nationkey").alias("C_NATIONKEY"), "c_acctbal", "c_mktsegment"
    ), names)


@query(
    "PRJ-07 PRJ-09",
    f"SELECT {ID}, income AS \"PIE_Income_Estimation\", bal AS \"CM_Credit_Model_Score\", N05_S0Y2, N05_S0Y2 AS \"N05_S0_Y2\", "
    "epay01attr24, epay01attr24 AS \"W49_ATTR24\" FROM "
    f"(SELECT *, PIE_Income_Estimation AS income, epay01attr25 AS bal FROM ({applicants_sql([ID, INCOME, 'epay01attr25', 'epay01attr24', 'N05_S0Y2'])}))",
)
def version_agnostic_names(spark, sf_dir):
    df = applicants(spark, sf_dir, [ID, INCOME, "epay01attr25", "epay01attr24", "N05_S0Y2"])
    old = df.withColumnsRenamed({INCOME: "PIE_v5", "epay01attr25": "Model_v6_Score"})
    return projection.add_approval_names(projection.rename_version_agnostic(old))


@query(
    "PRJ-10 PRJ-11 PRJ-12 PRJ-13 ST-00",
    f"SELECT {ID}, epay01attr19, epay01attr25, epay01attr19 AS bestcase_epay01attr19, epay01attr25 AS bestcase_epay01attr25 "
    f"FROM ({applicants_sql([ID, 'epay01attr19', 'epay01attr25'])})",
)
def column_lists(spark, sf_dir):
    df = applicants(spark, sf_dir, [ID, INCOME, "epay01attr19", "epay01attr25", "RECENT_TAG"])
    loans = projection.matching_columns(df, "epay")
    wanted = projection.column_union([ID], loans)
    kept = df.drop("RECENT_TAG").select(*projection.prefixed(loans, "bestcase_"), *df.columns[:-1])
    return projection.select_columns(kept, [*wanted, *[f"bestcase_{c}" for c in loans]])


_ZIP_ORDER = ("modelling", "population", "incomes", "home_values", "income", "irs")
_ZIP_DROPS = {"home_values": rules.HOME_VALUE_DROPPED, "income": rules.INCOME_DROPPED}


def _zip_sql(names) -> str:
    columns = [c for n in names for c in D.ZIP_TABLE_SQL[n][1] if c not in _ZIP_DROPS.get(n, ())]
    joins = " ".join(
        f"LEFT JOIN ({D.zip_table_sql(n, _ZIP_DROPS.get(n, ()))}) t_{n} ON a.NCOA_ADDR_ZipCode = t_{n}.zipcode" for n in names
    )
    return f"SELECT {ID}, NCOA_ADDR_ZipCode, {', '.join(columns)} FROM ({applicants_sql([ID, 'NCOA_ADDR_ZipCode'])}) a {joins}"


def external_zip_tables(spark, sf_dir, modelling: bool = True):
    t = D.zip_tables(spark, sf_dir)
    five = standard_zip_tables(t["population"], t["incomes"], t["home_values"], t["income"], t["irs"])
    return [t["modelling"], *five] if modelling else five


@query("JN-01", _zip_sql(_ZIP_ORDER))
def zip_append(spark, sf_dir):
    return append_zip_data(applicants(spark, sf_dir, [ID, "NCOA_ADDR_ZipCode"]), external_zip_tables(spark, sf_dir))


@query("JN-02 PRJ-12", _zip_sql(_ZIP_ORDER[1:]))
def zip_append_legacy(spark, sf_dir):
    people = applicants(spark, sf_dir, [ID, "NCOA_ADDR_ZipCode"])
    return append_zip_data_keeping_zip(people, external_zip_tables(spark, sf_dir, modelling=False))


@query(
    "JN-10 FN-17 FN-18",
    "SELECT c_custkey, CAST(c_nationkey * 60 AS STRING) || '.0' AS \"NCOA_ADDR_ZipCode\", CAST(50000 + n_nationkey AS DOUBLE) AS irs_income "
    "FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 3 <> 0) ON c_nationkey = n_nationkey",
)
def zip_cleanup(spark, sf_dir):
    people = D.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "CAST(c_nationkey * 60 AS STRING) || '.0' AS NCOA_ADDR_ZipCode"
    )
    side = D.table(spark, sf_dir, "nation").filter("n_nationkey % 3 <> 0").selectExpr(
        "CAST(n_nationkey * 60 AS STRING) AS RegionName", "CAST(50000 + n_nationkey AS DOUBLE) AS irs_income"
    )
    return append_by_clean_zip(people, side, "NCOA_ADDR_ZipCode", "RegionName")


@query(
    "FLT-02 JN-14",
    f"SELECT {ID}, {INCOME} FROM ({applicants_sql([ID, INCOME])}) WHERE {ID} IN "
    "(SELECT CAST(o_custkey AS STRING) FROM orders WHERE o_orderstatus = 'F')",
)
def id_semi(spark, sf_dir):
    ids = D.table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").selectExpr(f"CAST(o_custkey AS STRING) AS {ID}")
    return projection.keep_ids(applicants(spark, sf_dir, [ID, INCOME]), ids, ID)


@query(
    "FLT-03 JN-14",
    f"SELECT {ID}, {INCOME} FROM ({applicants_sql([ID, INCOME])}) WHERE {ID} NOT IN "
    "(SELECT CAST(o_custkey AS STRING) FROM orders WHERE o_totalprice > 400000)",
)
def id_anti(spark, sf_dir):
    ids = D.table(spark, sf_dir, "orders").filter("o_totalprice > 400000").selectExpr(f"CAST(o_custkey AS STRING) AS {ID}")
    return projection.drop_ids(applicants(spark, sf_dir, [ID, INCOME]), ids, ID)


# ---------------------------------------------------------- income v4 encodings

_AS_OF = "DATE '2022-10-01'"


@query(
    "FN-15 FN-20 UDF-04",
    f"SELECT {ID}, round(date_diff('day', strptime(coalesce(substr(N05_S0Y2, 1, 6), '196008') || '01', '%Y%m%d')::DATE, "
    f"DATE '2022-10-01') / 365e0) AS age FROM ({applicants_sql([ID, 'N05_S0Y2'])})",
)
def age_years(spark, sf_dir):
    df = applicants(spark, sf_dir, [ID, "N05_S0Y2"])
    return df.selectExpr(ID, f"{K.age_in_years('N05_S0Y2', _AS_OF)} AS age")


_MODE_SQL = "(SELECT {c} FROM src WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    "IMP-13 AG-13",
    f"WITH src AS ({applicants_sql([ID, 'W55_RVLR14', 'V71_MT101S', 'V71_REAP01'])}) SELECT {ID}, "
    f"coalesce(W55_RVLR14, {_MODE_SQL.format(c='W55_RVLR14')}) AS \"W55_RVLR14\", "
    "coalesce(V71_MT101S, (SELECT median(V71_MT101S) FROM src)) AS \"V71_MT101S\", "
    "coalesce(V71_REAP01, (SELECT median(V71_REAP01) FROM src)) AS \"V71_REAP01\" FROM src",
)
def impute_median_mode(spark, sf_dir):
    df = applicants(spark, sf_dir, [ID, "W55_RVLR14", "V71_MT101S", "V71_REAP01"])
    return impute.fill_mode_median(df, ["W55_RVLR14"], ["V71_MT101S", "V71_REAP01"])


@query(
    "FN-22",
    f"WITH src AS ({applicants_sql([ID, 'W55_RVLR14', 'epay01attr25'])}), means AS (SELECT W55_RVLR14 AS v, avg(epay01attr25) AS m FROM src "
    "WHERE epay01attr25 >= 100 GROUP BY 1) "
    f"SELECT {ID}, src.W55_RVLR14, {rnd('m', 'te_W55_RVLR14')} FROM src LEFT JOIN means ON src.W55_RVLR14 = means.v",
)
def target_encode(spark, sf_dir):
    df = applicants(spark, sf_dir, [ID, "W55_RVLR14", "epay01attr25"])
    means = df.filter("epay01attr25 >= 100").groupBy(F.col("W55_RVLR14").alias("value")).agg(F.avg("epay01attr25").alias("mean"))
    return with_rounded(features.target_encode(df.drop("epay01attr25"), "W55_RVLR14", means))


_FLAGS = tuple(f"V71_ST02S_{v}" for v in (-5.0, -4.0, -3.0, -2.0, -1.0, 0.0, 1.0, 2.0)) + ("V71_PB06S_9.0",)


@query(
    "FN-23",
    f"SELECT {ID}, "
    + ", ".join(f"CASE WHEN V71_ST02S = {v} AND (SELECT min(V71_ST02S) FROM ({applicants_sql([ID, 'V71_ST02S'])})) <> {v} THEN 1 ELSE 0 END AS \"V71_ST02S_{v}\""
                for v in (-5.0, -4.0, -3.0, -2.0, -1.0, 0.0, 1.0, 2.0))
    + f", 0 AS \"V71_PB06S_9.0\" FROM ({applicants_sql([ID, 'V71_ST02S'])}) a",
)
def one_hot(spark, sf_dir):
    return features.one_hot(applicants(spark, sf_dir, [ID, "V71_ST02S"]), ["V71_ST02S"], _FLAGS)


_V4_MEDIAN = ["V71_MT101S", "V71_REAP01", *[
    c for c in rules.INCOME_V4_FEATURES if c.startswith(("V71_", "W55_", "W49_")) and c not in rules.ONE_HOT_REQUIRED]]
_V4_OTHERS = [*_V4_MEDIAN, *rules.ONE_HOT_COLUMNS, "median_home", "median_rental", "age"]
_V4_FIRST = {c: f"(SELECT min(\"{c}\") FROM f)" for c in rules.ONE_HOT_COLUMNS}


def _income_v4_sql() -> str:
    raw = [ID, "N05_S0Y2", "NCOA_ADDR_ZipCode", *rules.TARGET_ENCODED, *rules.ONE_HOT_COLUMNS, *_V4_MEDIAN]
    age = (
        "round(date_diff('day', strptime(coalesce(substr(N05_S0Y2, 1, 6), '196008') || '01', '%Y%m%d')::DATE, "
        f"{_AS_OF}) / 365e0)"
    )
    joined = (
        f"SELECT a.* EXCLUDE (N05_S0Y2, NCOA_ADDR_ZipCode), {age} AS age, z.median_home, z.median_rental "
        f"FROM ({applicants_sql(raw)}) a LEFT JOIN ({D.zip_table_sql('home_values')}) z ON a.NCOA_ADDR_ZipCode = z.zipcode"
    )
    filled = ", ".join(
        [f'coalesce("{c}", (SELECT median("{c}") FROM src)) AS "{c}"' for c in _V4_OTHERS]
        + [f'coalesce({c}, {_MODE_SQL.format(c=c)}) AS {c}' for c in rules.TARGET_ENCODED]
    )
    encodings = ", ".join(
        f"m_{c} AS (SELECT {c} AS v, avg(V71_REAP01) AS m FROM src WHERE V71_REAP01 >= 0 AND {c} IS NOT NULL GROUP BY 1)"
        for c in rules.TARGET_ENCODED
    )
    encoded = ", ".join(f"m_{c}.m AS te_{c}" for c in rules.TARGET_ENCODED)
    lookups = " ".join(f"LEFT JOIN m_{c} ON f.{c} = m_{c}.v" for c in rules.TARGET_ENCODED)
    flags = ", ".join(
        f'CASE WHEN "{n.rsplit("_", 1)[0]}" = {n.rsplit("_", 1)[1]} AND {_V4_FIRST[n.rsplit("_", 1)[0]]} <> {n.rsplit("_", 1)[1]} '
        f'THEN 1 ELSE 0 END AS "{n}"' for n in rules.ONE_HOT_REQUIRED
    )
    kept = [c for c in _V4_OTHERS if c not in rules.ONE_HOT_COLUMNS]
    te = ", ".join(
        rnd(f"coalesce(te_{c}, (SELECT median(te_{c}) FROM e))", f"te_{c}") for c in rules.TARGET_ENCODED
    )
    return (
        f"WITH src AS ({joined}), f AS (SELECT {ID}, {filled} FROM src), {encodings}, "
        f"e AS (SELECT f.*, {encoded} FROM f {lookups}) SELECT {ID}, {rnds(kept)}, {te}, {flags} FROM e"
    )


@query("DM-22 IMP-13 FN-15 FN-22 FN-23 JN-10 AG-13", _income_v4_sql())
def income_v4_inputs(spark, sf_dir):
    raw = [ID, "N05_S0Y2", "NCOA_ADDR_ZipCode", *rules.TARGET_ENCODED, *rules.ONE_HOT_COLUMNS, *_V4_MEDIAN]
    df = applicants(spark, sf_dir, raw)
    known = df.filter("V71_REAP01 >= 0")
    encodings = {
        c: known.filter(f"{c} IS NOT NULL").groupBy(F.col(c).alias("value")).agg(F.avg("V71_REAP01").alias("mean"))
        for c in rules.TARGET_ENCODED
    }
    homes = D.zip_tables(spark, sf_dir)["home_values"]
    return with_rounded(income.income_v4_inputs(df, homes, encodings, _AS_OF, side_zip="zipcode"))
