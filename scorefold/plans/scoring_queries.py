"""Model scores, scenarios and the whole campaign.

The models here are invented for the driver's tables; they only exercise the
scoring operators and are nobody's production models.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from scorefold.functions import rules
from scorefold.operators import aggregates, features, impute, joins, projection, scenario, scoring, training
from scorefold.operators.checkpoints import Checkpoints
from scorefold.operators.credit import add_credit_attributes
from scorefold.operators.scoring import LEGACY_SCORES, CustomModel, LinearModel, ModelTable, PreparedModel, TreeModel, score
from scorefold.operators.tax import StateBrackets, calculate_ndi
from scorefold.plans.applicant_queries import (
    HOUSING, ID, INCOME, _ATTRIBUTE_RAW, _BALANCES, _CREDIT_RAW, _DATES, _LOAN_RAW, _FUNDING_RAW, _HOUSING_RAW, _NDI_RAW, _TAGS, _TRADE,
    _counter, _label_sql, _tier_sql, attributes_sql, external_zip_tables, funding_sql, housing_sql, ndi_source_sql,
    ndi_sql, recency_sql,
)
from scorefold.plans.campaign import CampaignInputs, score_campaign
from scorefold.plans.registry import num, query, rnd, rnds, with_rounded
from scorefold.session import kept, scratch_path
from scorefold.sources import driver_tables as D
from scorefold.sources.driver_tables import applicants, applicants_sql

# ---------------------------------------------------------------- invented specs


def _leaf(x: float) -> dict:
    return {"leaf": x}


def _node(feature: str, below: float, yes: dict, no: dict, missing: str = "yes", gain: float = 1.0) -> dict:
    return {"feature": feature, "below": below, "yes": yes, "no": no, "missing": missing, "gain": gain}


LINEAR = LinearModel({INCOME: 0.02, "V71_REAP01": -0.5, "W55_TRV02": 10.0}, intercept=100.0)
LOGISTIC = LinearModel({INCOME: -4e-06, "epay01attr24": 0.0004, "W55_TRV01": 0.03}, intercept=-0.5, link="logistic")
TREES = TreeModel(
    [
        _node(INCOME, 90000.0,
              _node("V71_REAP01", 200.0, _node("W55_TRV01", 3.0, _leaf(0.1), _leaf(0.2), "no"), _leaf(0.35), gain=4.0),
              _node("epay01attr25", 15000.0, _leaf(-0.2), _node("V71_BC03S", 4.0, _leaf(-0.05), _leaf(0.15)), "no", 2.5),
              gain=9.0),
        _node("W55_TRV02", 5.0, _node("V71_REAP01", 0.0, _leaf(0.3), _leaf(-0.1), "no", 3.0), _leaf(0.05), "no", 6.0),
    ],
    base=0.5,
)
_MODEL_RAW = [ID, INCOME, "V71_REAP01", "W55_TRV01", "W55_TRV02", "epay01attr24", "epay01attr25", "V71_BC03S"]


def linear_sql(model: LinearModel) -> str:
    def value(c: str) -> str:
        return f"CASE WHEN \"{c}\" IS NULL OR isnan(CAST(\"{c}\" AS DOUBLE)) THEN {num(model.missing)} ELSE CAST(\"{c}\" AS DOUBLE) END"

    total = " + ".join([num(model.intercept)] + [f"({value(c)}) * {num(w)}" for c, w in model.weights.items()])
    return f"1 / (1 + exp(-({total})))" if model.link == "logistic" else f"({total})"


def trees_sql(model: TreeModel) -> str:
    def branch(n: dict) -> str:
        if "leaf" in n:
            return num(n["leaf"])
        c = f"\"{n['feature']}\""
        gone = f"({c} IS NULL OR isnan(CAST({c} AS DOUBLE)))"
        test = f"({gone} OR {c} < {num(n['below'])})" if n["missing"] == "yes" else f"(NOT {gone} AND {c} < {num(n['below'])})"
        return f"CASE WHEN {test} THEN {branch(n['yes'])} ELSE {branch(n['no'])} END"

    return " + ".join([num(model.base)] + [branch(t) for t in model.trees])


_APPLICANTS = applicants_sql(_MODEL_RAW)


@query("ML-01", f"SELECT {ID}, {rnd(linear_sql(LINEAR), 'score', 6)} FROM ({_APPLICANTS})")
def score_linear(spark, sf_dir):
    return with_rounded(score(applicants(spark, sf_dir, _MODEL_RAW), LINEAR, "score").select(ID, "score"), 6)


@query("ML-01", f"SELECT {ID}, {rnd(linear_sql(LOGISTIC), 'score', 6)} FROM ({_APPLICANTS})")
def score_logistic(spark, sf_dir):
    return with_rounded(score(applicants(spark, sf_dir, _MODEL_RAW), LOGISTIC, "score").select(ID, "score"), 6)


@query("ML-01", f"SELECT {ID}, {rnd(trees_sql(TREES), 'score', 6)} FROM ({_APPLICANTS})")
def score_trees(spark, sf_dir):
    return with_rounded(score(applicants(spark, sf_dir, _MODEL_RAW), TREES, "score").select(ID, "score"), 6)


@query(
    "UDF-02 UDF-03 FN-21 ML-01",
    f"SELECT {ID}, {rnd(f'CASE WHEN W55_TRV01 >= 0 THEN {trees_sql(TREES)} END', 'score', 6)} FROM ({_APPLICANTS})",
)
def score_arrow(spark, sf_dir):
    df = applicants(spark, sf_dir, _MODEL_RAW)
    scored = score(df, TREES, "score", where="W55_TRV01 >= 0", engine="arrow")
    return with_rounded(scored.select(ID, "score"), 6)


_RESPONSE = {
    9: LinearModel({"PREVIOUS_COUNTER_5": 0.2, "months_since_last_application": -0.001}, -1.0, "logistic"),
    10: LinearModel({"PREVIOUS_COUNTER_5": 0.25, "months_since_last_application": -0.0012}, -0.9, "logistic"),
}
_RESPONSE_SQL = (
    f"SELECT *, {_counter(5)} FROM ({recency_sql(applicants_sql([ID, *_DATES, *_TAGS]))})"
)


@query(
    "ML-06",
    f"SELECT {ID}, {rnd(linear_sql(_RESPONSE[9]), 'RR_ResponseProb_v9', 6)}, {rnd(linear_sql(_RESPONSE[10]), 'RR_ResponseProb', 6)} "
    f"FROM ({_RESPONSE_SQL})",
)
def score_two_versions(spark, sf_dir):
    df = features.add_application_recency(applicants(spark, sf_dir, [ID, *_DATES, *_TAGS]))
    df = features.add_selection_counters(df)
    df = score(score(df, _RESPONSE[9], "RR_ResponseProb_v9"), _RESPONSE[10], "RR_ResponseProb")
    return with_rounded(df.select(ID, "RR_ResponseProb_v9", "RR_ResponseProb"), 6)


# ------------------------------------------------------------ campaign models

_CAMPAIGN_MODELS = {
    "income": LinearModel(
        {"V71_REAP01": 20.0, "epay01attr25": 1.2, "W49_AUP1003": 15.0, "acs_median_income": 0.5}, 20000.0
    ),
    "loan_amount": LinearModel({INCOME: 0.08, "W49_AUC1002": 3.0, "lastreportedhousingpayment": 1.5, "NDI": 0.2}, 1000.0),
    "credit": LinearModel(
        {"DaysSinceMostRecentUILInquiry": -1e-06, "UnsecuredInstallmentLoanBalance": 3e-05, "epay01attr24": 0.0005,
         "CPg_Bti": 0.8}, -1.6, "logistic",
    ),
    "response": _RESPONSE[10],
    "approval": TreeModel([
        _node("PricingTier_v6", 4.0, _node("MonthlyDti", 0.4, _leaf(0.6), _leaf(0.4)), _node("CPg_Bti", 0.3, _leaf(0.2), _leaf(0.1)))
    ]),
    "funding": LinearModel({"CCAprEst": 2.0, "state_label_5_FR": 0.1, "W55_PAYMNT08_FRM": -0.02, "MeanIncome_Processed": 1e-06}, -1.0, "logistic"),
}


def campaign_models(spark) -> ModelTable:
    rows = [(name, 10 if name == "response" else 1, "Production", m) for name, m in _CAMPAIGN_MODELS.items()]
    return ModelTable.from_models(spark, [*rows, ("response", 9, "Archived", _RESPONSE[9])])


_CAMPAIGN_RAW = list(dict.fromkeys([
    ID, "NCOA_ADDR_State", "NCOA_ADDR_ZipCode", "RECENT_TAG", *_TAGS, *_DATES, *_BALANCES, *_NDI_RAW,
    *[c for c in _HOUSING_RAW if c != INCOME], *[c for c in _ATTRIBUTE_RAW if c != "LAE_Loan_Amount_Estimation"],
    *_FUNDING_RAW, "W49_AUC1002", "lastreportedincome", "lastreportedhousingpayment", "GGENERC_gna001", "V71_AT03S",
    "V71_AT09S", "V71_AT20S", "V71_G069S", "V71_G095S", "N05_G082", "PREVIOUS_COUNTER", "email_only", "sendableemail",
    "ehpm01_nopdfor", "ehpm01_nopmod", "ehpm01_nocpgt45",
]))


def campaign_inputs(spark, sf_dir) -> CampaignInputs:
    return CampaignInputs(external_zip_tables(spark, sf_dir), D.state_brackets(spark, sf_dir), campaign_models(spark))


def campaign_applicants(spark, sf_dir):
    return applicants(spark, sf_dir, _CAMPAIGN_RAW)


_BEST = rules.BEST_CASE_INCOME


def _prefix_sql() -> str:
    zipped = (
        f"SELECT a.*, z.acs_median_income FROM ({applicants_sql(_CAMPAIGN_RAW)}) a "
        f"LEFT JOIN ({D.zip_table_sql('modelling')}) z ON a.NCOA_ADDR_ZipCode = z.zipcode"
    )
    typed = (
        "SELECT * EXCLUDE (lastreportedhousingpayment, W49_AUC1002), TRY_CAST(lastreportedhousingpayment AS INTEGER) AS lastreportedhousingpayment, "
        f"CAST(trunc(W49_AUC1002) AS INTEGER) AS \"W49_AUC1002\", {linear_sql(_CAMPAIGN_MODELS['income'])} AS \"{INCOME}\" FROM ({zipped})"
    )
    return f"SELECT *, greatest({INCOME}, lastreportedincome) AS \"{_BEST}\" FROM ({housing_sql(typed)})"


def _eligibility_sql(income: str) -> str:
    """Disposable income, loan amount, attributes, credit score and tier for one income."""
    loan = f"SELECT *, {linear_sql(LinearModel(_CAMPAIGN_MODELS['loan_amount'].weights, 1000.0))} AS \"LAE_Loan_Amount_Estimation\" FROM ({ndi_sql(_prefix_sql(), income)})"
    uil = (
        "SELECT *, CASE WHEN epay01attr26 IN (-6, -5, -4, -3, -2, -1) THEN 1e5 ELSE epay01attr26 END AS \"DaysSinceMostRecentUILInquiry\", "
        "CASE WHEN epay01attr19 IN (-6, -5, -4, -3, -2, -1) THEN 0 ELSE epay01attr19 END AS \"UnsecuredInstallmentLoanBalance\" "
        f"FROM ({attributes_sql(loan, income)})"
    )
    scored = f"SELECT *, {linear_sql(_CAMPAIGN_MODELS['credit'])} AS \"CM_Credit_Model_Score\" FROM ({uil})"
    tier = _tier_sql().replace("s <", "CM_Credit_Model_Score <")
    return f"SELECT *, {tier} AS \"PricingTier_v6\", \"CPg_MonthlyDti\" AS \"MonthlyDti\" FROM ({scored})"


_BEST_SELECT = (
    f"SELECT {ID} AS bid, \"{_BEST}\" AS best_income, \"MonthlyDti\" AS b_dti, \"CPg_Bti\" AS b_bti, \"Tradeline_NDI\" AS b_ndi, "
    f"CM_Credit_Model_Score AS b_score, PricingTier_v6 AS b_tier FROM ({_eligibility_sql(_BEST)}) WHERE lastreportedincome IS NOT NULL"
)
_BEST_LIST = (
    f"{rnd('best_income', _BEST)}, {rnd('b_dti', 'bestcase_MonthlyDti')}, {rnd('b_bti', 'bestcase_Bti')}, "
    f"{rnd('b_ndi', 'bestcase_Tradeline_NDI', 6)}, {rnd('b_score', 'bestcase_CM_Credit_Model_Score')}, b_tier AS \"bestcase_PricingTier_v6\""
)

_BASE_SQL = (
    f"SELECT *, {linear_sql(_RESPONSE[9])} AS p9, {linear_sql(_RESPONSE[10])} AS p10, {trees_sql(_CAMPAIGN_MODELS['approval'])} AS pa "
    f"FROM (SELECT *, {_counter(5)} FROM ({recency_sql(_eligibility_sql(INCOME))}))"
)
_FUNDING_STEP = (
    f"SELECT *, {funding_sql(14)}, {_label_sql(rules.STATE_LABEL_GROUPS, 'state_label_5_FR')} FROM ({_BASE_SQL})"
)
_RAW_SKINNY = [
    c for c in rules.SKINNY_COLUMNS
    if c in _CAMPAIGN_RAW and c not in (ID, "RECENT_TAG", "NCOA_ADDR_State", "lastreportedhousingpayment")
]
_FLOAT_RAW = [c for c in _RAW_SKINNY if "AS INT" not in D.APPLICANT_SQL[c][:40] or "CASE" in D.APPLICANT_SQL[c][:4]]
_INT_RAW = [c for c in _RAW_SKINNY if c not in _FLOAT_RAW]

_CAMPAIGN_SQL = (
    f"SELECT {ID}, NCOA_ADDR_State, {rnds(_FLOAT_RAW)}, {', '.join(_INT_RAW)}, previous6Tag1 AS \"RECENT_TAG\", RECENT_TAG AS eligible_last_month, "
    f"{rnd(INCOME, INCOME)}, {rnd('LAE_Loan_Amount_Estimation', 'LAE_Loan_Amount_Estimation')}, {rnd(HOUSING, HOUSING)}, "
    f"{rnd('epay01attr20', 'DaysSinceOpenedUIL')}, {rnd('epay01attr21', 'MaxUILUtilization')}, {rnd('epay01attr23', 'UILAccountsOpenedPast12mo')}, "
    f"{rnd('epay01attr25', 'RevolvingBalance')}, {rnd('epay01attr26', 'DaysSinceUILInquiry')}, {rnd('Tradeline_NDI', 'Tradeline_NDI', 6)}, "
    f"{rnd('bal', 'UnsecuredSummaryBalance')}, {rnd('CPg_LieDetectorRatio', 'LieDetectorRatio')}, {rnd('MonthlyDti', 'MonthlyDti')}, {rnd('CPg_Bti', 'Bti')}, "
    f"{rnd('CPg_PctNewBCTradesInPast12mo', 'PctNewBCTradesInPast12mo')}, {rnd('CM_Credit_Model_Score', 'CM_Credit_Model_Score')}, \"PricingTier_v6\", "
    f"{rnd('p9', 'RR_ResponseProb_v9')}, {rnd('p10', 'RR_ResponseProb')}, {rnd('pa', 'AR_ApprovalProb')}, "
    f"{rnd(linear_sql(_CAMPAIGN_MODELS['funding']), 'FR_FundingProb')}, months_since_last_application, "
    f"{rnd(_TRADE, 'UnsecuredSummaryBalanceTUVars1')}, {rnd('V71_US101S + V71_BC101S', 'UnsecuredSummaryBalanceTUVars2')}, "
    f"{rnd('epay01attr25 + epay01attr19', 'UnsecuredSummaryBalanceCustomVars')}, "
    f"{rnd(f'greatest({_TRADE}, epay01attr25 + epay01attr19)', 'UnsecuredSummayBalanceBlend')}, lastreportedhousingpayment, {_BEST_LIST} "
    f"FROM ({_FUNDING_STEP}) LEFT JOIN ({_BEST_SELECT}) ON {ID} = bid"
)


@query("DM-20 DM-18 DM-23 ML-02 ML-04 ML-05 ML-07 ML-08 PRJ-10", _CAMPAIGN_SQL)
def campaign_skinny(spark, sf_dir):
    df = score_campaign(campaign_applicants(spark, sf_dir), campaign_inputs(spark, sf_dir))
    return with_rounded(df, finer={"Tradeline_NDI": 6, "bestcase_Tradeline_NDI": 6})


@query(
    "DQ-13 AG-06",
    f"WITH n AS (SELECT count(*) AS n, count(*) FILTER (WHERE {ID} IS NULL) AS gone FROM ({applicants_sql([ID])})) "
    + " UNION ALL ".join(f"SELECT '{step}' AS step, n AS rows, gone AS null_keys, TRUE AS same_keys FROM n" for step in ("loaded", "zip_data", "scored")),
)
def campaign_checkpoints(spark, sf_dir):
    """Rows and keys at three places of a campaign, counted by the job that writes its scores."""
    seen = Checkpoints(ID)
    df = score_campaign(campaign_applicants(spark, sf_dir), campaign_inputs(spark, sf_dir), rules.SCORE_COLUMNS, seen)
    df.write.parquet(scratch_path(spark, "checked_campaign"))
    found = seen.report(spark)
    first = found.where("step = 'loaded'").select(F.col("key_digest").alias("loaded"))
    digest = first.first()["loaded"]
    return found.select("step", "rows", "null_keys", F.coalesce(F.col("key_digest") == F.lit(digest), F.lit(False)).alias("same_keys"))


# ------------------------------------------------------- stored, prepared models

_LONG = ["V71_AT36S_mo_since_most_recent_dq", "V71_AT104S_pct_all_trd_opned_pst_24mo_all_trd"]
#: Months that are no number are 999 for the model, and its columns have their long names.
_PREPARED = LinearModel({_LONG[0]: -0.0007, _LONG[1]: 0.011, "UnsecuredInstallmentLoanTrades": 0.05, "DaysSinceMostRecentUILInquiry": -2e-06}, -1.2, "logistic")
_PREPARE = "scorefold.operators.impute:impute_credit_model"


def _prepared_sql() -> str:
    codes = "(-6, -5, -4, -3, -2, -1)"
    months = ", ".join(f"CASE WHEN {c} IN {codes} THEN 999e0 ELSE {c} END AS \"{n}\"" if c in rules.CREDIT_MODEL_999 else f"{c} AS \"{n}\""
                       for n, c in ((n, projection.bureau_code(n)) for n in _LONG))
    loans = ", ".join(f"CASE WHEN {c} IN {codes} THEN {num(v)} ELSE {c} END AS \"{n}\"" for n, c, v in rules.CREDIT_MODEL_LOAN_COLUMNS)
    source = f"SELECT {ID}, {months}, {loans} FROM ({applicants_sql([ID, *_CREDIT_RAW, *_LOAN_RAW])})"
    score = rnd(linear_sql(_PREPARED), "prepared_score", 6), rnd(linear_sql(_PREPARED), "custom_score", 6)
    return f"SELECT {ID}, {', '.join(score)} FROM ({source})"


@query("UDF-03 UDF-02 ML-05 ML-12 DM-11", _prepared_sql())
def prepared_credit_score(spark, sf_dir):
    """A model table is written and read back; its models prepare their own inputs, one as columns and one as a user's loader."""
    custom = CustomModel(_PREPARED.features, "scorefold.operators.scoring:load_linear", json.loads(_PREPARED.to_json()) | {"kind": None})
    custom.settings.pop("kind")
    path = scratch_path(spark, "models")
    ModelTable.from_models(spark, [
        ("credit", 1, "Production", PreparedModel(_PREPARED, _PREPARE)), ("credit_custom", 1, "Production", PreparedModel(custom, _PREPARE))]).write(path)
    models = ModelTable.read(spark, path)
    df = applicants(spark, sf_dir, [ID, *_CREDIT_RAW, *_LOAN_RAW])
    df = score(df, models.resolve("models:/credit/1"), "prepared_score")
    df = score(df, models.resolve("models:/credit_custom/Production"), "custom_score")
    return with_rounded(df.select(ID, "prepared_score", "custom_score"), 6)


_MODEL_LIST = "SELECT name, CAST(row_number() OVER (ORDER BY first) - 1 AS INTEGER) AS at FROM (SELECT {name} AS name, min(p_partkey) AS first FROM part WHERE {where} GROUP BY 1)"


@query(
    "ML-13 ML-12",
    "SELECT name, CASE WHEN d.at IS NULL THEN 'missing' WHEN m.at IS NULL THEN 'extra' WHEN d.at <> m.at THEN 'moved' ELSE 'same' END AS status, "
    "d.at AS declared_at, m.at AS model_at FROM "
    f"({_MODEL_LIST.format(name='p_brand', where='p_size > 10')}) m FULL JOIN ({_MODEL_LIST.format(name='p_brand', where='p_size > 5 AND p_brand <> ' + chr(39) + 'Brand#3' + chr(39))}) d USING (name)",
)
def feature_list_check(spark, sf_dir):
    """A feature list from a file against the order of a stored model: what is missing, extra or moved."""
    parts = D.table(spark, sf_dir, "part")

    def names(where: str) -> list[str]:
        return [r["p_brand"] for r in parts.where(where).groupBy("p_brand").agg(F.min("p_partkey").alias("first")).orderBy("first").collect()]

    path, listed = scratch_path(spark, "models"), scratch_path(spark, "feature_list")
    ModelTable.from_models(spark, [("brands", 1, "Production", LinearModel({n: 1.0 for n in names("p_size > 10")}))]).write(path)
    declared = list(enumerate(names("p_size > 5 AND p_brand <> 'Brand#3'")))
    spark.createDataFrame(declared, "position int, name string").coalesce(1).write.csv(listed)
    return scoring.feature_differences(spark.read.schema("position int, name string").csv(listed), ModelTable.read(spark, path).resolve("models:/brands/Production"))


def _ensemble(trees: int = 100, depth: int = 5) -> TreeModel:
    """An invented ensemble: thresholds and leaves follow from the numbers of tree and node."""
    ranges = {"l_quantity": 50.0, "l_extendedprice": 100_000.0, "l_discount": 0.1, "l_tax": 0.08}
    names = list(ranges)

    def node(tree: int, at: int, level: int) -> dict:
        if level == depth:
            return {"leaf": ((tree * 31 + at * 17) % 101 - 50) / 64}
        name = names[(tree + at) % len(names)]
        below = ranges[name] * (((tree * 7 + at * 13) % 97) + 0.5) / 97.003
        return {"feature": name, "below": below, "yes": node(tree, 2 * at, level + 1), "no": node(tree, 2 * at + 1, level + 1),
                "missing": "yes" if (tree + at) % 3 else "no", "gain": float((tree + at) % 11)}

    return TreeModel([node(t, 1, 0) for t in range(trees)], base=0.5)


_ENSEMBLE = _ensemble()
_ENSEMBLE_RAW = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, nullif(l_discount, 0.05) AS l_discount, l_tax"


@query(
    "ML-01 ML-07",
    f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {rnd(trees_sql(_ENSEMBLE), 'score', 6)} FROM (SELECT {_ENSEMBLE_RAW} FROM lineitem)",
)
def score_ensemble(spark, sf_dir):
    """100 trees of depth 5 over line items, walked level by level in Arrow batches."""
    lines = D.table(spark, sf_dir, "lineitem").selectExpr(*_ENSEMBLE_RAW.split(", ")[:6], "nullif(l_discount, 0.05) AS l_discount", "l_tax")
    return with_rounded(score(lines, _ENSEMBLE, "score").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "score"), 6)


_SCORES = ", ".join(f'"{c}"' for c in rules.SCORE_COLUMNS)


@query("PRJ-10 DM-20", f"SELECT {_SCORES} FROM ({_CAMPAIGN_SQL})")
def campaign_scores(spark, sf_dir):
    """The nine score columns alone."""
    df = score_campaign(campaign_applicants(spark, sf_dir), campaign_inputs(spark, sf_dir), rules.SCORE_COLUMNS)
    return with_rounded(df)


_SCENARIO_RAW = [*_ATTRIBUTE_RAW, "lastreportedincome"]


def _scenario_sql() -> str:
    source = f"SELECT *, greatest({INCOME}, lastreportedincome) AS \"{_BEST}\" FROM ({ndi_source_sql(_SCENARIO_RAW)})"
    best = attributes_sql(ndi_sql(source, _BEST), _BEST)
    return (
        f"SELECT a.{ID}, {rnd('best_income', _BEST)}, {rnd('b_dti', 'bestcase_MonthlyDti')}, {rnd('b_bti', 'bestcase_Bti')}, "
        f"{rnd('b_ndi', 'bestcase_Tradeline_NDI', 6)} FROM ({applicants_sql([ID])}) a LEFT JOIN "
        f"(SELECT {ID} AS bid, \"{_BEST}\" AS best_income, \"CPg_MonthlyDti\" AS b_dti, \"CPg_Bti\" AS b_bti, \"Tradeline_NDI\" AS b_ndi "
        f"FROM ({best}) WHERE lastreportedincome IS NOT NULL) ON a.{ID} = bid"
    )


@query("DM-17 DM-18 FLT-01 JN-06 FN-02 PRJ-11", _scenario_sql())
def bestcase_scenario(spark, sf_dir):
    from scorefold.operators.housing import estimate_housing

    brackets = StateBrackets.load(D.state_brackets(spark, sf_dir))
    raw = list(dict.fromkeys([ID, "NCOA_ADDR_State", *_HOUSING_RAW, *_NDI_RAW, *_SCENARIO_RAW]))
    df = scenario.add_best_case_income(estimate_housing(applicants(spark, sf_dir, raw)))
    out = scenario.add_scenario(
        df,
        [lambda x: calculate_ndi(x, brackets, income=_BEST), lambda x: add_credit_attributes(x, income=_BEST)],
        [_BEST, "MonthlyDti", "Bti", "Tradeline_NDI"],
        "bestcase_",
        "lastreportedincome IS NOT NULL",
    )
    kept = out.select(
        ID, F.col(f"bestcase_{_BEST}").alias(_BEST), "bestcase_MonthlyDti", "bestcase_Bti", "bestcase_Tradeline_NDI"
    )
    return with_rounded(kept, finer={"bestcase_Tradeline_NDI": 6})


# --------------------------------------------------------------- older scores

_LEGACY_MODELS = {
    ("income", 3): LinearModel({"CCIntEst": 1000.0, "V71_REAP01": 12.0}, 30000.0),
    ("income", 4): LinearModel({"V71_MT101S": 0.05, "W55_TRV14": 100.0}, 28000.0),
    ("loan_amount", 3): LinearModel({"PIE_v4": 0.1, "W49_AUC1002": 2.0, "lastreportedhousingpayment": 1.0}, 900.0),
    ("response", 8): LinearModel({"PREVIOUS_COUNTER_4": 0.3}, -1.0, "logistic"),
    ("response_dm", 8): LinearModel({"PREVIOUS_COUNTER_3": 0.3}, -1.1, "logistic"),
    ("approval", 6): LinearModel({"W49_ATTR24": 0.0003, "N05_S0_Y2": 1e-06}, -1.0, "logistic"),
    ("funding", 6): LinearModel({"CCAprEst": 2.0, "no_student_trades": 0.4}, -1.0, "logistic"),
    ("funding", 4): LinearModel({c: 1e-05 * (i + 1) for i, c in enumerate(rules.FUNDING_V4_FEATURES)}, -0.5, "logistic"),
    ("pre_uol", 1): LinearModel({"V71_REAP01": 0.001}, -0.2, "logistic"),
    ("creative_black_back", 2): LinearModel({"V71_G200S": 0.002}, 0.1, "logistic"),
    ("creative_confetti", 2): LinearModel({"V71_G200S": -0.002}, 0.1, "logistic"),
}
_LEGACY_RAW = list(dict.fromkeys([
    ID, *_DATES, *_TAGS, *_FUNDING_RAW, "V71_MT101S", "W55_TRV14", "W49_AUC1002", "lastreportedhousingpayment", "N05_S0Y2",
    "epay01attr24", "V71_G200S", "GGENERC_gna001", "V71_AT34B", "V71_MT09S", "V71_BR31S", "W55_WALSRVS1", "V71_RE28S",
    "V71_INAP01", "V71_BR01S", "V71_G201A", "V71_ST05S", "W49_AUP1003",
]))
_LEGACY_OUT = list(LEGACY_SCORES)


def _legacy_sql() -> str:
    m = _LEGACY_MODELS
    typed = (
        "SELECT * EXCLUDE (lastreportedhousingpayment, W49_AUC1002), CAST(trunc(W49_AUC1002) AS INTEGER) AS \"W49_AUC1002\", "
        "TRY_CAST(lastreportedhousingpayment AS INTEGER) AS lastreportedhousingpayment, N05_S0Y2 AS \"N05_S0_Y2\", epay01attr24 AS \"W49_ATTR24\", "
        f"0.25e0 AS \"Model_v3_Score\", {_counter(4)}, {_counter(3)}, "
        "CASE WHEN V71_REAP01 >= 0 THEN V71_REAP01 END AS reap, "
        f"CASE WHEN cc IS NULL OR cc < 0 THEN 0 WHEN cc > 0.3 THEN 0.3 ELSE cc END AS \"CCIntEst\" "
        f"FROM (SELECT *, 12 * W49_ATTR08 / nullif(W49_ATTR07, 0) - 0.12 AS cc FROM ({recency_sql(applicants_sql(_LEGACY_RAW))}))"
    )
    funded = f"SELECT *, {funding_sql(14)} FROM ({typed})"
    v3 = linear_sql(m["income", 3]).replace('"V71_REAP01"', "reap")
    first = f"SELECT *, {v3} AS s_v3, CAST({linear_sql(m['income', 4])} AS FLOAT) AS \"PIE_v4\" FROM ({funded})"
    parts = {
        "PIE_v3": "s_v3", "PIE_v4": '"PIE_v4"', "LAE_v3": linear_sql(m["loan_amount", 3]), "RR_v8": linear_sql(m["response", 8]),
        "RR_v8_dm": linear_sql(m["response_dm", 8]), "AR_v6": linear_sql(m["approval", 6]), "FR_v6": linear_sql(m["funding", 6]),
        "FR_v4_python": linear_sql(m["funding", 4]), "pre_UOL_score_v1": linear_sql(m["pre_uol", 1]),
        "creative_v2_black_back_202007": linear_sql(m["creative_black_back", 2]),
        "creative_v2_confetti_201910": linear_sql(m["creative_confetti", 2]),
    }
    return f"SELECT {ID}, {', '.join(rnd(parts[c], c, 3) for c in _LEGACY_OUT)} FROM ({first})"


@query("ML-10 ML-09 ML-11 ML-12 ML-13 DM-23 PRJ-07", _legacy_sql())
def score_legacy_models(spark, sf_dir):
    models = ModelTable.from_models(
        spark, [(name, version, "Production", m) for (name, version), m in _LEGACY_MODELS.items()]
    )
    listed = scoring.check_features(rules.FUNDING_V4_FEATURES, models.resolve("models:/funding/4").features)
    if not listed.same_order:
        raise ValueError(f"the model does not fit its feature list: {listed}")
    df = applicants(spark, sf_dir, _LEGACY_RAW)
    df = features.add_selection_counters(features.add_application_recency(df)).withColumn("Model_v3_Score", F.lit(0.25))
    third = LEGACY_SCORES["PIE_v3"]
    scrubbed = df.withColumn("_reap", F.col("V71_REAP01"))
    df = third.apply(impute.income_v3_inputs(scrubbed, ["V71_REAP01"]), models).drop("V71_REAP01").withColumnRenamed("_reap", "V71_REAP01")
    for output in _LEGACY_OUT[1:]:
        df = LEGACY_SCORES[output].apply(df, models)
    return with_rounded(df.select(ID, *_LEGACY_OUT), 3)


_PRE_UOL = LinearModel({"epay01attr24": 0.0003, "W55_TRV01": 0.02}, -0.4, "logistic")


@query(
    "ML-09",
    f"SELECT {ID}, {rnd(linear_sql(_PRE_UOL), 'preUOLScore', 6)} FROM ({_APPLICANTS})",
)
def score_pre_uol(spark, sf_dir):
    models = ModelTable.from_models(spark, [("pre_uol", 1, "Production", _PRE_UOL)])
    scored = scoring.CURRENT_SCORES["preUOLScore"].apply(applicants(spark, sf_dir, _MODEL_RAW), models)
    return with_rounded(scored.select(ID, "preUOLScore"), 6)


# --------------------------------------------------------- scores by id, checks


@query(
    "JN-07 JN-08 FLT-01",
    "SELECT c_custkey, c_nationkey, spent, orders FROM customer "
    "LEFT JOIN (SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1) s ON c_custkey = s.o_custkey "
    "JOIN (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1) n ON c_custkey = n.o_custkey WHERE c_acctbal IS NOT NULL",
)
def scores_by_id(spark, sf_dir):
    """One score file joined left, one inner, as files that were scored elsewhere."""
    per_id = D.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("spent"), F.count("*").alias("orders")
    )
    people = projection.has_value(D.table(spark, sf_dir, "customer"), "c_acctbal").select("c_custkey", "c_nationkey")
    left = joins.join_scores(people, per_id, "c_custkey", ["spent"], "left")
    return joins.join_scores(left, per_id, "c_custkey", ["orders"])


@query(
    "AG-14 ML-12",
    "SELECT p_brand AS name, max(p_size) AS latest_version FROM part GROUP BY p_brand",
)
def latest_model_versions(spark, sf_dir):
    registry = D.table(spark, sf_dir, "part").selectExpr("p_brand AS name", "p_size AS version")
    return scoring.latest_versions(registry)


@query(
    "ML-12",
    "SELECT p_partkey, CASE WHEN p_brand = 'Brand#7' AND p_size = 5 THEN 'Production' "
    "WHEN p_brand = 'Brand#7' AND p_type = 'Production' THEN 'Archived' ELSE p_type END AS stage FROM "
    "(SELECT * EXCLUDE (p_type), CASE WHEN p_type = 'LARGE' THEN 'Production' ELSE p_type END AS p_type FROM part)",
)
def promote_version(spark, sf_dir):
    registry = D.table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_brand AS name", "p_size AS version",
        "CASE WHEN p_type = 'LARGE' THEN 'Production' ELSE p_type END AS stage",
    )
    return ModelTable(registry).promote("Brand#7", 5, "Production").table.select("p_partkey", "stage")


# ------------------------------------------------------------------- training

_TRAIN_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query("ML-14 ML-15 ML-16")
def boosted_tree_importance(spark, sf_dir):
    """Feature importances of boosted trees that predict the line price, with the held-out error."""
    lines = kept(D.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount", "l_tax"), "training_lines")
    key = ["l_orderkey", "l_linenumber"]
    train, test = training.split_rows(lines, key)
    packaged = training.train_boosted_trees(
        training.with_validation(train, key), _TRAIN_FEATURES, "l_extendedprice", validation="_validation")
    error = training.quality(packaged, train, test, "l_extendedprice").first()
    found = packaged.importances()
    counted = aggregates.describe(lines, _TRAIN_FEATURES)
    names = F.create_map(*[x for n, v in found.items() for x in (F.lit(n), F.lit(v))])
    return counted.select("column", "count", names[F.col("column")].alias("importance"), F.lit(packaged.rounds()).alias("rounds"),
                          F.lit(error["rmse"]).alias("held_out_rmse"), F.lit(error["mean_rmse"]).alias("mean_rmse"))


_SHARE = "(CAST('0x' || substr(md5({}), 1, 8) AS BIGINT) % 10000)"


@query(
    "ML-15",
    "SELECT CASE WHEN " + _SHARE.format("'123|' || l_orderkey || '|' || l_linenumber")
    + " >= 2500 THEN 'train' ELSE 'test' END AS side, count(*) AS \"count\" FROM lineitem GROUP BY 1",
)
def train_test_split(spark, sf_dir):
    """Rows per side of the deterministic split."""
    lines = D.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    train, test = training.split_rows(lines, ["l_orderkey", "l_linenumber"])
    return train.select(F.lit("train").alias("side")).unionAll(test.select(F.lit("test").alias("side"))).groupBy("side").count()
