"""The monthly scoring run: base scores, best-case scenario, output columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold.functions import kernels as K
from scorefold.functions import rules
from scorefold.operators.checkpoints import Checkpoints
from scorefold.operators.credit import add_credit_attributes, apply_tier
from scorefold.operators.features import add_reusable_features
from scorefold.operators.housing import estimate_housing
from scorefold.operators.joins import append_zip_data
from scorefold.operators.projection import column_union, create_new_variables, select_columns
from scorefold.operators.scenario import add_best_case_income, add_scenario
from scorefold.operators.scoring import CURRENT_SCORES, ModelTable, all_input_features
from scorefold.operators.tax import StateBrackets, calculate_ndi


@dataclass(frozen=True)
class CampaignInputs:
    """What a run needs besides the applicant file."""

    zip_tables: Sequence[DataFrame]
    state_table: DataFrame
    models: ModelTable


def full_columns(models: Sequence) -> list[str]:
    """Every model input, the skinny output and the columns needed to reproduce a run."""
    inputs = all_input_features(*[m.features for m in models])
    return column_union(inputs, rules.SKINNY_COLUMNS, rules.REPRODUCIBILITY_COLUMNS)


def eligibility_steps(inputs: CampaignInputs, state_table, income: str, only_scenario: bool = False) -> list:
    """Disposable income through price tier for one definition of income."""
    def scored(output: str):
        def step(df: DataFrame) -> DataFrame:
            where = "_in_scenario" if only_scenario else None
            return CURRENT_SCORES[output].apply(df, inputs.models, where)

        return step

    return [
        lambda df: calculate_ndi(df, state_table, income=income),
        scored("LAE_Loan_Amount_Estimation"),
        lambda df: add_credit_attributes(df, income=income),
        scored("CM_Credit_Model_Score"),
        apply_tier,
    ]


def shared_prefix(df: DataFrame, inputs: CampaignInputs) -> DataFrame:
    """The part both scenarios have in common: variables, ZIP data, income, housing."""
    df = create_new_variables(df)
    if inputs.zip_tables:
        df = append_zip_data(df, inputs.zip_tables)
    df = CURRENT_SCORES["PIE_Income_Estimation"].apply(df, inputs.models)
    return estimate_housing(df)


def base_run(df: DataFrame, inputs: CampaignInputs, state_table) -> DataFrame:
    for step in eligibility_steps(inputs, state_table, "PIE_Income_Estimation"):
        df = step(df)
    df = add_reusable_features(df)
    for output in ("RR_ResponseProb_v9", "RR_ResponseProb", "AR_ApprovalProb", "FR_FundingProb"):
        df = CURRENT_SCORES[output].apply(df, inputs.models)
    return df


def score_campaign(
    df: DataFrame, inputs: CampaignInputs, columns: Sequence[str] | None = rules.SKINNY_COLUMNS,
    checkpoints: Checkpoints | None = None,
) -> DataFrame:
    """Score applicants for base and best-case income with one scan and no id join.

    ``columns`` is the output list; None keeps everything.  ``checkpoints``
    count rows and keys as loaded, after the ZIP data and after all scores.
    """
    mark = checkpoints.mark if checkpoints else lambda df, step: df
    state_table = StateBrackets.load(inputs.state_table)
    df = mark(shared_prefix(mark(df, "loaded"), inputs), "zip_data").transform(add_best_case_income)
    df = add_scenario(
        df,
        eligibility_steps(inputs, state_table, rules.BEST_CASE_INCOME, only_scenario=True),
        rules.BEST_CASE_OUTPUTS,
        "bestcase_",
        "lastreportedincome IS NOT NULL",
    )
    df = K.with_sql(df, {rules.BEST_CASE_INCOME: K.case([("lastreportedincome IS NOT NULL", rules.BEST_CASE_INCOME)])})
    df = mark(base_run(df, inputs, state_table), "scored")
    return df if columns is None else select_columns(df, columns)


def score_campaign_twice(
    df: DataFrame, inputs: CampaignInputs, columns: Sequence[str] = rules.SKINNY_COLUMNS
) -> DataFrame:
    """Two full runs joined by id; the yardstick for ``score_campaign``."""
    base = base_run(shared_prefix(df, inputs), inputs, inputs.state_table)
    best = shared_prefix(df.filter(F.col("lastreportedincome").isNotNull()), inputs)
    best = best.transform(add_best_case_income).withColumn("_in_scenario", F.lit(True))
    for step in eligibility_steps(inputs, inputs.state_table, rules.BEST_CASE_INCOME):
        best = step(best)
    best = best.select(
        "PPPCL_CONSUMER_ID", rules.BEST_CASE_INCOME,
        *[F.col(c).alias(f"bestcase_{c}") for c in rules.BEST_CASE_OUTPUTS],
    )
    return select_columns(base.join(best, "PPPCL_CONSUMER_ID", "left"), columns)
