import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from scorefold.operators import credit, features, impute, projection
from scorefold.plans import scoring_queries as S
from scorefold.plans.campaign import score_campaign, score_campaign_twice


def attributes(spark, **values):
    base = dict(
        HPE_Housing_Payment_Estimation=500.0, PIE_Income_Estimation=60000.0, LAE_Loan_Amount_Estimation=10000.0,
        NCOA_ADDR_State="CA", epay01attr25=3000.0, epay01attr19=2000.0, epay01attr24=400.0, epay01attr21=0.5, epay01attr20=1.0,
        epay01attr26=1.0, epay01attr23=0.0, epay01attr22=1.0, CEMP08_b_finscr=700.0, FederalTax=8000.0, StateTax=4000.0,
        V71_REAP01=100.0, V71_INAP01=200.0, V71_BC03S=4.0, V71_BC25S=1.0, W55_TRV01=6.0, W55_TRV02=3.0, W55_AGG910=10.0,
    ) | values
    kinds = {c: "string" if c == "NCOA_ADDR_State" else "double" for c in base}
    df = spark.createDataFrame([tuple(base.values())], ", ".join(f"{c} {k}" for c, k in kinds.items()))
    return credit.add_credit_attributes(df).first()


def test_attributes_by_hand(spark):
    r = attributes(spark)
    assert r["MonthlyIncome"] == 4000 and r["Tradeline_NDI"] == 4000 - 100 - 200 - 500
    assert r["LieDetectorRatio"] == 2.0 and r["LieDetectorDiff"] == 5000 and r["LieDetectorHigh"] == 0.5
    assert r["NdiWithLieDetector"] == pytest.approx(3200 - 5000 * 0.01744269)
    assert r["MonthlyDti"] == pytest.approx(900 / 60000 * 12) and r["Bti"] == pytest.approx(5000 / 60000)
    assert r["BtiWithLieDetector"] == pytest.approx(10000 / 60000)
    assert r["PctNewBCTradesInPast12mo"] == 0.75 and r["CPg_OverlimitTrend"] == 0.5 and r["CPg_W55_AGG910_UNF"] == 0


def test_attribute_edges(spark):
    empty = attributes(spark, epay01attr25=0.0, epay01attr19=-1.0)
    assert math.isinf(empty["LieDetectorRatio"]) and empty["LieDetectorHigh"] == 1.0
    unknown = attributes(spark, epay01attr25=None)
    assert math.isinf(unknown["LieDetectorRatio"]) and unknown["LieDetectorDiff"] is None
    assert unknown["NdiWithLieDetector"] == unknown["Tradeline_NDI"]
    assert attributes(spark, PIE_Income_Estimation=0.0)["Bti"] is None
    assert attributes(spark, LAE_Loan_Amount_Estimation=0.0)["LieDetectorHigh"] == 0.0
    negative = attributes(spark, V71_REAP01=-2.0, V71_INAP01=None)
    assert negative["Tradeline_NDI"] == 4000 + 2 - 500
    none = attributes(spark, V71_BC03S=0.0, V71_BC25S=5.0, W55_TRV01=-3.0, W55_TRV02=20.0, W55_AGG910=-1.0)
    assert none["PctNewBCTradesInPast12mo"] == 1.0 and none["CPg_OverlimitTrend"] == 12.0 and none["CPg_W55_AGG910_UNF"] == 1
    with pytest.raises(ValueError):
        credit.attribute_aliases(NoSuchAttribute="x")


RECENCY = "creditAsOfDate int, last_applied_date string, last_partner_applied_date string"


def test_recency_edges(spark):
    rows = [
        (20220804, "2022-05-06", None), (20220804, None, None), (20220804, "2010-01-01", "2022-08-04 00:00:00"),
        (20220804, "2022-09-10", "2022-08-20"), (None, "2022-05-06", "2022-05-06"), (20220804, "bad", "2022-01-01"),
    ]
    df = features.add_application_recency(spark.createDataFrame(rows, RECENCY))
    names = ["months_since_last_onsite_application", "months_since_last_partner_application", "months_since_last_application"]
    found = [tuple(r[n] for n in names) for r in df.collect()]
    assert found == [(3, 999, 3), (999, 999, 999), (999, 0, 0), (-1, 0, -1), (None, None, None), (999, 7, 7)]
    assert df.first()["CREDITASOFDATE"] == date(2022, 8, 4)
    again = features.add_application_recency(df)
    assert [r["months_since_last_application"] for r in again.collect()] == [f[2] for f in found]


def test_counters(spark):
    rows = [("N",) * 5, ("Y",) * 5, (None,) * 5, ("N", "Y", None, "Y", "N")]
    df = spark.createDataFrame(rows, ", ".join(f"previous6Tag{i} string" for i in range(1, 6)))
    found = [[r[f"PREVIOUS_COUNTER_{n}"] for n in (5, 4, 3, 1)] for r in features.add_selection_counters(df).collect()]
    assert found[1] == [5.0, 4.0, 3.0, 1.0] and found[3][:3] == [2.0, 2.0, 1.0] and math.isnan(found[3][3])
    assert all(math.isnan(x) for x in found[0] + found[2])


def test_policy_rules_cover_the_ndi_rules():
    names = [c for c, _, _ in impute.rules.POLICY_IMPUTATION]
    assert len(names) == len(set(names)) == 37


def test_one_hot_drop_first(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "v double")
    out = features.one_hot(df, ["v"], required=("v_1.0", "v_2.0", "w_1.0"))
    assert out.columns == ["v_1.0", "v_2.0", "w_1.0"]
    assert [tuple(r) for r in out.collect()] == [(0, 0, 0), (0, 1, 0), (0, 0, 0)]
    many = features.one_hot(spark.range(5000).selectExpr("CAST(id AS DOUBLE) AS v"), ["v"], required=("v_0.0", "v_4999.0"))
    assert many.where('`v_4999.0` = 1').count() == 1 and many.where('`v_0.0` = 1').count() == 0


def test_medians_and_modes_match_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=4001), rng.integers(0, 4, size=4001).astype(float)
    rows = [(None if i % 7 == 0 else float(x), float(y) if i % 5 else float("nan")) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double")
    present = lambda k: [r[k] for r in rows if r[k] is not None and not math.isnan(r[k])]
    for limit in (1_000_000, 50):
        found = impute.column_medians(df, ["a", "b"], max_values=limit, accuracy=200)
        assert found["a"] == pytest.approx(float(np.median(present(0)))) and found["b"] == np.median(present(1))
    values, counts = np.unique(present(1), return_counts=True)
    assert impute.column_modes(df, ["b"])["b"] == min(v for v, c in zip(values, counts) if c == counts.max())
    even = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert impute.column_medians(even, ["x"]) == {"x": 2.5}
    filled = impute.fill_mode_median(df, ["b"], ["a"])
    assert filled.filter("a IS NULL OR b IS NULL OR isnan(b)").count() == 0


def test_one_scan_campaign_equals_two_runs(spark, sf_dir):
    inputs = S.campaign_inputs(spark, sf_dir)
    people = S.campaign_applicants(spark, sf_dir)
    once, twice = score_campaign(people, inputs), score_campaign_twice(people, inputs)
    floats = [n for n, k in once.dtypes if k == "double"]
    tidy = lambda df: df.withColumns({c: F.round(c, 6) for c in floats})
    assert once.columns == twice.columns == list(projection.rules.SKINNY_COLUMNS)
    a, b = tidy(once), tidy(twice)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("customer.parquet") == 1


def test_full_output_list():
    from scorefold.plans.campaign import full_columns

    full = full_columns([S.LINEAR, S.TREES])
    assert full == sorted(set(full)) and {"MedianRental", "W55_TRV02", "bestcase_Bti", "HC03_VC113"} <= set(full)
