import math

import pytest
from pyspark.sql import functions as F

from scorefold.operators import housing, tax
from scorefold.plans.applicant_queries import ndi_frame
from scorefold.sources import driver_tables as D

INCOME = "PIE_Income_Estimation"


def federal_by_hand(t):
    if t < 0:
        return 0.0
    brackets = [(0, 9075, .10), (9075, 36900, .15), (36900, 89350, .25), (89350, 186350, .28),
                (186350, 405100, .33), (405100, 406750, .35), (406750, math.inf, .396)]
    return sum((min(t, high) - low) * rate for low, high, rate in brackets if t > low)


def test_federal_tax_at_bracket_edges(spark):
    edges = [-1.0, 0.0, 9075.0, 36900.0, 89350.0, 186350.0, 405100.0, 406750.0, 500000.0]
    values = [e + d for e in edges for d in (-0.01, 0.0, 0.01)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "TaxableIncome double")
    rows = df.select("TaxableIncome", F.expr(tax.federal_columns()["FederalTax"]).alias("t")).collect()
    for r in rows:
        if r["TaxableIncome"] is None:
            assert r["t"] is None
        else:
            assert r["t"] == pytest.approx(federal_by_hand(r["TaxableIncome"]), abs=1e-6)


def test_mortgage_interest_edges(spark):
    rows = [(-5.0, 0.0, 1000.0), (0.0, 0.0, 1000.0), (1.0, 0.0, 1000.0), (360.0, 0.0, 1000.0), (360.0, 0.0, -1.0)]
    df = spark.createDataFrame(rows, "W49_ATTR10_Imputed double, V71_MT21S_Imputed double, V71_MT101S_Imputed double")
    out = [r["YearAvgMortInterest"] for r in tax.add_federal_tax(df.withColumn("inc", F.lit(50000.0)), "inc").collect()]
    r = 0.05 / 12

    def by_hand(n, amount):
        g = (1 + r) ** n
        return max(12 * amount * ((r * n * g) / (g - 1) - 1) / n, 0)

    expected = [by_hand(360, 1000), 0.0, by_hand(1, 1000), by_hand(360, 1000), 0.0]
    assert out == pytest.approx(expected, rel=1e-9)


def test_personal_exemption_threshold(spark):
    df = spark.createDataFrame([(258249.0,), (258250.0,), (258251.0,)], "inc double").withColumns({
        "MortAmnt": F.lit(-1.0), "NumMortPayRemaing": F.lit(360.0)})
    found = [r[0] for r in df.select(F.expr(tax.taxable_income("inc"))).collect()]
    assert found == [258249 - 4000 - 6300, 258250 - 6300, 258251 - 6300]


BRACKETS = "State string, DollarsPreviousTaxed double, MaximumTaxableDollars double, Rates double, Standard_Deduction double, Personal_Exemption double"


def people(spark):
    rows = [(str(i), s, inc) for i, (s, inc) in enumerate(
        (s, inc) for s in ("A", "B", "C", "Z", None) for inc in (None, 0.0, 500.0, 1000.0, 9000.0, 2e5, 1e7))]
    return spark.createDataFrame(rows, f"PPPCL_CONSUMER_ID string, NCOA_ADDR_State string, {INCOME} double")


def brackets(spark):
    return spark.createDataFrame([
        ("A", 0.0, 1000.0, .02, 100.0, 50.0), ("A", 1000.0, 5000.0, .04, 100.0, 50.0), ("A", 6000.0, 1e9, .06, 100.0, 50.0),
        ("B", 0.0, None, .03, 10.0, 5.0), ("B", None, 100.0, .05, 10.0, 5.0), ("B", 50.0, 70.0, None, None, 5.0),
        ("C", 0.0, 100.0, None, 1.0, 1.0),
    ], BRACKETS)


@pytest.mark.parametrize("deductions", [False, True])
def test_fold_equals_rejoin(spark, deductions):
    """The one-to-one fold and join-aggregate-rejoin agree, also on incomplete brackets."""
    columns = ["AfterDeduction_max", "StateTax_sum", "Money_sum", "StateTax"]

    def rows(method):
        out = tax.add_state_tax(people(spark), brackets(spark), INCOME, deductions=deductions, method=method)
        return {r["PPPCL_CONSUMER_ID"]: [r[c] for c in columns] for r in out.collect()}

    fold, rejoin = rows("fold"), rows("rejoin")
    assert len(fold) == 35
    for key in fold:
        assert [x is None for x in fold[key]] == [x is None for x in rejoin[key]], key
        assert [x for x in fold[key] if x is not None] == pytest.approx([x for x in rejoin[key] if x is not None])


@pytest.mark.parametrize("rows", [64, 65, 25_000])
def test_tax_does_not_depend_on_the_size_of_the_table(spark, rows):
    """``rows`` brackets in one state; NULL and repeated ids keep their own tax."""
    width = 6400.0 / rows
    table = spark.range(rows).selectExpr(
        "'A' AS State", f"id * {width!r}D AS DollarsPreviousTaxed", f"{width!r}D AS MaximumTaxableDollars", "0.1D AS Rates")
    df = spark.createDataFrame([("a", "A", 5000.0), (None, "A", 5000.0), ("a", "A", 5000.0)], people(spark).schema)
    out = tax.add_state_tax(df, table, INCOME).collect()
    assert len(out) == 3 and all(r["StateTax_sum"] == pytest.approx(500.0) for r in out)


def test_fold_ignores_repeated_and_null_ids(spark):
    df = spark.createDataFrame([("1", "A", 5000.0), ("1", "A", 5000.0), (None, "A", 5000.0)], people(spark).schema)
    found = {r["StateTax_sum"] for r in tax.add_state_tax(df, brackets(spark), INCOME).collect()}
    assert found == {1000 * .02 + 4000 * .04}


def test_ndi_reads_applicants_once_and_does_not_shuffle(spark, sf_dir):
    plan = ndi_frame(spark, sf_dir).select("NDI")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("customer.parquet") == 1
    assert "Exchange hashpartitioning" not in plan


def test_housing_missing_rules(spark):
    columns = ["MedianRental", INCOME, "V71_AT36S", "V71_G208S", "V71_BC03S", "W55_TRV14", "V71_RT35S", "V71_MT01S", "W49_ATTR09"]
    rows = [[None, 60000.0] + [1.0] * 7, [1000.0, None] + [1.0] * 7, [1.0, 1.0] + [0.0] * 7, [1e6, 60000.0, 0.0, None] + [0.0] * 5]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    out = "HPE_Housing_Payment_Estimation"
    deployed = [r[out] for r in housing.estimate_housing(df).collect()]
    older = [r[out] for r in housing.estimate_housing(df, missing="skip").collect()]
    mortgage = 60000 * 0.003352 + 17.987879 + 0.703487 + 32.807283
    assert deployed == [10000.0, 10000.0, 250.0, 10000.0]
    assert older[0] == pytest.approx(max(mortgage, 250)) and older[1] is None and older[2:] == [250.0, 10000.0]
    with pytest.raises(ValueError):
        housing.estimate_housing(df, missing="zero")


def test_preprocess_false_uses_given_columns(spark, sf_dir):
    from scorefold.operators.impute import impute_by_rules
    df = housing.estimate_housing(D.applicants(spark, sf_dir, list(dict.fromkeys(
        ["PPPCL_CONSUMER_ID", "NCOA_ADDR_State", *__import__("scorefold.plans.applicant_queries", fromlist=["x"])._TAX_RAW]))))
    table = D.state_brackets(spark, sf_dir)
    a = tax.calculate_ndi(df, table).select("PPPCL_CONSUMER_ID", "NDI")
    b = tax.calculate_ndi(impute_by_rules(df), table, preprocess=False).select("PPPCL_CONSUMER_ID", "NDI")
    assert a.exceptAll(b).count() == 0
