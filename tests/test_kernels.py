import math
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scorefold.functions import kernels as K
from scorefold.functions import rules

NAN, INF = float("nan"), float("inf")
EDGE = [None, NAN, -1.0, -2.0, -3.0, -4.0, -5.0, -6.0, -7.0, 0.0, 5.0]


def apply(spark, values, sql, kind="double"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r["y"] for r in df.select("i", F.expr(sql).alias("y")).orderBy("i").collect()]


def same(a, b):
    return a is None and b is None or (
        a is not None and b is not None and (a == b or (math.isnan(a) and math.isnan(b)))
    )


def check(found, expected):
    assert len(found) == len(expected)
    assert all(same(a, b) for a, b in zip(found, expected)), (found, expected)


def test_impute_prefers_codes_over_default(spark):
    found = apply(spark, EDGE, K.impute("x", 7.5, {-1: 1.5, (-2, -3): 2.5, -4: 4.5}))
    check(found, [7.5, NAN, 1.5, 2.5, 2.5, 4.5, 7.5, 7.5, 7.5, 0.0, 5.0])


def test_replace_sentinels_keeps_null_and_minus_seven(spark):
    check(apply(spark, EDGE, K.replace_sentinels("x", 999.0)), [None, NAN] + [999.0] * 6 + [-7.0, 0.0, 5.0])


def test_negative_to_null(spark):
    check(apply(spark, EDGE, K.negative_to_null("x")), [None, NAN] + [None] * 7 + [0.0, 5.0])


def test_null_to_and_value_to_nan(spark):
    check(apply(spark, [None, NAN, 0.0], K.null_to("x", 3.0)), [3.0, NAN, 0.0])
    check(apply(spark, [None, 0.0, 2.0], K.value_to_nan("x", 0)), [None, NAN, 2.0])


def test_clipping_keeps_null_and_sends_nan_up(spark):
    values = [None, NAN, 249.0, 250.0, 10000.0, 10001.0]
    check(apply(spark, values, K.clip("x", 250.0, 10000.0)), [None, 10000.0, 250.0, 250.0, 10000.0, 10000.0])
    check(apply(spark, values, K.cap("x", 300.0)), [None, 300.0, 249.0, 250.0, 300.0, 300.0])
    check(apply(spark, [None, 0.0, 1.0, 2.0], K.not_above("x", 1, 1.0)), [None, 1.0, 1.0, 2.0])


def test_rates(spark):
    values = [None, NAN, INF, -INF, -0.1, 0.1, 0.26, 0.31, 1.0, 1.1]
    check(apply(spark, values, K.scrub_rate("x")), [0.0, 0.0, 0.0, 0.0, 0.0, 0.1, 0.26, 0.3, 0.3, 0.3])
    check(apply(spark, values, K.clip_apr("x")), [0.0, 0.0, 0.0, 0.0, 0.0, 0.1, 0.25, 0.25, 0.25, 0.0])
    check(apply(spark, [0.0, 2.0, None], K.ratio("4D", "x")), [None, 2.0, None])


def test_flags_treat_null_as_miss(spark):
    assert apply(spark, [None, -1.0, 1.0], K.flag("x < 0")) == [0, 1, 0]
    check(apply(spark, [None, -1.0, 1.0], K.positive_part("x")), [0.0, 0.0, 1.0])


def test_tier_thresholds(spark):
    values = [None, NAN, -1.0]
    for bound in rules.TIER_UPPER_BOUNDS:
        values += [bound - 1e-9, bound]
    found = apply(spark, values, K.tier("x", rules.TIER_UPPER_BOUNDS))
    assert found == [6, 6, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 6]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1, 2, allow_nan=False), min_size=1, max_size=40))
def test_tier_and_clip_are_monotone(spark, values):
    values = sorted(values)
    tiers = apply(spark, values, K.tier("x", rules.TIER_UPPER_BOUNDS))
    clipped = apply(spark, values, K.clip("x", 0.1, 0.9))
    assert tiers == sorted(tiers) and clipped == sorted(clipped)


def test_dates(spark):
    check_dates = apply(spark, ["20010131", "20011331", None], K.parse_date("x", "yyyyMMdd"), "string")
    assert check_dates == [date(2001, 1, 31), None, None]
    text = ["2022-08-04 00:00:00", "2022-08-04", "junk", None]
    assert apply(spark, text, K.parse_date("x", "yyyy-MM-dd"), "string") == [date(2022, 8, 4)] * 2 + [None, None]
    months = apply(spark, ["2001-12-31", "2002-01-29", "2002-01-30", "2001-12-02"],
                   K.whole_months_between("DATE '2001-12-31'", "CAST(x AS DATE)"), "string")
    assert months == [0, 0, -1, 0]
    ages = apply(spark, ["196008", "19600815", None], K.age_in_years("x", "DATE '2020-08-01'"), "string")
    assert ages == [60.0, 60.0, 60.0]


def test_weekend_follows_new_york_across_summer_time(spark):
    from zoneinfo import ZoneInfo

    start = datetime(2024, 3, 8)
    hours = [start + timedelta(hours=h) for h in range(24 * 7)] + [datetime(2024, 11, 3, h) for h in range(12)]
    found = apply(spark, hours, K.is_weekend("x"), "timestamp_ntz")
    zone = ZoneInfo("America/New_York")
    assert found == [int(t.replace(tzinfo=ZoneInfo("UTC")).astimezone(zone).weekday() >= 5) for t in hours]


def test_ceil_to_minutes(spark):
    times = [
        datetime(2024, 1, 1, 10, 15), datetime(2024, 1, 1, 10, 15, 0, 1), datetime(2024, 1, 1, 10, 29, 59, 999999),
        datetime(1969, 12, 31, 23, 50),
    ]
    quarter = 1704103200 + 900
    assert apply(spark, times, K.ceil_to_minutes("x", 15), "timestamp_ntz") == [quarter, quarter + 900, quarter + 900, 0]


def test_text(spark):
    assert apply(spark, ["60600.0", "501", " 00501 ", "10.01"], K.clean_zip("x"), "string") == [
        "60600", "00501", "00501", "10.01"
    ]
    check(apply(spark, ["WY", "CA", "MA", None], K.label_by_group("x", rules.STATE_LABEL_GROUPS), "string"), [0.0, 3.0, NAN, NAN])


def test_state_groups_are_disjoint():
    for groups in (rules.STATE_LABEL_GROUPS, rules.LEGACY_STATE_LABEL_GROUPS):
        states = [s for g in groups for s in g]
        assert len(states) == len(set(states))


@pytest.mark.parametrize("value, text", [(1, "1"), (2.5, "2.5D"), ("a'b", "'a\\'b'"), (True, "TRUE")])
def test_literals(value, text):
    assert K.literal(value) == text
