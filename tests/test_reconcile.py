import numpy as np
import pytest
from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F

from scorefold.operators import aggregates, reconcile

NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("equal_nan", [False, True])
def test_close_is_numpy_isclose(spark, equal_nan):
    edge = [None, NAN, INF, -INF, 0.0, 1e-8, 2e-8, 1.0, 1.0 + 1e-9, 1.1]
    pairs = [(a, b) for a in edge for b in edge]
    df = spark.createDataFrame(pairs, "a double, b double")
    found = [r[0] for r in df.select(reconcile.close("a", "b", equal_nan=equal_nan)).collect()]
    number = lambda x: NAN if x is None else x
    want = [bool(np.isclose(number(a), number(b), rtol=0, equal_nan=equal_nan)) for a, b in pairs]
    assert found == want


def test_bins_equal_bucketizer_on_linspace(spark):
    rng = np.random.default_rng(1)
    low, high = -3.3, 17.9
    edges = np.linspace(low, high, 101)
    values = [float(x) for x in rng.uniform(low, high, 2000)] + [float(x) for x in edges] + [
        float(np.nextafter(x, d)) for x in edges[1:-1] for d in (-INF, INF)]
    df = spark.createDataFrame([(v,) for v in values], "value double")
    want = Bucketizer(splits=[float(e) for e in edges], inputCol="value", outputCol="want").transform(df)
    both = reconcile._with_bin(
        want.withColumns({"low": F.lit(low), "high": F.lit(high), "kept": F.col("value")}), 100
    )
    off = both.filter("bin != want").collect()
    # numpy's own edges are a last-digit off the plain product for some of the 100 steps
    assert all(np.min(np.abs(edges - r["kept"])) < 1e-13 for r in off) and both.filter("abs(bin - want) > 1").count() == 0
    assert both.filter("bin < 0 OR bin > 99").count() == 0


def test_bins_outside_the_range(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (10.0,), (11.0,), (NAN,), (None,), (INF,)], "x double")
    found = {r["bin"]: r["count"] for r in reconcile.distribution(df, "x", 0.0, 10.0, 10).collect()}
    assert found == {-1: 1, 0: 1, 9: 1, 10: 2, None: 2}


def test_bin_differences_with_new_side_outside(spark):
    legacy = spark.createDataFrame([(0.0,), (1.0,), (1.0,)], "old double")
    current = spark.createDataFrame([(5.0,), (1.0,), (None,)], "new double")
    out = reconcile.bin_differences(current, legacy, [("new", "old")])
    assert sorted(tuple(r) for r in out.collect() if r["diff"] is not None) == [("new", 99, 1, 2, 1)]
    assert out.filter("diff IS NULL").select("bin", "legacy_count").first() == (0, 1)
    matrix = reconcile.bin_matrix(out, ["new"])
    assert matrix.count() == 100 and matrix.filter("new_diff IS NOT NULL").count() == 1
    assert reconcile.moved_share(out, current).first()["percent"] == pytest.approx(100 / 3)


def joined(spark):
    a = spark.createDataFrame([(1, 1.0, 5.0), (2, None, 5.0), (3, 3.0, 6.0), (4, 4.0, 1.0)], "id int, s double, f double")
    b = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 3.5, 5.0), (5, 1.0, 1.0)], "id int, old double, f double")
    return reconcile.join_runs(a, b, "id")


def test_mismatch_reports(spark):
    df = joined(spark)
    pairs = reconcile.suffix_pairs([("s", "old"), ("f", "f")])
    assert pairs == [("s", "old"), ("f_DB", "f_R")]
    assert sorted(r["id"] for r in reconcile.mismatches(df, "id", pairs[0]).collect()) == [2, 3]
    assert {(r["id"], r["score"]) for r in reconcile.all_mismatches(df, "id", pairs).collect()} == {(2, "s"), (3, "s"), (3, "f_DB")}
    assert {r["score"]: (r["all_close"], r["mismatches"]) for r in reconcile.verdicts(df, pairs).collect()} == {
        "s": (False, 2), "f_DB": (False, 1)}
    rest = reconcile.without_differing(df, "id", pairs[1])
    assert reconcile.verdicts(rest, pairs[:1]).first()["mismatches"] == 1
    assert [r["id"] for r in reconcile.null_pattern_rows(df, "s", "old").collect()] == [2]
    gaps = reconcile.absolute_differences(df, pairs, missing_as=0.0)
    assert gaps.columns == ["old_diff", "f_diff"] and sorted(r[0] for r in gaps.collect()) == [0.0, 0.5, 2.0]
    assert df.filter(reconcile.rounded_equal("s", "old", 0)).count() == 1


def test_aggregates(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (2, 4.0, None), (3, NAN, "c"), (3, None, None)], "k int, x double, t string")
    assert {r["column"]: r["nulls"] for r in aggregates.null_counts(df).collect()} == {"k": 0, "x": 2, "t": 2}
    r = aggregates.describe(df.filter("x < 10"), ["x"]).first()
    assert (r["count"], r["mean"], r["min"], r["max"]) == (2, 3.0, 2.0, 4.0)
    assert aggregates.key_report(df, "k").first().asDict() == {"rows": 4, "distinct_keys": 3, "null_keys": 0, "most_per_key": 2}
    assert aggregates.key_report(df, "t").first()["null_keys"] == 2
    with pytest.raises(ValueError):
        aggregates.assert_unique_key(df, "k")
    assert not aggregates.holds_for_all(df, F.col("x") > 0).first()[0]
    assert {r["column"]: r["percent"] for r in aggregates.share_of_rows(df, ["k"]).collect()} == {"k": 225.0}


def test_correlation_is_pairwise_complete(spark):
    import pandas as pd
    data = pd.DataFrame({"a": [1.0, 2, 3, NAN, 5], "b": [2.0, 1, NAN, 4, 9], "c": [1.0, 1, 2, 2, NAN]})
    df = spark.createDataFrame([tuple(None if x != x else float(x) for x in r) for r in data.to_numpy()], "a double, b double, c double")
    want = data.corr()
    for r in aggregates.correlations(df, ["a", "b", "c"]).collect():
        assert r["correlation"] == pytest.approx(want.loc[r["a"], r["b"]])


@pytest.mark.parametrize("kind", ["long", "double", "string"])
def test_rows_that_agree_are_left_out_and_no_other(spark, kind):
    """Repeated, missing and one-sided keys, missing and infinite values; few differing rows, none, and all."""
    def run(seed, change):
        r = np.random.default_rng(seed)
        rows = []
        for i in [*range(400), *range(0, 40, 3), None, None]:
            x = [float(i or 0) * k for k in range(1, 6)]
            if r.random() < change:
                x[int(r.integers(5))] += 1.0
            if i is not None and i % 50 == 7:
                x[2] = [None, NAN, INF, -INF][i // 50 % 4]
            if i == 0:
                x = [-0.0 if seed == 1 else 0.0] * 5
            key = None if i is None else {"long": i, "string": str(i), "double": (-0.0 if i == 0 and seed == 1 else NAN if i == 399 else float(i))}[kind]
            rows.append((key, (i or 0) % 3, *x))
        if seed == 2:
            rows = rows[20:] + [({"long": 9999, "string": "x", "double": 0.5}[kind], 0, *[1.0] * 5)]
        return rows

    schema = f"id {kind}, part int, " + ", ".join(f"c{k} double" for k in range(5))
    names = [(f"c{k}", f"c{k}") for k in range(5)]
    pairs = reconcile.suffix_pairs(names)
    for change in (0.0, 0.1, 1.0):
        a, b = spark.createDataFrame(run(1, change), schema), spark.createDataFrame(run(2, 0.0), schema)
        want = reconcile.column_mismatches(reconcile.join_runs(a, b, ["id", "part"]), pairs).collect()
        c, d = reconcile.without_agreeing(a, b, ["id", "part"], names)
        assert c.columns == a.columns and d.dtypes == b.dtypes
        assert sorted(reconcile.column_mismatches(reconcile.join_runs(c, d, ["id", "part"]), pairs).collect()) == sorted(want)
        if change < 1:
            assert 0 < c.count() < a.count() / 2 and d.count() < b.count() / 2
    # Nothing differs: nothing is left.  Keys of other types: all is left.
    same = a.where("part = 1 AND c2 IS NOT NULL AND NOT isnan(c2)").dropDuplicates(["id"])
    assert [x.count() for x in reconcile.without_agreeing(same, same, ["id", "part"], names)] == [0, 0]
    other = b.withColumn("part", F.col("part").cast("long"))
    assert reconcile.without_agreeing(a, other, ["id", "part"], names) == (a, other)


def test_few_bits_keep_more_rows_and_lose_none(spark, monkeypatch):
    monkeypatch.setattr(reconcile, "MAX_BITS", 1)
    a = spark.range(60_000).selectExpr("id", "CAST(id AS DOUBLE) AS x", "CAST(id % 7 AS DOUBLE) AS y")
    b = a.selectExpr("id", "IF(id % 4 = 1, x + 1, x) AS x", "y")
    c, d = reconcile.without_agreeing(a, b, "id", [("x", "x"), ("y", "y")])
    left = {r["id"] for r in c.select("id").collect()}
    assert left == {r["id"] for r in d.select("id").collect()} and left >= set(range(1, 60_000, 4)) and 15_000 < len(left) < 40_000
    joined = reconcile.join_runs(c, d, "id")
    assert sorted(reconcile.column_mismatches(joined, reconcile.suffix_pairs([("x", "x"), ("y", "y")])).collect()) == [("x_DB", 15_000), ("y_DB", 0)]
