import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorefold.operators import aggregates, impute, ranks, reconcile
from scorefold.operators.checkpoints import Checkpoints

NAN = float("nan")


def test_ordered_bits_order_like_doubles():
    x = np.array([-math.inf, -1e300, -2.5, -1e-320, -0.0, 0.0, 5e-324, 1e-310, 1.0, 1.0000000000000002, 1e308, math.inf])
    keys = ranks.ordered_bits(x)
    assert (np.diff(keys.astype(object)) >= 0).all() and keys[4] == keys[5]
    assert all(ranks.from_ordered_bits(int(k)) == v for k, v in zip(keys, x))


@pytest.mark.parametrize("bits", [16, 13, 5])
def test_values_at_ranks_equal_a_sort(spark, bits):
    rng = np.random.default_rng(1)
    columns = {"normal": rng.normal(size=3000), "few": rng.integers(-2, 3, 3000).astype(float), "wide": np.exp(rng.normal(size=3000) * 200),
               "one": np.full(3000, 7.25), "odd name": rng.choice([math.inf, -math.inf, 0.0, -0.0, 1e-310], 3000)}
    df = spark.createDataFrame(pd.DataFrame(columns)).repartition(5)
    wanted = {c: [0, 1, 1499, 1500, 2999] for c in columns}
    found = ranks.values_at_ranks(df, wanted, bits)
    for c, x in columns.items():
        assert [found[c, r] for r in wanted[c]] == np.sort(x)[wanted[c]].tolist()


def test_medians_of_many_columns_take_few_jobs_and_no_window(spark):
    rng = np.random.default_rng(2)
    data = pd.DataFrame({f"c{i}": np.where(rng.random(500) < 0.2, NAN, rng.normal(size=500) * 10.0**i) for i in range(68)})
    data["none"] = NAN
    df = spark.createDataFrame(data)
    spark.sparkContext.setJobGroup("medians", "medians")
    found = impute.column_medians(df, list(data.columns))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("medians"))
    spark.sparkContext.setJobGroup("other", "other")
    assert jobs < 15 and "none" not in found
    assert all(found[c] == np.nanmedian(data[c]) for c in data.columns if c != "none")


def test_correlations_of_many_columns_equal_pandas(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(900, 5))
    x = base @ rng.normal(size=(5, 70)) + rng.normal(size=(900, 70)) * 0.3 + 1e7
    x[rng.random(x.shape) < 0.15] = NAN
    data = pd.DataFrame(x, columns=[f"c{i}" for i in range(70)])
    data["constant"], data["empty"] = 3.0, NAN
    df = spark.createDataFrame(data).repartition(4)
    want = data.corr()
    got = aggregates.correlations(df, list(data.columns)).collect()
    assert len(got) == 72 * 72
    for r in got:
        w = want.loc[r["a"], r["b"]]
        if math.isnan(w) or "constant" in (r["a"], r["b"]):
            assert r["correlation"] is None
        else:
            assert r["correlation"] == pytest.approx(w, abs=1e-6)


@pytest.mark.parametrize("equal_nan", [False, True])
def test_mismatches_of_150_columns_equal_those_of_each(spark, equal_nan):
    rng = np.random.default_rng(4)
    a = rng.integers(0, 9, (60, 150)).astype(float)
    b = a.copy()
    where = rng.random(a.shape) < 0.02
    b[where] += rng.choice([1e-9, 1.0, math.inf], where.sum())
    for x, share in ((a, 0.01), (b, 0.01)):
        x[rng.random(a.shape) < share] = NAN
    both = rng.random(a.shape) < 0.01
    a[both] = b[both] = NAN
    zero = rng.random(a.shape) < 0.01
    a[zero], b[zero] = 0.0, -0.0
    names = [f"c{i}" for i in range(150)]
    df = spark.createDataFrame(pd.concat([pd.DataFrame(a, columns=names), pd.DataFrame(b, columns=[f"{n}_r" for n in names])], axis=1))
    pairs = [(n, f"{n}_r") for n in names]
    got = {r["score"]: r["mismatches"] for r in reconcile.column_mismatches(df, pairs, equal_nan=equal_nan).collect()}
    want = {r["score"]: r["mismatches"] for r in reconcile.verdicts(df, pairs, equal_nan=equal_nan).collect()}
    assert got == want and sum(got.values()) > 50


def test_checkpoints_cost_no_job_and_see_changes(spark, tmp_path):
    df, seen = spark.range(1000).withColumn("k", F.when(F.col("id") > 3, F.col("id"))), Checkpoints("k")
    df = seen.mark(df, "loaded")
    df = seen.mark(df.withColumn("x", F.col("id") * 2), "projected")
    more = spark.createDataFrame([(5, 1), (5, 2), (6, 1)], "k long, y int")
    df = seen.mark(df.join(F.broadcast(more), "k", "left"), "joined")
    spark.sparkContext.setJobGroup("checkpoints", "checkpoints")
    df.write.parquet(str(tmp_path / "out"))
    rows = {r["step"]: (r["rows"], r["null_keys"]) for r in seen.report(spark).collect()}
    assert rows == {"loaded": (1000, 4), "projected": (1000, 4), "joined": (1001, 4)} and seen.changed() == ["joined"]
