import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorefold.operators import feature_store as fs
from scorefold.operators import scoring, training
from scorefold.plans import trip_queries as T
from scorefold.plans.scoring_queries import _ensemble
from scorefold.session import scratch_path


def lines(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    data = pd.DataFrame({"l_quantity": rng.uniform(0, 50, n), "l_extendedprice": rng.uniform(0, 1e5, n), "l_discount": rng.uniform(0, 0.1, n), "l_tax": rng.uniform(0, 0.08, n)})
    return spark.createDataFrame(data.mask(rng.random(data.shape) < 0.1, None).mask(rng.random(data.shape) < 0.05, np.nan))


def test_flat_trees_equal_the_case_form(spark):
    model = _ensemble(100, 5)
    df = lines(spark, 120)
    small = scoring.TreeModel(model.trees[:8], 0.5)
    both = scoring.score(scoring.score(df, small, "a", engine="column"), small, "b", engine="arrow")
    assert both.where("a != b OR a IS NULL").count() == 0
    want = np.full(120, 0.5)
    rows = df.toPandas()

    def leaf(node, r):
        while "leaf" not in node:
            v = r[node["feature"]]
            gone = v is None or np.isnan(v)
            node = node["yes"] if (node["missing"] == "yes" if gone else v < node["below"]) else node["no"]
        return node["leaf"]

    for t in model.trees:
        want += [leaf(t, r) for r in rows.to_dict("records")]
    assert np.array_equal(model.load()(rows), want)


def test_flat_trees_of_uneven_depth_and_without_rows():
    tree = {"feature": "x", "below": 1.0, "missing": "no", "gain": 2.0, "yes": {"leaf": 1.0},
            "no": {"feature": "y", "below": 0.0, "missing": "yes", "gain": 3.0, "yes": {"leaf": 10.0}, "no": {"leaf": 20.0}}}
    model = scoring.TreeModel([tree, {"leaf": 0.5}], base=100.0)
    batch = pd.DataFrame({"y": [0.0, -1.0, np.nan, 1.0], "x": [0.0, 1.0, 2.0, np.nan]})
    assert model.load()(batch).tolist() == [101.5, 110.5, 110.5, 120.5]
    assert model.load()(batch[:0]).tolist() == [] and model.importance() == {"x": 2.0, "y": 3.0} and model.features == ["x", "y"]
    assert scoring.TreeModel([], 3.0).load()(batch).tolist() == [3.0] * 4


def test_a_trained_package_survives_saving(spark):
    data = spark.range(600).selectExpr("id", "cast(id % 7 AS DOUBLE) AS a", "cast(id % 11 AS DOUBLE) AS b").withColumn("y", F.col("a") * 3 - F.col("b"))
    train, test = training.split_rows(data, ["id"])
    lookups = [fs.FeatureLookup("t", ["f"], ["k"])]
    packaged = training.train_boosted_trees(training.with_validation(train, ["id"]), ["a", "b"], "y", lookups, rounds=15, max_depth=3, validation="_validation")
    path = scratch_path(spark, "package")
    packaged.save(spark, path)
    again = training.PackagedModel.load(spark, path)
    assert again.lookups == tuple(lookups) and again.features == ("a", "b") and 1 <= again.rounds() <= 15
    same = packaged.predict(test).withColumnRenamed("prediction", "p").select("id", "p").join(again.predict(test), "id")
    assert same.where("p != prediction").count() == 0 and same.count() == test.count()
    found = training.quality(again, train, test, "y").first()
    assert found["rmse"] == pytest.approx(training.rmse(packaged, test, "y")) and found["rmse"] < 0.7 * found["mean_rmse"]
    y, learned = np.array([r["y"] for r in test.collect()]), train.agg(F.avg("y")).first()[0]
    assert found["mean_rmse"] == pytest.approx(np.sqrt(((y - learned) ** 2).mean())) and found["train_rows"] + found["test_rows"] == 600


def test_early_stopping_ends_on_noise(spark):
    noise = spark.range(400).selectExpr("id", "cast(id % 5 AS DOUBLE) AS a", "rand(3) AS y")
    packaged = training.train_boosted_trees(training.with_validation(noise, ["id"], 0.3), ["a"], "y", rounds=100, max_depth=2, validation="_validation")
    assert packaged.rounds() < 30


def test_score_batch_loads_a_package_by_path(spark):
    store, name = fs.FeatureStore(spark, scratch_path(spark, "store")), T._name("features")
    store.create_table(name, ["zip", "ts"], spark.createDataFrame([(1, 5, "a", 2.0)], "zip int, ts int, yyyy_mm string, f double"), "yyyy_mm")
    path = scratch_path(spark, "linear")
    model = scoring.LinearModel({"f": 10.0, "x": 1.0}, 0.5)
    training.PackagedModel(model, ("f", "x"), (fs.FeatureLookup(name, ["f"], ["z", "t"]),)).save(spark, path)
    trips = spark.createDataFrame([(1, 5, 1.0), (1, 6, 2.0)], "z int, t int, x double")
    assert sorted(r["prediction"] for r in training.score_batch(store, path, trips).collect()) == [2.5, 21.5]


def test_stored_custom_and_prepared_models(spark):
    custom = scoring.CustomModel(["x"], "scorefold.operators.scoring:load_linear", {"weights": {"x": 2.0}})
    prepared = scoring.PreparedModel(scoring.LinearModel({"UnsecuredInstallmentLoanBalance": 2.0}), "scorefold.operators.impute:impute_credit_model")
    path = scratch_path(spark, "models")
    scoring.ModelTable.from_models(spark, [("custom", 1, "Production", custom), ("prepared", 1, "Production", prepared)]).write(path)
    models = scoring.ModelTable.read(spark, path)
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    assert sorted(r["s"] for r in scoring.score(df, models.resolve("models:/custom/1"), "s").collect()) == [2.0, 6.0]
    found = models.resolve("models:/prepared/Production")
    assert isinstance(found, scoring.PreparedModel) and found.features == ["UnsecuredInstallmentLoanBalance"]


def test_feature_differences_name_missing_extra_and_moved(spark):
    model = scoring.LinearModel({"a": 1.0, "b": 1.0, "c": 1.0})
    declared = spark.createDataFrame([("a", 0), ("c", 1), ("d", 2)], "name string, position int")
    got = {r["name"]: (r["status"], r["declared_at"], r["model_at"]) for r in scoring.feature_differences(declared, model).collect()}
    assert got == {"a": ("same", 0, 0), "b": ("missing", None, 1), "c": ("moved", 1, 2), "d": ("extra", 2, None)}
