import numpy as np
import pytest
from pyspark.sql import functions as F

from scorefold.operators import scoring, training
from scorefold.operators.scoring import CustomModel, LinearModel, ModelTable, TreeModel, score
from scorefold.plans import scoring_queries as S
from scorefold.sources.driver_tables import applicants

MODELS = {"linear": S.LINEAR, "logistic": S.LOGISTIC, "trees": S.TREES}


@pytest.mark.parametrize("name", MODELS)
def test_column_form_equals_arrow_form(spark, sf_dir, name):
    df = applicants(spark, sf_dir, S._MODEL_RAW)
    both = score(score(df, MODELS[name], "a", engine="column"), MODELS[name], "b", engine="arrow")
    assert both.filter("a IS NULL OR b IS NULL OR abs(a - b) > 1e-9").count() == 0


@pytest.mark.parametrize("name", MODELS)
def test_json_round_trip(name):
    assert scoring.model_from_json(MODELS[name].to_json()) == MODELS[name]


def test_where_leaves_other_rows_null(spark, sf_dir):
    df = applicants(spark, sf_dir, S._MODEL_RAW)
    for engine in ("column", "arrow"):
        out = score(df, S.TREES, "s", where="W55_TRV01 >= 0", engine=engine)
        assert out.filter("s IS NULL").count() == df.filter("W55_TRV01 < 0 OR W55_TRV01 IS NULL").count()


def test_custom_model_loads_inside_tasks_and_sees_only_its_features(spark):
    def load():
        offset = 10.0
        return lambda batch: batch["x"].to_numpy() * 2 + offset + (len(batch.columns) - 1)

    df = spark.range(100).selectExpr("CAST(id AS DOUBLE) AS x", "id AS unused")
    out = score(df, CustomModel(["x"], load), "s")
    assert out.filter("s = x * 2 + 10").count() == 100
    with pytest.raises(ValueError, match="missing"):
        score(df, CustomModel(["y"], load), "s")
    with pytest.raises(ValueError):
        score(df, S.LINEAR, "s", engine="fast")


def test_large_tree_models_use_batches():
    leafy = TreeModel([{"feature": "x", "below": 1.0, "yes": {"leaf": 1.0}, "no": {"leaf": 0.0}, "missing": "no"}] * 100)
    assert not leafy.as_column and S.TREES.as_column


def test_model_table(spark, tmp_path):
    models = ModelTable.from_models(spark, [
        ("m", 1, "Production", LinearModel({"x": 1.0})), ("m", 2, "None", LinearModel({"x": 2.0})), ("n", 7, "None", S.TREES),
    ])
    models.write(str(tmp_path / "models"))
    models = ModelTable.read(spark, str(tmp_path / "models"))
    assert models.latest_version("m") == 2 and models.latest_version("absent") == 1
    assert models.resolve("models:/m/1").weights == {"x": 1.0}
    assert models.resolve("models:/m/Production").weights == {"x": 1.0}
    assert models.resolve("m").weights == {"x": 2.0}
    moved = models.promote("m", 2, "Production")
    assert moved.resolve("models:/m/Production").weights == {"x": 2.0}
    assert {r["version"]: r["stage"] for r in moved.table.filter("name = 'm'").collect()} == {1: "Archived", 2: "Production"}
    with pytest.raises(LookupError):
        models.resolve("models:/m/9")


def test_feature_checks():
    check = scoring.check_features(["a", "b", "x"], ["b", "a", "c"])
    assert check.missing == ["c"] and check.extra == ["x"] and not check.same_order
    assert scoring.check_features(["a"], ["a"]).same_order
    assert S.TREES.importance()["PIE_Income_Estimation"] == 9.0
    assert "MedianRental" in scoring.all_input_features(["zz"])


def test_loan_casts(spark):
    df = spark.createDataFrame([("12.9", 3.7, "1.5"), ("x", None, "y")], "lastreportedhousingpayment string, W49_AUC1002 double, PIE_v4 string")
    out = [tuple(r) for r in scoring.cast_legacy_loan_inputs(df).collect()]
    assert out == [(12, 3, 1.5), (None, None, None)]


def test_training_learns_and_split_is_stable(spark):
    df = spark.range(2000).selectExpr("id", "CAST(id % 50 AS DOUBLE) AS x", "CAST(id % 7 AS DOUBLE) AS z", "CAST(3 * (id % 50) AS DOUBLE) AS y")
    train, test = training.split_rows(df, ["id"])
    again, _ = training.split_rows(df.repartition(7), ["id"])
    assert train.count() + test.count() == 2000 and train.exceptAll(again).count() == 0
    assert 0.2 < test.count() / 2000 < 0.3
    packaged = training.train_boosted_trees(train, ["x", "z"], "y", rounds=4)
    spread = np.std([r["y"] for r in test.select("y").collect()])
    assert training.rmse(packaged, test, "y") < spread / 3
    assert packaged.importances()["x"] > 0.9
    assert packaged.model.transform(test).select(F.count("prediction")).first()[0] == test.count()


@pytest.mark.parametrize("model", [
    LinearModel({"a": 2.0, "b": -1.0}, 0.5), LinearModel({"a": 2.0, "b": 1.0}, 0.5, missing=float("nan")), LinearModel({"a": 1.0}, link="logistic"),
    TreeModel([{"feature": "a", "below": 1.0, "yes": {"leaf": 1.0}, "no": {"leaf": float("nan")}, "missing": "no"}]),
    TreeModel([{"feature": "b", "below": 0.0, "yes": {"leaf": 1.0}, "no": {"leaf": 2.0}, "missing": "yes"}], base=0.25),
])
def test_engines_agree_on_missing_and_infinite_values(spark, model):
    values = [None, float("nan"), float("inf"), float("-inf"), 0.0, 1.0, -2.5]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate((a, b) for a in values for b in values)], "i int, a double, b double")
    found = [
        {r["i"]: repr(r["s"]) for r in scoring.score(df, model, "s", where="i % 3 > 0", engine=e).collect()} for e in ("column", "arrow")
    ]
    assert found[0] == found[1] and found[0][0] == "None"


def mean_of(columns):
    return lambda batch: batch[columns].mean(axis=1)


def doubled(df):
    return df.withColumn("a", df["a"] * 2)


def test_user_models_and_preparations_live_in_the_table(spark, tmp_path):
    import sys

    custom = scoring.CustomModel(["a", "b"], f"{__name__}:mean_of", {"columns": ["a", "b"]})
    prepared = scoring.PreparedModel(LinearModel({"a": 1.0}), f"{__name__}:doubled")
    table = scoring.ModelTable.from_models(spark, [("own", 1, "Production", custom), ("own", 2, "None", prepared)])
    table.write(str(tmp_path / "models"))
    again = scoring.ModelTable.read(spark, str(tmp_path / "models"))
    df = spark.createDataFrame([(1.0, 3.0)], "a double, b double")
    assert scoring.score(df, again.resolve("models:/own"), "s").first().asDict() == {"a": 1.0, "b": 3.0, "s": 2.0}
    assert again.resolve("models:/own/1").load()(__import__("pandas").DataFrame({"a": [1.0], "b": [3.0]})).tolist() == [2.0]
    assert again.latest_version("own") == 2 and again.latest_version("other") == 1 and __name__ in sys.modules
    with pytest.raises(ValueError):
        scoring.CustomModel(["a"], lambda: None).to_json()
