"""Distributed training of the fare model and scoring with packaged lookups."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml import Pipeline as Stages
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorefold.operators.feature_store import FeatureLookup, FeatureStore, add_features
from scorefold.operators.projection import hash_share
from scorefold.operators.scoring import LinearModel, PreparedModel, TreeModel, model_from_json, score
from scorefold.session import ensure_checkpoint_dir


def split_rows(df: DataFrame, key: Sequence[str], test_share: float = 0.25, seed: int = 123) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of ``key``: the same row always falls on the same side."""
    bucket = hash_share(key, seed)
    return df.filter(bucket >= test_share), df.filter(bucket < test_share)


_MANIFEST, _MODEL = "manifest", "model"


@dataclass(frozen=True)
class PackagedModel:
    """A trained model, or a model spec, with the lookups its inputs come from."""

    model: PipelineModel | LinearModel | TreeModel | PreparedModel
    features: Sequence[str]
    lookups: Sequence[FeatureLookup] = ()

    def importances(self) -> dict[str, float]:
        """Share of the total gain per feature."""
        return dict(zip(self.features, (float(x) for x in self.model.stages[-1].featureImportances.toArray())))

    def rounds(self) -> int:
        """Trees that boosting kept."""
        return self.model.stages[-1].getNumTrees

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``."""
        if isinstance(self.model, PipelineModel):
            return self.model.transform(df).drop("_features")
        return score(df, self.model, "prediction")

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the package to a folder: a manifest of features and lookups, and the model beside it."""
        trained = isinstance(self.model, PipelineModel)
        manifest = {
            "features": list(self.features),
            "lookups": [[one.table_name, list(one.feature_names), list(one.lookup_key)] for one in self.lookups],
            "spec": None if trained else self.model.to_json(),
        }
        if trained:
            self.model.write().overwrite().save(f"{path}/{_MODEL}")
        spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{_MANIFEST}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> PackagedModel:
        manifest = json.loads(spark.read.text(f"{path}/{_MANIFEST}", wholetext=True).first()["value"])
        model = model_from_json(manifest["spec"]) if manifest["spec"] else PipelineModel.load(f"{path}/{_MODEL}")
        return PackagedModel(model, tuple(manifest["features"]), tuple(FeatureLookup(*one) for one in manifest["lookups"]))


def train_boosted_trees(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    lookups: Sequence[FeatureLookup] = (),
    rounds: int = 100,
    max_depth: int = 5,
    seed: int = 123,
    checkpoint_interval: int = 10,
    validation: str | None = None,
    tolerance: float = 0.01,
) -> PackagedModel:
    """Gradient-boosted regression trees; depth 5 gives up to 32 leaves.

    Rows with a missing feature are kept and sent through as NaN.  Rows where
    the boolean column ``validation`` is true are not learned from: boosting
    stops before ``rounds`` once a round lowers their error by less than
    ``tolerance`` (relative), and keeps the trees up to the best round.
    """
    ensure_checkpoint_dir(train.sparkSession)
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")
    trees = GBTRegressor(
        featuresCol="_features", labelCol=label, maxIter=rounds, maxDepth=max_depth, seed=seed,
        checkpointInterval=checkpoint_interval, validationTol=tolerance, **({"validationIndicatorCol": validation} if validation else {}),
    )
    return PackagedModel(Stages(stages=[assembler, trees]).fit(train), tuple(features), tuple(lookups))


def with_validation(train: DataFrame, key: Sequence[str], share: float = 0.1, seed: int = 321, column: str = "_validation") -> DataFrame:
    """Marks a share of the training rows, by a hash of ``key``, as those that decide when to stop."""
    return train.withColumn(column, hash_share(key, seed) < share)


def rmse(packaged: PackagedModel, test: DataFrame, label: str) -> float:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse").evaluate(packaged.predict(test))


def quality(packaged: PackagedModel, train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """One row: rows on each side, the error on the held-out side, and that of the training mean there."""
    error, y = F.col("prediction") - F.col(label), F.col(label)
    learned = train.agg(F.avg(y).alias("mean"), F.count("*").alias("n")).first()
    mean = F.lit(learned["mean"]).cast("double")
    return packaged.predict(test).agg(
        F.lit(learned["n"]).alias("train_rows"), F.count("*").alias("test_rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"), F.sqrt(F.avg((y - mean) * (y - mean))).alias("mean_rmse"))


def score_batch(store: FeatureStore, packaged: PackagedModel | str, df: DataFrame) -> DataFrame:
    """Fetch the model's features by its own lookups and add ``prediction``; a text is the folder of a saved package."""
    if isinstance(packaged, str):
        packaged = PackagedModel.load(store.spark, packaged)
    return packaged.predict(add_features(store, df, packaged.lookups))
