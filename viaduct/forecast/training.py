"""Fitting, comparing and keeping regression models."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VarianceThresholdSelector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import shared_dir
from .boosting import HistogramBoosting
from .evaluation import best_model, compare_predictions
from .features import FEATURES, LABEL, SCALED, bucket_of, feature_stages
from .forest import HistogramForest

SEED = 42
FOREST_DEPTH = 30
# Histograms of the upper nodes that a task sums in one pass over the rows.
FOREST_MEMORY_MB = 256


def _fit(train: DataFrame, regressor: Estimator, features: tuple[str, ...] = FEATURES) -> PipelineModel:
    return Pipeline(stages=[*feature_stages(features), regressor]).fit(train)


def linear() -> Pipeline:
    """Least squares over the features that vary: a constant one would make the equations singular."""
    return Pipeline(stages=[
        VarianceThresholdSelector(featuresCol=SCALED, outputCol="varying", varianceThreshold=0.0),
        LinearRegression(featuresCol="varying", labelCol=LABEL),
    ])


def forest(trees: int = 100, depth: int = FOREST_DEPTH, memory_mb: int = FOREST_MEMORY_MB) -> HistogramForest:
    """Deep trees over a third of the features per node; small nodes are grown within tasks."""
    return HistogramForest(featuresCol=SCALED, labelCol=LABEL, trees=trees, depth=depth, memoryMB=memory_mb, seed=SEED)


def gbt(stages: int = 100) -> GBTRegressor:
    return GBTRegressor(featuresCol=SCALED, labelCol=LABEL, maxIter=stages, maxDepth=3, seed=SEED)


def boosted_subsampled(stages: int = 100, alpha: float = 10.0) -> HistogramBoosting:
    """Boosting with a small step, an L1 term on the leaf weights, and 30 % of the features drawn per tree."""
    return HistogramBoosting(featuresCol=SCALED, labelCol=LABEL, trees=stages, depth=5, step=0.1, columns=0.3,
                             alpha=alpha, seed=SEED)


def train_linear(train: DataFrame, features: tuple[str, ...] = FEATURES) -> PipelineModel:
    """Ordinary least squares."""
    return _fit(train, linear(), features)


def train_forest(train: DataFrame, trees: int = 100, depth: int = FOREST_DEPTH) -> PipelineModel:
    shared_dir(train.sparkSession)
    return _fit(train, forest(trees, depth))


def train_gbt(train: DataFrame, stages: int = 100) -> PipelineModel:
    return _fit(train, gbt(stages))


def train_boosted_subsampled(train: DataFrame, stages: int = 100, alpha: float = 10.0) -> PipelineModel:
    return _fit(train, boosted_subsampled(stages, alpha))


@dataclass(frozen=True)
class TrainedModels:
    models: dict[str, PipelineModel]
    metrics: DataFrame
    best_name: str

    @property
    def best(self) -> PipelineModel:
        return self.models[self.best_name]


def train_models(train: DataFrame, test: DataFrame, regressors: dict[str, Estimator] | None = None) -> TrainedModels:
    """Fit each regressor on the training rows and choose the one with the best R2 on the test rows.

    Fitting goes over the rows many times, so they are checkpointed in the shared folder first: the
    joins behind them run once, and a lost executor does not bring them back.
    """
    if regressors is None:
        regressors = {"linear_regression": linear(), "random_forest": forest(),
                      "gradient_boosting": gbt(), "boosted_subsampled": boosted_subsampled()}
    shared_dir(train.sparkSession)
    train, test = train.checkpoint(), test.checkpoint()
    models = {name: _fit(train, regressor) for name, regressor in regressors.items()}
    metrics = compare_predictions(*score_all(models, test)).checkpoint()
    return TrainedModels(models, metrics, best_model(metrics).first()["model_name"])


def score_all(models: dict[str, PipelineModel], rows: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows with one prediction column per model, and the names of these columns."""
    own, columns = rows.columns, {}
    for place, (name, model) in enumerate(models.items()):
        columns[name] = f"prediction_{place}"
        rows = model.transform(rows).withColumnRenamed("prediction", columns[name]).select(*own, *columns.values())
    return rows, columns


def cross_validated(train: DataFrame, regressor: Estimator, key: str, grid: list | None = None,
                    folds: int = 5) -> CrossValidator:
    """Choose parameters by cross-validation on R2, with folds by a hash of the key."""
    folded = train.withColumn("__fold", bucket_of(F.col(key), folds, SEED).cast("int"))
    validator = CrossValidator(
        estimator=Pipeline(stages=[*feature_stages(), regressor]), numFolds=folds, foldCol="__fold",
        estimatorParamMaps=grid or ParamGridBuilder().build(),
        evaluator=RegressionEvaluator(labelCol=LABEL, metricName="r2"))
    return validator.fit(folded)


@dataclass(frozen=True)
class Searched:
    by_fold: DataFrame  # model_name, fold and the measures
    means: DataFrame    # model_name and the means of the measures over the folds
    best_name: str
    best: PipelineModel


def grid_search(train: DataFrame, candidates: dict[str, tuple[Estimator, tuple[str, ...]]], key: str,
                folds: int = 5) -> Searched:
    """Fit every candidate, (regressor, features) by name, once without each fold, and the best on all rows.

    Folds are a hash of the key, stored with the rows in the shared folder; the fits read them from there. Each row is
    then scored by the fits that have not seen it, for all candidates and folds in one scan, and the measures of all
    come from one aggregate. The best has the greatest mean R2, of equal ones the first by name.
    """
    if not candidates:
        raise ValueError("no candidate to fit")
    shared_dir(train.sparkSession)
    folded = train.withColumn("fold", bucket_of(F.col(key), folds, SEED).cast("int")).checkpoint()
    scored, columns = folded, {}
    for place, (name, (regressor, features)) in enumerate(candidates.items()):
        unseen = F.lit(None).cast("double")
        own = scored.columns
        for fold in range(folds):
            model = _fit(folded.where(F.col("fold") != fold), regressor, features)
            scored = (model.transform(scored).withColumnRenamed("prediction", f"__p{fold}")
                      .select(*own, *[f"__p{k}" for k in range(fold + 1)]))
            unseen = F.when(F.col("fold") == fold, F.col(f"__p{fold}")).otherwise(unseen)
        columns[name] = f"prediction_{place}"
        scored = scored.select(*own, unseen.alias(columns[name]))
    by_fold = compare_predictions(scored, columns, by=("fold",)).checkpoint()
    measures = [c for c in by_fold.columns if c not in ("model_name", "fold")]
    means = by_fold.groupBy("model_name").agg(*[F.avg(c).alias(c) for c in measures])
    best = best_model(means).first()["model_name"]
    return Searched(by_fold, means, best, _fit(folded, *candidates[best]))


def save_model(model: PipelineModel, path: str, *, name: str, metrics: dict[str, float],
               trained_at: dt.datetime) -> None:
    """The fitted pipeline, scaler included, and a JSON record about it."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path.rstrip('/')}/model")
    record = json.dumps({"best_algorithm": name, "feature_columns": list(FEATURES), "metrics": metrics,
                         "trained_timestamp": trained_at.isoformat()})  # fixed values: the keys of the record
    spark.createDataFrame([(record,)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path.rstrip('/')}/metadata")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel | None, dict | None]:
    """What `save_model` kept; (None, None) where there is nothing, so that the rule scores instead."""
    try:
        record = spark.read.text(f"{path.rstrip('/')}/metadata").first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None, None
        raise
    return PipelineModel.load(f"{path.rstrip('/')}/model"), json.loads(record["value"])
