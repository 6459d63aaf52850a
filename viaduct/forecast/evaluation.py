"""Error measures of a regression."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def evaluate_regression(scored: DataFrame, prediction: str = "prediction", actual: str = "vehicle_count",
                        by: tuple[str, ...] = ()) -> DataFrame:
    """RMSE, MAE, R2 and MAPE (in percent) in one aggregate, per group of `by` if given.

    Actuals of zero are left out of MAPE; if there are no others it is 0. Where all actuals are
    equal R2 is 1 for a perfect prediction and 0 otherwise.
    """
    known = scored.where(F.col(prediction).isNotNull() & F.col(actual).isNotNull())
    truth = F.col(actual).cast("double")
    error = truth - F.col(prediction)
    sums = known.groupBy(*by).agg(
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("MAE"),
        F.var_pop(truth).alias("variance"),
        F.avg(F.when(truth != 0, F.abs(error / F.when(truth != 0, truth)))).alias("relative"),
        F.count(F.lit(1)).alias("n"))
    r2 = (F.when(F.col("variance") != 0, 1 - F.col("mse") / F.when(F.col("variance") != 0, F.col("variance")))
          .when(F.col("mse") == 0, 1.0).when(F.col("n") > 0, 0.0))
    return sums.select(*by, F.sqrt("mse").alias("RMSE"), "MAE", r2.alias("R2"),
                       F.when(F.col("n") > 0, F.coalesce(F.col("relative"), F.lit(0.0)) * 100).alias("MAPE"))


def compare_models(scored: dict[str, DataFrame], prediction: str = "prediction",
                   actual: str = "vehicle_count") -> DataFrame:
    """One row of measures per model, over the test rows each has scored."""
    if not scored:
        raise ValueError("no model to compare")
    named = [df.select(F.lit(name).alias("model_name"), F.col(prediction).cast("double").alias("prediction"),
                       F.col(actual).cast("double").alias("actual")) for name, df in scored.items()]
    return evaluate_regression(reduce(DataFrame.unionAll, named), "prediction", "actual", by=("model_name",))


def compare_predictions(scored: DataFrame, predictions: dict[str, str], actual: str = "vehicle_count",
                        by: tuple[str, ...] = ()) -> DataFrame:
    """One row of measures per model, and per group of `by`, over one frame that holds all predictions; `predictions`
    names their columns.

    The rows are read once, however many models there are.
    """
    if not predictions:
        raise ValueError("no model to compare")
    each = F.array(*[F.struct(F.lit(name).alias("model_name"), F.col(column).cast("double").alias("prediction"))
                     for name, column in predictions.items()])
    long = scored.select(*by, F.col(actual).cast("double").alias("actual"), F.inline(each))
    return evaluate_regression(long, "prediction", "actual", by=("model_name", *by))


def best_model(metrics: DataFrame) -> DataFrame:
    """The row with the greatest R2; of equal ones the first by name."""
    return metrics.orderBy(F.desc_nulls_last("R2"), "model_name").limit(1)
