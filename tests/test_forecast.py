import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from viaduct import forecast
from viaduct.forecast.training import boosted_subsampled, forest, gbt, linear


@pytest.fixture(scope="module")
def known(spark):
    """Training rows whose count is a known function of speed and lanes."""
    n = F.col("id")
    return spark.range(400).select(
        n.alias("event_id"), (n % 24).cast("double").alias("hour"), (n % 7).cast("double").alias("day_of_week"),
        F.lit(1.0).alias("month"), (n % 2).cast("double").alias("is_weekend"), (n % 3 % 2).cast("double").alias("is_rush_hour"),
        (n * 7 % 31).cast("double").alias("temperature_celsius"), (n * 11 % 43).cast("double").alias("humidity_percent"),
        (n * 37 % 90).cast("double").alias("average_speed_kmh"), (2 + n * 5 % 3).cast("double").alias("num_lanes"),
        (50 + n * 13 % 60).cast("double").alias("speed_limit_kmh"),
        (100.0 + 2 * (n * 37 % 90) + 30 * (2 + n * 5 % 3)).cast("double").alias("vehicle_count"))


def test_rule_gives_427_and_high(spark):
    row = spark.createDataFrame([(8, 3, True, False, 60)], "hour int, num_lanes int, is_rush_hour boolean, "
                                "is_weekend boolean, speed_limit_kmh int")
    scored = forecast.score_congestion(row).first()
    assert (scored.predicted_vehicle_count, scored.predicted_congestion_level) == (427, "HIGH")
    assert (scored.predicted_average_speed, scored.predicted_congestion_index) == (22.0, 0.63)


def test_missing_features_take_their_defaults(spark):
    scored = forecast.score_vehicle_count(spark.createDataFrame([(None,), (4,)], "num_lanes int"))
    assert sorted(r.predicted_count for r in scored.collect()) == [225.0, 300.0]
    assert scored.first().temperature_celsius == 25.0


def test_forecast_of_a_day(spark):
    day = forecast.forecast_24h(spark.createDataFrame([(7, 3)], "road_id int, num_lanes int"))
    got = {r.hour_label: r.predicted_vehicles for r in day.collect()}
    assert len(got) == 24 and [got[h] for h in ("00:00", "06:00", "08:00", "12:00", "18:00", "23:00")] == [45, 225, 427, 225, 427, 45]


def test_measures(spark):
    frame = spark.createDataFrame([("a", 10.0, 12.0), ("a", 20.0, 16.0), ("a", 0.0, 3.0), ("b", 5.0, 5.0), ("c", 0.0, 1.0),
                                   ("b", 5.0, 5.0), ("d", None, 1.0)], "m string, vehicle_count double, prediction double")
    got = {r.m: r for r in forecast.evaluate_regression(frame, by=("m",)).collect()}
    assert got["a"].RMSE == pytest.approx((29 / 3) ** 0.5) and got["a"].MAE == 3
    assert got["a"].R2 == pytest.approx(1 - 29 / 200) and got["a"].MAPE == pytest.approx(20)
    assert (got["b"].R2, got["b"].MAPE) == (1.0, 0.0)
    assert (got["c"].R2, got["c"].MAPE) == (0.0, 0.0)
    assert "d" not in got


def test_split_is_stable_and_whole(spark):
    frame = spark.range(5000)
    train, test = forecast.split(frame, "id")
    again = forecast.split(frame.repartition(7).orderBy(F.desc("id")), "id")[1]
    assert train.count() + test.count() == 5000 and train.join(test, "id").count() == 0
    assert 0.17 < test.count() / 5000 < 0.23
    assert rows(test) == rows(again)
    assert rows(forecast.split(frame, "id", seed=1)[1]) != rows(test)


def test_raw_names_and_incomplete_rows(spark, known):
    raw = known.withColumnsRenamed({"temperature_celsius": "temperature", "humidity_percent": "humidity"})
    raw = raw.withColumn("num_lanes", F.when(F.col("event_id") > 9, F.col("num_lanes")))
    prepared = forecast.prepare_features(raw, keep=("event_id",))
    assert prepared.count() == 390 and set(forecast.FEATURES) <= set(prepared.columns)


def test_standardised_columns(known):
    scaled = forecast.standardized(known).agg(F.avg("z_average_speed_kmh"), F.stddev_samp("z_average_speed_kmh"), F.max("z_month"))
    mean, spread, constant = scaled.first()
    assert mean == pytest.approx(0, abs=1e-9) and spread == pytest.approx(1) and constant == 0


def test_known_coefficients_are_found(known):
    train, test = forecast.split(known, "event_id")
    model = forecast.train_linear(train)
    measures = forecast.evaluate_regression(model.transform(test)).first()
    assert measures.RMSE < 1e-6 and measures.R2 == pytest.approx(1)


def test_models_are_compared_kept_and_loaded(spark, known, tmp_path):
    train, test = forecast.split(known, "event_id")
    trained = forecast.train_models(train, test, {"linear_regression": linear(), "random_forest": forest(5, 4),
                                                  "gradient_boosting": gbt(5)})
    assert trained.best_name == "linear_regression" and trained.metrics.count() == 3
    path = str(tmp_path / "model")
    assert forecast.load_model(spark, path) == (None, None)
    forecast.save_model(trained.best, path, name=trained.best_name, metrics={"R2": 1.0},
                        trained_at=dt.datetime(2024, 1, 1))
    model, record = forecast.load_model(spark, path)
    assert record["best_algorithm"] == "linear_regression" and record["feature_columns"] == list(forecast.FEATURES)
    scored = forecast.score_vehicle_count(test, model)
    assert scored.where(F.abs(F.col("predicted_count") - F.col("vehicle_count")) > 1e-6).count() == 0
    assert forecast.score_congestion(test, model).where("predicted_vehicle_count < 0").count() == 0


def test_prediction_is_never_negative(spark, known):
    model = forecast.train_linear(known)
    low = spark.createDataFrame([(-10000.0,)], "average_speed_kmh double")
    assert forecast.score_vehicle_count(low, model).first().predicted_count == 0.0


def test_boosted_and_cross_validated(known):
    model = forecast.train_boosted_subsampled(known, stages=3)
    settings = boosted_subsampled()
    assert model.stages[-1].getOrDefault("depth") == 5
    assert [settings.getOrDefault(p) for p in ("trees", "depth", "step", "columns", "alpha")] == [100, 5, 0.1, 0.3, 10.0]
    checked = forecast.cross_validated(known, linear(), "event_id", folds=3)
    assert checked.avgMetrics[0] == pytest.approx(1)


def test_predictions_meet_what_happened(spark):
    scored = spark.createDataFrame([(1, 100, "LOW", 55.0), (2, 50, "HIGH", 20.0)], "road_id int, predicted_vehicle_count int, "
                                   "predicted_congestion_level string, predicted_average_speed double")
    at = F.lit("2024-01-01 07:30:00").cast("timestamp_ntz")
    made = forecast.record_predictions(scored, model_name="m", prediction_type="CONGESTION", predicted_at=at, horizon_minutes=60)
    events = spark.createDataFrame([(1, "2024-01-01 08:10:00", 90, 0.1), (1, "2024-01-01 08:50:00", 95, 0.6), (2, "2024-01-01 09:00:00", 1, 0.1)],
                                   "road_id int, t string, vehicle_count int, congestion_index double").withColumn(
                                       "timestamp", F.col("t").cast("timestamp_ntz"))
    met = {r.road_id: r for r in forecast.with_actuals(made, events).collect()}
    assert (met[1].actual_vehicle_count, met[1].actual_congestion_level, met[1].rmse) == (93, "MEDIUM", 7.0)
    assert (met[2].actual_vehicle_count, met[2].rmse) == (None, None)
    with pytest.raises(ValueError):
        forecast.record_predictions(scored, model_name="m", prediction_type="OTHER", predicted_at=at, horizon_minutes=60)


def test_grid_search_scores_rows_that_a_fit_has_not_seen(known):
    candidates = {"all": (linear(), forecast.FEATURES), "hour": (linear(), ("hour",))}
    found = forecast.grid_search(known, candidates, key="event_id")
    by_fold = {(r.model_name, r.fold): r for r in found.by_fold.collect()}
    assert set(by_fold) == {(name, fold) for name in candidates for fold in range(5)}
    assert all(by_fold["all", fold].R2 == pytest.approx(1.0) and by_fold["hour", fold].R2 < 0.5 for fold in range(5))
    assert found.best_name == "all" and len(found.means.collect()) == 2
    assert found.best.transform(known).where("abs(prediction - vehicle_count) > 1e-6").count() == 0
    with pytest.raises(ValueError):
        forecast.grid_search(known, {}, key="event_id")
