"""Queries for training rows, scores, models and their errors."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from .. import forecast
from ..functions import round_numeric, time_features
from ..forecast import FEATURES, demand
from ..forecast.features import LABEL
from ..forecast.training import linear
from ..session import shared_dir, shared_path
from .catalog import query, rounded
from .model import ntz
from .scalars import RULE_SQL

TRAINING_SQL = """(SELECT e.*, r.road_name, r.num_lanes, r.speed_limit_kmh, r.length_km, w.temperature_celsius,
   w.humidity_percent, w."timestamp" AS timestamp_weather
 FROM traffic_events e JOIN roads r ON e.road_id = r.road_id JOIN weather_data w ON e.weather_id = w.weather_id)"""


def _training(m) -> DataFrame:
    return forecast.build_training_set(m.events, m.roads, m.weather)


@query("build_training_set", f"""
SELECT event_id, road_name, num_lanes, speed_limit_kmh, temperature_celsius, humidity_percent, timestamp_weather, vehicle_count
FROM {TRAINING_SQL}""")
def build_training_set(m):
    return _training(m).select("event_id", "road_name", "num_lanes", "speed_limit_kmh", "temperature_celsius",
                               "humidity_percent", "timestamp_weather", "vehicle_count")


def _z(name: str) -> str:
    x = f"CAST({name} AS DOUBLE)" if not name.startswith("is_") else f"CAST(CAST({name} AS INT) AS DOUBLE)"
    spread = f"(stddev_samp({x}) OVER ())"
    return f"""{rounded(f"CASE WHEN {spread} = 0 THEN 0e0 ELSE ({x} - avg({x}) OVER ()) / {spread} END")} AS z_{name}"""


@query("prepare_features", f"SELECT event_id, {', '.join(_z(name) for name in FEATURES)} FROM {TRAINING_SQL}")
def prepare_features(m):
    scaled = forecast.standardized(forecast.prepare_features(_training(m), keep=("event_id",)), keep=("event_id",))
    return scaled.withColumns({f"z_{name}": round_numeric(F.col(f"z_{name}"), 6) for name in FEATURES})


IN_TEST = "CAST('0x' || substr(md5('42:' || CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 20"


@query("split", f"SELECT event_id, {IN_TEST} AS is_test FROM raw_events")
def split(m):
    train, test = forecast.split(m.raw_events, "event_id")
    return train.select("event_id", F.lit(False).alias("is_test")).unionAll(
        test.select("event_id", F.lit(True).alias("is_test")))


def _scored_by_rule(m) -> DataFrame:
    return forecast.score_vehicle_count(m.placed_events.withColumns(time_features(F.col("timestamp"))))


RULE_SCORES = f"""(SELECT e.*, r.num_lanes, r.speed_limit_kmh, {RULE_SQL} AS predicted_count
 FROM traffic_events e JOIN roads r ON e.road_id = r.road_id)"""


@query("score_vehicle_count", f"SELECT event_id, predicted_count FROM {RULE_SCORES}")
def score_vehicle_count(m):
    return _scored_by_rule(m).select("event_id", "predicted_count")


CONGESTION_SCORES = f"""(SELECT *, CASE WHEN speed >= speed_limit_kmh THEN 0e0 ELSE 1e0 - speed / speed_limit_kmh END AS idx
 FROM (SELECT *, speed_limit_kmh * greatest(0.1e0, least(1.1e0, 1e0 - predicted_count / (num_lanes * 150 * 1.5e0))) AS speed
       FROM {RULE_SCORES}))"""
LEVEL_OF_IDX = """CASE WHEN idx < 0.25e0 THEN 'LOW' WHEN idx < 0.5e0 THEN 'MEDIUM'
  WHEN idx < 0.75e0 THEN 'HIGH' ELSE 'CRITICAL' END"""


@query("score_congestion", f"""
SELECT event_id, CAST(predicted_count AS INT) AS predicted_vehicle_count,
       round_even(speed * 10, 0) / 10 AS predicted_average_speed, round_even(idx * 100, 0) / 100 AS predicted_congestion_index,
       {LEVEL_OF_IDX} AS predicted_congestion_level
FROM {CONGESTION_SCORES}""")
def score_congestion(m):
    scored = forecast.score_congestion(m.placed_events.withColumns(time_features(F.col("timestamp"))))
    return scored.select("event_id", "predicted_vehicle_count", "predicted_average_speed",
                         "predicted_congestion_index", "predicted_congestion_level")


@query("forecast_24h", f"""
SELECT road_id, day, lpad(CAST(hour AS VARCHAR), 2, '0') || ':00' AS hour_label, CAST({RULE_SQL} AS INT) AS predicted_vehicles
FROM (SELECT d.*, r.num_lanes, CAST(h AS INT) AS hour, h IN (7, 8, 9, 17, 18, 19) AS is_rush_hour
      FROM (SELECT DISTINCT road_id, CAST("timestamp" AS DATE) AS day, is_weekend FROM traffic_events) d
      JOIN roads r ON d.road_id = r.road_id, range(24) t(h))""")
def forecast_24h(m):
    days = m.placed_events.select("road_id", "num_lanes", F.to_date("timestamp").alias("day")).distinct()
    day = time_features(F.col("day").cast("timestamp_ntz"))
    forecasts = forecast.forecast_24h(days.withColumn("is_weekend", day["is_weekend"]))
    return forecasts.select("road_id", "day", "hour_label", "predicted_vehicles")


def _measures_sql(scores: str, prediction: str, keys: str = "") -> str:
    error = f"(vehicle_count - {prediction})"
    return f"""
SELECT {keys} {rounded(f"sqrt(avg({error} * {error}))", 4)} AS RMSE, {rounded(f"avg(abs({error}))", 4)} AS MAE,
       {rounded(f"1 - avg({error} * {error}) / var_pop(vehicle_count)")} AS R2,
       {rounded(f"100 * avg(CASE WHEN vehicle_count <> 0 THEN abs({error} / vehicle_count) END)", 4)} AS MAPE
FROM {scores}"""


def _tidy_measures(df: DataFrame) -> DataFrame:
    return df.withColumns({name: round_numeric(F.col(name), 6 if name == "R2" else 4)
                           for name in ("RMSE", "MAE", "R2", "MAPE")})


@query("evaluate_regression", _measures_sql(RULE_SCORES, "predicted_count"))
def evaluate_regression(m):
    return _tidy_measures(forecast.evaluate_regression(_scored_by_rule(m), "predicted_count"))


@query("evaluate_by_road", _measures_sql(RULE_SCORES, "predicted_count", "road_id,") + " GROUP BY road_id")
def evaluate_by_road(m):
    return _tidy_measures(forecast.evaluate_regression(_scored_by_rule(m), "predicted_count", by=("road_id",)))


MODEL_SCORES = f"""(SELECT 'capacity_rule' AS model_name, vehicle_count, predicted_count AS p FROM {RULE_SCORES}
 UNION ALL SELECT 'flat_capacity', vehicle_count, num_lanes * 75e0 FROM {RULE_SCORES}
 UNION ALL SELECT 'speed_rule', vehicle_count, average_speed_kmh FROM {RULE_SCORES})"""


def _compared(m) -> DataFrame:
    scored = _scored_by_rule(m).withColumns({"flat": F.col("num_lanes") * 75.0})
    return forecast.compare_predictions(scored, {
        "capacity_rule": "predicted_count", "flat_capacity": "flat", "speed_rule": "average_speed_kmh"})


@query("compare_models", _measures_sql(MODEL_SCORES, "p", "model_name,") + " GROUP BY model_name")
def compare_models(m):
    return _tidy_measures(_compared(m))


@query("best_model", _measures_sql(MODEL_SCORES, "p", "model_name,") + " GROUP BY model_name ORDER BY R2 DESC LIMIT 1")
def best_model(m):
    return _tidy_measures(forecast.best_model(_compared(m)))


@query("record_predictions", f"""
WITH road_hours AS (
  SELECT e.road_id, date_trunc('hour', "timestamp") AS due_at, CAST(round(avg(vehicle_count)) AS INT) AS actual_vehicle_count,
         {rounded("avg(congestion_index)", 9)} AS actual_index, min(hour) AS hour, bool_or(is_rush_hour) AS is_rush_hour,
         bool_or(is_weekend) AS is_weekend, min(num_lanes) AS num_lanes, min(speed_limit_kmh) AS speed_limit_kmh
  FROM traffic_events e JOIN roads r ON e.road_id = r.road_id GROUP BY 1, 2),
scored AS (SELECT *, {RULE_SQL} AS predicted_count FROM road_hours),
speeds AS (SELECT *, speed_limit_kmh * greatest(0.1e0, least(1.1e0, 1e0 - predicted_count / (num_lanes * 150 * 1.5e0))) AS speed
           FROM scored),
indexes AS (SELECT *, CASE WHEN speed >= speed_limit_kmh THEN 0e0 ELSE 1e0 - speed / speed_limit_kmh END AS idx FROM speeds)
SELECT 'capacity_rule' AS model_name, 'CONGESTION' AS prediction_type, road_id, CAST(NULL AS VARCHAR) AS sensor_id,
       due_at - INTERVAL 60 MINUTE AS predicted_at, CAST(60 AS INT) AS prediction_horizon_minutes,
       CAST(predicted_count AS INT) AS predicted_vehicle_count, {LEVEL_OF_IDX} AS predicted_congestion_level,
       round_even(speed * 10, 0) / 10 AS predicted_avg_speed, CAST(NULL AS DOUBLE) AS confidence_score,
       actual_vehicle_count,
       CASE WHEN actual_index < 0.25e0 THEN 'LOW' WHEN actual_index < 0.5e0 THEN 'MEDIUM'
            WHEN actual_index < 0.75e0 THEN 'HIGH' ELSE 'CRITICAL' END AS actual_congestion_level,
       CAST(abs(CAST(predicted_count AS INT) - actual_vehicle_count) AS DOUBLE) AS rmse
FROM indexes""")
def record_predictions(m):
    at = ntz(F.date_trunc("hour", "timestamp"))
    due = m.placed_events.select("road_id", "num_lanes", "speed_limit_kmh", at.alias("at")).distinct()
    scored = forecast.score_congestion(due.withColumns(time_features(F.col("at"))))
    predictions = forecast.record_predictions(
        scored, model_name="capacity_rule", prediction_type="CONGESTION",
        predicted_at=F.col("at") - F.expr("INTERVAL 60 MINUTES"), horizon_minutes=60)
    return forecast.with_actuals(predictions, m.events)


LINEAR_SQL = f"""
WITH line AS (SELECT regr_slope(vehicle_count, average_speed_kmh) AS slope,
                     regr_intercept(vehicle_count, average_speed_kmh) AS base
              FROM {TRAINING_SQL} WHERE NOT ({IN_TEST}))
SELECT event_id, {rounded("base + slope * average_speed_kmh", 4)} AS prediction
FROM {TRAINING_SQL}, line WHERE {IN_TEST}"""


def _predicted(model, test: DataFrame) -> DataFrame:
    return model.transform(test).select("event_id", round_numeric(F.col("prediction"), 4).alias("prediction"))


@query("train_linear_one_feature", LINEAR_SQL)
def train_linear_one_feature(m):
    train, test = _prepared_split(m)
    return _predicted(forecast.train_linear(train, features=("average_speed_kmh",)), test)


# A label that is linear in the ten features, so that the fit must give it back. The fraction keeps counts, speeds and
# indexes away from where rounding turns.
KNOWN_COUNT = """(20.137e0 + 3 * hour + 2 * day_of_week + 8 * CAST(is_weekend AS DOUBLE) + 25 * CAST(is_rush_hour AS DOUBLE)
  + 4 * temperature_celsius + humidity_percent - 2 * average_speed_kmh + 12 * num_lanes + speed_limit_kmh)"""
KNOWN_SQL = f"SELECT event_id, {rounded(KNOWN_COUNT, 4)} AS prediction FROM {TRAINING_SQL} WHERE {IN_TEST}"


def _known_split(m) -> tuple[DataFrame, DataFrame]:
    return tuple(rows.withColumn(LABEL, F.expr(KNOWN_COUNT)) for rows in _prepared_split(m))


@query("train_linear", KNOWN_SQL)
def train_linear(m):
    train, test = _known_split(m)
    return _predicted(forecast.train_linear(train), test)


@query("save_and_load_model", f"""
SELECT *, 'linear_regression' AS best_algorithm, '{",".join(FEATURES)}' AS feature_columns, 1e0 AS r2,
       '2024-01-31T00:00:00' AS trained_timestamp FROM ({KNOWN_SQL})""")
def save_and_load_model(m):
    """The loaded model scores the test rows, beside what the record says of it."""
    train, test = _known_split(m)
    path = shared_path(m.spark, "model")
    fitted = forecast.train_linear(train)
    measures = forecast.evaluate_regression(fitted.transform(test)).first().asDict()
    forecast.save_model(fitted, path, name="linear_regression", metrics=measures, trained_at=dt.datetime(2024, 1, 31))
    model, record = forecast.load_model(m.spark, path)
    return _predicted(model, test).withColumns({
        "best_algorithm": F.lit(record["best_algorithm"]), "feature_columns": F.lit(",".join(record["feature_columns"])),
        "r2": F.lit(round(record["metrics"]["R2"], 6)), "trained_timestamp": F.lit(record["trained_timestamp"])})


@query("score_congestion_by_model", f"""
SELECT event_id, CAST(trunc(predicted_count) AS INT) AS predicted_vehicle_count,
       round_even(speed * 10, 0) / 10 AS predicted_average_speed, round_even(idx * 100, 0) / 100 AS predicted_congestion_index,
       {LEVEL_OF_IDX} AS predicted_congestion_level
FROM (SELECT *, CASE WHEN speed >= speed_limit_kmh THEN 0e0 ELSE 1e0 - speed / speed_limit_kmh END AS idx
      FROM (SELECT *, speed_limit_kmh * greatest(0.1e0, least(1.1e0, 1e0 - predicted_count / (num_lanes * 150 * 1.5e0))) AS speed
            FROM (SELECT *, greatest(0e0, {KNOWN_COUNT}) AS predicted_count FROM {TRAINING_SQL} WHERE {IN_TEST})))""")
def score_congestion_by_model(m):
    """Scores of a model that was fitted, kept and loaded, not of the rule."""
    train, test = _known_split(m)
    path = shared_path(m.spark, "model")
    forecast.save_model(forecast.train_linear(train), path, name="linear_regression", metrics={},
                        trained_at=dt.datetime(2024, 1, 31))
    model, _ = forecast.load_model(m.spark, path)
    return forecast.score_congestion(test.drop(LABEL), model).select(
        "event_id", "predicted_vehicle_count", "predicted_average_speed", "predicted_congestion_index",
        "predicted_congestion_level")


@query("forecast_24h_by_model", f"""
SELECT event_id, lpad(CAST(hour AS VARCHAR), 2, '0') || ':00' AS hour_label,
       CAST(trunc(greatest(0e0, {KNOWN_COUNT})) AS INT) AS predicted_vehicles
FROM (SELECT t.* EXCLUDE (hour, is_rush_hour), CAST(h AS INT) AS hour, h IN (7, 8, 9, 17, 18, 19) AS is_rush_hour
      FROM (SELECT * FROM {TRAINING_SQL} WHERE {IN_TEST}) t, range(24) r(h))""")
def forecast_24h_by_model(m):
    train, test = _known_split(m)
    forecasts = forecast.forecast_24h(test.drop(LABEL), forecast.train_linear(train))
    return forecasts.select("event_id", "hour_label", "predicted_vehicles")


def _prepared_split(m) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, written to the shared folder once since a fit reads them many times."""
    shared_dir(m.spark)
    prepared = forecast.prepare_features(_training(m), keep=("event_id",)).checkpoint()
    return forecast.split(prepared, "event_id")


def _trained(m, train_model) -> DataFrame:
    train, test = _prepared_split(m)
    return forecast.evaluate_regression(train_model(train).transform(test))


@query("train_linear_all_features")
def train_linear_all_features(m):
    return _trained(m, forecast.train_linear)


_PRODUCTS = " UNION ALL ".join(f"SELECT '{name}' AS feature" for name in ("one", *FEATURES))


@query("train_linear_normal_equations", f"""
SELECT feature, 0e0 AS mean_product, (SELECT count(*) FROM {TRAINING_SQL} WHERE NOT ({IN_TEST})) AS training_rows
FROM ({_PRODUCTS})""")
def train_linear_normal_equations(m):
    """A fit is least squares exactly if its residuals sum to zero on the training rows, alone and by each feature."""
    train, _ = _prepared_split(m)
    fitted = forecast.train_linear(train).transform(train)
    residual = F.col(LABEL) - F.col("prediction")
    means = fitted.agg(
        F.count(F.lit(1)).alias("training_rows"), F.avg(residual).alias("one"),
        *[F.avg(residual * F.col(name)).alias(name) for name in FEATURES])
    return means.select("training_rows", F.inline(F.array(*[
        F.struct(F.lit(name).alias("feature"), F.round(F.abs(F.col(name)), 3).alias("mean_product"))
        for name in ("one", *FEATURES)]))).select("feature", "mean_product", "training_rows")


@query("train_forest")
def train_forest(m):
    return _trained(m, forecast.train_forest)


@query("train_gbt")
def train_gbt(m):
    return _trained(m, forecast.train_gbt)


@query("train_boosted_subsampled")
def train_boosted_subsampled(m):
    return _trained(m, forecast.train_boosted_subsampled)


# A label in steps, which trees of every kind must come close to.
STEPS = "(100e0 + CASE WHEN hour >= 12 THEN 50 ELSE 0 END + CASE WHEN num_lanes >= 3 THEN 30 ELSE 0 END)"
STEPS_SQL = f"SELECT event_id, {STEPS} AS expected, TRUE AS met FROM {TRAINING_SQL} WHERE {IN_TEST}"


def _steps_met(m, train_model, tolerance: float, label: str = STEPS) -> DataFrame:
    """Whether the predictions of the test rows lie within the tolerance of the label."""
    train, test = (rows.withColumn(LABEL, F.expr(label)) for rows in _prepared_split(m))
    scored = train_model(train).transform(test)
    near = F.abs(F.col("prediction") - F.col(LABEL)) <= tolerance
    return scored.select("event_id", F.col(LABEL).alias("expected"), near.alias("met"))


@query("train_forest_on_steps", STEPS_SQL)
def train_forest_on_steps(m):
    return _steps_met(m, forecast.train_forest, 9.0)


@query("train_gbt_on_steps", STEPS_SQL)
def train_gbt_on_steps(m):
    return _steps_met(m, forecast.train_gbt, 1.0)


# Of 100 trees with a tenth's step only those that draw a feature come closer to its steps, and the L1 term weighs on few
# rows: one feature, a wide step, and predictions nearer to it than to the other one.
STEP = "(100e0 + CASE WHEN hour >= 12 THEN 60 ELSE 0 END)"


@query("train_boosted_subsampled_on_steps", STEPS_SQL.replace(STEPS, STEP))
def train_boosted_subsampled_on_steps(m):
    return _steps_met(m, forecast.train_boosted_subsampled, 25.0, STEP)


FOLD = "CAST('0x' || substr(md5('42:' || CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 5"
_FOLDED = f"(SELECT *, {FOLD} AS fold FROM {TRAINING_SQL} WHERE NOT ({IN_TEST}))"
_LINES = " UNION ALL ".join(f"""
SELECT '{name}' AS model_name, f.fold, vehicle_count, base + slope * {feature} AS p
FROM {_FOLDED} f JOIN (SELECT k.fold, regr_slope(vehicle_count, {feature}) AS slope, regr_intercept(vehicle_count, {feature}) AS base
  FROM (SELECT DISTINCT fold FROM {_FOLDED}) k JOIN {_FOLDED} t ON t.fold <> k.fold GROUP BY k.fold) l ON f.fold = l.fold"""
                            for name, feature in (("by_speed", "average_speed_kmh"), ("by_hour", "hour")))


@query("cross_validate", _measures_sql(f"({_LINES})", "p", "model_name, CAST(fold AS INT) AS fold,") + " GROUP BY model_name, fold")
def cross_validate(m):
    train, _ = _prepared_split(m)
    searched = forecast.grid_search(train, {"by_speed": (linear(), ("average_speed_kmh",)), "by_hour": (linear(), ("hour",))},
                                    key="event_id")
    return _tidy_measures(searched.by_fold)


@query("cross_validate_best", f"""
SELECT model_name FROM ({_measures_sql(f"({_LINES})", "p", "model_name, fold,")} GROUP BY model_name, fold)
GROUP BY model_name ORDER BY avg("R2") DESC LIMIT 1""")
def cross_validate_best(m):
    """Kept by the means over the folds; the folds are looked at as in `cross_validate`."""
    train, _ = _prepared_split(m)
    searched = forecast.grid_search(train, {"by_speed": (linear(), ("average_speed_kmh",)), "by_hour": (linear(), ("hour",))},
                                    key="event_id")
    return m.spark.createDataFrame([(searched.best_name,)], "model_name string")


PANEL_SINCE, PANEL_UNTIL = dt.datetime(1995, 1, 1), dt.datetime(2001, 8, 1)
ORIGINS = [dt.datetime(2000, 1, 3), dt.datetime(2001, 1, 1), dt.datetime(2001, 7, 2)]
TEST_DAYS = 7
_PANEL_SQL = f"""(SELECT p.road_id, p."at", coalesce(n, 0) AS rides FROM (
   SELECT road_id, unnest(range(TIMESTAMP '{PANEL_SINCE}', TIMESTAMP '{PANEL_UNTIL + dt.timedelta(days=1)}', INTERVAL 1 DAY)) AS "at" FROM roads) p
 LEFT JOIN (SELECT pickup_road_id AS road_id, date_trunc('day', "timestamp") AS "at", count(*) AS n FROM ride_requests GROUP BY 1, 2) r
   ON p.road_id = r.road_id AND p."at" = r."at")"""
_DEMAND_SQL = f"""(SELECT *, {", ".join(f'lag(rides, {k}) OVER s AS lag_{k}' for k in demand.LAGS)},
  {", ".join(f"""CASE WHEN count(*) OVER (s ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) = {k}
     THEN CAST(sum(rides) OVER (s ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS DOUBLE) / {k} END AS mean_{k}""" for k in demand.FRAMES)}
 FROM {_PANEL_SQL} WINDOW s AS (PARTITION BY road_id ORDER BY "at"))"""
_ORIGINS_SQL = f"""(SELECT d.*, origin, "at" >= origin AS is_test FROM {_DEMAND_SQL} d
 JOIN (SELECT unnest([{", ".join(f"TIMESTAMP '{o}'" for o in ORIGINS)}]) AS origin) o ON "at" < origin + INTERVAL {TEST_DAYS} DAY)"""


def _demand(m) -> tuple[DataFrame, DataFrame]:
    panel = demand.demand_panel(m.rides, m.roads, PANEL_SINCE, PANEL_UNTIL)
    return panel, demand.demand_features(panel)


@query("ride_demand_features", f"SELECT * FROM {_DEMAND_SQL}")
def ride_demand_features(m):
    return _demand(m)[1].withColumns({f"mean_{k}": F.col(f"mean_{k}") for k in demand.FRAMES})


@query("ride_demand_forecasts", f"""
SELECT 'weekly_rule' AS model_name, 'RIDE_DEMAND' AS prediction_type, road_id, "at" - INTERVAL {TEST_DAYS} DAY AS predicted_at,
       CAST({TEST_DAYS * 1440} AS INT) AS prediction_horizon_minutes, CAST(trunc(p) AS INT) AS predicted_vehicle_count,
       CAST(rides AS INT) AS actual_vehicle_count, CAST(abs(CAST(trunc(p) AS INT) - rides) AS DOUBLE) AS rmse
FROM (SELECT *, (lag_7 + lag_14 + lag_21 + lag_28) / 4e0 AS p FROM {_ORIGINS_SQL}) WHERE is_test""")
def ride_demand_forecasts(m):
    """A week ahead of each day from the origins on, recorded, and met by what was asked for."""
    panel, features = _demand(m)
    tested = demand.rolling_origins(features, ORIGINS, TEST_DAYS).where("is_test")
    scored = demand.weekly_rule(tested).withColumn("predicted_vehicle_count", F.col("predicted_count").cast("int"))
    predictions = forecast.record_predictions(
        scored, model_name="weekly_rule", prediction_type="RIDE_DEMAND",
        predicted_at=F.col("at") - F.expr(f"INTERVAL {TEST_DAYS} DAYS"), horizon_minutes=TEST_DAYS * 1440)
    return demand.with_demand_actuals(predictions, panel).drop("sensor_id", "predicted_congestion_level",
                                                               "predicted_avg_speed", "confidence_score")


_DEMAND_ROWS = f"""(SELECT * FROM {_ORIGINS_SQL} WHERE {" AND ".join(f"{c} IS NOT NULL" for c in demand.DEMAND_FEATURES)})"""
_DEMAND_LINES = f"""(SELECT t.origin, rides, base + slope * mean_28 AS p FROM {_DEMAND_ROWS} t
 JOIN (SELECT origin, regr_slope(rides, mean_28) AS slope, regr_intercept(rides, mean_28) AS base
       FROM {_DEMAND_ROWS} WHERE NOT is_test GROUP BY origin) l ON t.origin = l.origin WHERE is_test)"""


@query("ride_demand_rolling_origin", _measures_sql(_DEMAND_LINES, "p", "origin,").replace("vehicle_count", "rides")
       + " GROUP BY origin")
def ride_demand_rolling_origin(m):
    """Least squares on the mean of four weeks, fitted anew at each origin on what was known then."""
    shared_dir(m.spark)
    rows = demand.as_training_rows(demand.rolling_origins(_demand(m)[1], ORIGINS, TEST_DAYS)).checkpoint()
    scored = None
    for origin in ORIGINS:
        own = rows.where(F.col("origin") == F.to_timestamp_ntz(F.lit(str(origin))))
        model = forecast.train_linear(own.where("NOT is_test"), features=("mean_28",))
        part = model.transform(own.where("is_test")).select("origin", LABEL, "prediction")
        scored = part if scored is None else scored.unionAll(part)
    return _tidy_measures(forecast.evaluate_regression(scored, by=("origin",)))
