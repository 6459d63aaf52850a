"""The scalar functions under the same names in SQL.

Each is a temporary SQL function, so Catalyst inlines the body and nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import calendar, geo, mobility, text, traffic

_RUSH = " OR ".join(f"hour BETWEEN {low} AND {high}" for low, high in calendar.RUSH_HOURS)
_WEEKEND = ", ".join(str(day) for day in calendar.WEEKEND_DAYS)
_LEVELS = " ".join(f"WHEN index < {bound} THEN '{name}'" for bound, name in traffic.LEVEL_BOUNDS)
_COLORS = " ".join(f"WHEN '{level}' THEN '{color}'" for level, color in traffic.MARKER_COLORS.items())
_DAYS = " ".join(f"WHEN '{name}' THEN {number}" for number, name in enumerate(calendar.DAY_NAMES))

# (signature, return type, body)
SQL_FUNCTIONS = (
    ("valid_coordinates(lat DOUBLE, lon DOUBLE)", "BOOLEAN",
     "coalesce(lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180, false)"),
    ("haversine_km(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE)", "DOUBLE",
     f"{2 * geo.EARTH_RADIUS_KM}D * asin(sqrt(least(1D, pow(sin(radians(lat2 - lat1) / 2), 2)"
     " + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))))"),
    ("normalize_road_name(name STRING)", "STRING",
     f"CASE WHEN name RLIKE r'{text.TIDY}' THEN initcap(name) ELSE replace(initcap(regexp_replace("
     f"trim(regexp_replace(replace(coalesce(name, ''), '{text.MARK}', ''), r'{text.BLANKS}', ' ')),"
     f" r'{text.INNER_WORD}', '{text.MARK} ')),"
     f" '{text.MARK} ', '') END"),
    ("sensor_id_for_road(name STRING)", "STRING", "concat('SENSOR_', upper(replace(name, ' ', '_')), '_01')"),
    ("traffic_density(vehicles DOUBLE, length_km DOUBLE, lanes INT)", "DOUBLE",
     "CASE WHEN length_km <= 0 OR lanes <= 0 THEN 0D ELSE vehicles / (length_km * lanes) END"),
    ("congestion_index(speed DOUBLE, speed_limit DOUBLE)", "DOUBLE",
     "CASE WHEN speed IS NULL OR speed_limit IS NULL THEN NULL"
     " WHEN speed_limit <= 0 OR speed >= speed_limit THEN 0D"
     " ELSE greatest(0D, least(1D, 1D - speed / speed_limit)) END"),
    ("congestion_level(index DOUBLE)", "STRING",
     f"CASE WHEN index IS NULL THEN NULL {_LEVELS} ELSE '{traffic.TOP_LEVEL}' END"),
    ("marker_color(level STRING)", "STRING", f"CASE level {_COLORS} ELSE '{traffic.OTHER_MARKER_COLOR}' END"),
    ("is_rush_hour(hour INT)", "BOOLEAN", _RUSH),
    ("is_weekend(day_of_week INT)", "BOOLEAN", f"day_of_week IN ({_WEEKEND})"),
    ("weekday_number(day_name STRING)", "INT", f"CASE day_name {_DAYS} END"),
    ("hour_label(hour INT)", "STRING", "format_string('%02d:00', hour)"),
    ("expected_speed(vehicles DOUBLE, lanes INT, speed_limit DOUBLE)", "DOUBLE",
     f"CASE WHEN vehicles IS NULL OR lanes IS NULL THEN NULL ELSE speed_limit * greatest({traffic.SPEED_FACTOR_MIN}D,"
     f" least({traffic.SPEED_FACTOR_MAX}D, coalesce(1D - vehicles / (CASE WHEN lanes > 0 THEN lanes END"
     f" * {traffic.VEHICLES_PER_LANE} * {traffic.SATURATION}D), {traffic.SPEED_FACTOR_MIN}D))) END"),
    ("rule_vehicle_count(hour INT, lanes INT, rush BOOLEAN, weekend BOOLEAN)", "DOUBLE",
     f"floor(lanes * {traffic.VEHICLES_PER_LANE} * CASE WHEN hour >= {calendar.NIGHT_FROM}"
     f" OR hour <= {calendar.NIGHT_UNTIL} THEN {traffic.FACTOR_NIGHT}D WHEN rush THEN {traffic.FACTOR_RUSH}D"
     f" WHEN weekend THEN {traffic.FACTOR_WEEKEND}D ELSE {traffic.FACTOR_OTHER}D END)"),
    ("classify_weather(rain_mm DOUBLE, humidity DOUBLE, temperature DOUBLE, wind_kmh DOUBLE)", "STRING",
     f"CASE WHEN rain_mm > {mobility.HEAVY_RAIN_MM} THEN 'Rainy' WHEN rain_mm > 0 THEN 'Drizzle'"
     f" WHEN humidity > {mobility.FOG_HUMIDITY} AND temperature < {mobility.FOG_BELOW_CELSIUS} THEN 'Foggy'"
     f" WHEN wind_kmh > {mobility.STORM_WIND_KMH} AND temperature > {mobility.STORM_ABOVE_CELSIUS} THEN 'Sandstorm'"
     " ELSE 'Sunny' END"),
    ("ride_fare(distance_km DOUBLE, minutes DOUBLE)", "DOUBLE",
     f"{mobility.FARE_BASE}D + distance_km * {mobility.FARE_PER_KM}D + minutes * {mobility.FARE_PER_MINUTE}D"),
    ("road_type(speed_limit_kmh INT)", "STRING",
     f"CASE WHEN speed_limit_kmh <= {mobility.URBAN_LIMIT_KMH} THEN 'Urban' ELSE 'Highway' END"),
)


def register_sql_functions(spark: SparkSession) -> None:
    for signature, returns, body in SQL_FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {returns} RETURN {body}")
