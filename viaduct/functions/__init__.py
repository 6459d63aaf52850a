"""Scalar functions of the traffic model, all Catalyst expressions."""

from .calendar import (format_ts, hour_label, is_night, is_rush_hour, is_weekend, parse_ts,
                       time_features, weekday_number)
from .geo import haversine_km, valid_coordinates
from .mobility import classify_weather, ride_fare, road_type
from .numeric import round_half_even, round_numeric
from .registry import register_sql_functions
from .text import normalize_road_name, sensor_id_for_road
from .traffic import (congestion_index, congestion_level, expected_speed, marker_color,
                      rule_vehicle_count, traffic_density)

__all__ = [
    "classify_weather", "congestion_index", "congestion_level", "expected_speed", "format_ts",
    "haversine_km", "hour_label", "is_night", "is_rush_hour", "is_weekend", "marker_color",
    "normalize_road_name", "parse_ts", "register_sql_functions", "ride_fare", "road_type",
    "round_half_even", "round_numeric", "rule_vehicle_count", "sensor_id_for_road", "time_features",
    "traffic_density", "valid_coordinates", "weekday_number",
]
