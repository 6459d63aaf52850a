"""Density, congestion and the capacity rule."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .calendar import is_night

# Fixed values of the traffic model.
LEVEL_BOUNDS = ((0.25, "LOW"), (0.5, "MEDIUM"), (0.75, "HIGH"))
TOP_LEVEL = "CRITICAL"
CONGESTED_LEVELS = ("HIGH", "CRITICAL")
MARKER_COLORS = {"LOW": "green", "MEDIUM": "orange", "HIGH": "red", "CRITICAL": "darkred"}
OTHER_MARKER_COLOR = "blue"
VEHICLES_PER_LANE = 150
SATURATION = 1.5
SPEED_FACTOR_MIN, SPEED_FACTOR_MAX = 0.1, 1.1
FACTOR_NIGHT, FACTOR_RUSH, FACTOR_WEEKEND, FACTOR_OTHER = 0.1, 0.95, 0.35, 0.5


def traffic_density(vehicle_count: Column, length_km: Column, num_lanes: Column) -> Column:
    """Vehicles per kilometre and lane; 0 where the road has no length or no lane."""
    lane_km = length_km * num_lanes
    no_road = (length_km <= 0) | (num_lanes <= 0)
    return F.when(no_road, F.lit(0.0)).otherwise(vehicle_count.cast("double") / lane_km)


def congestion_index(speed: Column, limit: Column) -> Column:
    """The share of the speed limit that is lost, within 0..1; null where speed or limit is."""
    free = (limit <= 0) | (speed >= limit)
    lost = F.lit(1.0) - speed / limit
    return (F.when(speed.isNull() | limit.isNull(), F.lit(None).cast("double"))
            .when(free, F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), lost))))


def congestion_level(index: Column) -> Column:
    level = F.when(index.isNull(), F.lit(None).cast("string"))
    for bound, name in LEVEL_BOUNDS:
        level = level.when(index < bound, name)
    return level.otherwise(TOP_LEVEL)


def marker_color(level: Column) -> Column:
    pairs = [F.lit(x) for pair in MARKER_COLORS.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), level), F.lit(OTHER_MARKER_COLOR))


def base_capacity(num_lanes: Column) -> Column:
    return num_lanes * VEHICLES_PER_LANE


def expected_speed(vehicle_count: Column, num_lanes: Column, limit: Column) -> Column:
    """Speed to expect at a vehicle count: the limit, scaled down as the road fills; least where there is no lane."""
    lanes = F.when(num_lanes > 0, num_lanes)
    free = F.coalesce(F.lit(1.0) - vehicle_count / (base_capacity(lanes) * SATURATION), F.lit(SPEED_FACTOR_MIN))
    factor = F.greatest(F.lit(SPEED_FACTOR_MIN), F.least(F.lit(SPEED_FACTOR_MAX), free))
    return F.when(vehicle_count.isNull() | num_lanes.isNull(), F.lit(None)).otherwise(limit * factor)


def rule_vehicle_count(hour: Column, num_lanes: Column, rush: Column, weekend: Column) -> Column:
    """Vehicle count by rule, for when there is no model: a share of the base capacity."""
    share = (F.when(is_night(hour), FACTOR_NIGHT)
             .when(rush, FACTOR_RUSH)
             .when(weekend, FACTOR_WEEKEND)
             .otherwise(FACTOR_OTHER))
    return F.floor(base_capacity(num_lanes) * share).cast("double")
