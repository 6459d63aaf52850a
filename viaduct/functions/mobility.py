"""Weather labels, road types and ride fares."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the traffic model.
URBAN_LIMIT_KMH = 60
HEAVY_RAIN_MM, FOG_HUMIDITY, FOG_BELOW_CELSIUS = 5.0, 75.0, 18.0
STORM_WIND_KMH, STORM_ABOVE_CELSIUS = 25.0, 35.0
FARE_BASE, FARE_PER_KM, FARE_PER_MINUTE = 15.0, 7.5, 1.5


def classify_weather(rain_mm: Column, humidity: Column, temperature: Column, wind_kmh: Column, *,
                     heavy_rain_mm: float = HEAVY_RAIN_MM, fog_humidity: float = FOG_HUMIDITY,
                     fog_below_celsius: float = FOG_BELOW_CELSIUS, storm_wind_kmh: float = STORM_WIND_KMH,
                     storm_above_celsius: float = STORM_ABOVE_CELSIUS) -> Column:
    """Label one weather observation; rain comes before fog, fog before sandstorm."""
    return (F.when(rain_mm > heavy_rain_mm, "Rainy")
            .when(rain_mm > 0, "Drizzle")
            .when((humidity > fog_humidity) & (temperature < fog_below_celsius), "Foggy")
            .when((wind_kmh > storm_wind_kmh) & (temperature > storm_above_celsius), "Sandstorm")
            .otherwise("Sunny"))


def ride_fare(distance_km: Column, duration_minutes: Column) -> Column:
    return F.lit(FARE_BASE) + distance_km * FARE_PER_KM + duration_minutes * FARE_PER_MINUTE


def road_type(speed_limit_kmh: Column) -> Column:
    return F.when(speed_limit_kmh <= URBAN_LIMIT_KMH, "Urban").otherwise("Highway")
