"""Time of day, week and year. Monday is day 0; the weekend is Friday and Saturday."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the traffic model.
RUSH_HOURS = ((7, 9), (17, 19))
WEEKEND_DAYS = (4, 5)
NIGHT_FROM, NIGHT_UNTIL = 23, 5
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def is_rush_hour(hour: Column) -> Column:
    (morning_from, morning_to), (evening_from, evening_to) = RUSH_HOURS
    return hour.between(morning_from, morning_to) | hour.between(evening_from, evening_to)


def is_night(hour: Column) -> Column:
    return (hour >= NIGHT_FROM) | (hour <= NIGHT_UNTIL)


def is_weekend(day_of_week: Column) -> Column:
    return day_of_week.isin(*WEEKEND_DAYS)


def parse_ts(text: Column) -> Column:
    """ISO-8601 text to an instant; null where the text is no timestamp."""
    return F.try_to_timestamp(text)


def format_ts(ts: Column) -> Column:
    """ISO-8601 text with the UTC offset spelled out; the fraction only where there is one.

    The session timezone must be UTC, as `session.DEFAULTS` sets it.
    """
    fraction = F.when(F.date_format(ts, "SSSSSS") == "000000", F.lit("")).otherwise(
        F.date_format(ts, ".SSSSSS"))
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))


def time_features(ts: Column) -> dict[str, Column]:
    """The calendar columns of an event, for `DataFrame.withColumns`."""
    hour, day = F.hour(ts), F.weekday(ts)
    return {
        "hour": hour,
        "day_of_week": day,
        "month": F.month(ts),
        "is_weekend": is_weekend(day),
        "is_rush_hour": is_rush_hour(hour),
    }


def weekday_number(day_name: Column) -> Column:
    """0 for Monday to 6 for Sunday; null for any other text."""
    pairs = [F.lit(x) for number, name in enumerate(DAY_NAMES) for x in (name, number)]
    return F.try_element_at(F.create_map(*pairs), day_name)


def hour_label(hour: Column) -> Column:
    return F.format_string("%02d:00", hour)
