"""Column expressions used by every layer.

All of them are built-in Spark functions, so they stay inside whole-stage
code generation; there is no Python UDF in this package.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, functions as F

from cabrank.functions import codes

When = "Column | dt.date | dt.datetime | str"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment(as_of: When) -> Column:
    """A reference time given as a literal or as a column (e.g. a scalar subquery)."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (str, dt.datetime)):
        return F.lit(as_of).cast("timestamp_ntz")
    return F.lit(as_of)


# --- labels -----------------------------------------------------------------


def label(code: Column | str, names: Mapping, default: str | None = None) -> Column:
    """Name of a code; ``default`` (or null) where the code is not listed."""
    code = col(code)
    pairs = iter(names.items())
    first_code, first_name = next(pairs)
    chain = F.when(code == first_code, first_name)
    for value, name in pairs:
        chain = chain.when(code == value, name)
    return chain if default is None else chain.otherwise(default)


def payment_method(code: Column | str = "payment_type") -> Column:
    return label(code, codes.PAYMENT_METHODS, "Other")


def rate_type(code: Column | str = "rate_code_id") -> Column:
    return label(code, codes.RATE_TYPES, "Unknown")


def day_name(day_of_week: Column | str = "pickup_day_of_week") -> Column:
    """English day name; Sunday is 1."""
    return label(day_of_week, codes.DAY_NAMES)


def distance_band(miles: Column | str = "trip_distance") -> Column:
    miles = col(miles)
    chain = F
    for bound, name in codes.DISTANCE_BANDS.items():
        chain = chain.when(miles <= bound, name)
    return chain.otherwise(codes.LONGEST_BAND)


def day_part(hour: Column | str = "pickup_hour") -> Column:
    hour = col(hour)
    chain = F
    for name, (first, last) in codes.DAY_PARTS.items():
        chain = chain.when(hour.between(first, last), name)
    return chain.otherwise(codes.NIGHT)


def weekend_aware_day_part(hour: Column | str = "pickup_hour", weekend: Column | str = "is_weekend") -> Column:
    """Six parts of the day. Evening hours win over the weekend, the other named hours do not."""
    hour, weekday = col(hour), ~col(weekend)
    parts = codes.DAY_PARTS
    chain = F
    for name in ("Morning Rush", "Evening Rush", "Daytime"):
        chain = chain.when(hour.between(*parts[name]) & weekday, name)
    return (
        chain.when(hour.between(*parts["Evening"]), "Evening")
        .when(col(weekend), "Weekend")
        .otherwise(codes.NIGHT)
    )


def rush_or_not(hour: Column | str = "pickup_hour", weekend: Column | str = "is_weekend") -> Column:
    in_rush = col(hour).isin(7, 8, 9, 17, 18, 19) & ~col(weekend)
    return F.when(in_rush, "Rush Hour").otherwise("Non-Rush Hour")


def is_airport(zone: Column | str, any_case: bool = False) -> Column:
    zone = col(zone)
    words = codes.AIRPORT_WORDS_ANY_CASE if any_case else codes.AIRPORT_WORDS
    matches = [zone.ilike(f"%{w}%") if any_case else zone.contains(w) for w in words]
    return reduce(lambda a, b: a | b, matches)


# --- time -------------------------------------------------------------------


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from start to end, as the clocks of the session's zone show them.

    Both are taken without zone, so a time with a zone and one without can be compared.
    (``timestampdiff`` would do the same, but costs ten times as much per row.)
    """
    start, end = (F.unix_timestamp(col(t).cast("timestamp_ntz")) for t in (start, end))
    return end - start


def minutes_between(start: Column | str, end: Column | str) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def hours_between(start: Column | str, end: Column | str) -> Column:
    return seconds_between(start, end) / F.lit(3600.0)


def whole_days_between(start: Column | str, end: Column | str) -> Column:
    """Completed 24-hour days, which is not the number of midnights passed."""
    return F.floor(seconds_between(start, end) / F.lit(86400.0)).cast("int")


def days_before(as_of: When, days: int) -> Column:
    return F.date_sub(moment(as_of).cast("date"), days)


def get_hour(ts: Column | str) -> Column:
    return F.hour(col(ts))


def get_day_of_week(ts: Column | str) -> Column:
    """Monday is 0."""
    return F.weekday(col(ts))


# --- measures ---------------------------------------------------------------


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, null when b is zero."""
    return F.try_divide(col(a), col(b))


def rounded(value: Column | str, digits: int) -> Column:
    """Round half up, as for decimals.

    Amounts are decimals held in binary; noise below 1e-9 is removed first, so
    that a mean of exactly one half is not rounded down by its last bit.
    """
    return F.round(F.round(col(value), 9), digits)


def calculate_tip_percentage(tip: Column | str = "tip_amount", fare: Column | str = "fare_amount") -> Column:
    tip, fare = col(tip), col(fare)
    return F.when(fare > 0, tip / fare * 100).otherwise(0.0)


def calculate_speed(miles: Column | str, seconds: Column | str) -> Column:
    """Miles per hour, 0 when the duration is not positive."""
    miles, seconds = col(miles), col(seconds)
    return F.when(seconds > 0, miles / (seconds / F.lit(3600.0))).otherwise(0.0)


def surge_revenue(
    fare: Column | str = "total_fare",
    tips: Column | str = "tips",
    tolls: Column | str = "tolls",
    surge: Column | str = "surge_multiplier",
) -> Column:
    """Part of the fare that is due to a surge multiplier above 1."""
    surge = col(surge)
    net = col(fare) - col(tips) - col(tolls)
    return F.when(surge > 1, net * (surge - 1) / surge).otherwise(0.0)


def z_score(value: Column | str, mean: Column | str, spread: Column | str) -> Column:
    return ratio(col(value) - col(mean), spread)


def clip(value: Column | str, lower=None, upper=None) -> Column:
    """Bound a value; a null stays null."""
    value = col(value)
    bounded = value
    if lower is not None:
        bounded = F.greatest(bounded, F.lit(lower))
    if upper is not None:
        bounded = F.least(bounded, F.lit(upper))
    return F.when(value.isNotNull(), bounded)


def full_name(first: Column | str = "first_name", last: Column | str = "last_name") -> Column:
    """First and last name; null when either is missing."""
    return F.concat(col(first), F.lit(" "), col(last))


def short_label(text: Column | str, length: int = 20) -> Column:
    text = col(text)
    return F.when(F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))).otherwise(text)
