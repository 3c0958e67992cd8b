"""Demand, surge, weather and live views of the ride service."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cabrank.functions import codes, columns as c
from cabrank.operators import aggregates as a, ordering, windows
from cabrank.operators.clean import completed_rides, since, since_moment
from cabrank.operators.joins import hour_bucket
from cabrank.operators.sizing import lookup


def _named(grouped: DataFrame, zones: DataFrame, *columns: str, key: str = "pickup_zone_id", how: str = "inner") -> DataFrame:
    """Zone names joined to an aggregate by zone id."""
    names = lookup(zones.select(F.col("location_id").alias("_id"), F.col("zone").alias("zone_name"), *columns))
    return grouped.join(names, F.col(key) == F.col("_id"), how).drop("_id")


def ride_hourly_demand_view(rides: DataFrame) -> DataFrame:
    return completed_rides(rides).groupBy(hour_bucket("pickup_datetime").alias("hour"), "pickup_zone_id").agg(
        a.rows(), a.mean("total_fare", "avg_fare"), a.mean("trip_distance", "avg_distance")
    )


def hourly_zone_demand(rides: DataFrame, zones: DataFrame) -> DataFrame:
    """Mean per hour of day, weekday and zone, taken over the single hours."""
    single = completed_rides(rides).groupBy(hour_bucket("pickup_datetime").alias("_hour"), "pickup_zone_id").agg(
        a.rows("_n"), a.mean("total_fare", "_fare"), a.mean("surge_multiplier", "_surge"), a.mean("wait_time", "_wait")
    )
    named = _named(single, zones, "area_type")
    means = named.groupBy(
        F.hour("_hour").alias("hour_of_day"), F.dayofweek("_hour").alias("_dow"), "zone_name", "area_type"
    ).agg(
        a.mean("_n", "avg_trips"),
        a.mean("_fare", "avg_fare"),
        a.mean("_surge", "avg_surge_multiplier"),
        a.mean("_wait", "avg_wait_seconds"),
    )
    return means.withColumn("day_name", c.day_name("_dow")).drop("_dow")


def surge_opportunities(
    rides: DataFrame, zones: DataFrame, as_of, days: int = 30, min_demand: int = 10, unique_ids: bool = True
) -> DataFrame:
    """Demand against supply per hour and zone.

    ``ride_id`` is the key of the rides, so counting rides is counting distinct
    ids; with ``unique_ids=False`` repeated ids are removed first.
    """
    recent = since(rides, as_of, days, "pickup_datetime")
    keys = ["hour", "pickup_zone_id"]
    ids = {"supply": "driver_id"} if unique_ids else {"supply": "driver_id", "demand": "ride_id"}
    demand = [F.count("ride_id").alias("_n"), *a.partial_sums("wait_time", "total_fare")]
    parts = a.id_cells(recent.withColumn("hour", hour_bucket("pickup_datetime")), keys, list(ids.values()), *demand)
    cells = a.merged_ids(
        parts, keys, ids, *([a.total("_n", "demand")] if unique_ids else []),
        a.merged_mean("wait_time", "avg_wait"), a.merged_mean("total_fare", "avg_fare"),
    )
    ratio = c.ratio("demand", "supply")
    advice = (
        F.when(ratio > 3, "High Surge Recommended")
        .when(ratio > 2, "Moderate Surge Recommended")
        .when(ratio > 1.5, "Low Surge Recommended")
        .otherwise("No Surge Needed")
    )
    busy = _named(cells.filter(F.col("demand") > min_demand), zones)
    return busy.select(
        "hour", "zone_name", "demand", "supply", c.rounded(ratio, 2).alias("demand_supply_ratio"),
        "avg_wait", "avg_fare", advice.alias("surge_recommendation"),
    )


def hour_zone_ratio(rides: DataFrame, zones: DataFrame) -> DataFrame:
    """Rides per distinct driver by hour of day and zone name, over rides of any status."""
    sums = a.partial_sums("total_fare", "surge_multiplier", "wait_time")
    hours = rides.withColumn("hour", F.hour("pickup_datetime"))
    parts = a.id_cells(hours, ["hour", "pickup_zone_id"], ["driver_id"], F.count("ride_id").alias("_n"), *sums)
    # Names meet one row per hour, zone and range of drivers; zones of the same name are merged, their drivers united.
    cells = a.merged_ids(
        _named(parts, zones), ["hour", "zone_name"], {"supply": "driver_id"},
        a.total("_n", "demand"),
        a.merged_mean("total_fare", "avg_fare"),
        a.merged_mean("surge_multiplier", "avg_surge"),
        a.merged_mean("wait_time", "avg_wait"),
    )
    return cells.withColumn("demand_supply_ratio", F.col("demand") / c.clip("supply", lower=1))


def surge_by_hour_zone(ratios: DataFrame, threshold: float = 2, k: int = 20) -> DataFrame:
    """Cells with the highest demand per driver, with the mean ratio of their hour over all zones."""
    hours = ratios.groupBy("hour").agg(a.mean("demand_supply_ratio", "hour_avg_ratio"))
    over = ratios.filter(F.col("demand_supply_ratio") > threshold)
    top = ordering.top_k(over, k, F.desc("demand_supply_ratio"), "hour", "zone_name")
    return top.join(hours, "hour")  # at most 24 rows against k rows


def surge_uplift(ratios: DataFrame, threshold: float = 2, factor: float = 1.5) -> DataFrame:
    """Revenue of the cells above the threshold, now and with a surge factor."""
    revenue = F.col("demand") * F.col("avg_fare")
    sums = ratios.filter(F.col("demand_supply_ratio") > threshold).agg(
        F.sum(revenue).alias("current_revenue"), F.sum(revenue * factor).alias("potential_revenue")
    )
    gain = c.ratio((F.col("potential_revenue") - F.col("current_revenue")) * 100, "current_revenue")
    return sums.withColumn("revenue_increase_pct", gain)


# --- weather ----------------------------------------------------------------


def _weather_pairs(rides: DataFrame, weather: DataFrame, attribute: str) -> DataFrame:
    """Rides and weather reports matched by zone and hour, both reduced to one row per key first.

    The reports of a zone and hour repeat its rides. Joining the counts instead
    of the rows gives the same sums, and a crowded hour stays one row.
    """
    cell = ["_zone", "_hour"]
    reports = (
        weather.groupBy(F.col("zone_id").alias("_zone"), hour_bucket("datetime").alias("_hour"), attribute)
        .agg(a.rows("_reports"))
    )
    measures = ("total_fare", "surge_multiplier", "wait_time")
    trips = rides.groupBy(
        F.col("pickup_zone_id").alias("_zone"), hour_bucket("pickup_datetime").alias("_hour")
    ).agg(F.count("ride_id").alias("_rides"), *a.partial_sums(*measures), F.var_pop("total_fare").alias("_var"))
    return trips.join(reports, cell)


def weather_impact(rides: DataFrame, weather: DataFrame) -> DataFrame:
    """Rides, fare, surge, wait and spread of the fare by weather condition.

    The spread is merged from (count, mean, squared deviations) of the cells: what a cell has inside it, and the
    square of the distance of its mean from that of the condition. No difference of large sums is taken.
    """
    pairs = _weather_pairs(completed_rides(rides), weather, "weather_condition")
    reports = F.col("_reports")
    count = F.col("_cnt_total_fare") * reports
    cell_mean = c.ratio("_sum_total_fare", "_cnt_total_fare")
    sums = pairs.groupBy("weather_condition").agg(
        F.sum(F.col("_rides") * reports).alias("total_trips"),
        a.merged_mean("total_fare", "avg_fare", reports),
        a.merged_mean("surge_multiplier", "avg_surge", reports),
        a.merged_mean("wait_time", "avg_wait_time", reports),
        F.sum(count).alias("_n"),
    )
    # One row per condition of a code list.
    means = sums.select(F.col("weather_condition").alias("_condition"), F.col("avg_fare").alias("_mean"))
    apart = cell_mean - F.col("_mean")
    squares = (
        pairs.join(lookup(means), F.col("weather_condition").eqNullSafe(F.col("_condition")))
        .groupBy("_condition")
        .agg(F.sum(count * (F.col("_var") + apart * apart)).alias("_squares"))
    )
    both = sums.join(squares, F.col("weather_condition").eqNullSafe(F.col("_condition")))
    variance = c.ratio("_squares", F.col("_n") - 1)
    return both.withColumn("fare_stddev", F.sqrt(variance)).drop("_n", "_squares", "_condition")


def weather_surge_contrast(impact: DataFrame, bad=codes.BAD_WEATHER) -> DataFrame:
    """Mean surge of the bad conditions against clear weather."""
    condition = F.col("weather_condition")
    return impact.agg(
        F.avg(F.when(condition.isin(*bad), F.col("avg_surge"))).alias("bad_weather_surge"),
        F.max(F.when(condition == "Clear", F.col("avg_surge"))).alias("clear_weather_surge"),
    )


def temperature_demand(rides: DataFrame, weather: DataFrame) -> DataFrame:
    """Rides by reported temperature, over rides of any status."""
    pairs = _weather_pairs(rides, weather, "temperature").filter(F.col("temperature").isNotNull())
    return pairs.groupBy("temperature").agg(F.sum(F.col("_rides") * F.col("_reports")).alias("trip_count"))


# --- calendar ---------------------------------------------------------------


def ride_hourly_demand(rides: DataFrame) -> DataFrame:
    return rides.groupBy(F.hour("pickup_datetime").alias("hour")).agg(
        F.count("ride_id").alias("trip_count"),
        a.mean("total_fare", "avg_fare"),
        a.mean("surge_multiplier", "avg_surge"),
        a.mean("wait_time", "avg_wait_time"),
    )


def ride_peak_hours(rides: DataFrame, k: int = 5) -> DataFrame:
    return ordering.top_k(ride_hourly_demand(rides), k, F.desc("trip_count"), "hour")


def ride_daily_demand(rides: DataFrame) -> DataFrame:
    """By weekday; Monday is 0."""
    grouped = rides.groupBy(F.weekday("pickup_datetime").alias("day_of_week")).agg(
        F.count("ride_id").alias("trip_count"),
        a.mean("total_fare", "avg_fare"),
        a.mean("trip_distance", "avg_distance"),
        a.mean("passenger_count", "avg_passengers"),
    )
    return grouped.withColumn("day_name", c.day_name((F.col("day_of_week") + 1) % 7 + 1))


def ride_weekend_comparison(rides: DataFrame) -> DataFrame:
    period = F.when(F.weekday("pickup_datetime") >= 5, "Weekend").otherwise("Weekday").alias("period_type")
    return rides.groupBy(period).agg(
        F.count("ride_id").alias("trip_count"), a.mean("total_fare", "avg_fare"), a.mean("surge_multiplier", "avg_surge")
    )


def ride_zone_demand(rides: DataFrame, zones: DataFrame, k: int = 15) -> DataFrame:
    measures = a.partial_sums("total_fare", "wait_time", "surge_multiplier")
    per_id = rides.groupBy("pickup_zone_id").agg(F.count("ride_id").alias("_n"), *measures)
    grouped = _named(per_id, zones, "area_type").groupBy("zone_name", "area_type").agg(
        a.total("_n", "trip_count"),
        a.merged_mean("total_fare", "avg_fare"),
        a.merged_mean("wait_time", "avg_wait_time"),
        a.merged_mean("surge_multiplier", "avg_surge"),
    )
    return ordering.top_k(grouped, k, F.desc("trip_count"), "zone_name", "area_type")


def ride_area_demand(rides: DataFrame, zones: DataFrame) -> DataFrame:
    per_id = rides.groupBy("pickup_zone_id").agg(F.count("ride_id").alias("_n"))
    return _named(per_id, zones, "area_type").groupBy("area_type").agg(a.total("_n", "trip_count"))


def daily_rides(rides: DataFrame) -> DataFrame:
    return rides.groupBy(F.to_date("pickup_datetime").alias("trip_date")).agg(F.count("ride_id").alias("trip_count"))


def ride_moving_average(rides: DataFrame) -> DataFrame:
    """Daily rides with 7- and 14-row means; the window runs on one row per day."""
    return windows.moving_average(daily_rides(rides), "trip_date", "trip_count", {"ma_7": 7, "ma_14": 14})


def ride_wow_trend(rides: DataFrame, n: int = 7) -> DataFrame:
    return windows.last_n_vs_prev_n(daily_rides(rides), "trip_date", "trip_count", n)


# --- live views -------------------------------------------------------------


def active_monitor(rides: DataFrame, as_of, interval: str = "4 hours") -> DataFrame:
    """Rides under way and requested, from the rides of the last hours."""
    under_way = F.col("trip_status") == "InProgress"
    age = c.minutes_between("pickup_datetime", c.moment(as_of))
    return since_moment(rides, as_of, interval).agg(
        a.count_where(under_way, "active_trips"),
        a.distinct(F.when(under_way, F.col("driver_id")), "active_drivers"),
        a.count_where(F.col("trip_status") == "Requested", "pending_requests"),
        F.avg(F.when(under_way, age)).alias("avg_trip_time_minutes"),
    )


def zone_heatmap(rides: DataFrame, zones: DataFrame, as_of) -> DataFrame:
    """Rides, wait and drivers per zone in the last hour and quarter; zones without rides are kept."""
    quarter = F.col("pickup_datetime") >= c.moment(as_of) - F.expr("INTERVAL 15 minutes")
    parts = a.id_cells(
        since_moment(rides, as_of, "1 hour"), ["pickup_zone_id"], ["driver_id"],
        a.rows("_n"), a.count_where(quarter, "_late"), *a.partial_sums("wait_time"),
    )
    live = a.merged_ids(
        parts, ["pickup_zone_id"], {"available_drivers": "driver_id"},
        a.total("_n", "trips_last_hour"), a.total("_late", "trips_last_15_min"), a.merged_mean("wait_time", "avg_wait_time"),
    )
    counts = ["trips_last_hour", "trips_last_15_min", "available_drivers"]
    return (
        zones.join(live, F.col("location_id") == F.col("pickup_zone_id"), "left")
        .select(F.col("zone").alias("zone_name"), "latitude", "longitude", *counts, "avg_wait_time")
        .fillna(0, counts)
    )
