"""Gold tables: aggregates and analytic columns over cleaned silver."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.columns import (
    altitude_bin,
    day_start,
    elapsed_seconds,
    grid_cell,
    half_hour_start,
    hour_start,
)
from contrail.operators.quantiles import exact_quantile
from contrail.session import settle


def _count_true(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def _timed(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("time_position").isNotNull())


def _placed(silver: DataFrame) -> DataFrame:
    """Rows with a time and valid coordinates."""
    return silver.where(
        "time_position IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL"
        " AND lat_valid = 1 AND lon_valid = 1"
    )


def gold_country_totals(silver: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals per country, and per `by`; rows without a country are left out."""
    return (
        silver.where(F.col("origin_country").isNotNull())
        .groupBy(*by, "origin_country")
        .agg(
            F.count("icao24").alias("total_flights"),
            F.avg("velocity").alias("avg_velocity"),
            F.sum(F.col("on_ground").cast("int")).alias("on_ground"),
        )
    )


def country_shares(silver: DataFrame, by: Sequence[str]) -> DataFrame:
    """What these rows add to the totals per country and `by`: sums and counts, which can be added up."""
    return (
        silver.where(F.col("origin_country").isNotNull())
        .groupBy(*by, "origin_country")
        .agg(
            F.count("icao24").alias("flights"),
            F.sum("velocity").alias("velocity_sum"),
            F.count("velocity").alias("velocity_count"),
            F.sum(F.col("on_ground").cast("int")).alias("on_ground"),
        )
    )


def totals_of_shares(shares: DataFrame, by: Sequence[str]) -> DataFrame:
    """`gold_country_totals` of all rows whose shares are given."""
    return shares.groupBy(*by, "origin_country").agg(
        F.sum("flights").alias("total_flights"),
        F.try_divide(F.sum("velocity_sum"), F.sum("velocity_count")).alias("avg_velocity"),
        F.sum("on_ground").alias("on_ground"),
    )


HOURLY = ["window_start", "origin_country"]


def _hourly(silver: DataFrame) -> DataFrame:
    return _timed(silver).withColumn("window_start", hour_start(F.col("time_position")))


def hourly_figures(silver: DataFrame) -> DataFrame:
    """Hourly figures per country that need one aggregation: all but the median.

    The distinct count is spread over aircraft before it is summed, so a
    dominant country or hour is never gathered in one task.
    """
    return (
        _hourly(silver)
        .groupBy(*HOURLY)
        .agg(
            F.countDistinct("icao24").alias("unique_flights"),
            F.count(F.lit(1)).alias("total_flights"),
            F.avg("velocity_validated").alias("avg_velocity"),
            F.max("velocity_validated").alias("max_velocity"),
            _count_true(F.col("on_ground")).alias("on_ground_count"),
            _count_true(~F.col("on_ground")).alias("airborne_count"),
            F.avg("baro_altitude").alias("avg_baro_altitude"),
            F.avg("geo_altitude").alias("avg_geo_altitude"),
            (F.avg(F.col("lat_valid") * F.col("lon_valid")) * 100).alias("position_validity_pct"),
            _count_true(F.col("airborne_position_valid") == 1).alias("valid_airborne_positions"),
        )
    )


def gold_flight_aggregations(silver: DataFrame) -> DataFrame:
    """Hourly figures per country of cleaned silver, with the exact median."""
    medians = exact_quantile(_hourly(silver), "velocity_validated", 0.5, HOURLY, "median_velocity")
    return hourly_figures(silver).join(medians, HOURLY, "left").select(
        *HOURLY,
        "unique_flights",
        "total_flights",
        "avg_velocity",
        "median_velocity",
        "max_velocity",
        "on_ground_count",
        "airborne_count",
        "avg_baro_altitude",
        "avg_geo_altitude",
        "position_validity_pct",
        "valid_airborne_positions",
    )


def gold_aircraft_activity(silver: DataFrame) -> DataFrame:
    return (
        _timed(silver)
        .groupBy("icao24", "origin_country")
        .agg(
            F.min("time_position").alias("first_seen"),
            F.max("time_position").alias("last_seen"),
            F.count(F.lit(1)).alias("position_count"),
            F.avg("velocity_validated").alias("avg_velocity"),
            F.max("velocity_validated").alias("max_velocity"),
            F.avg("baro_altitude").alias("avg_altitude"),
            _count_true(F.col("on_ground")).alias("ground_time_samples"),
            _count_true(~F.col("on_ground")).alias("airborne_time_samples"),
        )
    )


def aircraft_days(silver: DataFrame) -> DataFrame:
    """Activity of one day per aircraft and country, as sums and counts, which can be added up."""
    return (
        _timed(silver)
        .groupBy("icao24", "origin_country", F.to_date("time_position").alias("day"))
        .agg(
            F.min("time_position").alias("first_seen"),
            F.max("time_position").alias("last_seen"),
            F.count(F.lit(1)).alias("position_count"),
            F.sum("velocity_validated").alias("velocity_sum"),
            F.count("velocity_validated").alias("velocity_count"),
            F.max("velocity_validated").alias("max_velocity"),
            F.sum("baro_altitude").alias("altitude_sum"),
            F.count("baro_altitude").alias("altitude_count"),
            _count_true(F.col("on_ground")).alias("ground_time_samples"),
            _count_true(~F.col("on_ground")).alias("airborne_time_samples"),
        )
    )


def activity_of_days(days: DataFrame) -> DataFrame:
    """`gold_aircraft_activity` of the days given."""
    return days.groupBy("icao24", "origin_country").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sum("position_count").alias("position_count"),
        F.try_divide(F.sum("velocity_sum"), F.sum("velocity_count")).alias("avg_velocity"),
        F.max("max_velocity").alias("max_velocity"),
        F.try_divide(F.sum("altitude_sum"), F.sum("altitude_count")).alias("avg_altitude"),
        F.sum("ground_time_samples").alias("ground_time_samples"),
        F.sum("airborne_time_samples").alias("airborne_time_samples"),
    )


def gold_altitude_distribution(silver: DataFrame, bin_width: int = 1000) -> DataFrame:
    """Histogram of barometric altitude per hour and country."""
    return (
        _timed(silver)
        .where(F.col("baro_altitude").isNotNull())
        .groupBy(
            hour_start(F.col("time_position")).alias("window_start"),
            "origin_country",
            altitude_bin(F.col("baro_altitude"), bin_width).alias("altitude_bin"),
        )
        .agg(
            F.count(F.lit(1)).alias("total_positions"),
            F.countDistinct("icao24").alias("unique_flights"),
        )
    )


def gold_flight_density_heatmap(silver: DataFrame) -> DataFrame:
    """Positions per hour on a one-degree grid."""
    return (
        _placed(silver)
        .groupBy(
            hour_start(F.col("time_position")).alias("window_start"),
            grid_cell(F.col("latitude")).alias("latitude_bin"),
            grid_cell(F.col("longitude")).alias("longitude_bin"),
        )
        .agg(
            F.countDistinct("icao24").alias("unique_flights"),
            F.count(F.lit(1)).alias("total_positions"),
            F.avg("velocity_validated").alias("avg_velocity"),
            F.avg("baro_altitude").alias("avg_baro_altitude"),
            _count_true(~F.col("on_ground")).alias("airborne_positions"),
        )
    )


def daily_figures(aggregations: DataFrame) -> DataFrame:
    """The hourly table (or `hourly_figures`) summed up by day and country."""
    return aggregations.groupBy(day_start(F.col("window_start")).alias("date"), "origin_country").agg(
        F.sum("total_flights").alias("daily_flights"),
        F.avg("avg_velocity").alias("daily_avg_velocity"),
        F.sum("airborne_count").alias("daily_airborne"),
        F.sum("on_ground_count").alias("daily_on_ground"),
    )


def daily_summary_of(daily: DataFrame) -> DataFrame:
    """Ratio, moving average and change of `daily_figures`.

    The moving average spans the last seven rows of the country, whether or
    not days are missing. A country has one row per day here, so its window
    is bounded by the calendar.
    """
    by_day = Window.partitionBy("origin_country").orderBy("date")
    return daily.select(
        "date",
        "origin_country",
        "daily_flights",
        "daily_avg_velocity",
        "daily_airborne",
        "daily_on_ground",
        F.try_divide("daily_on_ground", "daily_flights").alias("on_ground_ratio"),
        F.avg("daily_flights").over(by_day.rowsBetween(-6, 0)).alias("flights_7day_avg"),
        (F.col("daily_flights") - F.lag("daily_flights").over(by_day)).alias("dod_change"),
    )


def gold_country_daily_summary(aggregations: DataFrame) -> DataFrame:
    """Daily roll-up of the hourly table (or of `hourly_figures`)."""
    return daily_summary_of(daily_figures(aggregations))


def closing_points(silver: DataFrame) -> DataFrame:
    """The last placed point of every aircraft on each of its days."""
    placed = _placed(silver).select("icao24", F.to_date("time_position").alias("_day"), "time_position", "latitude", "longitude")
    return placed.groupBy("icao24", "_day").agg(
        F.max("time_position").alias("time_position"),
        F.max_by("latitude", "time_position").alias("latitude"),
        F.max_by("longitude", "time_position").alias("longitude"),
    )


def gold_flight_trajectories(
    silver: DataFrame, gap_seconds: int = 3600, since: date | None = None, closing: DataFrame | None = None
) -> DataFrame:
    """Link every point of an aircraft to the one before it.

    Points are shuffled by aircraft and day, which after de-duplication to
    whole seconds holds at most 86,400 rows. The last point of each day is
    added to the aircraft's next active day as a marker, so that links across
    midnight come out of the same window; markers are dropped afterwards.

    With `since`, only points from that day on are given. Of the time before,
    each aircraft's last point is still found, as the start of its first link.
    With `closing`, `silver` may hold any choice of whole days: the
    `closing_points` given, of these and earlier days, take the place of the
    days that it lacks.
    """
    placed = _placed(silver)
    points = placed if since is None else placed.where(F.col("time_position") >= F.lit(since))
    points = points.select(
        "icao24",
        F.to_date("time_position").alias("_day"),
        "time_position",
        "latitude",
        "longitude",
        "origin_country",
        "baro_altitude",
        "velocity_validated",
        "true_track",
        "on_ground",
        F.lit(False).alias("_marker"),
    )
    if closing is None:
        closing = closing_points(silver if since is None else silver.where(F.col("time_position") >= F.lit(since)))
        if since is not None:
            earlier = placed.where(F.col("time_position") < F.lit(since)).groupBy("icao24")
            last = earlier.agg(F.max_by(F.struct("time_position", "latitude", "longitude"), "time_position").alias("p")).select("icao24", "p.*")
            closing = closing.unionByName(last.withColumn("_day", F.to_date("time_position")))
    next_day = F.lead("_day").over(Window.partitionBy("icao24").orderBy("_day"))
    markers = (
        closing.withColumn("_day", next_day)
        .where(F.col("_day").isNotNull())
        .withColumn("_marker", F.lit(True))
    )
    track = Window.partitionBy("icao24", "_day").orderBy("time_position")
    linked = (
        points.unionByName(markers, allowMissingColumns=True)
        .withColumns(
            {
                "start_time": F.lag("time_position").over(track),
                "start_latitude": F.lag("latitude").over(track),
                "start_longitude": F.lag("longitude").over(track),
            }
        )
        .where(~F.col("_marker"))
    )
    delta = elapsed_seconds(F.col("start_time"), F.col("time_position"))
    return linked.withColumn("time_delta_seconds", delta).select(
        hour_start(F.col("time_position")).alias("window_start"),
        "icao24",
        "origin_country",
        "start_time",
        F.col("time_position").alias("end_time"),
        "start_latitude",
        "start_longitude",
        F.col("latitude").alias("end_latitude"),
        F.col("longitude").alias("end_longitude"),
        "baro_altitude",
        "velocity_validated",
        "true_track",
        "on_ground",
        "time_delta_seconds",
        F.coalesce(F.col("time_delta_seconds") > gap_seconds, F.lit(True)).alias("is_new_segment"),
    )


def gold_speed_anomalies(silver: DataFrame, k: float = 2.0) -> DataFrame:
    """Distance of each velocity from its hour's mean, in standard deviations.

    A window by hour would gather each hour in one task. Instead the hours are
    summarised (with map-side combine), that summary is settled, and its real
    size decides between a broadcast join and a shuffled one.
    """
    rows = (
        _timed(silver)
        .where(F.col("velocity_validated").isNotNull())
        .select(
            hour_start(F.col("time_position")).alias("window_start"),
            "icao24",
            "origin_country",
            "time_position",
            "velocity_validated",
        )
    )
    hours = settle(
        rows.groupBy("window_start").agg(
            F.avg("velocity_validated").alias("hourly_mean_velocity"),
            F.stddev_samp("velocity_validated").alias("hourly_stddev_velocity"),
        ),
        "hours",
    )
    distance = F.abs(F.col("velocity_validated") - F.col("hourly_mean_velocity"))
    return rows.join(hours, "window_start").select(
        "window_start",
        "icao24",
        "origin_country",
        "time_position",
        "velocity_validated",
        "hourly_mean_velocity",
        "hourly_stddev_velocity",
        F.try_divide(distance, "hourly_stddev_velocity").alias("z_score"),
        F.coalesce(distance > k * F.col("hourly_stddev_velocity"), F.lit(False)).alias("is_anomaly"),
    )


def gold_top_busiest_countries(silver: DataFrame) -> DataFrame:
    """Countries ranked by flights in each 30-minute slot.

    Ranking runs over counts, one row per country, not over reports.
    """
    counts = (
        _timed(silver)
        .groupBy(half_hour_start(F.col("time_position")).alias("window_start"), "origin_country")
        .agg(
            F.countDistinct("icao24").alias("unique_flights"),
            F.count(F.lit(1)).alias("total_flights"),
        )
    )
    busiest = Window.partitionBy("window_start").orderBy(F.desc("total_flights"))
    return counts.select(
        "window_start",
        F.rank().over(busiest).alias("rank"),
        F.dense_rank().over(busiest).alias("dense_rank"),
        "origin_country",
        "unique_flights",
        "total_flights",
    )
