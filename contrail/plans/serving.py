"""Serving queries over gold tables and predictions.

Each takes the table it reads, and works the same on a lazily derived frame and
on a stored table. Every limit has a full tie-break, so answers are repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.operators.sampling import sample_n


def latest_window(table: DataFrame, ts: str = "window_start") -> DataFrame:
    """Rows of the newest window, found by a scalar subquery.

    On a stored table the date partition is matched as well, so only one
    day's files are read.
    """
    if "window_date" in table.columns:
        newest_day = table.select(F.max("window_date")).scalar()
        table = table.where(F.col("window_date") == newest_day)
    newest = table.select(F.max(ts)).scalar()
    return table.where(F.col(ts) == newest)


def busiest_countries_latest(busiest: DataFrame, n: int = 20) -> DataFrame:
    return (
        latest_window(busiest)
        .select("window_start", "rank", "origin_country", "unique_flights", "total_flights")
        .orderBy("rank", "origin_country")
        .limit(n)
    )


def velocity_trend(aggregations: DataFrame) -> DataFrame:
    """Mean of the country means in every window."""
    return (
        aggregations.groupBy("window_start")
        .agg(F.avg("avg_velocity").alias("global_avg_velocity"))
        .orderBy("window_start")
    )


def density_latest(heatmap: DataFrame) -> DataFrame:
    return (
        latest_window(heatmap)
        .groupBy("latitude_bin", "longitude_bin")
        .agg(F.sum("unique_flights").alias("flights"), F.sum("total_positions").alias("positions"))
    )


def anomalies_by_country(anomalies: DataFrame, n: int = 20) -> DataFrame:
    return (
        latest_window(anomalies)
        .groupBy("window_start", "origin_country")
        .agg(
            F.count(F.lit(1)).alias("total_samples"),
            F.count_if("is_anomaly").alias("anomaly_count"),
            F.avg("z_score").alias("avg_z_score"),
        )
        .orderBy(F.desc("anomaly_count"), "origin_country")
        .limit(n)
    )


def daily_summary(summary: DataFrame, n: int = 500, countries: Sequence[str] | None = None) -> DataFrame:
    """The newest `n` rows, then optionally only some countries of them."""
    rows = (
        summary.select(
            "date",
            "origin_country",
            "daily_flights",
            "daily_avg_velocity",
            "flights_7day_avg",
            "dod_change",
            "on_ground_ratio",
        )
        .orderBy(F.desc("date"), "origin_country")
        .limit(n)
    )
    return rows if countries is None else rows.where(F.col("origin_country").isin(list(countries)))


def available_countries(summary: DataFrame, n: int = 500, preselected: int = 5) -> DataFrame:
    """Countries to choose from among the newest rows; the first few are preselected."""
    names = daily_summary(summary, n).select("origin_country").na.drop().distinct()
    chosen = names.orderBy("origin_country").limit(preselected).withColumn("is_default", F.lit(True))
    return (
        names.join(F.broadcast(chosen), "origin_country", "left")
        .select("origin_country", F.coalesce("is_default", F.lit(False)).alias("is_default"))
        .orderBy("origin_country")
    )


def altitude_latest(distribution: DataFrame) -> DataFrame:
    return (
        latest_window(distribution)
        .groupBy("origin_country", "altitude_bin")
        .agg(F.sum("unique_flights").alias("unique_flights"))
        .orderBy("altitude_bin", "origin_country")
    )


def altitude_top_countries(distribution: DataFrame, n: int = 5) -> DataFrame:
    """Altitude profile of the `n` countries with most flights in the latest window."""
    latest = altitude_latest(distribution)
    top = (
        latest.groupBy("origin_country")
        .agg(F.sum("unique_flights").alias("_flights"))
        .orderBy(F.desc("_flights"), "origin_country")
        .limit(n)
    )
    return latest.join(F.broadcast(top), "origin_country", "left_semi").select(
        "origin_country", "altitude_bin", "unique_flights"
    )


def kpi_velocity(trend: DataFrame) -> DataFrame:
    """Velocity of the newest window and its change from the one before."""
    newest = trend.orderBy(F.desc("window_start")).limit(2)
    latest = F.max_by("global_avg_velocity", "window_start")
    change = F.bround(latest - F.min_by("global_avg_velocity", "window_start"), 1)
    return newest.agg(
        latest.alias("latest_velocity"),
        F.when(F.count(F.lit(1)) == 2, change).alias("velocity_delta"),
    )


def kpi_snapshot(
    busiest: DataFrame, aggregations: DataFrame, anomalies: DataFrame
) -> DataFrame:
    """One row of headline figures of the latest windows."""
    countries = busiest_countries_latest(busiest).agg(
        F.countDistinct("origin_country").alias("countries_tracked"),
        F.sum("unique_flights").alias("unique_flights"),
    )
    flagged = anomalies_by_country(anomalies).agg(F.sum("anomaly_count").alias("speed_anomalies"))
    tiles = [countries, kpi_velocity(velocity_trend(aggregations)), flagged]
    one = countries.sparkSession.range(1)
    # one subquery per tile, not per figure
    found = one.select(*[tile.select(F.struct(*tile.columns)).scalar().alias(f"_{i}") for i, tile in enumerate(tiles)])
    return found.select(*[F.col(f"_{i}.{column}") for i, tile in enumerate(tiles) for column in tile.columns])


def ml_predictions_latest(predictions: DataFrame) -> DataFrame:
    return latest_window(predictions).select(
        "icao24",
        "origin_country",
        "velocity",
        "baro_altitude",
        "predicted_on_ground",
        "onground_probability",
        "anomaly_score",
        "is_anomaly",
        "window_start",
    )


def ml_country_summary(predictions: DataFrame, n: int = 25) -> DataFrame:
    return (
        latest_window(predictions)
        .groupBy("origin_country")
        .agg(
            F.count(F.lit(1)).alias("total_flights"),
            F.count_if("is_anomaly").alias("anomaly_count"),
            F.count_if("predicted_on_ground").alias("predicted_on_ground_count"),
            F.avg("onground_probability").alias("avg_onground_prob"),
            F.avg("anomaly_score").alias("avg_anomaly_score"),
        )
        .orderBy(F.desc("anomaly_count"), "origin_country")
        .limit(n)
    )


def kpi_ml(predictions: DataFrame) -> DataFrame:
    """One row of totals over the latest scored window."""
    scored, anomalies = F.count(F.lit(1)), F.count_if("is_anomaly")
    return latest_window(predictions).agg(
        scored.alias("flights_scored"),
        anomalies.alias("anomalies"),
        (F.try_divide(anomalies, scored) * 100).alias("anomaly_pct"),
        F.count_if("predicted_on_ground").alias("predicted_on_ground"),
        F.avg("onground_probability").alias("avg_onground_prob"),
    )


def top_anomalous_flights(predictions: DataFrame, n: int = 20) -> DataFrame:
    return (
        latest_window(predictions)
        .where("is_anomaly")
        .select(
            "icao24",
            "origin_country",
            "velocity",
            "baro_altitude",
            "predicted_on_ground",
            "onground_probability",
            "anomaly_score",
        )
        .orderBy("anomaly_score", "icao24", "origin_country", "velocity", "baro_altitude")
        .limit(n)
    )


def prediction_sample(predictions: DataFrame, n: int = 2000, seed: int = 42) -> DataFrame:
    """Repeatable random sample of the latest predictions."""
    return sample_n(ml_predictions_latest(predictions), n, ["icao24", "window_start"], seed)
