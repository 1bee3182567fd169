"""Further inputs derived from the `events` table: raw documents and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.columns import day_start
from contrail.operators.silver import dedupe_latest

EVENTS_PER_DOCUMENT = 500


def state_vector(reports: DataFrame) -> Column:
    """A report as the 17 mixed-type slots of a raw state vector."""

    def epoch(column: str) -> Column:
        return F.unix_seconds(F.col(column).cast("timestamp")).cast("double")

    nothing = F.lit(None).cast("string")
    slots = [
        F.col("icao24"),
        F.concat("icao24", F.lit("  ")),
        F.col("origin_country"),
        epoch("time_position"),
        epoch("last_contact"),
        F.col("longitude"),
        F.col("latitude"),
        F.col("baro_altitude"),
        F.col("on_ground"),
        F.col("velocity"),
        F.col("true_track"),
        F.col("vertical_rate"),
        nothing,
        F.col("geo_altitude"),
        nothing,
        F.lit(False),
        F.lit(0),
    ]
    return F.array(*[s.cast("variant") for s in slots])


def raw_documents(reports: DataFrame, period: int = 1) -> DataFrame:
    """Reports packed into JSON documents: (raw_data, source_file).

    A document covers a fixed range of event ids, so its size is bounded. Its
    time is that of its last report, cut down to a multiple of `period` seconds.
    """
    document = F.floor(F.col("event_id") / EVENTS_PER_DOCUMENT).alias("document")
    return (
        reports.select(
            document,
            F.unix_seconds(F.col("ingestion_time").cast("timestamp")).alias("seen"),
            state_vector(reports).alias("state"),
        )
        .groupBy("document")
        .agg((F.floor(F.max("seen") / period) * period).alias("time"), F.collect_list("state").alias("states"))
        .select(
            F.to_json(F.struct("time", "states")).alias("raw_data"),
            F.format_string("document-%d.json", "document").alias("source_file"),
        )
    )


def valid_reports(reports: DataFrame) -> DataFrame:
    """The same reports with values that break a rule set to NULL."""
    lat, lon = F.col("latitude"), F.col("longitude")
    placed = lat.between(-90, 90) & lon.between(-180, 180) & F.col("time_position").isNotNull()
    return reports.withColumns(
        {
            "latitude": F.when(placed, lat),
            "longitude": F.when(placed, lon),
            "velocity": F.when(F.col("velocity") >= 0, F.col("velocity")),
        }
    )


def rule_predictions(reports: DataFrame) -> DataFrame:
    """Predictions by simple rules in place of models, one per aircraft and day.

    They let the serving queries be checked against plain SQL.
    """
    daily = reports.where(F.col("time_position").isNotNull()).withColumn(
        "window_start", day_start(F.col("time_position"))
    )
    order = [F.desc("time_position"), F.desc("ingestion_time"), F.asc("event_id")]
    latest = dedupe_latest(daily, ["icao24", "window_start"], order)
    return latest.select(
        "icao24",
        "origin_country",
        "velocity",
        "baro_altitude",
        "on_ground",
        (F.col("true_track") < 90).alias("predicted_on_ground"),
        (F.col("true_track") * 0.0025).alias("onground_probability"),
        (F.col("vertical_rate") / 100).alias("anomaly_score"),
        (F.col("vertical_rate") < -15).alias("is_anomaly"),
        "window_start",
    )
