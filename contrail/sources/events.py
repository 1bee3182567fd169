"""Position reports derived from the `events` test table.

A fixed mapping that brings re-deliveries, missing times and positions,
coordinates out of range and negative velocities, so every rule has work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.columns import NTZ
from contrail.session import prepare


def event_reports(spark: SparkSession, root: str) -> DataFrame:
    """One bronze-view row per delivery of every event."""
    prepare(spark)
    events = spark.read.parquet(f"{root}/events.parquet").select(
        "event_id", "user_id", F.col("ts").cast(NTZ).alias("t0"), "value"
    )
    # Each event once, and every tenth a second time, an hour later. Exploding
    # the delivery number keeps this a single scan.
    deliveries = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    src = events.withColumn("delivery", F.explode(deliveries)).select(
        "event_id",
        "user_id",
        "t0",
        "delivery",
        (F.col("t0") + F.make_dt_interval(hours=F.col("delivery"))).cast(NTZ).alias("ingestion_time"),
        (F.col("value") + F.col("delivery")).alias("value"),
    )
    event, user = F.col("event_id"), F.col("user_id")
    second = F.date_trunc("second", "t0").cast(NTZ)

    def unless_multiple(n: int, value):
        return F.when(event % n != 0, value)

    altitude = ((event * 101) % 12000).cast("double")
    return src.select(
        "event_id",
        "delivery",
        F.lpad(user.cast("string"), 6, "0").alias("icao24"),
        unless_multiple(29, F.concat(F.lit("NATION_"), (user % 25).cast("string"))).alias("origin_country"),
        unless_multiple(17, ((event * 37) % 20000).cast("double") / 100 - 100).alias("latitude"),
        unless_multiple(17, ((event * 53) % 40000).cast("double") / 100 - 200).alias("longitude"),
        unless_multiple(41, second).alias("time_position"),
        (second + F.expr("INTERVAL '1' SECOND")).cast(NTZ).alias("last_contact"),
        unless_multiple(13, F.col("value") - 20).alias("velocity"),
        (((event * 7) % 400).cast("double") / 10 - 20).alias("vertical_rate"),
        ((event * 13) % 360).cast("double").alias("true_track"),
        unless_multiple(11, altitude).alias("baro_altitude"),
        unless_multiple(11, altitude + 50).alias("geo_altitude"),
        (event % 5 == 0).alias("on_ground"),
        "ingestion_time",
    )
