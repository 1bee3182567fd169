"""Windows and sessions, over stored reports and over streams with late ones."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from contrail.sources import versions
from contrail.streaming.windows import flight_sessions, store_closed, stream_reports, windowed_totals

START = datetime(2024, 1, 1)
SCHEMA = "icao24 string, time_position timestamp_ntz, origin_country string, velocity double, on_ground boolean"


@pytest.fixture()
def seen(spark):
    """Reports of one aircraft at so many hours after the start; None gives one without a time."""

    def build(*hours, icao24="a"):
        rows = [(icao24, None if h is None else START + timedelta(hours=h), "X", h, False) for h in hours]
        return spark.createDataFrame([(i, t, c, None if v is None else float(v), g) for i, t, c, v, g in rows], SCHEMA)

    return build


def hours(df, column="window_start"):
    return {(r[column] - START).total_seconds() / 3600: r for r in df.collect()}


def test_totals_of_windows(seen):
    got = hours(windowed_totals(seen(0, 0.5, 1, None, 25).unionByName(seen(0.25, icao24="b").withColumn("on_ground", F.lit(True)))))
    assert {h: (r.total_flights, r.known_velocities, r.on_ground) for h, r in got.items()} == {0: (3, 3, 1), 1: (1, 1, 0), 25: (1, 1, 0)}
    assert got[0].avg_velocity == 0.25
    assert windowed_totals(seen()).count() == 0


def test_sessions_follow_the_gap_rule(seen):
    second = 1 / 3600
    rows = seen(0, 1, 2 + second, 23.5, 24.2, 24.2, 25.2 + second, None).unionByName(seen(0.5, icao24="b")).unionByName(seen(3, icao24=None))
    got = {(r.icao24, round((r.first_seen - START).total_seconds()), round((r.last_seen - START).total_seconds()), r.reports) for r in flight_sessions(rows).collect()}
    assert got == {
        ("a", 0, 3600, 2),  # exactly an hour apart is not a gap, a second more is
        ("a", 7201, 7201, 1),
        ("a", 84_600, 87_120, 3),  # over midnight, with a repeated report
        ("a", 90_721, 90_721, 1),
        ("b", 1800, 1800, 1),
    }


def test_one_busy_aircraft_is_merged_before_the_shuffle(spark):
    rows = spark.range(20_000).select(F.lit("a").alias("icao24"), (F.timestamp_seconds(F.col("id") * 10)).cast("timestamp_ntz").alias("time_position"), F.lit(1.0).alias("velocity"))
    sessions = flight_sessions(rows.repartition(8))
    assert [r.reports for r in sessions.collect()] == [20_000]
    plan = sessions._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MergingSessions") >= 2  # within the map tasks, and after the shuffle


def run(spark, home, results, reports, *batches):
    for batch in batches:
        reports(*batch).coalesce(1).write.mode("append").parquet(f"{home}/in")
        stream = stream_reports(spark, f"{home}/in", reports())
        store_closed(results(stream), f"{home}/closed", f"{home}/progress").awaitTermination()
    return versions.read(spark, f"{home}/closed")


def test_a_late_report_counts_until_the_watermark_has_passed(spark, seen, tmp_path):
    totals = lambda df: windowed_totals(df, delay="2 hours")
    home = str(tmp_path)
    assert set(hours(run(spark, home, totals, seen, [0, 10]))) == {0}  # the watermark stands at 8, hour 10 is open
    assert set(hours(run(spark, home, totals, seen, [9, 11]))) == {0}
    got = hours(run(spark, home, totals, seen, [0.5, 8.5, 9.5, 30]))  # it stands at 9: two are too late, one counts
    assert {h: r.total_flights for h, r in got.items()} == {0: 1, 9: 2, 10: 1, 11: 1}
    got = hours(run(spark, home, totals, seen, [29.5, 60]))
    assert {h: r.total_flights for h, r in got.items()} == {0: 1, 9: 2, 10: 1, 11: 1, 29: 1, 30: 1}


def test_streamed_sessions_are_those_of_the_whole(spark, seen, tmp_path):
    parts = [[0, 0.5, 3], [1.4, 3.2, 5], [4.1, 30]]
    got = run(spark, str(tmp_path), lambda df: flight_sessions(df, delay="3 hours"), seen, *parts)
    closed = flight_sessions(seen(*sum(parts, []))).where(F.col("last_seen") < F.lit(START + timedelta(hours=26)).cast("timestamp_ntz"))
    assert {tuple(r) for r in got.drop("ingestion_batch").collect()} == {tuple(r) for r in closed.collect()}
