from __future__ import annotations

from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.operators import gold
from contrail.operators.silver import clean_silver
from contrail.plans import serving


def test_country_totals(reports):
    rows = reports(
        {"origin_country": "United States", "velocity": 250.0},
        {"origin_country": "United Kingdom", "velocity": 280.0, "icao24": None},
        {"origin_country": "United Kingdom", "velocity": None, "on_ground": True},
        {"origin_country": None},
    )
    got = {r.origin_country: r for r in gold.gold_country_totals(rows).collect()}
    assert set(got) == {"United States", "United Kingdom"}
    assert (got["United States"].total_flights, got["United States"].on_ground) == (1, 0)
    uk = got["United Kingdom"]
    assert (uk.total_flights, uk.avg_velocity, uk.on_ground) == (1, 280.0, 1)


def test_hourly_figures(reports, at):
    rows = clean_silver(
        reports(
            {"icao24": "a", "velocity": 100.0, "time_position": at(10)},
            {"icao24": "a", "velocity": 300.0, "time_position": at(10, 30)},
            {"icao24": "b", "velocity": -5.0, "on_ground": True, "latitude": 95.0, "time_position": at(10, 59, 59)},
            {"icao24": "c", "velocity": None, "baro_altitude": None, "time_position": at(11)},
            {"icao24": "d", "time_position": None},
        )
    )
    got = {r.window_start: r for r in gold.gold_flight_aggregations(rows).collect()}
    assert set(got) == {at(10), at(11)}
    ten = got[at(10)]
    assert (ten.unique_flights, ten.total_flights) == (2, 3)
    assert (ten.avg_velocity, ten.median_velocity, ten.max_velocity) == (200.0, 200.0, 300.0)
    assert (ten.on_ground_count, ten.airborne_count, ten.valid_airborne_positions) == (1, 2, 2)
    assert ten.position_validity_pct == pytest.approx(200 / 3)
    assert (got[at(11)].median_velocity, got[at(11)].avg_baro_altitude) == (None, None)


def test_daily_summary_is_the_same_from_figures(reports, at):
    rows = clean_silver(reports(*[{"icao24": f"{i}", "time_position": at(i % 24, day=1 + i % 3)} for i in range(40)]))
    from_figures = gold.gold_country_daily_summary(gold.hourly_figures(rows))
    from_table = gold.gold_country_daily_summary(gold.gold_flight_aggregations(rows))
    assert from_figures.orderBy("date").collect() == from_table.orderBy("date").collect()


def test_moving_average_counts_rows_not_days(spark, at):
    days = [1, 2, 3, 5, 8, 9, 10, 20]
    rows = [(at(day=d), "X", 10 * (i + 1), 100.0, 1, 1) for i, d in enumerate(days)]
    hourly = spark.createDataFrame(
        rows,
        "window_start timestamp_ntz, origin_country string, total_flights bigint, avg_velocity double,"
        " airborne_count bigint, on_ground_count bigint",
    )
    got = gold.gold_country_daily_summary(hourly).orderBy("date").collect()
    assert [r.flights_7day_avg for r in got] == [
        float(np.mean([10 * (j + 1) for j in range(max(0, i - 6), i + 1)])) for i in range(8)
    ]
    assert [r.dod_change for r in got] == [None] + [10] * 7
    assert got[1].on_ground_ratio == 1 / 20


def test_trajectories_link_across_days_like_one_long_window(reports, at):
    rng = np.random.default_rng(3)
    start = at()
    rows, expected = [], {}
    for icao24 in ("a", "b", None):
        offsets = sorted(set(int(s) for s in rng.integers(0, 20 * 86400, 60)))
        previous = None
        for s in offsets:
            moment = start + timedelta(seconds=s)
            rows.append({"icao24": icao24, "time_position": moment, "latitude": s % 90 * 1.0})
            expected[icao24, moment] = previous
            previous = (moment, s % 90 * 1.0)
    got = gold.gold_flight_trajectories(clean_silver(reports(*rows))).collect()
    assert len(got) == len(rows)
    for r in got:
        before = expected[r.icao24, r.end_time]
        assert (r.start_time, r.start_latitude) == (before or (None, None))
        seconds = (r.end_time - before[0]).total_seconds() if before else None
        assert r.time_delta_seconds == seconds
        assert r.is_new_segment == (seconds is None or seconds > 3600)


def test_trajectories_since_a_day_are_the_tail_of_all(reports, at):
    moments = [at(1), at(23), at(5, day=4), at(5, 10, day=4), at(0, day=7), at(12, day=9)]
    rows = clean_silver(reports(*[{"icao24": k, "time_position": m} for k in "ab" for m in moments], {"icao24": "c", "time_position": at(3, day=7)}))
    for day in (1, 4, 5, 7, 10):
        since = at(day=day).date()
        tail = gold.gold_flight_trajectories(rows).where(F.col("end_time") >= F.lit(since))
        part = gold.gold_flight_trajectories(rows, since=since)
        assert sorted(map(str, part.collect())) == sorted(map(str, tail.collect()))


def test_trajectory_gap_edge_and_invalid_points(reports, at):
    rows = clean_silver(
        reports(
            {"time_position": at(1)},
            {"time_position": at(1, 30), "latitude": 91.0},
            {"time_position": at(2)},
            {"time_position": at(3, 0, 1)},
        )
    )
    got = gold.gold_flight_trajectories(rows).orderBy("end_time").collect()
    assert [r.time_delta_seconds for r in got] == [None, 3600, 3601]
    assert [r.is_new_segment for r in got] == [True, False, True]


def test_anomalies_need_more_than_one_row(reports, at):
    steady = [{"icao24": f"n{i}", "velocity": 100.0 + i % 2, "time_position": at(5, i)} for i in range(30)]
    rows = clean_silver(
        reports(
            *steady,
            {"icao24": "fast", "velocity": 900.0, "time_position": at(5, 45)},
            {"icao24": "alone", "velocity": 500.0, "time_position": at(7)},
            {"icao24": "same1", "velocity": 7.0, "time_position": at(8)},
            {"icao24": "same2", "velocity": 7.0, "time_position": at(8)},
        )
    )
    got = {r.icao24: r for r in gold.gold_speed_anomalies(rows).collect()}
    assert [k for k, r in got.items() if r.is_anomaly] == ["fast"]
    assert got["fast"].z_score > 2
    assert (got["alone"].hourly_stddev_velocity, got["alone"].z_score) == (None, None)
    assert got["same1"].z_score is None


def test_busiest_ranks_ties(reports, at):
    rows = clean_silver(
        reports(
            *[{"icao24": f"a{i}", "origin_country": "A", "time_position": at(1, i)} for i in range(3)],
            *[{"icao24": f"b{i}", "origin_country": "B", "time_position": at(1, i)} for i in range(3)],
            {"icao24": "c", "origin_country": "C", "time_position": at(1, 29, 59)},
            {"icao24": "d", "origin_country": "C", "time_position": at(1, 30)},
        )
    )
    got = gold.gold_top_busiest_countries(rows).orderBy("window_start", "rank", "origin_country").collect()
    assert [(r.origin_country, r.rank, r.dense_rank) for r in got[:3]] == [("A", 1, 1), ("B", 1, 1), ("C", 3, 2)]
    assert got[3].window_start == at(1, 30)


def test_altitude_bins_below_zero(reports):
    rows = clean_silver(reports({"baro_altitude": -1.0}, {"icao24": "b", "baro_altitude": 999.9}))
    bins = {r.altitude_bin for r in gold.gold_altitude_distribution(rows).collect()}
    assert bins == {-1000.0, 0.0}


def test_hot_group_is_whole(spark):
    """One country and hour with nearly all rows still gives the exact figures."""
    n = 20000
    rows = spark.range(n).select(
        F.format_string("%06d", F.col("id") % 5000).alias("icao24"),
        F.when(F.col("id") % 50 == 0, "B").otherwise("A").alias("origin_country"),
        F.timestamp_seconds(1704067200 + F.col("id") % 3600).cast("timestamp_ntz").alias("time_position"),
        ((F.col("id") * 7919) % 10007 / 37).alias("velocity_validated"),
        F.lit(1.0).alias("baro_altitude"),
        F.lit(1.0).alias("geo_altitude"),
        F.lit(False).alias("on_ground"),
        *[F.lit(1).alias(c) for c in ("lat_valid", "lon_valid", "airborne_position_valid")],
    )
    got = {r.origin_country: r for r in gold.gold_flight_aggregations(rows).collect()}
    ids = np.arange(n)
    for country, mask in (("A", ids % 50 != 0), ("B", ids % 50 == 0)):
        velocity = (ids[mask] * 7919) % 10007 / 37
        assert got[country].total_flights == mask.sum()
        assert got[country].unique_flights == len(set(ids[mask] % 5000))
        assert got[country].median_velocity == pytest.approx(np.median(velocity))


def test_velocity_kpi_of_a_single_window(spark, at):
    trend = spark.createDataFrame([(at(1), 10.0)], "window_start timestamp_ntz, global_avg_velocity double")
    row = serving.kpi_velocity(trend).first()
    assert (row.latest_velocity, row.velocity_delta) == (10.0, None)


def test_latest_window_on_partitioned_and_empty_tables(spark, at):
    rows = spark.createDataFrame([(at(1), 1), (at(3), 2), (at(3), 3)], "window_start timestamp_ntz, v int")
    assert {r.v for r in serving.latest_window(rows).collect()} == {2, 3}
    dated = rows.withColumn("window_date", F.to_date("window_start"))
    assert {r.v for r in serving.latest_window(dated).collect()} == {2, 3}
    assert serving.latest_window(rows.where("v > 9")).count() == 0
