from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from contrail.functions import calendar_features, feature_cell, grid_cell
from contrail.operators.silver import (
    bronze_view,
    clean_silver,
    dedupe_latest,
    latest_first,
    parse_payload,
    project_states,
    select_existing,
    to_silver,
    with_event_times,
)
from contrail.schemas import SILVER

STATE = ["4b1a2c", "SWR7K   ", "Switzerland", 1704103230.0, 1704103231.0, 8.5492, 47.4647,
         6400.0, False, 175.5, 312.0, -3.25, None, 6525.0, "2001", False, 0]


def documents(spark, *payloads):
    rows = [(p if isinstance(p, str) else json.dumps(p), f"f{i}.json") for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "raw_data string, source_file string")


def payload(*states):
    return {"time": 1700000000, "states": list(states)}


def test_api_layout(spark):
    row = to_silver(documents(spark, payload(STATE))).select(*SILVER.names).first()
    assert row.asDict() == {
        "icao24": "4b1a2c",
        "origin_country": "Switzerland",
        "latitude": 47.4647,
        "longitude": 8.5492,
        "time_position": 1704103230,
        "last_contact": 1704103231,
        "velocity": 175.5,
        "vertical_rate": -3.25,
        "true_track": 312.0,
        "baro_altitude": 6400.0,
        "on_ground": False,
        "geo_altitude": 6525.0,
    }


def test_types_are_the_declared_ones(spark):
    silver = to_silver(documents(spark, payload(STATE))).select(*SILVER.names)
    assert [f.dataType for f in silver.schema] == [f.dataType for f in SILVER]


def test_legacy_layout_reads_other_slots(spark):
    row = bronze_view(documents(spark, payload(STATE)), "legacy_sql").first()
    assert (row.velocity, row.true_track, row.vertical_rate) == (6400.0, 175.5, 312.0)
    assert (row.baro_altitude, row.geo_altitude) == (None, 0.0)
    assert str(row.time_position) == "2024-01-01 10:00:30"


def test_empty_null_and_missing_states_give_no_rows(spark):
    docs = documents(spark, payload(), {"time": 1, "states": None}, {"time": 1}, payload(STATE))
    assert to_silver(docs).count() == 1


def test_a_null_state_is_still_a_row(spark):
    rows = to_silver(documents(spark, payload(STATE, None))).collect()
    assert len(rows) == 2 and [r.icao24 for r in rows].count(None) == 1


def test_documents_are_parsed_once(spark):
    plan = to_silver(documents(spark, payload(STATE)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_short_and_long_vectors(spark):
    rows = to_silver(documents(spark, payload(STATE[:10], [*STATE, 3]))).orderBy("geo_altitude").collect()
    assert [r.geo_altitude for r in rows] == [None, 6525.0]
    assert [r.vertical_rate for r in rows] == [None, -3.25]


def test_unreadable_values_become_null(spark):
    state = list(STATE)
    state[3], state[7], state[8], state[9], state[12] = "soon", "high", None, "x", [1, 2]
    row = to_silver(documents(spark, payload(state))).first()
    assert (row.time_position, row.baro_altitude, row.velocity) == (None, None, None)
    assert row.on_ground is False


def test_names_are_trimmed_and_stay_null(spark):
    padded, absent = list(STATE), list(STATE)
    padded[0], padded[2], absent[2] = "  abc  ", " France ", None
    rows = {(r.icao24, r.origin_country) for r in to_silver(documents(spark, payload(padded, absent))).collect()}
    assert rows == {("abc", "France"), ("4b1a2c", None)}


def test_bad_document_raises_or_is_skipped(spark):
    docs = documents(spark, "{not json", payload(STATE))
    with pytest.raises(Exception, match="(?i)malformed|fail"):
        to_silver(docs).collect()
    assert to_silver(docs, on_bad="skip").count() == 1


def test_missing_ground_flag_differs_by_path(spark):
    state = list(STATE)
    state[8] = None
    docs = documents(spark, payload(state))
    assert to_silver(docs).first().on_ground is False
    assert bronze_view(docs, "api").first().on_ground is None


def test_select_existing(spark):
    flat = project_states(parse_payload(documents(spark, payload(STATE))).select(F.explode("payload.states").alias("state")))
    assert select_existing(flat, ["velocity", "nope", "icao24"]).columns == ["velocity", "icao24"]


def test_latest_delivery_wins(reports, at):
    rows = reports(
        {"velocity": 1.0, "ingestion_time": at(11)},
        {"velocity": 2.0, "ingestion_time": at(12)},
        {"velocity": 3.0, "ingestion_time": at(12), "source_file": "b.json"},
    )
    kept = clean_silver(rows).collect()
    assert [r.velocity for r in kept] == [2.0]


def test_null_times_share_one_group_per_aircraft(reports, at):
    rows = reports(
        {"time_position": None, "ingestion_time": at(9)},
        {"time_position": None, "ingestion_time": at(10)},
        {"time_position": None, "icao24": "other"},
    )
    assert clean_silver(rows).count() == 2


def test_dedupe_limits_rows_before_the_shuffle(reports):
    rows = reports({}, {})
    plan = dedupe_latest(rows, ["icao24", "time_position"], latest_first(rows))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") >= 2


def test_flags_and_defaults(reports):
    rows = clean_silver(
        reports(
            {"icao24": "1", "origin_country": None, "velocity": -1.0},
            {"icao24": "2", "latitude": 90.0, "longitude": -180.0},
            {"icao24": "3", "latitude": 90.1, "longitude": 180.5},
            {"icao24": "4", "latitude": None, "on_ground": False},
            {"icao24": "5", "on_ground": True},
            {"icao24": "6", "on_ground": None, "velocity": 0.0},
        )
    ).orderBy("icao24").collect()
    assert (rows[0].origin_country, rows[0].velocity_validated) == ("UNKNOWN", None)
    assert [(r.lat_valid, r.lon_valid) for r in rows] == [(1, 1), (1, 1), (0, 0), (0, 1), (1, 1), (1, 1)]
    assert [r.airborne_position_valid for r in rows] == [1, 1, 1, 0, 0, 0]
    assert rows[5].velocity_validated == 0.0


def test_file_silver_can_be_cleaned(spark, at):
    silver = to_silver(documents(spark, payload(STATE, STATE))).withColumn(
        "ingestion_time", F.lit(at(1)).cast("timestamp_ntz")
    )
    assert clean_silver(with_event_times(silver)).count() == 1


def test_rounding_rules(spark):
    values = spark.createDataFrame([(v,) for v in (0.5, 2.5, -0.5, 5.0, 15.0, -5.0, 25.0)], "v double")
    rows = values.select("v", grid_cell(F.col("v")).alias("up"), feature_cell(F.col("v")).alias("even")).collect()
    assert [r.up for r in rows[:3]] == [1.0, 3.0, -1.0]
    assert [r.even for r in rows[3:]] == [0.0, 20.0, 0.0, 20.0]


def test_calendar(reports, at):
    rows = calendar_features(
        reports({"time_position": at(8, day=1)}, {"time_position": at(21, day=6)}, {"time_position": at(22, day=7)})
    ).orderBy("time_position").collect()
    assert [r.weekday_numeric for r in rows] == [0, 5, 6]
    assert [r.is_weekend for r in rows] == [False, True, True]
    assert [r.is_peak_hour for r in rows] == [0, 1, 0]
    assert (rows[0].year, rows[0].month, rows[1].day, rows[2].hour) == (2024, 1, 6, 22)
