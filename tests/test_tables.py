from __future__ import annotations

import json
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from contrail.operators.upsert import upsert
from contrail.schemas import COUNTRY_TOTALS_KEYS, COUNTRY_TOTALS_UPDATES
from contrail.session import SkipBatch
from contrail.sources import tables
from contrail.sources.files import read_bronze_json, read_predictions, read_silver, read_silver_dir, write_layer

TOTALS = "window_start timestamp_ntz, origin_country string, total_flights bigint, avg_velocity double, on_ground_sum bigint"


def bag(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_upsert_semantics(spark):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old"), (None, 3, "old")], "k string, v int, note string")
    source = spark.createDataFrame([("a", 10, "new"), ("c", 30, "new"), (None, 40, "new")], "k string, v int, note string")
    got = upsert(target, source, ["k"], ["v"])
    assert bag(got, "k", "v", "note") == sorted(
        [("a", 10, "old"), ("b", 2, "old"), ("c", 30, "new"), (None, 3, "old"), (None, 40, "new")], key=str
    )


def test_upsert_can_overwrite_with_null(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.createDataFrame([("a", None)], "k string, v int")
    assert bag(upsert(target, source, ["k"], ["v"]), "k", "v") == [("a", None)]


def test_upsert_refuses_repeated_source_keys(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    twice = spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int")
    with pytest.raises(ValueError, match="repeats"):
        upsert(target, twice, ["k"], ["v"])
    absent = spark.createDataFrame([(None, 2), (None, 3)], "k string, v int")
    assert upsert(target, absent, ["k"], ["v"]).count() == 3


def load(df, root, now):
    return tables.upsert_table(df, root, "gold_flight_agg", COUNTRY_TOTALS_KEYS, COUNTRY_TOTALS_UPDATES, now)


def test_upsert_table_touches_only_its_dates(spark, tmp_path, at):
    root = str(tmp_path)
    first = spark.createDataFrame(
        [(at(1), "A", 1, 1.0, 0), (at(1, day=2), "A", 2, 2.0, 0), (at(1, day=3), "B", 3, 3.0, 1)], TOTALS
    )
    assert load(first, root, at(5)) == 3
    files = lambda day: set(tables.read_table(spark, root, "gold_flight_agg", [f"2024-01-{day:02d}"]).inputFiles())
    before = {d: files(d) for d in (1, 2, 3)}
    second = spark.createDataFrame([(at(1), "A", 10, 10.0, 5), (at(2, day=3), "B", 4, 4.0, 0)], TOTALS)
    assert load(second, root, at(6)) == 2
    assert files(2) == before[2] and files(1) != before[1] and files(3) != before[3]
    table = tables.read_table(spark, root, "gold_flight_agg")
    expected = [(at(1), "A", 10), (at(1, day=2), "A", 2), (at(1, day=3), "B", 3), (at(2, day=3), "B", 4)]
    assert bag(table, "window_start", "origin_country", "total_flights") == sorted(expected, key=str)
    assert {r.load_time for r in table.where("total_flights IN (10, 4)").collect()} == {at(6)}
    once = bag(table, *table.columns)
    load(second, root, at(6))
    assert bag(tables.read_table(spark, root, "gold_flight_agg"), *table.columns) == once


def test_upsert_table_edge_batches(spark, tmp_path, at):
    root = str(tmp_path)
    rows = spark.createDataFrame([(at(1), "A", 1, 1.0, 0)], TOTALS)
    load(rows, root, at(2))
    assert load(rows.where("false"), root, at(2)) == 0
    with pytest.raises(ValueError, match="window_start"):
        load(spark.createDataFrame([(None, "A", 1, 1.0, 0)], TOTALS), root, at(2))
    with pytest.raises(ValueError, match="repeats"):
        load(rows.union(rows), root, at(2))
    nameless = spark.createDataFrame([(at(1), None, 1, 1.0, 0)], TOTALS)
    load(nameless, root, at(3))
    load(nameless, root, at(3))
    assert tables.read_table(spark, root, "gold_flight_agg").where("origin_country IS NULL").count() == 2


def test_snapshot_and_rollback(spark, tmp_path, at):
    root = str(tmp_path)
    load(spark.createDataFrame([(at(1), "A", 1, 1.0, 0)], TOTALS), root, at(2))
    ts = tables.snapshot(spark, root, ["gold_flight_agg"])
    with pytest.raises(Exception, match="(?i)exists"):
        tables.snapshot(spark, root, ["gold_flight_agg"], ts)
    load(spark.createDataFrame([(at(1), "A", 7, 7.0, 0), (at(1), "B", 7, 7.0, 0)], TOTALS), root, at(3))
    for _ in range(2):
        tables.rollback(spark, root, ts, ["gold_flight_agg"])
        assert bag(tables.read_table(spark, root, "gold_flight_agg"), "origin_country", "total_flights") == [("A", 1)]
    assert spark.read.parquet(tables.backup(spark, root)).count() == 1


def test_batches_are_idempotent_and_keep_each_other(spark, reports, tmp_path, at):
    root = str(tmp_path)
    silver = reports({}, {"icao24": "b"}).drop("ingestion_time").withColumn("spare", F.lit(1))
    assert tables.append_silver(silver, root, "20240101", at(1)) == 2
    assert tables.append_silver(silver, root, "20240101", at(1)) == 2
    assert tables.append_silver(silver.limit(1), root, "007", at(2)) == 1
    table = tables.read_table(spark, root, "silver_flights")
    assert {r.ingestion_batch for r in table.collect()} == {"20240101", "007"}
    assert table.count() == 3 and "spare" not in table.columns and "geo_altitude" in table.columns
    assert list(tables.tables(spark, root)) == ["silver_flights"]


def test_retention(spark, reports, tmp_path, at):
    root = str(tmp_path)
    assert tables.retain_table(spark, root, "silver_flights") == 0
    for batch, day in (("old one: a", 1), ("edge", 8), ("new", 14)):
        tables.append_silver(reports({}, {"icao24": batch[:3]}).drop("ingestion_time"), root, batch, at(day=day))
    assert tables.retain_table(spark, root, "silver_flights", 7, at(day=15)) == 2
    kept = tables.read_table(spark, root, "silver_flights")
    assert {r.ingestion_batch for r in kept.collect()} == {"edge", "new"}
    assert tables.retain_table(spark, root, "silver_flights", 7, at(day=15) + timedelta(seconds=1)) == 2
    assert tables.retain_table(spark, root, "silver_flights", 7, at(day=15)) == 0


def test_retention_rewrites_mixed_batches(spark, reports, tmp_path, at):
    rows = reports({"ingestion_time": at(day=1)}, {"ingestion_time": at(day=14), "icao24": "kept"})
    tables.write_batches(rows.withColumn("ingestion_batch", F.lit("b")), f"{tmp_path}/silver_flights")
    assert tables.retain_table(spark, str(tmp_path), "silver_flights", 7, at(day=15)) == 1
    assert [r.icao24 for r in tables.read_table(spark, str(tmp_path), "silver_flights").collect()] == ["kept"]


def test_materialize(spark, reports, tmp_path, at):
    root = str(tmp_path)
    model = spark.createDataFrame([(at(1), 1.0, 2.0, 3)], "window_start timestamp_ntz, latitude_bin double, longitude_bin double, n int")
    stored = tables.materialize(model, root, "gold_flight_density_heatmap", now=at(4))
    assert stored.first().load_time == at(4)
    assert len(list(Path(root, "gold_flight_density_heatmap").glob("write=*/window_date=2024-01-01"))) == 1
    again = tables.materialize(model.withColumn("n", F.lit(9)), root, "gold_flight_density_heatmap")
    assert [r.n for r in again.collect()] == [9]
    tables.materialize(model, root, "heat", kind="view")
    assert spark.table("heat").count() == 1
    with pytest.raises(ValueError):
        tables.materialize(model, root, "heat", kind="cube")


def test_landing_is_idempotent(spark, tmp_path):
    docs = lambda *t: spark.createDataFrame([(json.dumps(x),) for x in t], "raw_data string")
    root = str(tmp_path)
    path = tables.land_bronze(docs({"time": 1, "states": [["a"]]}), root, "b1")
    assert tables.land_bronze(docs({"time": 2, "states": [["b"], ["c"]]}), root, "b1") == path
    assert json.loads(spark.read.text(path).first().value) == {"time": 1, "states": [["a"]]}
    with pytest.raises(SkipBatch):
        tables.land_bronze(docs({"time": 1, "states": None}), root, "b2")
    assert not Path(root, "landing", "ingestion_batch=b2").exists()


SILVER_HEADER = "icao24,origin_country,latitude,longitude,time_position,last_contact,velocity,vertical_rate,true_track,baro_altitude,on_ground"


def test_silver_csv(spark, tmp_path):
    one = tmp_path / "flight_silver_20240101.csv"
    one.write_text(f"{SILVER_HEADER}\nabc,France,1.5,2.5,1700000000.0,1700000001,250,0,90,,False\ndef,,,,,1700000001,x,0,90,10,True\n")
    (tmp_path / "flight_silver_20240102.csv").write_text(
        f"{SILVER_HEADER},geo_altitude\nghi,Peru,1,2,1700000000,1700000001,1,0,90,5,True,77\n"
    )
    (tmp_path / "other.csv").write_text("nothing\n1\n")
    rows = read_silver(spark, str(one)).orderBy("icao24").collect()
    assert (rows[0].time_position, rows[0].on_ground, rows[0].baro_altitude) == (1700000000, False, None)
    assert (rows[1].origin_country, rows[1].velocity, rows[1].on_ground) == (None, None, True)
    assert "geo_altitude" not in rows[0].asDict()
    both = {r.icao24: r.geo_altitude for r in read_silver_dir(spark, str(tmp_path)).collect()}
    assert both == {"abc": None, "def": None, "ghi": 77.0}


def test_many_headers_take_one_scan_of_the_rows(spark, tmp_path):
    names = SILVER_HEADER.split(",")
    for i in range(12):
        own = names[i % 11 :] + names[: i % 11] + [f"extra_{i}"]
        values = {n: "" for n in own} | {"icao24": f'"a,{i}"', "velocity": str(i), "on_ground": "True", f"extra_{i}": '"say ""x"""'}
        line = ",".join(values[n] for n in own)
        mark = "\ufeff" if i == 3 else ""
        (tmp_path / f"flight_silver_{i}.csv").write_text(f"{mark}{','.join(own)}\n\n{line}\n{line}\n", encoding="utf-8")
    (tmp_path / "flight_silver_empty.csv").write_text("")
    read = read_silver_dir(spark, str(tmp_path))
    assert sorted((r.icao24, r.velocity, r.on_ground, r.latitude) for r in read.collect()) == sorted((f"a,{i}", float(i), True, None) for i in range(12) for _ in range(2))
    plan = read._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan text") == 1


def test_missing_inputs_raise(spark, tmp_path):
    for read in (read_bronze_json, read_silver, read_silver_dir, read_predictions):
        with pytest.raises(FileNotFoundError):
            read(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError, match="flight_silver"):
        read_silver_dir(spark, str(tmp_path))
    with pytest.raises(ValueError):
        read_silver(spark, "")


def test_predictions_round_trip_and_window_in_utc(spark, tmp_path, at):
    rows = spark.createDataFrame(
        [("a", "X", 1.0, 2.0, False, True, 0.25, -0.1, True, "2024-01-01T12:00:00+02:00")],
        "icao24 string, origin_country string, velocity double, baro_altitude double, on_ground boolean,"
        " predicted_on_ground boolean, onground_probability double, anomaly_score double, is_anomaly boolean, window_start string",
    )
    back = read_predictions(spark, write_layer(rows, str(tmp_path / "ml")))
    assert back.first() == rows.first()
    loaded = tables.prepare_predictions(back)
    assert loaded.first().window_start == at(10) and "on_ground" not in loaded.columns


def test_rename_and_stamp(spark, at):
    df = tables.rename_for_load(spark.range(1).withColumnRenamed("id", "on_ground"), {"on_ground": "on_ground_sum"})
    row = tables.stamp(df, at(1), window="w").first()
    assert row.asDict() == {"on_ground_sum": 0, "load_time": at(1), "window": "w"}
