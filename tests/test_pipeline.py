from __future__ import annotations

import json
from datetime import date, datetime

import pytest

from contrail.operators.quality import QualityError
from contrail.plans.pipeline import half_hour, process_documents, refresh_models, run_batch, undo_batch
from contrail.session import SkipBatch, clean_scratch, discard, path_exists, scratch_root, settle
from contrail.sources import tables
from contrail.streaming.ingest import ingest_stream, stream_documents

COUNTRIES = ["Norway", "Kenya", "Chile", "Japan", "Malta"]
START = 1704103200  # 2024-01-01 10:00


def state(i, seconds=0, **changes):
    slots = [f"f0{i:03d}", "NAX7", COUNTRIES[i % 5], START + 30.0 + seconds, START + 31.0, 3.0 * i, 40.0 + i,
             7300.0, False, 180.0 + 15 * i, 211.0, -1.5, None, 7420.0, "0707", False, 0]
    for slot, value in changes.items():
        slots[int(slot[1:])] = value
    return slots


def write_payload(folder, name, states, time=START):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps({"time": time, "states": states}))
    return str(folder / name)


def totals(spark, root):
    rows = tables.read_table(spark, root, "gold_flight_agg").collect()
    return sorted((r.window_start, r.origin_country, r.total_flights, r.avg_velocity, r.on_ground_sum) for r in rows)


def test_batch_end_to_end_and_rerun(spark, tmp_path, at):
    root = str(tmp_path / "wh")
    path = write_payload(tmp_path / "in", "a.json", [state(i) for i in range(5)] + [state(0, _8=True, _0="zzz")])
    counts = run_batch(spark, path, root, "run-1", at(1), at(1, 5))
    assert counts == {"bronze_rows": 1, "silver_rows": 6, "gold_rows": 5}
    first = totals(spark, root)
    assert sum(r[2] for r in first) == 6
    assert {r[1] for r in first} == set(COUNTRIES)
    assert (at(1), "Norway", 2, 180.0, 1) in first
    run_batch(spark, path, root, "run-1", at(1), at(1, 9))
    assert totals(spark, root) == first
    assert tables.read_table(spark, root, "silver_flights").count() == 6
    assert tables.read_table(spark, root, "bronze_flights").count() == 1


def test_empty_payload_skips_and_writes_nothing(spark, tmp_path, at):
    for states in ([], None):
        path = write_payload(tmp_path / "in", "a.json", states)
        with pytest.raises(SkipBatch):
            run_batch(spark, path, str(tmp_path / "wh"), "run-1", at(1))
    assert not (tmp_path / "wh").exists()


def test_broken_rules_stop_before_gold(spark, tmp_path, at):
    path = write_payload(tmp_path / "in", "a.json", [state(0, _9=-4.0)])
    with pytest.raises(QualityError, match="velocity"):
        run_batch(spark, path, str(tmp_path / "wh"), "run-1", at(1))
    assert not (tmp_path / "wh" / "gold_flight_agg").exists()


def two_batches(spark, tmp_path, root, at):
    for n, hour in enumerate((1, 2)):
        path = write_payload(tmp_path / f"in{n}", "a.json", [state(i, 1800 * n * (i % 2)) for i in range(5)])
        run_batch(spark, path, root, f"run-{n}", at(hour), at(hour))


def contents(built):
    """Rows of every table without the load time."""
    return {
        name: sorted((tuple(r) for r in df.drop("load_time").collect()), key=str) for name, df in built.items()
    }


def test_refresh_from_bronze(spark, tmp_path, at):
    root = str(tmp_path / "wh")
    two_batches(spark, tmp_path, root, at)
    built = refresh_models(spark, root, "bronze", layout="api", now=at(3))
    assert built["silver_flights_cleaned"].count() == built["gold_flight_trajectories"].count() == 7
    assert spark.table("bronze_flights_raw").count() == 10


def test_refresh_in_full_and_of_recent_dates(spark, tmp_path, at):
    root = str(tmp_path / "wh")
    two_batches(spark, tmp_path, root, at)
    built = refresh_models(spark, root, now=at(3))
    assert built["silver_flights_cleaned"].count() == 7  # three of the second batch repeat the first
    assert {name: df.count() > 0 for name, df in built.items()} == dict.fromkeys(built, True)
    assert set(built) == set(tables.LAYOUT) - {"gold_flight_agg", "gold_ml_predictions"}
    assert {r.ingestion_time for r in built["silver_flights_cleaned"].where("icao24 = 'f0000'").collect()} == {at(2)}
    assert all("load_time" in df.columns for df in built.values())

    later = [state(i, 86400 * 2, _9=100.0) for i in range(4)] + [state(0, 86400 * 2 + 60)]
    run_batch(spark, write_payload(tmp_path / "in3", "a.json", later), root, "run-3", at(4), at(4))
    since = date(2024, 1, 2)
    recent = contents(refresh_models(spark, root, now=at(5), since=since))
    first_day = tables.read_table(spark, root, "gold_speed_anomalies").where("window_date = DATE'2024-01-01'")
    assert {r.load_time for r in first_day.collect()} == {at(3)}
    assert len(recent["gold_flight_trajectories"]) == 12
    assert recent == contents(refresh_models(spark, root, now=at(5)))


def test_stream_picks_up_each_file_once(spark, tmp_path, at):
    root, incoming, progress = str(tmp_path / "wh"), tmp_path / "incoming", str(tmp_path / "progress")

    def run():
        documents = stream_documents(spark, str(incoming), files_per_batch=1)
        ingest_stream(documents, root, progress, clock=lambda: at(23)).awaitTermination()

    write_payload(incoming, "a.json", [state(i) for i in range(3)])
    run()
    assert {r[0] for r in totals(spark, root)} == {at(10)}
    run()
    assert tables.read_table(spark, root, "silver_flights").count() == 3
    write_payload(incoming, "b.json", None)
    run()
    write_payload(incoming, "c.json", [state(i, 60) for i in range(4)], START + 60)
    write_payload(incoming, "d.json", [state(i, 1900) for i in range(2)], START + 1900)
    run()
    silver = tables.read_table(spark, root, "silver_flights")
    assert silver.count() == 9
    assert [r[:3] for r in totals(spark, root) if r[0] == at(10)] == sorted((at(10), c, 2 if i < 3 else 1) for i, c in enumerate(COUNTRIES[:4]))
    assert {r[0] for r in totals(spark, root)} == {at(10), at(10, 30)}
    # a micro-batch that comes again changes nothing
    before = totals(spark, root)
    again = tables.read_table(spark, root, "bronze_flights").where("ingestion_batch = 'stream-00000000'")
    process_documents(again.select("raw_data", "source_file"), root, "stream-00000000", now=at(23, 50))
    assert totals(spark, root) == before and sum(r[2] for r in before) == 9


def test_refused_batch_reaches_no_table_but_bronze(spark, tmp_path, at):
    root = str(tmp_path / "wh")
    run_batch(spark, write_payload(tmp_path / "good", "a.json", [state(i) for i in range(3)]), root, "good", now=at(11))
    bad = write_payload(tmp_path / "bad", "a.json", [state(3, _9=-4.0), state(4, _6=123.0)])
    with pytest.raises(QualityError):
        run_batch(spark, bad, root, "bad", now=at(12))
    built = refresh_models(spark, root, now=at(13))
    assert {r.icao24 for r in built["silver_flights_cleaned"].collect()} == {"f0000", "f0001", "f0002"}
    assert tables.read_table(spark, root, "bronze_flights").count() == 2


def test_undo_a_batch(spark, tmp_path, at):
    root = str(tmp_path / "wh")
    run_batch(spark, write_payload(tmp_path / "a", "a.json", [state(i) for i in range(3)]), root, "one", now=at(11))
    before = totals(spark, root)
    run_batch(spark, write_payload(tmp_path / "b", "b.json", [state(i) for i in range(5)]), root, "two", now=at(12), snapshot_as="s1")
    assert totals(spark, root) != before
    undo_batch(spark, root, "two", "s1")
    assert totals(spark, root) == before and tables.read_table(spark, root, "silver_flights").count() == 3


def test_scratch_ends(spark, tmp_path, at):
    run_batch(spark, write_payload(tmp_path / "a", "a.json", [state(0)]), str(tmp_path / "wh"), "one", now=at(11))
    kept = settle(spark.range(3))
    assert path_exists(spark, kept._scratch)
    discard(kept)
    assert not path_exists(spark, kept._scratch)
    root = scratch_root(spark)
    clean_scratch(spark)
    assert not path_exists(spark, root)


def test_half_hour():
    assert half_hour(datetime(2024, 1, 1, 10, 59, 59, 9)) == datetime(2024, 1, 1, 10, 30)
    assert half_hour(datetime(2024, 1, 1, 10, 0)) == datetime(2024, 1, 1, 10)
