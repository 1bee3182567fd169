"""Totals, quarantine and refreshes that follow single batches, against full rebuilds."""

from __future__ import annotations

from threading import Barrier

import pytest
from pyspark.sql import functions as F

from contrail.operators.quality import QualityError, valid_rows
from contrail.plans import pipeline
from contrail.plans.pipeline import (
    QUARANTINE,
    batches_with_status,
    gated_bronze,
    process_documents,
    refresh_arrived,
    refresh_models,
    refresh_totals,
    release_batch,
    run_batch,
    undo_batch,
    undo_load,
)
from contrail.plans.registry import files_per_batch
from contrail.sources import tables, versions
from contrail.sources.files import read_bronze_json
from contrail.streaming.ingest import ingest_stream, stream_documents
from test_pipeline import START, state, totals, write_payload

DAY = 86_400


def feed(spark, tmp_path, root, batch, states, now, time=START):
    path = write_payload(tmp_path / f"in-{batch}", "a.json", states, time)
    return process_documents(read_bronze_json(spark, path), root, batch, now=now)


# totals


def test_a_corrected_batch_takes_its_old_share_back(spark, tmp_path, at):
    root = str(tmp_path / "wh")
    feed(spark, tmp_path, root, "one", [state(i) for i in range(5)], at(11))
    feed(spark, tmp_path, root, "two", [state(i) for i in range(2)], at(11))
    assert [r[1:3] for r in totals(spark, root)] == [("Chile", 1), ("Japan", 1), ("Kenya", 2), ("Malta", 1), ("Norway", 2)]
    feed(spark, tmp_path, root, "one", [state(0, _9=100.0)], at(12))  # four countries less
    assert [r[1:4] for r in totals(spark, root)] == [("Kenya", 1, 195.0), ("Norway", 2, 140.0)]
    feed(spark, tmp_path, root, "one", [state(1)], at(12), START + 1800)  # and then another window
    assert [r[:3] for r in totals(spark, root)] == [(at(10), "Kenya", 1), (at(10), "Norway", 1), (at(10, 30), "Kenya", 1)]


def test_totals_read_the_batches_of_their_windows_only(spark, tmp_path, at, monkeypatch):
    root = str(tmp_path / "wh")
    for n in range(4):
        feed(spark, tmp_path, root, f"b{n}", [state(n)], at(11), START + n * DAY)
    read, seen = versions.read, []

    def watched(session, path, *args, **kwargs):
        df = read(session, path, *args, **kwargs)
        seen.extend(df.inputFiles())
        return df

    monkeypatch.setattr(versions, "read", watched)
    feed(spark, tmp_path, root, "late", [state(1)], at(12), START + 2 * DAY)
    assert not [f for f in seen if "/silver_flights/" in f]
    assert {f.split("ingestion_batch=")[1].split("/")[0] for f in seen if pipeline.SHARES in f} == {"b2", "late"}
    assert {f.split("window_date=")[1].split("/")[0] for f in seen if "/gold_flight_agg/" in f} == {"2024-01-03"}


def test_an_interrupted_load_is_made_up_for(spark, tmp_path, at, monkeypatch):
    root = str(tmp_path / "wh")
    feed(spark, tmp_path, root, "one", [state(i) for i in range(3)], at(11))
    with monkeypatch.context() as broken:
        broken.setattr(pipeline, "replace_windows", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            feed(spark, tmp_path, root, "one", [state(0)], at(12))
    assert refresh_totals(spark, root, at(13)) == 1
    assert [r[1:3] for r in totals(spark, root)] == [("Norway", 1)]
    assert refresh_totals(spark, root, at(13)) == 0


def test_undo_keeps_what_came_later(spark, tmp_path, at):
    root = str(tmp_path / "wh")
    for n in range(3):
        path = write_payload(tmp_path / f"in{n}", "a.json", [state(n), state(3)])
        run_batch(spark, path, root, f"b{n}", now=at(11 + n), snapshot_as=f"before-{n}")
    undo_batch(spark, root, "b1")
    assert [r[1:3] for r in totals(spark, root)] == [("Chile", 1), ("Japan", 2), ("Norway", 1)]
    undo_load(spark, root, "before-1")
    assert [r[1:3] for r in totals(spark, root)] == [("Japan", 1), ("Norway", 1)]
    assert tables.read_table(spark, root, "silver_flights").count() == 2
    assert refresh_totals(spark, root) == 0  # the shares went back with the totals
    assert versions.tagged_or_none(spark, f"{root}/silver_flights", "before-2") is not None


# refused batches


def test_refused_batches_wait_and_are_released(spark, tmp_path, at):
    root = str(tmp_path / "wh")
    bad = [state(0), state(1, _9=-4.0), state(2, _6=123.0), state(3, _6=None, _5=None)]
    feed(spark, tmp_path, root, "good", [state(4)], at(11))
    for batch in ("bad", "worse"):
        with pytest.raises(QualityError, match="velocity"):
            feed(spark, tmp_path, root, batch, bad, at(12))
    noted = {r.rule: r for r in tables.read_table(spark, root, QUARANTINE, ["bad"]).collect()}
    assert noted["velocity is not negative"].violations == noted["latitude within [-90, 90]"].violations == 1
    assert {(r.status, r.row_count, r.refused_at, r.resolved_at) for r in noted.values()} == {("refused", 4, at(12), None)}
    assert tables.read_table(spark, root, "silver_flights").count() == 1

    assert release_batch(spark, root, "bad", now=at(13)) == {"silver_rows": 2, "gold_rows": 3}
    assert {r.icao24 for r in tables.read_table(spark, root, "silver_flights").collect()} == {"f0000", "f0003", "f0004"}
    assert [r[1:3] for r in totals(spark, root)] == [("Japan", 1), ("Malta", 1), ("Norway", 1)]
    assert {(r.status, r.resolved_at) for r in tables.read_table(spark, root, QUARANTINE, ["bad"]).collect()} == {("released valid", at(13))}
    assert batches_with_status(spark, root, "refused") == ["worse"]
    with pytest.raises(ValueError, match="held back"):
        release_batch(spark, root, "bad")
    with pytest.raises(ValueError, match="choice"):
        release_batch(spark, root, "worse", "some")
    assert release_batch(spark, root, "worse", "all", now=at(14))["silver_rows"] == 4


def test_a_corrected_delivery_replaces_a_refused_one(spark, tmp_path, at):
    root = str(tmp_path / "wh")
    with pytest.raises(QualityError):
        feed(spark, tmp_path, root, "b", [state(0, _9=-4.0)], at(11))
    feed(spark, tmp_path, root, "b", [state(0)], at(12))
    assert batches_with_status(spark, root, "refused") == [] and batches_with_status(spark, root, "replaced") == ["b"]
    assert gated_bronze(spark, root, "api").count() == 1


def test_batches_that_are_too_small_wait_too(spark, tmp_path, at):
    root = str(tmp_path / "wh")
    documents = read_bronze_json(spark, write_payload(tmp_path / "in", "a.json", [state(0)]))
    with pytest.raises(QualityError, match="1 rows"):
        process_documents(documents, root, "b", now=at(11), min_row_count=2)
    assert [(r.rule, r.status) for r in tables.read_table(spark, root, QUARANTINE).collect()] == [("the gate", "refused")]


def test_the_bronze_path_stands_behind_the_gate(spark, tmp_path, at):
    root = str(tmp_path / "wh")
    feed(spark, tmp_path, root, "good", [state(4)], at(11))
    for batch, i in (("bad", 0), ("other", 2)):
        with pytest.raises(QualityError):
            feed(spark, tmp_path, root, batch, [state(i), state(i + 1, _9=-4.0)], at(12))
    seen = lambda: {r.icao24 for r in refresh_models(spark, root, "bronze", "api", now=at(13))["silver_flights_cleaned"].collect()}
    assert seen() == {"f0004"}
    release_batch(spark, root, "bad", now=at(13))
    assert seen() == {"f0000", "f0004"}
    release_batch(spark, root, "other", "all", now=at(13))
    assert seen() == {"f0000", "f0002", "f0003", "f0004"}


def test_a_stream_goes_on_after_a_refused_batch(spark, tmp_path, at):
    root, incoming = str(tmp_path / "wh"), tmp_path / "incoming"
    for n, states in enumerate(([state(0)], [state(1, _9=-4.0), state(2)], [state(3)])):
        write_payload(incoming, f"{n}.json", states)
        documents = stream_documents(spark, str(incoming), files_per_batch=1)
        ingest_stream(documents, root, str(tmp_path / "progress"), clock=lambda: at(23)).awaitTermination()
    assert {r.icao24 for r in tables.read_table(spark, root, "silver_flights").collect()} == {"f0000", "f0003"}
    [held] = batches_with_status(spark, root, "refused")
    release_batch(spark, root, held, now=at(23))
    assert {r.icao24 for r in tables.read_table(spark, root, "silver_flights").collect()} == {"f0000", "f0002", "f0003"}


def test_valid_rows_keep_unknown_values(spark):
    columns = "icao24 string, latitude double, longitude double, velocity double, on_ground boolean, time_position long"
    rows = [("a", None, None, None, False, None), ("b", 1.0, 2.0, 0.0, True, 5), (" ", 1.0, 2.0, 0.0, True, 5), ("c", 1.0, 2.0, 0.0, True, None), ("d", 91.0, 2.0, 0.0, True, 5)]
    assert {r.icao24 for r in valid_rows(spark.createDataFrame(rows, columns)).collect()} == {"a", "b"}


# refresh


def contents(built):
    """Rows of every table without the load time; averages rounded, as sums may be taken in another order."""
    found = {}
    for name, df in built.items():
        plain = df.drop("load_time").select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.drop("load_time").dtypes])
        found[name] = sorted((tuple(r) for r in plain.collect()), key=str)
    return found


def silver_batch(spark, root, batch, states, now):
    from contrail.operators.silver import to_silver

    import json

    documents = spark.createDataFrame([(json.dumps({"time": START, "states": states}), "f")], "raw_data string, source_file string")
    tables.append_silver(to_silver(documents), root, batch, now)


def full(spark, root, now):
    """A full rebuild of the same silver, beside the tables."""
    beside = f"{root}-full"
    stored = tables.read_table(spark, root, "silver_flights")
    versions.write(stored, f"{beside}/silver_flights", "ingestion_batch", replace=None)
    return contents(refresh_models(spark, beside, now=now))


def test_arrived_reports_give_what_a_full_rebuild_gives(spark, tmp_path, at):
    root = str(tmp_path / "wh")
    for day in (0, 2, 9, 10, 12):
        silver_batch(spark, root, f"day-{day}", [state(i, day * DAY + 600 * i, _9=100.0 + 10 * i) for i in range(5)], at(1))
    first = contents(refresh_arrived(spark, root, at(2)))
    assert first == full(spark, root, at(2))
    before = {n: versions.current(spark, f"{root}/{n}") for n in ("silver_flights_cleaned", "gold_flight_trajectories", "gold_speed_anomalies")}

    # late ones for an old day, the last of which changes a link ten days on; one new day; some without a time
    late = [state(i, 2 * DAY + 40_000 + i, _9=333.0) for i in range(3)] + [state(6, 3 * DAY)]
    silver_batch(spark, root, "late", late, at(3))
    silver_batch(spark, root, "untimed", [state(7, 0, _3=None, _5=None, _6=None)], at(3))
    second = contents(refresh_arrived(spark, root, at(4)))
    assert second == full(spark, root, at(4)) and second != first
    after = {n: versions.current(spark, f"{root}/{n}") for n in before}
    kept = lambda n: {d for d, p in before[n].parts.items() if after[n].parts.get(d) == p}
    days = {d: f"2024-01-{d + 1:02d}" for d in (0, 2, 9, 10, 12)}
    assert kept("silver_flights_cleaned") == kept("gold_speed_anomalies") == {days[d] for d in (0, 9, 10, 12)}
    assert kept("gold_flight_trajectories") == {days[d] for d in (0, 10, 12)}  # day 9 follows the changed last points

    # corrected, undone and repeated batches
    silver_batch(spark, root, "day-9", [state(0, 9 * DAY)], at(5))
    tables.drop_batch(spark, root, "silver_flights", "day-0")
    third = contents(refresh_arrived(spark, root, at(6)))
    assert third == full(spark, root, at(6)) and third != second
    assert contents(refresh_arrived(spark, root, at(7))) == third


def test_a_refresh_reads_the_batches_of_its_days_only(spark, tmp_path, at, monkeypatch):
    root = str(tmp_path / "wh")
    for day in range(4):
        silver_batch(spark, root, f"day-{day}", [state(0, day * DAY)], at(1))
    refresh_arrived(spark, root, at(2))
    silver_batch(spark, root, "late", [state(1, 2 * DAY)], at(3))
    read, seen = versions.read, []

    def watched(session, path, *args, **kwargs):
        df = read(session, path, *args, **kwargs)
        if path.endswith("/silver_flights"):
            seen.extend(df.inputFiles())
        return df

    monkeypatch.setattr(versions, "read", watched)
    refresh_arrived(spark, root, at(4))
    assert {f.split("ingestion_batch=")[1].split("/")[0] for f in seen} == {"day-2", "late"}


def test_no_silver_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        refresh_arrived(spark, str(tmp_path / "wh"))


def test_the_newest_window_is_read_from_one_date(spark, tmp_path, at):
    root = str(tmp_path / "wh")
    model = spark.createDataFrame([(at(h, day=d), "X", h) for d in (1, 2, 3) for h in (1, 5)], "window_start timestamp_ntz, origin_country string, rank int")
    tables.materialize(model, root, "gold_top_busiest_countries", now=at(4))
    newest = tables.read_newest(spark, root, "gold_top_busiest_countries")
    assert {f.split("window_date=")[1].split("/")[0] for f in newest.inputFiles()} == {"2024-01-03"}
    assert newest.count() == 2
    with pytest.raises(FileNotFoundError):
        tables.read_newest(spark, root, "gold_speed_anomalies")


def test_a_backlog_is_cut_into_a_bounded_number_of_micro_batches():
    """The totals of a window are added up at each step, so steps that grow with the backlog would cost its square."""
    assert files_per_batch(3) == files_per_batch(64) == 8
    assert files_per_batch(200) == 25
    assert all(-(-n // files_per_batch(n)) <= 8 for n in (1, 8, 63, 65, 1_200, 12_000, 72_001))


def test_independent_models_are_built_side_by_side(spark, tmp_path, at, monkeypatch):
    """Two models that wait for each other end: neither is planned after the other is stored."""
    met = Barrier(2, timeout=60)

    def waiting(model):
        def build(silver):
            met.wait()
            return model(silver)

        return build

    two = ("gold_altitude_distribution", "gold_top_busiest_countries")
    monkeypatch.setattr(pipeline, "RECENT_MODELS", {n: waiting(pipeline.RECENT_MODELS[n]) for n in two} | {"gold_flight_aggregations": pipeline.RECENT_MODELS["gold_flight_aggregations"]})
    root = str(tmp_path / "wh")
    feed(spark, tmp_path, root, "a", [state(1), state(2, DAY)], at(1))
    assert refresh_arrived(spark, root, at(2))["gold_top_busiest_countries"].agg(F.sum("total_flights")).first()[0] == 2
    feed(spark, tmp_path, root, "b", [state(3, DAY)], at(3))
    refresh_arrived(spark, root, at(4))
    assert tables.read_table(spark, root, two[1]).agg(F.sum("total_flights")).first()[0] == 3
