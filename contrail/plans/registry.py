"""Every query by name, over a folder of test tables.

Each one derives its position reports from the whole `events` table. Computed
averages are rounded to six digits; a nudge far below that digit keeps exact
ties from depending on the order in which an engine adds numbers up.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import lru_cache, partial, reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.columns import calendar_features, hour_start
from contrail.operators import features, gold
from contrail.operators.classifier import class_weights, classification_report, report_averages
from contrail.operators.iforest import SIGNALS, IsolationForest
from contrail.operators.quantiles import exact_quantile
from contrail.operators.quality import QualityError, quality_report, validate
from contrail.operators.sampling import key_split, sample_n, stratified_split
from contrail.operators.silver import bronze_view, clean_silver, dedupe_latest, latest_first, to_silver
from contrail.operators.upsert import upsert
from contrail.plans import models, serving
from contrail.plans.pipeline import (
    batches_with_status,
    gated_bronze,
    load_predictions,
    process_documents,
    refresh_arrived,
    refresh_models,
    release_batch,
    run_batch,
)
from contrail.schemas import (
    COUNTRY_TOTALS_KEYS,
    COUNTRY_TOTALS_UPDATES,
    PREDICTION_KEYS,
    PREDICTION_UPDATES,
    SILVER,
)
from contrail.session import listed, scratch_path, settle
from contrail.sources import tables, versions
from contrail.sources.derived import EVENTS_PER_DOCUMENT, raw_documents, rule_predictions, valid_reports
from contrail.sources.events import event_reports
from contrail.sources.files import read_bronze_json, read_predictions, read_silver, read_silver_dir, write_layer
from contrail.streaming.ingest import ingest_stream, stream_documents
from contrail.streaming.windows import flight_sessions, store_closed, stream_reports, windowed_totals

NOW = datetime(2024, 1, 31)
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__.removeprefix("run_")] = build
    return build


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in columns})


def silver(spark: SparkSession, root: str) -> DataFrame:
    return clean_silver(event_reports(spark, root), tie=["event_id"])


def stored_silver(spark: SparkSession, root: str) -> DataFrame:
    """Cleaned silver written once, for queries that read it more than once."""
    return settle(silver(spark, root), "silver")


# Silver -------------------------------------------------------------------------


@query
def run_dedupe_latest(spark: SparkSession, root: str) -> DataFrame:
    reports = event_reports(spark, root)
    order = latest_first(reports, ["event_id"])
    return dedupe_latest(reports, ["icao24", "time_position"], order).select(
        "event_id", "delivery", "icao24", "time_position", "ingestion_time", "velocity"
    )


@query
def run_clean_silver(spark: SparkSession, root: str) -> DataFrame:
    return silver(spark, root)


@query
def flatten_states(spark: SparkSession, root: str) -> DataFrame:
    return to_silver(raw_documents(event_reports(spark, root))).select(*SILVER.names)


@query
def flatten_states_legacy(spark: SparkSession, root: str) -> DataFrame:
    return bronze_view(raw_documents(event_reports(spark, root)), "legacy_sql").select(*SILVER.names)


@query
def run_calendar_features(spark: SparkSession, root: str) -> DataFrame:
    reports = event_reports(spark, root).select("event_id", "delivery", "time_position")
    return calendar_features(reports)


@query
def run_quality_report(spark: SparkSession, root: str) -> DataFrame:
    return quality_report(silver(spark, root))


@query
def quality_violations(spark: SparkSession, root: str) -> DataFrame:
    return validate(event_reports(spark, root))


@query
def retention_filter(spark: SparkSession, root: str) -> DataFrame:
    kept = tables.apply_retention(event_reports(spark, root), 7, NOW)
    return kept.select("event_id", "delivery", "ingestion_time")


# Gold ---------------------------------------------------------------------------


@query
def country_totals(spark: SparkSession, root: str) -> DataFrame:
    return rounded(gold.gold_country_totals(event_reports(spark, root)), "avg_velocity")


@query
def flight_aggregations(spark: SparkSession, root: str) -> DataFrame:
    return rounded(
        gold.gold_flight_aggregations(stored_silver(spark, root)),
        "avg_velocity",
        "median_velocity",
        "avg_baro_altitude",
        "avg_geo_altitude",
        "position_validity_pct",
    )


@query
def aircraft_activity(spark: SparkSession, root: str) -> DataFrame:
    return rounded(gold.gold_aircraft_activity(silver(spark, root)), "avg_velocity", "avg_altitude")


@query
def altitude_distribution(spark: SparkSession, root: str) -> DataFrame:
    return gold.gold_altitude_distribution(silver(spark, root))


@query
def density_heatmap(spark: SparkSession, root: str) -> DataFrame:
    return rounded(
        gold.gold_flight_density_heatmap(silver(spark, root)), "avg_velocity", "avg_baro_altitude"
    )


def _daily(spark: SparkSession, root: str) -> DataFrame:
    return gold.gold_country_daily_summary(gold.hourly_figures(silver(spark, root)))


@query
def country_daily_summary(spark: SparkSession, root: str) -> DataFrame:
    return rounded(_daily(spark, root), "daily_avg_velocity", "on_ground_ratio", "flights_7day_avg")


@query
def flight_trajectories(spark: SparkSession, root: str) -> DataFrame:
    return gold.gold_flight_trajectories(stored_silver(spark, root))


@query
def speed_anomalies(spark: SparkSession, root: str) -> DataFrame:
    return rounded(
        gold.gold_speed_anomalies(stored_silver(spark, root)),
        "hourly_mean_velocity",
        "hourly_stddev_velocity",
        "z_score",
    )


@query
def top_busiest_countries(spark: SparkSession, root: str) -> DataFrame:
    return gold.gold_top_busiest_countries(silver(spark, root))


# Serving ------------------------------------------------------------------------


@query
def busiest_countries_latest(spark: SparkSession, root: str) -> DataFrame:
    return serving.busiest_countries_latest(gold.gold_top_busiest_countries(stored_silver(spark, root)))


@query
def velocity_trend(spark: SparkSession, root: str) -> DataFrame:
    trend = serving.velocity_trend(gold.hourly_figures(silver(spark, root)))
    return rounded(trend, "global_avg_velocity")


@query
def density_latest(spark: SparkSession, root: str) -> DataFrame:
    return serving.density_latest(gold.gold_flight_density_heatmap(stored_silver(spark, root)))


@query
def anomalies_by_country(spark: SparkSession, root: str) -> DataFrame:
    return rounded(
        serving.anomalies_by_country(gold.gold_speed_anomalies(stored_silver(spark, root))), "avg_z_score"
    )


@query
def daily_summary_500(spark: SparkSession, root: str) -> DataFrame:
    return rounded(
        serving.daily_summary(_daily(spark, root)),
        "daily_avg_velocity",
        "flights_7day_avg",
        "on_ground_ratio",
    )


@query
def daily_summary_countries(spark: SparkSession, root: str) -> DataFrame:
    return rounded(
        serving.daily_summary(_daily(spark, root), countries=["NATION_1", "NATION_2", "UNKNOWN"]),
        "daily_avg_velocity",
        "flights_7day_avg",
        "on_ground_ratio",
    )


@query
def available_countries(spark: SparkSession, root: str) -> DataFrame:
    return serving.available_countries(_daily(spark, root))


@query
def altitude_latest(spark: SparkSession, root: str) -> DataFrame:
    return serving.altitude_latest(gold.gold_altitude_distribution(stored_silver(spark, root)))


@query
def altitude_top_countries(spark: SparkSession, root: str) -> DataFrame:
    return serving.altitude_top_countries(gold.gold_altitude_distribution(stored_silver(spark, root)))


@query
def kpi_snapshot(spark: SparkSession, root: str) -> DataFrame:
    cleaned = stored_silver(spark, root)
    tiles = serving.kpi_snapshot(
        gold.gold_top_busiest_countries(cleaned),
        gold.hourly_figures(cleaned),
        gold.gold_speed_anomalies(cleaned),
    )
    return rounded(tiles, "latest_velocity")


def _predictions(spark: SparkSession, root: str) -> DataFrame:
    return rule_predictions(event_reports(spark, root))


@query
def ml_predictions_latest(spark: SparkSession, root: str) -> DataFrame:
    return serving.ml_predictions_latest(_predictions(spark, root))


@query
def ml_country_summary(spark: SparkSession, root: str) -> DataFrame:
    return rounded(
        serving.ml_country_summary(_predictions(spark, root)), "avg_onground_prob", "avg_anomaly_score"
    )


@query
def kpi_ml(spark: SparkSession, root: str) -> DataFrame:
    return rounded(serving.kpi_ml(_predictions(spark, root)), "anomaly_pct", "avg_onground_prob")


@query
def top_anomalous_flights(spark: SparkSession, root: str) -> DataFrame:
    return serving.top_anomalous_flights(_predictions(spark, root))


@query
def run_sample_n(spark: SparkSession, root: str) -> DataFrame:
    return sample_n(_predictions(spark, root), 2000, ["icao24", "window_start"])


# Tables -------------------------------------------------------------------------


def _hourly_totals(reports: DataFrame) -> DataFrame:
    return reports.groupBy(hour_start(F.col("ingestion_time")).alias("window_start"), "origin_country").agg(
        F.count("icao24").alias("total_flights"),
        F.avg("velocity").alias("avg_velocity"),
        F.sum(F.col("on_ground").cast("int")).alias("on_ground_sum"),
    )


def _deliveries(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    reports = event_reports(spark, root)
    return reports.where("delivery = 0"), reports.where("delivery = 1")


@query
def upsert_country_totals(spark: SparkSession, root: str) -> DataFrame:
    first, second = _deliveries(spark, root)
    merged = upsert(
        _hourly_totals(first),
        _hourly_totals(second),
        COUNTRY_TOTALS_KEYS,
        COUNTRY_TOTALS_UPDATES,
        unique=True,
    )
    return rounded(merged, "avg_velocity")


@query
def upsert_predictions(spark: SparkSession, root: str) -> DataFrame:
    first, second = (rule_predictions(d).drop("on_ground") for d in _deliveries(spark, root))
    return upsert(first, second, PREDICTION_KEYS, PREDICTION_UPDATES, unique=True)


@query
def stored_country_totals(spark: SparkSession, root: str) -> DataFrame:
    """The country totals again, by way of a stored table and two loads."""
    home = scratch_path(spark, "totals")
    for batch in _deliveries(spark, root):
        tables.upsert_table(
            _hourly_totals(batch), home, "gold_flight_agg", COUNTRY_TOTALS_KEYS, COUNTRY_TOTALS_UPDATES, NOW
        )
    stored = tables.read_table(spark, home, "gold_flight_agg").drop("load_time", "window_date")
    return rounded(stored, "avg_velocity")


@query
def stored_predictions(spark: SparkSession, root: str) -> DataFrame:
    """Predictions loaded in two batches and served from the stored table."""
    home = scratch_path(spark, "predictions")
    for batch in _deliveries(spark, root):
        load_predictions(rule_predictions(batch), home, NOW)
    return serving.ml_predictions_latest(tables.read_table(spark, home, "gold_ml_predictions"))


@query
def stored_density_latest(spark: SparkSession, root: str) -> DataFrame:
    """The latest density, read from the materialised heatmap."""
    home = scratch_path(spark, "heatmap")
    heatmap = gold.gold_flight_density_heatmap(silver(spark, root))
    stored = tables.materialize(heatmap, home, "gold_flight_density_heatmap", now=NOW)
    return serving.density_latest(stored)


@query
def silver_batches(spark: SparkSession, root: str) -> DataFrame:
    """Two appended silver batches, the second one loaded twice."""
    home = scratch_path(spark, "batches")
    first, second = (to_silver(raw_documents(d)) for d in _deliveries(spark, root))
    tables.append_silver(first, home, "first", NOW)
    for _ in range(2):
        tables.append_silver(second, home, "second", NOW)
    stored = tables.read_table(spark, home, "silver_flights")
    return stored.select("ingestion_batch", *SILVER.names)


@query
def snapshot_rollback(spark: SparkSession, root: str) -> DataFrame:
    """The totals after a second load was undone from a snapshot."""
    home = scratch_path(spark, "snapshot")
    name = "gold_flight_agg"
    first, second = (_hourly_totals(d) for d in _deliveries(spark, root))
    tables.upsert_table(first, home, name, COUNTRY_TOTALS_KEYS, COUNTRY_TOTALS_UPDATES, NOW)
    taken = tables.snapshot(spark, home, [name])
    tables.upsert_table(second, home, name, COUNTRY_TOTALS_KEYS, COUNTRY_TOTALS_UPDATES, NOW)
    tables.rollback(spark, home, taken, [name])
    restored = tables.read_table(spark, home, name).drop("load_time", "window_date")
    return rounded(restored, "avg_velocity")


@query
def retained_batches(spark: SparkSession, root: str) -> DataFrame:
    """Rows per daily batch that a seven-day retention leaves in a table."""
    home = scratch_path(spark, "retention")
    batch = F.date_format("ingestion_time", "yyyyMMdd").alias("ingestion_batch")
    tables.write_batches(
        event_reports(spark, root).select("event_id", "delivery", "ingestion_time", batch),
        f"{home}/silver_flights",
    )
    tables.retain_table(spark, home, "silver_flights", 7, datetime(2024, 1, 31, 12))
    kept = tables.read_table(spark, home, "silver_flights")
    return kept.groupBy("ingestion_batch").agg(F.count(F.lit(1)).alias("rows"))


DAY = 86_400
#: Files that a micro-batch takes at least, and micro-batches that a backlog of more files is cut into.
LEAST_FILES, MICRO_BATCHES = 8, 8


def files_per_batch(files: int) -> int:
    """Files a micro-batch takes, so that the steps of a backlog do not grow with it, only their size."""
    return max(LEAST_FILES, -(-files // MICRO_BATCHES))


@query
def stream_totals(spark: SparkSession, root: str) -> DataFrame:
    """Country totals after several micro-batches to a window, the first of which came twice."""
    home = scratch_path(spark, "stream-totals")
    documents = raw_documents(valid_reports(event_reports(spark, root)), period=DAY)
    documents.select("raw_data").write.option("maxRecordsPerFile", 1).text(f"{home}/incoming")
    files = sum(name.startswith("part-") for name, _ in listed(spark, f"{home}/incoming"))
    stream = stream_documents(spark, f"{home}/incoming", files_per_batch(files))
    ingest_stream(stream, home, f"{home}/progress", clock=lambda: NOW).awaitTermination()
    first = tables.read_table(spark, home, "bronze_flights").where("ingestion_batch = 'stream-00000000'")
    process_documents(first.select("raw_data", "source_file"), home, "stream-00000000", now=NOW)
    totals = tables.read_table(spark, home, "gold_flight_agg").drop("load_time", "window_date")
    return rounded(totals, "avg_velocity")


@query
def corrected_batch(spark: SparkSession, root: str) -> DataFrame:
    """Country totals after two batches to the same windows, the first of which came again with fewer rows."""
    home = scratch_path(spark, "corrected")
    reports = valid_reports(event_reports(spark, root))
    first, second = (reports.where(f"event_id % 2 = {i}") for i in (0, 1))
    corrected = first.where("origin_country NOT IN ('NATION_1', 'NATION_2') AND event_id % 3 <> 0")
    for batch, rows in (("first", first), ("second", second), ("first", corrected)):
        process_documents(raw_documents(rows, period=DAY), home, batch, now=NOW)
    totals = tables.read_table(spark, home, "gold_flight_agg").drop("load_time", "window_date")
    return rounded(totals, "avg_velocity")


@query
def quarantined_stream(spark: SparkSession, root: str) -> DataFrame:
    """Silver rows after a stream brought a good, a bad and a good batch, and the valid rows of the bad one were released."""
    home = scratch_path(spark, "quarantined")
    reports = event_reports(spark, root)
    for n, rows in enumerate((valid_reports(reports), reports, valid_reports(reports))):
        documents = raw_documents(rows.where(f"floor(event_id / {EVENTS_PER_DOCUMENT}) % 3 = {n}"))
        documents.select("raw_data").write.mode("append").option("maxRecordsPerFile", 1).text(f"{home}/incoming")
        stream = stream_documents(spark, f"{home}/incoming")
        ingest_stream(stream, home, f"{home}/progress", clock=lambda: NOW).awaitTermination()
    for batch in batches_with_status(spark, home, "refused"):
        release_batch(spark, home, batch, "valid", now=NOW)
    return tables.read_table(spark, home, "silver_flights").select(*SILVER.names)


@query
def released_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Reports per aircraft on the bronze path: a good batch, one held back, and the valid rows of a third."""
    home = scratch_path(spark, "bronze-path")
    reports = event_reports(spark, root)
    for n, rows in enumerate((valid_reports(reports), reports, reports)):
        documents = raw_documents(rows.where(f"event_id % 3 = {n} AND delivery = 0"))
        try:
            process_documents(documents, home, f"batch-{n}", now=NOW)
        except QualityError:
            pass
    release_batch(spark, home, "batch-2", "valid", now=NOW)
    view = gated_bronze(spark, home, layout="api")
    return view.groupBy("icao24").agg(
        F.count(F.lit(1)).alias("reports"), F.count("latitude").alias("placed"), F.min("velocity").alias("slowest")
    )


@query
def late_reports(spark: SparkSession, root: str) -> DataFrame:
    """Links per aircraft after a first refresh, a batch of late reports for older days, and a refresh of what arrived."""
    home = scratch_path(spark, "late")
    placed = valid_reports(event_reports(spark, root)).where("delivery = 0 AND latitude IS NOT NULL")
    is_late = F.pmod(F.dayofyear("time_position"), F.lit(7)) == 3
    for batch, rows in (("in-time", placed.where(~is_late)), ("late", placed.where(is_late))):
        tables.append_silver(to_silver(raw_documents(rows)), home, batch, NOW)
        built = refresh_arrived(spark, home, NOW)
    links = built["gold_flight_trajectories"]
    return links.select("icao24", "start_time", "end_time", "time_delta_seconds", "is_new_segment")


@query
def late_activity(spark: SparkSession, root: str) -> DataFrame:
    """Lifetime figures per aircraft after a batch was refreshed, undone and another one came."""
    home = scratch_path(spark, "late-activity")
    placed = valid_reports(event_reports(spark, root)).where("delivery = 0 AND latitude IS NOT NULL")
    for n in range(3):
        tables.append_silver(to_silver(raw_documents(placed.where(f"event_id % 3 = {n}"))), home, f"batch-{n}", NOW)
        built = refresh_arrived(spark, home, NOW)
        if n == 1:
            tables.drop_batch(spark, home, "silver_flights", "batch-1")
    activity = built["gold_aircraft_activity"].groupBy("icao24")
    return activity.agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("position_count").alias("positions"))


@query
def versioned_totals(spark: SparkSession, root: str) -> DataFrame:
    """The totals as read by one who began before a load, by one after it, and after a broken write and a rollback."""
    home, name = scratch_path(spark, "versioned"), "gold_flight_agg"
    first, second = (_hourly_totals(d) for d in _deliveries(spark, root))
    load = partial(tables.upsert_table, root=home, name=name, keys=COUNTRY_TOTALS_KEYS, update_columns=COUNTRY_TOTALS_UPDATES, now=NOW)
    load(first)
    taken = tables.snapshot(spark, home, [name])
    begun = tables.read_table(spark, home, name)
    load(second)
    loaded = tables.read_table(spark, home, name)
    second.write.parquet(f"{home}/{name}/write=broken/window_date=2024-01-01")  # a write that never gets as far as its version
    tables.rollback(spark, home, taken, [name])
    reads = {"begun": begun, "loaded": loaded, "restored": tables.read_table(spark, home, name)}
    tagged = [df.select(F.lit(moment).alias("moment"), *first.columns) for moment, df in reads.items()]
    return rounded(reduce(lambda a, b: a.unionByName(b), tagged), "avg_velocity")


@query
def stored_anomalies_by_country(spark: SparkSession, root: str) -> DataFrame:
    """The newest window's anomalies, from the one date of the stored table whose range holds it."""
    home = scratch_path(spark, "anomalies")
    tables.materialize(gold.gold_speed_anomalies(stored_silver(spark, root)), home, "gold_speed_anomalies", now=NOW)
    return rounded(serving.anomalies_by_country(tables.read_newest(spark, home, "gold_speed_anomalies")), "avg_z_score")


@query
def gated_silver(spark: SparkSession, root: str) -> DataFrame:
    """Cleaned silver per aircraft after one good batch and one that the gate refused."""
    home = scratch_path(spark, "gated")
    first, second = _deliveries(spark, root)
    process_documents(raw_documents(valid_reports(first)), home, "good", now=NOW)
    try:
        process_documents(raw_documents(second), home, "bad", now=NOW)
    except QualityError:
        pass
    cleaned = refresh_models(spark, home, now=NOW)["silver_flights_cleaned"]
    return cleaned.groupBy("icao24").agg(
        F.count(F.lit(1)).alias("reports"), F.min("time_position").alias("first_seen"), F.max("time_position").alias("last_seen")
    )


@query
def silver_folder(spark: SparkSession, root: str) -> DataFrame:
    """Silver written as CSV with three different headers, read back by column name."""
    home = scratch_path(spark, "folder")
    rows = to_silver(raw_documents(event_reports(spark, root))).select(*SILVER.names)
    layouts = [SILVER.names, SILVER.names[::-1], [c for c in SILVER.names if c not in ("vertical_rate", "true_track")]]
    for i, names in enumerate(layouts):
        part = rows.where(F.pmod(F.col("last_contact"), F.lit(3)) == i).select(*names)
        write_layer(part, f"{home}/flight_silver_{i}.csv")
    read = read_silver_dir(spark, f"{home}/*", "part-*.csv")
    return read.select(*SILVER.names)


@query
def landed_batch(spark: SparkSession, root: str) -> DataFrame:
    """Silver rows of raw files that were landed, read back and run as one batch, twice."""
    home = scratch_path(spark, "landed")
    documents = raw_documents(valid_reports(event_reports(spark, root)))
    documents.select("raw_data").write.option("maxRecordsPerFile", 1).text(f"{home}/incoming")
    for _ in range(2):
        run_batch(spark, f"{home}/incoming", home, "batch", now=NOW)
    landed = to_silver(read_bronze_json(spark, f"{home}/landing/ingestion_batch=batch"))
    stored = tables.read_table(spark, home, "silver_flights")
    names = SILVER.names
    return landed.select(F.lit("landed").alias("part"), *names).unionByName(stored.select(F.lit("silver").alias("part"), *names))


@query
def silver_file(spark: SparkSession, root: str) -> DataFrame:
    """Silver written as one CSV layer and read back by its header."""
    rows = to_silver(raw_documents(event_reports(spark, root))).select(*SILVER.names)
    return read_silver(spark, write_layer(rows, f"{scratch_path(spark, 'silver-file')}/flight_silver.csv"))


@query
def prediction_files(spark: SparkSession, root: str) -> DataFrame:
    """Predictions written as CSV with windows two hours ahead of UTC, read back and prepared for their table."""
    ahead = F.date_format(F.col("window_start") + F.expr("INTERVAL '2' HOUR"), "yyyy-MM-dd'T'HH:mm:ss'+02:00'")
    rows = _predictions(spark, root).withColumn("window_start", ahead)
    read = read_predictions(spark, write_layer(rows, f"{scratch_path(spark, 'predictions')}/ml_predictions.csv"))
    return tables.prepare_predictions(read)


@query
def flagged_features(spark: SparkSession, root: str) -> DataFrame:
    """Feature rows when some reports lack the ground flag: these are left out, before medians and codes are taken."""
    reports = event_reports(spark, root).withColumn("on_ground", F.when(F.col("event_id") % 19 != 0, F.col("on_ground")))
    return features.engineer_features(reports, ids=["event_id", "delivery"])[0].drop("meta")


@query
def stream_ingest(spark: SparkSession, root: str) -> DataFrame:
    """Silver rows after a file stream of raw documents ran through the batch flow."""
    home = scratch_path(spark, "stream")
    documents = raw_documents(valid_reports(event_reports(spark, root)))
    documents.select("raw_data").write.option("maxRecordsPerFile", 1).text(f"{home}/incoming")
    stream = stream_documents(spark, f"{home}/incoming")
    ingest_stream(stream, home, f"{home}/progress", clock=lambda: NOW).awaitTermination()
    return tables.read_table(spark, home, "silver_flights").select(*SILVER.names)


@query
def run_flight_sessions(spark: SparkSession, root: str) -> DataFrame:
    """Sessions of each aircraft, split where more than an hour passes between reports."""
    return flight_sessions(event_reports(spark, root))


@query
def watermarked_totals(spark: SparkSession, root: str) -> DataFrame:
    """Closed hourly totals of a stream whose last arrivals are late: some still count, some come after the watermark."""
    home = scratch_path(spark, "watermark")
    reports = event_reports(spark, root).where("delivery = 0").select("event_id", "icao24", "origin_country", "time_position", "velocity", "on_ground")
    late, early = F.col("event_id") % 7 == 0, F.col("time_position") < F.lit(datetime(2024, 1, 10)).cast("timestamp_ntz")
    for arriving in (~late & early, ~late & ~early, late):
        reports.where(arriving).write.mode("append").parquet(f"{home}/incoming")
        totals = windowed_totals(stream_reports(spark, f"{home}/incoming", reports), delay="2 days")
        store_closed(totals, f"{home}/closed", f"{home}/progress").awaitTermination()
    return rounded(versions.read(spark, f"{home}/closed").drop("ingestion_batch"), "avg_velocity")


# Models -------------------------------------------------------------------------


@query
def impute_features(spark: SparkSession, root: str) -> DataFrame:
    filled = features.impute(event_reports(spark, root))
    return filled.select(
        "event_id", "delivery", "velocity", "baro_altitude", "vertical_rate", "true_track"
    )


@query
def grid_buckets(spark: SparkSession, root: str) -> DataFrame:
    return features.grid_buckets(event_reports(spark, root)).select(
        "event_id", "delivery", "lat_bucket", "lon_bucket"
    )


@query
def country_encoding(spark: SparkSession, root: str) -> DataFrame:
    reports = event_reports(spark, root)
    encoder = features.fit_country_encoder(reports)
    return features.encode_country(reports, encoder).select(
        "event_id", "delivery", "origin_country", "country_encoded"
    )


def _matrix(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    return features.engineer_features(event_reports(spark, root), ids=["event_id", "delivery"])


@query
def feature_matrix(spark: SparkSession, root: str) -> DataFrame:
    return _matrix(spark, root)[0].drop("meta")


@query
def run_class_weights(spark: SparkSession, root: str) -> DataFrame:
    labels = event_reports(spark, root).select(F.col("on_ground").cast("double").alias("label"))
    return rounded(class_weights(labels), "weight")


@query
def train_test_split(spark: SparkSession, root: str) -> DataFrame:
    train, test = key_split(event_reports(spark, root), ["event_id", "delivery"])
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return sides.select("event_id", "delivery", "on_ground", "side")


@query
def run_stratified_split(spark: SparkSession, root: str) -> DataFrame:
    """Which rows are held out when each class gives exactly a fifth; the country stands for the class."""
    reports = event_reports(spark, root).select("event_id", "delivery", "origin_country")
    train, test = stratified_split(reports, ["event_id", "delivery"], label="origin_country")
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query
def exact_percentiles(spark: SparkSession, root: str) -> DataFrame:
    """Quantiles of nearly equal values beside far ones, which no even cut of their range tells apart."""
    reports = event_reports(spark, root)
    near = 200 + F.col("velocity") * 1e-9
    values = reports.select("on_ground", F.when(F.col("event_id") % 1000 == 0, F.col("velocity") * 1e12).otherwise(near).alias("v"))
    parts = [exact_quantile(values, "v", q, ["on_ground"], "value").withColumn("q", F.lit(q)) for q in (0.05, 0.5, 0.95)]
    return reduce(lambda a, b: a.unionByName(b), parts).withColumn("value", F.round("value", 12))


@lru_cache(maxsize=2)
def _planted(app: str, root: str):
    spark = SparkSession.active()
    rows = silver(spark, root).where("velocity IS NOT NULL AND baro_altitude IS NOT NULL")
    planted = rows.withColumn("on_ground", F.expr("baro_altitude < 3000 AND velocity < 60"))
    return models.train(*features.engineer_features(planted), trees=20)


@query
def planted_report(spark: SparkSession, root: str) -> DataFrame:
    """Held-out figures of a forest where the class follows from altitude and speed: it must find it."""
    report = _planted(spark.sparkContext.applicationId, root)[1]
    return report.select("class", "support", *[(F.col(c) > 0.95).alias(f"high_{c}") for c in ("precision", "recall", "f1")])


@query
def planted_importances(spark: SparkSession, root: str) -> DataFrame:
    """Which features weigh where the class follows from altitude and speed, and from nothing else."""
    rows = _planted(spark.sparkContext.applicationId, root)[2]
    return rows.select("feature", (F.col("importance") > 0.1).alias("weighs"))


@query
def run_classification_report(spark: SparkSession, root: str) -> DataFrame:
    """Precision, recall and F1 of the rule predictions."""
    report = classification_report(_predictions(spark, root), "on_ground", "predicted_on_ground")
    return rounded(report, "precision", "recall", "f1")


@query
def run_report_averages(spark: SparkSession, root: str) -> DataFrame:
    """Accuracy and averages of the report on the rule predictions."""
    averages = report_averages(run_classification_report(spark, root))
    return rounded(averages, "precision", "recall", "f1")


@lru_cache(maxsize=2)
def _trained(app: str, root: str):
    spark = SparkSession.active()
    matrix, encoder = features.engineer_features(silver(spark, root))
    return models.train(matrix, encoder)


def trained(spark: SparkSession, root: str):
    """Models of a test folder, trained once per application."""
    return _trained(spark.sparkContext.applicationId, root)


@query
def score_batch(spark: SparkSession, root: str) -> DataFrame:
    """Every scored row, and whether its figures agree with each other and with the batch."""
    fitted, _, _ = trained(spark, root)
    scored = models.score_batch(silver(spark, root), fitted, window_start="2024-01-31T00:00:00+00:00")
    scored = settle(scored, "scored")
    share = scored.select(F.avg(F.col("is_anomaly").cast("double"))).scalar()
    p, ground = F.col("onground_probability"), F.col("predicted_on_ground")
    return scored.select(
        "icao24",
        "origin_country",
        "velocity",
        "baro_altitude",
        "on_ground",
        "window_start",
        p.between(0, 1).alias("probability_in_range"),
        F.when(ground, p >= 0.5).otherwise(p <= 0.5).alias("class_follows_probability"),
        F.when(F.col("is_anomaly"), F.col("anomaly_score") <= 0).otherwise(F.col("anomaly_score") >= 0).alias("anomaly_follows_score"),
        (F.abs(share - 0.05) < 0.01).alias("one_in_twenty_is_odd"),
    )


@query
def onground_report(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the held-out report: their support, and whether the figures are proper shares."""
    report = trained(spark, root)[1]
    proper = [F.col(c).between(0, 1) for c in ("precision", "recall", "f1")]
    return report.select("class", "support", (proper[0] & proper[1] & proper[2]).alias("proper_shares"))


@query
def run_feature_importances(spark: SparkSession, root: str) -> DataFrame:
    """Each feature, and whether the importances are shares of one."""
    rows = trained(spark, root)[2]
    whole = rows.select(F.sum("importance")).scalar()
    return rows.select("feature", F.col("importance").between(0, 1).alias("proper_share"), (F.abs(whole - 1) < 1e-6).alias("sum_is_one"))


@query
def forest_scores(spark: SparkSession, root: str) -> DataFrame:
    """Scores of a forest of two hand-made trees, whose paths SQL can follow."""
    nodes = [
        (0, 0, 0, 120.0, 1, 2, 0.0), (0, 1, -1, 0.0, 1, 1, 2.0), (0, 2, 1, 6000.0, 3, 4, 0.0),
        (0, 3, -1, 0.0, 3, 3, 3.0), (0, 4, -1, 0.0, 4, 4, 5.0),
        (1, 0, 2, 0.0, 1, 2, 0.0), (1, 1, -1, 0.0, 1, 1, 1.0), (1, 2, -1, 0.0, 2, 2, 4.0),
    ]
    names = ["tree", "node", "feature", "threshold", "low", "high", "path"]
    forest = IsolationForest(pd.DataFrame(nodes, columns=names), 8, -0.5)
    rows = event_reports(spark, root).where("velocity IS NOT NULL AND baro_altitude IS NOT NULL")
    scored = forest.score(rows.select("event_id", "delivery", *SIGNALS))
    return rounded(scored.select("event_id", "delivery", "anomaly_score"), "anomaly_score")
