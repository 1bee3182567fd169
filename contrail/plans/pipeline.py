"""Batch flow: land, type, check, aggregate, load; and the refresh of gold."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta, timezone
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.columns import event_time
from contrail.operators import gold
from contrail.operators.quality import QualityError, enforce, quality_gate, quality_report, silver_rules, valid_rows, validate
from contrail.operators.silver import bronze_view, clean_silver, to_silver, with_event_times
from contrail.schemas import COUNTRY_TOTALS_KEYS, COUNTRY_TOTALS_UPDATES, PREDICTION_KEYS, PREDICTION_UPDATES
from contrail.session import SkipBatch, discard, prepare, settle
from contrail.sources import versions
from contrail.sources.files import read_bronze_json
from contrail.sources.tables import (
    append_bronze,
    append_silver,
    drop_batch,
    land_bronze,
    materialize,
    on_days,
    prepare_predictions,
    read_table,
    rename_for_load,
    replace_windows,
    rollback,
    snapshot,
    stamp,
    upsert_table,
    utc_now,
)

# Gold models whose rows depend on the reports of their own window only.
RECENT_MODELS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "gold_flight_aggregations": gold.gold_flight_aggregations,
    "gold_altitude_distribution": gold.gold_altitude_distribution,
    "gold_flight_density_heatmap": gold.gold_flight_density_heatmap,
    "gold_speed_anomalies": gold.gold_speed_anomalies,
    "gold_top_busiest_countries": gold.gold_top_busiest_countries,
}

#: Models that are built at a time: each leaves cores free while it is planned, published, or ends on few tasks.
AT_ONCE = 4


def side_by_side(steps: Mapping[str, Callable[[], Any]]) -> dict[str, Any]:
    """Results of steps that do not need each other; the first error is raised once all have ended."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        begun = {name: pool.submit(step) for name, step in steps.items()}
    return {name: step.result() for name, step in begun.items()}


def load_country_totals(
    silver: DataFrame, root: str, window_start: datetime, now: datetime | None = None
) -> int:
    """Upsert a batch's country totals under its window; returns rows touched."""
    totals = rename_for_load(gold.gold_country_totals(silver), {"on_ground": "on_ground_sum"})
    batch = totals.withColumn("window_start", F.lit(window_start).cast("timestamp_ntz"))
    return upsert_table(batch, root, "gold_flight_agg", COUNTRY_TOTALS_KEYS, COUNTRY_TOTALS_UPDATES, now)


SHARES = "gold_flight_agg_shares"


def load_shares(silver: DataFrame, root: str, batch: str) -> None:
    """Store what a batch adds to the totals, in place of what an earlier run of it added."""
    shares = gold.country_shares(silver, ["window_start"]).withColumn("ingestion_batch", F.lit(batch))
    versions.write(shares, f"{root}/{SHARES}", "ingestion_batch", {"window_start": F.col("window_start")}, [batch])


def refresh_totals(spark: SparkSession, root: str, now: datetime | None = None) -> int:
    """Bring the totals up to date with the stored shares; returns the rows written.

    The windows of all shares that came or went since the last time are added up
    anew, from the batches that have shares in them, and replace what was stored
    for them: a country that is gone leaves no row, and a run that was broken off
    is made up for by the next. Silver is not read.
    """
    path = f"{root}/{SHARES}"
    newest, done = versions.current(spark, path), versions.tagged_or_none(spark, path, "in-totals")
    if newest is None:
        return 0
    moved = [part.select("window_start").distinct() for part in versions.difference(spark, path, done, newest)]
    rows = 0
    if moved:
        windows = settle(reduce(lambda a, b: a.unionByName(b), moved).distinct(), "windows")
        low, high = (str(x) for x in windows.agg(F.min(F.col("window_start").cast("string")), F.max(F.col("window_start").cast("string"))).first())
        shares = versions.read(spark, path, newest, lambda _, part: part.meets("window_start", low, high))
        totals = gold.totals_of_shares(shares.join(windows, "window_start", "left_semi"), ["window_start"])
        totals = rename_for_load(totals, {"on_ground": "on_ground_sum"})
        rows = replace_windows(totals, root, "gold_flight_agg", windows, now)
        discard(windows)
    versions.move_tag(spark, path, "in-totals", newest)
    return rows


def load_predictions(predictions: DataFrame, root: str, now: datetime | None = None) -> int:
    """Upsert a batch of predictions; returns rows touched."""
    return upsert_table(
        prepare_predictions(predictions), root, "gold_ml_predictions", PREDICTION_KEYS, PREDICTION_UPDATES, now
    )


def process_documents(
    documents: DataFrame,
    root: str,
    batch: str,
    window_start: datetime | None = None,
    now: datetime | None = None,
    min_row_count: int = 1,
) -> dict[str, int]:
    """Take raw documents through bronze, the quality gate, silver and the load.

    Each step is keyed by the batch, so running a batch again changes nothing,
    and a corrected run takes back what the earlier one added. Documents without
    states raise `SkipBatch` before anything is written. A batch that breaks a
    rule raises `QualityError`: it stays in bronze and is noted in the quarantine,
    from where `release_batch` lets it on; an earlier run of it in silver is left
    alone. Rows count for the half hour of their document's own time, or of `now`
    if it gives none, or for `window_start` if that is given.
    """
    spark = documents.sparkSession
    checked = settle(_checked(documents, window_start, now), "checked")
    report = quality_report(checked).first()
    if not report.row_count:
        discard(checked)
        raise SkipBatch(f"batch {batch} has no states")
    bronze_rows = append_bronze(documents, root, batch, now)
    try:
        enforce(validate(checked))
        quality_gate(report, min_row_count)
    except QualityError as refusal:
        quarantine_batch(validate(checked), root, batch, report.row_count, str(refusal), now)
        discard(checked)
        raise
    loaded = _load_checked(checked, root, batch, now)
    settle_quarantine(spark, root, batch, "replaced", now)
    discard(checked)
    return {"bronze_rows": bronze_rows, **loaded}


def _checked(documents: DataFrame, window_start: datetime | None, now: datetime | None) -> DataFrame:
    if window_start is None:
        window = F.coalesce("window_start", F.lit(half_hour(now or utc_now())).cast("timestamp_ntz"))
    else:
        window = F.lit(window_start).cast("timestamp_ntz")
    return to_silver(documents, window="window_start").withColumn("window_start", window)


def _load_checked(checked: DataFrame, root: str, batch: str, now: datetime | None) -> dict[str, int]:
    silver_rows = append_silver(checked, root, batch, now)
    load_shares(checked, root, batch)
    return {"silver_rows": silver_rows, "gold_rows": refresh_totals(checked.sparkSession, root, now)}


# Refused batches ----------------------------------------------------------------

QUARANTINE = "quarantined_batches"


def quarantine_batch(
    broken: DataFrame, root: str, batch: str, rows: int, reason: str, now: datetime | None = None
) -> None:
    """Note a refused batch with the rules it broke; its documents are in bronze."""
    noted = broken.withColumns(
        {
            "row_count": F.lit(rows).cast("bigint"),
            "reason": F.lit(reason),
            "status": F.lit("refused"),
            "resolved_at": F.lit(None).cast("timestamp_ntz"),
            "ingestion_batch": F.lit(batch),
        }
    )
    if broken.isEmpty():  # the gate refused it for its size
        whole = broken.sparkSession.range(1).select(
            F.lit("the gate").alias("rule"), F.lit("error").alias("severity"), F.lit(1).cast("bigint").alias("violations")
        )
        quarantine_batch(whole, root, batch, rows, reason, now)
        return
    versions.write(stamp(noted, now, "refused_at"), f"{root}/{QUARANTINE}", "ingestion_batch", {"status": F.col("status")}, [batch])


def batches_with_status(spark: SparkSession, root: str, *status: str) -> list[str]:
    """Batches in the quarantine whose status is one of these, told by the stored ranges."""
    version = versions.current(spark, f"{root}/{QUARANTINE}")
    return [b for b, part in version.parts.items() if part.ranges["status"][0] in status] if version else []


def settle_quarantine(spark: SparkSession, root: str, batch: str, status: str, now: datetime | None = None) -> None:
    """Note what became of a refused batch; one that was never refused is no error."""
    if not batches_with_status(spark, root, "refused") or batch not in batches_with_status(spark, root, "refused"):
        return
    noted = read_table(spark, root, QUARANTINE, [batch]).withColumns(
        {"status": F.lit(status), "resolved_at": F.lit(now or utc_now()).cast("timestamp_ntz")}
    )
    versions.write(noted, f"{root}/{QUARANTINE}", "ingestion_batch", {"status": F.col("status")}, [batch])


def release_batch(
    spark: SparkSession,
    root: str,
    batch: str,
    rows: str = "valid",
    window_start: datetime | None = None,
    now: datetime | None = None,
) -> dict[str, int]:
    """Let a refused batch on: its `valid` rows, or `all` of them as they are.

    It goes on from the documents in bronze as any other batch does, and counts
    from then on in silver, in the totals and on the bronze path.
    """
    if rows not in ("valid", "all"):
        raise ValueError(f"unknown choice of rows: {rows}")
    if batch not in batches_with_status(spark, root, "refused"):
        raise ValueError(f"batch {batch} is not held back")
    checked = _checked(read_table(spark, root, "bronze_flights", [batch]).drop("ingestion_time", "ingestion_batch"), window_start, now)
    checked = settle(valid_rows(checked) if rows == "valid" else checked, "released")
    loaded = _load_checked(checked, root, batch, now)
    settle_quarantine(spark, root, batch, f"released {rows}", now)
    discard(checked)
    return loaded


def gated_bronze(spark: SparkSession, root: str, layout: str = "legacy_sql") -> DataFrame:
    """The SQL view of the raw documents, without what the gate holds back.

    Refused batches are not read; of those whose valid rows were released, the
    others are left out.
    """
    held = set(batches_with_status(spark, root, "refused"))
    partly = batches_with_status(spark, root, "released valid")
    bronze = versions.read(prepare(spark), f"{root}/bronze_flights", keep=lambda batch, _: batch not in held)
    view = bronze_view(bronze, layout)
    if not partly:
        return view
    rules = [r for r in silver_rules() if r.columns != ("on_ground",)]  # silver reads a missing flag as airborne
    some = F.col("ingestion_batch").isin(partly)
    return view.where(~some).unionByName(valid_rows(view.where(some), rules))


def half_hour(moment: datetime) -> datetime:
    return moment - timedelta(
        minutes=moment.minute % 30, seconds=moment.second, microseconds=moment.microsecond
    )


def run_batch(
    spark: SparkSession,
    path: str,
    root: str,
    batch: str,
    window_start: datetime | None = None,
    now: datetime | None = None,
    snapshot_as: str | None = None,
) -> dict[str, int]:
    """Land the raw files at `path`, name a snapshot of the loaded tables, and process the documents.

    Every load has its snapshot of `gold_flight_agg` and `silver_flights`, called
    `snapshot_as` or after the batch and the time; it costs one small file a table.
    """
    documents = read_bronze_json(spark, path)
    if to_silver(documents).isEmpty():
        raise SkipBatch(f"batch {batch} has no states")
    land_bronze(documents, root, batch)
    name = snapshot_as or f"before_{batch}_{utc_now():%Y%m%d_%H%M%S_%f}"
    snapshot(spark, root, [t for t in LOADED if versions.is_versioned(spark, f"{root}/{t}")], name)
    return process_documents(documents, root, batch, window_start, now)


#: The tables that a load changes, and that a snapshot of it names.
LOADED = ("gold_flight_agg", "silver_flights", SHARES)


def undo_load(spark: SparkSession, root: str, snapshot_id: str) -> None:
    """Put all loaded tables back to a snapshot, whatever was loaded since; nothing is copied."""
    rollback(spark, root, snapshot_id, [t for t in LOADED if versions.tagged_or_none(spark, f"{root}/{t}", snapshot_id)])
    shares = versions.current(spark, f"{root}/{SHARES}")
    versions.move_tag(spark, f"{root}/{SHARES}", "in-totals", shares)


def undo_batch(spark: SparkSession, root: str, batch: str, snapshot_id: str | None = None, now: datetime | None = None) -> None:
    """Take one batch out of silver and out of the totals; its documents stay in bronze.

    The totals lose its shares only, so what came later stays; a snapshot, if
    named, is put back first, so that rows keep its load times.
    """
    if snapshot_id:
        rollback(spark, root, snapshot_id, ["gold_flight_agg"])
    drop_batch(spark, root, "silver_flights", batch)
    drop_batch(spark, root, SHARES, batch)
    refresh_totals(spark, root, now)


def refresh_models(
    spark: SparkSession,
    root: str,
    source: str = "silver",
    layout: str = "legacy_sql",
    now: datetime | None = None,
    since: date | None = None,
) -> dict[str, DataFrame]:
    """Rebuild cleaned silver and the gold tables in dependency order.

    `source="silver"` reads the typed batches; `"bronze"` reads the raw
    documents that the gate let through, by way of the SQL view. Cleaned silver is written once and read by
    the seven models on it, so its shuffle is not repeated.

    With `since`, only the dates from that day on are rebuilt: a report repeated
    later carries the same position time, so earlier dates cannot change unless
    reports that old arrive. Rows without a position time, which no gold model
    reads, and the lifetime figures per aircraft need the full rebuild of their
    table; the latter is always done, from pre-aggregated rows.
    """
    if source == "silver":
        batches = read_table(spark, root, "silver_flights")
        if since is not None:
            midnight = datetime(since.year, since.month, since.day, tzinfo=timezone.utc)
            batches = batches.where(F.col("time_position") >= int(midnight.timestamp()))
        view = with_event_times(batches)
    else:
        view = gated_bronze(spark, root, layout)
        materialize(view, root, "bronze_flights_raw", kind="view")
        if since is not None:
            view = view.where(F.col("time_position") >= F.lit(since))
    cleaned = materialize(clean_silver(view), root, "silver_flights_cleaned", now=now, since=since)
    built = {"silver_flights_cleaned": cleaned}
    recent = cleaned if since is None else cleaned.where(F.col("window_date") >= F.lit(since))

    def build(name: str, model: Callable[[], DataFrame], since: date | None = since) -> Callable[[], DataFrame]:
        return lambda: materialize(model(), root, name, now=now, since=since)

    steps = {name: build(name, lambda model=model: model(recent)) for name, model in RECENT_MODELS.items()}
    links, activity = "gold_flight_trajectories", "gold_aircraft_activity"
    steps[links] = build(links, lambda: gold.gold_flight_trajectories(cleaned, since=since))
    steps[activity] = build(activity, lambda: gold.gold_aircraft_activity(cleaned), None)
    built |= side_by_side(steps)
    daily = gold.gold_country_daily_summary(built["gold_flight_aggregations"])
    built["gold_country_daily_summary"] = materialize(
        daily, root, "gold_country_daily_summary", now=now, since=since
    )
    return built


def refresh_arrived(spark: SparkSession, root: str, now: datetime | None = None) -> dict[str, DataFrame]:
    """Refresh cleaned silver and gold for the dates of which reports came or went since the last refresh.

    The version of silver that the last refresh read is kept by name. What differs
    between it and the newest one, corrected and undone batches included, tells the
    dates; of silver only the batches that hold rows of these dates are read, of
    the dated tables only those dates. Links also change on the next day of every
    aircraft whose last point of a day changed; stored last points tell which days
    that are, and stand in for all earlier days. Lifetime figures are added up from
    stored days. The first refresh is a full one.
    """
    path = f"{root}/silver_flights"
    newest, done = versions.current(prepare(spark), path), versions.tagged_or_none(spark, path, "in-models")
    if newest is None:
        raise FileNotFoundError(f"no table silver_flights in {root}")
    if done is None:
        built = refresh_models(spark, root, now=now)
        cleaned, states = built["silver_flights_cleaned"], {"aircraft_days": gold.aircraft_days, "aircraft_last_points": gold.closing_points}
        side_by_side({name: lambda name=name, state=state: materialize(state(cleaned), root, name, now=now) for name, state in states.items()})
    else:
        moved = [part.select(_report_day()).distinct() for part in versions.difference(spark, path, done, newest)]
        days = _days(reduce(lambda a, b: a.unionByName(b), moved)) if moved else []
        if days:
            _refresh_days(spark, root, newest, days, now)
        names = ["silver_flights_cleaned", *RECENT_MODELS, "gold_flight_trajectories", "gold_aircraft_activity", "gold_country_daily_summary"]
        built = {name: read_table(spark, root, name) for name in names}
    versions.move_tag(spark, path, "in-models", newest)
    return built


def _report_day() -> Column:
    return F.to_date(event_time(F.col("time_position"))).alias("day")


def _days(frame: DataFrame) -> list[str]:
    """The distinct dates of a one-column frame, as keys of partitions; one for each day at most."""
    return sorted(r[0].isoformat() if r[0] else versions.NULL for r in frame.distinct().collect())


def _refresh_days(spark: SparkSession, root: str, silver: versions.Version, days: list[str], now: datetime | None) -> None:
    dated = [d for d in days if d != versions.NULL]

    def holds(_: str, part: versions.Part) -> bool:
        return any(part.meets("day", d, d) for d in dated) or (versions.NULL in days and part.lacks("day"))

    reports = versions.read(spark, f"{root}/silver_flights", silver, holds)
    reports = with_event_times(reports.where(on_days(_report_day(), days)))
    materialize(clean_silver(reports), root, "silver_flights_cleaned", now=now, days=days)
    if not dated:
        return
    recent = read_table(spark, root, "silver_flights_cleaned", dated)
    steps = {
        name: lambda name=name, model=model: materialize(model(recent), root, name, now=now, days=dated)
        for name, model in RECENT_MODELS.items()
    }
    steps["gold_flight_trajectories"] = lambda: _refresh_links(spark, root, recent, dated, now)
    steps["gold_aircraft_activity"] = lambda: _refresh_activity(spark, root, recent, dated, now)
    side_by_side(steps)
    _refresh_daily_summary(spark, root, dated, now)


def _refresh_links(spark: SparkSession, root: str, recent: DataFrame, dated: list[str], now: datetime | None) -> None:
    following = _new_last_points(spark, root, recent, dated, now)
    linked = sorted({*dated, *following})
    points = read_table(spark, root, "aircraft_last_points").where(F.col("window_date") <= F.lit(date.fromisoformat(linked[-1])))
    active = read_table(spark, root, "silver_flights_cleaned", linked)
    points = points.join(active.select("icao24").distinct(), "icao24", "left_semi").drop("window_date", "load_time")
    links = gold.gold_flight_trajectories(active, closing=points)
    materialize(links, root, "gold_flight_trajectories", now=now, days=linked)


def _refresh_activity(spark: SparkSession, root: str, recent: DataFrame, dated: list[str], now: datetime | None) -> None:
    materialize(gold.aircraft_days(recent), root, "aircraft_days", now=now, days=dated)
    activity = gold.activity_of_days(read_table(spark, root, "aircraft_days"))
    materialize(activity, root, "gold_aircraft_activity", now=now)


def _new_last_points(spark: SparkSession, root: str, recent: DataFrame, days: list[str], now: datetime | None) -> list[str]:
    """Store the last points of these days; returns the later days on which a link starts from one that changed."""
    name, figures = "aircraft_last_points", ["icao24", "_day", "time_position", "latitude", "longitude"]
    before = read_table(spark, root, name, days).select(*figures)
    materialize(gold.closing_points(recent), root, name, now=now, days=days)
    after = read_table(spark, root, name, days).select(*figures)
    other = before.exceptAll(after).unionByName(after.exceptAll(before)).select("icao24", F.col("_day").alias("of")).distinct()
    later = read_table(spark, root, name).where(F.col("window_date") > F.lit(date.fromisoformat(days[0]))).select("icao24", "_day")
    following = later.join(other, "icao24").where("_day > of").groupBy("icao24", "of").agg(F.min("_day").alias("day"))
    return _days(following.select("day"))


def _refresh_daily_summary(spark: SparkSession, root: str, days: list[str], now: datetime | None) -> None:
    """Averages over rows reach back and on, so all stored days from the first one change; they are few figures each."""
    name, figures = "gold_country_daily_summary", ["date", "origin_country", "daily_flights", "daily_avg_velocity", "daily_airborne", "daily_on_ground"]
    fresh = gold.daily_figures(read_table(spark, root, "gold_flight_aggregations", days))
    stored = versions.current(spark, f"{root}/{name}")
    others = [d for d in stored.parts if d not in days]
    daily = read_table(spark, root, name, others).select(*figures).unionByName(fresh)
    materialize(gold.daily_summary_of(daily), root, name, now=now, days=sorted({*days, *(d for d in others if d >= days[0])}))
