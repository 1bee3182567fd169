"""Stored tables: landing, appends, refreshes, upserts, snapshots, retention.

A table is a folder `<root>/<name>` with versions (`versions.py`), partitioned by
batch or by date, so each load writes only the partitions it touches, and readers
of an earlier version are not disturbed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.columns import NTZ, event_time, utc_ntz
from contrail.operators.silver import parse_payload
from contrail.operators.upsert import require_unique_keys, upsert
from contrail.schemas import BRONZE, PREDICTION_TABLE, SILVER
from contrail.session import SkipBatch, discard, path_exists, prepare, settle
from contrail.sources import versions

# Table -> (time column that dates its partitions, columns rows are sorted by).
LAYOUT: dict[str, tuple[str | None, list[str]]] = {
    "silver_flights_cleaned": ("time_position", ["ingestion_time", "origin_country"]),
    "gold_flight_agg": ("window_start", ["window_start", "origin_country"]),
    "gold_flight_aggregations": ("window_start", ["window_start", "origin_country"]),
    "gold_aircraft_activity": (None, ["icao24"]),
    "gold_altitude_distribution": ("window_start", ["window_start", "origin_country", "altitude_bin"]),
    "gold_flight_density_heatmap": ("window_start", ["window_start", "latitude_bin", "longitude_bin"]),
    "gold_country_daily_summary": ("date", ["date", "origin_country"]),
    "gold_flight_trajectories": ("window_start", ["window_start", "icao24"]),
    "gold_speed_anomalies": ("window_start", ["window_start", "is_anomaly", "origin_country"]),
    "gold_top_busiest_countries": ("window_start", ["window_start", "rank"]),
    "gold_ml_predictions": ("window_start", ["window_start", "icao24"]),
}
# What refreshes carry from one run to the next: activity and last points per aircraft and day.
STATES: dict[str, tuple[str, list[str]]] = {
    "aircraft_days": ("first_seen", ["icao24"]),
    "aircraft_last_points": ("time_position", ["icao24"]),
}


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _moment(now: datetime | None) -> Column:
    return F.lit(now or utc_now()).cast(NTZ)


def stamp(df: DataFrame, now: datetime | None = None, column: str = "load_time", **constants) -> DataFrame:
    """Add the load time and any constant columns."""
    return df.withColumns({column: _moment(now), **{k: F.lit(v) for k, v in constants.items()}})


def rename_for_load(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def read_table(spark: SparkSession, root: str, name: str, only: Iterable[str] | None = None) -> DataFrame:
    """The newest version of a stored table, or only some of its partition values."""
    values = None if only is None else set(only)
    keep = None if values is None else lambda value, _: value in values
    return versions.read(prepare(spark), f"{root}/{name}", keep=keep)


def read_newest(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The partitions of a dated table that hold its newest moment, chosen by the stored ranges."""
    ts = LAYOUT[name][0]
    version = versions.current(prepare(spark), f"{root}/{name}")
    if version is None:
        raise FileNotFoundError(f"no table {name} in {root}")
    newest = max((p.ranges[ts][1] for p in version.parts.values() if p.ranges[ts][1]), default="")
    return versions.read(spark, f"{root}/{name}", version, lambda _, part: part.meets(ts, newest, newest))


def tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every known table present under `root`."""
    names = ["bronze_flights", "silver_flights", *LAYOUT]
    return {n: read_table(spark, root, n) for n in names if versions.is_versioned(spark, f"{root}/{n}")}


# Raw and silver batches ---------------------------------------------------------


def land_bronze(documents: DataFrame, root: str, batch: str) -> str:
    """Land the raw documents of a batch once; a second call does nothing.

    A batch without any state vector raises `SkipBatch`. The folder counts as
    landed only with its success marker, so an interrupted run is redone.
    """
    spark = documents.sparkSession
    path = f"{root}/landing/ingestion_batch={batch}"
    if path_exists(spark, f"{path}/_SUCCESS"):
        return path
    states = parse_payload(documents).where("payload.states IS NOT NULL")
    if states.isEmpty():
        raise SkipBatch(f"batch {batch} has no states")
    documents.select("raw_data").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    return path


def write_batches(df: DataFrame, path: str, also: Iterable[str] = ()) -> versions.Version:
    """Write the batch partitions in `df`, replacing only earlier runs of those batches and of `also`.

    The ranges of the times in `df` are kept with each batch: readers that ask for
    some days or windows, and the retention, need not open the others.
    """
    ranges = {c: F.col(c) for c in ("ingestion_time", "window_start") if c in df.columns}
    if "time_position" in df.columns:
        seen = F.col("time_position")
        ranges["day"] = F.to_date(event_time(seen) if isinstance(df.schema["time_position"].dataType, T.LongType) else seen)
    return versions.write(df, path, "ingestion_batch", ranges, also)


def _batch_rows(version: versions.Version, batch: str) -> int:
    return version.parts[batch].rows if batch in version.parts else 0


def append_bronze(documents: DataFrame, root: str, batch: str, now: datetime | None = None) -> int:
    """Add the raw documents of a batch with their lineage; returns its rows."""
    rows = stamp(documents, now, "ingestion_time", ingestion_batch=batch).select(*BRONZE.names)
    return _batch_rows(write_batches(rows, f"{root}/bronze_flights", [batch]), batch)


def append_silver(silver: DataFrame, root: str, batch: str, now: datetime | None = None) -> int:
    """Add a silver batch, keeping the known columns and the window it has; returns its rows."""
    stamped = stamp(silver, now, "ingestion_time", ingestion_batch=batch)
    known = ["ingestion_time", *SILVER.names, "window_start", "source_file", "ingestion_batch"]
    rows = stamped.select(*[c for c in known if c in stamped.columns])
    return _batch_rows(write_batches(rows, f"{root}/silver_flights", [batch]), batch)


# Refresh and upsert -------------------------------------------------------------


def _dated(df: DataFrame, ts: str | None) -> tuple[DataFrame, str | None]:
    if ts is None:
        return df, None
    return df.withColumn("window_date", F.to_date(ts)), "window_date"


def _write_dated(df: DataFrame, path: str, ts: str | None, sort: Sequence[str], replace: Iterable[str] | None) -> versions.Version:
    """Write with one date per task where that is small, split where it is not.

    The rebalance hint lets AQE cut a dominant date into several tasks; a
    plain repartition by date would put all of it in one.
    """
    df, day = _dated(df, ts)
    sort = [c for c in sort if c in df.columns]
    if day:
        df = df.hint("rebalance", F.col(day)).sortWithinPartitions(day, *sort)
    elif sort:
        df = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    return versions.write(df, path, day, {ts: F.col(ts)} if ts else {}, replace)


def materialize(
    df: DataFrame,
    root: str,
    name: str,
    kind: str = "table",
    now: datetime | None = None,
    since: date | None = None,
    days: Iterable[str] | None = None,
) -> DataFrame:
    """Publish a model as a view, or as a table.

    A table is written in full; with `since` only its dates from that day on, with
    `days` only those dates (ISO text, or `versions.NULL`). `df` must then hold
    these completely: a date for which it has no rows is emptied.
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind != "table":
        raise ValueError(f"unknown kind of model: {kind}")
    ts, sort = (LAYOUT | STATES)[name]
    stamped, replace = stamp(df, now), None
    if ts and (since is not None or days is not None):
        stored = versions.current(spark, f"{root}/{name}")
        known = list(stored.parts) if stored else []
        replace = [v for v in known if v != versions.NULL and v >= since.isoformat()] if days is None else list(days)
        wanted = F.to_date(ts) >= F.lit(since) if days is None else on_days(F.to_date(ts), replace)
        stamped = stamped.where(wanted)
    _write_dated(stamped, f"{root}/{name}", ts, sort, replace)
    return read_table(spark, root, name)


def on_days(day: Column, days: Sequence[str]) -> Column:
    """Whether a date is one of these keys of partitions."""
    named = [date.fromisoformat(d) for d in days if d != versions.NULL]
    return day.isin(named) | (day.isNull() if versions.NULL in days else F.lit(False))


def upsert_table(
    source: DataFrame,
    root: str,
    name: str,
    keys: Sequence[str],
    update_columns: Sequence[str],
    now: datetime | None = None,
) -> int:
    """Merge a batch into a stored table; returns the rows inserted or updated.

    Only the dates of the batch are read and written. The batch is settled first,
    as it is read several times; the table's own files are never changed.
    """
    spark = source.sparkSession
    ts, sort = LAYOUT[name]
    staged = settle(stamp(source, now), f"stage-{name}")
    days = {r.day: r for r in staged.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("rows")).collect()}
    if None in days:
        raise ValueError(f"{days[None].rows} rows without {ts}")
    if not days:
        return 0
    require_unique_keys(staged, keys)
    merged = staged
    if versions.is_versioned(spark, f"{root}/{name}"):
        touched = read_table(spark, root, name, [d.isoformat() for d in days]).drop("window_date")
        merged = upsert(touched, staged, keys, update_columns, unique=True)
    _write_dated(merged, f"{root}/{name}", ts, sort, ())
    discard(staged)
    return sum(r.rows for r in days.values())


def replace_windows(
    source: DataFrame, root: str, name: str, windows: DataFrame, now: datetime | None = None
) -> int:
    """Put the rows of `source` in place of all stored rows of `windows`; returns the rows of `source`.

    `windows` has one column, the table's time. Windows for which `source` has no
    rows lose theirs; other rows of the same dates stay. `source` must not hold
    rows of other windows.
    """
    spark = source.sparkSession
    ts, sort = LAYOUT[name]
    windows = windows.select(ts).distinct()
    days = [r[0].isoformat() for r in windows.select(F.to_date(ts)).distinct().collect()]  # dates of one load
    staged = settle(stamp(source, now), f"stage-{name}")
    rows = staged.count()
    if versions.is_versioned(spark, f"{root}/{name}"):
        others = read_table(spark, root, name, days).drop("window_date").join(windows, ts, "left_anti")
        merged = others.unionByName(staged, allowMissingColumns=True)
    else:
        merged = staged
    _write_dated(merged, f"{root}/{name}", ts, sort, days)
    discard(staged)
    return rows


def prepare_predictions(predictions: DataFrame) -> DataFrame:
    """Scored rows as the predictions table takes them: UTC window, known columns."""
    if isinstance(predictions.schema["window_start"].dataType, T.StringType):
        predictions = predictions.withColumn("window_start", utc_ntz(F.col("window_start")))
    return predictions.select(*[c for c in PREDICTION_TABLE if c in predictions.columns])


# Snapshots and retention --------------------------------------------------------


def snapshot(
    spark: SparkSession,
    root: str,
    names: Sequence[str] = ("gold_flight_agg", "silver_flights"),
    ts: str | None = None,
) -> str:
    """Name the tables' newest versions by a timestamp, which is returned; nothing is copied."""
    ts = ts or utc_now().strftime("%Y%m%d_%H%M%S")
    for name in names:
        versions.tag(spark, f"{root}/{name}", ts)
    return ts


def rollback(
    spark: SparkSession,
    root: str,
    ts: str,
    names: Sequence[str] = ("gold_flight_agg", "silver_flights"),
) -> None:
    """Put tables back to a snapshot; nothing is copied, the snapshot stays, so this can be repeated."""
    for name in names:
        path = f"{root}/{name}"
        versions.restore(spark, path, versions.tagged(spark, path, ts))


def drop_batch(spark: SparkSession, root: str, name: str, batch: str) -> None:
    """Remove one batch from a batch table; a missing table or batch is no error."""
    versions.drop_parts(spark, f"{root}/{name}", [batch])


def backup(spark: SparkSession, root: str, name: str = "gold_flight_agg") -> str:
    """Replace the rolling backup of a table, a full copy apart from it; returns where its files are."""
    path = f"{root}/{name}_backup"
    partition = versions.current(spark, f"{root}/{name}").partition
    copied = versions.write(read_table(spark, root, name), path, partition, replace=None)
    versions.vacuum(spark, path, utc_now())
    return f"{path}/{next(iter(copied.parts.values())).folder.split('/')[0]}" if copied.parts else path


def apply_retention(
    df: DataFrame, days: int = 7, now: datetime | None = None, ts: str = "ingestion_time"
) -> DataFrame:
    """Rows no older than `days`."""
    return df.where(F.col(ts) >= F.lit((now or utc_now()) - timedelta(days=days)).cast(NTZ))


def retain_table(
    spark: SparkSession, root: str, name: str, days: int = 7, now: datetime | None = None
) -> int:
    """Drop rows older than `days` from a batch table; returns how many.

    The stored ranges tell which batches expired as a whole: these are left out
    of the next version unread. One that expired in part is rewritten. Files go
    once no snapshot names them and a day has passed. A missing table counts as
    empty.
    """
    path = f"{root}/{name}"
    version = versions.current(prepare(spark), path)
    if version is None:
        return 0
    limit = (now or utc_now()) - timedelta(days=days)
    # text of the limit, as the ranges are written: no fraction if it is whole
    text = limit.isoformat(" ").rstrip("0").rstrip(".") if limit.microsecond else limit.isoformat(" ")
    old = {v: p for v, p in version.parts.items() if p.ranges["ingestion_time"][0] is not None and p.ranges["ingestion_time"][0] < text}
    expired = [v for v, p in old.items() if p.ranges["ingestion_time"][1] < text and not p.lacks("ingestion_time")]
    mixed = [v for v in old if v not in expired]
    removed = sum(old[v].rows for v in expired)
    if mixed:
        kept = read_table(spark, root, name, mixed).where(F.col("ingestion_time").isNull() | (F.col("ingestion_time") >= F.lit(limit).cast(NTZ)))
        written = write_batches(kept, path, [*mixed, *expired])
        removed += sum(old[v].rows - _batch_rows(written, v) for v in mixed)
    elif expired:
        versions.drop_parts(spark, path, expired)
    versions.vacuum(spark, path, utc_now() - timedelta(days=1))
    return removed
