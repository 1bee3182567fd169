"""Raw payloads to typed rows, and typed rows to cleaned, de-duplicated silver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.columns import event_time, to_bigint, to_boolean, to_double
from contrail.schemas import LAYOUTS, PAYLOAD, SILVER, SILVER_DOUBLES, SILVER_LONGS


def parse_payload(bronze: DataFrame, raw: str = "raw_data", on_bad: str = "raise") -> DataFrame:
    """Parse the JSON document of each row into a `payload` struct.

    Slots of a state vector have mixed types, so all of them are read as text
    and cast later. `on_bad="skip"` turns an unreadable document into NULL.
    """
    mode = {"raise": "FAILFAST", "skip": "PERMISSIVE"}[on_bad]
    return bronze.withColumn("payload", F.from_json(raw, PAYLOAD, {"mode": mode}))


def flatten_states(parsed: DataFrame) -> DataFrame:
    """One row per state vector; NULL and empty `states` give no rows.

    A plain explode would have Spark filter on the size of the array first,
    and parse every document once more for it; the outer form does not.
    """
    kept = [c for c in parsed.columns if c not in ("payload", "raw_data")]
    exploded = parsed.select(*kept, F.posexplode_outer("payload.states").alias("_pos", "state"))
    return exploded.where(F.col("_pos").isNotNull()).drop("_pos")


def project_states(flat: DataFrame, layout: str = "api") -> DataFrame:
    """Pick the silver columns out of the positional vector, still as text.

    Vectors shorter than the layout give NULL for the missing slots.
    """
    slots = LAYOUTS[layout]
    kept = [c for c in flat.columns if c != "state"]
    picked = [F.get("state", F.lit(slots[name])).alias(name) for name in SILVER.names]
    return flat.select(*picked, *kept)


def coerce_numeric(df: DataFrame, doubles: Sequence[str], longs: Sequence[str]) -> DataFrame:
    """Cast the named columns that exist; unreadable values become NULL."""
    casts = {c: to_double(F.col(c)) for c in doubles if c in df.columns}
    casts |= {c: to_bigint(F.col(c)) for c in longs if c in df.columns}
    return df.withColumns(casts)


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns that the frame has, in the named order."""
    return df.select(*[c for c in columns if c in df.columns])


def to_silver(
    bronze: DataFrame, layout: str = "api", on_bad: str = "raise", window: str | None = None
) -> DataFrame:
    """Raw documents to typed silver rows, lineage columns kept at the end.

    A missing ground flag counts as airborne; names are trimmed; a missing
    name stays NULL. `window` names a further column with the half hour of the
    time that the document itself gives.
    """
    parsed = parse_payload(bronze, on_bad=on_bad)
    if window:
        parsed = parsed.withColumn(window, event_time(F.floor(F.col("payload.time") / 1800) * 1800))
    rows = project_states(flatten_states(parsed), layout)
    typed = coerce_numeric(rows, SILVER_DOUBLES, SILVER_LONGS)
    return typed.withColumns(
        {
            "icao24": F.trim("icao24"),
            "origin_country": F.trim("origin_country"),
            "on_ground": F.coalesce(to_boolean(F.col("on_ground")), F.lit(False)),
        }
    )


def bronze_view(bronze: DataFrame, layout: str = "legacy_sql", on_bad: str = "raise") -> DataFrame:
    """Raw documents to rows with event times; a missing ground flag stays NULL."""
    rows = project_states(flatten_states(parse_payload(bronze, on_bad=on_bad)), layout)
    typed = coerce_numeric(rows, SILVER_DOUBLES, SILVER_LONGS)
    return typed.withColumns(
        {
            "time_position": event_time(F.col("time_position")),
            "last_contact": event_time(F.col("last_contact")),
            "on_ground": to_boolean(F.col("on_ground")),
        }
    )


def with_event_times(silver: DataFrame) -> DataFrame:
    """Epoch-second columns of file silver to timestamps, as cleaning expects."""
    return silver.withColumns({c: event_time(F.col(c)) for c in SILVER_LONGS})


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key by `order`; NULL keys count as equal.

    Filtering on a row number of 1 lets Spark keep one row per key in every
    map task before the shuffle, so a key with a third of all rows still
    sends only one row per task.
    """
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rn).where("_rn = 1").drop("_rn")


def quality_flags(df: DataFrame) -> DataFrame:
    """0/1 flags for the coordinates; NULL coordinates are not valid."""

    def flag(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    lat, lon = F.col("latitude"), F.col("longitude")
    return df.withColumns(
        {
            "lat_valid": flag(lat.between(-90, 90)),
            "lon_valid": flag(lon.between(-180, 180)),
            "airborne_position_valid": flag(~F.col("on_ground") & lat.isNotNull() & lon.isNotNull()),
        }
    )


# Among equal ingestion times the file name decides, then the content, so that
# a rerun keeps the same row whatever the order of the input.
def latest_first(df: DataFrame, tie: Sequence[str] | None = None) -> list[Column]:
    if tie is None:
        tie = [c for c in ("source_file", *SILVER.names) if c in df.columns]
    return [F.col("ingestion_time").desc(), *[F.col(c).asc() for c in tie]]


CLEAN_COLUMNS = [
    "icao24",
    "origin_country",
    "latitude",
    "longitude",
    "time_position",
    "last_contact",
    "velocity",
    "velocity_validated",
    "vertical_rate",
    "true_track",
    "baro_altitude",
    "geo_altitude",
    "on_ground",
    "ingestion_time",
    "lat_valid",
    "lon_valid",
    "airborne_position_valid",
]


def clean_silver(view: DataFrame, tie: Sequence[str] | None = None) -> DataFrame:
    """Latest delivery per aircraft and time, with defaults and flags."""
    latest = dedupe_latest(view, ["icao24", "time_position"], latest_first(view, tie))
    cleaned = quality_flags(
        latest.withColumns(
            {
                "origin_country": F.coalesce("origin_country", F.lit("UNKNOWN")),
                "velocity_validated": F.when(F.col("velocity") >= 0, F.col("velocity")),
            }
        )
    )
    return cleaned.select(*CLEAN_COLUMNS)
