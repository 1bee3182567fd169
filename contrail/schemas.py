"""Row shapes, and the fixed values that results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# Slots of a raw state vector, in the order of the public API.
STATE_SLOTS = [
    "icao24",
    "callsign",
    "origin_country",
    "time_position",
    "last_contact",
    "longitude",
    "latitude",
    "baro_altitude",
    "on_ground",
    "velocity",
    "true_track",
    "vertical_rate",
    "sensors",
    "geo_altitude",
    "squawk",
    "spi",
    "position_source",
    "category",
]

# Which slot feeds which silver column. "api" follows the slot
# list above; "legacy_sql" keeps the other numbering found in older SQL views,
# so that their output can be reproduced.
LAYOUTS = {
    "api": {name: i for i, name in enumerate(STATE_SLOTS)},
    "legacy_sql": {
        "icao24": 0,
        "callsign": 1,
        "origin_country": 2,
        "time_position": 3,
        "last_contact": 4,
        "longitude": 5,
        "latitude": 6,
        "velocity": 7,
        "on_ground": 8,
        "true_track": 9,
        "vertical_rate": 10,
        "sensors": 11,
        "baro_altitude": 12,
        "squawk": 13,
        "spi": 14,
        "position_source": 15,
        "geo_altitude": 16,
    },
}

PAYLOAD = T.StructType(
    [
        T.StructField("time", T.LongType()),
        T.StructField("states", T.ArrayType(T.ArrayType(T.StringType()))),
    ]
)

BRONZE = T.StructType(
    [
        T.StructField("ingestion_time", T.TimestampNTZType()),
        T.StructField("raw_data", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("ingestion_batch", T.StringType()),
    ]
)

SILVER = T.StructType(
    [
        T.StructField("icao24", T.StringType()),
        T.StructField("origin_country", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("time_position", T.LongType()),
        T.StructField("last_contact", T.LongType()),
        T.StructField("velocity", T.DoubleType()),
        T.StructField("vertical_rate", T.DoubleType()),
        T.StructField("true_track", T.DoubleType()),
        T.StructField("baro_altitude", T.DoubleType()),
        T.StructField("on_ground", T.BooleanType()),
        T.StructField("geo_altitude", T.DoubleType()),
    ]
)
SILVER_DOUBLES = [f.name for f in SILVER if isinstance(f.dataType, T.DoubleType)]
SILVER_LONGS = [f.name for f in SILVER if isinstance(f.dataType, T.LongType)]

PREDICTIONS = T.StructType(
    [
        T.StructField("icao24", T.StringType()),
        T.StructField("origin_country", T.StringType()),
        T.StructField("velocity", T.DoubleType()),
        T.StructField("baro_altitude", T.DoubleType()),
        T.StructField("on_ground", T.BooleanType()),
        T.StructField("predicted_on_ground", T.BooleanType()),
        T.StructField("onground_probability", T.DoubleType()),
        T.StructField("anomaly_score", T.DoubleType()),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("window_start", T.StringType()),
    ]
)

# Columns of the loaded predictions table; load_time is stamped on load.
PREDICTION_TABLE = [
    "icao24",
    "origin_country",
    "velocity",
    "baro_altitude",
    "predicted_on_ground",
    "onground_probability",
    "anomaly_score",
    "is_anomaly",
    "window_start",
    "load_time",
]

# upserts' key columns and the columns a match overwrites.
COUNTRY_TOTALS_KEYS = ["window_start", "origin_country"]
COUNTRY_TOTALS_UPDATES = ["total_flights", "avg_velocity", "on_ground_sum", "load_time"]
PREDICTION_KEYS = ["icao24", "window_start"]
PREDICTION_UPDATES = [
    "predicted_on_ground",
    "onground_probability",
    "anomaly_score",
    "is_anomaly",
    "velocity",
    "baro_altitude",
    "load_time",
]
