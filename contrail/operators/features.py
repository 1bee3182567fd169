"""Model features from silver rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.columns import feature_cell
from contrail.operators.ordinal import sorted_positions
from contrail.operators.quantiles import exact_quantile
from contrail.session import settle

# Feature order, and what stands in for a missing measurement.
# A missing velocity takes the median instead.
FEATURES = [
    "velocity",
    "baro_altitude",
    "vertical_rate",
    "true_track",
    "lat_bucket",
    "lon_bucket",
    "country_encoded",
]
FILL = {"baro_altitude": 0.0, "vertical_rate": 0.0, "true_track": 180.0}
UNKNOWN = "Unknown"
META = ["icao24", "origin_country", "velocity", "baro_altitude", "on_ground"]


def velocity_median(df: DataFrame) -> DataFrame:
    """Exact median velocity, as a one-row frame."""
    return exact_quantile(df, "velocity", 0.5, name="median")


def impute(df: DataFrame, median: float | None = None) -> DataFrame:
    """Fill missing measurements.

    The velocity median is that of `df` itself unless a saved one is given; `df`
    is then read four times. Lazy.
    """
    middle: Column = velocity_median(df).scalar() if median is None else F.lit(float(median))
    fills = {"velocity": F.coalesce(F.col("velocity"), middle)}
    fills |= {c: F.coalesce(F.col(c), F.lit(v)) for c, v in FILL.items()}
    return df.withColumns(fills)


def grid_buckets(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "lat_bucket": feature_cell(F.col("latitude")),
            "lon_bucket": feature_cell(F.col("longitude")),
        }
    )


def _country() -> Column:
    return F.coalesce(F.col("origin_country"), F.lit(UNKNOWN))


def fit_country_encoder(df: DataFrame) -> DataFrame:
    """Codes of the countries in sort order: (origin_country, country_encoded).

    A missing country counts as "Unknown". If no row had that value, its code
    is added after the last one.
    """
    seen = sorted_positions(df.select(_country().alias("origin_country")), "origin_country", "country_encoded")
    extra = seen.agg(
        F.lit(UNKNOWN).alias("origin_country"),
        F.count(F.lit(1)).alias("country_encoded"),
        F.count_if(F.col("origin_country") == UNKNOWN).alias("_seen"),
    ).where("_seen = 0")
    return settle(seen.unionByName(extra.drop("_seen")), "encoder")


def encode_country(df: DataFrame, encoder: DataFrame) -> DataFrame:
    """Add `country_encoded`; countries the encoder has not seen are "Unknown".

    The encoder is a settled frame, so its file size decides whether the join
    broadcasts it.
    """
    unknown = encoder.where(F.col("origin_country") == UNKNOWN).select("country_encoded").scalar()
    codes = encoder.select(
        F.col("origin_country").alias("_country"), F.col("country_encoded").alias("_code")
    )
    return (
        df.withColumn("_country", _country())
        .join(codes, "_country", "left")
        .withColumn("country_encoded", F.coalesce(F.col("_code"), unknown).cast("double"))
        .drop("_country", "_code")
    )


def engineer_features(
    df: DataFrame,
    encoder: DataFrame | None = None,
    median: float | None = None,
    ids: Sequence[str] = ("icao24", "time_position"),
) -> tuple[DataFrame, DataFrame]:
    """Feature rows and the encoder that was used or newly fitted.

    The rows hold `ids`, the features as doubles, `label` (1 = on ground) and
    `meta`, the untouched columns that go with a prediction. Eager: the input is
    written once, so that it is derived once.
    """
    rows = settle(df.na.drop(subset=["on_ground"]), "feature-rows")  # read by the median, the codes and the rows
    if rows.isEmpty():
        raise ValueError("no rows with a ground flag")
    if encoder is None:
        encoder = fit_country_encoder(rows)
    meta = F.struct(*[c for c in META if c in rows.columns])
    built = encode_country(grid_buckets(impute(rows.withColumn("meta", meta), median)), encoder)
    matrix = built.select(
        *ids,
        *[F.col(c).cast("double").alias(c) for c in FEATURES],
        F.col("on_ground").cast("double").alias("label"),
        "meta",
    )
    return matrix, encoder
