"""Column expressions; all built from native functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"


def to_double(col: Column) -> Column:
    """Text or number to double; anything unreadable becomes NULL."""
    return col.try_cast("double")


def to_bigint(col: Column) -> Column:
    """Text or number to bigint by way of double: JSON may write 1.7E9."""
    return col.try_cast("double").try_cast("bigint")


def to_boolean(col: Column) -> Column:
    return col.try_cast("boolean")


def event_time(epoch_seconds: Column) -> Column:
    """Epoch seconds to a zone-less UTC timestamp."""
    return F.timestamp_seconds(epoch_seconds).cast(NTZ)


def utc_ntz(iso_text: Column) -> Column:
    """ISO text, with or without an offset, to a zone-less UTC timestamp."""
    return F.try_to_timestamp(iso_text).cast(NTZ)


def hour_start(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast(NTZ)


def day_start(ts: Column) -> Column:
    return F.date_trunc("day", ts).cast(NTZ)


def half_hour_start(ts: Column) -> Column:
    """Start of the 30-minute slot, aligned to the epoch."""
    return F.window(ts, "30 minutes").getField("start")


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Second boundaries crossed between two timestamps."""
    seconds = [F.unix_seconds(F.date_trunc("second", t)) for t in (start, end)]
    return seconds[1] - seconds[0]


def altitude_bin(altitude: Column, width: int = 1000) -> Column:
    """Lower edge of the altitude band, as double."""
    return (F.floor(altitude / width) * width).cast("double")


def grid_cell(degrees: Column) -> Column:
    """Nearest whole degree, halves away from zero."""
    return F.round(degrees, 0)


def feature_cell(degrees: Column, size: int = 10) -> Column:
    """Nearest multiple of `size` degrees, halves to even; NULL counts as 0."""
    return F.bround(F.coalesce(degrees, F.lit(0.0)) / size, 0) * size


def calendar_features(df: DataFrame, ts: str = "time_position") -> DataFrame:
    """Calendar columns of a timestamp; the week starts on Monday = 0."""
    t = F.col(ts)
    return df.withColumns(
        {
            "year": F.year(t),
            "month": F.month(t),
            "day": F.day(t),
            "hour": F.hour(t),
            "weekday_numeric": F.weekday(t),
            "is_weekend": F.weekday(t) > 4,
            "is_peak_hour": ((F.hour(t) > 8) & (F.hour(t) < 22)).cast("int"),
        }
    )
