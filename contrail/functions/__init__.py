from contrail.functions.columns import (  # noqa: F401
    altitude_bin,
    calendar_features,
    day_start,
    elapsed_seconds,
    event_time,
    feature_cell,
    grid_cell,
    half_hour_start,
    hour_start,
    to_bigint,
    to_boolean,
    to_double,
    utc_ntz,
)
