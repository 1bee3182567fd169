"""The registered queries in plain SQL, for a check by another engine."""

from __future__ import annotations

REPORTS = """
WITH src AS (
  SELECT event_id, 0 AS delivery, user_id, ts AS t0, ts AS ingestion_time, value FROM events
  UNION ALL
  SELECT event_id, 1, user_id, ts, ts + INTERVAL '1' HOUR, value + 1 FROM events WHERE event_id % 10 = 0
),
reports AS (
  SELECT event_id, delivery,
    lpad(CAST(user_id AS varchar), 6, '0') AS icao24,
    CASE WHEN event_id % 29 = 0 THEN NULL
         ELSE concat('NATION_', CAST(user_id % 25 AS varchar)) END AS origin_country,
    CASE WHEN event_id % 17 = 0 THEN NULL
         ELSE CAST((event_id * 37) % 20000 AS double) / 100 - 100 END AS latitude,
    CASE WHEN event_id % 17 = 0 THEN NULL
         ELSE CAST((event_id * 53) % 40000 AS double) / 100 - 200 END AS longitude,
    CASE WHEN event_id % 41 = 0 THEN NULL
         ELSE CAST(date_trunc('second', t0) AS timestamp) END AS time_position,
    CAST(date_trunc('second', t0) AS timestamp) + INTERVAL '1' SECOND AS last_contact,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE value - 20 END AS velocity,
    CAST((event_id * 7) % 400 AS double) / 10 - 20 AS vertical_rate,
    CAST((event_id * 13) % 360 AS double) AS true_track,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST((event_id * 101) % 12000 AS double) END AS baro_altitude,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST((event_id * 101) % 12000 AS double) + 50 END AS geo_altitude,
    event_id % 5 = 0 AS on_ground,
    ingestion_time
  FROM src
)"""

CLEANED = (
    REPORTS
    + """,
latest AS (
  SELECT *, row_number() OVER (PARTITION BY icao24, time_position
                               ORDER BY ingestion_time DESC, event_id) AS rn
  FROM reports
),
silver AS (
  SELECT icao24, coalesce(origin_country, 'UNKNOWN') AS origin_country, latitude, longitude,
    time_position, last_contact, velocity,
    CASE WHEN velocity >= 0 THEN velocity END AS velocity_validated,
    vertical_rate, true_track, baro_altitude, geo_altitude, on_ground, ingestion_time,
    CASE WHEN latitude BETWEEN -90 AND 90 THEN 1 ELSE 0 END AS lat_valid,
    CASE WHEN longitude BETWEEN -180 AND 180 THEN 1 ELSE 0 END AS lon_valid,
    CASE WHEN NOT on_ground AND latitude IS NOT NULL AND longitude IS NOT NULL
         THEN 1 ELSE 0 END AS airborne_position_valid
  FROM latest WHERE rn = 1
)"""
)

AGGREGATIONS = (
    CLEANED
    + """,
aggregations AS (
  SELECT date_trunc('hour', time_position) AS window_start, origin_country,
    count(DISTINCT icao24) AS unique_flights,
    count(*) AS total_flights,
    avg(velocity_validated) AS avg_velocity,
    median(velocity_validated) AS median_velocity,
    max(velocity_validated) AS max_velocity,
    CAST(sum(CASE WHEN on_ground THEN 1 ELSE 0 END) AS bigint) AS on_ground_count,
    CAST(sum(CASE WHEN NOT on_ground THEN 1 ELSE 0 END) AS bigint) AS airborne_count,
    avg(baro_altitude) AS avg_baro_altitude,
    avg(geo_altitude) AS avg_geo_altitude,
    avg(lat_valid * lon_valid) * 100 AS position_validity_pct,
    CAST(sum(airborne_position_valid) AS bigint) AS valid_airborne_positions
  FROM silver WHERE time_position IS NOT NULL
  GROUP BY 1, 2
)"""
)

DAILY = (
    AGGREGATIONS
    + """,
per_day AS (
  SELECT date_trunc('day', window_start) AS date, origin_country,
    CAST(sum(total_flights) AS bigint) AS daily_flights,
    avg(avg_velocity) AS daily_avg_velocity,
    CAST(sum(airborne_count) AS bigint) AS daily_airborne,
    CAST(sum(on_ground_count) AS bigint) AS daily_on_ground
  FROM aggregations GROUP BY 1, 2
),
daily AS (
  SELECT *,
    CAST(daily_on_ground AS double) / nullif(daily_flights, 0) AS on_ground_ratio,
    avg(daily_flights) OVER (PARTITION BY origin_country ORDER BY date
                             ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS flights_7day_avg,
    daily_flights - lag(daily_flights) OVER (PARTITION BY origin_country ORDER BY date) AS dod_change
  FROM per_day
)"""
)

PLACED = """time_position IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
  AND lat_valid = 1 AND lon_valid = 1"""

HEATMAP = (
    CLEANED
    + f""",
heatmap AS (
  SELECT date_trunc('hour', time_position) AS window_start,
    round(latitude, 0) + 0.0 AS latitude_bin, round(longitude, 0) + 0.0 AS longitude_bin,
    count(DISTINCT icao24) AS unique_flights, count(*) AS total_positions,
    avg(velocity_validated) AS avg_velocity, avg(baro_altitude) AS avg_baro_altitude,
    CAST(sum(CASE WHEN NOT on_ground THEN 1 ELSE 0 END) AS bigint) AS airborne_positions
  FROM silver WHERE {PLACED}
  GROUP BY 1, 2, 3
)"""
)

ALTITUDES = (
    CLEANED
    + """,
altitudes AS (
  SELECT date_trunc('hour', time_position) AS window_start, origin_country,
    CAST(floor(baro_altitude / 1000) * 1000 AS double) AS altitude_bin,
    count(*) AS total_positions, count(DISTINCT icao24) AS unique_flights
  FROM silver WHERE time_position IS NOT NULL AND baro_altitude IS NOT NULL
  GROUP BY 1, 2, 3
)"""
)

ANOMALIES_BODY = """,
stats AS (
  SELECT date_trunc('hour', time_position) AS window_start, icao24, origin_country, time_position,
    velocity_validated,
    avg(velocity_validated) OVER (PARTITION BY date_trunc('hour', time_position)) AS hourly_mean_velocity,
    stddev_samp(velocity_validated) OVER (PARTITION BY date_trunc('hour', time_position)) AS hourly_stddev_velocity
  FROM silver WHERE time_position IS NOT NULL AND velocity_validated IS NOT NULL
),
anomalies AS (
  SELECT *, abs(velocity_validated - hourly_mean_velocity) / nullif(hourly_stddev_velocity, 0) AS z_score,
    coalesce(abs(velocity_validated - hourly_mean_velocity) > 2 * hourly_stddev_velocity, FALSE) AS is_anomaly
  FROM stats
)"""
ANOMALIES = CLEANED + ANOMALIES_BODY

BUSIEST_BODY = """,
slots AS (
  SELECT time_bucket(INTERVAL '30 minutes', time_position) AS window_start, origin_country,
    count(DISTINCT icao24) AS unique_flights, count(*) AS total_flights
  FROM silver WHERE time_position IS NOT NULL GROUP BY 1, 2
),
busiest AS (
  SELECT window_start,
    CAST(rank() OVER w AS integer) AS rank, CAST(dense_rank() OVER w AS integer) AS dense_rank,
    origin_country, unique_flights, total_flights
  FROM slots WINDOW w AS (PARTITION BY window_start ORDER BY total_flights DESC)
)"""
BUSIEST = CLEANED + BUSIEST_BODY

HOURLY_TOTALS = (
    REPORTS
    + """,
totals AS (
  SELECT delivery, date_trunc('hour', ingestion_time) AS window_start, origin_country,
    count(icao24) AS total_flights, avg(velocity) AS avg_velocity,
    CAST(sum(CASE WHEN on_ground THEN 1 ELSE 0 END) AS bigint) AS on_ground_sum
  FROM reports GROUP BY 1, 2, 3
)"""
)


def _predictions(per_delivery: bool = False) -> str:
    extra = "delivery, " if per_delivery else ""
    return (
        REPORTS
        + f""",
per_day AS (
  SELECT *, date_trunc('day', time_position) AS window_start,
    row_number() OVER (PARTITION BY {extra}icao24, date_trunc('day', time_position)
                       ORDER BY time_position DESC, ingestion_time DESC, event_id) AS rn
  FROM reports WHERE time_position IS NOT NULL
),
predictions AS (
  SELECT {extra}icao24, origin_country, velocity, baro_altitude, on_ground,
    true_track < 90 AS predicted_on_ground, true_track * 0.0025::double AS onground_probability,
    vertical_rate / 100 AS anomaly_score, vertical_rate < -15 AS is_anomaly, window_start
  FROM per_day WHERE rn = 1
)"""
    )


PREDICTIONS = _predictions()
PREDICTION_COLUMNS = """icao24, origin_country, velocity, baro_altitude, predicted_on_ground,
  onground_probability, anomaly_score, is_anomaly, window_start"""


def r6(expression: str, name: str | None = None) -> str:
    """Rounded to six digits the way the registered queries do it."""
    return f"round({expression} + 1e-9, 6) AS {name or expression}"


def latest(table: str) -> str:
    return f"window_start = (SELECT max(window_start) FROM {table})"


DAILY_COLUMNS = f"""date, origin_country, daily_flights, {r6('daily_avg_velocity')},
  {r6('flights_7day_avg')}, dod_change, {r6('on_ground_ratio')}"""

UPSERT_TOTALS = (
    HOURLY_TOTALS
    + f""",
old AS (SELECT * FROM totals WHERE delivery = 0),
new AS (SELECT * FROM totals WHERE delivery = 1)
SELECT o.window_start, o.origin_country,
  CASE WHEN n.delivery IS NULL THEN o.total_flights ELSE n.total_flights END AS total_flights,
  {r6('CASE WHEN n.delivery IS NULL THEN o.avg_velocity ELSE n.avg_velocity END', 'avg_velocity')},
  CASE WHEN n.delivery IS NULL THEN o.on_ground_sum ELSE n.on_ground_sum END AS on_ground_sum
FROM old o LEFT JOIN new n ON o.window_start = n.window_start AND o.origin_country = n.origin_country
UNION ALL
SELECT window_start, origin_country, total_flights, {r6('avg_velocity')}, on_ground_sum FROM new n
WHERE NOT EXISTS (SELECT 1 FROM old o
                  WHERE o.window_start = n.window_start AND o.origin_country = n.origin_country)"""
)

UPSERT_TOTALS_BODY = (
    HOURLY_TOTALS
    + """,
merged AS (
  SELECT * EXCLUDE (last) FROM (
    SELECT *, max(delivery) OVER (PARTITION BY window_start, origin_country) AS last FROM totals
    WHERE origin_country IS NOT NULL) x
  WHERE delivery = last
  UNION ALL SELECT * FROM totals WHERE origin_country IS NULL
)"""
)

UPSERTED_PREDICTIONS = (
    _predictions(per_delivery=True)
    + """,
old AS (SELECT * FROM predictions WHERE delivery = 0),
new AS (SELECT * FROM predictions WHERE delivery = 1),
merged AS (
  SELECT o.icao24, o.origin_country,
    CASE WHEN n.delivery IS NULL THEN o.velocity ELSE n.velocity END AS velocity,
    CASE WHEN n.delivery IS NULL THEN o.baro_altitude ELSE n.baro_altitude END AS baro_altitude,
    coalesce(n.predicted_on_ground, o.predicted_on_ground) AS predicted_on_ground,
    coalesce(n.onground_probability, o.onground_probability) AS onground_probability,
    coalesce(n.anomaly_score, o.anomaly_score) AS anomaly_score,
    coalesce(n.is_anomaly, o.is_anomaly) AS is_anomaly, o.window_start
  FROM old o LEFT JOIN new n USING (icao24, window_start)
  UNION ALL
  SELECT icao24, origin_country, velocity, baro_altitude, predicted_on_ground,
    onground_probability, anomaly_score, is_anomaly, window_start
  FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o
                               WHERE o.icao24 = n.icao24 AND o.window_start = n.window_start)
)"""
)

EPOCHS = """CAST(epoch(time_position) AS bigint) AS time_position,
  CAST(epoch(last_contact) AS bigint) AS last_contact"""

SILVER_FILE = f"""icao24, origin_country, latitude, longitude, {EPOCHS}, velocity, vertical_rate,
  true_track, baro_altitude, on_ground, geo_altitude"""

PLACED_VALID = "latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND time_position IS NOT NULL"

FLAGGED = REPORTS.replace("reports AS (", "every AS (") + """,
reports AS (SELECT * FROM every WHERE event_id % 19 <> 0)"""

KEEPS_RULES = """coalesce(latitude BETWEEN -90 AND 90, true) AND coalesce(longitude BETWEEN -180 AND 180, true)
  AND coalesce(velocity >= 0, true) AND (latitude IS NULL OR longitude IS NULL OR time_position IS NOT NULL)"""

FILLED = """
  coalesce(velocity, (SELECT median(velocity) FROM reports)) AS velocity,
  coalesce(baro_altitude, 0.0) AS baro_altitude, coalesce(vertical_rate, 0.0) AS vertical_rate,
  coalesce(true_track, 180.0) AS true_track"""

BUCKETS = """
  round_even(coalesce(latitude, 0.0) / 10, 0) * 10 + 0.0 AS lat_bucket,
  round_even(coalesce(longitude, 0.0) / 10, 0) * 10 + 0.0 AS lon_bucket"""

ENCODER = """,
encoder AS (
  SELECT country, row_number() OVER (ORDER BY country) - 1 AS code
  FROM (SELECT DISTINCT coalesce(origin_country, 'Unknown') AS country FROM reports)
)"""

DENSITY_LATEST = (
    HEATMAP
    + f""" SELECT latitude_bin, longitude_bin, CAST(sum(unique_flights) AS bigint) AS flights,
      CAST(sum(total_positions) AS bigint) AS positions
    FROM heatmap WHERE {latest('heatmap')} GROUP BY 1, 2"""
)

ANOMALIES_LATEST = (
    ANOMALIES
    + f""" SELECT window_start, origin_country, count(*) AS total_samples,
      count(*) FILTER (is_anomaly) AS anomaly_count, {r6('avg(z_score)', 'avg_z_score')}
    FROM anomalies WHERE {latest('anomalies')} GROUP BY 1, 2
    ORDER BY anomaly_count DESC, origin_country LIMIT 20"""
)

ORACLES: dict[str, str] = {
    "dedupe_latest": CLEANED
    + """ SELECT event_id, delivery, icao24, time_position, ingestion_time, velocity
    FROM latest WHERE rn = 1""",
    "clean_silver": CLEANED + " SELECT * FROM silver",
    "flatten_states": REPORTS + f" SELECT {SILVER_FILE} FROM reports",
    "flatten_states_legacy": REPORTS
    + """ SELECT icao24, origin_country, latitude, longitude, time_position, last_contact,
      baro_altitude AS velocity, true_track AS vertical_rate, velocity AS true_track,
      CAST(NULL AS double) AS baro_altitude, on_ground, CAST(0 AS double) AS geo_altitude
    FROM reports""",
    "calendar_features": REPORTS
    + """ SELECT event_id, delivery, time_position,
      CAST(year(time_position) AS integer) AS year, CAST(month(time_position) AS integer) AS month,
      CAST(day(time_position) AS integer) AS day, CAST(hour(time_position) AS integer) AS hour,
      CAST(isodow(time_position) - 1 AS integer) AS weekday_numeric,
      isodow(time_position) > 5 AS is_weekend,
      CAST(hour(time_position) > 8 AND hour(time_position) < 22 AS integer) AS is_peak_hour
    FROM reports""",
    "quality_report": CLEANED
    + """ SELECT count(*) AS row_count,
      count(*) FILTER (icao24 IS NULL) AS null_icao24,
      count(*) FILTER (latitude IS NULL) AS null_latitude,
      count(*) FILTER (longitude IS NULL) AS null_longitude,
      count(*) FILTER (on_ground AND latitude IS NULL) AS null_position_ground,
      count(*) FILTER (NOT on_ground AND latitude IS NULL) AS null_position_airborne
    FROM silver""",
    "quality_violations": REPORTS
    + """ SELECT rule, severity, violations FROM (
      SELECT 'icao24 is present' AS rule, 'error' AS severity, count(*) FILTER (icao24 IS NULL) AS violations FROM reports
      UNION ALL SELECT 'icao24 is not blank', 'error', count(*) FILTER (trim(icao24) = '') FROM reports
      UNION ALL SELECT 'latitude within [-90, 90]', 'error',
        count(*) FILTER (latitude < -90 OR latitude > 90) FROM reports
      UNION ALL SELECT 'longitude within [-180, 180]', 'error',
        count(*) FILTER (longitude < -180 OR longitude > 180) FROM reports
      UNION ALL SELECT 'velocity is not negative', 'error', count(*) FILTER (velocity < 0) FROM reports
      UNION ALL SELECT 'on_ground is present', 'error', count(*) FILTER (on_ground IS NULL) FROM reports
      UNION ALL SELECT 'at least one row', 'error', CASE WHEN count(*) < 1 THEN 1 ELSE 0 END FROM reports
      UNION ALL SELECT 'a position has a time', 'error',
        count(*) FILTER (latitude IS NOT NULL AND longitude IS NOT NULL AND time_position IS NULL) FROM reports
      UNION ALL SELECT 'an airborne row has a position', 'warning',
        count(*) FILTER (NOT on_ground AND (latitude IS NULL OR longitude IS NULL)) FROM reports
    ) WHERE violations > 0""",
    "retention_filter": REPORTS
    + """ SELECT event_id, delivery, ingestion_time FROM reports
    WHERE ingestion_time >= TIMESTAMP '2024-01-24 00:00:00'""",
    "country_totals": REPORTS
    + f""" SELECT origin_country, count(icao24) AS total_flights, {r6('avg(velocity)', 'avg_velocity')},
      CAST(sum(CASE WHEN on_ground THEN 1 ELSE 0 END) AS bigint) AS on_ground
    FROM reports WHERE origin_country IS NOT NULL GROUP BY origin_country""",
    "flight_aggregations": AGGREGATIONS
    + f""" SELECT window_start, origin_country, unique_flights, total_flights, {r6('avg_velocity')},
      {r6('median_velocity')}, max_velocity, on_ground_count, airborne_count, {r6('avg_baro_altitude')},
      {r6('avg_geo_altitude')}, {r6('position_validity_pct')}, valid_airborne_positions
    FROM aggregations""",
    "aircraft_activity": CLEANED
    + f""" SELECT icao24, origin_country, min(time_position) AS first_seen, max(time_position) AS last_seen,
      count(*) AS position_count, {r6('avg(velocity_validated)', 'avg_velocity')},
      max(velocity_validated) AS max_velocity, {r6('avg(baro_altitude)', 'avg_altitude')},
      CAST(sum(CASE WHEN on_ground THEN 1 ELSE 0 END) AS bigint) AS ground_time_samples,
      CAST(sum(CASE WHEN NOT on_ground THEN 1 ELSE 0 END) AS bigint) AS airborne_time_samples
    FROM silver WHERE time_position IS NOT NULL GROUP BY 1, 2""",
    "altitude_distribution": ALTITUDES + " SELECT * FROM altitudes",
    "density_heatmap": HEATMAP
    + f""" SELECT window_start, latitude_bin, longitude_bin, unique_flights, total_positions,
      {r6('avg_velocity')}, {r6('avg_baro_altitude')}, airborne_positions FROM heatmap""",
    "country_daily_summary": DAILY
    + f""" SELECT {DAILY_COLUMNS}, daily_airborne, daily_on_ground FROM daily""",
    "flight_trajectories": CLEANED
    + f""",
    linked AS (
      SELECT *, lag(time_position) OVER w AS start_time, lag(latitude) OVER w AS start_latitude,
        lag(longitude) OVER w AS start_longitude
      FROM silver WHERE {PLACED}
      WINDOW w AS (PARTITION BY icao24 ORDER BY time_position)
    )
    SELECT date_trunc('hour', time_position) AS window_start, icao24, origin_country, start_time,
      time_position AS end_time, start_latitude, start_longitude, latitude AS end_latitude,
      longitude AS end_longitude, baro_altitude, velocity_validated, true_track, on_ground,
      date_diff('second', start_time, time_position) AS time_delta_seconds,
      coalesce(date_diff('second', start_time, time_position) > 3600, TRUE) AS is_new_segment
    FROM linked""",
    "speed_anomalies": ANOMALIES
    + f""" SELECT window_start, icao24, origin_country, time_position, velocity_validated,
      {r6('hourly_mean_velocity')}, {r6('hourly_stddev_velocity')}, {r6('z_score')}, is_anomaly
    FROM anomalies""",
    "top_busiest_countries": BUSIEST + " SELECT * FROM busiest",
    "busiest_countries_latest": BUSIEST
    + f""" SELECT window_start, rank, origin_country, unique_flights, total_flights FROM busiest
    WHERE {latest('busiest')} ORDER BY rank, origin_country LIMIT 20""",
    "velocity_trend": AGGREGATIONS
    + f""" SELECT window_start, {r6('avg(avg_velocity)', 'global_avg_velocity')}
    FROM aggregations GROUP BY window_start""",
    "density_latest": DENSITY_LATEST,
    "stored_density_latest": DENSITY_LATEST,
    "anomalies_by_country": ANOMALIES_LATEST,
    "stored_anomalies_by_country": ANOMALIES_LATEST,
    "daily_summary_500": DAILY
    + f" SELECT {DAILY_COLUMNS} FROM daily ORDER BY date DESC, origin_country LIMIT 500",
    "daily_summary_countries": DAILY
    + f""" SELECT {DAILY_COLUMNS} FROM
      (SELECT * FROM daily ORDER BY date DESC, origin_country LIMIT 500)
    WHERE origin_country IN ('NATION_1', 'NATION_2', 'UNKNOWN')""",
    "available_countries": DAILY
    + """ SELECT origin_country, row_number() OVER (ORDER BY origin_country) <= 5 AS is_default
    FROM (SELECT DISTINCT origin_country FROM
      (SELECT * FROM daily ORDER BY date DESC, origin_country LIMIT 500)
      WHERE origin_country IS NOT NULL)""",
    "altitude_latest": ALTITUDES
    + f""" SELECT origin_country, altitude_bin, CAST(sum(unique_flights) AS bigint) AS unique_flights
    FROM altitudes WHERE {latest('altitudes')} GROUP BY 1, 2""",
    "altitude_top_countries": ALTITUDES
    + f""",
    current AS (
      SELECT origin_country, altitude_bin, CAST(sum(unique_flights) AS bigint) AS unique_flights
      FROM altitudes WHERE {latest('altitudes')} GROUP BY 1, 2
    )
    SELECT * FROM current WHERE origin_country IN (
      SELECT origin_country FROM current GROUP BY origin_country
      ORDER BY sum(unique_flights) DESC, origin_country LIMIT 5)""",
    "kpi_snapshot": AGGREGATIONS
    + ANOMALIES_BODY
    + BUSIEST_BODY
    + f""",
    top20 AS (SELECT * FROM busiest WHERE {latest('busiest')} ORDER BY rank, origin_country LIMIT 20),
    flagged AS (
      SELECT origin_country, count(*) FILTER (is_anomaly) AS anomaly_count
      FROM anomalies WHERE {latest('anomalies')} GROUP BY 1
      ORDER BY anomaly_count DESC, origin_country LIMIT 20
    ),
    trend AS (
      SELECT window_start, avg(avg_velocity) AS v, row_number() OVER (ORDER BY window_start DESC) AS nth
      FROM aggregations GROUP BY window_start
    )
    SELECT (SELECT count(DISTINCT origin_country) FROM top20) AS countries_tracked,
      (SELECT CAST(sum(unique_flights) AS bigint) FROM top20) AS unique_flights,
      {r6('(SELECT v FROM trend WHERE nth = 1)', 'latest_velocity')},
      round_even((SELECT v FROM trend WHERE nth = 1) - (SELECT v FROM trend WHERE nth = 2), 1) AS velocity_delta,
      (SELECT CAST(sum(anomaly_count) AS bigint) FROM flagged) AS speed_anomalies""",
    "ml_predictions_latest": PREDICTIONS
    + f" SELECT {PREDICTION_COLUMNS} FROM predictions WHERE {latest('predictions')}",
    "ml_country_summary": PREDICTIONS
    + f""" SELECT origin_country, count(*) AS total_flights, count(*) FILTER (is_anomaly) AS anomaly_count,
      count(*) FILTER (predicted_on_ground) AS predicted_on_ground_count,
      {r6('avg(onground_probability)', 'avg_onground_prob')}, {r6('avg(anomaly_score)', 'avg_anomaly_score')}
    FROM predictions WHERE {latest('predictions')} GROUP BY origin_country
    ORDER BY anomaly_count DESC, origin_country NULLS FIRST LIMIT 25""",
    "kpi_ml": PREDICTIONS
    + f""" SELECT count(*) AS flights_scored, count(*) FILTER (is_anomaly) AS anomalies,
      {r6('count(*) FILTER (is_anomaly) / nullif(CAST(count(*) AS double), 0) * 100', 'anomaly_pct')},
      count(*) FILTER (predicted_on_ground) AS predicted_on_ground,
      {r6('avg(onground_probability)', 'avg_onground_prob')}
    FROM predictions WHERE {latest('predictions')}""",
    "top_anomalous_flights": PREDICTIONS
    + f""" SELECT icao24, origin_country, velocity, baro_altitude, predicted_on_ground,
      onground_probability, anomaly_score
    FROM predictions WHERE {latest('predictions')} AND is_anomaly
    ORDER BY anomaly_score, icao24 LIMIT 20""",
    "sample_n": PREDICTIONS
    + f""" SELECT {PREDICTION_COLUMNS}, on_ground FROM predictions
    ORDER BY md5(concat_ws('|', '42', icao24, strftime(window_start, '%Y-%m-%d %H:%M:%S'))), icao24, window_start
    LIMIT 2000""",
    "upsert_country_totals": UPSERT_TOTALS,
    "stored_country_totals": UPSERT_TOTALS,
    "snapshot_rollback": HOURLY_TOTALS
    + f""" SELECT window_start, origin_country, total_flights, {r6('avg_velocity')}, on_ground_sum
    FROM totals WHERE delivery = 0""",
    "upsert_predictions": UPSERTED_PREDICTIONS + " SELECT * FROM merged",
    "stored_predictions": UPSERTED_PREDICTIONS
    + f" SELECT {PREDICTION_COLUMNS} FROM merged WHERE {latest('merged')}",
    "silver_batches": REPORTS
    + f""" SELECT CASE delivery WHEN 0 THEN 'first' ELSE 'second' END AS ingestion_batch, {SILVER_FILE}
    FROM reports""",
    "retained_batches": REPORTS
    + """ SELECT strftime(ingestion_time, '%Y%m%d') AS ingestion_batch, count(*) AS rows
    FROM reports WHERE ingestion_time >= TIMESTAMP '2024-01-24 12:00:00' GROUP BY 1""",
    "stream_ingest": REPORTS
    + f""" SELECT icao24, origin_country, CASE WHEN {PLACED_VALID} THEN latitude END AS latitude,
      CASE WHEN {PLACED_VALID} THEN longitude END AS longitude, {EPOCHS},
      CASE WHEN velocity >= 0 THEN velocity END AS velocity, vertical_rate, true_track,
      baro_altitude, on_ground, geo_altitude
    FROM reports""",
    "stream_totals": REPORTS
    + f""", documents AS (
      SELECT event_id // 500 AS document,
        floor(max(epoch(date_trunc('second', ingestion_time))) / 86400) * 86400 AS seen FROM reports GROUP BY 1)
    SELECT TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST(seen AS bigint)) AS window_start, origin_country,
      count(*) AS total_flights, {r6('avg(CASE WHEN velocity >= 0 THEN velocity END)', 'avg_velocity')},
      CAST(sum(CASE WHEN on_ground THEN 1 ELSE 0 END) AS bigint) AS on_ground_sum
    FROM reports JOIN documents ON document = event_id // 500 WHERE origin_country IS NOT NULL GROUP BY 1, 2""",
    "corrected_batch": REPORTS
    + f""", chosen AS (
      SELECT *, event_id % 2 AS batch FROM reports
      WHERE event_id % 2 = 1 OR (origin_country NOT IN ('NATION_1', 'NATION_2') AND event_id % 3 <> 0)),
    documents AS (
      SELECT batch, event_id // 500 AS document,
        floor(max(epoch(date_trunc('second', ingestion_time))) / 86400) * 86400 AS seen FROM chosen GROUP BY 1, 2)
    SELECT TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST(seen AS bigint)) AS window_start, origin_country,
      count(*) AS total_flights, {r6('avg(CASE WHEN velocity >= 0 THEN velocity END)', 'avg_velocity')},
      CAST(sum(CASE WHEN on_ground THEN 1 ELSE 0 END) AS bigint) AS on_ground_sum
    FROM chosen c JOIN documents d ON document = event_id // 500 AND d.batch = c.batch
    WHERE origin_country IS NOT NULL GROUP BY 1, 2""",
    "quarantined_stream": REPORTS
    + f""", made AS (
      SELECT icao24, origin_country, CASE WHEN {PLACED_VALID} THEN latitude END AS latitude,
        CASE WHEN {PLACED_VALID} THEN longitude END AS longitude, {EPOCHS},
        CASE WHEN velocity >= 0 THEN velocity END AS velocity, vertical_rate, true_track,
        baro_altitude, on_ground, geo_altitude, (event_id // 500) % 3 AS batch,
        {KEEPS_RULES} AS is_valid
      FROM reports)
    SELECT * EXCLUDE (batch, is_valid) FROM made WHERE batch <> 1 OR is_valid""",
    "released_bronze": REPORTS
    + f""" SELECT icao24, count(*) AS reports,
      count(CASE WHEN event_id % 3 = 2 OR {PLACED_VALID} THEN latitude END) AS placed,
      min(CASE WHEN velocity >= 0 THEN velocity END) AS slowest
    FROM reports WHERE delivery = 0 AND (event_id % 3 = 0 OR (event_id % 3 = 2 AND {KEEPS_RULES})) GROUP BY 1""",
    "late_reports": REPORTS
    + f""", points AS (SELECT DISTINCT icao24, time_position FROM reports WHERE delivery = 0 AND {PLACED_VALID}),
    linked AS (
      SELECT icao24, lag(time_position) OVER (PARTITION BY icao24 ORDER BY time_position) AS start_time,
        time_position AS end_time FROM points)
    SELECT *, date_diff('second', start_time, end_time) AS time_delta_seconds,
      coalesce(date_diff('second', start_time, end_time) > 3600, true) AS is_new_segment
    FROM linked""",
    "late_activity": REPORTS
    + f""", points AS (
      SELECT DISTINCT icao24, time_position FROM reports WHERE delivery = 0 AND event_id % 3 <> 1 AND {PLACED_VALID})
    SELECT icao24, min(time_position) AS first_seen, max(time_position) AS last_seen, count(*) AS positions
    FROM points GROUP BY 1""",
    "versioned_totals": UPSERT_TOTALS_BODY
    + f""" SELECT moment, window_start, origin_country, total_flights, {r6('avg_velocity')}, on_ground_sum
    FROM (
      SELECT 'begun' AS moment, * FROM totals WHERE delivery = 0
      UNION ALL SELECT 'restored', * FROM totals WHERE delivery = 0
      UNION ALL SELECT 'loaded', * FROM merged) x""",
    "flight_sessions": REPORTS
    + """, marked AS (
      SELECT *, CASE WHEN date_diff('second', lag(time_position) OVER w, time_position) <= 3600 THEN 0 ELSE 1 END AS begins
      FROM reports WHERE time_position IS NOT NULL WINDOW w AS (PARTITION BY icao24 ORDER BY time_position)),
    numbered AS (
      SELECT *, sum(begins) OVER (PARTITION BY icao24 ORDER BY time_position RANGE UNBOUNDED PRECEDING) AS session FROM marked)
    SELECT icao24, min(time_position) AS first_seen, max(time_position) AS last_seen, count(*) AS reports,
      max(velocity) AS max_velocity
    FROM numbered GROUP BY icao24, session""",
    "watermarked_totals": REPORTS
    + f""", timed AS (
      SELECT *, event_id % 7 = 0 AS late, date_trunc('hour', time_position) AS window_start
      FROM reports WHERE delivery = 0 AND time_position IS NOT NULL),
    marks AS (
      SELECT max(CASE WHEN NOT late THEN time_position END) - INTERVAL '2' DAY AS before_late,
        max(time_position) - INTERVAL '2' DAY AS at_end FROM timed)
    SELECT window_start, origin_country, count(*) AS total_flights, count(velocity) AS known_velocities,
      {r6('avg(velocity)', 'avg_velocity')}, CAST(sum(CASE WHEN on_ground THEN 1 ELSE 0 END) AS bigint) AS on_ground
    FROM timed, marks
    WHERE (NOT late OR window_start + INTERVAL '1' HOUR > before_late) AND window_start + INTERVAL '1' HOUR <= at_end
    GROUP BY 1, 2""",
    "gated_silver": REPORTS
    + """ SELECT icao24, count(*) AS reports, min(time_position) AS first_seen, max(time_position) AS last_seen
    FROM (SELECT DISTINCT icao24, time_position FROM reports WHERE delivery = 0) x GROUP BY 1""",
    "silver_folder": REPORTS
    + f""", states AS (
      SELECT icao24, origin_country, latitude, longitude, {EPOCHS}, velocity, vertical_rate, true_track,
        baro_altitude, on_ground, geo_altitude FROM reports)
    SELECT * REPLACE (CASE WHEN last_contact % 3 < 2 THEN vertical_rate END AS vertical_rate,
      CASE WHEN last_contact % 3 < 2 THEN true_track END AS true_track) FROM states""",
    "score_batch": CLEANED
    + """ SELECT icao24, origin_country, velocity, baro_altitude, on_ground,
      '2024-01-31T00:00:00+00:00' AS window_start, true AS probability_in_range,
      true AS class_follows_probability, true AS anomaly_follows_score, true AS one_in_twenty_is_odd
    FROM silver""",
    "onground_report": CLEANED
    + """ SELECT CASE WHEN on_ground THEN 'on_ground' ELSE 'airborne' END AS class,
      CAST(floor(count(*) * 0.2 + 0.5) AS bigint) AS support, true AS proper_shares
    FROM silver GROUP BY 1""",
    "planted_report": CLEANED
    + """ SELECT CASE WHEN baro_altitude < 3000 AND velocity < 60 THEN 'on_ground' ELSE 'airborne' END AS class,
      CAST(floor(count(*) * 0.2 + 0.5) AS bigint) AS support,
      true AS high_precision, true AS high_recall, true AS high_f1
    FROM silver WHERE velocity IS NOT NULL AND baro_altitude IS NOT NULL GROUP BY 1""",
    "planted_importances": """ SELECT feature, feature IN ('velocity', 'baro_altitude') AS weighs
    FROM (VALUES ('velocity'), ('baro_altitude'), ('vertical_rate'), ('true_track'), ('lat_bucket'),
      ('lon_bucket'), ('country_encoded')) t(feature)""",
    "stratified_split": REPORTS
    + """, numbered AS (
      SELECT event_id, delivery, origin_country, count(*) OVER (PARTITION BY origin_country) AS total,
        row_number() OVER (PARTITION BY origin_country ORDER BY substr(md5(concat_ws('|', '42',
          CAST(event_id AS varchar), CAST(delivery AS varchar))), 1, 15)) AS nth
      FROM reports)
    SELECT event_id, delivery, origin_country,
      CASE WHEN nth <= floor(total * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS side
    FROM numbered""",
    "exact_percentiles": REPORTS
    + """, chosen AS (
      SELECT on_ground, CASE WHEN event_id % 1000 = 0 THEN velocity * 1e12 ELSE 200 + velocity * 1e-9 END AS v FROM reports)
    SELECT on_ground, round(quantile_cont(v, 0.05), 12) AS value, CAST(0.05 AS double) AS q FROM chosen GROUP BY 1
    UNION ALL SELECT on_ground, round(quantile_cont(v, 0.5), 12), 0.5 FROM chosen GROUP BY 1
    UNION ALL SELECT on_ground, round(quantile_cont(v, 0.95), 12), 0.95 FROM chosen GROUP BY 1""",
    "feature_importances": """ SELECT feature, true AS proper_share, true AS sum_is_one
    FROM (VALUES ('velocity'), ('baro_altitude'), ('vertical_rate'), ('true_track'), ('lat_bucket'),
      ('lon_bucket'), ('country_encoded')) t(feature)""",
    "forest_scores": REPORTS
    + f""", paths AS (
      SELECT event_id, delivery,
        (CASE WHEN velocity <= 120 THEN 2.0 WHEN baro_altitude <= 6000 THEN 3.0 ELSE 5.0 END
         + CASE WHEN vertical_rate <= 0 THEN 1.0 ELSE 4.0 END) / 2 AS path,
        2 * (ln(7.0) + 0.5772156649015329) - 2 * 7.0 / 8.0 AS usual
      FROM reports WHERE velocity IS NOT NULL AND baro_altitude IS NOT NULL)
    SELECT event_id, delivery, {r6('0.5 - pow(2.0, -path / usual)', 'anomaly_score')} FROM paths""",
    "impute_features": REPORTS + f" SELECT event_id, delivery, {FILLED} FROM reports",
    "grid_buckets": REPORTS + f" SELECT event_id, delivery, {BUCKETS} FROM reports",
    "country_encoding": REPORTS
    + ENCODER
    + """ SELECT event_id, delivery, origin_country, CAST(code AS double) AS country_encoded
    FROM reports JOIN encoder ON country = coalesce(origin_country, 'Unknown')""",
    "feature_matrix": REPORTS
    + ENCODER
    + f""" SELECT event_id, delivery, {FILLED}, {BUCKETS}, CAST(code AS double) AS country_encoded,
      CAST(on_ground AS double) AS label
    FROM reports JOIN encoder ON country = coalesce(origin_country, 'Unknown')""",
    "class_weights": REPORTS
    + f""", sizes AS (
      SELECT CAST(on_ground AS double) AS label, count(*) AS support FROM reports GROUP BY 1)
    SELECT label, support,
      {r6('(SELECT sum(support) FROM sizes) / ((SELECT count(*) FROM sizes) * CAST(support AS double))', 'weight')}
    FROM sizes""",
    "train_test_split": REPORTS
    + """ SELECT event_id, delivery, on_ground,
      CASE WHEN CAST(concat('0x', substr(md5(concat_ws('|', '42', CAST(event_id AS varchar),
             CAST(delivery AS varchar))), 1, 8)) AS bigint) / 4294967296.0 < 0.2
           THEN 'test' ELSE 'train' END AS side
    FROM reports""",
    "classification_report": PREDICTIONS
    + f""", classes AS (
      SELECT c.class, count(*) FILTER (on_ground = c.flag) AS of_class,
        count(*) FILTER (predicted_on_ground = c.flag) AS guessed,
        count(*) FILTER (on_ground = c.flag AND predicted_on_ground = c.flag) AS hits
      FROM predictions, (VALUES ('airborne', FALSE), ('on_ground', TRUE)) AS c(class, flag)
      GROUP BY c.class
    )
    SELECT class, {r6('coalesce(hits / nullif(CAST(guessed AS double), 0), 0.0)', 'precision')},
      {r6('coalesce(hits / nullif(CAST(of_class AS double), 0), 0.0)', 'recall')},
      {r6('coalesce(2.0 * hits / nullif(CAST(of_class + guessed AS double), 0), 0.0)', 'f1')},
      of_class AS support
    FROM classes""",
}

ORACLES["landed_batch"] = f"""WITH silver AS ({ORACLES["stream_ingest"]})
SELECT 'landed' AS part, * FROM silver UNION ALL SELECT 'silver', * FROM silver"""
ORACLES["silver_file"] = ORACLES["flatten_states"]
ORACLES["prediction_files"] = PREDICTIONS + f" SELECT {PREDICTION_COLUMNS} FROM predictions"
ORACLES["flagged_features"] = ORACLES["feature_matrix"].replace(REPORTS, FLAGGED)

ORACLES["report_averages"] = f"""WITH report AS ({ORACLES["classification_report"]}),
means AS (
  SELECT sum(recall * support) / sum(support) AS accuracy, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
    sum(precision * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr,
    sum(f1 * support) / sum(support) AS wf, CAST(sum(support) AS bigint) AS support
  FROM report
),
named AS (
  SELECT 'accuracy' AS class, accuracy AS p, accuracy AS r, accuracy AS f, support FROM means
  UNION ALL SELECT 'macro avg', mp, mr, mf, support FROM means
  UNION ALL SELECT 'weighted avg', wp, wr, wf, support FROM means
)
SELECT class, {r6('p', 'precision')}, {r6('r', 'recall')}, {r6('f', 'f1')}, support FROM named"""
