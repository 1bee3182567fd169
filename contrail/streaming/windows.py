"""Totals per time window and sessions per aircraft, over stored reports and over streams of them.

The same functions serve both. On a stream, state is kept only for windows and
sessions that may still change: the watermark trails the newest report by a
delay, what it has passed is given out and forgotten, and reports that come
later still are refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from contrail.functions.columns import NTZ
from contrail.session import prepare
from contrail.sources import versions

#: How far behind the newest report one may come and still count.
DELAY = "2 hours"
#: A longer silence ends a session.
GAP_SECONDS = 3600


def windowed_totals(reports: DataFrame, width: str = "1 hour", delay: str = DELAY, ts: str = "time_position") -> DataFrame:
    """Reports, known velocities and their mean, and reports on the ground, per window and country.

    Reports without a time are left out; those without a country count under NULL.
    """
    timed = _watermarked(reports.where(F.col(ts).isNotNull()), ts, delay)
    totals = timed.groupBy(F.window(ts, width).alias("w"), "origin_country").agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.count("velocity").alias("known_velocities"),
        F.avg("velocity").alias("avg_velocity"),
        F.count_if("on_ground").alias("on_ground"),
    )
    return totals.select(F.col("w.start").cast(NTZ).alias("window_start"), *totals.columns[1:])


def flight_sessions(reports: DataFrame, gap_seconds: int = GAP_SECONDS, delay: str = DELAY, ts: str = "time_position") -> DataFrame:
    """Sessions of each aircraft: reports that follow each other by no more than the gap, over midnight too.

    Reports without a time or an aircraft are left out. Spark merges sessions in
    each map task before the shuffle if
    `spark.sql.sessionWindow.merge.sessions.in.local.partition` is on, as it is in
    sessions that `build_session` makes, so one busy aircraft sends few rows.
    """
    timed = _watermarked(reports.where(F.col(ts).isNotNull() & F.col("icao24").isNotNull()), ts, delay)
    sessions = timed.groupBy("icao24", F.session_window(ts, f"{gap_seconds} seconds").alias("w")).agg(
        F.count(F.lit(1)).alias("reports"), F.max(ts).alias("last_seen"), F.max("velocity").alias("max_velocity")
    )
    times = [F.col("w.start").cast(NTZ).alias("first_seen"), F.col("last_seen").cast(NTZ).alias("last_seen")]
    return sessions.select("icao24", *times, "reports", "max_velocity")


def _watermarked(reports: DataFrame, ts: str, delay: str) -> DataFrame:
    """A watermark needs a time with a zone; sessions of this package are pinned to UTC."""
    return reports.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def stream_reports(spark: SparkSession, path: str, like: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of reports as they arrive in a folder, with the columns of `like`."""
    reader = prepare(spark).readStream.schema(like.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def store_closed(results: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Add every window or session to a table once it can no longer change.

    A micro-batch that comes again after a failure replaces its own rows. Without
    `every` all files present are processed and the query stops; what is still
    open waits in the checkpoint for the next run.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        name = f"stream-{batch_id:08d}"
        versions.write(batch.withColumn("ingestion_batch", F.lit(name)), path, "ingestion_batch", replace=[name])

    writer = results.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(store)
    return writer.trigger(**({"processingTime": every} if every else {"availableNow": True})).start()
