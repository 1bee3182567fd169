"""Incremental runs: a file stream feeds the batch flow, one micro-batch at a time."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from contrail.operators.quality import QualityError
from contrail.plans.pipeline import process_documents
from contrail.session import SkipBatch, prepare
from contrail.sources.tables import utc_now

log = logging.getLogger(__name__)


def stream_documents(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Raw documents of a folder as they arrive, one per file."""
    reader = prepare(spark).readStream.option("wholetext", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).select(
        F.col("value").alias("raw_data"), F.col("_metadata.file_path").alias("source_file")
    )


def ingest_stream(
    documents: DataFrame,
    root: str,
    checkpoint: str,
    every: str | None = None,
    clock=utc_now,
) -> StreamingQuery:
    """Run the batch flow on every micro-batch of the stream.

    Without `every` all files present are processed and the query stops. The
    checkpoint hands each file over once; after a failure the same micro-batch
    comes again under the same id and replaces its own earlier output. Totals
    belong to the half hour that the documents name, so neither the time of
    arrival nor the cut into micro-batches changes them. A micro-batch that the
    gate refuses waits in the quarantine, and the stream goes on.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        now = clock()
        try:
            process_documents(batch, root, f"stream-{batch_id:08d}", now=now)
        except SkipBatch:
            pass
        except QualityError as refusal:
            log.warning("micro-batch %d is held back: %s", batch_id, refusal)

    writer = documents.writeStream.option("checkpointLocation", checkpoint).foreachBatch(process)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
