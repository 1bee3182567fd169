"""Reading tables, splitting words, and moving columns through Arrow batches."""

from __future__ import annotations

import gc
import tempfile
import time
import zipfile
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import discard


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application; clusters need no installed copy."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    home = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="contrail-")) / "contrail.zip"  # read by the driver's file server only
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(home.rglob("*.py")):
            out.write(file, file.relative_to(home.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(spark.sparkContext.applicationId)


def forget(spark: SparkSession) -> None:
    """Have the driver collect garbage, so that Spark deletes shuffle files of frames that are no longer held."""
    for _ in range(2):  # what the first pass lets go of holds the last plan's shuffles
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def discard_all(*frames: DataFrame | None) -> None:
    """Delete the files of those of the frames that were settled; nothing may read them any more."""
    for frame in frames:
        if getattr(frame, "_scratch", None):
            discard(frame)


def texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", null: str | None = "") -> DataFrame:
    """The two columns the operators read, as `doc_id` and `text`; NULL text reads as `null`."""
    ship(docs.sparkSession)
    body = F.col(text) if null is None else F.coalesce(F.col(text), F.lit(null))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"))


def slices(batches: Iterator[pa.RecordBatch], chars: int = 8_000_000) -> Iterator[tuple[list, list]]:
    """Lists of ids and texts, cut so that each holds about `chars` bytes, or one longer text."""
    for batch in batches:
        ids, column = batch.column("doc_id").to_pylist(), batch.column("text")
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.cumsum(sizes) // chars
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(ids)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b:
                yield ids[a:b], column.slice(a, b - a).to_pylist()


def utf8(text: str) -> bytes:
    """UTF-8 of a text. `lower()` and `split()` of bytes know ASCII letters and white space only."""
    return text.encode("utf-8", "surrogatepass")


def numbered(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """All words of some documents as numbers, the first position of each document, and the distinct words."""
    every = list(chain.from_iterable(words))
    number = {w: i for i, w in enumerate(dict.fromkeys(every))}
    flat = np.fromiter(map(number.__getitem__, every), dtype=np.int64, count=len(every))
    bounds = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum([len(ws) for ws in words], out=bounds[1:])
    return flat, bounds, list(number)


def fmix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of unsigned 64-bit numbers (two multiply and shift rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
