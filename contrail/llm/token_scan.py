"""Token counts from flat token files without an index: search for separators, stitch blocks by a prefix scan.

A flat file is nothing but little-endian identifiers; a document ends at each
end-of-document identifier. Blocks of a file are searched on their own, all
identifiers of a block at once. What a block needs to know of those before it,
the last separator and the number of documents, is a running maximum and a
running sum over the block summaries of its file.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.llm.common import ship, slices, texts
from contrail.llm.tokens import RANKS, tokenizer, tokenizer_path
from contrail.session import scratch_path, settle

#: Identifiers in a block.
BLOCK_IDS = 1 << 17
#: Blocks that one task reads.
RANGE_BLOCKS = 64
#: The vocabulary's own end-of-text identifier; ids are 16 bits wide.
END_OF_TEXT = 50256

#: Schemes of paths that Arrow opens at any place.
SEEKABLE = ("file", "hdfs", "s3", "s3a", "gs")

BLOCKS = "file string, block long, ids binary, labels array<long>"
SUMMARY = "file string, block long, n_ids long, ends array<long>, labels array<long>"


def token_stream(docs: DataFrame, end_id: int = END_OF_TEXT, block_ids: int = BLOCK_IDS) -> DataFrame:
    """The flat token stream of each partition of `docs` in blocks, as a file of 16-bit ids would hold it.

    `labels` names the documents that end in a block; the search doesn't use it.
    """
    path, ranks = tokenizer_path(), tokenizer_path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, block = f"part-{TaskContext.get().partitionId():05d}", 0
        rest, labels = np.zeros(0, dtype="<u2"), []

        def out(part: np.ndarray, names: list) -> pa.RecordBatch:
            arrays = [pa.array([file]), pa.array([block], pa.int64()), pa.array([part.tobytes()], pa.binary()), pa.array([names], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(arrays, ["file", "block", "ids", "labels"])

        for ids, bodies in slices(batches, 2_000_000):
            encoded = tokenizer(path, ranks).encode(bodies)
            stops = len(rest) + np.cumsum([len(e) + 1 for e in encoded])  # one past each separator
            stream = np.concatenate([rest, *(x for e in encoded for x in (e.astype("<u2"), np.asarray([end_id], "<u2")))])
            whole, done = len(stream) // block_ids, 0
            for i in range(whole):
                upto = int(np.searchsorted(stops, (i + 1) * block_ids, "right"))
                yield out(stream[i * block_ids : (i + 1) * block_ids], labels + ids[done:upto])
                labels, done, block = [], upto, block + 1
            rest, labels = stream[whole * block_ids :], labels + ids[done:]
        if len(rest):
            yield out(rest, labels)

    return texts(docs).mapInArrow(run, BLOCKS)


def write_token_files(docs: DataFrame, path: str, end_id: int = END_OF_TEXT) -> DataFrame:
    """Write a flat file of 16-bit ids for each partition of `docs`; which document is where: `part`, `ordinal`, `doc_id`.

    `docs` is read twice, so it must give the same rows in the same partitions each
    time, as a scan of files does; whatever is more than that is written to the
    shared folder first. Spark's text writer ends each document with the bytes of
    `end_id`. NULL and empty texts are a separator alone, repeated rows are written
    as often as they occur, and an empty table gives no document. Eager.
    """
    words, ranks = tokenizer_path(), tokenizer_path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, bodies in slices(batches, 2_000_000):
            encoded = tokenizer(words, ranks).encode(bodies)
            yield pa.RecordBatch.from_arrays([pa.array([e.astype("<u2").tobytes() for e in encoded], pa.binary())], ["ids"])

    docs = texts(docs)
    if not scans_files(docs):
        docs = settle(docs, "token-documents")
    end = int(end_id).to_bytes(2, "little").decode("latin-1")
    values = docs.mapInArrow(run, "ids binary").select(F.col("ids").cast("string").alias("value"))
    values.write.option("encoding", "ISO-8859-1").option("lineSep", end).option("compression", "none").text(path)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return docs.select(F.spark_partition_id().alias("part"), place.alias("ordinal"), "doc_id")


def scans_files(df: DataFrame) -> bool:
    """Whether a frame is one scan of files, filtered and projected by what depends on its rows alone."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.deterministic():
        name, children = plan.nodeName(), plan.children()
        if name in ("Project", "Filter"):
            plan = children.apply(0)
        else:
            return name == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation"
    return False


def open_path(path: str):
    """A file for reading at any place."""
    if path.startswith("file:"):
        return pa.OSFile("/" + path[5:].lstrip("/"))
    scheme, rest = path.split(":", 1)
    store, name = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}:{quote(rest)}")
    return store.open_input_file(name)


def read_token_files(spark: SparkSession, path: str, width: int = 2, block_ids: int = BLOCK_IDS, range_blocks: int = RANGE_BLOCKS) -> DataFrame:
    """Blocks of flat token files of `width` bytes an id; what is left of an id at the end is ignored.

    Files are listed with their sizes, and each range of `range_blocks` blocks is
    read by a task of its own. Only in stores that Arrow does not open (it opens
    local and shared folders, HDFS, S3 and GCS) one task reads a file, of at most 2 GB.
    """
    step = width * block_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at, upto in zip(*(batch.column(c).to_pylist() for c in ("path", "at", "upto")), strict=True):
                with open_path(path) as file:
                    file.seek(at)
                    for start in range(at, upto, step):
                        part = file.read(min(step, upto - start))
                        arrays = [pa.array([path]), pa.array([start // step], pa.int64()), pa.array([part], pa.binary()), pa.array([None], pa.list_(pa.int64()))]
                        yield pa.RecordBatch.from_arrays(arrays, ["file", "block", "ids", "labels"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content"), strict=True):
                data, step = memoryview(content.as_buffer()), width * block_ids
                for block, at in enumerate(range(0, len(data) - len(data) % width, step)):
                    part = bytes(data[at : min(at + step, len(data) - len(data) % width)])
                    arrays = [pa.array([file.as_py()]), pa.array([block], pa.int64()), pa.array([part], pa.binary()), pa.array([None], pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(arrays, ["file", "block", "ids", "labels"])

    ship(spark)
    files = spark.read.format("binaryFile").load(path)
    first = files.select("path").head()
    if first and first[0].split(":", 1)[0] not in SEEKABLE:
        return files.select("path", "content").mapInArrow(run, BLOCKS)
    usable = F.expr(f"length - length % {width}")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), usable - 1, F.lit(step * range_blocks).cast("long")))
    ranges = files.where(usable > 0).select("path", usable.alias("usable"), starts.alias("at"))
    ranges = settle(ranges.select("path", "at", F.least("usable", F.col("at") + step * range_blocks).alias("upto")), "ranges")
    return ranges.repartition(max(1, ranges.count())).mapInArrow(read, BLOCKS)


def token_file_scan(docs: DataFrame) -> DataFrame:
    """Flat files of `docs` in the scratch folder, scanned; `doc_id` is joined by part and ordinal once they are found.

    One row per row of `docs`, with the columns of `document_tokens`. NULL and empty
    texts have 0 tokens, repeated rows a row each; a NULL id stays NULL; an empty
    table gives no rows. Eager.
    """
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "token-files")
    names = settle(write_token_files(docs, path), "token-names")
    found = document_tokens(read_token_files(spark, path)).drop("doc_id")
    part = F.regexp_extract(F.col("file"), r"/part-(\d+)[^/]*$", 1).cast("int")
    return found.withColumn("part", part).join(names, ["part", "ordinal"], "left").select(*found.columns, "doc_id")


def document_tokens(blocks: DataFrame, end_id: int = END_OF_TEXT, width: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Documents of flat token files: `file`, `ordinal` (in the file), `start`, `n_tokens` (without the separator), `ended`, `doc_id`.

    All blocks of a file but its last hold `block_ids` ids. What follows a file's
    last separator is a document with `ended` false, if there is any. Separators
    that follow each other enclose empty documents. An empty file has none.
    `doc_id` is NULL where the blocks name no documents. Eager.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files, numbers, sizes, found = [], [], [], []
            for file, block, ids in zip(batch.column("file"), batch.column("block"), batch.column("ids"), strict=True):
                values = np.frombuffer(ids.as_buffer(), dtype=f"<u{width}")
                files.append(file.as_py())
                numbers.append(block.as_py())
                sizes.append(len(values))
                found.append(np.flatnonzero(values == end_id) + block.as_py() * block_ids)
            arrays = [pa.array(files, pa.string()), pa.array(numbers, pa.int64()), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64())), batch.column("labels")]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in SUMMARY.split(", ")])

    by_file = Window.partitionBy("file").orderBy("block")
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    scanned = settle(blocks.mapInArrow(search, SUMMARY), "separators")
    # what is stitched of each block is two numbers; its separators stay where they are
    summary = scanned.select("file", "block", F.when(F.size("ends") > 0, F.element_at("ends", -1)).alias("end"), F.size("ends").alias("n"))
    before_each = summary.select(
        "file",
        "block",
        F.coalesce(F.max("end").over(before), F.lit(-1)).alias("last_end"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ended_before"),
        F.lead("block").over(by_file).isNull().alias("is_last"),
    )
    stitched = scanned.join(before_each, ["file", "block"])
    length = F.col("block") * block_ids + F.col("n_ids")
    own_last = F.when(F.size("ends") > 0, F.element_at("ends", -1)).otherwise(F.col("last_end"))
    tail = F.when(F.col("is_last") & (own_last + 1 < length), F.array(length))
    stops = F.concat("ends", F.coalesce(tail, F.array().cast("array<bigint>")))
    split = stitched.withColumn("n_ends", F.size("ends")).withColumn("stops", stops)
    start = F.when(F.col("i") > 0, F.get("stops", F.col("i") - 1)).otherwise(F.col("last_end")) + 1
    return split.select("*", F.posexplode("stops").alias("i", "stop")).select(
        "file",
        (F.col("ended_before") + F.col("i")).alias("ordinal"),
        start.alias("start"),
        (F.col("stop") - start).alias("n_tokens"),
        (F.col("i") < F.col("n_ends")).alias("ended"),
        F.get("labels", F.col("i")).alias("doc_id"),
    )
