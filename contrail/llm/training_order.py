"""Training order on disk: a keyed permutation of all sequences, in shards of fixed stride.

The token stream of each partition is cut into sequences, which are written once
and counted, so each has a global number; a Feistel network with cycle-walking
maps the numbers onto themselves. The slot decides the shard, a range of slots, and the
place in it: record r of shard k holds slot k * slots_per_shard + r and starts at
byte r * stride. A reader resumes at any slot, and needs no index.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import fmix, forget, ship, slices, texts
from contrail.llm.token_scan import SEEKABLE, open_path
from contrail.llm.tokens import RANKS, tokenizer, tokenizer_path
from contrail.session import discard_path, read_bytes, scratch_path, settle, write_bytes

SEQUENCE_IDS, SLOTS_PER_SHARD = 1023, 8192
END_OF_TEXT = 50256
#: Fills the last sequence of a partition; no vocabulary id.
PADDING = 0xFFFF
#: Ends each record: one more id, so that a record of 1,023 ids takes 2,048 bytes.
RECORD_END = "\0\0"
ROUNDS, KEY = 6, 20_240_601

SEQUENCES = "part long, at long, ids binary"
RECORDS = "slot long, shard long, row long, sequence_id long, n_tokens long, ids_crc32 long, ids binary"
#: Shards are shuffled and written in so many waves, so that only one wave's share is in shuffle files at a time.
WAVES = 4
#: Folders are named for their first shard; the header is written last, so an unfinished order has none.
FIRST, HEADER = "first_shard", "header.json"


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _round_keys(key: int) -> np.ndarray:
    return fmix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key % 2**64))


def permuted(numbers: np.ndarray, n: int, key: int = KEY, inverse: bool = False) -> np.ndarray:
    """A keyed permutation of 0 .. n - 1, or its inverse, on an array of numbers below n."""
    bits = np.uint64(_half_bits(n))
    low = (np.uint64(1) << bits) - np.uint64(1)
    keys = _round_keys(key)
    out = np.asarray(numbers, dtype=np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> bits, out[todo] & low
        for k in keys[::-1] if inverse else keys:
            if inverse:
                left, right = right ^ (fmix(left + k) & low), left
            else:
                left, right = right, left ^ (fmix(right + k) & low)
        out[todo] = left << bits | right
        todo = todo[out[todo] >= n]  # outside: walk on along the cycle
    return out.astype(np.int64)


def _streams(batches: Iterator[pa.RecordBatch], path: str, ranks: str, size: int, end_id: int) -> Iterator[np.ndarray]:
    """Sequences of one partition, (some, size); the last one is padded."""
    rest = np.zeros(0, dtype="<u2")
    for _, bodies in slices(batches, 2_000_000):
        encoded = tokenizer(path, ranks).encode(bodies)
        stream = np.concatenate([rest, *(x for e in encoded for x in (e.astype("<u2"), np.asarray([end_id], "<u2")))])
        whole = len(stream) // size
        yield stream[: whole * size].reshape(whole, size)
        rest = stream[whole * size :]
    if len(rest):
        yield np.concatenate([rest, np.full(size - len(rest), PADDING, "<u2")]).reshape(1, size)


def write_training_order(
    docs: DataFrame,
    path: str,
    key: int = KEY,
    size: int = SEQUENCE_IDS,
    slots_per_shard: int = SLOTS_PER_SHARD,
    end_id: int = END_OF_TEXT,
) -> int:
    """Write shards of all documents' tokens under `path`; returns the number of sequences.

    A document's tokens are its ids and `end_id`; NULL and empty texts have that
    one. Ids are 16 bits wide. Which sequence holds what follows from the
    partitions and row order of `docs`; repeated rows are written as often as they
    occur. An empty table writes no shard. A header names the key and the layout. Eager.
    """
    spark, docs = docs.sparkSession, texts(docs)
    words, ranks = tokenizer_path(), tokenizer_path(RANKS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for block in _streams(batches, words, ranks, size, end_id):
            columns = [pa.array([part] * len(block), pa.int64()), pa.array(np.arange(at, at + len(block)), pa.int64())]
            at += len(block)
            yield pa.RecordBatch.from_arrays([*columns, pa.array([r.tobytes() for r in block], pa.binary())], ["part", "at", "ids"])

    cut_path = scratch_path(spark, "sequences")
    docs.mapInArrow(cut, SEQUENCES).write.option("compression", "zstd").parquet(cut_path)
    sequences = spark.read.schema(SEQUENCES).parquet(cut_path)
    first, n = {}, 0
    for row in sequences.groupBy("part").count().orderBy("part").collect():  # a row for each partition
        first[row["part"]], n = n, n + row["count"]
    shards = -(-n // slots_per_shard)

    def placing(low: int, high: int) -> Callable:
        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            packer = zstandard.ZstdCompressor(level=1)
            for batch in batches:
                start = np.fromiter(map(first.__getitem__, batch.column("part").to_pylist()), dtype=np.int64, count=batch.num_rows)
                slots = permuted(start + batch.column("at").to_numpy(), n, key)
                mine = np.flatnonzero((low <= slots) & (slots < high))
                packed = [packer.compress(x) for x in batch.column("ids").take(pa.array(mine)).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(slots[mine], pa.int64()), pa.array(packed, pa.binary())], ["slot", "ids"])

        return place

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.column("ids").slice(at, 2000).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([packer.decompress(x) for x in part], pa.binary())], ["ids"])

    cuts = sorted({shards * wave // WAVES for wave in range(WAVES + 1)})
    for low, high in zip(cuts, cuts[1:], strict=False):
        shard = F.floor(F.col("slot") / slots_per_shard).cast("int") - low
        mine = sequences.mapInArrow(placing(low * slots_per_shard, high * slots_per_shard), "slot long, ids binary")
        placed = mine.repartitionById(high - low, shard).sortWithinPartitions("slot")
        records = placed.select("ids").mapInArrow(raw, "ids binary").select(F.col("ids").cast("string").alias("value"))
        writer = records.write.option("lineSep", RECORD_END).option("compression", "none").option("maxRecordsPerFile", 0)
        writer.text(f"{path}/{FIRST}={low}")
        del mine, placed, records, writer
        forget(spark)  # the shuffle files of this wave
    discard_path(spark, cut_path)
    header = {"sequences": n, "key": key, "size": size, "slots_per_shard": slots_per_shard, "end_id": end_id}
    write_bytes(spark, f"{path}/{HEADER}", json.dumps(header).encode())
    return n


def read_training_order(spark: SparkSession, path: str, start: int = 0, stop: int | None = None) -> DataFrame:
    """What the shards hold from slot `start` on, up to `stop`, one row per slot: `slot`, `shard`, `row`, `sequence_id`
    (number before the permutation), `n_tokens` (without padding), `ids_crc32` (of those ids, little-endian, 16 bits),
    `ids` (those ids).

    The header that the writer left last says how the shards are laid out. Shards
    outside the slots asked for are not opened, and of the others only the records
    asked for are read; where Arrow does not open the store, shards are read whole.
    """
    header = json.loads(read_bytes(spark, f"{path}/{HEADER}"))
    n, key, size, slots_per_shard = (header[x] for x in ("sequences", "key", "size", "slots_per_shard"))
    stride, start, stop = 2 * (size + 1), max(start, 0), n if stop is None else min(stop, n)
    ship(spark)
    if start >= stop:
        return spark.createDataFrame([], RECORDS)

    def records(shard: int, begin: int, content) -> pa.RecordBatch:
        data = np.frombuffer(content, dtype="<u2").reshape(-1, stride // 2)
        rows = begin + np.arange(len(data))
        slots = rows + shard * slots_per_shard
        sizes = (data[:, :size] != PADDING).sum(axis=1)
        ids = [r[:k].tobytes() for r, k in zip(data, sizes.tolist(), strict=True)]
        columns = [slots, np.full(len(data), shard), rows, permuted(slots, n, key, inverse=True), sizes, [zlib.crc32(x) for x in ids]]
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(ids, pa.binary())], [c.split()[0] for c in RECORDS.split(", ")])

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, shard, begin, end in zip(*(batch.column(c).to_pylist() for c in ("path", "shard", "begin", "end")), strict=True):
                with open_path(name) as file:
                    file.seek(begin * stride)
                    for at in range(begin, end, 1000):
                        yield records(shard, at, file.read(min(1000, end - at) * stride))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, shard, begin, end in zip(batch.column("content"), *(batch.column(c).to_pylist() for c in ("shard", "begin", "end")), strict=True):
                yield records(shard, begin, memoryview(content.as_buffer())[begin * stride : end * stride])

    number = F.regexp_extract("path", rf"/{FIRST}=(\d+)/part-(\d+)", 1).cast("long") + F.regexp_extract("path", r"/part-(\d+)", 1).cast("long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("basePath", path).load(path).where(f"length > 0 AND {FIRST} <= {(stop - 1) // slots_per_shard}")
    first_slot = F.col("shard") * slots_per_shard
    files = files.withColumn("shard", number).where(F.col("shard").between(start // slots_per_shard, (stop - 1) // slots_per_shard))
    files = files.withColumn("begin", F.greatest(start - first_slot, F.lit(0).cast("long"))).withColumn("end", F.least(stop - first_slot, (F.col("length") / stride).cast("long")))
    if urlsplit(files.select("path").head()[0]).scheme not in SEEKABLE:
        return files.select("content", "shard", "begin", "end").mapInArrow(cut, RECORDS)
    listed = settle(files.select("path", "shard", "begin", "end"), "shards")
    return listed.repartition(-(-stop // slots_per_shard) - start // slots_per_shard, "shard").mapInArrow(seek, RECORDS)


def training_order(docs: DataFrame) -> DataFrame:
    """Shards of `docs` in the shared folder, and what they hold; an empty table gives no rows."""
    spark = docs.sparkSession
    path = scratch_path(spark, "training-order")
    write_training_order(docs, path)
    return read_training_order(spark, path).drop("ids")
