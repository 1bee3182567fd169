"""Packing documents into fixed windows with a bounded number of open ones.

Each partition streams its documents. Whole windows are cut off long documents;
what remains goes into the open window that it fills best. If it fits none and
as many windows are open as allowed, the fullest one is emitted. The windows
still open at the end of a partition meet those of other partitions, whole
groups of them at a time, and are merged.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import slices, texts
from contrail.llm.tokens import tokenizer, tokenizer_path
from contrail.session import settle

WINDOW = 1024
OPEN_WINDOWS = 64
#: Partitions whose open windows meet in one merging task.
MERGED_PARTITIONS = 64
END_OF_DOCUMENT = 0

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, is_open boolean"
)
PIECE_COLUMNS = [c.split()[0] for c in PIECES.split(", ")]


class OpenWindows:
    """Windows with free space, at most `limit`; sequence numbers start at `first`."""

    def __init__(self, size: int, limit: int, first: int):
        self.size, self.limit, self.next = size, limit, first
        self.free: list[tuple[int, int]] = []  # (free space, sequence number), in order

    def fresh(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, length: int) -> tuple[int, int]:
        """Sequence number and offset for a piece."""
        at = bisect_left(self.free, (length, -1))
        if at < len(self.free):
            space, sequence = self.free.pop(at)
        else:
            if len(self.free) >= self.limit:
                self.free.pop(0)  # the fullest
            space, sequence = self.size, self.fresh()
        if space > length:
            insort(self.free, (space - length, sequence))
        return sequence, self.size - space


def pack(
    docs: DataFrame,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    tokenizer_file: str | None = None,
    end_id: int = END_OF_DOCUMENT,
    merged_partitions: int = MERGED_PARTITIONS,
) -> DataFrame:
    """Pieces of all documents and their places in windows of at most `window` tokens.

    A document's tokens are its ids and `end_id`; NULL and empty texts have that
    one token. One row per piece: `doc_id`, `start` (tokens before it in the
    document), `length`, `ids_crc32` (of the little-endian 32-bit ids),
    `doc_tokens`, `sequence_id`, `offset`. Pieces of a sequence follow each other
    without gaps. Repeated rows are packed as often as they occur; rows with a
    NULL id are packed too. An empty table gives no rows.
    """
    path = tokenizer_file or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = OpenWindows(window, open_windows, TaskContext.get().partitionId() << 40)
        pending: dict[int, list[tuple]] = {}
        for ids, bodies in slices(batches):
            rows = []
            for doc_id, tokens in zip(ids, tokenizer(path).encode(bodies), strict=True):
                tokens = np.append(tokens, np.uint32(end_id)).astype("<u4")
                total = len(tokens)
                for start in range(0, total, window):
                    part = tokens[start : start + window]
                    sequence, offset = (windows.fresh(), 0) if len(part) == window else windows.place(len(part))
                    row = (doc_id, start, len(part), zlib.crc32(part.tobytes()), total, sequence, offset)
                    if len(part) == window:
                        rows.append(row)
                    else:
                        pending.setdefault(sequence, []).append(row)
            still = {s for _, s in windows.free}
            for sequence in [s for s in pending if s not in still]:
                rows += pending.pop(sequence)
            yield _batch(rows, False)
        yield _batch([row for rows in pending.values() for row in rows], True)

    pieces = settle(texts(docs).mapInArrow(run, PIECES), "packed")
    return pieces.where(~F.col("is_open")).unionByName(_merged(pieces.where("is_open"), window, merged_partitions)).drop("is_open")


def _merged(pieces: DataFrame, window: int, partitions: int) -> DataFrame:
    """The same pieces with left-over windows put together, the longest first, each into the best-fitting one."""

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        fill = frame.groupby("sequence_id")["length"].sum().reset_index().sort_values(["length", "sequence_id"], ascending=[False, True])
        windows = OpenWindows(window, len(fill), 0)
        moved, named = {}, {}
        for own, length in zip(fill["sequence_id"], fill["length"], strict=True):
            target, offset = windows.place(int(length))
            moved[own] = (named.setdefault(target, own), offset)
        places = frame["sequence_id"].map(moved)
        frame["sequence_id"] = [s for s, _ in places]
        frame["offset"] += [o for _, o in places]
        return frame.drop(columns="group")

    group = F.floor(F.shiftright("sequence_id", 40) / partitions)
    return pieces.withColumn("group", group).groupBy("group").applyInPandas(merge, PIECES)


def _batch(rows: list[tuple], is_open: bool) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 7
    arrays = [pa.array(c, pa.int64()) for c in columns] + [pa.array([is_open] * len(rows), pa.bool_())]
    return pa.RecordBatch.from_arrays(arrays, PIECE_COLUMNS)
