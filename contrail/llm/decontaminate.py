"""Benchmark decontamination: suffix arrays of training text, searched for every benchmark suffix.

Each slice of documents is a shard. Words are numbered by the benchmark's
vocabulary; a suffix that begins with fewer known words than the shortest window
can hold no match, so the shard's suffix array leaves it out. Every benchmark
suffix is found in it by binary search for its window. Neighbouring finds on one
diagonal are a longest verbatim match, with its place. The benchmark is broadcast
in blocks of bounded size, one scan of the documents for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import numbered, slices, texts, utf8

WINDOW_WORDS = 10
#: Bytes of benchmark text in one broadcast block; a longer item is cut into overlapping parts.
BLOCK_BYTES = 4_000_000

MATCHES = "doc_id long, n_words long, item_id string, start long, length long"
_SEPARATORS = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def words(text: str) -> list[bytes]:
    """Words of a text: A-Z lower-cased, cut at ASCII characters other than digits and letters."""
    return utf8(text).lower().translate(_SEPARATORS).split()


class Block(NamedTuple):
    """Windows of some benchmark items. `owner` and `place` list, window by window, the items and their positions."""

    vocabulary: dict[bytes, int]
    keys: np.ndarray  # distinct windows, words beyond a short one are 0
    lengths: np.ndarray
    bounds: np.ndarray  # first entry of each window in owner and place
    owner: np.ndarray
    place: np.ndarray
    names: list[str]


def block_of(items: list[tuple[str, int, list[bytes]]], window: int) -> Block:
    """`items`: name, position of the first word in the item, words."""
    flat, starts, distinct = numbered([ws for _, _, ws in items])
    flat = np.concatenate([flat + 1, np.zeros(window, dtype=np.int64)]).astype(np.int32)
    first, length, owner, place = [], [], [], []
    for i, (_, shift, ws) in enumerate(items):
        size = min(window, len(ws))
        at = np.arange(len(ws) - size + 1) if ws else np.zeros(0, dtype=np.int64)
        first.append(starts[i] + at)
        place.append(shift + at)
        length.append(np.full(len(at), size))
        owner.append(np.full(len(at), i))
    first, length, owner, place = (np.concatenate([*x, np.zeros(0, dtype=np.int64)]).astype(np.int64) for x in (first, length, owner, place))
    keys, which = np.unique(_keys(flat, first, length, window), return_inverse=True)
    order = np.argsort(which, kind="stable")
    lengths = np.zeros(len(keys), dtype=np.int64)
    lengths[which] = length
    bounds = np.searchsorted(which[order], np.arange(len(keys) + 1))
    return Block({w: i + 1 for i, w in enumerate(distinct)}, keys, lengths, bounds, owner[order], place[order], [n for n, _, _ in items])


def _keys(numbers: np.ndarray, at: np.ndarray, length: np.ndarray, window: int) -> np.ndarray:
    """The `length` words from each position, as fixed-width big-endian keys that sort like the word numbers."""
    column = np.arange(window)
    table = numbers[np.minimum(at[:, None] + column, len(numbers) - 1)]
    table = np.where(column < length[:, None], table, 0).astype(">u4")
    return np.ascontiguousarray(table).view(f"S{4 * window}").ravel()


def find(block: Block, lists: list[list[bytes]], window: int) -> list[tuple[int, int, int, int]]:
    """Longest verbatim matches in a shard: document number, item number, first word, words."""
    get = block.vocabulary.get
    sizes = [len(ws) + 1 for ws in lists]  # a break after each document
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    numbers = np.zeros(int(starts[-1]) + window, dtype=np.int32)
    for at, ws in zip(starts.tolist(), lists, strict=False):
        numbers[at : at + len(ws)] = [get(w, 0) for w in ws]
    if not len(block.keys):
        return []
    breaks = np.flatnonzero(numbers == 0)
    known = np.repeat(breaks, np.diff(breaks, prepend=-1)) - np.arange(breaks[-1] + 1)  # words known from here on
    suffixes = np.flatnonzero(known >= block.lengths.min())
    keys = _keys(numbers, suffixes, known[suffixes], window)
    order = np.argsort(keys, kind="stable")
    suffixes, keys = suffixes[order], keys[order]
    low = np.searchsorted(keys, block.keys, "left")
    # past all suffixes that begin with the window: its last word's number, plus one
    column = block.lengths - 1
    past = np.frombuffer(block.keys.tobytes(), dtype=">u4").reshape(-1, window).copy()
    past[np.arange(len(past)), column] += 1
    high = np.searchsorted(keys, np.ascontiguousarray(past).view(f"S{4 * window}").ravel(), "left")
    found = high - low
    which = np.repeat(np.arange(len(found)), found)
    at = suffixes[np.repeat(low - np.cumsum(found) + found, found) + np.arange(int(found.sum()))]
    # every find with every item that holds the window
    copies = block.bounds[which + 1] - block.bounds[which]
    entry = np.repeat(block.bounds[which] - np.cumsum(copies) + copies, copies) + np.arange(int(copies.sum()))
    at, size = np.repeat(at, copies), np.repeat(block.lengths[which], copies)
    owner, place = block.owner[entry], block.place[entry]
    doc = np.searchsorted(starts, at, "right") - 1
    order = np.lexsort((at, at - place, owner, doc))
    doc, owner, at, place, size = (x[order] for x in (doc, owner, at, place, size))
    if not len(at):
        return []
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(doc) != 0) | (np.diff(owner) != 0) | (np.diff(at - place) != 0) | (np.diff(at) != 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1
    length = at[tail] - at[head] + size[tail]
    return list(zip(doc[head].tolist(), owner[head].tolist(), (at[head] - starts[doc[head]]).tolist(), length.tolist(), strict=True))


def blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Block]:
    """The benchmark in blocks; the driver holds one at a time."""
    part, size, none = [], 0, True
    for item, text in benchmark.toLocalIterator():
        ws = words(text or "")
        step = max(window, block_bytes // 64)
        for shift in range(0, max(1, len(ws) - window + 1), step):
            cut = ws[shift : shift + step + window - 1]
            part.append((item, shift, cut))
            size += sum(map(len, cut))
            if size >= block_bytes:
                yield block_of(part, window)
                part, size, none = [], 0, False
    if part or none:
        yield block_of(part, window)


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Longest verbatim matches of at least a window, `start` and `length` in words; and one row per document with `n_words`."""
    docs, out = texts(docs), None
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(item_text).alias("text"))
    for number, block in enumerate(blocks(items, window, block_bytes)):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, number=number) -> Iterator[pa.RecordBatch]:
            names = sent.value.names
            for ids, bodies in slices(batches):
                lists = [words(t) for t in bodies]
                rows = [(ids[d], None, names[i], start, length) for d, i, start, length in find(sent.value, lists, window)]
                if number == 0:
                    rows += [(i, len(ws), None, None, None) for i, ws in zip(ids, lists, strict=True)]
                columns = list(zip(*rows, strict=True)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in MATCHES.split(", ")])

        part = docs.mapInArrow(run, MATCHES)
        out = part if out is None else out.unionByName(part)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """How much of each document is benchmark text, one row per id.

    A window is `window` consecutive words of an item, or a shorter item as a
    whole. Columns: `doc_id`, `n_words`, `n_hit` (words inside any occurrence of a
    window), `n_items`, `items_sha256` (item ids as sorted strings, comma-joined),
    `contaminated`. NULL and empty texts have no words; items without words match
    nothing; a NULL item id counts as an empty string; an empty benchmark hits
    nothing. Rows that share an id (NULL is one id) are reported as one, with the
    hits of all and the largest word count.
    """
    spans = F.array_sort(F.collect_list(F.when(F.col("start").isNotNull(), F.struct("start", (F.col("start") + F.col("length")).alias("end")))))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), x["end"] - F.greatest(x["start"], acc["end"]))).alias("n"),
            F.greatest(acc["end"], x["end"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    return (
        matches(docs, benchmark, **options)
        .groupBy("doc_id")
        .agg(F.max("n_words").alias("n_words"), spans.alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items"))
        .select(
            "doc_id",
            "n_words",
            covered.alias("n_hit"),
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
            (F.size("spans") > 0).alias("contaminated"),
        )
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, all columns, whose text holds no benchmark window; rows with a NULL id stay."""
    hit = contamination(docs, benchmark, **options).where("contaminated").select(F.col("doc_id").alias("_hit"))
    return docs.join(hit, docs["doc_id"].cast("long") == hit["_hit"], "left_anti")
