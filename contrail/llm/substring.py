"""Removal of repeated passages: suffix automata over reference shards, matching statistics, spans.

A window is removed if its words occur earlier. Comparing every document with an
automaton of all earlier text would grow with the square of the corpus, so the
reference is dealt into shards by content: each window belongs to the least hash
among its word groups, equal windows to the same one. Hashes that occur once are
left out. In a shard the passages of a hash stream by in order of document; a
suffix automaton of the ones before gives each word's matching statistic, and
words that end a match of a window's length are marked. Hashes that occur very
often, where one automaton would hold an unbounded number of passages, are
compared window by window instead, by grouping.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import fmix, forget, numbered, slices, texts, utf8
from contrail.session import discard, settle

WINDOW_WORDS = 20
#: Words of a group; its least hash in a window names the window's shard.
GROUP_WORDS = 8
#: Windows of a passage at most; longer runs are cut. Place and windows share a number, 16 to a word.
PASSAGE_WINDOWS = 14
#: Passages of one hash that an automaton takes at most.
AUTOMATON_PASSAGES = 2000

RUNS = "doc_id long, row_hash long, n_words long, kept_sha256 string, hashes array<long>, starts array<int>, counts array<int>, again array<long>"
PASSAGES = "hash long, doc_id long, row_hash long, start int, passage binary"
SPANS = "doc_id long, row_hash long, start int, end int"
RESULT = "doc_id long, row_hash long, n_removed long, kept_sha256 string, text string"
_STEP = np.uint64(0x9E3779B97F4A7C15)


class SuffixAutomaton:
    """Automaton of all words fed so far. A break keeps matches from running over it."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        self.last = 0

    def feed(self, words: list[bytes]) -> list[int]:
        """For each word the longest match that ends there with anything fed before it; then the words are part of it."""
        out, state, matched = [], 0, 0
        self.last = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            out.append(matched)
            self._extend(word)
            while state and self.length[self.link[state]] >= matched:  # a state that was split meanwhile
                state = self.link[state]
        return out

    def _extend(self, word: bytes) -> None:
        nexts, link, length = self.next, self.link, self.length
        p = self.last
        if word in nexts[p]:
            q = nexts[p][word]
            self.last = q if length[q] == length[p] + 1 else self._split(p, q, word)
            return
        new = len(length)
        nexts.append({})
        link.append(0)
        length.append(length[p] + 1)
        while p != -1 and word not in nexts[p]:
            nexts[p][word] = new
            p = link[p]
        if p != -1:
            q = nexts[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, q, word)
        self.last = new

    def _split(self, p: int, q: int, word: bytes) -> int:
        """The part of state q that is one word longer than p, as a state of its own."""
        nexts, link, length = self.next, self.link, self.length
        half = len(length)
        nexts.append(dict(nexts[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = half
        while p != -1 and nexts[p].get(word) == q:
            nexts[p][word] = half
            p = link[p]
        return half


def words(text: str) -> list[bytes]:
    return utf8(text).split()


def least(hashes: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` neighbours."""
    done, out = 1, hashes
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def runs_of(lists: list[list[bytes]], window: int, group: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring windows with the same least hash: document, first window, windows, hash, whether words may repeat in it."""
    flat, bounds, distinct = numbered(lists)
    empty = np.zeros(0, dtype=np.int64)
    nothing = empty, empty, empty, empty.astype(np.uint64), empty.astype(bool)
    if len(flat) < window:
        return nothing
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), dtype=np.uint64, count=len(distinct))[flat]
    rolled = np.zeros(len(flat) - group + 1, dtype=np.uint64)
    for i in range(group):
        rolled = fmix(rolled * _STEP + hashes[i : i + len(rolled)])
    value = least(rolled, window - group + 1)
    owner = np.repeat(np.arange(len(lists)), np.diff(bounds))[: len(value)]
    inside = np.arange(len(value)) + window <= bounds[1:][owner]
    at = np.flatnonzero(inside)
    if not len(at):
        return nothing
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(at) != 1) | (value[at[1:]] != value[at[:-1]]) | (owner[at[1:]] != owner[at[:-1]])
    head = np.flatnonzero(new)
    length = np.diff(head, append=len(at))
    parts = -(-length // PASSAGE_WINDOWS)
    turn = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(at[head], parts) + turn * PASSAGE_WINDOWS
    count = np.minimum(PASSAGE_WINDOWS, np.repeat(length, parts) - turn * PASSAGE_WINDOWS)
    doc = owner[first]
    # equal windows of one run overlap, so they hold a group of words twice at a distance below a run's length
    twice = np.zeros(len(rolled) + 1, dtype=np.int64)
    for period in range(1, min(PASSAGE_WINDOWS, len(rolled))):
        twice[1 : len(rolled) - period + 1] |= rolled[:-period] == rolled[period:]
    twice = np.cumsum(twice)
    own = twice[np.minimum(first + count + window - group, len(rolled))] > twice[first]
    return doc, first - bounds[:-1][doc], count, value[first], own


def repeated_words(rows: Iterator[tuple], window: int) -> Iterator[tuple]:
    """Spans of words in windows that occur earlier. `rows`: hash, doc_id, row_hash, start, passage, in this order."""
    group, before = object(), None
    for name, doc_id, row_hash, start, passage in rows:
        if name != group:
            group, before, seen, waiting, automaton = name, None, set(), [], None
        if (doc_id, row_hash, start) == before:
            continue  # a repeated row
        before = (doc_id, row_hash, start)
        if passage in seen:
            yield doc_id, row_hash, start, start + passage.count(b" ") + 1
            continue
        ws = passage.split(b" ")
        if not seen and len(set(ws)) > len(ws) - window + PASSAGE_WINDOWS - 1:  # the first, and too varied to repeat itself
            waiting.append(ws)
        else:
            automaton = automaton or SuffixAutomaton()
            for earlier in waiting:
                automaton.feed(earlier)
            waiting = []
            end = -1
            for place, matched in enumerate(automaton.feed(ws)):
                if matched >= window:
                    low = place - window + 1
                    if end >= 0 and low > end:
                        yield doc_id, row_hash, start + begin, start + end
                        end = -1
                    begin, end = (low if end < 0 else begin), place + 1
            if end >= 0:
                yield doc_id, row_hash, start + begin, start + end
        seen.add(passage)


def _batches(rows: Iterator[tuple], schema: str, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    columns = [c.split() for c in schema.split(", ")]
    part = []

    def made() -> pa.RecordBatch:
        data = list(zip(*part, strict=True)) or [()] * len(columns)
        return pa.RecordBatch.from_arrays([pa.array(d, kinds[k]) for d, (_, k) in zip(data, columns, strict=True)], [n for n, _ in columns])

    for row in rows:
        part.append(row)
        if len(part) == size:
            yield made()
            part = []
    yield made()


def remove_repeats(docs: DataFrame, window: int = WINDOW_WORDS, group: int = GROUP_WORDS, often: int = AUTOMATON_PASSAGES) -> DataFrame:
    """Documents without the words of repeated windows, one row per row of `docs`.

    A window is `window` consecutive words of a document; it is repeated if the
    same words start earlier, in a smaller `doc_id` or before it in the same one.
    Columns: `doc_id`, `n_words`, `n_removed`, `kept_sha256` (of the kept words
    joined by one space), `kept_text` (those words; NULL where nothing is removed).
    NULL and empty texts have no words. Repeated rows (id and text) count as one
    document and get the same result; different texts under one id are ordered by
    a hash of the text. A NULL id is smaller than all others. Eager.
    """
    docs = texts(docs).withColumn("row_hash", F.xxhash64("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, at = batch.column("row_hash"), 0
            for ids, bodies in slices(iter([batch])):
                lists = [words(t) for t in bodies]
                doc, first, count, value, own = runs_of(lists, window, group)
                offsets = pa.array(np.searchsorted(doc, np.arange(len(lists) + 1)).astype(np.int32))
                shas = [hashlib.sha256(b" ".join(ws)).hexdigest() for ws in lists]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        hashes.slice(at, len(ids)),
                        pa.array([len(ws) for ws in lists], pa.int64()),
                        pa.array(shas, pa.string()),
                        pa.ListArray.from_arrays(offsets, pa.array(value.astype(np.int64))),
                        pa.ListArray.from_arrays(offsets, pa.array(first.astype(np.int32))),
                        pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int32))),
                        pa.ListArray.from_arrays(
                            pa.array(np.searchsorted(doc[own], np.arange(len(lists) + 1)).astype(np.int32)), pa.array(value[own].astype(np.int64))
                        ),
                    ],
                    [c.split()[0] for c in RUNS.split(", ")],
                )
                at += len(ids)

    spark = docs.sparkSession
    scanned = settle(docs.mapInArrow(scan, RUNS), "runs")
    # the hash of the text tells rows apart only where an id has several texts; elsewhere it is 0 and costs nothing
    several = scanned.groupBy("doc_id").agg(F.min("row_hash").alias("low"), F.max("row_hash").alias("high")).where("low < high")
    several = settle(several.select(F.col("doc_id").alias("several_id")), "several")

    def told_apart(df: DataFrame) -> DataFrame:
        joined = df.join(several.withColumn("hit", F.lit(True)), df.doc_id.eqNullSafe(several.several_id), "left")
        return joined.withColumn("row_hash", F.when(F.col("hit"), F.col("row_hash")).otherwise(F.lit(0).cast("long"))).select(*df.columns)

    scanned, docs = told_apart(scanned), told_apart(docs)
    counted = scanned.select(F.explode(F.concat("hashes", "again")).alias("hash")).groupBy("hash").count()
    shared = settle(counted.where("count > 1").select("hash", (F.col("count") > often).alias("often")), "shared")
    packed = F.zip_with("starts", "counts", lambda s, n: s * 16 + n)
    occurrences = scanned.select("doc_id", "row_hash", F.explode(F.arrays_zip("hashes", packed.alias("at"))).alias("r")).select(
        "doc_id", "row_hash", F.col("r.hashes").alias("hash"), F.col("r.at").alias("at")
    )
    found = settle(occurrences.join(shared, "hash").groupBy("doc_id", "row_hash").agg(F.collect_set(F.struct("hash", "at", "often")).alias("runs")), "found")
    del counted, occurrences
    discard(shared)
    forget(spark)
    same = [docs[c].eqNullSafe(found[c]) for c in ("doc_id", "row_hash")]
    known = settle(docs.join(found, same).select(docs.doc_id, docs.row_hash, "text", "runs"), "passage-texts")
    discard(found)
    forget(spark)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, row_hash, text, runs in zip(*(batch.column(c) for c in ("doc_id", "row_hash", "text", "runs")), strict=True):
                    doc_id, row_hash, ws = doc_id.as_py(), row_hash.as_py(), words(text.as_py())
                    for r in runs.as_py():
                        start, n = divmod(r["at"], 16)
                        yield r["hash"], doc_id, row_hash, start, b" ".join(ws[start : start + n + window - 1])

        yield from _batches(rows(), PASSAGES, 5000)

    def passages(frequent: bool) -> DataFrame:
        mine = known.withColumn("runs", F.filter("runs", lambda r: r["often"] == F.lit(frequent))).where(F.size("runs") > 0)
        return mine.mapInArrow(cut, PASSAGES)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("hash", "doc_id", "row_hash", "start", "passage")), strict=True))
        yield from _batches(repeated_words(rows, window), SPANS)

    few = passages(False).repartition("hash").sortWithinPartitions("hash", F.asc_nulls_first("doc_id"), "row_hash", "start").mapInArrow(match, SPANS)
    few = settle(few, "spans")
    forget(spark)  # the passages are shuffled one kind after the other
    spans = settle(few.unionByName(_often(passages(True), window)), "all-spans")
    discard(few)
    forget(spark)
    spans = spans.groupBy("doc_id", "row_hash").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, row_hash, text, cuts in zip(*(batch.column(c) for c in ("doc_id", "row_hash", "text", "spans")), strict=True):
                    ws = words(text.as_py())
                    drop = np.zeros(len(ws) + 1, dtype=np.int64)
                    for s in cuts.as_py():
                        drop[s["start"]] += 1
                        drop[s["end"]] -= 1
                    kept = [w for w, d in zip(ws, np.cumsum(drop).tolist(), strict=False) if not d]
                    body = b" ".join(kept)
                    yield doc_id.as_py(), row_hash.as_py(), len(ws) - len(kept), hashlib.sha256(body).hexdigest(), body.decode("utf-8", "replace")

        yield from _batches(rows(), RESULT, 500)

    same = [known[c].eqNullSafe(spans[c]) for c in ("doc_id", "row_hash")]
    cleaned = known.join(spans, same).select(known.doc_id, known.row_hash, "text", "spans").mapInArrow(keep, RESULT)
    cleaned = cleaned.select(F.col("doc_id").alias("c_id"), F.col("row_hash").alias("c_hash"), "n_removed", F.col("kept_sha256").alias("c_sha"), F.col("text").alias("kept_text"))
    cleaned = cleaned.dropDuplicates(["c_id", "c_hash"])
    whole = scanned.select("doc_id", "row_hash", "n_words", "kept_sha256")
    return whole.join(cleaned, whole.doc_id.eqNullSafe(F.col("c_id")) & (whole.row_hash == F.col("c_hash")), "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("c_sha", "kept_sha256").alias("kept_sha256"), "kept_text"
    )


def _often(passages: DataFrame, window: int) -> DataFrame:
    """Spans of repeated windows, by grouping: a whole passage seen before, or else each window with the first of its kind."""
    place = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "row_hash", "start")
    rows = passages.withColumn("place", place)
    distinct = rows.groupBy("passage").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    ws = F.split(F.col("passage").cast("string"), " ")
    copies = rows.join(distinct.where("n > 1").drop("n"), "passage").where("place > first").withColumn("end", F.col("start") + F.size(ws))
    windows = F.transform(
        F.sequence(F.lit(0), F.size("ws") - window),
        lambda i: F.struct((F.col("start") + i).alias("start"), F.array_join(F.slice("ws", i + 1, F.lit(window)), " ").alias("window")),
    )
    once = distinct.select("first.*", ws.alias("ws")).select("doc_id", "row_hash", F.explode(windows).alias("w")).select("doc_id", "row_hash", "w.*")
    first = once.groupBy("window").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("window", "first")
    later = once.withColumn("place", place).join(first, "window").where("place > first").withColumn("end", F.col("start") + window)
    return copies.select("doc_id", "row_hash", "start", "end").unionByName(later.select("doc_id", "row_hash", "start", "end"))
