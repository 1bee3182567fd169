"""How far the sources of each language differ in their terms, by chunk factorisation.

A chunk is a piece of text between white space. Chunks are counted per document;
each distinct chunk of the whole corpus is cut into terms once; its terms are
joined back to the counts. Documents are held in blocks of bounded size, in which
chunks and documents are small numbers, so a frequent chunk moves once for each
block and not once for each document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import forget, numbered, ship, slices, utf8
from contrail.session import discard, settle

# Fixed value: a term is a run of letters, where everything beyond ASCII is one.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_DOCUMENTS = 30
#: Added to every count, and the whole that shares are parts of.
SMOOTHING, WHOLE = 5, 1_000_000_000
TOP_TERMS = 50
#: Different (document, chunk) pairs from which a block is closed.
BLOCK_ENTRIES = 2_000_000
#: Characters that are cut at a time, and (document, chunk) pairs of a block that are spelled out in terms at a time.
SLICE_CHARS, SLICE_ENTRIES = 1_000_000, 250_000

BLOCK_COLUMNS = ["block", "chunks", "holders", "langs", "sources", "doc_group", "doc_size", "low", "high", "counts"]
BLOCK = (
    "block long, chunks array<string>, holders array<int>, langs array<string>, sources array<string>, doc_group array<int>, doc_size array<int>,"
    " low array<smallint>, high array<smallint>, counts array<int>"
)
TERM_ROWS = "lang string, term string, docs int, at array<int>, n array<int>"


class _Block:
    """Documents whose chunks are counted: chunks, groups and documents have numbers."""

    def __init__(self):
        self.chunks: dict[bytes, int] = {}
        self.groups: dict[tuple[str, str], int] = {}
        self.doc_group, self.doc_size, self.ids, self.counts, self.entries = [], [], [], [], 0

    def add(self, langs: list[str], sources: list[str], bodies: list[str]) -> None:
        flat, bounds, distinct = numbered([utf8(body).split() for body in bodies])
        number = self.chunks.setdefault
        own = np.fromiter((number(c, len(self.chunks)) for c in distinct), dtype=np.int64, count=len(distinct))
        doc = np.repeat(np.arange(len(bodies)), np.diff(bounds))
        pairs, counts = np.unique(doc << 32 | own[flat] if len(flat) else doc, return_counts=True)
        self.doc_group.append(np.asarray([self.groups.setdefault(g, len(self.groups)) for g in zip(langs, sources, strict=True)]))
        self.doc_size.append(np.bincount(pairs >> 32, minlength=len(bodies)))
        self.ids.append((pairs & 0xFFFFFFFF).astype(np.int32))
        self.counts.append(counts.astype(np.int32))
        self.entries += len(pairs)

    def row(self, number: int) -> pa.RecordBatch:
        """The block as one row. Chunk numbers rise within a document; their steps are kept, as two short numbers."""
        langs, sources = zip(*self.groups, strict=True)
        names = pa.array(list(self.chunks), pa.binary()).cast(pa.string())
        ids = np.concatenate(self.ids)
        steps = np.diff(ids, prepend=np.int32(0)).astype(np.int32).view(np.int16).reshape(-1, 2)
        whole = [pa.array(np.concatenate(x).astype(np.int32)) for x in (self.doc_group, self.doc_size, self.counts)]
        short = [pa.array(np.ascontiguousarray(steps[:, i])) for i in (0, 1)]
        holders = pa.array(np.bincount(ids, minlength=len(names)).astype(np.int32))
        lists = [names, holders, pa.array(langs, pa.string()), pa.array(sources, pa.string()), *whole[:2], *short, whole[2]]
        arrays = [pa.array([number]), *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists)]
        return pa.RecordBatch.from_arrays(arrays, BLOCK_COLUMNS)


def _chunk_numbers(low: pa.Array, high: pa.Array) -> np.ndarray:
    steps = np.stack([low.to_numpy(zero_copy_only=False), high.to_numpy(zero_copy_only=False)], axis=1).astype(np.int16)
    return np.cumsum(np.ascontiguousarray(steps).view(np.int32).ravel(), dtype=np.int32)


def chunk_blocks(docs: DataFrame, entries: int = BLOCK_ENTRIES) -> DataFrame:
    """The chunks of all documents, counted per document, a row for each block of documents."""
    ship(docs.sparkSession)
    columns = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, first = _Block(), TaskContext.get().partitionId() << 32
        for groups, bodies in slices(batches, SLICE_CHARS):
            block.add([g["lang"] for g in groups], [g["source"] for g in groups], bodies)
            if block.entries >= entries:
                yield block.row(first)
                block, first = _Block(), first + 1
        if block.groups:
            yield block.row(first)

    shaped = docs.select(*columns).select(F.struct("lang", "source").alias("doc_id"), "text")
    return shaped.mapInArrow(count, BLOCK)


def stored_blocks(blocks: DataFrame) -> DataFrame:
    """What `chunk_blocks` returns, settled. A block is a row group of its own, so that one at a time is held by who writes or reads them."""
    return settle(blocks, "chunk-blocks", **{"compression": "zstd", "parquet.block.row.count.limit": "1"})


def held_chunks(blocks: DataFrame) -> DataFrame:
    """`chunk` and `holders` for every chunk of each block, both read in place: no pair is built for a chunk."""
    placed = blocks.select("holders", F.posexplode("chunks").alias("pos", "chunk"))
    return placed.select("chunk", F.get("holders", F.col("pos")).alias("holders"))


def chunk_terms(chunks: DataFrame, min_documents: int) -> DataFrame:
    """`chunk`, `term` and how often it is in there (`k`); every distinct chunk is cut once.

    Given `chunk` and `holders` (documents of a block that hold it). Terms that
    cannot be in `min_documents` documents are left out: no more documents hold a
    term than hold one of its chunks.
    """
    distinct = chunks.groupBy("chunk").agg(F.sum("holders").alias("holders"))
    cut = F.regexp_extract_all(F.translate("chunk", _UPPER, _LOWER), F.lit(TERM), F.lit(0))
    terms = distinct.select("chunk", "holders", cut.alias("terms")).where(F.size("terms") > 0)
    each = terms.select("chunk", "holders", "terms", F.explode(F.array_distinct("terms")).alias("term"))
    each = each.select("chunk", "holders", "term", F.expr("size(filter(terms, t -> t = term))").alias("k"))
    at_most = F.sum("holders").over(Window.partitionBy("term"))
    return each.withColumn("at_most", at_most).where(F.col("at_most") >= min_documents).select("chunk", "term", "k")


def source_places(blocks: DataFrame) -> DataFrame:
    """`lang`, `source` and `at`, the place of the source among those of its language, for every group of documents."""
    groups = blocks.select(F.explode(F.arrays_zip("langs", "sources")).alias("g")).select(F.col("g.langs").alias("lang"), F.col("g.sources").alias("source"))
    order = Window.partitionBy("lang").orderBy("source")
    return groups.distinct().withColumn("at", F.row_number().over(order) - 1)


def block_terms(blocks: DataFrame, terms: DataFrame, places: DataFrame) -> DataFrame:
    """`lang`, `term` of each block with `docs` that hold it, and the places `at` of the sources that do with their occurrences `n`."""
    chunks = blocks.select(F.col("block").alias("of_block"), F.posexplode("chunks").alias("pos", "chunk"))
    found = chunks.join(terms, "chunk").select("of_block", "pos", "term", "k")
    groups = blocks.select("block", F.posexplode(F.arrays_zip("langs", "sources")).alias("nth", "g"))
    groups = groups.select("block", "nth", F.col("g.langs").alias("lang"), F.col("g.sources").alias("source")).join(places, ["lang", "source"])
    numbered = groups.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("nth", "at"))).alias("groups"))
    counted = blocks.drop("chunks", "holders", "sources").join(numbered.select("block", F.col("groups.at").alias("places")), "block")
    return counted.groupBy("block").cogroup(found.groupBy("of_block")).applyInArrow(_block_terms, TERM_ROWS)


def _block_terms(counted: pa.Table, found: pa.Table) -> pa.Table:
    kinds = [pa.string(), pa.string(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    schema = pa.schema(list(zip(["lang", "term", "docs", "at", "n"], kinds, strict=True)))
    if not counted.num_rows or not found.num_rows:
        return schema.empty_table()
    column = {c: counted.column(c).combine_chunks().flatten() for c in counted.column_names if c != "block"}
    doc_group, doc_size, counts = (column[c].to_numpy() for c in ("doc_group", "doc_size", "counts"))
    ids = _chunk_numbers(column["low"], column["high"])
    spelled = found.column("term").combine_chunks().dictionary_encode()
    pos = found.column("pos").to_numpy()
    order = np.argsort(pos, kind="stable")  # the terms of a chunk stand together
    codes, times, n_terms = spelled.indices.to_numpy()[order], found.column("k").to_numpy()[order], len(spelled.dictionary)
    size = np.bincount(pos, minlength=int(ids.max(initial=0)) + 1).astype(np.int32)
    first = np.cumsum(size, dtype=np.int32) - size
    langs, places = column["langs"].to_pylist(), column["places"].to_numpy().astype(np.int32)
    names = sorted(set(langs))
    lang_of = np.asarray([names.index(x) for x in langs], dtype=np.int64)
    ends, parts, doc = np.cumsum(doc_size, dtype=np.int64), [], 0
    while doc < len(doc_size):  # some documents at a time, as two of these tasks share an executor
        start = int(ends[doc - 1]) if doc else 0
        last = max(doc + 1, int(np.searchsorted(ends, start + SLICE_ENTRIES, side="right")))
        own = slice(start, int(ends[last - 1]))
        each = size[ids[own]]
        at = np.repeat(first[ids[own]] - np.cumsum(each, dtype=np.int32) + each, each)
        at += np.arange(len(at), dtype=np.int32)
        n = np.repeat(counts[own], each) * times[at]
        key = np.repeat(np.repeat(np.arange(last - doc), doc_size[doc:last]), each) * n_terms + codes[at]
        # a document counts once for a term, however many of its chunks hold the term
        key, n = _added(key, n)
        group, term = doc_group[doc + key // n_terms].astype(np.int64), key % n_terms
        parts.append(_added((lang_of[group] * n_terms + term) * len(langs) + group, n, count=True))
        doc = last
    key, n, docs = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(key, kind="stable")
    key, n, docs = key[order], n[order], docs[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, dtype=np.int64)
    n, docs = (np.add.reduceat(x, starts) if len(x) else x for x in (n, docs))
    key = key[starts]
    row, starts = np.unique(key // len(langs), return_index=True)
    offsets = pa.array(np.append(starts, len(key)), pa.int32())
    columns = [
        pa.array(names, pa.string()).take(pa.array(row // n_terms)),
        spelled.dictionary.take(pa.array(row % n_terms)),
        pa.array(np.add.reduceat(docs, starts) if len(docs) else docs, pa.int32()),
        pa.ListArray.from_arrays(offsets, pa.array(places[key % len(langs)])),
        pa.ListArray.from_arrays(offsets, pa.array(n, pa.int32())),
    ]
    return pa.Table.from_arrays(columns, schema=schema)


def _added(key: np.ndarray, n: np.ndarray, count: bool = False) -> tuple[np.ndarray, ...]:
    """Distinct keys with the sums of their `n`, and how many rows each has."""
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    del order
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, dtype=np.int64)
    sums = np.add.reduceat(n, starts) if len(n) else n
    return (key[starts], sums, np.diff(starts, append=len(n))) if count else (key[starts], sums)


def term_counts(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """Two settled tables: `lang`, `term`, `total`, `of` (at, n) of the kept terms, and `source_places`."""
    blocks = stored_blocks(chunk_blocks(docs))
    terms = settle(chunk_terms(held_chunks(blocks), min_documents), "chunk-terms", compression="zstd")
    forget(docs.sparkSession)
    places = settle(source_places(blocks), "source-places")
    forget(docs.sparkSession)  # the shuffle files of the terms are free once the collector has been round again
    # dealt by term once; both groupings and the choice of terms follow that dealing
    dealt = block_terms(blocks, terms, places).repartition("lang", "term")
    each = dealt.select("lang", "term", "docs", F.posexplode(F.arrays_zip("at", "n")).alias("nth", "o"))
    by_source = each.groupBy("lang", "term", F.col("o.at").alias("at")).agg(
        F.sum("o.n").alias("n"), F.sum(F.when(F.col("nth") == 0, F.col("docs"))).alias("docs")
    )
    by_term = by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("at", "n")).alias("of")
    )
    kept = settle(by_term.where(F.col("docs") >= min_documents).drop("docs"), "kept-terms")
    for done in (blocks, terms):
        discard(done)
    return kept, places


def _share(count: str, n: str, v: str) -> str:
    """SQL of 1 + floor(WHOLE * (count + 5) / (n + 5 * v)), exact for any count of a long."""
    above = f"(cast({count} as decimal(20,0)) + {SMOOTHING}) * {WHOLE}"
    return f"1 + ({above}) div (cast({n} as decimal(20,0)) + {SMOOTHING} * cast({v} as decimal(18,0)))"


def source_divergence(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Per `lang` and `source`: how far each other source differs, and the terms it uses more than its language.

    Rows have `part` (`pair` or `term`), `item` (other source or term), `value`
    and `rank` (from 1, by falling value, then item in UTF-8 order). A share is
    p = 1 + floor(10^9 (count + 5) / (N + 5 V)) over the V terms that at least
    `min_documents` documents of the language hold. Pairs sum |p - q| over all of
    them, 0 if there are none; terms have value p - q, where q is the share in
    the whole language, and end at `top_terms`.

    NULL text, language or source reads as empty. Every row is a document of its
    own, repeated rows and those with a NULL id too. An empty table gives no
    rows, a source that is alone in its language no pairs. Other columns are not
    read. Eager: the terms are counted when called.
    """
    kept, places = term_counts(docs, min_documents)
    used = kept.select("lang", "term", "total", F.explode("of").alias("o")).select("lang", "term", "total", "o.at", "o.n")
    sizes = used.groupBy("lang", "at").agg(F.sum("n").alias("n_group"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
    named = places.join(sizes, ["lang", "at"], "left").join(langs, "lang", "left").na.fill(0)
    named = settle(named, "source-sizes")
    return _pairs(kept, named).unionByName(_terms(used, named, top_terms))


def _terms(used: DataFrame, named: DataFrame, top: int) -> DataFrame:
    shares = used.join(named, ["lang", "at"]).withColumns({"p": F.expr(_share("n", "n_group", "v")), "q": F.expr(_share("total", "n_lang", "v"))})
    found = shares.where("n > 0 and p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return _ranked(found).where(F.col("rank") <= top)


def _pairs(kept: DataFrame, named: DataFrame) -> DataFrame:
    each = named.groupBy("lang", "v").agg(F.array_sort(F.collect_list(F.struct("at", "n_group"))).alias("sizes"))
    counts = kept.select("lang", F.map_from_entries("of").alias("of")).join(each, "lang")
    share = _share("coalesce(try_element_at(of, s.at), 0)", "s.n_group", "v")
    values = counts.select("lang", F.expr(f"transform(sizes, s -> {share})").alias("p"))
    apart = values.mapInArrow(_differences, "lang string, a int, b int, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    left = named.select("lang", F.col("at").alias("a"), "source")
    right = named.select("lang", F.col("at").alias("b"), F.col("source").alias("item"))
    every = left.join(right, "lang").where("a <> b")
    summed = every.join(apart, ["lang", "a", "b"], "left")
    return _ranked(summed.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value")))


def _ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return found.withColumn("rank", F.row_number().over(order))


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of |p_a - p_b| over the terms of a task, for every two sources of a language."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, shares = np.asarray(batch.column("lang").to_pylist(), dtype=object), batch.column("p")
        for lang in dict.fromkeys(langs):
            p = shares.filter(pa.array(langs == lang))
            p = p.flatten().to_numpy().astype(np.int64).reshape(len(p), -1)
            total = sums.setdefault(lang, np.zeros((p.shape[1],) * 2, dtype=np.int64))
            for a in range(p.shape[1]):
                total[a] += np.abs(p - p[:, [a]]).sum(axis=0)
    for lang, total in sums.items():
        a, b = np.nonzero(~np.eye(len(total), dtype=bool))
        arrays = [pa.array([lang] * len(a), pa.string()), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(total[a, b])]
        yield pa.RecordBatch.from_arrays(arrays, ["lang", "a", "b", "value"])
