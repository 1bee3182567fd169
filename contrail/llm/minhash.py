"""Near-duplicate groups by SuperMinHash signatures, banding, verification and union-find.

A SuperMinHash value of a slot is the least (rank + random fraction) among the
elements, where each element ranks the slots by its own random permutation. The
ranks of one element differ between slots, so signatures vary less than with
independent hashes; and ranks are dealt in rising order, so a set is finished as
soon as all its slots hold a lower rank than the next one: large sets after one
draw for each element.

Documents with the same set are one class. Classes that agree on a band are
candidates. Where buckets are large, all members are first compared with one hub
of the bucket, in rounds with other hubs, and linked ones are merged. Classes
that this leaves in different groups are mostly versions of one text, each too
far from it: they meet by what they do not share with a hub (`unlike_hub`).
Every link is confirmed on the full sets of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import discard_all, fmix, numbered, slices, texts, utf8
from contrail.llm.grouping import linked_groups
from contrail.session import settle

SHINGLE_WORDS = 5
PERCENT = 80
#: 40 bands of 5 slots: a pair of similarity 0.8 is missed by all bands with probability 1.3e-7.
BANDS, ROWS = 40, 5
#: A pair goes on to its texts if so many standard deviations below the expected number of equal slots.
DEVIATIONS = 7
#: A round merges what is linked to the best connected member of a bucket; `unlike_hub` is quick with all the rest.
HUB_ROUNDS = 1

_STEP = np.uint64(0x9E3779B97F4A7C15)
SKETCH = "doc_id long, n_shingles long, set_key binary, bands array<long>, slots binary"


def words(text: str) -> list[bytes]:
    """Words of a text: A-Z lower-cased, cut at ASCII white space."""
    return utf8(text).lower().split()


def shingle_set(text: str, size: int) -> set[tuple[bytes, ...]]:
    """Distinct runs of `size` words; the whole sequence if there are fewer; none without words."""
    ws = words(text)
    if not ws:
        return set()
    return set(zip(*(ws[i:] for i in range(size)), strict=False)) if len(ws) >= size else {tuple(ws)}


def shingle_hashes(lists: list[list[bytes]], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each word list."""
    flat, bounds, distinct = numbered(lists)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), dtype=np.uint64, count=len(distinct))[flat]
    out = []
    rolled = np.zeros(max(0, len(flat) - size + 1), dtype=np.uint64)
    for i in range(size):
        rolled = fmix(rolled * _STEP + hashes[i : i + len(rolled)] + np.uint64(1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            whole = np.zeros(1, dtype=np.uint64)
            for i in range(a, b):
                whole = fmix(whole * _STEP + hashes[i : i + 1] + np.uint64(1))
            out.append(whole)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def superminhash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """Signatures, one row per set: rank in the high byte, a random fraction below; all ones for an empty set."""
    signature = np.full(len(sets) * slots, np.iinfo(np.uint64).max, dtype=np.uint64)
    element = np.concatenate([*sets, np.zeros(0, dtype=np.uint64)])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = None  # each element's permutation so far, from the second rank on
    for rank in range(slots):
        if not len(element):
            break
        random = fmix(element + np.uint64((rank + 1) * int(_STEP) % 2**64))
        pick = rank + ((random & np.uint64(0xFFFFFFFF)) * np.uint64(slots - rank) >> np.uint64(32)).astype(np.int64)
        if order is None:
            slot = pick
        else:
            row = np.arange(len(element))
            slot = order[row, pick].astype(np.int64)
            order[row, pick] = order[row, rank]
        np.minimum.at(signature, owner * slots + slot, (np.uint64(rank) << np.uint64(56)) | (fmix(random) >> np.uint64(8)))
        open_ = (signature.reshape(-1, slots) >= np.uint64(rank + 1) << np.uint64(56)).any(axis=1)
        stays = open_[owner]
        element, owner = element[stays], owner[stays]
        if order is None:
            order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(element), 1))
            order[np.arange(len(element)), pick[stays]] = 0
        else:
            order = order[stays]
    return signature.reshape(len(sets), slots)


def sketches(docs: DataFrame, size: int = SHINGLE_WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Set size, set fingerprint, band keys and one byte per slot for each row of `doc_id`, `text`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, bodies in slices(batches, 1_000_000):
            sets = shingle_hashes([words(t) for t in bodies], size)
            signature = superminhash(sets, bands * rows)
            cut = signature.reshape(len(sets), bands, rows)
            keys = np.broadcast_to(fmix(np.arange(1, bands + 1, dtype=np.uint64)), (len(sets), bands))
            for i in range(rows):
                keys = fmix(keys * _STEP + cut[:, :, i])
            low = (signature & np.uint64(0xFF)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * bands, pa.array(keys.astype(np.int64).ravel())),
                    pa.array([r.tobytes() for r in low], pa.binary()),
                ],
                [c.split()[0] for c in SKETCH.split(", ")],
            )

    return docs.mapInArrow(run, SKETCH)


def near_duplicates(
    docs: DataFrame,
    size: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    hub_rounds: int = HUB_ROUNDS,
) -> DataFrame:
    """Groups of documents linked by similar sets of word shingles, one row per row of `docs`.

    Two documents are linked if 100 times their common shingles reach `percent`
    times all their shingles. Columns: `doc_id`, `n_shingles`, `component_id`
    (smallest id reachable over links), `kept` (it is the own id). NULL and
    empty texts have no shingles and no links. Rows with a NULL id get a NULL
    component unless a copy has an id, and are kept then. Repeated rows are
    members of one class. Eager: the rounds run when called.
    """
    docs = texts(docs)
    sketched = settle(sketches(docs, size, bands, rows), "sketches")
    filled = sketched.where("n_shingles > 0")
    classes = filled.groupBy("set_key", "n_shingles", "bands", "slots").agg(F.min("doc_id").alias("class_id")).where("class_id is not null")
    classes = settle(classes, "classes")
    exploded = classes.select(F.explode("bands").alias("band"), F.col("class_id").alias("doc"))
    shared = exploded.groupBy("band").count().where("count > 1").select("band")
    members = settle(exploded.join(shared, "band"), "buckets")
    involved = settle(members.select("doc").distinct(), "candidates")
    facts = settle(
        involved.join(docs.withColumnRenamed("doc_id", "doc"), "doc")
        .dropDuplicates(["doc"])
        .join(classes.select(F.col("class_id").alias("doc"), F.col("n_shingles").alias("n"), "slots"), "doc"),
        "candidate-texts",
    )
    _, grouped = linked_groups(
        members,
        facts.select("doc", "n"),
        f"100 * least(n, n_b) >= {percent} * greatest(n, n_b)",
        lambda pairs: confirmed(pairs, facts, size, percent, bands * rows),
        hub_rounds,
        lambda around: unlike_hub(around, facts, size, percent),
    )
    discard_all(members, involved, facts)
    grouped = grouped.select(F.col("node").alias("class_id"), "component")
    classes = classes.select("set_key", "class_id").join(grouped, "class_id", "left")
    return (
        sketched.join(classes, "set_key", "left")
        .withColumn("component_id", F.coalesce("component", "class_id", "doc_id"))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def confirmed(pairs: DataFrame, facts: DataFrame, size: int, percent: int, slots: int) -> DataFrame:
    """The pairs `a`, `b` whose full sets are similar enough.

    Set sizes and signature bytes rule out most of the others before any text moves.
    """
    share = percent / 100
    least = int(slots * share - DEVIATIONS * (slots * share * (1 - share)) ** 0.5)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, slots) for c in ("slots_a", "slots_b"))
            near = (a == b).sum(axis=1) >= least
            yield batch.select(["a", "b"]).filter(pa.array(near))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for batch in batches:
            found = []
            for b, x, y in zip(batch.column("b").to_pylist(), batch.column("text_a"), batch.column("text_b"), strict=True):
                if b != last:
                    last, own = b, shingle_set(y.as_py(), size)
                other = shingle_set(x.as_py(), size)
                common = len(own & other)
                found.append(100 * common >= percent * (len(own) + len(other) - common))
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    a = facts.select(*(F.col(c).alias(f"{c}_a") for c in ("doc", "n", "slots")))
    b = facts.select(*(F.col(c).alias(f"{c}_b") for c in ("doc", "n", "slots")))
    schema = ", ".join(f"{c} long" for c in ("a", "b"))
    sized = pairs.join(a, pairs.a == F.col("doc_a")).join(b, pairs.b == F.col("doc_b")).where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    near = settle(sized.select("a", "b", "slots_a", "slots_b").mapInArrow(close, schema), "close")
    first = facts.select(F.col("doc").alias("a"), F.col("text").alias("text_a"))
    second = facts.select(F.col("doc").alias("b"), F.col("text").alias("text_b"))
    return near.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b").mapInArrow(check, schema)


def unlike_hub(around: DataFrame, facts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs `a`, `b` that may be links, none missing, of different labels that stand around one hub.

    Let D be the shingles in which a set differs from the hub's. Sets x and y are linked if
    they differ in at most (100 - p) / (100 + p) of |x| + |y| shingles, and they differ in
    |Dx| + |Dy| less twice what Dx and Dy share. So Dx and Dy share at least (Ex + Ey) / 2 (100 + p)
    shingles, E being (100 + p) |D| - (100 - p) |set|. That is above 0 unless both are linked
    to the hub, and have its label; then the first shared one, rare ones first, stands among as
    many first ones of either D as leave fewer behind them. What one label has alone comes before
    all others and is no key: in versions of one text that is most of what an edit puts in.
    """
    near, far = 100 + percent, 100 - percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                hubs = dict(zip(part.column("hub").to_pylist(), part.column("text_b").to_pylist(), strict=True))
                hubs = dict(zip(hubs, shingle_hashes([words(t) for t in hubs.values()], size), strict=True))
                sets = shingle_hashes([words(t) for t in part.column("text_a").to_pylist()], size)
                others = [hubs[h] for h in part.column("hub").to_pylist()]
                unlike = [np.setxor1d(x, h, assume_unique=True) for x, h in zip(sets, others, strict=True)]
                counts = [pa.array([len(x) for x in lists], pa.int64()) for lists in (sets, others, unlike)]
                bounds = np.cumsum([0, *(len(x) for x in unlike)]).astype(np.int32)
                elements = pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(unlike).view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in named), *counts, elements], [*named, "n", "n_hub", "m", "elements"])

    named = ["doc", "label", "hub", "hub_label"]
    first = facts.select("doc", F.col("text").alias("text_a"))
    second = facts.select(F.col("doc").alias("hub"), F.col("text").alias("text_b"))
    schema = ", ".join(f"{c} long" for c in (*named, "n", "n_hub", "m")) + ", elements array<long>"
    unlike = settle(around.join(first, "doc").join(second, "hub").select(*named, "text_a", "text_b").mapInArrow(run, schema), "unlike")
    linked = F.expr(f"{near} * m <= {far} * (n + n_hub)")
    own = unlike.withColumns({"old": F.col("label"), "label": F.when(linked, F.col("hub_label")).otherwise(F.col("label"))})
    own = own.withColumns({"out": F.col("label") != F.col("hub_label"), "excess": F.expr(f"{near} * m - {far} * n")})
    direct = own.where("not out and old <> hub_label").select(F.col("doc").alias("a"), F.col("hub").alias("b"))
    lows = own.groupBy("hub").agg(F.min("excess").alias("low"), F.min(F.when(F.col("out"), F.col("excess"))).alias("low_out")).where("low_out is not null")
    shared = "({0} + {1} + " + f"{2 * near - 1}) div {2 * near}"
    least = F.expr(shared.format("excess", "if(out, low, low_out)")).alias("least")
    elements = own.join(lows, "hub").select("hub", "doc", "label", "out", "excess", "m", least, F.explode("elements").alias("element"))
    common = elements.groupBy("hub", "element").agg(F.count("*").alias("f"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    each = Window.partitionBy("hub", "doc")
    place = F.col("m") - F.count("*").over(each) + F.row_number().over(each.orderBy("f", "element")) - 1
    ranked = elements.join(common.select("hub", "element", "f"), ["hub", "element"]).withColumn("place", place)
    keys = settle(ranked.where("place <= m - least").select("hub", "element", "doc", "label", "out", "excess", "m", "place"), "unlike-keys")
    others = keys.select("hub", "element", *(F.col(c).alias(f"{c}_b") for c in keys.columns[2:]))
    both = shared.format("excess", "excess_b")
    met = keys.where("out").join(others, ["hub", "element"])
    met = met.where(f"label <> label_b and (not out_b or doc < doc_b) and place <= m - {both} and place_b <= m_b - {both}")
    pairs = settle(met.select(F.col("doc").alias("a"), F.col("doc_b").alias("b")).unionByName(direct).distinct(), "pairs")
    discard_all(unlike, keys)
    return pairs
