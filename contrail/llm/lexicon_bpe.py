"""Encoding and decoding by byte-pair merges, with frequent words in a transducer.

The corpus' words are counted, the most frequent ones are compiled with their
ids into a minimal acyclic transducer, and the file is mapped by every worker.
Words that it does not know are merged pair by pair, exactly as the merge list
says. A word is a piece of text between single blanks, with the blank before it:
the splitting pattern never joins anything over such a blank.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.llm.common import ship, slices, texts
from contrail.llm.tokens import tokenizer_path
from contrail.llm.transducer import Transducer, compile_words
from contrail.session import discard, scratch_path, settle, write_bytes

#: Words in the transducer at most, their bytes, and how often each must occur; all others are merged.
LEXICON_WORDS = 100_000
WORD_BYTES = 64
FREQUENT = 5
#: Merged words that a worker remembers, and distinct words that a counting task holds.
REMEMBERED_WORDS = 800_000
COUNTED_WORDS = 500_000
#: Characters of text that a task has in hand at once.
SLICE_CHARS = 4_000_000
#: Bytes from which a piece is merged on its own.
LONG_PIECE = 64
_NEVER = 2**62

# Fixed value: the splitting pattern of the vocabulary, with white space as Unicode defines it.
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
_TOUCHING = re.compile(r"\s\s")
_SAFE_BLANK = re.compile(r"(?<!\s) (?!\s)")


def byte_names() -> dict[str, int]:
    """The printable character by which the vocabulary names each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class MergeList:
    """A tokenizer file's vocabulary and merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        names, model = byte_names(), spec["model"]
        vocabulary = model["vocab"]
        self.added = added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_pattern = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        size = max([*vocabulary.values(), *added.values()]) + 1
        self.bytes_of = [b""] * size
        for name, i in vocabulary.items():
            self.bytes_of[i] = bytes(names[c] for c in name)
        for name, i in added.items():
            self.bytes_of[i] = bytes(names[c] for c in name) if all(c in names for c in name) else name.encode()
        self.of_byte = [0] * 256
        for name, b in names.items():
            self.of_byte[b] = vocabulary[name]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = {(vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(pairs)}

        self.pair_keys, order = np.unique([a << 32 | b for a, b in self.merges], return_index=True)
        merges = np.asarray(list(self.merges.values()), dtype=np.int64)[order]
        self.pair_ranks, self.pair_ids = np.append(merges[:, 0], _NEVER), np.append(merges[:, 1], -1)
        self.byte_ids = np.asarray(self.of_byte, dtype=np.int64)

    def merged(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece: in each the merge of the lowest rank first, the leftmost of equals.

        One round makes one merge in every piece that has one left. Long pieces
        go one by one, as a round for each of their merges would cost too much.
        """
        short = [p for p in pieces if 0 < len(p) <= LONG_PIECE]
        sizes = np.fromiter(map(len, short), dtype=np.int64, count=len(short))
        ids = self.byte_ids[np.frombuffer(b"".join(short), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(short)), sizes)
        done_ids, done_owners = [ids[:0]], [owner[:0]]
        while len(ids):
            found = self._find(ids[:-1] << 32 | ids[1:])
            found[owner[:-1] != owner[1:]] = len(self.pair_keys)
            found = np.append(found, len(self.pair_keys))
            ranks = self.pair_ranks[found]
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lengths = np.diff(starts, append=len(ids))
            best = np.repeat(np.minimum.reduceat(ranks, starts), lengths)
            ended = best == _NEVER
            done_ids.append(ids[ended])
            done_owners.append(owner[ended])
            at = np.flatnonzero((ranks == best) & ~ended)
            at = at[np.append(True, owner[at[1:]] != owner[at[:-1]])] if len(at) else at  # the leftmost of each piece
            ids[at] = self.pair_ids[found[at]]
            keep = ~ended
            keep[at + 1] = False
            ids, owner = ids[keep], owner[keep]
        owner = np.concatenate(done_owners)
        order = np.argsort(owner, kind="stable")
        flat = np.concatenate(done_ids)[order].tolist()
        bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(short)))]).tolist()
        merged = iter([flat[a:b] for a, b in zip(bounds, bounds[1:])])
        return [[] if not p else next(merged) if len(p) <= LONG_PIECE else self._merged_by_queue(p) for p in pieces]

    def _find(self, pairs: np.ndarray) -> np.ndarray:
        """The place of each pair among the merges, their number for those that are none."""
        at = np.minimum(np.searchsorted(self.pair_keys, pairs), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == pairs, at, len(self.pair_keys))

    def _merged_by_queue(self, piece: bytes) -> list[int]:
        """The same for one long piece, in n log n steps."""
        ids = [self.of_byte[b] for b in piece]
        after, before = [*range(1, len(ids)), -1], list(range(-1, len(ids) - 1))
        queue = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(len(ids) - 1) if (m := self.merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        while queue:
            _, i, a, b, into = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # one of the two has gone into another merge
            ids[i], ids[j], after[i] = into, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (m := self.merges.get((ids[left], ids[right]))):
                    heapq.heappush(queue, (m[0], left, ids[left], ids[right], m[1]))
        return [i for i in ids if i >= 0]

    def encoded(self, words: list[str]) -> list[list[int]]:
        """The ids of each word, cut by the splitting pattern and merged."""
        cut = [PATTERN.findall(word) for word in words]
        distinct = list(set(chain.from_iterable(cut)))
        ids = dict(zip(distinct, self.merged([piece.encode("utf-8") for piece in distinct]), strict=True))
        return [list(chain.from_iterable(map(ids.__getitem__, pieces))) for pieces in cut]

    def decoded(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def pieces(text: str) -> list[str]:
    """A text cut at its safe blanks; all but the first piece stand for a blank and themselves."""
    return _SAFE_BLANK.split(text) if _TOUCHING.search(text) else text.split(" ")


class LexiconEncoder:
    """Encodes texts with a merge list and, for the words that it knows, a transducer.

    Words met are remembered with their ids in flat arrays, up to a limit; then all are forgotten.
    """

    def __init__(self, merges: MergeList, lexicon: Transducer | None, remembered: int = REMEMBERED_WORDS):
        self.merges, self.lexicon, self.limit = merges, lexicon, remembered
        self._forget()

    def _forget(self) -> None:
        self.begins: dict[str, int] = {}  # pieces that begin a text, by themselves
        self.follows: dict[str, int] = {}  # pieces after a blank, without it
        self.bounds, self.ids = np.zeros(1, dtype=np.int64), np.empty(0, dtype=np.int32)
        self.names = dict(zip(self.merges.added, self._remember([[i] for i in self.merges.added.values()]), strict=True))

    def _remember(self, ids: list[list[int]]) -> range:
        """Places of new entries with these ids."""
        first = len(self.bounds) - 1
        ends = self.bounds[-1] + np.cumsum(np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)))
        self.bounds = np.concatenate([self.bounds, ends])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(self.bounds[-1]) - len(self.ids))])
        return range(first, first + len(ids))

    def _learn(self, words: list[str]) -> range:
        """Find words in the transducer, and merge those that it does not know."""
        known = self.lexicon.look_up([w.encode("utf-8") for w in words]) if self.lexicon else [None] * len(words)
        merged = iter(self.merges.encoded([w for w, ids in zip(words, known, strict=True) if ids is None]))
        return self._remember([next(merged) if ids is None else ids for ids in known])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; names of added tokens are those tokens."""
        if len(self.bounds) > self.limit:
            self._forget()
        cut = [[(pieces(part), then) for part, then in self.around_added(text)] for text in texts]
        first = list({p[0] for parts in cut for p, _ in parts}.difference(self.begins))
        later = list(set(chain.from_iterable(p[1:] for parts in cut for p, _ in parts)).difference(self.follows))
        self.begins.update(zip(first, self._learn(first), strict=True))
        self.follows.update(zip(later, self._learn([" " + w for w in later]), strict=True))
        find, at, counts = self.follows.__getitem__, [], []
        for parts in cut:
            before = len(at)
            for p, then in parts:
                at.append(self.begins[p[0]])
                at.extend(map(find, p[1:]))
                if then:
                    at.append(self.names[then])
            counts.append(len(at) - before)
        places = np.asarray(at, dtype=np.int64)
        sizes = self.bounds[places + 1] - self.bounds[places]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.bounds[places] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        return np.split(ids, np.append(0, ends)[np.cumsum(counts)[:-1]]) if texts else []

    def around_added(self, text: str) -> list[tuple[str, str]]:
        """Stretches of ordinary text, each with the name of the added token that follows it."""
        found = self.merges.added_pattern and list(self.merges.added_pattern.finditer(text))
        if not found:
            return [(text, "")]
        starts, ends = [0, *(m.end() for m in found)], [*(m.start() for m in found), len(text)]
        return [(text[a:b], name) for a, b, name in zip(starts, ends, [*(m[0] for m in found), ""], strict=True)]


@cache
def merge_list(path: str) -> MergeList:
    """One merge list for each Python worker."""
    return MergeList(path)


@cache
def _encoder(path: str, lexicon: str) -> LexiconEncoder:
    return LexiconEncoder(merge_list(path), Transducer(SparkFiles.get(lexicon)))


def word_counts(docs: DataFrame, tokenizer_file: str | None = None) -> DataFrame:
    """`word`, `n`: how often each word occurs in all texts, with the blank before it if it has one."""
    path = tokenizer_file or tokenizer_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, first, later = LexiconEncoder(merge_list(path), None), Counter(), Counter()
        for _, bodies in slices(batches, SLICE_CHARS):
            for text, _ in chain.from_iterable(map(encoder.around_added, bodies)):
                words = pieces(text)
                first[words[0]] += 1
                later.update(words[1:])
            if len(first) + len(later) > COUNTED_WORDS:
                yield _counted(first, later)
        yield _counted(first, later)

    return texts(docs).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(first: Counter, later: Counter) -> pa.RecordBatch:
    words = [*first, *(" " + w for w in later)]
    counts = [*first.values(), *later.values()]
    first.clear()
    later.clear()
    return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])


def build_lexicon(docs: DataFrame, tokenizer_file: str | None = None, words: int = LEXICON_WORDS, frequent: int = FREQUENT) -> str:
    """Compile the most frequent words of a corpus; returns the file's name among the application's files.

    Counts of counts give the least count at which no more than `words` words are
    left; only these reach the driver, of at most 64 bytes each. The file lies in
    the shared folder; every executor, also one that joins later, fetches it once.
    """
    spark = docs.sparkSession
    merges = merge_list(tokenizer_file or tokenizer_path())
    fits = F.octet_length("word").between(1, WORD_BYTES) & (F.col("n") >= frequent)
    counted = settle(word_counts(docs, tokenizer_file).where(fits), "word-counts")
    at_least = F.sum("words").over(Window.orderBy(F.desc("n")))
    steps = counted.groupBy("n").agg(F.count("*").alias("words")).withColumn("at_least", at_least)  # a row per count
    least = steps.where(F.col("at_least") <= words).agg(F.min("n")).first()[0]
    top = [r.word for r in counted.where(F.col("n") >= F.lit(least)).select("word").collect()]
    discard(counted)
    return share(spark, compile_words((w.encode("utf-8"), tuple(ids)) for w, ids in zip(top, merges.encoded(top), strict=True)))


def share(spark: SparkSession, compiled: bytes) -> str:
    path = scratch_path(spark, "lexicon") + ".bin"
    write_bytes(spark, path, compiled)
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]


def encode_documents(docs: DataFrame, tokenizer_file: str | None = None, lexicon: str | None = None, words: int = LEXICON_WORDS) -> DataFrame:
    """`doc_id`, `ids` (array of int) and `decoded` (text of those ids) for every row of `docs`.

    The ids are those of the tokenizer file with `add_special_tokens=False`, also
    for names of special tokens in a text. NULL and empty texts have no ids.
    Repeated rows and rows with a NULL id stay as they are; an empty table gives
    no rows; other columns are not read. Eager: the lexicon is built when called,
    unless one of `build_lexicon` is given.
    """
    path, run = _encoding(docs, tokenizer_file, lexicon, words)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, encoded, decoded in run(batches):
            columns = [pa.array(ids, pa.int64()), pa.array(encoded, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    return texts(docs).mapInArrow(encode, "doc_id long, ids array<int>, decoded string")


def encoding_digests(docs: DataFrame, tokenizer_file: str | None = None, lexicon: str | None = None, words: int = LEXICON_WORDS) -> DataFrame:
    """`doc_id`, `n_tokens`, `ids_sha256`, `decoded_sha256` of what `encode_documents` gives, row for row."""
    path, run = _encoding(docs, tokenizer_file, lexicon, words)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal = list(map(str, range(len(merge_list(path).bytes_of))))
        for ids, encoded, decoded in run(batches):
            written = [",".join(map(decimal.__getitem__, e)) for e in encoded]
            columns = [
                pa.array(ids, pa.int64()),
                pa.array(list(map(len, encoded)), pa.int64()),
                pa.array([hashlib.sha256(w.encode()).hexdigest() for w in written], pa.string()),
                pa.array([hashlib.sha256(d.encode("utf-8")).hexdigest() for d in decoded], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts(docs).mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _encoding(docs: DataFrame, tokenizer_file: str | None, lexicon: str | None, words: int):
    ship(docs.sparkSession)
    path = tokenizer_file or tokenizer_path()
    lexicon = lexicon or build_lexicon(docs, tokenizer_file, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
        encoder = _encoder(path, lexicon)
        for ids, bodies in slices(batches, SLICE_CHARS):
            encoded = [e.tolist() for e in encoder.encode(bodies)]
            yield ids, encoded, list(map(encoder.merges.decoded, encoded))

    return path, run
