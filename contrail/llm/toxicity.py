"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is its own embedding beside the mean embedding of its character
trigrams, so unseen compounds are known by their parts. Windows of words overlap;
each is read in both directions, its states are pooled by attention, and a text
scores as its most toxic window.

The network is fitted in one task to a bounded sample of labelled documents,
first on all windows, then on each document's most toxic ones as the network
itself sees them (toxic documents are mostly clean). Scoring runs where the
texts are.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import fmix, numbered, slices, texts

WINDOW, STRIDE = 64, 48
HIDDEN, WORD_DIM, CHAR_DIM, ATTENTION = 12, 12, 20, 8
WORD_BUCKETS, CHAR_BUCKETS = 1 << 14, 1 << 13
#: Labelled documents of each class, and their longest text, that the network is fitted to.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 1500, 2500, 20_000
ROUNDS, BATCH, RATE, DECAY = 6, 128, 0.01, 0.1
#: Windows of a kind (toxic, clean that look most toxic, clean at random) in a round of training.
ROUND_WINDOWS = 2000

SCORES = "doc_id long, score double"
_EDGES = b".,;:!?\"'()[]{}<>*_-"


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").split()


class Features(NamedTuple):
    """Inputs of distinct words: a bucket for each, and the buckets of its trigrams, one after the other."""

    word: np.ndarray
    trigram: np.ndarray
    first: np.ndarray
    count: np.ndarray


def features(distinct: list[bytes]) -> Features:
    bare = [w.strip(_EDGES) or w for w in distinct]
    word = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in bare), dtype=np.uint64, count=len(bare)) % np.uint64(WORD_BUCKETS)
    sizes = np.fromiter(map(len, bare), dtype=np.int64, count=len(bare)) + 2  # an edge mark before and behind
    flat = np.frombuffer(b"\x01" + b"\x02\x01".join(bare) + b"\x02", dtype=np.uint8).astype(np.uint64) if bare else np.zeros(0, dtype=np.uint64)
    starts = np.cumsum(sizes) - sizes
    count = sizes - 2
    at = np.repeat(starts - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
    code = flat[at] << np.uint64(16) | flat[at + 1] << np.uint64(8) | flat[at + 2] if len(at) else np.zeros(0, dtype=np.uint64)
    return Features(word.astype(np.int64), (fmix(code + np.uint64(1)) % np.uint64(CHAR_BUCKETS)).astype(np.int64), np.cumsum(count) - count, count)


def windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, words, and document of every window; windows cover each text and overlap."""
    sizes = np.diff(bounds)
    many = np.where(sizes > WINDOW, -(-(sizes - WINDOW) // STRIDE) + 1, np.minimum(sizes, 1))
    doc = np.repeat(np.arange(len(sizes)), many)
    turn = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    first = bounds[:-1][doc] + turn * STRIDE
    return first, np.minimum(WINDOW, bounds[1:][doc] - first), doc


def sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):  # 1 / (1 + inf) is the limit
        y = np.exp(-x)
    y += 1
    return np.reciprocal(y, out=y)


def tanh(x: np.ndarray) -> np.ndarray:
    y = sigmoid(2 * x)
    y *= 2
    y -= 1
    return y


class Network:
    """Parameters with forward and backward passes. Arrays go (time, direction, window, unit)."""

    def __init__(self, seed: int = 7):
        random = np.random.default_rng(seed)
        size, h = WORD_DIM + CHAR_DIM, HIDDEN
        scale = {"word": 0.0, "char": 0.0, "input": size**-0.5, "state": h**-0.5, "attend": (2 * h) ** -0.5, "query": 1.0, "out": 0.3}
        shapes = {"word": (WORD_BUCKETS, WORD_DIM), "char": (CHAR_BUCKETS, CHAR_DIM), "input": (size, 2 * 3 * h), "state": (2, h, 3 * h), "attend": (2 * h, ATTENTION), "query": (ATTENTION,), "out": (2 * h,)}
        self.p = {k: (random.standard_normal(shapes[k]) * scale[k]).astype(np.float32) for k in shapes}
        self.p |= {"gate_bias": np.zeros(2 * 3 * h, np.float32), "attend_bias": np.zeros(ATTENTION, np.float32), "bias": np.zeros(1, np.float32)}

    def inputs(self, f: Features, part: slice) -> np.ndarray:
        """Embeddings of some words."""
        first, count = f.first[part], f.count[part]
        grams = self.p["char"][f.trigram[first[0] : first[-1] + count[-1]]]
        return np.hstack([self.p["word"][f.word[part]], np.add.reduceat(grams, first - first[0]) / count[:, None]])

    def gates(self, f: Features) -> np.ndarray:
        """What each word adds to the gates of either direction."""
        parts = [self.inputs(f, slice(i, i + 20_000)) @ self.p["input"] + self.p["gate_bias"] for i in range(0, len(f.word), 20_000)]
        return np.concatenate([*parts, np.zeros((1, 6 * HIDDEN), np.float32)])  # the last row: no word

    def forward(self, gates: np.ndarray, index: np.ndarray, keep: bool = False):
        """Logits of windows. `index`: (time, window) rows of gates; -1, the last row, after a window's end."""
        h, (steps, many) = HIDDEN, index.shape
        mask = (index >= 0).astype(np.float32)
        full = bool(mask.all())
        x = np.stack([gates[index, : 3 * h], gates[index[::-1], 3 * h :]], axis=1)
        masks = np.stack([mask, mask[::-1]], axis=1)[..., None]
        states = np.zeros((steps + 1, 2, many, h), np.float32)
        saved = []
        for t in range(steps):
            last = states[t]
            own = last @ self.p["state"]
            zr = sigmoid(x[t, :, :, : 2 * h] + own[:, :, : 2 * h])
            z, r = zr[:, :, :h], zr[:, :, h:]
            n = tanh(x[t, :, :, 2 * h :] + r * own[:, :, 2 * h :])
            new = n + z * (last - n)
            states[t + 1] = new if full else new * masks[t]
            if keep:
                saved.append((z, r, n, own[:, :, 2 * h :]))
        both = np.concatenate([states[1:, 0], states[1:, 1][::-1]], axis=-1)
        hidden = tanh(both @ self.p["attend"] + self.p["attend_bias"])
        energy = hidden @ self.p["query"] + (mask - 1) * 1e9
        weight = np.exp(energy - energy.max(axis=0))
        weight *= mask
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pooled = np.einsum("tb,tbh->bh", weight, both)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        return (logit, (index, masks, states, saved, both, hidden, weight, pooled)) if keep else logit

    def backward(self, error: np.ndarray, kept: tuple) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the parameters behind the gates, and of the gates at each (time, direction, window)."""
        index, masks, states, saved, both, hidden, weight, pooled = kept
        h, g = HIDDEN, {}
        g["bias"], g["out"] = error.sum(keepdims=True), error @ pooled
        d_pooled = error[:, None] * self.p["out"]
        d_weight = np.einsum("tbh,bh->tb", both, d_pooled)
        d_energy = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["query"] = np.einsum("tb,tba->a", d_energy, hidden)
        d_hidden = d_energy[..., None] * self.p["query"] * (1 - hidden**2)
        g["attend"] = np.einsum("tbh,tba->ha", both, d_hidden, optimize=True)
        g["attend_bias"] = d_hidden.sum(axis=(0, 1))
        d_both = weight[..., None] * d_pooled + d_hidden @ self.p["attend"].T
        d_states = np.stack([d_both[..., :h], d_both[..., h:][::-1]], axis=1)
        d_gates = np.empty((len(saved), 2, index.shape[1], 3 * h), np.float32)
        g["state"] = np.zeros_like(self.p["state"])
        back = np.zeros_like(states[0])
        for t in range(len(saved) - 1, -1, -1):
            z, r, n, own_n = saved[t]
            d = (d_states[t] + back) * masks[t]
            d_n = d * (1 - z) * (1 - n**2)
            d_own = np.concatenate([d * (states[t] - n) * z * (1 - z), d_n * own_n * r * (1 - r), d_n * r], axis=-1)
            d_gates[t] = np.concatenate([d_own[:, :, : 2 * h], d_n], axis=-1)
            g["state"] += states[t].transpose(0, 2, 1) @ d_own
            back = d * z + d_own @ self.p["state"].transpose(0, 2, 1)
        return g, d_gates


class Trainer:
    """Adam over a network, for windows of a fixed list of texts."""

    def __init__(self, network: Network, lists: list[list[bytes]], rate: float = RATE):
        self.net, self.rate, self.steps = network, rate, 0
        self.flat, bounds, distinct = numbered(lists)
        self.features = features(distinct)
        self.first, self.length, self.doc = windows(bounds)
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}

    def index(self, chosen: np.ndarray) -> np.ndarray:
        return window_index(self.flat, self.first[chosen], self.length[chosen])

    def logits(self) -> np.ndarray:
        gates, out = self.net.gates(self.features), np.empty(len(self.first), np.float32)
        for chosen in in_batches(self.length, 1024):
            out[chosen] = self.net.forward(gates, self.index(chosen))
        return out

    def step(self, chosen: np.ndarray, label: np.ndarray) -> None:
        net, f, h = self.net, self.features, HIDDEN
        index = self.index(chosen)
        used, place = np.unique(index[index >= 0], return_inverse=True)
        count = f.count[used]
        at = np.repeat(f.first[used] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        own = Features(f.word[used], f.trigram[at], np.cumsum(count) - count, count)
        local = np.full(index.shape, -1)
        local[index >= 0] = place
        x = net.inputs(own, slice(None))
        gates = np.concatenate([x @ net.p["input"] + net.p["gate_bias"], np.zeros((1, 6 * h), np.float32)])
        logit, kept = net.forward(gates, local, keep=True)
        g, d = net.backward(((sigmoid(logit) - label) / len(label)).astype(np.float32), kept)
        d_gates = np.zeros_like(gates)
        for way, turned in ((0, local), (1, local[::-1])):
            gather(d_gates[:, way * 3 * h : (way + 1) * 3 * h], turned.ravel(), d[:, way].reshape(-1, 3 * h))
        d_gates = d_gates[:-1]
        g["gate_bias"], g["input"] = d_gates.sum(axis=0), x.T @ d_gates
        d_x = d_gates @ net.p["input"].T
        g["word"], g["char"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["char"])
        gather(g["word"], own.word, d_x[:, :WORD_DIM])
        gather(g["char"], own.trigram, np.repeat(d_x[:, WORD_DIM:] / count[:, None], count, axis=0))
        self.steps += 1
        size = float(np.sqrt(sum(float((v**2).sum()) for v in g.values())))
        for k, (m, v) in self.moments.items():
            grad = g[k].reshape(m.shape) * min(1.0, 5.0 / max(size, 1e-9))
            m += 0.1 * (grad - m)
            v += 0.005 * (grad**2 - v)
            net.p[k] *= 1 - DECAY * self.rate
            net.p[k] -= self.rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.995**self.steps)) + 1e-6)


def gather(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Sums of the values with the same row, put into those rows."""
    order = np.argsort(rows, kind="stable")
    named, starts = np.unique(rows[order], return_index=True)
    into[named] = np.add.reduceat(values[order], starts)


def window_index(flat: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """(time, window) word numbers, -1 after a window's end."""
    column = np.arange(int(length.max()))[:, None]
    return np.where(column < length, flat[np.minimum(first + column, len(flat) - 1)], -1)


def in_batches(length: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Windows of like length together."""
    order = np.argsort(length, kind="stable")
    for at in range(0, len(order), size):
        yield order[at : at + size]


def train(sample: pd.DataFrame, rounds: int = ROUNDS, seed: int = 7) -> Network | float:
    """A network fitted to `text` and `toxic` (0 or 1); without both classes, the constant score."""
    label = sample["toxic"].to_numpy(dtype=np.float32)
    lists = [words(t) for t in sample["text"]]
    label = label[[i for i, ws in enumerate(lists) if ws]]
    lists = [ws for ws in lists if ws]
    if not len(label) or label.min() == label.max():
        return float(label.max()) if len(label) else 0.0
    random, net = np.random.default_rng(seed), Network(seed)
    trainer = Trainer(net, lists)
    toxic = label[trainer.doc] == 1
    alone = toxic & (np.bincount(trainer.doc, minlength=len(label))[trainer.doc] <= 1)
    for turn in range(rounds):
        if turn:
            logits = trainer.logits()
            order = np.lexsort((-logits, trainer.doc))
            top = order[np.unique(trainer.doc[order], return_index=True)[1]]
            positive, clean = top[toxic[top]], np.flatnonzero(~toxic)
            worst = clean[np.argsort(-logits[clean], kind="stable")][:ROUND_WINDOWS]
        else:  # a toxic text of one window is toxic there; longer ones only somewhere
            positive, clean = np.flatnonzero(alone if alone.sum() >= 50 else toxic), np.flatnonzero(~toxic)
            worst = clean[:0]
        if len(positive) > ROUND_WINDOWS:
            positive = random.choice(positive, size=ROUND_WINDOWS, replace=False)
        fill = random.choice(clean, size=min(len(clean), ROUND_WINDOWS), replace=False)
        chosen = np.concatenate([positive, worst, fill])
        trainer.rate = RATE * (1 - turn / rounds)
        for _ in range(max(1, round(30 * BATCH / len(chosen)))):
            random.shuffle(chosen)
            for at in range(0, len(chosen), BATCH):
                part = chosen[at : at + BATCH]
                trainer.step(part, toxic[part].astype(np.float32))
    return net


def labelled_sample(docs: DataFrame, labels: DataFrame, toxic: int, clean: int, chars: int) -> DataFrame:
    """At most `toxic` and `clean` labelled documents of the training folds, those with the smallest id hash."""
    marked = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    known = docs.where(~held_out(F.col("doc_id")) & F.length("text").between(1, chars)).select("doc_id").join(marked, "doc_id")
    parts = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for k, n in ((1, toxic), (0, clean))]
    few = parts[0].unionByName(parts[1])  # bounded by the two limits
    return docs.join(F.broadcast(few), "doc_id")


def fitted(sample: DataFrame) -> Network | float:
    """What `train` makes of the rows, whose number is bounded, in a task: their texts never reach the driver."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"text": [], "toxic": []}), *frames], ignore_index=True)
        yield pd.DataFrame({"network": [pickle.dumps(train(rows))]})

    rows = sample.select("doc_id", "text", "toxic").repartition(1).sortWithinPartitions("doc_id", "text")
    made = rows.mapInPandas(run, "network binary").first()
    return pickle.loads(made[0]) if made else 0.0  # no rows may leave no task


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN, chars: int = SAMPLE_CHARS) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` for each row of `docs`.

    The network sees labels of rows whose crc32(doc_id) mod 5 is not 0. A text
    scores as its highest window, from 0 to 1; NULL and empty texts score 0.
    Without labels of both classes all texts score as the class there is, or 0.
    Rows with a NULL id are scored and never used for training. Eager: the
    network is fitted when called.
    """
    docs = texts(docs)
    net = fitted(labelled_sample(docs, labels, toxic, clean, chars))
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, bodies in slices(batches, 4_000_000):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(score(sent.value, bodies), pa.float64())], ["doc_id", "score"])

    return docs.mapInArrow(run, SCORES).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def score(net: Network | float, bodies: list[str]) -> np.ndarray:
    flat, bounds, distinct = numbered([words(t) for t in bodies])
    out = np.zeros(len(bodies))
    if isinstance(net, float):
        out[np.diff(bounds) > 0] = net
        return out
    first, length, doc = windows(bounds)
    if not len(first):
        return out
    gates = net.gates(features(distinct))
    for chosen in in_batches(length, 1024):
        logit = net.forward(gates, window_index(flat, first[chosen], length[chosen]))
        np.maximum.at(out, doc[chosen], sigmoid(logit.astype(np.float64)))
    return out
