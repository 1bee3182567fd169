"""A minimal acyclic transducer from byte strings to strings of numbers.

Words are added in byte order. Each output is carried by the earliest arc at
which it is certain, and states with equal futures are one state, so words share
their beginnings and their endings. The finished machine is a few flat arrays in
one file, which readers map into memory: processes of a machine share its pages.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

_MAGIC = b"transducer-1"
#: The arrays of a file, in their order.
_PARTS = [("keys", "<u8"), ("targets", "<u4"), ("arc_outputs", "<u4"), ("final_outputs", "<i8"), ("pool_bounds", "<u4"), ("pool", "<u4")]


class _Path:
    """A state on the path of the last word, not yet shared."""

    __slots__ = ("arcs", "final")

    def __init__(self):
        self.arcs: list[list] = []  # [label, target, output]
        self.final: tuple | None = None  # output that ends a word here; None where no word ends


class _Builder:
    def __init__(self):
        self.states: dict[tuple, int] = {}
        self.path, self.last = [_Path()], b""

    def _shared(self, node: _Path) -> int:
        """The number of the state that has this future."""
        return self.states.setdefault((node.final, tuple(map(tuple, node.arcs))), len(self.states))

    def _close(self, depth: int) -> None:
        """Give every state below `depth` on the last word's path its number."""
        while len(self.path) > depth + 1:
            state = self._shared(self.path.pop())
            self.path[-1].arcs[-1][1] = state

    def add(self, word: bytes, output: tuple) -> None:
        if word <= self.last and (self.last or self.path[0].arcs):
            raise ValueError("words must come in byte order, each once")
        common = _common(self.last, word)
        self._close(common)
        for at in range(common):  # what both words agree on stays on the arc, the rest moves past it
            arc, after = self.path[at].arcs[-1], self.path[at + 1]
            agreed = _common(arc[2], output)
            moved, arc[2], output = arc[2][agreed:], arc[2][:agreed], output[agreed:]
            if moved:
                for later in after.arcs:
                    later[2] = moved + later[2]
                if after.final is not None:
                    after.final = moved + after.final
        for label in word[common:]:
            self.path[-1].arcs.append([label, -1, output])
            self.path.append(_Path())
            output = ()
        self.path[-1].final = output
        self.last = word


def _common(a, b) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def compile_words(words: Iterable[tuple[bytes, tuple]]) -> bytes:
    """The file of the machine for (word, output) pairs, whose words are distinct and not empty."""
    builder = _Builder()
    for word, output in sorted(words):
        if not word:
            raise ValueError("an empty word")
        builder.add(word, tuple(output))
    builder._close(0)
    builder._shared(builder.path[0])  # the root is the last state
    outputs: dict[tuple, int] = {(): 0}
    keys, targets, arc_outputs, final_outputs = [], [], [], []
    for state, (final, arcs) in enumerate(builder.states):
        final_outputs.append(-1 if final is None else outputs.setdefault(final, len(outputs)))
        for label, target, output in arcs:
            keys.append(state << 8 | label)
            targets.append(target)
            arc_outputs.append(outputs.setdefault(output, len(outputs)))
    bounds = np.cumsum([0, *map(len, outputs)])
    pool = [i for output in outputs for i in output]
    arrays = [np.asarray(x, dtype=t) for x, (_, t) in zip([keys, targets, arc_outputs, final_outputs, bounds, pool], _PARTS, strict=True)]
    header = _MAGIC.ljust(16, b"\0") + np.asarray([len(a) for a in arrays], dtype="<u8").tobytes()
    return header + b"".join(a.tobytes().ljust(-(-a.nbytes // 8) * 8, b"\0") for a in arrays)


class Transducer:
    """A compiled machine, mapped from its file."""

    def __init__(self, path: str):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        if bytes(raw[: len(_MAGIC)]) != _MAGIC:
            raise ValueError(f"not a transducer: {path}")
        sizes, at = raw[16 : 16 + 8 * len(_PARTS)].view("<u8").tolist(), 16 + 8 * len(_PARTS)
        for (name, kind), size in zip(_PARTS, sizes, strict=True):
            width = np.dtype(kind).itemsize * size
            setattr(self, name, raw[at : at + width].view(kind))
            at += -(-width // 8) * 8

    @property
    def n_states(self) -> int:
        return len(self.final_outputs)

    def look_up(self, words: list[bytes]) -> list[list[int] | None]:
        """The output of each word, None for those that the machine does not know. All words step together."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        text = np.frombuffer(b"".join(words), dtype=np.uint8)
        first = np.cumsum(sizes) - sizes
        state = np.full(len(words), self.n_states - 1, dtype=np.uint64)
        alive = np.flatnonzero(sizes > 0) if len(self.keys) else np.empty(0, dtype=np.int64)
        state[sizes == 0] = 0
        known = np.zeros(len(words), dtype=bool)
        whose, what, step = [], [], 0
        while len(alive):
            wanted = state[alive] << np.uint64(8) | text[first[alive] + step].astype(np.uint64)
            arc = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            found = self.keys[arc] == wanted
            alive, arc = alive[found], arc[found]
            state[alive] = self.targets[arc]
            said = self.arc_outputs[arc] > 0
            whose.append(alive[said])
            what.append(self.arc_outputs[arc[said]].astype(np.int64))
            step += 1
            ended = sizes[alive] == step
            done = alive[ended]
            final = self.final_outputs[state[done]]
            known[done] = final >= 0
            whose.append(done[final > 0])
            what.append(final[final > 0])
            alive = alive[~ended]
        return self._outputs(known, whose, what)

    def _outputs(self, known: np.ndarray, whose: list, what: list) -> list[list[int] | None]:
        who = np.concatenate([np.empty(0, dtype=np.int64), *whose])
        out = np.concatenate([np.empty(0, dtype=np.int64), *what])
        order = np.argsort(who, kind="stable")  # by word, then by step
        who, out = who[order], out[order]
        sizes = self.pool_bounds[out + 1].astype(np.int64) - self.pool_bounds[out]
        ends = np.cumsum(sizes)
        source = np.repeat(self.pool_bounds[out] - ends + sizes, sizes) + np.arange(sizes.sum())
        ids = self.pool[source].tolist()
        bounds = np.concatenate([[0], np.cumsum(np.bincount(who, weights=sizes, minlength=len(known)))]).astype(np.int64).tolist()
        return [ids[a:b] if k else None for k, a, b in zip(known.tolist(), bounds, bounds[1:])]
