"""Token ids of texts by a public tokenizer, with a cache of words.

A byte-level tokenizer never joins two words over a single blank between two
non-blank characters, so a text's ids are those of its words, each with the
blank before it. Words repeat, texts hardly do: only words not seen lately reach
the tokenizer. A text where a blank touches other white space, or that holds a
special token's name, goes to it as a whole.
"""

from __future__ import annotations

import base64
import os
from functools import cache
from itertools import chain

import numpy as np

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Words kept at most, and bytes that they, their ids and their places in the index may take. A full cache is emptied
#: before the next batch.
CACHE_WORDS, CACHE_BYTES = 1_000_000, 256 << 20
#: The same where a rank file encodes: words met again cost less there.
PLAIN_BYTES = 96 << 20
#: About what a word takes beside its characters and ids: an entry, two objects, two numbers.
_WORD_BYTES = 200
#: Fixed value: how the vocabulary writes a leading blank.
_BLANK = "\u0120"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Encodes lists of texts exactly as `encode(text, add_special_tokens=False)` does.

    With `plain`, names of special tokens in a text are ordinary text, and a rank
    file of the same vocabulary encodes the words, which is faster; `path` is not
    loaded then.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS, plain: str | None = None, cache_bytes: int = CACHE_BYTES):
        self.special, self.ranks = [], None
        if plain:
            self.ranks, opening, size = rank_encoding(plain)
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)
            self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
            names = self.tokenizer.get_vocab()
            opening, size = [i for name, i in names.items() if name.startswith(_BLANK)], max(names.values()) + 1
        self.opens = np.zeros(size, dtype=bool)  # ids that begin with a blank
        self.opens[opening] = True
        self.limit, self.most = cache_words, cache_bytes
        self._empty()

    def _empty(self) -> None:
        self.held = 0  # bytes, about
        self.index: dict[str, int] = {}
        self.ids, self.used = np.empty(1 << 16, dtype=np.uint32), 0
        self.first, self.length = np.empty(1 << 14, dtype=np.int64), np.empty(1 << 14, dtype=np.int64)

    def _ids(self, text: str) -> np.ndarray:
        if self.ranks:
            return np.asarray(self.ranks.encode_ordinary(text), dtype=np.uint32)
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _learn(self, words: list[str]) -> None:
        """Encode words a thousand to a text, cut again where an id begins with a blank. Irregular ones get length -1."""
        known_ids = self.used
        plain = [w for w in words if w and not w[0].isspace() and not w[-1].isspace()]
        odd = set(words).difference(plain)
        self._grow(0, len(odd))
        self.length[len(self.index) : len(self.index) + len(odd)] = -1
        self.index.update(zip(odd, range(len(self.index), len(self.index) + len(odd)), strict=True))
        for at in range(0, len(plain), 1000):
            part = plain[at : at + 1000]
            ids = self._ids(" " + " ".join(part))
            starts, known = np.flatnonzero(self.opens[ids]), len(self.index)
            self._grow(len(ids), len(part))
            self.ids[self.used : self.used + len(ids)] = ids
            self.first[known : known + len(part)] = self.used + starts
            self.length[known : known + len(part)] = np.diff(starts, append=len(ids))
            self.used += len(ids)
            self.index.update(zip(part, range(known, known + len(part)), strict=True))
        self.held += _WORD_BYTES * len(words) + sum(map(len, words)) + 4 * (self.used - known_ids)

    def _grow(self, ids: int, words: int) -> None:
        self.ids = _grown(self.ids, self.used + ids)
        self.first, self.length = _grown(self.first, len(self.index) + words), _grown(self.length, len(self.index) + words)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit numbers."""
        if len(self.index) > self.limit or self.held > self.most:
            self._empty()
        split = [text.split(" ") for text in texts]
        self._learn(list(set(chain.from_iterable(split)).difference(self.index)))
        find, out = self.index.__getitem__, []
        for text, words in zip(texts, split, strict=True):
            at = np.fromiter(map(find, words), dtype=np.int64, count=len(words))
            if len(words) == 1 or self.length[at].min() < 0 or any(s in text for s in self.special):
                out.append(self._ids(text))
                continue
            at = at[1:]
            sizes = self.length[at]
            ends = np.cumsum(sizes)
            source = np.repeat(self.first[at] - ends + sizes, sizes) + np.arange(ends[-1])
            out.append(np.concatenate([self._ids(words[0]), self.ids[source]]))
        return out


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    return array if size <= len(array) else np.concatenate([array, np.empty(max(size, 2 * len(array)) - len(array), dtype=array.dtype)])


def rank_encoding(path: str):
    """The vocabulary of a rank file (each line a token in base 64 and its rank), the ids that begin with a blank, and one past the last id."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    opening = [rank for token, rank in ranks.items() if token.startswith(b" ")]
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), opening, max(ranks.values()) + 1


@cache
def tokenizer(path: str, plain: str | None = None) -> WordTokenizer:
    """One tokenizer for each Python worker."""
    return WordTokenizer(path, plain=plain, cache_bytes=PLAIN_BYTES if plain else CACHE_BYTES)
