"""Texts as arrays of numbers, for operators that run numpy inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np

_GOLD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), element by element; wraps around."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salted(x: np.ndarray, salt: int) -> np.ndarray:
    return mix(x + np.uint64(salt * _GOLD % 2**64))


def unit(x: np.ndarray) -> np.ndarray:
    """Uniform in [0, 1) from the upper 53 bits."""
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


#: What makes each operator forget the words it remembers, by operator.
_FORGET: dict[str, Callable[[], object]] = {}


def remembers(operator: str, forget: Callable[[], object]) -> None:
    """``operator`` remembers words from task to task in a Python worker; ``forget`` drops them."""
    _FORGET[operator] = forget


def working(operator: str) -> None:
    """A task of ``operator`` runs in this Python worker: the words of the others are dropped.

    Spark goes on using a worker for other operators, and each executor holds
    several; so a worker holds the words of one operator at most.
    """
    for other, forget in _FORGET.items():
        if other != operator:
            forget()


class WordHashes(dict):
    """64-bit hashes of words (str or bytes); the more frequent are remembered."""

    def __init__(self, limit: int = 200_000):
        import xxhash
        super().__init__()
        self._hash, self._limit = xxhash.xxh3_64_intdigest, limit

    def __missing__(self, word) -> int:
        h = self._hash(word)
        if len(word) <= 64:
            if len(self) >= self._limit:
                self.clear()
            self[word] = h
        return h

    def array(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def slices(batches: Iterable, most_chars: int, *columns: int) -> Iterator[list[tuple]]:
    """Rows of Arrow batches in lists of up to ``most_chars`` characters of text.

    The text is the last of ``columns``; null is the empty text.
    """
    part, chars = [], 0
    for batch in batches:
        keys = [batch.column(c).to_pylist() for c in columns[:-1]]
        for i, text in enumerate(batch.column(columns[-1])):
            text = text.as_py() or ""
            part.append((*[k[i] for k in keys], text))
            chars += len(text)
            if chars >= most_chars or len(part) >= 20_000:
                yield part
                part, chars = [], 0
    if part:
        yield part
