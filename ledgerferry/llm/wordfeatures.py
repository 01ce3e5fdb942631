"""Hashed features of words, computed for many words at a time, and tables of what they give."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np

BITS = 17
#: Number of feature rows; row 0 is padding and weighs nothing.
ROWS = 1 << BITS
PREFIXES, SUFFIXES = 5, 4
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def _row(values: np.ndarray, salt: int, there: np.ndarray) -> np.ndarray:
    mixed = (values + np.uint64(salt)) * _A
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _B
    return np.where(there, (mixed >> np.uint64(64 - BITS)) | np.uint64(1), np.uint64(0)).astype(np.int32)


def word_features(words: list[str]) -> np.ndarray:
    """Rows of the features of words of like length: the word, its affixes, all its 2- and 3-grams."""
    n, width = len(words), max(map(len, words))
    codes = np.array(words, dtype=f"U{width}").view(np.uint32).reshape(n, width).astype(np.uint64)
    length = np.fromiter(map(len, words), np.int64, n)
    whole = np.zeros(n, np.uint64)
    columns: list[np.ndarray] = []
    for j in range(width):
        whole = np.where(j < length, whole * _B + codes[:, j] + np.uint64(1), whole)
        if j < PREFIXES:
            columns.append(_row(whole, 100 + j, j < length))
    columns.insert(0, _row(whole, 1, length > 0))
    tail = np.zeros(n, np.uint64)
    for j in range(SUFFIXES):
        at = np.maximum(length - 1 - j, 0)
        tail = tail * _B + codes[np.arange(n), at] + np.uint64(1)
        columns.append(_row(tail, 200 + j, j < length))
    for size in (2, 3):
        for i in range(width - size + 1):
            gram = np.zeros(n, np.uint64)
            for j in range(size):
                gram = gram * _B + codes[:, i + j] + np.uint64(1)
            columns.append(_row(gram, 300 + size, i + size <= length))
    return np.stack(columns, 1)


def by_width(words: Iterable[str]) -> list[list[str]]:
    """Words in groups whose lengths have as many bits, cut to bounded matrices."""
    groups: dict[int, list[str]] = {}
    for w in words:
        groups.setdefault(max(3, (len(w) - 1).bit_length()), []).append(w)
    out = []
    for bits, group in groups.items():
        step = max(1, (1 << 16) >> bits)
        out += [group[i : i + step] for i in range(0, len(group), step)]
    return out


class WordTable:
    """Numbers of words, and a row of values for each: computed once, kept up to `limit` words."""

    def __init__(self, values: Callable[[list[str]], np.ndarray], width: int, limit: int = 80_000):
        self.values, self.limit, self.width = values, limit, width
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.rows = np.zeros((self.limit + 1, self.width), np.float32)

    def look_up(self, words: list[str]) -> np.ndarray:
        """Row numbers into `rows`, which hold until the next call."""
        numbers = self.numbers
        new = {w for w in words if w not in numbers}
        if len(numbers) + len(new) > self.limit:
            self._clear()
            numbers, new = self.numbers, set(words)
        if new:
            end = len(numbers) + 1 + len(new)  # row 0 stays zero
            if end > len(self.rows):  # one batch of texts has more words than the limit
                self.rows = np.concatenate([self.rows, np.zeros((end - len(self.rows), self.width), np.float32)])
            for group in by_width(sorted(new)):
                start = len(numbers) + 1
                self.rows[start : start + len(group)] = self.values(group)
                numbers.update(zip(group, range(start, start + len(group)), strict=True))
        return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


class Adam:
    """Adaptive steps for a dict of arrays."""

    def __init__(self, parameters: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = parameters, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in parameters.items()}
        self.v = {k: np.zeros_like(v) for k, v in parameters.items()}

    def step(self, gradients: dict[str, np.ndarray | tuple[np.ndarray, np.ndarray]]) -> None:
        """A gradient is an array, or (rows, array) for some rows of a table."""
        self.t += 1
        rate = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in gradients.items():
            rows, g = g if isinstance(g, tuple) else (slice(None), g)
            self.m[k][rows] = 0.9 * self.m[k][rows] + 0.1 * g
            self.v[k][rows] = 0.999 * self.v[k][rows] + 0.001 * g * g
            self.p[k][rows] -= rate * self.m[k][rows] / (np.sqrt(self.v[k][rows]) + 1e-8)


class Ragged:
    """All features of words, of any number each: the word itself, and the rest one after the other."""

    def __init__(self, whole: np.ndarray, rest: np.ndarray, counts: np.ndarray):
        self.whole, self.rest, self.counts = whole, rest, counts
        self.starts = np.cumsum(counts) - counts

    @classmethod
    def of(cls, words: list[str]) -> Ragged:
        place = {w: i for i, w in enumerate(words)}
        whole, counts = np.zeros(len(words), np.int32), np.zeros(len(words), np.int64)
        parts, owners = [], []
        for group in by_width(words):
            rows, own = word_features(group), np.array([place[w] for w in group])
            there = rows[:, 1:] > 0
            whole[own], counts[own] = rows[:, 0], there.sum(1)
            parts.append(rows[:, 1:][there])
            owners.append(np.repeat(own, there.sum(1)))
        order = np.argsort(np.concatenate(owners), kind="stable") if owners else []
        return cls(whole, np.concatenate(parts)[order] if parts else np.zeros(0, np.int32), counts)

    def __len__(self) -> int:
        return len(self.whole)

    def take(self, words: np.ndarray) -> Ragged:
        counts = self.counts[words]
        first = np.repeat(self.starts[words] - (np.cumsum(counts) - counts), counts)
        return Ragged(self.whole[words], self.rest[first + np.arange(len(first))], counts)

    def rows(self) -> np.ndarray:
        return np.unique(np.concatenate([self.whole, self.rest]))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Of each word: the sum of its features' values, the word itself left out (every word has others)."""
        return np.add.reduceat(values[self.rest], self.starts, axis=0)

    def gradient(self, by_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums by feature row of the gradients of `sums`."""
        unique, place = np.unique(self.rest, return_inverse=True)
        spread = np.repeat(by_word, self.counts, axis=0)
        out = np.stack([np.bincount(place, spread[:, k], len(unique)) for k in range(by_word.shape[1])], 1)
        return unique, out.astype(np.float32)
