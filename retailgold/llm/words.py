"""Words, word hashes and shingles of many texts at once, as numpy arrays.

A word is a maximal run of characters other than ``\\x20 \\x09-\\x0D``.  All of them are one byte in UTF-8 and never part
of a longer character, so the words of a batch can be cut on the bytes of all its texts laid end to end.
Lone surrogates cannot occur in a Spark string.  A text that is null counts as empty.
"""

from __future__ import annotations

import numpy as np

_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix in which every bit of the input reaches every bit of the result."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """``_ODD ** i`` for i < n, kept between calls."""
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 1 << 16) - 1, _ODD)]), dtype=np.uint64)
    return _powers[:n]


class Words:
    """The words of ``texts``: ``start``, ``end`` (byte places in ``data``), ``text`` (whose), ``first`` (per text, n + 1 values)."""

    def __init__(self, texts: list[str | None], lower: bool = False):
        coded = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        self.data = np.frombuffer(b"\n".join(coded) + b"\n", np.uint8)  # a gap between texts, so that none runs into the next
        if lower:
            self.data = _LOWER[self.data]
        self.place = np.concatenate([[0], np.cumsum([len(c) + 1 for c in coded])]).astype(np.int64)
        gap = np.concatenate([[True], _GAP[self.data]])
        turn = np.flatnonzero(gap[1:] != gap[:-1])
        self.start, self.end = turn[::2], turn[1::2]
        self.text = np.searchsorted(self.place, self.start, "right") - 1
        self.first = np.searchsorted(self.start, self.place)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64 bits per word, of its bytes."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        out = np.empty(len(self.start), np.uint64)
        with np.errstate(over="ignore"):
            length = (self.end - self.start).astype(np.int64)
            step = np.cumsum(length) - length  # of each word in an array of words only
            chars = self.data[np.repeat(self.start - step, length) + np.arange(int(length.sum()))]
            place = np.arange(len(chars)) - np.repeat(step, length)
            out = np.add.reduceat(_BYTE[chars] * powers(int(length.max()))[place], step)
            return mixed(out + length.astype(np.uint64) * _ODD)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` hashes; the order within the run counts."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for i in range(width):
            out = mixed(out * _ODD + hashes[i : i + n])
    return out


def shingle_sets(texts: list[str | None], width: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its lower-cased (A-Z) ``width``-word shingles.

    A text with fewer words has its whole sequence as its one shingle; one without words has none.
    """
    words = Words(texts, lower=True)
    hashes = words.hashes()
    run = windows(hashes, width)
    sets = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= width:
            sets.append(np.unique(run[a : b - width + 1]))
        elif b > a:
            with np.errstate(over="ignore"):
                sets.append(windows(hashes[a:b], b - a) + np.uint64(b - a))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
