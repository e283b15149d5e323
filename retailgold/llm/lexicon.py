"""A minimal acyclic transducer: words in, id sequences out, in flat arrays that are memory-mapped.

States with the same right language are one state (shared suffixes).  Each edge holds how many words sort before those
that go through it; the sum along a word's path numbers the word, and the number points to its ids.
"""

from __future__ import annotations

import io
import mmap
import tempfile
from array import array
from collections.abc import Iterable
from itertools import accumulate

import numpy as np

PARTS = ("keys", "targets", "before", "final", "bounds", "ids")


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The transducer of the entries as one block of bytes."""
    words = sorted(entries)
    bounds = np.fromiter(accumulate((len(entries[w]) for w in words), initial=0), np.int64)
    return compile_sorted(words, bounds, np.fromiter((i for w in words for i in entries[w]), np.int64))


def compile_sorted(words: Iterable[bytes], bounds: np.ndarray, ids: np.ndarray) -> bytes:
    """The same from different words in byte order; those of word i have ``ids[bounds[i] : bounds[i + 1]]``.

    Incremental construction: a state is written out as soon as it gets no more edges, and known again by its packed edges.
    """
    known: dict[bytes, int] = {}
    keys, targets, before, final, below = (array("q") for _ in range(5))
    path: list[array] = [array("q", [0])]  # the states of the last word that may still get edges: final, then target and label of each
    last = b""

    def freeze(node: array) -> int:
        at = known.setdefault(node.tobytes(), len(final))
        if at == len(final):  # a new one
            n = node[0]
            for edge in node[1:]:
                keys.append(at << 8 | edge & 255), targets.append(edge >> 8), before.append(n)
                n += below[edge >> 8]  # children were frozen before their parents
            final.append(node[0]), below.append(n)
        return at

    def close(depth: int) -> None:
        while len(path) - 1 > depth:
            at = freeze(path.pop())
            path[-1].append(at << 8 | last[len(path) - 1])

    for word in words:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        close(same)
        path.extend(array("q", [0]) for _ in word[same:])
        path[-1][0] = 1
        last = word
    close(0)
    root = freeze(path[0])
    arrays = {"keys": keys, "targets": targets, "before": before, "final": final, "bounds": bounds, "ids": ids}
    head = np.array([root, *(len(arrays[p]) for p in PARTS)], np.int64)
    out = io.BytesIO()
    for part in (head, *(arrays[p] for p in PARTS)):
        out.write(np.asarray(part, np.int64).tobytes())
    return out.getvalue()


class Lexicon:
    """A compiled transducer, mapped from a file that has no name any more and so goes with the process."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(block)
            file.flush()
            flat = np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ), np.int64)
        self.root, at = int(flat[0]), 1 + len(PARTS)
        for part, size in zip(PARTS, flat[1 : 1 + len(PARTS)].tolist()):
            setattr(self, part, flat[at : at + size])
            at += size

    def find(self, words: list[bytes]) -> list[list[int] | None]:
        """The ids of each word, None where the transducer does not accept it; all words take a step together."""
        found: list[list[int] | None] = [None] * len(words)
        if not len(self.keys):
            return found
        sizes = np.array([len(w) for w in words], np.int64)
        place = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        alive = np.flatnonzero(sizes > 0)
        state, number, step = np.full(len(alive), self.root, np.int64), np.zeros(len(alive), np.int64), 0
        while len(alive):
            key = state << 8 | flat[place[alive] + step]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[edge] == key
            alive, edge, number = alive[ok], edge[ok], number[ok]
            state, number, step = self.targets[edge], number + self.before[edge], step + 1
            over = sizes[alive] == step
            for word, n in zip(alive[over & (self.final[state] == 1)].tolist(), number[over & (self.final[state] == 1)].tolist()):
                found[word] = self.ids[self.bounds[n] : self.bounds[n + 1]].tolist()
            alive, state, number = alive[~over], state[~over], number[~over]
        return found
