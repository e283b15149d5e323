"""Byte-pair encoding and decoding with a lexicon of the corpus's frequent words.

The vocabulary file of a public tokenizer (a parameter) gives tokens and merges.  A first pass counts the pre-tokenized
words of all documents; frequent ones are merged once, where they lie, and compiled on the driver into a minimal acyclic
transducer with their ids as outputs, which executors memory-map.  A second pass looks the distinct words of each batch up in it; a word
that it does not hold is merged exactly, so the lexicon's size never changes a result.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import math
import os
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailgold.llm.frames import BATCH_ROWS, arrow_schema, by_batch, pieces, small_batches, stored
from retailgold.llm.lexicon import Lexicon, compile_sorted

# Characters that str.split() takes for white space and Unicode does not.
NOT_SPACE = regex.compile("[\x1c-\x1f]")
SPACES = regex.compile(r"\p{White_Space}+")
MEMO_CHUNKS = 300_000
COUNT_CHUNKS = 500_000
SHORT = 40
NEVER = 1 << 62
NO_RANK = 1 << 40
TOGETHER = 16


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in plain)}


class WordBpe:
    """Encoding and decoding of a tokenizer file with word-end suffixes: NFC, one space, lower case, split, merge."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        # pairs of ids as one number -> rank; rank -> new id
        listed = [(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in pairs]
        self.ranks = {a << 32 | b: rank for rank, (a, b, _) in enumerate(listed)}
        self.made = [new for _, _, new in listed]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.vocab | self.special).items()}
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # nothing before this part of the pattern begins with a letter, so a run of letters is one word
        self.letters_whole = r"|[\p{L}]+|" in pattern and not any(p[:1].isalpha() for p in pattern.split(r"|[\p{L}]+|")[0].split("|"))
        self.words = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        letters = byte_letters()
        self.inner = [self.vocab[letters[b]] for b in range(256)]
        self.outer = [self.vocab[letters[b] + self.suffix] for b in range(256)]
        self.digits = {i: str(i) for i in self.tokens}
        self.token_of = {self.digits[i]: t for i, t in self.tokens.items()}
        # the same for many words at once; pairs in order, and one that is none
        self.pairs = np.array(sorted(self.ranks) + [NEVER], np.int64)
        self.pair_ranks = np.array([self.ranks.get(p, NO_RANK) for p in self.pairs.tolist()], np.int64)
        self.inner_of, self.outer_of, self.made_of = (np.array(x, np.int64) for x in (self.inner, self.outer, self.made))

    def chunks(self, text: str) -> list[str]:
        """A text cut at white space, which no word, merge or composed letter reaches over."""
        return [c for c in SPACES.split(text) if c] if NOT_SPACE.search(text) else text.split()

    def pieces(self, chunk: str) -> list[str]:
        """The words of a chunk in order; a special token is a piece of its own."""
        if chunk.isascii():
            if self.letters_whole and chunk.isalpha():
                return [chunk.lower()]
            if "<|" not in chunk and chunk not in self.special:
                return self.words.findall(chunk.lower())
        out: list[str] = []
        for part in self.cut.split(chunk) if self.cut and "<|" in chunk else (chunk,):
            if part in self.special:
                out.append(part)
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
            # letter by letter where lower() would look at a letter's place in its word
            part = "".join(c.lower() for c in part) if "Σ" in part else part.lower()
            out += self.words.findall(part)
        return out

    def merge(self, word: bytes) -> list[int]:
        """The ids of a word: the merge of lowest rank first, the leftmost of equal ones."""
        ids = [self.inner[b] for b in word[:-1]] + [self.outer[word[-1]]]
        if len(ids) <= SHORT:
            return self._merge_short(ids)
        rank_of, made, end = self.ranks.get, self.made, len(ids)
        after, prior = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(end - 1) if (r := rank_of(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= end or ids[j] != b:
                continue  # one side has been merged meanwhile
            new = made[rank]
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[i] < end:
                prior[after[i]] = i
                if (r := rank_of(new << 32 | ids[after[i]])) is not None:
                    heapq.heappush(heap, (r, i, new, ids[after[i]]))
            if (p := prior[i]) >= 0 and (r := rank_of(ids[p] << 32 | new)) is not None:
                heapq.heappush(heap, (r, p, ids[p], new))
        return [i for i in ids if i >= 0]

    def _merge_short(self, ids: list[int]) -> list[int]:
        rank_of, made = self.ranks.get, self.made
        ways = [rank_of(a << 32 | b, NEVER) for a, b in zip(ids, ids[1:])]
        while ways and (best := min(ways)) != NEVER:
            i = ways.index(best)
            ids[i] = new = made[best]
            del ids[i + 1], ways[i]
            if i:
                ways[i - 1] = rank_of(ids[i - 1] << 32 | new, NEVER)
            if i < len(ways):
                ways[i] = rank_of(new << 32 | ids[i + 1], NEVER)
        return ids

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """``merge`` of each word; short words of one length take a step together, each row its own merge of lowest rank."""
        out: list[list[int]] = [[]] * len(words)
        by: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by.setdefault(len(w), []).append(i)
        for size, which in by.items():
            if size < 2 or size > SHORT or len(which) < TOGETHER:
                for i in which:
                    out[i] = self.merge(words[i])
                continue
            flat = np.frombuffer(b"".join([words[i] for i in which]), np.uint8).reshape(len(which), size)
            ids = self.inner_of[flat]
            ids[:, -1] = self.outer_of[flat[:, -1]]
            for i, row in zip(which, self._merge_rows(ids)):
                out[i] = row
        return out

    def _merge_rows(self, ids: np.ndarray) -> Iterator[list[int]]:
        """Rows of ids, each of one word, merged to its end."""
        rows, size = ids.shape
        left, width = np.full(rows, size), np.arange(size)
        ranks = self._ranks_of(ids[:, :-1], ids[:, 1:])
        live = np.arange(rows)
        while len(live):
            at = ranks[live].argmin(1)  # the leftmost of the lowest
            best = ranks[live, at]
            more = best < NO_RANK
            live, at, best = live[more], at[more], best[more]
            if not len(live):
                break
            # what lies behind the pair moves up
            moved = np.minimum(width[None, :] + (width[None, :] > at[:, None]), size - 1)
            ids[live] = np.take_along_axis(ids[live], moved, 1)
            ids[live, at] = self.made_of[best]
            left[live] -= 1
            shifted = np.take_along_axis(ranks[live], np.minimum(moved[:, :-1], size - 2), 1)
            shifted[width[None, :-1] >= (left[live] - 1)[:, None]] = NO_RANK
            n = np.arange(len(live))
            for side in (at - 1, at):
                ok = (side >= 0) & (side + 1 < left[live])
                shifted[n[ok], side[ok]] = self._ranks_of(ids[live[ok], side[ok]], ids[live[ok], side[ok] + 1])
            ranks[live] = shifted
        return (row[:n] for row, n in zip(ids.tolist(), left.tolist()))

    def _ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, ``NO_RANK`` where they do not merge."""
        pairs = a << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.pair_ranks[at], NO_RANK)

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder: tokens joined by one space."""
        return " ".join([self.tokens[i] for i in ids])


@lru_cache(maxsize=1)
def _rules(path: str, size: int, changed: int) -> WordBpe:
    return WordBpe(path)


def rules_of(path: str) -> WordBpe:
    """The rules of a file; a worker reads them once for all its tasks, and again when the file has changed."""
    file = os.stat(path)
    return _rules(path, file.st_size, file.st_mtime_ns)


class Encoder:
    """Texts to ids and back, with the transducer and a bounded memory of the first chunks seen by this task.

    The memory holds a chunk's ids only: they name its tokens, so these need no memory of their own.
    """

    def __init__(self, bpe: WordBpe, block: bytes):
        self.bpe, self.lexicon = bpe, Lexicon(block)
        # ids of each chunk, joined by spaces
        self.known: dict[str, str] = {}

    def learn(self, chunks: set[str]) -> set[str]:
        """Put the ids of each chunk into memory; gives those that are to be taken out again.  A chunk holds a word at least."""
        bpe, pieces = self.bpe, self.bpe.pieces
        new = chunks - self.known.keys()
        cuts = {c: pieces(c) for c in new}
        words = list(set(chain.from_iterable(cuts.values())))
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        found = self.lexicon.find(raw)
        unknown = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(unknown, bpe.merge_all([raw[i] for i in unknown])):
            found[i] = [bpe.special[words[i]]] if words[i] in bpe.special else ids
        digit, known = bpe.digits.__getitem__, self.known
        said = {w: " ".join(map(digit, ids)) for w, ids in zip(words, found)}
        full = len(known) >= MEMO_CHUNKS
        for c, cut in cuts.items():
            known[c] = said[cut[0]] if len(cut) == 1 else " ".join([said[w] for w in cut])
        return new if full else set()

    def _read(self, texts: list[str | None]) -> Iterator[list[str]]:
        """Each text's chunks, while what they stand for is in memory."""
        collecting = gc.isenabled()
        gc.disable()  # hundreds of thousands of small lists, none of them in a cycle
        try:
            cut = [self.bpe.chunks(t) if t else [] for t in texts]
            passing = self.learn(set(chain.from_iterable(cut)))
        finally:
            if collecting:
                gc.enable()
        yield from cut
        for chunk in passing:
            del self.known[chunk]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """The ids of each text; null counts as empty."""
        return [[int(i) for c in chunks for i in self.known[c].split(" ")] for chunks in self._read(texts)]

    def digests(self, texts: list[str | None]) -> tuple[list[int], list[str], list[str]]:
        """Per text: tokens, SHA-256 of its ids joined by spaces, SHA-256 of the decoded text."""
        ids, token, sha = self.known.__getitem__, self.bpe.token_of.__getitem__, lambda t: hashlib.sha256(t.encode("utf-8")).hexdigest()
        n, said, back = [], [], []
        for chunks in self._read(texts):
            text = " ".join(map(ids, chunks))
            each = text.split(" ") if text else []
            n.append(len(each))
            said.append(sha(text))
            back.append(sha(" ".join(map(token, each))))
        return n, said, back


def word_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(word, n): the pre-tokenized words of all texts.

    A task counts what lies between white space, and cuts that into words once it has met ``COUNT_CHUNKS`` different ones or its end.
    """
    small_batches(docs.sparkSession)
    schema = arrow_schema("word string, n bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, chunks = rules_of(path), Counter()

        def words() -> pa.RecordBatch:
            seen: dict[str, int] = {}
            for chunk, n in chunks.items():
                for word in bpe.pieces(chunk):
                    seen[word] = seen.get(word, 0) + n
            chunks.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], schema=schema)

        for (texts,) in pieces(batches, 0):
            for t in texts:
                chunks.update(bpe.chunks(t) if t else ())
            if len(chunks) >= COUNT_CHUNKS:
                yield words()
        yield words()

    return docs.select(text).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """(word) above the lowest frequency class (an eighth of a doubling) that leaves at most ``most`` of them."""
    level = F.floor(F.log2("n") * 8).cast("int")
    sizes = {r["level"]: r["words"] for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()}
    least, total = math.inf, 0
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > most:
            break
        least = at
    return counts.where("false" if least == math.inf else level >= least).select("word")


def frequent_words(counts: DataFrame, most: int) -> list[str]:
    return frequent(counts, most).toArrow()["word"].to_pylist()


def merged(words: DataFrame, path: str) -> DataFrame:
    """(word, ids): the bytes of each word and what they merge to; a special token is left out."""

    def make():
        bpe = rules_of(path)

        def work(texts):
            raw = [w.encode("utf-8", "surrogatepass") for w in texts if w not in bpe.special]
            return raw, bpe.merge_all(raw)

        return work

    return by_batch(words, make, "word binary, ids array<int>")


def lexicon_of(docs: DataFrame, path: str, text: str = "text", most: int = 200_000) -> bytes:
    """The compiled transducer of the most frequent words of all documents, at most ``most``.

    The driver gets words and ids as Arrow columns: neither it nor the JVM beside it holds an object for each.
    """
    counts = stored(word_counts(docs, path, text), "bpe-words")
    table = merged(frequent(counts, most), path).toArrow()
    table = table.take(pc.sort_indices(table, [("word", "ascending")]))
    words = chain.from_iterable(b.column(0).to_pylist() for b in table.to_batches(max_chunksize=BATCH_ROWS))
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(table["ids"]).to_numpy(), dtype=np.int64)])
    return compile_sorted(words, bounds, pc.list_flatten(table["ids"]).to_numpy())


def _encoders(docs: DataFrame, path: str, text: str, most: int):
    block = docs.sparkSession.sparkContext.broadcast(lexicon_of(docs, path, text, most))
    return lambda: Encoder(rules_of(path), block.value)


def encode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", most: int = 200_000) -> DataFrame:
    """(key, ids): token ids of every whole text.  Null and empty texts have none; a row in is a row out."""
    encoder = _encoders(docs, path, text, most)

    def make():
        run = encoder()
        return lambda keys, texts: (keys, run.encode(texts))

    kind = docs.schema[key].dataType.simpleString()
    return by_batch(docs.select(key, text), make, f"`{key}` {kind}, ids array<int>", text=1)


def decode(coded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, text): the texts of id lists; null ids give null."""

    def make():
        bpe = rules_of(path)
        return lambda keys, ids: (keys, [None if i is None else bpe.decode(i) for i in ids])

    kind = coded.schema[key].dataType.simpleString()
    return by_batch(coded.select(key, "ids"), make, f"`{key}` {kind}, text string")


def encode_digests(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", most: int = 200_000, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) and the columns ``keep`` of every row; see ``encode`` for odd rows."""
    encoder = _encoders(docs, path, text, most)

    def make():
        run = encoder()
        return lambda keys, texts, *kept: (keys, *run.digests(texts), *kept)

    kind = docs.schema[key].dataType.simpleString()
    more = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return by_batch(
        docs.select(key, text, *keep), make, f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{more}", text=1
    )
