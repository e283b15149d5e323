"""Quality rules: base counts of a text, and how far it is from the language references.

A reference is, for each language of the corpus, the histogram of character classes and of common words over all its
documents.  A common word has a share of at least ``WORD_SHARE`` of its language's words, whatever its length, so a language
has at most ``1 / WORD_SHARE`` of them; all other words are one more bin.  A text is compared by
Jensen-Shannon distance (0 to 1) with every reference and the nearest counts, so its own language label is not needed.
Texts below the minimum lengths are not judged by distance.

Null and empty texts have no words and fail the base rule.  Without any labelled text there is no reference and only the
base rule holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailgold.llm.frames import arrow_schema, by_batch, pieces, small_batches, stored
from retailgold.llm.words import Words, mixed, windows

WORD_SHARE = 0.001
LEAST_WORDS = 100
LEAST_CHARS = 400
# Distances above which a text fails; see README for how they were set.
FAR_CLASSES = 0.30
FAR_WORDS = 0.45

CLASSES = 8


def _classes() -> np.ndarray:
    """Class of each UTF-8 byte: lower, upper, digit, white space, sentence marks, symbols, other letters; 7: inside a character."""
    table = np.full(256, 5)
    table[ord("a") : ord("z") + 1], table[ord("A") : ord("Z") + 1], table[ord("0") : ord("9") + 1] = 0, 1, 2
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 3
    table[[ord(c) for c in ".,;:!?'\"()-"]] = 4
    table[0x80:0xC0], table[0xC0:] = 7, 6
    return table


_CLASS = _classes()
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_EDGE = " \t\x0b\x0c\r"


def class_counts(words: Words) -> np.ndarray:
    """Texts x 7 counts of characters by class, without the sign between two texts."""
    n = len(words.place) - 1
    kind = _CLASS[words.data]
    whose = np.repeat(np.arange(n), np.diff(words.place))
    out = np.bincount(whose * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES)[:, :7]
    out[:, 3] -= 1
    return out


def base_counts(texts: list[str | None]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each whole text."""
    words = Words(texts)
    n, count = len(texts), words.counts
    leads = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    chars = np.bincount(words.text, leads[words.end] - leads[words.start], n).astype(np.int64)
    symbols = np.bincount(np.searchsorted(words.place, np.flatnonzero(_SYMBOL[words.data]), "right") - 1, minlength=n)
    lines = []
    for t in texts:
        full = [x for x in t.split("\n") if x.strip(_EDGE)] if t else []
        lines.append(len(full) - len(set(full)))
    repeated = np.zeros(len(words.start) + 2, bool)
    run = windows(words.hashes(), 3)
    inside = np.flatnonzero(words.text[:-2] == words.text[2:]) if len(run) else np.zeros(0, np.int64)
    key = mixed(run[inside] ^ mixed(words.text[inside].astype(np.uint64)))
    order = np.argsort(key)
    twin = key[order][1:] == key[order][:-1]
    found = inside[order[np.concatenate([twin, [False]]) | np.concatenate([[False], twin])]] if len(key) else inside
    for i in range(3):
        repeated[found + i] = True
    return {
        "n_words": count, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": np.array(lines, np.int64),
        "n_repeat_words": np.bincount(words.text, repeated[: len(words.start)], n).astype(np.int64),
    }


def base_failed(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def distances(rows: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts (to base 2, its root) to a reference distribution; 0 for empty rows."""
    total = rows.sum(1, keepdims=True)
    p = rows / np.maximum(total, 1)
    m = (p + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        of = lambda a: np.where(a > 0, a * np.log2(a / m), 0.0).sum(1)
        gap = (of(p) + of(np.broadcast_to(reference, p.shape))) / 2
    return np.where(total[:, 0] > 0, np.sqrt(np.clip(gap, 0, 1)), 0.0)


CELLS = 2_000_000  # text and language pairs, and their common bins, that are held at one time


@dataclass
class References:
    """Shares by language; those of words by word, with the languages that have it, as most words are common in few."""

    classes: np.ndarray  # languages x 7 shares
    words: np.ndarray  # sorted hashes of all common words
    first: np.ndarray  # words + 2: where each word's entries start, the last word standing for all others
    langs: np.ndarray  # language of each entry
    shares: np.ndarray  # share of each entry

    def nearest(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Distance of classes and of words to the nearest reference; 0 where there is none."""
        if not len(self.classes):
            return np.zeros(len(texts)), np.zeros(len(texts))
        words = Words(texts, lower=True)
        n, bins = len(texts), len(self.words) + 1
        bin_ = np.full(len(words.start), bins - 1)
        if len(self.words) and len(words.start):
            hashes = words.hashes()
            at = np.minimum(np.searchsorted(self.words, hashes), bins - 2)
            bin_ = np.where(self.words[at] == hashes, at, bins - 1)
        cells, counts = np.unique(words.text * bins + bin_, return_counts=True)
        classes = class_counts(Words(texts))
        near = np.ones(n)
        for r in self.classes:
            near = np.minimum(near, distances(classes, r))
        return near, self._words_near(n, cells // bins, cells % bins, counts)

    def _words_near(self, n: int, whose: np.ndarray, bin_: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The divergence is 1 plus half of a term per bin that both sides have, so only those are looked at."""
        total = np.bincount(whose, counts, n)
        p = counts / total[whose]
        size = self.first[bin_ + 1] - self.first[bin_]
        languages = len(self.classes)
        work = np.bincount(whose, size, n) + languages
        part = ((np.cumsum(work) - work) // CELLS).astype(np.int64)
        out = np.zeros(n)
        for i in np.unique(part):
            texts = np.flatnonzero(part == i)
            mine = slice(*np.searchsorted(whose, [texts[0], texts[-1] + 1]))
            many = size[mine]
            entry = np.arange(many.sum()) + np.repeat(self.first[bin_[mine]] - np.cumsum(many) + many, many)
            a, b = np.repeat(p[mine], many), self.shares[entry]
            term = a * np.log2(a / (a + b)) + b * np.log2(b / (a + b))
            cell = np.repeat(whose[mine] - texts[0], many) * languages + self.langs[entry]
            gap = 1 + np.bincount(cell, term, len(texts) * languages).reshape(-1, languages) / 2
            out[texts] = np.sqrt(np.clip(gap.min(1), 0, 1))
        return np.where(total > 0, out, 0.0)


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> References:
    """Histograms by language over all texts."""
    small_batches(docs.sparkSession)
    schema = "lang string, word boolean, key bigint, n bigint"
    arrow = arrow_schema(schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: dict[str, np.ndarray] = {}
        words: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts):
            keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(back, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)

        for langs, texts in pieces(batches, 1):
            by_lang: dict[str, list[str | None]] = {}
            for t, name in zip(texts, langs):
                by_lang.setdefault(name, []).append(t)
            for name, own in by_lang.items():
                words.setdefault(name, []).append(np.unique(Words(own, lower=True).hashes(), return_counts=True))
                whole = class_counts(Words(own)).sum(0)
                classes[name] = classes.get(name, 0) + whole
                if len(words[name]) > 40:
                    words[name] = [merged(words[name])]
        for name, counts in classes.items():
            keys, n = merged(words[name])
            size = len(keys)
            yield pa.RecordBatch.from_arrays([
                pa.array([name] * (size + 7), pa.string()), pa.array([True] * size + [False] * 7),
                pa.array(np.concatenate([keys.view(np.int64), np.arange(7)])), pa.array(np.concatenate([n, counts]).astype(np.int64)),
            ], schema=arrow)

    counted = (
        docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), text).mapInArrow(count, schema)
        .groupBy("lang", "word", "key").agg(F.sum("n").alias("n"))
    )
    counted = stored(counted, "quality-counts")
    sums = counted.where("word").groupBy("lang").agg(F.sum("n").alias("total"))
    totals = {r["lang"]: r["total"] for r in sums.collect()}
    # languages are rows of a join, not branches of an expression, so their number does not matter to the plan
    common = counted.where("word").join(sums, "lang").where(F.col("n") >= F.col("total") * WORD_SHARE)
    common = common.select("lang", "key", "n").collect()  # at most 1 / WORD_SHARE per language
    classes = counted.where("not word").collect()  # 7 per language
    names = {n: i for i, n in enumerate(sorted(n for n, total in totals.items() if total))}
    found = np.array([r["key"] for r in common], np.int64).view(np.uint64)
    keys, word = np.unique(found, return_inverse=True)
    lang_of = np.array([names[r["lang"]] for r in common], np.int64)
    share = np.array([r["n"] / totals[r["lang"]] for r in common])
    rest = 1 - np.bincount(lang_of, share, len(names))
    open_ = np.flatnonzero(rest > 0)
    word, lang_of, share = np.append(word, np.full(len(open_), len(keys))), np.append(lang_of, open_), np.append(share, rest[open_])
    order = np.lexsort((lang_of, word))
    kinds = np.zeros((len(names), 7))
    for r in classes:
        if r["lang"] in names:
            kinds[names[r["lang"]], r["key"]] = r["n"]
    return References(
        kinds / np.maximum(kinds.sum(1, keepdims=True), 1), keys, np.searchsorted(word[order], np.arange(len(keys) + 2)), lang_of[order], share[order],
    )


def judge(docs: DataFrame, refs: References, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the base counts, base_failed, kept, and both distances."""
    shared = docs.sparkSession.sparkContext.broadcast(refs)  # at most 1 / WORD_SHARE words per language

    def make():
        def work(keys, texts):
            base = base_counts(texts)
            failed = base_failed(base["n_words"], base["n_repeat_words"])
            classes, words = shared.value.nearest(texts)
            length = np.array([len(t) if t else 0 for t in texts])
            far = ((length >= LEAST_CHARS) & (classes > FAR_CLASSES)) | ((base["n_words"] >= LEAST_WORDS) & (words > FAR_WORDS))
            return [keys, *base.values(), failed, ~failed & ~far, classes, words]

        return work

    kind = docs.schema[key].dataType.simpleString()
    counts = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
    return by_batch(
        docs.select(key, text), make,
        f"`{key}` {kind}, {counts}, base_failed boolean, kept boolean, class_distance double, word_distance double", text=1,
    )
