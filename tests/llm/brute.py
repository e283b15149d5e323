"""The operators' results in plain Python, by definition and without their methods."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")
BASE = (
    ("assign", re.compile(
        r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
        r"""[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile("[0-9a-f]+"), 0, 32),
)


class Classes:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, width=5):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def near_duplicates(docs):
    """doc_id -> (n_shingles, component_id), every pair compared."""
    sets = {d: shingles(t) for d, t in docs}
    classes = Classes()
    by_token = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            by_token[x].add(d)
    for d, s in sets.items():
        for e in set().union(*(by_token[x] for x in s)) if s else ():
            both = len(s & sets[e])
            if e < d and 100 * both >= 75 * (len(s) + len(sets[e]) - both):
                classes.link(d, e)
    return {d: (len(s), classes.find(d)) for d, s in sets.items()}


def base_spans(text):
    found = []
    for i, (kind, pattern, group, least) in enumerate(BASE):
        found += [(m.start(), i, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return [x[2] for x in sorted(found)], Counter(x[1] for x in found)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    count = Counter(zip(words, words[1:], words[2:]))
    marked = {j for i in range(len(words) - 2) if count[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked)


def line_dedup(docs, least):
    """Index of the text in ``docs`` (in order of place) -> numbers of deleted lines: every run of every length is looked up."""
    first, deleted = {}, defaultdict(set)
    rows = [(t.split("\n") if t else []) for _, t in docs]
    runs = []
    for d, lines in enumerate(rows):
        size = [len(x.encode().split()) for x in lines]
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                if sum(size[i:j]) >= least:
                    runs.append((d, i, j, tuple(lines[i:j])))
    for d, i, j, run in runs:
        first[run] = min(first.get(run, (d, i)), (d, i))
    for d, i, j, run in runs:
        if first[run] < (d, i):
            deleted[d].update(range(i, j))
    return deleted
