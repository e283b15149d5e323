from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from retailgold.llm import collocations
from retailgold.llm.queries import op11_collocations
from tests.llm.conftest import ODD, SF


def phrases(rows, least, top=2_000):
    """(lang, rank, phrase, a, l, r, n, score) by definition, from (text, lang)."""
    often, size = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            size[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    often[lang, tuple(words[i : i + k])] += 1
    found = {p: a for p, a in often.items() if len(p[1]) > 1 and a >= least}
    covered = {
        (lang, p[i : i + k]) for (lang, p), a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if a >= found[lang, p[i : i + k]]
    }
    out = defaultdict(list)
    for (lang, p), a in found.items():
        if (lang, p) not in covered:
            cuts = ((1000 * a * size[lang] // (often[lang, p[:k]] * often[lang, p[k:]]), k) for k in range(1, len(p)))
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(p).encode(), often[lang, p[:k]], often[lang, p[k:]]))
    return {(g, i + 1, p.decode(), -a, l, r, size[g], -s) for g, v in out.items() for i, (s, a, p, l, r) in enumerate(sorted(v)[:top])}


def mined(docs, **options):
    rows = [tuple(r) for r in collocations.mine(docs, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("least,top", [(4, 2_000), (9, 7)])
def test_against_brute_force(table, least, top):
    docs = table("documents").select("text", "lang")
    assert mined(docs.repartition(5), least=least, top=top) == phrases([tuple(r) for r in docs.collect()], least, top)


def test_query(spark, table):
    docs = [tuple(r) for r in table("documents").select("text", "lang").collect()]
    assert {tuple(r) for r in op11_collocations(spark, SF).collect()} == phrases(docs, 100)


def test_phrases_that_are_reached_late(spark):
    """A phrase of five words whose parts reach the threshold one after the other, and one inside a longer one."""
    rows = [("a b c d e. x", "en")] * 6 + [("p q r s t", "en"), ("p q r s", None)] * 5 + [("q r, s t", "en")] * 3 + [("z z z z z z", "en")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    assert mined(docs, least=5) == phrases(rows, 5)


def test_full_bitmaps_change_nothing(spark, table, monkeypatch):
    """With every bit set, phrases are only looked at more often."""
    docs = table("documents").select("text", "lang").limit(60)
    want = phrases([tuple(r) for r in docs.collect()], 4)
    real = collocations.marked
    monkeypatch.setattr(collocations, "marked", lambda counts, least: real(counts, least) | np.uint8(255))
    monkeypatch.setattr(collocations, "pair_filter", lambda parts, least: np.full(collocations.BITS // 8, 255, np.uint8))
    assert mined(docs, least=4) == want


def test_bits_of_other_phrases_lose_no_shard(spark, table, monkeypatch):
    """A bit that another phrase set earlier than the phrase's parts were admitted does not end its cycle early."""
    docs = table("documents").select("text", "lang").limit(60)
    want = phrases([tuple(r) for r in docs.collect()], 4)
    real, noise = collocations.marked, np.random.default_rng(3).integers(0, 256, collocations.BITS // 8).astype(np.uint8)
    monkeypatch.setattr(collocations, "marked", lambda counts, least: real(counts, least) | noise)
    assert mined(docs, least=4) == want


def test_pieces_and_letters(spark):
    rows = [("One TWO\tthree; Ärger Ä\x0bone two\rone  two:one two", "de"), ("one two three", "de")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert mined(docs, least=1) == phrases(rows, 1)


def test_odd_rows(spark, texts):
    docs = texts(ODD)
    assert mined(docs, least=2) == phrases([(t, "en") for _, t in ODD], 2)
    assert mined(texts([(1, None), (2, " ")])) == set() == mined(texts([]).where("false"))
    rows = [("a b", None), ("a b", "und"), ("a b", "")]
    assert mined(spark.createDataFrame(rows, "text string, lang string"), least=1) == phrases(rows, 1)


def test_exact_arithmetic(spark):
    """Products that pass 64 bits."""
    value = spark.sql("select cast(9e18 as decimal(19,0)) as x, cast(3 as decimal(19,0)) as y").select(collocations._quotient("x", "y").alias("q")).first()["q"]
    assert value == 3_000_000_000_000_000_000
