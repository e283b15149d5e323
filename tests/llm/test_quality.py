from __future__ import annotations

import re
import time
from collections import Counter

import numpy as np
import pytest

from retailgold.llm import quality

from . import brute
from .conftest import ODD

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@pytest.fixture(scope="module")
def refs(table):
    return quality.references(table("documents"))


def test_base_counts_of_the_table(table, refs):
    docs = table("documents")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in quality.judge(docs, refs).collect():
        want = brute.quality(text[r["doc_id"]])
        assert tuple(r[c] for c in COUNTS) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["kept"] and r["base_failed"])


def test_odd_rows(texts, refs):
    rows = ODD + [(10, "x\ny\nx\n\n \nx \nx"), (11, "a b c a b c d a\x0bb\x0cc"), (12, "a b | <c>")]
    got = quality.judge(texts(rows), refs).collect()
    want = sorted((brute.quality(t) for _, t in rows))
    assert sorted(tuple(r[c] for c in COUNTS) for r in got) == want


def test_junk_fails_and_clean_text_stays(table, texts, refs):
    clean = [r for r in table("documents").where("n_chars > 1500").collect()][:20]
    marked = [(100 + i, " ".join(w + "%%%" for w in r["text"].split())) for i, r in enumerate(clean)]
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(texts(marked), refs).collect()}
    assert not any(kept.values())
    labels = table("labels").where("quality = 1 and toxic = 0")
    good = quality.judge(table("documents"), refs).join(labels, "doc_id").where("not base_failed")
    assert good.where("not kept").count() == 0 and good.count() > 20


def test_short_texts_are_not_judged_by_distance(texts, refs):
    junk = lambda n: " ".join(f"| zz{i}" for i in range(n))
    got = {r["doc_id"]: r for r in quality.judge(texts([(1, junk(30)), (2, junk(200))]), refs).collect()}
    assert got[1]["n_words"] < quality.LEAST_WORDS and len(junk(30)) < quality.LEAST_CHARS
    assert got[1]["class_distance"] > quality.FAR_CLASSES and got[1]["kept"] and not got[2]["kept"]


def test_references_over_all_documents(spark, texts):
    refs = quality.references(texts([(1, "the cat the dog"), (2, "the END"), (3, None)]))
    assert len(refs.words) == 4 and abs(refs.shares.sum() - 1) < 1e-12
    assert max(refs.shares) == 0.5 and abs(refs.classes.sum() - 1) < 1e-12


def test_long_words_are_common_too(texts):
    refs = quality.references(texts([(1, "international the international обществознание"), (2, "обществознание INTERNATIONAL")]))
    assert len(refs.words) == 3 and sorted(np.round(refs.shares * 6)) == [0, 1, 2, 3]
    near = quality.judge(texts([(3, "international обществознание")]), refs).collect()[0]
    assert near["word_distance"] < 0.4
    assert not len(quality.references(texts([(1, ""), (2, None)])).classes)


def test_no_reference(texts):
    docs = texts(ODD, lang=None)
    refs = quality.references(docs)
    assert not len(refs.classes)
    assert all(r["kept"] != r["base_failed"] for r in quality.judge(docs, refs).collect())
    assert quality.judge(docs.where("false"), refs).count() == 0


def test_distance():
    same, other = np.array([[2, 2, 0]]), np.array([[0, 0, 5]])
    ref = np.array([0.5, 0.5, 0.0])
    assert quality.distances(same, ref)[0] == 0 and quality.distances(other, ref)[0] == 1


def plain_distance(p, q):
    return sum(x * np.log2(2 * x / (x + y)) for x, y in ((p.get(k, 0), q.get(k, 0)) for k in p.keys() | q.keys()) if x)


def test_distances_and_verdicts_against_plain_histograms(table, refs):
    """Histograms as dicts over whole texts, every language compared, by the definition of the distance."""
    docs = table("documents").collect()
    words = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
    by_lang = {}
    for r in docs:
        if r["lang"] is not None:
            by_lang.setdefault(r["lang"], Counter()).update(words(r["text"]))
    reference = {}
    for lang, counts in by_lang.items():
        total = sum(counts.values())
        kept = {w: n / total for w, n in counts.items() if n >= total * quality.WORD_SHARE}
        reference[lang] = kept | {"": 1 - sum(kept.values())}
    every = set().union(*reference.values())
    got = {r["doc_id"]: r for r in quality.judge(table("documents"), refs).collect()}
    for r in docs:
        counts = Counter(w if w in every else "" for w in words(r["text"]))
        total = sum(counts.values())
        want = 0.0
        if total:
            p = {w: n / total for w, n in counts.items()}
            want = min((max(0.0, plain_distance(p, q) + plain_distance(q, p)) / 2) ** 0.5 for q in reference.values())
        row = got[r["doc_id"]]
        assert abs(row["word_distance"] - want) < 1e-6
        far = (len(r["text"] or "") >= quality.LEAST_CHARS and row["class_distance"] > quality.FAR_CLASSES) or (
            row["n_words"] >= quality.LEAST_WORDS and want > quality.FAR_WORDS)
        assert row["kept"] == (not row["base_failed"] and not far)


def test_thousands_of_languages(spark):
    rows = [(i, f"word{i} and more of word{i % 50}", f"l{i:04d}") for i in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    refs = quality.references(docs)
    assert len(refs.classes) == 3_000 and len(refs.shares) < 20_000
    began = time.time()
    classes, words = refs.nearest([t for _, t, _ in rows] + [None, "nothing known here"])
    assert time.time() - began < 60 and max(words[:3_000]) < 1e-6 and words[3_000] == 0 and words[3_001] > 0.9
