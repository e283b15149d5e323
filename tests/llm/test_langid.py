from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import pytest

from retailgold.llm import langid

from .conftest import ODD


@pytest.fixture(scope="module")
def model(table):
    return langid.train(table("documents"))


def test_held_out_accuracy(table, model):
    docs = table("documents")
    rows = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(texts, model):
    got = {r["doc_id"]: r for r in langid.identify(texts(ODD + [(9, "12 34 !?")]), model).collect()}
    assert [got[k]["lang_pred"] for k in (1, 2, 3, 9)] == ["und"] * 4 and got[9]["score"] == 0
    assert got[4]["lang_pred"] in model.languages and got[None]["held_out"] is False
    assert langid.identify(texts(ODD), model).count() == len(ODD)


def test_only_the_text_decides(texts, model):
    one = langid.identify(texts([(5, "der die und das nicht")], lang=None, source=None), model).first()
    two = langid.identify(texts([(77, "der die und das nicht")], lang="fr", source="x"), model).first()
    assert one["lang_pred"] == two["lang_pred"] == "de" and one["score"] == two["score"]


def test_nothing_to_learn(spark, texts):
    empty = texts(ODD).where("false")
    nothing = langid.train(empty)
    assert langid.identify(empty, nothing).count() == 0
    assert {r["lang_pred"] for r in langid.identify(texts([(1, "abc")]), nothing).collect()} == {"und"}


def test_accepted_keeps_rows_as_they_are(texts, model):
    rows = ODD + [(20, "the and of that with this from for"), (21, "%%% 123")]
    kept = langid.accepted(texts(rows), model)
    assert kept.columns == texts(rows).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 20 in ids and not {1, 2, 3, 21} & set(ids)
    assert {tuple(r) for r in kept.collect()} <= {tuple(r) for r in texts(rows).collect()}


def test_features_see_the_whole_text():
    (a, n), (b, m) = langid.features(["ab " * 50_000, "ab " * 50_000 + "zq"])
    assert set(b) - set(a) and n.sum() < m.sum()


def test_weights_are_sparse_and_temperature_is_fitted():
    draw = random.Random(3)
    rows = []
    for i in range(300):
        lang = "xy"[i % 2]
        text = " ".join("".join(draw.choice("abcde" if lang == "x" else "defgh") for _ in range(5)) for _ in range(6))
        rows.append((*langid.features([text])[0], lang))
    tight = langid.fit(rows, np.ones(langid.SIZE), l1=0.5)
    loose = langid.fit(rows, np.ones(langid.SIZE), l1=0.0)
    assert np.count_nonzero(tight.weights) < np.count_nonzero(loose.weights)
    assert 0.05 <= loose.temperature <= 10


def test_thousands_of_languages_and_the_bound_of_the_sample(spark):
    rows = [(i, f"text {i}", f"l{i % 3_000:04d}") for i in range(6_000)]
    known = spark.createDataFrame(rows, "key bigint, text string, lang string")
    sizes = {f"l{i:04d}": 2 for i in range(3_000)}
    got = langid.labelled(known, sizes, 2_000).collect()
    assert 1_700 < len(got) < 2_300 and all(0 <= r["place"] < 1 for r in got)
    assert sorted(got) == sorted(langid.labelled(known.repartition(7), sizes, 2_000).collect())


def test_the_sample_is_no_larger_than_its_parameter(table, monkeypatch):
    taken = []
    monkeypatch.setattr(langid, "fit", lambda rows, idf: taken.append(len(rows)))
    langid.train(table("documents"), sample=40)
    assert 20 <= taken[0] <= 40


def test_the_driver_holds_the_sample_once(texts):
    draw = random.Random(1)
    long = [("".join(chr(0x4E00 + draw.randrange(20_000)) for _ in range(5_000))) for _ in range(100)]
    docs = texts([(i, t) for i, t in enumerate(long)])
    tracemalloc.start()
    try:
        model = langid.train(docs)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    held = sum(len(f) for f, _ in langid.features(long))
    assert model.languages == ["en"] and held > 500_000
    assert peak < 2 * 8 * held  # a weight for each feature of a text, and not its rows and copies beside them
