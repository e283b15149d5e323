from __future__ import annotations

import hashlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from retailgold.llm import mixing

from . import brute
from .conftest import ODD, SF

COLUMNS_TYPED = ["doc_id bigint", "text string", "lang string", "source string", "n_chars bigint"]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, table, tmp_path_factory):
    docs, out = table("documents"), []
    for name, stage in corpus_pipeline.STAGES:
        path = f"file://{tmp_path_factory.mktemp('stage')}/{name}"
        stage(spark, docs, SF).write.parquet(path)
        out.append((docs.collect(), spark.read.parquet(path)))
        docs = out[-1][1]
    return dict(zip((n for n, _ in corpus_pipeline.STAGES), out))


def test_order_and_columns(steps):
    assert list(steps) == ["language", "lines", "near_duplicates", "mix", "tokens"]
    assert all(steps[n][1].columns == COLUMNS for n in list(steps)[:-1])


def test_clean_documents_stay_in_the_language_stage(steps):
    before, after = steps["language"]
    assert after.count() >= 0.99 * len(before)
    assert {tuple(r) for r in after.collect()} <= {tuple(r) for r in before}


def test_lines(steps):
    before, after = steps["lines"]
    rows = sorted((r["doc_id"], r["text"]) for r in before)
    gone = brute.line_dedup(rows, 50)
    want = {}
    for i, (k, t) in enumerate(rows):
        text = "\n".join(x for j, x in enumerate(t.split("\n")) if j not in gone[i])
        if not gone[i] or brute.WORD.search(text):
            want[k] = text
    assert {r["doc_id"]: r["text"] for r in after.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_one_document_of_each_group_stays(steps):
    before, after = steps["near_duplicates"]
    classes = brute.near_duplicates([(r["doc_id"], r["text"]) for r in before])
    assert {r["doc_id"] for r in after.collect()} == {c for _, c in classes.values()}
    assert {tuple(r) for r in after.collect()} <= {tuple(r) for r in before}


def test_the_mix_keeps_all(steps):
    before, after = steps["mix"]
    assert sorted(tuple(r) for r in after.collect()) == sorted(tuple(r) for r in before)
    first = [r["source"] for r in after.collect()[:60]]
    assert len(set(first)) > 3  # sources alternate from the start


def test_the_mix_survives_the_reread(spark, steps):
    before, after = steps["mix"][0], steps["tokens"][1]
    rows = after.repartition(5).orderBy("position").collect()
    assert len(rows) == len(before) and len({r["position"] for r in rows}) == len(rows)
    want = mixing.mixed(spark.createDataFrame(before, ", ".join(COLUMNS_TYPED))).select("doc_id", "position").collect()
    assert {(r["doc_id"], r["position"]) for r in rows} == {tuple(r) for r in want}
    assert [r["doc_id"] for r in rows] != [r["doc_id"] for r in before]


def test_the_result_has_the_place_that_mix_decided(spark, tmp_path):
    """Also of rows that repeat a doc_id or have none: their order in the mix is that of their positions."""
    data = [(k, f"{k} text {i}", "en", s, 9) for s in "ab" for k in (1, 2, None) for i in range(150)]
    docs = spark.createDataFrame(data, ", ".join(COLUMNS_TYPED)).repartition(7)
    stages = dict(corpus_pipeline.STAGES)
    mixed = stages["mix"](spark, docs, SF).collect()
    assert sorted(map(str, mixed)) == sorted(map(str, docs.collect()))
    again = spark.createDataFrame(mixed, ", ".join(COLUMNS_TYPED)).repartition(5, "text")
    got = stages["tokens"](spark, again, SF)
    assert set(mixing.PLACE) <= set(got.columns) and "source" not in got.columns
    rows = got.orderBy("position").collect()
    assert all(r["release"] <= r["slot"] < r["deadline"] and r["position"] // mixing.BLOCK == r["slot"] for r in rows)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = lambda t: " ".join(map(str, library.encode(t, add_special_tokens=False).ids))
    assert [(r["doc_id"], r["ids_sha256"]) for r in rows] == [(r["doc_id"], hashlib.sha256(ids(r["text"]).encode()).hexdigest()) for r in mixed]


def test_the_result_is_in_the_proportions_of_the_weights(spark, tmp_path):
    left = Counter({"a": 400, "b": 100, "c": 25})
    data = [(i, f"text {i}", "en", s, 6) for i, s in enumerate(left.elements())]
    docs = spark.createDataFrame(data, ", ".join(COLUMNS_TYPED)).repartition(3)
    stages = dict(corpus_pipeline.STAGES)
    stages["mix"](spark, docs, SF).write.parquet(f"file://{tmp_path}/mix")
    stages["tokens"](spark, spark.read.parquet(f"file://{tmp_path}/mix"), SF).write.parquet(f"file://{tmp_path}/tokens")
    rows = spark.read.parquet(f"file://{tmp_path}/tokens").orderBy("position").collect()
    assert len(rows) == len(data)
    weights, seen = {"a": 20 / 35, "b": 10 / 35, "c": 5 / 35}, Counter()
    for total, r in enumerate(rows, 1):
        seen[data[r["doc_id"]][3]] += 1
        if any(left[s] - seen[s] < mixing.BLOCK for s in left):  # until a source runs out
            break
        assert all(abs(seen[s] - total * w) < 2 * mixing.BLOCK for s, w in weights.items())
    assert total > 100


def test_tokens_and_run(spark, steps):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    before, after = steps["tokens"]
    text = {r["doc_id"]: r["text"] for r in before}
    rows = after.collect()
    for r in rows:
        ids = library.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == sorted(tuple(r) for r in rows)


def test_odd_rows_in_every_stage(spark, table, texts):
    odd = texts(ODD + ODD, lang=None, source=None).select(*COLUMNS)
    docs = table("documents").where("doc_id >= 100").select(*COLUMNS).unionByName(odd)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF)
        assert got.columns == COLUMNS or name == "tokens"
        ids = [r["doc_id"] for r in got.collect()]
        if name in ("mix", "tokens"):
            assert len(ids) == docs.count()
        if name == "near_duplicates":
            assert ids.count(7) == 1 and ids.count(None) == 1 and {1, 2, 3} <= set(ids)
        assert stage(spark, docs.where("false"), SF).count() == 0


def test_rows_of_one_id_are_decided_on_their_own(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    data = [(1, a), (2, a + " tail"), (2, b), (None, b), (None, c), (None, c + " end"), (3, None), (3, None), (None, "")]
    docs = spark.createDataFrame([(k, t, "en", "s", 1, "x") for k, t in data], ", ".join(COLUMNS_TYPED) + ", _row string")
    got = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF)
    assert got.columns == docs.columns
    rows = Counter((r["doc_id"], r["text"]) for r in got.collect())
    lone = [k for k in rows if k in ((None, c), (None, c + " end"))]
    assert len(lone) == 1 and rows == Counter([(1, a), (2, b), *lone, (3, None), (3, None), (None, "")])
