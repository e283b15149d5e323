from __future__ import annotations

import random

import numpy as np
import pytest

from retailgold.llm import components, ngram_join
from retailgold.llm.words import shingle_sets

from . import brute
from .conftest import LONG, ODD


def run(docs, **options):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.classes(docs, **options).collect()}


def test_table(table):
    docs = table("documents")
    assert run(docs) == brute.near_duplicates([(r["doc_id"], r["text"]) for r in docs.collect()])


def groups(seed, n_groups, size, words, change):
    """Groups of near copies, each with changes of its own."""
    draw, rows = random.Random(seed), []
    for g in range(n_groups):
        base = [f"g{g}w{draw.randrange(10**6)}" for _ in range(words)]
        for _ in range(size):
            own = list(base)
            for _ in range(draw.randrange(change)):
                own[draw.randrange(words)] = f"x{draw.randrange(10**9)}"
            rows.append(" ".join(own))
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("shape", [(30, 4, 60, 4), (2, 60, 120, 6), (20, 3, 9, 2)])
def test_near_copies_with_links_around_the_limit(texts, shape):
    rows = groups(5, *shape)
    want = brute.near_duplicates(rows)
    assert run(texts(rows)) == want
    assert 1 < len({c for _, c in want.values()}) < len(rows)


def test_common_passage_links_nothing_by_itself(texts):
    draw = random.Random(1)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"o{draw.randrange(10**9)}" for _ in range(draw.choice((15, 40, 90))))) for i in range(60)]
    assert run(texts(rows)) == brute.near_duplicates(rows)


def test_odd_rows(texts):
    rows = ODD + [(8, "SAME Row  twice"), (9, "same row"), (10, LONG + " tail"), (11, "A b\x0bc\x1fd"), (12, "a B c\x1fd")]
    got = ngram_join.classes(texts(rows)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert [(by[k]["n_shingles"], by[k]["component_id"]) for k in (1, 2, 3)] == [(0, 1), (0, 2), (0, 3)]
    assert by[7]["component_id"] == by[8]["component_id"] == 7 and by[9]["component_id"] == 9
    assert by[5]["component_id"] == by[10]["component_id"] == 5 and by[11]["component_id"] == by[12]["component_id"] == 11
    assert by[None]["component_id"] is None and by[None]["n_shingles"] == 1
    assert ngram_join.classes(texts(rows).where("false")).count() == 0


def test_null_key_joins_a_class(texts):
    got = ngram_join.classes(texts([(None, "one two three"), (4, "one two three"), (6, "ONE two three")])).collect()
    assert {r["component_id"] for r in got} == {4}


def test_a_run_over_batches(spark, conf):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    rows = [(t, s, 1, 0) for t in (1, 2, 3) for s in range(t * t)] + [(9, 5, 1, 0), (9, 5, 1, 0)]
    df = spark.createDataFrame(rows, "token bigint, sid bigint, n int, pos int")
    got = sorted((r["token"], r["sid"]) for r in ngram_join.shared_runs(df).collect())
    assert got == [(2, s) for s in range(4)] + [(3, s) for s in range(9)]


def test_suffix_filter_never_refuses_a_similar_pair():
    draw = np.random.default_rng(0)
    for _ in range(300):
        x = np.unique(draw.integers(0, 400, 60).astype(np.uint64))
        y = np.unique(np.concatenate([x[draw.random(len(x)) < draw.random()], draw.integers(0, 400, draw.integers(1, 40)).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        assert ngram_join.suffix_possible(x, y, both)
        assert ngram_join.similar(x, y, 75) == (100 * both >= 75 * (len(x) + len(y) - both))


def test_shingles_equal_python(table):
    texts = [r["text"] for r in table("documents").collect()] + ["", None, "A b\x0bc d e f", "x" * 5]
    got = shingle_sets(texts)
    assert [len(s) for s in got] == [len(brute.shingles(t)) for t in texts]
    for i, a in enumerate(texts[:40]):
        for j, b in enumerate(texts[:i]):
            assert len(np.intersect1d(got[i], got[j])) == len(brute.shingles(a) & brute.shingles(b))


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 300), (300, 100), (7, 7), (400, 400), (None, 5)] + [(1000, i) for i in range(1001, 1100)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in (100, 200, 300)} | {i: 1000 for i in range(1000, 1100)}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_sketches_never_refuse_a_similar_pair():
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 2**63, draw.integers(1, 200)).astype(np.uint64)) for _ in range(60)]
    sets += [np.unique(np.concatenate([s[draw.random(len(s)) < 0.9], draw.integers(0, 2**63, 1 + len(s) // 20).astype(np.uint64)])) for s in sets]
    refused = 0
    for i, x in enumerate(sets):
        for y in sets[:i]:
            both = len(np.intersect1d(x, y))
            allowed = ngram_join.sketches_allow(ngram_join.sketch(x), ngram_join.sketch(y), len(x), len(y), 75)
            assert allowed or 100 * both < 75 * (len(x) + len(y) - both)
            refused += not allowed
    assert refused > 1_000


def test_sets_of_pairs_far_from_the_limit_are_not_sent(texts, monkeypatch):
    draw, seen, folders = random.Random(2), [], []
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"o{draw.randrange(10**9)}" for _ in range(60))) for i in range(20)]
    sets_of, drop = ngram_join.sets_of, ngram_join.drop_scratch
    monkeypatch.setattr(ngram_join, "sets_of", lambda docs, rows, involved, *more: seen.append(involved.count()) or sets_of(docs, rows, involved, *more))
    monkeypatch.setattr(ngram_join, "drop_scratch", lambda spark, path: folders.append(path) or drop(spark, path))
    assert run(texts(rows)) == brute.near_duplicates(rows)
    assert seen and not any(seen)
    assert any("ngram-sets" in f for f in folders) and any("ngram-headed" in f for f in folders)
