from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from retailgold.llm import mixing


def frame(spark, sizes):
    rows = [(f"{s}{i}" if s else f"n{i}", s, "x", 7) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "doc_id string, source string, text string, slot int").repartition(4)


def test_plan_keeps_every_source_within_a_block():
    share = mixing.shares({"a": 5, "b": 3, "c": 1.7, "d": 0.01, None: 2})
    rows = mixing.plan(share)
    assert sum(share.values()) == len(rows) == mixing.PERIOD and share["d"] >= 1
    done = Counter()
    for s, block, release, deadline, slot in rows:
        assert release <= slot < deadline and block == done[s]
        done[s] += 1
        for x, a in share.items():
            assert abs(done[x] - (slot + 1) * a / mixing.PERIOD) < 1
    assert done == share


def test_shares():
    assert mixing.shares({"a": 1, "b": 1, "c": 1}, 10) == {"a": 4, "b": 3, "c": 3}
    assert mixing.shares({"a": 1e9, "b": 1, "c": 1}, 10) == {"a": 8, "b": 1, "c": 1}
    with pytest.raises(ValueError, match="period"):
        mixing.shares({i: 1 for i in range(11)}, 10)
    with pytest.raises(ValueError, match="positive"):
        mixing.shares({"a": 0})


def test_mix(spark):
    sizes = {"a": 900, "b": 300, "c": 40, None: 60}
    rows = mixing.mixed(frame(spark, sizes), {"a": 5, "b": 4, "c": 1, None: 2}, block=4).orderBy("position").collect()
    assert Counter(r["source"] for r in rows) == sizes and len({r["position"] for r in rows}) == len(rows)
    share = {r["source"]: r["share"] for r in rows}
    seen, left, total = Counter(), dict(sizes), 0
    for r in rows:
        assert r["release"] <= r["slot"] < r["deadline"]
        if min(left.values()) >= 4:  # until a source runs out
            seen[r["source"]] += 1
            total += 1
            for s, a in share.items():
                assert abs(seen[s] / 4 - total / 4 * a / mixing.PERIOD) < 2  # a block that is under way counts in part
        left[r["source"]] -= 1


def test_more_sources_than_slots(spark):
    sizes = {f"host{i}": 1 + 40 * (i < 3) for i in range(1_500)} | {None: 2}
    rows = mixing.mixed(frame(spark, sizes), block=4).orderBy("position").collect()
    assert Counter(r["source"] for r in rows) == sizes and len({r["position"] for r in rows}) == len(rows)
    share = {r["source"]: r["share"] for r in rows}
    assert sum(share.values()) == mixing.period_of(len(sizes)) and min(share.values()) >= 1
    assert share["host0"] > 5 * share["host9"]
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in rows)


def test_order_within_a_source(spark):
    rows = mixing.mixed(frame(spark, {"a": 5_000}), block=8).orderBy("position").collect()
    assert [r["doc_id"] for r in rows] == sorted((r["doc_id"] for r in rows), key=lambda k: hashlib.md5(k.encode()).hexdigest())
    assert [r["block"] for r in rows] == [i // 8 for i in range(5_000)]


def test_odd_rows(spark):
    rows = [(1, "a", "t"), (1, "a", "t"), (1, "b", None), (None, "a", ""), (None, None, "z"), (2, "", "y"), (3, "-", "y"), (4, "+a", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = mixing.mixed(docs).collect()
    assert Counter((r["doc_id"], r["source"], r["text"]) for r in got) == Counter(rows)
    assert len({r["position"] for r in got}) == len(rows)
    assert mixing.mixed(docs.where("false")).count() == 0
    with pytest.raises(ValueError, match="no target weight"):
        mixing.mixed(docs, {"a": 1})


def test_no_python_in_the_plan(spark, capsys):
    mixing.mixed(frame(spark, {"a": 9, "b": 5})).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
