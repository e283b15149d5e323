from __future__ import annotations

import random

import pytest

from retailgold.llm import line_dedup

from . import brute
from .conftest import LONG, ODD


def check(docs, rows, least=line_dedup.LEAST_WORDS):
    """``rows`` have distinct keys and are in order of place."""
    want = brute.line_dedup(rows, least)
    got = {r["doc_id"]: r for r in line_dedup.deduplicated(docs, least=least).collect()}
    assert len(got) == len(rows)
    for i, (k, t) in enumerate(rows):
        lines = t.split("\n") if t else []
        assert got[k]["n_lines"] == len(lines) and got[k]["n_deleted"] == len(want[i])
        assert got[k]["text"] == (t if not want[i] else "\n".join(x for j, x in enumerate(lines) if j not in want[i]))
    return sum(map(len, want.values()))


def test_table(table):
    docs = table("documents")
    assert check(docs, [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]) > 0


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_short_lines(texts, seed):
    draw = random.Random(seed)
    lines = [" ".join(f"l{i}" for _ in range(draw.choice((0, 1, 2, 5, 11)))) for i in range(6)] + ["", "a", "a"]
    rows = [(i, "\n".join(draw.choices(lines, k=draw.randrange(1, 25)))) for i in range(40)]
    rows += [(100 + i, "\n".join(rows[i][1].split("\n")[2:] + ["own"])) for i in range(10)]
    assert check(texts(rows), rows, least=10) > 50


def test_runs_from_different_places_do_not_add_up(texts):
    rows = [(1, "a b c\nx1"), (2, "d e f\nx2"), (3, "a b c\nd e f\nx3"), (4, "a b c\nd e f\nx4")]
    assert check(texts(rows), rows, least=5) == 2  # only the fourth repeats a run of six words


def test_periodic_text_keeps_its_first_line(texts):
    rows = [(1, "\n".join(["one two three"] * 9))]
    assert check(texts(rows), rows, least=4) == 8


def test_long_passage_across_documents(texts):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"head {i}\n{passage}\ntail {i}") for i in range(30)] + [(99, "short line\nshort line\nhead 1")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(texts(rows)).collect()}
    assert passage in got[0] and all(got[i] == f"head {i}\ntail {i}" for i in range(1, 30)) and got[99] == rows[-1][1]


def test_odd_rows(texts):
    twice = (7, LONG)
    rows = [r for r in ODD if r[0] != 7] + [twice, twice, (8, LONG), (None, LONG)]
    got = line_dedup.deduplicated(texts(rows))
    assert got.columns == [*texts(rows).columns, "n_lines", "n_deleted"] and got.count() == len(rows)
    by = {}
    for r in got.collect():
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["text"] is None and by[2][0]["text"] == "" and by[5][0]["text"] == LONG
    assert [r["text"] for r in by[7]] == ["", ""] and by[8][0]["n_deleted"] == 1  # later copies of document 5
    assert {r["text"] for r in by[None]} == {"", "no key here"}
    assert line_dedup.deduplicated(texts(rows).where("false")).count() == 0


def test_repeated_rows_are_one_place(texts):
    rows = [(5, "u v w x y z"), (5, "u v w x y z"), (6, "u v w x y z")]
    got = sorted((r["doc_id"], r["text"]) for r in line_dedup.deduplicated(texts(rows), least=3).collect())
    assert got == [(5, "u v w x y z"), (5, "u v w x y z"), (6, "")]


def test_shortest_runs():
    assert line_dedup.shortest_runs([60, 5], 50) == [(0, 1), (0, 2)]
    assert line_dedup.shortest_runs([5, 60], 50) == [(0, 2), (1, 1)]
    assert line_dedup.shortest_runs([1, 2], 50) == []
