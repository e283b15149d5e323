from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from retailgold.llm import structure
from retailgold.llm.queries import op12_structure
from tests.llm.brute import sha
from tests.llm.conftest import SF

TABLE = "conv_id bigint, turn bigint, role string, text string, audit string, part int"


def cheapest(rows):
    """By definition: every way through the rows, step by step, keeping the best (cost, letters) of each state of the pattern."""
    seen, faults = set(), []
    for _, role, text in rows:
        said = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    who = {"s": "system", "u": "user", "a": "assistant"}

    def better(ways, state, way):
        if state not in ways or way[:2] < ways[state][:2]:
            ways[state] = way

    def inserted(ways):
        for _ in range(3):
            for q, (c, a, out) in list(ways.items()):
                n = "a" if q == "u" else "u"
                better(ways, n, (c + 2, a + "I", [*out, (who[n], "")]))
        return ways

    ways = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for q, (c, a, out) in inserted(ways).items():
            better(new, q, (c + 3, a + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            c += fault == "truncated"
            if role[:1] and role[:1] in after[q]:
                better(new, role[:1], (c, a + "K", [*out, (role, text)]))
            n = "a" if q == "u" else "u"
            better(new, n, (c + 2, a + "R", [*out, (who[n], text)]))
        ways = new
    cost, audit, out = min(w for q, w in inserted(ways).items() if q in ("", "a"))
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:]))
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, out


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        lot = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if lot:
            text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
            out += [(c, t, "user" if lot == 4 else role, text)] * (2 if lot == 3 else 1)
    return out


def grouped(rows, ids):
    by = {c: [] for c in ids}
    for c, t, role, text in rows:
        by[c].append((t, role, text))
    place = lambda r: (r[0] is not None, r[0] or 0, r[1], sha(r[2]))
    return {c: sorted(rs, key=place) for c, rs in by.items()}


def made(seed, conversations, longest):
    rnd = random.Random(seed)
    for c in [*range(conversations), None]:
        for t in range(rnd.randrange(longest)):
            role = rnd.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"])
            yield c, rnd.choice([t, t, t, None, t + 3]), role, rnd.choice(["a.", "b", "", " \t", None, "c!", "d? ", f"x{t}.", f"y{t}"])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "mine", 1) for r in rows], TABLE).repartition(4)


def result(df):
    return {r["conv_id"]: (*r[1:8], [(t["role"], t["text"]) for t in r["repaired"]]) for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rows = list(made(seed, 40, 14))
    df = frame(spark, rows)
    ids = {r[0] for r in rows}
    assert result(structure.repair(structure.damage(df), df)) == {c: cheapest(rs) for c, rs in grouped(damaged(rows), ids).items()}


def test_long_conversation_over_several_partitions(spark):
    rnd = random.Random(3)
    rows = [(7, t, rnd.choice(["user", "assistant", "system"]), rnd.choice([f"x{t}.", f"y{t}", "same."])) for t in range(300)] + [(8, 1, "user", "again.")] * 200
    want = {c: cheapest(rs) for c, rs in grouped(rows, {7, 8}).items()}
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert result(structure.repair(frame(spark, rows))) == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_blocks():
    for codes, entry, want in [("", 0, {0: (0, "")}), ("u", 0, {0: (3, "D"), 2: (0, "K"), 3: (4, "IR")}), ("-", 2, {2: (3, "D"), 3: (5, "ID")}), ("A", 2, {2: (3, "D"), 3: (1, "K")})]:
        found = structure.through(codes, entry)
        assert {q: found[q] for q in want} == want


def test_auction_prices_are_duals():
    codes = "sUua-xA"
    arcs = structure._leading_to(structure._arcs(codes), 4 * len(codes) + 3)
    price = [0] * len(arcs)
    structure.auction(arcs, 0, 4 * len(codes) + 3, price)
    assert all(price[v] <= c + price[t] for v, out in enumerate(arcs) for _, c, t in out)
    letters = structure.trace(arcs, 0, 4 * len(codes) + 3, price)
    at, cost = 0, 0
    for x in letters:
        c, at = next((c, t) for letter, c, t in arcs[at] if letter == x)
        cost += c
    assert at == 4 * len(codes) + 3 and cost == price[0] - price[at]


def test_odd_rows(spark):
    long = "wörd " * 60_000
    rows = [(1, 0, None, None), (1, 1, "user", long), (1, 2, "assistant", "Yes."), (None, None, "user", "Hi."), (None, None, "user", "Hi.")]
    got = result(structure.repair(frame(spark, rows)))
    assert got == {c: cheapest(rs) for c, rs in grouped([(c, t, r or " ", x or " ") for c, t, r, x in rows], {1, None}).items()}
    assert got[1][-1] == [("user", long), ("assistant", "Yes.")] and got[1][5:7] == (4, "DKK")
    empty = frame(spark, rows).where("false")
    assert structure.repair(empty).count() == 0
    left = structure.repair(empty, frame(spark, rows)).collect()
    assert {r["conv_id"] for r in left} == {1, None} and all(r["cost"] == 0 and r["audit"] == "" and r["repaired"] == [] for r in left)


def test_query_against_brute_force(spark, table):
    rows = [tuple(r) for r in table("conversations").collect()]
    want = {c: cheapest(rs) for c, rs in grouped(damaged(rows), {r[0] for r in rows}).items()}
    got = {r["conv_id"]: r for r in op12_structure(spark, SF).collect()}
    assert set(got) == set(want)
    for c, w in want.items():
        assert tuple(got[c][n] for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")) == w[:7]
        assert got[c]["repaired_sha256"] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in w[7]).encode()).hexdigest()
