from __future__ import annotations

import numpy as np
import pytest

from retailgold.llm import caps


def frame(spark, rows):
    return spark.createDataFrame([(k, v, label, 1, "x") for k, v, label in rows], "vec_id bigint, embedding array<double>, label int, node int, space string").repartition(3)


def brute(rows, limit=0.93):
    good = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    near = {i: set() for i in range(len(rows))}
    for a in good:
        for b in good:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[i][1], float) / np.abs(rows[i][1]).max() for i in (a, b))
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= limit:
                    near[a].add(b), near[b].add(a)
    out = []
    for i, (k, _, _) in enumerate(rows):
        seen, edge = {i}, [i]
        while edge:
            new = near[edge.pop()] - seen
            seen |= new
            edge += new
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((k, len(near[i]), low, k is not None and k == low))
    return sorted(out, key=str)


def run(spark, rows, **options):
    return sorted((tuple(r) for r in caps.near_duplicates(frame(spark, rows), **options).collect()), key=str)


def near_copies(draw, center, cosine, n):
    """Vectors at exactly a cosine of the center."""
    out = []
    for _ in range(n):
        noise = draw.standard_normal(len(center))
        noise -= noise @ center * center
        out.append(cosine * center + np.sqrt(1 - cosine**2) * noise / np.linalg.norm(noise))
    return out


def unit(draw, size):
    x = draw.standard_normal(size)
    return x / np.linalg.norm(x)


def test_against_all_pairs(spark):
    draw = np.random.default_rng(1)
    rows = [(i, unit(draw, 64).tolist(), i % 3) for i in range(200)]
    for c in range(12):
        center = unit(draw, 64)
        rows += [(1000 * (c + 1) + i, (v * (i + 1)).tolist(), c % 3) for i, v in enumerate([center, *near_copies(draw, center, 0.97, 5)])]
    assert run(spark, rows) == brute(rows)


def test_recall_at_the_limit(spark):
    draw = np.random.default_rng(2)
    rows = []
    for c in range(400):
        center = unit(draw, 64)
        rows += [(2 * c, center.tolist(), 0), (2 * c + 1, near_copies(draw, center, 0.9305, 1)[0].tolist(), 0)]
    got = sum(r[1] for r in run(spark, rows))
    assert got >= 0.99 * 800


@pytest.mark.parametrize("size", [24, 32, 64])
@pytest.mark.parametrize("vectors", [1_000_000, 100_000_000])
def test_recall_with_the_filters_of_a_large_table(size, vectors):
    code = caps.ProductCode(size, caps.FILTERS_PER_VECTOR * vectors)
    draw = np.random.default_rng(5)
    x = np.array([unit(draw, size) for _ in range(1000)])
    y = np.array([near_copies(draw, v, 0.9305, 1)[0] for v in x])
    shared = [len(np.intersect1d(a, b)) for i in range(0, 1000, 250) for a, b in zip(code.filters(x[i : i + 250]), code.filters(y[i : i + 250]))]
    assert np.mean(shared) >= 33 and np.mean(np.array(shared) == 0) <= 0.005


def test_links_with_the_filters_of_a_large_table(spark, monkeypatch):
    monkeypatch.setattr(caps, "FILTERS_PER_VECTOR", 8_000_000)  # 800 vectors have the filters of 100 million
    draw = np.random.default_rng(6)
    rows = []
    for c in range(400):
        center = unit(draw, 32)
        rows += [(2 * c, center.tolist(), 0), (2 * c + 1, near_copies(draw, center, 0.9305, 1)[0].tolist(), 0)]
    assert sum(r[1] for r in run(spark, rows)) >= 0.99 * 800


def test_crowded_filter_is_split_and_counted_once(spark, monkeypatch):
    monkeypatch.setattr(caps, "CHUNK", 8)
    draw = np.random.default_rng(3)
    center = unit(draw, 32)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(near_copies(draw, center, 0.97, 60))]
    rows += [(100 + i, rows[0][1], 1) for i in range(30)]  # copies of one vector
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    a = [1.0, 2.0, 0.5]
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [nan, 1.0, 1.0], 1), (5, [inf, 1.0, 1.0], 1), (6, [None, 1.0, 2.0], 1),
        (7, a, None), (8, a, 1), (9, a, 1), (9, a, 1), (None, a, 1), (10, [2.0, 4.0, 1.0], 1), (11, a, 2), (12, [1.0, 2.0], 1),
        (13, [1e-300, 2e-300, 5e-301], 1), (14, [1e300, 2e300, 5e299], 1), (15, [-1.0, -2.0, -0.5], 1),
    ]
    assert run(spark, rows) == brute(rows)
    assert caps.near_duplicates(frame(spark, rows).where("false")).count() == 0


def test_decoding_finds_exactly_the_best_filters():
    code = caps.ProductCode(32, 10_000)
    draw = np.random.default_rng(4)
    x = np.array([unit(draw, 32) for _ in range(20)])
    for row, found in zip(x, code.filters(x)):
        parts = (row @ code.rotation).reshape(caps.BLOCKS, -1)
        s = [code.code[b] @ parts[b] for b in range(caps.BLOCKS)]
        total = (s[0][:, None, None, None] + s[1][None, :, None, None] + s[2][None, None, :, None] + s[3][None, None, None, :]).ravel()
        assert set(found.tolist()) == set(np.argsort(-total)[: caps.PER_VECTOR].tolist())
