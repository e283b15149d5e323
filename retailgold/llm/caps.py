"""Near-duplicate vectors by spherical-cap filters.

Filter directions are a product code: the rotated space is cut into four blocks, each with random unit code words, and a
direction is one word per block.  A vector is list-decoded to the directions that exceed its threshold, without looking at
the others; the threshold is set for each vector so that a given number of directions do.  Vectors meet where they share a
filter and are verified by their cosine in double precision.  The code grows with the number of vectors, so that a filter is
passed by a few vectors at any size, and its caps get smaller; the directions of a vector grow with the words of a block, from
``PER_VECTOR`` at ``LEAST_FILTERS`` on, so that two vectors at the similarity limit share 33 filters or more on average at any
size.  Tests measure the recall with the filters of large tables.
Vectors of fewer than ``LEAST_SIZE`` components have too few separate caps: they all pass one filter.

Equal vectors of a label are one node.  A filter's vectors are split into chunks, and a pair of chunks is a unit of work, so a
filter that many vectors pass spreads over many tasks.  A pair is counted at the lowest filter that both pass; what leaves
a unit is a sum per vector and a star per connected group, never the pairs.

Vectors that are null, zero, or hold null or non-finite components, and those with a null label, link with nothing; neither do
vectors of different lengths.  Rows that repeat a key are vectors of their own; null keys link, and count, but name no class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailgold.llm.components import components
from retailgold.llm.frames import arrow_schema, by_batch, small_batches, stored

LIMIT = 0.93
BLOCKS = 4
FILTERS_PER_VECTOR = 64
LEAST_FILTERS = 1 << 20
LEAST_SIZE = 24
PER_VECTOR = 96
CHUNK = 256
WIDE = 6


def per_vector(words: int) -> int:
    """Directions a vector is decoded to, in proportion to the words of a block."""
    return min(words**2, max(PER_VECTOR, math.ceil(PER_VECTOR * words / LEAST_FILTERS ** (1 / BLOCKS))))


class ProductCode:
    """Code words of each block for vectors of one length, the same in every process."""

    def __init__(self, size: int, filters: int, seed: int = 11):
        draw = np.random.default_rng([seed, size])
        self.words = math.ceil(filters ** (1 / BLOCKS))
        self.per_vector = per_vector(self.words)
        width = -(-size // BLOCKS)
        padded = width * BLOCKS
        self.rotation = np.linalg.qr(draw.standard_normal((padded, padded)))[0][:size]
        code = draw.standard_normal((BLOCKS, self.words, width))
        self.code = code / np.linalg.norm(code, axis=2, keepdims=True)
        # of two sorted lists the a-th and b-th best can only be among the best per_vector sums if a * b is not more
        rank = np.arange(1, self.per_vector + 1)
        self.left, self.right = np.nonzero(rank[:, None] * rank[None, :] <= self.per_vector)
        inside = (self.left < self.words) & (self.right < self.words)
        self.first, self.second = self.left[inside], self.right[inside]

    def filters(self, unit: np.ndarray) -> np.ndarray:
        """Sorted numbers of the per_vector best filters of each row of unit vectors."""
        n, k = len(unit), self.words
        x = (unit @ self.rotation).reshape(n, BLOCKS, -1)
        score = np.einsum("nbw,bkw->nbk", x, self.code)
        order = np.argsort(-score, axis=2, kind="stable")
        score = np.take_along_axis(score, order, 2)
        halves = []
        for b in (0, 2):
            sums = score[:, b, self.first] + score[:, b + 1, self.second]
            best = np.argpartition(-sums, self.per_vector - 1, axis=1)[:, : self.per_vector]
            best = np.take_along_axis(best, np.argsort(-np.take_along_axis(sums, best, 1), axis=1, kind="stable"), 1)
            number = np.take_along_axis(order[:, b], self.first[best], 1) * k + np.take_along_axis(order[:, b + 1], self.second[best], 1)
            halves.append((number, np.take_along_axis(sums, best, 1)))
        (left, left_sum), (right, right_sum) = halves
        sums = left_sum[:, self.left] + right_sum[:, self.right]
        best = np.argpartition(-sums, self.per_vector - 1, axis=1)[:, : self.per_vector]
        return np.sort(np.take_along_axis(left, self.left[best], 1) * (k * k) + np.take_along_axis(right, self.right[best], 1), axis=1)


def _units(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares of very large or small numbers stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def passed(nodes: DataFrame, filters: int) -> DataFrame:
    """(node, filters): the filter numbers of each node."""

    def make():
        codes: dict[int, ProductCode] = {}

        def work(ids, vectors):
            out: list[list[int]] = [[0]] * len(ids)
            for size in {len(v) for v in vectors}:
                if size < LEAST_SIZE:
                    continue
                at = [i for i, v in enumerate(vectors) if len(v) == size]
                if size not in codes:
                    codes[size] = ProductCode(size, filters)
                for start in range(0, len(at), 256):
                    part = at[start : start + 256]
                    for i, f in zip(part, codes[size].filters(_units(np.array([vectors[i] for i in part])))):
                        out[i] = f
            return ids, out

        return work

    return by_batch(nodes.select("node", "embedding"), make, "node bigint, filters array<bigint>")


def _earlier(lists: list[np.ndarray], at: int) -> np.ndarray:
    """Which pairs share a filter below ``at``."""
    low = [f[: np.searchsorted(f, at)] for f in lists]
    known, column = np.unique(np.concatenate(low), return_inverse=True)
    held = np.zeros((len(lists), len(known)), np.float32)
    held[np.repeat(np.arange(len(lists)), [len(f) for f in low]), column] = 1
    return held @ held.T > 0


def _unit(filter_: int, sides: np.ndarray | None, nodes, copies, x, lists, limit: float) -> list[tuple[int, int | None, int]]:
    """Sums and stars of one filter's chunk, or of the pairs between two chunks where ``sides`` tells them apart."""
    near = x @ x.T >= limit
    if sides is not None:
        near &= sides[:, None] != sides[None, :]
    np.fill_diagonal(near, False)
    if not near.any():
        return []
    counted = near & ~_earlier(lists, filter_)
    sums = counted @ copies
    out: list[tuple[int, int | None, int]] = [(int(nodes[i]), None, int(sums[i])) for i in np.flatnonzero(sums)]
    left = near.any(1)
    while left.any():
        start = int(np.argmax(left))
        group, edge = np.zeros(len(nodes), bool), np.zeros(len(nodes), bool)
        edge[start] = True
        while edge.any():
            group |= edge
            edge = near[edge].any(0) & ~group
        out += [(int(nodes[start]), int(nodes[i]), 0) for i in np.flatnonzero(group) if i != start]
        left &= ~group
    return out


def _split(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column end to end, and where each list starts and the last ends."""
    sizes = column.value_lengths().to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)])


def _groups(table: pa.Table, limit: float) -> list[tuple[int, int | None, int]]:
    """All units of a table that holds whole units, neighbours by unit."""
    keys = np.stack([table.column(i).to_numpy() for i in range(4)])
    chunk, nodes, copies = (table.column(i).to_numpy() for i in (4, 5, 6))
    vectors, bounds = _split(table.column(7).combine_chunks())
    numbers, places = _split(table.column(8).combine_chunks())
    first = np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(0)])
    group = np.cumsum(first) - 1
    starts = np.append(np.flatnonzero(first), len(first))
    sizes = np.diff(bounds)
    out = []
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        x = _units(vectors[bounds[rows][:, None] + np.arange(size)])
        mine = group[rows]
        # most units hold a few vectors, none of them alike: these are settled side by side
        wide = np.bincount(mine, minlength=len(starts) - 1) > WIDE
        found = set(np.flatnonzero(wide).tolist())
        for step in range(1, min(WIDE, len(rows))):
            at = np.flatnonzero((mine[step:] == mine[:-step]) & ~wide[mine[step:]])
            near = np.einsum("ij,ij->i", x[at], x[at + step]) >= limit
            found.update(mine[at[near]].tolist())
        for g in sorted(found):
            a, b = starts[g], starts[g + 1]
            at = np.searchsorted(rows, a)
            p, q = keys[2, a], keys[3, a]
            lists = [numbers[places[i] : places[i + 1]] for i in range(a, b)]
            out += _unit(int(keys[1, a]), None if p == q else chunk[a:b], nodes[a:b], copies[a:b], x[at : at + b - a], lists, limit)
    return out


def linked(units: DataFrame, limit: float) -> DataFrame:
    """Rows sorted by unit to (node, other, links): sums where ``other`` is null, stars elsewhere."""
    small_batches(units.sparkSession)
    schema_text = "node bigint, other bigint, links bigint"
    schema = arrow_schema(schema_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(table: pa.Table) -> pa.RecordBatch:
            out = _groups(table, limit) if table.num_rows else []
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], schema=schema)

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            if not table.num_rows:
                continue
            keys = np.stack([table.column(i).to_numpy() for i in range(4)])
            last = int(np.flatnonzero((keys != keys[:, -1:]).any(0))[-1]) + 1 if (keys != keys[:, -1:]).any() else 0
            held = table.slice(last)
            if last:
                yield result(table.slice(0, last))
        if held is not None:
            yield result(held)

    return units.mapInArrow(run, schema_text)


def near_duplicates(
    rows: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding", limit: float = LIMIT
) -> DataFrame:
    """(key, n_links, component_id, kept) of every row."""
    v = F.col("embedding")
    rows = rows.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("embedding"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    nodes = rows.where(usable).groupBy("label", "embedding").agg(F.min("key").alias("least"), F.count("*").alias("copies"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "caps-nodes")
    filters = max(LEAST_FILTERS, FILTERS_PER_VECTOR * nodes.count())
    hits = nodes.select("node", F.xxhash64("label", F.size("embedding")).alias("space")).join(passed(nodes, filters), "node")
    hits = stored(hits.select("node", "space", F.explode("filters").alias("filter")), "caps-hits")
    busy = hits.groupBy("space", "filter").agg(F.count("*").alias("n")).where("n > 1")
    hits = stored(hits.join(busy, ["space", "filter"]), "caps-busy")
    # a vector's filters that others pass too: where a pair is counted shows on them
    vectors = nodes.select("node", "copies", "embedding").join(
        hits.groupBy("node").agg(F.sort_array(F.collect_list("filter")).alias("filters")), "node"
    )
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    hits = hits.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int")).withColumn(
        "mate", F.explode(F.sequence(F.lit(0), chunks - 1))
    )
    unit = ["space", "filter", "p", "q"]
    units = hits.select(
        "space", "filter", F.least("chunk", "mate").alias("p"), F.greatest("chunk", "mate").alias("q"), "chunk", "node"
    ).join(vectors, "node")
    units = units.select(*unit, "chunk", "node", "copies", "embedding", "filters").repartition(*unit).sortWithinPartitions(*unit)
    found = stored(linked(units, limit), "caps-links")
    sums = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    stars = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    nodes = nodes.join(sums, "node", "left").join(stars, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    nodes = nodes.join(least, "component").select(
        "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    out = rows.where(usable).join(nodes, ["label", "embedding"]).select("key", "n_links", "component_id").unionByName(
        rows.where(~usable).select("key", F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component_id"))
    )
    return out.select(F.col("key").alias(key), "n_links", "component_id", F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)).alias("kept"))
