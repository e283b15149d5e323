"""Mixing sources to target weights by Pfair scheduling.

A source's rows, in an order of their own (MD5 of the key), are cut into blocks.  With target weight w, block i (from 0) is
released at slot floor(i / w) and due by slot ceil((i + 1) / w); each slot goes to the released block with the earliest
deadline.  Weights are whole shares of a period, so the plan repeats after ``PERIOD`` slots and is a table of that size; more
sources than that have a longer period, ``SLOTS_PER_SOURCE`` slots for each.  Slots of a source that has run out are passed over.
No row is left out and none comes twice.

Up to the point where a source runs out, each source has at any time less than one block more or less than its share of the
period asks for.  The share is the target weight rounded to a whole slot, at least one, so the deviation from the weight itself
grows with every period.  The driver holds the sources and the plan of one period.

Everything here is DataFrame functions; a source's rank runs over bins of neighbouring keys, so a source that holds
most of the rows is spread over many tasks.  Rows with a null source are a source of their own (null), null keys sort first;
rows that repeat a key follow one another.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PERIOD = 1_000
SLOTS_PER_SOURCE = 10
BLOCK = 8
BIN_ROWS = 2_000
PLACE = ("share", "block", "release", "deadline", "slot", "position")


def shares(weights: Mapping, period: int = PERIOD) -> dict:
    """Whole shares of the period by largest remainder, at least one each."""
    if len(weights) > period:
        raise ValueError(f"{len(weights)} sources do not fit a period of {period} slots")
    if any(not w > 0 for w in weights.values()):
        raise ValueError("target weights must be positive")
    total = math.fsum(weights.values())
    order = sorted(weights, key=lambda s: (s is not None, s or ""))
    out = {s: max(1, math.floor(weights[s] * period / total)) for s in order}
    rest = {s: weights[s] * period / total - out[s] for s in order}
    gap = period - sum(out.values())
    step = 1 if gap > 0 else -1
    heap = [(-step * rest[s], i, s) for i, s in enumerate(order) if step > 0 or out[s] > 1]
    heapq.heapify(heap)
    for _ in range(abs(gap)):
        least, i, s = heapq.heappop(heap)
        out[s] += step
        if step > 0 or out[s] > 1:
            heapq.heappush(heap, (least + 1, i, s))
    return out


def period_of(sources: int, period: int = PERIOD) -> int:
    """``period``, or a multiple of it that has ``SLOTS_PER_SOURCE`` slots a source where that many sources do not fit it."""
    return period if sources <= period else period * -(-SLOTS_PER_SOURCE * sources // period)


def plan(share: Mapping) -> list[tuple]:
    """(source, block, release, deadline, slot) of one period, by earliest deadline first among the released blocks."""
    period = sum(share.values())
    order = {s: i for i, s in enumerate(sorted(share, key=lambda s: (s is not None, s or "")))}
    blocks = sorted((i * period // a, -(-(i + 1) * period // a), order[s], i, s) for s, a in share.items() for i in range(a))
    out, ready, at = [], [], 0
    for slot in range(period):
        while at < len(blocks) and blocks[at][0] <= slot:
            release, deadline, n, i, s = blocks[at]
            heapq.heappush(ready, (deadline, n, i, release, s))
            at += 1
        deadline, _, i, release, s = heapq.heappop(ready)
        out.append((s, i, release, deadline, slot))
    return out


def tempered(counts: Mapping, power: float = 0.5) -> dict:
    """Target weights between the natural proportions (1) and equal ones (0)."""
    return {s: n**power for s, n in counts.items()}


def mixed(
    docs: DataFrame, weights: Mapping | None = None, key: str = "doc_id", source: str = "source", period: int = PERIOD, block: int = BLOCK,
    tie: str | None = None,
) -> DataFrame:
    """``docs`` with all its columns and share, block, release, deadline, slot and position; sorting by position gives the mix.

    Without ``weights`` they are the square roots of the sources' sizes.  A source that the weights do not name is an error.
    Of clashing names the operator's own win.  Rows that repeat a key follow one another by the column ``tie``, without it in any order.
    """
    docs = docs.select(*(c for c in docs.columns if c not in PLACE))
    counts = {r["s"]: r["n"] for r in docs.groupBy(F.col(source).alias("s")).agg(F.count("*").alias("n")).collect()}
    fits = len(counts) <= period
    period = period_of(len(counts), period)
    if weights is not None and (extra := set(counts) - set(weights)):
        raise ValueError(f"no target weight for {sorted(map(str, extra))[:5]}")
    share = shares({s: w for s, w in (weights or tempered(counts)).items() if s in counts} if counts else {}, period) if counts else {}
    # a source's name in joins and windows, which a null has too
    named = lambda s: "-" if s is None else f"+{s}"
    slots = docs.sparkSession.createDataFrame(
        [(named(s), i, r, d, slot) for s, i, r, d, slot in plan(share)], "_source string, _turn bigint, _release bigint, _deadline bigint, _slot bigint"
    )
    sizes = docs.sparkSession.createDataFrame([(named(s), a) for s, a in share.items()], "_source string, share bigint")
    if fits:  # the plan has as many rows as the period has slots; where the sources made it longer, its size decides the join
        slots, sizes = F.broadcast(slots), F.broadcast(sizes)
    digits = max(1, math.ceil(math.log(max(1, max(counts.values(), default=1) // BIN_ROWS), 16)))
    mark = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    rows = docs.withColumn("_source", F.coalesce(F.concat(F.lit("+"), F.col(source).cast("string")), F.lit("-")))
    rows = rows.withColumn("_mark", mark).withColumn("_bin", F.substring("_mark", 1, digits))
    bins = rows.groupBy("_source", "_bin").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n").join(sizes, "_source")
    inside = Window.partitionBy("_source", "_bin").orderBy("_mark", key, *filter(None, [tie]))
    rows = rows.withColumn("_rank", F.row_number().over(inside).cast("bigint") - 1).join(bins, ["_source", "_bin"])
    rows = rows.withColumn("_rank", F.col("_rank") + F.col("_before")).withColumn("block", F.expr(f"_rank div {block}"))
    rows = rows.withColumn("_period", F.expr("block div share")).withColumn("_turn", F.expr("block % share"))
    out = rows.join(slots, ["_source", "_turn"])
    for name in ("release", "deadline", "slot"):
        out = out.withColumn(name, F.col("_period") * period + F.col(f"_{name}"))
    out = out.withColumn("position", F.col("slot") * block + F.col("_rank") % block)
    return out.select(*docs.columns, *PLACE)
