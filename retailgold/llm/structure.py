"""Repair of conversation structure: the cheapest edits that make the roles ``(s?(ua)+)?``, by an auction for shortest paths.

A conversation's rows, in the order of ``turn``, and four states of the role pattern span a lattice.  From a node a row is kept
(0), given the role that fits (2) or deleted (3), or an empty turn that fits is put before it (2); a truncated row that stays
costs 1 more.  Blank rows and repetitions can only be deleted.  The edit's letter and the state say which role results.

The auction keeps a price per node and a path from the start.  The path's end is extended along its cheapest arc if its price
equals that arc's cost plus the next price; else the price is raised to that and the path shrinks by one node.  When the path
has arrived, arcs whose cost is the difference of their prices are tight, all shortest paths consist of tight arcs, and the
one whose letters sort first is traced.

Long conversations are not solved in one piece.  Rows are sorted over all machines, so a conversation may lie in several
partitions; blocks of eight rows are solved for each state they may be entered in and left in, and put together one after the
other.  Two ways through a block that cost the same are told apart before they end, so the first in order is found piece by piece.
Only the finished conversation is one row.

Defined results: a null role or text is one space; rows of equal turn follow by role and SHA-256 of the text; a role counts by its first
character, one without any fits nowhere; a null conversation is one of its own; no rows give no edits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailgold.llm.frames import arrow_schema, by_batch, pieces, small_batches, stored

BLOCK = 8
SEEN_BLOCKS = 1 << 16
KEEP, REROLE, INSERT, DELETE, TRUNCATED = 0, 2, 2, 3, 1

# states: nothing yet, after the system turn, after a user's, after an assistant's
FITS = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
NEXT = (2, 2, 3, 2)  # where the turn leads that fits
WHO = ("user", "user", "assistant", "user")
CLOSE = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))  # what is still to come at the end
LEGAL = {"su", "ua", "au"}


def _arcs(codes: str) -> list[list[tuple[str, int, int]]]:
    """(letter, cost, target) from each node, letters in order.  Node 4 * i + q stands before row i in state q.

    A row's code is ``-`` where it has to go, else its role's initial (``x`` for others), in capitals if it is truncated.
    """
    out = []
    for i, code in enumerate(codes):
        more = TRUNCATED if code.isupper() else 0
        for q in range(4):
            arcs = [("D", DELETE, 4 * i + 4 + q), ("I", INSERT, 4 * i + NEXT[q])]
            if code != "-":
                if (to := FITS.get((code.lower(), q))) is not None:
                    arcs.append(("K", KEEP + more, 4 * i + 4 + to))
                arcs.append(("R", REROLE + more, 4 * i + 4 + NEXT[q]))
            out.append(arcs)
    return out + [[] for _ in range(4)]


def _leading_to(arcs: list[list[tuple[str, int, int]]], end: int) -> list[list[tuple[str, int, int]]]:
    """The arcs on ways to ``end``; a node without any is cut off."""
    live = [False] * len(arcs)
    live[end] = True
    for first in range(len(arcs) - 4, -1, -4):
        for _ in range(3):  # within a layer a way has two arcs at most that are not a round trip
            for v in range(first, first + 4):
                live[v] = live[v] or any(live[t] for _, _, t in arcs[v])
    return [[a for a in out if live[a[2]]] if live[v] else [] for v, out in enumerate(arcs)]


def auction(arcs: list[list[tuple[str, int, int]]], start: int, end: int, price: list[int]) -> None:
    """Raise ``price`` until a path of tight arcs leads from ``start`` to ``end``, which must be within reach.

    On entry and always: price of a node <= cost of each of its arcs + price of the arc's target.
    """
    path = [start]
    while (at := path[-1]) != end:
        best, to = min((cost + price[t], t) for _, cost, t in arcs[at])
        if price[at] < best:
            price[at] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)


def trace(arcs: list[list[tuple[str, int, int]]], start: int, end: int, price: list[int]) -> str:
    """The letters of the first path in order along tight arcs."""
    tight = _leading_to([[(x, c, t) for x, c, t in out if price[v] == c + price[t]] for v, out in enumerate(arcs)], end)
    said, at = [], start
    while at != end:
        letter, _, at = tight[at][0]
        said.append(letter)
    return "".join(said)


@lru_cache(SEEN_BLOCKS)
def through(codes: str, entry: int) -> tuple[tuple[int, str] | None, ...]:
    """For each state that a block of rows may be left in: the least cost and the first letters of it, None without a way."""
    arcs, out = _arcs(codes), []
    for leave in range(4):
        end = 4 * len(codes) + leave
        ways = _leading_to(arcs, end)
        if not ways[entry] and entry != end:
            out.append(None)
            continue
        price = [0] * len(ways)
        auction(ways, entry, end, price)
        out.append((price[entry] - price[end], trace(ways, entry, end, price)))
    return tuple(out)


class Ways:
    """The best ways from one state through the rows so far: per state they end in cost, letters as linked parts, and their order."""

    def __init__(self, entry: int):
        self.ends: list[tuple[int, tuple | None, int] | None] = [None] * 4
        self.ends[entry] = (0, None, 0)

    def on(self, blocks) -> None:
        """``blocks(q)`` gives cost and letters from state q to each state."""
        cost: list[tuple] = []
        for q, here in enumerate(self.ends):
            if here:
                for leave, way in enumerate(blocks(q)):
                    if way:
                        # of equal cost, the order of the parts before decides, then the block's letters
                        cost.append((leave, here[0] + way[0], here[2], way[1], here[1]))
        cost.sort(key=lambda c: c[:4])
        best: dict[int, tuple] = {}
        for c in cost:
            best.setdefault(c[0], c)
        place = {c[0]: i for i, c in enumerate(sorted(best.values(), key=lambda c: c[2:4]))}
        self.ends = [(best[q][1], (best[q][4], best[q][3]), place[q]) if q in best else None for q in range(4)]

    def result(self) -> list[tuple[int, str] | None]:
        out = []
        for end in self.ends:
            if end:
                part, said = end[1], []
                while part:
                    said.append(part[1])
                    part = part[0]
            out.append((end[0], "".join(reversed(said))) if end else None)
        return out


class _Part:
    """The rows of one conversation in one partition, as they come."""

    def __init__(self, key, entries: range):
        self.key, self.ways, self.codes = key, {e: Ways(e) for e in entries}, ""
        self.counts = [0, 0, 0, 0]  # blank, duplicate, truncated, illegal
        self.first = self.last = None

    def add(self, initial: str, blank: bool, truncated: bool, first: bool, copies: int) -> None:
        blanks, doubles = (copies, 0) if blank else (0, copies - first)
        stays = copies - blanks - doubles
        self.counts[0] += blanks
        self.counts[1] += doubles
        self.counts[2] += truncated * stays
        if self.last is not None:
            self.counts[3] += self.last + initial not in LEGAL
        self.counts[3] += copies - 1  # no role may follow itself
        self.first = initial if self.first is None else self.first
        self.last = initial
        code = initial if initial in ("s", "u", "a") else "x"
        self.codes += (code.upper() if truncated else code) * stays
        left = copies - stays
        while left or len(self.codes) >= BLOCK:
            take = min(left, BLOCK)
            self.codes, left = self.codes + "-" * take, left - take
            while len(self.codes) >= BLOCK:
                self._solve(self.codes[:BLOCK])
                self.codes = self.codes[BLOCK:]

    def _solve(self, codes: str) -> None:
        for ways in self.ways.values():
            ways.on(lambda q: through(codes, q))

    def row(self) -> tuple:
        if self.codes:
            self._solve(self.codes)
        results = [self.ways[e].result() if e in self.ways else [None] * 4 for e in range(4)]
        flat = [w for r in results for w in r]
        return (self.key, *self.counts, self.first, self.last, [w and w[0] for w in flat], [w and w[1] for w in flat])


def _parts(turns: DataFrame) -> DataFrame:
    """What each partition of the sorted turns says of each of its conversations."""
    small_batches(turns.sparkSession)
    kind = turns.schema["conv_id"].dataType.simpleString()
    layout = (
        f"conv_id {kind}, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, costs array<int>, audits array<string>"
    )
    schema = arrow_schema(layout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, begun = None, False
        for columns in pieces(batches, None):
            done = []
            for key, *turn in zip(*columns):
                if part is None or part.key != key:
                    if part is not None:
                        done.append(part.row())
                    # only the first conversation of a partition may have begun in another one
                    part, begun = _Part(key, range(1) if begun else range(4)), True
                part.add(*turn)
            yield _batch(done, schema)
        if part is not None:
            yield _batch([part.row()], schema)

    return turns.mapInArrow(run, layout).withColumn("part", F.spark_partition_id())


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _joined(parts: list[dict]) -> tuple[int, int, int, int, int, str]:
    """Counts, cost and letters of a conversation from its parts in order."""
    ways, counts, last = Ways(0), [0, 0, 0, 0], None
    for p in parts:
        for i, name in enumerate(("blank", "duplicate", "truncated", "illegal")):
            counts[i] += p[name]
        if last is not None:
            counts[3] += last + p["first"] not in LEGAL
        last = p["last"]
        ways.on(lambda q: [None if c is None else (c, a) for c, a in zip(p["costs"][4 * q : 4 * q + 4], p["audits"][4 * q : 4 * q + 4])])
    ends = [(way[0] + more, way[1] + rest) for way, (more, rest) in zip(ways.result(), CLOSE) if way]
    return (*counts, *min(ends))


def edited(audit: str, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The turns (role, text) after the edits of ``audit``."""
    out, state, at = [], 0, iter(rows)
    for letter in audit:
        if letter == "I":
            out.append((WHO[state], ""))
            state = NEXT[state]
            continue
        role, text = next(at)
        if letter == "K":
            out.append((role, text))
            state = FITS[role[0], state]
        elif letter == "R":
            out.append((WHO[state], text))
            state = NEXT[state]
    return out


def damage(conversations: DataFrame) -> DataFrame:
    """Rows lost, emptied, cut, repeated or given to the user, by the CRC-32 of ``conv_id:turn``; nulls are one space."""
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    text = F.coalesce("text", F.lit(" "))
    rows = conversations.withColumn("_lot", F.crc32(named) % 20).where("_lot <> 0").select(
        "conv_id", "turn",
        F.when(F.col("_lot") == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("_lot") == 1, F.lit("")).when(F.col("_lot") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("_lot") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    )
    return rows.drop("_copy")


def repair(conversations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired) per conversation.

    ``gaps`` counts the numbers missing between the smallest and the largest turn, ``blank``, ``duplicate`` and ``truncated`` rows by
    their first fault, ``illegal`` adjacent roles other than su, ua, au; ``audit`` has a letter per edit, ``repaired`` the turns after
    them.  ``ids`` names conversations that are to be in the result though they may have no row.
    """
    text = F.coalesce("text", F.lit(" "))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), F.sha2(text, 256).alias("said"))
    last = F.substring(F.regexp_replace("text", r"[\x20\x09-\x0D]+$", ""), -1, 1)
    # one row per distinct turn, without its text
    turns = stored(rows.select(
        "conv_id", "turn", "role", "said", (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"),
    ).groupBy("conv_id", "turn", "role", "said").agg(F.first("blank").alias("blank"), F.first("truncated").alias("truncated"), F.count("*").alias("copies")), "turns")
    seen = turns.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("said").alias("s")).agg(F.min(F.struct("turn"))["turn"].alias("t"))
    # the first turn's number is part of the key, so a text that is said very often makes no hot key
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("role") == F.col("r")) & (F.col("said") == F.col("s"))
    marked = turns.join(seen, same, "left").select(
        "conv_id", "turn", "role", "said", F.substring("role", 1, 1).alias("initial"), "blank", "truncated", F.col("s").isNotNull().alias("first"), "copies",
    )
    place = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "said"]
    in_order = marked.repartitionByRange(*place).sortWithinPartitions(*place)
    parts = _parts(in_order.select("conv_id", "initial", "blank", "truncated", "first", "copies"))
    whole = parts.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("part", "blank", "duplicate", "truncated", "illegal", "first", "last", "costs", "audits"))).alias("parts")
    )
    kind = turns.schema["conv_id"].dataType.simpleString()
    solved = by_batch(
        whole, lambda: lambda keys, found: (keys, *(list(c) for c in zip(*map(_joined, found)))) if keys else ([],) * 7,
        f"conv_id {kind}, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string",
    )
    numbers = turns.groupBy("conv_id", "turn").agg(F.lit(1)).groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps")
    )
    said = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "said", "text"))).alias("rows"))
    base = (turns if ids is None else ids).select("conv_id").distinct()
    for part in (numbers, solved, said):
        base = base.join(part.withColumnRenamed("conv_id", "_other"), F.col("conv_id").eqNullSafe(F.col("_other")), "left").drop("_other")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    found = base.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.transform("rows", lambda r: F.struct(r["role"], r["text"])).alias("rows"))

    def apply():
        def work(*columns):
            *kept, audits, rows = columns
            turns = [edited(a, [(r["role"], r["text"]) for r in rs or []]) for a, rs in zip(audits, rows)]
            return (*kept, audits, [[{"role": r, "text": t} for r, t in ts] for ts in turns])
        return work

    return by_batch(
        found, apply, f"conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
        "repaired array<struct<role: string, text: string>>",
    )


def repaired_digest() -> Column:
    """SHA-256 of ``role:text`` of the repaired turns, joined by newlines."""
    return F.sha2(F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n"), 256)
