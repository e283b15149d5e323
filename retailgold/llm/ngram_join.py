"""Similarity join of documents on their word shingles: rare-first prefix filtering, each pair verified once.

A document's set holds the 64-bit hashes of its distinct five-word shingles; equal sets are one node.  Shingles are ordered
by how often their slot of a fixed-size frequency table is hit, rare ones first, ties by hash.  Two sets that are similar
enough share a shingle in their prefixes, so sets are joined on prefix shingles only, under a length, a positional and a
suffix filter.

What is returned is which documents hang together, so links inside an already connected class need not be looked at:
first each run of equal prefix shingles verifies its members against one leader, which is found by streaming; then only
pairs of different classes in a run are joined, all of them.  So no link between classes is lost, and a group of
near copies costs a few comparisons per member and not one per pair.

A pair is first held against the sets' sketches: the parities of their tokens by low bits.  Each parity that differs stands for a
token that only one of them has, so sketches refuse no similar pair, and only the sets of pairs that pass are cut again and
sent to each other.  Stored tables go as soon as nothing reads them any more.

Null and empty texts, and texts without words, have an empty set and are linked with nothing.  Rows that repeat a text, also
under the same key, are copies of each other.  Null keys take part; a class's id is its smallest key that is not null.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailgold.llm.components import components
from retailgold.llm.frames import arrow_schema, by_batch, pieces, small_batches, stored, stored_at
from retailgold.llm.words import shingle_sets
from retailgold.session import drop_scratch

WIDTH = 5
PERCENT = 75
SLOTS = 1 << 20  # of the frequency table: 4 MB, at any size of the corpus
_SLOT_SHIFT = np.uint64(64 - 20)
_CHUNK = 1 << 12
MARKS = 1 << 21  # bits of the bitmap of documents whose sets are needed: 0.25 MB
HEAD = 16
ROUNDS = 2
LEADERS = 16


def set_id(tokens: np.ndarray) -> int:
    """64 bits for a sorted set."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketch(tokens: np.ndarray) -> bytes:
    """A bit for each value of the tokens' low bits, set where an odd number of them has it: two to four bits a token, 64 at least."""
    size = 64
    while size < 2 * len(tokens):
        size *= 2
    odd = np.bincount((tokens & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def sketches_allow(x: bytes, y: bytes, nx: int, ny: int, percent: int) -> bool:
    """False only for sets that are less similar; the larger sketch is folded until both look at the same low bits."""
    u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(u) > len(v):
        u = u[: len(u) // 2] ^ u[len(u) // 2 :]
    while len(v) > len(u):
        v = v[: len(v) // 2] ^ v[len(v) // 2 :]
    need = -(-percent * (nx + ny) // (100 + percent))
    return nx + ny - int(np.bitwise_count(u ^ v).sum()) >= 2 * need


def prefix_size(n: int, percent: int) -> int:
    """Sets of size n that reach the similarity with another share one of so many first tokens."""
    return n - -(-percent * n // 100) + 1


def described(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """Rows of documents (key, n, sid, sketch) and, with ``chunk`` not null, each task's part of the frequency table."""
    small_batches(docs.sparkSession)
    schema_text = f"key {docs.schema[key].dataType.simpleString()}, n bigint, sid bigint, sketch binary, chunk int, counts binary"
    schema = arrow_schema(schema_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(SLOTS, np.int32)
        for keys, texts in pieces(batches, 1):
            sets = shingle_sets(texts, width)
            table += np.bincount((np.concatenate(sets) >> _SLOT_SHIFT).astype(np.int64), minlength=SLOTS).astype(np.int32) if sets else 0
            none = [None] * len(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(
                    (keys, [len(s) for s in sets], [set_id(s) if len(s) else None for s in sets], [sketch(s) if len(s) else None for s in sets], none, none),
                    schema)],
                schema=schema,
            )
        parts = [(i // _CHUNK, zlib.compress(part.tobytes(), 1)) for i in range(0, SLOTS, _CHUNK) if (part := table[i : i + _CHUNK]).any()]
        none = [None] * len(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, f.type) for v, f in zip((none, none, none, none, [p[0] for p in parts], [p[1] for p in parts]), schema)], schema=schema
        )

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema_text)


def frequencies(parts: DataFrame) -> np.ndarray:
    """The frequency table: chunks are added up where they meet, SLOTS numbers come to the driver."""
    schema = arrow_schema("chunk int, counts binary")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for chunks, counts in pieces(batches, None):
            for c, packed in zip(chunks, counts):
                total[c] = total.get(c, 0) + np.frombuffer(zlib.decompress(packed), np.int32).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([np.minimum(v, 2**31 - 1).astype(np.int32).tobytes() for v in total.values()], pa.binary())],
            schema=schema,
        )

    out = np.zeros(SLOTS, np.int32)
    for r in parts.repartition("chunk").mapInArrow(add, "chunk int, counts binary").collect():
        out[r["chunk"] * _CHUNK : (r["chunk"] + 1) * _CHUNK] = np.frombuffer(r["counts"], np.int32)
    return out


def rare_first(tokens: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """The places of a sorted set's tokens in the global order."""
    return np.argsort(frequency[(tokens >> _SLOT_SHIFT).astype(np.int64)], kind="stable")


def prefixes(docs: DataFrame, text: str, frequency: np.ndarray, width: int, percent: int) -> DataFrame:
    """(token, sid, n, pos): the first tokens of each distinct set.  A task sends equal sets once."""
    small_batches(docs.sparkSession)
    schema_text = "token bigint, sid bigint, n int, pos int"
    schema = arrow_schema(schema_text)
    shared = docs.sparkSession.sparkContext.broadcast(frequency)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for (texts,) in pieces(batches, 0):
            rows = []
            for tokens in shingle_sets(texts, width):
                if not len(tokens) or (sid := set_id(tokens)) in seen:
                    continue
                seen.add(sid)
                rows.append((tokens[rare_first(tokens, shared.value)[: prefix_size(len(tokens), percent)]], sid, len(tokens)))
            if rows:
                sizes = [len(t) for t, _, _ in rows]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([t for t, _, _ in rows]).view(np.int64)), pa.array(np.repeat([s for _, s, _ in rows], sizes)),
                    pa.array(np.repeat([n for _, _, n in rows], sizes).astype(np.int32)),
                    pa.array(np.concatenate([np.arange(z) for z in sizes]).astype(np.int32)),
                ], schema=schema)

    return docs.select(text).mapInArrow(run, schema_text)


def shared_runs(rows: DataFrame) -> DataFrame:
    """Prefix rows whose token another set has too.

    Rows come sorted by token; a row is held until the next one shows whether its token goes on, so a run of any length
    passes through in constant memory.
    """
    schema_text = "token bigint, sid bigint, n int, pos int"
    schema = arrow_schema(schema_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, going = None, False  # the last row so far, and whether its run has others before it
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            token, sid = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            same = token[1:] == token[:-1]
            # the set of a task's copy comes again from another task
            fresh = np.concatenate([[True], ~(same & (sid[1:] == sid[:-1]))])
            before = np.concatenate([[going], same])
            after = np.concatenate([same, [False]])
            if not fresh.all():
                batch = batch.filter(pa.array(fresh))
                token = token[fresh]
                same = token[1:] == token[:-1]
                before, after = np.concatenate([[going], same]), np.concatenate([same, [False]])
            keep = before | after
            last = batch.num_rows - 1
            yield batch.slice(0, last).filter(pa.array(keep[:last]))
            held, going = batch.slice(last), bool(before[last])
        if held is not None and going:
            yield pa.RecordBatch.from_arrays(held.columns, schema=schema)

    return rows.repartition("token").sortWithinPartitions("token", "sid").mapInArrow(run, schema_text)


def passes(percent: int) -> Column:
    """Length and positional filter of the joined rows x and y on one token.

    The overlap can at most be this token and what follows it in the shorter rest; that bound holds at the first token
    that both share, where every similar pair comes through.
    """
    nx, ny = F.col("x.n").cast("bigint"), F.col("y.n").cast("bigint")
    rest = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")).cast("bigint")
    return (100 * F.least(nx, ny) >= percent * F.greatest(nx, ny)) & ((100 + percent) * rest >= percent * (nx + ny))


def suffix_possible(x: np.ndarray, y: np.ndarray, overlap: int, depth: int = 3) -> bool:
    """Suffix filter: halve x at its middle token and y at the same token; what the sizes of the parts allow must reach ``overlap``."""
    return _most(x, y, depth) >= overlap


def _most(x: np.ndarray, y: np.ndarray, depth: int) -> int:
    if not depth or min(len(x), len(y)) < 2:
        return min(len(x), len(y))
    middle = len(x) // 2
    at = int(np.searchsorted(y, x[middle]))
    return _most(x[:middle], y[:at], depth - 1) + _most(x[middle:], y[at:], depth - 1)


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    total = len(x) + len(y)
    need = -(-percent * total // (100 + percent))
    if not suffix_possible(x, y, need):
        return False
    both = np.concatenate([x, y])
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1])) >= need


def marked(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """Rows whose column ``slot`` is among the given ones, by a bitmap of ``MARKS`` bits: at most ``MARKS / 64`` rows go to all executors."""
    bit = F.expr("shiftleft(1L, slot % 64)")
    word = F.expr("slot div 64").alias("_word")
    words = slots.groupBy(word).agg(F.bit_or(bit).alias("_bits"))
    return rows.withColumn("_word", word).join(F.broadcast(words), "_word").where(F.col("_bits").bitwiseAND(bit) != 0)


def _involved(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()


def possible(rows: DataFrame, pairs: DataFrame, involved: DataFrame, percent: int) -> DataFrame:
    """The pairs that their sketches allow.  A bitmap of fixed size keeps most sketches that no pair needs out of the shuffle."""
    slot = F.pmod(F.xxhash64("sid"), F.lit(MARKS)).cast("int").alias("slot")
    near = marked(rows.where("sid is not null").select(slot, "sid", "n", "sketch"), involved.select(slot)).select("sid", "n", "sketch")
    near = near.join(involved, "sid", "left_semi").dropDuplicates(["sid"])
    x = near.select(F.col("sid").alias("a"), F.col("n").alias("nx"), F.col("sketch").alias("x")).hint("merge")
    y = near.select(F.col("sid").alias("b"), F.col("n").alias("ny"), F.col("sketch").alias("y")).hint("merge")

    def make():
        def work(*columns):
            kept = [(a, b) for a, b, x, y, nx, ny in zip(*columns) if sketches_allow(x, y, nx, ny, percent)]
            return [list(v) for v in zip(*kept)] if kept else [[], []]

        return work

    return by_batch(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y", "nx", "ny"), make, "a bigint, b bigint")


def sets_of(docs: DataFrame, rows: DataFrame, involved: DataFrame, text: str, key: str, width: int) -> DataFrame:
    """(sid, tokens) of the sets involved, cut again from one document each.

    A bitmap of fixed size tells which documents may be needed, so that the others' texts are not cut; what it lets through
    in error is dropped by the join.
    """
    slot = F.pmod(F.xxhash64("key"), F.lit(MARKS)).cast("int").alias("slot")
    first = rows.join(involved, "sid", "left_semi").groupBy("sid").agg(F.min("key").alias("key"))

    def make():
        seen: set[int] = set()

        def work(texts):
            sets = [s for s in shingle_sets(texts, width) if len(s)]
            new = {i: s for s in sets if (i := set_id(s)) not in seen}
            seen.update(new)
            return [list(new), [s.tobytes() for s in new.values()]]

        return work

    mine = marked(docs.select(F.col(key).alias("key"), F.col(text).alias("text")).select(slot, "text"), first.select(slot))
    cut = by_batch(mine.select("text"), make, "sid bigint, tokens binary", text=0)
    return cut.join(involved, "sid", "left_semi").dropDuplicates(["sid"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) of distinct pairs."""
    # sort-merge at any size: sets are the heavy side, and pairs grow with the documents
    x = sets.select(F.col("sid").alias("a"), F.col("tokens").alias("x")).hint("merge")
    y = sets.select(F.col("sid").alias("b"), F.col("tokens").alias("y")).hint("merge")

    def make():
        read = lambda t: np.frombuffer(t, np.uint64)
        return lambda a, b, x, y: (a, b, [similar(read(s), read(t), percent) for s, t in zip(x, y)])

    return by_batch(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y"), make, "a bigint, b bigint, linked boolean")


def checked(docs: DataFrame, rows: DataFrame, pairs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """(a, b, linked) of the distinct pairs that their sketches allow."""
    spent: list[str] = []
    near = _kept(possible(rows, pairs, _kept(_involved(pairs), "ngram-involved", spent), percent), "ngram-near", spent)
    sets = _kept(sets_of(docs, rows, _kept(_involved(near), "ngram-involved", spent), text, key, width), "ngram-sets", spent)
    out = stored(verified(near, sets, percent), "ngram-checked")
    _drop(docs.sparkSession, spent)
    return out


def _kept(df: DataFrame, name: str, spent: list[str]) -> DataFrame:
    out, path = stored_at(df, name)
    spent.append(path)
    return out


def _drop(spark: SparkSession, spent: list[str]) -> None:
    for path in spent:
        drop_scratch(spark, path)


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def linked_sets(docs: DataFrame, rows: DataFrame, key: str, text: str, frequency: np.ndarray, width: int, percent: int) -> DataFrame:
    """(node, component) over set ids."""
    spark = docs.sparkSession
    runs = stored(shared_runs(prefixes(docs, text, frequency, width, percent)), "ngram-runs")
    tried, links, classes, turn, last = None, None, None, 0, False
    while True:
        spent: list[str] = []
        at = runs.withColumn("class", F.col("sid")) if classes is None else _open_runs(runs, classes, spent)
        if last:
            at = _with_heads(at, spent)
        pairs = _all_pairs(at, percent) if last else _leader_pairs(at, turn, percent)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "ngram-pairs")
        _drop(spark, spent)
        new = checked(docs, rows, pairs, key, text, width, percent)
        linked = new.where("linked").select("a", "b")
        found = not linked.isEmpty()
        tried, links = (pairs, linked) if tried is None else (tried.union(pairs), links.union(linked))
        if found or classes is None:
            classes = stored(components(links), "ngram-classes")
        if last:
            return classes
        turn += 1
        # further leaders are worth while as long as they link anything; what they leave is compared in full
        last = not found or turn == ROUNDS


def _leader_pairs(at: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each member of a run with its leaders of other classes: sets whose number, mixed anew each turn, comes first.

    At first one leader gathers what is alike; later ones look for what it missed.
    """
    picks = [F.min_by(F.struct("sid", "n", "pos", "class"), F.xxhash64("sid", F.lit(turn), F.lit(i))) for i in range(LEADERS if turn else 1)]
    leaders = at.groupBy("token").agg(F.array_distinct(F.array(*picks)).alias("leaders"))
    met = at.join(leaders, "token").withColumn("leaders", F.filter("leaders", lambda y: y["class"] != F.col("class"))).where("size(leaders) > 0")
    met = met.select(F.struct("sid", "n", "pos").alias("x"), F.explode("leaders").alias("y"))
    return met.where(passes(percent)).select(*_pair("x.sid", "y.sid")).distinct()


def _open_runs(runs: DataFrame, classes: DataFrame, spent: list[str]) -> DataFrame:
    """Rows of the runs that hold more than one class, with their class."""
    at = runs.join(classes.withColumnRenamed("node", "sid"), "sid", "left").withColumn("class", F.coalesce("component", "sid")).drop("component")
    at = _kept(at, "ngram-classed", spent)  # it is read for both sides of the join
    several = at.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("token")
    return at.join(several, "token", "left_semi")


def _with_heads(at: DataFrame, spent: list[str]) -> DataFrame:
    """The rows with the first tokens of their set among them."""
    at = _kept(at, "ngram-open", spent)
    heads = at.groupBy("sid").agg(F.slice(F.array_sort(F.collect_list(F.struct("pos", "token"))), 1, HEAD).alias("h"))
    return _kept(at.join(heads.select("sid", F.col("h.token").alias("head")), "sid"), "ngram-headed", spent)


def _all_pairs(at: DataFrame, percent: int) -> DataFrame:
    """All pairs of different classes in a run; a pair comes through at its first common token where both heads show it."""
    common = F.try_element_at(F.array_intersect("x.head", "y.head"), F.lit(1))
    pairs = at.alias("x").join(at.alias("y"), "token").where(
        (F.col("x.sid") < F.col("y.sid")) & (F.col("x.class") != F.col("y.class")) & passes(percent)
        & F.coalesce(common == F.col("token"), F.lit(True))
    )
    return pairs.select(*_pair("x.sid", "y.sid")).distinct()


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id) of every row."""
    both = stored(described(docs, key, text, width), "ngram-sizes")
    rows = both.where("chunk is null").select("key", "n", "sid", "sketch")
    frequency = frequencies(both.where("chunk is not null").select("chunk", "counts"))
    nodes = linked_sets(docs, rows, key, text, frequency, width, percent)
    # copies are one node; the smallest key of a node, then of its component
    least = rows.where("sid is not null").groupBy("sid").agg(F.min("key").alias("least"))
    least = least.join(nodes.withColumnRenamed("node", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    low = least.groupBy("component").agg(F.min("least").alias("component_id"))
    named = least.join(low, "component").select("sid", "component_id")
    return rows.join(named, "sid", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("sid").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id")
    )
