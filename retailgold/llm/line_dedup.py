"""Line dedup: repeated runs of lines, from a suffix array over line ids by distributed prefix doubling.

A line's id is its class of equal lines.  Lines that occur once are in no repeated run, so only segments of consecutive
repeated lines with enough words go on.  In round k a suffix gets the rank of its first ``2 ** k`` lines from the ranks of
its two halves; a suffix whose pair of ranks is alone keeps no rank, because no longer run from it can repeat.  Suffixes with
equal ranks are an interval of the suffix array whose longest common prefix is at least that long; for lengths between two
powers the interval is found by the ranks of the two overlapping halves.

A maximal repeated run of at least ``least`` words is covered by the shortest runs of so many words that start at its lines and
those that end at them, so these two per line are looked up, and every line in one that occurs earlier is deleted.

Earlier means a smaller key (nulls last), then the hash of the row, then the line.  Occurrences may overlap.  Lines are cut at
``\\n``; words are runs of characters other than ``\\x20 \\x09-\\x0D``.  The first occurrence of a line is never deleted.  Null texts
stay null and empty ones empty; rows that repeat key and text are one place and keep the same lines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailgold.llm.frames import by_batch, pieces, small_batches, stored

LEAST_WORDS = 50


def row_id(key, text: str) -> int:
    """64 bits for a row."""
    h = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8, key=str(key).encode()[:64])
    return int.from_bytes(h.digest(), "little", signed=True)


def lines_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, row, line, words, high, low): one row per line; high and low are 128 bits of its text."""

    def make():
        def work(keys, texts):
            out = []
            for k, t in zip(keys, texts):
                if t:
                    row = row_id(k, t)
                    for i, line in enumerate(t.encode("utf-8", "surrogatepass").split(b"\n")):
                        high, low = np.frombuffer(hashlib.md5(line).digest(), np.int64).tolist()
                        out.append((k, row, i, len(line.split()), high, low))
            return [list(v) for v in zip(*out)] if out else [[]] * 6

        return work

    kind = docs.schema[key].dataType.simpleString()
    return by_batch(docs.select(key, text), make, f"key {kind}, row bigint, line int, words int, high bigint, low bigint", text=1)


def repeated_segments(lines: DataFrame, least: int) -> DataFrame:
    """Lines that occur more than once, in segments of neighbours with ``least`` words or more; ``place`` numbers them."""
    # a table of its own, so that the join may split a line that very many documents have
    often = stored(lines.groupBy("high", "low").agg(F.count("*").alias("n")).where("n > 1").select("high", "low"), "line-often")
    by_row = Window.partitionBy("key", "row").orderBy("line")
    # repeated rows are one place
    again = lines.join(often, ["high", "low"]).dropDuplicates(["key", "row", "line"])
    again = again.withColumn("segment", F.col("line") - F.row_number().over(by_row))
    whole = Window.partitionBy("key", "row", "segment")
    return again.withColumn("sum", F.sum("words").over(whole)).where(F.col("sum") >= least).drop("sum").withColumn("place", F.monotonically_increasing_id())


def shortest_runs(words: list[int], least: int) -> list[tuple[int, int]]:
    """(start, lines) of the shortest runs of ``least`` words from each line on, and up to each line."""
    total = np.concatenate([[0], np.cumsum(words)])
    n = len(words)
    start = np.arange(n)
    end = np.searchsorted(total, total[:-1] + least)  # the first end with enough words
    runs = {(int(a), int(b - a)) for a, b in zip(start, end) if b <= n}
    first = np.searchsorted(total, total[1:] - least, "right") - 1  # the last start with enough words
    return sorted(runs | {(int(a), int(b + 1 - a)) for a, b in zip(first, start) if a >= 0})


def _segments(ranked: DataFrame, levels: int) -> DataFrame:
    held = F.sort_array(F.collect_list(F.struct("line", "words", *(f"r{k}" for k in range(levels)))))
    return ranked.groupBy("key", "row", "segment").agg(held.alias("held"))


def longest_needed(segments: DataFrame, least: int) -> int:
    def make():
        return lambda held: [[max((n for _, n in shortest_runs([x["words"] for x in h], least)), default=0) for h in held]]

    return by_batch(segments.select("held"), make, "n int").agg(F.max("n")).first()[0] or 0


def doubled(ranked: DataFrame, k: int) -> DataFrame:
    """Adds ranks of ``2 ** (k + 1)`` lines."""
    rank = f"r{k}"
    order = Window.partitionBy("key", "row", "segment").orderBy("line")
    pairs = ranked.withColumn("second", F.lead(rank, 2**k).over(order))
    # a suffix without a pair gets a number of its own, which meets nothing
    pairs = pairs.withColumn("first", F.when(F.col(rank).isNotNull() & F.col("second").isNotNull(), F.col(rank)).otherwise(-1 - F.col("place")))
    pairs = pairs.withColumn("second", F.coalesce("second", F.lit(-1).cast("bigint")))
    names = pairs.where("first >= 0").groupBy("first", "second").agg(F.min("place").alias(f"r{k + 1}"), F.count("*").alias("n"))
    return pairs.join(names.where("n > 1").drop("n"), ["first", "second"], "left").drop("first", "second")


def later_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """(key, row, start, lines): runs that occur earlier too."""
    segments = stored(repeated_segments(stored(lines_of(docs, key, text), "line-ids"), least), "line-segments")
    names = segments.groupBy("high", "low").agg(F.min("place").alias("r0"))
    ranked = stored(segments.join(names, ["high", "low"]).drop("high", "low"), "line-ranks")
    longest, levels = longest_needed(_segments(ranked, 1), least), 1
    while 2**levels <= longest:
        ranked = stored(doubled(ranked, levels - 1), "line-ranks")
        levels += 1

    def make():
        def work(keys, rows, held):
            out = []
            for k, row, h in zip(keys, rows, held):
                for start, n in shortest_runs([x["words"] for x in h], least):
                    level = n.bit_length() - 1
                    first, second = h[start][f"r{level}"], h[start + n - 2**level][f"r{level}"]
                    if first is not None and second is not None:
                        out.append((k, row, h[start]["line"], n, first, second))
            return [list(v) for v in zip(*out)] if out else [[]] * 6

        return work

    kind = docs.schema[key].dataType.simpleString()
    runs = by_batch(
        _segments(ranked, levels).select("key", "row", "held"), make,
        f"key {kind}, row bigint, start int, lines int, first bigint, second bigint",
    )
    runs = stored(runs, "line-runs").withColumn("at", F.struct(F.col("key").isNull().alias("last"), "key", "row", "start"))
    same = ["lines", "first", "second"]
    earliest = runs.groupBy(*same).agg(F.min("at").alias("earliest"))
    return runs.join(earliest, same).where("at > earliest").select("key", "row", "start", "lines")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with all its columns, the text without later copies, and ``n_lines`` and ``n_deleted``.

    Of clashing names the operator's own win.
    """
    runs = later_runs(docs, key, text, least)
    cuts = runs.groupBy("row").agg(F.collect_set(F.struct("start", "lines")).alias("cuts"))
    names = [c for c in docs.columns if c not in ("n_lines", "n_deleted")]
    numbered = with_row_id(docs.select(*names), key, text)
    # sort-merge at any size: the list of cuts grows with the documents
    joined = numbered.join(stored(cuts, "line-cuts").withColumnRenamed("row", "_row").hint("merge"), "_row", "left").drop("_row")
    small_batches(docs.sparkSession)
    at = names.index(text)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    schema_text = f"{fields}, n_lines int, n_deleted int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes, gone = [], [], []
            for t, cuts in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
                lines = t.split("\n") if t else []
                drop = {i for c in cuts or () for i in range(c["start"], c["start"] + c["lines"])}
                texts.append("\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else t)
                sizes.append(len(lines)), gone.append(len(drop))
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int32()), pa.array(gone, pa.int32())], names=[*names, "n_lines", "n_deleted"])

    return joined.select(*names, "cuts").mapInArrow(run, schema_text)


def with_row_id(docs: DataFrame, key: str, text: str) -> DataFrame:
    small_batches(docs.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    key_at, text_at = docs.columns.index(key), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = []
            for keys, texts in pieces([batch.select([key_at, text_at])], 1):
                # rows without text have no lines to lose; their own numbers keep them apart in the join
                ids += [row_id(k, t) if t else hash((k, i)) for i, (k, t) in enumerate(zip(keys, texts))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.int64())], names=[*batch.schema.names, "_row"])

    return docs.mapInArrow(run, f"{fields}, _row bigint")
