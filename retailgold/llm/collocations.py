"""Phrase collocations by dynamic itemset counting.

Texts are cut into pieces and words once and kept, as hashes, in shards.  The shards are scanned in a cycle.  All lengths are
counted in the same scans: words from the first shard on, a longer phrase from the first scan at which both of its parts without the
last and without the first word have reached the threshold, until each phrase has been counted in every shard once.  So a scan
counts some phrases for the first time and others for the last, and the corpus is read about as often as phrases are nested.

Which phrases have reached the threshold is known to a scan from a bitmap of their hashes, one per scan so far.  A phrase's first
scan follows from the bitmaps alone, so it is counted in exactly one cycle also where a bit is set for another phrase; the bitmap only
decides what is looked at, the counts are exact.  Pairs of words are looked at only if their bucket of a counting filter, filled while
the texts are cut, reaches the threshold.  Bitmap and filter have fixed sizes; on a corpus that fills them they sort out less and
more is counted, with the same result.

Phrases are compared by 64-bit hashes of their language and words, texts are fetched at the end.  Null and empty texts have no
phrase, a null language is ``und``, repeated rows count each, a table without words gives no rows.  Words and phrases of any length in
characters are whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailgold.llm.frames import arrow_schema, pieces, small_batches, stored
from retailgold.llm.words import Words, mixed
from retailgold.session import scratch_dir

SHARDS = 4
LONGEST = 5
LEAST = 100
TOP = 2_000
BITS = 1 << 24  # of a bitmap: 2 MB
BUCKETS = 1 << 24  # of the filter of pairs, a byte each while they are counted
_BIT_SHIFT = np.uint64(64 - 24)
_CHUNK = 1 << 16
_ODD = np.uint64(0x9E3779B97F4A7C15)
FLUSH = 4_000_000  # words whose counts a task adds up before it sends them
SENT = 2_000_000

_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?\n\r", 0x0B, 0x0C]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Pieces(Words):
    """Words between spaces and tabs, of pieces that end at ``.,;:!?`` and line ends; ``piece`` numbers them."""

    def __init__(self, texts: list[str | None]):
        coded = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        self.data = _LOWER[np.frombuffer(b"\n".join(coded) + b"\n", np.uint8)]
        self.place = np.concatenate([[0], np.cumsum([len(c) + 1 for c in coded])]).astype(np.int64)
        ends = _BREAK[self.data]
        gap = np.concatenate([[True], _GAP[self.data] | ends])
        turn = np.flatnonzero(gap[1:] != gap[:-1])
        self.start, self.end = turn[::2], turn[1::2]
        self.text = np.searchsorted(self.place, self.start, "right") - 1
        self.first = np.searchsorted(self.start, self.place)
        self.piece = np.cumsum(ends)[self.start] if len(self.start) else np.zeros(0, np.int64)


def language_seed(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def coded(words: Pieces, langs: list[str]) -> np.ndarray:
    """A number per word, of its bytes and its text's language; 0 stands for nothing."""
    seeds = np.array([language_seed(x) for x in langs], np.uint64)
    with np.errstate(over="ignore"):
        out = mixed(words.hashes() * _ODD + seeds[words.text])
    out[out == 0] = 1
    return out


def longer(phrases: np.ndarray, codes: np.ndarray, length: int) -> np.ndarray:
    """Phrases of ``length`` words from those of one word less and the words."""
    n = max(0, len(codes) - length + 1)
    with np.errstate(over="ignore"):
        return mixed(phrases[:n] * _ODD + codes[length - 1 : length - 1 + n])


def _slots(phrases: np.ndarray) -> np.ndarray:
    return (phrases >> _BIT_SHIFT).astype(np.int64)


def has(bits: np.ndarray | None, phrases: np.ndarray) -> np.ndarray:
    if bits is None:
        return np.zeros(len(phrases), bool)
    at = _slots(phrases)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def cut(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Rows (shard, lang, seed, n, codes): a text's numbers with a 0 between pieces; and (chunk, counts): parts of the filter of pairs."""
    small_batches(docs.sparkSession)
    layout = "shard int, lang string, seed bigint, n bigint, codes binary, chunk int, counts binary"
    schema = arrow_schema(layout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.zeros(BUCKETS, np.uint8)
        for texts, langs in pieces(batches, 0):
            words = Pieces(texts)
            codes = coded(words, langs)
            same = words.piece[1:] == words.piece[:-1]
            slots, times = np.unique(_slots(longer(codes, codes, 2)[same]), return_counts=True)
            filled[slots] = np.minimum(filled[slots].astype(np.int64) + times, 255)
            # a 0 before each word that begins a piece
            begins = np.concatenate([[True], ~same]) if len(codes) else np.zeros(0, bool)
            at = np.arange(len(codes)) + np.cumsum(begins)
            spread = np.zeros(len(codes) + int(begins.sum()), np.uint64)
            spread[at] = codes
            first = np.concatenate([at - begins, [len(spread)]])[words.first]  # where each text begins
            flat = spread.tobytes()
            rows = [(a, b, n, x) for a, b, n, x in zip(first[:-1].tolist(), first[1:].tolist(), words.counts.tolist(), langs) if n]
            if rows:
                none = [None] * len(rows)
                codes_of = [flat[8 * a : 8 * b] for a, b, _, _ in rows]
                shard = [zlib.crc32(c) % SHARDS for c in codes_of]
                seeds = [int(language_seed(r[3]).view(np.int64)) for r in rows]
                yield _batch([shard, [r[3] for r in rows], seeds, [r[2] for r in rows], codes_of, none, none], schema)
        parts = [(i // _CHUNK, zlib.compress(p.tobytes(), 1)) for i in range(0, BUCKETS, _CHUNK) if (p := filled[i : i + _CHUNK]).any()]
        none = [None] * len(parts)
        # filter parts lie beside the shards
        yield _batch([[-1] * len(parts), none, none, none, none, [p[0] for p in parts], [p[1] for p in parts]], schema)

    return docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang), F.lit("und")).alias("lang")).mapInArrow(run, layout)


def pair_filter(parts: DataFrame, least: int) -> np.ndarray:
    """The bitmap of the buckets that reach ``least``; parts of a chunk are added up where they meet."""
    schema = arrow_schema("chunk int, bits binary")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for chunks, counts in pieces(batches, None):
            for c, packed in zip(chunks, counts):
                part = np.frombuffer(zlib.decompress(packed), np.uint8)
                # 255 stands for 255 or more, which is enough in any case or counts as enough
                total[c] = np.minimum(total.get(c, np.zeros(_CHUNK, np.uint32)) + part + (part == 255) * np.uint32(least), np.uint32(1 << 30))
        out = [(c, np.packbits(t >= least, bitorder="little").tobytes()) for c, t in total.items()]
        yield _batch([[c for c, _ in out], [b for _, b in out]], schema)

    return _bitmap(parts.select("chunk", "counts").repartition("chunk").mapInArrow(add, "chunk int, bits binary"))


def _bitmap(chunks: DataFrame) -> np.ndarray:
    """A bitmap from the chunks that have a bit; its size is fixed."""
    bits = np.zeros(BITS // 8, np.uint8)
    for r in chunks.collect():
        bits[r["chunk"] * _CHUNK // 8 : (r["chunk"] + 1) * _CHUNK // 8] |= np.frombuffer(r["bits"], np.uint8)
    return bits


def marked(counts: list[DataFrame], least: int) -> np.ndarray:
    """The bitmap of the phrases that have at least ``least`` in the tables together."""
    often = _sum(counts).where(F.col("n") >= least)
    place = F.shiftrightunsigned("phrase", 40)
    word, bit = F.shiftright(place, 5), F.expr("shiftleft(1L, cast(shiftrightunsigned(phrase, 40) & 31 as int))")
    words = often.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))  # at most BITS / 32 rows
    found = words.toArrow()
    out = np.zeros(BITS // 32, np.uint32)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def _sum(counts: list[DataFrame], *carried: str) -> DataFrame:
    rows = counts[0]
    for c in counts[1:]:
        rows = rows.union(c)
    return rows.groupBy("phrase").agg(F.sum("n").alias("n"), *(F.first(c).alias(c) for c in carried))


COUNTED = ("prefix", "suffix", "seed")


def scan(shard: DataFrame, words_too: bool, now: np.ndarray | None, ago: np.ndarray | None, pairs: np.ndarray) -> DataFrame:
    """(phrase, n, prefix, suffix, seed): how often a shard has each phrase that is being counted: those that ``now`` admits and ``ago`` did not.

    A phrase was admitted only if its parts were, all the way down: a bit of ``ago`` that another phrase set is not enough.
    ``prefix`` and ``suffix`` are the phrases of one word less that it begins and ends with (0: it is a word).
    """
    small_batches(shard.sparkSession)
    layout = "phrase bigint, n bigint, prefix bigint, suffix bigint, seed bigint"
    schema = arrow_schema(layout)
    shared = shard.sparkSession.sparkContext.broadcast((now, ago, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ago, pairs = shared.value
        found: list[tuple[np.ndarray, ...]] = []
        held, last = 0, np.zeros(1, np.uint64)
        for batch in batches:
            parts = [np.frombuffer(b, np.uint64) for b in batch.column(0).to_pylist()]
            codes = np.concatenate([*parts, last])
            seeds = np.repeat(np.concatenate([batch.column(1).to_numpy(), [0]]), [*map(len, parts), 1])
            word = codes != 0
            if words_too:
                found.append((codes[word], np.zeros(int(word.sum()), np.uint64), np.zeros(int(word.sum()), np.uint64), seeds[word]))
            if now is not None:
                phrases, ok, was_ok = codes, word, word
                for length in range(2, LONGEST + 1):
                    inside, before = has(now, phrases) & ok, has(ago, phrases) & was_ok
                    n = max(0, len(codes) - length + 1)
                    admitted, was = inside[:n] & inside[1 : n + 1], before[:n] & before[1 : n + 1]
                    shorter, phrases = phrases, longer(phrases, codes, length)
                    if length == 2:
                        paired = has(pairs, phrases)
                        admitted, was = admitted & paired, was & paired
                    at = np.flatnonzero(admitted & ~was)
                    found.append((phrases[at], shorter[at], shorter[at + 1], seeds[at]))
                    ok, was_ok = admitted, was
            held += len(codes)
            if held >= FLUSH:
                yield _counted(found, schema)
                found, held = [], 0
        yield _counted(found, schema)

    return _sum([shard.select("codes", "seed").mapInArrow(run, layout)], *COUNTED)


def _counted(found: list[tuple[np.ndarray, ...]], schema: pa.Schema) -> pa.RecordBatch:
    if not found:
        return _batch([[]] * len(schema), schema)
    columns = [np.concatenate(c) for c in zip(*found)]
    phrases, at, n = np.unique(columns[0], return_index=True, return_counts=True)
    return _batch([phrases.view(np.int64), n, *(c[at].astype(np.int64, copy=False) if c.dtype == np.int64 else c[at].view(np.int64) for c in columns[1:])], schema)


def frequent(spark: SparkSession, shards: list[DataFrame], pairs: np.ndarray, least: int) -> DataFrame:
    """(phrase, n, prefix, suffix, seed) of all phrases that occur at least ``least`` times."""
    size = len(shards)
    tables: list[DataFrame] = []
    bitmaps: list[np.ndarray | None] = [None]  # before each scan; None: nothing has reached the threshold
    step = 0
    while True:
        ago = bitmaps[step - size] if step >= size else None
        rows = scan(shards[step % size], step < size, bitmaps[step], ago, pairs)
        tables.append(stored(rows, f"phrases-{step}"))
        # a phrase that is being counted was counted in the last scans only, one per shard
        reached = marked(tables[-size:], least)
        if bitmaps[step] is not None:
            reached = reached | bitmaps[step]
        bitmaps.append(reached if reached.any() else None)
        step += 1
        if step >= size and _same(bitmaps[step], bitmaps[step - size]):
            break  # all that was admitted has had its cycle
        if step > size:
            bitmaps[step - size - 1] = None  # no scan looks back so far
    return stored(_sum(tables, *COUNTED).where(F.col("n") >= least), "phrases")


def _same(a: np.ndarray | None, b: np.ndarray | None) -> bool:
    return (a is None and b is None) or (a is not None and b is not None and np.array_equal(a, b))


def named(docs: DataFrame, text: str, lang: str, bits: np.ndarray) -> DataFrame:
    """(phrase, words) of the phrases of two words and more in ``bits``.  A task sends a phrase again only after very many others."""
    small_batches(docs.sparkSession)
    layout = "phrase bigint, words string"
    schema = arrow_schema(layout)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = np.zeros(0, np.uint64)
        for texts, langs in pieces(batches, 0):
            words = Pieces(texts)
            codes = coded(words, langs)
            phrases = codes
            for length in range(2, LONGEST + 1):
                n = max(0, len(codes) - length + 1)
                phrases = longer(phrases, codes, length)
                at = np.flatnonzero((words.piece[length - 1 : length - 1 + n] == words.piece[:n]) & has(shared.value, phrases))
                at = at[np.unique(phrases[at], return_index=True)[1]]
                at = at[~np.isin(phrases[at], sent)]
                sent = np.concatenate([sent if len(sent) < SENT else sent[:0], phrases[at]])
                said = [
                    b" ".join(words.data[a:b].tobytes() for a, b in zip(words.start[i : i + length].tolist(), words.end[i : i + length].tolist()))
                    for i in at.tolist()
                ]
                if said:
                    yield _batch([phrases[at].view(np.int64), [s.decode("utf-8", "surrogatepass") for s in said]], schema)

    return docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang), F.lit("und")).alias("lang")).mapInArrow(run, layout)


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int | None = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of two to five words, or all of them.

    ``a`` is how often the phrase occurs, ``l`` and ``r`` how often the two parts of its weakest cut, ``n`` the words of the language,
    score ``floor(1000 * a * n / (l * r))``.  A phrase that occurs only inside one longer phrase is left out.
    """
    spark = docs.sparkSession
    kept = stored_shards(cut(docs, text, lang))
    rows = spark.read.schema("lang string, seed bigint, n bigint, codes binary, chunk int, counts binary, shard int").parquet(kept)
    pairs = pair_filter(rows.where("shard = -1"), least)
    shards = [rows.where(F.col("shard") == i) for i in range(SHARDS)]
    often = frequent(spark, shards, pairs, least)
    sizes = rows.where("shard >= 0").groupBy("seed", "lang").agg(F.sum("n").alias("size"))
    best = scored(often).join(sizes, "seed").select(
        "phrase", "lang", "a", F.col("size").alias("n"), F.transform("cuts", lambda c, i: F.struct(_score(c["l"], c["r"]).alias("score"), i, c["l"], c["r"])).alias("cuts")
    ).select("phrase", "lang", "a", "n", F.array_min("cuts").alias("cut"))
    found = best.select("phrase", "lang", "a", "cut.l", "cut.r", "n", "cut.score")
    strongest = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    if top is not None:  # also all that the last one's text decides about
        found = found.withColumn("place", F.rank().over(strongest)).where(F.col("place") <= top).drop("place")
    found = stored(found, "strongest")
    texts = named(docs, text, lang, marked([found.withColumn("n", F.lit(least))], least)).groupBy("phrase").agg(F.first("words").alias("words"))
    out = found.join(texts, "phrase").drop("phrase").withColumnRenamed("words", "phrase")
    ranked = out.withColumn("rank", F.row_number().over(strongest.orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("bigint"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def stored_shards(rows: DataFrame) -> str:
    """The rows by shard, without a shuffle: each task writes a file per shard."""
    path = scratch_dir(rows.sparkSession, "shards")
    rows.write.partitionBy("shard").parquet(path)
    return path


def scored(often: DataFrame) -> DataFrame:
    """(phrase, seed, a, cuts) of the candidates: ``cuts`` has (l, r), the counts of both parts, for each cut from the left."""
    longest = often.where("prefix <> 0").select(F.explode(F.array("prefix", "suffix")).alias("phrase"), F.col("n").alias("longer"))
    # what a phrase loses to a longer one, it loses to one of one word more
    inside = longest.groupBy("phrase").agg(F.max("longer").alias("longer"))
    rows = often.where("prefix <> 0").join(inside, "phrase", "left").where("longer is null or longer < n")
    rows = rows.select("phrase", "seed", F.col("n").alias("a"), "prefix", "suffix")
    for side in ("prefix", "suffix"):
        known = often.select(F.col("phrase").alias("_part"), F.col("n").alias("_n"), F.col(side).alias("_next"))
        rows = rows.withColumns({f"{side}es": F.array().cast("array<bigint>"), "_at": F.col(side)})
        for _ in range(LONGEST - 1):
            rows = rows.join(known, F.col("_at") == F.col("_part"), "left").withColumns({
                f"{side}es": F.when(F.col("_n").isNull(), F.col(f"{side}es")).otherwise(F.concat(f"{side}es", F.array("_n"))), "_at": F.coalesce("_next", F.lit(0)),
            }).drop("_part", "_n", "_next")
    cuts = F.zip_with(F.reverse("prefixes"), "suffixes", lambda x, y: F.struct(x.alias("l"), y.alias("r")))
    return rows.select("phrase", "seed", "a", cuts.alias("cuts"))


def _score(l: Column, r: Column) -> Column:  # noqa: E741
    exact = lambda c: c.cast("decimal(19,0)")
    return _quotient((F.lit(1000) * exact(F.col("a"))).cast("decimal(22,0)") * exact(F.col("size")), exact(l) * exact(r))


def _quotient(above: Column, below: Column) -> Column:
    """Whole quotient of two decimals, as a long."""
    return F.call_function("div", above, below).cast("bigint")
