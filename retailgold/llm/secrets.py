"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Three base kinds are found by pattern, and a fourth, ``own``, are runs that look like a generated credential (length, letters
of both cases, digits, many different signs).  The value of every candidate is hashed, and each hash is counted by the distinct
repositories and owners it occurs under: a value under ``example_owners`` owners or more is a widely copied example, one
below is specific to its owners.  Base spans are always reported; an ``own`` span only where its value is owner-specific and
it does not lie inside a base span.

Positions are code points, ends exclusive.  They come from the pieces between the matches (split) and the matches themselves.
Null and empty texts hold nothing.  A null repository or owner counts as one of its own; rows that repeat key and text are
reported each, with the same spans.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailgold.llm.frames import stored

# Kind, pattern, group that holds the value, least length of that group.
KINDS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    ("own", r"[A-Za-z0-9+/_-]{20,}", 0, 20),
)
EXAMPLE_OWNERS = 3
DIFFERENT_SIGNS = 10


def live_looking(value: Column) -> Column:
    return (
        value.rlike("[a-z]") & value.rlike("[A-Z]") & value.rlike("[0-9]")
        & (F.size(F.array_distinct(F.split(value, ""))) >= DIFFERENT_SIGNS)
    )


def matches(text: Column, pattern: str, group: int) -> Column:
    """Array of (gap, length, value): code points since the last match, of the match, and the group."""
    whole, values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(whole))
    joined = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), values.alias("value"))
    return F.transform(joined, lambda m: F.struct(F.length(m["gap"]).alias("gap"), F.length(m["whole"]).alias("length"), m["value"].alias("value")))


def candidates(docs: DataFrame) -> DataFrame:
    """(key, mark, repository, owner, kind, matches) of the texts in which a kind occurs; ``mark`` stands for the text."""
    found = [
        F.when(F.col("text").rlike(p), F.struct(F.lit(i).alias("kind"), matches(F.col("text"), p, g).alias("matches")))
        for i, (_, p, g, _) in enumerate(KINDS)
    ]
    hits = docs.where(reduce(or_, (F.col("text").rlike(p) for _, p, _, _ in KINDS)))
    return hits.select("key", "mark", "repository", "owner", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("f")).select(
        "key", "mark", "repository", "owner", "f.kind", "f.matches"
    )


def accepted(kind: Column, value: Column) -> Column:
    out = F.lit(False)
    for i, (name, _, _, least) in enumerate(KINDS):
        rule = F.length(value) >= least
        out = F.when(kind == i, rule & live_looking(value) if name == "own" else rule).otherwise(out)
    return out


def ownership(found: DataFrame) -> DataFrame:
    """(hash, repositories, owners) of each accepted candidate value.

    Values are brought down to one row per value, repository and owner before the counts, so a widely copied one is no hot key.
    """
    values = found.select("repository", "owner", "kind", F.explode("matches.value").alias("value")).where(accepted(F.col("kind"), F.col("value")))
    seen = values.select(F.sha2("value", 256).alias("hash"), "repository", "owner").distinct()
    by_owner = seen.groupBy("hash", "owner").agg(F.count("*").alias("pairs"))
    repositories = seen.select("hash", "repository").distinct().groupBy("hash").agg(F.count("*").alias("repositories"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("owners")).join(repositories, "hash")


def spans_of(found: DataFrame) -> DataFrame:
    """(key, mark, kind, start, end, value) of each accepted match."""
    one = found.dropDuplicates(["key", "mark", "kind"]).select("key", "mark", "kind", F.posexplode("matches").alias("i", "m"))
    order = Window.partitionBy("key", "mark", "kind").orderBy("i")
    end = F.sum(F.col("m.gap") + F.col("m.length")).over(order)
    placed = one.select("key", "mark", "kind", (end - F.col("m.length")).alias("start"), end.alias("end"), F.col("m.value").alias("value"))
    return placed.where(accepted(F.col("kind"), F.col("value")))


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", repository: Column | None = None, owner: Column | None = None,
    example_owners: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """Per row: key, n_assign, n_access, n_hex, base_sha256, spans, and how many spans hold examples and owner-specific values."""
    repository = F.col("source") if repository is None else repository
    owner = F.col("source") if owner is None else owner
    body = F.coalesce(F.col(text), F.lit(""))
    docs = docs.select(
        F.col(key).alias("key"), body.alias("text"), F.xxhash64(body).alias("mark"),
        F.coalesce(F.concat(F.lit("+"), repository.cast("string")), F.lit("-")).alias("repository"),
        F.coalesce(F.concat(F.lit("+"), owner.cast("string")), F.lit("-")).alias("owner"),
    )
    found = stored(candidates(docs), "secret-candidates")
    spans = spans_of(found).withColumn("hash", F.sha2("value", 256)).join(ownership(found), "hash", "left")
    own = len(KINDS) - 1
    common = F.col("owners") >= example_owners
    # own spans inside a base span: the furthest end of the base spans that start no later
    order = Window.partitionBy("key", "mark").orderBy("start", F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(F.col("kind") < own, F.col("end"))).over(order)
    spans = spans.withColumn("reach", reach).where(
        (F.col("kind") < own) | (~common & (F.coalesce("reach", F.lit(-1)) < F.col("end")))
    )
    name = F.element_at(F.array(*(F.lit(k) for k, *_ in KINDS)), F.col("kind") + 1)
    said = F.concat_ws(":", name, F.col("start").cast("string"), F.col("end").cast("string"))
    item = F.struct("start", "kind", said.alias("said"))
    listed = lambda c: F.concat_ws(",", F.transform(F.sort_array(c), lambda x: x["said"]))
    by_text = spans.groupBy("key", "mark").agg(
        *(F.sum((F.col("kind") == i).cast("bigint")).alias(f"n_{k}") for i, (k, *_) in enumerate(KINDS[:own])),
        listed(F.collect_list(F.when(F.col("kind") < own, item))).alias("base"), listed(F.collect_list(item)).alias("spans"),
        F.sum(common.cast("bigint")).alias("n_example"), F.sum((~common).cast("bigint")).alias("n_owner_specific"),
    )
    # a null key is a key here
    keyed = lambda d: d.withColumn("_key", F.coalesce(F.concat(F.lit("+"), F.col("key").cast("string")), F.lit("-")))
    out = keyed(docs.select("key", "mark")).join(keyed(by_text).drop("key"), ["_key", "mark"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    none = lambda c: F.coalesce(c, F.lit(""))
    return out.select(
        F.col("key").alias(key), zero("n_assign"), zero("n_access"), zero("n_hex"), F.sha2(none("base"), 256).alias("base_sha256"),
        none("spans").alias("spans"), zero("n_example"), zero("n_owner_specific"),
    )
