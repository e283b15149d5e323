"""From raw documents to token ids in stages; each stage reads what the one before has written.

Every stage but the last gives rows of ``documents``: same columns, whole texts.  What each decides is written at it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailgold.llm import bpe, langid, line_dedup, mixing, ngram_join
from retailgold.llm.frames import stored

WORD = r"[^\x20\x09-\x0D]"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those in no learned language (calibrated score below one half)."""
    return langid.accepted(docs, langid.train(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of repeated line runs; a document of nothing else goes, ``n_chars`` follows the text."""
    left = line_dedup.deduplicated(docs).where((F.col("n_deleted") == 0) | F.col("text").rlike(WORD))
    return left.withColumn("n_chars", F.when(F.col("n_deleted") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each class, one of its rows if it is repeated.

    Rows are told apart by doc_id and text, so each text of a repeated doc_id is decided on its own, as is one without a doc_id,
    which comes after all that have one.  Documents without words are in no class and stay.
    """
    row = "_row"
    while row in docs.columns:
        row += "_"
    first = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    rows = docs.where(worded).withColumn(row, F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text"))
    found = stored(ngram_join.classes(rows.select(row, "text"), key=row), "pipeline-classes").select(row, "component_id")
    names = rows.select(row, "doc_id").join(found.distinct(), row)
    kept = names.groupBy("component_id").agg(F.min(first)[row].alias(row)).select(row)
    return rows.join(kept, row, "left_semi").dropDuplicates([row]).select(*docs.columns).unionByName(docs.where(~worded))


def _told_apart(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number of each text, by which rows of one doc_id, or without one, follow each other in the mix."""
    name = "_text"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, F.xxhash64("text")), name


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the documents in the order of the mix; none is left out.

    A reread need not give files in their order, so ``tokens`` states each document's place in this very order.
    """
    rows, text = _told_apart(docs)
    return mixing.mixed(rows, tie=text).orderBy("position").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of what is left, and its place in the mix: sorting by position gives the mix.

    The place has all that the mix decides: the source's share, and the block with its release, deadline and slot.
    """
    rows, text = _told_apart(docs)
    coded = bpe.encode_digests(rows, public_tokenizers.path("word_bpe_49k.json"), keep=("source", text))
    # places follow from doc_id, source and the text's number, so the texts are not shuffled again
    placed = mixing.mixed(stored(coded, "pipeline-coded"), tie=text)
    return placed.select(*(c for c in coded.columns if c not in ("source", text)), *mixing.PLACE)


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("mix", mix), ("tokens", tokens)]

# A learned model and merges of a vocabulary decide the rows, which SQL cannot express; the tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
