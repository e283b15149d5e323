"""The operators as registered queries over the whole tables, with the column names their readers expect."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailgold.llm import (
    bpe, caps, chat, collocations, extract, langid, line_dedup, mixing, ngram_join, quality, secrets, structure, warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and calibrated score of every document."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op2_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and classes of all vectors of equal label."""
    return caps.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract.extract(table(spark, sf_dir, "pages"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document; a source is an owner, its documents of one language a repository."""
    repository = F.concat_ws("/", "source", "lang")
    return secrets.scan(table(spark, sf_dir, "documents"), repository=repository, owner=F.col("source"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive, normalised and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mix of all sources."""
    mix = mixing.mixed(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return mix.select("doc_id", "source", "share", "block", "release", "deadline", "slot", "position")


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without later copies of repeated line runs."""
    docs = line_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_deleted", "text")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.references(docs))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document."""
    return ngram_join.classes(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of every language."""
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after its rows were damaged."""
    said = table(spark, sf_dir, "conversations")
    found = structure.repair(structure.damage(said), said)
    return found.withColumn("repaired_sha256", structure.repaired_digest()).drop("repaired")


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the formatted conversations say, read back from their strings and masks; conversation -1 is full of control strings."""
    said = table(spark, sf_dir, "conversations")
    role = F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant"))
    odd = spark.range(2).select(F.lit(-1).cast(said.schema["conv_id"].dataType).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    columns = ["conv_id", "turn", "role", "text"]
    read = chat.read_turns(chat.format_conversations(chat.log_of(said.select(*columns).unionByName(odd))))
    said_by = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = read.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), said_by.alias("said"), chat.loss_text().alias("loss"), "formatted")
    return read.select(
        "conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def llm_queries():
    run = (
        op1_langid, op2_caps, op3_extract, op4_bpe, op5_secrets, op6_warc, op7_mixing, op8_lines, op9_quality, op10_ngram_join,
        op11_collocations, op12_structure, op13_chat,
    )
    return {f.__name__: f for f in run}

