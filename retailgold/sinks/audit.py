"""Audit log: one headerless control-character-separated row per table and run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retailgold.schemas import AUDIT_LAYOUT

# --- fixed value -----------------------------------------------------------------------------------------------------
SEPARATOR = "\u0001"
# --- end of fixed value ----------------------------------------------------------------------------------------------


def write_audit(rows: DataFrame, path: str) -> None:
    """Append a run's rows; a run has at most one per gold table, so one file holds them."""
    rows.coalesce(1).write.mode("append").option("sep", SEPARATOR).option("header", False).csv(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_LAYOUT).option("sep", SEPARATOR).csv(path)
