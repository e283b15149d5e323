"""What the operators share: stored tables, and Python over Arrow batches of bounded size."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from retailgold.session import scratch_dir

ROOT = str(Path(__file__).resolve().parents[2])
BATCH_CHARS = 1_000_000
BATCH_ROWS = 2_000
# Workers live on from stage to stage, so they give back what a stage freed: Arrow's buffers go through malloc, and malloc keeps
# no more than these bytes.  What the session's user has set stays.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(8 << 20)}


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back: a cut lineage that outlives its executors."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``stored``, and its folder for ``drop_scratch`` once nothing reads it any more."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def small_batches(spark: SparkSession) -> None:
    """Few rows per Arrow batch, so that a batch of very long texts still fits a worker.

    Workers on the driver's machine also find this package where the driver has it, whatever folder they start in; a cluster
    gets it with ``--py-files``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    paths = spark.sparkContext.environment
    for name, value in WORKER_MEMORY.items():
        paths.setdefault(name, value)
    if ROOT not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(filter(None, [paths.get("PYTHONPATH"), ROOT]))


def pieces(batches: Iterator[pa.RecordBatch], text: int | None) -> Iterator[list[list]]:
    """Columns as Python lists, cut again where the texts of column ``text`` add up to ``BATCH_CHARS``."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        if text is None:
            yield columns
            continue
        start = held = 0
        for i, t in enumerate(columns[text]):
            held += len(t) if t else 0
            if held >= BATCH_CHARS:
                yield [c[start : i + 1] for c in columns]
                start, held = i + 1, 0
        if start < len(columns[text]) or not columns[text]:
            yield [c[start:] for c in columns]


def by_batch(df: DataFrame, make: Callable[[], Callable[..., list]], schema: str, text: int | None = None) -> DataFrame:
    """``make()`` runs once per task and gives the function from columns (lists) to result columns."""
    small_batches(df.sparkSession)
    arrow = to_arrow_schema(_as_struct(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for columns in pieces(batches, text):
            out = work(*columns)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def arrow_schema(schema: str) -> pa.Schema:
    return to_arrow_schema(_as_struct(schema))


def _as_struct(schema: str) -> StructType:
    return _parse_datatype_string(schema)
