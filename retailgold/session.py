"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# Values the operators rely on.  AQE picks broadcast joins from measured sizes and splits hot join partitions; a split
# is taken even where it costs one more shuffle, because an unsplit hot key costs the whole stage.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # sides that lie in buckets of one join key need no shuffle by all of them
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # many paths are listed by as many tasks, not by up to 10,000
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}

_local_scratch: list[tempfile.TemporaryDirectory] = []


def build_session(app_name: str = "retailgold", **conf: str) -> SparkSession:
    """A session with the settings above; master, memory and parallelism come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session that already runs."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def use_keyed_state(spark: SparkSession) -> None:
    """The state store that keyed state with timers needs; it keeps the state of large streams outside the heap."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )


def share_package(spark: SparkSession) -> None:
    """Python workers on the driver's machine find this package where the driver has it; a cluster gets it with ``--py-files``."""
    root, paths = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(filter(None, [paths.get("PYTHONPATH"), root]))


def scratch_dir(spark: SparkSession, name: str, root: str | None = None) -> str:
    """A new folder below ``root``, or else below the shared one the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder, which goes when the process ends.
    """
    root = root or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _local_scratch:
            _local_scratch.append(tempfile.TemporaryDirectory(prefix="retailgold-"))
        root = _local_scratch[0].name
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``scratch_dir`` named."""
    fs, folder = file_system(spark, path)
    fs.delete(folder, True)


def free_shuffles(spark: SparkSession) -> None:
    """What writes that have ended shuffled goes from the executors' disks.

    Spark removes it when the driver's JVM finds that nothing refers to it any more, which otherwise may be half an hour later.
    """
    spark.sparkContext._jvm.System.gc()
