"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where the split costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Group and rank by all keys, not by the part of them a join happened to shuffle on.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
}

# A task of a scan reads no more of a file than this: it sorts its rows to combine those of a key, and
# values that repeat take many times their size in a file.
SCAN_BYTES = 32 * 1024 * 1024
_SCAN = "spark.sql.files.maxPartitionBytes"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job here relies on; sizes stay the cluster's, but for large scans."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if size(spark.conf.get(_SCAN)) > SCAN_BYTES:
        spark.conf.set(_SCAN, str(SCAN_BYTES))
    return spark


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing = threading.Lock()
# Session -> how many are within, and the setting before the first of them.
_within: WeakKeyDictionary[SparkSession, tuple[int, str | None]] = WeakKeyDictionary()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that is made and run within go when it ends.

    Otherwise they stay on disk until the driver collects garbage, which a driver that only
    plans seldom does. Meant for writes: a query that runs again has to shuffle again. Before
    Spark 4.1 this changes nothing.
    """
    with _freeing:
        depth, before = _within.get(spark, (0, None))
        if not depth:
            before = spark.conf.get(_FREE, None)
            spark.conf.set(_FREE, "true")
        _within[spark] = (depth + 1, before)
    try:
        yield
    finally:
        with _freeing:
            depth, before = _within.pop(spark)
            if depth > 1:
                _within[spark] = (depth - 1, before)
            elif before is None:
                spark.conf.unset(_FREE)
            else:
                spark.conf.set(_FREE, before)


def local_session(cores: int | str = "*", app_name: str = "tidemark") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-"))
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session may lack the setting and then gets a temporary folder. On a
    cluster a missing setting is an error: a machine-local folder would lose data
    with the machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
