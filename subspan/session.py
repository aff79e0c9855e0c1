"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock
from weakref import WeakKeyDictionary

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

# Runtime settings the operators are written for. Results do not depend on any of them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # So many values of an IN filter reach the files' statistics and Bloom filters one by one, not as a range.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # Long texts: a batch for a Python worker ends at this size, however few rows it has.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BRIEF: WeakKeyDictionary[SparkSession, tuple[int, str | None]] = WeakKeyDictionary()  # how many are inside of brief_shuffles, and the setting before
_LOCK = Lock()


def local_session(app: str = "subspan", cores: str | int = "*", partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and the bench. Clusters bring their own session."""
    local = os.path.join(tempfile.gettempdir(), "subspan-warehouse")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        # Small data: keep every core busy instead of merging shuffles of a few megabytes.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SUBSPAN_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", local)
        .config("spark.checkpoint.dir", os.path.join(local, "shared"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that the whole cluster shares: ``spark.checkpoint.dir``, else one below the SQL warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/subspan-shared"


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is executed inside drops its shuffle files when it ends, not when the driver happens to collect its garbage.

    For steps that end in files or in a few collected rows. Threads may be inside together; the last to leave restores the session's setting.
    """
    with _LOCK:
        inside, kept = _BRIEF.get(spark, (0, None))
        if not inside:
            kept = spark.conf.get(SHUFFLE_CLEANUP, None)
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _BRIEF[spark] = inside + 1, kept
    try:
        yield
    finally:
        with _LOCK:
            inside, kept = _BRIEF[spark]
            _BRIEF[spark] = inside - 1, kept
            if inside == 1 and kept is None:
                spark.conf.unset(SHUFFLE_CLEANUP)
            elif inside == 1:
                spark.conf.set(SHUFFLE_CLEANUP, kept)


def written(df: DataFrame, path: str, partition_by: str | None = None, placed: bool = False) -> DataFrame:
    """Write ``df`` and read it back: the plan after it starts from files, not from lineage.

    With ``partition_by`` one value goes to one task, or to several when it is large; ``placed`` rows lie like that already.
    """
    if partition_by:
        writer = (df if placed else df.hint("rebalance", partition_by)).write.partitionBy(partition_by)
    else:
        writer = df.write
    writer.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def observed(seen: Observation, name: str, default):
    """A metric of a finished write. A frame without rows may be planned away together with its
    metrics; ``default`` is their value over no rows."""
    try:
        return seen.get[name]
    except Py4JJavaError:
        return default
