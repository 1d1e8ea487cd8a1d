"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator relies on. Timestamps carry no zone, arithmetic is ANSI, and AQE may
# split a skewed shuffle partition even where that costs one more exchange.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "tallyhouse", master: str | None = None, **settings: str) -> SparkSession:
    """Create (or reuse) a session; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return prepare_session(builder.getOrCreate())


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
BYTES_PER_PARTITION = 64 * 1024 * 1024
UNKNOWN_SIZE = 1 << 60


def _scanned_bytes(df: DataFrame) -> int:
    """Bytes of the files a frame reads; sources of unknown size count as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN_SIZE)


def size_shuffles(spark: SparkSession, *tables: DataFrame, bytes_per_partition: int = BYTES_PER_PARTITION) -> int:
    """Let shuffles start with enough partitions for the given tables; AQE merges the small ones again.

    The sizes come from file metadata. The number only ever grows, and never falls below
    ``spark.sql.shuffle.partitions``.
    """
    total = sum(_scanned_bytes(table) for table in tables)
    current = int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-total // bytes_per_partition)
    if wanted > current:
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
        return wanted
    return current


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, a query deletes its shuffle files when it ends; otherwise they stay until the driver's JVM collects its garbage.

    A frame made within and run twice computes its shuffles twice.
    """
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


def releasing_shuffles(run: Callable) -> Callable:
    """A run of many queries, given the session first, as one within ``released_shuffles``."""

    @wraps(run)
    def released(spark: SparkSession, *args, **kwargs):
        with released_shuffles(spark):
            return run(spark, *args, **kwargs)

    return released


_LOCAL_FOLDERS: dict[str, str] = {}


def _shared_setting(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor can reach.

    A local folder is used only where that setting is absent and Spark itself runs on this machine.
    """
    shared = _shared_setting(spark)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder shared by all executors.")
        application = spark.sparkContext.applicationId
        if application not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="tallyhouse-")
        shared = _LOCAL_FOLDERS[application]
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
