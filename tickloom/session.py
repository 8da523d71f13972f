"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import atexit
import contextlib
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings that suit both a laptop and a large cluster. Sizes of shuffle
# partitions are left to AQE: it starts from many and merges or splits them
# towards the advisory size, also for the rebalanced table writes.
SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # A task that writes few dates keeps a file open for each instead of sorting.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}

# For many terabytes; see README "Running at scale". A submission's own values win.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
}

_local_root: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "tickloom", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    width = str(cores) if str(cores).isdigit() else "8"
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", width)
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_session(app: str) -> SparkSession:
    """The session of a submitted job."""
    given = SparkConf()
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **CLUSTER_SETTINGS}.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local session without that setting falls back to a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="tickloom-")
        atexit.register(shutil.rmtree, _local_root[app], ignore_errors=True)
    return _local_root[app]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared root that no earlier run has used."""
    return f"{shared_root(spark)}/tickloom/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def settings(spark: SparkSession, **values: object) -> Iterator[None]:
    """Session settings for the length of a block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
