"""Sessions for tests and benchmarks, and the folder a job may keep intermediate tables in."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: the session's checkpoint directory.

    Where none is set, a session on one machine gets a new temporary folder, and a session on a
    cluster a folder in its warehouse, which its executors share.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if configured is None:
        configured = context.getCheckpointDir()
    if configured is None:
        if context.master.startswith("local[") or context.master == "local":
            configured = tempfile.mkdtemp(prefix="docquarry-")
        else:
            configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/docquarry-work"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


@contextmanager
def small_splits(spark: SparkSession, size: int):
    """Scans that run inside read at most ``size`` bytes a task, unless the session asks for less already."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    digits = before.lower().removesuffix("b")
    if digits.isdigit() and int(digits) > size:
        spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Shuffle files of each job begun inside are removed when it ends, and not only when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def local_session(cores: int | str = 8, memory: str = "12g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("docquarry")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        # Call sites of every column expression cost more than building the expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
