"""Session settings the transformations rely on, and size-checked broadcasting."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.errors import BatchError

# A repeated key in a JSON object keeps its last value instead of making the text unreadable.
REQUIRED_SETTINGS = {"spark.sql.variant.allowDuplicateKeys": "true"}

SIZE_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app_name: str = "marketloom", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("MARKETLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _as_bytes(text: str) -> int:
    digits = text.strip().lower().rstrip("bkmg")
    return int(digits) * SIZE_UNITS[text.strip().lower()[len(digits):]]


def fits_broadcast(df: DataFrame) -> bool:
    """True when Catalyst's size estimate of ``df`` is below the session's broadcast threshold."""
    limit = _as_bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return 0 < estimate <= limit


def broadcast_if_small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or a fresh one in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[[^-]*\])?$", spark.sparkContext.master):
        raise BatchError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="marketloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


# Spark removes the shuffle files of a query when it has ended. What is stored does not need them any more.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written here does not leave its shuffle files behind."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back.

    Used where several consumers read one result: columnar, prunable, sized by its files, and
    safe against lost executors because it no longer depends on their shuffle output, which is removed.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/marketloom/{uuid.uuid4().hex}/{name}"
    with shuffles_removed(spark):
        df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._marketloom_folder = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Remove what ``materialise`` has stored, when all that read it has been stored in turn."""
    for df in stored:
        jvm = df.sparkSession._jvm
        place = jvm.org.apache.hadoop.fs.Path(df._marketloom_folder)
        place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
