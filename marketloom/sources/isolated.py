"""Inputs that may be unreadable: a lost, cut or damaged file fails its own input and nothing else."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.errors import BatchError

# What Spark and the file systems say when a file cannot be read; any other failure is not the input's.
READ_ERRORS = (
    "FAILED_READ_FILE", "CANNOT_READ_FILE", "ChecksumException", "FileNotFoundException", "BlockMissingException",
    "MALFORMED_RECORD", "EOFException", "PATH_NOT_FOUND", "MalformedInputException", "ZipException", "not a Parquet file",
)


def _is_read_error(error: Exception) -> bool:
    return isinstance(error, (AnalysisException, BatchError)) or any(sign in str(error) for sign in READ_ERRORS)


def failure_of(rows: DataFrame) -> str | None:
    """Why ``rows`` cannot be read to their end, or None. Errors that are not of the input are raised.

    Everything is read and nothing kept: files fail when they are read, not when they are listed.
    """
    try:
        rows.agg(F.bit_xor(F.xxhash64(*rows.columns)), F.count(F.lit(1))).collect()
    except (Py4JJavaError, PySparkException, BatchError) as error:
        if not _is_read_error(error):
            raise
        return str(error).splitlines()[0]
    return None


def unreadable_files(spark: SparkSession, files: list[str], read: Callable[[list[str]], DataFrame]) -> list[str]:
    """Those of ``files`` that cannot be read. Halves without a failure are read once, so n bad ones of N take n log N jobs."""
    if not files or failure_of(read(files)) is None:
        return []
    if len(files) == 1:
        return files
    middle = len(files) // 2
    return unreadable_files(spark, files[:middle], read) + unreadable_files(spark, files[middle:], read)


def seen_and_listed(rows: DataFrame) -> tuple[int, int]:
    """(files that gave a row, files listed) of a readable input, by the hidden file name of every row."""
    seen = rows.select(F.col("_metadata.file_path").alias("file")).distinct().count()
    return seen, len(rows.inputFiles())


def readable_or_empty(spark: SparkSession, read: Callable[[], DataFrame], empty: Callable[[], DataFrame]) -> tuple[DataFrame, str | None]:
    """What ``read`` gives if all of it can be read, else an empty frame, and why."""
    try:
        rows = read()
    except (AnalysisException, BatchError) as error:
        return empty(), str(error).splitlines()[0]
    reason = failure_of(rows)
    return (rows, None) if reason is None else (empty(), reason)
