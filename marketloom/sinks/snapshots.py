"""Metric snapshots: one JSON object per line, keys and lines sorted, decimals as text."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StringType, StructField, StructType

from marketloom.errors import BatchError
from marketloom.operators.numbering import numbered
from marketloom.schemas import METRICS, table_schema
from marketloom.sources.isolated import failure_of

BROKEN_LINE = "broken_line"


def _json_text(column: str, rows: DataFrame) -> Column:
    kind = rows.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, (DecimalType, DateType)):
        text = F.concat(F.lit('"'), value.cast("string"), F.lit('"'))
    elif isinstance(kind, StringType):
        quoted = F.to_json(F.array(value))
        text = F.substring(quoted, F.lit(2), F.char_length(quoted) - 2)
    else:
        text = value.cast("string")
    return F.when(value.isNull(), F.lit("null")).otherwise(text)


def canonical_json(rows: DataFrame) -> Column:
    """All columns as one JSON object text with sorted keys and NULLs kept."""
    pairs = [F.concat(F.lit(f'"{name}": '), _json_text(name, rows)) for name in sorted(rows.columns)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}"))


def snapshot_lines(rows: DataFrame) -> DataFrame:
    """The snapshot text of each row; ``orderBy("line")`` of it is the file order."""
    return rows.select("dt", canonical_json(rows).alias("line"))


def numbered_lines(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, line_no, line): the lines of all snapshots with their place in their file, from 1."""
    lines = [snapshot_lines(rows).select(F.lit(name).alias("table_name"), "line") for name, rows in tables.items()]
    return numbered(reduce(DataFrame.unionByName, lines), "table_name", "line")


def snapshot_path(root: str, batch_date: str, table: str) -> str:
    return f"{root}/snapshots/{batch_date}/{table}"


def write_snapshot(rows: DataFrame, root: str, batch_date: str, table: str) -> int:
    """Range-sorted text files, named in the order of their lines; gives the number of lines.

    Lines are counted behind the sort: what lies before it also runs to sample the ranges.
    """
    written = Observation(f"{table}_snapshot")
    lines = snapshot_lines(rows).select("line").orderBy("line").observe(written, F.count(F.lit(1)).alias("lines"))
    lines.write.mode("overwrite").text(snapshot_path(root, batch_date, table))
    return written.get["lines"]


def read_snapshot(spark: SparkSession, root: str, batch_date: str, table: str) -> DataFrame:
    """A written snapshot; blank lines are skipped and text decimals read as decimals.

    Raises when the snapshot is missing or one of its lines cannot be read.
    """
    schema, path = table_schema(table), snapshot_path(root, batch_date, table)
    try:
        lines = spark.read.schema(StructType([*schema.fields, StructField(BROKEN_LINE, StringType())])).option("columnNameOfCorruptRecord", BROKEN_LINE).json(path)
    except AnalysisException as error:
        raise BatchError(f"no snapshot of {table} for {batch_date}") from error
    reason = failure_of(lines)
    if reason is not None:
        raise BatchError(f"the snapshot of {table} for {batch_date} is unreadable: {reason}")
    if lines.where(F.col(BROKEN_LINE).isNotNull()).head(1):
        raise BatchError(f"the snapshot of {table} for {batch_date} has unreadable lines")
    return lines.drop(BROKEN_LINE)


def read_snapshots(spark: SparkSession, root: str, batch_date: str) -> dict[str, DataFrame]:
    """All six snapshots; fails when one is missing or broken, before anything is changed."""
    return {table: read_snapshot(spark, root, batch_date, table) for table in METRICS}
