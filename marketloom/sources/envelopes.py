"""Landed envelopes: reading a batch, and checking landed text against the contract."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.errors import BatchError
from marketloom.functions import json_values as J
from marketloom.schemas import ENVELOPE, FEEDS, envelope_schema
from marketloom.sinks import versions

CONTRACT_FIELDS = ("entity", "source", "batch_date", "data")


def checked_date(batch_date: str) -> str:
    """``batch_date`` itself if it is YYYY-MM-DD and an existing calendar day."""
    try:
        good = date.fromisoformat(batch_date).isoformat() == batch_date
    except ValueError:
        good = False
    if not good:
        raise ValueError("a batch date must be a calendar day written YYYY-MM-DD")
    return batch_date


def feed_path(root: str, source: str) -> str:
    return f"{root}/ods/{source}"


def landing_log(root: str) -> str:
    return f"{root}/ods/_landed"


def batch_folder(spark: SparkSession, root: str, source: str, batch_date: str, base: str | None = None) -> str:
    """Where the landed batch lies that readers see; ``dt=`` folders without a log are read as they are."""
    base = base or feed_path(root, source)
    if not versions.exists(spark, landing_log(root)):
        return f"{base}/dt={batch_date}"
    version = versions.version_of(spark, landing_log(root), source, batch_date)
    if version is None:
        raise BatchError(f"{source} of {batch_date} has not landed")
    return f"{versions.version_path(base, version)}/dt={batch_date}"


def read_feed(spark: SparkSession, root: str, source: str) -> DataFrame:
    """All landed batches of a source; ``dt`` comes from the folder names and stays a string."""
    if versions.exists(spark, landing_log(root)):
        return versions.read_visible(spark, landing_log(root), feed_path(root, source), source, envelope_schema(), "dt", form="json")
    return spark.read.schema(envelope_schema()).option("basePath", feed_path(root, source)).json(feed_path(root, source))


def read_batch(spark: SparkSession, root: str, source: str, batch_date: str) -> DataFrame:
    """Envelopes of one batch; those that name another date belong elsewhere and are left out."""
    checked_date(batch_date)
    try:
        landed = spark.read.schema(ENVELOPE).json(batch_folder(spark, root, source, batch_date))
    except AnalysisException as error:
        raise BatchError(f"cannot read {source} of {batch_date}: {error}") from error
    return landed.where(F.col("batch_date") == batch_date).withColumn("dt", F.lit(batch_date))


def _is_json(text: Column) -> Column:
    """A single JSON value of any type with nothing after it."""
    pair = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), J.end_mark(text), F.lit('"]')))
    return J.holds(F.try_variant_get(pair, "$[1]", "string") == J.end_mark(text)) & F.try_variant_get(pair, "$[2]", "variant").isNull()


def contract_checked(lines: DataFrame, source: str, batch_date: Column) -> DataFrame:
    """Landed lines (column ``value``) with their first contract ``violation``, NULL when there is none."""
    fields = ", ".join(f"{name} VARIANT" for name in CONTRACT_FIELDS)
    read = lines.select("*", J.read_object(F.col("value"), fields).alias("read"))
    row = F.col("row")
    parsed = read.select(*lines.columns, J.payload_of(F.col("read"), F.col("value")).alias("row")).select(
        "*", *[J.text_value(row[name]).alias(f"{name}_text") for name in CONTRACT_FIELDS]
    )
    expected = {"entity": F.lit(FEEDS[source].entity), "source": F.lit(source), "batch_date": batch_date}
    checks = [("blank_line", J.is_visible(F.col("value"))), ("invalid_json", row.isNotNull())]
    checks += [(f"missing_{name}", row[name].isNotNull()) for name in CONTRACT_FIELDS]
    checks += [(f"{name}_mismatch", J.holds(F.col(f"{name}_text") == value)) for name, value in expected.items()]
    checks += [("data_not_text", F.col("data_text").isNotNull()), ("data_not_json", _is_json(F.col("data_text")))]
    violation = F.coalesce(*[F.when(~holds, F.lit(name)) for name, holds in checks])
    return parsed.select(*lines.columns, violation.alias("violation"))


def contract_violations(lines: DataFrame, source: str, batch_date: Column) -> DataFrame:
    """Violating lines per kind; filtered by count, as a filter on the kind would read the JSON twice."""
    checked = contract_checked(lines, source, batch_date).withColumn("source", F.lit(source))
    counted = checked.groupBy("source", "violation").agg(F.count("violation").alias("rows"))
    return counted.where(F.col("rows") > 0)


def require_landed_contract(spark: SparkSession, root: str, source: str, batch_date: str) -> None:
    """Raise if the landed text of a batch is empty or breaks the contract."""
    checked_date(batch_date)
    lines = spark.read.text(batch_folder(spark, root, source, batch_date))
    if lines.isEmpty():
        raise BatchError(f"landed {source} of {batch_date} is empty")
    broken = contract_violations(lines, source, F.lit(batch_date)).collect()
    if broken:
        raise BatchError("; ".join(f"{source} {r.violation}: {r.rows}" for r in broken))
