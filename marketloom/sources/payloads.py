"""Raw feed payloads: one JSON object per page, its items in an array named after the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import json_values as J
from marketloom.schemas import FEEDS, schema_of
from marketloom.sinks import versions
from marketloom.sources.envelopes import batch_folder, landing_log

# Items are read as their JSON text.
PAYLOAD_FIELDS = ", ".join(f"{name} ARRAY<STRING>" for name in FEEDS)


def read_payloads(spark: SparkSession, folder: str, source: str, batch_date: str) -> DataFrame:
    """Every file of ``folder`` is one payload page of ``source``; a page is read whole, so keep pages small."""
    pages = spark.read.text(folder, wholetext=True)
    return pages.select(
        F.lit(source).alias("source"), F.lit(batch_date).alias("batch_date"), F.col("value").alias("payload")
    )


def read_raw(spark: SparkSession, root: str, source: str, batch_date: str) -> DataFrame:
    """The pages of a landed batch as they came, to land them again."""
    pages = spark.read.schema("payload STRING").json(batch_folder(spark, root, source, batch_date, raw_path(root, source)))
    return pages.select(F.lit(source).alias("source"), F.lit(batch_date).alias("batch_date"), "payload")


def read_raw_batches(spark: SparkSession, root: str, source: str) -> DataFrame:
    """The pages of all landed batches of a source."""
    pages = versions.read_visible(spark, landing_log(root), raw_path(root, source), source, schema_of("payload STRING, dt STRING"), "dt", form="json")
    return pages.select(F.lit(source).alias("source"), F.col("dt").alias("batch_date"), "payload", "dt")


def raw_path(root: str, source: str) -> str:
    return f"{root}/raw/{source}"


def _read_pages(payloads: DataFrame) -> DataFrame:
    read = payloads.select("source", "batch_date", "payload", J.read_object(F.col("payload"), PAYLOAD_FIELDS).alias("read"))
    return read.select("source", "batch_date", J.payload_of(F.col("read"), F.col("payload")).alias("page"))


def _items(page: Column) -> Column:
    """The list named after the page's own source."""
    return F.coalesce(*[F.when(F.col("source") == name, page[name]) for name in FEEDS])


def broken_payloads(payloads: DataFrame) -> DataFrame:
    """Pages per source that have no list under the source's name."""
    counted = _read_pages(payloads).groupBy("source", "batch_date").agg(
        F.count_if(_items(F.col("page")).isNull()).alias("pages")
    )
    return counted.where(F.col("pages") > 0)


def flatten_payloads(payloads: DataFrame) -> DataFrame:
    """One envelope per item of the readable pages."""
    entity = F.lit(None).cast("string")
    for name, feed in FEEDS.items():
        entity = F.when(F.col("source") == name, F.lit(feed.entity)).otherwise(entity)
    return (
        _read_pages(payloads)
        .select("source", "batch_date", F.explode(F.when(F.col("page").isNotNull(), _items(F.col("page")))).alias("data"))
        .select(entity.alias("entity"), "source", "batch_date", "data", F.col("batch_date").alias("dt"))
    )
