"""Landing: raw payloads kept as they came, and their items as dated envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.errors import BatchError
from marketloom.schemas import FEEDS
from marketloom.sinks import versions
from marketloom.sources.envelopes import checked_date, feed_path, landing_log
from marketloom.sources.payloads import broken_payloads, flatten_payloads, raw_path


def land_payloads(payloads: dict[str, DataFrame], root: str, batch_date: str) -> str:
    """Land all sources of a batch, or none; gives the version.

    ``payloads`` maps a source to its pages (source, batch_date, payload). All pages are checked
    before the first write, and must name the batch they are landed in. Raw pages are kept as one JSON text a
    line each, so that they can be read back. Everything is written under a new version, which readers see when the
    last source is there: a run that ends early shows nothing, and landing again replaces the whole batch.
    """
    return land_batches({s: pages.withColumn("dt", F.lit(batch_date)) for s, pages in payloads.items()}, root, checked_date(batch_date))


def land_batches(payloads: dict[str, DataFrame], root: str, batch_date: str | None = None) -> str:
    """As ``land_payloads``, for the batches that the pages' ``dt`` names (or all of one ``batch_date``), by one commit."""
    unknown = set(payloads) - set(FEEDS)
    if unknown:
        raise ValueError(f"unknown sources: {sorted(unknown)}")
    for source, pages in payloads.items():
        if pages.isEmpty():
            raise BatchError(f"no payload for {source}")
        if not pages.where(~(F.col("source").eqNullSafe(source) & F.col("batch_date").eqNullSafe(F.col("dt")))).isEmpty():
            raise BatchError(f"a payload of {source} belongs to another source or batch")
        if not broken_payloads(pages).isEmpty():
            raise BatchError(f"a payload of {source} has no list named {source}")
    version, landed = versions.new_version(), None
    for source, pages in payloads.items():
        pages.select("payload", "dt").write.partitionBy("dt").json(versions.version_path(raw_path(root, source), version))
        flatten_payloads(pages).write.partitionBy("dt").json(versions.version_path(feed_path(root, source), version))
        batches = pages.select(F.lit(source).alias("name"), F.col("dt").alias("key")).distinct()
        landed = batches if landed is None else landed.unionByName(batches)
    if landed is not None:
        versions.commit(landing_log(root), landed, version)
    return version
