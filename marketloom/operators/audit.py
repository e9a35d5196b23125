"""Counts of read, written and rejected records, and of exported rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.operators.details import CHECKS, RECORD, settled


def _counted(feed: str, envelopes: DataFrame) -> DataFrame:
    checked = CHECKS[feed](envelopes)
    rows = F.size("lines") if feed == "carts" else F.lit(1)
    counted = checked.select(
        *[name for name in (RECORD,) if name in checked.columns],
        F.lit(feed).alias("feed"),
        "dt",
        "reject_reason",
        F.when(F.col("reject_reason").isNull(), rows).otherwise(F.lit(0)).alias("rows"),
    )
    return settled(counted).drop(RECORD) if RECORD in checked.columns else counted


def _all_feeds(envelopes: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [_counted(feed, df) for feed, df in envelopes.items()])


def reject_counts(envelopes: dict[str, DataFrame]) -> DataFrame:
    """Rejected records per feed, batch and reason.

    Accepted ones are dropped by their zero count: a filter on the reason would read the JSON twice.
    """
    counted = _all_feeds(envelopes).groupBy("feed", "dt", "reject_reason").agg(F.count("reject_reason").alias("rejected"))
    return counted.where(F.col("rejected") > 0)


def batch_audit(envelopes: dict[str, DataFrame]) -> DataFrame:
    """Records read, detail rows written and records rejected per feed and batch."""
    return _all_feeds(envelopes).groupBy("feed", "dt").agg(
        F.count(F.lit(1)).alias("read"),
        F.sum("rows").alias("written"),
        F.count("reject_reason").alias("invalid"),
    )


def export_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table; a table without rows counts zero."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("exported")).select(F.lit(name).alias("table_name"), "exported")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
