"""Feeds of changes: what was in force on a day, without a copy of the feed for every day.

A change feed has a row of an item only on days (``dt``) when the item changed, and a row of its key alone when it was
withdrawn. Its size follows the changes, not days times items. Days are looked up for the (item, day) pairs that are asked for,
by a union with the versions and the last version before each; a group is one item, with at most a row per calendar
day and version, so a hot item needs no salt. Counts over all items come from running sums of changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.session import broadcast_if_small

VERSION = "version"


def versions(rows: DataFrame, on: str, withdrawn: DataFrame | None = None) -> DataFrame:
    """(on, dt, version): one version of an item a day; withdrawals (columns ``on`` and ``dt``) are versions without values.

    Repeated rows are one version. Of different rows of an item and day the greatest counts, by its columns in order,
    and a withdrawal before all others.
    """
    values = [name for name in rows.columns if name not in (on, "dt")]
    listed = rows.select(on, "dt", F.struct(F.lit(False).alias("withdrawn"), *values).alias(VERSION))
    if withdrawn is not None:
        empty = [F.lit(None).cast(rows.schema[name].dataType).alias(name) for name in values]
        gone = withdrawn.select(on, "dt", F.struct(F.lit(True).alias("withdrawn"), *empty).alias(VERSION))
        listed = listed.unionByName(gone)
    return listed.groupBy(on, "dt").agg(F.max(VERSION).alias(VERSION))


def as_of(asked: DataFrame, known: DataFrame, on: str) -> DataFrame:
    """The items of ``asked`` (``on``, ``dt``) as they were on that day: the columns of the versions' rows.

    A pair without a version up to its day, or whose last one is a withdrawal, gives no row. Null keys match no version.
    """
    pairs = asked.where(F.col(on).isNotNull()).select(on, "dt").distinct()
    none = F.lit(None).cast(known.schema[VERSION].dataType)
    marked = known.select(on, "dt", VERSION, F.lit(0).alias("asks")).unionByName(
        pairs.select(on, "dt", none.alias(VERSION), F.lit(1).alias("asks"))
    )
    until_now = Window.partitionBy(on).orderBy("dt", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = marked.withColumn(VERSION, F.last(VERSION, ignorenulls=True).over(until_now))
    found = last.where((F.col("asks") == 1) & ~F.col(VERSION)["withdrawn"])
    return found.select(on, "dt", f"{VERSION}.*").drop("withdrawn")


def rows_as_of(rows: DataFrame, known: DataFrame, on: str) -> DataFrame:
    """``rows`` (``on``, ``dt`` and others) with ``version``: the item as it was on that day, NULL where it was not listed.

    As ``as_of`` without a join back, for rows that are reduced already: they pass one shuffle, by ``on`` and ``apart``.
    ``apart`` deals rows without a key over their days, as they match no version. The rows come sorted by ``on``, ``apart``,
    ``dt`` and ``asks``, so windows over these need neither a shuffle nor a sort.
    """
    apart = F.when(F.col(on).isNull(), F.col("dt")).alias("apart")
    asks = rows.select(*rows.columns, apart, F.lit(1).alias("asks"))
    told = known.where(F.col(on).isNotNull()).select(on, "dt", VERSION, F.lit(0).alias("asks"))
    marked = asks.unionByName(told, allowMissingColumns=True)
    until_now = Window.partitionBy(on, "apart").orderBy("dt", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = marked.withColumn(VERSION, F.last(VERSION, ignorenulls=True).over(until_now)).where(F.col("asks") == 1)
    return last.select(*rows.columns, "apart", "asks", F.when(~F.col(VERSION)["withdrawn"], F.col(VERSION)).alias(VERSION))


def counts_over_time(known: DataFrame, on: str, by: list[str]) -> DataFrame:
    """(by, dt, items): how many items a group has from each day on when that changes; NULL is a group of its own.

    ``by`` are columns of the versions' rows. An item leaves its old group and enters its new one; changes of a day
    are added up before the running sum, so the sum of a group has one row per calendar day at most.
    """
    before = F.lag(VERSION).over(Window.partitionBy(on).orderBy("dt"))
    moves = known.where(F.col(on).isNotNull()).withColumn("before", before)

    def side(version: str, step: int) -> Column:
        group = [F.col(version)[name].alias(name) for name in by]
        present = F.col(version).isNotNull() & ~F.col(version)["withdrawn"]
        return F.when(present, F.struct(*group, F.lit(step).alias("step")))

    changes = moves.select("dt", F.inline(F.array_compact(F.array(side("before", -1), side(VERSION, 1)))))
    per_day = changes.groupBy(*by, "dt").agg(F.sum("step").alias("step")).where(F.col("step") != 0)
    running = Window.partitionBy(*by).orderBy("dt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_day.select(*by, "dt", F.sum("step").over(running).alias("items"))


def on_days(changes: DataFrame, by: list[str], days: DataFrame) -> DataFrame:
    """``changes`` of ``counts_over_time`` on every one of ``days`` (``dt``) where the group has items."""
    after = Window.partitionBy(*by).orderBy("dt")
    last_day = days.agg(F.max("dt")).scalar()
    until = F.coalesce(F.date_sub(F.to_date(F.lead("dt").over(after)), 1), F.to_date(last_day))
    spans = changes.withColumn("until", until).where((F.col("items") > 0) & (F.to_date("dt") <= F.col("until")))
    each = F.explode(F.sequence(F.to_date("dt"), F.col("until"), F.expr("INTERVAL 1 DAY")))
    filled = spans.select(*by, "items", each.alias("day")).select(*by, "items", F.date_format("day", "yyyy-MM-dd").alias("dt"))
    return filled.join(broadcast_if_small(days.select("dt").distinct()), "dt", "left_semi")
