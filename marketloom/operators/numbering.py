"""Row numbers of a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.session import broadcast_if_small, materialise

NUMBER = "line_no"


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with ``line_no``, from 1 within each ``group`` in the given order (NULLs first); equal rows in any order.

    Rows are sorted by ranges and stored with their place; a range counts its rows per group, and sums of the counts
    before it give its first number. Only the counts, ranges plus groups in number, come together, so one large group is as
    many ranges as it needs.
    """
    keys = [F.col(group), *[F.col(name) for name in order]]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id())
    placed = materialise(placed.withColumn("range", F.shiftright("place", 33)), "numbered")
    counts = placed.groupBy("range", group).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    earlier = Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("range", F.col(group).alias("of"), "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    joined = placed.join(broadcast_if_small(starts), (placed["range"] == starts["range"]) & placed[group].eqNullSafe(starts["of"]))
    return joined.select(*[placed[c] for c in rows.columns], (F.col("before") + F.col("place") - F.col("first") + 1).alias(NUMBER))
