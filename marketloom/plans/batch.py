"""One batch from landed envelopes to published tables and the quality report.

Every layer is stored before the next reads it, as several builders share each input. Everything is
lazy between two stores; nothing but counts reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketloom.errors import BatchError
from marketloom.operators import details, dimensions, metrics, quality, summaries
from marketloom.schemas import FEEDS, METRICS, envelope_schema, schema_of, table_schema
from marketloom.session import broadcast_if_small, configure, materialise
from marketloom.sinks import serving, snapshots
from marketloom.sinks.tables import commit_partitions, read_table, replace_partition, replace_partitions, rows_per_batch, write_kinds
from marketloom.sources.envelopes import checked_date, read_batch, read_feed, require_landed_contract
from marketloom.sources.isolated import readable_or_empty

AUDIT = "feed STRING, dt STRING, read BIGINT, written BIGINT, invalid BIGINT"
EXPORTS = "table_name STRING, exported BIGINT"
FAILURES = "input STRING, reason STRING"


def batch_dates(spark: SparkSession, *dates: str) -> DataFrame:
    """Requested dates as a one-column frame."""
    return spark.createDataFrame([(checked_date(d),) for d in dates], "dt STRING")


def run_details(spark: SparkSession, root: str, batch_date: str) -> DataFrame:
    """Build the detail tables of a batch and give its audit rows.

    The JSON is read once per source: counts are observed while the table is written. Whether there
    is any valid row is asked first, which stops at the first one found.
    """
    configure(spark)
    checked_date(batch_date)
    counts = []
    for source, feed in FEEDS.items():
        envelopes = read_batch(spark, root, source, batch_date)
        if envelopes.isEmpty():
            raise BatchError(f"no {source} landed for {batch_date}")
        checked = details.CHECKS[source](envelopes)
        if details.accepted_rows(source, checked).isEmpty():
            raise BatchError(f"no valid {source} for {batch_date}")
        incoming, outgoing = Observation(f"{source}_read"), Observation(f"{source}_written")
        observed = checked.observe(
            incoming, F.count(F.lit(1)).alias("read"), F.count("reject_reason").alias("invalid")
        )
        rows = details.accepted_rows(source, observed).observe(outgoing, F.count(F.lit(1)).alias("written"))
        replace_partition(rows, root, feed.detail_table, batch_date)
        counts.append((source, batch_date, incoming.get["read"], outgoing.get["written"], incoming.get["invalid"]))
    return spark.createDataFrame(counts, AUDIT)


def _build_metrics(
    stored: Callable[[str], DataFrame], store: Callable[[str, DataFrame], None], dates: DataFrame
) -> dict[str, DataFrame]:
    """Dimensions, summaries and metrics in dependency order, each read back where it is used."""
    products, users, lines = (stored(FEEDS[s].detail_table) for s in ("products", "users", "carts"))
    store("dim_date", dimensions.date_dimension(dates))
    store("dim_product", dimensions.product_dimension(products))
    store("dim_category", dimensions.category_dimension(products))
    store("dim_user", dimensions.user_dimension(users))

    store("dws_sales_daily", summaries.sales_daily(lines, dates))
    store("dws_product_daily", summaries.product_daily(lines, stored("dim_product")))
    store("dws_category_daily", summaries.category_daily(stored("dws_product_daily"), stored("dim_category")))
    store("dws_user_profile_daily", summaries.user_profile_daily(stored("dim_user"), lines))
    store("dws_funnel_daily", summaries.funnel_daily(lines, dates))

    return _shape_metrics(stored, store)


def _shape_metrics(stored: Callable[[str], DataFrame], store: Callable[[str, DataFrame], None]) -> dict[str, DataFrame]:
    store("ads_kpi_daily", metrics.kpi_daily(stored("dws_sales_daily"), stored("dws_funnel_daily")))
    store("ads_sales_trend_daily", metrics.sales_trend_daily(stored("dws_sales_daily")))
    store("ads_product_rank_daily", metrics.product_rank_daily(stored("dws_product_daily")))
    store("ads_category_share_daily", metrics.category_share_daily(stored("dws_category_daily")))
    store("ads_user_profile_daily", metrics.user_profile_daily(stored("dws_user_profile_daily")))
    store("ads_funnel_daily", metrics.funnel_daily(stored("dws_funnel_daily")))
    return {table: stored(table) for table in METRICS}


def run_metrics(spark: SparkSession, root: str, batch_date: str) -> dict[str, DataFrame]:
    """Build everything above the detail tables for one batch."""
    return _build_metrics(
        lambda table: read_table(spark, root, table, batch_date),
        lambda table, rows: replace_partition(rows, root, table, batch_date),
        batch_dates(spark, batch_date),
    )


def backfill_details(spark: SparkSession, root: str, dates: DataFrame) -> DataFrame:
    """Rebuild the detail tables of many batches (column ``dt``), one job per source; gives their audit rows.

    Every envelope is parsed once: rows and what is to be counted are written together, and counted from the written
    columns. As in ``run_details`` a batch with nothing landed or no valid record fails, here for all sources and before any
    table changes; a requested date on which nothing at all has landed is an empty batch.
    """
    configure(spark)
    written, audits = {}, []
    for source, feed in FEEDS.items():
        landed = read_feed(spark, root, source).where(F.col("batch_date") == F.col("dt"))
        rows = details.audited_rows(source, _only(landed, dates))
        version, records = write_kinds(rows, root, feed.detail_table, schema_of("reject_reason STRING"))
        counts = records.groupBy("dt").agg(F.count(F.lit(1)).alias("read"), F.count("reject_reason").alias("invalid"))
        stored = rows_per_batch(spark, root, feed.detail_table, version)
        audit = counts.join(stored, "dt", "left").select(
            F.lit(source).alias("feed"), "dt", "read", F.coalesce("written", F.lit(0)).alias("written"), "invalid"
        )
        audits.append(audit)
        written[feed.detail_table] = version
    audit = materialise(reduce(DataFrame.unionByName, audits), "audit")
    landed = audit.groupBy("dt").agg(F.collect_set("feed").alias("feeds"), F.count_if(F.col("read") == F.col("invalid")).alias("empty"))
    broken = [r.dt for r in landed.where((F.size("feeds") < len(FEEDS)) | (F.col("empty") > 0)).orderBy("dt").limit(20).collect()]
    if broken:
        raise BatchError(f"sources without a valid record, or not landed: {', '.join(broken)}")
    for table, version in written.items():
        commit_partitions(root, table, version, audit.select("dt").distinct(), dates)
    return audit


def backfill_metrics(spark: SparkSession, root: str, dates: DataFrame) -> dict[str, DataFrame]:
    """Rebuild everything above the detail tables for many batches, one job per table."""
    return _build_metrics(
        lambda table: _only(read_table(spark, root, table), dates),
        lambda table, rows: replace_partitions(rows, root, table, dates),
        dates,
    )


def backfill_metrics_of_changes(
    spark: SparkSession, root: str, dates: DataFrame, withdrawn: dict[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """As ``backfill_metrics`` where the product and user details are feeds of changes.

    A detail row lies in the batch of the day it changed, and holds until the item's next one; ``withdrawn`` gives, per
    source, (product_id or user_id, dt) of items that are gone from that day on. Products and users are read up to
    the last of ``dates``, whatever their number, so a day costs its carts and not a copy of the catalogue.
    """
    gone = withdrawn or {}
    last = dates.agg(F.max("dt")).scalar()

    def stored(table: str) -> DataFrame:
        return _only(read_table(spark, root, table), dates)

    def store(table: str, rows: DataFrame) -> None:
        replace_partitions(rows, root, table, dates)

    products = dimensions.product_dimension(read_table(spark, root, "dwd_product_info").where(F.col("dt") <= last))
    users = dimensions.user_dimension(read_table(spark, root, "dwd_user_info").where(F.col("dt") <= last))
    lines = stored("dwd_order_cart_detail")
    store("dim_date", dimensions.date_dimension(dates))
    store("dws_sales_daily", summaries.sales_daily(lines, dates))
    store("dws_product_daily", summaries.product_daily_as_of(lines, products, gone.get("products")))
    store("dws_category_daily", summaries.category_daily_as_of(stored("dws_product_daily"), products, gone.get("products")))
    store("dws_user_profile_daily", summaries.user_profile_daily_as_of(users, lines, dates, gone.get("users")))
    store("dws_funnel_daily", summaries.funnel_daily(lines, dates))
    return _shape_metrics(stored, store)


def _only(rows: DataFrame, dates: DataFrame) -> DataFrame:
    """Rows of the requested batches; folders of other dates are pruned at run time."""
    return rows.join(broadcast_if_small(dates.select("dt").distinct()), "dt", "left_semi").select(*rows.columns)


def export_snapshots(tables: dict[str, DataFrame], root: str, batch_date: str) -> DataFrame:
    """Write the six snapshots; gives the rows written per table, counted while writing."""
    counts = [(table, snapshots.write_snapshot(rows, root, batch_date, table)) for table, rows in tables.items()]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(counts, EXPORTS)


def check_quality(spark: SparkSession, root: str, batch_date: str) -> DataFrame:
    """Evaluate the rules on the landed feeds and the snapshots; stores and gives the rule rows.

    An input that is missing, broken, or fails while it is read (a damaged or lost file) counts as empty: its rule fails,
    the reason is stored beside the report, and the others are evaluated. Each input is read once for that, so that
    no failure can reach the job of the rules.
    """
    inputs: dict[str, tuple[Callable[[], DataFrame], StructType]] = {
        s: (lambda s=s: read_batch(spark, root, s, batch_date), envelope_schema()) for s in FEEDS
    }
    inputs |= {t: (lambda t=t: snapshots.read_snapshot(spark, root, batch_date, t), table_schema(t)) for t in METRICS}
    read, failures = {}, []
    for name, (reader, schema) in inputs.items():
        read[name], reason = readable_or_empty(spark, reader, lambda schema=schema: spark.createDataFrame([], schema))
        if reason is not None:
            failures.append((name, reason))
    feeds, exported = ({n: read[n] for n in names} for names in (FEEDS, METRICS))
    rules = quality.quality_rules(feeds, exported, batch_dates(spark, batch_date))
    path = f"{root}/quality/{batch_date}"
    spark.createDataFrame(failures, FAILURES).coalesce(1).write.mode("overwrite").json(f"{path}/unreadable")
    rules.write.mode("overwrite").json(f"{path}/rules")
    stored = spark.read.schema(rules.schema).json(f"{path}/rules")
    quality.quality_report(stored).coalesce(1).write.mode("overwrite").json(f"{path}/report")
    return stored


def unreadable_inputs(spark: SparkSession, root: str, batch_date: str) -> DataFrame:
    """The inputs that the last quality check of a batch could not read, and why."""
    return spark.read.schema(FAILURES).json(f"{root}/quality/{batch_date}/unreadable")


def run_batch(spark: SparkSession, root: str, batch_date: str) -> dict[str, DataFrame]:
    """All stages of a landed batch in order; the first failing stage ends it."""
    configure(spark)
    checked_date(batch_date)
    for source in FEEDS:
        require_landed_contract(spark, root, source, batch_date)
    audited = run_details(spark, root, batch_date)
    audited.write.mode("overwrite").json(f"{root}/audit/dt={batch_date}")
    tables = run_metrics(spark, root, batch_date)
    exported = export_snapshots(tables, root, batch_date)
    serving.publish(snapshots.read_snapshots(spark, root, batch_date), root, batch_date)
    rules = check_quality(spark, root, batch_date)
    failed = [r.name for r in rules.where("status = 'failed' AND severity = 'critical'").collect()]
    if failed:
        raise BatchError(f"critical rules failed for {batch_date}: {', '.join(sorted(failed))}")
    return {"audit": audited, "exported": exported, "rules": rules}

