"""Every operator as a query over the sample tables: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from marketloom.errors import BatchError
from marketloom.functions.text import is_batch_date
from marketloom.operators import audit, contracts, details, dimensions, metrics, quality, serving, summaries
from marketloom.plans import batch, landing
from marketloom.schemas import FEEDS, SERVING, table_schema
from marketloom.session import configure, materialise, shared_folder, shuffles_removed
from marketloom.sinks import serving as served
from marketloom.sinks import tables, versions
from marketloom.sinks.snapshots import numbered_lines, snapshot_lines
from marketloom.sinks.tables import align_to_schema
from marketloom.sources import envelopes as landed
from marketloom.sources import payloads
from marketloom.sources import sample_tables as sample

Query = Callable[[SparkSession, str], DataFrame]


def _day_lines(spark: SparkSession, folder: str) -> DataFrame:
    return sample.cart_detail(spark, folder, "day")


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.product_dimension(sample.product_detail(spark, folder))


def _users(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.user_dimension(sample.user_detail(spark, folder))


def _product_changes(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return dimensions.product_dimension(sample.product_changes(spark, folder)), sample.withdrawn_products(spark, folder)


def _user_changes(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return dimensions.user_dimension(sample.user_changes(spark, folder)), sample.withdrawn_users(spark, folder)


def _feeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    configure(spark)
    return {
        "products": sample.product_envelopes(spark, folder),
        "users": sample.user_envelopes(spark, folder),
        "carts": sample.cart_envelopes(spark, folder, "year"),
    }


def _records(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The feeds for counting: one row per record, without its data."""
    feeds = {
        "products": sample.product_envelopes(spark, folder),
        "users": sample.user_envelopes(spark, folder),
        "carts": sample.cart_records(spark, folder, "year"),
    }
    return {name: df.select(*details.ENVELOPE_COLUMNS) for name, df in feeds.items()}


def _day_records(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The daily feeds for counting: carts, and the products and users that changed."""
    return {
        "products": sample.product_changes(spark, folder).select("dt"),
        "users": sample.user_changes(spark, folder).select("dt"),
        "carts": sample.cart_records(spark, folder, "day").select("dt"),
    }


# ---- detail ------------------------------------------------------------------------------------


def dwd_product_info(spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    return details.detail_rows("products", sample.product_envelopes(spark, folder))


def dwd_user_info(spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    return details.detail_rows("users", sample.user_envelopes(spark, folder))


def dwd_order_cart_detail(spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    return details.detail_rows("carts", sample.cart_envelopes(spark, folder, "day"))


def batch_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Records of each batch that name the batch they lie in."""
    rows = reduce(DataFrame.unionByName, _records(spark, folder).values())
    own = rows.where(F.col("batch_date") == F.col("dt"))
    return own.groupBy("source", "dt").agg(F.count(F.lit(1)).alias("envelopes"))


def reject_counts(spark: SparkSession, folder: str) -> DataFrame:
    return audit.reject_counts(_feeds(spark, folder))


def batch_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.batch_audit(_feeds(spark, folder))


# ---- dimensions, summaries, metrics --------------------------------------------------------------


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.date_dimension(sample.batch_dates(spark, folder, "day"))


def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    return _products(spark, folder)


def dim_category(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.category_dimension(sample.product_detail(spark, folder))


def dim_user(spark: SparkSession, folder: str) -> DataFrame:
    return _users(spark, folder)


def dws_sales_daily(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.sales_daily(_day_lines(spark, folder))


def dws_product_daily(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.product_daily_as_of(_day_lines(spark, folder), *_product_changes(spark, folder))


def dws_category_daily(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.category_daily_as_of(dws_product_daily(spark, folder), *_product_changes(spark, folder))


def dws_user_profile_daily(spark: SparkSession, folder: str) -> DataFrame:
    users, withdrawn = _user_changes(spark, folder)
    dates = sample.batch_dates(spark, folder, "day")
    return summaries.user_profile_daily_as_of(users, _day_lines(spark, folder), dates, withdrawn)


def dws_funnel_daily(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.funnel_daily(_day_lines(spark, folder))


def ads_kpi_daily(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.kpi_of_sales(dws_sales_daily(spark, folder))


def ads_sales_trend_daily(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.sales_trend_daily(dws_sales_daily(spark, folder))


def ads_product_rank_daily(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.product_rank_daily(dws_product_daily(spark, folder))


def ads_category_share_daily(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.category_share_daily(materialise(dws_category_daily(spark, folder), "dws_category_daily"))


def ads_user_profile_daily(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.user_profile_daily(dws_user_profile_daily(spark, folder))


def ads_funnel_daily(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.funnel_daily(dws_funnel_daily(spark, folder))


def kpi_from_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The whole way from JSON envelopes to the KPI table."""
    return metrics.kpi_of_sales(summaries.sales_daily(dwd_order_cart_detail(spark, folder)))


# ---- stored metric tables and what reads them ----------------------------------------------------

_STORED: dict[tuple[str, str], dict[str, DataFrame]] = {}


def stored_metrics(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The six metric tables of the daily batches, stored once per application and folder.

    Serving, contract and quality queries read stored tables, as they do in a batch.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _STORED:
        lines = materialise(_day_lines(spark, folder).select(*summaries.LINE_COLUMNS), "dwd_order_cart_detail")
        products, gone_products = _product_changes(spark, folder)
        users, gone_users = _user_changes(spark, folder)
        product_days = materialise(summaries.product_daily_as_of(lines, products, gone_products), "dws_product_daily")
        category_days = materialise(
            summaries.category_daily_as_of(product_days, products, gone_products), "dws_category_daily"
        )
        sales = materialise(summaries.sales_daily(lines), "dws_sales_daily")
        funnel = materialise(summaries.funnel_daily(lines), "dws_funnel_daily")
        dates = sample.batch_dates(spark, folder, "day")
        profile = summaries.user_profile_daily_as_of(users, lines, dates, gone_users)
        built = {
            "ads_kpi_daily": metrics.kpi_daily(sales, funnel),
            "ads_sales_trend_daily": metrics.sales_trend_daily(sales),
            "ads_product_rank_daily": metrics.product_rank_daily(product_days),
            "ads_category_share_daily": metrics.category_share_daily(category_days),
            "ads_user_profile_daily": metrics.user_profile_daily(profile),
            "ads_funnel_daily": metrics.funnel_daily(funnel),
        }
        _STORED[key] = {name: materialise(rows, name) for name, rows in built.items()}
    return _STORED[key]


def align_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Rows from before ``category_hint`` existed, with a column the table does not know."""
    old = _day_lines(spark, folder).drop("category_hint").withColumn("extra", F.lit("x"))
    return align_to_schema(old, table_schema("dwd_order_cart_detail"))


def snapshot_rows(spark: SparkSession, folder: str) -> DataFrame:
    tables = stored_metrics(spark, folder)
    lines = [snapshot_lines(rows).select(F.lit(name).alias("table_name"), "line") for name, rows in tables.items()]
    return reduce(DataFrame.unionByName, lines)


def serving_rows(spark: SparkSession, folder: str) -> DataFrame:
    shares = stored_metrics(spark, folder)["ads_category_share_daily"]
    return contracts.serving_rows("ads_category_share_daily", shares.drop("sales_quantity").withColumn("extra", F.lit(1)))


def contract_violations(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.contract_violations(stored_metrics(spark, folder))


def export_counts(spark: SparkSession, folder: str) -> DataFrame:
    return audit.export_counts(stored_metrics(spark, folder))


def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(_day_records(spark, folder), stored_metrics(spark, folder))


def quality_summary(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_summary(quality_report(spark, folder))


def latest_date(spark: SparkSession, folder: str) -> DataFrame:
    return serving.latest_date(stored_metrics(spark, folder))


def _section(name: str) -> Query:
    return lambda spark, folder: serving.section_rows(stored_metrics(spark, folder), name)


def overview_sections(spark: SparkSession, folder: str) -> DataFrame:
    return serving.overview_sections(stored_metrics(spark, folder))


def overview_latest(spark: SparkSession, folder: str) -> DataFrame:
    return serving.overview(stored_metrics(spark, folder))


def kpi_cards(spark: SparkSession, folder: str) -> DataFrame:
    """Cards of every day, so that all number formats occur."""
    return serving.kpi_cards(ads_kpi_daily(spark, folder))


def share_slices(spark: SparkSession, folder: str) -> DataFrame:
    return serving.share_slices(stored_metrics(spark, folder)["ads_category_share_daily"])


def profile_labels(spark: SparkSession, folder: str) -> DataFrame:
    return serving.profile_labels(stored_metrics(spark, folder)["ads_user_profile_daily"])


# ---- landing -------------------------------------------------------------------------------------


def _pages(spark: SparkSession, folder: str, broken: bool = True) -> DataFrame:
    return reduce(DataFrame.unionByName, [sample.payload_pages(spark, folder, source, broken) for source in FEEDS])


def flatten_payload(spark: SparkSession, folder: str) -> DataFrame:
    return payloads.flatten_payloads(_pages(spark, folder)).drop("dt")


def broken_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Batches with a page that has no list under its source's name."""
    return payloads.broken_payloads(_pages(spark, folder)).select("source", "batch_date")


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder for a query that writes and reads back."""
    return f"{shared_folder(spark)}/marketloom/{uuid.uuid4().hex}/{name}"


def landed_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """Land three sources twice, then once with a broken page in the third, which is refused; what readers see then."""
    root = _scratch(spark, "landed")
    dated = lambda broken: {
        source: sample.payload_pages(spark, folder, source, broken).withColumn("dt", F.col("batch_date")) for source in FEEDS
    }
    good, bad = dated(False), dated(True)
    landing.land_batches(good, root)
    landing.land_batches(good, root)
    try:
        landing.land_batches({**good, "carts": bad["carts"]}, root)
    except BatchError:
        seen = [landed.read_feed(spark, root, source) for source in FEEDS]
        return reduce(DataFrame.unionByName, seen).select("entity", "source", "batch_date", "data", "dt")
    raise AssertionError("a broken page was landed")


def raw_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Raw pages landed and read back: their items per batch."""
    root = _scratch(spark, "raw")
    pages = {s: sample.payload_pages(spark, folder, s, False).withColumn("dt", F.col("batch_date")) for s in FEEDS}
    landing.land_batches(pages, root)
    read = reduce(DataFrame.unionByName, [payloads.read_raw_batches(spark, root, source) for source in FEEDS])
    return payloads.flatten_payloads(read).groupBy("source", "dt").agg(F.count(F.lit(1)).alias("items"))


REPLACED, EMPTIED = "07", "03"


def replaced_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly sales written, then the Julys replaced and the Marches emptied by one commit, twice; what is read then."""
    root = _scratch(spark, "partitions")
    sales = materialise(summaries.sales_daily(sample.cart_detail(spark, folder, "month")), "dws_sales_daily")
    month = F.substring("dt", 6, 2)
    tables.replace_partitions(sales.withColumn("order_count", F.lit(-1).cast("bigint")), root, "dws_sales_daily")
    first = tables.replace_partitions(sales, root, "dws_sales_daily")
    changed = sales.where(month == REPLACED).withColumn("total_quantity", F.lit(0).cast("bigint"))
    dates = sales.where(month.isin(REPLACED, EMPTIED)).select("dt")
    for _ in range(2):
        tables.replace_partitions(changed, root, "dws_sales_daily", dates)
    before = tables.read_table(spark, root, "dws_sales_daily", None, first).withColumn("state", F.lit("before"))
    after = tables.read_table(spark, root, "dws_sales_daily").withColumn("state", F.lit("after"))
    return before.unionByName(after)


def _lines_of(rows: dict[str, DataFrame], **extra: Column) -> DataFrame:
    parts = [snapshot_lines(df.withColumn("dt", F.col("date_id"))).select(F.lit(name).alias("table_name"), "line") for name, df in rows.items()]
    return reduce(DataFrame.unionByName, parts).withColumns(extra)


def _corrections(tables_: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Rows to merge: on the 15th of a month keys in capitals with spaces behind, and whole new dates."""
    out = {}
    for name, rows in tables_.items():
        old = contracts.serving_rows(name, rows)
        texts = [k for k in SERVING[name].key if k != "date_id" and isinstance(old.schema[k].dataType, StringType)]
        capital = {k: F.concat(F.upper(k), F.lit("  ")) for k in texts}
        again = old.where(F.col("date_id").endswith("-15")).withColumns(capital)
        new = old.where(F.col("date_id").endswith("-16")).withColumn("date_id", F.regexp_replace("date_id", "^19", "29"))
        out[name] = again.unionByName(new)
    return out


def merged_tables(spark: SparkSession, folder: str) -> DataFrame:
    """All six tables with corrections merged by their collated keys."""
    stored = stored_metrics(spark, folder)
    fixes = _corrections(stored)
    return _lines_of({name: contracts.merged_rows(name, rows, fixes[name]) for name, rows in stored.items()})


def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of the tables that differ only in case, and how often they occur."""
    found = [
        contracts.duplicate_keys(name, rows).groupBy(F.lit(name).alias("table_name")).agg(F.count(F.lit(1)).alias("keys"), F.sum("copies").alias("rows"))
        for name, rows in stored_metrics(spark, folder).items()
    ]
    return reduce(DataFrame.unionByName, found)


def published_versions(spark: SparkSession, folder: str) -> DataFrame:
    """All dates published, corrected by an upsert, the first version read again, old versions removed: both states."""
    root = _scratch(spark, "published")
    stored = {name: contracts.with_defaults(name, rows) for name, rows in stored_metrics(spark, folder).items()}
    clean = {name: contracts.merged_rows(name, rows.limit(0), rows) for name, rows in stored.items()}
    dates = reduce(DataFrame.unionByName, [rows.select("date_id") for rows in stored.values()])
    first = served.publish_dates(clean, root, dates)
    before = materialise(_lines_of({n: df.drop("updated_at") for n, df in served.read_all_served(spark, root, first).items()}), "first")
    second = served.upsert(_corrections(stored), root)
    served.vacuum(spark, root, second)
    after = _lines_of({n: df.drop("updated_at") for n, df in served.read_all_served(spark, root).items()})
    return before.withColumn("state", F.lit("before")).unionByName(after.withColumn("state", F.lit("after")))


def numbered_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return numbered_lines(stored_metrics(spark, folder))


def backfilled_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The yearly feeds landed as files and backfilled in one pass each: the audit of every batch.

    The texts repeat their names and addresses in every record, so the files are compressed.
    """
    configure(spark)
    root, version = _scratch(spark, "backfill"), versions.new_version()
    for source, rows in _feeds(spark, folder).items():
        landed_rows = rows.select("entity", "source", "batch_date", "data", "dt")
        with shuffles_removed(spark):
            landed_rows.write.partitionBy("dt").json(versions.version_path(landed.feed_path(root, source), version), compression="gzip")
    dates = sample.batch_dates(spark, folder, "year")
    names = F.explode(F.array(*[F.lit(source) for source in FEEDS])).alias("name")
    versions.commit(landed.landing_log(root), dates.select(names, F.col("dt").alias("key")), version)
    return batch.backfill_details(spark, root, dates)


def asked_dates(spark: SparkSession, folder: str) -> DataFrame:
    """What queries of all kinds of dates are told: days with data, days without, and texts that are no date."""
    texts = sample.batch_date_texts(spark, folder).select(F.col("batch_date").alias("date_id"))
    absent = sample.batch_date_texts(spark, folder).select(F.regexp_replace("batch_date", "^19", "29").alias("date_id"))
    return serving.answer_states(stored_metrics(spark, folder), texts.union(absent))


def quality_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The quality document of every batch: its status, its counts, and its rules in their order."""
    rules = F.array_join(F.transform("rules", lambda r: F.concat(r["name"], F.lit("="), r["status"])), ";")
    return quality.quality_report(quality_report(spark, folder)).select("batch_date", "status", "summary.*", rules.alias("rules"))


def landed_violations(spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    return landed.contract_violations(sample.landed_user_lines(spark, folder), "users", F.col("dt"))


def batch_date_check(spark: SparkSession, folder: str) -> DataFrame:
    texts = sample.batch_date_texts(spark, folder)
    return texts.groupBy("batch_date", is_batch_date(F.col("batch_date")).alias("usable")).agg(
        F.count(F.lit(1)).alias("rows")
    )


QUERIES: dict[str, Query] = {
    "m01_dwd_product_info": dwd_product_info,
    "m02_dwd_user_info": dwd_user_info,
    "m03_dwd_order_cart_detail": dwd_order_cart_detail,
    "m04_dim_date": dim_date,
    "m05_dim_product": dim_product,
    "m06_dim_category": dim_category,
    "m07_dim_user": dim_user,
    "m08_dws_sales_daily": dws_sales_daily,
    "m09_dws_product_daily": dws_product_daily,
    "m10_dws_category_daily": dws_category_daily,
    "m11_dws_user_profile_daily": dws_user_profile_daily,
    "m12_dws_funnel_daily": dws_funnel_daily,
    "m13_ads_kpi_daily": ads_kpi_daily,
    "m14_ads_sales_trend_daily": ads_sales_trend_daily,
    "m15_ads_product_rank_daily": ads_product_rank_daily,
    "m16_ads_category_share_daily": ads_category_share_daily,
    "m17_ads_user_profile_daily": ads_user_profile_daily,
    "m18_ads_funnel_daily": ads_funnel_daily,
    "m13_kpi_from_feed": kpi_from_feed,
    "s1_batch_rows": batch_rows,
    "s4_flatten_payload": flatten_payload,
    "k3_broken_payload": broken_payload,
    "k1_raw_pages": raw_pages,
    "k4_landed_feeds": landed_feeds,
    "k5_replaced_partitions": replaced_partitions,
    "k6_backfilled_batches": backfilled_batches,
    "k10_merged_tables": merged_tables,
    "k10_duplicate_keys": duplicate_keys,
    "k12_published_versions": published_versions,
    "k15_quality_documents": quality_documents,
    "t7_numbered_snapshots": numbered_snapshots,
    "q6_asked_dates": asked_dates,
    "p7_reject_counts": reject_counts,
    "p13_landed_violations": landed_violations,
    "p15_batch_date_check": batch_date_check,
    "k7_align_schema": align_schema,
    "k9_snapshot_rows": snapshot_rows,
    "k10_serving_rows": serving_rows,
    "k11_contract_violations": contract_violations,
    "k13_batch_audit": batch_audit,
    "k14_export_counts": export_counts,
    "d_quality_report": quality_report,
    "d9_quality_summary": quality_summary,
    "q1_latest_date": latest_date,
    "q2_kpi": _section("kpi"),
    "q3_trend": _section("trend"),
    "q4_product_rank": _section("product_rank"),
    "q4_category_share": _section("category_share"),
    "q4_user_profile": _section("user_profile"),
    "q4_funnel": _section("funnel"),
    "q5_overview_sections": overview_sections,
    "q5_overview_latest": overview_latest,
    "q7_kpi_cards": kpi_cards,
    "q7_profile_labels": profile_labels,
    "a11_share_with_other": share_slices,
}
