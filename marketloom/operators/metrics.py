"""Metric layer: the six dashboard tables, shaped from the summary layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.numbers import guarded_ratio, money
from marketloom.functions.text import blank_to_unknown

TOP_PRODUCTS = 10


def kpi_daily(sales: DataFrame, funnel: DataFrame) -> DataFrame:
    rates = funnel.select("dt", "date_id", "payment_rate")
    return sales.join(rates, ["dt", "date_id"], "left").select(
        "date_id",
        "total_sales_amount",
        F.col("order_count").alias("total_order_count"),
        F.col("pay_user_count").alias("paid_user_count"),
        "avg_order_amount",
        F.col("payment_rate").alias("payment_conversion_rate"),
        "dt",
    )


def kpi_of_sales(sales: DataFrame) -> DataFrame:
    """The KPI rows of days whose funnel is that of their sales: every cart is an order and a payment."""
    orders = F.col("order_count")
    return sales.select(
        "date_id",
        "total_sales_amount",
        orders.alias("total_order_count"),
        F.col("pay_user_count").alias("paid_user_count"),
        "avg_order_amount",
        guarded_ratio(orders, orders).alias("payment_conversion_rate"),
        "dt",
    )


def sales_trend_daily(sales: DataFrame) -> DataFrame:
    return sales.select(
        "date_id",
        F.col("total_sales_amount").alias("sales_amount"),
        "order_count",
        F.col("pay_user_count").alias("paid_user_count"),
        "dt",
    )


def product_rank_daily(product_days: DataFrame) -> DataFrame:
    """Best-selling products of each day.

    The rank filter becomes a group limit before the shuffle, so each task sends at most ten rows
    per day. Columns after quantity only make ties repeatable.
    """
    best_first = Window.partitionBy("dt").orderBy(
        F.desc("sales_amount"), F.desc("sales_quantity"), "product_id", "product_name", "category", "brand"
    )
    ranked = product_days.withColumn("rank_no", F.row_number().over(best_first))
    return ranked.where(F.col("rank_no") <= TOP_PRODUCTS).select(
        "date_id", "rank_no", "product_id", "product_name", "category", "sales_quantity", "sales_amount", "dt"
    )


def category_share_daily(category_days: DataFrame) -> DataFrame:
    """Share of each category in its day.

    Totals are aggregated and joined back instead of taken over a window, which would sort a whole
    day in one task. ``category_days`` is read twice, so pass a stored table.
    """
    totals = category_days.groupBy("dt").agg(F.sum("sales_amount").alias("day_amount"))
    share = F.when(F.coalesce("day_amount", F.lit(0)) == 0, F.lit(0)).otherwise(
        F.col("sales_amount") / F.col("day_amount")
    )
    return category_days.join(totals, "dt").select(
        "date_id", "category", "sales_amount", "sales_quantity", share.cast("decimal(10,4)").alias("sales_share"), "dt"
    )


def user_profile_daily(profile_days: DataFrame) -> DataFrame:
    """Roll-ups by age group, gender and country: one scan unpivoted, then one aggregation."""
    normalised = profile_days.select(
        "date_id",
        *[blank_to_unknown(F.col(name)).alias(name) for name in ("age_group", "gender", "country")],
        "user_count",
        "buyer_count",
        "sales_amount",
        "dt",
    )
    return (
        normalised.unpivot(
            ["dt", "date_id", "user_count", "buyer_count", "sales_amount"],
            ["age_group", "gender", "country"],
            "dimension_type",
            "dimension_value",
        )
        .groupBy("dt", "date_id", "dimension_type", "dimension_value")
        .agg(
            F.sum("user_count").alias("user_count"),
            F.sum("buyer_count").alias("buyer_count"),
            money(F.sum("sales_amount")).alias("sales_amount"),
        )
        .select("date_id", "dimension_type", "dimension_value", "user_count", "buyer_count", "sales_amount", "dt")
    )


def funnel_daily(funnel: DataFrame) -> DataFrame:
    """One row per stage: its order, its count and its rate over the stage before."""
    stages = F.array(
        *[
            F.struct(
                F.lit(name).alias("stage_name"),
                F.lit(order).alias("stage_order"),
                F.col(count).alias("stage_count"),
                guarded_ratio(F.col(count), F.col(previous)).alias("conversion_rate"),
            )
            for order, (name, count, previous) in enumerate(
                (
                    ("cart", "cart_count", "view_count"),
                    ("order", "order_count", "cart_count"),
                    ("payment", "payment_count", "order_count"),
                ),
                start=1,
            )
        ]
    )
    return funnel.select("date_id", "dt", F.inline(stages)).select(
        "date_id", "stage_name", "stage_order", "stage_count", "conversion_rate", "dt"
    )
