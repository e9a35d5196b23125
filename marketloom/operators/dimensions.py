"""Dimension layer. Every builder keeps ``dt``, so one call covers one batch or all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.numbers import money
from marketloom.functions.text import blank_to_unknown, slug

SUNDAY, SATURDAY = 1, 7


def date_dimension(dates: DataFrame) -> DataFrame:
    """Calendar attributes of each batch date in column ``dt``."""
    day = F.to_date("dt", "yyyy-MM-dd")
    return dates.select(
        F.col("dt").alias("date_id"),
        day.alias("date_value"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofweek(day).alias("day_of_week"),
        F.dayofweek(day).isin(SUNDAY, SATURDAY).alias("is_weekend"),
        "dt",
    )


def product_dimension(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        "product_name",
        blank_to_unknown(F.col("category")).alias("category"),
        "brand",
        money(F.col("price")).alias("price"),
        "stock",
        "availability_status",
        "dt",
    )


def category_dimension(products: DataFrame) -> DataFrame:
    named = products.select("dt", "product_id", blank_to_unknown(F.col("category")).alias("category_name"))
    counted = named.groupBy("dt", "category_name").agg(F.countDistinct("product_id").alias("product_count"))
    return counted.select(slug(F.col("category_name")).alias("category_id"), "category_name", "product_count", "dt")


def user_dimension(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id", "username", "gender", "age", "age_group", "city", "state", "country", "role", "dt"
    )
