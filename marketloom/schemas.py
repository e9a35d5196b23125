"""Fixed schemas of every layer, as DDL strings; partition column ``dt`` is always a string."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

BATCH = "dt STRING"


@dataclass(frozen=True)
class Feed:
    """A landed source and the detail table built from it."""

    source: str
    entity: str
    detail_table: str


# Source name, entity name, detail table.
FEEDS = {
    "products": Feed("products", "product", "dwd_product_info"),
    "users": Feed("users", "user", "dwd_user_info"),
    "carts": Feed("carts", "order", "dwd_order_cart_detail"),
}

ENVELOPE = "entity STRING, source STRING, batch_date STRING, data STRING"

DETAIL = {
    "dwd_product_info": (
        "product_id BIGINT, product_name STRING, category STRING, brand STRING, price DECIMAL(18,2), "
        "discount_percentage DECIMAL(10,2), rating DECIMAL(10,2), stock INT, availability_status STRING, "
        "thumbnail STRING, source STRING, batch_date STRING"
    ),
    "dwd_user_info": (
        "user_id BIGINT, username STRING, full_name STRING, gender STRING, age INT, age_group STRING, "
        "email STRING, phone STRING, city STRING, state STRING, country STRING, latitude DECIMAL(18,6), "
        "longitude DECIMAL(18,6), role STRING, source STRING, batch_date STRING"
    ),
    "dwd_order_cart_detail": (
        "cart_id BIGINT, user_id BIGINT, product_id BIGINT, product_name STRING, unit_price DECIMAL(18,2), "
        "quantity INT, line_total DECIMAL(18,2), discount_percentage DECIMAL(10,2), "
        "line_discounted_total DECIMAL(18,2), category_hint STRING, cart_total DECIMAL(18,2), "
        "cart_discounted_total DECIMAL(18,2), total_products INT, total_quantity INT, source STRING, "
        "batch_date STRING"
    ),
}

DIMENSIONS = {
    "dim_date": (
        "date_id STRING, date_value DATE, year INT, quarter INT, month INT, day INT, week_of_year INT, "
        "day_of_week INT, is_weekend BOOLEAN"
    ),
    "dim_product": (
        "product_id BIGINT, product_name STRING, category STRING, brand STRING, price DECIMAL(18,2), "
        "stock INT, availability_status STRING"
    ),
    "dim_category": "category_id STRING, category_name STRING, product_count BIGINT",
    "dim_user": (
        "user_id BIGINT, username STRING, gender STRING, age INT, age_group STRING, city STRING, "
        "state STRING, country STRING, role STRING"
    ),
}

SUMMARIES = {
    "dws_sales_daily": (
        "date_id STRING, order_count BIGINT, pay_user_count BIGINT, total_sales_amount DECIMAL(18,2), "
        "discount_sales_amount DECIMAL(18,2), avg_order_amount DECIMAL(18,2), total_quantity BIGINT"
    ),
    "dws_product_daily": (
        "date_id STRING, product_id BIGINT, product_name STRING, category STRING, brand STRING, "
        "sales_quantity BIGINT, sales_amount DECIMAL(18,2), order_count BIGINT"
    ),
    "dws_category_daily": (
        "date_id STRING, category STRING, product_count BIGINT, sales_quantity BIGINT, "
        "sales_amount DECIMAL(18,2), order_count BIGINT"
    ),
    "dws_user_profile_daily": (
        "date_id STRING, age_group STRING, gender STRING, country STRING, user_count BIGINT, "
        "buyer_count BIGINT, order_count BIGINT, sales_amount DECIMAL(18,2)"
    ),
    "dws_funnel_daily": (
        "date_id STRING, view_count BIGINT, cart_count BIGINT, order_count BIGINT, payment_count BIGINT, "
        "cart_rate DECIMAL(10,4), order_rate DECIMAL(10,4), payment_rate DECIMAL(10,4)"
    ),
}

METRICS = {
    "ads_kpi_daily": (
        "date_id STRING, total_sales_amount DECIMAL(18,2), total_order_count BIGINT, paid_user_count BIGINT, "
        "avg_order_amount DECIMAL(18,2), payment_conversion_rate DECIMAL(10,4)"
    ),
    "ads_sales_trend_daily": "date_id STRING, sales_amount DECIMAL(18,2), order_count BIGINT, paid_user_count BIGINT",
    "ads_product_rank_daily": (
        "date_id STRING, rank_no INT, product_id BIGINT, product_name STRING, category STRING, "
        "sales_quantity BIGINT, sales_amount DECIMAL(18,2)"
    ),
    "ads_category_share_daily": (
        "date_id STRING, category STRING, sales_amount DECIMAL(18,2), sales_quantity BIGINT, sales_share DECIMAL(10,4)"
    ),
    "ads_user_profile_daily": (
        "date_id STRING, dimension_type STRING, dimension_value STRING, user_count BIGINT, buyer_count BIGINT, "
        "sales_amount DECIMAL(18,2)"
    ),
    "ads_funnel_daily": (
        "date_id STRING, stage_name STRING, stage_order INT, stage_count BIGINT, conversion_rate DECIMAL(10,4)"
    ),
}


@dataclass(frozen=True)
class ServingTable:
    """Constraints of a serving table: key columns, other NOT NULL columns, text length limits."""

    key: tuple[str, ...]
    required: tuple[str, ...]
    lengths: dict[str, int] = field(default_factory=dict)


# The serving contract.
SERVING = {
    "ads_kpi_daily": ServingTable(
        ("date_id",),
        ("total_sales_amount", "total_order_count", "paid_user_count", "avg_order_amount", "payment_conversion_rate"),
        {"date_id": 10},
    ),
    "ads_sales_trend_daily": ServingTable(
        ("date_id",), ("sales_amount", "order_count", "paid_user_count"), {"date_id": 10}
    ),
    "ads_product_rank_daily": ServingTable(
        ("date_id", "rank_no"),
        ("product_id", "product_name", "sales_quantity", "sales_amount"),
        {"date_id": 10, "product_name": 255, "category": 128},
    ),
    "ads_category_share_daily": ServingTable(
        ("date_id", "category"),
        ("sales_amount", "sales_quantity", "sales_share"),
        {"date_id": 10, "category": 128},
    ),
    "ads_user_profile_daily": ServingTable(
        ("date_id", "dimension_type", "dimension_value"),
        ("user_count", "buyer_count", "sales_amount"),
        {"date_id": 10, "dimension_type": 32, "dimension_value": 128},
    ),
    "ads_funnel_daily": ServingTable(
        ("date_id", "stage_order"),
        ("stage_name", "stage_count", "conversion_rate"),
        {"date_id": 10, "stage_name": 64},
    ),
}

LAYER_OF = {
    **{name: "dwd" for name in DETAIL},
    **{name: "dim" for name in DIMENSIONS},
    **{name: "dws" for name in SUMMARIES},
    **{name: "ads" for name in METRICS},
}
COLUMNS = {**DETAIL, **DIMENSIONS, **SUMMARIES, **METRICS}


SCALARS: dict[str, DataType] = {
    "STRING": StringType(),
    "BIGINT": LongType(),
    "INT": IntegerType(),
    "DATE": DateType(),
    "BOOLEAN": BooleanType(),
    "TIMESTAMP": TimestampType(),
}
COLUMN = re.compile(r"(\w+) ([A-Z]+)(?:\((\d+),(\d+)\))?")


def schema_of(ddl: str) -> StructType:
    """The struct type of a flat DDL string, readable without a session."""
    return StructType(
        [
            StructField(name, DecimalType(int(precision), int(scale)) if precision else SCALARS[kind])
            for name, kind, precision, scale in COLUMN.findall(ddl)
        ]
    )


def columns_of(table: str) -> StructType:
    """The columns of a layer table without its partition column."""
    return schema_of(COLUMNS[table])


def table_schema(table: str) -> StructType:
    return schema_of(f"{COLUMNS[table]}, {BATCH}")


def envelope_schema() -> StructType:
    return schema_of(f"{ENVELOPE}, {BATCH}")
