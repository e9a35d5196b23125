"""Queries over the six serving tables.

``*_list`` functions answer for one date, or for the latest with data; a date without rows raises
``DataNotFound``. ``overview_sections`` gives all sections of all complete dates as rows, and
``overview`` the answer for one date as ordered rows.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.errors import DataNotFound
from marketloom.functions import display
from marketloom.functions.numbers import zero_if_null
from marketloom.functions.text import labelled_value
from marketloom.schemas import METRICS, columns_of
from marketloom.session import broadcast_if_small

DATE_FORMAT = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")
SHARE_SLICES = 6

# Fixed values of the dashboard: the name of the rest bucket and the card labels and hints.
OTHER_CATEGORY = "其他"
CARD_SALES, CARD_ORDERS, CARD_USERS, CARD_RATE = "销售额", "订单数", "支付用户", "支付转化率"
HINT_AVERAGE, HINT_USERS, HINT_RATE, HINT_DATE = "客单价 ", "支付用户 ", "转化率 ", "数据日期 "

# Section name of the overview, its table, and the order of its items: (column, descending).
SECTIONS = {
    "kpi": ("ads_kpi_daily", ()),
    "trend": ("ads_sales_trend_daily", ()),
    "product_rank": ("ads_product_rank_daily", (("rank_no", False),)),
    "category_share": (
        "ads_category_share_daily",
        (("sales_share", True), ("sales_amount", True), ("category", False)),
    ),
    "user_profile": (
        "ads_user_profile_daily",
        (("dimension_type", False), ("user_count", True), ("dimension_value", False)),
    ),
    "funnel": ("ads_funnel_daily", (("stage_order", False),)),
}


def _ordering(keys: tuple[tuple[str, bool], ...]) -> list[Column]:
    return [F.desc_nulls_last(name) if descending else F.asc_nulls_first(name) for name, descending in keys]


def _item_columns(section: str) -> list[str]:
    """Columns of a list item: all but the date, which the response names once."""
    return [name for name in columns_of(SECTIONS[section][0]).names if name != "date_id"]


def latest_date(tables: dict[str, DataFrame]) -> DataFrame:
    """One row: the latest date over all tables, NULL when all are empty."""
    maxima = [df.agg(F.max("date_id").alias("date_id")) for df in tables.values()]
    return reduce(DataFrame.unionByName, maxima).agg(F.max("date_id").alias("date_id"))


def resolve_date(tables: dict[str, DataFrame], date_id: str | None = None) -> str:
    if date_id:
        if not DATE_FORMAT.fullmatch(date_id):
            raise ValueError("a date must look like YYYY-MM-DD")
        return date_id
    latest = latest_date(tables).first().date_id
    if latest is None:
        raise DataNotFound("no data is available")
    return latest


def section_rows(tables: dict[str, DataFrame], section: str) -> DataFrame:
    """Rows of a section for all dates, in the order the serving queries use."""
    table, keys = SECTIONS[section]
    return tables[table].select(*columns_of(table).names).orderBy("date_id", *_ordering(keys))


def _section_of(tables: dict[str, DataFrame], section: str, date_id: str) -> DataFrame:
    table, keys = SECTIONS[section]
    rows = tables[table].where(F.col("date_id") == date_id)
    if rows.isEmpty():
        raise DataNotFound(f"no {section} data for {date_id}")
    return rows.orderBy(*_ordering(keys)) if keys else rows


def kpi(tables: dict[str, DataFrame], date_id: str | None = None) -> DataFrame:
    date_id = resolve_date(tables, date_id)
    return _section_of(tables, "kpi", date_id).select(*columns_of("ads_kpi_daily").names)


def item_list(tables: dict[str, DataFrame], section: str, date_id: str | None = None) -> DataFrame:
    """Items of one list section, without their date."""
    date_id = resolve_date(tables, date_id)
    return _section_of(tables, section, date_id).select(*_item_columns(section))


def complete_dates(tables: dict[str, DataFrame]) -> DataFrame:
    """Dates on which every section has rows."""
    seen = [tables[table].select("date_id", F.lit(name).alias("section")) for name, (table, _) in SECTIONS.items()]
    sections = reduce(DataFrame.unionByName, seen).groupBy("date_id").agg(F.countDistinct("section").alias("sections"))
    return sections.where(F.col("sections") == len(SECTIONS)).select("date_id")


def overview_sections(tables: dict[str, DataFrame]) -> DataFrame:
    """All sections of all complete dates as (date_id, section, item JSON); one row per item."""
    complete = complete_dates(tables)
    rows = []
    for section, (table, _) in SECTIONS.items():
        item = F.to_json(F.struct(*_item_columns(section)), {"ignoreNullFields": "false"})
        rows.append(tables[table].select("date_id", F.lit(section).alias("section"), item.alias("item")))
    return reduce(DataFrame.unionByName, rows).join(complete, "date_id", "left_semi")


def overview(tables: dict[str, DataFrame], date_id: str | None = None) -> DataFrame:
    """The answer for one date as rows: (date_id, section, item_no, item JSON), items numbered in their order.

    Decimals are JSON numbers. For a given date a section without rows raises; without one, the latest date
    of all tables is found in the same query, and ``complete_dates`` tells where no section is missing.
    """
    if date_id is not None:
        resolve_date(tables, date_id)
    parts, latest = [], None if date_id else latest_date(tables).scalar()
    for section, (table, keys) in SECTIONS.items():
        if date_id is None:
            rows = tables[table].where(F.col("date_id") == latest)
        else:
            rows = _section_of(tables, section, date_id)
        position = Window.partitionBy("date_id").orderBy(*(_ordering(keys) or [F.col("date_id")]))
        item = F.to_json(F.struct(*_item_columns(section)), {"ignoreNullFields": "false"})
        parts.append(rows.select("date_id", F.lit(section).alias("section"), F.row_number().over(position).alias("item_no"), item.alias("item")))
    return reduce(DataFrame.unionByName, parts)


FOUND, NOT_FOUND, BAD_DATE = "found", "not_found", "bad_date"


def answer_states(tables: dict[str, DataFrame], asked: DataFrame) -> DataFrame:
    """(date_id, section, status, items) of every section of every date of ``asked`` (``date_id``), each date once.

    What a query of that date would be told: the number of items found, that there is no data, or that the text is no
    date; the whole ``overview`` is found when every section is. Tables are filtered by the asked dates before they are
    counted, which prunes folders and files at run time. NULL asks for the latest date with data.
    """
    latest = latest_date(tables).scalar()
    wanted = asked.select(F.coalesce("date_id", latest).alias("date_id")).where("date_id IS NOT NULL").distinct()
    names = F.array(*[F.lit(name) for name in SECTIONS])
    pairs = wanted.select("date_id", F.explode(names).alias("section"))
    small = broadcast_if_small(wanted)
    counts = [
        tables[table].select("date_id").join(small, "date_id", "left_semi").groupBy("date_id").agg(F.count(F.lit(1)).alias("items"))
        .select("date_id", F.lit(name).alias("section"), "items")
        for name, (table, _) in SECTIONS.items()
    ]
    found = pairs.join(reduce(DataFrame.unionByName, counts), ["date_id", "section"], "left")
    well_formed = F.col("date_id").rlike(f"^{DATE_FORMAT.pattern}$")
    status = F.when(~well_formed, F.lit(BAD_DATE)).when(F.col("items") > 0, F.lit(FOUND)).otherwise(F.lit(NOT_FOUND))
    rows = found.select("date_id", "section", status.alias("status"), F.coalesce("items", F.lit(0)).alias("items"))
    whole = rows.groupBy("date_id").agg(
        F.min("status").alias("least"), F.max("status").alias("most"), F.sum("items").alias("items")
    )
    all_found = F.when(F.col("most") == F.col("least"), F.col("most")).otherwise(F.lit(NOT_FOUND))
    return rows.unionByName(whole.select("date_id", F.lit("overview").alias("section"), all_found.alias("status"), "items"))


def share_slices(shares: DataFrame, limit: int = SHARE_SLICES) -> DataFrame:
    """The largest categories of each date and one bucket for the rest, if there is a rest.

    The bucket is the day's total less the listed slices, so no day is sorted as a whole: the list
    is a group-limited rank and the totals combine map-side. ``shares`` is read more than once, so
    pass a stored table.
    """
    order = Window.partitionBy("date_id").orderBy(*_ordering(SECTIONS["category_share"][1]))
    measures = ["sales_amount", "sales_quantity", "sales_share"]
    listed = (
        shares.select("date_id", "category", *measures, F.row_number().over(order).alias("slice_no"))
        .where(F.col("slice_no") <= limit)
    )
    whole = shares.groupBy("date_id").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(zero_if_null(F.col(m))).alias(m) for m in measures]
    )
    head = listed.groupBy("date_id").agg(*[F.sum(zero_if_null(F.col(m))).alias(f"head_{m}") for m in measures])
    types = {f.name: f.dataType for f in columns_of("ads_category_share_daily")}
    rest = whole.where(F.col("n") > limit).join(head, "date_id").select(
        "date_id",
        F.lit(OTHER_CATEGORY).alias("category"),
        *[(F.col(m) - F.col(f"head_{m}")).cast(types[m]).alias(m) for m in measures],
        F.lit(limit + 1).alias("slice_no"),
    )
    return listed.unionByName(rest)


def kpi_cards(kpis: DataFrame) -> DataFrame:
    """Four label / value / hint rows per date."""
    sales, average = F.col("total_sales_amount"), F.col("avg_order_amount")
    orders, payers, rate = F.col("total_order_count"), F.col("paid_user_count"), F.col("payment_conversion_rate")
    cards = (
        (CARD_SALES, display.money_text(sales), HINT_AVERAGE, display.money_text(average)),
        (CARD_ORDERS, display.count_text(orders), HINT_USERS, display.count_text(payers)),
        (CARD_USERS, display.count_text(payers), HINT_RATE, display.percent_text(rate)),
        (CARD_RATE, display.percent_text(rate), HINT_DATE, F.col("date_id")),
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(number).alias("card_no"),
                F.lit(label).alias("label"),
                value.alias("value"),
                F.concat(F.lit(hint), detail).alias("hint"),
            )
            for number, (label, value, hint, detail) in enumerate(cards, start=1)
        ]
    )
    return kpis.select("date_id", F.inline(rows))


def profile_labels(profiles: DataFrame) -> DataFrame:
    """Axis label and both counts of each profile row."""
    label = labelled_value(F.col("dimension_type"), F.col("dimension_value"))
    return profiles.select("date_id", label.alias("label"), "user_count", "buyer_count")
