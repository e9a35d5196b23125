"""Detail layer: landed JSON envelopes to typed rows, with the reason of every reject.

``check_*`` reads each envelope once: typed columns, and ``reject_reason`` (NULL when accepted).
``*_rows`` keep the accepted ones. They do so by exploding an array that is NULL for rejects: a plain
filter would be pushed below the typed columns and parse the JSON again for every predicate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import json_values as J
from marketloom.functions import text
from marketloom.schemas import FEEDS, columns_of

ENVELOPE_COLUMNS = ("source", "batch_date", "dt")
# Names the record of an envelope where a feed lays large records over several envelopes (``parts``).
RECORD = "record"
# The reasons that parts of one cart can differ in, the first check first.
LINE_REASONS = ("invalid_line", "wrong_type")


PRODUCT_FIELDS = (
    "id BIGINT, title VARIANT, price DOUBLE, stock INT, category STRING, brand STRING, "
    "discountPercentage STRING, rating STRING, availabilityStatus STRING, thumbnail STRING"
)
USER_FIELDS = (
    "id BIGINT, username VARIANT, firstName VARIANT, lastName VARIANT, gender STRING, age VARIANT, "
    "email STRING, phone STRING, role STRING, address VARIANT"
)
ADDRESS_FIELDS = "city STRING, state STRING, country STRING, coordinates STRUCT<lat STRING, lng STRING>"
CART_FIELDS = (
    "id BIGINT, userId BIGINT, total DOUBLE, discountedTotal DOUBLE, totalProducts INT, totalQuantity INT, "
    "products ARRAY<STRUCT<id BIGINT, title STRING, price DOUBLE, quantity INT, total DOUBLE, "
    "discountPercentage DOUBLE, discountedTotal DOUBLE, thumbnail VARIANT>>"
)


def _envelope_columns(envelopes: DataFrame) -> list[str]:
    return [*ENVELOPE_COLUMNS, *[name for name in (RECORD,) if name in envelopes.columns]]


def _read(envelopes: DataFrame, fields: str) -> DataFrame:
    """Envelope columns plus the payload ``p`` and ``well_typed``."""
    read, own = F.col("read"), _envelope_columns(envelopes)
    return envelopes.select(*own, "data", J.read_object(F.col("data"), fields).alias("read")).select(
        *own, J.payload_of(read, F.col("data")).alias("p"), J.is_well_typed(read).alias("well_typed")
    )


def _reason(source: str, *checks: tuple[str, Column]) -> Column:
    """Name of the first check that fails; NULL when all hold."""
    all_checks = (
        ("source_mismatch", J.holds(F.col("source") == source)),
        ("batch_date_mismatch", J.holds(F.col("batch_date") == F.col("dt"))),
        ("payload_not_object", F.col("p").isNotNull()),
        *checks,
        ("wrong_type", F.col("well_typed")),
    )
    return F.coalesce(*[F.when(~check, F.lit(name)) for name, check in all_checks]).alias("reject_reason")


def check_products(envelopes: DataFrame) -> DataFrame:
    p = F.col("p")
    title = J.text_value(p["title"]).alias("product_name")
    read = _read(envelopes, PRODUCT_FIELDS).select("*", title)
    return read.select(
        p["id"].alias("product_id"),
        "product_name",
        p["category"].alias("category"),
        p["brand"].alias("brand"),
        J.to_decimal(p["price"], 18, 2).alias("price"),
        J.to_decimal(p["discountPercentage"], 10, 2).alias("discount_percentage"),
        J.to_decimal(p["rating"], 10, 2).alias("rating"),
        p["stock"].alias("stock"),
        p["availabilityStatus"].alias("availability_status"),
        p["thumbnail"].alias("thumbnail"),
        *ENVELOPE_COLUMNS,
        _reason(
            "products",
            ("invalid_id", J.holds(p["id"] > 0)),
            ("invalid_title", J.is_visible(F.col("product_name"))),
            ("invalid_price", J.is_amount(p["price"])),
            ("invalid_stock", J.is_optional_count(p["stock"])),
        ),
    )


def check_users(envelopes: DataFrame) -> DataFrame:
    p = F.col("p")
    read = _read(envelopes, USER_FIELDS).select(
        "*",
        J.text_value(p["username"]).alias("username"),
        J.text_value(p["firstName"]).alias("first_name"),
        J.text_value(p["lastName"]).alias("last_name"),
        J.whole_number(p["age"]).alias("whole_age"),
        J.nested_object(p["address"], ADDRESS_FIELDS).alias("address"),
    )
    address = F.col("address")
    return read.select(
        p["id"].alias("user_id"),
        "username",
        text.full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        p["gender"].alias("gender"),
        F.try_variant_get(p["age"], "$", "int").alias("age"),
        text.age_group(F.col("whole_age")).alias("age_group"),
        p["email"].alias("email"),
        p["phone"].alias("phone"),
        address["city"].alias("city"),
        address["state"].alias("state"),
        address["country"].alias("country"),
        J.to_decimal(address["coordinates"]["lat"], 18, 6).alias("latitude"),
        J.to_decimal(address["coordinates"]["lng"], 18, 6).alias("longitude"),
        p["role"].alias("role"),
        *ENVELOPE_COLUMNS,
        _reason(
            "users",
            ("invalid_id", J.holds(p["id"] > 0)),
            ("invalid_username", J.is_visible(F.col("username"))),
        ),
    )


def _is_valid_line(line: Column) -> Column:
    return (
        J.holds(line["id"] > 0)
        & J.holds(line["quantity"] > 0)
        & J.is_amount(line["price"])
        & J.is_optional_amount(line["total"])
        & J.is_optional_amount(line["discountPercentage"], 10, 2)
        & J.is_optional_amount(line["discountedTotal"])
    )


def check_carts(envelopes: DataFrame) -> DataFrame:
    """One row per envelope with its ``lines``; one bad line rejects all of them, counted once.

    Carts in several envelopes are settled by ``settled`` (counts) and ``detail_rows`` (lines).
    """
    p = F.col("p")
    return _read(envelopes, CART_FIELDS).select(
        p["id"].alias("cart_id"),
        p["userId"].alias("user_id"),
        J.to_decimal(p["total"], 18, 2).alias("cart_total"),
        J.to_decimal(p["discountedTotal"], 18, 2).alias("cart_discounted_total"),
        p["totalProducts"].alias("total_products"),
        p["totalQuantity"].alias("total_quantity"),
        p["products"].alias("lines"),
        *_envelope_columns(envelopes),
        _reason(
            "carts",
            ("invalid_id", J.holds(p["id"] > 0)),
            ("invalid_user_id", J.holds(p["userId"] > 0)),
            ("products_not_a_list", p["products"].isNotNull()),
            ("invalid_total", J.is_optional_amount(p["total"])),
            ("invalid_discounted_total", J.is_optional_amount(p["discountedTotal"])),
            ("invalid_total_products", J.is_optional_count(p["totalProducts"])),
            ("invalid_total_quantity", J.is_optional_count(p["totalQuantity"])),
            ("no_lines", F.size(p["products"]) > 0),
            ("invalid_line", F.forall(p["products"], _is_valid_line)),
        ),
    )


def _unless_rejected(rows: Column) -> Column:
    return F.explode(F.when(F.col("reject_reason").isNull(), rows))


def _if_rejected(rows: Column) -> Column:
    return F.explode(F.when(F.col("reject_reason").isNotNull(), rows))


def _flat_rows(checked: DataFrame) -> DataFrame:
    kept = [name for name in checked.columns if name != "reject_reason"]
    return checked.select(_unless_rejected(F.array(F.struct(*kept))).alias("row")).select("row.*")


def _line_columns(exploded: DataFrame) -> DataFrame:
    line = F.col("line")
    return exploded.withColumns(
        {
            "product_id": line["id"],
            "product_name": line["title"],
            "unit_price": J.to_decimal(line["price"], 18, 2),
            "quantity": line["quantity"],
            "line_total": J.to_decimal(line["total"], 18, 2),
            "discount_percentage": J.to_decimal(line["discountPercentage"], 10, 2),
            "line_discounted_total": J.to_decimal(line["discountedTotal"], 18, 2),
            "thumbnail": J.text_value(line["thumbnail"]),
        }
    ).withColumn("category_hint", text.category_hint(F.col("thumbnail")))


def _cart_lines(checked: DataFrame) -> DataFrame:
    """One row per line of an accepted cart, header columns repeated."""
    header = [name for name in checked.columns if name not in ("lines", "reject_reason")]
    return _line_columns(checked.select(*header, _unless_rejected(F.col("lines")).alias("line")))


def rejects(checked: DataFrame) -> DataFrame:
    """Rejected envelopes with their reason, for a quarantine table."""
    row = F.struct(*ENVELOPE_COLUMNS, "reject_reason")
    return checked.select(_if_rejected(F.array(row)).alias("row")).select("row.*")


CHECKS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "products": check_products,
    "users": check_users,
    "carts": check_carts,
}
ROWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "products": _flat_rows,
    "users": _flat_rows,
    "carts": _cart_lines,
}


def accepted_rows(source: str, checked: DataFrame) -> DataFrame:
    """Accepted rows of one source in the column order of its detail table."""
    return ROWS[source](checked).select(*columns_of(FEEDS[source].detail_table).names, "dt")


def settled(counted: DataFrame) -> DataFrame:
    """One row per record of (feed, dt, record, reject_reason, rows), one per part: a rejected part rejects the record."""
    reason = F.col("reject_reason")
    order = F.when(reason.isNotNull(), F.array_position(F.array(*map(F.lit, LINE_REASONS)), reason))
    whole = counted.groupBy("feed", "dt", RECORD).agg(
        F.min_by("reject_reason", order).alias("reject_reason"), F.sum("rows").alias("rows")
    )
    return whole.withColumn("rows", F.when(F.col("reject_reason").isNull(), F.col("rows")).otherwise(F.lit(0)))


def _of_whole_records(source: str, envelopes: DataFrame) -> DataFrame:
    """Without the envelopes of records that have a rejected part; only records of several parts are read for it."""
    checked = CHECKS[source](envelopes.where(F.col("parts") > 1))
    rejected = checked.select(_if_rejected(F.array(RECORD)).alias(RECORD)).distinct()
    return envelopes.join(rejected, RECORD, "left_anti")


ROW, RECORD_SEEN = "row", "record"


def audited_rows(source: str, envelopes: DataFrame) -> DataFrame:
    """Detail rows (``kind`` row) and one row per envelope with its reason (``kind`` record), from one parse.

    Both are written by one job; the second kind has nothing but dt and ``reject_reason``, and counts what was read,
    whatever the number of batches. Every envelope is a record here.
    """
    checked = CHECKS[source](envelopes)
    columns = columns_of(FEEDS[source].detail_table).names
    if source == "carts":
        lines = F.when(F.col("reject_reason").isNull(), F.col("lines"))
        entries = F.concat(F.array(F.lit(None).cast(checked.schema["lines"].dataType.elementType)), F.coalesce(lines, F.array().cast(checked.schema["lines"].dataType)))
        rows = _line_columns(checked.select("*", F.posexplode(entries).alias("at", "line")))
    else:
        kept = F.when(F.col("reject_reason").isNull(), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        rows = checked.select("*", F.explode(kept).alias("at"))
    is_row = F.col("at") > 0
    values = [F.when(is_row, F.col(name)).alias(name) for name in columns]
    reason = F.when(~is_row, F.col("reject_reason")).alias("reject_reason")
    return rows.select(*values, reason, "dt", F.when(is_row, F.lit(ROW)).otherwise(F.lit(RECORD_SEEN)).alias("kind"))


def detail_rows(source: str, envelopes: DataFrame) -> DataFrame:
    if RECORD in envelopes.columns:
        envelopes = _of_whole_records(source, envelopes)
    return accepted_rows(source, CHECKS[source](envelopes))
