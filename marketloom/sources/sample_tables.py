"""Sample input: maps order, line, part and customer tables to the retail model.

``*_detail`` functions give clean detail-layer frames. ``*_envelopes`` give landed JSON envelopes of
the same records, with invalid ones mixed in by key so that every reject rule is met. Carts come in
daily batches (``"day"``) or yearly ones (``"year"``); a yearly batch also carries the full product
and user feeds, as a feed is re-published with every batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import text
from marketloom.schemas import columns_of

WRONG_DATE = "1900-01-01"
LINES_PER_ENVELOPE = 1000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _every(key: Column, step: int, rest: int = 0) -> Column:
    return key % step == rest


def _cents(value: Column) -> Column:
    """Nearest whole cent of an amount that is not negative."""
    return (value * 100.0 + 0.5).cast("bigint")


def _amount(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")


def _whole(numerator: Column, denominator: Column) -> Column:
    return (numerator / denominator).cast("bigint")


def _per_cent_off(cents: Column, per_cent: Column) -> Column:
    return _whole(cents * (F.lit(100) - per_cent), F.lit(100))


def _batch(order_date: Column, batches: str) -> Column:
    """The batch of an order: its day, or the first day of its ``month`` or ``year``."""
    return F.date_format(order_date if batches == "day" else F.trunc(order_date, batches), "yyyy-MM-dd")


def _republished(df: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """One copy per yearly batch: the years of the orders, found by a subquery, as many as the calendar has.

    The rows are dealt evenly over the tasks before: a table of few bytes is read by one task, and every row makes much work.
    """
    years = batch_dates(spark, folder, "year").agg(F.collect_set("dt")).scalar()
    return df.hint("rebalance").withColumn("dt", F.explode(years))


def batch_dates(spark: SparkSession, folder: str, batches: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.select(_batch(F.col("o_orderdate"), batches).alias("dt")).distinct()


# ---- carts -------------------------------------------------------------------------------------


def _headers(spark: SparkSession, folder: str, batches: str) -> DataFrame:
    key = F.col("o_orderkey")
    total = _cents(F.col("o_totalprice"))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        (key + 1).alias("cart_id"),
        (F.col("o_custkey") + 1).alias("user_id"),
        _batch(F.col("o_orderdate"), batches).alias("dt"),
        F.when(~_every(key, 53), _amount(total)).alias("cart_total"),
        F.when(~_every(key, 59), _amount(_per_cent_off(total, key % 30))).alias("cart_discounted_total"),
        (key % 5 + 1).cast("int").alias("total_products"),
        F.when(~_every(key, 61), (key % 9 + 1).cast("int")).alias("total_quantity"),
    )


def _line_columns() -> list[Column]:
    """The columns of a cart line; flags in lower case on line 6 make categories that differ only in case."""
    part, number = F.col("l_partkey"), F.col("l_linenumber")
    price = _cents(F.col("l_extendedprice"))
    off = _cents(F.col("l_discount")).cast("int")
    flags = F.concat_ws("-", "l_returnflag", "l_linestatus")
    hint = F.when(number == 6, F.lower(flags)).when(number != 7, flags)
    return [
        F.col("l_orderkey"),
        number.alias("line_number"),
        (part + 1).alias("product_id"),
        F.concat(F.lit("item "), part.cast("string")).alias("product_name"),
        _amount(_whole(price, F.col("l_quantity"))).alias("unit_price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _amount(price).alias("line_total"),
        off.cast("decimal(10,2)").alias("discount_percentage"),
        F.when(~_every(part, 47), _amount(_per_cent_off(price, off))).alias("line_discounted_total"),
        hint.alias("category_hint"),
    ]


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(*_line_columns())


def cart_detail(spark: SparkSession, folder: str, batches: str = "year") -> DataFrame:
    lines = _lines(spark, folder)
    headers = _headers(spark, folder, batches)
    joined = lines.join(headers, lines.l_orderkey == headers.o_orderkey)
    return joined.withColumns(
        {
            "source": F.lit("carts"),
            "batch_date": F.col("dt"),
        }
    ).select(*columns_of("dwd_order_cart_detail").names, "dt")


def _paged_lines(spark: SparkSession, folder: str, dirty: bool) -> DataFrame:
    """JSON lines per cart. A cart of very many lines comes in several ``parts``, evenly; they are still one record.

    The stored columns are dealt out, and the texts made of them where they are gathered: a text has several times their bytes.
    """
    stored = table(spark, folder, "lineitem").withColumn("position", F.monotonically_increasing_id())
    crowded = (
        stored.groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("line_count"))
        .where(F.col("line_count") > LINES_PER_ENVELOPE)
        .select("l_orderkey", F.ceil(F.col("line_count") / LINES_PER_ENVELOPE).alias("pages"))
    )
    zero_quantity = (F.col("line_number") == 1) & _every(F.col("l_orderkey"), 137, 7) & F.lit(dirty)
    line = F.struct(
        F.col("product_id").alias("id"),
        F.col("product_name").alias("title"),
        F.col("unit_price").alias("price"),
        F.when(zero_quantity, F.lit(0)).otherwise(F.col("quantity")).alias("quantity"),
        F.col("line_total").alias("total"),
        F.col("discount_percentage").alias("discountPercentage"),
        F.col("line_discounted_total").alias("discountedTotal"),
        F.concat(F.lit("https://cdn.example.test/product-images/"), F.col("category_hint"), F.lit("/1.webp")).alias("thumbnail"),
    )
    lines = stored.join(crowded, "l_orderkey", "left").select(*_line_columns(), "position", F.coalesce("pages", F.lit(1)).alias("parts"))
    texts = lines.select("l_orderkey", "parts", F.pmod("position", "parts").alias("page"), F.to_json(line).alias("line"))
    return (
        texts.groupBy("l_orderkey", "parts", "page")
        .agg(F.collect_list("line").alias("lines"))
    )


def _json_number(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("null"))


def cart_envelopes(spark: SparkSession, folder: str, batches: str = "day", dirty: bool = True) -> DataFrame:
    """Carts as landed; ``record`` is the cart of an envelope and ``parts`` in how many envelopes it may lie."""
    headers = _headers(spark, folder, batches)
    lines = _paged_lines(spark, folder, dirty)
    keys = table(spark, folder, "lineitem").select("l_orderkey")
    # Two joins instead of an outer one, whose line side could not be split where it is skewed.
    filled = headers.join(lines, headers.o_orderkey == lines.l_orderkey)
    empty = headers.join(keys, headers.o_orderkey == keys.l_orderkey, "left_anti")
    carts = filled.unionByName(empty, allowMissingColumns=True)
    key = F.col("o_orderkey")
    bad = {name: _every(key, step, rest) if dirty else F.lit(False) for name, (step, rest) in CART_FLAWS.items()}
    listed = F.concat(F.lit("["), F.coalesce(F.array_join("lines", ","), F.lit("")), F.lit("]"))
    values = {
        "id": F.when(bad["fractional_id"], F.lit("1.5")).otherwise(_json_number("cart_id")),
        "userId": F.when(bad["boolean_user"], F.lit("true")).otherwise(_json_number("user_id")),
        "totalProducts": F.when(bad["fractional_count"], F.lit("1.5")).otherwise(_json_number("total_products")),
        "total": _json_number("cart_total"),
        "discountedTotal": _json_number("cart_discounted_total"),
        "totalQuantity": _json_number("total_quantity"),
        "products": F.when(bad["products_text"], F.lit('"bad"')).otherwise(listed),
    }
    pairs = [F.concat(F.lit(f'"{name}":'), value) for name, value in values.items()]
    document = F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))
    named = carts.withColumns({"record": key, "parts": F.coalesce("parts", F.lit(1))})
    return _enveloped(named, "carts", document, bad, "record", "parts")


def cart_records(spark: SparkSession, folder: str, batches: str) -> DataFrame:
    """The carts of ``cart_envelopes`` without their data, one row each: for counting, no line is read."""
    headers = _headers(spark, folder, batches)
    bad = {name: _every(F.col("o_orderkey"), step, rest) for name, (step, rest) in CART_FLAWS.items()}
    return _enveloped(headers, "carts", F.lit(None).cast("string"), bad).drop("data")


# Fixed flaws of the sample feeds: (step, rest) of the record key.
CART_FLAWS = {
    "broken_json": (101, 0),
    "wrong_source": (103, 1),
    "wrong_date": (107, 2),
    "fractional_id": (109, 3),
    "boolean_user": (113, 4),
    "fractional_count": (127, 5),
    "products_text": (131, 6),
}
PRODUCT_FLAWS = {
    "broken_json": (101, 0),
    "wrong_source": (103, 1),
    "wrong_date": (107, 2),
    "fractional_id": (109, 3),
    "numeric_title": (113, 4),
    "no_price": (127, 5),
    "fractional_stock": (131, 6),
    "negative_id": (137, 7),
}
USER_FLAWS = {
    "broken_json": (101, 0),
    "wrong_source": (103, 1),
    "wrong_date": (107, 2),
    "boolean_id": (109, 3),
    "numeric_name": (113, 4),
    "fractional_age": (127, 5),
    "address_text": (131, 6),
    "blank_name": (137, 7),
}
ENTITIES = {"products": "product", "users": "user", "carts": "order"}


def _enveloped(records: DataFrame, source: str, document: Column, bad: dict[str, Column], *kept: str) -> DataFrame:
    return records.select(
        *kept,
        F.lit(ENTITIES[source]).alias("entity"),
        F.when(bad["wrong_source"], F.lit("other")).otherwise(F.lit(source)).alias("source"),
        F.when(bad["wrong_date"], F.lit(WRONG_DATE)).otherwise(F.col("dt")).alias("batch_date"),
        F.when(bad["broken_json"], F.lit("{bad json")).otherwise(document).alias("data"),
        "dt",
    )


# ---- products ----------------------------------------------------------------------------------


def _catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Parts of the product feed; every 19th part is not listed."""
    key = F.col("p_partkey")
    kind = F.concat(F.col("p_type"), F.lit(" & "), (F.col("p_size") % 3).cast("string"))
    return table(spark, folder, "part").where(~_every(key, 19)).select(
        "p_partkey",
        (key + 1).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(_every(key, 17), F.lit("  ")).when(~_every(key, 23), kind).alias("category"),
        F.col("p_brand").alias("brand"),
        _amount(_cents(F.col("p_retailprice"))).alias("price"),
        (key % 20).cast("decimal(10,2)").alias("discount_percentage"),
        (key % 6).cast("decimal(10,2)").alias("rating"),
        F.col("p_size").alias("stock"),
        F.when(F.col("p_size") < 10, F.lit("Low Stock")).otherwise(F.lit("In Stock")).alias("availability_status"),
        F.concat(F.lit("https://cdn.example.test/"), key.cast("string"), F.lit(".png")).alias("thumbnail"),
    )


def product_detail(spark: SparkSession, folder: str) -> DataFrame:
    listed = _republished(_catalogue(spark, folder), spark, folder)
    return listed.withColumns({"source": F.lit("products"), "batch_date": F.col("dt")}).select(
        *columns_of("dwd_product_info").names, "dt"
    )


# Fixed calendar of the change feeds: all items are listed on the first day; (step, rest) of the key tells which ones change,
# which are withdrawn and which come back; a change falls on day 1 + (key * pace) % CHANGE_DAYS after the first.
FIRST_BATCH = "1992-01-01"
CHANGE_DAYS = 2400
BACK_AFTER = 90
PRODUCT_CHANGES = {"changed": (4, 1, 37), "withdrawn": (11, 2, 53), "back": (44, 35, 53)}
USER_CHANGES = {"changed": (5, 2, 41), "withdrawn": (17, 4, 29)}


def _change_day(key: Column, change: tuple[int, int, int], after: int = 0) -> Column:
    offset = 1 + (key * change[2]) % CHANGE_DAYS + after
    return F.date_format(F.date_add(F.lit(FIRST_BATCH).cast("date"), offset.cast("int")), "yyyy-MM-dd")


def product_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Product detail rows on the days they are first listed, changed or listed again only."""
    key, changes = F.col("p_partkey"), PRODUCT_CHANGES
    rows = _catalogue(spark, folder)
    first = rows.withColumn("dt", F.lit(FIRST_BATCH))
    changed = rows.where(_every(key, *changes["changed"][:2])).withColumns(
        {
            "product_name": F.concat("product_name", F.lit(" II")),
            "category": F.concat("category", F.lit(" II")),
            "dt": _change_day(key, changes["changed"]),
        }
    )
    back = rows.where(_every(key, *changes["back"][:2])).withColumn("dt", _change_day(key, changes["back"], BACK_AFTER))
    listed = first.unionByName(changed).unionByName(back)
    return listed.withColumns({"source": F.lit("products"), "batch_date": F.col("dt")}).select(
        *columns_of("dwd_product_info").names, "dt"
    )


def withdrawn_products(spark: SparkSession, folder: str) -> DataFrame:
    key, change = F.col("p_partkey"), PRODUCT_CHANGES["withdrawn"]
    parts = table(spark, folder, "part").where(_every(key, *change[:2]) & ~_every(key, 19))
    return parts.select((key + 1).alias("product_id"), _change_day(key, change).alias("dt"))


def product_envelopes(spark: SparkSession, folder: str, dirty: bool = True) -> DataFrame:
    listed = _republished(_catalogue(spark, folder), spark, folder)
    bad = {
        name: _every(F.col("p_partkey"), step, rest) if dirty else F.lit(False)
        for name, (step, rest) in PRODUCT_FLAWS.items()
    }
    rest = F.struct(
        F.when(~bad["no_price"], F.col("price")).alias("price"),
        "category",
        "brand",
        F.col("discount_percentage").alias("discountPercentage"),
        "rating",
        F.col("availability_status").alias("availabilityStatus"),
        "thumbnail",
    )
    identity = F.col("product_id").cast("string")
    document = F.concat(
        F.lit('{"id":'),
        F.when(bad["fractional_id"], F.lit("1.5")).when(bad["negative_id"], F.concat(F.lit("-"), identity)).otherwise(identity),
        F.lit(',"title":'),
        F.when(bad["numeric_title"], F.lit("123")).otherwise(F.concat(F.lit('"'), F.col("product_name"), F.lit('"'))),
        F.lit(',"stock":'),
        F.when(bad["fractional_stock"], F.lit("3.7")).otherwise(F.col("stock").cast("string")),
        F.regexp_replace(F.to_json(rest), r"^\{", ","),
    )
    return _enveloped(listed, "products", document, bad)


# ---- users -------------------------------------------------------------------------------------


def _people(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return customers.select(
        "c_custkey",
        (key + 1).alias("user_id"),
        F.col("c_name").alias("username"),
        F.concat(F.lit("First"), (key % 100).cast("string")).alias("first_name"),
        F.when(~_every(key, 10), F.concat(F.lit("Last"), (key % 70).cast("string"))).alias("last_name"),
        F.when(_every(key, 3), F.lit("female")).when(_every(key, 3, 1), F.lit("male")).otherwise(F.lit("")).alias("gender"),
        F.when(~_every(key, 13), (key % 60 + 10).cast("int")).alias("age"),
        F.concat(F.lower("c_mktsegment"), F.lit("@example.test")).alias("email"),
        F.concat(F.lit("+1 555 "), key.cast("string")).alias("phone"),
        F.concat(F.lit("City "), (key % 40).cast("string")).alias("city"),
        F.col("r_name").alias("state"),
        F.when(~_every(key, 29), F.col("n_name")).alias("country"),
        (key % 90).cast("decimal(18,6)").alias("latitude"),
        (-(key % 180)).cast("decimal(18,6)").alias("longitude"),
        F.when(_every(key, 50), F.lit("admin")).otherwise(F.lit("user")).alias("role"),
    )


def user_detail(spark: SparkSession, folder: str) -> DataFrame:
    people = _republished(_people(spark, folder), spark, folder)
    return people.withColumns(
        {
            "full_name": text.full_name(F.col("first_name"), F.col("last_name")),
            "age_group": text.age_group(F.col("age")),
            "source": F.lit("users"),
            "batch_date": F.col("dt"),
        }
    ).select(*columns_of("dwd_user_info").names, "dt")


def user_changes(spark: SparkSession, folder: str) -> DataFrame:
    """User detail rows on the days they first appear or change only."""
    key, change = F.col("c_custkey"), USER_CHANGES["changed"]
    rows = _people(spark, folder)
    first = rows.withColumn("dt", F.lit(FIRST_BATCH))
    changed = rows.where(_every(key, *change[:2])).withColumns(
        {"age": F.col("age") + 15, "country": F.lit("ABROAD"), "dt": _change_day(key, change)}
    )
    people = first.unionByName(changed)
    return people.withColumns(
        {
            "full_name": text.full_name(F.col("first_name"), F.col("last_name")),
            "age_group": text.age_group(F.col("age")),
            "source": F.lit("users"),
            "batch_date": F.col("dt"),
        }
    ).select(*columns_of("dwd_user_info").names, "dt")


def withdrawn_users(spark: SparkSession, folder: str) -> DataFrame:
    key, change = F.col("c_custkey"), USER_CHANGES["withdrawn"]
    return table(spark, folder, "customer").where(_every(key, *change[:2])).select(
        (key + 1).alias("user_id"), _change_day(key, change).alias("dt")
    )


def user_envelopes(spark: SparkSession, folder: str, dirty: bool = True) -> DataFrame:
    return _keyed_user_envelopes(spark, folder, dirty).drop("c_custkey")


def _keyed_user_envelopes(spark: SparkSession, folder: str, dirty: bool) -> DataFrame:
    people = _republished(_people(spark, folder), spark, folder)
    bad = {
        name: _every(F.col("c_custkey"), step, rest) if dirty else F.lit(False)
        for name, (step, rest) in USER_FLAWS.items()
    }
    address = F.struct(
        "city",
        "state",
        "country",
        F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lng")).alias("coordinates"),
    )
    rest = F.struct(
        F.when(bad["blank_name"], F.lit("  ")).when(~bad["numeric_name"], F.col("username")).alias("username"),
        F.col("first_name").alias("firstName"),
        F.col("last_name").alias("lastName"),
        "gender",
        F.when(bad["fractional_age"], F.lit("30.5").cast("decimal(10,1)")).alias("unusualAge"),
        F.when(~bad["fractional_age"], F.col("age")).alias("age"),
        "email",
        "phone",
        "role",
        F.when(~bad["address_text"], address).alias("address"),
    )
    document = F.concat(
        F.lit('{"id":'),
        F.when(bad["boolean_id"], F.lit("true")).otherwise(F.col("user_id").cast("string")),
        F.when(bad["numeric_name"], F.lit(',"username":123')).otherwise(F.lit("")),
        F.when(bad["address_text"], F.lit(',"address":"none"')).otherwise(F.lit("")),
        F.regexp_replace(F.regexp_replace(F.to_json(rest), r"^\{", ","), "unusualAge", "age"),
    )
    return _enveloped(people, "users", document, bad, "c_custkey")


# ---- landing -------------------------------------------------------------------------------------

ITEMS_PER_PAGE = 100
# (step, rest) of the page number: pages without a list.
BROKEN_PAGES = {"products": (7, 3), "users": (5, 2), "carts": (11, 4)}


def _items(spark: SparkSession, folder: str, source: str) -> tuple[Column, DataFrame, Column]:
    """The key, the rows and the item texts of a source."""
    if source == "products":
        key = F.col("p_partkey")
        fields = [(key + 1).alias("id"), F.col("p_name").alias("title"), F.col("p_size").alias("stock")]
        return key, table(spark, folder, "part"), F.to_json(F.struct(*fields))
    if source == "users":
        key = F.col("c_custkey")
        return key, table(spark, folder, "customer"), F.to_json(F.struct((key + 1).alias("id"), F.col("c_name").alias("username")))
    key = F.col("o_orderkey")
    return key, table(spark, folder, "orders"), F.to_json(F.struct((key + 1).alias("id"), (F.col("o_custkey") + 1).alias("userId")))


def payload_pages(spark: SparkSession, folder: str, source: str, broken: bool = True) -> DataFrame:
    """Payload pages of at most 100 items of a source; some pages have no list.

    Cutting by row position as well as by key keeps a page small whatever the keys are.
    """
    key, rows, item = _items(spark, folder, source)
    items = rows.select(
        F.floor(key / ITEMS_PER_PAGE).alias("page"),
        F.floor(F.monotonically_increasing_id() / ITEMS_PER_PAGE).alias("stretch"),
        item.alias("item"),
    )
    listed = F.concat(F.lit(f'{{"{source}":['), F.array_join("items", ","), F.lit('],"total":1}'))
    pages = items.groupBy("page", "stretch").agg(F.collect_list("item").alias("items"))
    is_broken = _every(F.col("page"), *BROKEN_PAGES[source])
    pages = pages if broken else pages.where(~is_broken)
    return pages.select(
        F.lit(source).alias("source"),
        F.concat(F.lit("2026-07-0"), (F.col("page") % 9 + 1).cast("string")).alias("batch_date"),
        F.when(is_broken, F.lit(f'{{"{source}":"none"}}')).otherwise(listed).alias("payload"),
    )


# Fixed flaws of the landed text lines: (step, rest) of the record key.
LINE_FLAWS = {"blank": (151, 3), "cut": (157, 4), "no_entity": (163, 5), "object_data": (167, 6)}


def landed_user_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Text lines of the landed user feed (``value``, ``dt``) with flaws of every kind."""
    users = _keyed_user_envelopes(spark, folder, dirty=True)
    flaw = {name: _every(F.col("c_custkey"), step, rest) for name, (step, rest) in LINE_FLAWS.items()}
    line = F.to_json(
        F.struct(F.when(~flaw["no_entity"], F.col("entity")).alias("entity"), "source", "batch_date", "data")
    )
    with_object = F.concat(
        F.lit('{"entity":"user","source":"users","batch_date":"'), F.col("dt"), F.lit('","data":{"id":1}}')
    )
    value = (
        F.when(flaw["blank"], F.lit(" "))
        .when(flaw["cut"], F.substring(line, 1, 20))
        .when(flaw["object_data"], with_object)
        .otherwise(line)
    )
    return users.select(value.alias("value"), "dt")


def batch_date_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates as text, some of them misspelt or not in the calendar."""
    key = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text_form = (
        F.when(_every(key, 97), F.concat(F.substring(day, 1, 4), F.lit("-02-30")))
        .when(_every(key, 89), F.regexp_replace(day, "-", ""))
        .when(_every(key, 83), F.concat(F.lit(" "), day))
        .otherwise(day)
    )
    return table(spark, folder, "orders").select(text_form.alias("batch_date"))
