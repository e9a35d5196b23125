"""Summary layer: per-day facts from cart lines and dimensions.

``dt`` is part of every grouping and join key. Rows of one day, product, user or cart are never
brought together before they are reduced: the first shuffle of each builder is on a key that
includes the cart, after a map-side combine, so a hot day or product spreads over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.numbers import guarded_ratio, money, money_sum, zero_if_null
from marketloom.functions.text import UNKNOWN
from marketloom.operators.as_of import VERSION, as_of, counts_over_time, on_days, rows_as_of, versions
from marketloom.session import broadcast_if_small

USER_ATTRIBUTES = ("age_group", "gender", "country")
# What the builders read of a cart line.
LINE_COLUMNS = (
    "dt", "cart_id", "user_id", "cart_total", "cart_discounted_total", "total_quantity", "product_id", "product_name",
    "category_hint", "quantity", "line_discounted_total",
)


def _one_row_per_date(daily: DataFrame, dates: DataFrame | None) -> DataFrame:
    """With requested ``dates`` (column ``dt``) a day without carts still gets a row, of NULLs."""
    return daily if dates is None else dates.select("dt").distinct().join(daily, "dt", "left")


def sales_daily(lines: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    headers = lines.select(
        "dt", "cart_id", "user_id", "cart_total", "cart_discounted_total", "total_quantity"
    ).distinct()
    daily = headers.groupBy("dt").agg(
        F.countDistinct("cart_id").alias("orders"),
        F.countDistinct("user_id").alias("payers"),
        F.sum("cart_total").alias("total"),
        F.sum("cart_discounted_total").alias("discounted"),
        F.sum("total_quantity").alias("quantity"),
    )
    discounted = zero_if_null(F.col("discounted"))
    return _one_row_per_date(daily, dates).select(
        F.col("dt").alias("date_id"),
        zero_if_null(F.col("orders")).alias("order_count"),
        zero_if_null(F.col("payers")).alias("pay_user_count"),
        money(zero_if_null(F.col("total"))).alias("total_sales_amount"),
        money(discounted).alias("discount_sales_amount"),
        guarded_ratio(discounted, F.col("orders"), "decimal(18,2)").alias("avg_order_amount"),
        zero_if_null(F.col("quantity")).alias("total_quantity"),
        "dt",
    )


def _product_grains(lines: DataFrame) -> DataFrame:
    """Sales per product and per variant of its lines (``per_product`` tells which), in one pass."""
    sold = lines.select(
        "dt",
        "product_id",
        "product_name",
        F.coalesce("category_hint", F.lit(UNKNOWN)).alias("category_hint"),
        "cart_id",
        "quantity",
        "line_discounted_total",
    )
    return sold.groupingSets(
        [["dt", "product_id"], ["dt", "product_id", "product_name", "category_hint"]],
        "dt", "product_id", "product_name", "category_hint",
    ).agg(
        (F.grouping("category_hint") == 1).alias("per_product"),
        F.sum("quantity").alias("quantity"),
        F.sum("line_discounted_total").alias("amount"),
        F.countDistinct("cart_id").alias("order_count"),
    )


def _named_sales(grains: DataFrame, products: DataFrame) -> DataFrame:
    catalogue = products.select(
        "dt",
        "product_id",
        F.col("product_name").alias("listed_name"),
        F.col("category").alias("listed_category"),
        "brand",
    )
    listings = catalogue.groupBy("dt", "product_id", "listed_name", "listed_category", "brand").agg(
        F.count(F.lit(1)).alias("copies")
    )
    copies = F.coalesce("copies", F.lit(1))
    return (
        grains.join(listings, ["dt", "product_id"], "left")
        .where(F.col("per_product") == F.col("copies").isNotNull())
        .select(
            F.col("dt").alias("date_id"),
            "product_id",
            F.coalesce("listed_name", "product_name").alias("product_name"),
            F.coalesce("listed_category", "category_hint").alias("category"),
            "brand",
            (F.col("quantity") * copies).alias("sales_quantity"),
            money(F.col("amount") * copies).alias("sales_amount"),
            "order_count",
            "dt",
        )
    )


def product_daily(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Sales per product; ``products`` is the product dimension, whose names are never NULL.

    Lines are reduced before they meet the catalogue, so a hot product joins as a few rows. A listed product
    takes its name and category from the catalogue, hence one row per product; an unlisted one keeps the
    names and hints of its lines. Distinct carts do not add up from the finer grain to the coarser, so both
    grains are aggregated in one pass and the join picks one.
    """
    return _named_sales(_product_grains(lines), products)


def _variant_sales(lines: DataFrame) -> DataFrame:
    """Sales per product and variant of its lines, with the distinct carts of the variant and, in ``first_carts``, of its product.

    ``first_carts`` counts a cart in one variant only, so it adds up over the variants of a product. A group is the lines
    of one product in one cart.
    """
    sold = lines.select(
        "dt",
        "product_id",
        "product_name",
        F.coalesce("category_hint", F.lit(UNKNOWN)).alias("category_hint"),
        "cart_id",
        "quantity",
        "line_discounted_total",
    )
    of_cart = Window.partitionBy("cart_id", "product_id", "dt").orderBy("product_name", "category_hint")
    again = [F.lag(name).over(of_cart).eqNullSafe(F.col(name)) for name in ("product_name", "category_hint")]
    marked = sold.withColumns({"place": F.row_number().over(of_cart), "again": again[0] & again[1]})
    seen, first = F.col("cart_id").isNotNull(), F.col("place") == 1
    return marked.groupBy("dt", "product_id", "product_name", "category_hint").agg(
        F.sum("quantity").alias("quantity"),
        F.sum("line_discounted_total").alias("amount"),
        F.count_if(seen & (first | ~F.col("again"))).alias("carts"),
        F.count_if(seen & first).alias("first_carts"),
    )


def product_daily_as_of(lines: DataFrame, products: DataFrame, withdrawn: DataFrame | None = None) -> DataFrame:
    """As ``product_daily``, with the changes of the product dimension instead of a catalogue for every day.

    Lines are reduced to the variants of a product and day, which meet the versions of the product once: the variants of
    a listed product are added up under its listed name and category, others stay apart.
    """
    known = versions(products.select("dt", "product_id", "product_name", "category", "brand"), "product_id", withdrawn)
    found = rows_as_of(_variant_sales(lines), known, "product_id").withColumn("listed", F.col(VERSION).isNotNull())
    of_day = Window.partitionBy("product_id", "apart", "dt")
    listed, version = F.col("listed"), F.col(VERSION)

    def measure(listed_name: str, name: str) -> Column:
        return F.when(listed, F.sum(listed_name).over(of_day)).otherwise(F.col(name))

    added = found.withColumns(
        {
            "place": F.row_number().over(of_day.orderBy("asks")),
            "sales_quantity": measure("quantity", "quantity"),
            "sales_amount": money(measure("amount", "amount")),
            "order_count": zero_if_null(measure("first_carts", "carts")),
        }
    )
    return added.where(~listed | (F.col("place") == 1)).select(
        F.col("dt").alias("date_id"),
        "product_id",
        F.when(listed, version["product_name"]).otherwise(F.col("product_name")).alias("product_name"),
        F.when(listed, version["category"]).otherwise(F.col("category_hint")).alias("category"),
        version["brand"].alias("brand"),
        "sales_quantity",
        "sales_amount",
        "order_count",
        "dt",
    )


def _category_sales(product_days: DataFrame) -> DataFrame:
    return product_days.groupBy("dt", "category").agg(
        F.sum("sales_quantity").alias("sales_quantity"),
        money(F.sum("sales_amount")).alias("sales_amount"),
        F.sum("order_count").alias("order_count"),
    )


def category_daily(product_days: DataFrame, categories: DataFrame) -> DataFrame:
    """Order counts add up over products, so a cart with two products of a category counts twice."""
    sold = _category_sales(product_days)
    sizes = categories.groupBy("dt", F.col("category_name").alias("category")).agg(
        F.max("product_count").alias("product_count")
    )
    return sold.join(sizes, ["dt", "category"], "left").select(
        F.col("dt").alias("date_id"), "category", "product_count", "sales_quantity", "sales_amount", "order_count", "dt"
    )


def category_daily_as_of(product_days: DataFrame, products: DataFrame, withdrawn: DataFrame | None = None) -> DataFrame:
    """As ``category_daily``, with the changes of the product dimension; sizes are running sums of its changes.

    Products are added up first, once, so days and categories are all that meets the sizes.
    """
    known = versions(products.select("dt", "product_id", "category"), "product_id", withdrawn)
    sizes = counts_over_time(known, "product_id", ["category"]).select("category", "dt", F.col("items").alias("product_count"))
    filled = sizes.where(F.col("product_count") > 0)
    sized = versions(filled, "category", sizes.where(F.col("product_count") == 0))
    found = rows_as_of(_category_sales(product_days), sized, "category")
    return found.select(
        F.col("dt").alias("date_id"), "category", F.col(VERSION)["product_count"].alias("product_count"),
        "sales_quantity", "sales_amount", "order_count", "dt",
    )


def _profile_rows(user_counts: DataFrame, people: DataFrame, lines: DataFrame) -> DataFrame:
    """Users and their carts, reduced separately and added up; ``people`` has one row per day, user and set of attributes."""
    carts = lines.select("dt", "cart_id", "user_id", "cart_discounted_total").distinct()
    bought = (
        carts.join(people, ["dt", "user_id"])
        .groupBy("dt", *USER_ATTRIBUTES)
        .agg(
            F.countDistinct("user_id").alias("buyer_count"),
            F.countDistinct("cart_id").alias("order_count"),
            F.sum(F.col("cart_discounted_total") * F.col("copies")).alias("sales_amount"),
        )
    )
    return (
        user_counts.unionByName(bought, allowMissingColumns=True)
        .groupBy("dt", *USER_ATTRIBUTES)
        .agg(
            F.sum(zero_if_null(F.col("user_count"))).alias("user_count"),
            F.sum(zero_if_null(F.col("buyer_count"))).alias("buyer_count"),
            F.sum(zero_if_null(F.col("order_count"))).alias("order_count"),
            money_sum(F.col("sales_amount")).alias("sales_amount"),
        )
        .select(
            F.col("dt").alias("date_id"), *USER_ATTRIBUTES, "user_count", "buyer_count", "order_count", "sales_amount",
            "dt",
        )
    )


def user_profile_daily(users: DataFrame, lines: DataFrame) -> DataFrame:
    """Users, buyers, orders and sales per age group, gender and country; NULL is a group of its own.

    Users without carts count as users only, so users and orders are reduced separately and added
    up. That leaves an inner join of carts with users, whose skewed side AQE can split, where the
    outer join of users with carts could not be split on the cart side.
    """
    people = users.groupBy("dt", "user_id", *USER_ATTRIBUTES).agg(F.count(F.lit(1)).alias("copies"))
    user_counts = people.groupBy("dt", *USER_ATTRIBUTES).agg(
        F.count_if(F.col("user_id").isNotNull() & (F.col("copies") > 0)).alias("user_count")
    )
    return _profile_rows(user_counts, people, lines)


def user_profile_daily_as_of(
    users: DataFrame, lines: DataFrame, dates: DataFrame, withdrawn: DataFrame | None = None
) -> DataFrame:
    """As ``user_profile_daily`` for each of ``dates`` (``dt``), with the changes of the user dimension.

    All users of a day are counted by running sums of changes; only buyers are looked up, on the days when they bought.
    """
    known = versions(users.select("dt", "user_id", *USER_ATTRIBUTES), "user_id", withdrawn)
    groups = list(USER_ATTRIBUTES)
    user_counts = on_days(counts_over_time(known, "user_id", groups), groups, dates).withColumnRenamed("items", "user_count")
    days = dates.select("dt").distinct()
    asked = lines.join(broadcast_if_small(days), "dt", "left_semi")
    people = as_of(asked, known, "user_id").withColumn("copies", F.lit(1))
    return _profile_rows(user_counts, people, asked)


def funnel_daily(lines: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Carts count as orders and as payments; there is no source of views."""
    daily = lines.groupBy("dt").agg(F.countDistinct("cart_id").alias("carts"))
    return _funnel(_one_row_per_date(daily, dates))


def funnel_of_sales(sales: DataFrame) -> DataFrame:
    """The funnel of the carts that ``sales_daily`` has counted, without reading their lines again."""
    return _funnel(sales.select("dt", F.col("order_count").alias("carts")))


def _funnel(daily: DataFrame) -> DataFrame:
    carts = zero_if_null(F.col("carts"))
    none = F.lit(0).cast("bigint")
    return daily.select(
        F.col("dt").alias("date_id"),
        none.alias("view_count"),
        carts.alias("cart_count"),
        carts.alias("order_count"),
        carts.alias("payment_count"),
        guarded_ratio(carts, none).alias("cart_rate"),
        guarded_ratio(carts, carts).alias("order_rate"),
        guarded_ratio(carts, carts).alias("payment_rate"),
        "dt",
    )
