"""Summaries and metrics against plain SQL on a small fixture full of awkward rows."""

import random
from decimal import Decimal

import duckdb
import pytest

from marketloom.operators import dimensions, metrics, summaries
from marketloom.schemas import schema_of, table_schema

LINES = (
    "cart_id BIGINT, user_id BIGINT, product_id BIGINT, product_name STRING, quantity INT, "
    "line_discounted_total DECIMAL(18,2), category_hint STRING, cart_total DECIMAL(18,2), "
    "cart_discounted_total DECIMAL(18,2), total_quantity INT, dt STRING"
)
PRODUCTS = "product_id BIGINT, product_name STRING, category STRING, brand STRING, dt STRING"
USERS = "user_id BIGINT, age_group STRING, gender STRING, country STRING, dt STRING"
DAYS = ("2026-07-01", "2026-07-02")


def amount(rng, top):
    return None if rng.random() < 0.1 else Decimal(rng.randrange(top)) / 100


def build_rows():
    """One product, one user and one cart id hold about a third of the lines of the first day."""
    rng = random.Random(7)
    lines = []
    for n in range(900):
        hot = rng.random() < 0.33
        cart = 1 if hot else rng.randrange(2, 60)
        user = 1 if hot else rng.randrange(1, 25)
        product = 1 if hot else rng.randrange(1, 30)
        lines.append(
            (
                cart, user, product, rng.choice(["a", "b", None]), rng.randrange(1, 5), amount(rng, 9000),
                rng.choice([None, "unknown", "home", "Home"]), amount(rng, 300), amount(rng, 300), rng.choice([None, 1, 2]),
                DAYS[0] if hot or n % 3 else DAYS[1],
            )
        )
    products = [
        (p, f"product {p % 7}", rng.choice(["tech", "home", "unknown"]), rng.choice([None, "B1"]), day)
        for p in range(1, 20)
        for day in DAYS
        for _ in range(rng.randrange(1, 4))
    ]
    products += [products[0]] * 3
    users = [
        (u, rng.choice(["<18", "18-24"]), rng.choice([None, "", " ", "male"]), rng.choice([None, "A"]), day)
        for u in range(1, 30)
        for day in DAYS
        for _ in range(rng.randrange(1, 3))
    ]
    return lines, products, users


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    lines, products, users = build_rows()
    frames = {
        "lines": spark.createDataFrame(lines, schema_of(LINES)),
        "products": spark.createDataFrame(products, schema_of(PRODUCTS)),
        "users": spark.createDataFrame(users, schema_of(USERS)),
    }
    folder = tmp_path_factory.mktemp("inputs")
    db = duckdb.connect()
    for name, df in frames.items():
        df.coalesce(1).write.parquet(f"{folder}/{name}")
        frames[name] = spark.read.parquet(f"{folder}/{name}")
        db.execute(f"CREATE TABLE {name} AS SELECT * FROM '{folder}/{name}/*.parquet'")
    return frames, db


def same(df, db, sql):
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    key = lambda row: tuple(str(v) for v in row)
    mine = sorted((tuple(r[n] for n in names) for r in df.collect()), key=key)
    assert mine == sorted((tuple(r) for r in result.fetchall()), key=key)


PRODUCT_SQL = """WITH per_cart AS (
  SELECT dt, cart_id, product_id, product_name, coalesce(category_hint, 'unknown') AS hint, sum(quantity) AS q, sum(line_discounted_total) AS a
  FROM lines GROUP BY ALL),
named AS (
  SELECT l.dt, cart_id, product_id, p.product_name, p.category, p.brand, sum(q) AS q, sum(a) AS a
  FROM per_cart AS l JOIN products AS p USING (dt, product_id) GROUP BY ALL
  UNION ALL SELECT dt, cart_id, product_id, product_name, hint, NULL, sum(q), sum(a)
  FROM per_cart ANTI JOIN products USING (dt, product_id) GROUP BY ALL)
SELECT dt, product_id, product_name, category, brand, CAST(sum(q) AS BIGINT) AS sales_quantity,
  CAST(sum(a) AS DECIMAL(18,2)) AS sales_amount, count(*) AS order_count
FROM named GROUP BY ALL"""


def test_product_daily(inputs):
    frames, db = inputs
    same(summaries.product_daily(frames["lines"], frames["products"]), db, PRODUCT_SQL)


def test_sales_daily(inputs):
    frames, db = inputs
    same(
        summaries.sales_daily(frames["lines"]).drop("avg_order_amount"),
        db,
        """SELECT dt AS date_id, count(DISTINCT cart_id) AS order_count, count(DISTINCT user_id) AS pay_user_count,
  CAST(sum(cart_total) AS DECIMAL(18,2)) AS total_sales_amount, CAST(sum(cart_discounted_total) AS DECIMAL(18,2)) AS discount_sales_amount,
  CAST(sum(total_quantity) AS BIGINT) AS total_quantity
FROM (SELECT DISTINCT dt, cart_id, user_id, cart_total, cart_discounted_total, total_quantity FROM lines) h GROUP BY dt""",
    )


def test_user_profile_daily(inputs):
    frames, db = inputs
    profile = summaries.user_profile_daily(frames["users"], frames["lines"])
    sql = """SELECT u.dt, u.age_group, u.gender, u.country, count(DISTINCT u.user_id) AS user_count,
  count(DISTINCT c.user_id) AS buyer_count, count(DISTINCT c.cart_id) AS order_count,
  CAST(coalesce(sum(c.cart_discounted_total), 0) AS DECIMAL(18,2)) AS sales_amount
FROM users u LEFT JOIN (SELECT DISTINCT dt, cart_id, user_id, cart_discounted_total FROM lines) c
  ON u.user_id = c.user_id AND u.dt = c.dt GROUP BY u.dt, u.age_group, u.gender, u.country"""
    same(profile, db, sql)
    value = "coalesce(nullif(trim({0}), ''), 'unknown')"
    arms = [
        f"SELECT dt, '{n}' AS dimension_type, {value.format(n)} AS dimension_value, CAST(sum(user_count) AS BIGINT) AS user_count, "
        f"CAST(sum(sales_amount) AS DECIMAL(18,2)) AS sales_amount FROM p GROUP BY ALL"
        for n in ("age_group", "gender", "country")
    ]
    same(metrics.user_profile_daily(profile), db, f"WITH p AS ({sql}) " + " UNION ALL ".join(arms))


def test_category_daily_and_share(inputs):
    frames, db = inputs
    days = summaries.product_daily(frames["lines"], frames["products"])
    categories = dimensions.category_dimension(frames["products"])
    category_days = summaries.category_daily(days, categories)
    sql = f"""SELECT s.dt, s.category, max(n) AS product_count, CAST(sum(sales_quantity) AS BIGINT) AS sales_quantity,
  CAST(sum(sales_amount) AS DECIMAL(18,2)) AS sales_amount, CAST(sum(order_count) AS BIGINT) AS order_count
FROM ({PRODUCT_SQL}) s LEFT JOIN (SELECT dt, category, count(DISTINCT product_id) AS n FROM products GROUP BY ALL) c
  ON s.category = c.category AND s.dt = c.dt GROUP BY s.dt, s.category"""
    same(category_days, db, sql)
    shares = metrics.category_share_daily(category_days).groupBy("dt").agg({"sales_share": "sum"}).collect()
    assert all(abs(float(r["sum(sales_share)"]) - 1) < 0.01 for r in shares)


def test_rank_is_ten_rows_in_repeatable_order(inputs):
    frames, _ = inputs
    days = summaries.product_daily(frames["lines"], frames["products"])
    ranks = metrics.product_rank_daily(days).orderBy("dt", "rank_no").collect()
    for day in DAYS:
        rows = [r for r in ranks if r.dt == day]
        assert [r.rank_no for r in rows] == list(range(1, 11))
        order = [(-(r.sales_amount or -1), -r.sales_quantity, r.product_id) for r in rows]
        assert order == sorted(order)


def test_empty_batch_gives_zero_rows_where_the_model_says_so(spark):
    dates = spark.createDataFrame([("2026-07-01",)], "dt STRING")
    lines = spark.createDataFrame([], table_schema("dwd_order_cart_detail"))
    users = spark.createDataFrame([(1, "<18", "male", None, "2026-07-01")], schema_of(USERS))
    products = spark.createDataFrame([], table_schema("dim_product"))
    sales, funnel = summaries.sales_daily(lines, dates), summaries.funnel_daily(lines, dates)
    assert [tuple(r)[1:7] for r in sales.collect()] == [(0, 0, Decimal("0.00"), Decimal("0.00"), Decimal("0.00"), 0)]
    assert [r.conversion_rate for r in metrics.funnel_daily(funnel).collect()] == [Decimal("0.0000")] * 3
    kpi = metrics.kpi_daily(sales, funnel).first()
    assert (kpi.date_id, kpi.total_order_count, kpi.payment_conversion_rate) == ("2026-07-01", 0, Decimal("0.0000"))
    days = summaries.product_daily(lines, products)
    assert days.isEmpty() and metrics.product_rank_daily(days).isEmpty()
    profile = summaries.user_profile_daily(users, lines).collect()
    assert [(r.user_count, r.buyer_count, r.sales_amount) for r in profile] == [(1, 0, Decimal("0.00"))]


def test_share_of_a_day_without_sales_is_zero(spark):
    rows = [("d", "a", None, 1, Decimal("0.00"), 1, "d"), ("d", "b", None, 1, None, 1, "d")]
    df = spark.createDataFrame(rows, table_schema("dws_category_daily"))
    assert {r.sales_share for r in metrics.category_share_daily(df).collect()} == {Decimal("0.0000")}


def test_calendar(spark):
    dates = spark.createDataFrame([("2026-07-01",), ("2026-07-04",), ("2027-01-03",)], "dt STRING")
    rows = {r.date_id: r for r in dimensions.date_dimension(dates).collect()}
    assert (rows["2026-07-01"].day_of_week, rows["2026-07-01"].week_of_year, rows["2026-07-01"].is_weekend) == (4, 27, False)
    assert (rows["2026-07-04"].day_of_week, rows["2026-07-04"].is_weekend) == (7, True)
    assert (rows["2027-01-03"].day_of_week, rows["2027-01-03"].week_of_year, rows["2027-01-03"].is_weekend) == (1, 53, True)


def test_category_slugs(spark):
    rows = [(1, "n", c, None, None, None, None, None, None, None, "products", "d", "d") for c in ("Home & Garden", "a-b", " ", None)]
    df = dimensions.category_dimension(spark.createDataFrame(rows, table_schema("dwd_product_info")))
    assert {(r.category_id, r.category_name) for r in df.collect()} == {
        ("home_garden", "Home & Garden"), ("a_b", "a-b"), ("unknown", "unknown")
    }
