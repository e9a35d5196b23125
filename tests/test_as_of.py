import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from marketloom.operators import dimensions, summaries
from marketloom.operators.as_of import as_of, counts_over_time, on_days, versions
from marketloom.plans import batch
from marketloom.schemas import table_schema
from marketloom.sinks.tables import read_table, replace_partitions

ROWS = "item BIGINT, colour STRING, dt STRING"
GONE = "item BIGINT, dt STRING"


def day(n):
    return (date(2026, 1, 1) + timedelta(n)).isoformat()


def random_feed(seed, items=12, days=40, count=120):
    rng = random.Random(seed)
    rows = [(rng.randrange(items), rng.choice(["red", "blue", None]), day(rng.randrange(days))) for _ in range(count)]
    gone = [(rng.randrange(items), day(rng.randrange(days))) for _ in range(count // 5)]
    return rows + rows[:5], gone + gone[:2]


def state(rows, gone, item, on):
    """None, or (colour,) of an item on a day, by a plain search."""
    best = None
    for i, colour, dt in rows:
        if i == item and dt <= on:
            best = max(best or ("",), (dt, False, colour is not None, colour or ""))
    for i, dt in gone:
        if i == item and dt <= on:
            best = max(best or ("",), (dt, True))
    return None if best is None or best[1] else (best[3] if best[2] else None,)


@pytest.mark.parametrize("seed", range(3))
def test_as_of_and_counts_equal_a_plain_search(spark, seed):
    rows, gone = random_feed(seed)
    known = versions(spark.createDataFrame(rows, ROWS), "item", spark.createDataFrame(gone, GONE))
    asked = [(i, day(n)) for i in range(14) for n in range(0, 45, 3)]
    found = as_of(spark.createDataFrame(asked + asked[:9] + [(None, day(3))], GONE), known, "item").collect()
    wanted = {(i, d, *s) for i, d in asked if (s := state(rows, gone, i, d)) is not None}
    assert {(r.item, r.dt, r.colour) for r in found} == wanted and len(found) == len(wanted)

    days = [day(n) for n in range(5, 50, 2)]
    counted = on_days(counts_over_time(known, "item", ["colour"]), ["colour"], spark.createDataFrame([(d,) for d in days], "dt STRING"))
    expected = {}
    for d in days:
        for i in range(14):
            if (s := state(rows, gone, i, d)) is not None:
                expected[d, s[0]] = expected.get((d, s[0]), 0) + 1
    assert {(r.dt, r.colour): r["items"] for r in counted.collect()} == expected


def test_empty_feeds(spark):
    known = versions(spark.createDataFrame([], ROWS), "item")
    assert as_of(spark.createDataFrame([(1, day(1))], GONE), known, "item").count() == 0
    assert on_days(counts_over_time(known, "item", ["colour"]), ["colour"], spark.createDataFrame([], "dt STRING")).count() == 0


def test_a_hot_item_has_a_row_a_day(spark):
    known = versions(spark.createDataFrame([(1, "red", day(0))], ROWS), "item")
    asked = spark.range(20_000).select(F.lit(1).cast("bigint").alias("item"), F.lit(day(3)).alias("dt"))
    assert as_of(asked, known, "item").count() == 1


def test_daily_copies_of_the_feed_give_the_same_summaries(spark):
    """The as-of builders against the builders that read a whole copy of the catalogue for every day."""
    rng = random.Random(4)
    days = [day(n) for n in range(6)]
    products, users = [], []
    for i in range(1, 12):
        for d in rng.sample(days, 2):
            products.append((i, f"p{i}", rng.choice(["a", "b", " "]), f"brand{i % 3}", d))
    for i in range(1, 9):
        for d in rng.sample(days, 2):
            users.append((i, rng.choice(["18-24", "unknown"]), rng.choice(["male", None]), rng.choice(["X", "Y"]), d))
    gone = [(3, day(4)), (5, day(2))]
    lines = [(c, rng.randint(1, 10), rng.randint(1, 13), f"line{rng.randint(1, 3)}", rng.randint(1, 4), rng.choice([None, "hint"]), rng.choice(days)) for c in range(60)]
    line_rows = spark.createDataFrame(
        [(c, u, p, n, q, h, 2.0 * q, 10.0, d) for c, u, p, n, q, h, d in lines],
        "cart_id BIGINT, user_id BIGINT, product_id BIGINT, product_name STRING, quantity INT, category_hint STRING, line DOUBLE, cart DOUBLE, dt STRING",
    ).withColumns({"line_discounted_total": F.col("line").cast("decimal(18,2)"), "cart_discounted_total": F.col("cart").cast("decimal(18,2)")})
    product_schema = "product_id BIGINT, product_name STRING, category STRING, brand STRING, dt STRING"
    user_schema = "user_id BIGINT, age_group STRING, gender STRING, country STRING, dt STRING"
    dates = spark.createDataFrame([(d,) for d in days], "dt STRING")

    def copies(rows, withdrawn):
        out = []
        for d in days:
            for item in {r[0] for r in rows}:
                past = [r for r in rows if r[0] == item and r[-1] <= d]
                left = [w for w in withdrawn if w[0] == item and w[1] <= d]
                if past and not (left and max(left)[1] >= max(r[-1] for r in past)):
                    last = max(past, key=lambda r: r[-1])
                    out.append((*last[:-1], d))
        return out

    def dims(frame):
        whole = frame.withColumns({"price": F.lit(None).cast("decimal(18,2)"), "stock": F.lit(1), "availability_status": F.lit("x")})
        return dimensions.product_dimension(whole)

    gone_rows = spark.createDataFrame(gone, "product_id BIGINT, dt STRING")
    every_day = spark.createDataFrame(copies(products, gone), product_schema)
    changes = spark.createDataFrame(products, product_schema)
    plain = summaries.product_daily(line_rows, dims(every_day))
    mine = summaries.product_daily_as_of(line_rows, dims(changes), gone_rows)
    assert sorted(map(str, mine.collect())) == sorted(map(str, plain.collect()))
    sizes = dimensions.category_dimension(every_day)
    assert sorted(map(str, summaries.category_daily_as_of(mine, dims(changes), gone_rows).collect())) == sorted(map(str, summaries.category_daily(plain, sizes).collect()))
    people = spark.createDataFrame(copies(users, []), user_schema)
    assert sorted(map(str, summaries.user_profile_daily_as_of(spark.createDataFrame(users, user_schema), line_rows, dates).collect())) == sorted(
        map(str, summaries.user_profile_daily(people, line_rows).collect())
    )


def test_backfill_of_changes_stores_every_day(spark, sample, tmp_path):
    from marketloom.sources import sample_tables

    root = str(tmp_path)
    lines = sample_tables.cart_detail(spark, sample, "day").where("dt < '1995-03-01'")
    dates = lines.select("dt").distinct()
    replace_partitions(lines, root, "dwd_order_cart_detail")
    replace_partitions(sample_tables.product_changes(spark, sample), root, "dwd_product_info")
    replace_partitions(sample_tables.user_changes(spark, sample), root, "dwd_user_info")
    gone = {"products": sample_tables.withdrawn_products(spark, sample), "users": sample_tables.withdrawn_users(spark, sample)}
    tables = batch.backfill_metrics_of_changes(spark, root, dates, gone)
    wanted = {r.dt for r in dates.collect()}
    assert len(wanted) > 20
    for name, rows in tables.items():
        assert {r.dt for r in rows.select("dt").distinct().collect()} == wanted, name
        assert rows.schema.names == table_schema(name).names
    from marketloom.plans import sample_queries

    whole = sample_queries.ads_category_share_daily(spark, sample).where("dt < '1995-03-01'")
    assert sorted(map(str, tables["ads_category_share_daily"].collect())) == sorted(map(str, whole.collect()))
    assert read_table(spark, root, "dws_user_profile_daily", max(wanted)).count() > 0
