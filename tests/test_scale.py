"""Steps that must not grow with one task, or read and shuffle their input more than once."""

import random
import re
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketloom.operators import summaries
from marketloom.plans import sample_queries
from marketloom.schemas import columns_of
from marketloom.sources import sample_tables

LINE = "dt STRING, cart_id BIGINT, product_id BIGINT, product_name STRING, category_hint STRING, quantity INT, line_discounted_total DECIMAL(18,2)"
LISTING = "dt STRING, product_id BIGINT, product_name STRING, category STRING, brand STRING"


def day(n):
    return (date(2026, 1, 1) + timedelta(n)).isoformat()


def stored(spark, tmp_path, name, rows, schema):
    path = str(tmp_path / name)
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def random_lines(seed, count=400):
    rng = random.Random(seed)
    some = lambda *values: rng.choice(values)
    rows = [
        (day(rng.randrange(6)), some(None, 1, 2, 3, 4), some(None, 1, 2, 3, 4, 5), some(None, "a", "b"), some(None, "A", "a"), some(None, 1, 2), some(None, "1.50", "2.25"))
        for _ in range(count)
    ]
    return [(*r[:-1], None if r[-1] is None else Decimal(r[-1])) for r in rows] + [(day(0), 1, None, "x", "A", 1, None)]


@pytest.mark.parametrize("seed", range(3))
def test_product_days_of_changes_equal_those_of_a_full_catalogue(spark, seed):
    """Carts with a product in several variants, and without ids, names, hints and amounts."""
    lines = spark.createDataFrame(random_lines(seed), LINE)
    listed = {1: ("one", "C", "B"), 2: (None, "D", None), 3: ("three", "C", "B")}
    changes = [(day(-3), k, *v) for k, v in listed.items()] + [(day(2), 1, "uno", "E", "B"), (day(1), None, "none", "N", "B")]
    gone = [(3, day(1)), (5, day(0))]
    found = summaries.product_daily_as_of(lines, spark.createDataFrame(changes, LISTING), spark.createDataFrame(gone, "product_id BIGINT, dt STRING"))
    catalogue = []
    for n in range(6):
        now = {**listed, 1: ("uno", "E", "B") if n >= 2 else listed[1]}
        catalogue += [(day(n), k, *v) for k, v in now.items() if not (k == 3 and n >= 1)]
    expected = summaries.product_daily(lines, spark.createDataFrame(catalogue, LISTING))
    assert found.columns == expected.columns and [f.dataType for f in found.schema] == [f.dataType for f in expected.schema]
    key = lambda r: str(tuple(r))
    assert sorted(found.collect(), key=key) == sorted(expected.collect(), key=key)


def test_product_days_read_and_deal_out_their_lines_once(spark, tmp_path):
    lines = stored(spark, tmp_path, "lines", random_lines(7), LINE)
    listings = spark.createDataFrame([(day(0), 1, "one", "C", "B")], LISTING)
    text = plan(summaries.product_daily_as_of(lines, listings))
    assert len(re.findall("FileScan parquet", text)) == 1 and "Expand" not in text
    # The lines by their cart, their variants, the versions, and the variants and versions by product.
    assert len(re.findall(r"\bExchange hashpartitioning", text)) <= 5


def test_category_days_read_product_days_once_and_reduce_them_first(spark, tmp_path):
    rows = [(day(0), 1, "p", c, "B", 2, None, 3, day(0)) for c in ("C", "C", None, "D")]
    product_days = stored(spark, tmp_path, "days", rows, columns_of("dws_product_daily").add("dt", "string"))
    listings = spark.createDataFrame([(day(0), 1, "one", "C", "B"), (day(0), 2, "two", "C", "B")], LISTING)
    found = summaries.category_daily_as_of(product_days, listings)
    assert len(re.findall("FileScan parquet", plan(found))) == 1
    assert {(r.category, r.product_count, r.sales_quantity, r.order_count) for r in found.collect()} == {
        ("C", 2, 4, 6), ("D", None, 2, 3), (None, None, 2, 3)
    }


def test_republished_records_are_made_by_all_tasks(spark, tmp_path):
    """The customers lie in one file of few bytes, which one task reads."""
    folder = str(tmp_path)
    spark.range(1).select(F.lit(date(1995, 5, 5)).alias("o_orderdate")).write.parquet(f"{folder}/orders.parquet")
    rows = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).coalesce(1)
    rows.write.parquet(f"{folder}/rows.parquet")
    name = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(name)
    spark.conf.set(name, "1k")
    try:
        made = sample_tables._republished(spark.read.parquet(f"{folder}/rows.parquet"), spark, folder)
        per_task = made.groupBy(F.spark_partition_id().alias("task")).agg(F.count("text").alias("rows"), F.max("text")).collect()
    finally:
        spark.conf.set(name, before)
    assert sum(r["rows"] for r in per_task) == 20_000 and len(per_task) > 1
    assert max(r["rows"] for r in per_task) < 10_000


def test_stored_lines_have_the_columns_that_are_read(spark, sample, monkeypatch):
    class Stored(Exception):
        pass

    def stop(df, name):
        raise Stored(name, df.columns)

    monkeypatch.setattr(sample_queries, "materialise", stop)
    monkeypatch.setattr(sample_queries, "_STORED", {})
    with pytest.raises(Stored) as seen:
        sample_queries.stored_metrics(spark, sample)
    assert seen.value.args == ("dwd_order_cart_detail", list(summaries.LINE_COLUMNS))


def sample_folder(spark, tmp_path):
    """Orders of two years, one of them without lines and one with 2,500, and what they name."""
    keys, noon = range(8, 28), datetime(1995, 5, 5, 12)
    lines = [(k, 10 + k % 3, n, 2.0, 3.5 + k, 0.05, "N", "O") for k in keys if k != 9 for n in range(1, 2501 if k == 10 else 4)]
    made = {
        "orders": ([(k, 8 + k % 4, 10.0 + k, noon.replace(year=1995 + k % 2)) for k in keys], "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderdate TIMESTAMP"),
        "lineitem": (lines, "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_returnflag STRING, l_linestatus STRING"),
        "part": ([(k, f"p{k}", "B", "T", k, 1.5) for k in range(10, 16)], "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"),
        "customer": ([(k, f"c{k}", 0, "M") for k in range(8, 12)], "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING"),
        "nation": ([(0, "N", 0)], "n_nationkey INT, n_name STRING, n_regionkey INT"),
        "region": ([(0, "R")], "r_regionkey INT, r_name STRING"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_backfilled_feeds_are_landed_compressed(spark, tmp_path, monkeypatch):
    folder, root = sample_folder(spark, tmp_path), tmp_path / "landed"
    monkeypatch.setattr(sample_queries, "_scratch", lambda *_: str(root))
    audit = {(r.feed, r.dt): (r.read, r.written, r.invalid) for r in sample_queries.backfilled_batches(spark, folder).collect()}
    assert {p.suffix for p in (root / "ods").rglob("part-*") if "_landed" not in str(p)} == {".gz"}
    years = {"1995-01-01": (12, 2527, 0), "1996-01-01": (10, 27, 1)}
    assert audit == {(s, y): counts for y, carts in years.items() for s, counts in (("carts", carts), ("products", (6, 6, 0)), ("users", (4, 4, 0)))}


def test_lines_are_dealt_out_before_their_texts_are_made(spark, tmp_path):
    text = plan(sample_tables.cart_envelopes(spark, sample_folder(spark, tmp_path), "year"))
    between = re.search(r"StructsToJson(.*?)FileScan parquet \[l_orderkey#\d+L?,l_partkey", text, re.DOTALL)
    assert "Join" in between[1]
