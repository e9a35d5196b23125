"""Every sample query against its SQL on the smallest sample."""

from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from marketloom.plans import sample_oracle, sample_queries

SQL = sample_oracle.all_sql()


@pytest.fixture(scope="module")
def db(sample):
    connection = duckdb.connect()
    for file in sorted(Path(sample).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    return format(value, "f") if isinstance(value, Decimal) else value


def test_every_statement_belongs_to_a_query():
    assert set(SQL) == set(sample_queries.QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sample, db, name):
    df = driver.queries()[name](spark, sample)
    result = db.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    mine = Counter(tuple(plain(row[c]) for c in names) for row in df.collect())
    assert mine == Counter(tuple(plain(v) for v in row) for row in result.fetchall())


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1


@pytest.fixture(scope="module")
def crowded(spark, sample, tmp_path_factory):
    """The sample with 2,500 lines in two carts: one has a single bad line, the other none."""
    folder = tmp_path_factory.mktemp("crowded")
    for file in Path(sample).glob("*.parquet"):
        if file.stem != "lineitem":
            (folder / file.name).symlink_to(file)
    connection = duckdb.connect()
    keys = "SELECT l_orderkey FROM lines WHERE {} AND l_linenumber = 1 ORDER BY 1 LIMIT 1"
    connection.execute(f"CREATE VIEW lines AS SELECT * FROM '{sample}/lineitem.parquet'")
    bad = connection.execute(keys.format("l_orderkey % 137 = 7 AND NOT " + FLAWED)).fetchone()[0]
    good = connection.execute(keys.format("l_orderkey % 137 <> 7 AND NOT " + FLAWED)).fetchone()[0]
    connection.execute(
        f"COPY (SELECT * FROM lines UNION ALL SELECT lines.* REPLACE (CAST(2 + i % 5 AS INTEGER) AS l_linenumber) FROM lines, range(2500) t(i) "
        f"WHERE l_orderkey IN ({bad}, {good}) AND l_linenumber = 1) TO '{folder}/lineitem.parquet' (FORMAT parquet)"
    )
    return str(folder), bad + 1, good + 1


FLAWED = "(" + " OR ".join(f"l_orderkey % {step} = {rest}" for step, rest in sample_queries.sample.CART_FLAWS.values()) + ")"
BY_CART = ["m03_dwd_order_cart_detail", "m13_kpi_from_feed", "p7_reject_counts", "k13_batch_audit", "s1_batch_rows", "d_quality_report", "d9_quality_summary"]


@pytest.mark.parametrize("name", BY_CART)
def test_a_cart_of_many_lines_is_one_record(spark, crowded, name):
    folder, bad, good = crowded
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    result = connection.execute(SQL[name])
    names = [d[0] for d in result.description]
    rows = driver.queries()[name](spark, folder).select(*names).collect()
    assert Counter(tuple(map(plain, r)) for r in rows) == Counter(tuple(plain(v) for v in r) for r in result.fetchall())
    if name == "m03_dwd_order_cart_detail":
        found = Counter(r.cart_id for r in rows)
        assert found[bad] == 0 and found[good] > 2500
