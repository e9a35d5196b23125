import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketloom.errors import BatchError, DataNotFound
from marketloom.operators import quality, serving as queries
from marketloom.plans import batch, landing
from marketloom.schemas import FEEDS, METRICS
from marketloom.sinks import serving, snapshots, tables
from marketloom.sources import payloads
from marketloom.sources.envelopes import read_batch
from marketloom.sources.payloads import read_payloads

DAY = "2026-07-01"


def write_payloads(folder, products, users, carts):
    for name, items in (("products", products), ("users", users), ("carts", carts)):
        path = Path(folder) / name
        path.mkdir(parents=True, exist_ok=True)
        text = items if isinstance(items, str) else json.dumps({name: items, "total": len(items)}, ensure_ascii=False)
        (path / "page-1.json").write_text(text, encoding="utf-8")


def pages(spark, folder):
    return {s: read_payloads(spark, f"{folder}/{s}", s, DAY) for s in ("products", "users", "carts")}


PRODUCTS = [
    {"id": 1, "title": "Phone", "price": 10.0, "category": "tech", "brand": "Acme", "stock": 3},
    {"id": 2, "title": "键盘", "price": 5, "category": " ", "brand": None},
    {"id": 3, "title": "Broken", "price": -1},
]
USERS = [
    {"id": 1, "username": "ann", "gender": "female", "age": 28, "address": {"country": "A"}},
    {"id": 2, "username": "bob", "gender": "male", "age": 40},
    {"id": True, "username": "bad"},
]
CARTS = [
    {
        "id": 10, "userId": 1, "total": 30, "discountedTotal": 27.5, "totalProducts": 2, "totalQuantity": 3,
        "products": [
            {"id": 1, "title": "Phone", "price": 10, "quantity": 2, "total": 20, "discountedTotal": 18},
            {"id": 7, "title": "Lamp", "price": 10, "quantity": 1, "total": 10, "discountedTotal": 9.5,
             "thumbnail": "https://x/product-images/home/7.webp"},
        ],
    },
    {
        "id": 11, "userId": 1, "total": 5, "discountedTotal": 5, "totalQuantity": 1,
        "products": [{"id": 2, "title": "K", "price": 5, "quantity": 1, "total": 5, "discountedTotal": 5}],
    },
    {"id": 12, "userId": 2, "products": []},
]


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    feed = str(tmp_path_factory.mktemp("feed"))
    write_payloads(feed, PRODUCTS, USERS, CARTS)
    landing.land_payloads(pages(spark, feed), root, DAY)
    return root, feed, batch.run_batch(spark, root, DAY)


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_audit_and_exports(done):
    _, _, result = done
    assert rows(result["audit"], "feed", "read", "written", "invalid") == [
        ("carts", 3, 3, 1), ("products", 3, 2, 1), ("users", 3, 2, 1)
    ]
    assert dict(rows(result["exported"], "table_name", "exported")) == {
        "ads_kpi_daily": 1, "ads_sales_trend_daily": 1, "ads_product_rank_daily": 3, "ads_category_share_daily": 3,
        "ads_user_profile_daily": 6, "ads_funnel_daily": 3,
    }


def test_quality_report_has_all_rules(spark, done):
    _, _, result = done
    assert result["rules"].count() == 26
    summary = quality.quality_summary(result["rules"]).first()
    assert (summary.total_rules, summary.failed, summary.status) == (26, 0, "passed")


def test_quality_document(spark, done):
    root, _, _ = done
    document = spark.read.json(f"{root}/quality/{DAY}/report").first()
    assert (document.batch_date, document.status, document.summary.total_rules) == (DAY, "passed", 26)
    assert document.rules[0].name == "processed_products_non_empty" and len(document.rules) == 26
    assert document.rules[-1].name == "ads_category_share_daily_share_sum_near_one"


def test_backfill_gives_what_single_batches_give(spark, done, tmp_path):
    root, feed, _ = done
    other, dates = str(tmp_path), batch.batch_dates(spark, DAY, "2026-07-02", "2026-07-03")
    for day in (DAY, "2026-07-02"):
        dated = {s: p.withColumn("batch_date", F.lit(day)) for s, p in pages(spark, feed).items()}
        landing.land_payloads(dated, other, day)
    audit = batch.backfill_details(spark, other, dates)
    assert rows(audit, "dt", "feed", "read", "written", "invalid") == [
        (day, feed, 3, n, 1) for day in (DAY, "2026-07-02") for feed, n in (("carts", 3), ("products", 2), ("users", 2))
    ]
    for source, feed in FEEDS.items():
        one, many = (tables.read_table(spark, r, feed.detail_table, DAY).drop("batch_date") for r in (root, other))
        assert sorted(map(str, one.collect())) == sorted(map(str, many.collect())), source
    batch.backfill_metrics(spark, other, dates)
    for table in METRICS:
        built, single = tables.read_table(spark, other, table), tables.read_table(spark, root, table)
        columns = [c for c in built.columns if c not in ("date_id", "dt")]
        for day in (DAY, "2026-07-02"):
            assert rows(built.where(F.col("dt") == day), *columns) == rows(single, *columns)
    assert tables.read_table(spark, other, "ads_funnel_daily", "2026-07-03").count() == 3
    assert tables.read_table(spark, other, "dws_product_daily", "2026-07-03").isEmpty()


def test_served_answers(spark, done):
    root, _, _ = done
    served = serving.read_all_served(spark, root)
    kpi = queries.kpi(served).first()
    assert (str(kpi.total_sales_amount), kpi.total_order_count, kpi.paid_user_count, str(kpi.avg_order_amount)) == (
        "35.00", 2, 1, "16.25"
    )
    ranks = queries.item_list(served, "product_rank", DAY).collect()
    assert [(r.rank_no, r.product_id, r.category, str(r.sales_amount)) for r in ranks] == [
        (1, 1, "tech", "18.00"), (2, 7, "home", "9.50"), (3, 2, "unknown", "5.00")
    ]
    answer = queries.overview(served).orderBy("section", "item_no").collect()
    assert answer == queries.overview(served, DAY).orderBy("section", "item_no").collect()
    items = {name: [json.loads(r.item) for r in answer if r.section == name] for name in queries.SECTIONS}
    assert {r.date_id for r in answer} == {DAY} and [i["total_sales_amount"] for i in items["kpi"]] == [35.0]
    assert [i["category"] for i in items["category_share"]] == ["tech", "home", "unknown"]
    assert [i["stage_name"] for i in items["funnel"]] == ["cart", "order", "payment"]
    assert [(i["dimension_type"], i["dimension_value"]) for i in items["user_profile"]] == [
        ("age_group", "25-34"), ("age_group", "35-44"), ("country", "A"), ("country", "unknown"),
        ("gender", "female"), ("gender", "male"),
    ]
    with pytest.raises(DataNotFound):
        queries.kpi(served, "2020-01-01")
    with pytest.raises(ValueError):
        queries.kpi(served, "1 OR 1=1")


def test_running_again_changes_nothing(spark, done):
    root, feed, _ = done
    before = {t: rows(tables.read_table(spark, root, t), *tables.read_table(spark, root, t).columns) for t in METRICS}
    landing.land_payloads(pages(spark, feed), root, DAY)
    batch.run_batch(spark, root, DAY)
    for table, old in before.items():
        again = tables.read_table(spark, root, table)
        assert rows(again, *again.columns) == old
        served = serving.read_served(spark, root, table)
        assert served.count() == len(old)


def test_snapshot_text(spark, done):
    root, _, _ = done
    files = sorted(Path(f"{root}/snapshots/{DAY}/ads_funnel_daily").glob("part-*"))
    lines = [line for f in files for line in f.read_text(encoding="utf-8").splitlines()]
    expected = [
        {"conversion_rate": rate, "date_id": DAY, "dt": DAY, "stage_count": 2, "stage_name": name, "stage_order": n}
        for rate, name, n in (("0.0000", "cart", 1), ("1.0000", "order", 2), ("1.0000", "payment", 3))
    ]
    assert lines == sorted(json.dumps(e, ensure_ascii=False, sort_keys=True) for e in expected)


def test_landing_is_all_or_nothing(spark, tmp_path):
    write_payloads(tmp_path / "feed", PRODUCTS, USERS, '{"carts": "none"}')
    with pytest.raises(BatchError):
        landing.land_payloads(pages(spark, tmp_path / "feed"), str(tmp_path / "root"), DAY)
    assert not (tmp_path / "root").exists()


def test_source_without_valid_rows_fails_and_keeps_old_data(spark, done, tmp_path):
    root, _, _ = done
    write_payloads(tmp_path / "feed", [{"id": 0}], USERS, CARTS)
    landing.land_payloads(pages(spark, tmp_path / "feed"), root, DAY)
    with pytest.raises(BatchError, match="no valid products"):
        batch.run_details(spark, root, DAY)
    assert tables.read_table(spark, root, "dwd_product_info", DAY).count() == 2
    with pytest.raises(BatchError):
        batch.run_details(spark, root, "2026-07-02")


def test_empty_result_clears_only_its_partition(spark, tmp_path):
    root = str(tmp_path)
    two = spark.createDataFrame([("a", "A", 1, "d1"), ("b", "B", 2, "d2")], "category_id STRING, category_name STRING, product_count BIGINT, dt STRING")
    tables.replace_partitions(two, root, "dim_category")
    tables.replace_partition(two.where("dt = 'none'"), root, "dim_category", "d1")
    assert rows(tables.read_table(spark, root, "dim_category"), "category_id", "dt") == [("b", "d2")]
    tables.replace_partitions(two.where("dt = 'd1'"), root, "dim_category")
    assert rows(tables.read_table(spark, root, "dim_category"), "category_id", "dt") == [("a", "d1"), ("b", "d2")]
    dates = spark.createDataFrame([("d1",), ("d2",), ("d3",)], "dt STRING")
    tables.replace_partitions(two.where("dt = 'd1'"), root, "dim_category", dates)
    assert rows(tables.read_table(spark, root, "dim_category"), "category_id", "dt") == [("a", "d1")]


@pytest.mark.parametrize("day", ["2026-02-30", "2026-7-1", "20260701", "../evil", "", "2026-07-01 "])
def test_only_calendar_days_are_batches(spark, tmp_path, day):
    root = str(tmp_path / "root")
    write_payloads(tmp_path / "feed", PRODUCTS, USERS, CARTS)
    for start in (landing.land_payloads, lambda _, r, d: batch.run_batch(spark, r, d), lambda _, r, d: batch.run_details(spark, r, d)):
        with pytest.raises(ValueError):
            start(pages(spark, tmp_path / "feed"), root, day)
    assert not (tmp_path / "root").exists()


def test_foreign_pages_are_refused_before_any_write(spark, tmp_path):
    write_payloads(tmp_path / "feed", PRODUCTS, USERS, CARTS)
    given = pages(spark, tmp_path / "feed")
    for source, column, value in (("users", "batch_date", "2026-07-02"), ("carts", "source", "users"), ("carts", "batch_date", None)):
        mixed = {**given, source: given[source].withColumn(column, F.lit(value).cast("string"))}
        with pytest.raises(BatchError):
            landing.land_payloads(mixed, str(tmp_path / "root"), DAY)
    assert not (tmp_path / "root").exists()


def test_raw_pages_can_be_landed_again(spark, tmp_path):
    root, again = str(tmp_path / "root"), str(tmp_path / "again")
    text = json.dumps({"products": [{"id": 5, "title": "a\nb"}]}, indent=1)
    page = [("products", DAY, text), ("products", DAY, text.replace("5", "6"))]
    land = {"products": spark.createDataFrame(page, "source STRING, batch_date STRING, payload STRING").coalesce(1)}
    landing.land_payloads(land, root, DAY)
    raw = payloads.read_raw(spark, root, "products", DAY)
    assert sorted(r.payload for r in raw.collect()) == sorted(p[2] for p in page)
    landing.land_payloads({"products": raw}, again, DAY)
    first, second = (read_batch(spark, r, "products", DAY) for r in (root, again))
    assert first.count() == 2 and first.exceptAll(second).isEmpty()


def test_quality_goes_on_without_a_readable_input(spark, done, tmp_path):
    root, feed, _ = done
    other = str(tmp_path / "root")
    landing.land_payloads(pages(spark, feed), other, DAY)
    everything = {r.name: r.status for r in batch.check_quality(spark, other, DAY).collect()}
    assert sum(n.endswith("snapshot_non_empty") for n, s in everything.items() if s == "failed") == 6
    assert all(s == "passed" for n, s in everything.items() if n.startswith("processed"))
    batch.run_batch(spark, other, DAY)
    with open(next(Path(f"{other}/snapshots/{DAY}/ads_kpi_daily").glob("part-*")), "a", encoding="utf-8") as file:
        file.write("{broken\n")
    rules = {r.name: r.status for r in batch.check_quality(spark, other, DAY).collect()}
    assert rules["ads_kpi_daily_snapshot_non_empty"] == "failed" and rules["ads_funnel_daily_snapshot_non_empty"] == "passed"
    with pytest.raises(BatchError, match="unreadable"):
        snapshots.read_snapshots(spark, other, DAY)
    assert {r.input for r in batch.unreadable_inputs(spark, other, DAY).collect()} == {"ads_kpi_daily"}


@pytest.mark.parametrize("with_sums", [True, False])
def test_a_damaged_file_fails_only_its_own_rule(spark, done, tmp_path, with_sums):
    """A changed file under its checksum fails when it is read; without one its line is broken."""
    root, feed, _ = done
    other = str(tmp_path / "root")
    landing.land_payloads(pages(spark, feed), other, DAY)
    batch.run_batch(spark, other, DAY)
    landed = next(Path(f"{other}/ods/users").glob(f"version=*/dt={DAY}/part-*.json"))
    metric = next(Path(f"{other}/snapshots/{DAY}/ads_funnel_daily").glob("part-*"))
    for file in (landed, metric):
        file.write_bytes(file.read_bytes().replace(b"user", b"\xff\xfe{") + b"{cut")
        sums = file.with_name(f".{file.name}.crc")
        if not with_sums:
            sums.unlink()
    rules = {r.name: r.status for r in batch.check_quality(spark, other, DAY).collect()}
    failed = {n for n, s in rules.items() if s == "failed"}
    wanted = {"ads_funnel_daily_snapshot_non_empty"} | ({"processed_users_non_empty"} if with_sums else set())
    assert wanted <= failed and not failed & {"processed_products_non_empty", "ads_kpi_daily_snapshot_non_empty"}
    names = {r.input for r in batch.unreadable_inputs(spark, other, DAY).collect()}
    assert names == {"ads_funnel_daily"} | ({"users"} if with_sums else set())


def test_unreadable_files_are_found_by_halves(spark, tmp_path):
    from marketloom.sources.isolated import seen_and_listed, unreadable_files

    spark.range(80).repartition(8).write.json(str(tmp_path / "x"))
    files = sorted(str(f) for f in (tmp_path / "x").glob("part-*"))
    assert unreadable_files(spark, files, lambda fs: spark.read.schema("id BIGINT").json(fs)) == []
    for file in (files[2], files[6]):
        Path(file).write_text("{damaged", encoding="utf-8")
    assert unreadable_files(spark, files, lambda fs: spark.read.schema("id BIGINT").json(fs)) == [files[2], files[6]]
    seen, listed = seen_and_listed(spark.read.schema("id BIGINT").json([f for f in files if f not in (files[2], files[6])]))
    assert seen == listed == 6


def test_landing_is_seen_as_a_whole(spark, tmp_path, monkeypatch):
    """A run that ends before its last source shows none of its batches, and the one before stays."""
    from marketloom.sinks import versions

    root = str(tmp_path / "root")
    write_payloads(tmp_path / "feed", PRODUCTS, USERS, CARTS)
    landing.land_payloads(pages(spark, tmp_path / "feed"), root, DAY)
    write_payloads(tmp_path / "feed", PRODUCTS[:1], USERS[:1], CARTS[:1])
    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            landing.land_payloads(pages(spark, tmp_path / "feed"), root, DAY)
    assert [read_batch(spark, root, s, DAY).count() for s in ("products", "users", "carts")] == [3, 3, 3]
    assert payloads.read_raw(spark, root, "carts", DAY).count() == 1
    landing.land_payloads(pages(spark, tmp_path / "feed"), root, DAY)
    assert [read_batch(spark, root, s, DAY).count() for s in ("products", "users", "carts")] == [1, 1, 1]
    with pytest.raises(BatchError, match="has not landed"):
        read_batch(spark, root, "users", "2026-07-09")


def test_versions_can_be_read_until_they_are_removed(spark, tmp_path):
    root = str(tmp_path)
    two = spark.createDataFrame([("a", "A", 1, "d1"), ("b", "B", 2, "d2")], "category_id STRING, category_name STRING, product_count BIGINT, dt STRING")
    first = tables.replace_partitions(two, root, "dim_category")
    second = tables.replace_partitions(two.where("dt = 'd1'").withColumn("product_count", F.lit(5).cast("bigint")), root, "dim_category", spark.createDataFrame([("d2",)], "dt STRING"))
    third = tables.replace_partition(two.where("dt = 'd2'"), root, "dim_category", "d2")
    read = lambda as_of=None: rows(tables.read_table(spark, root, "dim_category", None, as_of), "category_id", "product_count")
    assert read(first) == [("a", 1), ("b", 2)] and read(second) == [("a", 5)] and read(third) == read() == [("a", 5), ("b", 2)]
    from marketloom.sinks import versions

    base, log = tables.table_path(root, "dim_category"), tables.manifest_path(root, "dim_category")
    stray = Path(versions.version_path(base, "20000101T000000000000-dead")) / "dt=d9"
    stray.mkdir(parents=True)
    running = tables.read_table(spark, root, "dim_category")
    assert versions.vacuum(spark, log, {"dim_category": base}, "dt", second) == 3  # both first batches and the stray one
    assert read(second) == [("a", 5)] and read() == [("a", 5), ("b", 2)] and running.count() == 2
    assert versions.vacuum(spark, log, {"dim_category": base}, "dt", second) == 0
    assert len(list(Path(log).glob("part-*"))) == 4
    assert versions.vacuum(spark, log, {"dim_category": base}, "dt", versions.new_version()) == 0
    assert len(list(Path(log).glob("part-*"))) == 1 and read() == [("a", 5), ("b", 2)]


def test_a_backfill_without_valid_records_changes_nothing(spark, done, tmp_path):
    root, feed, _ = done
    dates = batch.batch_dates(spark, DAY)
    other = str(tmp_path / "root")
    landing.land_payloads(pages(spark, feed), other, DAY)
    batch.backfill_details(spark, other, dates)
    write_payloads(tmp_path / "feed", PRODUCTS, [{"id": 0}], CARTS)
    landing.land_payloads(pages(spark, tmp_path / "feed"), other, DAY)
    with pytest.raises(BatchError, match=DAY):
        batch.backfill_details(spark, other, dates)
    assert tables.read_table(spark, other, "dwd_user_info", DAY).count() == 2
    assert tables.read_table(spark, other, "dwd_order_cart_detail").count() == 3

