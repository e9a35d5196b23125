import json
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from marketloom.errors import BatchError, DataNotFound
from marketloom.functions import display
from marketloom.functions.text import is_batch_date
from marketloom.operators import contracts, quality, serving
from marketloom.schemas import METRICS, schema_of, table_schema
from marketloom.sinks import snapshots
from marketloom.sinks import serving as published
from marketloom.sinks.tables import align_to_schema
from marketloom.sources import envelopes, payloads

DAY = "2026-07-01"
D = Decimal


def metric_rows():
    return {
        "ads_kpi_daily": [(DAY, D("733.20"), 6, 4, D("122.20"), D("1.0000"), DAY)],
        "ads_sales_trend_daily": [(DAY, D("733.20"), 6, 4, DAY)],
        "ads_product_rank_daily": [(DAY, 1, 3107, "Walnut stool", "seating", 9, D("733.20"), DAY)],
        "ads_category_share_daily": [(DAY, "seating", D("733.20"), 9, D("1.0000"), DAY)],
        "ads_user_profile_daily": [(DAY, "country", "Portugal", 7, 4, D("733.20"), DAY)],
        "ads_funnel_daily": [(DAY, "order", 2, 6, D("1.0000"), DAY)],
    }


def frames(spark, **changes):
    return {t: spark.createDataFrame(rows, table_schema(t)) for t, rows in {**metric_rows(), **changes}.items()}


def feeds(spark):
    return {s: spark.createDataFrame([("x", DAY)], "data STRING, dt STRING") for s in ("products", "carts", "users")}


def report(spark, **changes):
    rules = quality.quality_rules(feeds(spark), frames(spark, **changes), spark.createDataFrame([(DAY,)], "dt STRING"))
    rows = {r.name: r for r in rules.collect()}
    return rows, quality.quality_summary(rules).first()


def test_valid_batch_passes_all_rules(spark):
    rules, summary = report(spark)
    assert len(rules) == 26 and (summary.total_rules, summary.failed, summary.status) == (26, 0, "passed")


def test_negative_sales_fail_the_batch(spark):
    rules, summary = report(spark, ads_kpi_daily=[(DAY, D("-7.50"), 6, 4, D("122.20"), D("1.0000"), DAY)])
    assert rules["ads_kpi_daily_sales_non_negative"].status == "failed"
    assert (summary.failed_critical, summary.status) == (1, "failed")


def test_share_sum_is_only_a_warning(spark):
    rules, summary = report(spark, ads_category_share_daily=[(DAY, "seating", D("3"), 9, D("0.6400"), DAY)])
    assert rules["ads_category_share_daily_share_sum_near_one"].status == "failed"
    assert (summary.failed, summary.failed_critical, summary.status) == (1, 0, "passed")


def test_rules_on_missing_and_repeated_rows(spark):
    twice = metric_rows()["ads_kpi_daily"] * 2
    rules, _ = report(spark, ads_kpi_daily=twice, ads_funnel_daily=[], ads_category_share_daily=[])
    assert rules["ads_kpi_daily_single_row"].status == "failed"
    assert "ads_kpi_daily_sales_non_negative" not in rules
    assert rules["ads_funnel_daily_snapshot_non_empty"].status == "failed"
    assert not [n for n in rules if n.startswith("ads_funnel_daily_stage")]
    assert len(rules) == 26 - 5 - 3 - 4


def test_rank_rules(spark):
    rank = metric_rows()["ads_product_rank_daily"][0]
    rules, _ = report(spark, ads_product_rank_daily=[rank, rank])
    assert rules["ads_product_rank_daily_rank_no_unique"].message == "rank_no contains duplicates"
    rules, _ = report(spark, ads_product_rank_daily=[(DAY, None, *rank[2:])])
    assert rules["ads_product_rank_daily_rank_no_unique"].message == "rank_no contains non-positive values"
    rules, _ = report(spark, ads_product_rank_daily=[(DAY, n, *rank[2:]) for n in range(1, 12)])
    assert rules["ads_product_rank_daily_row_count"].status == "failed"


def test_null_measures_count_as_zero(spark):
    rules, _ = report(spark, ads_funnel_daily=[(DAY, "cart", 1, None, None, DAY)])
    assert rules["ads_funnel_daily_conversion_rate_range"].status == "passed"


def violations(spark, **changes):
    found = contracts.contract_violations(frames(spark, **changes))
    return {(r.table_name, r.constraint_name): r.violations for r in found.where("violations > 0").collect()}


def test_contract_of_a_valid_batch(spark):
    assert violations(spark) == {}
    contracts.require_contract(frames(spark))


def test_contract_violations(spark):
    share = metric_rows()["ads_category_share_daily"][0]
    variants = [(DAY, c, *share[2:]) for c in ("seating", "SEATING", "séating", "seating ", "other")]
    found = violations(
        spark,
        ads_category_share_daily=variants,
        ads_product_rank_daily=[(DAY, 1, 5, "n" * 256, "c" * 129, 1, None, DAY)],
    )
    assert found == {
        ("ads_category_share_daily", "primary_key"): 3,
        ("ads_product_rank_daily", "not_null(sales_amount)"): 1,
        ("ads_product_rank_daily", "length(product_name)"): 1,
        ("ads_product_rank_daily", "length(category)"): 1,
    }


def test_unknown_serving_table_is_refused(spark):
    with pytest.raises(ValueError):
        contracts.serving_rows("users", spark.range(1))


def test_broken_batch_leaves_the_published_one(spark, tmp_path):
    root = str(tmp_path)
    published.publish(frames(spark), root, DAY)
    bad = frames(spark, ads_funnel_daily=[(DAY, "cart", 1, None, D("1"), DAY)], ads_sales_trend_daily=[(DAY, D("7"), 1, 1, DAY)])
    with pytest.raises(BatchError, match="not_null"):
        published.publish(bad, root, DAY)
    served = published.read_all_served(spark, root)
    assert served["ads_sales_trend_daily"].first().sales_amount == D("733.20")
    published.publish(frames(spark, ads_sales_trend_daily=[(DAY, D("8.00"), 1, 1, DAY)]), root, DAY)
    assert [r.sales_amount for r in published.read_served(spark, root, "ads_sales_trend_daily").collect()] == [D("8.00")]
    with pytest.raises(ValueError):
        published.publish({"ads_kpi_daily": frames(spark)["ads_kpi_daily"]}, root, DAY)


def test_latest_date_and_missing_sections(spark):
    tables = frames(spark, ads_sales_trend_daily=[("2026-07-03", D("1"), 1, 1, "2026-07-03")])
    assert serving.latest_date(tables).first().date_id == "2026-07-03"
    with pytest.raises(DataNotFound):
        serving.kpi(tables)
    with pytest.raises(DataNotFound):
        serving.overview(tables, DAY)
    assert serving.overview_sections(tables).isEmpty()
    empty = {t: df.limit(0) for t, df in tables.items()}
    with pytest.raises(DataNotFound):
        serving.resolve_date(empty)


def test_overview_of_a_complete_date(spark):
    answer = {(r.date_id, r.section, r.item_no): json.loads(r.item) for r in serving.overview(frames(spark)).collect()}
    assert answer[DAY, "kpi", 1]["avg_order_amount"] == 122.2
    assert answer[DAY, "product_rank", 1] == {
        "rank_no": 1, "product_id": 3107, "product_name": "Walnut stool", "category": "seating", "sales_quantity": 9, "sales_amount": 733.2
    }
    assert len(answer) == len(serving.SECTIONS)
    assert {r.section for r in serving.overview_sections(frames(spark)).collect()} == set(serving.SECTIONS)


def test_share_slices(spark):
    rows = [(DAY, f"c{n}", D(9000 - n), 10, D("0.1000"), DAY) for n in range(6)]
    six = spark.createDataFrame(rows, table_schema("ads_category_share_daily"))
    assert serving.share_slices(six).count() == 6
    more = rows + [(DAY, "c6", D(5000), 40, D("0.0150"), DAY), (DAY, "c7", D(3000), 27, D("0.0050"), DAY)]
    slices = serving.share_slices(spark.createDataFrame(more, table_schema("ads_category_share_daily"))).orderBy("slice_no").collect()
    assert [r.category for r in slices] == [f"c{n}" for n in range(6)] + ["其他"]
    assert (slices[-1].sales_amount, slices[-1].sales_quantity, slices[-1].sales_share) == (D("8000.00"), 67, D("0.0200"))


def test_display_text_rounds_the_binary_value(spark):
    values = ["1234567.89", "3420", "0.374", "0.1235", "0.0625", "0.0675", "1", "10050", "12350.00", "9999.99", "10000", "0", "-12345.67"]
    df = spark.createDataFrame([(v, D(v)) for v in values], "t STRING, v DECIMAL(18,4)")
    rows = df.select("t", display.percent_text(F.col("v")).alias("p"), display.money_text(F.col("v")).alias("m")).collect()

    def fixed(number, digits):
        return str(D(number).quantize(D(1).scaleb(-digits), rounding=ROUND_HALF_UP))

    for row in rows:
        number = float(row.t)
        assert row.p == fixed(number * 100, 1) + "%"
        assert row.m == (fixed(number / 10000, 2) + " 万" if abs(number) >= 10000 else f"{number:,.2f}")
    texts = {r.t: r for r in rows}
    assert texts["1234567.89"].m == "123.46 万" and texts["0.374"].p == "37.4%"
    assert spark.range(1).select(display.count_text(F.lit(3420))).first()[0] == "3,420"
    assert spark.range(1).select(display.money_text(F.lit(None).cast("double"))).first()[0] == "0.00"


def line(**changes):
    record = {"entity": "user", "source": "users", "batch_date": DAY, "data": '{"id": 1}'}
    record.update(changes)
    return json.dumps({k: v for k, v in record.items() if v is not ...}, ensure_ascii=False)


def test_landed_contract(spark):
    cases = [
        (line(), None),
        (line(data="[1]"), None),
        ("  ", "blank_line"),
        ("{bad", "invalid_json"),
        (line() + "x", "invalid_json"),
        (line(entity=...), "missing_entity"),
        (line(data=...), "missing_data"),
        (line(entity="product"), "entity_mismatch"),
        (line(source="Users"), "source_mismatch"),
        (line(batch_date="2026-07-02"), "batch_date_mismatch"),
        (line(data={"id": 1}), "data_not_text"),
        (line(data="{bad"), "data_not_json"),
        (line(data='{"id": 1} x'), "data_not_json"),
    ]
    df = spark.createDataFrame([(text,) for text, _ in cases], "value STRING")
    checked = envelopes.contract_checked(df, "users", F.lit(DAY))
    assert [r.violation for r in checked.collect()] == [v for _, v in cases]
    assert {r.violation for r in envelopes.contract_violations(df, "users", F.lit(DAY)).collect()} == {v for _, v in cases if v}


def test_payloads(spark):
    rows = [
        ("products", DAY, '{"products": [{"id": 1, "price": 1.0, "t": "é"}, {"id": 2}], "total": 2}'),
        ("products", DAY, '{"items": []}'),
        ("carts", DAY, '{"carts": "none"}'),
        ("users", DAY, '{"users": []}'),
    ]
    pages = spark.createDataFrame(rows, "source STRING, batch_date STRING, payload STRING")
    flat = payloads.flatten_payloads(pages).collect()
    assert [(r.entity, r.source, json.loads(r.data)) for r in flat] == [
        ("product", "products", {"id": 1, "price": 1.0, "t": "é"}), ("product", "products", {"id": 2})
    ]
    assert '"price":1.0' in flat[0].data
    assert {r.source for r in payloads.broken_payloads(pages).collect()} == {"products", "carts"}


def test_batch_dates(spark):
    texts = ["2026-07-01", "2026-02-30", "20260701", "2026-7-1", " 2026-07-01", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    assert [r[0] for r in df.select(is_batch_date(F.col("t"))).collect()] == [True] + [False] * 6


def test_snapshot_keeps_nulls_and_unicode(spark, tmp_path):
    rank = (DAY, 1, 5, '键盘 "x"\\', None, 2, None, DAY)
    df = spark.createDataFrame([rank], table_schema("ads_product_rank_daily"))
    text = snapshots.snapshot_lines(df).first().line
    names = table_schema("ads_product_rank_daily").names
    assert text == json.dumps(dict(zip(names, rank)), ensure_ascii=False, sort_keys=True)
    assert snapshots.write_snapshot(df, str(tmp_path), DAY, "ads_product_rank_daily") == 1
    back = snapshots.read_snapshot(spark, str(tmp_path), DAY, "ads_product_rank_daily").first()
    assert tuple(back) == rank
    with pytest.raises(Exception):
        snapshots.read_snapshots(spark, str(tmp_path), DAY)


def test_schema_alignment(spark):
    df = spark.createDataFrame([("x", 1, "d")], "extra STRING, product_count INT, dt STRING")
    aligned = align_to_schema(df, schema_of("category_id STRING, product_count BIGINT, dt STRING"))
    assert aligned.dtypes == [("category_id", "string"), ("product_count", "bigint"), ("dt", "string"), ("extra", "string")]
    assert tuple(aligned.first()) == (None, 1, "d", "x")


def test_every_metric_table_is_checked():
    assert set(metric_rows()) == set(METRICS)
