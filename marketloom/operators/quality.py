"""The data-quality rules, evaluated for every batch date in one job.

Each checked table is reduced to one row of measures per date; the rows are merged per date and
turned into one row per rule. Rules on the rows of an empty table, and the value rules of a KPI table
that does not have exactly one row, are not evaluated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.numbers import number_or_zero
from marketloom.schemas import FEEDS, METRICS

CRITICAL, WARNING = "critical", "warning"
FEED_ORDER = ("products", "carts", "users")

# Fixed values: (rule, KPI column, smallest, largest).
KPI_RANGES = (
    ("ads_kpi_daily_sales_non_negative", "total_sales_amount", 0.0, None),
    ("ads_kpi_daily_order_count_positive", "total_order_count", 1.0, None),
    ("ads_kpi_daily_paid_user_count_non_negative", "paid_user_count", 0.0, None),
    ("ads_kpi_daily_avg_order_amount_non_negative", "avg_order_amount", 0.0, None),
    ("ads_kpi_daily_payment_conversion_rate_range", "payment_conversion_rate", 0.0, 1.0),
)
# Fixed values: (rule, table, column, smallest, largest); every row must comply.
ROW_RANGES = (
    ("ads_product_rank_daily_sales_quantity_non_negative", "ads_product_rank_daily", "sales_quantity", 0.0, None),
    ("ads_product_rank_daily_sales_amount_non_negative", "ads_product_rank_daily", "sales_amount", 0.0, None),
    ("ads_category_share_daily_sales_quantity_non_negative", "ads_category_share_daily", "sales_quantity", 0.0, None),
    ("ads_category_share_daily_sales_amount_non_negative", "ads_category_share_daily", "sales_amount", 0.0, None),
    ("ads_category_share_daily_share_range", "ads_category_share_daily", "sales_share", 0.0, 1.0),
    ("ads_funnel_daily_stage_count_non_negative", "ads_funnel_daily", "stage_count", 0.0, None),
    ("ads_funnel_daily_conversion_rate_range", "ads_funnel_daily", "conversion_rate", 0.0, 1.0),
)
# Fixed values: (rule, table, column); values must be positive and differ.
UNIQUE_NUMBERS = (
    ("ads_product_rank_daily_rank_no_unique", "ads_product_rank_daily", "rank_no"),
    ("ads_funnel_daily_stage_order_unique", "ads_funnel_daily", "stage_order"),
)
RANK_ROWS = ("ads_product_rank_daily_row_count", "ads_product_rank_daily", 1, 10)
SHARE_SUM = ("ads_category_share_daily_share_sum_near_one", "ads_category_share_daily", "sales_share", 0.95, 1.05)


def _name(table: str, measure: str) -> str:
    return f"{table}__{measure}"


def _measures(table: str, rows: DataFrame) -> DataFrame:
    """One row per date with everything the rules of ``table`` look at."""
    wanted: dict[str, Column] = {_name(table, "rows"): F.count(F.lit(1))}
    ranged = [column for _, column, _, _ in KPI_RANGES] if table == "ads_kpi_daily" else []
    ranged += [column for _, owner, column, _, _ in ROW_RANGES if owner == table]
    for column in ranged:
        wanted[_name(table, f"{column}_min")] = F.min(number_or_zero(F.col(column)))
        wanted[_name(table, f"{column}_max")] = F.max(number_or_zero(F.col(column)))
    for _, owner, column in UNIQUE_NUMBERS:
        if owner == table:
            number = number_or_zero(F.col(column)).cast("bigint")
            wanted[_name(table, f"{column}_min")] = F.min(number).cast("double")
            wanted[_name(table, f"{column}_distinct")] = F.countDistinct(number)
    if table == SHARE_SUM[1]:
        wanted[_name(table, "share_sum")] = F.sum(F.coalesce(F.col(SHARE_SUM[2]).try_cast("decimal(10,4)"), F.lit(0)))
    return rows.groupBy("dt").agg(*[value.alias(name) for name, value in wanted.items()])


def _rule(name: str, severity: str, passed: Column, good: Column, bad: Column, applies: Column | None = None) -> Column:
    passed = F.coalesce(passed, F.lit(False))
    row = F.struct(
        F.lit(name).alias("name"),
        F.lit(severity).alias("severity"),
        F.when(passed, F.lit("passed")).otherwise(F.lit("failed")).alias("status"),
        F.when(passed, good).otherwise(bad).alias("message"),
    )
    return row if applies is None else F.when(applies, row)


def _within(low_value: Column, high_value: Column, smallest: float, largest: float | None) -> Column:
    inside = low_value >= smallest
    return inside if largest is None else inside & (high_value <= largest)


def _text(value: Column) -> Column:
    return value.cast("string")


def _all_rules() -> list[Column]:
    rules = []
    tables = [(f"processed_{feed}_non_empty", feed) for feed in FEED_ORDER]
    tables += [(f"{table}_snapshot_non_empty", table) for table in METRICS]
    for name, table in tables:
        rows = F.col(_name(table, "rows"))
        rules.append(
            _rule(
                name, CRITICAL, rows > 0,
                F.concat(F.lit(f"{table} has "), _text(rows), F.lit(" rows")), F.lit(f"{table} has no rows"),
            )
        )

    kpi_rows = F.col(_name("ads_kpi_daily", "rows"))
    rules.append(
        _rule(
            "ads_kpi_daily_single_row", CRITICAL, kpi_rows == 1,
            F.lit("ads_kpi_daily has exactly one row"),
            F.concat(F.lit("ads_kpi_daily has "), _text(kpi_rows), F.lit(" rows")),
        )
    )
    for name, column, smallest, largest in KPI_RANGES:
        value = F.col(_name("ads_kpi_daily", f"{column}_min"))
        limit = F.concat(F.lit(" is above "), F.lit(f"{largest}"))
        outside = F.when(value < smallest, F.lit(f" is below {smallest:g}")).otherwise(limit)
        rules.append(
            _rule(
                name, CRITICAL, _within(value, value, smallest, largest),
                F.lit(f"{column} is within range"), F.concat(F.lit(f"{column} "), F.format_string("%.4f", value), outside), kpi_rows == 1,
            )
        )

    rank_rule, rank_table, fewest, most = RANK_ROWS
    ranks = F.col(_name(rank_table, "rows"))
    rules.append(
        _rule(
            rank_rule, CRITICAL, ranks.between(fewest, most),
            F.concat(_text(ranks), F.lit(" is within range")), F.concat(_text(ranks), F.lit(f" is above {most}")), ranks > 0,
        )
    )
    for name, table, column in UNIQUE_NUMBERS:
        rows, low = F.col(_name(table, "rows")), F.col(_name(table, f"{column}_min"))
        problem = F.when(low <= 0, F.lit(f"{column} contains non-positive values"))
        rules.append(
            _rule(
                name, CRITICAL, (low > 0) & (F.col(_name(table, f"{column}_distinct")) == rows),
                F.lit(f"{column} values are unique positive integers"),
                problem.otherwise(F.lit(f"{column} contains duplicates")), rows > 0,
            )
        )
    for name, table, column, smallest, largest in ROW_RANGES:
        low, high = (F.col(_name(table, f"{column}_{end}")) for end in ("min", "max"))
        kind = ("non-negative", "negative") if largest is None else ("within range", "out-of-range")
        rules.append(
            _rule(
                name, CRITICAL, _within(low, high, smallest, largest),
                F.lit(f"{column} values are {kind[0]}"), F.lit(f"{column} contains {kind[1]} values"),
                F.col(_name(table, "rows")) > 0,
            )
        )
    share_rule, share_table, _, least, greatest = SHARE_SUM
    total = F.col(_name(share_table, "share_sum"))
    message = F.concat(F.lit("sales_share sum is "), _text(total))
    rules.append(
        _rule(share_rule, WARNING, total.between(least, greatest), message, message, F.col(_name(share_table, "rows")) > 0)
    )
    return rules


def rule_names() -> list[str]:
    """All rules in the order they are evaluated."""
    names = [f"processed_{feed}_non_empty" for feed in FEED_ORDER]
    names += [f"{table}_snapshot_non_empty" for table in METRICS] + ["ads_kpi_daily_single_row"]
    names += [rule[0] for rule in (*KPI_RANGES, RANK_ROWS, *UNIQUE_NUMBERS, *ROW_RANGES, SHARE_SUM)]
    return names


def quality_rules(feeds: dict[str, DataFrame], metrics: dict[str, DataFrame], dates: DataFrame | None = None) -> DataFrame:
    """Rule results per batch date. With ``dates`` (column ``dt``) exactly those are reported."""
    missing = [name for name in (*FEEDS, *METRICS) if name not in feeds and name not in metrics]
    if missing:
        raise ValueError(f"tables to check are missing: {missing}")
    parts = [_measures(name, df) for name, df in {**feeds, **metrics}.items()]
    if dates is not None:
        requested = dates.select("dt").distinct()
        parts = [part.join(requested, "dt", "left_semi") for part in parts] + [requested]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    counts = [name for name in merged.columns if name.endswith("__rows")]
    per_date = merged.groupBy("dt").agg(*[F.max(name).alias(name) for name in merged.columns if name != "dt"])
    per_date = per_date.fillna(0, counts)
    rules = per_date.select("dt", F.explode(F.array_compact(F.array(*_all_rules()))).alias("rule"))
    return rules.select(F.col("dt").alias("batch_date"), "rule.*")


def quality_summary(rules: DataFrame) -> DataFrame:
    """One row per batch date; only a failed critical rule fails the batch."""
    failed = F.col("status") == "failed"
    counted = rules.groupBy("batch_date").agg(
        F.count(F.lit(1)).alias("total_rules"),
        F.count_if(~failed).alias("passed"),
        F.count_if(failed).alias("failed"),
        F.count_if(failed & (F.col("severity") == CRITICAL)).alias("failed_critical"),
    )
    status = F.when(F.col("failed_critical") > 0, F.lit("failed")).otherwise(F.lit("passed"))
    return counted.withColumn("status", status)


def quality_report(rules: DataFrame) -> DataFrame:
    """One document per batch date: status, time, counts, and its rules (never more than there are kinds)."""
    counts = ("total_rules", "passed", "failed", "failed_critical")
    number = F.array_position(F.array(*[F.lit(name) for name in rule_names()]), F.col("name"))
    rule = F.struct(number.alias("number"), F.struct("name", "severity", "status", "message").alias("rule"))
    listed = rules.groupBy("batch_date").agg(F.sort_array(F.collect_list(rule)).alias("numbered"))
    return listed.join(quality_summary(rules), "batch_date").select(
        "batch_date",
        "status",
        F.current_timestamp().alias("checked_at"),
        F.struct(*counts).alias("summary"),
        F.transform("numbered", lambda r: r["rule"]).alias("rules"),
    )
