"""The sample queries as ANSI SQL over the raw tables, for comparison with another engine.

Each statement stands alone: the shared common table expressions below, then one SELECT. Averages and
shares are rounded half-up in integer cents, because a decimal division may give a binary double.
"""

from __future__ import annotations

import re

from marketloom.operators import quality, serving
from marketloom.schemas import METRICS, SERVING, columns_of
from marketloom.sources import sample_tables as sample

YEARS = "(SELECT DISTINCT strftime(o_orderdate, '%Y-01-01') AS dt FROM orders) AS y"


def _flaw(key: str, flaws: dict[str, tuple[int, int]], name: str) -> str:
    step, rest = flaws[name]
    return f"{key} % {step} = {rest}"


def _no_flaw(key: str, flaws: dict[str, tuple[int, int]], *skip: str) -> str:
    return " AND ".join(f"NOT ({_flaw(key, flaws, name)})" for name in flaws if name not in skip)


def _amount(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"


def _cents(value: str) -> str:
    return f"CAST(round({value} * 100) AS BIGINT)"


def _half_up(numerator: str, denominator: str, digits: int, kind: str) -> str:
    """numerator / denominator of whole numbers, rounded half-up to ``digits`` decimals."""
    scale = 10**digits
    whole = f"(2 * {scale} * CAST({numerator} AS HUGEINT) + {denominator}) // (2 * {denominator})"
    unit = f"CAST({1 / scale:.{digits}f} AS DECIMAL({digits + 1},{digits}))"
    return f"CAST(CAST({whole} AS DECIMAL(18,0)) * {unit} AS {kind})"


def _headers(name: str, dt: str) -> str:
    total = _cents("o_totalprice")
    off = f"({total} * (100 - o_orderkey % 30)) // 100"
    return f"""{name} AS (
  SELECT o_orderkey, o_orderkey + 1 AS cart_id, o_custkey + 1 AS user_id, {dt} AS dt,
         CASE WHEN o_orderkey % 53 <> 0 THEN {_amount(total)} END AS cart_total,
         CASE WHEN o_orderkey % 59 <> 0 THEN {_amount(off)} END AS cart_discounted_total,
         CAST(o_orderkey % 5 + 1 AS INTEGER) AS total_products,
         CASE WHEN o_orderkey % 61 <> 0 THEN CAST(o_orderkey % 9 + 1 AS INTEGER) END AS total_quantity
  FROM orders)"""


def _lines() -> str:
    price = _cents("l_extendedprice")
    off = "CAST(round(l_discount * 100) AS INTEGER)"
    flags = "l_returnflag || '-' || l_linestatus"
    return f"""cart_lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey + 1 AS product_id, 'item ' || l_partkey AS product_name,
         {_amount(f"{price} // CAST(l_quantity AS BIGINT)")} AS unit_price,
         CAST(l_quantity AS INTEGER) AS quantity, {_amount(price)} AS line_total,
         CAST({off} AS DECIMAL(10,2)) AS discount_percentage,
         CASE WHEN l_partkey % 47 <> 0 THEN {_amount(f"({price} * (100 - {off})) // 100")} END AS line_discounted_total,
         CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN lower({flags}) ELSE {flags} END AS category_hint
  FROM lineitem)"""


def _detail(name: str, headers: str) -> str:
    columns = ", ".join(c for c in columns_of("dwd_order_cart_detail").names if c not in ("source", "batch_date"))
    return f"""{name} AS (
  SELECT {columns}, 'carts' AS source, dt AS batch_date, dt, o_orderkey
  FROM cart_lines JOIN {headers} ON l_orderkey = o_orderkey)"""


KIND = "CASE WHEN p_partkey % 17 = 0 THEN '  ' WHEN p_partkey % 23 <> 0 THEN p_type || ' & ' || (p_size % 3) END"
CATALOGUE = f"""catalogue AS (
  SELECT p_partkey, p_partkey + 1 AS product_id, p_name AS product_name, {KIND} AS category, p_brand AS brand,
         {_amount(_cents("p_retailprice"))} AS price, CAST(p_partkey % 20 AS DECIMAL(10,2)) AS discount_percentage,
         CAST(p_partkey % 6 AS DECIMAL(10,2)) AS rating, p_size AS stock,
         CASE WHEN p_size < 10 THEN 'Low Stock' ELSE 'In Stock' END AS availability_status,
         'https://cdn.example.test/' || p_partkey || '.png' AS thumbnail, 'products' AS source, dt AS batch_date, dt
  FROM part CROSS JOIN {YEARS} WHERE p_partkey % 19 <> 0)"""

AGE = "CASE WHEN c_custkey % 13 <> 0 THEN CAST(c_custkey % 60 + 10 AS INTEGER) END"
PEOPLE = f"""people AS (
  SELECT c_custkey, c_custkey + 1 AS user_id, c_name AS username,
         'First' || (c_custkey % 100) || CASE WHEN c_custkey % 10 <> 0 THEN ' Last' || (c_custkey % 70) ELSE '' END AS full_name,
         CASE c_custkey % 3 WHEN 0 THEN 'female' WHEN 1 THEN 'male' ELSE '' END AS gender, {AGE} AS age,
         lower(c_mktsegment) || '@example.test' AS email, '+1 555 ' || c_custkey AS phone,
         'City ' || (c_custkey % 40) AS city, r_name AS state,
         CASE WHEN c_custkey % 29 <> 0 THEN n_name END AS country,
         CAST(c_custkey % 90 AS DECIMAL(18,6)) AS latitude, CAST(-(c_custkey % 180) AS DECIMAL(18,6)) AS longitude,
         CASE WHEN c_custkey % 50 = 0 THEN 'admin' ELSE 'user' END AS role, 'users' AS source, dt AS batch_date, dt
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
  CROSS JOIN {YEARS})"""


def _age_group(age: str) -> str:
    return (
        f"CASE WHEN {age} IS NULL THEN 'unknown' WHEN {age} < 18 THEN '<18' WHEN {age} < 25 THEN '18-24' "
        f"WHEN {age} < 35 THEN '25-34' WHEN {age} < 45 THEN '35-44' WHEN {age} < 55 THEN '45-54' ELSE '55+' END"
    )


def _or_unknown(text: str) -> str:
    return f"coalesce(nullif(trim({text}), ''), 'unknown')"


DIMENSIONS = f"""dim_product AS (
  SELECT product_id, product_name, {_or_unknown("category")} AS category, brand, price, stock, availability_status, dt
  FROM catalogue),
dim_category AS (
  SELECT lower(regexp_replace(category, '[^a-zA-Z0-9]+', '_', 'g')) AS category_id, category AS category_name,
         count(DISTINCT product_id) AS product_count, dt
  FROM dim_product GROUP BY category, dt),
dim_user AS (
  SELECT user_id, username, gender, age, {_age_group("age")} AS age_group, city, state, country, role, dt FROM people)"""


def _sales(name: str, detail: str) -> str:
    """One row per order that has lines; ids of orders do not repeat, so nothing is made distinct but the buyers."""
    money = "CAST(coalesce(sum({0}), 0) AS DECIMAL(18,2)) AS {1}"
    average = _half_up("CAST(coalesce(sum(cart_discounted_total), 0) * 100 AS HUGEINT)", "count(*)", 0, "BIGINT")
    return f"""{name} AS (
  SELECT dt AS date_id, count(*) AS order_count, count(DISTINCT user_id) AS pay_user_count,
         {money.format("cart_total", "total_sales_amount")}, {money.format("cart_discounted_total", "discount_sales_amount")},
         {_amount(average)} AS avg_order_amount, CAST(coalesce(sum(total_quantity), 0) AS BIGINT) AS total_quantity, dt
  FROM day_headers WHERE o_orderkey IN (SELECT o_orderkey FROM {detail}) GROUP BY dt)"""


def _funnel(name: str, detail: str) -> str:
    rate = "CAST({0} AS DECIMAL(10,4)) AS {1}"
    return f"""{name} AS (
  SELECT dt AS date_id, CAST(0 AS BIGINT) AS view_count, carts AS cart_count, carts AS order_count, carts AS payment_count,
         {rate.format(0, "cart_rate")}, {rate.format(1, "order_rate")}, {rate.format(1, "payment_rate")}, dt
  FROM (SELECT dt, count(DISTINCT cart_id) AS carts FROM {detail} GROUP BY dt) AS c)"""


def _kpi(name: str, sales: str, funnel: str) -> str:
    return f"""{name} AS (
  SELECT s.date_id, s.total_sales_amount, s.order_count AS total_order_count, s.pay_user_count AS paid_user_count,
         s.avg_order_amount, f.payment_rate AS payment_conversion_rate, s.dt
  FROM {sales} AS s LEFT JOIN {funnel} AS f ON s.date_id = f.date_id)"""


def _trend(name: str, sales: str) -> str:
    return f"""{name} AS (
  SELECT date_id, total_sales_amount AS sales_amount, order_count, pay_user_count AS paid_user_count, dt FROM {sales})"""


def _stages(name: str, funnel: str) -> str:
    stage = "SELECT date_id, '{0}' AS stage_name, {1} AS stage_order, {0}_count AS stage_count, CAST({2} AS DECIMAL(10,4)) AS conversion_rate, dt FROM {3}"
    arms = [stage.format(s, n, rate, funnel) for n, (s, rate) in enumerate((("cart", 0), ("order", 1), ("payment", 1)), 1)]
    return f"{name} AS (\n  " + "\n  UNION ALL ".join(arms) + ")"


def _change_day(key: str, change: tuple[int, int, int], after: int = 0) -> str:
    days = f"1 + ({key} * {change[2]}) % {sample.CHANGE_DAYS} + {after}"
    return f"strftime(DATE '{sample.FIRST_BATCH}' + CAST({days} AS INTEGER), '%Y-%m-%d')"


def _changes(change: tuple[int, int, int], key: str) -> str:
    return f"{key} % {change[0]} = {change[1]}"


_P, _U = sample.PRODUCT_CHANGES, sample.USER_CHANGES
# Every state of an item with the days from and up to which it holds; withdrawals end a state and are none themselves.
STATES = f"""parts AS (
  SELECT p_partkey, p_partkey + 1 AS product_id, p_name AS product_name, {_or_unknown(KIND)} AS category,
         {_or_unknown(f"{KIND} || ' II'")} AS changed_category, p_brand AS brand FROM part WHERE p_partkey % 19 <> 0),
product_events AS (
  SELECT product_id, product_name, category, brand, '{sample.FIRST_BATCH}' AS since, false AS gone FROM parts
  UNION ALL SELECT product_id, product_name || ' II', changed_category, brand, {_change_day("p_partkey", _P["changed"])}, false
  FROM parts WHERE {_changes(_P["changed"], "p_partkey")}
  UNION ALL SELECT product_id, NULL, NULL, NULL, {_change_day("p_partkey", _P["withdrawn"])}, true
  FROM parts WHERE {_changes(_P["withdrawn"], "p_partkey")}
  UNION ALL SELECT product_id, product_name, category, brand, {_change_day("p_partkey", _P["back"], sample.BACK_AFTER)}, false
  FROM parts WHERE {_changes(_P["back"], "p_partkey")}),
product_states AS (
  SELECT *, lead(since, 1, '9999-12-31') OVER (PARTITION BY product_id ORDER BY since) AS until
  FROM (SELECT * FROM product_events QUALIFY row_number() OVER (PARTITION BY product_id, since ORDER BY gone DESC) = 1)),
buyers AS (
  SELECT c_custkey, c_custkey + 1 AS user_id, {AGE} AS age, CASE c_custkey % 3 WHEN 0 THEN 'female' WHEN 1 THEN 'male' ELSE '' END AS gender,
         CASE WHEN c_custkey % 29 <> 0 THEN n_name END AS country
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
user_events AS (
  SELECT user_id, {_age_group("age")} AS age_group, gender, country, '{sample.FIRST_BATCH}' AS since, false AS gone FROM buyers
  UNION ALL SELECT user_id, {_age_group("(age + 15)")}, gender, 'ABROAD', {_change_day("c_custkey", _U["changed"])}, false
  FROM buyers WHERE {_changes(_U["changed"], "c_custkey")}
  UNION ALL SELECT user_id, NULL, NULL, NULL, {_change_day("c_custkey", _U["withdrawn"])}, true
  FROM buyers WHERE {_changes(_U["withdrawn"], "c_custkey")}),
user_states AS (
  SELECT *, lead(since, 1, '9999-12-31') OVER (PARTITION BY user_id ORDER BY since) AS until
  FROM (SELECT * FROM user_events QUALIFY row_number() OVER (PARTITION BY user_id, since ORDER BY gone DESC) = 1)),
batch_days AS (
  SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS dt FROM orders)"""

# Independent of the builders: one row per cart first, listed and unlisted products apart, users and buyers apart.
SUMMARIES = """cart_products AS (
  SELECT dt, cart_id, product_id, product_name, coalesce(category_hint, 'unknown') AS category,
         sum(quantity) AS pieces, sum(line_discounted_total) AS amount
  FROM day_detail GROUP BY ALL),
listed_products AS (
  SELECT * FROM product_states WHERE NOT gone),
named_products AS (
  SELECT c.dt, c.cart_id, c.product_id, p.product_name, p.category, p.brand, sum(pieces) AS pieces, sum(amount) AS amount
  FROM cart_products AS c JOIN listed_products AS p ON c.product_id = p.product_id AND c.dt >= p.since AND c.dt < p.until
  GROUP BY ALL
  UNION ALL
  SELECT c.dt, c.cart_id, c.product_id, c.product_name, c.category, NULL, sum(c.pieces), sum(c.amount)
  FROM cart_products AS c LEFT JOIN listed_products AS p ON c.product_id = p.product_id AND c.dt >= p.since AND c.dt < p.until
  WHERE p.product_id IS NULL GROUP BY ALL),
dws_product AS (
  SELECT dt AS date_id, product_id, product_name, category, brand, CAST(sum(pieces) AS BIGINT) AS sales_quantity,
         CAST(sum(amount) AS DECIMAL(18,2)) AS sales_amount, count(*) AS order_count, dt
  FROM named_products GROUP BY ALL),
listed_sizes AS (
  SELECT b.dt, category, count(DISTINCT product_id) AS product_count
  FROM batch_days AS b JOIN listed_products AS p ON b.dt >= p.since AND b.dt < p.until GROUP BY ALL),
dws_category AS (
  SELECT dt AS date_id, category, product_count, CAST(pieces AS BIGINT) AS sales_quantity,
         CAST(amount AS DECIMAL(18,2)) AS sales_amount, orders AS order_count, dt
  FROM (SELECT dt, category, sum(pieces) AS pieces, sum(amount) AS amount, count(*) AS orders FROM named_products GROUP BY ALL) AS s
  LEFT JOIN listed_sizes USING (dt, category)),
user_days AS (
  SELECT b.dt, user_id, age_group, gender, country
  FROM batch_days AS b JOIN user_states AS u ON b.dt >= u.since AND b.dt < u.until WHERE NOT gone),
cart_users AS (
  SELECT DISTINCT dt, user_id, cart_id, cart_discounted_total AS amount FROM day_detail),
user_facts AS (
  SELECT dt, user_id, age_group, gender, country, 1 AS users, 0 AS orders, 0 AS amount FROM user_days
  UNION ALL
  SELECT dt, user_id, age_group, gender, country, 0, 1, c.amount FROM user_days JOIN cart_users AS c USING (dt, user_id)),
per_user AS (
  SELECT dt, user_id, age_group, gender, country, max(users) AS users, sum(orders) AS orders, sum(amount) AS amount
  FROM user_facts GROUP BY ALL),
dws_profile AS (
  SELECT dt AS date_id, age_group, gender, country, CAST(sum(users) AS BIGINT) AS user_count,
         count(*) FILTER (WHERE orders > 0) AS buyer_count, CAST(sum(orders) AS BIGINT) AS order_count,
         CAST(coalesce(sum(amount), 0) AS DECIMAL(18,2)) AS sales_amount, dt
  FROM per_user GROUP BY ALL)"""

SHARE = _half_up("CAST(c.sales_amount * 100 AS HUGEINT)", "CAST(t.total * 100 AS HUGEINT)", 4, "DECIMAL(10,4)")


METRIC_TABLES = f"""ads_product_rank_daily AS (
  SELECT date_id, CAST(rank_no AS INTEGER) AS rank_no, product_id, product_name, category, sales_quantity, sales_amount, dt
  FROM (SELECT *, row_number() OVER (PARTITION BY dt ORDER BY sales_amount DESC NULLS LAST, sales_quantity DESC NULLS LAST,
                                     product_id, product_name, category, brand) AS rank_no FROM dws_product) AS r
  WHERE rank_no <= 10),
ads_category_share_daily AS (
  SELECT c.date_id, c.category, c.sales_amount, c.sales_quantity,
         CASE WHEN coalesce(t.total, 0) = 0 THEN CAST(0 AS DECIMAL(10,4)) ELSE {SHARE} END AS sales_share, c.dt
  FROM dws_category AS c JOIN (SELECT dt, sum(sales_amount) AS total FROM dws_category GROUP BY dt) AS t ON c.dt = t.dt),
ads_user_profile_daily AS (
  SELECT dt AS date_id, dimension_type, {_or_unknown("value")} AS dimension_value, CAST(sum(users) AS BIGINT) AS user_count,
         count(*) FILTER (WHERE orders > 0) AS buyer_count, CAST(coalesce(sum(amount), 0) AS DECIMAL(18,2)) AS sales_amount, dt
  FROM per_user, LATERAL (VALUES ('age_group', age_group), ('gender', gender), ('country', country)) AS d(dimension_type, value)
  GROUP BY ALL)"""

COMMON = ",\n".join(
    (
        _headers("day_headers", "strftime(o_orderdate, '%Y-%m-%d')"),
        _headers("year_headers", "strftime(o_orderdate, '%Y-01-01')"),
        _lines(),
        _detail("day_detail", "day_headers"),
        CATALOGUE,
        PEOPLE,
        DIMENSIONS,
        _sales("day_sales", "day_detail"),
        _funnel("day_funnel", "day_detail"),
        _kpi("day_kpi", "day_sales", "day_funnel"),
        _kpi("ads_kpi_daily", "day_sales", "day_funnel"),
        _trend("day_trend", "day_sales"),
        _trend("ads_sales_trend_daily", "day_sales"),
        _stages("day_stages", "day_funnel"),
        _stages("ads_funnel_daily", "day_funnel"),
        STATES,
        SUMMARIES,
        METRIC_TABLES,
    )
)


def _bad_carts(name: str, headers: str) -> str:
    """Every cart envelope with its reject reason, in the order the checks are made."""
    key, flaws = "o_orderkey", sample.CART_FLAWS
    return f"""{name} AS (
  SELECT h.*, coalesce(l.n, 0) AS line_count, CASE
    WHEN {_flaw(key, flaws, "wrong_source")} THEN 'source_mismatch'
    WHEN {_flaw(key, flaws, "wrong_date")} THEN 'batch_date_mismatch'
    WHEN {_flaw(key, flaws, "broken_json")} THEN 'payload_not_object'
    WHEN {_flaw(key, flaws, "fractional_id")} THEN 'invalid_id'
    WHEN {_flaw(key, flaws, "boolean_user")} THEN 'invalid_user_id'
    WHEN {_flaw(key, flaws, "products_text")} THEN 'products_not_a_list'
    WHEN l.n IS NULL THEN 'no_lines'
    WHEN l.zero_quantity AND o_orderkey % 137 = 7 THEN 'invalid_line'
    WHEN {_flaw(key, flaws, "fractional_count")} THEN 'wrong_type' END AS reject_reason
  FROM {headers} AS h LEFT JOIN (
    SELECT l_orderkey, count(*) AS n, bool_or(l_linenumber = 1) AS zero_quantity FROM lineitem GROUP BY l_orderkey
  ) AS l ON o_orderkey = l_orderkey)"""


PRODUCT_REASON = f"""CASE
    WHEN {_flaw("p_partkey", sample.PRODUCT_FLAWS, "wrong_source")} THEN 'source_mismatch'
    WHEN {_flaw("p_partkey", sample.PRODUCT_FLAWS, "wrong_date")} THEN 'batch_date_mismatch'
    WHEN {_flaw("p_partkey", sample.PRODUCT_FLAWS, "broken_json")} THEN 'payload_not_object'
    WHEN {_flaw("p_partkey", sample.PRODUCT_FLAWS, "fractional_id")} THEN 'invalid_id'
    WHEN {_flaw("p_partkey", sample.PRODUCT_FLAWS, "negative_id")} THEN 'invalid_id'
    WHEN {_flaw("p_partkey", sample.PRODUCT_FLAWS, "numeric_title")} THEN 'invalid_title'
    WHEN {_flaw("p_partkey", sample.PRODUCT_FLAWS, "no_price")} THEN 'invalid_price'
    WHEN {_flaw("p_partkey", sample.PRODUCT_FLAWS, "fractional_stock")} THEN 'wrong_type' END"""
USER_REASON = f"""CASE
    WHEN {_flaw("c_custkey", sample.USER_FLAWS, "wrong_source")} THEN 'source_mismatch'
    WHEN {_flaw("c_custkey", sample.USER_FLAWS, "wrong_date")} THEN 'batch_date_mismatch'
    WHEN {_flaw("c_custkey", sample.USER_FLAWS, "broken_json")} THEN 'payload_not_object'
    WHEN {_flaw("c_custkey", sample.USER_FLAWS, "boolean_id")} THEN 'invalid_id'
    WHEN {_flaw("c_custkey", sample.USER_FLAWS, "numeric_name")} THEN 'invalid_username'
    WHEN {_flaw("c_custkey", sample.USER_FLAWS, "blank_name")} THEN 'invalid_username' END"""

CHECKED = f"""{_bad_carts("day_carts", "day_headers")},
{_bad_carts("year_carts", "year_headers")},
checked AS (
  SELECT 'products' AS feed, dt, 1 AS line_count, {PRODUCT_REASON} AS reject_reason FROM catalogue
  UNION ALL SELECT 'users', dt, 1, {USER_REASON} FROM people
  UNION ALL SELECT 'carts', dt, line_count, reject_reason FROM year_carts)"""


NAMED = re.compile(r"^(\w+) AS \(", re.MULTILINE)


def _by_name(text: str) -> dict[str, str]:
    """The common table expressions of a text, each of which starts a line."""
    starts = [m.start() for m in NAMED.finditer(text)] + [len(text)]
    parts = [text[a:b].rstrip().rstrip(",") for a, b in zip(starts[:-1], starts[1:], strict=True)]
    return {NAMED.match(part)[1]: part for part in parts}


def _select(body: str, *more: str) -> str:
    """``body`` after the common table expressions it needs, in their order."""
    known = _by_name(",\n".join((COMMON, *more)))
    wanted, todo = set(), [body]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in (known.keys() & words) - wanted:
            wanted.add(name)
            todo.append(known[name])
    parts = [part for name, part in known.items() if name in wanted]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def _columns(table: str) -> str:
    return ", ".join(columns_of(table).names)


def _json_value(name: str, kind: str, quote_decimals: bool) -> str:
    if kind == "string":
        value = f"'\"' || {name} || '\"'"
    elif kind == "decimal" and quote_decimals:
        value = f"'\"' || CAST({name} AS VARCHAR) || '\"'"
    else:
        value = f"CAST({name} AS VARCHAR)"
    return f"coalesce({value}, 'null')"


def _snapshot_arm(table: str) -> str:
    kinds = {f.name: f.dataType.typeName() for f in columns_of(table)} | {"dt": "string"}
    pairs = [f"'\"{name}\": ' || {_json_value(name, kinds[name], True)}" for name in sorted(kinds)]
    line = "'{' || " + " || ', ' || ".join(pairs) + " || '}'"
    return f"SELECT '{table}' AS table_name, {line} AS line FROM {table}"


def _overview_arm(section: str) -> str:
    table = serving.SECTIONS[section][0]
    fields = [f for f in columns_of(table) if f.name != "date_id"]
    pairs = " || ',' || ".join(f"'\"{f.name}\":' || {_json_value(f.name, f.dataType.typeName(), False)}" for f in fields)
    return f"SELECT date_id, '{section}' AS section, '{{' || {pairs} || '}}' AS item FROM {table}"


def _latest_arm(section: str) -> str:
    """The items of a section on the latest date, with their place in its order."""
    table, keys = serving.SECTIONS[section]
    fields = [f for f in columns_of(table) if f.name != "date_id"]
    pairs = " || ',' || ".join(f"'\"{f.name}\":' || {_json_value(f.name, f.dataType.typeName(), False)}" for f in fields)
    order = ", ".join(f"{name} DESC NULLS LAST" if down else f"{name} NULLS FIRST" for name, down in keys) or "date_id"
    return (
        f"SELECT date_id, '{section}' AS section, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS item_no, "
        f"'{{' || {pairs} || '}}' AS item FROM {table} JOIN latest USING (date_id)"
    )


def _constraint_arms(table: str) -> list[str]:
    contract = SERVING[table]
    kinds = {f.name: f.dataType.typeName() for f in columns_of(table)}
    keys = ", ".join(f"lower(rtrim({k}))" if kinds[k] == "string" else k for k in contract.key)
    arm = "SELECT '{0}' AS table_name, '{1}' AS constraint_name, CAST({2} AS BIGINT) AS violations FROM {3}"
    groups = f"(SELECT count(*) AS n FROM {table} GROUP BY {keys}) AS g"
    arms = [arm.format(table, "primary_key", "coalesce(sum(n - 1), 0)", groups)]
    for name in (*contract.key, *contract.required):
        arms.append(arm.format(table, f"not_null({name})", f"count(*) FILTER (WHERE {name} IS NULL)", table))
    for name, limit in contract.lengths.items():
        arms.append(arm.format(table, f"length({name})", f"count(*) FILTER (WHERE length({name}) > {limit})", table))
    return arms


def _rule_arms() -> list[str]:
    """The data-quality rules one by one, each over its own table."""
    arm = (
        "SELECT dt AS batch_date, '{name}' AS name, '{severity}' AS severity, "
        "CASE WHEN {ok} THEN 'passed' ELSE 'failed' END AS status, CASE WHEN {ok} THEN {good} ELSE {bad} END AS message "
        "FROM (SELECT DISTINCT dt FROM day_records) AS b LEFT JOIN ({rows}) AS r USING (dt) {where}"
    )
    arms = []

    def add(name: str, rows: str, ok: str, good: str, bad: str, where: str = "", severity: str = "critical") -> None:
        arms.append(arm.format(name=name, severity=severity, ok=f"coalesce({ok}, false)", good=good, bad=bad, rows=rows, where=where))

    counted = "SELECT dt, count(*) AS n FROM {0} GROUP BY dt"
    for feed in quality.FEED_ORDER:
        rows = counted.format(f"(SELECT dt FROM day_records WHERE feed = '{feed}') AS f")
        add(f"processed_{feed}_non_empty", rows, "n > 0", f"'{feed} has ' || n || ' rows'", f"'{feed} has no rows'")
    for table in METRICS:
        add(f"{table}_snapshot_non_empty", counted.format(table), "n > 0", f"'{table} has ' || n || ' rows'", f"'{table} has no rows'")
    kpi = counted.format("ads_kpi_daily")
    add("ads_kpi_daily_single_row", kpi, "n = 1", "'ads_kpi_daily has exactly one row'", "'ads_kpi_daily has ' || coalesce(n, 0) || ' rows'")
    for name, column, low, high in quality.KPI_RANGES:
        rows = f"SELECT dt, count(*) AS n, coalesce(min({column}), 0) AS v FROM ads_kpi_daily GROUP BY dt"
        ok = f"v >= {low}" + ("" if high is None else f" AND v <= {high}")
        bad = f"'{column} ' || printf('%.4f', CAST(v AS DOUBLE)) || CASE WHEN v < {low} THEN ' is below {low:g}' ELSE ' is above {high}' END"
        add(name, rows, ok, f"'{column} is within range'", bad, "WHERE n = 1")
    rule, table, low, high = quality.RANK_ROWS
    add(rule, counted.format(table), f"n BETWEEN {low} AND {high}", "n || ' is within range'", f"n || ' is above {high}'", "WHERE n > 0")
    for name, table, column in quality.UNIQUE_NUMBERS:
        rows = f"SELECT dt, count(*) AS n, min(coalesce({column}, 0)) AS v, count(DISTINCT coalesce({column}, 0)) AS d FROM {table} GROUP BY dt"
        bad = f"CASE WHEN v <= 0 THEN '{column} contains non-positive values' ELSE '{column} contains duplicates' END"
        add(name, rows, "v > 0 AND d = n", f"'{column} values are unique positive integers'", bad, "WHERE n > 0")
    for name, table, column, low, high in quality.ROW_RANGES:
        rows = f"SELECT dt, count(*) AS n, min(coalesce({column}, 0)) AS v, max(coalesce({column}, 0)) AS w FROM {table} GROUP BY dt"
        ok = f"v >= {low}" + ("" if high is None else f" AND w <= {high}")
        good, bad = ("non-negative", "negative") if high is None else ("within range", "out-of-range")
        add(name, rows, ok, f"'{column} values are {good}'", f"'{column} contains {bad} values'", "WHERE n > 0")
    rule, table, column, low, high = quality.SHARE_SUM
    rows = f"SELECT dt, count(*) AS n, sum({column}) AS v FROM {table} GROUP BY dt"
    text = "'sales_share sum is ' || CAST(v AS VARCHAR)"
    add(rule, rows, f"v BETWEEN {low} AND {high}", text, text, "WHERE n > 0", "warning")
    return arms


DAY_RECORDS = """day_records AS (
  SELECT 'products' AS feed, since AS dt FROM product_events WHERE NOT gone
  UNION ALL SELECT 'users', since FROM user_events WHERE NOT gone
  UNION ALL SELECT 'carts', dt FROM day_headers)"""
REPORT = "report AS (\n  " + "\n  UNION ALL ".join(_rule_arms()) + ")"


def _fixed(value: str, digits: int) -> str:
    """A double with ``digits`` decimals; exactly representable ties away from zero."""
    step = 2 ** (digits + 1)
    tie = f"({value} * {step} = floor({value} * {step}) AND CAST(floor({value} * {step}) AS BIGINT) % 2 = 1)"
    return f"printf('%.{digits}f', {value} + CASE WHEN {tie} THEN {10.0 ** -(digits + 2):.4f}::DOUBLE ELSE 0::DOUBLE END)"


def _money_text(value: str) -> str:
    number = f"CAST({value} AS DOUBLE)"
    return f"CASE WHEN {number} >= 10000 THEN {_fixed(f'({number} / 10000::DOUBLE)', 2)} || ' 万' ELSE format('{{:,.2f}}', {number}) END"


def _card_arms() -> list[str]:
    count = "format('{{:,}}', {0})"
    rate = _fixed("(CAST(payment_conversion_rate AS DOUBLE) * 100::DOUBLE)", 1) + " || '%'"
    orders, payers = count.format("total_order_count"), count.format("paid_user_count")
    cards = (
        (serving.CARD_SALES, _money_text("total_sales_amount"), serving.HINT_AVERAGE, _money_text("avg_order_amount")),
        (serving.CARD_ORDERS, orders, serving.HINT_USERS, payers),
        (serving.CARD_USERS, payers, serving.HINT_RATE, rate),
        (serving.CARD_RATE, rate, serving.HINT_DATE, "date_id"),
    )
    return [
        f"SELECT date_id, {n} AS card_no, '{label}' AS label, {value} AS value, '{hint}' || ({detail}) AS hint FROM day_kpi"
        for n, (label, value, hint, detail) in enumerate(cards, 1)
    ]


SLICED = """sliced AS (
  SELECT *, row_number() OVER (PARTITION BY date_id ORDER BY sales_share DESC, sales_amount DESC NULLS LAST, category) AS n
  FROM ads_category_share_daily)"""


def _slices() -> str:
    limit, other = serving.SHARE_SLICES, serving.OTHER_CATEGORY
    return f"""SELECT date_id, category, sales_amount, sales_quantity, sales_share, CAST(n AS INTEGER) AS slice_no
FROM sliced WHERE n <= {limit}
UNION ALL
SELECT date_id, '{other}', CAST(sum(coalesce(sales_amount, 0)) AS DECIMAL(18,2)),
       CAST(sum(coalesce(sales_quantity, 0)) AS BIGINT), CAST(sum(coalesce(sales_share, 0)) AS DECIMAL(10,4)), {limit + 1}
FROM sliced WHERE n > {limit} GROUP BY date_id"""


def _landed() -> str:
    key, flaws, users = "c_custkey", sample.LINE_FLAWS, sample.USER_FLAWS
    return f"""SELECT 'users' AS source, violation, count(*) AS rows FROM (
  SELECT CASE WHEN {_flaw(key, flaws, "blank")} THEN 'blank_line'
    WHEN {_flaw(key, flaws, "cut")} THEN 'invalid_json'
    WHEN {_flaw(key, flaws, "object_data")} THEN 'data_not_text'
    WHEN {_flaw(key, flaws, "no_entity")} THEN 'missing_entity'
    WHEN {_flaw(key, users, "wrong_source")} THEN 'source_mismatch'
    WHEN {_flaw(key, users, "wrong_date")} THEN 'batch_date_mismatch'
    WHEN {_flaw(key, users, "broken_json")} THEN 'data_not_json' END AS violation
  FROM people) AS v WHERE violation IS NOT NULL GROUP BY violation"""


# Table, key and item text of each source's pages.
PAGED = {
    "products": ("part", "p_partkey", "'{\"id\":' || (p_partkey + 1) || ',\"title\":\"' || p_name || '\",\"stock\":' || p_size || '}'"),
    "users": ("customer", "c_custkey", "'{\"id\":' || (c_custkey + 1) || ',\"username\":\"' || c_name || '\"}'"),
    "carts": ("orders", "o_orderkey", "'{\"id\":' || (o_orderkey + 1) || ',\"userId\":' || (o_custkey + 1) || '}'"),
}


def _pages(listed: bool) -> str:
    arms = []
    for source, (table, key, item) in PAGED.items():
        step, rest = sample.BROKEN_PAGES[source]
        page = f"{key} // {sample.ITEMS_PER_PAGE}"
        day = f"'2026-07-0' || ({page} % 9 + 1)"
        if listed:
            arms.append(
                f"SELECT '{sample.ENTITIES[source]}' AS entity, '{source}' AS source, {day} AS batch_date, {item} AS data "
                f"FROM {table} WHERE {page} % {step} <> {rest}"
            )
        else:
            arms.append(f"SELECT DISTINCT '{source}' AS source, {day} AS batch_date FROM {table} WHERE {page} % {step} = {rest}")
    return "\nUNION ALL ".join(arms)


def _merged(table: str, old: str, state: str = "") -> str:
    """Lines of a table with the corrections merged: of rows with one key, without case and spaces behind, the new one."""
    kinds = {f.name: f.dataType.typeName() for f in columns_of(table)}
    names = list(kinds)
    texts = [k for k in SERVING[table].key if k != "date_id" and kinds[k] == "string"]
    capital = ", ".join(f"upper({n}) || '  ' AS {n}" if n in texts else n for n in names)
    later = ", ".join("'29' || substr(date_id, 3) AS date_id" if n == "date_id" else n for n in names)
    keys = ", ".join(f"lower(rtrim({k}))" if kinds[k] == "string" else k for k in SERVING[table].key)
    order = ", ".join(f"{n} DESC NULLS LAST" for n in names)
    columns = ", ".join(names)
    if state:
        numbers = {n for n in SERVING[table].required if kinds[n] != "string"}
        filled = ", ".join(f"coalesce({n}, 0) AS {n}" if n in numbers else n for n in names)
        old = f"(SELECT {filled} FROM {old}) AS o"
    fresh = (
        f" UNION ALL SELECT {capital}, 1 FROM {old} WHERE date_id LIKE '%-15'"
        f" UNION ALL SELECT {later}, 1 FROM {old} WHERE date_id LIKE '%-16' AND date_id LIKE '19%'"
        if state != "before" else ""
    )
    pairs = [f"'\"{name}\": ' || {_json_value(name, kinds.get(name, 'string'), True)}" for name in sorted([*names, "dt"])]
    line = "'{' || " + " || ', ' || ".join(pairs) + " || '}'"
    extra = f", '{state}' AS state" if state else ""
    return (
        f"SELECT '{table}' AS table_name, {line} AS line{extra} FROM (SELECT *, date_id AS dt FROM ("
        f"SELECT {columns}, 0 AS fresh FROM {old}{fresh}) AS b "
        f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY fresh DESC, {order}) = 1) AS m"
    )


DATE_TEXTS = """date_texts AS (
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN strftime(o_orderdate, '%Y-02-30')
              WHEN o_orderkey % 89 = 0 THEN strftime(o_orderdate, '%Y%m%d')
              WHEN o_orderkey % 83 = 0 THEN ' ' || strftime(o_orderdate, '%Y-%m-%d')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS batch_date FROM orders)"""

ACCEPTED_USER = f"""SELECT user_id, username, full_name, gender,
  CASE WHEN {_flaw("c_custkey", sample.USER_FLAWS, "fractional_age")} THEN 30 ELSE age END AS age,
  CASE WHEN {_flaw("c_custkey", sample.USER_FLAWS, "fractional_age")} THEN 'unknown' ELSE {_age_group("age")} END AS age_group,
  email, phone, {", ".join(f"CASE WHEN NOT ({_flaw('c_custkey', sample.USER_FLAWS, 'address_text')}) THEN {c} END AS {c}" for c in ("city", "state", "country", "latitude", "longitude"))},
  role, source, batch_date, dt
FROM people WHERE {_no_flaw("c_custkey", sample.USER_FLAWS, "fractional_age", "address_text")}"""


RULE_ORDER = "rule_order AS (\n  SELECT unnest([" + ", ".join(f"'{n}'" for n in quality.rule_names()) + "]) AS name, unnest(range(40)) AS number)"


def _duplicates(table: str) -> str:
    kinds = {f.name: f.dataType.typeName() for f in columns_of(table)}
    keys = ", ".join(f"lower(rtrim({k}))" if kinds[k] == "string" else k for k in SERVING[table].key)
    groups = f"(SELECT count(*) AS n FROM {table} GROUP BY {keys} HAVING count(*) > 1) AS g"
    return f"SELECT '{table}' AS table_name, count(*) AS keys, CAST(sum(n) AS BIGINT) AS rows FROM {groups} HAVING count(*) > 0"


def _asked() -> str:
    """The sections one by one, then the overview of each date."""
    counts = " UNION ALL ".join(
        f"SELECT '{section}' AS section, date_id, count(*) AS items FROM {table} GROUP BY date_id" for section, (table, _) in serving.SECTIONS.items()
    )
    names = ", ".join(f"('{section}')" for section in serving.SECTIONS)
    return f"""SELECT date_id, section, status, items FROM (
  WITH wanted AS (SELECT batch_date AS date_id FROM date_texts UNION SELECT regexp_replace(batch_date, '^19', '29') FROM date_texts),
  told AS (
    SELECT date_id, section, coalesce(items, 0) AS items, CASE WHEN NOT regexp_full_match(date_id, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 'bad_date'
      WHEN items > 0 THEN 'found' ELSE 'not_found' END AS status
    FROM wanted CROSS JOIN (VALUES {names}) AS n(section) LEFT JOIN ({counts}) AS c USING (date_id, section))
  SELECT date_id, section, status, items FROM told
  UNION ALL SELECT date_id, 'overview', CASE WHEN bool_and(status = 'found') THEN 'found' WHEN bool_or(status = 'bad_date') THEN 'bad_date' ELSE 'not_found' END,
    CAST(sum(items) AS BIGINT) FROM told GROUP BY date_id) AS a"""


def all_sql() -> dict[str, str]:
    cart_columns = _columns("dwd_order_cart_detail")
    accepted_carts = "o_orderkey IN (SELECT o_orderkey FROM day_carts WHERE reject_reason IS NULL)"
    fed_detail = f"fed_detail AS (SELECT * FROM day_detail WHERE {accepted_carts})"
    fed = (CHECKED, fed_detail, _sales("fed_sales", "fed_detail"), _funnel("fed_funnel", "fed_detail"), _kpi("fed_kpi", "fed_sales", "fed_funnel"))
    dated = "CAST(day AS DATE)"
    statements = {
        "m01_dwd_product_info": _select(
            f"SELECT {_columns('dwd_product_info')}, dt FROM catalogue WHERE {_no_flaw('p_partkey', sample.PRODUCT_FLAWS)}"
        ),
        "m02_dwd_user_info": _select(ACCEPTED_USER),
        "m03_dwd_order_cart_detail": _select(f"SELECT {cart_columns}, dt FROM fed_detail", CHECKED, fed_detail),
        "m04_dim_date": f"""SELECT dt AS date_id, {dated} AS date_value, CAST(year({dated}) AS INTEGER) AS year,
  CAST(quarter({dated}) AS INTEGER) AS quarter, CAST(month({dated}) AS INTEGER) AS month, CAST(day({dated}) AS INTEGER) AS day,
  CAST(weekofyear({dated}) AS INTEGER) AS week_of_year, CAST(dayofweek({dated}) + 1 AS INTEGER) AS day_of_week,
  dayofweek({dated}) IN (0, 6) AS is_weekend, dt
FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS dt, CAST(o_orderdate AS DATE) AS day FROM orders) AS d""",
        "m05_dim_product": _select("SELECT * FROM dim_product"),
        "m06_dim_category": _select("SELECT * FROM dim_category"),
        "m07_dim_user": _select("SELECT * FROM dim_user"),
        "m08_dws_sales_daily": _select("SELECT * FROM day_sales"),
        "m09_dws_product_daily": _select("SELECT * FROM dws_product"),
        "m10_dws_category_daily": _select("SELECT * FROM dws_category"),
        "m11_dws_user_profile_daily": _select("SELECT * FROM dws_profile"),
        "m12_dws_funnel_daily": _select("SELECT * FROM day_funnel"),
        "m13_ads_kpi_daily": _select("SELECT * FROM day_kpi"),
        "m14_ads_sales_trend_daily": _select("SELECT * FROM day_trend"),
        "m15_ads_product_rank_daily": _select("SELECT * FROM ads_product_rank_daily"),
        "m16_ads_category_share_daily": _select("SELECT * FROM ads_category_share_daily"),
        "m17_ads_user_profile_daily": _select("SELECT * FROM ads_user_profile_daily"),
        "m18_ads_funnel_daily": _select("SELECT * FROM day_stages"),
        "m13_kpi_from_feed": _select("SELECT * FROM fed_kpi", *fed),
        "s1_batch_rows": _select(
            "SELECT CASE WHEN reject_reason = 'source_mismatch' THEN 'other' ELSE feed END AS source, dt, count(*) AS envelopes "
            "FROM (SELECT *, feed AS f FROM tagged WHERE NOT wrong_date) AS t GROUP BY ALL",
            CHECKED,
            f"""tagged AS (
  SELECT 'products' AS feed, dt, {PRODUCT_REASON} AS reject_reason, {_flaw("p_partkey", sample.PRODUCT_FLAWS, "wrong_date")} AS wrong_date FROM catalogue
  UNION ALL SELECT 'users', dt, {USER_REASON}, {_flaw("c_custkey", sample.USER_FLAWS, "wrong_date")} FROM people
  UNION ALL SELECT 'carts', dt, reject_reason, {_flaw("o_orderkey", sample.CART_FLAWS, "wrong_date")} FROM year_carts)""",
        ),
        "s4_flatten_payload": _pages(True),
        "k3_broken_payload": _pages(False),
        "k1_raw_pages": "SELECT source, batch_date AS dt, count(*) AS items FROM (" + _pages(True) + ") AS p GROUP BY ALL",
        "k4_landed_feeds": "SELECT *, batch_date AS dt FROM (" + _pages(True) + ") AS p",
        "k5_replaced_partitions": _select(
            "SELECT *, 'before' AS state FROM month_sales UNION ALL "
            "SELECT * REPLACE (CASE WHEN substr(dt, 6, 2) = '07' THEN 0 ELSE total_quantity END AS total_quantity), 'after' "
            "FROM month_sales WHERE substr(dt, 6, 2) <> '03'",
            _headers("month_headers", "strftime(o_orderdate, '%Y-%m-01')"),
            _sales("month_sales", "day_detail").replace("FROM day_headers", "FROM month_headers"),
        ),
        "k6_backfilled_batches": _select(
            "SELECT feed, dt, count(*) AS read, CAST(sum(CASE WHEN reject_reason IS NULL THEN line_count ELSE 0 END) AS BIGINT) AS written, "
            "count(reject_reason) AS invalid FROM own_batch GROUP BY feed, dt",
            CHECKED,
            f"""own_batch AS (
  SELECT 'products' AS feed, dt, 1 AS line_count, {PRODUCT_REASON} AS reject_reason FROM catalogue
  WHERE NOT ({_flaw("p_partkey", sample.PRODUCT_FLAWS, "wrong_date")})
  UNION ALL SELECT 'users', dt, 1, {USER_REASON} FROM people WHERE NOT ({_flaw("c_custkey", sample.USER_FLAWS, "wrong_date")})
  UNION ALL SELECT 'carts', dt, line_count, reject_reason FROM year_carts WHERE NOT ({_flaw("o_orderkey", sample.CART_FLAWS, "wrong_date")}))""",
        ),
        "k10_merged_tables": _select("\nUNION ALL ".join(_merged(table, table) for table in METRICS)),
        "k10_duplicate_keys": _select("\nUNION ALL ".join(_duplicates(table) for table in METRICS)),
        "k12_published_versions": _select(
            "\nUNION ALL ".join(_merged(table, table, state) for state in ("before", "after") for table in METRICS)
        ),
        "k15_quality_documents": _select(
            "SELECT batch_date, CASE WHEN count(*) FILTER (WHERE status = 'failed' AND severity = 'critical') > 0 THEN 'failed' ELSE 'passed' END AS status, "
            "count(*) AS total_rules, count(*) FILTER (WHERE status = 'passed') AS passed, count(*) FILTER (WHERE status = 'failed') AS failed, "
            "count(*) FILTER (WHERE status = 'failed' AND severity = 'critical') AS failed_critical, "
            "string_agg(name || '=' || status, ';' ORDER BY number) AS rules FROM report JOIN rule_order USING (name) GROUP BY batch_date",
            DAY_RECORDS, REPORT, RULE_ORDER,
        ),
        "t7_numbered_snapshots": _select(
            "SELECT table_name, row_number() OVER (PARTITION BY table_name ORDER BY line) AS line_no, line FROM ("
            + "\nUNION ALL ".join(_snapshot_arm(table) for table in METRICS) + ") AS l"
        ),
        "q6_asked_dates": _select(_asked(), DATE_TEXTS),
        "p7_reject_counts": _select(
            "SELECT feed, dt, reject_reason, count(*) AS rejected FROM checked WHERE reject_reason IS NOT NULL GROUP BY ALL", CHECKED
        ),
        "p13_landed_violations": _select(_landed()),
        "p15_batch_date_check": f"WITH {DATE_TEXTS}\n"
        "SELECT batch_date, coalesce(regexp_full_match(batch_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') "
        "AND TRY_CAST(batch_date AS DATE) IS NOT NULL, false) AS usable, count(*) AS rows FROM date_texts GROUP BY ALL",
        "k7_align_schema": _select(
            "SELECT " + cart_columns.replace("category_hint", "CAST(NULL AS VARCHAR) AS category_hint") + ", dt, 'x' AS extra FROM day_detail"
        ),
        "k9_snapshot_rows": _select("\nUNION ALL ".join(_snapshot_arm(table) for table in METRICS)),
        "k10_serving_rows": _select(
            "SELECT date_id, category, sales_amount, CAST(NULL AS BIGINT) AS sales_quantity, sales_share FROM ads_category_share_daily"
        ),
        "k11_contract_violations": _select("\nUNION ALL ".join(arm for table in METRICS for arm in _constraint_arms(table))),
        "k13_batch_audit": _select(
            "SELECT feed, dt, count(*) AS read, CAST(sum(CASE WHEN reject_reason IS NULL THEN line_count ELSE 0 END) AS BIGINT) AS written, "
            "count(reject_reason) AS invalid FROM checked GROUP BY feed, dt",
            CHECKED,
        ),
        "k14_export_counts": _select(
            "\nUNION ALL ".join(f"SELECT '{table}' AS table_name, count(*) AS exported FROM {table}" for table in METRICS)
        ),
        "d_quality_report": _select("SELECT * FROM report", DAY_RECORDS, REPORT),
        "d9_quality_summary": _select(
            "SELECT batch_date, count(*) AS total_rules, count(*) FILTER (WHERE status = 'passed') AS passed, "
            "count(*) FILTER (WHERE status = 'failed') AS failed, "
            "count(*) FILTER (WHERE status = 'failed' AND severity = 'critical') AS failed_critical, "
            "CASE WHEN count(*) FILTER (WHERE status = 'failed' AND severity = 'critical') > 0 THEN 'failed' ELSE 'passed' END AS status "
            "FROM report GROUP BY batch_date",
            DAY_RECORDS, REPORT,
        ),
        "q1_latest_date": _select(
            "SELECT max(date_id) AS date_id FROM ("
            + " UNION ALL ".join(f"SELECT max(date_id) AS date_id FROM {table}" for table in METRICS) + ") AS m"
        ),
        "q5_overview_sections": _select(
            "SELECT date_id, section, item FROM ("
            "SELECT *, count(DISTINCT section) OVER (PARTITION BY date_id) AS sections FROM items) AS o "
            f"WHERE sections = {len(serving.SECTIONS)}",
            "items AS (\n  " + "\n  UNION ALL ".join(_overview_arm(section) for section in serving.SECTIONS) + ")",
        ),
        "q5_overview_latest": _select(
            "\nUNION ALL ".join(_latest_arm(section) for section in serving.SECTIONS),
            "latest AS (\n  SELECT max(date_id) AS date_id FROM ("
            + " UNION ALL ".join(f"SELECT max(date_id) AS date_id FROM {table}" for table in METRICS) + ") AS m)",
        ),
        "q7_kpi_cards": _select("\nUNION ALL ".join(_card_arms())),
        "q7_profile_labels": _select(
            "SELECT date_id, dimension_type || ':' || dimension_value AS label, user_count, buyer_count FROM ads_user_profile_daily"
        ),
        "a11_share_with_other": _select(_slices(), SLICED),
    }
    sections = {
        "q2_kpi": "kpi", "q3_trend": "trend", "q4_product_rank": "product_rank", "q4_category_share": "category_share",
        "q4_user_profile": "user_profile", "q4_funnel": "funnel",
    }
    for key, section in sections.items():
        table, order = serving.SECTIONS[section]
        keys = ", ".join(["date_id"] + [f"{c} DESC" if down else c for c, down in order])
        statements[key] = _select(f"SELECT {_columns(table)} FROM {table} ORDER BY {keys}")
    return statements
