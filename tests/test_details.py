import json
from decimal import Decimal

from marketloom.operators import details
from marketloom.schemas import envelope_schema, table_schema
from marketloom.sources import sample_tables

DAY = "2026-07-01"
ENTITY = {"products": "product", "users": "user", "carts": "order"}


def envelope(source, payload, batch_date=DAY, dt=DAY):
    data = payload if isinstance(payload, str) or payload is None else json.dumps(payload, ensure_ascii=False)
    return (ENTITY.get(source, source), source, batch_date, data, dt)


def frame(spark, rows):
    return spark.createDataFrame(rows, envelope_schema())


def accepted(spark, source, *rows):
    return [r.asDict() for r in details.detail_rows(source, frame(spark, list(rows))).collect()]


def reasons(spark, source, *rows):
    checked = details.CHECKS[source](frame(spark, list(rows)))
    return [r.reject_reason for r in checked.select("reject_reason").collect()]


def product(**changes):
    return {"id": 3107, "title": "Walnut stool", "price": 41.5, **changes}


def user(**changes):
    return {"id": 918, "username": "okafor", **changes}


def line(**changes):
    return {"id": 64, "price": 2.5, "quantity": 3, **changes}


def cart(**changes):
    return {"id": 5501, "userId": 918, "products": [line()], **changes}


# Values of every JSON type that a rule must refuse, by rule.
NOT_IDS = (None, 0, -8, 2.25, 4.0, False, "31", [1], {"id": 1}, 2**70)
NOT_COUNTS = (-6, 0.5, 2.0, False, "2", [2])
NOT_AMOUNTS = (-0.5, "12", False, [1], 1e40)
NOT_VISIBLE = (None, 77, True, "", " \u3000\t", ["x"])
NOT_OBJECTS = (None, "", "{", "[]", "7", "null", '"x"', "true")
# Texts in which something follows the object, some of them made to look complete.
TAILS = (
    " tail", "}", "]", "]}", ',{"a":1}', ',"a":1', ',{"end_of_payload_mark":true}],"x":[{}',
    ',{"end_of_payload_mark":"0000"}],"x":[{}', ',{"end_of_payload_mark":null}]}',
)


def misplaced(source, payload):
    """A good payload in envelopes that name another source or batch."""
    other = next(s for s in ENTITY if s != source)
    return [envelope(other, payload), envelope(source, payload, batch_date="2026-06-30"), envelope(source, payload, dt="2026-07-02")]


def unreadable(source, payload):
    text = json.dumps(payload)
    return [envelope(source, t) for t in NOT_OBJECTS] + [envelope(source, text + tail) for tail in TAILS] + [envelope(source, text.replace('"', "'"))]


def none_accepted(spark, source, rows):
    assert accepted(spark, source, *rows) == []
    assert None not in reasons(spark, source, *rows)


def test_product_columns(spark):
    payload = product(
        category="seating", brand="Loft", discountPercentage=12.35, rating=3.08, stock=16,
        availabilityStatus="On order", thumbnail="https://img.example.test/3107.webp", extra={"colour": ["oak"]},
    )
    assert accepted(spark, "products", envelope("products", payload)) == [
        {
            "product_id": 3107, "product_name": "Walnut stool", "category": "seating", "brand": "Loft",
            "price": Decimal("41.50"), "discount_percentage": Decimal("12.35"), "rating": Decimal("3.08"), "stock": 16,
            "availability_status": "On order", "thumbnail": "https://img.example.test/3107.webp", "source": "products",
            "batch_date": DAY, "dt": DAY,
        }
    ]


def test_product_rejects(spark):
    rules = {"id": NOT_IDS, "title": NOT_VISIBLE, "stock": NOT_COUNTS, "price": (None, *NOT_AMOUNTS)}
    rows = [envelope("products", product(**{field: v})) for field, values in rules.items() for v in values]
    rows += [envelope("products", {k: v for k, v in product().items() if k != missing}) for missing in product()]
    rows += [envelope("products", '{"id":3,"title":"x","price":NaN}')]
    none_accepted(spark, "products", rows + misplaced("products", product()) + unreadable("products", product()))


def test_product_edge_values_are_accepted(spark):
    rows = accepted(
        spark,
        "products",
        envelope("products", product(price=0, stock=0)),
        envelope("products", product(stock=None, category=5, rating="4.5")),
        envelope("products", ' \n{"id":1,"title":"first","title":" last ","price":1e2}\n'),
        envelope("products", product(title="键盘")),
    )
    assert [r["price"] for r in rows] == [Decimal("0.00"), Decimal("41.50"), Decimal("100.00"), Decimal("41.50")]
    assert rows[1]["rating"] == Decimal("4.50") and rows[1]["category"] == "5"
    assert rows[2]["product_name"] == " last "
    assert rows[3]["product_name"] == "键盘"


def test_user_columns(spark):
    place = {"city": "Braga", "state": "Minho", "country": "Portugal", "coordinates": {"lat": 41.55, "lng": -8.42}}
    payload = user(firstName="Ines", lastName="Okafor", gender="female", age=47, email="i@example.test", phone="+351 9", role="editor", address=place)
    assert accepted(spark, "users", envelope("users", payload)) == [
        {
            "user_id": 918, "username": "okafor", "full_name": "Ines Okafor", "gender": "female", "age": 47,
            "age_group": "45-54", "email": "i@example.test", "phone": "+351 9", "city": "Braga", "state": "Minho",
            "country": "Portugal", "latitude": Decimal("41.550000"), "longitude": Decimal("-8.420000"),
            "role": "editor", "source": "users", "batch_date": DAY, "dt": DAY,
        }
    ]


def test_age_groups(spark):
    groups = {"<18": (-40, 17), "18-24": (18, 24), "25-34": (25, 34), "35-44": (35, 44), "45-54": (45, 54), "55+": (55, 130)}
    cases = [(age, group) for group, ends in groups.items() for age in ends]
    cases += [(age, "unknown") for age in (None, 21.5, "21", True, [21])]
    rows = accepted(spark, "users", *[envelope("users", user(age=age)) for age, _ in cases])
    assert [r["age_group"] for r in rows] == [group for _, group in cases]


def test_unusable_address_gives_nulls(spark):
    addresses = [None, "text", 5, [1], {"coordinates": "x"}, {"coordinates": [1]}, '{"city":"A"}']
    rows = accepted(spark, "users", *[envelope("users", user(address=a)) for a in addresses])
    assert len(rows) == len(addresses)
    for row in rows:
        assert [row[c] for c in ("city", "state", "country", "latitude", "longitude")] == [None] * 5


def test_full_names(spark):
    cases = [("A", "B", "A B"), ("A", None, "A"), ("", "B", "B"), (None, None, None), ("", "", None), (5, "B", "B")]
    rows = accepted(spark, "users", *[envelope("users", user(firstName=f, lastName=l)) for f, l, _ in cases])
    assert [r["full_name"] for r in rows] == [name for _, _, name in cases]


def test_user_rejects(spark):
    rules = {"id": NOT_IDS, "username": NOT_VISIBLE}
    rows = [envelope("users", user(**{field: v})) for field, values in rules.items() for v in values]
    none_accepted(spark, "users", rows + misplaced("users", user()) + unreadable("users", user()))


def test_cart_lines_repeat_the_header(spark):
    payload = cart(
        id=101, total=30.5, discountedTotal=27.449, totalProducts=2, totalQuantity=3,
        products=[
            line(id=1, title="A", price=10.25, quantity=2, total=20.5, discountPercentage=10, discountedTotal=18.45),
            line(id=2, quantity=1),
        ],
    )
    rows = accepted(spark, "carts", envelope("carts", payload))
    assert [r["product_id"] for r in rows] == [1, 2]
    assert {r["cart_id"] for r in rows} == {101} and {r["cart_total"] for r in rows} == {Decimal("30.50")}
    assert {r["cart_discounted_total"] for r in rows} == {Decimal("27.45")}
    assert rows[0]["line_discounted_total"] == Decimal("18.45") and rows[1]["line_total"] is None
    assert list(rows[0]) == table_schema("dwd_order_cart_detail").names


def test_category_hint(spark):
    cases = [
        ("https://cdn.example.test/product-images/smartphones/x/t.webp", "smartphones"),
        ("https://cdn.example.test/product-images/mens-watches/x/t.webp", "mens-watches"),
        ("https://cdn.example.test/product-images/ 　/t.webp", None),
        ("https://cdn.example.test/product-images/ a b /t.webp", "a b"),
        ("https://example.test/none.png", None),
        ({"u": "/product-images/a/"}, None),
        (7, None),
        (None, None),
    ]
    rows = accepted(spark, "carts", *[envelope("carts", cart(products=[line(thumbnail=t)])) for t, _ in cases])
    assert [r["category_hint"] for r in rows] == [hint for _, hint in cases]


def test_cart_rejects(spark):
    header = {"id": NOT_IDS, "userId": NOT_IDS, "totalProducts": NOT_COUNTS, "totalQuantity": NOT_COUNTS, "total": NOT_AMOUNTS, "discountedTotal": NOT_AMOUNTS}
    rows = [envelope("carts", cart(**{field: v})) for field, values in header.items() for v in values]
    rows += [envelope("carts", cart(products=v)) for v in (None, [], "none", 3, {"id": 64}, [line(), None], [line(), "x"])]
    rules = {"id": NOT_IDS, "quantity": (None, 0, *NOT_COUNTS), "price": (None, *NOT_AMOUNTS), "total": NOT_AMOUNTS, "discountedTotal": NOT_AMOUNTS, "discountPercentage": NOT_AMOUNTS}
    rows += [envelope("carts", cart(products=[line(), line(**{field: v}), line()])) for field, values in rules.items() for v in values]
    none_accepted(spark, "carts", rows + misplaced("carts", cart()) + unreadable("carts", cart()))


def test_rejects_carry_their_reason(spark):
    rows = frame(spark, [envelope("carts", cart()), envelope("carts", cart(id=0)), envelope("carts", cart(products=[]))])
    kept = details.rejects(details.check_carts(rows))
    assert [(r.dt, r.reject_reason) for r in kept.collect()] == [(DAY, "invalid_id"), (DAY, "no_lines")]


def test_each_text_is_parsed_once(spark, tmp_path):
    frame(spark, [envelope("carts", cart())]).write.json(str(tmp_path / "ods"))
    landed = spark.read.schema(envelope_schema()).json(str(tmp_path / "ods"))
    checked = details.check_carts(landed)
    for df in (details.accepted_rows("carts", checked), details.rejects(checked)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") + plan.count("JsonToStructsEvaluator") == 1


def test_json_feed_gives_the_same_rows_as_the_tables(spark, sample):
    pairs = {
        "products": (sample_tables.product_envelopes(spark, sample, dirty=False), sample_tables.product_detail(spark, sample)),
        "users": (sample_tables.user_envelopes(spark, sample, dirty=False), sample_tables.user_detail(spark, sample)),
        "carts": (
            sample_tables.cart_envelopes(spark, sample, "day", dirty=False),
            sample_tables.cart_detail(spark, sample, "day"),
        ),
    }
    for source, (envelopes, expected) in pairs.items():
        rows = details.detail_rows(source, envelopes)
        assert rows.schema.names == expected.schema.names
        assert rows.exceptAll(expected).isEmpty() and expected.exceptAll(rows).isEmpty(), source
