"""Event validation against hand-written cases (FIXTURES.md §2).

Each test runs its cases as one batch of lines (one Spark job), then checks
every line's outcome: its validated payload or its reject reason.
"""

import json

from conftest import lines_df
from shopflow.operators.events import check_lines, validate_events

BASE = {"timestamp": "2025-01-02T03:04:05Z", "user_id": "u1", "device": "mobile", "session_id": "s1"}


def ev(event_type, **payload):
    d = dict(BASE, event_type=event_type)
    d.update(payload)
    return json.dumps(d)


def with_fields(kind, drop=(), **fields):
    d = json.loads(ev(kind))
    d.update(fields)
    for k in drop:
        d.pop(k, None)
    return json.dumps(d)


def run(spark, lines):
    valid, rejects = validate_events(lines_df(spark, lines))
    v = {x["_row"]: x for x in (r.asDict(recursive=True) for r in valid.collect())}
    r = {x["_row"]: x["reason"] for x in rejects.collect()}
    return v, r


def check_cases(spark, cases, make, pick):
    """cases: [(raw, expected)]; expected is a reject reason (str starting with
    a capital or quote) or the expected value picked from the valid row."""
    v, r = run(spark, [make(raw) for raw, _ in cases])
    for i, (raw, expected) in enumerate(cases):
        if isinstance(expected, str) and (expected[:1].isupper() or expected[:1] in "'c"):
            assert r.get(i) == expected, (raw, r.get(i), v.get(i))
        else:
            assert i in v, (raw, r.get(i))
            got = pick(v[i])
            assert got == expected, (raw, got)


def test_one_valid_line_per_type(spark):
    lines = [
        ev("page_view", url_path="/p/1", http_status=200),
        ev("product_search", query="shoes"),
        ev("cart_view", cart_items=[{"product_id": "p1"}]),
        ev("add_to_cart", product_id="p1", quantity=2),
        ev("remove_from_cart", product_id="p1", quantity=1),
        ev("wishlist_add", product_id="p1"),
        ev("checkout_start", cart_value=10.5),
        ev("payment_attempt", payment_type="card", success=True),
        ev("order_complete", order_id="o1"),
        ev("review_submit", product_id="p1", rating=5),
    ]
    v, r = run(spark, lines)
    assert r == {}
    assert len(v) == 10
    d = {x["event_type"]: x["event_data"] for x in v.values()}
    assert d["page_view"]["duration_sec"] == 0
    assert d["product_search"]["results_count"] == 0 and d["product_search"]["clicked_position"] is None
    assert d["cart_view"]["cart_items"] == [{"product_id": "p1", "price": 0.0, "quantity": 1}]
    assert d["cart_view"]["cart_value"] == 0.0
    assert d["wishlist_add"]["wishlist_name"] == "default"
    assert d["review_submit"]["text_length"] == 0
    assert d["payment_attempt"]["success"] is True
    assert d["order_complete"]["product_id"] is None  # other types' fields stay NULL
    assert v[0]["ingestion"]["source_file"] == "f.json"


def test_bad_lines(spark):
    v, r = run(spark, ["", "   ", "{bad", "[1]", "5", "null"])
    assert v == {}
    # blank lines are skipped silently, rows 0 and 1 do not appear
    assert r == {2: "Invalid JSON", 3: "'list' object has no attribute 'get'",
                 4: "'int' object has no attribute 'get'", 5: "'NoneType' object has no attribute 'get'"}


def test_common_fields_blank(spark):
    cases, lines = [], []
    for field in ["timestamp", "user_id", "event_type", "device", "session_id"]:
        for blank in [None, "", "None", " NaN ", "null"]:
            d = json.loads(ev("order_complete", order_id="o1"))
            if blank is None:
                del d[field]
            else:
                d[field] = blank
            lines.append(json.dumps(d))
            cases.append(f"Missing required common field: {field}")
    v, r = run(spark, lines)
    assert v == {}
    assert r == dict(enumerate(cases))


def test_whitespace_user_is_kept_as_empty_and_strings_stripped(spark):
    v, r = run(spark, [with_fields("order_complete", order_id=" o1 ", user_id="  ", fulfillment_speed=5)])
    assert r == {}
    assert v[0]["user_id"] == "" and v[0]["event_data"]["order_id"] == "o1"
    assert v[0]["event_data"]["fulfillment_speed"] == "5"


def test_event_type_exact(spark):
    v, r = run(spark, [with_fields("page_view", event_type="Page_View"),
                       with_fields("page_view", event_type=" page_view"),
                       with_fields("page_view", event_type=5)])
    assert r == {0: "Unknown event_type: Page_View", 1: "Unknown event_type:  page_view",
                 2: "Unknown event_type: 5"}


def test_cast_int(spark):
    check_cases(spark, [
        (3.7, 3), (" 3 ", 3), (True, 1), (-3.7, -3), (1e3, 1000), ("+4", 4), (False, 0),
        ("3.7", "Cannot cast field 'rating' to int: 3.7"),
        ({}, "Cannot cast field 'rating' to int: {}"),
        (3000000000, "Cannot cast field 'rating' to int: 3000000000"),
        ("1_000", "Cannot cast field 'rating' to int: 1_000"),
        ("  ", "Cannot cast field 'rating' to int:   "),
        (None, "Required int field is null: rating"),
        ("nan", "Required int field is null: rating"),
    ], lambda raw: ev("review_submit", product_id="p1", rating=raw), lambda row: row["event_data"]["rating"])


def test_optional_int_defaults(spark):
    check_cases(spark, [(None, 0), ("", 0), ("null", 0), (7, 7), ("x", "Cannot cast field 'text_length' to int: x")],
                lambda raw: ev("review_submit", product_id="p1", rating=1, text_length=raw),
                lambda row: row["event_data"]["text_length"])


def test_cast_bool(spark):
    check_cases(spark, [
        (True, True), ("YES", True), (0, False), ("n", False), (" y ", True), (1, True), (False, False),
        # JSON 1.0 parses as the integer 1 in Spark's variant (trailing zeros
        # are normalised away), so only a non-zero fraction shows the float.
        (1.5, "Cannot cast field 'success' to bool: 1.5"),
        ("maybe", "Cannot cast field 'success' to bool: maybe"),
        (None, "Required bool field is null: success"),
    ], lambda raw: ev("payment_attempt", payment_type="card", success=raw),
        lambda row: row["event_data"]["success"])


def test_cast_float(spark):
    check_cases(spark, [
        (10, 10.0), ("2.5", 2.5), (" inf ", float("inf")), (True, 1.0), ("1e3", 1000.0),
        ("abc", "Cannot cast field 'cart_value' to float: abc"),
        ([1], "Cannot cast field 'cart_value' to float: [1]"),
        (None, "Required float field is null: cart_value"),
    ], lambda raw: ev("checkout_start", cart_value=raw), lambda row: row["event_data"]["cart_value"])


def test_cast_datetime(spark):
    fmt = "%Y-%m-%d %H:%M:%S.%f"
    check_cases(spark, [
        ("2025-01-02T03:04:05Z", "2025-01-02 03:04:05.000000"),
        ("2025-01-02T03:04:05+03:30", "2025-01-01 23:34:05.000000"),
        ("2025-01-02T03:04:05.250", "2025-01-02 03:04:05.250000"),
        ("2025-01-02 03:04:05", "2025-01-02 03:04:05.000000"),
        ("2025-01-02", "2025-01-02 00:00:00.000000"),
        ("2025", "Cannot cast field 'timestamp' to datetime: 2025"),
        ("bad", "Cannot cast field 'timestamp' to datetime: bad"),
        ("2025-02-30", "Cannot cast field 'timestamp' to datetime: 2025-02-30"),
    ], lambda raw: with_fields("order_complete", order_id="o1", timestamp=raw),
        lambda row: row["timestamp"].strftime(fmt))


def test_required_default_is_dead_and_error_order(spark):
    v, r = run(spark, [ev("add_to_cart", product_id="p1"),
                       with_fields("add_to_cart", product_id="p1", timestamp="bad"),
                       with_fields("add_to_cart", product_id=None, quantity="x")])
    assert r == {0: "Required int field is null: quantity",
                 1: "Required int field is null: quantity",
                 2: "Required string field is null: product_id"}


def test_cart_items(spark):
    check_cases(spark, [
        (None, []), ([], []),
        ("x", "cart_items must be list, got: <class 'str'>"),
        (5, "cart_items must be list, got: <class 'int'>"),
        ([1], "'int' object has no attribute 'get'"),
        ([None], "'NoneType' object has no attribute 'get'"),
        ([{"price": 1}], "Required string field is null: cart_items.product_id"),
        ([{"product_id": " p9 "}], [{"product_id": "p9", "price": 0.0, "quantity": 1}]),
        ([{"product_id": "p1", "price": "2.5", "quantity": "3"}],
         [{"product_id": "p1", "price": 2.5, "quantity": 3}]),
        ([{"product_id": "p1"}, {"product_id": "p2", "quantity": "x"}],
         "Cannot cast field 'cart_items.quantity' to int: x"),
    ], lambda raw: with_fields("cart_view", cart_items=raw) if raw is not None else ev("cart_view"),
        lambda row: row["event_data"]["cart_items"])


def test_reject_line_numbers(spark, tmp_dir):
    from shopflow.sources.files import scan_jsonl
    with open(f"{tmp_dir}/a.json", "w") as fh:
        fh.write(ev("order_complete", order_id="o1") + "\n\n{bad\n" + ev("order_complete") + "\n")
    with open(f"{tmp_dir}/b.json", "w") as fh:
        fh.write("[]\n")
    valid, rejects = validate_events(scan_jsonl(spark, tmp_dir))
    got = sorted((r["source_file"], r["line"], r["reason"]) for r in rejects.collect())
    assert got == [("a.json", 3, "Invalid JSON"), ("a.json", 4, "Required string field is null: order_id"),
                   ("b.json", 1, "'list' object has no attribute 'get'")]
    assert valid.count() == 1


def test_output_schema_is_the_declared_one(spark):
    from shopflow.schemas import VALID_EVENT
    valid, _ = validate_events(lines_df(spark, [ev("order_complete", order_id="o1")]))
    got = valid.select(*VALID_EVENT.fieldNames()).schema
    assert [(f.name, f.dataType) for f in got.fields] == [(f.name, f.dataType) for f in VALID_EVENT.fields]


def test_cart_items_are_taken_apart_once(spark):
    """per element, types and casts are computed once, and odd elements give the errors of the source."""
    head = '{"timestamp": "2025-01-02T03:04:05Z", "user_id": "u1", "event_type": "cart_view", "device": "mobile", "session_id": "s1", "cart_items": '
    cases = {'[]}': [], 'null}': [], '[{"product_id": 5}]}': [("5", 0.0, 1)], '[{"product_id": " p ", "price": " 2.5 ", "quantity": true}]}': [("p", 2.5, 1)],
             '[{"product_id": "p", "price": null, "quantity": 3.7, "price": 4}]}': [("p", 4.0, 3)], '[{"product_id": true}, {"product_id": 1.5}]}': [("True", 0.0, 1), ("1.5", 0.0, 1)],
             '[{"product_id": "a"}, 7]}': "'int' object has no attribute 'get'", '[null]}': "'NoneType' object has no attribute 'get'", '[[1]]}': "'list' object has no attribute 'get'",
             '[{"product_id": "a"}, {"price": 1}]}': "Required string field is null: cart_items.product_id",
             '[{"product_id": "a", "quantity": "3.7"}]}': "Cannot cast field 'cart_items.quantity' to int: 3.7",
             '[{"product_id": "a", "price": "x"}]}': "Cannot cast field 'cart_items.price' to float: x", '{"a": 1}}': "cart_items must be list, got: <class 'dict'>"}
    lines = spark.createDataFrame([(head + c,) for c in cases], "value string")
    checked = check_lines(lines)
    got = {r["value"][len(head):]: r["reason"] or [tuple(i) for i in r["event_data"]["cart_items"]] for r in checked.collect()}
    assert got == cases
    assert checked._jdf.queryExecution().optimizedPlan().toString().count("schemaOfVariant") < 40
