import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from colloquy.operators import support

AS_OF = "2024-03-31 12:00:00"


@pytest.fixture(scope="module")
def orders(spark):
    def order(key, status, estimated):
        return (f"ORD-{key}", status, dt.date(2024, 1, 1), estimated, "UPS", "UP1", 89.97, "1 Main St")

    day = dt.date(2024, 3, 1)
    rows = [order(s, s, day) for s in ("processing", "shipped", "out_for_delivery", "delivered", "cancelled")]
    # Delivered the day before the estimate: 30 and 31 days ago, and in the future.
    rows += [order("day30", "delivered", dt.date(2024, 3, 2)), order("day31", "delivered", dt.date(2024, 3, 1)),
             order("future", "delivered", dt.date(2024, 5, 1))]
    return spark.createDataFrame(
        rows, "order_id string, status string, order_date date, estimated_delivery date, carrier string, "
              "tracking_number string, total double, shipping_address string"
    )


@pytest.fixture(scope="module")
def accounts(spark):
    rows = [(f"{s}@x", s, plan, "Card 1", dt.date(2024, 4, 15))
            for s, plan in (("active", "Standard"), ("suspended", "Basic"), ("cancelled", "Basic"))]
    return spark.createDataFrame(
        rows, "email string, account_status string, subscription_plan string, payment_method string, next_billing_date date"
    )


def codes(out, key):
    return {r[key]: (r["success"], r["code"]) for r in out.collect()}


def ask(spark, column, values, extra="", fill=()):
    rows = [(i, v, *fill) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"request_id long, {column} string{extra}")


ORDER_IDS = ["ORD-processing", "ORD-shipped", "ORD-out_for_delivery", "ORD-delivered", "ORD-cancelled", "ORD-none", "X", None]
BAD = {"ORD-none": (None, "order_not_found"), "X": (None, "invalid_order_id"), None: (None, "invalid_order_id")}


def test_order_lookup(spark, orders):
    rows = {r["order_id"]: r for r in support.order_lookup(ask(spark, "order_id", ORDER_IDS), orders).collect()}
    assert rows["ORD-delivered"]["delivered_date"] == dt.date(2024, 2, 29)
    assert rows["ORD-shipped"]["delivered_date"] is None and rows["ORD-shipped"]["status"] == "shipped"
    assert rows["X"]["error"] == "Invalid order ID format: X. Expected format: ORD-XXXXXX"
    assert rows["ORD-none"]["code"] == "order_not_found" and rows["ORD-none"]["status"] is None


def test_address_change(spark, orders):
    out = support.address_change(ask(spark, "order_id", ORDER_IDS, ", new_address string", ("2 Side St",)), orders)
    refused = (False, "already_shipped")
    assert codes(out, "order_id") == {
        "ORD-processing": (True, "ok"), "ORD-cancelled": (True, "ok"), "ORD-shipped": refused,
        "ORD-out_for_delivery": refused, "ORD-delivered": refused, **BAD,
    }
    rows = {r["order_id"]: r for r in out.collect()}
    assert rows["ORD-shipped"]["carrier"] == "UPS" and rows["ORD-processing"]["carrier"] is None
    assert rows["ORD-processing"]["old_address"] == "1 Main St"
    assert "order is already shipped" in rows["ORD-shipped"]["error"]


def test_cancel_order(spark, orders):
    out = support.cancel_order(ask(spark, "order_id", ORDER_IDS), orders, AS_OF)
    refused = (False, "already_shipped")
    assert codes(out, "order_id") == {
        "ORD-processing": (True, "ok"), "ORD-cancelled": (False, "already_cancelled"), "ORD-shipped": refused,
        "ORD-out_for_delivery": refused, "ORD-delivered": refused, **BAD,
    }
    good = out.where("code = 'ok'").first()
    assert (good["refund_amount"], good["cancelled_at"]) == (89.97, "2024-03-31 12:00 UTC")


def test_returns_at_the_edge_of_the_window(spark, orders):
    ids = ["ORD-day30", "ORD-day31", "ORD-future", "ORD-shipped", "X"]
    out = support.return_eligibility(ask(spark, "order_id", ids), orders, AS_OF)
    assert codes(out, "order_id") == {
        "ORD-day30": (True, "ok"), "ORD-day31": (False, "window_expired"), "ORD-future": (True, "ok"),
        "ORD-shipped": (False, "not_delivered"), "X": (None, "invalid_order_id"),
    }
    rows = {r["order_id"]: r for r in out.collect()}
    assert rows["ORD-day31"]["error"].endswith("(delivered 31 days ago).")
    assert rows["ORD-day30"]["return_label_url"] == "https://returns.example.com/label/ORD-day30"


EMAILS = ["active@x", "suspended@x", "cancelled@x", "none@x", "no-at", None]
BAD_MAIL = {"none@x": (None, "account_not_found"), "no-at": (None, "invalid_email"), None: (None, "invalid_email")}


def test_account_lookup_and_unlock(spark, accounts):
    asked = ask(spark, "email", EMAILS)
    found = {r["email"]: r for r in support.account_lookup(asked, accounts).collect()}
    assert found["active@x"]["subscription_plan"] == "Standard" and found["no-at"]["error"] == "Invalid email address: no-at"
    assert codes(support.account_unlock(asked, accounts, AS_OF), "email") == {
        "active@x": (True, "ok"), "suspended@x": (True, "ok"), "cancelled@x": (False, "account_cancelled"), **BAD_MAIL,
    }


def test_plan_change(spark, accounts):
    rows = [(0, "active@x", "Premium"), (1, "active@x", "Basic"), (2, "active@x", "Standard"), (3, "suspended@x", "Premium"),
            (4, "no-at", "UltraPro"), (5, "no-at", "Basic"), (6, "cancelled@x", "Basic"), (7, "active@x", None)]
    asked = spark.createDataFrame(rows, "request_id long, email string, new_plan string")
    out = {r["request_id"]: r for r in support.plan_change(asked, accounts).collect()}
    assert [out[i]["code"] for i in range(8)] == [
        "ok", "ok", "same_plan", "account_blocked", "invalid_plan", "invalid_email", "account_blocked", "invalid_plan"
    ]
    assert (out[0]["old_price"], out[0]["new_price"], out[0]["proration_credit"], out[0]["effective_date"]) == (
        "$19.99/month", "$39.99/month", "$20.00", "immediately")
    assert (out[1]["proration_credit"], out[1]["effective_date"]) == ("N/A", "next billing cycle")
    assert out[0]["message"].startswith("Upgraded from Standard to Premium.")
    assert out[4]["error"] == "Invalid plan: UltraPro. Available plans: ['Basic', 'Standard', 'Premium']"


def test_cancel_subscription(spark, accounts):
    out = support.cancel_subscription(ask(spark, "email", EMAILS), accounts, AS_OF)
    assert codes(out, "email") == {
        "active@x": (True, "ok"), "suspended@x": (True, "ok"), "cancelled@x": (False, "already_cancelled"), **BAD_MAIL,
    }
    assert out.where("email = 'active@x'").first()["access_until"] == "2024-04-15"


@pytest.mark.parametrize("amount,email,success,code", [
    (0.0, "active@x", None, "refund_not_positive"), (-1.0, "no-at", None, "refund_not_positive"),
    (0.01, "active@x", True, "ok"), (500.0, "active@x", True, "ok"), (500.01, "no-at", False, "escalated"),
    (999.99, "active@x", False, "escalated"), (49.99, "no-at", None, "invalid_email"), (None, "active@x", None, "refund_not_positive"),
])
def test_refunds(spark, accounts, amount, email, success, code):
    asked = spark.createDataFrame([(1, email, "ORD-1", amount)], "request_id long, email string, order_id string, amount double")
    row = support.refund_routing(asked, accounts, AS_OF).first()
    assert (row["success"], row["code"]) == (success, code)
    if code == "ok":
        assert row["refund_id"].startswith("REF-") and len(row["refund_id"]) == 10
    if code == "escalated":
        assert row["escalated"] and f"${amount:.2f}" in row["error"]


def test_mixed_batch_agrees_with_single_operators(spark, orders, accounts):
    rows = [(0, "cancel_order", "ORD-processing", "active@x", None, None), (1, "process_refund", "X", "active@x", None, 12.5),
            (2, "unlock_account", None, "cancelled@x", None, None), (3, "dance", None, None, None, None),
            (4, "get_return_label", "ORD-day31", None, None, None)]
    asked = spark.createDataFrame(
        rows, "request_id long, action string, order_id string, email string, new_plan string, amount double")
    out = support.adjudicate(asked, orders, accounts, AS_OF)
    got = {r["request_id"]: (r["success"], r["code"], r["refund_amount"] and float(r["refund_amount"])) for r in out.collect()}
    assert got == {0: (True, "ok", 89.97), 1: (True, "ok", 12.5), 2: (False, "account_cancelled", None),
                   3: (None, "unknown_action", None), 4: (False, "window_expired", None)}
    total = support.adjudication_summary(out).agg({"n_requests": "sum"}).first()[0]
    assert total == 5


@pytest.mark.parametrize("text,tool,args", [
    ('Sure.\n  TOOL_CALL: lookup_order({"order_id": "ORD-1"})\nbye', "lookup_order", {"order_id": "ORD-1"}),
    ('TOOL_CALL:cancel_order ( {"order_id": "A(1)", "reason": "x"} ) thanks', "cancel_order", {"order_id": "A(1)", "reason": "x"}),
    ("TOOL_CALL: lookup_order(not json)", "lookup_order", {}),
    ("TOOL_CALL: lookup_order({'order_id': 1})", "lookup_order", {}),
    ("TOOL_CALL: f()\nTOOL_CALL: g()", "f", {}),
    ('\n\n\tTOOL_CALL: f({"n": 5})', "f", {"n": "5"}),
    ("I would use TOOL_CALL: f()", None, None),
    ("TOOL_CALL: no parenthesis", None, None),
    ("TOOL_CALL:\nf()", None, None),
    ("nothing", None, None),
    (None, None, None),
])
def test_tool_call_extraction(spark, text, tool, args):
    row = support.with_tool_call(spark.createDataFrame([(text,)], "text string")).first()
    assert (row["tool"], row["args"]) == (tool, args)


def test_tool_call_checks(spark):
    texts = ['TOOL_CALL: lookup_order({"order_id": "1"})', 'TOOL_CALL: cancel_order({"order_id": "1", "reason": "r"})',
             "TOOL_CALL: lookup_order({bad)", 'TOOL_CALL: lookup_order({"order_id": "1", "x": 2})', "TOOL_CALL: fly({})", "hello"]
    calls = support.with_tool_call(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string"))
    got = {r["id"]: r["code"] for r in support.check_tool_calls(calls).collect()}
    assert got == {0: "ok", 1: "ok", 2: "bad_arguments", 3: "bad_arguments", 4: "unknown_tool"}
    assert support.invalid_tool_calls(calls).count() == 3
    assert {r["tool"]: r["n_calls"] for r in support.tool_usage(calls).collect()}["lookup_order"] == 3


def test_arguments_must_be_one_whole_object(spark):
    texts = ['f({"a": 1} x)', 'f({"a": {"b":1}}) thanks :)', 'f({"a": 1}] [{"b": 2})', 'f({"a": 1} {"b": 2})', 'f({"a": 1}, {"b": 2})', 'f({"a": "(x)"})']
    table = spark.createDataFrame([(i, f"TOOL_CALL: {t}") for i, t in enumerate(texts)], "id int, text string")
    rows = support.with_tool_call(table).orderBy("id").collect()
    assert [r["tool"] for r in rows] == ["f"] * 6
    assert [r["args"] for r in rows] == [{}, {}, {}, {}, {}, {"a": "(x)"}]


def test_money_nan_and_unknown_stored_plan(spark):
    accounts = spark.createDataFrame(
        [("a@x", "active", "Gold", "Card"), ("a@x", "active", "Gold", "Card"), ("b@x", "active", "Basic", "Card")],
        "email string, account_status string, subscription_plan string, payment_method string",
    )
    refunds = spark.createDataFrame(
        [(1, "b@x", "ORD-1", 2.675), (2, "b@x", "ORD-1", float("nan")), (3, "a@x", "ORD-1", 5.0)],
        "request_id int, email string, order_id string, amount double",
    )
    rows = {r["request_id"]: r for r in support.refund_routing(refunds, accounts, "1998-01-01").collect()}
    assert len(rows) == 3 and rows[1]["refund"] == "$2.68"
    assert (rows[2]["code"], rows[2]["success"]) == ("refund_not_positive", None)
    plans = spark.createDataFrame([(1, "a@x", "Basic"), (2, "b@x", "Premium")], "request_id int, email string, new_plan string")
    rows = {r["request_id"]: r for r in support.plan_change(plans, accounts).collect()}
    assert len(rows) == 2 and rows[2]["code"] == "ok"
    assert (rows[1]["code"], rows[1]["success"]) == ("unknown_stored_plan", None)


def test_answers_are_whole_and_as_json_dumps_writes_them(spark):
    orders = spark.createDataFrame(
        [("ORD-1", "shipped", "1998-01-02", "1998-01-08", "UPS", "UP1", [("a \"b\"", 2, 1.5)], 3.0, "1 é St"), ("ORD-2", "delivered", "1998-01-02", "1998-01-08", "DHL", "DH2", [], 9.99, "2 St")],
        "order_id string, status string, order_date string, estimated_delivery string, carrier string, tracking_number string, "
        "items array<struct<name string, quantity int, price double>>, total double, shipping_address string",
    ).withColumns({c: F.col(c).cast("date") for c in ("order_date", "estimated_delivery")})
    accounts = spark.createDataFrame([("a@x", "active", "Basic", "Card"), ("b@x", "suspended", "Basic", "Card")], "email string, account_status string, subscription_plan string, payment_method string").withColumns(
        {"member_since": F.lit("1990-05-06").cast("date"), "billing_cycle": F.lit("monthly"), "next_billing_date": F.lit("1998-02-03").cast("date")})
    calls = [
        ('lookup_order({"order_id": "ORD-1"})', {"order_id": "ORD-1", "status": "shipped", "order_date": "1998-01-02", "estimated_delivery": "1998-01-08", "carrier": "UPS", "tracking_number": "UP1",
                                               "items": [{"name": 'a "b"', "quantity": 2, "price": 1.5}], "total": 3.0, "shipping_address": "1 é St"}),
        ('cancel_order({"order_id": "ORD-1"})', {"success": False, "error": "Cannot cancel — order is already shipped. Please use our return process once the package arrives."}),
        ('lookup_order({"order_id": "ORD-2"})', {"order_id": "ORD-2", "status": "delivered", "order_date": "1998-01-02", "estimated_delivery": "1998-01-08", "carrier": "DHL", "tracking_number": "DH2",
                                               "items": [], "total": 9.99, "shipping_address": "2 St", "delivered_date": "1998-01-07"}),
        ('update_subscription({"customer_email": "a@x", "new_plan": "Premium"})', {
            "success": True, "email": "a@x", "old_plan": "Basic", "new_plan": "Premium", "old_price": "$9.99/month", "new_price": "$39.99/month", "effective_date": "immediately",
            "proration_credit": "$30.00", "message": "Upgraded from Basic to Premium. New features are available now."}),
        ('update_subscription({"customer_email": "b@x", "new_plan": "Premium"})', {"success": False, "error": "Cannot change plan — account is suspended."}),
        ('process_refund({"customer_email": "a@x", "order_id": "ORD-1", "amount": 501, "reason": "r"})', {
            "success": False, "error": "Refund of $501.00 exceeds the automated limit ($500). A senior agent will review and process this within 24 hours.", "escalated": True}),
        ('cancel_subscription({"customer_email": "a@x"})', {
            "success": True, "email": "a@x", "cancellation_date": "1998-01-10", "access_until": "1998-02-03", "reason": None,
            "message": "Subscription cancelled. You'll retain access until 1998-02-03. No further charges will be made.", "reactivation_info": "You can reactivate your subscription at any time."}),
        ('unlock_account({"customer_email": "nobody"})', {"error": "Invalid email address: nobody"}),
        ('fly({})', {"error": "Unknown tool: fly"}), ('lookup_order({"x": 1})', {"error": "Tool call failed"}),
    ]
    table = spark.createDataFrame([(i, "TOOL_CALL: " + c) for i, (c, _) in enumerate(calls)], "request_id long, text string").withColumn("extra", F.lit("kept"))
    rows = {r["request_id"]: r for r in support.call_outcomes(support.with_tool_call(table), orders, accounts, "1998-01-10 10:00:00").collect()}
    for i, (_, want) in enumerate(calls):
        text = rows[i]["tool_result"]
        assert json.loads(text) == want and rows[i]["extra"] == "kept" and list(json.loads(text)) == list(want)
        if "total" not in want and "Tool" not in str(want) and "tool" not in str(want):
            assert text == json.dumps(want, indent=2)


def test_mixed_batches_scan_little_and_stand_a_hot_key(spark, tmp_path):
    requests = spark.range(900).select(
        F.col("id").alias("request_id"), F.lit("lookup_order").alias("action"), F.when(F.col("id") % 3 == 0, "ORD-1").otherwise(F.concat(F.lit("ORD-"), F.col("id"))).alias("order_id"),
        F.lit("a@x").alias("email"), F.lit("Basic").alias("new_plan"), F.lit(1.0).alias("amount"))
    orders = spark.range(600).select(F.concat(F.lit("ORD-"), F.col("id")).alias("order_id"), F.lit("shipped").alias("status"), F.lit(2.0).alias("total"), F.lit("1998-01-01").cast("date").alias("estimated_delivery"))
    accounts = spark.createDataFrame([("a@x", "active", "Basic", "Card")], "email string, account_status string, subscription_plan string, payment_method string")
    tables = []
    for name, df in (("r", requests), ("o", orders), ("a", accounts)):
        df.write.parquet(f"{tmp_path}/{name}")
        tables.append(spark.read.parquet(f"{tmp_path}/{name}"))
    out = support.adjudicate(*tables, "1998-01-31")
    codes = {r["request_id"]: r["code"] for r in out.collect()}
    assert len(codes) == 900 and all(codes[i] == ("ok" if i % 3 == 0 or i < 600 else "order_not_found") for i in codes)
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") <= 5, final.count("FileScan")


def test_calls_are_cut_at_every_line_end_and_white_space_character(spark):
    def is_in(body, c):
        ranges = [[ord(x) if len(x) == 1 else int(x.strip("\\x{}"), 16) for x in part] for part in body]
        return any(r[0] <= ord(c) <= r[-1] for r in ranges)

    ends = [["\n", "\r"], ["1c", "1e"], ["85"], ["2028"], ["2029"]]
    spaces = [["\t", "\r"], ["1c", "20"], ["85"], ["a0"], ["1680"], ["2000", "200a"], ["2028"], ["2029"], ["202f"], ["205f"], ["3000"]]
    chars = [chr(c) for c in [*range(0x100), 0x1680, 0x180E, *range(0x2000, 0x2070), 0x3000, 0xFEFF] if chr(c) not in "()"]
    rows = [(c, f"hm{c}TOOL_CALL: f{{}}\n{c}TOOL_CALL:{c}g{c}({{}}){c}x)") for c in chars]
    got = {r["c"]: r["tool"] for r in support.with_tool_call(spark.createDataFrame(rows, "c string, text string")).collect()}
    for c in chars:
        end, space = is_in(ends, c), is_in(spaces, c)
        # A line end in front starts a line with a call that has no parentheses.
        want = None if end or not space else "g"
        assert got[c] == want, hex(ord(c))


def test_fields_of_a_json_object_are_those_of_the_whole_text(spark):
    from colloquy.functions.text import json_object, json_object_fields

    texts = ['{"a": 1}', "{}", ' {"a":{"b":[1, 2]}} ', '{"a":null}', "[1]", '"{"', "{", '{"a":1} x', '{"a": 1}] [{"b": 2}', '{"a":1},{"b":2}', '{"a":1}{"b":2}', "{'a':1}",
             '{"a":"\\u00e9"}', "", None, "null", '{"a":1},', '{"a":NaN}', '{"__end":1}', '{"a":1}}', '{"a":[1,]}', '\n{"a":\n1}\n']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    known = F.from_json(json_object("t"), "map<string,string>", {"allowSingleQuotes": "false"})
    for r in df.select("t", known.alias("want"), json_object_fields("t").alias("got")).collect():
        assert r["got"] == r["want"], r["t"]
    # A text that brings an end of its own is not one object.
    assert df.limit(1).select(json_object_fields(F.lit('{"a":1},{"__end":1}] [')).alias("x")).first()["x"] is None


def test_outcomes_read_the_texts_twice_and_shuffle_the_state_once(spark, tmp_path):
    # Fitting calls, calls with wrong arguments, unknown tools, texts without a call and null texts.
    text = F.when(F.col("id") % 5 == 0, 'TOOL_CALL: lookup_order({"x": 1})').when(F.col("id") % 5 == 1, "TOOL_CALL: fly({})").when(F.col("id") % 5 == 2, "hello").when(
        F.col("id") % 5 == 3, F.concat(F.lit('TOOL_CALL: lookup_order({"order_id": "ORD-'), F.col("id"), F.lit('"})')))
    spark.range(500).select(F.col("id").alias("request_id"), text.alias("text")).write.parquet(f"{tmp_path}/c")
    spark.range(300).select(F.concat(F.lit("ORD-"), F.col("id")).alias("order_id"), *[F.lit("shipped").alias(c) for c in ("status", "carrier", "tracking_number", "shipping_address")],
                            *[F.lit("1998-01-01").cast("date").alias(c) for c in ("order_date", "estimated_delivery")], F.lit(2.0).alias("total"),
                            F.array(F.struct(F.lit("n").alias("name"), F.lit(1).alias("quantity"), F.lit(2.0).alias("price"))).alias("items")).write.parquet(f"{tmp_path}/o")
    accounts = spark.createDataFrame([("a@x", "active", "Basic", "Card")], "email string, account_status string, subscription_plan string, payment_method string").withColumns(
        {"member_since": F.lit("1990-05-06").cast("date"), "billing_cycle": F.lit("monthly"), "next_billing_date": F.lit("1998-02-03").cast("date")})
    calls = support.with_tool_call(spark.read.parquet(f"{tmp_path}/c"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = support.call_outcomes(calls, spark.read.parquet(f"{tmp_path}/o"), accounts, "1998-01-31")
        rows = {r["request_id"]: r for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert {i: rows[i]["code"] for i in (0, 1, 3, 498)} == {0: "bad_arguments", 1: "unknown_tool", 3: "ok", 498: "order_not_found"}
    assert len(rows) == 300 and json.loads(rows[1]["tool_result"]) == {"error": "Unknown tool: fly"}
    # Once for the hot keys and once for the answers; the orders and the requests are each dealt out once by order.
    assert plan.count(f"{tmp_path}/c]") == 2 and plan.count("hashpartitioning(order_id") == 2, plan
