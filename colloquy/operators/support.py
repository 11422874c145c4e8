"""Tool calls in transcripts, and batches of customer requests decided by rules.

A request joins the state table of its order or account and runs through an ordered list of
rules; the first rule that applies gives the outcome code. ``success`` is true, false, or
null where the request itself was malformed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import fixed_values as fixed
from colloquy.functions.text import fill, json_object_fields
from colloquy.operators.joins import hot_salts, lookup_join

Rules = list[tuple[Column, str]]

# ---------------------------------------------------------------- tool calls in text

# The fixed classes of white space and of line ends under ``(?U)``: few tests a character where the lists of their ranges take many.
_SPACE = r"\s\x1c-\x1f"
_LINE_END = r"\v\x1c-\x1e"


def with_tool_call(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``tool`` and ``args`` of the first line that calls a tool; null if there is none.

    Arguments that are not a JSON object become an empty map; a call without parentheses
    has no tool name.
    """
    mark = fixed.TOOL_CALL_MARK
    # The rest of the first line that has nothing but white space before the mark.
    call = F.regexp_extract(text, rf"(?U)(?:^|[{_LINE_END}])[{_SPACE}]*+{mark}[{_SPACE}&&[^{_LINE_END}]]*+([^{_LINE_END}]*+)", 1)
    # The name, and everything up to the last closing parenthesis.
    parts = F.transform(F.array(call), lambda c: F.struct(
        F.regexp_extract(c, rf"(?U)^[^({_SPACE}][^(]*?(?=[{_SPACE}]*\(.*\))", 0).alias("__tool"),
        F.regexp_extract(c, r"\((.*)\)", 1).alias("__given"),
    ))
    # Texts without the mark skip the regular expressions. The array keeps a later test of ``tool`` from running them again.
    found = df.withColumn("__call", F.when(F.col(text).contains(mark), parts))
    one = found.select(*df.columns, F.inline_outer("__call"))
    empty = F.create_map().cast("map<string,string>")
    called = F.col("__tool") != ""
    return one.select(
        *df.columns, F.when(called, F.col("__tool")).alias("tool"),
        F.when(called, F.coalesce(json_object_fields("__given"), empty)).alias("args"),
    )


def tool_usage(calls: DataFrame) -> DataFrame:
    called = calls.where(F.col("tool").isNotNull())
    return called.groupBy("tool").agg(F.count(F.lit(1)).alias("n_calls"))


def tool_catalogue(spark: SparkSession) -> DataFrame:
    """``tool, required, optional``: one row per known tool."""
    def texts(names: list[str]) -> Column:
        return F.array(*map(F.lit, names)).cast("array<string>")

    rows = [
        F.struct(F.lit(name).alias("tool"), texts(need).alias("required"), texts(may).alias("optional"))
        for name, (need, may) in fixed.TOOL_CATALOGUE.items()
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def check_tool_calls(calls: DataFrame, catalogue: DataFrame | None = None) -> DataFrame:
    """Add ``code`` (ok, unknown_tool, bad_arguments) and ``error`` to rows with a call.

    The built-in catalogue is a handful of rows and is broadcast; one passed in is joined
    as the optimizer sees fit.
    """
    called = calls.where(F.col("tool").isNotNull())
    known = F.broadcast(tool_catalogue(calls.sparkSession)) if catalogue is None else catalogue
    given = F.map_keys("args")
    joined = called.join(known, "tool", "left")
    fits = (F.size(F.array_except("required", given)) == 0) & (
        F.size(F.array_except(given, F.concat("required", "optional"))) == 0
    )
    code = (
        F.when(F.col("required").isNull(), "unknown_tool").when(fits, "ok").otherwise("bad_arguments")
    )
    error = F.when(F.col("required").isNull(), F.concat(F.lit("Unknown tool: "), F.col("tool"))).when(
        ~fits, F.lit("Tool call failed")
    )
    return joined.select(*calls.columns, code.alias("code"), error.alias("error"))


def invalid_tool_calls(calls: DataFrame, catalogue: DataFrame | None = None) -> DataFrame:
    return check_tool_calls(calls, catalogue).where(F.col("code") != "ok")


# ---------------------------------------------------------------- rules

# Codes of requests that are malformed or name nothing known: success stays null.
MALFORMED = [
    "invalid_order_id", "order_not_found", "invalid_email", "account_not_found", "invalid_plan",
    "refund_not_positive", "unknown_action", "unknown_stored_plan",
]


def _code(rules: Rules) -> Column:
    chain = None
    for condition, code in rules:
        condition = F.coalesce(condition, F.lit(False))
        chain = F.when(condition, code) if chain is None else chain.when(condition, code)
    return F.lit("ok") if chain is None else chain.otherwise("ok")


def _success() -> Column:
    return F.when(F.col("code") == "ok", True).when(~F.col("code").isin(MALFORMED), False)


def _text(key: str, *values: Column) -> Column:
    return fill(fixed.MESSAGES[key], **{str(i): v for i, v in enumerate(values)})


def _order_rules() -> Rules:
    well_formed = F.coalesce(F.col("order_id").startswith(fixed.ORDER_ID_PREFIX), F.lit(False))
    return [(~well_formed, "invalid_order_id"), (F.col("__order").isNull(), "order_not_found")]


def _account_rules() -> Rules:
    well_formed = F.coalesce(F.col("email").contains("@"), F.lit(False))
    return [(~well_formed, "invalid_email"), (F.col("__account").isNull(), "account_not_found")]


_STATUS = "__order.status"
_ACCOUNT_STATUS = "__account.account_status"


def _address_rules() -> Rules:
    return [*_order_rules(), (F.col(_STATUS).isin(fixed.SHIPPED_STATUSES), "already_shipped")]


def _cancel_rules() -> Rules:
    return [*_address_rules(), (F.col(_STATUS) == "cancelled", "already_cancelled")]


def _days_since_delivery(as_of: Column) -> Column:
    return F.datediff(as_of, F.col("__order.delivered_date"))


def _return_rules(as_of: Column) -> Rules:
    return [
        *_order_rules(),
        (F.col(_STATUS) != "delivered", "not_delivered"),
        (_days_since_delivery(as_of) > fixed.RETURN_WINDOW_DAYS, "window_expired"),
    ]


def _unlock_rules() -> Rules:
    return [*_account_rules(), (F.col(_ACCOUNT_STATUS) == "cancelled", "account_cancelled")]


def _plan_rules() -> Rules:
    known = F.coalesce(F.col("new_plan").isin(list(fixed.PLAN_PRICES)), F.lit(False))
    return [
        (~known, "invalid_plan"),
        *_account_rules(),
        (F.col(_ACCOUNT_STATUS).isin("suspended", "cancelled"), "account_blocked"),
        (~F.coalesce(F.col("__account.subscription_plan").isin(list(fixed.PLAN_PRICES)), F.lit(False)), "unknown_stored_plan"),
        (F.col("__account.subscription_plan") == F.col("new_plan"), "same_plan"),
    ]


def _subscription_rules() -> Rules:
    return [*_account_rules(), (F.col(_ACCOUNT_STATUS) == "cancelled", "already_cancelled")]


def _money(amount: str) -> Column:
    """An amount as decimal(18,2); null for NaN and for what is out of range."""
    number = F.col(amount)
    return F.when(~F.isnan(number.cast("double")), number).try_cast("decimal(18,2)")


def _refund_rules() -> Rules:
    return [
        (~F.coalesce(_money("amount") > 0, F.lit(False)), "refund_not_positive"),
        (_money("amount") > fixed.REFUND_LIMIT, "escalated"),
        *_account_rules(),
    ]


# ---------------------------------------------------------------- state and helpers


def _with_order(requests: DataFrame, orders: DataFrame, salts: Column | None = None) -> DataFrame:
    """Attach the order; a delivered one gets its date, a day before the estimate, unless
    the table already has it."""
    if "delivered_date" not in orders.columns:
        orders = orders.withColumn(
            "delivered_date",
            F.when(F.col("status") == "delivered", F.date_sub("estimated_delivery", 1)),
        )
    return lookup_join(requests, orders, "order_id", "request_id", "__order", salts=salts)


def _with_account(requests: DataFrame, accounts: DataFrame, salts: Column | None = None) -> DataFrame:
    return lookup_join(requests, accounts, "email", "request_id", "__account", salts=salts)


def _errors(uses: str, **by_code: Column) -> Column:
    """The error text of each code; ``uses`` names the state table whose ids are checked."""
    texts = {
        "order": {
            "invalid_order_id": _text("invalid_order_id", F.coalesce("order_id", F.lit("None"))),
            "order_not_found": F.concat(F.lit("Order not found: "), F.col("order_id")),
        },
        "account": {
            "invalid_email": _text("invalid_email", F.coalesce("email", F.lit("None"))),
            "account_not_found": F.concat(F.lit("Account not found: "), F.col("email")),
        },
    }[uses]
    pairs = [(F.col("code") == code, text) for code, text in {**texts, **by_code}.items()]
    chain = F.when(*pairs[0])
    for hit, text in pairs[1:]:
        chain = chain.when(hit, text)
    return chain


def _address_errors() -> Column:
    return _errors("order", already_shipped=_text("address_already_shipped", F.col(_STATUS)))


def _cancel_errors() -> Column:
    return _errors("order", already_shipped=_text("cancel_already_shipped", F.col(_STATUS)), already_cancelled=_text("already_cancelled"))


def _return_errors(day: Column) -> Column:
    days = _days_since_delivery(day).cast("string")
    return _errors("order", not_delivered=_text("not_delivered", F.col(_STATUS)), window_expired=_text("window_expired", days))


def _unlock_errors() -> Column:
    return _errors("account", account_cancelled=_text("unlock_cancelled"))


def _plan_errors() -> Column:
    stored = F.coalesce("__account.subscription_plan", F.lit("None"))
    return _errors(
        "account",
        invalid_plan=_text("invalid_plan", F.coalesce("new_plan", F.lit("None"))),
        account_blocked=_text("plan_blocked", F.col(_ACCOUNT_STATUS)),
        same_plan=_text("same_plan", F.col("new_plan")),
        unknown_stored_plan=F.concat(F.lit("Unknown plan on the account: "), stored),
    )


def _subscription_errors() -> Column:
    return _errors("account", already_cancelled=_text("subscription_already_cancelled"))


def _refund_errors() -> Column:
    return _errors(
        "account", refund_not_positive=_text("refund_not_positive"), escalated=_text("refund_escalated", _money("amount").cast("string"))
    )


def _ok(value: Column) -> Column:
    return F.when(F.col("code") == "ok", value)


def _outcome(joined: DataFrame, requests: DataFrame, rules: Rules, error: Column, **more: Column) -> DataFrame:
    decided = joined.withColumn("code", _code(rules))
    return decided.select(
        *requests.columns, _success().alias("success"), "code", error.alias("error"),
        *[c.alias(name) for name, c in more.items()],
    )


def _stamp(as_of: Column) -> Column:
    return F.date_format(as_of.cast("timestamp"), "yyyy-MM-dd HH:mm 'UTC'")


def _as_column(as_of: str | Column) -> Column:
    return F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of


# ---------------------------------------------------------------- orders


def order_lookup(requests: DataFrame, orders: DataFrame) -> DataFrame:
    """Requests (``request_id, order_id``) with the order they name."""
    joined = _with_order(requests, orders)
    names = [c for c in orders.columns if c != "order_id"]
    if "delivered_date" not in names:
        names.append("delivered_date")
    decided = joined.withColumn("code", _code(_order_rules()))
    return decided.select(
        *requests.columns, "code", _errors("order").alias("error"),
        *[F.when(F.col("code") == "ok", F.col("__order")[c]).alias(c) for c in names],
    )


def address_change(requests: DataFrame, orders: DataFrame) -> DataFrame:
    """Requests (``request_id, order_id, new_address``); a cancelled order may change."""
    refused = F.col("code") == "already_shipped"
    return _outcome(
        _with_order(requests, orders), requests, _address_rules(),
        _address_errors(),
        carrier=F.when(refused, F.col("__order.carrier")),
        tracking_number=F.when(refused, F.col("__order.tracking_number")),
        old_address=_ok(F.col("__order.shipping_address")),
        message=_ok(_text("address_ok")),
    )


def cancel_order(requests: DataFrame, orders: DataFrame, as_of: str | Column) -> DataFrame:
    """Requests (``request_id, order_id``); an accepted one refunds the order total."""
    return _outcome(
        _with_order(requests, orders), requests, _cancel_rules(),
        _cancel_errors(),
        cancelled_at=_ok(_stamp(_as_column(as_of))),
        refund_amount=_ok(F.col("__order.total")),
        refund_method=_ok(F.lit(fixed.ORDER_REFUND_METHOD)),
        refund_eta=_ok(F.lit(fixed.REFUND_ETA)),
    )


def return_eligibility(requests: DataFrame, orders: DataFrame, as_of: str | Column) -> DataFrame:
    """Requests (``request_id, order_id``); day 30 after delivery is the last good one."""
    day = _as_column(as_of).cast("date")
    return _outcome(
        _with_order(requests, orders), requests, _return_rules(day),
        _return_errors(day),
        return_label_url=_ok(F.concat(F.lit(fixed.RETURN_LABEL_URL), F.col("order_id"))),
        return_instructions=_ok(F.lit(fixed.RETURN_INSTRUCTIONS)),
        refund_eta=_ok(F.lit(fixed.RETURN_REFUND_ETA)),
        carrier=_ok(F.lit(fixed.RETURN_CARRIER)),
    )


# ---------------------------------------------------------------- accounts


def account_lookup(requests: DataFrame, accounts: DataFrame) -> DataFrame:
    """Requests (``request_id, email``) with the account they name."""
    decided = _with_account(requests, accounts).withColumn("code", _code(_account_rules()))
    return decided.select(
        *requests.columns, "code", _errors("account").alias("error"),
        *[_ok(F.col("__account")[c]).alias(c) for c in accounts.columns if c != "email"],
    )


def account_unlock(requests: DataFrame, accounts: DataFrame, as_of: str | Column) -> DataFrame:
    """Requests (``request_id, email``); a suspended account may be unlocked."""
    return _outcome(
        _with_account(requests, accounts), requests, _unlock_rules(),
        _unlock_errors(),
        message=_ok(_text("unlock_ok")),
        action_taken=_ok(F.lit(fixed.UNLOCK_ACTION)),
        timestamp=_ok(_stamp(_as_column(as_of))),
    )


def _price(plan: Column) -> Column:
    prices = F.create_map(
        *[F.lit(x) for plan, price in fixed.PLAN_PRICES.items() for x in (plan, price)]
    )
    return F.element_at(prices, plan).cast("decimal(10,2)")


def _dollars(amount: Column) -> Column:
    return F.concat(F.lit("$"), amount.cast("string"))


def _plan_terms() -> dict[str, Column]:
    """What an accepted change of plan comes to."""
    old, new, month = F.col("__account.subscription_plan"), F.col("new_plan"), F.lit("/month")
    up = _price(new) > _price(old)
    return {
        "old_plan": old,
        "new_plan": new,
        "old_price": F.concat(_dollars(_price(old)), month),
        "new_price": F.concat(_dollars(_price(new)), month),
        "effective_date": F.when(up, fixed.EFFECTIVE_UPGRADE).otherwise(fixed.EFFECTIVE_DOWNGRADE),
        "proration_credit": F.when(up, _dollars((_price(new) - _price(old)).cast("decimal(10,2)"))).otherwise("N/A"),
        "message": F.when(up, _text("plan_upgraded", old, new)).otherwise(_text("plan_downgraded", old, new)),
    }


def plan_change(requests: DataFrame, accounts: DataFrame) -> DataFrame:
    """Requests (``request_id, email, new_plan``). An upgrade takes effect at once and
    credits the price difference; a downgrade waits for the next cycle."""
    return _outcome(
        _with_account(requests, accounts), requests, _plan_rules(),
        _plan_errors(),
        **{name: _ok(value) for name, value in _plan_terms().items() if name != "new_plan"},
    )


def cancel_subscription(requests: DataFrame, accounts: DataFrame, as_of: str | Column) -> DataFrame:
    """Requests (``request_id, email``); access lasts until the next billing date."""
    until = F.date_format("__account.next_billing_date", "yyyy-MM-dd")
    return _outcome(
        _with_account(requests, accounts), requests, _subscription_rules(),
        _subscription_errors(),
        cancellation_date=_ok(F.date_format(_as_column(as_of), "yyyy-MM-dd")),
        access_until=_ok(until),
        message=_ok(_text("subscription_cancelled", until)),
        reactivation_info=_ok(F.lit(fixed.REACTIVATION_INFO)),
    )


def _refund_id() -> Column:
    digest = F.md5(F.concat(F.coalesce("order_id", F.lit("")), F.col("email")).cast("binary"))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 1000000
    return F.concat(F.lit("REF-"), F.lpad(number.cast("string"), 6, "0"))


def refund_routing(requests: DataFrame, accounts: DataFrame, as_of: str | Column) -> DataFrame:
    """Requests (``request_id, email, order_id, amount``). More than the limit goes to a
    person, exactly the limit passes; the order is not looked up.

    Amounts are money: decimal(18,2), a half cent rounding up. NaN is no amount."""
    requests = requests.withColumn("amount", _money("amount"))
    amount = F.col("amount").cast("string")
    method = F.col("__account.payment_method")
    return _outcome(
        _with_account(requests, accounts), requests, _refund_rules(),
        _refund_errors(),
        escalated=F.when(F.col("code") == "escalated", True),
        refund_id=_ok(_refund_id()),
        refund=_ok(F.concat(F.lit("$"), amount)),
        method=_ok(method),
        eta=_ok(F.lit(fixed.REFUND_ETA)),
        timestamp=_ok(_stamp(_as_column(as_of))),
        message=_ok(_text("refund_ok", amount, method)),
    )


# ---------------------------------------------------------------- answers as text


def _quoted(text: Column) -> Column:
    """A text as JSON, everything beyond ASCII as escapes; null as null."""
    plain = F.regexp_extract(F.to_json(F.struct(text.alias("x"))), r'(?s)^\{"x":(".*")\}$', 1)
    one = F.transform(F.array(plain), lambda t: F.when(t.rlike(r"^[\x00-\x7F]*$"), t).otherwise(F.array_join(F.transform(
        F.split(t, ""), lambda c: F.when(c.rlike(r"^[\x00-\x7F]*$"), c).otherwise(F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", r"\\u$1"))
    ), "")))
    # Printable ASCII without a quote or a backslash stands as it is.
    simple = text.rlike(r"^[\x20!#-\[\]-~]*\z")
    return F.when(text.isNull(), F.lit("null")).when(simple, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(F.element_at(one, 1))


def _money_text(value: Column) -> Column:
    return value.cast("decimal(18,2)").cast("string")


def _text_field(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"), F.lit(True).alias("quoted"))


def _raw_field(name: str, value: Column) -> Column:
    """A field whose value is JSON already; it is left out where that is null."""
    return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"), F.lit(False).alias("quoted"))


def _object_text(fields: Column) -> Column:
    """An array of fields as an object, indented by two spaces."""
    present = F.filter(fields, lambda f: f["quoted"] | f["value"].isNotNull())
    lines = F.transform(present, lambda f: F.concat(F.lit('  "'), f["name"], F.lit('": '), F.when(f["quoted"], _quoted(f["value"])).otherwise(f["value"])))
    return F.concat(F.lit("{\n"), F.array_join(lines, ",\n"), F.lit("\n}"))


def _items_text(items: Column) -> Column:
    """The items of an order: a list of objects, indented as part of an answer."""
    def one(x: Column) -> Column:
        return F.concat(
            F.lit('    {\n      "name": '), _quoted(x["name"]), F.lit(',\n      "quantity": '), F.coalesce(x["quantity"].cast("string"), F.lit("null")),
            F.lit(',\n      "price": '), F.coalesce(_money_text(x["price"]), F.lit("null")), F.lit("\n    }"),
        )

    return F.when(F.size(items) > 0, F.concat(F.lit("[\n"), F.array_join(F.transform(items, one), ",\n"), F.lit("\n  ]"))).otherwise(F.lit("[]"))


def _answers(as_of: Column, account_columns: list[str]) -> dict[str, Column]:
    """For each tool the fields of its whole answer, in terms of a request, its ``code`` and the state it was joined to."""
    day, stamp = as_of.cast("date"), _stamp(as_of)
    malformed, text, raw = F.col("code").isin(MALFORMED), _text_field, _raw_field
    counts = [c for c in ("total_orders", "loyalty_points") if c in account_columns]

    def order(name: str) -> Column:
        return text(name, F.col(f"__order.{name}"))

    def account(name: str) -> Column:
        return text(name, F.col(f"__account.{name}"))

    def given(name: str) -> Column:
        return text(name, F.col(name))

    def told(error: Column, accepted: list[Column], *when_refused: Column) -> Column:
        refused = [raw("success", F.when(~malformed, F.lit("false"))), text("error", error), *when_refused]
        return F.when(F.col("code") == "ok", F.array(*accepted)).otherwise(F.array(*refused))

    def done(*fields: Column) -> list[Column]:
        return [raw("success", F.lit("true")), *fields]

    shipped = F.col("code") == "already_shipped"
    delivered, until = F.col("__order.delivered_date"), F.date_format("__account.next_billing_date", "yyyy-MM-dd")
    amount, method = _money("amount").cast("string"), F.col("__account.payment_method")
    total = F.coalesce(_money_text(F.col("__order.total")), F.lit("null"))
    return {
        "lookup_order": told(_errors("order"), [
            given("order_id"), order("status"), order("order_date"), order("estimated_delivery"), order("carrier"), order("tracking_number"),
            raw("items", _items_text(F.col("__order.items"))), raw("total", total), order("shipping_address"),
            raw("delivered_date", F.concat(F.lit('"'), delivered.cast("string"), F.lit('"'))),
        ]),
        "update_shipping_address": told(_address_errors(), done(
            given("order_id"), text("old_address", F.col("__order.shipping_address")), given("new_address"), text("message", _text("address_ok")),
        ), *[raw(n, F.when(shipped, _quoted(F.col(f"__order.{n}")))) for n in ("carrier", "tracking_number")]),
        "cancel_order": told(_cancel_errors(), done(
            given("order_id"), text("cancelled_at", stamp), raw("refund_amount", total), text("refund_method", F.lit(fixed.ORDER_REFUND_METHOD)),
            text("refund_eta", F.lit(fixed.REFUND_ETA)), given("reason"),
        )),
        "get_return_label": told(_return_errors(day), done(
            given("order_id"), text("item", F.col("item_name")), given("return_reason"),
            text("return_label_url", F.concat(F.lit(fixed.RETURN_LABEL_URL), F.col("order_id"))), text("return_instructions", F.lit(fixed.RETURN_INSTRUCTIONS)),
            text("refund_eta", F.lit(fixed.RETURN_REFUND_ETA)), text("carrier", F.lit(fixed.RETURN_CARRIER)),
        )),
        "get_account_info": told(_errors("account"), [
            given("email"), account("account_status"), account("subscription_plan"), account("member_since"),
            *[raw(c, F.coalesce(F.col(f"__account.{c}").cast("string"), F.lit("null"))) for c in counts], account("payment_method"), account("billing_cycle"), account("next_billing_date"),
        ]),
        "unlock_account": told(_unlock_errors(), done(
            given("email"), text("message", _text("unlock_ok")), text("action_taken", F.lit(fixed.UNLOCK_ACTION)), text("timestamp", stamp),
        )),
        "update_subscription": told(_plan_errors(), done(given("email"), *[text(name, value) for name, value in _plan_terms().items()])),
        "cancel_subscription": told(_subscription_errors(), done(
            given("email"), text("cancellation_date", day), text("access_until", until), given("reason"),
            text("message", _text("subscription_cancelled", until)), text("reactivation_info", F.lit(fixed.REACTIVATION_INFO)),
        )),
        "process_refund": told(_refund_errors(), done(
            text("refund_id", _refund_id()), given("order_id"), given("email"), text("amount", F.concat(F.lit("$"), amount)), text("method", method),
            given("reason"), text("eta", F.lit(fixed.REFUND_ETA)), text("timestamp", stamp), text("message", _text("refund_ok", amount, method)),
        ), raw("escalated", F.when(F.col("code") == "escalated", F.lit("true")))),
    }


# ---------------------------------------------------------------- mixed batches


def _adjudicated(requests: DataFrame, orders: DataFrame, accounts: DataFrame, as_of: Column) -> DataFrame:
    """Requests joined to both state tables, with their ``code``."""
    day = as_of.cast("date")
    by_action = {
        "lookup_order": _order_rules(),
        "update_shipping_address": _address_rules(),
        "cancel_order": _cancel_rules(),
        "get_return_label": _return_rules(day),
        "get_account_info": _account_rules(),
        "unlock_account": _unlock_rules(),
        "update_subscription": _plan_rules(),
        "cancel_subscription": _subscription_rules(),
        "process_refund": _refund_rules(),
    }
    code = None
    for action, rules in by_action.items():
        hit = F.col("action") == action
        code = F.when(hit, _code(rules)) if code is None else code.when(hit, _code(rules))
    # Both lookups take their hot keys from the requests, in one sketch.
    salts = hot_salts(requests, ["order_id", "email"])
    joined = _with_account(_with_order(requests, orders, salts["order_id"]), accounts, salts["email"])
    return joined.withColumn("code", code.otherwise("unknown_action"))


def adjudicate(
    requests: DataFrame, orders: DataFrame, accounts: DataFrame, as_of: str | Column
) -> DataFrame:
    """Decide a batch of mixed requests with one join per state table.

    ``requests``: ``request_id, action, order_id, email, new_plan, amount``; ``action`` is a
    tool name. Adds ``success, code, refund_amount``.
    """
    refund = F.when(F.col("action") == "cancel_order", F.col("__order.total")).when(
        F.col("action") == "process_refund", _money("amount")
    )
    return _adjudicated(requests, orders, accounts, _as_column(as_of)).select(
        *requests.columns, _success().alias("success"), "code",
        _ok(refund.cast("decimal(18,2)")).alias("refund_amount"),
    )


def adjudication_summary(outcomes: DataFrame) -> DataFrame:
    """Requests and refunds by action and outcome."""
    return outcomes.groupBy("action", "code").agg(
        F.count(F.lit(1)).alias("n_requests"), F.sum("refund_amount").alias("refund_amount")
    )


# ---------------------------------------------------------------- from calls to outcomes


def requests_from_calls(calls: DataFrame) -> DataFrame:
    """Extracted calls (``request_id, tool, args``) as requests for :func:`adjudicate`; other columns come along.

    An argument a call lacks is null; an amount that is no number is null.
    """
    def given(name: str) -> Column:
        return F.try_element_at("args", F.lit(name))

    others = [c for c in calls.columns if c not in ("request_id", "tool", "args", "text", "code", "error")]
    return calls.where(F.col("tool").isNotNull()).select(
        "request_id", *others, F.col("tool").alias("action"), given("order_id").alias("order_id"), given("customer_email").alias("email"),
        given("new_plan").alias("new_plan"), given("amount").try_cast("decimal(18,2)").alias("amount"),
        given("new_address").alias("new_address"), given("reason").alias("reason"), given("item_name").alias("item_name"),
        given("return_reason").alias("return_reason"),
    )


def call_outcomes(calls: DataFrame, orders: DataFrame, accounts: DataFrame, as_of: str | Column) -> DataFrame:
    """``request_id, tool, code, tool_result``: what each call comes to, as the text of a tool result; other columns of ``calls`` but the text come along.

    The text is the tool's whole answer as a JSON object, indented by two spaces: the order, account, dates, prices and messages of an accepted call, or
    the error of a refused one, or that of a call that names no known tool or has the wrong arguments. Money has two decimals. The rows can be
    given to :func:`colloquy.operators.turns.history_rows`. No tool is executed.
    """
    at = _as_column(as_of)
    others = [c for c in calls.columns if c not in ("request_id", "tool", "args", "text")]
    # Calls that do not fit stay among the others, so that the texts are read once; without keys, they join nothing.
    checked = check_tool_calls(calls).withColumnsRenamed({"code": "__checked", "error": "__refusal"})
    fits = F.col("__checked") == "ok"
    asked = requests_from_calls(checked).withColumns({key: F.when(fits, F.col(key)) for key in ("order_id", "email")})
    decided = _adjudicated(asked, orders, accounts, at)
    fields = None
    for action, answer in _answers(at, accounts.columns).items():
        hit = fits & (F.col("action") == action)
        fields = F.when(hit, answer) if fields is None else fields.when(hit, answer)
    bad = F.concat(F.lit('{"error": '), _quoted(F.col("__refusal")), F.lit("}"))
    return decided.select(
        "request_id", *others, F.col("action").alias("tool"), F.when(fits, F.col("code")).otherwise(F.col("__checked")).alias("code"),
        F.when(fits, _object_text(fields)).otherwise(bad).alias("tool_result"),
    )
