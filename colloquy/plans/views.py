"""Dialogue, prediction, request and state tables derived from the given tables.

Only projections and the package's own operators: each view grows with its source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import fixed_values as fixed
from colloquy.operators import support
from colloquy.operators.turns import pairs_from_turns
from colloquy.sources.tables import read_table

AS_OF = "1998-01-31 09:30:00"


def table(spark: SparkSession, folder: str, name: str, spread: bool = False) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet", spread=spread)


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    found = pairs_from_turns(turns)
    # One number for conversation and turn: as many places a conversation as the longest one needs.
    width = turns.agg(F.max("turn") + 1).scalar()
    return found.select(
        (F.col("conv_id") * width + F.col("turn")).alias("example_id"),
        "instruction", "response",
        F.concat(F.lit("intent_"), (F.col("conv_id") % 7).cast("string")).alias("intent"),
        F.concat(F.lit("category_"), (F.col("conv_id") % 3).cast("string")).alias("category"),
    )


def dialogues(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    joined = table(spark, folder, "documents", spread).join(table(spark, folder, "labels"), "doc_id", "left")
    marks = F.concat(
        F.when(F.col("quality") == 0, "B").otherwise(""), F.when(F.col("toxic") == 1, "I").otherwise("")
    )
    return joined.select(
        F.col("doc_id").alias("example_id"),
        F.substring_index("text", "\n", 1).alias("instruction"),
        F.col("text").alias("response"),
        F.col("source").alias("intent"),
        F.col("lang").alias("category"),
        F.when(F.col("quality").isNotNull(), marks).alias("flags"),
    )


def pred_base(spark: SparkSession, folder: str) -> DataFrame:
    return pairs(spark, folder).select(
        "*", F.col("instruction").alias("prediction"), (F.length("response") * 2.5).alias("latency_ms")
    )


def pred_ft(spark: SparkSession, folder: str) -> DataFrame:
    half = F.expr("substr(response, 1, length(response) div 2)")
    return pairs(spark, folder).select(
        "*", half.alias("prediction"), (F.length("instruction") * 12.5).alias("latency_ms")
    )


def doc_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Long texts with their own first half as the prediction."""
    return dialogues(spark, folder, spread=True).select(
        "example_id", "instruction", "response", "intent", "category",
        F.expr("substr(response, 1, length(response) div 2)").alias("prediction"),
        (F.length("response") * 1.5).alias("latency_ms"),
    )


def _k(col: str = "props") -> F.Column:
    return F.get_json_object(col, "$.k").cast("bigint")


def latency(spark: SparkSession, folder: str) -> DataFrame:
    measured = F.when(F.col("event_id") % 997 == 5, F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, folder, "events").select(
        "event_id", F.col("event_type").alias("label"), measured.alias("latency_ms"),
        _k().alias("response_tokens"), F.col("props").alias("prompt"), F.col("event_type").alias("response"),
    )


def _rating(k: F.Column, shift: int) -> F.Column:
    def score(step: int) -> F.Column:
        return ((k + (shift + step)) % 5 + 1).cast("string")

    text = F.concat(
        F.lit('{"helpfulness": '), score(0), F.lit(', "accuracy": '), score(1),
        F.lit(', "professionalism": '), score(2), F.lit(', "reasoning": "k'), k.cast("string"), F.lit('"}'),
    )
    return (
        F.when(k % 10 == 0, "not json").when(k % 10 == 3, F.concat(text, F.lit(" That is all.")))
        .when(k % 10 == 6, F.concat(text, text)).otherwise(text)
    )


def _winner(k: F.Column) -> F.Column:
    text = F.concat(
        F.lit('{"winner": "'), F.when(k % 2 == 0, "A").otherwise("B"), F.lit('", "reasoning": "k'),
        k.cast("string"), F.lit('"}'),
    )
    return (
        F.when(k % 10 == 0, "no verdict").when(k % 10 == 3, F.concat(text, F.lit("]")))
        .when(k % 10 == 6, F.concat(text, F.lit("\n"), text)).otherwise(text)
    )


def replies(spark: SparkSession, folder: str) -> DataFrame:
    """Judge replies, one event each."""
    k = F.col("k")
    return table(spark, folder, "events").withColumn("k", _k()).select(
        F.col("event_id").alias("example_id"), F.col("event_type").alias("label"),
        _rating(k, 0).alias("rating_reply"), _winner(k).alias("pref_reply"),
    )


def pair_replies(spark: SparkSession, folder: str) -> DataFrame:
    """Judge replies for the pairs."""
    k = F.pmod(F.col("example_id"), F.lit(97))
    return pairs(spark, folder).select(
        "example_id", _rating(k, 0).alias("base_reply"), _rating(k, 1).alias("ft_reply"),
        _winner(k).alias("pref_reply"),
    )


def order_state(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "P", F.when(key % 10 == 1, "out_for_delivery").otherwise("shipped"))
        .otherwise(F.when(key % 10 == 0, "cancelled").otherwise("processing"))
    )
    carrier = F.element_at(F.array(*map(F.lit, ("FedEx", "UPS", "USPS", "DHL"))), (key % 4 + 1).cast("int"))
    day = F.to_date("o_orderdate")
    return table(spark, folder, "orders").select(
        F.concat(F.lit("ORD-"), key.cast("string")).alias("order_id"),
        status.alias("status"),
        day.alias("order_date"),
        F.date_add(day, 6).alias("estimated_delivery"),
        carrier.alias("carrier"),
        F.concat(F.upper(F.substring(carrier, 1, 2)), F.lpad(key.cast("string"), 9, "0")).alias("tracking_number"),
        F.array(F.struct(
            F.col("o_orderpriority").alias("name"), F.lit(1).alias("quantity"), F.col("o_totalprice").alias("price")
        )).alias("items"),
        F.col("o_totalprice").alias("total"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(" Main St")).alias("shipping_address"),
    )


def account_state(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    plans = F.array(*map(F.lit, ("Basic", "Standard", "Premium")))
    return table(spark, folder, "customer").select(
        F.concat(F.lower("c_name"), F.lit("@x")).alias("email"),
        F.when(key % 5 == 3, "suspended").when(key % 5 == 4, "cancelled").otherwise("active").alias("account_status"),
        F.when(key % 31 == 0, "Legacy").otherwise(F.element_at(plans, (key % 3 + 1).cast("int"))).alias("subscription_plan"),
        F.date_sub(F.lit("1998-01-01").cast("date"), (key % 900).cast("int")).alias("member_since"),
        (key % 50 + 1).alias("total_orders"),
        (key * 37 % 5001).alias("loyalty_points"),
        F.concat(F.lit("Card "), F.col("c_mktsegment")).alias("payment_method"),
        F.lit("monthly").alias("billing_cycle"),
        F.date_add(F.lit("1998-02-01").cast("date"), (key % 28).cast("int")).alias("next_billing_date"),
    )


TOOLS_IN_ORDER = [
    "lookup_order", "update_shipping_address", "cancel_order", "get_return_label", "get_account_info",
    "unlock_account", "update_subscription", "cancel_subscription", "process_refund", "reset_router",
]


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """One request per order, some with ids that are malformed or match nothing."""
    key = F.col("o_orderkey")
    number = key.cast("string")
    mail = F.concat(F.lit("customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    plans = F.array(*map(F.lit, ("Basic", "Standard", "Premium", "Platinum")))
    tools = F.array(*map(F.lit, TOOLS_IN_ORDER))
    return table(spark, folder, "orders").select(
        key.alias("request_id"),
        F.element_at(tools, (key % 10 + 1).cast("int")).alias("action"),
        F.when(key % 50 == 0, F.concat(F.lit("BAD-"), number))
        .when(key % 33 == 0, F.concat(F.lit("ORD-X"), number))
        .otherwise(F.concat(F.lit("ORD-"), number)).alias("order_id"),
        F.when(key % 40 == 0, mail).when(key % 37 == 0, F.concat(mail, F.lit("@y")))
        .otherwise(F.concat(mail, F.lit("@x"))).alias("email"),
        F.element_at(plans, (key % 4 + 1).cast("int")).alias("new_plan"),
        F.when(key % 100 == 0, 0.0).when(key % 101 == 0, 500.0).when(key % 103 == 0, float("nan"))
        .otherwise(F.floor(F.col("o_totalprice") / 5.0) / 100.0).alias("amount"),
        F.concat(F.col("o_orderpriority"), F.lit(" Road")).alias("new_address"),
        F.concat(F.lit("status "), F.col("o_orderstatus")).alias("reason"),
        F.concat(F.lit('the "'), F.col("o_orderpriority"), F.lit('" one')).alias("item_name"),
        F.concat(F.lit("priority "), F.col("o_orderpriority")).alias("return_reason"),
    )


def _with_arguments(requests: DataFrame) -> DataFrame:
    """Requests with ``fit``, the arguments of each one's tool as a JSON object, in the order of the catalogue; a reason is optional for cancellations.

    What is used in many places is a column of its own: written out at each of them it makes code too long to be compiled.
    """
    def text(name: str, value: F.Column) -> F.Column:
        return F.concat(F.lit(f'"{name}": "'), F.replace(value, F.lit('"'), F.lit('\\"')), F.lit('"'))

    written = {
        **{n: F.col(f"{n}_argument") for n in ("order_id", "customer_email")},
        "amount": F.when(F.isnan("amount"), F.lit('"amount": "NaN"')).otherwise(F.concat(F.lit('"amount": '), F.format_string("%.2f", "amount"))),
        **{n: text(n, F.col(n)) for n in ("new_address", "new_plan", "reason", "item_name", "return_reason")},
    }
    out = written["order_id"]
    for tool, (needed, optional) in fixed.TOOL_CATALOGUE.items():
        parts = [written[n] for n in needed] + [F.when(F.col("request_id") % 3 == 0, written[n]) for n in optional]
        out = F.when(F.col("action") == tool, F.concat_ws(", ", *parts)).otherwise(out)
    named = requests.withColumns({"order_id_argument": text("order_id", F.col("order_id")), "customer_email_argument": text("customer_email", F.col("email"))})
    return named.withColumn("fit", F.concat(F.lit("{"), out, F.lit("}")))


def agent_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Assistant texts made from the requests; most call their tool with fitting arguments, some badly."""
    key, fit = F.col("request_id"), F.col("fit")
    args = (
        F.when(key % 7 == 0, F.lit("{broken"))
        .when(key % 17 == 0, F.concat(F.lit('{"order_number": "'), F.col("order_id"), F.lit('"}')))
        .when(key % 23 == 0, F.concat(fit, fit))
        .when(key % 29 == 0, F.concat(fit, F.lit(") (as asked")))
        .otherwise(fit)
    )
    call = F.concat(F.lit("  TOOL_CALL: "), F.col("action"), F.lit("("), args, F.lit(")"), F.when(key % 19 == 0, " please").otherwise(""))
    text = (
        F.when(key % 11 == 0, F.lit("Our returns desk is open.\nAnything else?"))
        .when(key % 13 == 0, F.concat(F.lit("TOOL_CALL: "), F.col("action")))
        .otherwise(F.concat(F.lit("Let me check that.\n"), call, F.lit("\nOne moment.")))
    )
    return _with_arguments(requests(spark, folder)).select("request_id", text.alias("text"))


def tool_results(spark: SparkSession, folder: str) -> DataFrame:
    """Tool calls and whole results of the conversations that a request belongs to (the one with its number)."""
    texts = agent_texts(spark, folder).select("request_id", "text", F.col("text").alias("response"))
    asked = table(spark, folder, "conversations").select(F.col("conv_id").alias("request_id"))
    calls = support.with_tool_call(texts.join(asked, "request_id", "left_semi"))
    outcomes = support.call_outcomes(calls, order_state(spark, folder), account_state(spark, folder), AS_OF)
    return outcomes.select(F.col("request_id").alias("conv_id"), F.col("request_id").alias("call"), "response", "tool_result")


# The labels of the events, which stand for runs.
LABELS = ["click", "error", "purchase", "signup", "view"]


def label_of(number: F.Column) -> F.Column:
    return F.element_at(F.array(*map(F.lit, LABELS)), (F.pmod(number, F.lit(len(LABELS))) + 1).cast("int"))


def run_configs(spark: SparkSession, folder: str) -> DataFrame:
    """A nested configuration for each run, made from the regions; one run does not set its rate."""
    key = F.col("r_regionkey").cast("bigint")
    training = F.when(key != 3, F.format_string('{"learning_rate": %.6f, "epochs": 3}', 0.0002 / (key + 1))).otherwise('{"epochs": 1}')
    config = F.concat(
        F.lit('{"model": {"base": "'), F.col("r_name"), F.lit('"}, "lora": {"r": '), F.expr("cast(shiftleft(4L, cast(r_regionkey as int)) as string)"),
        F.lit(', "target_modules": ["q_proj", "v_proj"]}, "training": '), training, F.lit("}"),
    )
    return table(spark, folder, "region").select(label_of(key).alias("label"), config.alias("config"))


def judge_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Error texts of a remote judge, made from the events."""
    k = F.col("k")
    number = k.cast("string")
    text = (
        F.when(k % 6 == 0, F.concat(F.lit("Error 429: rate limit, try again in "), number, F.lit("m1"), number, F.lit(".5s.")))
        .when(k % 6 == 1, F.concat(F.lit("RATE_LIMIT reached: tokens per day, try again in 1h"), number, F.lit("m2s")))
        .when(k % 6 == 2, F.lit("Error 429: try again in a while"))
        .when(k % 6 == 3, F.lit("connection reset"))
        .when(k % 6 == 4, F.concat(F.lit("code 429 TPD used "), number))
    )
    return table(spark, folder, "events").withColumn("k", _k()).select(
        F.col("event_id").alias("example_id"), text.alias("message")
    )


def token_vectors(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Candidate (even ids) and reference (odd ids) vectors of 32 neighbours; a pair stays small
    however large the table is."""
    vectors = table(spark, folder, "embeddings").select(
        F.floor(F.col("vec_id") / 32).alias("pair_id"), F.col("vec_id").alias("position"), "embedding"
    )
    return vectors.where(F.col("position") % 2 == 0), vectors.where(F.col("position") % 2 == 1)
