import pytest
from pyspark.sql import functions as F

from colloquy.functions import fixed_values as fixed
from colloquy.operators import format, turns

TURNS = [
    (1, 0, "system", "s"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 5, "user", "q2"),
    (1, 9, "assistant", "a2"), (1, 10, "user", "q3"), (1, 11, "user", "q4"), (1, 40, "assistant", "a4"),
    (2, 0, "user", "only"), (3, 7, "assistant", "x"), (3, 8, "user", "y"), (3, 9, "system", "z"), (3, 10, "assistant", "w"),
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").repartition(4)


@pytest.mark.parametrize("span", [1, 2, 3, 10, 4096])
def test_pairs_do_not_depend_on_the_span(table, span):
    got = {tuple(r) for r in turns.pairs_from_turns(table, span=span).collect()}
    assert got == {(1, 1, "q1", "a1"), (1, 5, "q2", "a2"), (1, 11, "q4", "a4")}


def test_history_has_system_turns_and_tool_result(table, spark):
    tools = spark.createDataFrame([(2, "TOOL_CALL: x()", "{}")], "conv_id long, response string, tool_result string")
    rows = {r["conv_id"]: r["messages"] for r in turns.assemble_history(table, "SYS", tools).collect()}
    assert [tuple(m) for m in rows[2]] == [
        ("system", "SYS"), ("user", "only"), ("assistant", "TOOL_CALL: x()"),
        ("user", "Tool result:\n{}\n\nPlease respond to the customer based on this information."),
    ]
    assert [m["content"] for m in rows[1]] == ["SYS", "s", "q1", "a1", "q2", "a2", "q3", "q4", "a4"]


def test_history_of_any_length_is_one_row(spark):
    n = 10_000
    long = spark.range(n).select(
        F.lit(7).alias("conv_id"), (F.col("id") * 1000).alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text")
    )
    row, = turns.assemble_history(long, "SYS").collect()
    assert [m["content"] for m in row["messages"]] == ["SYS", *map(str, range(n))]


def test_two_tool_results_keep_call_and_result_together(spark, table):
    tools = spark.createDataFrame(
        [(1, 2, "call b", "result b"), (1, 1, "call z", "result z")], "conv_id int, call int, response string, tool_result string"
    )
    added = turns.history_rows(table, "SYS", tools).where("conv_id = 1").orderBy("turn").collect()[-4:]
    assert [r["role"] for r in added] == ["assistant", "user", "assistant", "user"]
    assert [r["content"] for r in added][::2] == ["call z", "call b"]
    assert "result z" in added[1]["content"] and "result b" in added[3]["content"]
    assert len({r["turn"] for r in added}) == 4


def test_agent_system_text_lists_the_tools():
    text = turns.agent_system_text()
    assert "lookup_order, update_shipping_address, cancel_order" in text and "{tool_list}" not in text
    assert 'TOOL_CALL: <tool_name>({"param": "value", ...})' in text


@pytest.fixture(scope="module")
def row(spark):
    return spark.createDataFrame(
        [("  Is it 100% {new}? ", "Yes\n", "i", "c", True)],
        "instruction string, response string, intent string, category string, has_quality_flag boolean",
    )


def test_messages(row):
    out = format.to_messages(row).first()
    assert [m["role"] for m in out["messages"]] == ["system", "user", "assistant"]
    assert out["messages"][1]["content"] == "  Is it 100% {new}? " and out["messages"][2]["content"] == "Yes\n"
    assert (out["intent"], out["category"], out["has_quality_flag"]) == ("i", "c", True)


def test_system_prompt():
    assert fixed.SYSTEM_PROMPT.startswith("You are a helpful, professional customer support agent.")


def test_chat_text(row):
    text = format.to_messages(row, "S").select(format.render_chat("messages")).first()[0]
    assert text == (
        "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nS<|eot_id|>"
        "<|start_header_id|>user<|end_header_id|>\n\nIs it 100% {new}?<|eot_id|>"
        "<|start_header_id|>assistant<|end_header_id|>\n\nYes<|eot_id|>"
    )
    bare = format.ChatTemplate("", "<", ">", "", strip_content=False)
    short = format.to_messages(row, "S").select(format.render_chat("messages", bare)).first()[0]
    assert short == "<system>S<user>  Is it 100% {new}? <assistant>Yes\n"


def test_prompts(row):
    def one(style):
        return row.select(format.render_prompt(F.lit("x"), style, "S")).first()[0]

    assert one("plain") == "S\n\nUser: x\nAssistant:"
    assert one("labelled") == "System: S\nUser: x\nAssistant:"
    assert one("chat").endswith("<|start_header_id|>assistant<|end_header_id|>\n\n")
    with pytest.raises(ValueError):
        one("other")


def test_transcript_and_pair(row):
    out = format.to_messages(row, "S").select(
        format.render_transcript("messages"), format.render_pair("instruction", "response")
    ).first()
    assert out[0] == "SYSTEM: S\nUSER:   Is it 100% {new}? \nASSISTANT: Yes\n\nASSISTANT:"
    assert out[1] == "User:   Is it 100% {new}? \nAssistant: Yes\n"


def test_calls_of_one_conversation_go_by_their_numbers(spark):
    table = spark.createDataFrame([(1, 0, "user", "hello"), (2, 0, "user", "hi")], "conv_id long, turn int, role string, text string")
    numbers = [9000, 3, 4097, 4096, 5]
    tools = spark.createDataFrame([(1, n, f"call {n}", f"result {n}") for n in numbers], "conv_id long, call long, response string, tool_result string")
    rows = turns.history_rows(table, "SYS", tools).where("conv_id = 1").orderBy("turn").collect()
    assert [r["turn"] for r in rows] == list(range(-1, 1 + 2 * len(numbers)))
    assert [r["content"] for r in rows[2::2]] == [f"call {n}" for n in sorted(numbers)]
    assert all(f"result {n}\n" in r["content"] for n, r in zip(sorted(numbers), rows[3::2]))
