"""Conversation tables: pairs of turns, histories, transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.functions import fixed_values as fixed
from colloquy.operators.ranking import rank_in_buckets

# Turn numbers handled together in one window group.
SPAN = 4096


def pairs_from_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", span: int = SPAN
) -> DataFrame:
    """Each user turn with the assistant turn that directly follows it.

    ``conv_id, turn, instruction, response``. A conversation is windowed in spans of turn
    numbers, so a huge one is spread over many tasks. The last turn of a span takes its
    successor from a table with the first turn of each span.
    """
    table = turns.select(conv, turn, "role", "text", F.expr(f"{turn} div {span}").alias("__span"))
    within = Window.partitionBy(conv, "__span").orderBy(turn)
    seen = table.select(
        "*",
        F.lead("role").over(within).alias("__next_role"),
        F.lead("text").over(within).alias("__next_text"),
        F.lead(turn).over(within).isNull().alias("__last"),
        F.lag(turn).over(within).isNull().alias("__first"),
    )
    # Row per span; the text travels only where it can be an answer.
    heads = seen.where("__first").select(
        conv, turn, "__span", "role", F.when(F.col("role") == "assistant", F.col("text")).alias("text")
    )
    across = Window.partitionBy(conv).orderBy(turn)
    following = heads.select(
        conv, "__span", F.lit(True).alias("__last"),
        F.lead("role").over(across).alias("__role"), F.lead("text").over(across).alias("__text"),
    ).where(F.col("__role") == "assistant")
    asks = seen.where((F.col("role") == "user") & ((F.col("__next_role") == "assistant") | F.col("__last")))
    joined = asks.join(following, [conv, "__span", "__last"], "left")
    answered = F.col("__next_role").isNotNull() | F.col("__role").isNotNull()
    return joined.where(answered).select(
        conv, turn, F.col("text").alias("instruction"),
        F.when(F.col("__last"), F.col("__text")).otherwise(F.col("__next_text")).alias("response"),
    )


def message(role: Column | str, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def agent_system_text(tools: list[str] | None = None) -> str:
    names = ", ".join(tools or list(fixed.TOOL_CATALOGUE))
    return fixed.AGENT_SYSTEM_PROMPT.replace("{tool_list}", names)


def history_rows(
    turns: DataFrame,
    system_text: str,
    tool_results: DataFrame | None = None,
    conv: str = "conv_id",
    turn: str = "turn",
) -> DataFrame:
    """A conversation as ordered message rows: ``conv_id, turn, role, content``.

    The system text comes first (turn -1), then the stored turns including the new user
    message. ``tool_results`` (``conv_id, response, tool_result``) adds the assistant's
    call and the result turn after the last stored turn, each call directly followed by its
    result; several of one conversation go by ``call`` (a number, for conversations of any
    size) if there is such a column, then by their texts.
    """
    stored = turns.select(conv, F.col(turn).cast("bigint").alias(turn), "role", F.col("text").alias("content"))
    ends = stored.groupBy(conv).agg(F.max(turn).alias("__last"))
    opening = ends.select(
        conv, F.lit(-1).cast("bigint").alias(turn), F.lit("system").alias("role"),
        F.lit(system_text).alias("content"),
    )
    rows = opening.unionByName(stored)
    if tool_results is None:
        return rows
    result_text = F.concat(
        F.lit(fixed.TOOL_RESULT_TURN.split("{tool_result}")[0]), F.col("tool_result"),
        F.lit(fixed.TOOL_RESULT_TURN.split("{tool_result}")[1]),
    )
    if "call" in tool_results.columns:
        # Calls are numbered in spans of their numbers, so those of one conversation may be any part of the table.
        spans = tool_results.withColumn("__span", F.expr(f"call div {SPAN}"))
        numbered = rank_in_buckets(spans, [conv], "__span", ["call", "response", "tool_result"], "__call")
    else:
        inside = Window.partitionBy(conv).orderBy("response", "tool_result")
        numbered = tool_results.withColumn("__call", F.row_number().over(inside))
    added = numbered.join(ends, conv).select(
        conv,
        F.posexplode(
            F.array(message("assistant", F.col("response")), message("user", result_text))
        ).alias("__step", "__message"),
        "__last", "__call",
    )
    return rows.unionByName(
        added.select(
            conv, (F.col("__last") + 2 * F.col("__call") - 1 + F.col("__step")).alias(turn),
            F.col("__message.role").alias("role"), F.col("__message.content").alias("content"),
        )
    )


def assemble_history(
    turns: DataFrame,
    system_text: str,
    tool_results: DataFrame | None = None,
    conv: str = "conv_id",
    turn: str = "turn",
) -> DataFrame:
    """``conv_id, messages``: the ordered message array of each conversation, one row each.

    The array form needs one conversation to fit into a row; :func:`history_rows` is the form
    for conversations of any length.
    """
    rows = history_rows(turns, system_text, tool_results, conv, turn)
    packed = rows.groupBy(conv).agg(
        F.sort_array(F.collect_list(F.struct(F.col(turn), "role", "content"))).alias("__turns")
    )
    return packed.select(
        conv,
        F.transform("__turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
        .alias("messages"),
    )
