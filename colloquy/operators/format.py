"""Message arrays and prompt texts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions import fixed_values as fixed
from colloquy.operators.turns import message


@dataclass(frozen=True)
class ChatTemplate:
    """Markers around each message; the defaults are the Llama-3 instruct ones."""

    begin: str = "<|begin_of_text|>"
    before_role: str = "<|start_header_id|>"
    after_role: str = "<|end_header_id|>\n\n"
    after_content: str = "<|eot_id|>"
    strip_content: bool = True


def to_messages(df: DataFrame, system_prompt: str = fixed.SYSTEM_PROMPT) -> DataFrame:
    """Add ``messages``: system, user and assistant; all other columns stay."""
    return df.withColumn(
        "messages",
        F.array(
            message("system", F.lit(system_prompt)),
            message("user", F.col("instruction")),
            message("assistant", F.col("response")),
        ),
    )


def render_chat(
    messages: Column | str, template: ChatTemplate = ChatTemplate(), open_turn: bool = False
) -> Column:
    """A message array as one text; ``open_turn`` adds the head of an assistant turn."""
    messages = F.col(messages) if isinstance(messages, str) else messages

    def one(m: Column) -> Column:
        content = F.regexp_replace(m["content"], r"^\s+|\s+$", "") if template.strip_content else m["content"]
        return F.concat(
            F.lit(template.before_role), m["role"], F.lit(template.after_role), content,
            F.lit(template.after_content),
        )

    body = F.array_join(F.transform(messages, one), "")
    tail = template.before_role + "assistant" + template.after_role if open_turn else ""
    return F.concat(F.lit(template.begin), body, F.lit(tail))


def render_prompt(
    instruction: Column | str, style: str = "plain", system_prompt: str = fixed.SYSTEM_PROMPT,
    template: ChatTemplate = ChatTemplate(),
) -> Column:
    """Inference prompt. ``plain`` and ``labelled`` are the two text layouts; ``chat`` uses
    a chat template with an open assistant turn."""
    text = F.col(instruction) if isinstance(instruction, str) else instruction
    if style == "plain":
        return F.concat(F.lit(f"{system_prompt}\n\nUser: "), text, F.lit("\nAssistant:"))
    if style == "labelled":
        return F.concat(F.lit(f"System: {system_prompt}\nUser: "), text, F.lit("\nAssistant:"))
    if style == "chat":
        turns = F.array(message("system", F.lit(system_prompt)), message("user", text))
        return render_chat(turns, template, open_turn=True)
    raise ValueError(f"unknown prompt style: {style}")


def render_transcript(messages: Column | str) -> Column:
    """``ROLE: text`` lines and an open ``ASSISTANT:`` line."""
    messages = F.col(messages) if isinstance(messages, str) else messages
    lines = F.transform(messages, lambda m: F.concat(F.upper(m["role"]), F.lit(": "), m["content"]))
    return F.concat(F.array_join(lines, "\n"), F.lit("\nASSISTANT:"))


def render_pair(instruction: Column | str, response: Column | str) -> Column:
    """The text whose likelihood is scored."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (instruction, response))
    return F.concat(F.lit("User: "), a, F.lit("\nAssistant: "), b)
