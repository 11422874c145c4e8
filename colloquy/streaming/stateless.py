"""The row-wise operators on a stream.

Cleaning (without dedup), formatting, reply parsing and tool-call extraction look at one
row at a time, so they take a streaming table as they take a batch one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from colloquy.operators.clean import CleanConfig, clean_stateless
from colloquy.operators.format import render_chat, to_messages


def prepare_stream(dialogues: DataFrame, config: CleanConfig = CleanConfig()) -> DataFrame:
    """Clean and format dialogues as they arrive."""
    return to_messages(clean_stateless(dialogues, config)).withColumn("text", render_chat("messages"))


def append_to(df: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append a stream to a Parquet table; exactly once through the checkpoint folder."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.outputMode("append").start()
