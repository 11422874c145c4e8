"""Attach a user's batch function (a model, a remote judge) to a table."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def with_predictions(
    df: DataFrame, fn: Callable[[list[str]], list[str]], input_col: str = "instruction",
    batch_rows: int = 1,
) -> DataFrame:
    """Add ``prediction`` and ``latency_ms`` from ``fn(list of texts) -> list of texts``.

    ``batch_rows`` texts go to one call; the time of a call is shared evenly by its rows.
    Latencies differ from run to run: write the result before using it twice.
    """
    schema = T.StructType([
        *df.schema.fields,
        T.StructField("prediction", T.StringType()),
        T.StructField("latency_ms", T.DoubleType()),
    ])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame[input_col].tolist()
            predictions: list[str] = []
            latencies: list[float] = []
            for at in range(0, len(texts), batch_rows):
                batch = texts[at : at + batch_rows]
                start = time.perf_counter()
                answers = list(fn(batch))
                spent = (time.perf_counter() - start) * 1000 / len(batch)
                if len(answers) != len(batch):
                    raise ValueError("the function must return one prediction per text")
                predictions += answers
                latencies += [spent] * len(batch)
            yield frame.assign(prediction=predictions, latency_ms=latencies)

    return df.mapInPandas(run, schema)


def with_replies(
    df: DataFrame, fn: Callable[[str], str], prompt_col: str = "prompt",
    reply_col: str = "reply", error_col: str = "error",
) -> DataFrame:
    """Add the raw reply of ``fn(prompt)``; what it raises becomes the error text."""
    schema = T.StructType([
        *df.schema.fields,
        T.StructField(reply_col, T.StringType()),
        T.StructField(error_col, T.StringType()),
    ])

    def ask(prompt: str) -> tuple[str | None, str | None]:
        try:
            return fn(prompt), None
        except Exception as problem:  # any failure of the user's function is data here
            return None, str(problem)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers = [ask(p) for p in frame[prompt_col]]
            yield frame.assign(**{
                reply_col: pd.Series([a for a, _ in answers], index=frame.index, dtype="object"),
                error_col: pd.Series([e for _, e in answers], index=frame.index, dtype="object"),
            })

    return df.mapInPandas(run, schema)
