"""Tables, splits and records on disk."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(
    spark: SparkSession, path: str, columns: list[str] | None = None, spread: bool = False
) -> DataFrame:
    """A Parquet table; a missing path raises when this is called.

    ``spread`` deals the rows of a table out to all cores if it has fewer files than there
    are cores, for work that costs much per row. A table of many files is left as it is, so
    this never shuffles a large one.
    """
    table = spark.read.parquet(path)
    if columns:
        table = table.select(*columns)
    cores = spark.sparkContext.defaultParallelism
    if spread and len(table.inputFiles()) < cores:
        table = table.repartition(cores)
    return table


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_splits(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One folder per value of ``split``, so that a reader of one split opens only that."""
    df.write.mode(mode).partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One split of a table written by :func:`write_splits`."""
    table = spark.read.parquet(path)
    return table.where(table["split"] == name).drop("split")


def write_record(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rows as JSON lines in UTF-8, null fields included."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_json_records(
    spark: SparkSession, paths: list[str], schema: T.StructType | str, multi_line: bool = True
) -> DataFrame:
    """The records of the first path that exists; an empty table if none does.

    A JSON array or object over several lines needs ``multi_line``; JSON lines are split
    over tasks without it.
    """
    for path in paths:
        try:
            return spark.read.schema(schema).option("multiLine", multi_line).json(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schema)
