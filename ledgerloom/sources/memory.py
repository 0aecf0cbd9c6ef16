"""Rows that start in the program: ranges and short lists of values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def number_range(
    spark: SparkSession, first: int, last: int, partitions: int | None = None
) -> DataFrame:
    """``value`` from ``first`` to ``last``, both included, made on the executors."""
    numbers = spark.range(first, last + 1, 1, partitions)
    return numbers.select(F.col("id").alias("value"))


def value_rows(
    spark: SparkSession, values: Sequence, type_name: str, partitions: int | None = None
) -> DataFrame:
    """A short list of values as the column ``value``."""
    rows = spark.createDataFrame([(value,) for value in values], f"value {type_name}")
    return rows.repartition(partitions) if partitions else rows
