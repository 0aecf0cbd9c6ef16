"""Word-level operators over lines of text. Each line is read whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import NON_WORD, UNICODE_BLANKS


def split_words(lines: DataFrame, column: str = "value", separator: str = UNICODE_BLANKS) -> DataFrame:
    """One row ``word`` per non-empty piece of each line."""
    pieces = lines.select(F.explode(F.split(column, separator)).alias("word"))
    return pieces.where(F.col("word") != "")


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lower-case words (runs of ASCII word characters) and their count, most frequent first.

    Each task counts its own words first, so a very common word costs one row per task.
    """
    words = split_words(lines, column, NON_WORD)
    counted = words.groupBy(F.lower("word").alias("word")).count()
    return counted.orderBy(F.col("count").desc(), "word")


def word_lengths(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(word, length)`` for each blank-separated word."""
    return split_words(lines, column).select("word", F.length("word").alias("length"))


def level_words(lines: DataFrame, column: str = "value", level: str = "ERROR") -> DataFrame:
    """Upper-case words of the log lines that start with ``level``."""
    chosen = lines.where(F.col(column).startswith(level))
    return split_words(chosen, column).select(F.upper("word").alias("word"))
