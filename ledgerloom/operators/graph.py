"""Node degree from adjacency lines ``id neighbour neighbour ...``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import BLANKS
from ledgerloom.operators.relational import only_value


def graph_degree(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(id, connections)``: neighbours listed per node, summed over its lines.

    A node may take several lines; each task sums its own lines first, so a node that owns
    a third of them costs one row per task. Lines without an integer id are left out.
    """
    parts = F.split(F.trim(F.col(column)), BLANKS)
    per_line = lines.select(
        F.get(parts, F.lit(0)).try_cast("int").alias("id"),
        (F.size(parts) - 1).alias("connections"),
    )
    known = per_line.where(F.col("id").isNotNull())
    return known.groupBy("id").agg(F.sum("connections").alias("connections"))


def min_degree_ties(lines: DataFrame, names: DataFrame, column: str = "value") -> DataFrame:
    """Every named node that has the smallest degree: ``(id, name, connections)``.

    ``names`` has columns id and name. The smallest degree is a scalar subquery over the same
    aggregate, whose shuffle Spark reuses: one job and one scan, nothing through the driver.
    """
    degree = graph_degree(lines, column)
    least = only_value(degree, "connections", F.min)
    rarest = degree.where(F.col("connections") == least)
    return rarest.join(names, "id").select("id", "name", "connections")
