"""Grouped and global aggregates. All combine map-side before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import round_half_up


def count_by(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, in key order."""
    return df.groupBy(key).count().orderBy(key)


def count_by_value(df: DataFrame, column: str) -> DataFrame:
    """Occurrences of each value, unordered."""
    return df.groupBy(F.col(column).alias("value")).count()


def average_by(df: DataFrame, key: str, value: str, name: str, places: int = 2) -> DataFrame:
    """Rounded mean per key, in key order."""
    mean = round_half_up(F.avg(value), places)
    return df.groupBy(key).agg(mean.alias(name)).orderBy(key)


def total_by(df: DataFrame, key: str, value: str, name: str = "total", places: int = 2) -> DataFrame:
    """Rounded sum per key, largest first, ties by key."""
    total = F.round(F.sum(value), places).alias(name)
    grouped = df.groupBy(key).agg(total)
    return grouped.orderBy(F.col(name).desc_nulls_last(), key)


# ``{orders}`` is bound to a frame with columns customer_id and order_price.
CUSTOMER_TOTALS_SQL = """
SELECT customer_id, CAST(SUM(order_price) AS DOUBLE) AS total
FROM {orders}
GROUP BY customer_id
ORDER BY total DESC NULLS LAST, customer_id
"""

# ``{people}`` is bound to a frame with a column age.
ADULTS_SQL = "SELECT * FROM {people} WHERE age >= {min_age}"


def customer_totals_sql(orders: DataFrame) -> DataFrame:
    return orders.sparkSession.sql(CUSTOMER_TOTALS_SQL, orders=orders)


def adults_sql(people: DataFrame, min_age: int = 18) -> DataFrame:
    return people.sparkSession.sql(ADULTS_SQL, people=people, min_age=min_age)


def min_by_key(
    df: DataFrame, key: str, measure: str, value: str, kind: str, name: str = "minimum"
) -> DataFrame:
    """Smallest ``value`` per key among rows whose ``measure`` equals ``kind``, coldest first."""
    wanted = df.where(F.col(measure) == kind)
    lowest = wanted.groupBy(key).agg(F.min(value).alias(name))
    return lowest.orderBy(F.col(name).asc_nulls_last(), key)


def reduce_numbers(df: DataFrame, column: str, zero: int = 0) -> DataFrame:
    """Sum, maximum, minimum and the folded sum of a column, in one row.

    ``fold`` over partitions counts its start value once per partition and once more at the
    end, so only the neutral start has a fixed meaning: ``zero`` is the result for no rows.
    """
    total = F.sum(column)
    return df.agg(
        total.alias("total"),
        F.max(column).alias("maximum"),
        F.min(column).alias("minimum"),
        F.coalesce(total, F.lit(zero)).alias("folded"),
    )
