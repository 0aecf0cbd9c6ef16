"""Row-level operators: de-duplication, required columns, key checks, counts, top-k."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType, VariantType

from ledgerloom.functions.cleaning import blank_to_null


def null_tokens(df: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """Trim every string column and turn the given tokens into null, in one projection."""
    texts = {
        field.name: blank_to_null(F.col(field.name), tokens)
        for field in df.schema.fields
        if isinstance(field.dataType, StringType)
    }
    return df.withColumns(texts)


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of ``columns`` is null."""
    return df.na.drop(subset=list(columns))


def dedup_by_key(
    df: DataFrame,
    keys: Sequence[str],
    rules: Mapping[str, Callable[[Column], Column]] | None = None,
    count_as: str | None = None,
) -> DataFrame:
    """One row per key: the smallest row, comparing all columns left to right, nulls first.

    The choice depends only on the data, so a re-run or a lost executor keeps the same row.
    It is a ``min`` over the other columns as a struct: each map task keeps one row per key before
    the shuffle, so a key that holds a third of the input sends one row per task, and the key
    travels once. Rows with a null key form one group, as ``dropDuplicates`` treats them.
    Columns without an order of their own (maps, variants) compare by their JSON text.

    ``rules`` are applied to columns of the kept rows as part of the aggregation's result, so
    an expensive rule runs once per kept row even when a later filter looks at its column.
    ``count_as`` names a further column with the number of rows of the key.
    """
    rules = rules or {}
    # by place, so that no column name can clash or need quoting on the way
    places = {name: f"key{i}" if name in keys else f"c{i}" for i, name in enumerate(df.columns)}
    placed = df.toDF(*places.values())
    others = [place for name, place in places.items() if name not in keys]
    types = {place: field.dataType for place, field in zip(places.values(), df.schema.fields)}
    ordered = [
        F.to_json(F.struct(place)).alias(place) if _has_no_order(types[place]) else F.col(place)
        for place in others
    ]
    grouped = placed.groupBy(*[places[name] for name in keys])
    if not others:
        kept = None
    elif any(_has_no_order(types[place]) for place in others):
        kept = F.min_by(F.struct(*others), F.struct(*ordered))
    else:
        kept = F.min(F.struct(*others))
    results = [
        rules.get(name, lambda column: column)(F.col(place) if name in keys else kept[place]).alias(place + "r")
        for name, place in places.items()
    ]
    names = [place + "r" for place in places.values()]
    if count_as:
        results.append(F.count(F.lit(1)).alias("rows"))
        return grouped.agg(*results).select(*names, "rows").toDF(*df.columns, count_as)
    return grouped.agg(*results).select(*names).toDF(*df.columns)


def _has_no_order(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_has_no_order(field.dataType) for field in kind.fields)
    if isinstance(kind, ArrayType):
        return _has_no_order(kind.elementType)
    return isinstance(kind, (MapType, VariantType))


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def fk_valid(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows whose every foreign key occurs in its dimension.

    ``dimensions`` maps a column name to the frame that owns it under the same name. Keys
    compare as text, so ``"007"`` does not match 7. Each test is an ``IN`` filter: Spark moves it
    below the joins that ``fact`` is made by, to the table that the key is of, and plans it there as a
    semi join. That never multiplies rows, so the dimension keys need no ``distinct``. No join hint is
    given: Spark broadcasts a key list only when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, where adaptive execution
    splits a hot key.
    """
    valid = fact
    for key, dimension in dimensions.items():
        valid = valid.where(fact[key].cast("string").isin(dimension.select(F.col(key).cast("string"))))
    return valid


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, record_count)``, one row per named frame."""
    counted = [
        frame.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("table_name"), "record_count"
        )
        for name, frame in frames.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def top(df: DataFrame, by: str, n: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows with the largest ``by``; nulls last, ties by ``tie_break`` ascending."""
    order: list[Column] = [F.col(by).desc_nulls_last(), *[F.col(name) for name in tie_break]]
    return df.orderBy(*order).limit(n)


def take_ordered(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in ascending ``order``, nulls last (also ``first`` and ``take``)."""
    return df.orderBy(*[F.col(name).asc_nulls_last() for name in order]).limit(n)


def only_value(df: DataFrame, column: str, function) -> Column:
    """One aggregate over the whole frame as a scalar subquery, so the plan stays one job."""
    return df.agg(function(column)).scalar()
