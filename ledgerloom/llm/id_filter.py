"""A filter of ids that is at hand in every task: rows that no id names are told apart without moving them."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shingles import mixed

# The filter has at most so many bits (8 MB).
FILTER_BITS = 1 << 26


def _places(ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places in a filter of ``bits`` bits, a power of two, for each id."""
    hashed = mixed(ids.astype(np.int64).view(np.uint64))
    return hashed & np.uint64(bits - 1), (hashed >> np.uint64(32)) & np.uint64(bits - 1)


def named_in(ids: DataFrame, most_bits: int = FILTER_BITS):
    """A function of an id column: false where no row of ``ids`` (one long column) has the id.

    It is true for every id of ``ids`` and for few others: 16 bits stand for an id, ``most_bits`` in
    all, so that with more ids than that allows for more of the others pass, and none of those is lost.
    A null id is never named.
    """
    name = ids.columns[0]
    distinct = ids.filter(F.col(name).isNotNull()).distinct()
    many = distinct.agg(F.approx_count_distinct(name).alias("n")).first().n
    bits = min(most_bits, max(1024, 1 << (16 * many).bit_length()))

    def words(batches):
        for batch in batches:
            places = np.concatenate(_places(batch.column(0).to_numpy(zero_copy_only=False), bits))
            bit = np.uint64(1) << (places & np.uint64(63))
            yield pa.record_batch([pa.array((places >> np.uint64(6)).view(np.int64)), pa.array(bit.view(np.int64))], names=["word", "bit"])

    found = distinct.mapInArrow(words, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    content = np.zeros(bits // 64, np.uint64)
    content[found.column("word").to_numpy()] = found.column("bit").to_numpy().view(np.uint64)
    shared = ids.sparkSession.sparkContext.broadcast(content)

    @F.pandas_udf("boolean")
    def there(keys: pd.Series) -> pd.Series:
        first, second = (
            shared.value[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1) for p in _places(keys.fillna(0).to_numpy(), bits)
        )
        return pd.Series((first & second).astype(bool) & keys.notna().to_numpy())

    def of(column: Column) -> Column:
        return there(column.cast("long"))

    return of
