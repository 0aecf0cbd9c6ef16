"""Text expressions: separators, labels and the two-argument details text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Separators of the text inputs (Java regex).
NON_WORD = r"\W+"
BLANKS = r"\s+"
# What splits words as a plain text split does: the Unicode blanks and the four separator controls.
UNICODE_BLANKS = r"[\x09-\x0D\x1C-\x20\x{85}\p{Z}]+"
PIPE = r"\|"
TAB = r"\t"
COMMA = ","


def prefixed(value: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def details_text(name: Column, age: Column) -> Column:
    """``Name: <name>, Age: <age>``; a missing argument reads ``None``."""
    shown_name = F.coalesce(name.cast("string"), F.lit("None"))
    shown_age = F.coalesce(age.cast("string"), F.lit("None"))
    return F.concat(F.lit("Name: "), shown_name, F.lit(", Age: "), shown_age)


@F.pandas_udf(StringType())
def details_udf(name: pd.Series, age: pd.Series) -> pd.Series:
    """``details_text`` as an Arrow-batched function of two string columns.

    Kept for callers that want a user-defined function; the built-in form is the fast one.
    """
    return "Name: " + name.fillna("None") + ", Age: " + age.fillna("None")
