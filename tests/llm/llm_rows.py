"""Fixtures that build documents frames."""

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents frame from (doc_id, text) pairs, or longer rows."""

    def build(*rows, columns=DOCUMENT):
        full = [tuple(row) + (None,) * (5 - len(row)) for row in rows]
        return spark.createDataFrame(full, columns)

    return build


@pytest.fixture
def clashing(documents):
    """The same with extra columns whose names the operators use inside."""

    def build(*rows):
        from pyspark.sql import functions as F

        names = "key row node label pos word digest batch h value n start end spans at c fp kept score"
        return documents(*rows).withColumns({name: F.lit("x") for name in names.split()})

    return build
