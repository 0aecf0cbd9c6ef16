"""One test per cleaning rule, with the expected value written by hand."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import cleaning as rules
from ledgerloom.operators import null_tokens

DAY = datetime.date(2024, 1, 5)


def applied(spark, rule, values, type_name="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {type_name}").coalesce(1)
    return [row.r for row in df.orderBy("i").select(rule(F.col("v")).alias("r")).collect()]


def amount(comma):
    return lambda value: rules.strip_amount(value, "decimal(38,10)", comma)


def decimals(*texts):
    return [None if text is None else Decimal(text) for text in texts]


ORDER_DATES = lambda value: rules.first_date(value, rules.ORDER_DATE_FORMATS)
PRODUCT_DATES = lambda value: rules.first_date(value, rules.PRODUCT_DATE_FORMATS)
ORDER_TOKENS = lambda value: rules.blank_to_null(value, rules.ORDER_NULL_TOKENS)
PRODUCT_TOKENS = lambda value: rules.blank_to_null(value, rules.PRODUCT_NULL_TOKENS)

CASES = {
    "order tokens": (
        ORDER_TOKENS,
        [" N/A ", "none", "", "NULL", "na", "?", " x ", None],
        [None, None, None, None, None, "?", "x", None],
    ),
    "product tokens": (PRODUCT_TOKENS, [" ? ", "NA", "nail"], [None, None, "nail"]),
    "a tab is not trimmed": (ORDER_TOKENS, ["\tx", "\t"], ["\tx", "\t"]),
    "digits": (rules.digits_only_id, ["12", "12a", "-1", "", None], ["12", None, None, None, None]),
    "product code": (rules.product_code, ["P12", "p12", "12", "P"], ["P12", None, None, None]),
    "order dates": (
        ORDER_DATES,
        ["2024-01-05", "2024/01/05", "01-05-2024", "2024-13-45", "2024-02-30", "2024-1-5", "x",
         "2024-01-05 10:00", "05/01/2024", "2024-01/05", None],
        [DAY, DAY, DAY, None, None, None, None, None, None, None, None],
    ),
    "product dates": (PRODUCT_DATES, ["2024-01-05", "2024/01/05", "01-05-2024"], [DAY, DAY, None]),
    "leap day": (ORDER_DATES, ["02-29-2024", "02-29-2023"], [datetime.date(2024, 2, 29), None]),
    "order amounts": (
        amount(False),
        ["$1,299.50", "12,50", "1.2.3", "-5", "EUR 7", "-", "1-2", "", None],
        decimals("1299.5", "1250", None, "-5", "7", None, None, None, None),
    ),
    "product amounts": (
        amount(True),
        ["12,50", "1,299.50", "$3.25", "0,5 kg"],
        decimals("12.5", None, "3.25", "0.5"),
    ),
    "integers lose the dot": (
        rules.strip_integer,
        ["3", "2.5", "-3", "12 pcs", "x", "99999999999"],
        [3, 25, -3, 12, None, None],
    ),
    "labels": (
        rules.title_label,
        ["CREDIT card", "paypal", "credit-card", None],
        ["Credit Card", "Paypal", "Credit-card", None],
    ),
    "flags": (
        rules.flag_words,
        ["YES", "1", "y", "True", "No", "0", "n", "FALSE", "maybe", None],
        [True, True, True, True, False, False, False, False, None, None],
    ),
    "e-mail": (
        rules.email_address,
        ["A@B.co", "a@b", "a b@c.de", "x.y+z@d-e.org", None],
        ["a@b.co", None, None, "x.y+z@d-e.org", None],
    ),
    "phone": (
        rules.phone_number,
        ["(555) 123-4567", "12345", "1" * 15, "1" * 16, None],
        ["5551234567", None, "1" * 15, None, None],
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_text_rule(spark, name):
    rule, values, expected = CASES[name]
    assert applied(spark, rule, values) == expected


def test_number_rules(spark):
    def positive(value):
        return rules.above(value, 0)

    def not_negative(value):
        return rules.at_least(value, 0)

    assert applied(spark, positive, [3, 0, -3, None], "int") == [3, None, None, None]
    assert applied(spark, not_negative, [3, 0, -3, None], "int") == [3, 0, None, None]
    assert applied(spark, rules.floor_at_zero, [-5, 0, 7, None], "int") == [0, 0, 7, None]
    percents = [Decimal(text) for text in ("15", "0", "100", "101", "-1")] + [None]
    assert applied(spark, rules.percent_or_zero, percents, "decimal(9,4)") == [15, 0, 100, 0, 0, 0]


def test_null_tokens_touches_string_columns_only(spark):
    df = spark.createDataFrame([(0, " none ", " b ")], "i int, a string, c string")
    cleaned = null_tokens(df, rules.ORDER_NULL_TOKENS)
    assert [tuple(row) for row in cleaned.collect()] == [(0, None, "b")]
