"""Products of money amounts against Python's decimals."""

from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType, StructField, StructType
from test_retail import customers, orders, products

from ledgerloom import plans
from ledgerloom.functions import exact_product, product_type

AMOUNT, GROSS, PERCENT = DecimalType(38, 10), DecimalType(38, 2), DecimalType(7, 4)


def rounded(left, right, places):
    with localcontext(prec=120):
        return (Decimal(left) * Decimal(right)).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)


def products_of(spark, pairs, left_type, right_type, places):
    schema = StructType([StructField("a", left_type), StructField("b", right_type)])
    made = exact_product(F.col("a"), left_type, F.col("b"), right_type, places)
    return [row.r for row in spark.createDataFrame(pairs, schema).select(made.alias("r")).collect()]


def scaled(places, digits):
    """Decimals with many nines, fives and zeros among them."""
    odd = st.text("0459", min_size=1, max_size=digits).map(int)
    whole = st.one_of(st.integers(0, 10**digits - 1), odd)
    # ``scaleb`` would round to 28 digits
    return st.tuples(whole, st.booleans()).map(lambda x: Decimal(f"{'-' if x[1] else ''}{x[0]}E-{places}"))


slow = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True, phases=[Phase.generate])


@slow
@given(pairs=st.lists(st.tuples(scaled(10, 35), st.integers(-999, 999)), min_size=60, max_size=60))
def test_price_times_quantity_is_rounded_once(spark, pairs):
    got = products_of(spark, pairs, AMOUNT, IntegerType(), 2)
    assert got == [rounded(a, b, 2) for a, b in pairs]


@slow
@given(pairs=st.lists(st.tuples(scaled(2, 38), st.integers(0, 10**6).map(lambda n: Decimal(n).scaleb(-4))), min_size=60, max_size=60))
def test_gross_times_percent_is_rounded_once(spark, pairs):
    got = products_of(spark, pairs, GROSS, PERCENT, 0)
    assert got == [rounded(a, b, 0) for a, b in pairs]


@pytest.mark.parametrize(
    "left, right, places",
    [(DecimalType(18, 4), IntegerType(), 2), (AMOUNT, LongType(), 2), (DecimalType(30, 8), DecimalType(12, 6), 3), (DecimalType(38, 0), DecimalType(6, 4), 2)],
)
def test_products_of_other_types(spark, left, right, places):
    pairs = [(Decimal(n).scaleb(-left.scale), m) for n in (0, 5, -5, 49_999_999, 123_456_789_012_345) for m in (0, 1, -3, 7)]
    pairs = [(a, Decimal(m).scaleb(-right.scale) if isinstance(right, DecimalType) else m) for a, m in pairs]
    assert products_of(spark, pairs, left, right, places) == [rounded(a, b, places) for a, b in pairs]


def test_a_product_that_does_not_fit_raises(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        products_of(spark, [(Decimal(10) ** 27, 2**31 - 1)], AMOUNT, IntegerType(), 2)
    with pytest.raises(ValueError, match="exactly"):
        exact_product(F.col("a"), AMOUNT, F.col("b"), DecimalType(38, 10), 2)
    with pytest.raises(TypeError, match="string"):
        exact_product(F.col("a"), AMOUNT, F.col("b"), StringType(), 2)


def test_products_of_short_amounts_stay_short():
    assert product_type(DecimalType(18, 4), IntegerType(), 2) == DecimalType(28, 2)
    assert product_type(AMOUNT, IntegerType(), 2) == GROSS


@pytest.mark.parametrize(
    "price, percent, quantity, gross, discount, net",
    [
        ("0.0049999999", "0", "1", "0.00", "0.00", "0.00"),
        ("0.0050000000", "0", "1", "0.01", "0.00", "0.01"),
        ("0.05", "9.999", "1", "0.05", "0.00", "0.05"),
        ("10.05", "10", "1", "10.05", "1.01", "9.04"),
        ("1234567890123456789012345.1234567891", "33.3333", "999", None, None, None),
    ],
)
def test_sales_are_booked_to_the_cent(spark, price, percent, quantity, gross, discount, net):
    one = orders(spark, {"quantity": quantity, "unit_price": price, "discount_pct": percent})
    sold = plans.sales_enriched(
        plans.clean_orders(one), plans.clean_customers(customers(spark, {})), plans.clean_products(products(spark, {}))
    ).first()
    booked = (sold.gross_amount, sold.discount_amount, sold.net_amount)
    right = rounded(price, quantity, 2)
    with localcontext(prec=120):
        off = rounded(right, Decimal(percent) / 100, 2)
        assert booked == (right, off, right - off)
    assert gross is None or booked == (Decimal(gross), Decimal(discount), Decimal(net))
