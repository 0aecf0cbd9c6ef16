"""Number expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegerType, LongType

# Digits of Spark's widest decimal, and the places it keeps in any product.
MAX_DIGITS = 38
KEPT_PLACES = 6


def round_half_up(value: Column, places: int = 2) -> Column:
    """A double rounded half up on its decimal reading.

    The last bit of a quotient can put 0.055 just under the half; eight decimal places are
    kept first, so such a value still rounds up. What has no such reading stays as it is: NaN, the
    infinities, and values from 1e30 on, which have no places left to round.
    """
    rounded = F.round(value.try_cast("decimal(38,8)"), places).cast("double")
    return F.coalesce(rounded, value.cast("double"))


def as_decimal(kind: DataType) -> DecimalType:
    """The decimal type that holds every value of ``kind``: a decimal, int or long."""
    if isinstance(kind, DecimalType):
        return kind
    if isinstance(kind, (IntegerType, LongType)):
        return DecimalType(10 if isinstance(kind, IntegerType) else 20, 0)
    raise TypeError(f"no exact decimal for {kind.simpleString()}")


def product_type(left: DataType, right: DataType, places: int) -> DecimalType:
    """The type of ``exact_product``: no wider than the factors ask for."""
    one, two = as_decimal(left), as_decimal(right)
    whole = one.precision - one.scale + two.precision - two.scale + 2
    return DecimalType(min(whole + places, MAX_DIGITS), places)


def exact_product(left: Column, left_type: DataType, right: Column, right_type: DataType, places: int) -> Column:
    """``left * right``, rounded once, half away from zero, to ``places``.

    Spark rounds a product of more than 38 digits to six places before anything else can look at it.
    Where that could happen ``left`` is split at 10**(right's scale - places): the upper part times
    ``right`` has ``places`` places and needs no rounding, the lower part is short and its product is
    exact, so rounding it rounds the whole. A product too large for 38 digits raises (null
    without ANSI mode); it is never inexact.
    """
    one, two = as_decimal(left_type), as_decimal(right_type)
    a, b = left.cast(one), right.cast(two)
    if one.precision + two.precision + 1 <= MAX_DIGITS:
        return F.round(a * b, places).cast(product_type(one, two, places))
    split = places - two.scale  # decimal places of the upper part; negative: zeros before the point
    if not 0 <= places <= KEPT_PLACES or one.scale + max(-split, 0) + two.precision + 1 > MAX_DIGITS:
        raise ValueError(f"cannot multiply {one.simpleString()} by {two.simpleString()} exactly to {places} places")
    step = F.lit(Decimal(1).scaleb(-split))
    if split >= one.scale:
        upper, lower = a, F.lit(Decimal(0))
    else:  # both towards zero, so that they have one sign (``abs`` and minus keep 34 digits only)
        upper = F.when(a < 0, F.ceil(a, F.lit(split))).otherwise(F.floor(a, F.lit(split)))
        lower = a % step
    if split < 0:  # both as whole numbers of the result's last place
        digits = DecimalType(one.precision - one.scale, 0)
        upper = (upper.cast(digits) * F.lit(Decimal(1).scaleb(split))).cast(digits)
        b_whole = (b * step).cast(DecimalType(min(two.precision - split, MAX_DIGITS), places))
        product = upper * b_whole
    else:
        product = upper * b
    return (product + F.round(lower * b, places)).cast(product_type(one, two, places))
