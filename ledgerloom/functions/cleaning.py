"""Column rules for dirty landing data.

Each rule is a built-in expression (whole-stage codegen, no Python worker) and is safe
under ANSI mode: a value that does not fit becomes null instead of raising.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no value", compared after trim and lower.
ORDER_NULL_TOKENS = ("", "null", "n/a", "na", "none")
PRODUCT_NULL_TOKENS = ("", "null", "n/a", "na", "none", "?")
BLANK_ONLY = ("",)

# Identifier, e-mail and number patterns (Java regex).
DIGITS_PATTERN = r"^\d+$"
PRODUCT_CODE_PATTERN = r"^P\d+$"
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
NOT_AMOUNT_PATTERN = r"[^0-9.\-]"
NOT_INTEGER_PATTERN = r"[^0-9\-]"
NUMBER_PATTERN = r"^-?(\d+\.?\d*|\.\d+)\z"

# Date formats in order of preference, and yes/no words.
ORDER_DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "MM-dd-yyyy")
PRODUCT_DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd")
TRUE_WORDS = ("true", "1", "yes", "y")
FALSE_WORDS = ("false", "0", "no", "n")
PHONE_DIGITS = (10, 15)


def blank_to_null(value: Column, null_tokens: Sequence[str] = BLANK_ONLY) -> Column:
    """Trimmed text, or null when it is one of ``null_tokens`` (any letter case)."""
    text = F.trim(value)
    return F.when(~F.lower(text).isin(list(null_tokens)), text)


def digits_only_id(value: Column) -> Column:
    return F.when(value.rlike(DIGITS_PATTERN), value)


def product_code(value: Column) -> Column:
    """Upper-case ``P`` and digits. The test comes before any case folding: ``p12`` is null."""
    return F.when(value.rlike(PRODUCT_CODE_PATTERN), value)


def _date_in(value: Column, fmt: str) -> Column:
    """The date when ``value`` has exactly the digits and marks of ``fmt``, else null.

    The shape is tested and the parts put in ISO order, because the cast is several times
    faster than a formatter and a misfit costs no exception.
    """
    parts = ("yyyy", "MM", "dd")
    shape = fmt
    for part in parts:
        shape = shape.replace(part, rf"\d{{{len(part)}}}")
    iso = F.concat_ws("-", *[F.substring(value, fmt.index(p) + 1, len(p)) for p in parts])
    return F.when(value.rlike(rf"^{shape}\z"), iso.try_cast("date"))


def first_date(value: Column, formats: Sequence[str]) -> Column:
    """The date read with the first fitting format, each made of yyyy, MM, dd and marks."""
    return F.coalesce(*[_date_in(value, fmt) for fmt in formats])


def strip_amount(value: Column, type_name: str, decimal_comma: bool = False) -> Column:
    """Number left after removing everything but digits, dot and minus.

    With ``decimal_comma`` a comma is read as the decimal point (``12,50`` is 12.50);
    without it a comma is a thousands mark and is removed (``12,50`` is 1250).
    What is left and is no number (``1.2.3``) becomes null. A number that the type cannot hold
    raises: as null it would cost the whole row without a trace.
    """
    text = F.translate(value, ",", ".") if decimal_comma else value
    number = F.regexp_replace(text, NOT_AMOUNT_PATTERN, "")
    read = number.try_cast(type_name)
    too_large = F.raise_error(F.concat(F.lit(f"amount does not fit {type_name}: "), number))
    return F.when(read.isNull() & number.rlike(NUMBER_PATTERN), too_large.cast(type_name)).otherwise(read)


def strip_integer(value: Column) -> Column:
    """Integer left after removing everything but digits and minus, so ``2.5`` is 25."""
    return F.regexp_replace(value, NOT_INTEGER_PATTERN, "").try_cast("int")


def at_least(value: Column, bound) -> Column:
    return F.when(value >= bound, value)


def above(value: Column, bound) -> Column:
    return F.when(value > bound, value)


def percent_or_zero(value: Column) -> Column:
    """A percentage from 0 to 100; anything else, null included, counts as 0."""
    return F.when(value.between(0, 100), value).otherwise(F.lit(0))


def title_label(value: Column) -> Column:
    """First letter of each blank-separated word in upper case, the rest in lower case."""
    return F.initcap(value)


def flag_words(value: Column) -> Column:
    """True or false for the known yes/no words, else null."""
    word = F.lower(value)
    return F.when(word.isin(list(TRUE_WORDS)), True).when(word.isin(list(FALSE_WORDS)), False)


def email_address(value: Column) -> Column:
    return F.when(value.rlike(EMAIL_PATTERN), F.lower(value))


def phone_number(value: Column) -> Column:
    digits = F.regexp_replace(value, r"\D", "")
    return F.when(F.length(digits).between(*PHONE_DIGITS), digits)


def floor_at_zero(value: Column) -> Column:
    """Negative becomes 0; null stays null (``greatest`` would turn null into 0)."""
    return F.when(value < 0, F.lit(0)).otherwise(value)
