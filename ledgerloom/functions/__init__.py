from ledgerloom.functions.cleaning import (
    above,
    at_least,
    blank_to_null,
    digits_only_id,
    email_address,
    first_date,
    flag_words,
    floor_at_zero,
    percent_or_zero,
    phone_number,
    product_code,
    strip_amount,
    strip_integer,
    title_label,
)
from ledgerloom.functions.numeric import exact_product, product_type, round_half_up
from ledgerloom.functions.text import details_text, details_udf, prefixed

__all__ = [
    "above",
    "at_least",
    "blank_to_null",
    "details_text",
    "details_udf",
    "digits_only_id",
    "email_address",
    "exact_product",
    "first_date",
    "flag_words",
    "floor_at_zero",
    "percent_or_zero",
    "phone_number",
    "prefixed",
    "product_code",
    "product_type",
    "round_half_up",
    "strip_amount",
    "strip_integer",
    "title_label",
]
