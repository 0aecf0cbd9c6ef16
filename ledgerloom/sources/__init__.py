from ledgerloom.sources.files import (
    header_names,
    misfit_counts,
    parse_delimited,
    read_csv,
    read_csv_by_name,
    read_customer_amounts,
    read_customer_payments,
    read_customers_landing,
    read_item_titles,
    read_lines,
    read_node_names,
    read_orders_landing,
    read_people_lines,
    read_products_landing,
    read_ratings,
    read_weather,
)
from ledgerloom.sources.memory import number_range, value_rows
from ledgerloom.sources.views import CURATED_VIEWS, register_curated, register_exports

__all__ = [
    "CURATED_VIEWS",
    "header_names",
    "misfit_counts",
    "number_range",
    "parse_delimited",
    "read_csv",
    "read_csv_by_name",
    "read_customer_amounts",
    "read_customer_payments",
    "read_customers_landing",
    "read_item_titles",
    "read_lines",
    "read_node_names",
    "read_orders_landing",
    "read_people_lines",
    "read_products_landing",
    "read_ratings",
    "read_weather",
    "register_curated",
    "register_exports",
    "value_rows",
]
