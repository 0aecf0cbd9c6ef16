from ledgerloom.plans.analytics import ANALYTICS, row_count_validation, run_sql
from ledgerloom.plans.retail import (
    clean_customers,
    clean_orders,
    clean_products,
    curate_retail,
    fk_valid_orders,
    job_counts,
    judge_customers,
    judge_orders,
    judge_products,
    monthly_sales_summary,
    rejected_rules,
    sales_enriched,
    source_and_curated_counts,
    store_co_located,
    tally,
)

__all__ = [
    "ANALYTICS",
    "clean_customers",
    "clean_orders",
    "clean_products",
    "curate_retail",
    "fk_valid_orders",
    "job_counts",
    "judge_customers",
    "judge_orders",
    "judge_products",
    "monthly_sales_summary",
    "rejected_rules",
    "row_count_validation",
    "run_sql",
    "sales_enriched",
    "source_and_curated_counts",
    "store_co_located",
    "tally",
]
