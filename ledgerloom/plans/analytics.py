"""The retail questions as SQL text, run over the registered curated views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TOP_PRODUCTS = """
SELECT product_id, product_name, CAST(SUM(net_amount) AS DOUBLE) AS net_revenue
FROM sales_enriched
GROUP BY product_id, product_name
ORDER BY net_revenue DESC NULLS LAST, product_id, product_name
LIMIT 10
"""

REVENUE_BY_CATEGORY_MONTH = """
SELECT order_month, category, net_revenue, total_units_sold
FROM monthly_sales_summary
ORDER BY order_month, category
"""

CUSTOMER_LIFETIME_VALUE = """
SELECT customer_id, first_name, last_name,
       ROUND(CAST(SUM(net_amount) AS DOUBLE), 2) AS lifetime_value,
       COUNT(DISTINCT order_id) AS total_orders
FROM sales_enriched
GROUP BY customer_id, first_name, last_name
ORDER BY lifetime_value DESC NULLS LAST, customer_id, first_name, last_name
LIMIT 10
"""

DISCOUNT_BY_PAYMENT = """
SELECT payment_method,
       CAST(ROUND(CAST(CAST(SUM(discount_pct) AS DOUBLE) / COUNT(discount_pct)
                       AS DECIMAL(38,8)), 2) AS DOUBLE) AS avg_discount_pct,
       ROUND(CAST(SUM(net_amount) AS DOUBLE), 2) AS net_revenue
FROM sales_enriched
GROUP BY payment_method
ORDER BY net_revenue DESC NULLS LAST, payment_method
"""

RETURN_RATES = """
WITH by_category AS (
  SELECT category,
         COUNT(*) AS total_rows,
         COUNT_IF(order_status = 'Returned') AS returned_rows,
         COUNT_IF(order_status = 'Cancelled') AS cancelled_rows
  FROM sales_enriched
  GROUP BY category
)
SELECT *,
       CAST(ROUND(CAST(100.0D * returned_rows / NULLIF(total_rows, 0)
                       AS DECIMAL(38,8)), 2) AS DOUBLE) AS return_rate_pct,
       CAST(ROUND(CAST(100.0D * cancelled_rows / NULLIF(total_rows, 0)
                       AS DECIMAL(38,8)), 2) AS DOUBLE) AS cancellation_rate_pct
FROM by_category
ORDER BY return_rate_pct DESC NULLS LAST, category
"""

ROW_COUNT_VALIDATION = """
SELECT 'ORDERS_CURATED' AS table_name, COUNT(*) AS record_count FROM orders_curated
UNION ALL SELECT 'PRODUCTS_CURATED', COUNT(*) FROM products_curated
UNION ALL SELECT 'CUSTOMERS_CURATED', COUNT(*) FROM customers_curated
UNION ALL SELECT 'SALES_ENRICHED', COUNT(*) FROM sales_enriched
UNION ALL SELECT 'MONTHLY_SALES_SUMMARY', COUNT(*) FROM monthly_sales_summary
"""

ANALYTICS = {
    "top_products": TOP_PRODUCTS,
    "revenue_by_category_month": REVENUE_BY_CATEGORY_MONTH,
    "customer_ltv": CUSTOMER_LIFETIME_VALUE,
    "discount_by_payment": DISCOUNT_BY_PAYMENT,
    "return_rates": RETURN_RATES,
    "row_count_validation": ROW_COUNT_VALIDATION,
}


def run_sql(spark: SparkSession, name: str) -> DataFrame:
    """One of ``ANALYTICS`` over the views that ``register_curated`` made."""
    return spark.sql(ANALYTICS[name])


def row_count_validation(spark: SparkSession) -> DataFrame:
    return run_sql(spark, "row_count_validation")
