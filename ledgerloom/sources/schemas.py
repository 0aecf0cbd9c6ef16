"""Column layouts of the file inputs, as DDL strings (fixed values)."""

ORDERS_LANDING = """
    order_id STRING, customer_id STRING, product_id STRING, order_date STRING,
    ship_date STRING, quantity STRING, unit_price STRING, discount_pct STRING,
    total_amount STRING, payment_method STRING, order_status STRING
"""

PRODUCTS_LANDING = """
    product_id STRING, product_name STRING, category STRING, brand STRING, price STRING,
    cost STRING, stock_quantity STRING, weight_kg STRING, created_date STRING, is_active STRING
"""

CUSTOMERS_LANDING = """
    customer_id INT, first_name STRING, last_name STRING, email STRING, phone STRING,
    signup_date DATE, country STRING, state STRING, postal_code STRING, is_active BOOLEAN,
    loyalty_points INT
"""

CUSTOMER_PAYMENTS = "customer_id STRING, order_id STRING, order_price DOUBLE"
CUSTOMER_AMOUNTS = "customer_id INT, order_id INT, amount FLOAT"
WEATHER = "station_id STRING, date INT, measure_type STRING, temperature FLOAT"
NODE_NAMES = "id INT, name STRING"
