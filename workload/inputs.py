"""Inputs of the registered queries, as SQL that reads the given tables.

The texts use only syntax that Spark SQL and the oracle engine read alike, so both sides
start from the same rows and everything after them is computed independently. ``{table}``
stands for a given table. The tables are clean, so dirt is put on by key arithmetic: padded
and broken ids, null words, currency marks, mixed date formats, out-of-range numbers, and
many copies per key (one landing row per line item or order).
"""

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def _dated(text: str, number: str) -> str:
    """``yyyy-MM-dd`` text written in one of the three date formats."""
    return (
        f"CASE ({number}) % 3 WHEN 0 THEN {text} WHEN 1 THEN replace({text}, '-', '/') "
        f"ELSE substr({text}, 6, 5) || '-' || substr({text}, 1, 4) END"
    )


def _marked(text: str) -> str:
    """``1234.50`` with a comma inside, ``1,234.50``; other lengths get it as well."""
    return f"substr({text}, 1, 1) || ',' || substr({text}, 2)"


def _money(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(18,2)) AS STRING)"


def _day(column: str) -> str:
    return f"CAST(CAST({column} AS DATE) AS STRING)"


LANDING_ORDERS = f"""
SELECT
  CASE WHEN n = 2 THEN ' ' WHEN k % 97 = 5 THEN 'x' ELSE '' END || k_text AS order_id,
  CASE WHEN s % 53 = 1 THEN 'none' WHEN s % 59 = 2 THEN '-' || c_text
       ELSE c_text || ' ' END AS customer_id,
  CASE WHEN s % 47 = 3 THEN 'p' WHEN n = 4 THEN ' P' ELSE 'P' END || p_text AS product_id,
  CASE WHEN s % 61 = 5 THEN '2024-13-45' ELSE {_dated('ordered', 's')} END AS order_date,
  CASE WHEN s % 43 = 0 THEN '' WHEN s % 2 = 0 THEN replace(shipped, '-', '/')
       ELSE shipped END AS ship_date,
  CASE WHEN s % 41 = 6 THEN '-' ELSE '' END || units ||
    CASE WHEN k % 19 = 0 THEN '.5' ELSE ' pcs' END AS quantity,
  CASE WHEN s % 67 = 4 THEN '1.2.3' WHEN s % 73 = 8 THEN '100000000000000'
       WHEN s % 79 = 9 THEN '0.00004' WHEN s % 37 = 7 THEN '0.0049999999'
       WHEN s % 37 = 8 THEN '0.05' WHEN s % 37 = 9 THEN '0.0050000000'
       WHEN s % 37 = 10 THEN '123456789012345678.1234567891'
       ELSE '$' || {_marked('price')} END AS unit_price,
  CASE WHEN s % 37 = 8 THEN '9.999' WHEN s % 37 = 10 THEN '33.3333' WHEN s % 13 = 0 THEN '15' WHEN s % 17 = 0 THEN '-' ELSE '' END || percent || ' %'
    AS discount_pct,
  CASE WHEN s % 71 = 9 THEN 'NA' WHEN s % 83 = 7 THEN '100,000,000,000,000,000,000'
       ELSE 'USD ' || {_marked('total')} END AS total_amount,
  CASE n % 3 WHEN 0 THEN 'CARD' WHEN 1 THEN 'paypal' ELSE ' Cash' END AS payment_method,
  CASE flag WHEN 'R' THEN 'RETURNED' WHEN 'A' THEN 'cancelled ' ELSE 'Completed' END
    AS order_status
FROM (
  SELECT l_orderkey AS k, l_linenumber AS n, l_orderkey + l_linenumber AS s,
         CAST(l_orderkey AS STRING) AS k_text, CAST(o_custkey AS STRING) AS c_text,
         CAST(l_partkey AS STRING) AS p_text,
         {_day('o_orderdate')} AS ordered, {_day('l_shipdate')} AS shipped,
         CAST(CAST(l_quantity AS INT) AS STRING) AS units,
         {_money('l_extendedprice')} AS price, {_money('o_totalprice')} AS total,
         CAST(CAST(l_discount AS DECIMAL(5,2)) AS STRING) AS percent,
         l_returnflag AS flag
  FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
) AS lines
"""

LANDING_PRODUCTS = f"""
SELECT
  CASE WHEN n = 5 THEN ' P' WHEN p % 89 = 4 THEN 'p' ELSE 'P' END || p_text AS product_id,
  CASE WHEN p % 79 = 1 THEN 'n/a' WHEN p % 83 = 1 THEN '?' ELSE p_name END AS product_name,
  lower(p_type) || ' ' AS category,
  CASE WHEN n % 2 = 0 THEN upper(p_brand) ELSE p_brand END AS brand,
  CASE WHEN p % 73 = 6 THEN '1,299.50' WHEN p % 71 = 5 THEN '100000000000000000000' ELSE 'EUR ' || replace(price, '.', ',') END AS price,
  CASE WHEN s % 997 = 1 THEN 'none' WHEN p % 61 = 3 THEN '0,00004' ELSE paid END AS cost,
  CASE WHEN s % 7 = 0 THEN '-' ELSE ' ' END || units || ' pcs' AS stock_quantity,
  CASE WHEN p % 9 = 0 THEN '0' ELSE size_text || ',5 kg' END AS weight_kg,
  CASE WHEN p % 67 = 8 THEN '01-05-2024' WHEN s % 2 = 0 THEN replace(shipped, '-', '/')
       ELSE shipped END AS created_date,
  CASE flag WHEN 'R' THEN 'YES' WHEN 'A' THEN '0' ELSE 'maybe' END AS is_active
FROM (
  SELECT p_partkey AS p, l_linenumber AS n, l_orderkey + l_linenumber AS s,
         CAST(p_partkey AS STRING) AS p_text, p_name, p_type, p_brand,
         {_money('p_retailprice')} AS price, {_money('l_extendedprice')} AS paid,
         CAST(CAST(l_quantity AS INT) AS STRING) AS units, CAST(p_size AS STRING) AS size_text,
         {_day('l_shipdate')} AS shipped, l_returnflag AS flag
  FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey
) AS lines
"""

LANDING_CUSTOMERS = f"""
SELECT
  CAST(c_custkey AS INT) AS customer_id,
  CASE WHEN c_custkey % 31 = 3 THEN '  ' ELSE ' ' || substr(c_name, 1, 8) END AS first_name,
  substr(c_name, 10) AS last_name,
  CASE WHEN c_custkey % 29 = 4 THEN 'c@b' WHEN c_custkey % 37 = 5 THEN ''
       ELSE 'C' || CAST(c_custkey AS STRING) || '@Example.com ' END AS email,
  CASE WHEN c_custkey % 5 = 0 THEN '12345'
       ELSE '(' || substr(c_name, 10, 3) || ') ' || substr(c_name, 13) || '-55' END AS phone,
  CASE WHEN c_custkey % 41 = 6 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS signup_date,
  'Country ' || CAST(c_nationkey AS STRING) AS country,
  CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE c_mktsegment END AS state,
  substr(c_name, 14) AS postal_code,
  o_orderstatus = 'F' AS is_active,
  CAST(o_orderkey % 200 - 50 AS INT) AS loyalty_points
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
"""

# The same as text, with cells that do not fit their types.
BROKEN_CUSTOMERS = f"""
SELECT CASE WHEN id % 17 = 1 THEN 'c' ELSE '' END || CAST(id AS STRING) AS customer_id,
  first_name, last_name, email, phone,
  CASE WHEN id % 11 = 2 THEN 'soon' ELSE CAST(signup_date AS STRING) END AS signup_date,
  country, state, postal_code,
  CASE WHEN id % 13 = 3 THEN 'maybe' ELSE CAST(is_active AS STRING) END AS is_active,
  CASE WHEN id % 7 = 4 THEN 'many' ELSE CAST(loyalty_points AS STRING) END AS loyalty_points
FROM (SELECT *, customer_id AS id FROM ({LANDING_CUSTOMERS}) AS landed) AS numbered
"""

# The curated retail tables over the clean data: every line item is a sold order line.
RETAIL_ORDERS = """
SELECT CAST(l_orderkey AS STRING) AS order_id,
       CAST(o_custkey AS STRING) AS customer_id,
       'P' || CAST(l_partkey AS STRING) AS product_id,
       CAST(o_orderdate AS DATE) AS order_date,
       CAST(l_shipdate AS DATE) AS ship_date,
       CAST(l_quantity AS INT) AS quantity,
       CAST(l_extendedprice AS DECIMAL(18,4)) AS unit_price,
       CAST(CAST(l_discount AS DECIMAL(5,2)) * 100 AS DECIMAL(7,4)) AS discount_pct,
       CAST(o_totalprice AS DECIMAL(18,4)) AS total_amount,
       o_orderpriority AS payment_method,
       CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Cancelled' ELSE 'Completed' END
         AS order_status
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

RETAIL_CUSTOMERS = """
SELECT CAST(c_custkey AS INT) AS customer_id,
       substr(c_name, 1, 8) AS first_name,
       substr(c_name, 10) AS last_name,
       'c' || CAST(c_custkey AS STRING) || '@example.com' AS email,
       n_name AS country,
       r_name AS state,
       c_acctbal AS balance
FROM {customer}
JOIN {nation} ON c_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey
"""

RETAIL_PRODUCTS = """
SELECT 'P' || CAST(p_partkey AS STRING) AS product_id,
       p_name AS product_name,
       p_type AS category,
       p_brand AS brand,
       p_size AS size
FROM {part}
"""

PEOPLE = """
SELECT c_custkey AS id, c_name AS name, c_nationkey + 10 AS age,
       CAST(floor(c_acctbal) AS INT) AS friends
FROM {customer}
"""

CUSTOMER_ORDERS = """
SELECT CAST(o_custkey AS STRING) AS customer_id, CAST(o_orderkey AS STRING) AS order_id,
       CAST(o_totalprice AS DECIMAL(18,2)) AS order_price
FROM {orders}
"""

# Adjacency lines: a supplier and the parts and orders it serves; some lines are blank, some
# have no usable id, some are padded.
GRAPH_LINES = """
SELECT CASE WHEN l_orderkey % 50 = 1 THEN ''
            WHEN l_orderkey % 50 = 2 THEN 'x' || CAST(l_suppkey AS STRING) || ' 1 2'
            WHEN l_linenumber = 1 THEN CAST(l_suppkey AS STRING)
            WHEN l_linenumber < 4 THEN ' ' || CAST(l_suppkey AS STRING) || '  '
                                       || CAST(l_partkey AS STRING) || ' '
            ELSE CAST(l_suppkey AS STRING) || ' ' || CAST(l_partkey AS STRING) || '   '
                 || CAST(l_orderkey AS STRING) END AS value
FROM {lineitem}
"""

GRAPH_NAMES = """
SELECT CAST(s_suppkey AS INT) AS id, s_name AS name FROM {supplier}
"""

RATINGS = """
SELECT o_custkey AS customer, l_suppkey AS supplier, l_quantity AS rating
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

TITLES = """
SELECT s_suppkey AS item, s_name AS title FROM {supplier}
"""

# Blanks of several kinds part the words: no-break, em and ideographic spaces among them.
LOG_LINES = """
SELECT upper(event_type) || ':\u00a0' || replace(props, ': ', ':\u2003') AS value FROM {events}
"""

SPACED_LINES = """
SELECT replace(replace(replace(text, 'e ', 'e\u00a0'), 't ', 't\u2003'), 'n ', 'n\u3000 ') AS value
FROM {conversations}
"""

READINGS = """
SELECT 'S' || CAST(user_id AS STRING) AS station_id,
       CAST(18000101 + event_id % 28 AS INT) AS date, event_type AS measure_type,
       value AS temperature
FROM {events}
"""

AMOUNTS = """
SELECT CAST(o_custkey AS INT) AS customer_id, CAST(o_orderkey AS INT) AS order_id,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount
FROM {orders}
"""
