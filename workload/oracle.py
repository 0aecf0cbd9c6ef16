"""The registered queries again, as SQL for the oracle engine.

Each text starts from the same input SQL and computes the operator on its own terms. Where
the engines round differently, the oracle rounds the decimal reading as ``DECIMAL(28,8)``.
"""

from __future__ import annotations

from workload import inputs
from workload.queries import MIN_PAIRS, MIN_SCORE, SIMILAR_TO, TOP_N


def over_tables(sql: str) -> str:
    return sql.format(**{name: name for name in inputs.TABLES})


def round2(expression: str) -> str:
    return f"CAST(round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(28,8)), 2) AS DOUBLE)"


def dbl(expression: str) -> str:
    """A decimal as the nearest double; the plain cast of a wide one can miss it."""
    return f"CAST(CAST({expression} AS VARCHAR) AS DOUBLE)"


def _with(**parts: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items()) + "\n"


# --- cleaning ---------------------------------------------------------------------------

ORDER_COLUMNS = (
    "order_id customer_id product_id order_date ship_date quantity unit_price discount_pct "
    "total_amount payment_method order_status"
).split()
PRODUCT_COLUMNS = (
    "product_id product_name category brand price cost stock_quantity weight_kg created_date "
    "is_active"
).split()
CUSTOMER_COLUMNS = (
    "customer_id first_name last_name email phone signup_date country state postal_code "
    "is_active loyalty_points"
).split()
CUSTOMER_TEXTS = "first_name last_name email phone country state postal_code".split()


def _token(column: str, tokens: str) -> str:
    return f"CASE WHEN lower(trim({column})) IN ({tokens}) THEN NULL ELSE trim({column}) END"


def _trimmed(source: str, columns, texts, tokens: str) -> str:
    shown = [f"{_token(c, tokens)} AS {c}" if c in texts else c for c in columns]
    return f"SELECT {', '.join(shown)} FROM {source}"


def _smallest(source: str, key: str, columns) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in columns)
    return (
        f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {key} ORDER BY {order}) AS place FROM {source}) WHERE place = 1"
    )


def _keyed(key: str, pattern: str, tokens: str) -> str:
    """Landing rows whose trimmed key is usable, under that key."""
    return (
        f"SELECT * REPLACE (trim({key}) AS {key}) FROM landing "
        f"WHERE regexp_full_match(trim({key}), '{pattern}') AND lower(trim({key})) NOT IN ({tokens})"
    )


def _dates(column: str, us_style: bool) -> str:
    us = (
        rf"WHEN regexp_full_match({column}, '\d{{2}}-\d{{2}}-\d{{4}}') "
        f"THEN CAST(try_strptime({column}, '%m-%d-%Y') AS DATE) "
    )
    return (
        rf"CASE WHEN regexp_full_match({column}, '\d{{4}}-\d{{2}}-\d{{2}}') "
        f"THEN CAST(try_strptime({column}, '%Y-%m-%d') AS DATE) "
        rf"WHEN regexp_full_match({column}, '\d{{4}}/\d{{2}}/\d{{2}}') "
        f"THEN CAST(try_strptime({column}, '%Y/%m/%d') AS DATE) {us if us_style else ''}END"
    )


def _number(column: str, comma: bool = False) -> str:
    text = f"replace({column}, ',', '.')" if comma else column
    return f"TRY_CAST(regexp_replace({text}, '[^0-9.-]', '', 'g') AS DECIMAL(38,10))"


def _integer(column: str) -> str:
    return f"TRY_CAST(regexp_replace({column}, '[^0-9-]', '', 'g') AS INTEGER)"


def _if(value: str, test: str) -> str:
    return f"CASE WHEN {value} {test} THEN {value} END"


def _title(column: str) -> str:
    return f"upper(substr({column}, 1, 1)) || lower(substr({column}, 2))"


ORDER_TOKENS = "'', 'null', 'n/a', 'na', 'none'"
PRODUCT_TOKENS = ORDER_TOKENS + ", '?'"

CLEAN_ORDERS = rf"""
SELECT order_id,
  CASE WHEN regexp_full_match(customer_id, '\d+') THEN customer_id END AS customer_id,
  CASE WHEN regexp_full_match(product_id, 'P\d+') THEN product_id END AS product_id,
  {_dates('order_date', True)} AS order_date,
  {_dates('ship_date', True)} AS ship_date,
  {_if(_integer('quantity'), '> 0')} AS quantity,
  {_if(_number('unit_price'), '>= 0')} AS unit_price,
  CASE WHEN {_number('discount_pct')} BETWEEN 0 AND 100 THEN {_number('discount_pct')} ELSE 0 END
    AS discount_pct,
  {_if(_number('total_amount'), '>= 0')} AS total_amount,
  {_title('payment_method')} AS payment_method,
  {_title('order_status')} AS order_status
FROM trimmed
"""

ORDERS_CTES = {
    "landing": over_tables(inputs.LANDING_ORDERS),
    "keyed": _keyed("order_id", r"\d+", ORDER_TOKENS),
    "survivors": _smallest("keyed", "order_id", ORDER_COLUMNS),
    "trimmed": _trimmed("survivors", ORDER_COLUMNS, ORDER_COLUMNS, ORDER_TOKENS),
    "cleaned": CLEAN_ORDERS,
    "curated": "SELECT * FROM cleaned WHERE "
    + " AND ".join(
        f"{c} IS NOT NULL"
        for c in "customer_id product_id order_date quantity unit_price total_amount".split()
    ),
}

SHOWN_ORDERS = f"""
SELECT order_id, customer_id, product_id, CAST(order_date AS VARCHAR) AS order_date,
  CAST(ship_date AS VARCHAR) AS ship_date, quantity, {dbl('unit_price')} AS unit_price,
  {dbl('discount_pct')} AS discount_pct, {dbl('total_amount')} AS total_amount,
  payment_method, order_status
FROM {{source}}
"""

CLEAN_PRODUCTS = rf"""
SELECT product_id, product_name,
  {_title('category')} AS category,
  {_title('brand')} AS brand,
  {_if(_number('price', True), '>= 0')} AS price,
  {_if(_number('cost', True), '>= 0')} AS cost,
  {_if(_integer('stock_quantity'), '>= 0')} AS stock_quantity,
  {_if(_number('weight_kg', True), '> 0')} AS weight_kg,
  {_dates('created_date', False)} AS created_date,
  CASE WHEN lower(is_active) IN ('true', '1', 'yes', 'y') THEN TRUE
       WHEN lower(is_active) IN ('false', '0', 'no', 'n') THEN FALSE END AS is_active
FROM trimmed
"""

PRODUCTS_CTES = {
    "landing": over_tables(inputs.LANDING_PRODUCTS),
    "keyed": _keyed("product_id", r"P\d+", PRODUCT_TOKENS),
    "survivors": _smallest("keyed", "product_id", PRODUCT_COLUMNS),
    "trimmed": _trimmed("survivors", PRODUCT_COLUMNS, PRODUCT_COLUMNS, PRODUCT_TOKENS),
    "cleaned": CLEAN_PRODUCTS,
    "curated": "SELECT * FROM cleaned WHERE "
    + " AND ".join(
        f"{c} IS NOT NULL" for c in "product_name category brand price cost created_date".split()
    ),
}

SHOWN_PRODUCTS = f"""
SELECT product_id, product_name, category, brand, {dbl('price')} AS price,
  {dbl('cost')} AS cost, stock_quantity, CAST(weight_kg AS DOUBLE) AS weight_kg,
  CAST(created_date AS VARCHAR) AS created_date, is_active
FROM curated
"""

CUSTOMERS_CTES = {
    "landing": over_tables(inputs.LANDING_CUSTOMERS),
    "survivors": _smallest("landing", "customer_id", CUSTOMER_COLUMNS),
    "trimmed": _trimmed("survivors", CUSTOMER_COLUMNS, CUSTOMER_TEXTS, "''"),
    "cleaned": r"""
SELECT customer_id, first_name, last_name,
  CASE WHEN regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$')
       THEN lower(email) END AS email,
  CASE WHEN length(regexp_replace(phone, '\D', '', 'g')) BETWEEN 10 AND 15
       THEN regexp_replace(phone, '\D', '', 'g') END AS phone,
  signup_date, country, state, postal_code, is_active,
  CASE WHEN loyalty_points < 0 THEN 0 ELSE loyalty_points END AS loyalty_points
FROM trimmed""",
    "curated": "SELECT * FROM cleaned WHERE customer_id IS NOT NULL AND first_name IS NOT NULL "
    "AND last_name IS NOT NULL AND email IS NOT NULL AND signup_date IS NOT NULL",
}

SHOWN_CUSTOMERS = """
SELECT customer_id, first_name, last_name, email, phone, CAST(signup_date AS VARCHAR) AS signup_date,
  country, state, postal_code, is_active, loyalty_points
FROM {source}
"""

# --- retail -----------------------------------------------------------------------------

RETAIL_CTES = {
    "retail_orders": over_tables(inputs.RETAIL_ORDERS),
    "retail_customers": over_tables(inputs.RETAIL_CUSTOMERS),
    "retail_products": over_tables(inputs.RETAIL_PRODUCTS),
}


def _sales_ctes(orders: str, customers: str, products: str) -> dict[str, str]:
    return {
        "priced": f"""
SELECT o.*, first_name, last_name, email, country, state, product_name, category, brand,
  round(quantity * unit_price, 2) AS gross_amount
FROM {orders} AS o
JOIN {customers} AS c ON o.customer_id = CAST(c.customer_id AS VARCHAR)
JOIN {products} AS p ON o.product_id = p.product_id""",
        "reduced": """
SELECT *, round(CAST(gross_amount AS DECIMAL(30,2)) * CAST(discount_pct AS DECIMAL(7,4))
    * CAST(0.01 AS DECIMAL(2,2)), 2) AS discount_amount FROM priced""",
        "sales": "SELECT *, gross_amount - discount_amount AS net_amount FROM reduced",
        "monthly": f"""
SELECT strftime(order_date, '%Y-%m') AS order_month, category,
  COUNT(DISTINCT order_id) AS total_orders,
  CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
  {dbl('SUM(gross_amount)')} AS gross_revenue,
  {dbl('SUM(discount_amount)')} AS total_discount,
  {dbl('SUM(net_amount)')} AS net_revenue,
  {round2(dbl('SUM(net_amount)') + ' / COUNT(net_amount)')} AS avg_order_value
FROM sales GROUP BY order_month, category""",
    }


SALES_CTES = RETAIL_CTES | _sales_ctes("retail_orders", "retail_customers", "retail_products")

SHOWN_SALES = f"""
SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, CAST(ship_date AS VARCHAR) AS ship_date,
  customer_id, first_name, last_name, email, country, state, product_id, product_name, category,
  brand, quantity, {dbl('unit_price')} AS unit_price,
  {dbl('discount_pct')} AS discount_pct, {dbl('total_amount')} AS total_amount,
  payment_method, order_status, {dbl('gross_amount')} AS gross_amount,
  {dbl('discount_amount')} AS discount_amount, {dbl('net_amount')} AS net_amount
FROM sales
"""

FK_VALID = """
SELECT * FROM retail_orders
WHERE customer_id IN (SELECT CAST(customer_id AS VARCHAR) FROM retail_customers WHERE balance > 0)
  AND product_id IN (SELECT product_id FROM retail_products WHERE size > 10)
"""

TOP_PRODUCTS = f"""
SELECT product_id, product_name, {dbl('SUM(net_amount)')} AS net_revenue
FROM sales GROUP BY product_id, product_name
ORDER BY net_revenue DESC, product_id, product_name LIMIT {TOP_N}
"""

CUSTOMER_LTV = f"""
SELECT customer_id, first_name, last_name, {dbl('SUM(net_amount)')} AS lifetime_value,
  COUNT(DISTINCT order_id) AS total_orders
FROM sales GROUP BY customer_id, first_name, last_name
ORDER BY lifetime_value DESC, customer_id, first_name, last_name LIMIT {TOP_N}
"""

DISCOUNT_BY_PAYMENT = f"""
SELECT payment_method,
  {round2(dbl('SUM(discount_pct)') + ' / COUNT(discount_pct)')} AS avg_discount_pct,
  {dbl('SUM(net_amount)')} AS net_revenue
FROM sales GROUP BY payment_method
"""

RETURN_RATES = f"""
SELECT category, COUNT(*) AS total_rows,
  COUNT(*) FILTER (WHERE order_status = 'Returned') AS returned_rows,
  COUNT(*) FILTER (WHERE order_status = 'Cancelled') AS cancelled_rows,
  {round2("CAST(100 AS DOUBLE) * COUNT(*) FILTER (WHERE order_status = 'Returned') / COUNT(*)")}
    AS return_rate_pct,
  {round2("CAST(100 AS DOUBLE) * COUNT(*) FILTER (WHERE order_status = 'Cancelled') / COUNT(*)")}
    AS cancellation_rate_pct
FROM sales GROUP BY category
"""


def _counts(named: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS record_count FROM {source}"
        for name, source in named.items()
    )


def _curated_job() -> dict[str, str]:
    """The three cleaning chains side by side, then keys, sales and summary; and what is shown of it."""
    ctes = {}
    for prefix, chain in (("o", ORDERS_CTES), ("p", PRODUCTS_CTES), ("c", CUSTOMERS_CTES)):
        for name, sql in chain.items():
            for other in chain:
                sql = sql.replace(f"FROM {other}", f"FROM {prefix}_{other}")
            ctes[f"{prefix}_{name}"] = sql
    ctes["valid_orders"] = """
SELECT * FROM o_curated
WHERE customer_id IN (SELECT CAST(customer_id AS VARCHAR) FROM c_curated)
  AND product_id IN (SELECT product_id FROM p_curated)"""
    ctes |= _sales_ctes("valid_orders", "c_curated", "p_curated")
    counted = {
        "orders source": "o_landing",
        "products source": "p_landing",
        "customers source": "c_landing",
        "customers curated": "c_curated",
        "products curated": "p_curated",
        "orders curated": "valid_orders",
        "sales_enriched curated": "sales",
        "monthly_sales_summary curated": "monthly",
    }
    shown = {
        "curate_retail": _counts(counted),
        "curated_sales": SHOWN_SALES,
        "curated_monthly": "SELECT * FROM monthly",
    }
    return {key: _with(**ctes) + sql for key, sql in shown.items()}


# --- what cleaning rejects --------------------------------------------------------------

EMAIL = r"'^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$'"
# Per landing table: its chain, key, whether a landing row's key is usable, and for each required
# column how it reads (null: not at all) and what must hold then.
JUDGED = {
    "orders": (
        ORDERS_CTES,
        "order_id",
        rf"regexp_full_match(trim(order_id), '\d+') AND lower(trim(order_id)) NOT IN ({ORDER_TOKENS})",
        (ORDER_COLUMNS, ORDER_COLUMNS, ORDER_TOKENS),
        {
            "order_id": (r"CASE WHEN regexp_full_match(order_id, '\d+') THEN 1 END", None),
            "customer_id": (r"CASE WHEN regexp_full_match(customer_id, '\d+') THEN 1 END", None),
            "product_id": (r"CASE WHEN regexp_full_match(product_id, 'P\d+') THEN 1 END", None),
            "order_date": (_dates("order_date", True), None),
            "quantity": (_integer("quantity"), "> 0"),
            "unit_price": (_number("unit_price"), ">= 0"),
            "total_amount": (_number("total_amount"), ">= 0"),
        },
    ),
    "products": (
        PRODUCTS_CTES,
        "product_id",
        rf"regexp_full_match(trim(product_id), 'P\d+') AND lower(trim(product_id)) NOT IN ({PRODUCT_TOKENS})",
        (PRODUCT_COLUMNS, PRODUCT_COLUMNS, PRODUCT_TOKENS),
        {
            "product_id": (r"CASE WHEN regexp_full_match(product_id, 'P\d+') THEN 1 END", None),
            "product_name": ("product_name", None),
            "category": ("category", None),
            "brand": ("brand", None),
            "price": (_number("price", True), ">= 0"),
            "cost": (_number("cost", True), ">= 0"),
            "created_date": (_dates("created_date", False), None),
        },
    ),
    "customers": (
        CUSTOMERS_CTES,
        "customer_id",
        "customer_id IS NOT NULL",
        (CUSTOMER_COLUMNS, CUSTOMER_TEXTS, "''"),
        {
            "customer_id": ("customer_id", None),
            "first_name": ("first_name", None),
            "last_name": ("last_name", None),
            "email": (f"CASE WHEN regexp_matches(email, {EMAIL}) THEN 1 END", None),
            "signup_date": ("signup_date", None),
        },
    ),
}


def _tally(name: str) -> str:
    ctes, _, usable, _, _ = JUDGED[name]
    counts = {
        "landed": "SELECT COUNT(*) FROM landing",
        "usable": f"SELECT COUNT(*) FROM landing WHERE {usable}",
        "surviving": f"SELECT COUNT(*) FROM survivors WHERE {usable}",
        "kept": "SELECT COUNT(*) FROM curated",
    }
    shown = ", ".join(f"({sql}) AS {count}" for count, sql in counts.items())
    return (
        f"SELECT '{name}' AS table_name, landed, kept, usable - surviving AS duplicates, "
        f"landed - usable + surviving - kept AS rejected FROM ({_with(**ctes)} SELECT {shown})"
    )


def _rules(name: str) -> str:
    ctes, _, usable, (columns, texts, tokens), required = JUDGED[name]
    listed = ", ".join(columns)
    each = f"SELECT {listed} FROM survivors WHERE {usable} UNION ALL SELECT {listed} FROM landing WHERE ({usable}) IS NOT TRUE"
    reasons = []
    for column, (read, test) in required.items():
        outside = f"WHEN NOT ({read} {test}) THEN '{column}: out of range' " if test else ""
        reasons.append(
            f"SELECT CASE WHEN {column} IS NULL THEN '{column}: missing' WHEN {read} IS NULL THEN "
            f"'{column}: unreadable' {outside}END AS rule FROM judged_tidy"
        )
    parts = _with(**ctes, judged_rows=each, judged_tidy=_trimmed("judged_rows", columns, texts, tokens))
    found = f"{parts} {' UNION ALL '.join(reasons)}"
    return f"SELECT '{name}' AS table_name, rule, COUNT(*) AS rows FROM ({found}) WHERE rule IS NOT NULL GROUP BY rule"


def _traced_counts() -> str:
    tallies = " UNION ALL ".join(
        f"SELECT table_name || ' {shown}' AS table_name, {column} AS record_count FROM ({_tally(name)})"
        for name in JUDGED
        for shown, column in (("source", "landed"), ("duplicates", "duplicates"), ("rejected", "rejected"))
    )
    return f"{tallies} UNION ALL SELECT * FROM ({_curated_job()['curate_retail']}) WHERE table_name LIKE '% curated'"


# --- similarity -------------------------------------------------------------------------

PAIRS = """
SELECT a.supplier AS item1, b.supplier AS item2, COUNT(*) AS num_pairs,
  SUM(a.rating * a.rating) AS sum_xx, SUM(b.rating * b.rating) AS sum_yy,
  SUM(a.rating * b.rating) AS sum_xy
FROM rated AS a JOIN rated AS b ON a.customer = b.customer AND a.supplier < b.supplier
GROUP BY item1, item2
"""
SCORED = """
SELECT item1, item2, num_pairs, CASE WHEN sqrt(sum_xx) * sqrt(sum_yy) = 0 THEN 0
  ELSE sum_xy / (sqrt(sum_xx) * sqrt(sum_yy)) END AS score FROM pairs
"""
PAIR_CTES = {"rated": over_tables(inputs.RATINGS), "pairs": PAIRS, "scored": SCORED}
ONCE_RATED = f"""
SELECT customer, supplier, MIN(rating) AS rating FROM ({over_tables(inputs.RATINGS)})
GROUP BY customer, supplier
"""
SIMILAR = f"""
SELECT similar_item, title, score, num_pairs
FROM (SELECT CASE WHEN item1 = {SIMILAR_TO} THEN item2 ELSE item1 END AS similar_item, score,
        num_pairs FROM scored
      WHERE {SIMILAR_TO} IN (item1, item2) AND score > {MIN_SCORE} AND num_pairs > {MIN_PAIRS})
LEFT JOIN titles ON item = similar_item
ORDER BY score DESC, similar_item LIMIT {TOP_N}
"""
SIMILAR_SQL = _with(**PAIR_CTES, titles=over_tables(inputs.TITLES)) + SIMILAR

# --- graph ------------------------------------------------------------------------------

GRAPH_CTES = {
    "lines": over_tables(inputs.GRAPH_LINES),
    "parts": r"SELECT regexp_split_to_array(trim(value), '\s+') AS part FROM lines",
    "degree": r"""
SELECT CAST(part[1] AS INTEGER) AS id, CAST(SUM(len(part) - 1) AS BIGINT) AS connections
FROM parts WHERE regexp_full_match(part[1], '\d+') GROUP BY part[1]""",
}

# --- the rest ---------------------------------------------------------------------------

PEOPLE = _with(people=over_tables(inputs.PEOPLE))
CUSTOMER_ORDERS = _with(sold=over_tables(inputs.CUSTOMER_ORDERS))


# The characters at which a plain text split parts words.
BLANKS = r"[\x09-\x0D\x1C-\x20\x{85}\p{Z}]+"


def _words(source: str, column: str, separator: str) -> str:
    return (
        f"SELECT word FROM (SELECT unnest(regexp_split_to_array({column}, '{separator}')) AS word "
        f"FROM {source}) WHERE word <> ''"
    )


def all_oracles() -> dict[str, str]:
    orders, products = _with(**ORDERS_CTES), _with(**PRODUCTS_CTES)
    customers, sales = _with(**CUSTOMERS_CTES), _with(**SALES_CTES)
    line_columns = (
        "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
        "l_returnflag l_linestatus l_shipdate"
    ).split()
    details = "'Name: ' || name || ', Age: ' || CAST(age AS VARCHAR) AS details"
    # An empty CSV cell reads back as null.
    landing_orders = (
        "SELECT * REPLACE (nullif(ship_date, '') AS ship_date) "
        f"FROM ({over_tables(inputs.LANDING_ORDERS)})"
    )
    landing_customers = (
        "SELECT * REPLACE (nullif(email, '') AS email) "
        f"FROM ({over_tables(inputs.LANDING_CUSTOMERS)})"
    )
    broken = over_tables(inputs.BROKEN_CUSTOMERS)
    fitting = {
        "customer_id": "TRY_CAST(customer_id AS INTEGER)",
        "signup_date": "CAST(TRY_CAST(signup_date AS DATE) AS VARCHAR)",
        "is_active": "TRY_CAST(is_active AS BOOLEAN)",
        "loyalty_points": "TRY_CAST(loyalty_points AS INTEGER)",
    }
    misfit = {
        name: f"CASE WHEN {name} IS NOT NULL AND {value} IS NULL THEN '{name}: ' || {name} END" for name, value in fitting.items()
    }
    replaced = ", ".join(f"{value} AS {name}" for name, value in fitting.items())
    return {
        "src_csv_checked": f"SELECT * REPLACE ({replaced}, nullif(email, '') AS email), "
        f"concat_ws(', ', {', '.join(misfit.values())}) AS misfits FROM ({broken})",
        "src_csv_misfits": " UNION ALL ".join(
            f"SELECT '{name}' AS column, COUNT(cell) AS cells FROM (SELECT {value} AS cell FROM ({broken})) HAVING COUNT(cell) > 0"
            for name, value in misfit.items()
        ),
        "clean_orders": orders + SHOWN_ORDERS.format(source="curated"),
        "clean_products": products + SHOWN_PRODUCTS,
        "clean_customers": customers + SHOWN_CUSTOMERS.format(source="curated"),
        "clean_null_tokens": _with(landing=over_tables(inputs.LANDING_ORDERS))
        + _trimmed("landing", ORDER_COLUMNS, ORDER_COLUMNS, ORDER_TOKENS),
        "landing_tally": " UNION ALL ".join(_tally(name) for name in JUDGED),
        "rejected_rules": " UNION ALL ".join(_rules(name) for name in JUDGED),
        "curate_retail_traced": _traced_counts(),
        "dedup_by_key": "SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM ("
        + _smallest("lineitem", "l_orderkey", line_columns)
        + ")",
        "distinct_keys": "SELECT l_partkey, l_suppkey FROM lineitem GROUP BY 1, 2",
        "fk_valid_orders": _with(**RETAIL_CTES, valid=FK_VALID) + SHOWN_ORDERS.format(source="valid"),
        "sales_enriched": sales + SHOWN_SALES,
        "stored_sales_enriched": sales + SHOWN_SALES,
        "stored_fk_valid_orders": _with(**RETAIL_CTES, valid=FK_VALID) + SHOWN_ORDERS.format(source="valid"),
        "monthly_sales_summary": sales + "SELECT * FROM monthly",
        "revenue_by_category_month": sales
        + "SELECT order_month, category, net_revenue, total_units_sold FROM monthly",
        "top_products": sales + TOP_PRODUCTS,
        "customer_ltv": sales + CUSTOMER_LTV,
        "discount_by_payment": sales + DISCOUNT_BY_PAYMENT,
        "return_rates": sales + RETURN_RATES,
        "row_count_validation": sales
        + _counts(
            {
                "ORDERS_CURATED": "retail_orders",
                "PRODUCTS_CURATED": "retail_products",
                "CUSTOMERS_CURATED": "retail_customers",
                "SALES_ENRICHED": "sales",
                "MONTHLY_SALES_SUMMARY": "monthly",
            }
        ),
        "register_curated": sales
        + _counts(
            {
                "orders_curated": "retail_orders",
                "products_curated": "retail_products",
                "customers_curated": "retail_customers",
                "sales_enriched": "sales",
                "monthly_sales_summary": "monthly",
            }
        ),
        "registered_exports": sales
        + _counts(
            {
                "orders_curated": "retail_orders",
                "products_curated": "retail_products",
                "customers_curated": "retail_customers",
                "sales_enriched": "sales",
                "monthly_sales_summary": "monthly",
            }
        ),
        **_curated_job(),
        "pair_stats": _with(**PAIR_CTES) + "SELECT * FROM pairs",
        "item_similarity": _with(**PAIR_CTES) + "SELECT * FROM scored",
        "item_similarity_dedup": _with(**(PAIR_CTES | {"rated": ONCE_RATED}))
        + "SELECT * FROM scored",
        "strong_similarities": _with(**PAIR_CTES)
        + f"SELECT * FROM scored WHERE score > {MIN_SCORE} AND num_pairs > {MIN_PAIRS}",
        "similar_items_topk": SIMILAR_SQL,
        "similar_items_lookup": SIMILAR_SQL,
        "item_title": f"SELECT coalesce(min(s_name), '{SIMILAR_TO}') AS title FROM supplier "
        f"WHERE s_suppkey = {SIMILAR_TO}",
        "graph_degree": _with(**GRAPH_CTES) + "SELECT * FROM degree",
        "min_degree_ties": _with(**GRAPH_CTES, names=over_tables(inputs.GRAPH_NAMES))
        + "SELECT id, name, connections FROM degree JOIN names USING (id) "
        "WHERE connections = (SELECT MIN(connections) FROM degree)",
        "word_count": "SELECT lower(word) AS word, COUNT(*) AS count FROM "
        f"({_words('documents', 'text', chr(92) + 'W+')}) GROUP BY lower(word)",
        "word_lengths": "SELECT word, CAST(length(word) AS INTEGER) AS length FROM "
        f"({_words('(' + over_tables(inputs.SPACED_LINES) + ')', 'value', BLANKS)})",
        "error_words": _with(lines=over_tables(inputs.LOG_LINES))
        + "SELECT upper(word) AS word FROM "
        f"({_words('(SELECT * FROM lines WHERE value LIKE ' + repr('ERROR%') + ')', 'value', BLANKS)})",
        "people_select": PEOPLE + "SELECT name, age FROM people",
        "people_filter": PEOPLE + "SELECT * FROM people WHERE age > 25",
        "adults_sql": PEOPLE + "SELECT * FROM people WHERE age >= 18",
        "count_by_age": PEOPLE + "SELECT age, COUNT(*) AS count FROM people GROUP BY age",
        "avg_friends_by_age": PEOPLE
        + f"SELECT age, {round2('CAST(SUM(friends) AS DOUBLE) / COUNT(friends)')} AS avg_friends "
        "FROM people GROUP BY age",
        "user_details": PEOPLE + f"SELECT id, {details} FROM people",
        "user_details_udf": PEOPLE + f"SELECT id, {details} FROM people",
        "customer_totals_sql": CUSTOMER_ORDERS
        + "SELECT customer_id, CAST(SUM(order_price) AS DOUBLE) AS total FROM sold GROUP BY 1",
        "customer_totals_df": CUSTOMER_ORDERS
        + "SELECT customer_id, CAST(SUM(order_price) AS DOUBLE) AS total FROM sold GROUP BY 1",
        "min_temp_by_station": "SELECT user_id, MIN(value) AS min_value FROM events "
        "WHERE event_type = 'view' GROUP BY user_id",
        "num_square_prefix": "SELECT p_partkey, p_partkey * p_partkey AS squared, "
        "'num_' || CAST(p_partkey AS VARCHAR) AS label FROM part",
        "num_filter_even": "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity % 2 = 0",
        "num_filter_above": "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 5",
        "num_filter": "SELECT l_orderkey, l_quantity FROM lineitem "
        "WHERE l_quantity % 2 = 0 AND l_quantity > 5",
        "num_reduce": "SELECT CAST(SUM(l_partkey) AS BIGINT) AS total, MAX(l_partkey) AS maximum, "
        "MIN(l_partkey) AS minimum, CAST(COALESCE(SUM(l_partkey), 0) AS BIGINT) AS folded "
        "FROM lineitem",
        "num_top": "SELECT p_partkey, p_size, p_name FROM part "
        f"ORDER BY p_size DESC, p_partkey LIMIT {TOP_N}",
        "num_take_ordered": "SELECT p_partkey, p_size, p_name FROM part "
        f"ORDER BY p_size, p_partkey LIMIT {TOP_N}",
        "num_first": "SELECT * FROM customer ORDER BY c_name, c_custkey LIMIT 1",
        "count_by_value": "SELECT event_type AS value, COUNT(*) AS count FROM events GROUP BY 1",
        "src_csv_strings": landing_orders,
        "src_csv_typed": _with(landing=landing_customers)
        + SHOWN_CUSTOMERS.format(source="landing"),
        "src_csv_infer": PEOPLE + "SELECT CAST(id AS INTEGER) AS id, name, age, friends FROM people",
        "src_csv_headerless": CUSTOMER_ORDERS
        + "SELECT customer_id, order_id, CAST(order_price AS DOUBLE) AS order_price FROM sold",
        "src_csv_weather": f"SELECT * REPLACE (CAST(CAST(temperature AS FLOAT) AS DOUBLE) AS temperature) "
        f"FROM ({over_tables(inputs.READINGS)})",
        "src_csv_amounts": f"SELECT * REPLACE (CAST(CAST(amount AS FLOAT) AS DOUBLE) AS amount) "
        f"FROM ({over_tables(inputs.AMOUNTS)})",
        "src_csv_quoted": "SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS name FROM part",
        "src_text_delimited": "SELECT CAST(p_partkey AS INTEGER) AS item, p_name AS title FROM part",
        "src_text_ratings": _with(rated=over_tables(inputs.RATINGS))
        + "SELECT CAST(customer AS INTEGER) AS user_id, CAST(supplier AS INTEGER) AS item_id, "
        "rating, CAST(881250949 AS BIGINT) AS timestamp FROM rated",
        "src_text_people": PEOPLE + "SELECT CAST(id AS INTEGER) AS id, name, age, friends FROM people",
        "sink_parquet_readback": "SELECT * FROM part",
        "sink_table_rows": "SELECT * FROM part",
        "table_versions": "SELECT CAST(1 AS INTEGER) AS version, CAST(p_partkey AS VARCHAR) AS key, p_brand, p_size AS size "
        "FROM part UNION ALL SELECT CAST(2 AS INTEGER), CAST(p_partkey AS VARCHAR), p_brand, p_size FROM part WHERE p_size > 10",
        "sink_table_readback": f"SELECT * FROM part ORDER BY p_partkey LIMIT {TOP_N}",
    }
