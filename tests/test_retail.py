"""The retail job on small dirty tables, and its invariants on the given tables."""

import datetime
from decimal import Decimal

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from ledgerloom import plans, sinks
from ledgerloom.operators import dedup_by_key, fk_valid, row_counts
from ledgerloom.sources import register_curated, schemas
from workload import queries

ORDER = {
    "order_id": "1",
    "customer_id": "7",
    "product_id": "P1",
    "order_date": "2024-01-05",
    "ship_date": "2024/01/06",
    "quantity": "2",
    "unit_price": "$1,000.50",
    "discount_pct": "10",
    "total_amount": "1800.90",
    "payment_method": "CREDIT card",
    "order_status": "returned",
}
PRODUCT = {
    "product_id": "P1",
    "product_name": "Bolt",
    "category": "TOOLS",
    "brand": "acme",
    "price": "12,50",
    "cost": "8.25",
    "stock_quantity": "5 pcs",
    "weight_kg": "0,125",
    "created_date": "2023/12/31",
    "is_active": "Y",
}
CUSTOMER = {
    "customer_id": 7,
    "first_name": " Ann ",
    "last_name": "Lee",
    "email": "Ann@Lee.org",
    "phone": "(555) 123-4567",
    "signup_date": datetime.date(2020, 2, 2),
    "country": "",
    "state": "X",
    "postal_code": "1",
    "is_active": True,
    "loyalty_points": -5,
}


def landing(spark, schema, base, *changes):
    return spark.createDataFrame([tuple((base | change).values()) for change in changes], schema)


def orders(spark, *changes):
    return landing(spark, schemas.ORDERS_LANDING, ORDER, *changes)


def products(spark, *changes):
    return landing(spark, schemas.PRODUCTS_LANDING, PRODUCT, *changes)


def customers(spark, *changes):
    return landing(spark, schemas.CUSTOMERS_LANDING, CUSTOMER, *changes)


def test_clean_order_values(spark):
    row = plans.clean_orders(orders(spark, {})).first()
    assert row.asDict() == {
        "order_id": "1",
        "customer_id": "7",
        "product_id": "P1",
        "order_date": datetime.date(2024, 1, 5),
        "ship_date": datetime.date(2024, 1, 6),
        "quantity": 2,
        "unit_price": Decimal("1000.5"),
        "discount_pct": Decimal(10),
        "total_amount": Decimal("1800.9"),
        "payment_method": "Credit Card",
        "order_status": "Returned",
    }


@pytest.mark.parametrize(
    "column",
    ["order_id", "customer_id", "product_id", "order_date", "quantity", "unit_price", "total_amount"],
)
def test_order_without_required_value_is_dropped(spark, column):
    assert plans.clean_orders(orders(spark, {column: " n/a "})).count() == 0


def test_order_optional_values(spark):
    missing = {"ship_date": "x", "discount_pct": None, "payment_method": "none", "order_status": ""}
    row = plans.clean_orders(orders(spark, missing)).first()
    assert (row.ship_date, row.discount_pct, row.payment_method, row.order_status) == (
        None,
        0,
        None,
        None,
    )


def test_dedup_takes_the_trimmed_key(spark):
    padded = orders(spark, {}, {"order_id": " 1"})
    assert plans.clean_orders(padded).count() == 1
    assert plans.clean_orders(padded, trim_key_first=False).count() == 2


def test_dedup_comes_before_validation(spark):
    """The smaller row survives even when it is the invalid one, in any order of arrival."""
    bad, good = {"customer_id": "-1"}, {"customer_id": "7"}
    assert plans.clean_orders(orders(spark, bad, good)).count() == 0
    assert plans.clean_orders(orders(spark, good, bad)).count() == 0


def test_float_amounts_keep_the_original_types(spark):
    cleaned = plans.clean_orders(orders(spark, {}), amount_type="float")
    types = dict(cleaned.dtypes)
    assert (types["unit_price"], types["discount_pct"], types["total_amount"]) == (
        "float",
        "double",
        "float",
    )
    sales = plans.sales_enriched(
        cleaned,
        plans.clean_customers(customers(spark, {})),
        plans.clean_products(products(spark, {}), amount_type="float"),
    )
    types = dict(sales.dtypes)
    assert (types["gross_amount"], types["discount_amount"], types["net_amount"]) == (
        "float",
        "double",
        "double",
    )
    row = sales.first()
    assert (row.gross_amount, row.discount_amount, row.net_amount) == (2001.0, 200.1, 1800.9)


def test_clean_product_values(spark):
    row = plans.clean_products(products(spark, {})).first()
    assert (row.category, row.brand, row.price, row.cost) == (
        "Tools",
        "Acme",
        Decimal("12.5"),
        Decimal("8.25"),
    )
    assert (row.stock_quantity, row.weight_kg, row.created_date, row.is_active) == (
        5,
        0.125,
        datetime.date(2023, 12, 31),
        True,
    )


@pytest.mark.parametrize(
    "change",
    [
        {"price": "1,299.50"},
        {"created_date": "12-31-2023"},
        {"cost": "-1"},
        {"product_name": "?"},
        {"product_id": "p1"},
    ],
)
def test_product_without_required_value_is_dropped(spark, change):
    assert plans.clean_products(products(spark, change)).count() == 0


def test_product_optional_values(spark):
    change = {"stock_quantity": "-3", "weight_kg": "0", "is_active": "maybe"}
    row = plans.clean_products(products(spark, change)).first()
    assert (row.stock_quantity, row.weight_kg, row.is_active) == (None, None, None)


def test_clean_customer_values(spark):
    row = plans.clean_customers(customers(spark, {})).first()
    assert (row.first_name, row.email, row.phone, row.country, row.loyalty_points) == (
        "Ann",
        "ann@lee.org",
        "5551234567",
        None,
        0,
    )
    none = {"phone": "1", "loyalty_points": None}
    row = plans.clean_customers(customers(spark, none)).first()
    assert (row.phone, row.loyalty_points) == (None, None)
    assert plans.clean_customers(customers(spark, {"email": "a@b"})).count() == 0


def test_dedup_is_the_same_for_every_arrangement(spark):
    df = spark.range(2000).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 0 ELSE id % 50 END").alias("key"),
        F.expr("CASE WHEN id % 7 = 0 THEN NULL ELSE id * 7919 % 1000 END").alias("a"),
        F.col("id").alias("b"),
    )
    expected = rows(dedup_by_key(df.coalesce(1), ["key"]))
    assert rows(dedup_by_key(df.repartition(13), ["key"])) == expected
    best = {}
    for row in df.collect():
        value = (row.key, row.a if row.a is not None else float("-inf"), row.b)
        best[row.key] = min(best.get(row.key, value), value)
    assert {r[0]: r[2] for r in expected} == {k: v[2] for k, v in best.items()}


def test_dedup_keeps_one_row_for_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 1)], "k int, v int")
    assert rows(dedup_by_key(df, ["k"])) == [(3, 1), (None, 1)]


def test_fk_valid_never_multiplies_and_compares_text(spark):
    fact = spark.createDataFrame([("7",), ("007",), ("8",), (None,)], "customer_id string")
    dimension = spark.createDataFrame([(7,), (7,), (None,)], "customer_id int")
    assert rows(fk_valid(fact, {"customer_id": dimension})) == [("7",)]


def test_whole_job(spark, folder):
    sources = {
        "orders": orders(
            spark,
            {},
            {"order_id": "2", "quantity": "1", "order_status": "CANCELLED", "discount_pct": "200"},
            {"order_id": "3", "customer_id": "99"},
            {"order_id": "4", "product_id": "P9"},
            {"order_id": "x"},
        ),
        "products": products(spark, {}, {"price": "13"}, {"product_id": "P2"}),
        "customers": customers(spark, {}, {"loyalty_points": 3}),
    }
    database = queries.database_name(folder)
    tables = plans.curate_retail(
        spark,
        **sources,
        database=database,
        location=f"{folder}/tables",
        export_folder=f"{folder}/exports",
    )
    counts = dict(rows(plans.source_and_curated_counts(sources, tables)))
    assert counts == {
        "orders source": 5,
        "products source": 3,
        "customers source": 2,
        "orders curated": 2,
        "products curated": 2,
        "customers curated": 1,
        "sales_enriched curated": 2,
        "monthly_sales_summary curated": 1,
    }
    valid = plans.fk_valid_orders(
        plans.clean_orders(sources["orders"]), tables["customers"], tables["products"]
    )
    assert tables["orders"].dtypes == valid.dtypes
    assert tables["orders"].columns[:2] == ["product_id", "customer_id"]
    assert rows(tables["orders"]) == rows(valid)
    for name, table in tables.items():
        assert rows(sinks.read_snapshot(spark, f"{folder}/exports/{name}")) == rows(table)
        stored = spark.table(f"{database}.{name}")
        assert rows(stored.select(*table.columns)) == rows(table)
    assert rows(spark.table(f"{database}.sales_enriched").select("sales_month").distinct()) == [("2024-01",)]

    money = ["gross_amount", "discount_amount", "net_amount"]
    assert rows(tables["sales_enriched"].select("order_id", *money)) == [
        ("1", Decimal("2001.00"), Decimal("200.10"), Decimal("1800.90")),
        ("2", Decimal("1000.50"), Decimal("0.00"), Decimal("1000.50")),
    ]
    assert rows(tables["monthly_sales_summary"]) == [
        ("2024-01", "Tools", 2, 3, 3001.5, 200.1, 2801.4, 1400.7)
    ]

    assert len(register_curated(spark, tables).collect()) == 5
    assert rows(plans.run_sql(spark, "top_products")) == [("P1", "Bolt", 2801.4)]
    assert rows(plans.run_sql(spark, "customer_ltv")) == [("7", "Ann", "Lee", 2801.4, 2)]
    assert rows(plans.run_sql(spark, "discount_by_payment")) == [("Credit Card", 5.0, 2801.4)]
    assert rows(plans.run_sql(spark, "return_rates")) == [("Tools", 2, 1, 1, 50.0, 50.0)]
    assert rows(plans.run_sql(spark, "revenue_by_category_month")) == [
        ("2024-01", "Tools", 2801.4, 3)
    ]
    assert dict(rows(plans.row_count_validation(spark))) == {
        "ORDERS_CURATED": 2,
        "PRODUCTS_CURATED": 2,
        "CUSTOMERS_CURATED": 1,
        "SALES_ENRICHED": 2,
        "MONTHLY_SALES_SUMMARY": 1,
    }


def test_rewriting_a_table_replaces_it(spark, folder):
    database = queries.database_name(folder)
    sinks.ensure_database(spark, database, f"{folder}/tables")
    sinks.ensure_database(spark, database)
    sinks.save_table(spark.range(5), f"{database}.numbers")
    again = sinks.save_table(spark.range(3).selectExpr("id AS other"), f"{database}.numbers")
    assert rows(again) == [(0,), (1,), (2,)]
    assert rows(sinks.read_back(spark, f"{database}.numbers", "other", 2)) == [(0,), (1,)]


def test_invariants_on_the_given_tables(spark):
    cleaned = queries.clean_orders(spark, SMALL)
    assert cleaned.count() == cleaned.select("order_id").distinct().count() > 0

    orders, customers, products = queries.retail_frames(spark, SMALL)
    sales = plans.sales_enriched(orders, customers, products)
    assert sales.count() == plans.fk_valid_orders(orders, customers, products).count()
    assert sales.where("net_amount <> gross_amount - discount_amount").count() == 0
    summary = plans.monthly_sales_summary(sales)
    assert summary.agg(F.sum("total_units_sold")).first()[0] == sales.agg(F.sum("quantity")).first()[0]

    counts = dict(rows(row_counts({"a": sales, "b": sales.limit(0)})))
    assert counts == {"a": sales.count(), "b": 0}


def test_rounding_is_half_up_and_exact(spark):
    """Discount of 10.05 at 10 % is 1.005, which rounds to 1.01 exactly."""
    one = orders(spark, {"quantity": "1", "unit_price": "10.05", "discount_pct": "10"})
    sales = plans.sales_enriched(
        plans.clean_orders(one),
        plans.clean_customers(customers(spark, {})),
        plans.clean_products(products(spark, {})),
    )
    assert sales.first().discount_amount == Decimal("1.01")


@pytest.mark.parametrize("amount", ["100000000000000", "100000000000000000000", "0.00004"])
def test_large_and_small_amounts_survive(spark, amount):
    cleaned = plans.clean_orders(orders(spark, {"unit_price": amount, "total_amount": amount, "quantity": "1"}))
    row = cleaned.first()
    assert (row.unit_price, row.total_amount) == (Decimal(amount), Decimal(amount))
    goods = plans.clean_products(products(spark, {"price": amount, "cost": amount}))
    assert (goods.first().price, goods.first().cost) == (Decimal(amount), Decimal(amount))
    sold = plans.sales_enriched(cleaned, plans.clean_customers(customers(spark, {})), goods).first()
    gross = Decimal(amount).quantize(Decimal("0.01"))
    assert (sold.gross_amount, sold.net_amount) == (gross, gross - sold.discount_amount)


def test_amount_that_cannot_be_held_raises(spark):
    too_long = orders(spark, {"unit_price": "1" * 30})
    with pytest.raises(Exception, match="amount does not fit"):
        plans.clean_orders(too_long).collect()
    assert plans.clean_orders(too_long, amount_type="double").first().unit_price == float("1" * 30)
    assert plans.clean_orders(orders(spark, {"unit_price": "1.2.3"})).count() == 0


def test_double_amounts_stay_double(spark):
    cleaned = plans.clean_orders(
        orders(spark, {"unit_price": "16777217.01", "quantity": "1", "discount_pct": "10"}), amount_type="double"
    )
    sales = plans.sales_enriched(
        cleaned,
        plans.clean_customers(customers(spark, {})),
        plans.clean_products(products(spark, {}), amount_type="double"),
    )
    assert (sales.first().gross_amount, sales.first().net_amount) == (16777217.01, 15099495.31)


def test_largest_amounts_do_not_overflow(spark):
    huge = {"quantity": "2147483647", "unit_price": "99999999999999.9999", "discount_pct": "99.9999"}
    sales = plans.sales_enriched(
        plans.clean_orders(orders(spark, huge)),
        plans.clean_customers(customers(spark, {})),
        plans.clean_products(products(spark, {})),
    )
    row = sales.first()
    gross = (Decimal(2147483647) * Decimal("99999999999999.9999")).quantize(Decimal("0.01"))
    assert row.gross_amount == gross
    assert row.net_amount == gross - row.discount_amount


def test_summary_of_unique_orders_is_the_same(spark):
    orders_, customers_, products_ = queries.retail_frames(spark, SMALL)
    sales = plans.sales_enriched(orders_, customers_, products_).withColumn("order_id", F.monotonically_increasing_id().cast("string"))
    assert rows(plans.monthly_sales_summary(sales, unique_orders=True)) == rows(plans.monthly_sales_summary(sales))


def test_dedup_takes_maps_and_any_name(spark):
    df = spark.sql(
        "SELECT 1 AS `a.b`, map('x', 2) AS m, 5 AS `key0` UNION ALL SELECT 1, map('x', 1), 7 UNION ALL SELECT 2, null, 1"
    )
    kept = dedup_by_key(df, ["a.b"])
    assert kept.columns == df.columns and kept.dtypes == df.dtypes
    assert sorted(map(tuple, kept.collect()), key=str) == [(1, {"x": 1}, 7), (2, None, 1)]
    assert rows(dedup_by_key(df.select("`a.b`"), ["a.b"])) == [(1,), (2,)]


def test_failed_write_keeps_the_earlier_table(spark, folder):
    database = queries.database_name(folder)
    sinks.ensure_database(spark, database, f"{folder}/tables")
    sinks.save_table(spark.range(5), f"{database}.numbers")
    failing = spark.range(0, 10, 1, 2).select(F.expr("IF(id = 9, raise_error('stop'), id)").cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.save_table(failing, f"{database}.numbers")
    spark.catalog.refreshTable(f"{database}.numbers")
    assert rows(spark.table(f"{database}.numbers")) == [(n,) for n in range(5)]
    assert rows(sinks.save_table(spark.range(2), f"{database}.numbers")) == [(0,), (1,)]


def test_scratch_folder_needs_the_shared_one(spark):
    class Without:
        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sinks.new_scratch_folder(Without)
    assert sinks.new_scratch_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
