"""What cleaning rejects, why, and how much of it; counts out of the job's own writes."""

import json

import pytest
from conftest import SMALL, final_plan, rows
from pyspark.sql import functions as F
from test_retail import CUSTOMER, ORDER, PRODUCT, customers, orders, products

from ledgerloom import plans
from workload import inputs, queries


def judged_rows(df, key):
    return {(row[key], row.copies): row for row in df.collect()}


def test_each_failed_rule_is_named(spark):
    landing = orders(
        spark,
        {},
        {"order_id": "2", "unit_price": "-1", "quantity": "0", "customer_id": "n/a", "product_id": "p1"},
        {"order_id": "3", "order_date": "2024-13-45", "total_amount": "1.2.3"},
        {"order_id": "4", "discount_pct": "200", "ship_date": "x"},
    )
    found = {row.order_id: row for row in plans.judge_orders(landing).collect()}
    assert found["1"].kept and found["1"].failed_rules == [] and found["1"].landing is None
    assert found["2"].failed_rules == [
        "customer_id: missing",
        "product_id: unreadable",
        "quantity: out of range",
        "unit_price: out of range",
    ]
    assert found["3"].failed_rules == ["order_date: unreadable", "total_amount: unreadable"]
    assert found["4"].kept  # these two are not required
    assert json.loads(found["3"].landing) == ORDER | {"order_id": "3", "order_date": "2024-13-45", "total_amount": "1.2.3"}
    assert [found[k].rejected_rows for k in "1234"] == [0, 1, 1, 0]


def test_landed_is_kept_and_duplicates_and_rejected(spark):
    landing = orders(
        spark,
        {},
        {"order_id": " 1 "},
        {"order_id": "1", "quantity": "9"},
        {"order_id": "2", "quantity": "x"},
        {"order_id": "2", "quantity": "y"},  # a duplicate of a rejected row
        {"order_id": "x7"},
        {"order_id": "x7"},  # rows without a usable key are no duplicates
        {"order_id": "x7", "quantity": "1"},
        {"order_id": "none"},
    )
    judged = plans.judge_orders(landing)
    assert judged.agg(*[v.alias(k) for k, v in plans.tally().items()]).first().asDict() == {
        "landed": 9,
        "kept": 1,
        "duplicates": 3,
        "rejected": 5,
    }
    assert dict(rows(plans.rejected_rules(judged))) == {"order_id: unreadable": 3, "order_id: missing": 1, "quantity: unreadable": 1}


@pytest.mark.parametrize(
    "judge, clean, make, key, base",
    [
        (plans.judge_orders, plans.clean_orders, orders, "order_id", ORDER),
        (plans.judge_products, plans.clean_products, products, "product_id", PRODUCT),
        (plans.judge_customers, plans.clean_customers, customers, "customer_id", CUSTOMER),
    ],
)
def test_kept_rows_are_those_of_cleaning(spark, judge, clean, make, key, base):
    changes = [{}, {key: None}, {key: None}] + [{name: None} for name in base if name != key]
    landing = make(spark, *changes)
    judged = judge(landing)
    kept = judged.where("kept").select(*landing.columns)
    assert kept.dtypes == clean(landing).dtypes and rows(kept) == rows(clean(landing))
    missing = judged.where(F.col(key).isNull()).select("copies", "rejected_rows", "failed_rules").collect()
    assert [tuple(row) for row in missing] == [(2, 2, [f"{key}: missing"])]
    empty = judge(landing.limit(0))
    assert empty.collect() == [] and list(empty.agg(*plans.tally().values()).first()) == [0, 0, 0, 0]


def test_kept_rows_of_the_given_tables(spark):
    landing = queries.frame(spark, SMALL, inputs.LANDING_ORDERS)
    judged = plans.judge_orders(landing)
    assert rows(judged.where("kept").select(*landing.columns)) == rows(plans.clean_orders(landing))
    counts = judged.agg(*[v.alias(k) for k, v in plans.tally().items()]).first()
    assert counts.landed == landing.count() == counts.kept + counts.duplicates + counts.rejected


def test_a_traced_job_counts_in_its_own_writes(spark, folder):
    database = queries.database_name(folder)
    landing = {
        "orders": orders(spark, {}, {"order_id": "2", "customer_id": "99"}, {"order_id": "3", "quantity": "x"}, {}, {"order_id": "?"}),
        "products": products(spark, {}, {"product_id": "P2", "price": "x"}),
        "customers": customers(spark, {}, {}),
    }
    traced = plans.curate_retail(spark, **landing, database=database, location=f"{folder}/a", export_folder=f"{folder}/e", trace=True)
    counted = plans.job_counts(spark, database)
    assert "FileScan" not in final_plan(counted) and "Scan csv" not in final_plan(counted)  # nothing is read again
    assert dict(rows(counted)) == {
        "orders source": 5,
        "orders duplicates": 1,
        "orders rejected": 2,
        "products source": 2,
        "products duplicates": 0,
        "products rejected": 1,
        "customers source": 2,
        "customers duplicates": 1,
        "customers rejected": 0,
        "orders curated": 1,
        "products curated": 1,
        "customers curated": 1,
        "sales_enriched curated": 1,
        "monthly_sales_summary curated": 1,
    }
    plain = plans.curate_retail(spark, **landing, database=queries.database_name(f"{folder}x"), location=f"{folder}/b")
    for name, table in plain.items():
        assert rows(traced[name]) == rows(table) and traced[name].dtypes == table.dtypes
    rejected = spark.table(f"{database}.orders_judged").where("NOT kept")
    assert sorted(row.failed_rules[0] for row in rejected.collect()) == ["order_id: unreadable", "quantity: unreadable"]


@pytest.mark.parametrize("judge, make", [(plans.judge_orders, orders), (plans.judge_products, products), (plans.judge_customers, customers)])
def test_reasons_are_counted_without_the_columns_after_them(spark, judge, make):
    base = {"orders": ORDER, "products": PRODUCT, "customers": CUSTOMER}[make.__name__]
    landing = make(spark, *[{}, {}], *[{name: None} for name in base], *[{name: None} for name in base])
    whole, short = judge(landing), judge(landing, reasons_only=True)
    assert "landing" not in short.columns and not {"payment_method", "is_active", "country"} & set(short.columns)
    assert rows(plans.rejected_rules(short)) == rows(plans.rejected_rules(whole)) != []
    tallies = [df.agg(*plans.tally().values()).first() for df in (whole, short)]
    assert tallies[0] == tallies[1]


def test_a_later_column_does_not_change_the_reasons(spark):
    landing = orders(
        spark,
        {"order_status": "a", "quantity": "9"},
        {"order_status": "b", "quantity": "0"},  # the smaller row, by a column before
        {"order_id": "x", "order_status": "a"},
        {"order_id": "x", "order_status": "b"},
    )
    judged = plans.judge_orders(landing, reasons_only=True)
    assert rows(plans.rejected_rules(judged)) == [("order_id: unreadable", 2), ("quantity: out of range", 1)]


def test_rules_are_worked_out_once_and_after_the_survivors_only(spark):
    plan = queries.rejected_rules(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [line for line in plan if "Filter" in line and "RLIKE" in line]
    assert not [line for line in plan if "payment_method" in line or "loyalty_points" in line]
