"""The retail job: landing tables -> curated tables -> enriched sales -> monthly summary."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FloatType, StringType

from ledgerloom.functions import cleaning as rules
from ledgerloom.functions.numeric import exact_product, product_type, round_half_up
from ledgerloom.operators.relational import dedup_by_key, fk_valid, require, row_counts
from ledgerloom.sinks.tables import ensure_database, save_parquet, save_table, side_by_side, table_snapshot

# Amounts are exact decimals by default, of up to 28 digits and ten places. A well-formed amount
# that does not fit fails the job. "float" gives the 32-bit floats of the original tables instead,
# "double" 64-bit ones (their sums then depend on the order of addition).
EXACT = "decimal(38,10)"
PERCENT = "decimal(7,4)"
# The column by which the stored sales are partitioned; it is not part of the returned table.
SALES_MONTH = "sales_month"
# A bucket of the co-located tables is at most so many times the average.
LARGEST_BUCKET = 5


Rule = Callable[[Column], Column]


@dataclass(frozen=True)
class TableRules:
    """How one landing table becomes a curated one.

    ``read`` turns tidy text into a value, ``check`` turns a value out of range into null.
    """

    key: str
    null_tokens: tuple[str, ...]
    read: Mapping[str, Rule]
    check: Mapping[str, Rule]
    required: tuple[str, ...]


def _apply(df: DataFrame, table: TableRules, trim_key_first: bool) -> DataFrame:
    """Drop rows that can never qualify, de-duplicate, read, check, require.

    A row whose key fails its rule is dropped in the end whichever duplicate survives, so it
    goes before the shuffle: missing keys, the usual hot key, are never shuffled. All other
    rules look at the surviving rows only and do not change who survives.
    """
    texts = {field.name for field in df.schema.fields if isinstance(field.dataType, StringType)}

    def cleaned(name: str, value: Column) -> Column:
        tidy = rules.blank_to_null(value, table.null_tokens) if name in texts else value
        return table.read[name](tidy) if name in table.read else tidy

    key = cleaned(table.key, F.col(table.key))
    usable = df.where(key.isNotNull())
    if trim_key_first:
        usable = usable.withColumn(table.key, key)
    on_read = {name: partial(cleaned, name) for name in df.columns}
    kept = dedup_by_key(usable, [table.key], on_read)
    checked = kept.withColumns({name: rule(F.col(name)) for name, rule in table.check.items()})
    return require(checked, table.required)


# The columns that ``judged`` adds.
COPIES, REJECTED_ROWS, FAILED, LANDING, KEPT = "copies", "rejected_rows", "failed_rules", "landing", "kept"


def judged(df: DataFrame, table: TableRules, reasons_only: bool = False) -> DataFrame:
    """What cleaning keeps, and what it rejects and why, in one pass.

    The columns of ``df``, cleaned, and: ``copies``, the landing rows of this key; ``kept``, whether
    the row is one that cleaning keeps; ``failed_rules``, for a required column ``name: missing``,
    ``name: unreadable`` or ``name: out of range``; ``landing``, a rejected row as it landed, as JSON;
    ``rejected_rows``, the landing rows that this row's rejection stands for. The survivor of a key
    stands for itself (its duplicates are duplicates); rows without a usable key are no duplicates
    of each other, only equal ones are one row here, with their number.

    ``reasons_only`` is for counting: the columns after the last required one, and ``landing``, are left out.
    No reason comes from them, and as the survivor of a key is its smallest row, compared left to right,
    they have no say in what the columns before them hold.
    """
    if reasons_only:
        df = df.select(*df.columns[: 1 + max(df.columns.index(name) for name in table.required)])
    texts = {field.name for field in df.schema.fields if isinstance(field.dataType, StringType)}

    def tidy(name: str) -> Column:
        return rules.blank_to_null(F.col(name), table.null_tokens) if name in texts else F.col(name)

    def read(name: str, value: Column) -> Column:
        return table.read[name](value) if name in table.read else value

    keyed = df.withColumn("usable", read(table.key, tidy(table.key)))
    odd = F.when(F.col("usable").isNull(), F.struct(*df.columns))
    marked = keyed.withColumns({"odd": odd, table.key: F.coalesce("usable", table.key)}).drop("usable")
    survivors = dedup_by_key(marked, [table.key, "odd"], count_as=COPIES)
    tidied = survivors.select(
        F.col("odd").isNotNull().alias("odd"),
        COPIES,
        F.to_json(F.coalesce("odd", F.struct(*df.columns))).alias(LANDING),
        *[tidy(name).alias(name) for name in df.columns],
    )
    missing = {f"{name}: missing": F.col(name).isNull() for name in table.required}
    readable = tidied.withColumns({name: read(name, F.col(name)) for name in table.read if name in df.columns} | missing)
    unreadable = {f"{name}: unreadable": F.col(name).isNull() for name in table.required}
    within = {name: rule(F.col(name)) for name, rule in table.check.items() if name in df.columns}
    checked = readable.withColumns(within | unreadable)

    def reason(name: str) -> Column:
        missing, unreadable = f"{name}: missing", f"{name}: unreadable"
        found = F.when(F.col(missing), missing).when(F.col(unreadable), unreadable)
        return found.when(F.col(name).isNull(), f"{name}: out of range")

    failed = checked.withColumn(FAILED, F.array_compact(F.array(*[reason(name) for name in table.required])))
    kept = F.size(FAILED) == 0
    rejected = F.when(kept, 0).when(F.col("odd"), F.col(COPIES)).otherwise(1).cast("long")
    return failed.select(
        *df.columns,
        COPIES,
        rejected.alias(REJECTED_ROWS),
        FAILED,
        *([] if reasons_only else [F.when(~kept, F.col(LANDING)).alias(LANDING)]),
        kept.alias(KEPT),
    )


def tally() -> dict[str, Column]:
    """Aggregates of judged rows: landed = kept + duplicates + rejected."""
    kept = F.col(KEPT).cast("long")
    counted = {
        "landed": F.col(COPIES),
        "kept": kept,
        "duplicates": F.col(COPIES) - F.col(REJECTED_ROWS) - kept,
        "rejected": F.col(REJECTED_ROWS),
    }
    return {name: F.coalesce(F.sum(value), F.lit(0).cast("long")) for name, value in counted.items()}


def judge_orders(orders: DataFrame, amount_type: str = EXACT, reasons_only: bool = False) -> DataFrame:
    return judged(orders, _orders_rules(amount_type), reasons_only)


def judge_products(products: DataFrame, amount_type: str = EXACT, reasons_only: bool = False) -> DataFrame:
    return judged(products, _products_rules(amount_type), reasons_only)


def judge_customers(customers: DataFrame, reasons_only: bool = False) -> DataFrame:
    return judged(customers, CUSTOMERS_RULES, reasons_only)


def rejected_rules(judged_rows: DataFrame) -> DataFrame:
    """``(rule, rows)``: how many landing rows each failed rule had a part in rejecting."""
    reasons = judged_rows.groupBy(FAILED).agg(F.sum(REJECTED_ROWS).alias("rows"))
    # Of a bare column Spark would test the size first, down at the survivors, with every rule written out anew.
    each = reasons.select(F.explode(F.array_compact(FAILED)).alias("rule"), "rows")
    return each.groupBy("rule").agg(F.sum("rows").alias("rows"))


def _not_negative(value: Column) -> Column:
    return rules.at_least(value, 0)


def _positive(value: Column) -> Column:
    return rules.above(value, 0)


def _orders_rules(amount_type: str) -> TableRules:
    date = partial(rules.first_date, formats=rules.ORDER_DATE_FORMATS)
    amount = partial(rules.strip_amount, type_name=amount_type)
    percent_type = PERCENT if amount_type.startswith("decimal") else "double"
    return TableRules(
        key="order_id",
        null_tokens=rules.ORDER_NULL_TOKENS,
        read={
            "order_id": rules.digits_only_id,
            "customer_id": rules.digits_only_id,
            "product_id": rules.product_code,
            "order_date": date,
            "ship_date": date,
            "quantity": rules.strip_integer,
            "unit_price": amount,
            "discount_pct": amount,
            "total_amount": amount,
            "payment_method": rules.title_label,
            "order_status": rules.title_label,
        },
        check={
            "quantity": _positive,
            "unit_price": _not_negative,
            "discount_pct": lambda value: rules.percent_or_zero(value).cast(percent_type),
            "total_amount": _not_negative,
        },
        required=(
            "order_id",
            "customer_id",
            "product_id",
            "order_date",
            "quantity",
            "unit_price",
            "total_amount",
        ),
    )


def _products_rules(amount_type: str) -> TableRules:
    amount = partial(rules.strip_amount, type_name=amount_type, decimal_comma=True)
    return TableRules(
        key="product_id",
        null_tokens=rules.PRODUCT_NULL_TOKENS,
        read={
            "product_id": rules.product_code,
            "category": rules.title_label,
            "brand": rules.title_label,
            "price": amount,
            "cost": amount,
            "stock_quantity": rules.strip_integer,
            "weight_kg": partial(rules.strip_amount, type_name="float", decimal_comma=True),
            "created_date": partial(rules.first_date, formats=rules.PRODUCT_DATE_FORMATS),
            "is_active": rules.flag_words,
        },
        check={
            "price": _not_negative,
            "cost": _not_negative,
            "stock_quantity": _not_negative,
            "weight_kg": _positive,
        },
        required=(
            "product_id",
            "product_name",
            "category",
            "brand",
            "price",
            "cost",
            "created_date",
        ),
    )


CUSTOMERS_RULES = TableRules(
    key="customer_id",
    null_tokens=rules.BLANK_ONLY,
    read={"email": rules.email_address, "phone": rules.phone_number},
    check={"loyalty_points": rules.floor_at_zero},
    required=("customer_id", "first_name", "last_name", "email", "signup_date"),
)


def clean_orders(
    orders: DataFrame, amount_type: str = EXACT, trim_key_first: bool = True
) -> DataFrame:
    """Curated orders from an all-text landing frame, one row per order_id.

    ``trim_key_first=False`` de-duplicates on the raw key, so ``"1"`` and ``" 1"`` both stay.
    """
    return _apply(orders, _orders_rules(amount_type), trim_key_first)


def clean_products(
    products: DataFrame, amount_type: str = EXACT, trim_key_first: bool = True
) -> DataFrame:
    """Curated products from an all-text landing frame, one row per product_id."""
    return _apply(products, _products_rules(amount_type), trim_key_first)


def clean_customers(customers: DataFrame) -> DataFrame:
    """Curated customers from a typed landing frame, one row per customer_id."""
    return _apply(customers, CUSTOMERS_RULES, trim_key_first=True)


def fk_valid_orders(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Orders whose customer and product are curated; the two keys lead the columns."""
    valid = fk_valid(orders, {"customer_id": customers, "product_id": products})
    return _keys_first(valid, orders.columns)


def _keys_first(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    keys = ["product_id", "customer_id"]
    return df.select(*keys, *[name for name in columns if name not in keys])


def sales_enriched(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Orders with customer and product attributes and gross, discount and net amounts.

    The joins carry no hint: a dimension is broadcast only when its measured size allows,
    else both sides are shuffled and adaptive execution splits the tasks of a hot key.
    """
    buyers = customers.select(
        F.col("customer_id").cast("string").alias("customer_id"),
        *["first_name", "last_name", "email", "country", "state"],
    )
    goods = products.select("product_id", "product_name", "category", "brand")
    joined = orders.join(buyers, "customer_id").join(goods, "product_id")

    price, quantity, percent = (F.col(name) for name in ("unit_price", "quantity", "discount_pct"))
    price_type, quantity_type, percent_type = (
        orders.schema[name].dataType for name in ("unit_price", "quantity", "discount_pct")
    )
    exact = isinstance(price_type, DecimalType)
    if exact:
        gross_type = product_type(price_type, quantity_type, 2)
        gross = exact_product(price, price_type, quantity, quantity_type, 2)
    else:  # a float stays a float, a double a double
        gross_type = "float" if isinstance(price_type, FloatType) else "double"
        gross = F.round(quantity.cast(gross_type) * price, 2).cast(gross_type)
    sold = joined.select(
        "order_id",
        "order_date",
        "ship_date",
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "country",
        "state",
        "product_id",
        "product_name",
        "category",
        "brand",
        "quantity",
        "unit_price",
        "discount_pct",
        "total_amount",
        "payment_method",
        "order_status",
        gross.alias("gross_amount"),
    )
    if exact:  # hundredths of a percent of the gross amount, rounded once to whole ones, are cents
        cents = exact_product(F.col("gross_amount"), gross_type, percent, percent_type, 0)
        discount = (cents * F.lit(Decimal("0.01"))).cast(gross_type)
        net = (F.col("gross_amount") - F.col("discount_amount")).cast(gross_type)
    else:
        discount = F.round(F.col("gross_amount") * (percent / 100), 2)
        net = F.round(F.col("gross_amount") - F.col("discount_amount"), 2)
    return sold.withColumn("discount_amount", discount).withColumn("net_amount", net)


def monthly_sales_summary(sales: DataFrame, unique_orders: bool = False) -> DataFrame:
    """Orders, units and amounts per month and category.

    Grouping is by the first day of the month, four bytes that need no text formatting per row;
    the ``yyyy-MM`` label is made once per group.
    The distinct order count is exact. Spark shuffles it by (month, category, order_id), so
    the busiest category is spread over all tasks; the sums combine map-side.
    ``unique_orders`` states that no order_id repeats, as in the job's own sales: the orders are
    then counted without telling them apart, and only one row per group and task is shuffled.
    """

    def total(column: str) -> Column:
        return F.sum(column).cast("double")

    month = F.trunc("order_date", "MM").alias("month")
    summary = sales.groupBy(month, "category").agg(
        (F.count if unique_orders else F.countDistinct)("order_id").alias("total_orders"),
        F.sum("quantity").alias("total_units_sold"),
        F.round(total("gross_amount"), 2).alias("gross_revenue"),
        F.round(total("discount_amount"), 2).alias("total_discount"),
        F.round(total("net_amount"), 2).alias("net_revenue"),
        round_half_up(total("net_amount") / F.count("net_amount")).alias("avg_order_value"),
    )
    order_month = F.date_format("month", "yyyy-MM").alias("order_month")
    return summary.select(order_month, *[name for name in summary.columns if name != "month"])


def curate_retail(
    spark: SparkSession,
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    database: str,
    location: str | None = None,
    export_folder: str | None = None,
    amount_type: str = EXACT,
    trace: bool = False,
) -> dict[str, DataFrame]:
    """Run the whole job and return the five curated tables, read back from storage.

    Each table is computed once, written, and read back by whatever needs it, so the tables
    and their Parquet exports hold the same rows. Curated keys are unique, so the inner joins
    of the enrichment keep exactly the orders with valid keys, once each: the orders table is
    a projection of the written sales and needs no join of its own, and the summary counts
    orders without telling them apart. Sales are stored by month. Writes that do not wait for
    each other run side by side.

    With ``trace`` the cleaning writes its judgement of every landing row first, as tables
    ``orders_judged``, ``products_judged`` and ``customers_judged``, split into kept and rejected rows,
    and goes on from there; ``job_counts`` then has all counts of the job from its own writes.
    """
    ensure_database(spark, database, location)

    def cleaned(name: str, landing: DataFrame) -> DataFrame:
        of_amounts = {} if name == "customers" else {"amount_type": amount_type}
        if not trace:
            return {"orders": clean_orders, "products": clean_products, "customers": clean_customers}[name](landing, **of_amounts)
        judge = {"orders": judge_orders, "products": judge_products, "customers": judge_customers}[name]
        rows = save_table(judge(landing, **of_amounts), f"{database}.{name}_judged", [KEPT], metrics=tally())
        return rows.where(KEPT).select(*landing.columns)

    def written(name: str, df: DataFrame, **layout) -> DataFrame:
        table = save_table(df, f"{database}.{name}", **layout)
        if export_folder:
            save_parquet(table, f"{export_folder}/{name}")
        return table

    def sales_table(usable: DataFrame) -> DataFrame:
        enriched = sales_enriched(usable, tables["customers"], tables["products"])
        month = F.date_format("order_date", "yyyy-MM").alias(SALES_MONTH)
        stored = save_table(enriched.select("*", month), f"{database}.sales_enriched", partition_by=[SALES_MONTH])
        return stored.drop(SALES_MONTH)

    first = side_by_side(
        customers=lambda: written("customers", cleaned("customers", customers)),
        products=lambda: written("products", cleaned("products", products)),
        orders=lambda: cleaned("orders", orders),
    )
    tables = {name: first[name] for name in ("customers", "products")}
    tables["sales_enriched"] = sales = sales_table(first["orders"])
    summary = monthly_sales_summary(sales, unique_orders=True)
    last = {
        "orders": lambda: written("orders", _keys_first(sales, orders.columns)),
        "monthly_sales_summary": lambda: written("monthly_sales_summary", summary),
    }
    if export_folder:
        last["export"] = lambda: save_parquet(sales, f"{export_folder}/sales_enriched")
    done = side_by_side(**last)
    return tables | {name: done[name] for name in ("orders", "monthly_sales_summary")}


def job_counts(spark: SparkSession, database: str) -> DataFrame:
    """``(table_name, record_count)`` of a traced job, out of what its writes counted: no row is read.

    For each landing table what landed, its duplicates and its rejected rows; for each curated one its rows.
    """
    counts = []
    for name in ("orders", "products", "customers"):
        seen = table_snapshot(spark, f"{database}.{name}_judged").metrics
        counts.append((f"{name} source", seen["landed"]))
        counts += [(f"{name} {what}", seen[what]) for what in ("duplicates", "rejected")]
    for name in ("orders", "products", "customers", "sales_enriched", "monthly_sales_summary"):
        counts.append((f"{name} curated", table_snapshot(spark, f"{database}.{name}").rows))
    return spark.createDataFrame(counts, "table_name string, record_count long")


def store_co_located(
    spark: SparkSession,
    database: str,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    buckets: int | None = None,
) -> dict[str, DataFrame]:
    """Orders and customers stored in equal buckets by customer, with the key as text in both; products as they are.

    ``fk_valid_orders`` and ``sales_enriched`` over these tables move neither orders nor customers,
    whatever their sizes, as long as products are small enough to broadcast; beyond that the orders are
    shuffled once, by product. ``buckets`` is ``spark.sql.shuffle.partitions`` by default. A bucket is
    read by one task, so if a customer or two make the largest more than ``LARGEST_BUCKET`` times the
    average, orders are stored without buckets, and adaptive execution splits their joins.
    """
    many = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.col("customer_id").cast("string")
    sizes = orders.groupBy(F.pmod(F.hash(key), F.lit(many))).count().agg(F.max("count"), F.sum("count")).first()
    even = (sizes[0] or 0) * many <= LARGEST_BUCKET * (sizes[1] or 0)

    def by_customer(name: str, df: DataFrame) -> DataFrame:
        layout = {"bucket_by": ["customer_id"], "buckets": many} if even else {}
        return save_table(df.withColumn("customer_id", key), f"{database}.{name}", **layout)

    return side_by_side(
        orders=lambda: by_customer("orders", orders),
        customers=lambda: by_customer("customers", customers),
        products=lambda: save_table(products, f"{database}.products"),
    )


def source_and_curated_counts(
    sources: Mapping[str, DataFrame], tables: Mapping[str, DataFrame]
) -> DataFrame:
    """Row counts of the landing frames and of the curated tables, by name."""
    named = {f"{name} source": frame for name, frame in sources.items()}
    named |= {f"{name} curated": frame for name, frame in tables.items()}
    return row_counts(named)
