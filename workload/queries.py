"""The registered queries: each operator or job over the given tables, whole."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import partial
from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, FloatType

from ledgerloom import operators as ops
from ledgerloom import plans, sinks, sources
from ledgerloom.functions import cleaning, details_text, details_udf, prefixed
from workload import inputs

Query = Callable[[SparkSession, str], DataFrame]

# The parameters of the queries, shared with the oracle.
SIMILAR_TO = 7
MIN_SCORE = 0.75
MIN_PAIRS = 10
TOP_N = 10


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def frame(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """The input that ``sql`` describes, over the given tables it names."""
    names = {field for _, field, _, _ in Formatter().parse(sql) if field}
    return spark.sql(sql, **{name: table(spark, folder, name) for name in names})


def plain(df: DataFrame) -> DataFrame:
    """Dates as text, decimals and floats as doubles, for comparison between engines."""

    def shown(field):
        column = F.col(field.name)
        if isinstance(field.dataType, (DecimalType, FloatType)):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, DateType):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*[shown(field) for field in df.schema.fields])


# --- cleaning ---------------------------------------------------------------------------


def clean_orders(spark, folder):
    return plain(plans.clean_orders(frame(spark, folder, inputs.LANDING_ORDERS)))


def clean_products(spark, folder):
    return plain(plans.clean_products(frame(spark, folder, inputs.LANDING_PRODUCTS)))


def clean_customers(spark, folder):
    return plain(plans.clean_customers(frame(spark, folder, inputs.LANDING_CUSTOMERS)))


def _judged(spark, folder):
    return {
        "orders": plans.judge_orders(frame(spark, folder, inputs.LANDING_ORDERS), reasons_only=True),
        "products": plans.judge_products(frame(spark, folder, inputs.LANDING_PRODUCTS), reasons_only=True),
        "customers": plans.judge_customers(frame(spark, folder, inputs.LANDING_CUSTOMERS), reasons_only=True),
    }


def landing_tally(spark, folder):
    """For each landing table: landed = kept + duplicates + rejected."""
    counted = [
        df.agg(*[value.alias(name) for name, value in plans.tally().items()]).withColumn("table_name", F.lit(table_name))
        for table_name, df in _judged(spark, folder).items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def rejected_rules(spark, folder):
    """How many rows each rule had a part in rejecting."""
    counted = [plans.rejected_rules(df).withColumn("table_name", F.lit(name)) for name, df in _judged(spark, folder).items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def clean_null_tokens(spark, folder):
    landing = frame(spark, folder, inputs.LANDING_ORDERS)
    return ops.null_tokens(landing, cleaning.ORDER_NULL_TOKENS)


def dedup_by_key(spark, folder):
    kept = ops.dedup_by_key(table(spark, folder, "lineitem"), ["l_orderkey"])
    return kept.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


def distinct_keys(spark, folder):
    return ops.distinct_keys(table(spark, folder, "lineitem"), ["l_partkey", "l_suppkey"])


# --- retail -----------------------------------------------------------------------------


def retail_frames(spark, folder):
    return (
        frame(spark, folder, inputs.RETAIL_ORDERS),
        frame(spark, folder, inputs.RETAIL_CUSTOMERS),
        frame(spark, folder, inputs.RETAIL_PRODUCTS),
    )


def fk_valid_orders(spark, folder):
    orders, customers, products = retail_frames(spark, folder)
    in_credit = customers.where("balance > 0")
    large = products.where("size > 10")
    return plain(plans.fk_valid_orders(orders, in_credit, large))


def _sales(spark, folder):
    return plans.sales_enriched(*retail_frames(spark, folder))


def sales_enriched(spark, folder):
    return plain(_sales(spark, folder))


def monthly_sales_summary(spark, folder):
    return plans.monthly_sales_summary(_sales(spark, folder))


def _co_located(spark, folder, customers_where="true", products_where="true"):
    """The retail tables saved in equal buckets by customer."""
    orders, customers, products = retail_frames(spark, folder)
    scratch = scratch_folder(spark)
    database = database_name(scratch)
    sinks.ensure_database(spark, database, f"{scratch}/tables")
    tables = plans.store_co_located(spark, database, orders, customers.where(customers_where), products.where(products_where))
    return tables["orders"], tables["customers"], tables["products"]


def stored_sales_enriched(spark, folder):
    """The enriched sales over stored tables, whose rows stay in place."""
    return plain(plans.sales_enriched(*_co_located(spark, folder)))


def stored_fk_valid_orders(spark, folder):
    return plain(plans.fk_valid_orders(*_co_located(spark, folder, "balance > 0", "size > 10")))


# The saved curated tables of a session, by data folder: saved once, read by every report.
_SAVED: dict[tuple[str, str], dict[str, DataFrame]] = {}


def save_curated(spark, folder, exports: str | None = None) -> dict[str, DataFrame]:
    """The five curated tables over the given tables, written and read back."""
    orders, customers, products = retail_frames(spark, folder)
    scratch = exports or scratch_folder(spark)

    def saved(name: str, df: DataFrame) -> DataFrame:
        return sinks.save_parquet(df, f"{scratch}/{name}")

    tables = sinks.side_by_side(
        orders=lambda: saved("orders", orders),
        products=lambda: saved("products", products),
        customers=lambda: saved("customers", customers),
    )
    # out of the saved tables: the lines are not joined with their orders a second time
    sales = plans.sales_enriched(tables["orders"], tables["customers"], tables["products"])
    tables["sales_enriched"] = saved("sales_enriched", sales)
    monthly = plans.monthly_sales_summary(tables["sales_enriched"])
    return tables | {"monthly_sales_summary": saved("monthly_sales_summary", monthly)}


def _registered(spark, folder):
    key = (spark.sparkContext.applicationId, folder)
    if key not in _SAVED:
        _SAVED[key] = save_curated(spark, folder)
    return sources.register_curated(spark, _SAVED[key])


def _question(name: str) -> Query:
    def query(spark, folder):
        _registered(spark, folder)
        return plans.run_sql(spark, name)

    return query


def register_curated(spark, folder):
    """The names that were registered, each with the rows behind it."""
    names = _registered(spark, folder)
    counts = ops.row_counts({view: spark.table(view) for view in sources.CURATED_VIEWS.values()})
    return names.join(counts, "table_name", "left")


def registered_exports(spark, folder):
    """The rows behind the lasting names, as another session of the catalog finds them."""
    scratch = scratch_folder(spark)
    database = database_name(scratch)
    sinks.ensure_database(spark, database, f"{scratch}/tables")
    curated = save_curated(spark, folder, f"{scratch}/exports")
    sinks.save_parquet(curated["orders"].limit(0), f"{scratch}/exports/orders")
    sources.register_exports(spark, f"{scratch}/exports", database)
    sinks.save_parquet(curated["orders"], f"{scratch}/exports/orders")
    sources.register_exports(spark, f"{scratch}/exports", database)  # shows what was exported since
    other = spark.newSession()
    return ops.row_counts({view: other.table(f"{database}.{view}") for view in sources.CURATED_VIEWS.values()})


def _curated(spark, folder, **options):
    """Landing CSV files -> curated tables and exports; what landed and what was written."""
    scratch = scratch_folder(spark)
    read = {
        "orders": (inputs.LANDING_ORDERS, sources.read_orders_landing),
        "products": (inputs.LANDING_PRODUCTS, sources.read_products_landing),
        "customers": (inputs.LANDING_CUSTOMERS, sources.read_customers_landing),
    }

    def landing(name):
        sql, reader = read[name]
        write_csv(frame(spark, folder, sql), f"{scratch}/landing/{name}", compression="gzip")
        sinks.release_shuffles(spark)
        return reader(spark, f"{scratch}/landing/{name}")

    landed = sinks.side_by_side(**{name: partial(landing, name) for name in read})
    curated = plans.curate_retail(
        spark,
        **landed,
        database=database_name(scratch),
        location=f"{scratch}/tables",
        export_folder=f"{scratch}/exports",
        **options,
    )
    return landed, curated, database_name(scratch)


def curate_retail(spark, folder):
    """The whole job, counted before and after."""
    return plans.source_and_curated_counts(*_curated(spark, folder)[:2])


def curate_retail_traced(spark, folder):
    """The whole job with its rejects; the counts that its own writes took."""
    return plans.job_counts(spark, _curated(spark, folder, trace=True)[2])


def curated_sales(spark, folder):
    """The whole job's enriched sales, as written."""
    return plain(_curated(spark, folder)[1]["sales_enriched"])


def curated_monthly(spark, folder):
    """The whole job's monthly summary, as written."""
    return _curated(spark, folder)[1]["monthly_sales_summary"]


# --- similarity -------------------------------------------------------------------------

RATED_BY = {"user": "customer", "item": "supplier", "rating": "rating"}


def pair_stats(spark, folder):
    return ops.pair_stats(frame(spark, folder, inputs.RATINGS), **RATED_BY)


def item_similarity(spark, folder):
    return ops.item_similarity(frame(spark, folder, inputs.RATINGS), **RATED_BY)


def item_similarity_dedup(spark, folder):
    return ops.item_similarity(frame(spark, folder, inputs.RATINGS), **RATED_BY, dedup=True)


def similar_items_topk(spark, folder):
    """The stored form: similarities are written once, then looked up."""
    ratings = frame(spark, folder, inputs.RATINGS)
    scratch = scratch_folder(spark)
    # written once as they come, so that the shuffles they were made by are gone before they are dealt by item
    similarities = sinks.save_parquet(ops.item_similarity(ratings, **RATED_BY), f"{scratch}/pairs")
    stored = ops.save_similarities(similarities, f"{scratch}/similarities")
    titles = frame(spark, folder, inputs.TITLES)
    return ops.similar_items_stored(stored, titles, SIMILAR_TO, MIN_SCORE, MIN_PAIRS, TOP_N)


def similar_items_lookup(spark, folder):
    ratings = frame(spark, folder, inputs.RATINGS)
    titles = frame(spark, folder, inputs.TITLES)
    bounds = {"min_score": MIN_SCORE, "min_pairs": MIN_PAIRS, "k": TOP_N}
    return ops.similar_items_lookup(ratings, titles, SIMILAR_TO, **RATED_BY, **bounds)


def strong_similarities(spark, folder):
    """All pairs above both bounds, without forming the others."""
    ratings = frame(spark, folder, inputs.RATINGS)
    return ops.strong_similarities(ratings, **RATED_BY, min_score=MIN_SCORE, min_pairs=MIN_PAIRS)


def item_title(spark, folder):
    return ops.item_title(frame(spark, folder, inputs.TITLES), SIMILAR_TO)


# --- graph ------------------------------------------------------------------------------


def graph_degree(spark, folder):
    return ops.graph_degree(frame(spark, folder, inputs.GRAPH_LINES))


def min_degree_ties(spark, folder):
    lines = frame(spark, folder, inputs.GRAPH_LINES)
    return ops.min_degree_ties(lines, frame(spark, folder, inputs.GRAPH_NAMES))


# --- text -------------------------------------------------------------------------------


def word_count(spark, folder):
    return ops.word_count(table(spark, folder, "documents"), "text")


def word_lengths(spark, folder):
    return ops.word_lengths(frame(spark, folder, inputs.SPACED_LINES))


def error_words(spark, folder):
    return ops.level_words(frame(spark, folder, inputs.LOG_LINES))


# --- counts, totals, people -------------------------------------------------------------


def people_select(spark, folder):
    return frame(spark, folder, inputs.PEOPLE).select("name", "age")


def people_filter(spark, folder):
    return frame(spark, folder, inputs.PEOPLE).where(F.col("age") > 25)


def adults_sql(spark, folder):
    return ops.adults_sql(frame(spark, folder, inputs.PEOPLE))


def count_by_age(spark, folder):
    return ops.count_by(frame(spark, folder, inputs.PEOPLE), "age")


def avg_friends_by_age(spark, folder):
    return ops.average_by(frame(spark, folder, inputs.PEOPLE), "age", "friends", "avg_friends")


def user_details(spark, folder):
    people = frame(spark, folder, inputs.PEOPLE)
    return people.select("id", details_text(F.col("name"), F.col("age")).alias("details"))


def user_details_udf(spark, folder):
    people = frame(spark, folder, inputs.PEOPLE)
    return people.select("id", details_udf("name", F.col("age").cast("string")).alias("details"))


def customer_totals_sql(spark, folder):
    return ops.customer_totals_sql(frame(spark, folder, inputs.CUSTOMER_ORDERS))


def customer_totals_df(spark, folder):
    orders = frame(spark, folder, inputs.CUSTOMER_ORDERS)
    return plain(ops.total_by(orders, "customer_id", "order_price"))


def min_temp_by_station(spark, folder):
    events = table(spark, folder, "events")
    return ops.min_by_key(events, "user_id", "event_type", "value", "view", "min_value")


def num_square_prefix(spark, folder):
    key = F.col("p_partkey")
    squares = (key * key).alias("squared")
    return table(spark, folder, "part").select(key, squares, prefixed(key, "num_").alias("label"))


def num_filter_even(spark, folder):
    lines = table(spark, folder, "lineitem")
    return lines.where(F.col("l_quantity") % 2 == 0).select("l_orderkey", "l_quantity")


def num_filter_above(spark, folder):
    lines = table(spark, folder, "lineitem")
    return lines.where(F.col("l_quantity") > 5).select("l_orderkey", "l_quantity")


def num_filter(spark, folder):
    lines = table(spark, folder, "lineitem")
    wanted = (F.col("l_quantity") % 2 == 0) & (F.col("l_quantity") > 5)
    return lines.where(wanted).select("l_orderkey", "l_quantity")


def num_reduce(spark, folder):
    return ops.reduce_numbers(table(spark, folder, "lineitem"), "l_partkey")


def num_top(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_size", "p_name")
    return ops.top(parts, "p_size", TOP_N, ["p_partkey"])


def num_take_ordered(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_size", "p_name")
    return ops.take_ordered(parts, ["p_size", "p_partkey"], TOP_N)


def num_first(spark, folder):
    return ops.take_ordered(table(spark, folder, "customer"), ["c_name", "c_custkey"], 1)


def count_by_value(spark, folder):
    return ops.count_by_value(table(spark, folder, "events"), "event_type")


# --- files and tables -------------------------------------------------------------------


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", compression: str = "none") -> None:
    """Landing files that keep the blanks around values."""
    writer = df.write.mode("overwrite").option("header", header).option("sep", sep).option("compression", compression)
    writer = writer.option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).csv(path)


def database_name(scratch: str) -> str:
    """A database name of its own for each scratch folder."""
    return "curated_" + scratch.rsplit("-", 1)[-1].replace(".", "_").lower()


def scratch_folder(spark: SparkSession) -> str:
    """A fresh scratch folder; a run in one process without a shared folder gets one of its own."""
    master = spark.sparkContext.master
    if not spark.conf.get("spark.checkpoint.dir", None) and (master == "local" or master.startswith("local[")):
        return "file://" + tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return sinks.new_scratch_folder(spark)


def _csv_round_trip(spark, df, read, header=True, sep=","):
    path = f"{scratch_folder(spark)}/csv"
    write_csv(df, path, header, sep)
    return read(spark, path)


def _text_round_trip(spark, values, read):
    path = f"{scratch_folder(spark)}/text"
    values.write.mode("overwrite").text(path)
    return read(spark, path)


def src_csv_strings(spark, folder):
    landing = frame(spark, folder, inputs.LANDING_ORDERS)
    return _csv_round_trip(spark, landing, sources.read_orders_landing)


def _broken_customers(spark, folder):
    """Files of two column orders, one with a column more, with cells that do not fit."""
    broken = frame(spark, folder, inputs.BROKEN_CUSTOMERS)
    path = f"{scratch_folder(spark)}/csv"
    odd = F.length("postal_code") + F.coalesce(F.length("state"), F.lit(0)) > 11
    write_csv(broken.where(odd), f"{path}/one")
    write_csv(broken.where(~odd).select(*reversed(broken.columns), F.lit("x").alias("remark")), f"{path}/two")
    return sources.read_customers_landing(spark, f"{path}/*", misfits=True)


def src_csv_checked(spark, folder):
    """Columns bound by the headers' names, and the cells that did not fit."""
    read = plain(_broken_customers(spark, folder))
    return read.withColumn("misfits", F.array_join("misfits", ", "))


def src_csv_misfits(spark, folder):
    return sources.misfit_counts(_broken_customers(spark, folder))


def src_csv_typed(spark, folder):
    landing = frame(spark, folder, inputs.LANDING_CUSTOMERS)
    return plain(_csv_round_trip(spark, landing, sources.read_customers_landing))


def src_csv_infer(spark, folder):
    people = frame(spark, folder, inputs.PEOPLE)
    return _csv_round_trip(spark, people, sources.read_csv)


def src_csv_headerless(spark, folder):
    orders = frame(spark, folder, inputs.CUSTOMER_ORDERS)
    return _csv_round_trip(spark, orders, sources.read_customer_payments, header=False)


def src_csv_weather(spark, folder):
    readings = frame(spark, folder, inputs.READINGS)
    return plain(_csv_round_trip(spark, readings, sources.read_weather, header=False))


def src_csv_amounts(spark, folder):
    orders = frame(spark, folder, inputs.AMOUNTS)
    return plain(_csv_round_trip(spark, orders, sources.read_customer_amounts, header=False))


def src_csv_quoted(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    return _csv_round_trip(spark, parts, sources.read_node_names, header=False, sep=" ")


def _joined(df, separator, *columns):
    return df.select(F.concat_ws(separator, *columns).alias("value"))


def src_text_delimited(spark, folder):
    lines = _joined(table(spark, folder, "part"), "|", "p_partkey", "p_name", "p_brand")
    return _text_round_trip(spark, lines, sources.read_item_titles)


def src_text_ratings(spark, folder):
    ratings = frame(spark, folder, inputs.RATINGS)
    lines = _joined(ratings, "\t", "customer", "supplier", "rating", F.lit("881250949"))
    return _text_round_trip(spark, lines, sources.read_ratings)


def src_text_people(spark, folder):
    people = frame(spark, folder, inputs.PEOPLE)
    lines = _joined(people, ",", "id", "name", "age", "friends")
    return _text_round_trip(spark, lines, sources.read_people_lines)


def sink_parquet_readback(spark, folder):
    path = f"{scratch_folder(spark)}/part"
    return sinks.save_parquet(table(spark, folder, "part"), path)


def sink_table_readback(spark, folder):
    scratch = scratch_folder(spark)
    database = database_name(scratch)
    sinks.ensure_database(spark, database, f"{scratch}/tables")
    sinks.save_table(table(spark, folder, "part"), f"{database}.part")
    return sinks.read_back(spark, f"{database}.part", "p_partkey")


def sink_table_rows(spark, folder):
    """All rows of a written table."""
    scratch = scratch_folder(spark)
    database = database_name(scratch)
    sinks.ensure_database(spark, database, f"{scratch}/tables")
    return sinks.save_table(table(spark, folder, "part"), f"{database}.part")


def table_versions(spark, folder):
    """A table partitioned by brand, then replaced by one of other columns: both versions, as read."""
    scratch = scratch_folder(spark)
    database = database_name(scratch)
    sinks.ensure_database(spark, database, f"{scratch}/tables")
    part, name = table(spark, folder, "part"), f"{database}.part"
    sinks.save_table(part, name, partition_by=["p_brand"])
    first = spark.table(name)  # stays with its version
    sinks.save_table(part.where("p_size > 10").selectExpr("string(p_partkey) AS key", "p_brand", "p_size AS size"), name)
    first = first.selectExpr("1 AS version", "string(p_partkey) AS key", "p_brand", "p_size AS size")
    return first.unionByName(spark.table(name).withColumn("version", F.lit(2)))


def all_queries() -> dict[str, Query]:
    listed = [
        clean_orders,
        clean_products,
        clean_customers,
        clean_null_tokens,
        landing_tally,
        rejected_rules,
        dedup_by_key,
        distinct_keys,
        fk_valid_orders,
        sales_enriched,
        monthly_sales_summary,
        stored_sales_enriched,
        stored_fk_valid_orders,
        register_curated,
        registered_exports,
        curate_retail,
        curate_retail_traced,
        curated_sales,
        curated_monthly,
        pair_stats,
        item_similarity,
        item_similarity_dedup,
        similar_items_topk,
        similar_items_lookup,
        strong_similarities,
        item_title,
        graph_degree,
        min_degree_ties,
        word_count,
        word_lengths,
        error_words,
        people_select,
        people_filter,
        adults_sql,
        count_by_age,
        avg_friends_by_age,
        user_details,
        user_details_udf,
        customer_totals_sql,
        customer_totals_df,
        min_temp_by_station,
        num_square_prefix,
        num_filter_even,
        num_filter_above,
        num_filter,
        num_reduce,
        num_top,
        num_take_ordered,
        num_first,
        count_by_value,
        src_csv_strings,
        src_csv_checked,
        src_csv_misfits,
        src_csv_typed,
        src_csv_infer,
        src_csv_headerless,
        src_csv_weather,
        src_csv_amounts,
        src_csv_quoted,
        src_text_delimited,
        src_text_ratings,
        src_text_people,
        sink_parquet_readback,
        sink_table_readback,
        sink_table_rows,
        table_versions,
    ]
    named = {query.__name__: query for query in listed}
    return named | {name: _question(name) for name in plans.ANALYTICS}
