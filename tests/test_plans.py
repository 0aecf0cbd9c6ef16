"""The plans Spark chooses: pruning, pushdown, map-side combining, reuse, skew, code size."""

import contextlib
import io
import re

import pytest
from conftest import SMALL, final_plan, rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom import operators as ops
from ledgerloom import plans, sinks, sources
from ledgerloom.operators.similarity import _spread_heavy_users
from workload import inputs, queries

JIT_LIMIT = 8000  # bytecodes; the JVM does not compile larger methods


def plan_text(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain("formatted")
    return out.getvalue()


def method_sizes(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain("codegen")
    return [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]


def test_scan_reads_only_the_columns_it_needs(spark):
    assert "ReadSchema: struct<c_name:string,c_nationkey:int>" in plan_text(
        queries.people_select(spark, SMALL)
    )
    enriched = plan_text(queries.sales_enriched(spark, SMALL).select("product_id", "net_amount"))
    assert "o_totalprice" not in enriched and "c_acctbal" not in enriched


def test_filter_reaches_the_scan(spark):
    found = plan_text(queries.min_temp_by_station(spark, SMALL))
    assert "EqualTo(event_type,view)" in found
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in found


def test_top_k_keeps_k_rows_per_task(spark):
    for key in ("top_products", "customer_ltv", "num_top", "num_take_ordered"):
        found = plan_text(queries.all_queries()[key](spark, SMALL))
        assert "TakeOrderedAndProject" in found, key


REPORTS = ["top_products", "customer_ltv", "discount_by_payment", "return_rates", "row_count_validation"]


@pytest.mark.parametrize("key", [*REPORTS, "revenue_by_category_month"])
def test_reports_read_saved_tables(spark, key):
    found = plan_text(queries.all_queries()[key](spark, SMALL))
    assert "Join" not in found and "lineitem" not in found
    if key == "revenue_by_category_month":
        assert "Aggregate" not in found


def test_summary_of_unique_orders_shuffles_groups_only(spark):
    sales = queries.save_curated(spark, SMALL)["sales_enriched"]
    assert plan_text(plans.monthly_sales_summary(sales)).count("Exchange") > plan_text(
        plans.monthly_sales_summary(sales, unique_orders=True)
    ).count("Exchange")


def test_stored_similarities_prune_on_lookup(spark, folder, setting):
    setting("spark.sql.shuffle.partitions", "16")
    setting("spark.sql.adaptive.enabled", "false")
    pairs = spark.range(0, 40000).selectExpr("id % 200 AS item1", "200 + id % 199 AS item2", "1.0D AS score", "20L AS num_pairs")
    stored = ops.save_similarities(pairs, f"{folder}/similarities")
    titles = spark.createDataFrame([], "item long, title string")
    found = ops.similar_items_stored(stored, titles, 7, 0.5, 1, 5)
    assert "EqualTo(item1,7)" in plan_text(found)
    files = stored.where("item1 = 7").select(F.input_file_name()).distinct().count()
    assert files == 1 and stored.select(F.input_file_name()).distinct().count() > 8
    expected = ops.similar_items_topk(pairs, titles, 7, 0.5, 1, 5)
    assert rows(found) == rows(expected)


def test_dedup_combines_before_the_shuffle(spark):
    found = plan_text(queries.dedup_by_key(spark, SMALL))
    assert found.count("+- Exchange") == 1
    assert "partial_min" in found


def test_hot_duplicate_key_sends_one_row_per_task(spark):
    """30,000 copies of one key in 6 tasks: the shuffle carries 6 rows of it, not 30,000."""
    copies = spark.range(0, 30000, 1, 6).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    df = ops.dedup_by_key(copies, ["k"])
    assert rows(df) == [(1, 0)]
    exchanges = [node for node in _nodes(df) if "ShuffleExchange" in node.getClass().getName()]
    written = [_metric(node, "shuffleRecordsWritten") for node in exchanges]
    assert written == [6]


def _nodes(df):
    def walk(node):
        yield node
        inner = None
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            inner = node.executedPlan()
        elif name.endswith("QueryStageExec"):
            inner = node.plan()
        if inner is not None:
            yield from walk(inner)
        children = node.children()
        for place in range(children.size()):
            yield from walk(children.apply(place))

    return walk(df._jdf.queryExecution().executedPlan())


def _metric(node, name):
    return node.metrics().apply(name).value()


def test_cleaning_filters_the_key_before_the_shuffle(spark):
    landing = spark.createDataFrame([], sources.schemas.ORDERS_LANDING)
    found = plan_text(plans.clean_orders(landing)).split("== Physical Plan ==")[1]
    tree = found.split("\n\n")[0]
    assert tree.count("Filter") == 2  # usable key below the exchange, required values above
    assert tree.rindex("Filter") > tree.rindex("Exchange") > tree.index("Filter")


@pytest.mark.parametrize("name", ["orders", "products", "customers"])
def test_cleaning_code_stays_under_the_jit_limit(spark, setting, tmp_path, name):
    setting("spark.sql.adaptive.enabled", "false")
    names = StructType.fromDDL(getattr(sources.schemas, f"{name.upper()}_LANDING")).names
    (tmp_path / "empty.csv").write_text(",".join(names) + "\n")
    landing = getattr(sources, f"read_{name}_landing")(spark, f"file://{tmp_path}")
    sizes = method_sizes(getattr(plans, f"clean_{name}")(landing))
    assert sizes and max(sizes) < JIT_LIMIT


WRITERS = ("src_", "sink_", "curate_", "similar_items_topk", "stored_", "table_", "registered_")


@pytest.mark.parametrize(
    "key", sorted(key for key in queries.all_queries() if not key.startswith(WRITERS))
)
def test_registered_code_stays_under_the_jit_limit(spark, setting, key):
    setting("spark.sql.adaptive.enabled", "false")
    sizes = method_sizes(queries.all_queries()[key](spark, SMALL))
    assert all(size < JIT_LIMIT for size in sizes)


def test_dimension_is_broadcast_only_within_the_size_limit(spark, setting):
    small = final_plan(queries.fk_valid_orders(spark, SMALL))
    assert "BroadcastHashJoin" in small and "LeftSemi" in small
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    large = final_plan(queries.fk_valid_orders(spark, SMALL))
    assert "SortMergeJoin" in large and "LeftSemi" in large and "Broadcast" not in large


def test_no_join_is_forced_or_crossed(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    for key in ("sales_enriched", "item_similarity", "similar_items_lookup", "min_degree_ties"):
        found = plan_text(queries.all_queries()[key](spark, SMALL))
        assert "Broadcast" not in found.replace("autoBroadcast", ""), key
        assert "CartesianProduct" not in found and "NestedLoop" not in found, key


def _hot_sales(spark):
    """Orders of which every third has the same customer and the same product."""
    orders = spark.range(0, 60000, 1, 8).select(
        F.col("id").cast("string").alias("order_id"),
        F.expr("CAST(CASE WHEN id % 3 = 0 THEN 1 ELSE id % 997 END AS STRING)").alias("customer_id"),
        F.expr("concat('P', CASE WHEN id % 3 = 1 THEN 1 ELSE id % 499 END)").alias("product_id"),
        F.expr("DATE'2024-01-01'").alias("order_date"),
        F.expr("DATE'2024-01-02'").alias("ship_date"),
        F.expr("CAST(1 + id % 5 AS INT)").alias("quantity"),
        F.expr("CAST(id % 100 AS DECIMAL(18,4))").alias("unit_price"),
        F.expr("CAST(id % 10 AS DECIMAL(7,4))").alias("discount_pct"),
        F.expr("CAST(id AS DECIMAL(18,4))").alias("total_amount"),
        F.lit("Card").alias("payment_method"),
        F.lit("Completed").alias("order_status"),
    )
    customers = spark.range(997).select(
        F.col("id").cast("int").alias("customer_id"),
        *[F.lit("x").alias(c) for c in ("first_name", "last_name", "email", "country", "state")],
    )
    products = spark.range(499).select(
        F.expr("concat('P', id)").alias("product_id"),
        *[F.lit("y").alias(c) for c in ("product_name", "category", "brand")],
    )
    return orders, customers, products


@pytest.mark.parametrize("job", [plans.sales_enriched, plans.fk_valid_orders])
def test_hot_keys_are_split_over_tasks(spark, setting, job):
    whole = rows(job(*_hot_sales(spark)).select("order_id"))
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.shuffle.partitions", "16")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "50KB")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50KB")
    split = job(*_hot_sales(spark))
    assert final_plan(split).count("(skew=true)") == 2
    assert rows(split.select("order_id")) == whole


def _stored_sales(spark, folder, **hot):
    database = queries.database_name(folder)
    sinks.ensure_database(spark, database, f"{folder}/tables")
    orders, customers, products = queries.retail_frames(spark, SMALL)
    orders = orders.withColumns({name: F.expr(sql) for name, sql in hot.items()})
    stored = plans.store_co_located(spark, database, orders, customers, products, 8)
    return (orders, customers, products), (stored["orders"], stored["customers"], stored["products"])


@pytest.mark.parametrize("job", [plans.sales_enriched, plans.fk_valid_orders])
def test_stored_orders_stay_in_place(spark, folder, setting, job):
    """Orders and customers are joined bucket by bucket: only the products, which are small, move."""
    loose, stored = _stored_sales(spark, folder)
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    joined = job(stored[0], stored[1], F.broadcast(stored[2]))
    found = final_plan(joined)
    assert "SortMergeJoin" in found and "Bucketed: true" in found
    assert not re.search(r"(?<!Broadcast)Exchange hashpartitioning", found)
    assert rows(joined.select("order_id")) == rows(job(*loose).select("order_id"))


def test_orders_of_a_hot_customer_are_not_bucketed(spark, folder, setting):
    """A third of the orders are one customer's: a bucket of them would be one task's."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    loose, stored = _stored_sales(spark, folder, customer_id="IF(CAST(order_id AS INT) % 10 < 8, '7', customer_id)")
    joined = plans.sales_enriched(*stored)
    assert "Bucketed: true" not in final_plan(joined)
    assert rows(joined.select("order_id", "net_amount")) == rows(plans.sales_enriched(*loose).select("order_id", "net_amount"))


def test_smallest_degree_reads_the_lines_once(spark):
    """Of the main query and its subquery, one scans the lines and the other reuses the shuffle."""
    df = queries.min_degree_ties(spark, SMALL)
    subquery = final_plan(df)  # printed first, up to its own initial plan
    main_scans = [node for node in _nodes(df) if "FileSourceScan" in node.getClass().getName()]
    scans = subquery.count("FileScan") + sum("l_suppkey" in node.toString() for node in main_scans)
    assert scans == 1
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_similarity_reads_and_shuffles_the_ratings_once(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    found = final_plan(queries.item_similarity(spark, SMALL))
    scans = [line for line in found.split("\n") if "FileScan" in line and "l_suppkey" in line]
    assert len(scans) == 1
    assert found.count("ReusedExchange") >= 2
    assert "partial_sum" in found


def test_heavy_user_is_dealt_into_bounded_cells(spark):
    """One user with 5,000 items among 200 ordinary ones: no cell holds more than ~2 blocks."""
    heavy = spark.range(5000).select(F.lit(0).alias("user"), F.col("id").alias("item"))
    light = spark.range(2000).select(
        (1 + F.col("id") % 200).cast("int").alias("user"), F.col("id").alias("item")
    )
    moments = heavy.union(light).selectExpr("*", "1L AS n", "1.0D AS s", "1.0D AS ss")
    cells = _spread_heavy_users(moments, 500).groupBy("user", "low", "high").count()
    assert cells.where("user = 0").count() == 55
    assert cells.where("user = 0").agg(F.max("count")).first()[0] < 1300
    assert cells.where("user > 0 AND (low > 0 OR high > 0)").count() == 0


def test_cells_stay_bounded_for_any_number_of_items(spark):
    """600,000 items of one user: blocks of about 1,000, counted without forming a cell or a pair."""
    moments = spark.range(600000).selectExpr("0 AS user", "id AS item", "1L AS n", "1.0D AS s", "1.0D AS ss")
    dealt = _spread_heavy_users(moments, 1000)
    blocks = dealt.where("low = block AND high = block").groupBy("block").count()
    largest, number = blocks.agg(F.max("count"), F.count("*")).first()
    assert number == 600 and largest < 1300


def test_lookup_does_not_form_pairs_of_other_items(spark):
    """A user with 20,000 items costs 20,000 joined rows, not 200 million pairs."""
    one_user = spark.range(20000).selectExpr("1 AS u", "id AS i", "1.0D AS r")
    titles = spark.createDataFrame([], "item long, title string")
    found = ops.similar_items_lookup(one_user, titles, 5, "u", "i", "r", 0.5, 0, 3)
    assert [row.similar_item for row in found.collect()] == [0, 1, 2]


def test_landing_inputs_name_only_given_tables():
    texts = [value for name, value in vars(inputs).items() if name.isupper() and name != "TABLES"]
    names = {name for text in texts for name in re.findall(r"\{(\w+)\}", text)}
    assert names <= set(inputs.TABLES)


def test_pairs_of_neighbouring_users_fold_before_the_shuffle(spark, setting):
    """Groups of users that rate their group's items: few rows for each pair travel, not one per task."""
    setting("spark.sql.shuffle.partitions", "16")
    setting("spark.sql.adaptive.enabled", "false")
    ratings = spark.sql("SELECT u.id AS u, 10 * (u.id DIV 40) + i.id AS i, 1.0D AS r FROM range(1280) AS u, range(10) AS i")
    found = ops.pair_stats(ratings, "u", "i", "r")
    assert [row.num_pairs for row in found.collect()] == [40] * (32 * 45)
    exchanges = [node for node in _nodes(found) if "ShuffleExchange" in node.getClass().getName()]
    pairs = [_metric(node, "shuffleRecordsWritten") for node in exchanges if "hashpartitioning(item1" in node.toString()]
    assert len(pairs) == 1 and 32 * 45 <= pairs[0] < 2 * 32 * 45


def test_ratings_move_once_on_the_way_to_their_pairs(spark, setting):
    """Beside the ratings themselves only counts of users and folded pairs are shuffled."""
    setting("spark.sql.adaptive.enabled", "false")
    setting("spark.sql.shuffle.partitions", "4")
    ratings = spark.sql("SELECT u.id AS u, 10 * (u.id DIV 40) + i.id AS i, 1.0D AS r FROM range(1280) AS u, range(10) AS i")
    found = ops.pair_stats(ratings, "u", "i", "r")
    assert len(found.collect()) == 32 * 45
    exchanges = [node for node in _nodes(found) if "ShuffleExchange" in node.getClass().getName()]
    moved = sum(_metric(node, "shuffleRecordsWritten") for node in exchanges if "item1" not in node.toString().split("\n")[0])
    assert 12800 <= moved <= 12800 + 4 * 1280


def test_strong_pairs_of_neighbouring_users_fold_before_the_shuffle(spark, setting):
    setting("spark.sql.shuffle.partitions", "16")
    setting("spark.sql.adaptive.enabled", "false")
    ratings = spark.sql("SELECT u.id AS u, 10 * (u.id DIV 40) + i.id AS i, 1.0D AS r FROM range(1280) AS u, range(10) AS i")
    found = ops.strong_candidates(ratings, "u", "i", "r")
    assert len(found.collect()) == 32 * 45
    exchanges = [node for node in _nodes(found) if "ShuffleExchange" in node.getClass().getName()]
    pairs = [_metric(node, "shuffleRecordsWritten") for node in exchanges if "hashpartitioning(item1" in node.toString()]
    assert len(pairs) == 1 and 32 * 45 <= pairs[0] < 2 * 32 * 45


def test_landing_and_written_files_are_small(spark, folder, monkeypatch):
    """Landing files are compressed, and tables by a codec that takes less disk."""
    monkeypatch.setattr(queries, "scratch_folder", lambda spark: folder)
    landed, curated, _ = queries._curated(spark, SMALL)
    assert all(file.endswith(".csv.gz") for df in landed.values() for file in df.inputFiles())
    assert all(".zstd.parquet" in file for df in curated.values() for file in df.inputFiles())


def test_saved_sales_come_out_of_the_saved_tables(spark, monkeypatch):
    """The lines and their orders are joined once, for the orders table."""
    seen, enriched = [], plans.sales_enriched
    monkeypatch.setattr(plans, "sales_enriched", lambda *frames: seen.extend(frames) or enriched(*frames))
    queries.save_curated(spark, SMALL)
    assert len(seen) == 3 and not [file for df in seen for file in df.inputFiles() if SMALL in file]
