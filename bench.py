"""Time the registered queries; prints one JSON line.

Settings come from the environment: ``BENCH_SF_DIR`` (data folder), ``BENCH_CPUS`` (cores),
``BENCH_RUNS`` (timed runs per query, the median counts) and ``BENCH_QUERIES`` (a comma list;
``all`` for every registered one; default ``HEADLINE``). Each query runs whole into the
``noop`` sink after one untimed warm-up.

Settings are Spark's defaults, as a user has them. The reports read curated tables that are saved
once per session, in their untimed warm-up; what the saving takes is the entry ``save_curated``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from workload.compare import local_session  # noqa: E402
from workload.queries import all_queries, save_curated  # noqa: E402

HEADLINE = """
clean_orders clean_products clean_customers dedup_by_key distinct_keys fk_valid_orders
sales_enriched monthly_sales_summary top_products revenue_by_category_month customer_ltv
discount_by_payment return_rates row_count_validation register_curated curate_retail
curated_sales curated_monthly pair_stats item_similarity similar_items_lookup
graph_degree min_degree_ties word_count count_by_age avg_friends_by_age customer_totals_sql
customer_totals_df min_temp_by_station user_details num_reduce num_top src_csv_strings
src_text_ratings
""".split()


def saving(spark, folder: str) -> float:
    """Seconds that the saving of the curated tables takes."""
    started = time.perf_counter()
    save_curated(spark, folder)
    return time.perf_counter() - started


def timed(query, spark, folder: str) -> float:
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    queries = all_queries()
    if chosen == "all":
        names = list(queries)
    else:
        names = [name for name in chosen.split(",") if name] or HEADLINE

    spark = local_session(cores, cores)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    if "top_products" in names:
        saving(spark, folder)
        seconds["save_curated"] = round(statistics.median(saving(spark, folder) for _ in range(runs)), 3)
        print(f"save_curated: {seconds['save_curated']}", file=sys.stderr, flush=True)
    for name in names:
        timed(queries[name], spark, folder)
        taken = [timed(queries[name], spark, folder) for _ in range(runs)]
        seconds[name] = round(statistics.median(taken), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
