"""Names for frames, so SQL text can use them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sinks.tables import register_snapshot

# Curated table -> name used by the analytics SQL.
CURATED_VIEWS = {
    "orders": "orders_curated",
    "products": "products_curated",
    "customers": "customers_curated",
    "sales_enriched": "sales_enriched",
    "monthly_sales_summary": "monthly_sales_summary",
}


def register_exports(spark: SparkSession, folder: str, database: str) -> dict[str, DataFrame]:
    """Put the curated exports below ``folder`` under their analytics names into ``database``, to last.

    The names are there for every session of the catalog and show the versions that are the
    latest now; run this again to show later ones. The frames by table, as registered.
    """
    return {
        view: register_snapshot(spark, f"{folder.rstrip('/')}/{table}", f"{database}.{view}")
        for table, view in CURATED_VIEWS.items()
    }


def register_curated(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Register the curated frames under their analytics names and list those names."""
    for table, view in CURATED_VIEWS.items():
        tables[table].createOrReplaceTempView(view)
    listed = spark.sql("SHOW TABLES").where("isTemporary")
    ours = listed.where(F.col("tableName").isin(list(CURATED_VIEWS.values())))
    return ours.select(F.col("tableName").alias("table_name"))
