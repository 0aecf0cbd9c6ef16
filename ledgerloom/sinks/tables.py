"""Table and Parquet sinks. A sink returns the written data, read back from storage.

Reading back cuts the lineage: whatever uses the result next, or is re-run after a lost
executor, starts from the files and sees the same rows in every copy.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession

from ledgerloom.sinks.snapshots import KEEP, Snapshot, latest_snapshot, list_snapshots, write_snapshot


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database if missing; ``location`` is the folder for its tables."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def save_table(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    keep: float = KEEP,
    metrics: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Create or replace ``table`` (``database.name``) as Parquet; the version that was written.

    The rows become the next version of a snapshot folder in the database's location. Then
    the catalog gets a table of that version, and ``table``, a view, is turned to it in one step: whatever
    the columns, partitions or buckets were before, the name is there at any time and shows one version
    whole. Tables that are bucketed by the key they are joined on, into as many buckets, are joined
    without a shuffle. The returned frame, and any frame taken before, stay with their version, whose
    files are kept for ``keep`` seconds after its replacement. The number of rows and further ``metrics``
    are taken as the rows are written, and kept in the version's manifest (``table_snapshot``).
    """
    spark = df.sparkSession
    root = snapshot_root(spark, table)
    written = write_snapshot(df, root, partition_by, keep, None, bucket_by, buckets, table, metrics)
    register_snapshot(spark, root, table, written)
    return spark.table(written.table(table))


def snapshot_root(spark: SparkSession, table: str) -> str:
    """The folder of ``table``'s versions. It is not the one that a managed table of the name would have."""
    database, name = table.rsplit(".", 1) if "." in table else ("default", table)
    home = spark.sql(f"DESCRIBE DATABASE {database}").where("info_name = 'Location'").first()[1]
    return f"{home.rstrip('/')}/{name}.versions"


def table_snapshot(spark: SparkSession, table: str) -> Snapshot:
    """The manifest of the latest version of ``table``."""
    found = latest_snapshot(spark, snapshot_root(spark, table))
    if found is None:
        raise FileNotFoundError(f"{table} has no version")
    return found


def _create_version(spark: SparkSession, root: str, table: str, version: Snapshot) -> None:
    """The catalog's table of one version, if it lacks."""
    name = version.table(table)
    if spark.catalog.tableExists(name):
        return

    def quoted(columns: Sequence[str]) -> str:
        return ", ".join(f"`{column}`" for column in columns)

    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in version.columns().fields)
    layout = f" PARTITIONED BY ({quoted(version.partition_by)})" if version.partition_by else ""
    if version.buckets:
        keys = quoted(version.bucket_by)
        layout += f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {version.buckets} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{layout} LOCATION '{version.location(root)}'")
    if version.partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def register_snapshot(spark: SparkSession, root: str, table: str, also: Snapshot | None = None) -> DataFrame:
    """Turn the catalog name ``table`` to the latest version below ``root``; run it again to refresh.

    The name lasts as the catalog does and is there for every session of it. Tables of versions that
    are gone are dropped; ``also`` is a version that gets a table though it may not be the latest.
    A table, not a view, of that name must be dropped to make room, once.
    """
    latest = latest_snapshot(spark, root)
    if latest is None:
        raise FileNotFoundError(f"no version below {root}")
    if also:
        _create_version(spark, root, table, also)
    while True:  # until no other write has committed meanwhile
        _create_version(spark, root, table, latest)
        if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
            spark.sql(f"DROP TABLE {table}")
        spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {latest.table(table)}")
        turned, latest = latest, latest_snapshot(spark, root)
        if latest == turned:
            break
    database, name = table.rsplit(".", 1) if "." in table else ("default", table)
    of_a_version = re.compile(re.escape(name.lower()) + "__[0-9a-f]{32}")
    # the tables first: one that is there, but without a manifest after that, is of no version
    shown = [row.tableName for row in spark.sql(f"SHOW TABLES IN {database} LIKE '{name}__*'").collect()]
    kept = {version.table(name).lower() for version in list_snapshots(spark, root)}
    for old in shown:
        if of_a_version.fullmatch(old) and old not in kept:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{old}")
    return spark.table(table)


def side_by_side(**writes: Callable[[], DataFrame]) -> dict[str, DataFrame]:
    """Run writes that do not depend on each other at once; their results by name.

    All end before this returns; the first failure is raised.
    """
    same_session = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(writes)) as pool:
        running = {name: pool.submit(same_session(write)) for name, write in writes.items()}
    return {name: task.result() for name, task in running.items()}


def save_parquet(df: DataFrame, path: str, keep: float = KEEP) -> DataFrame:
    """Export ``df`` as the next version of ``path``; the version that was written.

    The files go to a folder of their own. Readers find the latest complete one by its manifest
    (``read_snapshot``, or ``latest_snapshot(...).location(path)`` for others), so an export that fails
    leaves the earlier files as they were.
    """
    return write_snapshot(df, path, keep=keep).read(df.sparkSession, path)


def read_back(spark: SparkSession, table: str, order_by: str, rows: int = 10) -> DataFrame:
    """The first rows of a written table, in a stated order."""
    return spark.sql(f"SELECT * FROM {table} ORDER BY {order_by} LIMIT {int(rows)}")


def new_scratch_folder(spark: SparkSession) -> str:
    """A fresh folder under the one that ``spark.checkpoint.dir`` names, which executors share."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/ledgerloom-{uuid.uuid4().hex}"
