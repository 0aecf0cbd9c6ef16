"""Snapshots of tables and exports: never absent, whole, and left alone by writes that fail."""

import threading
import time

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from ledgerloom import sinks
import ledgerloom.sinks.snapshots as module
from workload import queries


@pytest.fixture
def database(spark, folder):
    name = queries.database_name(folder)
    sinks.ensure_database(spark, name, f"{folder}/tables")
    return name


def numbers(spark, n, **columns):
    return spark.range(n).withColumns({name: F.expr(sql) for name, sql in columns.items()})


def test_shuffle_files_of_a_write_are_gone_after_it(spark, folder):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {int(name.split("_")[1]) for name in names if name.startswith("shuffle_") and name.endswith(".data")}

    last = max(shuffles(), default=-1)
    sinks.save_parquet(numbers(spark, 1000).repartition(3, "id"), f"{folder}/dealt")
    until = time.time() + 20
    while (left := {n for n in shuffles() if n > last}) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_versions_follow_each_other(spark, folder):
    root = f"{folder}/root"
    first = sinks.write_snapshot(numbers(spark, 5), root)
    assert (first.version, first.rows, first.partition_by) == (1, 5, ())
    assert first.files >= 1 and first.bytes > 0
    old = sinks.read_snapshot(spark, root)
    second = sinks.write_snapshot(numbers(spark, 3, p="id % 2", name="string(id)"), root, ["p"])
    assert (second.version, second.rows, second.columns().names) == (2, 3, ["id", "name", "p"])
    assert rows(sinks.read_snapshot(spark, root)) == [(0, "0", 0), (1, "1", 1), (2, "2", 0)]
    assert rows(old) == rows(sinks.read_snapshot(spark, root, 1)) == [(n,) for n in range(5)]
    assert [one.version for one in sinks.list_snapshots(spark, root)] == [1, 2] and sinks.latest_snapshot(spark, root) == second
    with pytest.raises(FileNotFoundError):
        sinks.read_snapshot(spark, root, 3)
    with pytest.raises(FileNotFoundError):
        sinks.read_snapshot(spark, f"{folder}/none")


def test_replaced_versions_stay_for_the_stated_time(spark, folder):
    root = f"{folder}/root"
    for n in (1, 2, 3):
        sinks.write_snapshot(numbers(spark, n), root)
    assert sinks.expire_snapshots(spark, root, 3600) == []
    time.sleep(1.1)
    sinks.write_snapshot(numbers(spark, 4), root, keep=1)  # version 3 has only just been replaced
    assert [one.version for one in sinks.list_snapshots(spark, root)] == [3, 4]
    files = module._Files(spark, root)
    assert {f"data/{name}" for name in files.names("data")} == {one.folder for one in sinks.list_snapshots(spark, root)}
    assert rows(sinks.read_snapshot(spark, root, 3)) == [(0,), (1,), (2,)]


def test_files_of_abandoned_writes_go(spark, folder, monkeypatch):
    root = f"{folder}/root"
    sinks.write_snapshot(numbers(spark, 2), root)
    files = module._Files(spark, root)
    files.write("data/abandoned/part", "x")
    files.write("versions/.draft-1", "x")
    sinks.expire_snapshots(spark, root, 0)
    assert "abandoned" in files.names("data")  # it may still be written
    now = time.time
    monkeypatch.setattr(module.time, "time", lambda: now() + 2 * module.ABANDONED)
    sinks.expire_snapshots(spark, root, 0)
    assert len(files.names("data")) == 1 and list(files.names("versions")) == ["1"]
    assert rows(sinks.read_snapshot(spark, root)) == [(0,), (1,)]


class Killed(Exception):
    pass


def failing(spark, *_):
    return spark.range(0, 10, 1, 2).select(F.expr("IF(id = 9, raise_error('stop'), id)").cast("long").alias("id"))


# What is killed, and the rows that are read afterwards.
STEPS = {
    "the files": (None, 5),
    "before the manifest": ("_commit", 5),
    "the manifest": ("write", 5),
    "its name": ("rename_new", 5),
    "after the commit": ("expire_snapshots", 7),
}


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("kind", ["table", "partitions", "export"])
def test_a_write_killed_at_any_step(spark, folder, database, monkeypatch, kind, step):
    """What was there stays; after the commit the new version counts. The next write goes on."""
    what, left = STEPS[step]
    by = ["p"] if kind == "partitions" else []

    def save(df):
        if kind == "export":
            return sinks.save_parquet(df, f"{folder}/export")
        return sinks.save_table(df, f"{database}.numbers", partition_by=by)

    def read():
        if kind == "export":
            return sinks.read_snapshot(spark, f"{folder}/export")
        return spark.table(f"{database}.numbers")

    save(numbers(spark, 5, p="id % 2"))
    before = read()

    def killed(*_, **__):
        raise Killed

    with monkeypatch.context() as patch:
        if what in ("write", "rename_new"):
            patch.setattr(module._Files, what, killed)
        elif what:
            patch.setattr(module, what, killed)
        with pytest.raises(Exception, match="stop" if what is None else None):
            save(failing(spark).withColumn("p", F.lit(0)) if what is None else numbers(spark, 7, p="id % 3"))
    # a table's name is turned to the new version after the commit, by the next write or registration
    if kind != "export" and left == 7:
        assert read().count() == 5
        sinks.register_snapshot(spark, sinks.snapshot_root(spark, f"{database}.numbers"), f"{database}.numbers")
    assert read().count() == left and before.count() == 5
    save(numbers(spark, 3, other="'x'", p="id"))
    assert rows(read().select("id", "other")) == [(0, "x"), (1, "x"), (2, "x")]


def test_a_table_is_there_all_the_time(spark, database):
    """Partitioned and re-typed again and again, the name always shows one version whole."""
    table = f"{database}.numbers"
    sinks.save_table(numbers(spark, 10, p="id % 2"), table, partition_by=["p"])
    seen, stop = [], threading.Event()

    def watch():
        while not stop.is_set():
            try:
                seen.append(spark.table(table).count())
            except Exception as error:  # what a reader would have got
                seen.append(str(error)[:300])

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        for n in (20, 30, 40):
            kind = "string" if n == 30 else "int"
            sinks.save_table(numbers(spark, n, p="id % 3", v=f"{kind}(id)"), table, partition_by=["p"] if n < 40 else [])
    finally:
        stop.set()
        watcher.join()
    assert set(seen) <= {10, 20, 30, 40} and len(seen) > 3
    assert spark.table(table).count() == 40


def test_a_reader_keeps_the_version_it_began_with(spark, database):
    table = f"{database}.numbers"
    first = sinks.save_table(numbers(spark, 4), table)
    by_name = spark.table(table)
    sinks.save_table(numbers(spark, 2, other="id"), table)
    assert first.count() == by_name.count() == 4 and spark.table(table).count() == 2


def test_two_writers_do_not_mix(spark, database, folder):
    table = f"{database}.numbers"
    frames = {k: numbers(spark, 1000, writer=f"{k}").repartition(4) for k in range(4)}
    sinks.side_by_side(**{f"w{k}": lambda k=k: sinks.save_table(frames[k], table) for k in frames})
    there = spark.table(table).groupBy("writer").count().collect()
    assert len(there) == 1 and there[0]["count"] == 1000
    found = sinks.list_snapshots(spark, sinks.snapshot_root(spark, table))
    assert [one.version for one in found] == [1, 2, 3, 4] and len({one.folder for one in found}) == 4


def test_a_write_from_an_older_version_is_refused(spark, folder):
    root = f"{folder}/root"
    sinks.write_snapshot(numbers(spark, 1), root, made_from=0)
    made = sinks.read_snapshot(spark, root).unionByName(numbers(spark, 1))
    sinks.write_snapshot(numbers(spark, 9), root)
    with pytest.raises(sinks.VersionConflict):
        sinks.write_snapshot(made, root, made_from=1)
    assert sinks.read_snapshot(spark, root).count() == 9
    assert sinks.write_snapshot(made, root, made_from=2).version == 3


def test_a_table_of_the_old_kind_makes_room(spark, database):
    spark.sql(f"CREATE TABLE {database}.numbers (id int) USING parquet")
    sinks.save_table(numbers(spark, 3), f"{database}.numbers")
    assert spark.table(f"{database}.numbers").count() == 3


def test_expired_versions_leave_the_catalog(spark, database):
    table = f"{database}.numbers"
    for n in (1, 2, 3):
        time.sleep(0.1)
        sinks.save_table(numbers(spark, n), table, keep=0)
    names = [row.tableName for row in spark.sql(f"SHOW TABLES IN {database}").collect()]
    assert len(names) == 2 and "numbers" in names  # the name and the latest version
    assert spark.table(table).count() == 3


def test_registration_lasts_and_refreshes(spark, folder, database):
    """Another session of the catalog reads the names, and what was exported since after a refresh."""
    exports = {name: f"{folder}/exports/{name}" for name in ("one", "two")}
    for name, root in exports.items():
        sinks.save_parquet(numbers(spark, 2), root)
        sinks.register_snapshot(spark, root, f"{database}.{name}")
    other = spark.newSession()
    assert [other.table(f"{database}.{name}").count() for name in exports] == [2, 2]
    sinks.save_parquet(numbers(spark, 6, added="id"), exports["two"])
    assert other.table(f"{database}.two").count() == 2
    sinks.register_snapshot(other, exports["two"], f"{database}.two")
    assert rows(other.table(f"{database}.two").select("added")) == [(n,) for n in range(6)]


def test_bucketed_tables_are_joined_in_place(spark, database, setting):
    """Equal buckets on the key: no exchange of either side, also through the tables' names."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name, n in (("facts", 200), ("keys", 50)):
        sinks.save_table(numbers(spark, n, k=f"string(id % {n // 4 + 1})"), f"{database}.{name}", bucket_by=["k"], buckets=4)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    facts, keys = spark.table(f"{database}.facts"), spark.table(f"{database}.keys").withColumnRenamed("id", "other")
    joined, kept = facts.join(keys, "k"), facts.join(keys, "k", "left_semi")
    assert "Exchange" not in plan(joined) and "Exchange" not in plan(kept)
    plain = [spark.range(n).selectExpr(f"id AS {i}", f"string(id % {n // 4 + 1}) AS k") for n, i in ((200, "id"), (50, "other"))]
    assert rows(joined.select("k", "id", "other")) == rows(plain[0].join(plain[1], "k").select("k", "id", "other"))
    assert rows(kept.select("id")) == rows(plain[0].join(plain[1], "k", "left_semi").select("id"))
    with pytest.raises(ValueError):
        sinks.save_table(facts, f"{database}.facts", ["id"], ["k"], 4)


def test_whole_tables_come_back(spark, folder):
    orders = queries.table(spark, SMALL, "orders")
    assert rows(sinks.save_parquet(orders, f"{folder}/orders")) == rows(orders)
