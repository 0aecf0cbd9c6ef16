import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from workload.compare import local_session

    session = local_session("8", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True, scope="module")
def no_views_left(spark):
    """Views of a module's session are not listed in the databases of the next one."""
    yield
    for table in spark.catalog.listTables():
        if table.isTemporary:
            spark.catalog.dropTempView(table.name)


@pytest.fixture
def setting(spark):
    """Change session settings for one test: ``setting(key, value)``."""
    before = {}

    def change(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def folder(spark):
    from workload.queries import scratch_folder

    return scratch_folder(spark)


def rows(df):
    """The rows as a sorted list of tuples."""
    return sorted((tuple(row) for row in df.collect()), key=str)


def final_plan(df):
    """The plan Spark ran, after adaptive changes."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
