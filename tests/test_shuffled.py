"""What is moved: rows that do not count go before the joins, not after."""

from conftest import SMALL
from pyspark.sql import functions as F

from ledgerloom.operators import fk_valid
from workload import queries


def test_keys_are_tested_below_the_joins_of_the_fact(spark):
    plan = queries.fk_valid_orders(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2 and plan.index("Join Inner") < plan.index("LeftSemi")


def test_null_and_repeated_keys_of_either_side(spark):
    fact = spark.createDataFrame([(1, "7"), (2, "007"), (3, None), (4, "8")], "id int, k string")
    dimension = spark.createDataFrame([(7,), (7,), (None,)], "k int")
    assert fk_valid(fact, {"k": dimension}).collect() == [(1, "7")]
    assert fk_valid(fact, {"k": dimension.where(F.lit(False))}).count() == 0
    assert fk_valid(fact, {"k": fact.where("id > 2")}).collect() == [(4, "8")]  # of the fact's own frame
