"""Graph, text, counts, numbers, in-memory rows."""

import re
from collections import Counter

from conftest import SMALL, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom import operators as ops
from ledgerloom.functions import details_text, details_udf, prefixed, round_half_up
from ledgerloom.sources import number_range, value_rows
from workload import queries

RELAXED = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def lines(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "value string")


def test_degree_adds_up_lines_and_skips_blank_ones(spark):
    graph = lines(spark, "1 2 3", " 1  4 ", "2", "", "  ", "x 1 2", "3\t1", None)
    assert rows(ops.graph_degree(graph)) == [(1, 3), (2, 0), (3, 1)]


def test_min_degree_keeps_ties_with_a_name(spark):
    names = spark.createDataFrame([(1, "one"), (2, "two"), (4, "four")], "id int, name string")
    graph = lines(spark, "1 5", "2 6", "3 1", "4 1 2", "")
    assert rows(ops.min_degree_ties(graph, names)) == [(1, "one", 1), (2, "two", 1)]


@RELAXED
@given(st.lists(st.text("aB_9 -éé,.\n", max_size=12), max_size=6))
def test_word_count_matches_python(spark, texts):
    words = Counter(
        word.lower() for text in texts for word in re.split(r"\W+", text, flags=re.ASCII) if word
    )
    counted = ops.word_count(lines(spark, *texts))
    assert {row.word: row["count"] for row in counted.collect()} == dict(words)


def test_word_count_is_ordered(spark):
    counted = ops.word_count(lines(spark, "b a, B c", "c... c"))
    assert [tuple(row) for row in counted.collect()] == [("c", 3), ("b", 2), ("a", 1)]


def test_word_lengths(spark):
    found = ops.word_lengths(lines(spark, "Hello World", "", " Apache  Spark "))
    assert rows(found) == [("Apache", 6), ("Hello", 5), ("Spark", 5), ("World", 5)]


def test_error_words(spark):
    log = lines(
        spark,
        "INFO: User logged in",
        "ERROR: Connection failed",
        "INFO: Data processed",
        "ERROR: Timeout occurred",
        "DEBUG: Cache hit",
    )
    expected = ["CONNECTION", "ERROR:", "ERROR:", "FAILED", "OCCURRED", "TIMEOUT"]
    assert [row[0] for row in rows(ops.level_words(log))] == expected


def test_colour_counts(spark):
    colours = value_rows(spark, "red blue red green blue red yellow".split(), "string")
    counts = {row.value: row["count"] for row in ops.count_by_value(colours, "value").collect()}
    assert counts == {"red": 3, "blue": 2, "green": 1, "yellow": 1}


def test_number_actions(spark):
    numbers = value_rows(spark, [10, 5, 8, 3, 15, 12, 7, 20, 1, 9], "int", partitions=4)
    assert numbers.rdd.getNumPartitions() == 4
    assert [row.value for row in ops.top(numbers, "value", 3).collect()] == [20, 15, 12]
    assert [row.value for row in ops.take_ordered(numbers, ["value"], 3).collect()] == [1, 3, 5]
    assert ops.take_ordered(numbers, ["value"], 1).first().value == 1
    assert rows(ops.reduce_numbers(numbers, "value")) == [(90, 20, 1, 90)]
    assert rows(ops.reduce_numbers(numbers.limit(0), "value")) == [(None, None, None, 0)]


def test_number_range_and_maps(spark):
    numbers = number_range(spark, 1, 100, partitions=4)
    assert numbers.rdd.getNumPartitions() == 4
    found = numbers.where("value <= 3").select(
        F.col("value") * F.col("value"), prefixed(F.col("value"), "num_")
    )
    assert rows(found) == [(1, "num_1"), (4, "num_2"), (9, "num_3")]
    both = number_range(spark, 1, 10).where((F.col("value") % 2 == 0) & (F.col("value") > 5))
    assert rows(both) == [(10,), (6,), (8,)]


def test_details_builtin_and_user_function_agree(spark):
    people = spark.createDataFrame([("Will", 33), (None, None)], "name string, age int")
    expected = ["Name: None, Age: None", "Name: Will, Age: 33"]
    builtin = people.select(details_text(F.col("name"), F.col("age")))
    arrow = people.select(details_udf("name", F.col("age").cast("string")))
    assert [row[0] for row in rows(builtin)] == expected
    assert [row[0] for row in rows(arrow)] == expected


def test_grouped_totals(spark):
    df = spark.createDataFrame(
        [("a", 1.006), ("b", 2.0), ("a", 1.0), ("c", 2.0)], "k string, v double"
    )
    assert [tuple(row) for row in ops.total_by(df, "k", "v").collect()] == [
        ("a", 2.01),
        ("b", 2.0),
        ("c", 2.0),
    ]
    averages = ops.average_by(df, "k", "v", "mean")
    assert [tuple(row) for row in averages.collect()] == [("a", 1.0), ("b", 2.0), ("c", 2.0)]
    assert [tuple(row) for row in ops.count_by(df, "k").collect()] == [("a", 2), ("b", 1), ("c", 1)]


def test_minimum_of_one_kind(spark):
    weather = spark.createDataFrame(
        [("s1", "TMIN", -5.0), ("s1", "TMAX", -9.0), ("s2", "TMIN", -7.5), ("s1", "TMIN", -6.0)],
        "station string, kind string, degrees float",
    )
    coldest = ops.min_by_key(weather, "station", "kind", "degrees", "TMIN", "coldest")
    assert [tuple(row) for row in coldest.collect()] == [("s2", -7.5), ("s1", -6.0)]


def test_adults_and_totals_in_sql(spark):
    people = spark.createDataFrame([("a", 17), ("b", 18)], "name string, age int")
    assert rows(ops.adults_sql(people)) == [("b", 18)]
    orders = spark.createDataFrame([("1", 2.5), ("2", 1.0), ("1", 2.5)], "customer_id string, order_price double")
    assert [tuple(row) for row in ops.customer_totals_sql(orders).collect()] == [("1", 5.0), ("2", 1.0)]


def test_half_up(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (0.1249,)], "v double")
    found = [row[0] for row in df.select(round_half_up(F.col("v"))).collect()]
    assert found == [1.01, 2.68, -1.01, 0.12]


def test_counts_add_up(spark):
    people = queries.count_by_age(spark, SMALL).agg(F.sum("count")).first()[0]
    assert people == spark.read.parquet(f"{SMALL}/customer.parquet").count()


def test_averages_without_decimal_reading_stay(spark):
    values = [("a", 1e31), ("b", float("nan")), ("c", float("inf")), ("d", None)]
    found = dict(map(tuple, ops.average_by(spark.createDataFrame(values, "k string, v double"), "k", "v", "mean").collect()))
    assert (found["a"], found["c"], found["d"]) == (1e31, float("inf"), None) and found["b"] != found["b"]


def test_words_part_at_every_blank(spark):
    text = "a b c d　\u0085e\x1ff\tg"
    lines = spark.createDataFrame([(text,)], "value string")
    assert [row.word for row in ops.word_lengths(lines).collect()] == text.split()
