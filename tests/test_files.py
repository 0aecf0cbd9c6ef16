"""CSV and text readers on files written by hand."""

import datetime
import gzip

import pytest
from conftest import rows

from ledgerloom import sources
from ledgerloom.sinks import save_parquet


def written(tmp_path, text):
    path = tmp_path / "input.txt"
    path.write_text(text)
    return f"file://{path}"


def test_orders_landing_is_all_text(spark, tmp_path):
    path = written(tmp_path, "order_id,customer_id\n 1 ,x,P1,,,2,\"$1,5\",,,,\n")
    found = sources.read_csv(spark, path, sources.schemas.ORDERS_LANDING)  # by position
    assert {kind for _, kind in found.dtypes} == {"string"}
    assert rows(found) == [(" 1 ", "x", "P1", None, None, "2", "$1,5", None, None, None, None)]


def test_customers_landing_turns_misfits_into_null(spark, tmp_path):
    path = written(tmp_path, "h\n7,A,B,a@b.co,1,2024-01-05,C,S,1,true,5\nx,A,B,e,p,never,C,S,1,maybe,many\n")
    found = sources.read_csv(spark, path, sources.schemas.CUSTOMERS_LANDING).select(  # by position
        "customer_id", "signup_date", "is_active", "loyalty_points"
    )
    assert rows(found) == [(7, datetime.date(2024, 1, 5), True, 5), (None, None, None, None)]


def test_inferred_types(spark, tmp_path):
    path = written(tmp_path, "id,name,age\n1,Will,33\n2,Jean,26\n")
    found = sources.read_csv(spark, path)
    assert found.dtypes == [("id", "int"), ("name", "string"), ("age", "int")]
    assert rows(found) == [(1, "Will", 33), (2, "Jean", 26)]


def test_headerless_typed_files(spark, tmp_path):
    weather = written(tmp_path, "ITE1,18000101,TMIN,-148\n")
    assert rows(sources.read_weather(spark, weather)) == [("ITE1", 18000101, "TMIN", -148.0)]
    orders = written(tmp_path, "44,8602,37.5\n")
    assert rows(sources.read_customer_payments(spark, orders)) == [("44", "8602", 37.5)]
    assert rows(sources.read_customer_amounts(spark, orders)) == [(44, 8602, 37.5)]


def test_names_need_quotes_to_keep_their_blanks(spark, tmp_path):
    path = written(tmp_path, '1 "24-HOUR MAN"\n2 ABYSS deep\n')
    assert rows(sources.read_node_names(spark, path)) == [(1, "24-HOUR MAN"), (2, "ABYSS")]


def test_lines_keep_the_empty_ones(spark, tmp_path):
    assert rows(sources.read_lines(spark, written(tmp_path, "a\n\nb\n"))) == [("",), ("a",), ("b",)]


def test_delimited_text(spark, tmp_path):
    items = written(tmp_path, "1|Toy Story|x\nbad|No id|x\n3\n")
    assert rows(sources.read_item_titles(spark, items)) == [(1, "Toy Story")]
    ratings = written(tmp_path, "196\t242\t3\t881250949\n1\t2\t\t5\n7\t8\t2.5\n")
    assert rows(sources.read_ratings(spark, ratings)) == [
        (196, 242, 3.0, 881250949),
        (7, 8, 2.5, None),
    ]
    people = written(tmp_path, "0,Will,33,385\n")
    assert rows(sources.read_people_lines(spark, people)) == [(0, "Will", 33, 385)]


def test_parquet_copy_is_what_was_written(spark, folder):
    df = spark.createDataFrame([(1, "a"), (None, None)], "n int, t string")
    first = save_parquet(df, f"{folder}/copy")
    assert rows(first) == rows(df)
    assert rows(save_parquet(df.limit(0), f"{folder}/copy")) == []


SHORT = "id INT, day DATE, name STRING"


def by_name(spark, tmp_path, **options):
    return sources.read_csv_by_name(spark, f"file://{tmp_path}", SHORT, **options)


def test_columns_are_bound_by_the_names_of_each_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,day,name\n1,2024-01-05,x\n")
    (tmp_path / "b.csv").write_text('\ufeffname, extra ,day,"id"\n"y, z",9,2024-01-06,2\n')
    (tmp_path / "c.csv.gz").write_bytes(gzip.compress(b"day,id,name,more,more\n,3,,1,2\n"))
    (tmp_path / "none.csv").write_text("")
    (tmp_path / "header.csv").write_text("id,day,name\n")
    d = datetime.date
    assert rows(by_name(spark, tmp_path)) == [(1, d(2024, 1, 5), "x"), (2, d(2024, 1, 6), "y, z"), (3, None, None)]
    assert rows(by_name(spark, tmp_path, misfits=True).select("id", "misfits")) == [(1, []), (2, []), (3, [])]


@pytest.mark.parametrize("header, lacking", [("id,name", "day"), ("id,day,Name", "name"), ("id,day,name,id", "id"), ("h", "id, day, name")])
def test_a_column_that_lacks_is_named(spark, tmp_path, header, lacking):
    (tmp_path / "good.csv").write_text("id,day,name\n1,2024-01-05,x\n")
    (tmp_path / "odd.csv").write_text(f"{header}\n1\n")
    with pytest.raises(ValueError, match=f"^{lacking} not once in the header of .*odd.csv"):
        by_name(spark, tmp_path)


def test_cells_that_do_not_fit_are_listed_and_counted(spark, tmp_path):
    lines = ["name,id,day", "a,1,2024-01-05", "b,x,2024-13-45", "c,2.5,", ",,", "d,4", "e,5,2024-01-05,more", '"f, q",7,never']
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    read = by_name(spark, tmp_path, misfits=True)
    found = {row.name: (row.id, row.misfits) for row in read.collect()}
    assert found["a"] == (1, []) and found[None] == (None, [])
    assert found["b"] == (None, ["id: x", "day: 2024-13-45"]) and found["c"] == (None, ["id: 2.5"])
    assert found["d"] == (4, ["row: d,4"]) and found["e"][1] == ["row: e,5,2024-01-05,more"]
    assert found["f, q"] == (7, ["day: never"])
    assert dict(rows(sources.misfit_counts(read))) == {"id": 2, "day": 2, "row": 2}
    assert rows(read.select("id")) == rows(by_name(spark, tmp_path).select("id"))


def test_a_folder_without_rows(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    empty = by_name(spark, tmp_path, misfits=True)
    assert empty.collect() == [] and empty.dtypes[-1] == ("misfits", "array<string>")
    assert by_name(spark, tmp_path).dtypes == [("id", "int"), ("day", "date"), ("name", "string")]
