"""Readers for CSV and delimited text. Spark splits the files over tasks.

All are lazy but ``read_csv`` without a schema, which runs a job to infer one, and the readers that
bind columns by name, which look at the first line of each file.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom.functions.text import COMMA, PIPE, TAB
from ledgerloom.operators.relational import require
from ledgerloom.sources import schemas


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    header: bool = True,
    sep: str = ",",
    quote: str = '"',
) -> DataFrame:
    """CSV with a given schema (DDL text or ``StructType``), columns bound by position.

    A cell that does not fit its type becomes null. Without a schema the types are inferred,
    which reads the input once more; give a schema for large inputs.
    """
    reader = spark.read.option("header", header).option("sep", sep).option("quote", quote)
    reader = reader.option("mode", "PERMISSIVE")
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


MISFITS = "misfits"
_RECORD = "_record"


def header_names(spark: SparkSession, path: str, sep: str = ",", quote: str = '"') -> dict[tuple[str, ...], list[str]]:
    """The files at ``path`` by the names in their first line; files without one hold no rows and are left out.

    Only the first line of each file is read, in the driver, many files at once.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(file: str) -> str | None:
        where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        stream, codec = where.getFileSystem(conf).open(where), codecs.getCodec(where)
        try:
            plain = codec.createInputStream(stream) if codec else stream
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
        finally:
            stream.close()

    files = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(first_line, files))
    found = defaultdict(list)
    for file, line in zip(files, lines):
        if line:
            names = next(csv.reader([line.removeprefix("\ufeff")], delimiter=sep, quotechar=quote))
            found[tuple(name.strip() for name in names)].append(file)
    return dict(found)


def read_csv_by_name(
    spark: SparkSession, path: str, schema: str | StructType, sep: str = ",", quote: str = '"', misfits: bool = False
) -> DataFrame:
    """CSV with a header, columns bound to ``schema`` by the header's names, whatever their order.

    Each file is bound by its own header; further columns are left out, a missing or repeated one raises
    ``ValueError`` with its name. A cell that does not fit its type is null. With ``misfits`` an array
    column of that name lists such cells as ``column: text`` (``misfit_counts`` counts them), and a row
    with too few or too many cells as ``row: line``.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    types = {field.name: field for field in wanted.fields}
    parts = []
    for names, files in sorted(header_names(spark, path, sep, quote).items()):
        lacking = [name for name in types if names.count(name) != 1]
        if lacking:
            raise ValueError(f"{', '.join(lacking)} not once in the header of {files[0]}")
        # columns that are not wanted get a name of their own, in case they come twice
        fields = [types.get(name) or StructField(f"_other{i}", StringType()) for i, name in enumerate(names)]
        reader = spark.read.option("header", True).option("sep", sep).option("quote", quote).option("mode", "PERMISSIVE")
        if not misfits:
            parts.append(reader.schema(StructType(fields)).csv(files).select(*types))
            continue
        reader = reader.option("columnNameOfCorruptRecord", _RECORD).option("columnPruning", False)
        typed = reader.schema(StructType([*fields, StructField(_RECORD, StringType())])).csv(files)
        texts = ", ".join(f"`{field.name}` STRING" for field in fields)
        cells = F.from_csv(F.col(_RECORD), texts, {"sep": sep, "quote": quote})
        each = [
            F.when(cells[name].isNotNull() & F.col(name).isNull(), F.concat(F.lit(f"{name}: "), cells[name]))
            for name in types
        ]
        found = F.array_compact(F.array(*each))
        listed = F.when(F.size(found) == 0, F.array(F.concat(F.lit("row: "), F.col(_RECORD)))).otherwise(found)
        none = F.array().cast("array<string>")
        parts.append(typed.select(*types, F.when(F.col(_RECORD).isNull(), none).otherwise(listed).alias(MISFITS)))
    if not parts:
        extra = [StructField(MISFITS, wanted.fromDDL("a array<string>")["a"].dataType)] if misfits else []
        return spark.createDataFrame([], StructType([*wanted.fields, *extra]))
    return reduce(DataFrame.unionByName, parts)


def misfit_counts(df: DataFrame) -> DataFrame:
    """``(column, cells)``: how many cells of each column did not fit, out of ``misfits``."""
    each = df.select(F.explode(MISFITS).alias("cell"))
    return each.groupBy(F.substring_index("cell", ": ", 1).alias("column")).agg(F.count(F.lit(1)).alias("cells"))


def read_orders_landing(spark: SparkSession, path: str, misfits: bool = False) -> DataFrame:
    return read_csv_by_name(spark, path, schemas.ORDERS_LANDING, misfits=misfits)


def read_products_landing(spark: SparkSession, path: str, misfits: bool = False) -> DataFrame:
    return read_csv_by_name(spark, path, schemas.PRODUCTS_LANDING, misfits=misfits)


def read_customers_landing(spark: SparkSession, path: str, misfits: bool = False) -> DataFrame:
    return read_csv_by_name(spark, path, schemas.CUSTOMERS_LANDING, misfits=misfits)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.WEATHER, header=False)


def read_customer_payments(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.CUSTOMER_PAYMENTS, header=False)


def read_customer_amounts(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.CUSTOMER_AMOUNTS, header=False)


def read_node_names(spark: SparkSession, path: str) -> DataFrame:
    """``id "name"`` lines; a name of several words must be quoted."""
    return read_csv(spark, path, schemas.NODE_NAMES, header=False, sep=" ")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per line, empty lines included."""
    return spark.read.text(path)


def parse_delimited(
    lines: DataFrame,
    separator: str,
    fields: Sequence[tuple[str, str]],
    required: Sequence[str] = (),
    column: str = "value",
) -> DataFrame:
    """Typed columns from delimited lines.

    ``fields`` gives ``(name, type)`` by position; a missing or unfit piece is null, and rows
    with a null in ``required`` are left out.
    """
    parts = F.split(column, separator)
    typed = [
        F.get(parts, F.lit(position)).try_cast(type_name).alias(name)
        for position, (name, type_name) in enumerate(fields)
    ]
    parsed = lines.select(*typed)
    return require(parsed, required) if required else parsed


def read_item_titles(spark: SparkSession, path: str) -> DataFrame:
    """``id|title|...`` lines as ``(item, title)``."""
    fields = [("item", "int"), ("title", "string")]
    return parse_delimited(read_lines(spark, path), PIPE, fields, ["item", "title"])


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``user item rating timestamp`` lines."""
    fields = [("user_id", "int"), ("item_id", "int"), ("rating", "double"), ("timestamp", "bigint")]
    return parse_delimited(read_lines(spark, path), TAB, fields, ["user_id", "item_id", "rating"])


def read_people_lines(spark: SparkSession, path: str) -> DataFrame:
    """Headerless ``id,name,age,friends`` lines."""
    fields = [("id", "int"), ("name", "string"), ("age", "int"), ("friends", "int")]
    return parse_delimited(read_lines(spark, path), COMMA, fields)
