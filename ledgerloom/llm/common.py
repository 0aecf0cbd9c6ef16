"""What several operators share: the shared scratch folder, written tables, text helpers.

``doc_id`` identifies a document. Every operator reads the columns it names and carries none of
the others along, so extra columns, whatever their names, neither clash nor change a result.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The ASCII letters and what they are lower-cased to.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

_OWN_FOLDERS: dict[str, str] = {}


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, which driver and executors share.

    Where the session names no such folder one is made for it, if all its tasks run in this process
    (tests on one machine); a cluster must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        application = spark.sparkContext.applicationId
        if application not in _OWN_FOLDERS:
            _OWN_FOLDERS[application] = "file://" + tempfile.mkdtemp(prefix="llm-")
        base = _OWN_FOLDERS[application]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and its lineage is cut.

    What it was computed from is needed no more. Spark deletes the shuffle files of frames that are
    gone when the driver collects its garbage, so that is asked for here: a job of many steps then
    holds the files of one step at a time.
    """
    spark, schema = df.sparkSession, df.schema
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    del df
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches``, in order, some at a time: what a worker makes of a batch is as small as its slices."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is. Null stays null."""
    # ``lower`` is the fast way where it cannot touch anything else
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def id_crc32(doc_id: Column) -> Column:
    """crc32 of the id as text, not negative; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary"))


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """``id_crc32`` modulo ``divisor``."""
    return id_crc32(doc_id) % divisor


def id_remainder_of(doc_id: int | None, divisor: int) -> int:
    return zlib.crc32(b"null" if doc_id is None else str(doc_id).encode()) % divisor
