"""Snapshots: a folder that is replaced as a whole, version by version.

    <root>/data/<id>/      what one write left; never changed afterwards
    <root>/versions/<n>    the manifest of version n: schema, folder, partition columns, rows, files, bytes

A version exists once its manifest has its name, which one rename that replaces nothing brings about.
So a write that ends at any step before leaves the earlier version as it was, writers at the same
time get versions of their own, and a reader keeps the files it began with: those of an
earlier version stay for ``keep`` seconds after it was replaced. The file system must rename
without replacing in one step, as HDFS does (on a local one a hard link is made instead).
"""

from __future__ import annotations

import gc
import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KEEP = 7 * 24 * 3600
# Files of a write that ended before its manifest go after a day, or after ``keep`` if that is longer.
ABANDONED = 24 * 3600
# Less disk than the default codec takes.
CODEC = "zstd"


class VersionConflict(RuntimeError):
    """Another write has committed since the version this one was made from."""


@dataclass(frozen=True)
class Snapshot:
    """One version, as its manifest says."""

    version: int
    committed: float
    folder: str
    schema: str
    partition_by: tuple[str, ...]
    bucket_by: tuple[str, ...]
    buckets: int
    rows: int
    files: int
    bytes: int
    metrics: dict[str, int]

    def table(self, name: str) -> str:
        """What the catalog calls this version of the table ``name``."""
        return f"{name}__{self.folder.rsplit('/', 1)[-1]}"

    def columns(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))

    def location(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.folder}"

    def read(self, spark: SparkSession, root: str) -> DataFrame:
        return spark.read.schema(self.columns()).parquet(self.location(root))


class _Files:
    """The few file operations that are needed, on whatever file system ``root`` is."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.conf = spark._jsc.hadoopConfiguration()
        self.system = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> dict[str, float]:
        """The names in a folder and when they were last changed, in seconds."""
        if not self.system.exists(self.path(folder)):
            return {}
        listed = self.system.listStatus(self.path(folder))
        return {one.getPath().getName(): one.getModificationTime() / 1000 for one in listed}

    def size(self, folder: str) -> tuple[int, int]:
        """Number and bytes of the files below a folder."""
        found = self.system.getContentSummary(self.path(folder))
        return found.getFileCount(), found.getLength()

    def text(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.system.create(self.path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)

    def rename_new(self, name: str, other: str) -> bool:
        """Give a file another name; False, and nothing changed, if the name is taken."""
        try:
            if self.system.getScheme() == "file":
                local = [self.jvm.java.io.File(self.path(x).toUri().getPath()).toPath() for x in (other, name)]
                self.jvm.java.nio.file.Files.createLink(*local)
                self.delete(name)
            else:
                options = self.jvm.org.apache.hadoop.fs.Options
                none = self.jvm.java.lang.reflect.Array.newInstance(options.Rename.NONE.getClass(), 0)
                context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path("").toUri(), self.conf)
                context.rename(self.path(name), self.path(other), none)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True


def _versions(files: _Files) -> list[int]:
    return sorted(int(name) for name in files.names("versions") if name.isdigit())


def _manifest(files: _Files, version: int) -> Snapshot:
    found = json.loads(files.text(f"versions/{version}"))
    return Snapshot(**found | {name: tuple(found[name]) for name in ("partition_by", "bucket_by")})


def list_snapshots(spark: SparkSession, root: str) -> list[Snapshot]:
    """The versions that are there, the latest last."""
    files, found = _Files(spark, root), []
    for version in _versions(files):
        try:
            found.append(_manifest(files, version))
        except Py4JJavaError as error:  # another write has just removed it
            if "FileNotFound" not in error.java_exception.getClass().getName():
                raise
    return found


def latest_snapshot(spark: SparkSession, root: str) -> Snapshot | None:
    files = _Files(spark, root)
    versions = _versions(files)
    return _manifest(files, versions[-1]) if versions else None


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of the latest or the given version; the frame stays with that version."""
    files = _Files(spark, root)
    versions = _versions(files)
    if not versions or version is not None and version not in versions:
        raise FileNotFoundError(f"no version {'' if version is None else version} below {root}")
    return _manifest(files, versions[-1] if version is None else version).read(spark, root)


def write_snapshot(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = (),
    keep: float = KEEP,
    made_from: int | None = None,
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    table: str | None = None,
    metrics: Mapping[str, Column] | None = None,
) -> Snapshot:
    """Write ``df`` as the next version of ``root`` and remove versions replaced over ``keep`` seconds ago.

    The rows are counted as they are written. ``made_from`` is the version that ``df`` was made from:
    if another was committed since, nothing is and ``VersionConflict`` is raised (0: the first).
    With ``bucket_by`` the rows are dealt into ``buckets`` files by those columns and sorted by them; Spark
    writes buckets for a catalog table only, a version of ``table``. ``metrics`` are further aggregates to
    take of the rows as they are written, without another look at them; the manifest keeps their values.
    A task that is run again counts once.
    """
    if bucket_by and (partition_by or buckets < 1 or not table):
        raise ValueError("buckets need their number and a table, and go without partitions")
    spark = df.sparkSession
    files, folder = _Files(spark, root), f"data/{uuid.uuid4().hex}"
    written = Observation()
    watched = [F.count(F.lit(1)).alias("rows"), *[value.alias(name) for name, value in (metrics or {}).items()]]
    draft = Snapshot(0, 0, folder, df.schema.json(), tuple(partition_by), tuple(bucket_by), buckets, 0, 0, 0, {})
    if bucket_by:
        # the rows are counted where they are written, after they are dealt
        dealt = df.repartition(buckets, *bucket_by).observe(written, *watched)
        writer = dealt.write.format("parquet").option("compression", CODEC).bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
        writer.option("path", draft.location(files.root)).saveAsTable(draft.table(table))
    else:
        counted = df.observe(written, *watched)
        counted.write.partitionBy(*partition_by).parquet(draft.location(files.root), compression=CODEC)
    many, size = files.size(folder)
    # partition columns come last when the files are read
    inner = [field for field in df.schema.fields if field.name not in partition_by]
    schema = StructType(inner + [df.schema[name] for name in partition_by]).json()
    seen = dict(written.get)
    done = replace(draft, schema=schema, rows=seen.pop("rows"), files=many, bytes=size, metrics=seen)
    found = _commit(files, done, made_from)
    expire_snapshots(spark, root, keep)
    release_shuffles(spark)
    return found


def release_shuffles(spark: SparkSession) -> None:
    """Have the files of shuffles that nothing refers to any more deleted.

    Spark does so when the driver collects its garbage, which a long job on little driver memory seldom
    does; asked after each write, a job of many writes holds the shuffles of those that run. What Python
    lets go of in the first round the JVM finds without references in the second.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()


def _commit(files: _Files, written: Snapshot, made_from: int | None) -> Snapshot:
    draft = f"versions/.draft-{uuid.uuid4().hex}"
    while True:
        last = max(_versions(files), default=0)
        if made_from is not None and last != made_from:
            raise VersionConflict(f"version {last} of {files.root} is there, this one was made from {made_from}")
        found = replace(written, version=last + 1, committed=time.time())
        files.write(draft, json.dumps(asdict(found)))
        if files.rename_new(draft, f"versions/{last + 1}"):
            return found


def expire_snapshots(spark: SparkSession, root: str, keep: float = KEEP) -> list[int]:
    """Remove the versions that were replaced more than ``keep`` seconds ago; which they were.

    A manifest goes before its files, so no version is there without them.
    """
    files, now = _Files(spark, root), time.time()
    there = list_snapshots(spark, root)
    gone = [one for one, after in zip(there, there[1:]) if now - after.committed > keep]
    for one in gone:
        files.delete(f"versions/{one.version}")
        files.delete(one.folder)
    used = {one.folder for one in there}
    for name, changed in files.names("data").items():
        if f"data/{name}" not in used and now - changed > max(keep, ABANDONED):
            files.delete(f"data/{name}")
    for name, changed in files.names("versions").items():
        if name.startswith(".draft") and now - changed > max(keep, ABANDONED):
            files.delete(f"versions/{name}")
    return [one.version for one in gone]
