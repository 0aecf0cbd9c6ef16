"""Exact de-duplication with keyed streaming state.

The rows' digests are a stream: a stateful query keeps, for every digest ever seen, the stable
identifier of the row that stays, where its content is, and how many rows had it. The state is
kept on disk (RocksDB), checkpointed to the shared folder, and never expires: there is no
watermark. A hit on a digest counts as a copy only once the full bytes agree; texts that differ
under one digest are told apart by content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import scratch_folder, stored

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a commit writes what changed, and many small stores do not reserve disk that they never fill
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest, locator of each row; null text counts as empty."""
    content = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"),
        F.input_file_name().alias("locator"),
    )


def update_state(spark: SparkSession, staged: str, checkpoint: str, changes: str, files_per_batch: int) -> None:
    """Feed what is new in the folder ``staged`` to the state; append the changed keys to ``changes``.

    The state lives on from call to call under ``checkpoint``.
    """
    before = {key: spark.conf.get(key, None) for key in STATE_STORE}
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        state = (
            spark.readStream.schema("doc_id long, digest binary, locator string")
            .option("maxFilesPerTrigger", files_per_batch)
            .parquet(staged)
            .groupBy("digest")
            .agg(F.max(F.struct("doc_id", "locator")).alias("keeper"), F.count("*").alias("group_size"))
        )

        def append(batch: DataFrame, number: int) -> None:
            # one folder for each micro-batch: a batch that is run again replaces itself
            batch.write.mode("overwrite").parquet(f"{changes}/batch={number}")

        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(append)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def exact_groups(docs: DataFrame, files_per_batch: int = 128) -> DataFrame:
    """One row per distinct text: digest, keep_id, locator, group_size.

    Of equal texts the row with the largest doc_id stays; a null doc_id is smaller than any other.
    Where one digest stands for several texts there is one row for each, with its text in
    ``content`` (otherwise null). No rows in: no rows out.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark, "exact")
    staged, changes = f"{folder}/staged", f"{folder}/changes"
    digests(docs).write.parquet(staged)
    update_state(spark, staged, f"{folder}/state", changes, files_per_batch)
    schema = "digest binary, keeper struct<doc_id: long, locator: string>, group_size long, batch int"
    states = spark.read.schema(schema).parquet(changes) if _exists(spark, changes) else spark.createDataFrame([], schema)
    # a key's count and keeper only grow, so its last state has the largest of both
    last = states.groupBy("digest").agg(F.max("keeper").alias("keeper"), F.max("group_size").alias("group_size"))
    groups = last.select(
        "digest",
        F.col("keeper.doc_id").alias("keep_id"),
        F.col("keeper.locator").alias("locator"),
        "group_size",
        F.lit(None).cast("string").alias("content"),
    )
    # the bytes: copies are one row of these only if all of their text is equal
    content = F.coalesce("text", F.lit(""))
    contents = docs.select(
        F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"), content.alias("content"), "doc_id"
    ).groupBy("digest", "content")
    shared = stored(
        contents.agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .groupBy("digest")
        .agg(F.count("*").alias("texts"))
        .filter("texts > 1"),
        "exact-collisions",
    )
    if shared.isEmpty():
        return groups
    apart = contents.agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).join(
        shared, "digest", "left_semi"
    )
    return groups.join(shared, "digest", "left_anti").unionByName(
        apart.select("digest", "keep_id", F.lit(None).cast("string").alias("locator"), "group_size", "content")
    )


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when all their bytes are; null counts as empty, so null and empty texts are
    one group. Rows that repeat both doc_id and text share their verdict and each count in
    group_size. A null doc_id is kept only if its whole group has none. Very long texts are
    compared whole. No rows in: no rows out.
    """
    groups = stored(exact_groups(docs), "exact-groups")
    content = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"))
    if not groups.filter("content IS NOT NULL").isEmpty():
        rows = docs.select("doc_id", F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"), content.alias("text"))
        found = rows.join(groups, (rows["digest"] == groups["digest"]) & F.coalesce(groups["content"] == rows["text"], F.lit(True)))
    else:
        found = rows.join(groups, rows["digest"] == groups["digest"])
    return found.select(
        rows["doc_id"],
        "keep_id",
        "group_size",
        rows["doc_id"].eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex(rows["digest"])).alias("text_sha256"),
    )


def without_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns; rows that repeat doc_id and text stay once."""
    groups = stored(exact_groups(docs), "exact-groups")
    content = F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(content.cast("binary"), 256))
    told = "__digest"
    stay = groups.select(
        F.col("digest").alias("__d"), F.col("keep_id").alias("__k"), F.col("content").alias("__c")
    )
    rows = docs.withColumn(told, digest)
    same = (rows[told] == stay["__d"]) & rows["doc_id"].eqNullSafe(stay["__k"])
    if not groups.filter("content IS NOT NULL").isEmpty():
        same = same & F.coalesce(stay["__c"] == content, F.lit(True))
    return rows.join(stay, same, "left_semi").dropDuplicates(["doc_id", told]).drop(told)
