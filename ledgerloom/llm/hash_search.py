"""Nearest neighbours by multi-index hashing of learned binary codes.

1. Equal vectors become one, with the smallest ids that any answer can need, so a vector that a third
   of all rows share is one entry.
2. A bounded sample teaches the codes: principal directions, then a rotation that brings the vectors
   close to the corners of a cube (iterative quantisation). A bit is the side on which a vector lies.
   The sample also sets the Hamming radius: ``RADIUS_SHARE`` of its own nearest neighbours lie within.
3. A code is split into substrings, each with an index of its own: a table in which the entries lie in
   buckets by the substring's value. By the pigeonhole principle a code within radius r = m * s + a
   has one of the first a + 1 substrings within s, or one of the others within s - 1.
4. The tables are dealt into cells by the leading bits of the substring, large cells further by hash.
   A query goes to those cells only whose leading bits are in reach. There it probes the buckets
   within the substring's radius, keeps the codes within r that no earlier table has found, and ranks
   their original vectors. A cell answers with its k + 1 nearest; they are joined over the cells.
5. Queries that found too few go again with twice the radius, until it spans the whole code.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerloom.llm.common import stored

BITS = 64
SUBSTRINGS = 4
SAMPLE = 20_000
SAMPLE_QUERIES = 500
RADIUS_SHARE = 0.97
ROTATIONS = 40
# Entries of a cell: at most so many are in a task's memory at once.
CELL_ROWS = 131_072
LEAST_CELL_ROWS = 4096

FOUND = "query long, score double, ids array<long>"


# --- codes ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Codes:
    """Centre and directions of the bits, and the radius that the sample asks for."""

    centre: np.ndarray
    directions: np.ndarray
    radius: int

    @property
    def bits(self) -> int:
        return self.directions.shape[1]

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """The codes of ``vectors`` as unsigned 64-bit numbers, the first bit the highest."""
        sides = (vectors - self.centre) @ self.directions > 0
        return sides @ (np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64))


def learn_codes(sample: np.ndarray, k: int, bits: int = BITS, share: float = RADIUS_SHARE) -> Codes:
    """Codes of at most ``bits`` bits, and not more than dimensions, fitted to the rows of ``sample``."""
    bits = min(bits, sample.shape[1])
    centre = sample.mean(axis=0)
    inner = sample - centre
    _, axes = np.linalg.eigh(inner.T @ inner)
    axes = axes[:, ::-1][:, :bits]
    flat = inner @ axes
    turn = np.linalg.qr(np.random.default_rng(7).normal(size=(bits, bits)))[0]
    for _ in range(ROTATIONS):
        corners = np.where(flat @ turn > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(corners.T @ flat)
        turn = (left @ right).T
    codes = Codes(centre, axes @ turn, bits)
    if len(sample) <= k + 1:
        return codes
    chosen = np.arange(min(SAMPLE_QUERIES, len(sample)))
    own, lengths = codes.of(sample), np.einsum("ij,ij->i", sample, sample)
    near = lengths[None] - 2 * sample[chosen] @ sample.T
    near[chosen, chosen] = np.inf
    nearest = np.argpartition(near, k, axis=1)[:, :k]
    apart = np.bitwise_count(own[chosen][:, None] ^ own[nearest])
    return Codes(centre, codes.directions, int(np.ceil(np.quantile(apart, share))))


@dataclass(frozen=True)
class Table:
    """One substring: its place in the code, its radius, and how many leading bits name the cell."""

    number: int
    shift: int
    width: int
    radius: int
    leading: int

    def value(self, codes: np.ndarray) -> np.ndarray:
        return (codes >> np.uint64(self.shift)) & np.uint64((1 << self.width) - 1)

    def cell(self, codes: np.ndarray) -> np.ndarray:
        return self.value(codes) >> np.uint64(self.width - self.leading)


def tables_for(bits: int, substrings: int, radius: int, leading: int) -> list[Table]:
    """The substrings that must be searched so that no code within ``radius`` is missed."""
    substrings = max(1, min(substrings, bits))
    each, rest = divmod(radius, substrings)
    tables, shift = [], bits
    for j in range(substrings):
        width = bits // substrings + (j < bits % substrings)
        shift -= width
        reach = each if j <= rest else each - 1
        if reach >= 0:
            tables.append(Table(j, shift, width, reach, min(leading, width)))
        if reach >= width:  # this one finds everything
            break
    return tables


# --- a cell ---------------------------------------------------------------------------------


class Cell:
    """The entries of a cell in buckets by the value of their substring."""

    def __init__(self, tables: list[Table], table: Table, radius: int, codes: np.ndarray, vectors: np.ndarray, ids: list[list[int]]):
        values = table.value(codes)
        order = np.argsort(values, kind="stable")
        self.buckets, self.sizes = np.unique(values, return_counts=True)
        self.codes, self.vectors, self.ids = codes[order], vectors[order], [ids[i] for i in order]
        self.least = np.fromiter((x[0] for x in self.ids), np.int64, len(ids))
        self.table, self.radius = table, radius
        self.earlier = [other for other in tables if other.number < table.number]

    def within(self, code: np.uint64) -> np.ndarray:
        """Entries within the radius that this table finds first."""
        probed = np.bitwise_count(self.buckets ^ self.table.value(code)) <= self.table.radius
        entries = np.flatnonzero(np.repeat(probed, self.sizes))
        apart = self.codes[entries] ^ code
        near = np.bitwise_count(apart) <= self.radius
        for other in self.earlier:
            near &= np.bitwise_count(other.value(apart)) > other.radius
        return entries[near]

    def nearest(self, code: np.uint64, vector: np.ndarray, k: int) -> tuple[np.ndarray, list[list[int]]]:
        """Distances and ids of the ``k`` nearest of these, ties by the smallest id."""
        entries = self.within(code)
        apart = self.vectors[entries].astype(np.float64) - vector.astype(np.float64)
        score = np.sqrt(np.einsum("ij,ij->i", apart, apart))
        if len(score) > k:
            few = np.flatnonzero(score <= np.partition(score, k - 1)[k - 1])
            entries, score = entries[few], score[few]
        first = np.lexsort((self.least[entries], score))[:k]
        return score[first], [self.ids[i] for i in entries[first]]


def _vectors(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimension)


# --- the search -----------------------------------------------------------------------------


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part (see ``nearest_neighbours``)."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = embeddings.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & finite & some)
    size = F.size("embedding")
    common = rows.groupBy(size.alias("size")).count().orderBy(F.desc("count"), F.desc("size")).select("size").first()
    return rows.filter(size == (common[0] if common else 0))


def distinct_vectors(rows: DataFrame, keep: int, name: str) -> DataFrame:
    """number, embedding, ids: every different vector with the ``keep`` smallest ids of its rows, in order."""
    placed = F.row_number().over(W.partitionBy("embedding").orderBy("vec_id"))
    few = rows.withColumn("place", placed).filter(F.col("place") <= keep)
    grouped = few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return stored(grouped.select(F.monotonically_increasing_id().alias("number"), "embedding", "ids"), name)


def _coded(vectors: DataFrame, codes: Codes) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = codes.of(_vectors(batch.column(1), len(codes.centre)).astype(np.float64))
            yield pa.record_batch([*batch.columns, pa.array(found.view(np.int64))], names=[*batch.schema.names, "code"])

    return vectors.mapInArrow(run, StructType([*vectors.schema.fields, StructField("code", LongType())]))


def _leading(table: Table) -> Column:
    """The leading bits of the table's substring of ``code``."""
    value = F.shiftrightunsigned(F.col("code"), table.shift + table.width - table.leading)
    return value.bitwiseAND(F.lit((1 << table.leading) - 1)).cast("int")


def _in_tables(coded: DataFrame, tables: list[Table]) -> DataFrame:
    """Each row once for each table, with the cell of its own code."""
    places = [F.struct(F.lit(t.number).alias("table"), _leading(t).alias("cell")) for t in tables]
    return coded.withColumn("at", F.explode(F.array(*places))).select("at.*", *coded.columns)


def _search(entries: DataFrame, queries: DataFrame, codes: Codes, radius: int, substrings: int, k: int, rows: int) -> DataFrame:
    """FOUND: for every query the ``k`` nearest of the entries within ``radius``, from each cell."""
    spark = entries.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    room = min(CELL_ROWS, max(LEAST_CELL_ROWS, rows // partitions))
    leading = max(0, (max(rows, 1) - 1) // room).bit_length()
    tables = tables_for(codes.bits, substrings, radius, leading)
    placed = _in_tables(_coded(entries, codes), tables)
    cells = stored(placed.groupBy("table", "cell").agg(F.ceil(F.count("*") / room).cast("int").alias("parts")), "cells")
    split = F.pmod(F.xxhash64("number"), F.col("parts")).cast("int").alias("part")
    columns = ["table", "cell", "part", "kind", "number", "ids", "code", "embedding"]
    index = placed.join(cells, ["table", "cell"]).withColumns({"part": split, "kind": F.lit(0)}).select(*columns)

    def of_table(values: list[int]) -> Column:
        return F.create_map(*[F.lit(x) for t, value in zip(tables, values) for x in (t.number, value)])[F.col("table")]

    # the cells in reach are those whose leading bits differ from the query's in few places
    asked = _in_tables(_coded(queries, codes), tables)
    masks = F.sequence(F.lit(0), of_table([(1 << t.leading) - 1 for t in tables]))
    spread = asked.withColumn("mask", F.explode(masks)).filter(F.bit_count("mask") <= of_table([t.radius for t in tables]))
    spread = spread.withColumn("cell", F.col("cell").bitwiseXOR(F.col("mask"))).join(cells, ["table", "cell"])
    spread = spread.withColumns({"part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1)), "kind": F.lit(1)})
    together = index.unionByName(spread.select(*columns))
    dealt = together.repartition(partitions, "table", "cell", "part").sortWithinPartitions("table", "cell", "part", "kind")
    by_number = {table.number: table for table in tables}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, cell = None, [], None
        for batch in batches:
            places = np.stack([batch.column(i).to_numpy() for i in range(4)])
            changes = np.flatnonzero((places[:, 1:] != places[:, :-1]).any(axis=0)) + 1
            for begin, end in zip([0, *changes], [*changes, batch.num_rows]):
                piece = batch.slice(begin, end - begin)
                *here, kind = places[:, begin].tolist()
                if here != at:
                    at, parts, cell = here, [], None
                vectors = _vectors(piece.column(7), len(codes.centre))
                own = piece.column(6).to_numpy().view(np.uint64)
                if kind == 0:
                    parts.append((own, vectors, piece.column(5).to_pylist()))
                    continue
                if cell is None and parts:
                    ids = [x for part in parts for x in part[2]]
                    arrays = [np.concatenate([part[i] for part in parts]) for i in (0, 1)]
                    cell = Cell(tables, by_number[at[0]], radius, *arrays, ids)
                    parts = []
                if cell is not None:
                    yield _answers(cell, piece.column(4), own, vectors, k)

    return dealt.mapInArrow(run, FOUND)


def _answers(cell: Cell, numbers: pa.Array, codes: np.ndarray, vectors: np.ndarray, k: int) -> pa.RecordBatch:
    query, score, ids = [], [], []
    for number, code, vector in zip(numbers.to_pylist(), codes, vectors):
        scores, found = cell.nearest(code, vector, k)
        query += [number] * len(found)
        score += scores.tolist()
        ids += found
    return pa.record_batch(
        [pa.array(query, pa.int64()), pa.array(score, pa.float64()), pa.array(ids, pa.list_(pa.int64()))],
        names=["query", "score", "ids"],
    )


def _nearest_items(found: DataFrame, k: int) -> DataFrame:
    """query and items: its ``k`` nearest (score, id) in order."""
    place = F.row_number().over(W.partitionBy("query").orderBy("score", F.col("ids")[0]))
    few = found.withColumn("place", place).filter(F.col("place") <= k)
    named = F.transform("ids", lambda one: F.struct(F.col("score").alias("score"), one.alias("vec_id")))
    items = F.slice(F.sort_array(F.flatten(F.collect_list(named))), 1, k)
    return few.groupBy("query").agg(items.alias("items"))


def nearest_neighbours(
    embeddings: DataFrame,
    chosen: Column | str,
    k: int = 10,
    bits: int = BITS,
    substrings: int = SUBSTRINGS,
    sample: int = SAMPLE,
    share: float = RADIUS_SHARE,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for each row that ``chosen`` holds for.

    ``embeddings`` has vec_id and embedding (array of float or double). Score is the Euclidean distance
    of the original vectors in double precision; ties go to the smaller vec_id. Candidates are all
    rows but the query's own: a repeated row is a candidate, and as a query is answered for each row.
    Rows without vec_id, vectors null, zero (or empty), or with null or non-finite components, and those not of
    the most frequent length (of equal ones the largest) take no part. A query gets all candidates if
    they are ``k`` or fewer. No rows in: no rows out.

    The codes are fitted to about ``sample`` different vectors (at most twice as many), chosen by hash;
    every row is indexed. ``share`` of the sample's own nearest neighbours set the radius, so recall is
    about that, or more where the whole table has nearer ones.
    """
    rows = usable(embeddings)
    entries = distinct_vectors(rows, k + 1, "entries")
    many = entries.count()
    if not many:
        return entries.selectExpr("number AS query_id", "0 AS rank", "number AS vec_id", "0D AS score").limit(0)
    asked = rows.filter(chosen)
    queries = distinct_vectors(asked, 1, "queries")
    lot = F.pmod(F.xxhash64("number"), F.lit(1 << 30)) < max(1, int((1 << 30) * min(1.0, sample / many)))
    seen = entries.filter(lot).select("embedding").limit(2 * sample).toArrow().column(0).combine_chunks()
    if not len(seen):
        seen = entries.select("embedding").limit(1).toArrow().column(0).combine_chunks()
    codes = learn_codes(_vectors(seen, len(seen[0])).astype(np.float64), k, bits, share)

    radius, open_, answers = codes.radius, queries, []
    wanted = min(k + 1, entries.agg(F.sum(F.size("ids"))).first()[0])
    while True:
        found = _search(entries, open_, codes, radius, substrings, k + 1, many)
        items = stored(_nearest_items(found, k + 1).filter(F.size("items") >= wanted), "neighbours")
        answers.append(items)
        if radius >= codes.bits:
            break
        open_ = stored(open_.join(items, F.col("number") == F.col("query"), "left_anti"), "open-queries")
        if open_.isEmpty():
            break
        radius = min(codes.bits, max(1, 2 * radius))
    everything = answers[0]
    for more in answers[1:]:
        everything = everything.unionByName(more)

    named = queries.select(F.col("number").alias("query"), "embedding")
    own = asked.join(named, "embedding").select(F.col("vec_id").alias("query_id"), "query")
    # the query's own row is one of those with its id at distance 0
    place = F.array_position("items", F.struct(F.lit(0.0).alias("score"), F.col("query_id").alias("vec_id"))).cast("int")
    others = F.when(place > 0, F.concat(F.slice("items", F.lit(1), place - 1), F.slice("items", place + 1, F.lit(k + 1))))
    left = F.slice(F.coalesce(others, F.col("items")), 1, k).alias("items")
    ranked = own.join(everything, "query").select("query_id", F.posexplode(left).alias("at", "item"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), "item.vec_id", "item.score")
