"""Near-duplicates by bottom-k sketches of one hash function.

1. A document's shingles are fingerprinted with one hash; its sketch is the smallest ``SKETCH`` of
   them. Documents with equal shingle sets are one class and go on as one representative.
2. Inverted lists of retained values generate overlaps. A value that more than ``COMMON`` classes
   retain is common; lists are made of the first ``LISTED`` values that are not, so that no list is
   longer than ``COMMON``. A linked pair misses all such lists with a chance of 0.5^24 at most
   unless common values make up half of it.
3. Classes whose sketch is common to a good part (``COMMON_SHARE``) are compared once more among
   themselves, by whole sets: of the shingles from rare to common, linked sets must share one among
   the first quarter, early enough, and neither may have many shingles alone (exact bounds). Long
   lists of these are first compared with one member each, the one with the fewest shingles of its
   own: of a group of near copies that is what they were made from. What is then one component need
   not be paired any more.
4. The sketch of the union estimates the similarity and filters; whole sets decide.
5. Components are the least ids reachable over the links, found by spreading them in rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import slices, stored
from ledgerloom.llm.shingles import Shingler, mixed

SKETCH = 64
LISTED = 24
COMMON = 32
COMMON_SHARE = 18 / 64
MIN_OVERLAP = 2
# The estimate's deviation at 0.75 is 0.054: pairs below this are 4.6 deviations away.
ESTIMATE_FLOOR = 0.5
STAR_ROUNDS = 1
# So many common values (8 MB) are at hand in every task; more are marked by a join.
AT_HAND = 1_000_000
PERCENT = 75
# The filter for ids has at most so many bits.
FILTER_BITS = 1 << 26

SKETCHED = "doc_id long, n_shingles long, digest binary, sketch binary, values array<long>"


def linked(shared: int, a: int, b: int) -> bool:
    return 100 * shared >= PERCENT * (a + b - shared)


def sketches(docs: DataFrame, size: int = 5) -> DataFrame:
    """doc_id, n_shingles, digest of the shingle set, its sketch, packed and as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in slices(batches):
            sets = [shingler.shingles(text.as_py()) for text in batch.column(1)]
            kept = [s[:SKETCH] for s in sets]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in kept], pa.binary()),
                    pa.array([s.view(np.int64) for s in kept], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "digest", "sketch", "values"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SKETCHED)


def full_sets(docs: DataFrame, ids: DataFrame, size: int = 5) -> DataFrame:
    """node, members (packed fingerprints) of the documents named in ``ids`` (node), and of a few others.

    No text is moved: a filter of all ids is at hand in every task. Two bits of it stand for each id; it
    has 16 bits an id and ``FILTER_BITS`` (8 MB) at most. With more ids than that allows for there are
    more of the others, never fewer of those.
    """
    many = ids.count()
    bits = min(FILTER_BITS, max(1024, 1 << (16 * many).bit_length()))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = _probes(batch.column(0), bits)
            bit = np.uint64(1) << (places & np.uint64(63))
            yield pa.record_batch([pa.array((places >> np.uint64(6)).view(np.int64)), pa.array(bit.view(np.int64))], names=["word", "bit"])

    found = ids.select("node").mapInArrow(words, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    content = np.zeros(bits // 64, np.uint64)
    content[found.column("word").to_numpy()] = found.column("bit").to_numpy().view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            places = _probes(batch.column(0), bits)
            there = (shared.value[places >> np.uint64(6)] >> (places & np.uint64(63)) & np.uint64(1)).astype(bool)
            wanted = np.flatnonzero(there[: batch.num_rows] & there[batch.num_rows :])
            for begin in range(0, len(wanted), 256):
                part = batch.take(pa.array(wanted[begin : begin + 256]))
                packed = [shingler.shingles(text.as_py()).tobytes() for text in part.column(1)]
                yield pa.record_batch([part.column(0), pa.array(packed, pa.binary())], names=["node", "members"])

    rows = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("node"), "text")
    return rows.mapInArrow(run, "node long, members binary")


def _probes(ids: pa.Array, bits: int) -> np.ndarray:
    """Two places in a filter of ``bits`` bits, a power of two, for each id: all first ones, then all second ones."""
    hashed = mixed(ids.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
    return np.concatenate([hashed, hashed >> np.uint64(32)]) & np.uint64(bits - 1)


def _packed(column: pa.Array) -> Iterator[np.ndarray]:
    """The fingerprints packed in each row of ``column``: views of its memory, no copies."""
    return (np.frombuffer(row.as_buffer(), np.uint64) for row in column)


def likely(pairs: DataFrame, sketched: DataFrame) -> DataFrame:
    """The pairs (a, b) whose union sketch does not rule a link out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(_packed(batch.column(2)), _packed(batch.column(3))):
                both = np.sort(np.concatenate([x, y]))
                same = both[1:] == both[:-1]
                union = np.concatenate([both[:1], both[1:][~same]])[:SKETCH]
                shared = np.count_nonzero(both[1:][same] <= union[-1])
                keep.append(shared >= ESTIMATE_FLOOR * len(union))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return with_both(pairs, sketched, "sketch").mapInArrow(run, "a long, b long")


def with_both(pairs: DataFrame, of: DataFrame, column: str) -> DataFrame:
    """a, b and ``column`` of each."""
    first = of.select(F.col("node").alias("a"), F.col(column).alias("of_a"))
    second = of.select(F.col("node").alias("b"), F.col(column).alias("of_b"))
    return pairs.select("a", "b").join(first, "a").join(second, "b").select("a", "b", "of_a", "of_b")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(_packed(batch.column(2)), _packed(batch.column(3))):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(linked(shared, len(x), len(y)))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return with_both(pairs, sets, "members").mapInArrow(run, "a long, b long")


def could_link(n: Column, own: Column, at: Column, x_n: Column, x_own: Column, x_at: Column) -> Column:
    """Whether two sets can be linked by a shingle at these places, if it is the first they share.

    ``own`` shingles are in no other set; what stands before the place is not shared.
    """
    most = F.least(n - own, x_n - x_own, n - at, x_n - x_at)
    return 100 * most >= PERCENT * (n + x_n - most)


def sizes_fit(x: Column, y: Column) -> Column:
    """Whether sets of these sizes can be linked at all."""
    return (100 * x >= PERCENT * y) & (100 * y >= PERCENT * x)


def components(links: DataFrame) -> DataFrame:
    """node, label: the least node that each node of ``links`` (a, b) reaches.

    Labels spread along the links and jump to their labels' labels until nothing changes, so that
    the rounds grow with the logarithm of the longest chain.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
    edges = stored(both.distinct(), "edges")
    labels = stored(
        edges.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("label")), "labels"
    )
    while True:
        around = edges.join(labels.select(F.col("node").alias("other"), "label"), "other")
        spread = (
            around.select("node", "label").union(labels).groupBy("node").agg(F.min("label").alias("label"))
        )
        of_label = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        old = labels.select("node", F.col("label").alias("old"))
        after = stored(
            spread.join(of_label, "label", "left")
            .select("node", F.least("label", "further").alias("label"))
            .join(old, "node"),
            "labels",
        )
        labels = after.select("node", "label")
        if after.filter("label <> old").isEmpty():
            return labels


def rare_prefixes(sets: DataFrame, chosen: DataFrame) -> DataFrame:
    """token, node, n, own, at: of each chosen set the rarest shingles, one of which linked sets must share.

    Rare means in few of the chosen sets; the ``own`` shingles of one set alone lead and are left out,
    as they link to nothing. ``at`` counts from 0, these included.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            packed = batch.column(1).to_pylist()
            counts = np.array([len(p) // 8 for p in packed], np.int64)
            tokens = np.frombuffer(b"".join(packed), np.int64)
            nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), counts)
            yield pa.record_batch(
                [pa.array(tokens), pa.array(nodes), pa.array(np.repeat(counts, counts))], names=["token", "node", "n"]
            )

    rows = sets.join(chosen, "node", "left_semi").mapInArrow(run, "token long, node long, n long")
    counts = rows.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    in_several = rows.join(counts, "token").groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens")
    )
    # ceil(0.75 n) shingles may come after the prefix; those of one set alone are before the rest
    own = F.col("n") - F.size("tokens")
    length = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1 - own
    return (
        in_several.filter(length > 0)
        .select("node", "n", own.alias("own"), F.posexplode(F.slice("tokens", F.lit(1), length.cast("int"))).alias("k", "t"))
        .select(F.col("t.token").alias("token"), "node", "n", "own", (F.col("own") + F.col("k")).alias("at"))
    )


def _pairs_of(first: Column, second: Column) -> list[Column]:
    return [F.least(first, second).alias("a"), F.greatest(first, second).alias("b")]


def links_among_common(sets: DataFrame, chosen: DataFrame, links: DataFrame) -> DataFrame:
    """More links, between the chosen nodes, that together with ``links`` join all that is linked."""
    prefixes = stored(rare_prefixes(sets, chosen), "prefixes")
    tested, columns = None, ["node", "label", "n", "own", "at"]
    for number in range(STAR_ROUNDS + 1):
        labels = components(links)
        rows = prefixes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        lists = rows.groupBy("token").agg(
            F.min("label").alias("low"), F.max("label").alias("high"),
            F.min(F.struct("own", F.xxhash64("node", F.lit(number)).alias("h"), "node", "label", "n", "at")).alias("head"),
        )
        unsettled = lists.filter("low <> high")
        if number < STAR_ROUNDS:  # one member of each list against the others
            head = unsettled.select("token", *(f"head.{c}" for c in columns))
        else:  # every member against those of other components
            head = rows.join(unsettled.select("token"), "token", "left_semi").select("token", *columns)
        head = head.toDF("token", *(f"x_{c}" for c in columns))
        fits = could_link(*(F.col(c) for c in ("n", "own", "at", "x_n", "x_own", "x_at")))
        pairs = (
            rows.join(head, "token")
            .filter((F.col("label") != F.col("x_label")) & fits)
            .select(*_pairs_of(F.col("node"), F.col("x_node")))
            .distinct()
        )
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "common-pairs")
        links = stored(links.unionByName(verified(pairs, sets)), "links")
        tested = pairs if tested is None else tested.unionByName(pairs)
    return links


def marked_values(nodes: DataFrame) -> DataFrame:
    """node, n, common (how many of its retained values are), rare (the first ``LISTED`` that are not)."""
    retained = nodes.select("node", "n", F.posexplode("values").alias("at", "value"))
    common = stored(
        retained.groupBy("value").agg(F.count("*").alias("df")).filter(F.col("df") > COMMON).select("value"), "common-values"
    )
    if common.limit(AT_HAND + 1).count() <= AT_HAND:
        found = np.sort(np.array([row.value for row in common.collect()], np.int64))
        return _marked_by_array(nodes, found)
    with_flag = retained.join(common.withColumn("is_common", F.lit(True)), "value", "left")
    rare = F.sort_array(F.collect_list(F.when(F.col("is_common").isNull(), F.struct("at", "value"))))
    marked = with_flag.groupBy("node", "n").agg(F.count("is_common").alias("common"), rare.alias("rare"))
    return marked.select("node", "n", "common", F.slice(F.col("rare.value"), 1, LISTED).alias("rare"))


def is_in(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    place = np.searchsorted(sorted_values, x)
    return sorted_values[np.minimum(place, len(sorted_values) - 1)] == x


def _marked_by_array(nodes: DataFrame, common: np.ndarray) -> DataFrame:
    """The same without a shuffle, where the common values are few enough to be at hand."""
    shared = nodes.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.frombuffer(x, np.int64) for x in batch.column(2).to_pylist()]
            flags = [is_in(shared.value, x) for x in values]
            yield pa.record_batch(
                [
                    *batch.columns[:2],
                    pa.array([int(f.sum()) for f in flags], pa.int64()),
                    pa.array([x[~f][:LISTED] for x, f in zip(values, flags)], pa.list_(pa.int64())),
                ],
                names=["node", "n", "common", "rare"],
            )

    return nodes.select("node", "n", "sketch").mapInArrow(run, "node long, n long, common long, rare array<long>")


def near_links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """a, b: links that join all linked ``nodes`` (node, n, sketch, values), one per shingle set."""
    marked = stored(marked_values(nodes), "marked")
    lists = marked.select("node", "n", F.explode("rare").alias("value"))
    other = lists.select(F.col("node").alias("x"), F.col("n").alias("x_n"), "value")
    overlaps = (
        lists.join(other, "value")
        .filter((F.col("node") < F.col("x")) & sizes_fit(F.col("n"), F.col("x_n")))
        .groupBy(F.col("node").alias("a"), F.col("x").alias("b"))
        .agg(F.count("*").alias("overlap"), F.min(F.least("n", "x_n")).alias("least_n"))
        .filter(F.col("overlap") >= F.least(F.lit(MIN_OVERLAP), F.col("least_n")))
    )
    pairs = stored(likely(overlaps, nodes), "likely")
    chosen = stored(
        marked.filter(F.col("common") >= COMMON_SHARE * F.least(F.col("n"), F.lit(SKETCH))).select("node"), "common"
    )
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(chosen).distinct()
    sets = stored(full_sets(docs, needed), "sets")
    links = stored(verified(pairs, sets), "links")
    return links_among_common(sets, chosen, links)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Shingles are five words, A-Z lower-cased, of whole texts; links need a similarity of 0.75.
    component_id is the least doc_id reachable over links, kept that it is the row's own. Texts
    without words, empty and null ones are linked with nothing. A row without doc_id is compared
    with nothing: its component_id is null and it is kept. Rows of one doc_id count as one document
    that has the links of all their texts. No rows in: no rows out.
    """
    rows = stored(sketches(docs), "sketches")
    classes = rows.filter("doc_id IS NOT NULL AND n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.min("n_shingles").alias("n"),
        F.min("sketch").alias("sketch"), F.min("values").alias("values"),
    )
    classes = stored(classes, "classes")
    labels = components(near_links(docs, classes.drop("digest")))
    of_class = classes.select("digest", "node").join(labels, "node", "left").select(
        "digest", F.coalesce("label", "node").alias("of_class")
    )
    found = rows.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
    alone = F.when(F.col("n_shingles") > 0, F.col("of_class")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), alone)
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns; one document of each component stays."""
    gone = near_duplicates(docs).filter("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == F.col("__gone"), "left_anti")
