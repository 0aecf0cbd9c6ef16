"""The prefix trie of conversations: what a cache of shared beginnings would hold and save.

1. Turns are dictionary-encoded: a turn's digest (role and text) gets a number, in the order of the
   digests. A conversation becomes its turns' numbers, in order of ``turn``.
2. Conversations are range-partitioned by (numbers, conv_id). A shard is a range of that order, so a
   prefix lies in neighbouring shards only, and copies of one conversation, however many, are dealt out.
3. A shard inserts its different conversations into a ternary search tree, the median first, then the
   medians of both halves, so that the nodes of one level are balanced. An iterative traversal adds up
   members, leaves and savings from below.
4. Only prefixes of a shard's first or last conversation can go on in another shard. Such boundary
   nodes leave the shard with what lies below them outside the boundary. One pass over them, in order,
   with the open path on a stack, joins those that are the same and adds up what is left. They are at
   most two paths a shard, whatever the number of conversations.
5. Nodes right below the boundary learn their parent's conv_id by a join on (shard, place).
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, turn_id long"
)
# place: of a boundary node in its shard; parent_place: of a boundary node that is the parent. A boundary
# node's counts are without the boundary nodes below it, and it has the ids that end there.
IN_SHARD = f"shard int, place long, parent_place long, n_chars long, ends string, {NODE}"
MERGED = f"shard int, place long, first boolean, {NODE}"


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    columns = list(zip(*rows)) if rows else [[] for _ in _names(schema)]
    types = [kinds[field.split()[1]] for field in schema.split(", ")]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=_names(schema))


# --- turns and conversations --------------------------------------------------------------


def _texts() -> tuple[Column, Column]:
    return F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))


def turn_digest() -> Column:
    """SHA-256 of a turn's role and text; null counts as empty."""
    role, text = _texts()
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


def turn_dictionary(conversations: DataFrame) -> DataFrame:
    """digest, turn_id, n_chars (code points of the text) of every different turn; ids follow the digests."""
    turns = conversations.select(turn_digest().alias("digest"), F.length(_texts()[1]).cast("long").alias("n_chars"))
    ordered = turns.groupBy("digest").agg(F.first("n_chars").alias("n_chars")).orderBy("digest")
    return stored(ordered.select("digest", F.monotonically_increasing_id().alias("turn_id"), "n_chars"), "turns")


def turn_texts(conversations: DataFrame, dictionary: DataFrame) -> DataFrame:
    """turn_id, role, text: what the numbers of the dictionary stand for."""
    role, text = _texts()
    turns = conversations.select(turn_digest().alias("digest"), role.alias("role"), text.alias("text"))
    return turns.dropDuplicates(["digest"]).join(dictionary, "digest").select("turn_id", "role", "text")


def conversation_paths(conversations: DataFrame, dictionary: DataFrame) -> DataFrame:
    """conv_id, path (turn ids in order), chars (code points of each).

    Turns are ordered by ``turn``, null first; those of one number by their digests. Rows without a
    conv_id belong to no conversation. A conversation is a unit: its numbers, not its texts, are in one
    task at once.
    """
    turns = conversations.filter(F.col("conv_id").isNotNull()).select("conv_id", "turn", turn_digest().alias("digest"))
    numbered = turns.join(dictionary, "digest").select("conv_id", F.struct("turn", "turn_id", "n_chars").alias("at"))
    grouped = numbered.groupBy("conv_id").agg(F.sort_array(F.collect_list("at")).alias("at"))
    return stored(grouped.select("conv_id", F.col("at.turn_id").alias("path"), F.col("at.n_chars").alias("chars")), "paths")


# --- a shard ------------------------------------------------------------------------------


class TernaryTree:
    """A ternary search tree of sequences of numbers. Node 0 is the empty sequence."""

    def __init__(self):
        self.key, self.low, self.equal, self.high = [-1], [-1], [-1], [-1]
        self.parent, self.depth, self.chars = [-1], [0], [0]

    def _new(self, key: int, parent: int, chars: int) -> int:
        for column, value in ((self.key, key), (self.parent, parent), (self.chars, chars)):
            column.append(value)
        for column in (self.low, self.equal, self.high):
            column.append(-1)
        self.depth.append(self.depth[parent] + 1)
        return len(self.key) - 1

    def insert(self, path: list[int], chars: list[int]) -> int:
        """The node of ``path``; it and those above it are made where they lack."""
        node = 0
        for key, length in zip(path, chars):
            side, at, below = self.equal, node, self.equal[node]
            while below >= 0 and self.key[below] != key:
                side = self.low if key < self.key[below] else self.high
                at, below = below, side[below]
            if below < 0:
                side[at] = below = self._new(key, node, length)
            node = below
        return node

    def insert_balanced(self, paths: list[list[int]], chars: list[list[int]]) -> list[int]:
        """Insert different sequences that are in order, medians first; their nodes in the given order."""
        ends, ranges = [0] * len(paths), [(0, len(paths))]
        while ranges:
            begin, end = ranges.pop()
            if begin < end:
                middle = (begin + end) // 2
                ends[middle] = self.insert(paths[middle], chars[middle])
                ranges += [(begin, middle), (middle + 1, end)]
        return ends

    def top_down(self) -> list[int]:
        """All nodes, each after the one whose sequence it extends."""
        found, open_ = [0], [self.equal[0]]
        while open_:
            node = open_.pop()
            if node >= 0:
                found.append(node)
                open_ += [self.high[node], self.low[node], self.equal[node]]
        return found

    def upwards(self, node: int) -> list[int]:
        """The node and those above it, the root first."""
        found = []
        while node >= 0:
            found.append(node)
            node = self.parent[node]
        return found[::-1]


def shard_nodes(shard: int, conversations: list[tuple[int, list[int], list[int]]]) -> list[tuple]:
    """Rows (IN_SHARD) of the nodes of conversations (conv_id, path, chars) in order of (path, conv_id)."""
    if not conversations:
        return []
    paths, chars, ids = [], [], []
    for conv_id, path, lengths in conversations:
        if not paths or path != paths[-1]:
            paths.append(path)
            chars.append(lengths)
            ids.append([])
        ids[-1].append(conv_id)
    tree = TernaryTree()
    ends = tree.insert_balanced(paths, chars)
    size = len(tree.key)
    members, children, leaves, saved = [0] * size, [0] * size, [0] * size, [0] * size
    least: list[int | None] = [None] * size
    ending = [""] * size
    for node, own in zip(ends, ids):
        members[node], least[node], ending[node] = len(own), own[0], ",".join(map(str, own))
    place = {node: k for k, node in enumerate(dict.fromkeys(tree.upwards(ends[0]) + tree.upwards(ends[-1])))}
    order = tree.top_down()
    for node in reversed(order[1:]):
        above = tree.parent[node]
        members[above] += members[node]
        least[above] = least[node] if least[above] is None else min(least[above], least[node])
        if node not in place:
            leaves[node] = leaves[node] or 1
            saved[node] += (members[node] - 1) * tree.chars[node]
            children[above] += 1
            leaves[above] += leaves[node]
            saved[above] += saved[node]
    rows = []
    for node in order:
        above, inner = tree.parent[node], node not in place
        rows.append(
            (
                shard,
                place.get(node),
                place.get(above) if inner else None,
                tree.chars[node],
                None if inner else ending[node],
                least[node],
                tree.depth[node],
                least[above] if inner and above not in place else None,
                members[node],
                children[node],
                leaves[node],
                saved[node],
                sha256(ending[node].encode()).hexdigest() if inner else None,
                tree.key[node] if node else None,
            )
        )
    return rows


# --- the boundary -------------------------------------------------------------------------


class _Open:
    """A boundary node of which more shards may come."""

    def __init__(self, row: dict):
        self.turn_id, self.depth, self.chars = row["turn_id"], row["depth"], row["n_chars"]
        self.members = self.children = self.leaves = self.saved = 0
        self.least, self.ends, self.any_ends = row["conv_id"], sha256(), False
        self.places: list[tuple[int, int]] = []
        self.closed: list[tuple[list[tuple[int, int]], list]] = []

    def add(self, row: dict) -> None:
        self.members += row["n_convs"]
        self.children += row["n_children"]
        self.leaves += row["n_leaves"]
        self.saved += row["saved_tokens"]
        self.least = min(self.least, row["conv_id"])
        self.places.append((row["shard"], row["place"]))
        if row["ends"]:
            self.ends.update(("," if self.any_ends else "").encode() + row["ends"].encode())
            self.any_ends = True


class BoundaryMerge:
    """Joins boundary nodes that come in order of (shard, place) and finishes them."""

    def __init__(self):
        self.path: list[_Open] = []
        self.rows: list[tuple] = []

    def add(self, row: dict) -> None:
        depth = row["depth"]
        if len(self.path) > depth and self.path[depth].turn_id != row["turn_id"]:
            self.close(depth)
        if len(self.path) == depth:
            self.path.append(_Open(row))
        self.path[depth].add(row)

    def close(self, depth: int = 0) -> None:
        """Finish the open nodes from ``depth`` on, the deepest first."""
        while len(self.path) > depth:
            node = self.path.pop()
            leaves = node.leaves or 1
            saved = node.saved + (node.members - 1) * node.chars
            values = [node.members, node.children, leaves, saved, node.ends.hexdigest(), node.turn_id]
            if self.path:
                above = self.path[-1]
                above.children += 1
                above.leaves += leaves
                above.saved += saved
                above.closed.append((node.places, [node.least, node.depth, *values]))
            else:
                self._finish(node.places, [node.least, node.depth, *values], None)
            for places, row in node.closed:
                self._finish(places, row, node.least)

    def _finish(self, places: list[tuple[int, int]], row: list, parent: int | None) -> None:
        conv_id, depth, *rest = row
        self.rows += [(*at, k == 0, conv_id, depth, parent, *rest) for k, at in enumerate(places)]

    def taken(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return _batch(rows, MERGED)


def path_trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """The trie's nodes (NODE) of ``paths``: conv_id, path, chars; a conv_id comes once.

    ``shards`` is the number of ranges, ``spark.sql.shuffle.partitions`` by default.
    """
    shards = shards or int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = paths.select("conv_id", "path", "chars").repartitionByRange(shards, "path", "conv_id")
    ordered = dealt.sortWithinPartitions("path", "conv_id").select(F.spark_partition_id().alias("shard"), "*")

    def in_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, conversations = 0, []
        for batch in batches:
            numbers, ids, found, lengths = (column.to_pylist() for column in batch.columns)
            shard = numbers[0] if numbers else shard
            conversations += zip(ids, found, lengths)
        rows = shard_nodes(shard, conversations)
        for begin in range(0, len(rows), 10_000):
            yield _batch(rows[begin : begin + 10_000], IN_SHARD)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boundary = BoundaryMerge()
        for batch in batches:
            for row in batch.to_pylist():
                boundary.add(row)
            yield boundary.taken()
        boundary.close()
        yield boundary.taken()

    nodes = stored(ordered.mapInArrow(in_shard, IN_SHARD), "shard-nodes")
    on_boundary = nodes.filter("place IS NOT NULL").repartition(1).sortWithinPartitions("shard", "place")
    merged = stored(on_boundary.mapInArrow(merge, MERGED), "boundary-nodes")
    above = merged.select("shard", F.col("place").alias("parent_place"), F.col("conv_id").alias("above"))
    inner = nodes.filter("place IS NULL").join(above, ["shard", "parent_place"], "left")
    names = _names(NODE)
    parent = F.coalesce("parent_conv_id", "above").alias("parent_conv_id")
    inner = inner.select(*[parent if name == "parent_conv_id" else name for name in names])
    return inner.unionByName(merged.filter("first").select(*names))


def conversation_trie(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the prefix trie of ``conversations`` (conv_id, turn, role, text).

    A node is a sequence of first turns (role and text) that some conversation begins with; the root
    is the empty one. conv_id: the smallest member, that is conversation which begins so; depth: turns;
    parent_conv_id: the parent's conv_id, null for the root; n_convs: members; n_children; n_leaves:
    nodes without children below it or itself; saved_tokens: (n_convs - 1) times the code points of its last text,
    summed over it and all nodes below; ends_sha256: SHA-256 of the members that end there, in numeric
    order, comma-joined; turn_id: its last turn in the dictionary, null for the root.

    Null roles and texts count as empty, a null ``turn`` comes first, repeated rows are turns of
    their own. Rows without conv_id are left out; no rows in: no rows out. Hashing the members that end at
    one node is sequential by nature: their ids reach it as one text from each shard.
    """
    dictionary = turn_dictionary(conversations)
    return path_trie(conversation_paths(conversations, dictionary), shards)
