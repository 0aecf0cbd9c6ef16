"""Removal of repeated byte strings with a logarithmic family of sparse suffix arrays.

Of each text the suffixes at *anchors* are indexed: places whose 16 bytes hash lowest among the 85
such places of some 100-byte string. Equal strings have anchors at equal places, so that a repeated
string of 100 bytes always meets its earlier copy at an anchor. An index entry is the anchor's hash
and that of its surroundings (all bytes of 100-byte strings that hold the anchor), and its position.

A new batch of documents gets its array, sorted by hash, and is scanned together with the levels so
far. Entries with the same surroundings as an earlier one are repeats. Where an anchor has different
surroundings, these are fetched from the texts and compared byte by byte: 100-byte strings that an
earlier one has too are repeats. What is new becomes a level, and levels of equal size merge, so that
an entry is rewritten once for each doubling.

An anchor that takes a large share of all entries (a phrase of many documents) is dealt by its
surroundings too, so that no task holds all its places; its surroundings all count as open. Texts
without open places are not moved to be read, nor those without repeats to be cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored
from ledgerloom.llm.id_filter import named_in
from ledgerloom.llm.shingles import mixed

LENGTH = 100
GRAM = 16
BEFORE = LENGTH - GRAM  # how far a string that holds an anchor can begin before it
AROUND = BEFORE + LENGTH
PLACES = BEFORE + 1
# Surroundings of one anchor that are compared in one task; more are spread by their strings.
TOGETHER = 100_000
CHUNK = 20_000
# About so many documents tell which anchors are crowded: those with this share of an average partition.
SAMPLE = 5_000
CROWDED_SHARE = 0.25
CROWDED_LEAST = 16

_ODD = np.uint64(0x9E3779B97F4A7C15)
_OF_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
ENTRY = "fp long, around long, key long, pos int, right int, repeat boolean"


def _powers(n: int) -> np.uint64:
    return np.uint64(pow(int(_ODD), n, 2**64))


def rolling(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of each ``length`` bytes of ``data``."""
    n = len(data) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    # doubling: the hash of 2m bytes comes from those of its halves
    have, width, out, done = _OF_BYTE[data], 1, None, 0
    rest = length
    while rest:
        if rest & 1:
            part = have[done : done + n]
            out = part.copy() if out is None else out * _powers(width) + part
            done += width
        rest >>= 1
        if rest:
            have = have[:-width] * _powers(width) + have[width:]
            width *= 2
    return mixed(out)


def anchors(prints: np.ndarray) -> np.ndarray:
    """The places of ``prints`` that are least in some run of ``PLACES`` of them; ties all count."""
    n = len(prints)
    if n < PLACES:
        return np.empty(0, np.int64)
    padded = np.full(-(-n // PLACES) * PLACES + PLACES, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = prints
    rows = padded.reshape(-1, PLACES)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - PLACES + 1], ahead[PLACES - 1 : n])  # of the run that begins here
    # a place is an anchor if one of the runs that hold it has its print as the least
    spread = np.zeros(n + PLACES - 1 + PLACES, np.uint64)
    spread[PLACES - 1 : n] = least
    blocks = spread[: (len(spread) // PLACES) * PLACES].reshape(-1, PLACES)
    up = np.maximum.accumulate(blocks, axis=1).ravel()
    down = np.maximum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    most = np.maximum(down[:n], up[PLACES - 1 : n + PLACES - 1])
    return np.flatnonzero(prints == most)


def entries_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """fp, around, pos and right (bytes from the anchor on, of 100) of a text's anchors."""
    prints = rolling(data, GRAM)
    at = anchors(prints)
    left, right = np.minimum(at, BEFORE), np.minimum(len(data) - at, LENGTH)
    # the hash of what is around: where it is cut by an end of the text, of what there is and how much
    around = np.zeros(len(at), np.uint64)
    inner = (left == BEFORE) & (right == LENGTH)
    if inner.any():
        around[inner] = rolling(data, AROUND)[at[inner] - BEFORE]
    for k in np.flatnonzero(~inner).tolist():
        a, b = int(at[k] - left[k]), int(at[k] + right[k])
        cut = hashlib.blake2b(data[a:b].tobytes(), digest_size=8, salt=bytes([left[k], right[k]])).digest()
        around[k] = np.frombuffer(cut, np.uint64)[0]
    fp = prints[at] & np.uint64(2**48 - 1)
    return fp.view(np.int64), around.view(np.int64), at.astype(np.int32), right.astype(np.int32)


def suffix_array(docs: DataFrame) -> DataFrame:
    """ENTRY of the anchors of ``docs`` (key, text); of equal ones at hand only the first is no repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in ENTRY.split(", ")]
        for batch in batches:
            order = np.argsort(batch.column(0).to_numpy(), kind="stable")
            found, texts = [], batch.column(1)
            for row in order.tolist():
                text = texts[row].as_py()
                data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
                if len(data) >= LENGTH:
                    found.append((batch.column(0)[row].as_py(), *entries_of(data)))
            if not found:
                continue
            keys = np.repeat([f[0] for f in found], [len(f[1]) for f in found])
            fp, around, pos, right = (np.concatenate([f[k] for f in found]) for k in range(1, 5))
            both = mixed(fp.view(np.uint64) * _ODD) ^ around.view(np.uint64)
            _, first = np.unique(both, return_index=True)
            repeat = np.ones(len(both), bool)
            repeat[first] = False
            yield pa.record_batch([pa.array(x) for x in (fp, around, keys, pos, right, repeat)], names=names)

    return docs.select("key", "text").mapInArrow(run, ENTRY)


def crowded_anchors(docs: DataFrame) -> list[int]:
    """The hashes of the anchors that would fill a large part of a task, as a sample of ``docs`` shows.

    They decide how entries are dealt to tasks, and no result. There are at most partitions / ``CROWDED_SHARE``.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = docs.sample(min(1.0, SAMPLE / max(docs.count(), 1)), seed=1)
    counts = stored(suffix_array(sample).filter("NOT repeat").groupBy("fp").agg(F.count("*").alias("n")), "anchors")
    total = counts.agg(F.sum("n").alias("n")).first().n or 0
    least = max(CROWDED_LEAST, total * CROWDED_SHARE / partitions)
    return sorted(row.fp for row in counts.filter(F.col("n") >= least).collect())


def dealt(rows: DataFrame, crowded: list[int]) -> DataFrame:
    """``rows`` by anchor; those of crowded anchors by their surroundings too."""
    if not crowded:
        return rows.repartition("fp")
    return rows.repartition("fp", F.when(F.col("fp").isin(crowded), F.col("around")))


SCANNED = "kind string, fp long, around long, key long, pos int, right int"


def scan(entries: DataFrame, levels: list[DataFrame], keep: bool = True, crowded: list[int] | None = None) -> DataFrame:
    """The batch's array and the levels, merged by hash and read in order.

    kind is ``repeat`` (an earlier entry has the same surroundings), ``new`` (the first with them, of
    the batch; only to ``keep`` it) or ``open`` (one of several surroundings of an anchor, the
    batch's among them; with a crowded anchor, any).
    """
    crowded = crowded or []
    known = np.array(crowded, np.int64)
    rows = entries.select(*[c.split()[0] for c in ENTRY.split(", ")[:-1]], "repeat", F.lit(True).alias("fresh"))
    for level in levels:
        rows = rows.unionByName(level.select("*", F.lit(False).alias("repeat"), F.lit(False).alias("fresh")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_groups(batches):
            fp, around, fresh, done = (t[n] for n in ("fp", "around", "fresh", "repeat"))
            same_fp = np.concatenate([[False], fp[1:] == fp[:-1]])
            same = same_fp & np.concatenate([[False], around[1:] == around[:-1]]) | done
            group = np.cumsum(~same_fp) - 1
            kinds = np.bincount(group, ~same)
            is_open = ~same & (((kinds > 1) & (np.bincount(group, fresh & ~same) > 0))[group] | np.isin(fp, known))
            for kind, chosen in (("repeat", same & fresh), ("new", ~same & fresh & keep), ("open", is_open)):
                if chosen.any():
                    yield pa.record_batch(
                        [pa.array([kind] * int(chosen.sum())), *(pa.array(t[n][chosen]) for n in ("fp", "around", "key", "pos", "right"))],
                        names=[c.split()[0] for c in SCANNED.split(", ")],
                    )

    # a repeat is settled; last in its group, it does not stand before the entry that it repeats
    merged = dealt(rows, crowded).sortWithinPartitions("fp", "repeat", "around", "key", "pos")
    return merged.mapInArrow(run, SCANNED)


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The rows in chunks, each with all rows of every ``fp`` in it; the rows come sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        fp = batch.column("fp").to_numpy()
        cut = int(np.searchsorted(fp, fp[-1], side="left"))
        if cut or (held and held[-1].column("fp")[-1].as_py() != fp[0]):
            yield _columns([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield _columns(held)


def _columns(batches: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
    table = pa.Table.from_batches(batches).combine_chunks()
    return {name: table.column(name).to_numpy(zero_copy_only=False) for name in table.column_names}


class SuffixLevels:
    """The family: levels of 1, 2, 4 .. batches; a later batch holds later documents."""

    def __init__(self, crowded: list[int] | None = None) -> None:
        self.levels: list[tuple[int, DataFrame]] = []
        self.crowded = crowded or []

    def add(self, docs: DataFrame, keep: bool = True) -> DataFrame:
        """Scan a batch (key, text) against the levels and, to ``keep`` it, make it one."""
        scanned = stored(scan(suffix_array(docs), [level for _, level in self.levels], keep, self.crowded), "scanned")
        if keep:
            columns = [c.split()[0] for c in SCANNED.split(", ")[1:]]
            self.levels.append((1, scanned.filter("kind = 'new'").select(*columns)))
            while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
                (size, late), (_, early) = self.levels.pop(), self.levels.pop()
                merged = dealt(early.unionByName(late), self.crowded).sortWithinPartitions("fp", "around")
                self.levels.append((2 * size, stored(merged, "level")))
        return scanned.filter("kind <> 'new'")


def surroundings(docs: DataFrame, places: DataFrame) -> DataFrame:
    """fp, key, pos, left, right, bytes around each open place (padded to full length)."""
    by_key = places.groupBy("key").agg(F.collect_list(F.struct("fp", "pos")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                rows = []
                for key, text, found in zip(*(c.to_pylist() for c in batch.slice(begin, 256).columns)):
                    data = text.encode("utf-8", "surrogatepass")
                    for place in found:
                        pos = place["pos"]
                        left, right = min(pos, BEFORE), min(len(data) - pos, LENGTH)
                        cut = data[pos - left : pos + right].rjust(left + right)
                        rows.append((place["fp"], key, pos, left, right, bytes(BEFORE - left) + cut + bytes(LENGTH - right)))
                if rows:
                    yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*rows), pa_schema)], schema=pa_schema)

    pa_schema = pa.schema(
        [("fp", pa.int64()), ("key", pa.int64()), ("pos", pa.int32()), ("left", pa.int32()), ("right", pa.int32()), ("around", pa.binary())]
    )
    named = named_in(places.select("key"))
    joined = docs.select("key", "text").filter(named(F.col("key"))).join(by_key, "key")
    return joined.mapInArrow(run, "fp long, key long, pos int, left int, right int, around binary")


def repeats_within(t: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, starts and ends of what earlier rows of the same anchor have too, by whole strings.

    Rows come in order of fp, then position. For each place that a string of 100 bytes can take around
    the anchor, strings are told apart by a hash and equal ones compared with the first, byte by byte.
    """
    n = len(t["fp"])
    data = np.frombuffer(b"".join(t["around"].tolist()), np.uint8).reshape(n, AROUND)
    columns = np.ascontiguousarray(data.T)
    low, high = np.full(n, PLACES), np.full(n, -1)
    prints = np.zeros(n, np.uint64)
    drop = _powers(LENGTH)
    salt = mixed(t["fp"].view(np.uint64) * _ODD)
    for j in range(LENGTH):
        prints = prints * _ODD + _OF_BYTE[columns[j]]
    for place in range(PLACES):  # the string begins ``before`` bytes before the anchor
        before = BEFORE - place
        if place:
            prints = prints * _ODD + _OF_BYTE[columns[place + LENGTH - 1]] - _OF_BYTE[columns[place - 1]] * drop
        rows = np.flatnonzero((t["left"] >= before) & (t["right"] >= LENGTH - before))
        _, first, back = np.unique(prints[rows] ^ salt[rows], return_index=True, return_inverse=True)
        origin = rows[first][back]
        later = rows != origin
        mine, its = rows[later], origin[later]
        equal = (data[mine, place : place + LENGTH] == data[its, place : place + LENGTH]).all(axis=1)
        mine = mine[equal]
        low[mine] = np.minimum(low[mine], before)
        high[mine] = np.maximum(high[mine], before)
    hit = np.flatnonzero(high >= 0)
    return hit, t["pos"][hit] - high[hit], t["pos"][hit] - low[hit] + LENGTH


def open_repeats(docs: DataFrame, places: DataFrame) -> DataFrame:
    """key, start, end of the repeats around open places."""
    many = places.groupBy("fp").agg(F.count("*").alias("n")).filter(F.col("n") > TOGETHER).select("fp")
    crowds = not many.isEmpty()
    few = surroundings(docs, places.join(many, "fp", "left_anti") if crowds else places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        for t in _whole_groups(batches):
            held.append(t)
            if sum(len(x["fp"]) for x in held) >= CHUNK:
                yield _found(held)
                held = []
        if held:
            yield _found(held)

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                rows = []
                for fp, key, pos, left, right, data in zip(*(c.to_pylist() for c in batch.slice(begin, 256).columns)):
                    for before in range(max(0, LENGTH - right), left + 1):
                        cut = data[BEFORE - before : BEFORE - before + LENGTH]
                        rows.append((before, key, pos, hashlib.blake2b(cut, digest_size=16).digest()))
                if rows:
                    yield pa.record_batch([pa.array(c) for c in zip(*rows)], names=["before", "key", "pos", "string"])

    near = few.repartition("fp").sortWithinPartitions("fp", "key", "pos").mapInArrow(run, "key long, start int, end int")
    if not crowds:
        return near
    around = surroundings(docs, places.join(many, "fp", "left_semi"))
    spread = stored(around.mapInArrow(strings, "before long, key long, pos long, string binary"), "strings")
    firsts = spread.groupBy("string").agg(F.min(F.struct("key", F.expr("pos - before").alias("at"))).alias("first"))
    far = (
        spread.join(firsts, "string")
        .withColumn("start", F.expr("cast(pos - before as int)"))
        .filter((F.col("first.key") != F.col("key")) | (F.col("first.at") != F.col("start")))
        .groupBy("key", "pos")
        .agg(F.min("start").alias("start"), F.max(F.col("start") + LENGTH).cast("int").alias("end"))
    )
    return near.unionByName(far.select("key", "start", "end"))


def _found(held: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
    t = {name: np.concatenate([x[name] for x in held]) for name in held[0]}
    rows, start, end = repeats_within(t)
    return pa.record_batch(
        [pa.array(t["key"][rows], pa.int64()), pa.array(start, pa.int32()), pa.array(end, pa.int32())], names=["key", "start", "end"]
    )


RESULT = "key long, doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left of ``data`` without the spans, and how many maximal runs they make."""
    kept, done, runs = [], 0, 0
    for start, end in sorted(spans):
        if start > done or not runs:
            kept.append(data[done:start])
            runs += 1
        done = max(done, end)
    return b"".join(kept) + data[done:], runs


def remove_repeats(docs: DataFrame, batches: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (the bytes that are left).

    A byte goes if a string of 100 bytes over it also begins earlier: in a row of a smaller doc_id,
    or earlier in the same text. A null doc_id is smaller than any; rows of one doc_id are in order of
    their texts, and of repeated rows all but one lose what is long enough. Null and empty texts, and
    those of under 100 bytes, stay as they are. The documents come in ``batches`` ranges of about as
    many rows. No rows in: no rows out.
    """
    ids = docs.select("doc_id")
    twice = ids.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 OR doc_id IS NULL").isEmpty()
    if twice:
        keyed = docs.select(F.col("doc_id").alias("key"), "doc_id", "text")
    else:  # a key for each row, in the same order
        ordered = docs.select("doc_id", "text").orderBy(F.col("doc_id").asc_nulls_first(), "text")
        keyed = stored(ordered.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text"), "keyed")
    shares = [k / batches for k in range(1, batches)]
    bounds = sorted(set(keyed.stat.approxQuantile("key", shares, 0.01))) if shares else []
    family, parts = SuffixLevels(crowded_anchors(keyed)), []
    for k, (low, high) in enumerate(zip([None, *bounds], [*bounds, None])):
        batch = keyed
        if low is not None:
            batch = batch.filter(F.col("key") > int(low))
        if high is not None:
            batch = batch.filter(F.col("key") <= int(high))
        parts.append(family.add(batch, keep=k < len(bounds)))
    scanned = parts[0]
    for part in parts[1:]:
        scanned = scanned.unionByName(part)
    # an anchor can be open in two batches
    places = stored(scanned.filter("kind = 'open'").select("fp", "key", "pos").distinct(), "places")
    same = scanned.filter((F.col("kind") == "repeat") & (F.least("pos", F.lit(BEFORE)) + F.col("right") >= LENGTH)).select(
        "key", F.greatest(F.col("pos") - BEFORE, F.lit(0)).alias("start"), (F.col("pos") + F.col("right")).alias("end")
    )
    spans = same.unionByName(open_repeats(keyed, places))
    by_key = stored(spans.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                texts = [(x or "").encode("utf-8", "surrogatepass") for x in part.column(2).to_pylist()]
                left = [cut(x, [(s["start"], s["end"]) for s in found or []]) for x, found in zip(texts, part.column(3).to_pylist())]
                yield pa.record_batch(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([len(x) for x in texts], pa.int64()),
                        pa.array([len(x) - len(kept) for x, (kept, _) in zip(texts, left)], pa.int64()),
                        pa.array([runs for _, runs in left], pa.int64()),
                        pa.array([kept for kept, _ in left], pa.binary()),
                    ],
                    names=[c.split()[0] for c in RESULT.split(", ")],
                )

    named = named_in(by_key.select("key"))
    rows = keyed.select("key", "doc_id", "text", named(F.col("key")).alias("named"))
    touched = rows.filter("named").join(by_key, "key", "left").select("key", "doc_id", "text", "spans").mapInArrow(run, RESULT)
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    zero = F.lit(0).cast("long")
    whole = rows.filter("NOT named").select(
        "key", "doc_id", F.octet_length(data).cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), data.alias("kept")
    )
    return touched.unionByName(whole).drop("key")
