"""Runs of repeated words: stretches that repeat with a period, by maximal pairs.

1. The words of a text become numbers. Two places that begin equal stretches of ``lcp`` words, with
   different words before them and after them, are a maximal pair; at distance p they are the two ends
   of a stretch of ``lcp + p`` words that has period p and that no neighbouring word extends. So with
   ``lcp >= (e - 1) * p`` and ``lcp + p >= min_length`` the pair is a run, and nothing is left to extend.
2. Such a pair has an ``lcp`` of ``base`` words at least. Texts in which no window of so many words
   comes twice (equal fingerprints; a chance equality costs time, no more) have no runs.
3. The others get a suffix array by prefix doubling and the common prefixes of its neighbours.
   ``maximal_pairs`` goes through the tree of LCP intervals from below. Every interval holds its places
   in order and a list of them for every left word; children are joined into the larger one.
4. With e >= 3 the places of an interval that are in reach (at most ``lcp / (e - 1)`` away) are
   equally spaced, so those after a place all have one left word and of those before it only the
   first can have another. A place is therefore compared with one class list on the right and one
   place on the left, whatever the number of classes, and the pairs that are listed are no more than
   the exponents of the runs together.
5. Of pairs that give one stretch the least distance is its smallest period.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from ledgerloom.llm.shingles import mixed

RUN = "struct<start: long, length: long, period: long>"
SCHEMA = (
    "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    f"runs array<{RUN}>, collapsed string"
)
# Texts go through numpy together until they hold so many bytes.
SLICE_BYTES = 1 << 20


class _Numbers(dict):
    """A number for every different word."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


def suffix_levels(words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of ``words``, and for k = 0, 1, ... each place's class by its first 2**k words.

    Numbers that occur once end all comparisons, so texts that end in such a number may stand in a row.
    """
    order = np.argsort(words, kind="stable")
    active, slots, keys = order, np.arange(len(words)), words[order]
    rank = np.empty(len(words), np.int32)
    levels: list[np.ndarray] = []
    while len(active):
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.append(first, len(keys)))
        rank[active] = np.repeat(slots[first], sizes)
        levels.append(rank.copy())
        open_ = np.repeat(sizes > 1, sizes)
        active, slots = active[open_], slots[open_]
        keys = rank[active].astype(np.int64) * (len(words) + 1) + rank[active + (1 << len(levels) - 1)] if len(active) else keys[:0]
        sorting = np.argsort(keys, kind="stable")
        active, keys = active[sorting], keys[sorting]
        order[slots] = active
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray], base: int) -> np.ndarray:
    """Words that neighbours in the suffix array have in common; 0 where they are fewer than ``base``."""
    lcp = np.zeros(max(len(order) - 1, 0), np.int64)
    top = min(base.bit_length() - 1, len(levels) - 1)
    near = np.flatnonzero(levels[top][order[:-1]] == levels[top][order[1:]])
    one, other, length = order[near], order[near + 1], np.zeros(len(near), np.int64)
    for k in reversed(range(len(levels))):
        length += (levels[k][one + length] == levels[k][other + length]).astype(np.int64) << k
    lcp[near] = np.where(length >= base, length, 0)
    return lcp


class _Interval:
    """The places below a node of the tree, in order, and the same by the word before them."""

    __slots__ = ("places", "classes")

    def __init__(self, place: int, left: int):
        self.places = [place]
        self.classes = {left: [place]}

    def take(self, other: _Interval) -> None:
        few = 8 * len(other.places) < len(self.places)
        self.places = _joined(self.places, other.places, few)
        for left, places in other.classes.items():
            mine = self.classes.get(left)
            self.classes[left] = places if mine is None else _joined(mine, places, few)


def _joined(mine: list[int], theirs: list[int], few: bool) -> list[int]:
    if not few:
        return sorted(mine + theirs)
    for place in theirs:
        insort(mine, place)
    return mine


def _pairs_between(large: _Interval, small: _Interval, left: list[int], reach: int) -> Iterator[tuple[int, int]]:
    """Places of two children with different left words, at most ``reach`` apart (see the module, 4)."""
    places = large.places
    for word, own in small.classes.items():
        for place in own:
            after = bisect_right(places, place)
            if after < len(places) and places[after] - place <= reach and left[places[after]] != word:
                theirs = large.classes[left[places[after]]]
                for other in theirs[bisect_right(theirs, place) : bisect_right(theirs, place + reach)]:
                    yield place, other
            before = bisect_left(places, place - reach, 0, after)
            if before < after and left[places[before]] != word:
                yield places[before], place


def maximal_pairs(
    order: list[int], lcp: list[int], left: list[int], times: int
) -> Iterator[tuple[int, int, int]]:
    """``(place, later place, lcp)`` of all maximal pairs that are at most ``lcp / times`` apart.

    ``order`` are places in suffix order, ``lcp[i]`` what those at i and i + 1 have in common, and
    ``left`` the word before each place. The stack holds the intervals that are still open.
    """
    stack: list[tuple[int, _Interval]] = []

    def joined(one: _Interval, two: _Interval, length: int) -> _Interval:
        large, small = (one, two) if len(one.places) >= len(two.places) else (two, one)
        found.extend((a, b, length) for a, b in _pairs_between(large, small, left, length // times))
        large.take(small)
        return large

    found: list[tuple[int, int, int]] = []
    for i, place in enumerate(order):
        node, length = _Interval(place, left[place]), lcp[i] if i < len(lcp) else 0
        while stack and stack[-1][0] > length:
            above, interval = stack.pop()
            node = joined(interval, node, above)
        if stack and stack[-1][0] == length:
            stack[-1] = length, joined(stack[-1][1], node, length)
        elif length:
            stack.append((length, node))
        yield from found
        found.clear()


class RunFinder:
    """Runs of at least ``min_length`` words and ``min_exponent`` periods, 3 or more of them."""

    def __init__(self, min_length: int = 24, min_exponent: int = 3):
        if min_exponent < 3 or min_length < 1:
            raise ValueError("min_exponent is 3 or more, min_length 1 or more")
        self.min_length, self.times = min_length, min_exponent - 1
        # the least lcp with lcp >= times * p and lcp + p >= min_length for some p >= 1
        self.base = max(-(-min_length * self.times // min_exponent), self.times)
        self.factors = np.cumprod(np.full(self.base, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)

    def _repeating(self, texts: list[np.ndarray]) -> np.ndarray:
        """The numbers of the texts in which some window of ``base`` words comes more than once."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        words, owner = np.concatenate(texts), np.repeat(np.arange(len(texts)), sizes)
        windows = len(words) - self.base + 1
        if windows < 2:
            return np.empty(0, np.int64)
        prints, total = mixed(words.astype(np.uint64) + np.uint64(1)), np.zeros(windows, np.uint64)
        for k in range(self.base):
            total += prints[k : k + windows] * self.factors[k]
        inside = owner[:windows] == owner[self.base - 1 :]
        owner = owner[:windows][inside]
        total = mixed(total[inside] + owner.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        ordered = np.sort(total)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        return np.unique(owner[np.isin(total, twice)]) if len(twice) else np.empty(0, np.int64)

    def find(self, texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
        """For every text, given as numbers of words, its runs (start, length, period) by start, then period."""
        runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        chosen = self._repeating(texts) if texts else np.empty(0, np.int64)
        if not len(chosen):
            return runs
        # texts in a row, each after a number of its own, and no word shared by two of them
        starts, parts, at = [], [], 1
        many = 1 + max(int(texts[k].max()) for k in chosen)
        for row, k in enumerate(chosen.tolist()):
            starts.append(at)
            parts += [texts[k] + row * many, [-1 - row]]
            at += len(texts[k]) + 1
        words = np.concatenate([[-1 - len(chosen)], *parts])
        order, levels = suffix_levels(words)
        lcp = common_prefixes(order, levels, self.base)
        del levels
        shared = np.concatenate(([False], lcp > 0)) | np.concatenate((lcp > 0, [False]))
        left = [0, *words.tolist()]  # left[i] is the word before place i
        periods: dict[tuple[int, int], int] = {}
        near = order[shared].tolist(), np.append(lcp, 0)[shared].tolist()
        for place, other, length in maximal_pairs(*near, left, self.times):
            end = other + length
            if end - place >= self.min_length:
                periods[place, end] = min(other - place, periods.get((place, end), other))
        for (start, end), period in sorted((stretch, p) for stretch, p in periods.items()):
            row = bisect_right(starts, start) - 1
            runs[chosen[row]].append((start - starts[row], end - start, period))
        return [sorted(found, key=lambda run: (run[0], run[2])) for found in runs]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but for those that any run contains after its first period, joined by one space."""
    kept, done = [], 0
    for start, end in sorted((start + period, start + length) for start, length, period in runs):
        if end > done:
            kept += words[done : max(start, done)]
            done = end
    return b" ".join(kept + words[done:])


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; of equal ones the first by start, then period."""
    return min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)


def periodic_runs(docs: DataFrame, min_length: int = 24, min_exponent: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, its runs, the strongest of them, the collapsed text.

    A run is a stretch of words with smallest period ``period`` and ``length`` of at least ``min_length``
    and ``min_exponent`` periods that no neighbouring word extends; words are what ASCII blanks part,
    numbered from 0. ``start`` to ``exponent_milli`` (1000 * length / period, rounded down) are of the
    strongest run, null without one. ``collapsed`` leaves out the words that come after a run's first
    period. Null and empty texts have no words, no runs and an empty ``collapsed``. Repeated rows give
    repeated rows, each by its own text; a null doc_id stays. No rows in: no rows out. Every row is
    worked on by itself, without a shuffle; memory is about 100 bytes for each word of the longest
    text in which windows repeat, and no text is cut.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = RunFinder(min_length, min_exponent)
        for batch in batches:
            sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0).to_numpy())
            begin = 0
            while begin < batch.num_rows:
                done = sizes[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(sizes, done + SLICE_BYTES, "right")))
                yield _answer(finder, batch.slice(begin, end - begin))
                begin = end

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def _answer(finder: RunFinder, part: pa.RecordBatch) -> pa.RecordBatch:
    texts = [(text or b"").split() for text in part.column(1).cast(pa.binary()).to_pylist()]
    numbers = _Numbers()
    numbered = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in texts]
    found = finder.find(numbered)
    best = [strongest(runs) or (None, None, None) for runs in found]
    columns = [
        part.column(0),
        pa.array(map(len, texts), pa.int64()),
        pa.array(map(len, found), pa.int64()),
        *[pa.array([run[k] for run in best], pa.int64()) for k in range(3)],
        pa.array([length and 1000 * length // period for _, length, period in best], pa.int64()),
        pa.array(
            [[{"start": s, "length": n, "period": p} for s, n, p in runs] for runs in found],
            pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])),
        ),
        pa.array([collapsed(words, runs) for words, runs in zip(texts, found)], pa.binary()).cast(pa.string()),
    ]
    names = "doc_id n_words n_runs start length period exponent_milli runs collapsed".split()
    return pa.record_batch(columns, names=names)
