"""Hidden Markov language model: trained by Baum-Welch, scored by the scaled forward recursion.

The states emit classes of words: the most frequent words are a class each, the others share
``HASHED`` classes by their hash. A word's probability is its class's under the states times its own
within the class, from the counts of the whole training corpus; so the model's size is fixed and no
word is left out. Texts are cut into words twice, to count them and to store their classes; each pass
of Baum-Welch reads the classes and sums the expected counts of all training documents over the
partitions, and the scores come from the classes too.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import id_remainder, slices, stored

STATES = 8
OWN_CLASS = 16_384
HASHED = 1024
# How classes are stored, all of them below 65,536.
STORED = np.dtype("<u2")
# So many of the most frequent words are at hand in every task; the rest are looked up by a join.
AT_HAND = 131_072
PRIOR = 1000.0
END = ""
# So many tokens, in whole texts, are worked on at once, and so many texts are cut into words.
BLOCK = 800_000
TEXTS = 1024
# Expected counts are added up for so many tokens at once.
COUNTED = 131_072
# Shares are scaled at every so many words: each word takes 1e-26 at the worst (a class and a step seen
# once in 1e10 tokens), so that doubles hold what is between.
SCALED = 8


def tokens_of(texts: pa.Array) -> pa.ListArray:
    """The words of each text, A-Z lower-cased, and one end. Null counts as empty."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(texts.fill_null("")))
    # a blank at the end splits off an empty word; an empty text is one as it is
    ended = pc.binary_join_element_wise(texts, END, " ")
    return pc.ascii_split_whitespace(pc.if_else(pc.equal(texts, ""), END, ended))


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``; after each, what Arrow has freed goes back to the system, since workers live on from step to step."""
    for batch in batches:
        yield batch
        pa.default_memory_pool().release_unused()


def _offsets(lists: pa.ListArray) -> np.ndarray:
    return lists.offsets.to_numpy().astype(np.int64)


def hashed(word: bytes) -> int:
    return zlib.crc32(word) % HASHED


@dataclass
class Words:
    """The counts of the words at hand, and what any word's class and its share of that are."""

    counts: dict[bytes, int]
    tokens: int
    distinct: int
    hashed_tokens: np.ndarray  # training tokens and distinct words by hash, of all words
    hashed_words: np.ndarray

    def __post_init__(self) -> None:
        order = sorted(self.counts, key=lambda word: (-self.counts[word], word))
        count = np.array([self.counts[word] for word in order], np.float64)
        hashes = np.array([hashed(word) for word in order], np.int32)
        own = np.arange(len(order)) < OWN_CLASS
        self.words = pa.array(order, pa.binary())  # by rank
        del self.counts
        # of the hashed classes, what is left when the words with a class of their own are taken out
        tokens = self.hashed_tokens - np.bincount(hashes[own], count[own], HASHED)
        words = self.hashed_words - np.bincount(hashes[own], minlength=HASHED)
        self.hashed_total = tokens + 0.5 * (words + 1)
        self.class_total = np.concatenate([np.pad(count[:OWN_CLASS], (0, OWN_CLASS - own.sum())), tokens])
        self.base_total = self.tokens + 0.5 * (self.distinct + 1)
        # by rank: the class, log10 of the word's share of its class and of its base probability
        # and nothing for rank -1
        self.classes = np.append(np.where(own, np.arange(len(order)), OWN_CLASS + hashes), 0).astype(STORED)
        self.shares = np.append(np.where(own, 0.0, np.log10((count + 0.5) / self.hashed_total[hashes])), 0.0)
        self.bases = np.append(np.log10((count + 0.5) / self.base_total), 0.0)

    def look_up(self, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The rank, -1 if it is not at hand, and the class of each token; each distinct one is looked up once."""
        found = tokens.cast(pa.binary()).dictionary_encode()
        ranks = pc.index_in(found.dictionary, value_set=self.words).fill_null(-1).to_numpy()
        far = np.flatnonzero(ranks < 0)
        rest = found.dictionary.take(pa.array(far)).to_numpy(zero_copy_only=False)
        classes = self.classes[ranks]
        classes[far] = [OWN_CLASS + hashed(word) for word in rest]
        at = found.indices.to_numpy()
        return ranks[at], classes[at]


@dataclass
class Model:
    """start (states), step (states x states) and emit (classes x states)."""

    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray

    def forward(
        self, classes: np.ndarray, active: list[int], keep: np.ndarray | None = None
    ) -> list[tuple[int, np.ndarray]]:
        """Scales of the forward recursion by time: the first text that is scaled, and the scales from it on.

        ``classes`` are those of all texts by time, the longest text first, ``active`` how many texts
        there are at each time. The product of a text's scales, the last of which is at its end, is its
        likelihood. The scaled state shares go to ``keep``, in the order of ``classes``.
        """
        states = len(self.start)
        ones = np.ones(states)
        own, moved = np.empty((2, active[0], states))
        share = own
        scales = []
        begin = 0
        for t, (n, after) in enumerate(zip(active, [*active[1:], 0])):
            came = np.matmul(share[:n], self.step, out=moved[:n]) if t else self.start
            share = own[:n] if keep is None else keep[begin : begin + n]
            np.take(self.emit, classes[begin : begin + n], axis=0, out=share, mode="clip")
            share *= came
            first = 0 if t % SCALED == 0 else after
            total = share[first:] @ ones
            share[first:] /= total[:, None]
            scales.append((first, total))
            begin += n
        return scales

    def log_likelihood(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 of each text's likelihood; ``texts`` are arrays of classes."""
        out = np.empty(len(texts))
        for rows, classes, active in blocks(texts):
            sums = np.zeros(len(rows))
            for first, total in self.forward(classes, active):
                sums[first : first + len(total)] += np.log10(total)
            out[rows] = sums
        return out

    def expected(self, texts: list[np.ndarray]) -> Expected:
        """The expected counts over ``texts``."""
        out = Expected.nothing()
        states = len(self.start)
        back_step = np.ascontiguousarray(self.step.T)
        room = np.empty((0, states))
        for _, classes, active in blocks(texts):
            if len(room) < len(classes):
                room = np.empty((len(classes), states))
            share = room[: len(classes)]
            scales = self.forward(classes, active, share)
            back = np.ones((active[0], states))
            ahead = np.empty((active[0], states))
            moves = np.zeros_like(self.step)
            end = len(classes)
            for t in range(len(active) - 1, 0, -1):
                n = active[t]
                begin = end - n
                here = np.take(self.emit, classes[begin:end], axis=0, out=ahead[:n], mode="clip")
                here *= back[:n]
                first, total = scales[t]
                here[first:] /= total[:, None]
                before = begin - active[t - 1]
                moves += share[before : before + n].T @ here
                share[begin:end] *= back[:n]
                np.matmul(here, back_step, out=back[:n])
                end = begin
            share[:end] *= back
            out.start += share[:end].sum(axis=0)
            out.step += moves * self.step
            for begin in range(0, len(classes), COUNTED):
                part = classes[begin : begin + COUNTED]
                by_state = np.ascontiguousarray(share[begin : begin + COUNTED].T)
                for k in range(states):
                    out.emit[:, k] += np.bincount(part, by_state[k], minlength=len(out.emit))
        return out


def blocks(texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
    """Numbers of some texts, longest first, their classes by time, and how many texts there are at each time."""
    lengths = np.array([len(text) for text in texts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    ends = np.cumsum(lengths[order])
    begin = 0
    while begin < len(order):
        done = ends[begin - 1] if begin else 0
        until = max(begin + 1, int(np.searchsorted(ends, done + BLOCK, side="right")))
        rows = order[begin:until]
        active = np.searchsorted(-lengths[rows], -np.arange(lengths[rows[0]]), side="left")
        starts = np.concatenate([[0], np.cumsum(active)])
        classes = np.empty(starts[-1], np.intp)
        for place, row in enumerate(rows.tolist()):
            classes[starts[: lengths[row]] + place] = texts[row]
        yield rows, classes, active.tolist()
        begin = until


@dataclass
class Expected:
    """Expected counts; they add up over texts, tasks and partitions."""

    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray

    @classmethod
    def nothing(cls) -> Expected:
        return cls(np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((OWN_CLASS + HASHED, STATES)))

    def add(self, other: Expected) -> None:
        self.start += other.start
        self.step += other.step
        self.emit += other.emit

    def rows(self) -> Iterator[tuple[int, np.ndarray]]:
        """Number and counts: the classes, then the steps from each state, then the start."""
        for at in np.flatnonzero(self.emit.any(axis=1)).tolist():
            yield at, self.emit[at]
        for k in range(STATES):
            yield len(self.emit) + k, self.step[k]
        yield len(self.emit) + STATES, self.start

    @classmethod
    def of_rows(cls, rows: list[tuple[int, list[float]]]) -> Expected:
        out = cls.nothing()
        everything = np.concatenate([out.emit, out.step, out.start[None]])
        for at, counts in rows:
            everything[at] = counts
        return cls(everything[-1], everything[len(out.emit) : -1], everything[: len(out.emit)])

    def model(self, classes: np.ndarray) -> Model:
        """The likeliest model, drawn to the classes' shares of all tokens so that none is impossible."""
        share = (classes + 0.5) / (classes + 0.5).sum()
        emit = self.emit + PRIOR * share[:, None]
        step = self.step + 1.0
        start = self.start + 1.0
        return Model(start / start.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def training(docs: DataFrame) -> DataFrame:
    return docs.filter(id_remainder(F.col("doc_id"), 5) != 1)


def token_counts(docs: DataFrame) -> DataFrame:
    """word (binary, the end is empty), c of the training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            parts = [tokens_of(part.column(0)).values.value_counts() for part in released(slices([batch], TEXTS))]
            words = pa.chunked_array([part.field("values").cast(pa.binary()) for part in parts], pa.binary())
            counts = pa.chunked_array([part.field("counts") for part in parts], pa.int64())
            found = pa.table([words, counts], names=["word", "n"])
            found = found.group_by("word", use_threads=False).aggregate([("n", "sum")]).select(["word", "n_sum"])
            yield from found.rename_columns(["word", "c"]).to_batches()

    parts = training(docs).select("text").mapInArrow(run, "word binary, c long")
    return stored(parts.groupBy("word").agg(F.sum("c").alias("c")), "token-counts")


def known_words(counts: DataFrame) -> Words:
    """Frequent words, ``AT_HAND`` at most, and sums over all words by hash.

    They are the words from a count on, which a histogram of counts gives: no task or driver sorts
    the vocabulary, and the driver gets the words themselves and no more.
    """
    steps = F.floor(F.log2("c") * 16).cast("int")
    histogram = counts.groupBy(steps.alias("step")).agg(F.count("*").alias("v")).collect()  # 1024 rows at most
    least, room = None, AT_HAND
    for row in sorted(histogram, key=lambda row: -row.step):
        room -= row.v
        if room < 0:
            break
        least = row.step
    at_hand = [] if least is None else counts.filter(steps >= least).collect()
    sums = counts.groupBy((F.crc32("word") % HASHED).alias("h")).agg(F.sum("c").alias("c"), F.count("*").alias("v"))
    tokens, words = np.zeros(HASHED), np.zeros(HASHED)
    for row in sums.collect():  # HASHED rows at most
        tokens[row.h], words[row.h] = row.c, row.v
    return Words({bytes(row.word): row.c for row in at_hand}, int(tokens.sum()), int(words.sum()), tokens, words)


def texts_of(stored_classes: pa.Array) -> list[np.ndarray]:
    """The classes of each text from how they are stored."""
    return [np.frombuffer(text.as_buffer(), STORED) for text in stored_classes]


def chance_model(words: Words) -> Model:
    """Where Baum-Welch begins: every class's tokens dealt to the states by chance."""
    rng = np.random.default_rng(0)
    guess = Expected.nothing()
    guess.emit += words.class_total[:, None] * rng.dirichlet(np.ones(STATES), len(guess.emit))
    guess.step += np.eye(STATES) * 1000
    return guess.model(words.class_total)


def first_model(docs: DataFrame, words: Words, sample: int, longest: int, passes: int) -> Model:
    """``passes`` of Baum-Welch from chance on ``sample`` training texts of up to ``longest`` bytes; not the default."""
    model = chance_model(words)
    chosen = (
        training(docs).filter(F.octet_length("text").between(1, longest)).select("doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    rows = training(docs).join(chosen, "doc_id", "left_semi").select("doc_id", "text").filter(F.octet_length("text") <= longest)
    texts = [row.text for row in sorted(rows.limit(2 * sample).collect(), key=lambda row: (row.doc_id, row.text))]
    tokens = tokens_of(pa.array(texts, pa.string()))
    classes = np.split(words.look_up(tokens.values)[1], _offsets(tokens)[1:-1]) if texts else []
    for _ in range(passes if texts else 0):
        model = model.expected(classes).model(words.class_total)
    return model


def baum_welch(encoded: DataFrame, words: Words, model: Model) -> Model:
    """One pass over all training documents; counts are summed by task, then over the partitions."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        total = Expected.nothing()
        for batch in released(batches):
            total.add(model.expected(texts_of(batch.column(0))))
        at, counts = zip(*total.rows())
        yield pa.record_batch(
            [pa.array(at, pa.int32()), *(pa.array(np.array(counts)[:, k]) for k in range(STATES))],
            names=["at", *names],
        )

    names = [f"s{k}" for k in range(STATES)]
    schema = "at int, " + ", ".join(f"{name} double" for name in names)
    learned = encoded.filter(~F.col("held_out")).select("classes").mapInArrow(run, schema)
    rows = learned.groupBy("at").agg(*(F.sum(n).alias(n) for n in names))
    return Expected.of_rows([(row.at, list(row)[1:]) for row in rows.collect()]).model(words.class_total)


ENCODED = (
    "key long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, shares double, "
    "rest array<binary>, classes binary"
)


def encode(docs: DataFrame, words: Words) -> DataFrame:
    """The classes of every text, and what its score takes from the counts of its words at hand; the rest of its words."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for part in released(slices(batches, TEXTS)):
            tokens = tokens_of(part.column(3))
            ends = _offsets(tokens)
            begins = ends[:-1]
            ranks, classes = words.look_up(tokens.values)
            far = np.flatnonzero(ranks < 0)
            columns = [
                pa.array(np.diff(ends)),
                pa.array(np.add.reduceat(ranks >= 0, begins, dtype=np.int64)),
                pa.array(np.add.reduceat(words.bases[ranks], begins)),
                pa.array(np.add.reduceat(words.shares[ranks], begins)),
                pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(far, ends), pa.int32()), tokens.values.take(pa.array(far)).cast(pa.binary())
                ),
                pa.Array.from_buffers(
                    pa.binary(), len(begins),
                    [None, pa.py_buffer((ends * STORED.itemsize).astype(np.int32)), pa.py_buffer(classes)],
                ),
            ]
            yield pa.record_batch([*part.columns[:3], *columns], names=[c.split()[0] for c in ENCODED.split(", ")])

    inputs = docs.select(
        F.monotonically_increasing_id().alias("key"), "doc_id",
        (id_remainder(F.col("doc_id"), 5) == 1).alias("held_out"), "text",
    )
    return stored(inputs.mapInArrow(run, ENCODED), "encoded")


def score_documents(
    docs: DataFrame, passes: int = 2, sample: int | None = None, longest: int = 16_384, sample_passes: int = 12
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the documents whose id's crc32 modulo 5 is not 1 (held_out: it is 1), all of them in
    every pass from chance on: ``sample_passes`` and then ``passes``. With a ``sample`` the first
    ``sample_passes`` read only so many of up to ``longest`` bytes. score is the log10 of the
    exact likelihood of the whole text with its end, base_score that of the smoothed word counts.
    Null and empty texts are one token, the end. Repeated rows each have a row and each count in
    training. Without training documents every token is new. No rows in: no rows out.
    """
    counts = token_counts(docs)
    words = known_words(counts)
    model = chance_model(words) if sample is None else first_model(docs, words, sample, longest, sample_passes)
    encoded = encode(docs, words)
    whole = passes if sample is not None else sample_passes + passes
    for _ in range(whole if words.tokens else 0):
        model = baum_welch(encoded, words, model)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    carried = ["key", "doc_id", "held_out", "n_tokens", "n_known", "base"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in released(batches):
            own = model.log_likelihood(texts_of(batch.column("classes"))) + batch.column("shares").to_numpy()
            yield pa.record_batch([*batch.columns[: len(carried)], pa.array(own)], names=[*carried, "own"])

    schema = ", ".join(c for c in ENCODED.split(", ") if c.split()[0] in carried) + ", own double"
    scored = stored(encoded.select(*carried, "shares", "classes").mapInArrow(run, schema), "scored")
    totals = docs.sparkSession.createDataFrame(
        [(h, float(total)) for h, total in enumerate(words.hashed_total)], "h long, of_class double"
    )
    smoothed = F.coalesce("c", F.lit(0)) + 0.5
    rest = (
        encoded.select("key", F.explode("rest").alias("word"))
        .join(counts, "word", "left")
        .withColumn("h", F.crc32("word") % HASHED)
        .join(F.broadcast(totals), "h")
        .groupBy("key")
        .agg(
            F.count("c").alias("rest_known"),
            F.sum(F.log10(smoothed / F.lit(float(words.base_total)))).alias("rest_base"),
            F.sum(F.log10(smoothed / F.col("of_class"))).alias("rest_own"),
        )
    )
    zero = F.lit(0.0)
    return scored.join(rest, "key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest_base", zero)).alias("base_score"),
        (F.col("own") + F.coalesce("rest_own", zero)).alias("score"),
    )
