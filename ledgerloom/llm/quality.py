"""Quality by co-training: a classifier of the text and one of the page's metadata teach each other.

Both are logistic regressions on their own view. In each round either one labels, of all documents
without a label, those it is surest of, and the other learns from them. At the end each is
calibrated on labelled documents that neither learned from, and the two are combined there.

No document without a label comes to the driver. A histogram of how sure a view is, summed over the
partitions, says where its surest share begins; what those documents teach is the gradient of
the pupil's loss and a bound on its curvature (a quarter of the sum of ``x x'``), summed likewise.
That is a parabola above the loss, which the pupil's next fit adds to that of the labelled rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

TEXT_SIZE = 512
META_SIZE = 64
# Rows that are worked on at once.
SLICE = 256
# How sure a view is, is counted in steps of this many logits from the least on.
STEP, STEPS = 0.05, 400
# Sums of tasks are added in this many groups first, then the groups.
GROUPS = 256
SUMS = pa.schema([("group", pa.int32()), ("pupil", pa.int32()), ("good", pa.bool_()), ("line", pa.int32()), ("n", pa.int64()), ("numbers", pa.binary())])
SCHEMA = "doc_id long, text_score double, meta_score double, score double, kept boolean"


def text_features(text: str | None) -> np.ndarray:
    """Hashed pairs of neighbouring bytes, as square roots of their shares, and the share of kinds."""
    out = np.zeros(TEXT_SIZE, np.float32)
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    if len(data) > 1:
        pairs = (data[:-1].astype(np.uint32) << 8 | data[1:]) * np.uint32(2654435761)
        counts = np.bincount(pairs >> np.uint32(32 - 9), minlength=TEXT_SIZE)
        out += np.sqrt(counts / len(data), dtype=np.float32) * 4
    return out


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Hashed language and source, and the length in powers of two; a null is a value of its own."""
    out = np.zeros(META_SIZE, np.float32)
    length = "none" if n_chars is None else str(max(0, int(n_chars)).bit_length())
    for name, value in (("lang", lang), ("source", source), ("length", length)):
        out[zlib.crc32(f"{name}={value}".encode("utf-8", "surrogatepass")) % META_SIZE] = 1
    return out


@dataclass
class Lesson:
    """What the documents of a teacher say at weights ``at`` (the last one the offset): means over each
    class, which weigh the same, of the gradient and of the bound on the curvature."""

    at: np.ndarray
    gradient: np.ndarray
    curvature: np.ndarray

    def slope(self, w: np.ndarray) -> np.ndarray:
        return self.gradient + self.curvature @ (w - self.at)


@dataclass
class Logistic:
    """Weights and offset of a logistic regression."""

    weights: np.ndarray
    offset: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.offset

    def all_weights(self) -> np.ndarray:
        return np.append(self.weights, self.offset)

    @classmethod
    def fit(
        cls, x: np.ndarray, y: np.ndarray, rate: float = 0.3, balanced: bool = True, steps: int = 400, decay: float = 1e-4,
        lesson: Lesson | None = None, trust: float = 0.0,
    ) -> Logistic:
        """By full-batch Adam; ``balanced``: both classes weigh the same. One class only: a constant.

        A lesson weighs ``trust`` times as much as the rows, however many documents it is from.
        """
        x = x.astype(np.float64)
        share = y.mean() if len(y) else 1.0
        if share in (0.0, 1.0):
            return cls(np.zeros(x.shape[1]), 6.0 if share else -6.0)
        cost = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) if balanced else 1.0
        w = np.zeros(x.shape[1] + 1) if lesson is None else lesson.at.copy()
        m, v = np.zeros_like(w), np.zeros_like(w)
        x1 = np.hstack([x, np.ones((len(x), 1))])
        for t in range(1, steps + 1):
            p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
            g = x1.T @ (cost * (p - y)) / len(y)
            g[:-1] += decay * w[:-1]
            if lesson is not None:
                g += trust * lesson.slope(w)
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        return cls(w[:-1], float(w[-1]))


@dataclass
class CoTrained:
    """The two views, each calibrated, and how they combine."""

    text: Logistic
    meta: Logistic
    calibrations: tuple[Logistic, Logistic]
    combined: Logistic

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        logits = self._calibrated(text, meta)
        combined = self.combined.logit(logits)
        return tuple(1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (logits[:, 0], logits[:, 1], combined))

    def _calibrated(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        views = self.text.logit(text), self.meta.logit(meta)
        return np.stack([c.logit(z[:, None]) for c, z in zip(self.calibrations, views)], axis=1)

    @classmethod
    def fit(
        cls, text: np.ndarray, meta: np.ndarray, y: np.ndarray,
        lessons: Callable[[list[Logistic], int], list[Lesson | None]], rounds: int, trust: float,
    ) -> CoTrained:
        """Every fifth labelled row is held back for calibration; ``lessons`` teaches both views in a round."""
        back = np.arange(len(y)) % 5 == 4
        rows = [(text[~back], y[~back]), (meta[~back], y[~back])]
        views = [Logistic.fit(*own) for own in rows]
        for number in range(1, rounds + 1 if len(set(y[~back])) == 2 else 1):
            told = lessons(views, number)
            views = [Logistic.fit(*own, lesson=lesson, trust=trust) for own, lesson in zip(rows, told)]
        held = (text[back], meta[back]), y[back]
        logits = [view.logit(x)[:, None] for view, x in zip(views, held[0])]
        calibrations = tuple(Logistic.fit(z, held[1], 0.05, balanced=False) for z in logits)
        both = np.stack([c.logit(z) for c, z in zip(calibrations, logits)], axis=1)
        return cls(*views, calibrations, Logistic.fit(both, held[1], 0.05, balanced=False))


def _features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    columns = {name: batch.column(name).to_pylist() for name in ("lang", "source", "n_chars")}
    text = np.stack([text_features(x.as_py()) for x in batch.column("text")])
    meta = np.stack([meta_features(*x) for x in zip(*columns.values())])
    return text, meta


def _labelled(docs: DataFrame, chosen: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label, text and metadata features of the chosen ids in their order; one row for each id.

    Of rows with one id that with the least features counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            packed = [np.concatenate(x).tobytes() for x in zip(*_features(part))]
            columns = [part.column("doc_id"), part.column("good"), pa.array(packed, pa.binary())]
            yield pa.record_batch(columns, names=["doc_id", "good", "features"])

    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    found = (
        docs.select(*columns).join(chosen, "doc_id").mapInArrow(run, "doc_id long, good double, features binary")
        .groupBy("doc_id", "good").agg(F.min("features").alias("features")).collect()
    )
    found.sort(key=lambda row: row.doc_id)
    x = np.frombuffer(b"".join(bytes(r.features) for r in found), np.float32).reshape(-1, TEXT_SIZE + META_SIZE)
    return np.array([r.good for r in found], np.float64), x[:, :TEXT_SIZE], x[:, TEXT_SIZE:]


def unlabelled_features(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``features`` of every row whose id ``known`` has not, in half precision: computed once and stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            packed = [np.concatenate(x).astype(np.float16).tobytes() for x in zip(*_features(part))]
            yield pa.record_batch([part.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "features"])

    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    made = docs.select(*columns).mapInArrow(run, "doc_id long, features binary")
    return stored(made.join(known, "doc_id", "left_anti").select("features"), "op8-features")


def _views_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(batch.column("features").to_pylist()), np.float16)
    x = x.reshape(-1, TEXT_SIZE + META_SIZE).astype(np.float64)
    return x[:, :TEXT_SIZE], x[:, TEXT_SIZE:]


def steps_of(logits: np.ndarray, sure: float) -> np.ndarray:
    """How sure a view is, in steps; -1: less than ``sure``."""
    beyond = np.abs(logits) - np.log(sure / (1 - sure))
    return np.where(beyond < 0, -1, np.minimum(beyond / STEP, STEPS - 1)).astype(np.int32)


def first_steps(counts: dict[tuple[int, bool, int], int], share: float) -> dict[tuple[int, bool], int]:
    """Per view and class: the step from which on its documents teach.

    They are the surest ``share`` of all documents that the view puts in the class. Documents of one
    step stay together, and those of the highest step always teach.
    """
    out = {}
    for view, good in {key[:2] for key in counts}:
        steps = {step: n for (v, g, step), n in counts.items() if (v, g) == (view, good)}
        left = share * sum(steps.values())
        for number, step in enumerate(sorted((s for s in steps if s >= 0), reverse=True)):
            left -= steps[step]
            if number and left < 0:
                break
            out[view, good] = step
    return out


def lessons_of(features: DataFrame, views: list[Logistic], sure: float, share: float) -> list[Lesson | None]:
    """What each view (0: text, 1: metadata) learns from the other's surest documents; None: there are none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, 2, STEPS + 1), np.int64)
        for part in _slices(batches):
            for view, x in enumerate(_views_of(part)):
                logits = views[view].logit(x)
                np.add.at(found, (view, (logits > 0).astype(int), steps_of(logits, sure) + 1), 1)
        view, good, step = found.nonzero()
        yield pa.record_batch(
            [pa.array(view, pa.int32()), pa.array(good > 0), pa.array(step - 1, pa.int32()), pa.array(found[view, good, step])],
            names=["view", "good", "step", "n"],
        )

    counted = features.mapInArrow(count, "view int, good boolean, step int, n long")
    counts = {(r.view, r.good, r.step): r.n for r in counted.groupBy("view", "good", "step").agg(F.sum("n").alias("n")).collect()}
    begin = first_steps(counts, share)

    def teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}  # (pupil, good): number of documents, gradient above curvature
        for part in _slices(batches):
            xs = _views_of(part)
            for pupil in (0, 1):
                teacher = 1 - pupil
                logits = views[teacher].logit(xs[teacher])
                steps = steps_of(logits, sure)
                for good in (False, True):
                    told = ((logits > 0) == good) & (steps >= begin.get((teacher, good), STEPS))
                    if told.any():
                        x = np.hstack([xs[pupil][told], np.ones((told.sum(), 1))])
                        p = 1 / (1 + np.exp(-np.clip(x @ views[pupil].all_weights(), -30, 30)))
                        n, total = sums.get((pupil, good), (0, 0.0))
                        sums[pupil, good] = n + len(x), total + np.vstack([x.T @ (p - good), x.T @ x / 4])
        group = TaskContext.get().partitionId() % GROUPS
        for (pupil, good), (n, total) in sums.items():
            key = {"group": group, "pupil": pupil, "good": good, "n": n}
            yield pa.RecordBatch.from_pylist([key | {"line": k, "numbers": x.tobytes()} for k, x in enumerate(total)], SUMS)

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in rows.column("numbers").to_pylist())
        first = rows.slice(0, 1).to_pylist()[0]
        return pa.Table.from_pylist([first | {"n": sum(rows.column("n").to_pylist()), "numbers": total.tobytes()}], SUMS)

    schema = "group int, pupil int, good boolean, line int, n long, numbers binary"
    key = ["pupil", "good", "line"]
    by_group = features.mapInArrow(teach, schema).groupBy("group", *key).applyInArrow(add, schema)
    lines = by_group.groupBy(*key).applyInArrow(add, schema).collect()
    out = []
    for pupil in (0, 1):
        means = []
        for good in (False, True):
            own = sorted((r.line, np.frombuffer(bytes(r.numbers)) / r.n) for r in lines if (r.pupil, r.good) == (pupil, good))
            means += [np.stack([x for _, x in own])] if own else []
        mean = sum(means) / len(means) if means else None
        out.append(None if mean is None else Lesson(views[pupil].all_weights(), mean[0], mean[1:]))
    return out


def train(
    docs: DataFrame, labels: DataFrame, labelled: int, rounds: int, sure: float, share: float, trust: float
) -> CoTrained:
    """Fits on at most ``labelled`` labels, those whose ids hash lowest, and all documents without a label.

    A doc_id with several labels counts as good if most of them are. In round r either view teaches by
    the surest r times ``share`` of the documents that it puts in each class.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).cast("double").alias("good")
    )
    good, text, meta = _labelled(docs, known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled))
    made = []

    def lessons(views: list[Logistic], number: int) -> list[Lesson | None]:
        if not made:
            made.append(unlabelled_features(docs, known))
        return lessons_of(made[0], views, sure, share * number)

    return CoTrained.fit(text, meta, good, lessons, rounds, trust)


LABELLED, ROUNDS, SURE, SHARE, TRUST, THRESHOLD = 4000, 4, 0.98, 0.05, 0.25, 0.5


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    labelled: int = LABELLED,
    rounds: int = ROUNDS,
    sure: float = SURE,
    share: float = SHARE,
    trust: float = TRUST,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_score, meta_score, score (1 is good), kept.

    ``labels`` has doc_id and quality (1 good, 0 not). ``labelled`` bounds the labelled rows that
    are fitted on; all others teach by ``share`` and ``trust``, and every document is scored, by its whole text. kept: the score is at least ``threshold``.
    Nulls are values: a null text is an empty one, null metadata a kind of its own. Repeated rows
    get equal scores. With labels of one kind only, or none, all documents are as the labels say
    (kept, if there are none). No rows in: no rows out.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, labelled, rounds, sure, share, trust))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            scores = model.value.scores(*_features(part))
            columns = [pa.array(s.astype(np.float64)) for s in scores]
            yield pa.record_batch(
                [part.column("doc_id"), *columns, pa.array(scores[2] >= threshold)],
                names=["doc_id", "text_score", "meta_score", "score", "kept"],
            )

    return docs.select("doc_id", "text", "lang", "source", "n_chars").mapInArrow(run, SCHEMA)


def without_low_quality(
    docs: DataFrame,
    labels: DataFrame,
    labelled: int = LABELLED,
    rounds: int = ROUNDS,
    sure: float = SURE,
    share: float = SHARE,
    trust: float = TRUST,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` that ``quality_scores`` keeps, with all their columns and without a shuffle.

    Nulls, empty texts, repeated rows and empty tables are as there: equal rows stay or go together, and
    without labels all stay.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, labelled, rounds, sure, share, trust))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            yield part.filter(pa.array(model.value.scores(*_features(part))[2] >= threshold))

    return docs.mapInArrow(run, docs.schema)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, SLICE):
            yield batch.slice(begin, SLICE)
