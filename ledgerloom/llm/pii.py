"""Personal data: rules, and a character-level BiLSTM-CRF that adds what the rules do not see.

The rules find e-mail addresses, IP addresses, card and phone numbers by pattern. The model is
trained on labelled spans: what the rules find in a bounded sample of documents, and the same kinds
of values, also written in other ways, put into the documents' own text. It labels whole texts in
overlapping windows. Each character takes the label of the window in which it lies deepest, and
spans are read from the labels of the whole text, so that none is cut or doubled by a window.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.bilstm import Tagger, character_classes

KINDS = ["email", "ip", "card", "phone"]
# The patterns of the rules. A local part is looked for backwards from its @.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

WINDOW = 512
MARGIN = 32
WINDOWS_AT_ONCE = 1024
TRAIN_WINDOW = 96

Span = tuple[int, int, int]  # start, number of the kind, end


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def is_card(text: str) -> bool:
    digits = digits_of(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def is_phone(text: str) -> bool:
    return 9 <= len(digits_of(text)) <= 15


def are_bytes(parts: list[str]) -> bool:
    stripped = [part.lstrip("0") for part in parts]
    return all(len(part) <= 3 and int(part or "0") <= 255 for part in stripped)


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def rule_spans(text: str) -> list[Span]:
    """The spans of the rules, in order of start and kind."""
    found = [(start, 0, end) for start, end in emails(text)] if "@" in text else []
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if are_bytes(m.group().split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if is_card(m.group())]
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if is_phone(m.group())]
    return sorted(found)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


# --- what the model learns from -------------------------------------------------------------


def _value(kind: int, rng: np.random.Generator, words: list[str]) -> str:
    """A value of a kind, written by the rules or in another way."""

    def number(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))

    way = int(rng.integers(0, 6))
    if kind == 0:
        user, host = (re.sub("[^a-z0-9]", "", words[rng.integers(len(words))].lower()) or "info" for _ in range(2))
        end = ["com", "org", "net", "edu", "io"][rng.integers(5)]
        at = ["@", "@", "@", " at ", " [at] ", "(at)"][way]
        return f"{user}{at}{host}{[' dot ', ' [dot] ', '.'][way - 3] if way > 2 else '.'}{end}"
    if kind == 1:
        return [".", ".", ".", "[.]", " . ", "(.)"][way].join(str(x) for x in rng.integers(0, 256, 4))
    if kind == 2:
        body = str(rng.integers(3, 7)) + number(14)
        digits = next(body + str(d) for d in range(10) if luhn(body + str(d)))
        mark = ["", " ", "-", ".", "/", "  "][way]
        return mark.join(digits[i : i + 4] for i in range(0, 16, 4))
    code = str(rng.integers(1, 99))
    a, b, c = number(3), number(3), number(4)
    return [
        f"+{code} {a} {b} {c}", f"+{code}-{a}-{b}-{c}", f"+{code} ({a}) {b}-{c}",
        f"00{code} {a} {b} {c}", f"({a}) {b}-{c}", f"+{code}/{a}/{b}{c}",
    ][way]


def _decoy(rng: np.random.Generator) -> str:
    """Figures that are no personal data."""
    n = [str(x) for x in rng.integers(0, 100, 4)]
    return [f"{n[0]}.{n[1]}", f"v{n[0]}.{n[1]}.{n[2]}", f"20{n[0]}-{n[1]}-{n[2]}", "#" + "".join(n), n[0], f"{n[0]}:{n[1]}"][
        rng.integers(6)
    ]


def training_windows(texts: list[str], count: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Windows of character classes and their labels (0 outside, else the kind's number and 1)."""
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    texts = [text for text in texts if len(text) > 20]
    marked = [(text, spans) for text in texts if (spans := rule_spans(text))]
    for number in range(count if texts else 0):
        if marked and number % 4 == 0:  # what the rules find, in place
            text, spans = marked[rng.integers(len(marked))]
            start = spans[rng.integers(len(spans))][0]
        else:
            text = texts[rng.integers(len(texts))]
            start = int(rng.integers(0, len(text)))
            if number % 4 < 3:
                words = text[max(0, start - 200) : start + 200].split() or ["info"]
                kind = int(rng.integers(0, len(KINDS) + 1))
                value = _value(kind, rng, words) if kind < len(KINDS) else _decoy(rng)
                start = text.rfind(" ", 0, start) + 1
                head, tail = text[max(0, start - TRAIN_WINDOW) : start], text[start : start + TRAIN_WINDOW]
                text, start = f"{head}{value} {tail}", len(head)
                spans = [(start, kind, start + len(value))] if kind < len(KINDS) else []
            else:
                spans = rule_spans(text)
        begin = max(0, start - int(rng.integers(0, TRAIN_WINDOW)))
        cut = text[begin : begin + TRAIN_WINDOW].ljust(TRAIN_WINDOW)
        marks = np.zeros(TRAIN_WINDOW, np.int64)
        for s, kind, e in sorted(spans, key=lambda span: -span[1]):
            marks[max(0, s - begin) : max(0, e - begin)] = kind + 1
        rows.append(character_classes(cut))
        labels.append(marks)
    return np.array(rows).reshape(-1, TRAIN_WINDOW), np.array(labels).reshape(-1, TRAIN_WINDOW)


def train(docs: DataFrame, sample: int, longest: int, windows: int, steps: int) -> Tagger:
    """Fits on texts of up to ``longest`` bytes of the ``sample`` documents whose ids hash lowest."""
    chosen = (
        docs.filter(F.octet_length("text").between(21, longest)).select("doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    rows = docs.filter(F.octet_length("text") <= longest).join(chosen, "doc_id", "left_semi").select("doc_id", "text")
    texts = [row.text for row in sorted(rows.limit(2 * sample).collect(), key=lambda row: (row.doc_id, row.text))]
    tagger = Tagger(len(KINDS))
    if texts:
        tagger.train(*training_windows(texts, windows), steps)
    return tagger.packed()


# --- what it adds -------------------------------------------------------------------------


def text_labels(tagger: Tagger, texts: list[str]) -> list[np.ndarray]:
    """The label of each character of each text, from overlapping windows."""
    pieces: list[tuple[int, int, np.ndarray]] = []  # text, where the window begins, its classes
    for i, text in enumerate(texts):
        classes = character_classes(text)
        for begin in range(0, max(len(text) - 2 * MARGIN, 1), WINDOW - 2 * MARGIN):
            pieces.append((i, begin, classes[begin : begin + WINDOW]))
    out = [np.zeros(len(text), np.int8) for text in texts]
    order = sorted(range(len(pieces)), key=lambda k: -len(pieces[k][2]))
    for first in range(0, len(order), WINDOWS_AT_ONCE):
        some = [pieces[k] for k in order[first : first + WINDOWS_AT_ONCE]]
        longest = len(some[0][2])
        if not longest:
            continue
        block = np.full((len(some), longest), ord(" "), np.int32)
        for row, (_, _, classes) in enumerate(some):
            block[row, : len(classes)] = classes
        labels = tagger.labels(np.ascontiguousarray(block.T)).T
        for row in np.flatnonzero(labels.any(axis=1)).tolist():
            i, begin, classes = some[row]
            # each character belongs to the window in which it is farthest from both ends
            low = MARGIN if begin else 0
            high = len(classes) if begin + len(classes) >= len(out[i]) else len(classes) - MARGIN
            out[i][begin + low : begin + high] = labels[row, low:high]
    return out


def plausible(kind: int, value: str) -> bool:
    """Whether a value that the model marks can be one of its kind."""
    if kind == 0:
        return bool(re.fullmatch(r"[\w.%+-]+ ?[\[(]?(?:@|at)[\])]? ?[\w-]+(?: ?[\[(]?(?:\.|dot)[\])]? ?[\w-]+)+", value)) and (
            "@" in value or "at" in re.split(r"[^a-z]+", value)
        )
    if kind == 1:
        parts = re.split("[^0-9]+", value)
        return len(parts) == 4 and all(parts) and are_bytes(parts)
    if not re.fullmatch(r"[+(]*[0-9][0-9\s().\-/+]*[0-9]", value):
        return False
    return is_card(value) if kind == 2 else is_phone(value)


def added_spans(text: str, labels: np.ndarray, rules: list[Span]) -> list[Span]:
    """The model's spans that are plausible and touch none of the rules'."""
    edges = np.flatnonzero(np.diff(labels, prepend=0, append=0))
    out = []
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        kind = int(labels[start]) - 1
        if kind < 0:
            continue
        value = text[start:end]
        start += len(value) - len(value.lstrip())
        end -= len(value) - len(value.rstrip())
        while start and text[start - 1].isalnum():  # a value does not begin or end inside a word
            start -= 1
        while end < len(text) and text[end].isalnum():
            end += 1
        if not any(s < end and start < e for s, _, e in rules) and plausible(kind, text[start:end]):
            out.append((start, kind, end))
    return out


SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
)


def find_personal_data(docs: DataFrame, sample: int = 1500, longest: int = 16_384, windows: int = 6000, steps: int = 300) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The counts and base_sha256 are of the rules' spans, spans has these and the model's. Offsets
    are code points, the end is exclusive. Null counts as empty and has none. Very long texts are read
    whole, repeated rows each by themselves. ``sample`` (texts of up to ``longest`` bytes),
    ``windows`` and ``steps`` bound what the model is fitted on. Without any text to learn from, the
    model adds what a blank one does: nothing that is not plausible. No rows in: no rows out.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, sample, longest, windows, steps))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                texts = [text or "" for text in part.column(1).to_pylist()]
                rules = [rule_spans(text) for text in texts]
                added = [added_spans(*x) for x in zip(texts, text_labels(model.value, texts), rules)]
                counts = np.array([[sum(s[1] == k for s in spans) for k in range(len(KINDS))] for spans in rules])
                yield pa.record_batch(
                    [
                        part.column(0),
                        *(pa.array(counts[:, k], pa.int64()) for k in range(len(KINDS))),
                        pa.array([hashlib.sha256(written(spans).encode()).hexdigest() for spans in rules]),
                        pa.array([written(sorted(a + b)) for a, b in zip(rules, added)]),
                        pa.array([len(a) for a in added], pa.int64()),
                    ],
                    names=[c.split()[0] for c in SCHEMA.split(", ")],
                )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
