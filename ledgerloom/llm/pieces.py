"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces and their log scores come from a model file of a public tokenizer; nothing is trained.
A space becomes the marker, one marker stands before the text, characters without a piece become
byte pieces. Decoding joins the pieces and the bytes, turns markers into spaces and drops the first.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MARKER = "▁"
MARKER_BYTES = MARKER.encode()
# Fixed values of the format: what an unknown character costs below the worst piece.
UNKNOWN_PENALTY = 10.0
# A byte that UTF-8 never has, and a key that no part of a text can be.
NO_BYTE = b"\xff"
LITERAL = "\ud800"
MARKS = ".,!?;:\n\r\t"
CACHED_WORDS = 400_000
LONG_WORD = 48
WORDS_AT_ONCE = 8192


class Vocabulary:
    """Pieces with scores, the 256 byte pieces, and the double-array trie over the pieces."""

    def __init__(self, pieces: list[tuple[int, bytes, float]], byte_ids: list[int]):
        """``pieces``: id, UTF-8 bytes, log score of every ordinary piece. ``byte_ids``: by byte."""
        self.byte_ids = byte_ids
        self.scores = {i: score for i, _, score in pieces}
        self.text = {i: data for i, data, _ in pieces}
        self.byte_of = {i: byte for byte, i in enumerate(byte_ids)}
        self.unknown_score = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.base, self.check, self.value = double_array({data: i for i, data, _ in pieces})
        self.parts = self._cutter([data.decode() for _, data, _ in pieces])

    @staticmethod
    def _cutter(pieces: list[str]) -> Callable[[str], list[str]]:
        """A function that cuts marked text only where no piece reaches across.

        That is before a run of markers that follows other text, and between a letter and a mark of
        ``MARKS``, as far as the pieces at hand allow it.
        """
        if any(MARKER in piece.lstrip(MARKER) for piece in pieces):
            return lambda text: [text]
        marks = "".join(
            mark for mark in MARKS if not any(a.isalpha() and b == mark for piece in pieces for a, b in zip(piece, piece[1:]))
        )
        letters = f"{MARKER}*[^\\W\\d_]+(?=[{re.escape(marks + MARKER)}]|\\Z)|" if marks else ""
        return re.compile(f"{letters}{MARKER}*[^{MARKER}]+|{MARKER}+").findall

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        ordinary = [
            (i, model.id_to_piece(i).encode(), model.get_score(i))
            for i in ids
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        byte_ids = [model.piece_to_id(f"<0x{byte:02X}>") for byte in range(256)]
        if not all(map(model.is_byte, byte_ids)):
            raise ValueError(f"{path} has no byte pieces")
        return cls(ordinary, byte_ids)


def double_array(words: dict[bytes, int]) -> tuple[list[int], list[int], list[int]]:
    """base, check and value: from state s, byte b leads to t = base[s] + b + 1 if check[t] == s.

    value[s] is the word's number where a word ends, else -1. State 0 is the root.
    """
    tree: dict = {}
    for word, number in words.items():
        node = tree
        for byte in word:
            node = node.setdefault(byte, {})
        node[-1] = number
    size = 1024
    base, check, value = [0] * size, [-1] * size, [-1] * size
    used = np.zeros(size, dtype=bool)
    used[0] = True
    first_free = 1
    waiting = [(0, tree)]
    while waiting:
        state, node = waiting.pop()
        value[state] = node.get(-1, -1)
        steps = sorted(byte + 1 for byte in node if byte >= 0)
        if not steps:
            continue
        while True:
            while first_free < len(used) and used[first_free]:
                first_free += 1
            begin = max(1, first_free - steps[0])
            room = len(used) - steps[-1] - begin
            if room > 0:
                taken = np.zeros(room, dtype=bool)
                for step in steps:
                    taken |= used[begin + step : begin + step + room]
                free = np.flatnonzero(~taken)
                if len(free):
                    place = begin + int(free[0])
                    break
            grow = len(used)
            base += [0] * grow
            check += [-1] * grow
            value += [-1] * grow
            used = np.concatenate([used, np.zeros(grow, dtype=bool)])
        base[state] = place
        for step in steps:
            used[place + step] = True
            check[place + step] = state
            waiting.append((place + step, node[step - 1]))
    return base, check, value


class _Words(dict):
    """Packed ids by word; what stands for a marker of the text outlasts ``clear``."""

    def clear(self) -> None:
        literal = self[LITERAL]
        super().clear()
        self[LITERAL] = literal


class Codec:
    """Encodes and decodes texts with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = v = vocabulary
        literal = np.array([v.byte_ids[byte] for byte in MARKER_BYTES], np.int32).tobytes()
        self.cache: dict[str, bytes] = _Words({LITERAL: literal})
        self.plain = {i: data.replace(MARKER_BYTES, b" ") for i, data in v.text.items()}
        self.plain |= {i: bytes([byte]) for i, byte in v.byte_of.items()}
        # the same arrays for many words at once; padded, so that any step stays inside
        self.base = np.array(v.base, np.int32)
        self.check = np.append(np.array(v.check, np.int32), np.full(257, -1, np.int32))
        self.value = np.array(v.value, np.int32)
        self.score = np.full(max(v.scores, default=0) + 1, -np.inf)
        self.score[list(v.scores)] = list(v.scores.values())

    def viterbi(self, data: bytes) -> tuple[int, ...]:
        """The ids of the best path over ``data``: the largest sum of scores.

        Of equal sums, the path whose last piece starts first wins, and so on leftwards. A character
        that no piece starts with costs ``unknown_score`` and gives one byte piece for each byte.
        """
        v = self.v
        base, check, value, scores = v.base, v.check, v.value, v.scores
        limit, n = len(base), len(data)
        best: list[float | None] = [None] * (n + 1)
        piece, start = [-1] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            so_far = best[i]
            if so_far is None:
                continue
            lead = data[i]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            state, whole = 0, False
            for j in range(i, n):
                step = base[state] + data[j] + 1
                if step >= limit or check[step] != state:
                    break
                state = step
                if value[state] >= 0:
                    end = j + 1
                    whole |= end - i == width
                    score = so_far + scores[value[state]]
                    if best[end] is None or score > best[end]:
                        best[end], piece[end], start[end] = score, value[state], i
            if not whole:
                end = i + width
                score = so_far + v.unknown_score
                if best[end] is None or score > best[end]:
                    best[end], piece[end], start[end] = score, -1, i
        out: list[int] = []
        end = n
        while end:
            begin = start[end]
            if piece[end] >= 0:
                out.append(piece[end])
            else:
                out.extend(v.byte_ids[byte] for byte in reversed(data[begin:end]))
            end = begin
        return tuple(reversed(out))

    def viterbi_many(self, words: list[bytes]) -> list[bytes]:
        """``viterbi`` of each word, all at once and packed: the same sums, the same choice among ties."""
        n, longest = len(words), max(map(len, words), default=0)
        lengths = np.array([len(word) for word in words], np.int32)
        padded = b"".join([word.ljust(longest, NO_BYTE) for word in words])
        data = np.frombuffer(padded, np.uint8).reshape(n, longest).T.astype(np.int32) + 1
        best = np.full((longest + 5, n), -np.inf)
        best[0] = 0.0
        piece = np.full((longest + 5, n), -1, np.int32)
        start = np.zeros((longest + 5, n), np.int32)
        base, check, value, scores = self.base, self.check, self.value, self.score
        for i in range(longest):
            rows = np.flatnonzero((lengths > i) & (best[i] > -np.inf))
            lead, so_far = data[i], best[i]
            width = 1 + (lead > 0xC0).astype(np.int32) + (lead > 0xE0) + (lead > 0xF0)
            whole = np.zeros(n, bool)
            row, state = rows, np.zeros(len(rows), np.int32)
            for j in range(i, longest):
                step = base[state] + data[j][row]
                goes = check[step] == state
                row, state = row[goes], step[goes]
                if not len(row):
                    break
                found = value[state]
                ends = found >= 0
                here, found = row[ends], found[ends]
                if j - i < 4:
                    whole[here[width[here] == j + 1 - i]] = True
                score = so_far[here] + scores[found]
                better = score > best[j + 1][here]
                here = here[better]
                best[j + 1][here], piece[j + 1][here], start[j + 1][here] = score[better], found[better], i
            here = rows[~whole[rows]]
            if len(here):
                end = i + width[here]
                score = so_far[here] + self.v.unknown_score
                better = score > best[end, here]
                here, end = here[better], end[better]
                best[end, here], piece[end, here], start[end, here] = score[better], -1, i
        # back from the ends, all words in step; the last piece of a word is the last of its row
        end, row = lengths.copy(), np.arange(n)
        path = np.full((n, max(longest, 1)), -1, np.int32)
        count = np.zeros(n, np.int32)
        in_bytes = np.zeros(n, bool)
        live = row[end > 0]
        while len(live):
            found = piece[end[live], live]
            in_bytes[live[found < 0]] = True
            count[live] += 1
            path[live, path.shape[1] - count[live]] = found
            end[live] = start[end[live], live]
            live = live[end[live] > 0]
        out = [path[i, path.shape[1] - c :].tobytes() for i, c in enumerate(count.tolist())]
        for i in np.flatnonzero(in_bytes).tolist():
            out[i] = np.array(self.viterbi(words[i]), np.int32).tobytes()
        return out

    def learn(self, texts: list[str]) -> list[list[str]]:
        """The words of each text (see ``words``), after encoding those that are not at hand yet."""
        cut = [self.words(text) for text in texts]
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        cache = self.cache
        fresh = sorted({word for words in cut for word in words if word not in cache}, key=len)
        short = [word for word in fresh if len(word) < LONG_WORD]
        for begin in range(0, len(short), WORDS_AT_ONCE):
            some = short[begin : begin + WORDS_AT_ONCE]
            cache.update(zip(some, self.viterbi_many([word.encode() for word in some])))
        for word in fresh[len(short) :]:
            cache[word] = np.array(self.viterbi(word.encode()), np.int32).tobytes()
        return cut

    def words(self, text: str) -> list[str]:
        """Parts of the marked text that can be encoded one by one, a marker of the text as its own part."""
        if not text:
            return []
        if MARKER not in text:
            return self.v.parts(MARKER + text.replace(" ", MARKER))
        out: list[str] = []
        for i, part in enumerate(text.split(MARKER)):
            if i:
                out.append(LITERAL)
            out.extend(self.v.parts((part if i else " " + part).replace(" ", MARKER)))
        return out

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; a marker character in it becomes its three bytes, so that it stays."""
        cut = self.learn(texts)
        at_hand = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(at_hand, words)), np.int32) for words in cut]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become replacement characters."""
        plain = self.plain
        text = b"".join([plain[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def encode_pieces(docs: DataFrame, model_path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, piece_ids, n_pieces, n_byte_pieces, decoded_sha256, round_trip.

    decoded_sha256 is of the decoded text, round_trip whether that is the text. Null and empty text
    give no pieces and decode to the empty text (for null, round_trip is null). Very long texts are
    encoded whole, repeated rows each by themselves; no rows in: no rows out. The vocabulary is read
    on the driver and broadcast: its size is that of the model file.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary.from_file(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        byte_ids = np.array(codec.v.byte_ids)
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                texts = part.column(1).to_pylist()
                ids = codec.encode_all([text or "" for text in texts])
                decoded = [codec.decode(found.tolist()) for found in ids]
                lengths = np.array([len(found) for found in ids])
                flat = np.concatenate(ids)
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                in_bytes = np.concatenate([[0], np.cumsum(np.isin(flat, byte_ids))])
                yield pa.record_batch(
                    [
                        part.column(0),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32())),
                        pa.array(lengths, pa.int64()),
                        pa.array(in_bytes[offsets[1:]] - in_bytes[offsets[:-1]], pa.int64()),
                        pa.array([hashlib.sha256(text.encode()).hexdigest() for text in decoded], pa.string()),
                        pa.array([None if a is None else a == b for a, b in zip(texts, decoded)], pa.bool_()),
                    ],
                    names=["doc_id", "piece_ids", "n_pieces", "n_byte_pieces", "decoded_sha256", "round_trip"],
                )

    schema = "doc_id long, piece_ids array<int>, n_pieces long, n_byte_pieces long, decoded_sha256 string, round_trip boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
