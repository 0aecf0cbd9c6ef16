"""Language identification by compression.

A language is a zstandard dictionary of raw content: text of that language. A document is
compressed with every dictionary, and the one that leaves the fewest bytes names its language. Where
the best and the second differ too little, the answer is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import id_remainder

UNKNOWN = "und"
# Of many languages, so many dictionaries are in memory at a time, for so many texts, and each has so many
# bytes at least.
BLOCK = 64
ROWS = 256
LEAST_BYTES = 4096
# So many times the rows that a dictionary takes are looked at, as copies may be among them.
SPARE = 4
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, margin double, rejected boolean"


def training_slices(docs: DataFrame, per_language: int, dictionary_bytes: int, total_bytes: int) -> dict[str, bytes]:
    """The dictionary of each language: slices of a bounded sample of its training documents.

    Training documents have an id whose crc32 modulo 3 is not 1, a language and a text; every language
    of one gets a dictionary. Rows whose hashes are lowest give a slice each, from a place that the
    hash chooses; of equal slices one is kept, and of these ``per_language``. They are so long that they
    fill ``dictionary_bytes`` together, or with many languages an equal part of ``total_bytes``, but
    ``LEAST_BYTES`` at least. Only they come to the driver.
    """
    train = docs.filter(
        (id_remainder(F.col("doc_id"), 3) != 1) & F.col("lang").isNotNull() & (F.octet_length("text") > 0)
    ).select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    known = train.groupBy("lang").agg(F.count("*").alias("n"), F.min("h").alias("least")).collect()
    if not known:
        return {}
    size = min(dictionary_bytes, max(LEAST_BYTES, total_bytes // len(known)))
    # about as many rows as are looked at, at any number of documents; one row at least
    limits = [
        (row.lang, max(row.least, min(2**63 - 1, -(2**63) + 2**64 * SPARE * per_language // row.n)), max(1, size // min(row.n, per_language)))
        for row in known
    ]
    limits = docs.sparkSession.createDataFrame(limits, "lang string, highest long, share int")
    order = Window.partitionBy("lang").orderBy("h", "slice")
    places = F.greatest(F.lit(1), F.octet_length("text") - F.col("share") + 1)
    at = F.pmod(F.xxhash64("h"), places).cast("int") + 1
    slices = (
        train.join(F.broadcast(limits), "lang")
        .filter(F.col("h") <= F.col("highest"))
        .select("lang", "h", F.substring(F.col("text").cast("binary"), at, F.col("share")).alias("slice"))
        .groupBy("lang", "slice")
        .agg(F.min("h").alias("h"))
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= per_language)
    )
    found: dict[str, list[bytes]] = {row.lang: [] for row in known}
    for row in slices.orderBy("lang", "n").collect():
        found[row.lang].append(bytes(row.slice))
    return {lang: b"".join(parts)[:size] for lang, parts in sorted(found.items())}


class CompressionClassifier:
    """Chooses the language whose dictionary compresses a text best.

    Dictionaries beyond ``BLOCK`` are made ready a block at a time, for all texts at hand.
    """

    def __init__(self, dictionaries: dict[str, bytes], level: int = 3):
        items = sorted(dictionaries.items())
        self.level = level
        self.blocks = [items[i : i + BLOCK] for i in range(0, len(items), BLOCK)]
        self.only = self._compressors(self.blocks[0]) if len(self.blocks) == 1 else None

    def _compressors(self, block: list[tuple[str, bytes]]) -> list[tuple[str, zstandard.ZstdCompressor]]:
        out = []
        for name, content in block:
            learned = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            learned.precompute_compress(self.level)
            made = zstandard.ZstdCompressor(
                dict_data=learned, level=self.level, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            out.append((name, made))
        return out

    def classify(self, text: str | None) -> tuple[str, float, float]:
        return self.classify_all([text])[0]

    def classify_all(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """Language, score and margin of each; ``und``, 0 and 0 for null, a text without letters or no languages.

        The margin is the share of bytes that the best saves against the second best; the score maps
        it to 0.5 .. 1 (1 with one language only). Of equal sizes the first name in order wins.
        """
        out = [(UNKNOWN, 0.0, 0.0)] * len(texts)
        data = {i: text.encode("utf-8", "surrogatepass") for i, text in enumerate(texts) if text and any(map(str.isalpha, text))}
        best: dict[int, list[tuple[int, str]]] = {i: [] for i in data}
        for block in self.blocks:
            compressors = self.only or self._compressors(block)
            for i, content in data.items():
                best[i] = sorted(best[i] + [(len(c.compress(content)), name) for name, c in compressors])[:2]
        for i, ranked in best.items():
            if len(ranked) == 1:
                out[i] = ranked[0][1], 1.0, 1.0
            elif ranked:
                margin = 1 - ranked[0][0] / ranked[1][0]
                out[i] = ranked[0][1], 0.5 + 0.5 * min(1.0, margin * 5), margin
        return out


def identify_languages(
    docs: DataFrame,
    per_language: int = 256,
    dictionary_bytes: int = 65_536,
    total_bytes: int = 64 * 65_536,
    min_margin: float = 0.01,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, margin, rejected.

    Fits on a bounded sample of every language (see ``training_slices``) and predicts from the whole
    text alone. Null
    text and text without any letter give ``und``; a margin below ``min_margin`` keeps the best
    language and sets ``rejected``. Repeated rows give repeated rows. Without training documents all
    is ``und``. held_out: the id's crc32 modulo 3 is 1. No rows in: no rows out.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(training_slices(docs, per_language, dictionary_bytes, total_bytes))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = CompressionClassifier(model.value)
        for batch in batches:
            parts = (batch.column(2).slice(at, ROWS).to_pylist() for at in range(0, batch.num_rows, ROWS))
            found = [answer for part in parts for answer in classifier.classify_all(part)]
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([lang for lang, _, _ in found], pa.string()),
                    pa.array([score for _, score, _ in found], pa.float64()),
                    pa.array([margin for _, _, margin in found], pa.float64()),
                    pa.array([lang == UNKNOWN or margin < min_margin for lang, _, margin in found], pa.bool_()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "margin", "rejected"],
            )

    inputs = docs.select("doc_id", (id_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "text")
    return inputs.mapInArrow(predict, SCHEMA)
