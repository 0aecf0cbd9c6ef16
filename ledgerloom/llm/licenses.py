"""Licence scans: MinHash bands over overlapping text windows, then exact containment.

Templates of one length are sought in windows of one and a half times that length, which begin at
every half length, so that each occurrence lies whole in some window. Every shingle of every document
is joined by its hash with the templates' shingles; what meets is gathered by window. A window and a
template that share a band are compared by their shingles. All of it is DataFrame operations.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored
from ledgerloom.llm.decontaminate import words_of

SHINGLE = 5
CONTAINMENT = 0.75
# One row in a band. A window with a whole template has at least a third of its shingles in common
# with it, and with three quarters of a template about as many: (2/3) ** 48 < 1e-8 of them are missed.
BANDS = 48
# With more shingles than this in all templates, Spark chooses how to join them.
BROADCAST_SHINGLES = 1_000_000
# Whole licence texts, each file named by its licence.
TEXTS = Path(__file__).parent / "license_texts"

# Notices of public licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("all-rights-reserved", "All rights reserved."),
]


def default_templates(spark: SparkSession) -> DataFrame:
    """The notices and the whole licence texts of this package."""
    whole = [(file.stem, file.read_text(encoding="utf-8")) for file in sorted(TEXTS.glob("*.txt"))]
    return spark.createDataFrame(TEMPLATES + whole, "license string, text string")


def shingle_prints(texts: DataFrame, keys: list[str], sizes: list[int]) -> DataFrame:
    """keys, pos, size, print: the hash of every shingle of each of ``sizes`` words (a column words).

    ``pos`` is the place of its first word, from 0; texts of fewer words than ``size`` have none.
    """
    ahead = [f"w{k}" for k in range(max(sizes))]
    shifted = [F.slice("words", k + 1, F.size("words")).alias(name) for k, name in enumerate(ahead)]
    grams = texts.select(*keys, *shifted).select(*keys, F.posexplode(F.arrays_zip(*ahead)).alias("pos", "w"))
    prints = [
        F.when(F.col(f"w.w{size - 1}").isNotNull(), F.struct(
            F.lit(size).alias("size"), F.xxhash64(*(F.col(f"w.{name}") for name in ahead[:size])).alias("print")
        ))
        for size in sizes
    ]
    found = grams.select(*keys, "pos", F.explode(F.array(*prints)).alias("s")).filter(F.col("s").isNotNull())
    return found.select(*keys, "pos", "s.size", "s.print")


def min_hashes(prints: Column, bands: int) -> Column:
    """For each band the least value of its hash function over the shingles."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda band: F.array_min(F.transform(prints, lambda p: F.xxhash64(p, band))),
    )


def anchors(templates: list[tuple[str, list[str]]]) -> list[str]:
    """Words of which every shingle of every template has one; so has any text that matches.

    The scan itself looks for whole shingles.
    """
    open_shingles = []
    for _, words in templates:
        size = min(SHINGLE, len(words))
        open_shingles += [set(words[i : i + size]) for i in range(len(words) - size + 1)]
    chosen = []
    while open_shingles:
        words = sorted(set().union(*open_shingles))
        best = max(words, key=lambda word: (sum(word in s for s in open_shingles) * len(word), word))
        chosen.append(best)
        open_shingles = [s for s in open_shingles if best not in s]
    return chosen


def template_shingles(templates: DataFrame) -> DataFrame:
    """template, license, length, size, wanted: the distinct shingles of each template that has words."""
    words = F.filter(words_of(F.col("text")), lambda word: word != "")
    rows = templates.select("license", words.alias("words")).filter(F.size("words") > 0).distinct()
    length = F.size("words")
    rows = rows.select(
        F.xxhash64("license", "words").alias("template"), "license", length.alias("length"),
        F.least(length, F.lit(SHINGLE)).alias("own"), "words",
    )
    prints = shingle_prints(rows, ["template", "license", "length", "own"], list(range(1, SHINGLE + 1)))
    own = prints.filter(F.col("size") == F.col("own"))
    return own.groupBy("template", "license", "length", "size").agg(F.collect_set("print").alias("wanted"))


def license_matches(docs: DataFrame, templates: DataFrame, bands: int = BANDS) -> DataFrame:
    """doc_id, license, containment, windows: what each document has, one row per licence.

    A template matches a window that has at least three quarters of its distinct shingles of five
    words (of all words, if it has fewer), shingles being told apart by hashes of 64 bits.
    containment is the largest over windows and templates of a licence, windows how many windows
    match. A-Z are lower-cased, words are letters and digits. Null, empty and wordless texts match
    nothing; documents without matches have no row. Very long texts are read whole, and so are
    templates, of any length and number. Rows of one doc_id are taken together, equal ones once; a
    null doc_id is an id as others. Without templates nothing matches.
    """
    spark = docs.sparkSession
    known = stored(template_shingles(templates), "license-templates")
    totals = known.agg(F.sort_array(F.collect_set("size")).alias("sizes"), F.sum(F.size("wanted")).alias("n")).first()
    if not totals.sizes:
        return spark.createDataFrame([], "doc_id long, license string, containment double, windows long")
    at_hand = F.broadcast if totals.n <= BROADCAST_SHINGLES else lambda df: df
    words = F.filter(words_of(F.col("text")), lambda word: word != "")
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), words.alias("words"))
    prints = shingle_prints(rows, ["doc_id", "row"], totals.sizes)
    wanted = known.select("length", "size", F.explode("wanted").alias("print")).distinct()
    # a shingle of no template adds to no containment
    hits = prints.join(at_hand(wanted), ["size", "print"])
    # windows begin at every ``step`` words; these have the whole shingle
    step = F.greatest(F.lit(1), F.floor(F.col("length") / 2))
    reach = F.col("length") + step - F.col("size")
    first, last = F.greatest(F.lit(0), F.ceil((F.col("pos") - reach) / step)), F.floor(F.col("pos") / step)
    windows = (
        hits.withColumn("window", F.explode(F.sequence(first, last)))
        .groupBy("doc_id", "row", "length", "window")
        .agg(F.collect_set("print").alias("shingles"))
        .withColumn("least", min_hashes(F.col("shingles"), bands))
    )
    known = known.select("template", "license", "length", "wanted", min_hashes(F.col("wanted"), bands).alias("its_least"))
    its_bands = known.select("template", "length", F.posexplode("its_least").alias("band", "value"))
    candidates = (
        windows.select("doc_id", "length", "shingles", "least", F.posexplode("least").alias("band", "value"))
        .join(at_hand(its_bands), ["length", "band", "value"])
        .join(at_hand(known.drop("length")), "template")
    )
    # once for each window and template, at the first band that they share
    shared = F.array_position(F.zip_with("least", "its_least", lambda a, b: a == b), True)
    containment = F.size(F.array_intersect("shingles", "wanted")) / F.size("wanted")
    return (
        candidates.filter(shared == F.col("band") + 1)
        .select("doc_id", "license", containment.alias("containment"))
        .filter(F.col("containment") >= CONTAINMENT)
        .groupBy("doc_id", "license")
        .agg(F.max("containment").alias("containment"), F.count("*").alias("windows"))
    )
