"""Benchmark decontamination with a positional inverted index.

The index holds a posting (word, document, position) for every place where a word of the benchmark
stands in the documents. A window of an item is looked up by its two rarest words: their postings,
less their offsets in the item, must meet in the same start. What is left is compared with the
document's words one by one, so that matches are exact. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import lower_ascii, stored

# Fixed value: what separates words, after A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
# A vocabulary of up to so many words is broadcast (tens of MB); a larger one is joined by shuffle.
BROADCAST_WORDS = 500_000
DOC = ["doc_id", "row"]


def words_of(text: Column) -> Column:
    """The words of a text in order; there may be an empty one at either end. Null has none."""
    return F.split(F.coalesce(lower_ascii(text), F.lit("")), SEPARATORS)


def documents_by_row(docs: DataFrame) -> DataFrame:
    """doc_id, row, text; ``row`` tells apart rows of one doc_id whose texts differ."""
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """item, item_id, words of each item that has words; equal rows once."""
    words = F.filter(words_of(F.col("text")), lambda word: word != "")
    return (
        benchmark.select(F.xxhash64("item_id", "text").alias("item"), "item_id", words.alias("words"))
        .filter(F.size("words") > 0)
        .dropDuplicates(["item", "item_id"])
    )


def postings(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """word, doc_id, row, pos of every token of ``docs`` that is in ``vocabulary`` (a column word).

    The empty word marks a document's ends: its last position is the number of parts that the text
    splits into, and each other one is a part without a word.
    """
    known = vocabulary.union(vocabulary.sparkSession.createDataFrame([("",)], "word string"))
    if known.count() <= BROADCAST_WORDS:
        known = F.broadcast(known)
    parts = F.concat(words_of(F.col("text")), F.array(F.lit("")))
    tokens = documents_by_row(docs).select(*DOC, F.posexplode(parts).alias("pos", "word"))
    return tokens.join(known, "word").select("word", *DOC, "pos")


def rarest_words(items: DataFrame, counts: DataFrame, window: int, anchors: int = 2) -> DataFrame:
    """item, at, length, ranked: for every window (its start ``at``) the places of its rarest words.

    ``ranked`` holds (count, place, word) of the ``anchors`` rarest, ties by place. Windows with a
    word that no document has are left out: they cannot occur.
    """
    length = F.least(F.size("words"), F.lit(window))
    windows = items.select(
        "item", length.alias("length"), "words",
        F.explode(F.sequence(F.lit(0), F.size("words") - length)).alias("at"),
    )
    places = windows.select(
        "item", "at", "length", F.posexplode(F.slice("words", F.col("at") + 1, F.col("length"))).alias("k", "word")
    )
    return (
        places.join(counts, "word")
        .groupBy("item", "at", "length")
        .agg(F.sort_array(F.collect_list(F.struct("n", (F.col("at") + F.col("k")).alias("place"), "word"))).alias("all"))
        .filter(F.size("all") == F.col("length"))
        .select("item", "at", "length", F.slice("all", 1, anchors).alias("ranked"))
    )


def phrase_candidates(index: DataFrame, ranked: DataFrame) -> DataFrame:
    """item, doc_id, row, start, ats: windows of an item whose rarest words meet.

    ``start`` is where the item's first word would stand; windows of one item and start come together.
    """
    anchors = ranked.select("item", "at", F.size("ranked").alias("needed"), F.explode("ranked").alias("a"))
    anchors = anchors.select("item", "at", "needed", F.col("a.place").alias("place"), F.col("a.word").alias("word"))
    wanted = anchors.groupBy("word", "item", "place").agg(F.collect_list(F.struct("at", "needed")).alias("windows"))
    # only the postings of the rarest words are shuffled: the frequent ones leave before it
    rare = wanted.select("word").distinct()
    if rare.limit(BROADCAST_WORDS + 1).count() <= BROADCAST_WORDS:
        rare = F.broadcast(rare)
    found = (
        index.join(rare, "word", "left_semi")
        .join(wanted, "word")
        .select("item", *DOC, (F.col("pos") - F.col("place")).alias("start"), F.explode("windows").alias("w"))
        .groupBy("item", *DOC, "start", "w")
        .agg(F.count("*").alias("met"))
        .filter(F.col("met") >= F.col("w.needed"))
    )
    return found.groupBy("item", *DOC, "start").agg(F.collect_list("w.at").alias("ats"))


def phrase_matches(docs: DataFrame, items: DataFrame, index: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, row, item, item_id, first, length: each exact occurrence of a window in a document.

    ``first`` counts the parts of ``words_of``, from 0.
    """
    counts = index.filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
    candidates = stored(phrase_candidates(index, rarest_words(items, counts, window)), "phrases")
    texts = documents_by_row(docs).join(
        candidates.select(*(F.col(c).alias(f"c_{c}") for c in DOC)).distinct(),
        F.col("row").eqNullSafe(F.col("c_row")) & F.col("doc_id").eqNullSafe(F.col("c_doc_id")),
        "left_semi",
    ).dropDuplicates(DOC)
    texts = stored(texts.select(*DOC, words_of(F.col("text")).alias("parts")), "phrase-words")
    c = candidates.join(items, "item").alias("c")
    both = texts.alias("t").join(
        c, (F.col("t.row") == F.col("c.row")) & F.col("t.doc_id").eqNullSafe(F.col("c.doc_id"))
    )
    length = F.least(F.size("c.words"), F.lit(window))
    return both.select(
        "t.doc_id", "t.row", "c.item", "c.item_id", length.alias("length"), "t.parts", "c.words", "c.start",
        F.explode("c.ats").alias("at"),
    ).filter(
        (F.col("start") + F.col("at") >= 0)
        & (F.slice("parts", F.greatest(F.col("start") + F.col("at"), F.lit(0)) + 1, F.col("length"))
           == F.slice("words", F.col("at") + 1, F.col("length")))
    ).select(*DOC, "item", "item_id", (F.col("start") + F.col("at")).alias("first"), "length")


def build_index(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The items and the stored index of their words."""
    items = stored(benchmark_items(benchmark), "items")
    vocabulary = items.select(F.explode("words").alias("word")).distinct()
    return items, stored(postings(docs, vocabulary), "postings")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A window is ``window`` consecutive words of an item, or all of a shorter item. A document's word
    is hit if it stands inside an occurrence of a window. Null and wordless texts have no words and
    no hits; wordless items none either. Rows that repeat doc_id and text give one row; rows of one
    doc_id with other texts each their own. Items without an id hit, but count and are named as no
    item. An empty benchmark hits nothing; no documents in: no rows out.
    """
    items, index = build_index(docs, benchmark)
    ends = index.filter("word = ''").groupBy(*DOC).agg(
        (F.max("pos") - F.count_distinct("pos") + 1).cast("long").alias("n_words")
    )
    matches = stored(phrase_matches(docs, items, index, window), "matches")
    hits = (
        matches.select(*DOC, F.explode(F.sequence("first", F.col("first") + F.col("length") - 1)).alias("pos"))
        .distinct()
        .groupBy(*DOC)
        .agg(F.count("*").alias("n_hit"))
    )
    names = matches.groupBy(*DOC).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("names"))
    hits, names = hits.alias("h"), names.alias("i")
    found = hits.join(
        names, (F.col("h.row") == F.col("i.row")) & F.col("h.doc_id").eqNullSafe(F.col("i.doc_id"))
    ).select(F.col("h.doc_id").alias("h_id"), F.col("h.row").alias("h_row"), "n_hit", "names")
    joined = ends.join(
        found, (F.col("row") == F.col("h_row")) & F.col("doc_id").eqNullSafe(F.col("h_id")), "left"
    )
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("names"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "names"), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def contaminated_rows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, row of the documents that hold a window of an item."""
    items, index = build_index(docs, benchmark)
    return phrase_matches(docs, items, index, window).select(*DOC).distinct()


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no window of an item, all columns."""
    found = contaminated_rows(docs, benchmark, window).select(
        F.col("doc_id").alias("__id"), F.col("row").alias("__row")
    )
    same = (F.xxhash64(docs["doc_id"], docs["text"]) == F.col("__row")) & docs["doc_id"].eqNullSafe(F.col("__id"))
    return docs.join(found, same, "left_anti")


def proximity_matches(index: DataFrame, queries: DataFrame, within: int) -> DataFrame:
    """query, doc_id, row, pos: places of a query's rarest word that have all its words close by.

    ``queries`` has query and words (an array of lower-cased words); close by is at most ``within``
    positions away, on either side, in any order. A query with a word that nothing has, or without
    words, matches nothing.
    """
    counts = index.filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
    terms = queries.select("query", F.explode(F.array_distinct("words")).alias("word"))
    needed = terms.groupBy("query").agg(F.count("*").alias("needed"))
    ranks = Window.partitionBy("query").orderBy("n", "word")
    ranked = terms.join(counts, "word").withColumn("rank", F.row_number().over(ranks))
    near = index.join(ranked, "word")
    rare = near.filter("rank = 1").select("query", *DOC, F.col("pos").alias("centre"))
    other = near.filter("rank > 1").select(
        F.col("query").alias("q"), F.col("doc_id").alias("d"), F.col("row").alias("r"), "pos", "rank"
    )
    met = rare.join(
        other,
        (F.col("query") == F.col("q"))
        & (F.col("row") == F.col("r"))
        & F.col("doc_id").eqNullSafe(F.col("d"))
        & (F.abs(F.col("pos") - F.col("centre")) <= within),
        "left",
    )
    return (
        met.groupBy("query", *DOC, "centre")
        .agg(F.count_distinct("rank").alias("others"))
        .join(needed, "query")
        .filter(F.col("others") + 1 == F.col("needed"))
        .select("query", *DOC, F.col("centre").alias("pos"))
    )
