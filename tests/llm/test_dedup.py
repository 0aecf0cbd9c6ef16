"""Exact, near-duplicate and substring dedup against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from llm_rows import clashing, documents  # noqa: F401
from pyspark.sql import functions as F

from ledgerloom.llm import exact_dedup, id_filter, near_dedup, suffix_dedup
from ledgerloom.llm.shingles import Shingler


def prose(seed, words=60, vocabulary=400):
    chance = random.Random(seed)
    return " ".join(f"w{chance.randrange(vocabulary)}" for _ in range(words))


def edited(text, seed, edits):
    chance = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[chance.randrange(len(words))] = f"new{chance.randrange(10**6)}"
    return " ".join(words)


# --- exact ------------------------------------------------------------------------------

EXACT = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "x" * 300_000), (7, "x" * 300_000), (8, "A"), (2, "b"), (None, "a"), (None, "q")]


def exact_brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("files", [1, 128])
def test_exact_groups(clashing, files, monkeypatch):
    monkeypatch.setattr(exact_dedup.exact_groups, "__defaults__", (files,))  # one or all files in a micro-batch
    found = exact_dedup.exact_duplicates(clashing(*EXACT).repartition(4))
    assert sorted(map(tuple, found.collect()), key=str) == exact_brute(EXACT)


def test_exact_nothing(documents):
    assert exact_dedup.exact_duplicates(documents(*EXACT).limit(0)).count() == 0


def test_exact_state_lives_on(spark, documents, folder):
    """A later run goes on from the state of an earlier one and does not see its rows again."""
    for batch, rows in enumerate([[(1, "a"), (2, "b")], [(3, "a"), (9, "c")]]):
        exact_dedup.digests(documents(*rows)).write.mode("append").parquet(f"{folder}/staged")
        exact_dedup.update_state(spark, f"{folder}/staged", f"{folder}/state", f"{folder}/changes", 8)
    changed = spark.read.parquet(f"{folder}/changes").orderBy("group_size", "keeper.doc_id")
    assert [(r.keeper.doc_id, r.group_size) for r in changed.collect()] == [(1, 1), (2, 1), (9, 1), (3, 2)]


def test_exact_tells_texts_of_one_digest_apart(documents, monkeypatch):
    """With a digest of the first letter only, the bytes still decide."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(F, "sha2", lambda column, _: F.hex(F.substring(column, 1, 1)))
    rows = [(1, "ab"), (2, "ac"), (3, "ab"), (4, "b")]
    found = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_duplicates(documents(*rows)).collect()}
    assert found == {1: (3, 2), 2: (2, 1), 3: (3, 2), 4: (4, 1)}
    assert sorted(r.doc_id for r in exact_dedup.without_exact_duplicates(documents(*rows)).collect()) == [2, 3, 4]


def test_exact_filter_keeps_columns_and_one_of_repeats(clashing):
    docs = clashing(*EXACT)
    kept = exact_dedup.without_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, i) for i in (2, 3, 5, 7, 8)] + [(True, 0)]


# --- near -------------------------------------------------------------------------------


def near_brute(rows):
    sets = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        few = frozenset([tuple(words)]) if words else frozenset()
        sets[doc_id] = frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or few
    label = {i: i for i in sets}
    changed = True
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


def near_found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect()}


def near_rows():
    rows = [(i, prose(i)) for i in range(40)]
    rows += [(100 + i, edited(prose(i % 7), i, 1 + i % 3)) for i in range(60)]  # near copies and chains
    passage = prose(777, 30)
    rows += [(300 + i, passage + " " + prose(900 + i, 30 + i)) for i in range(50)]  # one passage in many
    rows += [(400 + i, edited(prose(500, 120), 40 + i, i % 9)) for i in range(60)]  # a large group
    rows += [(600, None), (601, ""), (602, " \t\n"), (603, "a b"), (604, "A  b"), (605, "a c"), (606, prose(3, 30_000))]
    rows += [(607, "one two three four five"), (608, "ONE two three four five"), (609, "ab " * 50), (610, "ab " * 60)]
    return rows


@pytest.mark.parametrize("at_hand", [0, 1_000_000])
def test_near_duplicates_match_brute_force(clashing, monkeypatch, at_hand):
    monkeypatch.setattr(near_dedup, "COMMON", 8)  # so that the small table has common values
    monkeypatch.setattr(near_dedup, "AT_HAND", at_hand)
    rows = near_rows()
    assert near_found(clashing(*rows).repartition(5)) == near_brute(rows)


def test_near_duplicates_without_common_values(documents):
    rows = near_rows()[:120]
    assert near_found(documents(*rows)) == near_brute(rows)


def test_near_nothing_nulls_and_repeats(documents):
    assert near_dedup.near_duplicates(documents((1, "a")).limit(0)).count() == 0
    found = near_dedup.near_duplicates(documents((None, prose(1)), (5, prose(1)), (5, prose(1)), (3, prose(1)))).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in found) == [
        (-1, -1, True), (3, 3, True), (5, 3, False), (5, 3, False),
    ]
    docs = documents((2, prose(1)), (1, prose(1)), (None, "x"), (3, None))
    kept = near_dedup.without_near_duplicates(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, None, 3}


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(101, 100), (100, 102)]
    found = near_dedup.components(spark.createDataFrame(links, "a long, b long"))
    assert dict(map(tuple, found.collect())) == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100, 102: 100}


def test_shingles_tell_orders_apart():
    """Sums of words in another order must differ: a b b a x and b a a b x."""
    words = "a b b a x b a a b x a b b a".split()
    want = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    assert len(Shingler().shingles(" ".join(words))) == len(want)


# --- substrings -------------------------------------------------------------------------


def suffix_brute(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for start in range(len(data) - 99):
            string = data[start : start + 100]
            if string in seen:
                gone[start : start + 100] = b"\1" * 100
            seen.add(string)
        kept = bytes(byte for byte, g in zip(data, gone) if not g)
        runs = len(bytes(gone).replace(b"\0", b" ").split())
        out.setdefault(doc_id, []).append((len(data), sum(gone), runs, kept))
    return out


def suffix_found(df, **options):
    out = defaultdict(list)
    for r in suffix_dedup.remove_repeats(df, **options).collect():
        out[r.doc_id].append((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)))
    return {key: sorted(value) for key, value in out.items()}


def suffix_rows():
    passage, line = prose(5, 40), prose(6, 19)[:99]
    rows = [(i, prose(i + 50, 30) + passage[: 90 + 3 * i] + prose(i + 90, 10)) for i in range(25)]
    rows += [(30, "a" * 950), (31, "ab" * 300), (32, "b" * 99), (33, None), (34, ""), (35, line), (36, line)]
    rows += [(40, passage), (41, passage), (42, passage + passage), (43, "é" * 120 + passage), (44, prose(9, 30_000)), (45, "x" + prose(9, 30_000))]
    return rows


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_repeats_match_brute_force(clashing, batches):
    rows = suffix_rows()
    want = {key: sorted(value) for key, value in suffix_brute(rows).items()}
    assert suffix_found(clashing(*rows).repartition(4), batches=batches) == want


def test_repeats_around_crowded_anchors(documents, monkeypatch):
    """Anchors with more surroundings than one task compares are spread by their strings."""
    monkeypatch.setattr(suffix_dedup, "TOGETHER", 3)
    rows = suffix_rows()
    assert suffix_found(documents(*rows)) == {key: sorted(value) for key, value in suffix_brute(rows).items()}


def test_repeats_with_crowded_phrases_dealt_by_surroundings(documents, monkeypatch, setting):
    """Anchors of a phrase in all documents go to many tasks, whose results are the same."""
    phrase = " one phrase, shorter than a string that is removed, which every one of these documents has "
    rows = [(i, prose(i, 15) + phrase + prose(i % 7 + 90, 15)) for i in range(60)]
    monkeypatch.setattr(suffix_dedup, "CROWDED_SHARE", 0.5)
    crowded = suffix_dedup.crowded_anchors(documents(*rows).withColumnRenamed("doc_id", "key"))
    assert crowded
    entries = suffix_dedup.suffix_array(documents(*rows).withColumnRenamed("doc_id", "key"))
    setting("spark.sql.adaptive.enabled", "false")  # it would put such few rows together
    parts = suffix_dedup.dealt(entries.filter(F.col("fp") == crowded[0]), crowded).select(F.spark_partition_id().alias("p")).distinct()
    assert parts.count() > 1
    assert suffix_found(documents(*rows)) == {key: sorted(value) for key, value in suffix_brute(rows).items()}


def test_repeats_with_null_and_equal_ids(documents):
    rows = [(None, prose(1)), (1, prose(1)), (1, prose(1)), (1, prose(2)), (None, None)]
    assert suffix_found(documents(*rows)) == {key: sorted(value) for key, value in suffix_brute(rows).items()}
    assert suffix_dedup.remove_repeats(documents((1, "a")).limit(0)).count() == 0


def test_levels_merge_geometrically(documents):
    from pyspark.sql import functions as F

    family = suffix_dedup.SuffixLevels()
    for batch in range(6):
        family.add(documents((batch, prose(batch, 80))).select(F.col("doc_id").alias("key"), "text"))
    assert [size for size, _ in family.levels] == [4, 2]


def test_equal_strings_share_an_anchor():
    data = np.frombuffer((prose(1, 200) + prose(2, 80) + prose(1, 200)).encode(), np.uint8)
    at = suffix_dedup.anchors(suffix_dedup.rolling(data, suffix_dedup.GRAM))
    gaps = np.diff(np.concatenate([[-1], at, [len(data) - suffix_dedup.GRAM + 1]]))
    assert gaps.max() <= suffix_dedup.PLACES
    prints = suffix_dedup.rolling(data, suffix_dedup.GRAM)
    want = set()
    for start in range(len(prints) - suffix_dedup.PLACES + 1):
        run = prints[start : start + suffix_dedup.PLACES]
        want |= {start + int(k) for k in np.flatnonzero(run == run.min())}
    assert set(at.tolist()) == want


def test_filter_names_every_id_and_few_others(spark):
    ids = spark.range(-300, 3000, 3).withColumnRenamed("id", "key")
    rows = spark.range(-1000, 20_000).unionByName(spark.createDataFrame([(None,)], "id long"))
    wanted = {row.key for row in ids.collect()}
    for most in (id_filter.FILTER_BITS, 64):
        found = [row.id for row in rows.filter(id_filter.named_in(ids, most)(F.col("id"))).collect()]
        assert wanted <= set(found) and None not in found
        assert most == 64 or len(found) <= len(wanted) + 1000
    assert rows.filter(id_filter.named_in(ids.limit(0))(F.col("id"))).count() == 0


@pytest.mark.parametrize("many", [0, 1, 500])
def test_sets_of_all_named_documents(spark, monkeypatch, many):
    """The filter of ids loses none of them, and leaves few others unless it is far too small."""
    docs = spark.range(-500, 4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b c d e "), "id").alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(None, "y")], "doc_id long, text string"))
    ids = spark.range(0, max(many, 1) * 7, 7).withColumnRenamed("id", "node").limit(many)
    wanted = {row.node for row in ids.collect()}
    found = {row.node: row.members for row in near_dedup.full_sets(docs, ids).collect()}
    assert wanted <= set(found) and None not in found and len(found) <= len(wanted) + 400
    assert all(found[n] == Shingler().shingles(f"a b c d e {n}").tobytes() for n in found)
    monkeypatch.setattr(near_dedup, "FILTER_BITS", 64)
    assert wanted <= {row.node for row in near_dedup.full_sets(docs, ids).collect()}
