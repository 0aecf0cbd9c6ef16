"""Periodic runs, the conversation trie and the vector search against plain programs."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from conftest import SMALL
from llm_rows import clashing, documents  # noqa: F401

from ledgerloom.llm import hash_search, periodic_runs, prefix_trie
from ledgerloom.llm.queries import llm_queries, table, with_periods, with_shared_heads

# --- periodic runs ------------------------------------------------------------------------


def runs_brute(words, min_length=24, times=3):
    n, found = len(words), set()
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j - i + p
            if j > i and length >= max(min_length, times * p):
                stretch = words[i : i + length]
                if not any(stretch[q:] == stretch[:-q] for q in range(1, p)):
                    found.add((i, length, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def some_words(chance):
    words = []
    for _ in range(chance.randint(0, 4)):
        unit = [chance.randint(0, 2) for _ in range(chance.randint(1, 12))]
        words += (unit * chance.randint(1, 9))[: chance.randint(1, 70)]
    return words


@pytest.mark.parametrize("min_length, times", [(24, 3), (6, 3), (9, 4), (1, 3)])
def test_runs_match_brute_force(min_length, times):
    chance, finder = random.Random(times), periodic_runs.RunFinder(min_length, times)
    for _ in range(300):
        texts = [some_words(chance) for _ in range(chance.randint(0, 4))]
        found = finder.find([np.array(words, np.int64) for words in texts])
        assert found == [runs_brute(words, min_length, times) for words in texts]


def test_suffix_array_and_common_prefixes():
    words = np.array([1, 2, 1, 2, 1, 2, 3, 1, 2, 3, -1])
    order, levels = periodic_runs.suffix_levels(words)
    tails = [words[i:].tolist() for i in order]
    # the end is its own number, so only the order up to it counts
    assert tails == sorted(tails) and sorted(order) == list(range(11))
    same = [next(n for n in range(12) if a[: n + 1] != b[: n + 1]) for a, b in zip(tails, tails[1:])]
    assert periodic_runs.common_prefixes(order, levels, 1).tolist() == same
    assert periodic_runs.common_prefixes(order, levels, 3).tolist() == [n if n >= 3 else 0 for n in same]


def test_maximal_pairs_are_all_listed():
    """Every maximal pair in reach, from different left words, once each."""
    words = [0, 1, 0, 1, 0, 1, 2, 1, 0, 1, 0, 0, 0, 0, -1]
    order, levels = periodic_runs.suffix_levels(np.array(words))
    lcp = periodic_runs.common_prefixes(order, levels, 1)
    found = [(a, b, n) for a, b, n in periodic_runs.maximal_pairs(order.tolist(), lcp.tolist(), [None, *words], 2)]
    want = set()
    for a in range(len(words)):
        for b in range(a + 1, len(words)):
            n = next(k for k in range(len(words)) if words[a + k] != words[b + k])
            if (a == 0 or words[a - 1] != words[b - 1]) and 2 * (b - a) <= n:
                want.add((a, b, n))
    assert len(found) == len(set(found)) and set(found) == want and want


@pytest.mark.parametrize("words", [[0] * 60_000, [k % 7 for k in range(60_000)], [0, 1] * 20_000 + [2] * 20_000])
def test_long_texts_have_the_runs_they_are_made_of(words):
    found = periodic_runs.RunFinder().find([np.array(words)])[0]
    assert sum(length for _, length, _ in found) == len(words)


def test_runs_of_odd_rows(clashing):  # noqa: F811
    docs = clashing(
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "a " * 23),
        (5, "a " * 24),
        (5, "a " * 24),
        (None, "x y b\n" * 12 + "x y c"),
        (7, "p q r s t u v w " * 3 + "p q"),
        (8, " ".join(f"w{k}" for k in range(50_000)) + " k" * 40),
    )
    out = {(row.doc_id, n): row for n, row in enumerate(periodic_runs.periodic_runs(docs).collect())}
    by_id = {row.doc_id: row for row in out.values()}
    assert len(out) == 9
    for k in (1, 2, 3):
        assert (by_id[k].n_words, by_id[k].n_runs, by_id[k].start, by_id[k].runs, by_id[k].collapsed) == (0, 0, None, [], "")
    assert by_id[4].n_runs == 0 and by_id[4].collapsed == ("a " * 23).strip()
    assert [tuple(r) for r in by_id[5].runs] == [(0, 24, 1)] and by_id[5].collapsed == "a"
    assert [tuple(r) for r in by_id[None].runs] == [(0, 25, 2)] and by_id[None].collapsed == "x y b c"
    assert tuple(by_id[7].runs[0]) == (0, 26, 8) and by_id[7].exponent_milli == 3250
    assert [tuple(r) for r in by_id[8].runs] == [(50_000, 40, 1)]
    assert periodic_runs.periodic_runs(docs.limit(0)).collect() == []


def test_strongest_run_by_exact_exponent():
    assert periodic_runs.strongest([(5, 30, 10), (9, 24, 8), (2, 33, 11)]) == (2, 33, 11)
    assert periodic_runs.strongest([(5, 40, 10), (9, 25, 6)]) == (9, 25, 6)
    with pytest.raises(ValueError):
        periodic_runs.RunFinder(24, 2)


def test_runs_query_matches_brute_force(spark):
    got = {row.doc_id: row for row in llm_queries()["op11_periodic_runs"](spark, SMALL).collect()}
    docs = table(spark, SMALL, "documents").collect()
    assert len(got) == len(docs)
    seen = 0
    for row in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
        n, h = len(words), zlib.crc32(str(row.doc_id).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = runs_brute(words)
        seen += len(runs)
        gone = {i for s, length, p in runs for i in range(s + p, s + length)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        mine = got[row.doc_id]
        assert (mine.n_runs, mine.start, mine.length, mine.period) == (len(runs), *best)
        assert mine.exponent_milli == (None if best[0] is None else 1000 * best[1] // best[2])
        lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        assert mine.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        left = " ".join(w for i, w in enumerate(words) if i not in gone)
        assert mine.collapsed_sha256 == hashlib.sha256(left.encode()).hexdigest()
    assert seen


def test_planted_periods_of_odd_rows(documents):  # noqa: F811
    ids = [k for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0][:4]
    docs = documents((ids[0], None), (ids[1], " \n"), (ids[2], "one"), (ids[3], " a  b\tc d e f g h"))
    out = {row.doc_id: row.text for row in with_periods(docs).collect()}
    assert out[ids[0]] is None and not out[ids[1]].strip() and out[ids[2]] == "one" and len(out[ids[3]].split()) == 8


# --- the trie of conversations --------------------------------------------------------------


def trie_brute(paths):
    """Rows of the nodes of {conv_id: [(role, text), ...]}."""
    members, ends, kids, leaves, saved = (defaultdict(list), defaultdict(list), defaultdict(set), defaultdict(int), defaultdict(int))
    for conv_id, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(conv_id)
        ends[tuple(path)].append(conv_id)
    for node in members:
        if node:
            kids[node[:-1]].add(node)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not kids[node]
        saved[node] += (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        if node:
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    return sorted(
        (
            (
                min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids[node]), leaves[node], saved[node],
                hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
            )
            for node, m in members.items()
        ),
        key=str,
    )


def trie_rows(df):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted((tuple(row) for row in df.select(*names).collect()), key=str)


CONVERSATION = "conv_id long, turn long, role string, text string"


def conversations_of(spark, paths):
    rows = [(c, k, role, text) for c, path in paths.items() for k, (role, text) in enumerate(path)]
    return spark.createDataFrame(rows, CONVERSATION)


def some_paths(seed, many=300, hot=0.4):
    """Conversations with shared beginnings, a long one, and one that many others repeat."""
    chance = random.Random(seed)
    copied = [("user", "hi"), ("assistant", "hello"), ("user", "é" * 9)]
    paths = {}
    for c in range(-5, many):
        if chance.random() < hot:
            paths[c] = list(copied[: chance.choice([2, 3, 3, 3])])
        else:
            paths[c] = [(chance.choice("ua"), "w" * chance.randint(0, 3)) for _ in range(chance.randint(1, 6))]
    paths[many] = copied + [("user", f"{k}") for k in range(120)]
    return paths


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_trie_matches_brute_force(spark, shards):
    """The same nodes however many shards the copies are dealt to."""
    paths = some_paths(shards)
    out = prefix_trie.conversation_trie(conversations_of(spark, paths), shards)
    assert trie_rows(out) == trie_brute(paths)


def test_shards_and_boundary_without_spark():
    """Every way to cut an order of conversations into shards gives the same trie."""
    chance = random.Random(3)
    for _ in range(150):
        paths = {c: [("", "x" * chance.randint(0, 2)) for _ in range(chance.randint(0, 3))] for c in range(chance.randint(1, 12))}
        # numbers that stand for the texts, and lengths to sum
        listed = sorted((([len(t) for _, t in path], c) for c, path in paths.items()))
        cuts = sorted(chance.randint(0, len(listed)) for _ in range(chance.randint(0, 4)))
        names = prefix_trie._names(prefix_trie.IN_SHARD)
        inner, boundary = [], prefix_trie.BoundaryMerge()
        for shard, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(listed)])):
            rows = [dict(zip(names, row)) for row in prefix_trie.shard_nodes(shard, [(c, path, path) for path, c in listed[a:b]])]
            inner += [row for row in rows if row["place"] is None]
            for row in sorted((row for row in rows if row["place"] is not None), key=lambda row: row["place"]):
                boundary.add(row)
        boundary.close()
        merged = [dict(zip(prefix_trie._names(prefix_trie.MERGED), row)) for row in boundary.rows]
        above = {(row["shard"], row["place"]): row["conv_id"] for row in merged}
        for row in inner:
            if row["parent_place"] is not None:
                row["parent_conv_id"] = above[row["shard"], row["parent_place"]]
        keys = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
        got = [tuple(row[k] for k in keys) for row in inner + [row for row in merged if row["first"]]]
        assert sorted(got, key=str) == trie_brute(paths)


def test_ternary_tree_is_balanced():
    """Of 1,023 first turns in order none is more than ten steps away."""
    tree = prefix_trie.TernaryTree()
    tree.insert_balanced([[k] for k in range(1023)], [[1]] * 1023)
    steps, open_ = 0, [(tree.equal[0], 1)]
    while open_:
        node, depth = open_.pop()
        if node >= 0:
            steps = max(steps, depth)
            open_ += [(tree.low[node], depth + 1), (tree.high[node], depth + 1)]
    assert steps == 10 and sorted(tree.top_down()) == list(range(1024))


def test_trie_of_odd_rows(spark):
    from pyspark.sql import functions as F

    rows = [
        (2, 1, "user", "b"),
        (2, None, None, "a"),  # null turn first, null role as empty
        (3, 0, "", "a"),
        (3, 0, "", "a"),  # a repeated row is a turn of its own
        (4, 5, "user", None),
        (4, 5, "user", ""),
        (None, 0, "user", "lost"),
    ]
    paths = {2: [("", "a"), ("user", "b")], 3: [("", "a"), ("", "a")], 4: [("user", ""), ("user", "")]}
    odd = spark.createDataFrame(rows, CONVERSATION).withColumns({n: F.lit("x") for n in ("path", "digest", "shard", "place", "depth")})
    assert trie_rows(prefix_trie.conversation_trie(odd)) == trie_brute(paths)
    assert prefix_trie.conversation_trie(odd.limit(0)).collect() == []
    names = prefix_trie.turn_dictionary(odd)
    assert sorted(tuple(r)[1:] for r in prefix_trie.turn_texts(odd, names).collect()) == [("", "a"), ("user", ""), ("user", "b"), ("user", "lost")]


def test_rebuilt_conversations(spark):
    """The first turns are those of the hundred's first conversation, also where it lacks or is short."""
    paths = {c: [("u", f"{c}/{k}") for k in range(c % 7)] for c in (0, 1, 2, 3, 4, 5, 6, 100, 104, 111, 250, 251)}
    paths = {c: path for c, path in paths.items() if path} | {100: [("u", "only")]}
    frame = conversations_of(spark, paths)
    names = prefix_trie.turn_dictionary(frame)
    rebuilt = {}
    for c, path in paths.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = paths.get(c - c % 100, [])[:h] + path[h:]
    assert any(not path for path in rebuilt.values())
    out = prefix_trie.path_trie(with_shared_heads(prefix_trie.conversation_paths(frame, names)))
    assert trie_rows(out) == trie_brute(rebuilt)


# --- vector search ----------------------------------------------------------------------------

VECTOR = "vec_id long, embedding array<float>"


def neighbours_brute(rows, chosen, k):
    out = {}
    for i, (vec_id, vector) in enumerate(rows):
        if chosen(vec_id):
            ranked = sorted((float(np.sqrt(((vector - v) ** 2).sum())), other) for j, (other, v) in enumerate(rows) if j != i)[:k]
            out.setdefault(vec_id, []).append([(n + 1, other, score) for n, (score, other) in enumerate(ranked)])
    return out


def vectors_of(spark, name):
    rows = table(spark, name, "embeddings").select("vec_id", "embedding").collect()
    return [(row.vec_id, np.array(row.embedding)) for row in rows]


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.1"])
def test_search_recall(spark, folder):
    """At least nine tenths of the nearest are found, with their exact distances."""
    want = neighbours_brute(vectors_of(spark, folder), lambda v: v % 100 == 0, 10)
    got = defaultdict(list)
    for row in llm_queries()["op13_hash_search"](spark, folder).collect():
        got[row.query_id].append((row["rank"], row.vec_id, row.score))
    right = 0
    for query, (truth,) in want.items():
        mine = sorted(got[query])
        assert [rank for rank, _, _ in mine] == list(range(1, 11))
        scores = {other: score for _, other, score in truth}
        right += sum(other in scores and scores[other] == pytest.approx(score, abs=1e-12) for _, other, score in mine)
    print("recall", right / (10 * len(want)))
    assert right >= 0.9 * 10 * len(want) and set(got) == set(want)


@pytest.mark.parametrize("bits, substrings, radius", [(64, 4, 27), (64, 4, 3), (10, 3, 4), (5, 8, 5), (7, 2, 0), (64, 4, 64)])
def test_tables_find_every_code_in_the_radius_once(bits, substrings, radius):
    rng = np.random.default_rng(bits + radius)
    codes = rng.integers(0, 1 << min(bits, 62), 400, dtype=np.uint64) & np.uint64((1 << bits) - 1 if bits < 64 else 2**64 - 1)
    codes[:40] = codes[0] ^ (np.uint64(1) << rng.integers(0, bits, 40, dtype=np.uint64))
    tables = hash_search.tables_for(bits, substrings, radius, 0)
    vectors, ids = np.zeros((400, 1)), [[k] for k in range(400)]
    for code in codes[::50]:
        found = []
        for one in tables:
            cell = hash_search.Cell(tables, one, radius, codes, vectors, ids)
            found += [cell.ids[i][0] for i in cell.within(code)]
        assert sorted(found) == np.flatnonzero(np.bitwise_count(codes ^ code) <= radius).tolist()


def test_search_of_odd_rows(spark):
    from pyspark.sql import functions as F

    nan, inf = float("nan"), float("inf")
    rows = [(k, [float(k), 1.0]) for k in range(1, 6)] + [(100, [3.0, 1.0]), (100, [3.0, 1.0]), (200, [0.0, 1.0]), (-100, [9.0, -0.0])]
    bad = [(300, None), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [0.0, -0.0]), (10, []), (11, [1.0, 2.0, 3.0]), (None, [3.0, 1.0]), (400, [0.0, 0.0])]
    frame = spark.createDataFrame(rows + bad, VECTOR).withColumns({n: F.lit("x") for n in ("number", "ids", "code", "query", "cell", "score")})
    want = neighbours_brute([(i, np.array(v)) for i, v in rows], lambda v: v % 100 == 0, 10)
    out = hash_search.nearest_neighbours(frame, "vec_id % 100 = 0", 10).collect()
    got = sorted((row.query_id, row["rank"], row.vec_id, row.score) for row in out)
    # the eight others are all there, ties to the smaller id, once for either row of 100
    assert got == sorted((q, *item) for q, answers in want.items() for answer in answers for item in answer)
    assert len([g for g in got if g[0] == 100]) == 16 and got[8][2:] == (3, 0.0)
    assert hash_search.nearest_neighbours(frame.limit(0), "vec_id % 100 = 0").collect() == []
    alone = hash_search.nearest_neighbours(frame.filter("vec_id = 200"), "vec_id % 100 = 0").collect()
    none = hash_search.nearest_neighbours(frame, "vec_id = 77").collect()
    assert alone == [] and none == []


def test_search_with_a_very_common_vector(spark):
    """A third of the rows are one vector: one entry, and each query still gets ten others."""
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(600, 8)).astype(np.float32).astype(float)
    vectors[::3] = vectors[0]
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], VECTOR)
    assert hash_search.distinct_vectors(hash_search.usable(frame), 11, "test").count() == 401
    out = defaultdict(list)
    for row in hash_search.nearest_neighbours(frame, "vec_id % 100 = 0", share=1.0).collect():
        out[row.query_id].append((row["rank"], row.vec_id, row.score))
    want = neighbours_brute(list(enumerate(vectors)), lambda v: v % 100 == 0, 10)
    for query in (0, 300):
        assert sorted(out[query]) == want[query][0]
    hits = sum(len({v for _, v, _ in out[q]} & {v for _, v, _ in truth}) for q, (truth,) in want.items())
    assert hits >= 54 and all(len(found) == 10 for found in out.values())


def test_radius_doubles_until_enough_are_found(spark):
    """A vector far from all others, beyond the sample's radius, is answered in full."""
    rng = np.random.default_rng(5)
    near = rng.normal(size=(300, 16)) * 0.01 + 1.0
    rows = [(k + 1, v.tolist()) for k, v in enumerate(near)] + [(1000, (-50 * np.ones(16)).tolist())]
    frame = spark.createDataFrame(rows, VECTOR)
    out = hash_search.nearest_neighbours(frame, "vec_id = 1000", share=0.5).collect()
    assert [row["rank"] for row in sorted(out, key=lambda row: row["rank"])] == list(range(1, 11))
