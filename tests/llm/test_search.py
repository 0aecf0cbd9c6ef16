"""Decontamination and licence scans against brute force."""

import random
import re

from llm_rows import clashing, documents  # noqa: F401

from ledgerloom.llm import decontaminate, licenses

WORDS = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def words(text):
    return re.findall(WORDS, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def prose(seed, n, vocabulary=50):
    chance = random.Random(seed)
    return " ".join(f"w{chance.randrange(vocabulary)}" for _ in range(n))


def benchmark(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id long, text string")


# --- decontamination ----------------------------------------------------------------------


def contamination_brute(docs, items):
    out = {}
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item_id, item in items:
            v = words(item)
            k = min(len(v), 10)
            windows = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if v else set()
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    found.add(item_id)
        out[doc_id] = (len(w), len(hit), len(found - {None}), bool(hit))
    return out


ITEMS = [(1, prose(1, 25)), (2, "Short ITEM, here!"), (3, None), (4, "..."), (5, prose(5, 10)), (6, "solo"), (7, "été ÉTÉ no"), (None, "nameless item text")]
DOCS = (
    [(i, prose(100 + i, 40) + " " + prose(1, 25)[i * 3 : i * 3 + 70] + " " + prose(200 + i, 20)) for i in range(12)]
    + [(20, None), (21, ""), (22, "?!"), (23, "short item"), (24, "x short-item here short item here y"), (25, "SOLO solo" * 3)]
    + [(26, prose(5, 10)), (27, "?" + prose(5, 10) + "?"), (28, prose(5, 9)), (29, "été ÉTÉ no"), (30, "a nameless item text b")]
    + [(31, "solo " * 30_000), (32, "w1 " * 20)]
)


def test_contamination_matches_brute_force(spark, clashing):
    found = decontaminate.contamination(clashing(*DOCS), benchmark(spark, *ITEMS, ITEMS[0])).collect()
    assert len(found) == len(DOCS)
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in found} == contamination_brute(DOCS, ITEMS)


def test_contamination_of_nothing_nulls_and_repeats(spark, documents):
    items = benchmark(spark, *ITEMS)
    assert decontaminate.contamination(documents((1, "a")).limit(0), items).count() == 0
    docs = documents((None, "solo"), (1, "solo"), (1, "solo"), (1, "other"))
    found = decontaminate.contamination(docs, items).collect()
    assert sorted((r.doc_id or -1, r.n_hit) for r in found) == [(-1, 1), (1, 0), (1, 1)]
    assert not any(r.contaminated for r in decontaminate.contamination(docs, items.limit(0)).collect())
    left = decontaminate.without_contaminated(docs, items)
    assert left.columns == docs.columns and [(r.doc_id, r.text) for r in left.collect()] == [(1, "other")]


def test_proximity(spark, documents):
    docs = documents((1, "red a b green c blue"), (2, "red a b c d e f g green blue"), (3, "blue green red"), (4, "red red"))
    vocabulary = spark.createDataFrame([(w,) for w in ("red", "green", "blue", "none")], "word string")
    index = decontaminate.postings(docs, vocabulary)
    queries = spark.createDataFrame([("a", ["red", "green", "blue"]), ("b", ["red", "none"]), ("c", ["blue"]), ("d", [])], "query string, words array<string>")
    found = decontaminate.proximity_matches(index, queries, 3)
    near = {(r["query"], r.doc_id) for r in found.collect()}
    assert near == {("a", 3), ("c", 1), ("c", 2), ("c", 3)}
    wider = decontaminate.proximity_matches(index, queries, 5).collect()
    assert {r.doc_id for r in wider if r["query"] == "a"} == {1, 3}


# --- licences -----------------------------------------------------------------------------


def license_brute(docs, templates):
    out = {}
    for doc_id, text in docs:
        w = words(text)
        for name, template in templates:
            v = words(template)
            if not v:
                continue
            k, step = min(5, len(v)), max(1, len(v) // 2)
            shingles = lambda x: {tuple(x[i : i + k]) for i in range(len(x) - k + 1)}
            want = shingles(v)
            for at in range(0, len(w), step):
                share = len(shingles(w[at : at + len(v) + step]) & want) / len(want)
                if share >= 0.75:
                    out[doc_id, name] = max(share, out.get((doc_id, name), 0))
    return out


def test_licenses_match_brute_force(clashing, spark):
    notices = [text for _, text in licenses.TEMPLATES]
    docs = [(i, prose(i, 30) + "\n" + notices[i % len(notices)] + " " + prose(i + 50, i)) for i in range(30)]
    docs += [(40, notices[0] * 3), (41, notices[6].replace("this", "these")), (42, "under the apache license"), (43, None), (44, ""), (45, "!")]
    docs += [(46, notices[8].upper()), (47, prose(9, 30_000) + " " + notices[1]), (48, "all rights RESERVED"), (49, "rights reserved")]
    found = licenses.license_matches(clashing(*docs), licenses.default_templates(spark)).collect()
    assert {(r.doc_id, r.license): r.containment for r in found} == license_brute(docs, licenses.TEMPLATES)
    assert len(found) == len({(r.doc_id, r.license) for r in found})


def test_licenses_of_nothing_nulls_and_repeats(spark, documents):
    templates = spark.createDataFrame([("X", "some very special notice text here"), (None, "no name at all"), ("Y", None), ("Z", "..")], "license string, text string")
    docs = documents((None, "some very special notice text here"), (1, "no name at all"), (1, "no name at all"))
    found = licenses.license_matches(docs, templates).collect()
    assert sorted((str(r.doc_id), str(r.license)) for r in found) == [("1", "None"), ("None", "X")]
    assert licenses.license_matches(docs, templates.limit(0)).count() == 0
    assert licenses.license_matches(docs.limit(0), templates).count() == 0


def test_whole_licence_texts_are_found(spark, documents):
    whole = {file.stem: file.read_text() for file in sorted(licenses.TEXTS.glob("*.txt"))}
    assert {"MIT", "GPL-3.0", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "ISC", "Unlicense", "Apache-2.0", "BSD-3-Clause"} <= set(whole)
    docs = [(i, prose(i, 300) + "\n" + text + "\n" + prose(i + 50, 20)) for i, text in enumerate(whole.values())]
    docs += [(50, "# " + whole["MIT"].upper().replace("\n", "\n# ")), (51, whole["MIT"][:300]), (52, whole["GPL-2.0"][:14_000])]
    found = {(r.doc_id, r.license): r.containment for r in licenses.license_matches(documents(*docs), licenses.default_templates(spark)).collect()}
    assert all(found[i, name] == 1 for i, name in enumerate(whole)) and found[50, "MIT"] == 1
    assert (51, "MIT") not in found and 0.75 <= found[52, "GPL-2.0"] < 1
    assert found == license_brute(docs, licenses.TEMPLATES + list(whole.items()))


def test_bands_find_nearly_all():
    assert (2 / 3) ** licenses.BANDS < 1e-8


def test_every_shingle_has_an_anchor():
    known = [(name, words(text)) for name, text in licenses.TEMPLATES]
    chosen = set(licenses.anchors(known))
    for _, w in known:
        k = min(5, len(w))
        assert all(chosen & set(w[i : i + k]) for i in range(len(w) - k + 1))


def test_no_python_in_the_plans(spark, documents):
    docs = documents(*DOCS[:5])
    for df in (decontaminate.contamination(docs, benchmark(spark, *ITEMS)), licenses.license_matches(docs, licenses.default_templates(spark))):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())
