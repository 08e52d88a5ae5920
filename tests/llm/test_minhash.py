import random

import numpy as np
import pytest

from ledgerloom.llm import minhash as mh
from ledgerloom.llm.common import table
from ledgerloom.llm.components import components


def sets_of(text, words):
    found = (text or "").encode().lower().split()
    if not found:
        return set()
    n = min(words, len(found))
    return {tuple(found[i : i + n]) for i in range(len(found) - n + 1)}


def expected(rows, words):
    """Smallest id of each row's component, by comparing all pairs."""
    sets = [sets_of(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc_id)
    return [(d, len(s), min(x for x in ids[find(i)]) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def corpus():
    """Copies, chains of near copies around the threshold, and texts that share a passage."""
    r = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(12):
        text = [r.choice(vocabulary) for _ in range(r.randint(8, 120))]
        for _ in range(r.randint(1, 14)):
            copy = [w if r.random() > 0.035 else r.choice(vocabulary) for w in text]
            text = copy if r.random() < 0.5 else text
            rows.append(" ".join(copy))
    shared = " ".join(r.choice(vocabulary) for _ in range(40))
    rows += [shared + " " + " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 30))) for _ in range(30)]
    rows += [shared] * 15 + ["Same TEXT here", "same text here", "one", "One", "", None, " \n", "w1 w2"]
    r.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("words", [2, 5])
def test_against_all_pairs(documents, words):
    rows = corpus()
    found = mh.component_ids(documents(rows), words).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == sorted(expected(rows, words))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    left = mh.keep_one(documents(rows), words)
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(r["doc_id"] for r in found if r["kept"])


def test_large_groups_are_cut_into_blocks(documents, monkeypatch):
    monkeypatch.setattr(mh, "BLOCK", 8)
    rows = corpus()
    found = mh.component_ids(documents(rows), 2).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == sorted(expected(rows, 2))


def test_joins_without_broadcast(documents, monkeypatch):
    monkeypatch.setattr(mh, "BROADCAST_ROWS", -1)
    rows = corpus()[:60]
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in mh.component_ids(documents(rows), 2).collect()) == sorted(expected(rows, 2))


def test_equal_rows_and_missing_ids(documents):
    rows = [(5, "a b c"), (5, "a b c"), (None, "a b c"), (None, "x y"), (None, None), (2, "a b c"), (5, "other words")]
    found = mh.component_ids(documents(rows), 2).collect()
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, found), key=str) == sorted(
        [(5, 2, 2, False), (5, 2, 2, False), (None, 2, 2, False), (None, 1, None, False), (None, 0, None, False), (2, 2, 2, True), (5, 1, 5, True)], key=str
    ), sorted(found, key=key)
    left = mh.keep_one(documents(rows), 2)
    assert left.columns == documents(rows).columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == [(2, "a b c"), (5, "other words"), (None, "x y"), (None, None)]
    twice = mh.keep_one(documents([(7, "p q r"), (7, "p q r"), (8, "z")]), 2)
    assert sorted(r["doc_id"] for r in twice.collect()) == [7, 8]


def test_empty_table_and_long_text(documents):
    assert mh.component_ids(documents([]), 2).count() == 0 and mh.keep_one(documents([])).count() == 0
    long = " ".join(f"v{i}" for i in range(60_000))
    found = mh.component_ids(documents([(1, long), (2, long + " end"), (3, "v1 v2")]), 2).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == [(1, 59_999, 1), (2, 60_000, 1), (3, 1, 3)]


def test_signatures_estimate_similarity():
    r = np.random.default_rng(3)
    errors = []
    for _ in range(40):
        union = r.integers(0, 2**63, 600, dtype=np.int64).astype(np.uint64) << np.uint64(1)
        a, b = np.sort(union[:500]), np.sort(union[100:])
        errors.append((mh.signature(a) == mh.signature(b)).mean() - 400 / 600)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_permutations_are_one_to_one():
    x = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65537)
    assert len(np.unique(mh._scrambled(x.copy(), 0x7FEB352D, 0x846CA68B))) == 1 << 16


def test_whole_table(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    found = mh.component_ids(table(spark, sf, "documents"), 2).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == sorted(expected(rows, 2))


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, i) for i in range(101, 160)]
    edges = spark.createDataFrame([*chain, *star, (200, 200), (301, 300), (300, 301)], "a long, b long")
    found = {r["node"]: r["label"] for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}
    assert components(edges.limit(0)).count() == 0
