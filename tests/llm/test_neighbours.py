import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import neighbours as nb
from ledgerloom.llm.common import configure, table
from ledgerloom.llm.queries import QUERIES


@pytest.fixture
def vectors(spark):
    configure(spark)

    def make(rows):
        made = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<float>")
        return made.selectExpr("*", "'x' as rank", "'y' as score", "1 as tree", "2 as cid", "3 as members")

    return make


def exact(rows, query, k):
    """The k nearest rows to a row, ties to the smaller id."""
    own = dict(rows)[query]
    out = sorted((float(np.sqrt(((np.float32(v).astype(float) - np.float32(own).astype(float)) ** 2).sum())), i) for i, v in rows if i != query)
    return [(i, d) for d, i in out[:k]]


def test_recall_on_the_table(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf, "embeddings").collect()]
    found = QUERIES["op6_nearest_neighbours"](spark, sf).toPandas()
    queries = [i for i, _ in rows if i % 100 == 0]
    assert sorted(found["query_id"].unique()) == sorted(queries)
    hits = []
    for q in queries:
        mine = found[found["query_id"] == q].sort_values("rank")
        want = exact(rows, q, 10)
        assert list(mine["rank"]) == list(range(1, len(want) + 1))
        hits.append(np.isin([i for i, _ in want], mine["vec_id"]).mean())
        distances = dict(exact(rows, q, len(rows)))
        assert all(abs(distances[i] - d) < 1e-12 for i, d in zip(mine["vec_id"], mine["score"], strict=True))
    assert np.mean(hits) >= 0.9


def test_whole_search_is_exact(vectors):
    r = np.random.default_rng(2)
    rows = [(i, r.integers(-2, 3, 4)) for i in range(300)]
    rows = [(i, v if v.any() else np.ones(4)) for i, v in rows]  # many ties and equal vectors
    found = nb.nearest(vectors(rows), F.col("vec_id") % 50 == 0, k=7, search_rows=10**6, trees=3, depth=3).collect()
    for q in range(0, 300, 50):
        mine = sorted((x["rank"], x["vec_id"], x["score"]) for x in found if x["query_id"] == q)
        assert [(i, round(d, 9)) for _, i, d in mine] == [(i, round(d, 9)) for i, d in exact(rows, q, 7)]


def test_one_vector_shared_by_many(vectors):
    rows = [(i, [1, 1]) for i in range(200)] + [(200 + i, [i + 2, 1]) for i in range(50)]
    found = nb.nearest(vectors(rows), F.col("vec_id").isin(0, 150, 200), k=5, trees=2, depth=2).collect()
    by = {q: [x["vec_id"] for x in sorted(found, key=lambda x: x["rank"]) if x["query_id"] == q] for q in (0, 150, 200)}
    assert by[0] == [1, 2, 3, 4, 5] and by[150] == [0, 1, 2, 3, 4] and by[200] == [0, 1, 2, 3, 4]


def test_rows_that_take_no_part(vectors):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 0]), (1, [0, 1]), (2, None), (3, [0, 0]), (4, [1, nan]), (5, [inf, 1]), (6, [1, None]), (7, [1, 2, 3]), (None, [1, 1]), (100, [0, 0]), (1, [0, 1])]
    found = nb.nearest(vectors(rows), F.col("vec_id") % 100 == 0, trees=2, depth=2).collect()
    assert [tuple(x) for x in found] == [(0, 1, 1, 2**0.5)]


def test_nothing_to_find(vectors):
    assert nb.nearest(vectors([(0, [1, 0])]), F.col("vec_id") == 0, trees=1, depth=1).count() == 0
    assert nb.nearest(vectors([(1, [1, 0])]), F.col("vec_id") == 0, trees=1, depth=1).count() == 0
    assert nb.nearest(vectors([]), F.col("vec_id") == 0, trees=1, depth=1).count() == 0


def test_blocks_of_rows_and_queries(vectors, monkeypatch):
    monkeypatch.setattr(nb, "BLOCK_ROWS", 1)
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=3)) for i in range(40)]
    found = nb.nearest(vectors(rows), F.col("vec_id") % 4 == 0, k=3, search_rows=10**6, trees=2, depth=2).collect()
    for q in range(0, 40, 4):
        assert [x["vec_id"] for x in sorted(found, key=lambda x: x["rank"]) if x["query_id"] == q] == [i for i, _ in exact(rows, q, 3)]


def test_the_queue_takes_the_nearest_leaves_first():
    r = np.random.default_rng(8)
    sample = r.normal(size=(512, 4))
    forest = nb.grow(sample, trees=2, depth=4)
    rows = np.stack([np.bincount(nb.leaves(forest, sample)[:, t], minlength=16) for t in range(2)])
    every = nb.search(forest, sample[0], rows, 10**9)
    assert len(set(every)) == len(every) == (rows > 0).sum()
    own = {(t, int(leaf)) for t, leaf in enumerate(nb.leaves(forest, sample[:1])[0])}
    assert set(every[:2]) == own and nb.search(forest, sample[0], rows, 1) == every[:1]


def test_depth_follows_the_table():
    assert [nb.depth_for(n) for n in (0, 1, 1000, 200_000, 300_000, 4_000_000, 10**12)] == [8, 8, 8, 8, 9, 12, 12]
    assert all(nb.LEAF_ROWS // 2 <= n >> nb.depth_for(n) <= nb.LEAF_ROWS for n in range(270_000, 4_000_000, 7919))


def test_recall_on_clusters_within_few_rows(vectors, monkeypatch):
    # Leaves of eight rows: the trees are as deep as for a hundred times the rows.
    monkeypatch.setattr(nb, "LEAF_ROWS", 8)
    r = np.random.default_rng(11)
    centres = r.normal(size=(60, 16)) * 3
    rows = [(i, centres[i % 60] + r.normal(size=16) * 0.3) for i in range(6000)]
    assert nb.depth_for(len(rows)) == 10
    found = nb.nearest(vectors(rows), F.col("vec_id") % 300 == 0, k=10, search_rows=1200, trees=8).collect()
    hits = []
    for q in range(0, 6000, 300):
        mine = {x["vec_id"] for x in found if x["query_id"] == q}
        hits.append(np.mean([i in mine for i, _ in exact(rows, q, 10)]))
    assert np.mean(hits) >= 0.9
