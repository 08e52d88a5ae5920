"""Approximate nearest neighbours with a forest of random-projection trees.

Each tree halves a bounded sample of the vectors again and again, at the median of
their projections on the line through two of its points. All rows are then led down
to a leaf of each tree. A query searches all trees through one priority queue, in
which a branch ranks by its smallest distance to the planes that part it from the
query, until the leaves it has taken hold enough rows. In each leaf the distances of
its rows to the queries that took it are exact, on the original vectors.

Equal vectors are folded first: a query needs at most its eleven smallest ids of
them. So a vector that a third of all rows share is one row in each tree.

Edge cases: vectors that are null, zero, or hold a null or non-finite component take
no part, neither do those of another length than most vectors have; an empty table
gives an empty one; rows equal in id and vector count once; with fewer candidates
than asked for, all that were found are returned. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import written

TREES = 16
# Trees get deeper with the table, so that a leaf holds this many rows and ``search_rows``
# bounds the work of a query. Beyond the greatest depth, whose planes take 16 MB and
# whose sample 32 MB at 64 dimensions, leaves grow again: from 4 million rows on.
LEAF_ROWS = 1024
LEAST_DEPTH, MOST_DEPTH = 8, 12
# Rows of the sample, at least and by leaf.
SAMPLE_ROWS, SAMPLE_PER_LEAF = 16_384, 16
# Rows that a query looks at, counted once per tree, as a share of all rows. Vectors
# without any structure need this much for a recall of 0.9; for others a number of
# rows, ``search_rows``, is enough.
SEARCH_SHARE = 1.0
# Rows and queries that are compared in one task.
BLOCK_ROWS = 4096


class Forest(NamedTuple):
    """Complete trees: normals (trees, nodes, dimensions) and offsets (trees, nodes)."""

    normals: np.ndarray
    offsets: np.ndarray

    @property
    def depth(self) -> int:
        return (self.offsets.shape[1] + 1).bit_length() - 1


def depth_for(rows: int) -> int:
    """Levels after which a leaf holds about ``LEAF_ROWS`` of so many rows, within the bounds."""
    return min(max(LEAST_DEPTH, (max(rows, 1) // LEAF_ROWS).bit_length()), MOST_DEPTH)


def grow(sample: np.ndarray, trees: int = TREES, depth: int = LEAST_DEPTH, seed: int = 1) -> Forest:
    """Fit the trees on a sample of vectors; nodes without points get any plane."""
    random = np.random.default_rng(seed)
    nodes = (1 << depth) - 1
    normals = np.zeros((trees, nodes, sample.shape[1]), dtype=np.float32)
    offsets = np.zeros((trees, nodes))
    for t in range(trees):
        members = {0: np.arange(len(sample))}
        for node in range(nodes):
            rows = members.pop(node, np.zeros(0, dtype=np.int64))
            normal = random.standard_normal(sample.shape[1])
            if len(rows) > 1:
                a, b = sample[random.choice(rows, 2, replace=False)]
                normal = a - b if (a != b).any() else normal
            normal = normal / np.linalg.norm(normal)
            normals[t, node] = normal
            if len(rows):
                along = sample[rows] @ normals[t, node].astype(np.float64)
                offsets[t, node] = np.median(along)
                right = along > offsets[t, node]
                members[2 * node + 1], members[2 * node + 2] = rows[~right], rows[right]
    return Forest(normals, offsets)


def leaves(forest: Forest, vectors: np.ndarray) -> np.ndarray:
    """Number of the leaf of each vector in each tree: (vectors, trees)."""
    out = np.empty((len(vectors), len(forest.offsets)), dtype=np.int32)
    for t in range(len(forest.offsets)):
        node = np.zeros(len(vectors), dtype=np.int64)
        for _ in range(forest.depth):
            along = np.einsum("ij,ij->i", vectors, forest.normals[t, node], dtype=np.float64)
            node = 2 * node + 1 + (along > forest.offsets[t, node])
        out[:, t] = node - forest.offsets.shape[1]
    return out


def search(forest: Forest, query: np.ndarray, rows: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """The (tree, leaf) pairs that one queue over all trees reaches first, until they hold enough rows.

    ``rows``: the number of rows in each leaf (trees, leaves).
    """
    margins = forest.normals @ query.astype(np.float32) - forest.offsets
    first_leaf = forest.offsets.shape[1]
    queue = [(-np.inf, t, 0) for t in range(len(margins))]
    heapq.heapify(queue)
    found, held = [], 0
    while queue and held < enough:
        distance, t, node = heapq.heappop(queue)
        if node >= first_leaf:
            if rows[t, node - first_leaf]:
                found.append((t, node - first_leaf))
                held += int(rows[t, node - first_leaf])
            continue
        margin = margins[t, node]
        heapq.heappush(queue, (max(distance, -margin), t, 2 * node + 2))
        heapq.heappush(queue, (max(distance, margin), t, 2 * node + 1))
    return found


def valid(table: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id, embedding`` of the rows that take part."""
    e = F.col(vector)
    rows = table.select(F.col(key).alias("vec_id"), e.cast("array<double>").alias("embedding")).where(
        F.col(key).isNotNull()
        & e.isNotNull()
        & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(e, lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), "d").first()
    return rows.where(F.size("embedding") == (common["d"] if common else 0))


def classes(rows: DataFrame, k: int) -> DataFrame:
    """``cid, embedding, members``: each distinct vector once, with its ``k + 1`` smallest ids."""
    place = F.dense_rank().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    folded = few.groupBy("embedding").agg(F.sort_array(F.collect_set("vec_id")).alias("members"))
    return written(folded.withColumn("cid", F.monotonically_increasing_id()), "vectors")


def _stacked(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def _blocks(count: Column | int, key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(count)).cast("int")


def nearest(
    table: DataFrame,
    queries: Column,
    k: int = 10,
    search_rows: int | None = None,
    key: str = "vec_id",
    vector: str = "embedding",
    trees: int = TREES,
    depth: int | None = None,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each row that ``queries`` selects.

    ``search_rows``: rows that a query looks at, counted once per tree; the last leaf
    may bring more. ``depth`` of the trees follows the table unless it is given.
    """
    rows = valid(table, key, vector)
    kinds = classes(rows, k)
    n = kinds.count()
    depth = depth or depth_for(n)
    wanted = max(SAMPLE_ROWS, SAMPLE_PER_LEAF << depth)
    share = min(1.0, wanted / max(n, 1))
    drawn = kinds.where(F.pmod(F.xxhash64("embedding"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    sample = _stacked(drawn.select("embedding").limit(2 * wanted).toPandas()["embedding"])
    forest = grow(sample if len(sample) else np.ones((1, 1)), trees, depth)
    enough = min(search_rows or int(SEARCH_SHARE * n) + k + 1, n * trees)

    def lead(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                at = leaves(forest, _stacked(b["embedding"]))
                yield pd.DataFrame({"cid": b["cid"], "leaves": list(at)})

    placed = written(kinds.select("cid", "embedding").mapInPandas(lead, "cid long, leaves array<int>"), "leaves")
    each = placed.select("cid", F.posexplode("leaves").alias("tree", "leaf"))
    held = np.zeros((trees, 1 << forest.depth), dtype=np.int64)  # as many counts as the forest has leaves
    for r in each.groupBy("tree", "leaf").agg(F.count("*").alias("n")).collect():
        held[r["tree"], r["leaf"]] = r["n"]

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for query, embedding in zip(b["query_id"], b["embedding"], strict=True):
                found = search(forest, np.asarray(embedding, dtype=np.float64), held, enough)
                yield pd.DataFrame(found, columns=["tree", "leaf"]).assign(query_id=query, embedding=[embedding] * len(found))

    asked = rows.where(queries).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("embedding").alias("embedding"))
    probes = asked.mapInPandas(probe, "query_id long, embedding array<double>, tree int, leaf int")
    per_leaf = max(1, n >> forest.depth)
    parts = -(-per_leaf // BLOCK_ROWS)
    # A query takes about enough / per_leaf of all leaves.
    crowd = asked.count() * enough // max(1, per_leaf * trees << forest.depth)
    crowds = 1 + crowd // BLOCK_ROWS
    all_parts = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    all_crowds = F.explode(F.sequence(F.lit(0), F.lit(crowds - 1))).alias("crowd")
    group = ["tree", "leaf", "part", "crowd"]
    left = probes.select("*", all_parts).withColumn("crowd", _blocks(crowds, "query_id"))
    right = each.join(kinds.select("cid", "embedding", F.element_at("members", 1).alias("low")), "cid")
    right = right.withColumn("part", _blocks(parts, "cid")).select("*", all_crowds)

    def compare(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or rows.empty:
            return pd.DataFrame({"query_id": [], "cid": [], "score": []})
        q, x = _stacked(asked["embedding"]), _stacked(rows["embedding"])
        low, cid = rows["low"].to_numpy(), rows["cid"].to_numpy()
        rough = (q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1) - 2 * q @ x.T
        ids, found, scores = [], [], []
        for i, query in enumerate(asked["query_id"]):
            at = np.argpartition(rough[i], k + 6)[: k + 7] if len(x) > k + 7 else np.arange(len(x))
            # Whatever is as near as the last of these, but for rounding, is measured too.
            at = np.flatnonzero(rough[i] <= rough[i, at].max() + 1e-9) if len(x) > k + 7 else at
            exact = np.sqrt(((x[at] - q[i]) ** 2).sum(axis=1))
            best = np.lexsort((low[at], exact))[: k + 1]
            ids += [query] * len(best)
            found += cid[at[best]].tolist()
            scores += exact[best].tolist()
        return pd.DataFrame({"query_id": ids, "cid": found, "score": scores})

    near = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(compare, "query_id long, cid long, score double")
    # A row met in several trees counts once; its class may hold the query itself, so one more class than rows.
    near = near.groupBy("query_id", "cid").agg(F.min("score").alias("score"))
    near = near.join(kinds.select("cid", "members"), "cid")
    by_class = Window.partitionBy("query_id").orderBy("score", F.element_at("members", 1))
    near = near.withColumn("place", F.row_number().over(by_class)).where(F.col("place") <= k + 1)
    each_row = near.select("query_id", "score", F.explode("members").alias("vec_id")).where("vec_id <> query_id")
    by_row = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = each_row.withColumn("rank", F.row_number().over(by_row)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
