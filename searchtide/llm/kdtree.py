"""Exact top-k search by inner product with one KD-tree per shard.

Vectors are spread over shards of bounded size by a hash of their id. A shard's
tree splits at the median of its widest dimension and keeps tight bounding boxes;
a search visits boxes best first, by the largest inner product that a point of the
box can have, and stops when no box can beat the k-th score. Every query first
searches its own shard; the k-th score found there goes with it to all others.
"""

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchtide.llm.common import ship_package, stored

FOUND = "query_id long, vec_id long, score long"
LONG = 2**63
#: Inner products below it are exact in doubles.
EXACT = 2**52


def usable(embedding: Column) -> Column:
    """True for a vector with at least one component, all of them finite."""
    finite = F.forall(
        embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    )
    return embedding.isNotNull() & (F.size(embedding) > 0) & finite


def sharded(embeddings: DataFrame, shard_rows: int, ok: Column) -> tuple[DataFrame, int]:
    """(vec_id, embedding, dim, shard) of usable vectors, one row per vec_id.

    Null ids are left out; of rows with the same id the least vector counts.
    """
    one = (
        embeddings.where(F.col("vec_id").isNotNull() & ok)
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
    )
    n_shards = max(1, -(-embeddings.count() // shard_rows))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(n_shards)).cast("int")
    cut = one.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        "embedding",
        F.size("embedding").alias("dim"),
        shard.alias("shard"),
    )
    return stored(cut, "vectors"), n_shards


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def as_integers(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 x). As floats while every inner product is exact, else as integers."""
    whole = np.floor(vectors * 1024.0)
    largest = float(np.abs(whole).max(initial=0.0))
    if largest**2 * vectors.shape[1] < EXACT:
        return whole
    return _integers(whole)


def _integers(whole: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in whole], dtype=object)


def over_shards(
    vectors: DataFrame,
    asked: DataFrame,
    n_shards: int,
    index: Callable[[pd.DataFrame], Any],
    answer: Callable[[Any, pd.DataFrame], pd.DataFrame],
    found: str,
) -> DataFrame:
    """What ``answer`` gives for the index of each shard and the queries sent there.

    Both tables have the same columns, ``dim`` and ``shard`` among them. A shard's
    rows come to one task sorted, its vectors before its queries: the vectors, of
    bounded number, become an index once, and the queries stream past it in batches,
    however many they are. Queries for a shard without vectors of their length find
    nothing.
    """
    both = vectors.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)))
    # The number of tasks is given, as little data may be much work.
    rows = both.repartition(n_shards, "dim", "shard").sortWithinPartitions("dim", "shard", "asks")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, stock, made = None, [], None
        for batch in batches:
            for (dim, shard, asks), part in batch.groupby(["dim", "shard", "asks"], sort=True):
                if (dim, shard) != here:
                    here, stock, made = (dim, shard), [], None
                if not asks:
                    stock.append(part)
                    continue
                if stock:
                    made, stock = index(pd.concat(stock)), []
                if made is not None:
                    yield answer(made, part)

    return rows.mapInPandas(run, found)


@dataclass
class Tree:
    points: np.ndarray  # in the order of the leaves
    ids: np.ndarray
    low: np.ndarray  # box of every node
    high: np.ndarray
    least_id: np.ndarray
    children: list[tuple[int, int] | None]
    spans: list[tuple[int, int]]

    def in_integers(self) -> "Tree":
        """The same tree with whole numbers of any size instead of doubles."""
        points, low, high = _integers(self.points), _integers(self.low), _integers(self.high)
        return replace(self, points=points, low=low, high=high)


def build(points: np.ndarray, ids: np.ndarray, leaf_size: int = 64) -> Tree:
    order = np.arange(len(points))
    low, high, least, children, spans = [], [], [], [], []

    def node(start: int, stop: int) -> int:
        own = order[start:stop]
        box = points[own]
        here = len(spans)
        low.append(box.min(axis=0))
        high.append(box.max(axis=0))
        least.append(ids[own].min())
        spans.append((start, stop))
        children.append(None)
        widths = high[here] - low[here]
        if stop - start > leaf_size and widths.max() > 0:
            middle = (stop - start) // 2
            along = box[:, int(np.argmax(widths))].astype(np.float64)
            order[start:stop] = own[np.argpartition(along, middle)]
            children[here] = (node(start, start + middle), node(start + middle, stop))
        return here

    node(0, len(points))
    return Tree(
        points[order], ids[order], np.array(low), np.array(high), np.array(least), children, spans
    )


def bounds(tree: Tree, queries: np.ndarray) -> np.ndarray:
    """Largest inner product of each query with any point of each node's box."""
    plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
    return plus @ tree.high.T + minus @ tree.low.T


def search(
    tree: Tree, query: np.ndarray, reach: np.ndarray, k: int, floor: int | None, own_id: int
) -> list[tuple[int, int]]:
    """The best (score, id), at most k, with a score of at least ``floor``."""
    best: list[tuple] = []  # heap of (score, -id), the worst first
    heap = [(-reach[0], 0)]
    while heap:
        bound, at = heapq.heappop(heap)
        bound = -bound
        if floor is not None and bound < floor:
            break
        if len(best) == k and (bound, -tree.least_id[at]) <= best[0]:
            if bound < best[0][0]:
                break
            continue
        if tree.children[at]:
            for child in tree.children[at]:
                heapq.heappush(heap, (-reach[child], child))
            continue
        start, stop = tree.spans[at]
        scores, ids = tree.points[start:stop] @ query, tree.ids[start:stop]
        keep = ids != own_id
        if floor is not None:
            keep &= scores >= floor
        if len(best) == k:
            keep &= scores >= best[0][0]
        scores, ids = scores[keep], ids[keep]
        if len(ids) > k:
            first = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[first], ids[first]
        for score, vec_id in zip(scores.tolist(), ids.tolist(), strict=True):
            entry = (score, -vec_id)
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
    return [(score, -minus) for score, minus in best]


def top_k(
    embeddings: DataFrame,
    queries: Column | str,
    k: int = 10,
    shard_rows: int = 4096,
    leaf_size: int = 64,
    block: int = 256,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every row that ``queries`` picks.

    A component x counts as floor(1024 x); the score is the inner product. A
    query's own id is no candidate; ties go to smaller ids. Null vectors, empty
    ones and those with null or non-finite components take no part, nor do pairs
    of different lengths; repeated ids count once. A score beyond a long is cut to
    it. An empty table, or one without queries, gives no rows. ``queries`` may use
    vec_id and embedding; other columns are left aside. Queries stream past a shard's
    tree, so a task holds one shard and a batch of queries.
    """
    ship_package(embeddings.sparkSession)
    vectors, n_shards = sharded(embeddings, shard_rows, usable(F.col("embedding")))
    # No null among them: a column of whole numbers with nulls would come as doubles.
    vectors = vectors.withColumn("floor", F.lit(-LONG).cast("long"))
    asked = vectors.where(queries)

    def index(points: pd.DataFrame) -> list[Tree | None]:
        """The tree in doubles, and room for the same in integers."""
        whole = np.floor(matrix(points["embedding"]) * 1024.0)
        return [build(whole, points["vec_id"].to_numpy(), leaf_size), None]

    def answer(trees: list[Tree | None], asks: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple[int, int, int]] = []
        whole = np.floor(matrix(asks["embedding"]) * 1024.0)
        reach = np.abs(whole).max(axis=1) * max(float(np.abs(trees[0].points).max()), 1.0) * whole.shape[1]
        ids, floors = asks["vec_id"].to_numpy(), asks["floor"].to_numpy()
        for exact in (True, False):
            some = np.flatnonzero((reach < EXACT) == exact)
            if not exact and len(some) and trees[1] is None:
                trees[1] = trees[0].in_integers()
            for start in range(0, len(some), block):
                part = some[start : start + block]
                tree, vecs = (trees[0], whole[part]) if exact else (trees[1], _integers(whole[part]))
                for i, vec, boxes in zip(part.tolist(), vecs, bounds(tree, vecs), strict=True):
                    least = None if floors[i] == -LONG else int(floors[i])
                    for score, vec_id in search(tree, vec, boxes, k, least, ids[i]):
                        rows.append((ids[i], vec_id, min(max(int(score), -LONG), LONG - 1)))
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    home = stored(over_shards(vectors, asked, n_shards, index, answer, FOUND), "home")
    kth = (
        home.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") == k)
        # A cut score is no safe bound.
        .where(F.abs("score") < F.lit(2**62))
        .select("query_id", F.col("score").alias("kth"))
    )
    others = F.array_except(F.sequence(F.lit(0), F.lit(n_shards - 1)), F.array("shard"))
    away = asked.join(kth, F.col("vec_id") == F.col("query_id"), "left").select(
        "vec_id",
        "embedding",
        "dim",
        F.explode(others).alias("shard"),
        F.coalesce("kth", "floor").alias("floor"),
    )
    found = home
    if n_shards > 1:
        found = home.unionByName(over_shards(vectors, away, n_shards, index, answer, FOUND))
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
