"""Approximate nearest neighbours with a robust-pruned directed graph per shard.

Vectors are spread over shards of bounded size by a hash of their id. A shard's
graph starts with random edges; then every point is searched for greedily, what
the search has visited is proposed as neighbours, and a relaxed distance pruning
keeps a diverse few: a candidate goes if ``alpha`` times its distance to a chosen
neighbour is within its distance to the point. Edges are put in both ways. Queries
search every shard with a beam. Equal vectors share one node.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchtide.llm.common import ship_package
from searchtide.llm.kdtree import matrix, over_shards, sharded, usable

FOUND = "query_id long, vec_id long, score double"
#: Most numbers in one block of pairwise distances.
BLOCK = 4_000_000


class Graph:
    def __init__(self, points: np.ndarray, degree: int, beam: int, alpha: float, seed: int = 0):
        wide = np.abs(points).max(initial=0.0) >= 1e15
        self.points = points if wide else points.astype(np.float32)
        self.degree, self.beam, self.alpha = degree, beam, alpha
        n = len(points)
        rng = np.random.default_rng(seed)
        self.edges = rng.integers(0, n, (n, degree), dtype=np.int64)
        self.edges[self.edges == np.arange(n)[:, None]] = -1
        middle = self.points.mean(axis=0)
        self.entry = int(np.argmin(((self.points - middle) ** 2).sum(axis=1)))
        order = rng.permutation(n)
        size = 256
        for start in range(0, n, size):
            self._insert(order[start : start + size])

    def beam_search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The beam of each query, nearest first, and all nodes it has expanded (-1: none)."""
        n_queries, rows = len(queries), np.arange(len(queries))
        ids = np.full((n_queries, beam), -1)
        far = np.full((n_queries, beam), np.inf, self.points.dtype)
        done = np.ones((n_queries, beam), bool)
        ids[:, 0] = self.entry
        far[:, 0] = ((self.points[self.entry] - queries) ** 2).sum(axis=1)
        done[:, 0] = False
        visited = []
        while True:
            at = np.argmin(done, axis=1)
            active = ~done[rows, at]
            if not active.any():
                break
            done[rows, at] = True
            node = np.where(active, ids[rows, at], -1)
            visited.append(node)
            near = self.edges[node]
            near[~active] = -1
            gap = self.points[near] - queries[:, None, :]
            away = np.einsum("bnd,bnd->bn", gap, gap)
            away[(near[:, :, None] == ids[:, None, :]).any(axis=2) | (near < 0)] = np.inf
            all_far = np.concatenate([far, away], axis=1)
            all_ids = np.concatenate([ids, near], axis=1)
            all_done = np.concatenate([done, np.isinf(away)], axis=1)
            keep = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            far = np.take_along_axis(all_far, keep, 1)
            ids = np.where(np.isinf(far), -1, np.take_along_axis(all_ids, keep, 1))
            done = np.take_along_axis(all_done, keep, 1) | np.isinf(far)
        return ids, np.stack(visited, axis=1)

    def _pruned(self, nodes: np.ndarray, proposed: np.ndarray) -> np.ndarray:
        """Up to ``degree`` diverse neighbours for each node out of its candidates (-1: none)."""
        chosen = np.full((len(nodes), self.degree), -1)
        width = proposed.shape[1]
        step = max(1, BLOCK // (width * max(width, self.points.shape[1])))
        for start in range(0, len(nodes), step):
            own, some = nodes[start : start + step], np.sort(proposed[start : start + step], axis=1)
            some[:, 1:][some[:, 1:] == some[:, :-1]] = -1
            some[some == own[:, None]] = -1
            spots = self.points[some]
            gap = spots - self.points[own][:, None, :]
            away = np.einsum("bnd,bnd->bn", gap, gap)
            away[some < 0] = np.inf
            squares = np.einsum("bnd,bnd->bn", spots, spots)
            between = squares[:, :, None] + squares[:, None, :] - 2 * spots @ spots.transpose(0, 2, 1)
            rows = np.arange(len(own))
            for slot in range(self.degree):
                pick = np.argmin(away, axis=1)
                left = np.isfinite(away[rows, pick])
                if not left.any():
                    break
                chosen[start : start + step, slot] = np.where(left, some[rows, pick], -1)
                reach = self.alpha**2 * between[rows, pick]
                gone = (reach <= away) & left[:, None]
                away[gone] = np.inf
                away[rows, pick] = np.inf
        return chosen

    def _insert(self, nodes: np.ndarray) -> None:
        _, visited = self.beam_search(self.points[nodes], self.beam)
        self.edges[nodes] = self._pruned(nodes, np.concatenate([visited, self.edges[nodes]], axis=1))
        heads = np.repeat(nodes, self.degree)
        tails = self.edges[nodes].ravel()
        heads, tails = heads[tails >= 0], tails[tails >= 0]
        order = np.argsort(tails, kind="stable")
        heads, tails = heads[order], tails[order]
        targets, first, counts = np.unique(tails, return_index=True, return_counts=True)
        width = int(counts.max(initial=0))
        if not width:
            return
        added = np.full((len(targets), width), -1)
        row = np.repeat(np.arange(len(targets)), counts)
        added[row, np.arange(len(tails)) - np.repeat(first, counts)] = heads
        self.edges[targets] = self._pruned(targets, np.concatenate([self.edges[targets], added], axis=1))


def _within(vectors: pd.DataFrame) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct points of a shard and the ascending ids of each."""
    points, which = np.unique(matrix(vectors["embedding"]), axis=0, return_inverse=True)
    ids = vectors["vec_id"].to_numpy()
    order = np.lexsort((ids, which.ravel()))
    cuts = np.flatnonzero(np.diff(which.ravel()[order])) + 1
    return points, np.split(ids[order], cuts)


def nearest(
    embeddings: DataFrame,
    queries: Column | str,
    k: int = 10,
    shard_rows: int = 2048,
    degree: int = 24,
    build_beam: int = 40,
    beam: int = 64,
    alpha: float = 1.2,
    block: int = 128,
) -> DataFrame:
    """(query_id, rank, vec_id, score): k near rows of every row that ``queries`` picks.

    The score is the Euclidean distance in double precision. All rows are in a
    graph; which near ones a beam finds is approximate. A query's own id is no
    candidate; ties go to smaller ids. Vectors that are null, empty, zero or hold
    null or non-finite components take no part, nor do pairs of different lengths;
    repeated ids count once. An empty table, or one without queries, gives no rows.
    ``queries`` may use vec_id and embedding; other columns are left aside. Queries
    stream past a shard's graph, so a task holds one shard and a batch of queries.
    """
    ship_package(embeddings.sparkSession)
    vector = F.col("embedding")
    ok = usable(vector) & F.exists(vector, lambda x: x != 0)
    vectors, n_shards = sharded(embeddings, shard_rows, ok)
    shards = F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))
    asked = vectors.where(queries).select("vec_id", "embedding", "dim", shards.alias("shard"))

    def index(stock: pd.DataFrame) -> tuple[np.ndarray, list[np.ndarray], Graph]:
        points, ids = _within(stock)
        return points, ids, Graph(points, degree, build_beam, alpha)

    def answer(made: tuple[np.ndarray, list[np.ndarray], Graph], asks: pd.DataFrame) -> pd.DataFrame:
        points, ids, graph = made
        found: list[pd.DataFrame] = []
        targets = matrix(asks["embedding"])
        for start in range(0, len(asks), block):
            part = targets[start : start + block]
            near, _ = graph.beam_search(part.astype(graph.points.dtype), max(beam, k + 1))
            asking = asks["vec_id"].iloc[start : start + block]
            for row, (query, some) in enumerate(zip(asking, near, strict=True)):
                some = some[some >= 0]
                away = np.sqrt(((points[some] - part[row]) ** 2).sum(axis=1))
                few = [ids[node][: k + 1] for node in some]
                table = pd.DataFrame(
                    {
                        "query_id": query,
                        "vec_id": np.concatenate(few),
                        "score": np.repeat(away, [len(x) for x in few]),
                    }
                )
                table = table[table["vec_id"] != query]
                found.append(table.sort_values(["score", "vec_id"]).head(k))
        return pd.concat(found)

    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        over_shards(vectors, asked, n_shards, index, answer, FOUND)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
