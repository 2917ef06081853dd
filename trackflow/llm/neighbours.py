"""Nearest neighbours by stable random projections and a kd-tree.

Largest inner products become smallest distances: candidates get one more coordinate that brings all
of them to the same norm, queries are scaled to that norm. A few Gaussian (2-stable) projections of
the vectors are indexed by a kd-tree. A query's candidates are taken in the order of their projected
distance and verified exactly, until the chi-square test holds: a vector as near as the k-th found
would, with probability `confidence`, have had a smaller projected distance than the next one.

Candidates are dealt into blocks by hash, each with a tree of its own. A query searches its home block
first; the k-th score found there bounds the search in all other blocks from the start, in which only
leaves, and of these only vectors, within the bound are looked at. The best of each block are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackflow.llm.shared import stored


@dataclass(frozen=True)
class Plan:
    k: int = 20
    projections: int = 24  # even, so that the chi-square distribution has a closed form
    confidence: float = 0.95
    leaf: int = 32
    step: int = 64  # vectors verified before the first test
    block_rows: int = 4096
    query_rows: int = 4096
    seed: int = 20


def chi_square(x: np.ndarray | float, degrees: int) -> np.ndarray | float:
    """Distribution function for an even number of degrees of freedom."""
    half = np.asarray(x) / 2
    term, total = np.ones_like(half), np.zeros_like(half)
    for i in range(degrees // 2):
        if i:
            term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def _quantile(p: float, degrees: int) -> float:
    lo, hi = 0.0, 1e3
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(mid, degrees) < p else (lo, mid)
    return hi


class Tree:
    """kd-tree of projected vectors: an order of the rows, and the box of each leaf's slice of it."""

    def __init__(self, points: np.ndarray, leaf: int) -> None:
        self.order = np.arange(len(points))
        cuts = [0, len(points)]
        todo = [(0, len(points))]
        while todo:
            lo, hi = todo.pop()
            if hi - lo <= leaf:
                continue
            own = points[self.order[lo:hi]]
            axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
            middle = (hi - lo) // 2
            self.order[lo:hi] = self.order[lo:hi][np.argpartition(own[:, axis], middle)]
            cuts.append(lo + middle)
            todo += [(lo, lo + middle), (lo + middle, hi)]
        self.cuts = np.unique(cuts)
        sorted_points = points[self.order]
        self.low = np.minimum.reduceat(sorted_points, self.cuts[:-1], axis=0)
        self.high = np.maximum.reduceat(sorted_points, self.cuts[:-1], axis=0)

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of each point to each leaf's box."""
        out = np.zeros((len(points), len(self.low)))
        for d in range(points.shape[1]):
            x = points[:, d : d + 1]
            gap = np.maximum(np.maximum(self.low[:, d] - x, x - self.high[:, d]), 0)
            out += gap * gap
        return out


@dataclass
class Work:
    """How many vectors a search could have verified, and how many it did."""

    possible: int = 0
    verified: int = 0


class BlockIndex:
    """Different vectors of a block, the kd-tree of their projections, and the ids of each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm: float, unit: float, plan: Plan) -> None:
        self.norm, self.unit, self.plan = norm, unit, plan
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        raw = vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
        _, first, group = np.unique(raw, return_index=True, return_inverse=True)
        by_group = np.argsort(group, kind="stable")
        self.ids, self.starts = ids[by_group], np.searchsorted(group[by_group], np.arange(len(first) + 1))
        self.vectors = vectors[first]
        scaled = self.vectors / unit
        rest = np.sqrt(np.maximum(norm * norm - np.einsum("ij,ij->i", scaled, scaled), 0.0))
        project = np.random.default_rng(plan.seed).standard_normal((vectors.shape[1] + 1, plan.projections))
        points = np.column_stack((scaled, rest)) @ project
        self.project = project[:-1]
        self.tree = Tree(points, plan.leaf)
        self.points, self.members = points[self.tree.order], scaled[self.tree.order]
        self.limit = _quantile(plan.confidence, plan.projections)

    def search(
        self, query_ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, work: Work | None = None
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of the best k of each query, best first, ties to the smaller id.

        bounds: a score that the k-th best of all blocks is known to reach, or minus infinity."""
        top = np.abs(queries).max(axis=1)
        lengths = np.sqrt(np.square(queries / top[:, None]).sum(axis=1))
        direction = queries / top[:, None] / lengths[:, None]
        aim = direction @ self.project * self.norm
        gaps = self.tree.distances(aim)
        # The largest inner product with a direction that may be passed over, in the index's unit.
        reached = bounds / self.unit / top / lengths
        for q in range(len(queries)):
            yield self._one(query_ids[q], queries[q], direction[q], aim[q], gaps[q], reached[q], work)

    def _radius(self, reached: float) -> float:
        """Projected distance beyond which the chi-square test holds, both squared."""
        return self.limit * max(2 * self.norm * (self.norm - reached), 0.0) if reached > -math.inf else math.inf

    def _one(self, own, query, direction, aim, gaps, reached, work) -> tuple[np.ndarray, np.ndarray]:
        k, cuts = self.plan.k, self.tree.cuts
        radius = self._radius(reached)
        leaves = np.flatnonzero(gaps <= radius)
        rows = np.concatenate([np.arange(cuts[x], cuts[x + 1]) for x in leaves]) if len(leaves) else np.zeros(0, np.int64)
        away = np.square(self.points[rows] - aim).sum(axis=1)
        near = away <= radius
        rows, away = rows[near], away[near]
        order = np.argsort(away, kind="stable")
        rows, away = rows[order], away[order]
        # The nearest first; then, as the k-th score rises, only what the test still asks for.
        done, step, products = 0, self.plan.step, np.zeros(0)
        while done < len(rows) and away[done] <= radius:
            upto = min(done + step, int(np.searchsorted(away, radius, "right")))
            products = np.concatenate((products, self.members[rows[done:upto]] @ direction))
            done, step = upto, 4 * step
            if len(products) > k:
                # One more than k, as the query's own row may be among them.
                reached = max(reached, np.partition(products, len(products) - k - 1)[-k - 1])
                radius = self._radius(reached)
        if work is not None:
            work.possible += len(self.vectors)
            work.verified += done
        good = self.tree.order[rows[:done][products >= reached - 1e-9 * self.norm]]
        exact = (self.vectors[good] * query).sum(axis=1)
        found_ids, found = [np.zeros(0, self.ids.dtype)], [np.zeros(0)]
        for u, value in zip(good.tolist(), exact.tolist(), strict=True):
            # Equal vectors are one candidate; of their ids the smallest k + 1 can matter.
            ids = self.ids[self.starts[u] : self.starts[u + 1]][: k + 1]
            found_ids.append(ids[ids != own])
            found.append(np.full(len(found_ids[-1]), value))
        ids, scores = np.concatenate(found_ids), np.concatenate(found)
        best = np.lexsort((ids, -scores))[:k]
        return ids[best], scores[best]


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), np.float64)


def _searcher(norm: float, unit: float, plan: Plan):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            empty = pd.DataFrame({"query_id": [], "copy": [], "vec_id": [], "score": []}).astype("int64")
            return empty.astype({"score": "float64"})
        index = BlockIndex(left["vec_id"].to_numpy(), _matrix(left["v"]), norm, unit, plan)
        query_ids, copies = right["query_id"].to_numpy(), right["copy"].to_numpy()
        found = list(index.search(query_ids, _matrix(right["query"]), right["bound"].to_numpy(np.float64)))
        sizes = [len(i) for i, _ in found]
        return pd.DataFrame(
            {
                "query_id": np.repeat(query_ids, sizes),
                "copy": np.repeat(copies, sizes),
                "vec_id": np.concatenate([i for i, _ in found]),
                "score": np.concatenate([s for _, s in found]),
            }
        )

    return run


FOUND = "query_id long, copy long, vec_id long, score double"


def _search_length(rows: DataFrame, is_query: str, n: int, n_queries: int, largest: float, plan: Plan) -> DataFrame:
    """The best k of each query of each pair of blocks it searched, over different rows of one length."""
    blocks, parts = -(-n // plan.block_rows), max(-(-n_queries // plan.query_rows), 1)
    # Entries are taken in units of the largest one, so that no square overflows.
    square = rows.select(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / largest) * (x / largest)).alias("s"))
    norm = math.sqrt(square.agg(F.max("s")).first()[0]) * (1 + 1e-12)

    def dealt(salt: int, into: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", "v", F.lit(salt)), F.lit(into)).cast("int")

    def every(size: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(size - 1)))

    run = _searcher(norm, largest, plan)
    candidates = rows.select(F.col("vec_id").alias("vec_id"), F.col("v").alias("v"), dealt(0, blocks).alias("c"))
    asked = rows.where(is_query).select(
        F.col("vec_id").alias("query_id"), F.col("v").alias("query"), F.xxhash64("v").alias("copy"),
        dealt(1, blocks).alias("home"), dealt(2, parts).alias("p"),
    )
    home = asked.select("query_id", "query", "copy", F.col("home").alias("c"), F.lit(-math.inf).alias("bound"))
    first = stored(candidates.groupBy("c").cogroup(home.groupBy("c")).applyInPandas(run, FOUND), "neighbours-home")
    if blocks == 1:
        return first
    bounds = first.groupBy(F.col("query_id").alias("_q"), F.col("copy").alias("_copy")).agg(
        F.when(F.count(F.lit(1)) >= plan.k, F.min("score")).alias("bound")
    )
    known = (F.col("query_id") == F.col("_q")) & (F.col("copy") == F.col("_copy"))
    others = asked.join(bounds, known, "left").select(
        "query_id", "query", "copy", F.coalesce("bound", F.lit(-math.inf)).alias("bound"), "home", "p", every(blocks).alias("c")
    )
    others = others.where("c <> home")
    candidates = candidates.withColumn("p", every(parts))
    rest = candidates.groupBy("c", "p").cogroup(others.groupBy("c", "p")).applyInPandas(run, FOUND)
    return first.unionByName(rest)


def search(vectors: DataFrame, is_query: str, plan: Plan = Plan()) -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates found with the largest inner product.

    vectors: vec_id, embedding; is_query: a condition on vec_id. A query's own id is no candidate.
    Rows with a null id, and null, empty, zero or non-finite vectors, take no part; vectors are compared
    with those of their own length. Identical rows count once; rows of one id with other vectors are
    queries of their own. Other columns are ignored."""
    sound = F.expr(
        "vec_id is not null and embedding is not null and exists(embedding, x -> x <> 0)"
        " and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    )
    rows = vectors.where(sound).select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    rows = stored(rows.distinct().withColumn("size", F.size("v")), "neighbours-rows")
    lengths = rows.groupBy("size").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.expr(f"int({is_query})")).alias("q"),
        F.max(F.expr("array_max(transform(v, x -> abs(x)))")).alias("largest"),
    )
    found: DataFrame | None = None
    # One entry per vector length, which is one in a table of embeddings.
    for r in sorted(lengths.collect()):
        part = _search_length(rows.where(F.col("size") == r.size).drop("size"), is_query, r.n, r.q, r.largest, plan)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    order = Window.partitionBy("query_id", "copy").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= plan.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
