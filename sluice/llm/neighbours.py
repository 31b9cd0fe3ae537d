"""Approximate nearest neighbours (largest inner product) by collision counting.

Vectors are projected on random orthogonal directions, one sorted array per direction, of which both ends are kept. A
query counts on those directions on which it lies farthest out. Its window on a direction holds the ranks around its own
projection and grows by virtual rehashing: every round widens it by a constant factor and counts only what is new.
Vectors that collide with the query on enough directions are verified in double precision; if the widest windows hold
too few of them, those with the most collisions are.

Directions, windows and verified vectors grow with the root of the rows: of more directions some lie nearer to a query,
and fewer rows need to be looked at. So does the number of blocks, until a block holds ``CELLS`` numbers. Queries meet
the blocks of vectors block by block, so a task holds one of each.

Nearness stands for inner products where norms are alike, so vectors are indexed in bands of similar norm. Bands are
searched from the largest norm down, and a query stops at the first band that can't hold anything better than its ``k``
best (|q| times the band's largest norm).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sluice.llm.common import stage

#: A query counts on so many directions. A vector is verified once it collides on ``THRESHOLD`` of them.
CHOSEN, THRESHOLD = 128, 16
#: For ``BASE`` rows: directions, rows in the first window, rows to verify besides the best ones.
BASE, DIRECTIONS, WINDOW, ENOUGH = 10_000, 768, 300, 1_800
WIDEN, ROUNDS = 1.4, 4
#: Largest norm of a band over its smallest.
BAND = 1.4
#: The numbers that a block of vectors holds at most, and one of queries.
CELLS, QUERY_CELLS = 2 ** 23, 2 ** 21
#: Rows are dealt to as many blocks as the root of rows / ``BLOCK``.
BLOCK, QUERY_SLICE = 4_096, 64
FOUND = "query_row long, query_id long, part long, vec_id long, score double"


class Band:
    """Vectors of similar norm, scaled to 1 at most, and both ends of their sorted projections, farthest out first."""

    def __init__(self, at: np.ndarray, unit: np.ndarray, norms: np.ndarray, k: int, grown: float, total: int, axes: np.ndarray):
        n, share = len(at), len(at) / total
        self.at, self.top = at, norms[at].max()
        self.enough = k + 1 + math.ceil(ENOUGH * grown * share)
        if self.enough >= n:
            return
        vectors = unit[at] / self.top
        self.axes, self.mean, self.spread = axes, vectors.mean(axis=0), np.cov(vectors.T).reshape(len(axes), -1)
        self.lengths = [min(n, math.ceil(WINDOW * grown * share * WIDEN ** i)) for i in range(ROUNDS)]
        depth = min(n, 2 * self.lengths[-1])
        self.ends = np.empty((2, len(axes[0]), depth), np.int32)
        self.places = np.empty(self.ends.shape, np.float32)
        step = max(1, 2 ** 20 // n)
        for first in range(0, len(axes[0]), step):
            up = axes[:, first:first + step].T @ vectors.T
            for side, projections in ((1, up), (0, -up)):
                cuts = np.partition(projections, depth - 1, axis=1)[:, depth - 1]
                for j, (array, cut) in enumerate(zip(projections, cuts, strict=True), first):
                    near = np.flatnonzero(array <= cut)
                    near = near[np.argsort(array[near], kind="stable")[:depth]]
                    self.ends[side, j], self.places[side, j] = near, array[near]

    def choose(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each query's directions: number, end (0 the upper) and the query's own projection, negative if that end is the upper."""
        # towards the query from the middle of the vectors, and the way its inner products with them grow
        way = sum(x / np.maximum(np.sqrt((x ** 2).sum(axis=1, keepdims=True)), 1e-300) for x in (queries - self.mean, queries @ self.spread))
        out = way @ self.axes
        chosen = np.argpartition(-np.abs(out), CHOSEN - 1, axis=1)[:, :CHOSEN]
        upper = np.take_along_axis(out, chosen, axis=1) >= 0
        own = np.take_along_axis(queries @ self.axes, chosen, axis=1)
        return chosen, 1 - upper.astype(np.int64), np.where(upper, -own, own)

    def collide(self, chosen: np.ndarray, end: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Vectors that collide on ``THRESHOLD`` directions, after the first round with enough of them."""
        counts = np.zeros(len(self.at), np.int64)
        place = (self.places[end, chosen] < own[:, None]).sum(axis=1)
        first, length = place, 0
        for wider in self.lengths:
            before, first = first, np.clip(place - wider // 2, 0, self.ends.shape[2] - wider)
            new = np.arange(wider - length)
            new = first[:, None] + new + np.where(new < (before - first)[:, None], 0, length)
            length = wider
            counts += np.bincount(self.ends[end[:, None], chosen[:, None], new].ravel(), minlength=len(counts))
            found = np.flatnonzero(counts >= THRESHOLD)
            if len(found) >= self.enough:
                return self.at[found]
        return self.at[counts >= np.partition(counts, -self.enough)[-self.enough]]


def search(rows, ids, data, query_rows, queries, k: int, seed: int = 7, total: int | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query (ids, scores) of the best ``k`` found in one block, best first, ties to smaller ids. ``rows``
    and ``query_rows`` number the rows: a query doesn't meet its own. ``total`` rows are in all blocks together."""
    d = data.shape[1]
    # copies share one vector, of which the k + 1 smallest ids can be among the best k of a query
    data = np.ascontiguousarray(data + 0.0)
    _, one, group = np.unique(data.view(np.dtype((np.void, data.itemsize * d))).ravel(), return_index=True, return_inverse=True)
    order = np.lexsort((ids, group))
    starts, copies = np.searchsorted(group[order], np.arange(len(one))), np.minimum(np.bincount(group), k + 1)
    vectors, rows, ids = data[one], rows[order], ids[order]
    total = max(len(one), round((total or len(data)) * len(one) / len(data)))
    grown = math.sqrt(total / BASE)
    turns = math.ceil(max(DIRECTIONS * grown, 2 * CHOSEN) / d)
    axes = np.concatenate(np.linalg.qr(np.random.default_rng(seed).standard_normal((turns, d, d)))[0], axis=1)
    largest = np.abs(vectors).max()
    unit = vectors / largest  # so that no square overflows
    norms = np.maximum(np.sqrt((unit ** 2).sum(axis=1)), 1e-300)
    level = np.floor(np.log(norms.max() / norms) / math.log(BAND) + 1e-9)
    bands = [Band(np.flatnonzero(level == v), unit, norms, k, grown, total, axes) for v in np.unique(level)]
    scaled = queries / np.abs(queries).max(axis=1, keepdims=True)
    size = np.sqrt((scaled ** 2).sum(axis=1))
    best = [(np.empty(0, np.int64), np.empty(0)) for _ in range(len(queries))]
    for first in range(0, len(queries), QUERY_SLICE):
        part = np.arange(first, min(first + QUERY_SLICE, len(queries)))
        for band in bands:
            limit = np.abs(queries[part]).max(axis=1) * size[part] * band.top * largest * (1 + 1e-9)
            going = [i for i, q in enumerate(part) if len(best[q][1]) < k or not limit[i] < best[q][1][-1]]
            whole = band.enough >= len(band.at)
            # a query of the band's norm has the same order of inner products
            windows = [()] * len(going) if whole else zip(*band.choose((scaled[part] / size[part][:, None])[going]), strict=True)
            for q, window in zip(part[going], windows, strict=True):
                at = band.at if whole else band.collide(*window)
                # row by row alike, so that equal vectors tie exactly
                scores = np.einsum("ij,j->i", vectors[at], queries[q])
                if len(scores) > k + 1:
                    kept = np.flatnonzero(scores >= np.partition(scores, -k - 1)[-k - 1])
                    at, scores = at[kept], scores[kept]
                times = copies[at]
                places = np.repeat(starts[at] - np.cumsum(times) + times, times) + np.arange(times.sum())
                other = rows[places] != query_rows[q]
                got = np.concatenate([best[q][0], ids[places[other]]])
                scores = np.concatenate([best[q][1], np.repeat(scores, times)[other]])
                sort = np.lexsort((got, -scores))[:k]
                best[q] = got[sort], scores[sort]
    return best


def _merged(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The best ``k`` of every group as an array of (s: negative score, vec_id)."""
    best = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id")))
    return found.groupBy(*keys).agg(F.slice(best, 1, k).alias("best"))


def nearest(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``vectors`` (vec_id, embedding) whose vec_id is divisible by
    ``every``, the ``k`` nearest found among all other rows, by largest inner product of the original vectors.

    Rows with a null vec_id and vectors that are null, empty, zero or hold null or non-finite components take no
    part. Vectors of another length than a query's aren't its candidates. Rows that repeat a vec_id are
    candidates and queries of their own: each has its own ranks, under the same query_id, and meets the others.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size("v") > 0)
                       & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
                       & F.exists("v", lambda x: x != 0))
    rows = stage(rows.withColumn("d", F.size("v")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, n_queries, d = rows.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0), F.coalesce(F.max("d"), F.lit(1))).first()
    data_blocks = max(1, math.ceil(math.sqrt(n / BLOCK)), math.ceil(n * d / CELLS))
    query_blocks = max(1, math.ceil(n_queries * d / QUERY_CELLS))
    h = F.xxhash64("row")
    data = rows.select("d", F.pmod(h, F.lit(data_blocks)).cast("bigint").alias("b"),
                       F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"), "row", "vec_id", "v")
    queries = rows.filter(F.col("vec_id") % every == 0).select(
        "d", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(data_blocks - 1).cast("bigint"))).alias("b"),
        F.pmod(h, F.lit(query_blocks)).cast("int").alias("qb"), "row", "vec_id", "v")
    parts = math.isqrt(data_blocks - 1) + 1

    def block(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(data):
            return pd.DataFrame({"query_row": [], "query_id": [], "part": [], "vec_id": [], "score": []})
        found = search(data["row"].to_numpy(), data["vec_id"].to_numpy(), np.stack(data["v"].to_numpy()),
                       queries["row"].to_numpy(), np.stack(queries["v"].to_numpy()), k, total=n)
        times = [len(i) for i, _ in found]
        return pd.DataFrame({"query_row": np.repeat(queries["row"].to_numpy(), times), "query_id": np.repeat(queries["vec_id"].to_numpy(), times),
                             "part": data["b"].iloc[0] % parts, "vec_id": np.concatenate([i for i, _ in found]),
                             "score": np.concatenate([s for _, s in found])})

    found = queries.groupBy("d", "b", "qb").cogroup(data.groupBy("d", "b", "qb")).applyInPandas(block, FOUND)
    # the best k of all blocks follow from the best k of each, merged by groups of blocks first: lists grow with the root of the blocks
    some = _merged(found, k, "query_row", "query_id", "part").select("query_row", "query_id", F.explode("best").alias("x"))
    some = some.select("query_row", "query_id", "x.vec_id", (-F.col("x.s")).alias("score"))
    return _merged(some, k, "query_row", "query_id").select("query_id", F.posexplode("best").alias("p", "x")).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score"))
