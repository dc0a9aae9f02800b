"""Exact top-k by inner product with cover trees over queries and vectors together.

Vectors lie in cells around pivots of a bounded sample. Queries travel as rows to the cells whose
bound reaches their worst k-th score (see `meeting` of the library), the most promising first, so
no query passes through the driver and the plan has the same size for any number of them. Where a
chunk of queries meets a part of a cell, a cover tree is built over each and both are searched
together, best bound first: a pair of nodes is left out when centre product plus covering radii
cannot reach the worst k-th score of the query group.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part.
Shorter vectors count as filled up with zeros. Ties go to the smaller id. Every row is a candidate,
also one that repeats another; the rows with a query's own id are none. Of several vectors under
one query id the smallest is searched. Null ids take no part. An empty table gives an empty result.
Scores are whole numbers of 64 bits; a table whose scores could need more raises an error.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.operators import meeting
from textloom.operators.retrieve import best_of
from textloom.operators.scoring import matrix_of
from textloom.session import materialise

_LEAF = 128
_FAN = 12
_NONE, _EMPTY = np.iinfo(np.int64).max, np.iinfo(np.int64).min


def scaled(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """Valid rows as `id` and `v`, the floor of each component times `scale`, as whole numbers."""
    values = F.transform(vector, lambda x: x.cast("double"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    good = F.col(key).isNotNull() & (F.size(vector) > 0) & ~F.exists(values, bad)
    return vectors.where(good).select(
        F.col(key).cast("long").alias("id"), F.transform(values, lambda x: F.floor(x * scale)).alias("v")
    )


def _products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Products as whole numbers; doubles are exact while every sum stays below 2**53."""
    return (a @ b.T).astype(np.int64) if exact else a.astype(np.int64) @ b.astype(np.int64).T


class CoverTree:
    """Nodes with centre, covering radius and either children or a slice of rows.

    A node's children are centres chosen farthest first until they cover the node with half its
    radius or the fan-out is reached; every row goes to its nearest centre.
    """

    def __init__(self, rows: np.ndarray, leaf: int = _LEAF):
        self.order = np.arange(len(rows))
        self.center: list[np.ndarray] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.span: list[tuple[int, int]] = []
        self._build(rows, leaf)

    def _node(self, rows: np.ndarray, start: int, end: int) -> int:
        part = rows[self.order[start:end]]
        middle = part.mean(axis=0)
        center = part[np.argmin(((part - middle) ** 2).sum(axis=1))]
        # the slack covers the rounding of the square root and of later products
        self.radius.append(float(np.sqrt(((part - center) ** 2).sum(axis=1).max())) * (1 + 1e-9) + 1e-6)
        self.center.append(center)
        self.children.append([])
        self.span.append((start, end))
        return len(self.radius) - 1

    def _build(self, rows: np.ndarray, leaf: int) -> None:
        stack = [self._node(rows, 0, len(rows))] if len(rows) else []
        while stack:
            node = stack.pop()
            start, end = self.span[node]
            if end - start <= leaf or self.radius[node] <= 1e-5:
                continue
            part = rows[self.order[start:end]]
            near = ((part - self.center[node]) ** 2).sum(axis=1)
            owner = np.zeros(len(part), np.int64)
            number = 1
            while number < _FAN and near.max() > (self.radius[node] / 2) ** 2:
                far = ((part - part[np.argmax(near)]) ** 2).sum(axis=1)
                closer = far < near
                owner[closer], near[closer] = number, far[closer]
                number += 1
            if number == 1:
                continue
            by = np.argsort(owner, kind="stable")
            self.order[start:end] = self.order[start:end][by]
            ends = start + np.cumsum(np.bincount(owner, minlength=number))
            for a, b in zip(np.concatenate(([start], ends[:-1])), ends):
                if b > a:
                    child = self._node(rows, int(a), int(b))
                    self.children[node].append(child)
                    stack.append(child)


class Queries:
    """A block of queries with its tree, norms and the bound each query starts from."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, floor: np.ndarray):
        self.tree = CoverTree(rows, 64)
        by = self.tree.order
        self.ids, self.rows, self.floor = ids[by], rows[by], floor[by]


class Best:
    """The k best of each query so far, scores falling, ties by id; empty places have no id."""

    def __init__(self, queries: Queries, k: int):
        n = len(queries.ids)
        self.queries, self.k = queries, k
        self.score = np.full((n, k), _EMPTY)
        self.id = np.full((n, k), _NONE)
        self.floor = queries.floor.copy()

    def worst(self, span: tuple[int, int]) -> float:
        return float(self.floor[span[0] : span[1]].min())

    def offer(self, span: tuple[int, int], ids: np.ndarray, scores: np.ndarray) -> None:
        a, b = span
        open_ = (scores >= self.floor[a:b, None]) & (self.queries.ids[a:b, None] != ids[None, :])
        touched = np.flatnonzero(open_.any(axis=1))
        if len(touched) == 0:
            return
        at = a + touched
        own = np.where(open_[touched], scores[touched], _EMPTY)
        score = np.concatenate([self.score[at], own], axis=1)
        id_ = np.concatenate([self.id[at], np.where(open_[touched], ids, _NONE)], axis=1)
        # -1 - score falls as the score rises and cannot overflow
        top = np.lexsort((id_, -1 - score, id_ == _NONE), axis=1)[:, : self.k]
        self.score[at] = np.take_along_axis(score, top, 1)
        self.id[at] = np.take_along_axis(id_, top, 1)
        # as a double, and below the k-th score where that has no exact double
        full = self.id[at, -1] != _NONE
        kth = np.where(full, np.nextafter(self.score[at, -1].astype(float), -np.inf), -np.inf)
        self.floor[at] = np.maximum(self.floor[at], kth)


def search(queries: Queries, ids: np.ndarray, rows: np.ndarray, best: Best, exact: bool = True) -> int:
    """Dual-tree search of one block of vectors; returns the number of products computed."""
    tree, asked = CoverTree(rows), queries.tree
    if not tree.radius or not asked.radius:
        return 0
    by_ids, by_rows = ids[tree.order], rows[tree.order]
    q_norm = [float(np.linalg.norm(c)) for c in asked.center]
    p_norm = [float(np.linalg.norm(c)) for c in tree.center]

    def bound(q: int, p: int) -> float:
        top = float(asked.center[q] @ tree.center[p])
        rq, rp = asked.radius[q], tree.radius[p]
        reach = q_norm[q] * rp + p_norm[p] * rq + rq * rp
        return top + reach + 1e-9 * (abs(top) + reach) + 1e-3

    heap = [(-bound(0, 0), 0, 0)]
    done = 0
    while heap:
        most, q, p = heapq.heappop(heap)
        # equal scores still count: the smaller id wins
        if -most < best.worst(asked.span[q]):
            continue
        below_q, below_p = asked.children[q], tree.children[p]
        if not below_q and not below_p:
            (a, b), (c, d) = asked.span[q], tree.span[p]
            for at in range(c, d, 2048):
                end = min(d, at + 2048)
                scores = _products(queries.rows[a:b], by_rows[at:end], exact)
                best.offer((a, b), by_ids[at:end], scores)
            done += (b - a) * (d - c)
            continue
        split_q = below_q and (not below_p or asked.radius[q] >= tree.radius[p])
        for child in below_q if split_q else below_p:
            pair = (child, p) if split_q else (q, child)
            top = bound(*pair)
            if top >= best.worst(asked.span[pair[0]]):
                heapq.heappush(heap, (-top, *pair))
    return done


def tree_search(k: int, width: int, exact: bool) -> meeting.Search:
    """The k best of each visitor of a group, by trees over its queries and its vectors."""

    def find(asked: pa.Table, held: pa.Table) -> pa.Table:
        floor = asked["floor"].to_numpy().astype(float)
        # a floor that came as a double may have been rounded up
        floor = np.where(np.isnan(floor), -np.inf, np.nextafter(floor, -np.inf))
        queries = Queries(asked["query_id"].to_numpy(), matrix_of(asked["vector"], width), floor)
        best = Best(queries, k)
        if held.num_rows:
            search(queries, held["pk"].to_numpy(), matrix_of(held["vector"], width), best, exact)
        at = np.nonzero(best.id != _NONE)
        return pa.table(
            {
                "query_id": pa.array(queries.ids[at[0]], pa.int64()),
                "pk": pa.array(best.id[at], pa.int64()),
                "score": pa.array(best.score[at], pa.int64()),
            }
        )

    return find


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 1024,
) -> DataFrame:
    """`query_id`, `rank`, key and `score` of the k best other rows for every row that `is_query` picks."""
    spark = vectors.sparkSession
    every = scaled(vectors, key, vector, scale)
    asked = scaled(vectors.where(is_query), key, vector, scale).groupBy("id").agg(F.min("v").alias("v"))
    size = every.agg(
        F.max(F.size("v")).alias("width"),
        F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))).alias("most"),
    ).first()
    result = f"query_id long, rank int, {key} long, score long"
    if size.width is None:
        return spark.createDataFrame([], result)
    width, bound = size.width, size.width * size.most * size.most
    if bound >= 2.0**63:
        raise OverflowError("scores of these vectors can need more than 64 bits")
    kind = "int" if size.most < 2**31 else "long"
    filled = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v"))).cast(f"array<{kind}>")
    docs = materialise(every.select(F.col("id").alias("pk"), filled.alias("vector")), "topk-vectors")
    queries = materialise(asked.select(F.col("id").alias("query_id"), filled.alias("vector")), "topk-queries")
    find = tree_search(k, width, bound < 2.0**53)
    found = meeting.routed(queries, docs, k, width, "dot", search=find, score=T.LongType())
    return best_of(found, k).select("query_id", "rank", F.col("pk").alias(key), "score")
