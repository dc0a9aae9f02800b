"""Similarity join: for every query vector the k best document vectors.

Pairs are scored in matrix blocks inside tasks and only the best k per query leave a task.

`broadcast`  queries of at most BROADCAST_BYTES, checked, are sent to the documents where they lie:
             one pass, no shuffle of vectors.
`cells`      the same queries, but documents are first put next to each other by nearest pivot, in
             one shuffle, and written. A pass then leaves out, for each block of documents, the
             queries that by the triangle inequality can find nothing better in it than what
             they know. Where the vectors have clusters most blocks meet few queries.
`routed`     any number of queries: they travel as rows to the cells that can hold their results
             (see `meeting`). More queries than may be broadcast always go this way.
`lsh`        queries and documents meet in buckets of random projections. With `fallback` queries
             that are not proven complete are searched again exactly; without it some results
             may be missing.

All but `lsh` without `fallback` are exact and give the same rows.

A query and a document meet once, in whichever strategy. Scores of results come from the two
vectors alone in double precision, are rounded to 6 digits and ties broken by document key, so
results do not depend on how rows are spread or batched. Null vectors, vectors of another
length or with nulls inside, and for cosine those of length 0 take no part. Keys of documents
must be unique; of queries that share an id the smallest vector is searched.

Either side may hold sparse vectors (size, buckets, weights), see `schemas.SPARSE_VECTOR`: they are
stored, shuffled and sent as they are and filled up only in the block that is scored. The results
are those of the same vectors written in full. One with a bucket that is null or not below its
size, or with another number of weights than buckets, takes no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.operators import meeting
from textloom.operators.sampling import smallest_hashes
from textloom.operators.scoring import (
    Best,
    Entries,
    Rows,
    SparseSearch,
    distances,
    margin_of,
    matrix_of,
    rough_scores,
    slab_rows,
    usable_rows,
    worth,
)
from textloom.session import fits, materialise

METRICS = ("cosine", "dot", "l2")
BROADCAST_BYTES = 64 << 20
#: Documents and queries that are scored at once.
BLOCK_ROWS, QUERY_ROWS = 2048, 4096
#: Pivots per square root of the number of documents, and the most there can be (all are broadcast).
CELLS_PER_ROOT, MOST_CELLS = 0.25, 4096
#: Documents that give every query of `cells` its first bound.
FIRST_ROWS = 2048
#: Results that leave a task at once.
RESULT_ROWS = 1 << 16
#: Parts in which the results of a query are merged first.
MERGE_PARTS = 16
STRATEGIES = ("auto", "broadcast", "cells", "routed", "lsh")


def knn_join(
    queries: DataFrame,
    docs: DataFrame,
    k: int,
    dim: int,
    metric: str = "cosine",
    strategy: str = "auto",
    skip_same_key: bool = False,
    cells: int | None = None,
    fallback: bool = True,
) -> DataFrame:
    """(query_id, rank, pk, score): the k best documents of each query.

    `queries` has query_id and vector, `docs` has pk and vector, with vectors
    of length `dim`. With `skip_same_key` a document is not a result of the
    query that has its key. `auto` broadcasts queries that are few enough and
    routes others.
    """
    if metric not in METRICS:
        raise ValueError(f"metric is one of {METRICS}")
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy is one of {STRATEGIES}")
    queries = queries.select("query_id", "vector").where(_is_vector(queries, dim))
    queries = queries.groupBy("query_id").agg(F.min("vector").alias("vector"))
    docs = docs.select("pk", "vector").where(_is_vector(docs, dim))
    depth = k + 1 if skip_same_key else k
    if strategy == "lsh":
        queries = materialise(queries, "queries")
        found, proven = meeting.lsh(queries, docs, depth, dim, metric)
        if fallback:
            done = materialise(proven.where("proven").select("query_id"), "proven")
            open_ = queries.join(done, "query_id", "left_anti")
            exact = _exact(open_, docs, depth, dim, metric, "auto", cells)
            found = found.join(done, "query_id", "left_semi").unionByName(exact)
    else:
        found = _exact(queries, docs, depth, dim, metric, strategy, cells)
    if skip_same_key:
        found = found.where(F.col("query_id") != F.col("pk"))
    return best_of(found, k)


def _is_vector(df: DataFrame, dim: int) -> Column:
    """True for dense and for sparse vectors of length `dim`."""
    if not isinstance(df.schema["vector"].dataType, T.StructType):
        return F.size("vector") == dim
    inside = F.forall("vector.buckets", lambda b: b.isNotNull() & b.between(0, dim - 1))
    return (F.col("vector.size") == dim) & (F.size("vector.buckets") == F.size("vector.weights")) & inside


def _exact(
    queries: DataFrame, docs: DataFrame, k: int, dim: int, metric: str, strategy: str, cells: int | None
) -> DataFrame:
    if strategy == "routed" or not _few(queries, dim):
        return meeting.routed(queries, docs, k, dim, metric, cells)
    if strategy != "cells":
        if metric == "cosine" and all(isinstance(side.schema["vector"].dataType, T.StructType) for side in (queries, docs)):
            return _search_sparse(queries, docs, k, dim)
        return _search(queries, docs, k, dim, metric, None)
    total = docs.count()
    return _search(queries, _in_cells(docs, dim, metric, cells, total), k, dim, metric, _first_rows(docs, dim, metric, total))


def _few(queries: DataFrame, dim: int) -> bool:
    """True when the queries, as they are stored, may be broadcast."""
    if fits(queries, max(BROADCAST_BYTES // (8 * dim), 1)):
        return True
    if not isinstance(queries.schema["vector"].dataType, T.StructType):
        return False
    # 8 bytes an entry, and what a row has besides
    return queries.agg(F.sum(8 * F.size("vector.buckets") + 16)).first()[0] <= BROADCAST_BYTES


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query, ranked.

    Each task drops its surplus before the shuffle, and what the tasks found for a
    query is merged in parts first, so that no task gets the rows of all tasks.
    """
    order = [F.desc("score"), F.col("pk")]
    parts = Window.partitionBy("query_id", "_part").orderBy(*order)
    merged = (
        found.withColumn("_part", F.pmod(F.xxhash64("pk"), F.lit(MERGE_PARTS)))
        .withColumn("_place", F.row_number().over(parts))
        .where(F.col("_place") <= k)
    )
    every = Window.partitionBy("query_id").orderBy(*order)
    ranked = merged.withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "pk", "score")


def above(found: DataFrame, threshold: float) -> DataFrame:
    """Results with a score strictly above the threshold."""
    return found.where(F.col("score") > threshold)


def _result_type(queries: DataFrame, docs: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("pk", docs.schema["pk"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


# -- passes --------------------------------------------------------------------


def _first_rows(docs: DataFrame, dim: int, metric: str, total: int) -> np.ndarray:
    """Vectors of a bounded sample of different documents, in hash order."""
    drawn = smallest_hashes(docs, ["pk"], FIRST_ROWS, total).toArrow()
    return usable_rows(matrix_of(drawn["vector"], dim), metric)[1]


def _search(
    chunk: DataFrame, docs: DataFrame, k: int, dim: int, metric: str, first: np.ndarray | None
) -> DataFrame:
    """The k best of each task for queries that are few enough. With `first`, blocks are pruned.

    A task takes the queries QUERY_ROWS at a time, so that few scores and filled-up vectors are held at once.
    """
    table = chunk.toArrow()
    rows = Rows(table["vector"], dim, metric, QUERY_ROWS)
    ids = table["query_id"].combine_chunks().take(pa.array(rows.keep))
    floors = [None] * len(rows.blocks())
    if first is not None and len(first) > k:
        # k other documents are known to score as much
        for i, at in enumerate(rows.blocks()):
            q = rows.block(at)
            floors[i] = np.empty(len(q))
            for start in range(0, len(q), 1024):
                some = q[start : start + 1024]
                scores = np.sort(rough_scores(some, first, metric), axis=1)
                floors[i][start : start + 1024] = scores[:, -k] - margin_of(some, first, metric)
    shared = docs.sparkSession.sparkContext.broadcast((ids, rows, floors))
    pruned = first is not None

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, floors = shared.value
        blocks = rows.blocks()
        found, key_type = [Best(at.stop - at.start, k, floor) for at, floor in zip(blocks, floors)], None
        for batch in batches:
            key_type = batch.column("pk").type
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                keep, d = usable_rows(matrix_of(part.column("vector"), dim), metric)
                keys = part.column("pk").to_numpy(zero_copy_only=False)[keep]
                if not len(d):
                    continue
                for at, best in zip(blocks, found):
                    q = rows.block(at)
                    best.add(q, keys, d, metric, worth(q, d, best.floor, metric) if pruned else None)
        for at, best in zip(blocks, found):
            if best.key is not None:
                yield best.to_arrow(ids[at], key_type)

    return docs.select("pk", "vector").mapInArrow(search, _result_type(chunk, docs))


def _slabs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows of the batches, `size` at a time."""
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - rows)
            held.append(part)
            rows += part.num_rows
            batch = batch.slice(part.num_rows)
            if rows == size:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _search_sparse(chunk: DataFrame, docs: DataFrame, k: int, dim: int) -> DataFrame:
    """As `_search`, for sparse vectors on both sides by cosine: only entries that a query has are multiplied."""
    shared = docs.sparkSession.sparkContext.broadcast(chunk.toArrow())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, finder, keys, order = shared.value, None, None, None
        for slab in _slabs(batches, slab_rows(dim)):
            finder = finder or SparseSearch(table["vector"], dim, k, QUERY_ROWS)
            entries = Entries(slab["vector"], dim)
            new = slab["pk"].combine_chunks().take(pa.array(entries.keep))
            before = 0 if keys is None else len(keys)
            keys = new if keys is None else pa.concat_arrays([keys, new])
            # documents are told apart by their place among the sorted keys seen so far
            now = pc.sort_indices(keys, null_placement="at_start").to_numpy()
            place = np.empty(len(now), np.int64)
            place[now] = np.arange(len(now))
            if order is not None:
                finder.renumber(place[order])
            order = now
            finder.add(entries, place[before:])
        if finder is None:
            return
        query, key, score = finder.found()
        ids = table["query_id"].combine_chunks()
        for at in range(0, len(query), RESULT_ROWS):
            some = slice(at, at + RESULT_ROWS)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(query[some])), keys.take(pa.array(order[key[some]])), pa.array(score[some])],
                ["query_id", "pk", "score"],
            )

    return docs.select("pk", "vector").mapInArrow(search, _result_type(chunk, docs))


def _in_cells(docs: DataFrame, dim: int, metric: str, cells: int | None, total: int) -> DataFrame:
    """Documents written next to those with the same nearest pivot; a crowded cell lies in several tasks.

    The cells only say what lies together; they decide nothing about results. Their number grows
    with the square root of the table.
    """
    spark = docs.sparkSession
    number = cells or min(MOST_CELLS, max(16, int(CELLS_PER_ROOT * math.sqrt(total))))
    drawn = smallest_hashes(docs, ["pk"], number, total).toArrow()
    pivots = spark.sparkContext.broadcast(usable_rows(matrix_of(drawn["vector"], dim), metric)[1])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, rows = usable_rows(matrix_of(batch.column("vector"), dim), metric)
            cell = distances(rows, pivots.value).argmin(axis=1) if len(rows) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int32()), *[column.take(pa.array(keep)) for column in batch.columns]],
                ["cell", *batch.schema.names],
            )

    schema = T.StructType([T.StructField("cell", T.IntegerType()), *docs.schema.fields])
    # ranges over (cell, hash) have equal sizes, so a cell with most of the documents is split
    placed = docs.mapInArrow(assign, schema).withColumn("_order", F.xxhash64("pk"))
    return materialise(placed.repartitionByRange("cell", "_order").sortWithinPartitions("cell", "_order"), "cells")
