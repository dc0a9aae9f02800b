"""Searches in which queries travel as rows: nothing on the query side passes through the driver.

Documents lie in numbered cells, written once. A query visits cells, as rows (cell, query). A cell
and its visitors meet by key, both cut into pieces of bounded size: a cell of many documents has
several parts, many visitors come in several chunks, and each part meets each chunk in a group of
its own. A group returns the k best of each query. The plan has the same size for any number of
queries.

`routed`  exact. Cells are those of the nearest pivot. A query visits its most promising cell, then
          a few more, then all whose bound by the triangle inequality reaches its k-th best score;
          the score travels from round to round in a table. With `matrix_search` neighbouring cells
          are packed into blocks of up to GROUP_BYTES of vectors, and a query travels to a block once,
          however many of its cells it wants: even where no bound holds, a query is moved once per
          block, and a document once per GROUP_BYTES of visitors.
`lsh`     cells are the sign patterns of random projections, in several tables, and a query also
          visits the patterns its nearest hyperplanes lead to. What no visited cell held lies
          beyond a hyperplane, which bounds its score: queries whose k-th best score is above
          that bound are proven complete, the others can be handed to the exact search.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.operators.sampling import smallest_hashes
from textloom.operators.scoring import Best, Entries, Rows, SparseSearch, ceilings, distances, matrix_of, slab_rows, usable_rows, worth
from textloom.session import materialise

#: Documents of a cell's part and queries of a chunk that meet in one group.
PART_ROWS, CHUNK_ROWS = 8192, 4096
#: Bytes of vectors, as they are stored or 8 an entry, on each side of a group of `matrix_search`;
#: blocks that the documents are cut into at least, if they are more than PART_ROWS each.
GROUP_BYTES, LEAST_BLOCKS = 32 << 20, 8
#: Queries and documents that `matrix_search` scores at once.
QUERY_ROWS, BLOCK_ROWS = 4096, 2048
#: Pairs of small buckets that are merged at once.
WAITING = 1 << 19
#: Pivots per square root of the number of documents, and the most there can be (all are broadcast).
CELLS_PER_ROOT, MOST_CELLS = 0.25, 4096
#: Cells that a query visits in the first and, at most, in the second round.
NEAR = (1, 8)
#: Documents that a bucket of `lsh` should hold on average; tables, and hyperplanes crossed in each.
BUCKET, TABLES, CROSSED = 64, 8, 4
_BATCH = 1024


def _fields(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(*f) for f in fields])


def _each(batches: Iterator[pa.RecordBatch], dim: int, metric: str):
    """Batches of at most _BATCH usable rows, with their vectors as a matrix."""
    for batch in batches:
        for at in range(0, batch.num_rows, _BATCH):
            part = batch.slice(at, _BATCH)
            keep, rows = usable_rows(matrix_of(part.column("vector"), dim), metric)
            if len(keep):
                yield part.take(pa.array(keep)), rows


#: The visitors (query_id, vector, floor) and documents (pk, vector) of a group -> (query_id, pk, score).
Search = Callable[[pa.Table, pa.Table], pa.Table]


def matrix_search(k: int, dim: int, metric: str) -> Search:
    """Scores in matrix blocks; the k best of each visitor.

    Documents with a `home`, the number of their cell, are taken by it, so that a block of them lies
    close together and is left out for visitors whose bound says so. Visitors with `cells` meet only
    the documents of these homes.
    """

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        if "cells" in asked.column_names:
            held = _without_copies(held)
        elif "home" in held.column_names:
            held = held.sort_by("home")
        if metric == "cosine" and "cells" not in asked.column_names and all(pa.types.is_struct(t["vector"].type) for t in (asked, held)):
            return _sparse_search(asked, held, k, dim)
        q = Rows(asked["vector"], dim, metric, QUERY_ROWS)
        d = Rows(held["vector"], dim, metric, BLOCK_ROWS)
        ids = asked["query_id"].combine_chunks().take(pa.array(q.keep))
        pks = held["pk"].combine_chunks().take(pa.array(d.keep))
        floors = asked["floor"].to_numpy()[q.keep].astype(float)
        floors = np.where(np.isnan(floors), -np.inf, floors)
        # documents are told apart by their place among the sorted keys
        order = pc.sort_indices(pks).to_numpy()
        ordered, place = pks.take(pa.array(order)), np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        home = held["home"].to_numpy()[d.keep] if "home" in held.column_names else None
        wanted = matrix_of(asked["cells"], len(asked["cells"][0])).astype(np.int64)[q.keep] if "cells" in asked.column_names and asked.num_rows else None
        found = []
        for some in q.blocks():
            left, best = q.block(some), Best(some.stop - some.start, k, floors[some])
            if wanted is None:
                for part in d.blocks():
                    right = d.block(part)
                    best.add(left, place[part], right, metric, worth(left, right, best.floor, metric))
            else:
                _add_wanted(best, left, wanted[some], d, home, place, metric)
            keys = np.empty(0, np.int64) if best.key is None else best.key
            found.append(
                pa.RecordBatch.from_arrays(
                    [ids[some].take(pa.array(best.query)), ordered.take(pa.array(keys)), pa.array(best.score)], ["query_id", "pk", "score"]
                )
            )
        schema = pa.schema([("query_id", ids.type), ("pk", pks.type), ("score", pa.float64())])
        return pa.Table.from_batches(found, schema)

    return search


def _sparse_search(asked: pa.Table, held: pa.Table, k: int, dim: int) -> pa.Table:
    """What `matrix_search` finds, for sparse vectors on both sides by cosine."""
    pks, ids = held["pk"].combine_chunks(), asked["query_id"].combine_chunks()
    order = pc.sort_indices(pks).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    floors = asked["floor"].to_numpy().astype(float)
    finder = SparseSearch(asked["vector"], dim, k, QUERY_ROWS, np.where(np.isnan(floors), -np.inf, floors))
    step = slab_rows(dim)
    for at in range(0, held.num_rows, step):
        docs = Entries(held["vector"].slice(at, step), dim)
        finder.add(docs, place[at + docs.keep], near=True)
    query, key, score = finder.found()
    return pa.table({"query_id": ids.take(pa.array(query)), "pk": pks.take(pa.array(order[key])), "score": pa.array(score)})


def _without_copies(held: pa.Table) -> pa.Table:
    """Documents by home, one of those with the same key there: the results of buckets count a key once."""
    held = held.sort_by([("home", "ascending"), ("pk", "ascending")]).combine_chunks()
    if held.num_rows < 2:
        return held
    equal = [pc.equal(c.slice(1), c.slice(0, len(c) - 1)) for c in (held["home"].combine_chunks(), held["pk"].combine_chunks())]
    new = pc.invert(pc.fill_null(pc.and_(*equal), False))
    return held.filter(pa.concat_arrays([pa.array([True]), new]))


def _add_wanted(best: Best, q: np.ndarray, wanted: np.ndarray, d: Rows, home: np.ndarray, place: np.ndarray, metric: str) -> None:
    """Scores of visitors and the documents, sorted by home, in the homes that each wants."""
    order = np.argsort(wanted, axis=None, kind="stable")
    cells, visitor = wanted.ravel()[order], order // wanted.shape[1]
    for part in d.blocks():
        right, there = d.block(part), home[part]
        starts = np.flatnonzero(np.diff(there, prepend=there[0] - 1))
        first, last = np.searchsorted(cells, there[starts], "left"), np.searchsorted(cells, there[starts], "right")
        for i in np.flatnonzero(first < last):
            rows = slice(starts[i], starts[i + 1] if i + 1 < len(starts) else len(there))
            best.add(q, place[part][rows], right[rows], metric, visitor[first[i] : last[i]], WAITING)
    best.flush()


def meet(
    visits: DataFrame,
    docs: DataFrame,
    search: Search,
    score: T.DataType = T.DoubleType(),
    part_rows: int | None = None,
    chunk_rows: int | None = None,
) -> DataFrame:
    """(query_id, pk, score): what `search` finds for each query in each part of each cell that it visits.

    `visits` has cell, query_id, vector and floor (null, or a score that as many documents as are
    wanted are known to reach); `docs` has cell, pk and vector, and what else `search` reads. Both are
    read twice and should be written tables.
    """
    part_rows, chunk_rows = part_rows or PART_ROWS, chunk_rows or CHUNK_ROWS
    parts = docs.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("parts"))
    chunks = visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / chunk_rows).cast("int").alias("chunks"))
    # one row per cell in use: written, so that their small size is known where they are joined
    sizes = materialise(parts.join(chunks, "cell"), "cell-sizes")
    own_part = F.pmod(F.xxhash64("pk"), F.col("parts")).cast("int").alias("part")
    own_chunk = F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int").alias("chunk")
    left = visits.join(sizes, "cell").select(
        "cell", own_chunk, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), *[c for c in visits.columns if c != "cell"]
    )
    right = docs.join(sizes, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), own_part, *[c for c in docs.columns if c != "cell"]
    )
    ids, keys = visits.schema["query_id"].dataType, docs.schema["pk"].dataType
    result = _fields(("query_id", ids), ("pk", keys), ("score", score))
    group = ["cell", "part", "chunk"]
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(search, result)


def _best(found: DataFrame, k: int) -> DataFrame:
    from textloom.operators.retrieve import best_of

    return best_of(found, k)


# -- exact ---------------------------------------------------------------------


class Cells:
    """Pivots with the radius of their cells and the greatest squared length in them."""

    def __init__(self, pivots: np.ndarray, radius: np.ndarray, longest2: np.ndarray):
        self.pivots, self.radius, self.longest2 = pivots, radius, longest2
        #: Documents of each cell.
        self.counts = np.zeros(len(pivots), np.int64)

    def reach(self, q: np.ndarray, metric: str) -> np.ndarray:
        """The most that each query can score in each cell; minus infinity for an empty one."""
        away = distances(q, self.pivots)
        gap = np.maximum(away - self.radius - 1e-6 * (1 + away + self.radius), 0)
        most = ceilings((q * q).sum(axis=1)[:, None], gap, self.longest2, metric)
        return np.where(self.radius < 0, -np.inf, most)


class Blocks:
    """Which block each cell lies in: one of its own, or with `rows` as many neighbours as have so many documents."""

    def __init__(self, pivots: np.ndarray, counts: np.ndarray, rows: int = 0):
        self.of = np.arange(len(pivots))
        self.order = self.of
        if rows and len(pivots):
            # neighbours: cells in the order of their pivots along the direction in which these differ most
            along = np.linalg.svd(pivots - pivots.mean(axis=0), full_matrices=False)[2][0]
            self.order = np.argsort(pivots @ along, kind="stable")
            total, number = 0, 0
            for cell in self.order:
                if total and total + counts[cell] > rows:
                    total, number = 0, number + 1
                total += counts[cell]
                self.of[cell] = number
            self.order = np.argsort(self.of, kind="stable")
        self.starts = np.flatnonzero(np.diff(self.of[self.order], prepend=-1))

    def holding(self, cells: np.ndarray) -> np.ndarray:
        """(row, cell) flags as (row, block) flags."""
        return np.logical_or.reduceat(cells[:, self.order], self.starts, axis=1)


def in_cells(docs: DataFrame, dim: int, metric: str, cells: int | None = None) -> tuple[DataFrame, Cells]:
    """Documents written with the number of their nearest pivot, and what bounds their scores."""
    total = docs.count()
    number = cells or min(MOST_CELLS, max(16, int(CELLS_PER_ROOT * math.sqrt(total))))
    drawn = smallest_hashes(docs.select("pk", "vector"), ["pk"], number, total).toArrow()
    pivots = usable_rows(matrix_of(drawn["vector"], dim), metric)[1]
    shared = docs.sparkSession.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _each(batches, dim, metric):
            far = distances(rows, shared.value)
            cell = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cell, pa.int64()), part.column("pk"), part.column("vector"),
                    pa.array(far[np.arange(len(cell)), cell]), pa.array((rows * rows).sum(axis=1)),
                ],
                ["cell", "pk", "vector", "away", "length2"],
            )

    kinds = docs.schema["pk"].dataType, docs.schema["vector"].dataType
    schema = _fields(
        ("cell", T.LongType()), ("pk", kinds[0]), ("vector", kinds[1]), ("away", T.DoubleType()), ("length2", T.DoubleType())
    )
    if not len(pivots):
        docs = docs.limit(0)
    placed = materialise(docs.select("pk", "vector").mapInArrow(assign, schema), "cells")
    # at most MOST_CELLS rows
    found = placed.groupBy("cell").agg(F.max("away").alias("away"), F.max("length2").alias("length2"), F.count(F.lit(1)).alias("n")).collect()
    radius, longest2 = np.full(len(pivots), -1.0), np.zeros(len(pivots))
    for row in found:
        radius[row.cell], longest2[row.cell] = row.away, row.length2
    known = Cells(pivots, radius, longest2)
    for row in found:
        known.counts[row.cell] = row.n
    return placed.select("cell", "pk", "vector"), known


def _group_rows(vectors: DataFrame, dim: int) -> int:
    """Rows whose vectors take GROUP_BYTES."""
    size = 8 * dim
    if isinstance(vectors.schema["vector"].dataType, T.StructType):
        mean = vectors.agg(F.avg(F.size("vector.buckets"))).first()[0]
        size = 16 + 8 * (mean or 0)
    return max(1, int(GROUP_BYTES / size))


def routed(
    queries: DataFrame,
    docs: DataFrame,
    k: int,
    dim: int,
    metric: str = "cosine",
    cells: int | None = None,
    search: Search | None = None,
    score: T.DataType = T.DoubleType(),
) -> DataFrame:
    """(query_id, pk, score) with the k best documents of each query. Exact.

    `search` finds the results of a group in another way than by `matrix_search`; scores must be
    those of the metric or a little above.
    """
    spark = queries.sparkSession
    placed, known = in_cells(docs, dim, metric, cells)
    part_rows, chunk_rows, rounds = None, None, (0, NEAR[0], sum(NEAR))
    blocks = Blocks(known.pivots, known.counts)
    if search is None:
        search, rounds = matrix_search(k, dim, metric), (0, NEAR[0])
        part_rows = max(PART_ROWS, min(_group_rows(placed, dim), int(known.counts.sum()) // LEAST_BLOCKS))
        chunk_rows = max(CHUNK_ROWS, _group_rows(queries, dim))
        blocks = Blocks(known.pivots, known.counts, part_rows)
        if len(known.pivots):
            # at most MOST_CELLS rows
            block = spark.createDataFrame(list(enumerate(blocks.of.tolist())), "home long, cell long")
            placed = placed.withColumnRenamed("cell", "home").join(F.broadcast(block), "home").select("cell", "home", "pk", "vector")
    shared = spark.sparkContext.broadcast((known, blocks))
    ids, vector = queries.schema["query_id"].dataType, queries.schema["vector"].dataType
    ask = _fields(("query_id", ids), ("vector", vector), ("near", T.ArrayType(T.IntegerType())))
    visit = _fields(("cell", T.LongType()), ("query_id", ids), ("vector", vector), ("floor", T.DoubleType()))
    most = rounds[-1]

    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, q in _each(batches, dim, metric):
            near = np.argsort(-shared.value[0].reach(q, metric), axis=1, kind="stable")[:, :most].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("query_id"), part.column("vector"), pa.array(near.tolist(), pa.list_(pa.int32()))], ask.names
            )

    # which cells are near is stored, so that later rounds leave out exactly those that were visited
    asked = materialise(queries.mapInArrow(promising, ask), "queries-near") if len(known.pivots) else None
    if asked is None:
        return queries.sparkSession.createDataFrame([], _fields(("query_id", ids), ("pk", docs.schema["pk"].dataType), ("score", score)))

    def to_near(first: int, last: int) -> Callable[[np.ndarray, np.ndarray, np.ndarray, Blocks], np.ndarray]:
        def chosen(reach: np.ndarray, floor: np.ndarray, near: np.ndarray, blocks: Blocks) -> np.ndarray:
            out = np.zeros(reach.shape, bool)
            mine = near[:, first:last]
            np.put_along_axis(out, mine, np.take_along_axis(reach >= floor[:, None], mine, 1), 1)
            return blocks.holding(out)

        return chosen

    def to_rest(reach: np.ndarray, floor: np.ndarray, near: np.ndarray, blocks: Blocks) -> np.ndarray:
        out = blocks.holding(reach >= floor[:, None])
        np.put_along_axis(out, blocks.of[near], False, 1)
        return out

    def visits(state: DataFrame, choose) -> DataFrame:
        def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, blocks = shared.value
            for part, q in _each(batches, dim, metric):
                floor = part.column("floor").to_numpy(zero_copy_only=False).astype(float)
                near = matrix_of(part.column("near"), min(most, len(known.pivots))).astype(np.int64)
                low = np.where(np.isnan(floor), -np.inf, floor)
                reach = np.where(known.radius >= 0, known.reach(q, metric), np.nan)  # nan: no document there
                row, cell = np.nonzero(choose(reach, low, near, blocks))
                for at in range(0, len(row), _BATCH):
                    some = part.take(pa.array(row[at : at + _BATCH]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell[at : at + _BATCH], pa.int64()), *[some.column(c) for c in visit.names[1:]]], visit.names
                    )

        return materialise(state.mapInArrow(go, visit), "visits")

    best, state = None, asked.withColumn("floor", F.lit(None).cast("double"))
    for choose in (*[to_near(*ends) for ends in itertools.pairwise(rounds)], to_rest):
        found = meet(visits(state, choose), placed, search, score, part_rows, chunk_rows)
        best = found if best is None else best.unionByName(found)
        best = materialise(_best(best, k), "best")
        floors = best.where(F.col("rank") == k).select(F.col("query_id").alias("_id"), F.col("score").cast("double").alias("floor"))
        state = asked.join(floors, F.col("query_id").eqNullSafe(F.col("_id")), "left").drop("_id")
        best = best.select("query_id", "pk", "score")
    return best


# -- random projections --------------------------------------------------------


class Planes:
    """Tables of hyperplanes through the origin, orthogonal to each other within a table."""

    def __init__(self, dim: int, bits: int, tables: int, seed: int = 17):
        draw = np.random.default_rng(seed)
        self.bits = min(bits, dim)
        self.normals = [np.linalg.qr(draw.standard_normal((dim, dim)))[0][:, : self.bits] for _ in range(tables)]

    def buckets(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per table the bucket of each row, and its distances from the hyperplanes with their sign."""
        weights = 1 << np.arange(self.bits, dtype=np.int64)
        for number, normals in enumerate(self.normals):
            side = rows @ normals
            yield (np.int64(number) << 32) + ((side > 0) @ weights), side


def lsh(
    queries: DataFrame,
    docs: DataFrame,
    k: int,
    dim: int,
    metric: str = "cosine",
    tables: int = TABLES,
    crossed: int = CROSSED,
    bucket: int = BUCKET,
) -> tuple[DataFrame, DataFrame]:
    """((query_id, pk, score) of the best found, (query_id, proven)).

    A query visits its bucket and those beyond every subset of its `crossed` nearest hyperplanes,
    in each table. A document in none of them lies beyond another hyperplane in every table, so at
    least as far as the nearest of those in the table where that is most. `proven` is true where
    the k-th score found is above what such a document can score.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError("lsh bounds distances: metric is 'cosine' or 'l2'")
    total = docs.count()
    bits = max(1, math.ceil(math.log2(max(2, total / bucket))))
    planes = queries.sparkSession.sparkContext.broadcast(Planes(dim, min(bits, 31), tables))
    free = min(crossed, planes.value.bits)
    # a bucket lies in the block of its first signs; a query travels to a block once, with all buckets it wants
    part_rows = max(PART_ROWS, _group_rows(docs, dim))
    low = max(0, planes.value.bits - max(0, math.ceil(math.log2(max(1, total / part_rows)))))
    in_block = np.int64(-1) << np.int64(low)
    subsets = [c for n in range(free + 1) for c in itertools.combinations(range(free), n)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _each(batches, dim, metric):
            for cell, _ in planes.value.buckets(rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell & in_block), part.column("pk"), part.column("vector"), pa.array(cell)], held.names
                )

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _each(batches, dim, metric):
            unseen = np.zeros(len(rows))
            cells = []
            for cell, side in planes.value.buckets(rows):
                order = np.argsort(np.abs(side), axis=1, kind="stable")
                flip = np.where(np.take_along_axis(side, order, 1) > 0, -1, 1) * (np.int64(1) << order.astype(np.int64))
                cells.append(np.stack([cell + sum((flip[:, i] for i in c), np.zeros(len(rows), np.int64)) for c in subsets], axis=1))
                near = np.abs(np.take_along_axis(side, order, 1))
                beyond = near[:, free] if side.shape[1] > free else np.full(len(rows), np.inf)
                unseen = np.maximum(unseen, beyond)
            ceiling = np.where(np.isinf(unseen), -np.inf, ceilings(np.zeros(len(rows)), np.minimum(unseen, 1e9), 0.0, metric))
            for wanted in cells:
                block = np.sort(wanted & in_block, axis=1)
                row, column = np.nonzero(np.diff(block, axis=1, prepend=block[:, :1] - 1))
                for at in range(0, len(row), _BATCH):
                    mine = row[at : at + _BATCH]
                    some = part.take(pa.array(mine))
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.arange(len(mine) + 1, dtype=np.int32) * wanted.shape[1]), pa.array(wanted[mine].ravel())
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(block[mine, column[at : at + _BATCH]]), some.column("query_id"), some.column("vector"),
                            pa.nulls(len(mine), pa.float64()), lists, pa.array(ceiling[mine]),
                        ],
                        visit.names,
                    )

    ids, keys = queries.schema["query_id"].dataType, docs.schema["pk"].dataType
    held = _fields(("cell", T.LongType()), ("pk", keys), ("vector", docs.schema["vector"].dataType), ("home", T.LongType()))
    visit = _fields(
        ("cell", T.LongType()), ("query_id", ids), ("vector", queries.schema["vector"].dataType),
        ("floor", T.DoubleType()), ("cells", T.ArrayType(T.LongType())), ("ceiling", T.DoubleType()),
    )
    visits = materialise(queries.mapInArrow(go, visit), "lsh-visits")
    placed = materialise(docs.select("pk", "vector").mapInArrow(place, held), "lsh-buckets")
    found = meet(visits.drop("ceiling"), placed, matrix_search(k, dim, metric), part_rows=part_rows, chunk_rows=max(CHUNK_ROWS, part_rows))
    # a document may be met in several tables: at most k rows a group, so the rows of a pair are few
    best = materialise(_best(found.dropDuplicates(["query_id", "pk"]), k), "lsh-best")
    last = best.where(F.col("rank") == k).select(F.col("query_id").alias("_id"), "score")
    limits = visits.groupBy("query_id").agg(F.max("ceiling").alias("ceiling"))
    proven = F.coalesce(F.col("ceiling") == float("-inf"), F.lit(False)) | F.coalesce(F.col("score") > F.col("ceiling"), F.lit(False))
    marked = limits.join(last, F.col("query_id").eqNullSafe(F.col("_id")), "left").select("query_id", proven.alias("proven"))
    return best.select("query_id", "pk", "score"), marked
