"""Scoring of vectors inside tasks: matrices, rough and exact scores, bounds and the k best."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SCORES = 4 << 20  # scores held at once in a task
#: Sparse queries that are scored together, and documents that they meet at once; bytes of either filled up, if wide.
GROUP_ROWS, SLAB_ROWS, WIDE_BYTES = 256, 8192, 32 << 20
#: A bucket that more than this share of a group's queries use is multiplied for all of them.
COMMON_SHARE = 1 / 16
#: Rarer entries of a query that are taken at once.
RARE_ROWS = 64
#: Parts of a slab of which the best score is looked at first.
STRIDES = 128
#: Pairs that are merged at once, and entries of pairs that are multiplied at once.
WAITING, _ENTRIES = 1 << 19, 1 << 20


def matrix_of(vectors: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows of a matrix; sparse ones are filled up, weights of the same bucket added."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if pa.types.is_struct(vectors.type):
        _, buckets, weights = vectors.flatten()
        row = np.repeat(np.arange(len(vectors)), buckets.value_lengths().to_numpy(zero_copy_only=False))
        cell = row * dim + buckets.flatten().to_numpy(zero_copy_only=False)
        weight = weights.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return np.bincount(cell, weight, len(vectors) * dim).reshape(-1, dim)
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable_rows(matrix: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions of usable rows, and the rows (of length 1 for cosine)."""
    lengths = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    keep = np.flatnonzero(np.isfinite(lengths) & ((lengths > 0) | (metric != "cosine")))
    rows = matrix[keep]
    return keep, rows / lengths[keep, None] if metric == "cosine" else rows


class Rows:
    """Usable vectors of an Arrow array, given out as blocks of a matrix of at most `step` rows.

    Dense ones are converted once; sparse ones stay as they are and are filled up block by block.
    """

    def __init__(self, vectors: pa.Array | pa.ChunkedArray, dim: int, metric: str, step: int):
        if isinstance(vectors, pa.ChunkedArray):
            vectors = vectors.combine_chunks()
        self.dim, self.metric, self.step = dim, metric, step
        self.matrix = self.vectors = None
        if pa.types.is_struct(vectors.type):
            kept = [
                at + usable_rows(matrix_of(vectors.slice(at, step), dim), metric)[0] for at in range(0, len(vectors), step)
            ]
            #: Places of the usable rows.
            self.keep = np.concatenate(kept) if kept else np.empty(0, np.int64)
            self.vectors = vectors.take(pa.array(self.keep))
        else:
            self.keep, self.matrix = usable_rows(matrix_of(vectors, dim), metric)

    def __len__(self) -> int:
        return len(self.keep)

    def blocks(self) -> list[slice]:
        return [slice(at, min(at + self.step, len(self))) for at in range(0, len(self), self.step)]

    def block(self, rows: slice) -> np.ndarray:
        if self.matrix is not None:
            return self.matrix[rows]
        return usable_rows(matrix_of(self.vectors.slice(rows.start, rows.stop - rows.start), self.dim), self.metric)[1]


def rough_scores(q: np.ndarray, d: np.ndarray, metric: str) -> np.ndarray:
    """Scores of all pairs, up to rounding errors."""
    product = q @ d.T
    if metric == "l2":
        square = (q * q).sum(1)[:, None] + (d * d).sum(1)[None, :] - 2 * product
        product = 1 / (1 + np.maximum(square, 0))
    return product


def margin_of(q: np.ndarray, d: np.ndarray, metric: str) -> float:
    """More than `_scores` can be off, in single precision for cosine, and half of the last digit kept."""
    if metric == "cosine":
        return q.shape[1] * 2.0**-23 + 1e-6
    size = np.linalg.norm(q, axis=1).max(initial=0) + np.linalg.norm(d, axis=1).max(initial=0)
    return float(q.shape[1] * 2.0**-50 * (1 + size * size)) + 1e-6


def pair_scores(q: np.ndarray, d: np.ndarray, row: np.ndarray, col: np.ndarray, metric: str) -> np.ndarray:
    """Scores of single pairs, the same whatever other pairs are asked for."""
    scores = np.empty(len(row))
    step = max(1, (8 << 20) // q.shape[1])
    for start in range(0, len(row), step):
        part = slice(start, start + step)
        left, right = q[row[part]], d[col[part]]
        if metric == "l2":
            left = right = left - right
        scores[part] = np.einsum("ij,ij->i", left, right)
    if metric == "l2":
        scores = 1 / (1 + scores)
    # + 0.0 turns a rounded -0.0 into 0.0
    return np.round(scores, 6) + 0.0


class Best:
    """The k best (score, key) pairs of each query seen so far in a task."""

    def __init__(self, queries: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.floor = np.full(queries, -np.inf) if floor is None else floor.copy()
        self.query = np.empty(0, np.int64)
        self.score = np.empty(0)
        self.key: np.ndarray | None = None
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waits = 0

    def add(
        self, q: np.ndarray, keys: np.ndarray, d: np.ndarray, metric: str, which: np.ndarray | None = None, later: int = 0
    ) -> None:
        """Score documents against the queries `which` (all, if None) of `q`.

        With `later`, for many small blocks, pairs wait until there are so many or `flush` is called.
        """
        if which is None:
            which, left = np.arange(len(q)), q
        else:
            left = q[which]
        if not len(which) or not len(d):
            return
        fast = metric == "cosine"
        left = left.astype(np.float32) if fast else left
        margin = margin_of(left, d, metric)
        step = max(64, _SCORES // len(which))
        for start in range(0, len(d), step):
            block, names = d[start : start + step], keys[start : start + step]
            rough = left @ block.astype(np.float32).T if fast else rough_scores(left, block, metric)
            row, col = self._candidates(rough, margin, which)
            if len(row):
                self.offer(row, pair_scores(q, block, row, col, metric), names[col], later)

    def offer(self, row: np.ndarray, score: np.ndarray, key: np.ndarray, later: int = 0) -> None:
        """Take scored pairs; they are merged once more than `later` wait, or by `flush`."""
        self.waiting.append((row, score, key))
        self.waits += len(row)
        if self.waits >= later:
            self.flush()

    def flush(self) -> None:
        if self.waiting:
            self._merge(*(np.concatenate(part) for part in zip(*self.waiting)))
            self.waiting, self.waits = [], 0

    def _candidates(self, rough: np.ndarray, margin: float, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that may be among the k best: at least the floor and the block's own k-th."""
        active = np.flatnonzero(rough.max(axis=1) >= self.floor[which] - margin)
        rough = rough[active]
        limit = self.floor[which[active]] - margin
        if rough.shape[1] > self.k and len(active):
            crowded = np.flatnonzero((rough >= limit[:, None]).sum(axis=1) > 2 * self.k)
            place = rough.shape[1] - self.k
            own = np.partition(rough[crowded], place, axis=1)[:, place] - 2 * margin
            limit[crowded] = np.maximum(limit[crowded], own)
        row, col = np.nonzero(rough >= limit[:, None])
        return which[active[row]], col

    def _merge(self, row: np.ndarray, score: np.ndarray, name: np.ndarray) -> None:
        good = score >= self.floor[row]
        row, score, name = row[good], score[good], name[good]
        if self.key is None:
            self.key = name[:0]
        # only the rows of queries that found something are sorted again
        touched = np.zeros(len(self.floor), bool)
        touched[row] = True
        again = touched[self.query]
        query = np.concatenate([self.query[again], row])
        score = np.concatenate([self.score[again], score])
        key = np.concatenate([self.key[again], name])
        order = np.lexsort((np.unique(key, return_inverse=True)[1], -score, query))
        query, score, key = query[order], score[order], key[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = place < self.k
        self.query = np.concatenate([self.query[~again], query[kept]])
        self.score = np.concatenate([self.score[~again], score[kept]])
        self.key = np.concatenate([self.key[~again], key[kept]])
        last = np.flatnonzero(place == self.k - 1)
        self.floor[query[last]] = np.maximum(self.floor[query[last]], score[last])

    def to_arrow(self, ids: pa.Array, key_type: pa.DataType) -> pa.RecordBatch:
        keys = pa.array([] if self.key is None else self.key.tolist(), key_type)
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(self.query)), keys, pa.array(self.score)],
            ["query_id", "pk", "score"],
        )


def ceilings(lengths2: np.ndarray, gap: np.ndarray, longest2: np.ndarray | float, metric: str) -> np.ndarray:
    """Most that a vector of squared length `lengths2` scores with one at least `gap` away and at most so long.

    A little above the bound, for rounding.
    """
    if metric == "cosine":
        most = 1 - gap**2 / 2
    elif metric == "l2":
        most = 1 / (1 + gap**2)
    else:
        most = (lengths2 + longest2 - gap**2) / 2
    return most + 1e-5 + 1e-9 * np.abs(most)


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (rows * rows).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :]
    return np.sqrt(np.maximum(square - 2 * rows @ pivots.T, 0))


def worth(q: np.ndarray, d: np.ndarray, floor: np.ndarray, metric: str) -> np.ndarray:
    """Queries that may find something in the block, by its centre and radius."""
    centre = d.mean(axis=0, keepdims=True)
    radius = float(distances(d, centre).max())
    gap = np.maximum(distances(q, centre)[:, 0] - radius - 1e-6 * (1 + radius), 0)
    longest2 = float((d * d).sum(axis=1).max())
    return np.flatnonzero(ceilings((q * q).sum(axis=1), gap, longest2, metric) >= floor)


# -- sparse vectors, cosine ------------------------------------------------------


def slab_rows(dim: int) -> int:
    """Sparse documents that `SparseSearch` takes at once."""
    return max(STRIDES, min(SLAB_ROWS, WIDE_BYTES // (4 * dim)))


class Entries:
    """Usable sparse vectors of an Arrow array, of length 1: (row, bucket, weight) of their entries, in this order."""

    def __init__(self, vectors: pa.Array | pa.ChunkedArray, dim: int):
        if isinstance(vectors, pa.ChunkedArray):
            vectors = vectors.combine_chunks()
        _, buckets, weights = vectors.flatten()
        row = np.repeat(np.arange(len(vectors)), buckets.value_lengths().to_numpy(zero_copy_only=False))
        cell = row * dim + buckets.flatten().to_numpy(zero_copy_only=False)
        weight = weights.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        if (np.diff(cell) <= 0).any():
            # out of order, or weights of the same bucket, which are added
            cell, at = np.unique(cell, return_inverse=True)
            weight = np.bincount(at, weight, len(cell))
            row = cell // dim
        lengths = np.sqrt(np.bincount(row, weight * weight, len(vectors)))
        usable = np.isfinite(lengths) & (lengths > 0)
        self.dim = dim
        #: Places of the usable vectors.
        self.keep = np.flatnonzero(usable)
        good = usable[row]
        self._set((np.cumsum(usable) - 1)[row[good]], (cell - row * dim)[good], weight[good] / lengths[row[good]])

    def _set(self, row: np.ndarray, bucket: np.ndarray, weight: np.ndarray) -> None:
        self.row, self.bucket, self.weight = row, bucket, weight
        self.counts = np.bincount(row, minlength=len(self.keep))
        self.starts = np.concatenate(([0], np.cumsum(self.counts)))

    def __len__(self) -> int:
        return len(self.keep)

    def order_by_count(self) -> None:
        """Put vectors with similar numbers of entries next to each other."""
        order = np.argsort(self.counts, kind="stable")
        at = self.at(order)
        row = np.repeat(np.arange(len(order)), self.counts[order])
        self.keep = self.keep[order]
        self._set(row, self.bucket[at], self.weight[at])

    def at(self, rows: np.ndarray) -> np.ndarray:
        """Places of the entries of some rows, one row after the other."""
        counts = self.counts[rows]
        before = np.cumsum(counts) - counts
        return np.repeat(self.starts[rows] - before, counts) + np.arange(counts.sum())

    def columns(self, width: int) -> np.ndarray:
        """The vectors as columns of a matrix of that width, in single precision."""
        matrix = np.zeros((self.dim, width), np.float32)
        matrix[self.bucket, self.row] = self.weight
        return matrix

    def slice(self, rows: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, bucket, weight) of the entries of neighbouring rows, which count from 0."""
        part = slice(self.starts[rows.start], self.starts[rows.stop])
        return self.row[part] - rows.start, self.bucket[part], self.weight[part]

    def away(self, centre: np.ndarray) -> np.ndarray:
        """Distances from a point."""
        product = np.bincount(self.row, self.weight * centre[self.bucket], len(self))
        return np.sqrt(np.maximum(1 + centre @ centre - 2 * product, 0))


class _Group:
    """Queries that are scored together.

    The buckets that many of them use are a matrix, which is multiplied at once; what else a query
    has, which is little where texts share their common words only, is taken entry by entry.
    """

    def __init__(self, entries: Entries, rows: slice):
        self.rows, self.size = rows, rows.stop - rows.start
        row, bucket, weight = entries.slice(rows)
        self.common = np.flatnonzero(np.bincount(bucket, minlength=entries.dim) > COMMON_SHARE * self.size)
        place = np.full(entries.dim, -1)
        place[self.common] = np.arange(len(self.common))
        often = place[bucket] >= 0
        self.matrix = np.zeros((self.size, len(self.common)), np.float32)
        self.matrix[row[often], place[bucket[often]]] = weight[often]
        self.bucket, self.weight = bucket[~often], weight[~often].astype(np.float32)
        self.starts = np.searchsorted(row[~often], np.arange(self.size + 1))

    def scores(self, which: np.ndarray | None, columns: np.ndarray, out: np.ndarray) -> None:
        """Scores of the queries `which` (all, if None), up to rounding errors."""
        left = self.matrix if which is None else self.matrix[which]
        if len(self.common):
            np.dot(left, columns if len(self.common) == len(columns) else columns[self.common], out=out)
        else:
            out[:] = 0
        width = columns.shape[1]
        some, total = np.empty((RARE_ROWS, width), np.float32), np.empty(width, np.float32)
        for line, i in zip(out, range(self.size) if which is None else which):
            for start in range(self.starts[i], self.starts[i + 1], RARE_ROWS):
                part = slice(start, min(start + RARE_ROWS, self.starts[i + 1]))
                rows = some[: part.stop - start]
                np.take(columns, self.bucket[part], axis=0, out=rows, mode="clip")
                np.dot(self.weight[part], rows, out=total)
                np.add(line, total, out=line)


class SparseSearch:
    """The k best documents of each of many sparse queries by cosine, over slabs of sparse documents.

    Only entries that a query has are multiplied, so the work goes with these and not with the width
    of the vectors. Rough scores in single precision choose the pairs that may be among the k best;
    those are scored again from their entries in double precision.
    """

    def __init__(self, vectors: pa.Array | pa.ChunkedArray, dim: int, k: int, query_rows: int, floors: np.ndarray | None = None):
        self.k, self.entries = k, Entries(vectors, dim)
        self.entries.order_by_count()
        #: Places of the usable queries, in the order in which they are searched.
        self.keep = self.entries.keep
        self.margin = dim * 2.0**-23 + 1e-6
        self.parts: list[tuple[Best, int, list[_Group]]] = []
        self.group_rows = max(1, min(GROUP_ROWS, WIDE_BYTES // (8 * dim)))
        for start in range(0, len(self.keep), query_rows):
            stop = min(start + query_rows, len(self.keep))
            groups = [_Group(self.entries, slice(at, min(at + self.group_rows, stop))) for at in range(start, stop, self.group_rows)]
            best = Best(stop - start, k, None if floors is None else floors[self.keep[start:stop]])
            self.parts.append((best, start, groups))

    def add(self, docs: Entries, keys: np.ndarray, near: bool = False) -> None:
        """Score the documents of a slab, at most `slab_rows`, whose keys are numbers in the order of the true ones.

        With `near`, for documents that lie close together, queries whose bound says so are left out.
        """
        if not len(docs):
            return
        width = -(-len(docs) // STRIDES) * STRIDES
        columns, scores = docs.columns(width), np.empty((self.group_rows, width), np.float32)
        far = self._distances(docs) if near else None
        for best, start, groups in self.parts:
            for group in groups:
                mine = slice(group.rows.start - start, group.rows.stop - start)
                which = None
                if far is not None:
                    reach = ceilings(np.ones(group.size), far[group.rows], 1.0, "cosine")
                    which = np.flatnonzero(reach >= best.floor[mine])
                    if not len(which):
                        continue
                rough = scores[: group.size if which is None else len(which)]
                group.scores(which, columns, rough)
                rough[:, len(docs) :] = -np.inf
                floor = best.floor[mine] if which is None else best.floor[mine][which]
                row, col = self._candidates(rough, floor, len(docs))
                row = row if which is None else which[row]
                for part, exact in self._exact(group.rows, row, docs, col):
                    best.offer(mine.start + row[part], exact, keys[col[part]], WAITING)
            best.flush()

    def _distances(self, docs: Entries, rows: int = 2048) -> np.ndarray:
        """At least how far each query is from all documents: from the nearest of some balls around them."""
        nearest = np.full(len(self.keep), np.inf)
        for start in range(0, len(docs), rows):
            stop = min(start + rows, len(docs))
            row, bucket, weight = docs.slice(slice(start, stop))
            centre = np.bincount(bucket, weight, docs.dim) / (stop - start)
            product = np.bincount(row, weight * centre[bucket], stop - start)
            radius = float(np.sqrt(np.maximum(1 + centre @ centre - 2 * product, 0)).max())
            nearest = np.minimum(nearest, np.maximum(self.entries.away(centre) - radius - 1e-6 * (1 + radius), 0))
        return nearest

    def _candidates(self, rough: np.ndarray, floor: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that may be among the k best: at least the floor and the k-th best of all parts of the slab."""
        parts = rough.reshape(len(rough), -1, STRIDES)
        tops, limit = parts.max(axis=1), floor - self.margin
        if STRIDES > self.k:
            crowded = np.flatnonzero((tops >= limit[:, None]).sum(axis=1) > self.k)
            own = np.partition(tops[crowded], STRIDES - self.k, axis=1)[:, STRIDES - self.k] - 2 * self.margin
            limit[crowded] = np.maximum(limit[crowded], own)
        row, stride = np.nonzero(tops >= limit[:, None])
        hit, place = np.nonzero(parts[row, :, stride] >= limit[row, None])
        row, col = row[hit], place * STRIDES + stride[hit]
        there = col < total
        return row[there], col[there]

    def _exact(self, rows: slice, row: np.ndarray, docs: Entries, col: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        """Scores of single pairs, some at a time, the same whatever other pairs are asked for."""
        if not len(row):
            return
        mine, bucket, weight = self.entries.slice(rows)
        q = np.zeros((rows.stop - rows.start, docs.dim))
        q[mine, bucket] = weight
        step = max(1, _ENTRIES // int(docs.counts.max()))
        for start in range(0, len(row), step):
            part = slice(start, min(start + step, len(row)))
            at = docs.at(col[part])
            pair = np.repeat(np.arange(part.stop - start), docs.counts[col[part]])
            product = q[row[part][pair], docs.bucket[at]] * docs.weight[at]
            yield part, np.round(np.bincount(pair, product, part.stop - start), 6) + 0.0

    def renumber(self, number: np.ndarray) -> None:
        """Give the documents found new numbers, in the order of the true keys again."""
        for best, _, _ in self.parts:
            if best.key is not None:
                best.key = number[best.key]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the query, key, score) of all results."""
        done = [(best, start) for best, start, _ in self.parts if best.key is not None]
        if not done:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        return (
            np.concatenate([self.keep[start + best.query] for best, start in done]),
            np.concatenate([best.key for best, _ in done]),
            np.concatenate([best.score for best, _ in done]),
        )
