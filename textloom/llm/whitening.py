"""Whitening of embeddings by a matrix-free Jacobi-Davidson solver.

The covariance is never formed. What the solver needs of it are products with a few vectors at a
time: a pass over the distinct vectors in which each task centres its rows exactly, multiplies and
adds, and partial sums are added in two levels. The corrections of all wanted components are found
together by inner MINRES steps, so a step costs one pass for the whole block; a subspace with
Rayleigh-Ritz extraction gathers them, and pairs whose residual has reached double precision are
locked. The driver holds matrices of the width of a vector times the size of the subspace, whatever
the number of rows.

Defined cases: rows whose vector is null or holds null or non-finite entries are dropped. Shorter
vectors, empty ones too, count as filled up with zeros. Each row left has its result rows, also
rows that repeat an id or a vector and rows without an id; the fit counts each vector once.
Components with no variance left beyond rounding cannot be whitened and are left out, so one
vector, or copies of one, give no rows. An empty table gives an empty result. Other columns are
not read. Entries of 2**40 and more after scaling, and deviations beyond 63 bits, raise an error.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import materialise

SCALE, OFFSET = 64, 1_000_000
#: Scaled entries from here on are refused.
LARGEST = 2**40
#: Rows of the fit list in one stored block, and rows centred at once.
BLOCK = 4096
#: Wanted pairs beyond the asked ones, which keep neighbours of the last ones from being missed.
GUARD = 4
#: Columns of the search space before it is cut back, as a multiple of the wanted pairs.
SPACE = 5
INNER, OUTER = 8, 60
#: Partial sums that the driver adds itself; more are first added in tasks.
PARTS = 64
#: Part of the trace under which a component counts as without variance.
NOTHING = 1e-12

Apply = Callable[[np.ndarray], np.ndarray]


def whole(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Valid rows as the key and `x`, the scaled entries as whole numbers."""
    values = F.transform(vector, lambda c: c.cast("double"))
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    good = F.col(vector).isNotNull() & ~F.exists(values, bad)
    # beyond LARGEST the caller refuses the table; kept within it here so that no sum overflows
    held = lambda c: F.greatest(F.least(c * SCALE, F.lit(2.0 * LARGEST)), F.lit(-2.0 * LARGEST))
    x = F.transform(values, lambda c: F.floor(held(c)) + OFFSET)
    return vectors.where(good).select(F.col(key), x.alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as whole numbers, filled up with zeros of the entries."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    if len(flat) == len(sizes) * width:
        return flat.reshape(-1, width)
    out = np.full((len(column), width), OFFSET, np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def fit_blocks(rows: DataFrame, width: int) -> DataFrame:
    """Each distinct `x` once, packed into written blocks of at most BLOCK rows."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                data = _matrix(batch.column(0).slice(at, BLOCK), width).astype("<i8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["block"])

    # filled up before they are compared, so that a short vector equals its filled copy
    filled = F.concat("x", F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(width) - F.size("x"))).alias("x")
    return materialise(rows.select(filled).distinct().mapInArrow(pack, "block binary"), "whitening-fit")


def added_up(blocks: DataFrame, width: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of `part` over all blocks. Whole numbers stay whole; part and result have a fixed shape."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(0):
                own = part(np.frombuffer(value.as_buffer(), "<i8").reshape(-1, width))
                total = own if total is None else total + own
        if total is not None:
            yield _blob(total)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(0).to_pylist():
                own = _array(value)
                total = own if total is None else total + own
        if total is not None:
            yield _blob(total)

    found = blocks.mapInArrow(sums, "part binary")
    tasks = blocks.rdd.getNumPartitions()
    if tasks > PARTS:
        found = found.repartition(math.isqrt(tasks)).mapInArrow(merge, "part binary")
    parts = [_array(r.part) for r in found.collect()]
    return sum(parts[1:], parts[0])


def _blob(total: np.ndarray) -> pa.RecordBatch:
    head = np.array([total.dtype.kind == "f", *total.shape], "<i8")
    data = bytes([len(head)]) + head.tobytes() + np.ascontiguousarray(total).tobytes()
    return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["part"])


def _array(data: bytes) -> np.ndarray:
    head = np.frombuffer(data[1 : 1 + 8 * data[0]], "<i8")
    return np.frombuffer(data[1 + 8 * data[0] :], "<f8" if head[0] else "<i8").reshape(head[1:])


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n in doubles, right to the last place: the difference is taken in whole numbers."""
    return (x * n - sums) / n


class Covariance:
    """Products with the covariance of the fit list, one pass each."""

    def __init__(self, blocks: DataFrame, width: int):
        self.blocks, self.width, self.passes = blocks, width, 0
        both = added_up(blocks, width, lambda x: np.concatenate(([len(x)], x.sum(axis=0))))
        self.n, self.sums = int(both[0]), both[1:]

    def _sum(self, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        n, sums = self.n, self.sums
        self.passes += 1
        return added_up(self.blocks, self.width, lambda x: part(centred(x, n, sums))) / n

    def trace(self) -> float:
        return float(self._sum(lambda y: np.array([np.einsum("ij,ij->", y, y)]))[0])

    def apply(self, z: np.ndarray) -> np.ndarray:
        return self._sum(lambda y: y.T @ (y @ z))

    def projected(self, z: np.ndarray) -> np.ndarray:
        """Covariance of the rows projected on the columns of z."""
        return self._sum(lambda y: (y @ z).T @ (y @ z))


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Columns that extend the span of `against` by that of `new`; what adds nothing is dropped."""
    out = np.zeros((len(new), 0))
    for column in new.T:
        size = np.linalg.norm(column)
        if size == 0 or not np.isfinite(size):
            continue
        column = column / size
        for _ in range(3):
            for known in (*against, out):
                column = column - known @ (known.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-10:
                break
            column = column / left
        else:
            out = np.column_stack([out, column])
    return out


def minres(apply: Apply, theta: np.ndarray, known: np.ndarray, right: np.ndarray, steps: int, goal: float) -> np.ndarray:
    """Approximate solutions t_i of (I - KK')(V - theta_i)(I - KK') t_i = right_i, all columns in step.

    The shifted operator is symmetric but indefinite, which MINRES allows. Each step is one
    product for the whole block; it ends when every column's residual has shrunk to `goal`.
    """

    def away(z: np.ndarray) -> np.ndarray:
        return z - known @ (known.T @ z)

    x = np.zeros_like(right)
    v = away(right)
    beta = np.linalg.norm(v, axis=0)
    start = np.where(beta > 0, beta, 1.0)
    v = v / start
    eta = beta.copy()
    before, w, w_before = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    c, c_before = np.ones(len(beta)), np.ones(len(beta))
    s, s_before = np.zeros(len(beta)), np.zeros(len(beta))
    beta = np.zeros(len(beta))
    live = eta > 0
    for _ in range(steps):
        if not live.any():
            break
        z = away(apply(v) - v * theta)
        alpha = np.einsum("ij,ij->j", v, z)
        z = z - v * alpha - before * beta
        after = np.linalg.norm(z, axis=0)
        delta = c * alpha - c_before * s * beta
        rho1 = np.hypot(delta, after)
        rho2 = s * alpha + c_before * c * beta
        rho3 = s_before * beta
        live &= rho1 > 0
        safe = np.where(rho1 > 0, rho1, 1.0)
        c_before, s_before = c, s
        c, s = np.where(live, delta / safe, 1.0), np.where(live, after / safe, 0.0)
        w, w_before = (v - w_before * rho3 - w * rho2) / safe, w
        x = np.where(live, x + w * (c * eta), x)
        eta = -s * eta
        before, v, beta = v, z / np.where(after > 0, after, 1.0), after
        live &= (np.abs(eta) > goal * start) & (after > 0)
    return x


def largest_pairs(apply: Apply, width: int, wanted: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues, falling, and unit eigenvectors as columns, by Jacobi-Davidson.

    Ends when the residual of every pair is at most the rounding of a product. A pair is locked
    only with all pairs before it, and GUARD more pairs are followed without having to converge.
    """
    wanted = min(wanted, width)
    follow = min(width, wanted + GUARD)
    space = _orthonormal(np.random.default_rng(seed).standard_normal((width, follow)))
    image = apply(space)
    locked, values = np.zeros((width, 0)), np.zeros(0)
    best, still = np.inf, 0
    for outer in range(OUTER):
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        ritz, moved = space @ turn, image @ turn
        norm = max(theta[0], values.max(initial=0.0))
        residual = moved - ritz * theta
        residual -= locked @ (locked.T @ residual)
        sizes = np.linalg.norm(residual, axis=0)
        left = wanted - len(values)
        limit = max(width, 64) * np.finfo(float).eps * norm
        done = int(np.argmin(np.append(sizes[:left] <= limit, False)))
        whole_space = space.shape[1] + len(values) == width
        if whole_space and sizes[:left].max() <= 64 * limit:
            done = left  # the space holds everything: what is left is rounding
        if done:
            locked, values = np.column_stack([locked, ritz[:, :done]]), np.append(values, theta[:done])
            ritz, moved, theta, residual, sizes = (a[..., done:] for a in (ritz, moved, theta, residual, sizes))
            left -= done
        if left == 0:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        worst = float(sizes[:left].max())
        best, still = (worst, 0) if worst < 0.5 * best or done else (best, still + 1)
        if still > 12:
            raise ArithmeticError(f"residual stays at {best:.3g}, above {limit:.3g}")
        active = min(follow, ritz.shape[1], left + GUARD)
        near = ritz[:, :active]
        known = np.column_stack([locked, near])
        step = minres(apply, theta[:active], known, -residual[:, :active], INNER, 2.0 ** -(outer + 2))
        if ritz.shape[1] + active > max(SPACE * (wanted + GUARD), active + follow):
            ritz, moved = ritz[:, : 2 * follow], moved[:, : 2 * follow]
        space, image = ritz, moved
        new = _orthonormal(step, locked, space)
        if not new.shape[1]:
            new = _orthonormal(np.random.default_rng(outer).standard_normal((width, follow)), locked, space)
        if new.shape[1]:
            space, image = np.column_stack([space, new]), np.column_stack([image, apply(new)])
        else:
            space = _orthonormal(space, locked)
            image = apply(space)
    raise ArithmeticError("Jacobi-Davidson did not converge")


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 16) -> DataFrame:
    """Per row and component: key, `component`, `n`, `deviation`, `whitened`, `explained`, `identity_error`."""
    spark = vectors.sparkSession
    kind = vectors.schema[key].dataType.simpleString()
    result = f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = whole(vectors, key, vector)
    size = rows.agg(
        F.max(F.size("x")).alias("width"), F.min(F.array_min("x")).alias("least"), F.max(F.array_max("x")).alias("most")
    ).first()
    if not size.width:
        return spark.createDataFrame([], result)
    width, least, most = size.width, min(size.least, OFFSET), max(size.most, OFFSET)
    if max(-least, most) >= LARGEST:
        raise OverflowError("an entry is too large to be whitened")
    covariance = Covariance(fit_blocks(rows, width), width)
    n, sums = covariance.n, covariance.sums
    if n * max(-least, most) >= 2**62:
        raise OverflowError("too many rows for sums of 63 bits")
    trace = covariance.trace()
    if trace <= 0:
        return spark.createDataFrame([], result)
    values, axes = largest_pairs(covariance.apply, width, components)
    real = values > NOTHING * trace
    values, axes = values[real], axes[:, real]
    scaled = axes / np.sqrt(values)
    error = float(np.abs(covariance.projected(scaled) - np.eye(len(values))).max())
    share = values / trace
    fits = width * (n * (most - least)) ** 2 < 2**63
    number = len(values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = _matrix(part.column(1), width)
                apart = x * n - sums
                if not fits:
                    apart = apart.astype(object)
                deviation = pa.array((apart * apart).sum(axis=1).tolist(), pa.int64())
                white = centred(x, n, sums) @ scaled
                at_row = pa.array(np.repeat(np.arange(len(x)), number))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(at_row),
                        pa.array(np.tile(np.arange(1, number + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(x) * number, n)),
                        deviation.take(at_row),
                        pa.array(white.reshape(-1)),
                        pa.array(np.tile(share, len(x))),
                        pa.array(np.full(len(x) * number, error)),
                    ],
                    [key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(project, result)
