"""Embedding whitening by a block Jacobi-Davidson method on a covariance that is never formed.

The covariance V of the whole-number vectors x is only known by its products with a few vectors at a time,
each one pass over the table: (1/n) sum of y (y . w) with y = x - S/n, centred before multiplying.
The driver holds blocks of dimension x a few columns.  Each round takes the Ritz pairs of its subspace
(Rayleigh-Ritz), locks the leading ones whose residual is down to rounding, and adds the corrections t of the
others, (I - QQ')(V - theta)(I - QQ') t = -r, which a few steps of MINRES approximate, again by passes
over the table (one a step for all columns together).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.llm.common import materialize, release, table

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LARGEST = 2.0 ** 52            # entries of this size and more have no exact long and count as non-finite
GUARDS = 4                     # further Ritz vectors that are corrected beside the wanted ones
INNER_STEPS = 4                # of MINRES a round
BASIS_BLOCKS = 6               # the subspace is cut back beyond so many blocks
RESIDUAL = 64 * 2.0 ** -52     # of the largest eigenvalue: rounding
STALLED = 1e-11                # a residual that no longer falls is accepted below this
MOST_ROUNDS = 500
FAN_IN = 256                   # partial results added at a time by one task or the driver


def whole_numbers(c: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * c).astype(np.int64) + SHIFT


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, vector) -> one row a batch and vector length: dims, ids, x as little-endian integers."""
    for batch in batches:
        vectors = batch.column("vector")
        lengths = np.where(vectors.is_null().to_numpy(zero_copy_only=False), -1, vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False))
        for dims in np.unique(lengths[lengths > 0]).tolist():
            at = np.flatnonzero(lengths == dims)
            flat = vectors.take(pa.array(at)).flatten()
            c = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, dims)
            good = (np.abs(c) < LARGEST).all(axis=1)             # false for nan
            if not good.any():
                continue
            x = whole_numbers(c[good])
            x = x.astype("<i4" if np.abs(x).max() < 2**31 else "<i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array([dims], pa.int32()), pa.array([len(x)], pa.int64()), pa.array([batch.column("id").take(pa.array(at[good])).to_pylist()], pa.list_(batch.column("id").type)),
                 pa.array([x.tobytes()], pa.binary())], ["dims", "n", "ids", "x"])


def _decode(payload: bytes, n: int, dims: int) -> np.ndarray:
    return np.frombuffer(payload, "<i4" if len(payload) == 4 * n * dims else "<i8").reshape(n, dims).astype(np.int64)


class Vectors:
    """The blocks of a table and sums over all their rows, each one pass."""

    def __init__(self, blocks: DataFrame, dims: int):
        self.blocks, self.dims = blocks, dims
        self.partitions = blocks.rdd.getNumPartitions()

    def fold(self, of_block: Callable[[np.ndarray], np.ndarray], combine: np.ufunc = np.add) -> np.ndarray | None:
        """``of_block`` of every block, combined; partial results of one array a partition, never rows, reach the driver."""
        dims = self.dims

        def partial(batches):
            total = None
            for batch in batches:
                for n, payload in zip(batch.column("n").to_pylist(), batch.column("x")):
                    here = of_block(_decode(payload.as_py(), n, dims))
                    if here.dtype == np.float64:
                        here = here.astype(np.longdouble)
                    total = here if total is None else combine(total, here)
            if total is not None:
                yield _row(TaskContext.get().partitionId(), total)

        def add(rows: pa.Table) -> pa.Table:
            return pa.Table.from_batches([_row(rows["part"][0].as_py() % groups, _combined(rows.to_pylist(), combine))])

        out = self.blocks.select("n", "x").mapInArrow(partial, "part int, kind string, shape array<int>, value binary")
        if self.partitions > FAN_IN:
            groups = int(np.ceil(np.sqrt(self.partitions)))
            out = out.groupBy(F.col("part") % groups).applyInArrow(add, out.schema)
        rows = [r.asDict() for r in out.collect()]
        return _combined(rows, combine) if rows else None

    def moments(self):
        """n, S and the extremes of each dimension, as Python integers."""
        def sums(x):
            return np.stack([np.full(x.shape[1], len(x)), (x >> 26).sum(axis=0), (x & (2**26 - 1)).sum(axis=0)])

        n, high, low = self.fold(sums)
        least = self.fold(lambda x: np.stack([x.min(axis=0), -x.max(axis=0)]), np.minimum)
        return int(n[0]), [int(h) * 2**26 + int(v) for h, v in zip(high, low)], least[0].tolist(), (-least[1]).tolist()


def _row(part: int, total: np.ndarray) -> pa.RecordBatch:
    total = total.astype(np.float64) if total.dtype == np.longdouble else total
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.dtype.str]), pa.array([list(total.shape)], pa.list_(pa.int32())),
                                       pa.array([total.tobytes()], pa.binary())], ["part", "kind", "shape", "value"])


def _combined(rows: list[dict], combine: np.ufunc) -> np.ndarray:
    """Partial results in the order of their partitions."""
    total = None
    for r in sorted(rows, key=lambda r: r["part"]):
        value = np.frombuffer(r["value"], r["kind"]).reshape(r["shape"])
        value = value.astype(np.longdouble) if value.dtype == np.float64 else value
        total = value if total is None else combine(total, value)
    return total.astype(np.float64) if total.dtype == np.longdouble else total


def centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """S/n as whole part and rest, so that x less both keeps all its digits."""
    base = [s // n for s in sums]
    return np.array(base, np.int64), np.array([(s - n * b) / n for s, b in zip(sums, base)])


def orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to ``against``."""
    kept = np.concatenate(against, axis=1)
    out = []
    for t in new.T:
        size = np.linalg.norm(t)
        for _ in range(3):                                       # again until nothing of the others is left
            t = t - kept @ (kept.T @ t)
        if size and np.linalg.norm(t) > 1e-8 * size:
            t = t / np.linalg.norm(t)
            t = t - kept @ (kept.T @ t)
            t = t / np.linalg.norm(t)
            out.append(t)
            kept = np.column_stack([kept, t])
    return np.column_stack(out) if out else new[:, :0]


def minres(apply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int) -> np.ndarray:
    """Minimal-residual solutions of symmetric systems, one a column, by ``steps`` Lanczos steps in common."""
    def over(a, b):
        return np.divide(a, b, out=np.zeros_like(a), where=b != 0)

    beta = np.linalg.norm(rhs, axis=0)
    v, v_last = over(rhs, np.broadcast_to(beta, rhs.shape)), np.zeros_like(rhs)
    left = beta.copy()                                           # norm of the residual, with its sign
    x, d1, d2 = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    c1, s1, c2, s2 = np.ones_like(beta), np.zeros_like(beta), np.ones_like(beta), np.zeros_like(beta)
    beta = np.zeros_like(beta)
    for _ in range(steps):
        z = apply(v)
        alpha = (v * z).sum(axis=0)
        z = z - alpha * v - beta * v_last
        after = np.linalg.norm(z, axis=0)
        # the new column of the tridiagonal matrix under the two rotations before it, then its own
        third, above = s2 * beta, c2 * beta
        second = c1 * above + s1 * alpha
        first = -s1 * above + c1 * alpha
        size = np.hypot(first, after)
        c2, s2 = c1, s1
        c1, s1 = over(first, size), over(after, size)
        d = over(v - second * d1 - third * d2, np.broadcast_to(size, v.shape))
        x = x + c1 * left * d
        left, d1, d2 = -s1 * left, d, d1
        v_last, v, beta = v, over(z, np.broadcast_to(after, z.shape)), after
        if not after.any():
            break
    return x


def largest_eigenpairs(product: Callable[[np.ndarray], np.ndarray], dims: int, count: int, inner: int = INNER_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix given by its products."""
    width = min(dims, count + GUARDS)
    locked, values = np.zeros((dims, 0)), []
    basis = orthonormal(np.random.default_rng(0).standard_normal((dims, width)), locked)
    image = product(basis)
    best, stalled = np.inf, 0
    for _ in range(MOST_ROUNDS):
        theta, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        rest = image - basis * theta
        rest -= locked @ (locked.T @ rest)
        scale = max([abs(t) for t in (*values[:1], *theta[:1])], default=0.0)
        norms = np.linalg.norm(rest, axis=0)
        wanted = norms[:count - len(values)]
        whole = basis.shape[1] + len(values) == dims             # nothing can be added: what is left is rounding
        stalled = 0 if wanted.max(initial=0.0) < 0.5 * best else stalled + 1
        best = min(best, wanted.max(initial=0.0))
        accepted = max(RESIDUAL, STALLED if whole or stalled > 3 else 0.0) * scale
        lock = next((i for i, r in enumerate(wanted) if r > accepted), len(wanted))
        if lock:
            locked = np.column_stack([locked, basis[:, :lock]])
            values += theta[:lock].tolist()
            basis, image, theta, rest = basis[:, lock:], image[:, lock:], theta[lock:], rest[:, lock:]
            best, stalled = np.inf, 0
            if len(values) >= count:
                order = np.argsort(values)[::-1]
                return np.array(values)[order], np.linalg.qr(locked[:, order])[0]
        active = min(width, basis.shape[1], count - len(values) + GUARDS)
        shut = np.column_stack([locked, basis[:, :active]])

        def apply(t, theta=theta[:active], shut=shut):
            t = t - shut @ (shut.T @ t)
            t = product(t) - theta * t
            return t - shut @ (shut.T @ t)

        right = rest[:, :active] - shut @ (shut.T @ rest[:, :active])
        if basis.shape[1] + active > BASIS_BLOCKS * width:       # the leading Ritz vectors are kept
            basis, image = basis[:, :2 * width], image[:, :2 * width]
        new = orthonormal(minres(apply, -right, inner), locked, basis)
        if not new.shape[1]:
            new = orthonormal(np.random.default_rng(len(values) + 1).standard_normal((dims, active)), locked, basis)
        if new.shape[1]:
            basis, image = np.column_stack([basis, new]), np.column_stack([image, product(new)])
    raise RuntimeError(f"residuals of {best:g} after {MOST_ROUNDS} rounds")


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n x - S)^2 of each row, exact; None beyond a long.  Sums wrap round 2^64, which is exact where the result fits."""
    base, _ = centre(n, sums)
    left = np.array([(s - n * int(b)) for s, b in zip(sums, base)], np.int64)
    away = x - base
    rough = ((float(n) * away - left) ** 2).sum(axis=1)
    with np.errstate(over="ignore"):
        exact = ((np.int64(n) * away - left) ** 2).sum(axis=1).tolist()
    for i in np.flatnonzero(rough > 2.0 ** 62).tolist():         # near the border by Python's integers
        true = sum((n * int(v) - s) ** 2 for v, s in zip(x[i], sums)) if rough[i] < 2.0 ** 64 else 2**64
        exact[i] = true if true < 2**63 else None
    return exact


def _whiten(dims: int, n: int, sums: list[int], matrix: np.ndarray, explained: list[float], error: float):
    base, rest = centre(n, sums)
    count = matrix.shape[1]

    def whiten(batches):
        for batch in batches:
            for rows, ids, payload in zip(batch.column("n").to_pylist(), batch.column("ids"), batch.column("x")):
                x = _decode(payload.as_py(), rows, dims)
                white = ((x - base) - rest) @ matrix
                at = np.repeat(np.arange(rows), count)
                yield pa.RecordBatch.from_arrays(
                    [ids.values.take(pa.array(at)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)), pa.array(np.full(len(at), n)),
                     pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(at)), pa.array(white.ravel()),
                     pa.array(np.tile(np.array(explained), rows)), pa.array(np.full(len(at), error))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return whiten


def whiten(vectors: DataFrame, count: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (id, component, n, deviation, whitened, explained, identity_error) of every usable vector.

    A vector that is null or empty, or holds a null or non-finite entry (or one of 2**52 and more, which
    has no exact whole number), is left out; of vectors of several lengths those of the most
    common length stay (the longest of equally common ones).  Repeated rows and ids count each for
    itself, null ids are kept.  Components without variance (eigenvalues within rounding of zero) are
    not reported: an empty table, one vector or equal vectors give no rows.  Vectors with tied
    eigenvalues are any basis of their space, the same for all rows.  Deviation is null where it exceeds a long.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    kind = rows.schema["id"].dataType.simpleString()
    result = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    blocks = materialize(rows.mapInArrow(_blocks, f"dims int, n long, ids array<{kind}>, x binary"), "whole-vectors")
    common = blocks.groupBy("dims").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if common is None:
        return vectors.sparkSession.createDataFrame([], result)
    dims = common["dims"]
    table_of = Vectors(blocks.where(F.col("dims") == dims), dims)
    n, sums, least, most = table_of.moments()
    base, rest = centre(n, sums)
    trace = float(table_of.fold(lambda x: np.array([(((x - base) - rest) ** 2).sum()]))[0]) / n
    if not any(a != b for a, b in zip(least, most)):
        return vectors.sparkSession.createDataFrame([], result)

    def product(w: np.ndarray) -> np.ndarray:
        def of_block(x):
            y = (x - base) - rest
            return y.T @ (y @ w)
        return table_of.fold(of_block) / n

    values, components = largest_eigenpairs(product, dims, min(count, dims))
    some = values > dims * 2.0 ** -50 * values[0]
    values, components = values[some], components[:, some]
    matrix = components / np.sqrt(values)

    def second_moments(x):
        z = ((x - base) - rest) @ matrix
        return np.vstack([z.T @ z, z.sum(axis=0)])

    found = table_of.fold(second_moments) / n
    covariance = found[:-1] - np.outer(found[-1], found[-1])
    error = float(np.abs(covariance - np.eye(len(values))).max())
    return table_of.blocks.select("n", "ids", "x").mapInArrow(
        _whiten(dims, n, sums, matrix, (values / trace).tolist(), error), result)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened components of every usable row of ``embeddings``."""
    return whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
