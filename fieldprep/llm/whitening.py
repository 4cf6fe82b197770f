"""Whitening of embeddings along their leading components, found by a Jacobi-Davidson iteration.

The covariance matrix is never formed. It is met only through products with a few vectors at once,
each one pass over the stored fit list: a task multiplies its rows, centred first, with the vectors
and hands on one sum per dimension and vector, and Spark adds these up. The driver holds a basis of
at most ``LARGEST_BASIS`` vectors of one dimension's length, whatever the number of rows.

A round of the iteration is a Rayleigh-Ritz step on that basis, then one correction equation for
every leading pair that has not converged,

    (I - QQ')(A - theta I)(I - QQ') t = -r,    t orthogonal to Q (locked pairs and the Ritz vector),

solved roughly by MINRES; all equations advance together, so a step of all of them is one pass over
the data. The corrections widen the basis. Pairs are locked once their residual is down to rounding.
Some pairs more than wanted (``GUARDS``) are carried along to a coarser residual, so that a larger
eigenvalue which the basis had missed comes up before the last wanted pair is accepted.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldprep.llm.batches import steps
from fieldprep.llm.store import cut, written

#: An entry c of a vector counts as the whole number floor(SCALE * c).
SCALE = 256
COMPONENTS = 4
#: Residual norm, as a share of the largest Ritz value, at which a pair counts as exact; and for guards.
EXACT, COARSE = 2e-14, 1e-2
GUARDS = 2
#: Steps of MINRES in a round, and vectors that the basis holds before it is cut back to the best.
INNER, LARGEST_BASIS = 6, 60
ROUNDS = 200
#: Eigenvalues up to this share of the largest are no direction of the data but rounding.
NOTHING = 1e-12
SEED = 20

RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def whole_vectors(rows: DataFrame) -> DataFrame:
    """vec_id and x, the vector in whole numbers, for every row with a usable vector."""
    vector = F.transform("embedding", lambda c: c.cast("double"))
    kept = rows.select(F.col("vec_id").cast("bigint"), vector.alias("embedding")).filter(usable(F.col("embedding")))
    return kept.select("vec_id", F.transform("embedding", lambda c: F.floor(F.lit(float(SCALE)) * c)).alias("x"))


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """The lists as rows; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def _summed(fit: DataFrame, width: int, dims: int, measure: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over the fit list of ``measure`` (rows as a matrix to an array of ``width`` numbers).

    Every task sends one number per place; Spark adds them per place.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in steps(batches, 4096):
            if batch.num_rows:
                total += measure(_matrix(batch.column(0), dims)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], names=["place", "part"])

    sums = fit.mapInArrow(partial, "place int, part double").groupBy("place").agg(F.sum("part").alias("total")).toPandas()
    out = np.zeros(width)
    out[sums["place"]] = sums["total"]
    return out


def _minres(times: Callable[[np.ndarray], np.ndarray], right: np.ndarray, inner: int, enough: float = 0.05) -> np.ndarray:
    """Rough solutions of one symmetric system per column of ``right``, all advanced together from zero.

    ``times`` applies to every column its own system. Columns whose residual has shrunk to ``enough``
    stay as they are.
    """
    size = right.shape[1]
    beta = np.linalg.norm(right, axis=0)
    start, live = beta.copy(), beta > 0
    scale = np.where(live, beta, 1.0)
    old, new = np.zeros_like(right), right / scale
    w_old, w_new, x = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    c_old, c, s_old, s, phi = np.ones(size), np.ones(size), np.zeros(size), np.zeros(size), beta.copy()
    beta = np.zeros(size)
    for _ in range(inner):
        if not live.any():
            break
        p = times(new) - old * beta
        alpha = (new * p).sum(axis=0)
        p -= new * alpha
        beta_next = np.linalg.norm(p, axis=0)
        # The two earlier rotations, then the one that removes beta_next.
        epsilon, bar = s_old * beta, c_old * beta
        delta, gamma_bar = c * bar + s * alpha, c * alpha - s * bar
        gamma = np.hypot(gamma_bar, beta_next)
        live &= gamma > 1e-300
        gamma = np.where(gamma > 1e-300, gamma, 1.0)
        w_old, w_new = w_new, (new - w_old * epsilon - w_new * delta) / gamma
        c_old, s_old, c, s = c, s, gamma_bar / gamma, beta_next / gamma
        x = np.where(live, x + w_new * (c * phi), x)
        phi = np.where(live, -s * phi, phi)
        live &= (np.abs(phi) > enough * start) & (beta_next > 1e-14 * (np.abs(alpha) + beta))
        old, new = new, p / np.where(beta_next > 0, beta_next, 1.0)
        beta = beta_next
    return x


def _outside(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to the orthonormal ``basis``."""
    kept = np.zeros((len(block), 0))
    for column in block.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        v = column / size
        for _ in range(3):
            v = v - basis @ (basis.T @ v) - kept @ (kept.T @ v)
        if np.linalg.norm(v) > 1e-8:
            v = v / np.linalg.norm(v)
            v = v - basis @ (basis.T @ v) - kept @ (kept.T @ v)
            kept = np.column_stack([kept, v / np.linalg.norm(v)])
    return kept


def leading_pairs(times: Callable[[np.ndarray], np.ndarray], dims: int, count: int, guards: int = GUARDS) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and unit eigenvectors of a symmetric operator.

    ``times`` multiplies a block of columns. The iteration ends when every residual is down to
    ``EXACT`` of the largest Ritz value, or no longer falls because rounding in the products forbids it.
    """
    count = min(count, dims)
    draws = np.random.default_rng(SEED)
    basis = _outside(draws.standard_normal((dims, min(dims, 2 * (count + guards)))), np.zeros((dims, 0)))
    images = times(basis)
    best, stuck = np.inf, 0
    for _ in range(ROUNDS):
        small = basis.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        vectors, products = basis @ turn, images @ turn
        size = max(abs(values[0]), abs(values[-1]), 1e-300)
        watched = min(count + guards, basis.shape[1])
        residuals = products[:, :watched] - vectors[:, :watched] * values[:watched]
        norms = np.linalg.norm(residuals, axis=0) / size
        exact = norms <= EXACT
        worst = norms[:count].max()
        stuck, best = (0, worst) if worst < best / 2 else (stuck + 1, min(best, worst))
        locked = np.logical_and.accumulate(exact)
        guarded = (norms[count:] <= COARSE).all()
        if basis.shape[1] >= dims or (guarded and (exact[:count].all() or (best < 1e-11 and stuck >= 3))):
            return values[:count], vectors[:, :count]
        if basis.shape[1] + watched > max(LARGEST_BASIS, 3 * watched):
            keep = 2 * watched
            basis, images = vectors[:, :keep], products[:, :keep]
        open_ = np.flatnonzero(~exact[:count])
        if not len(open_) or not guarded:
            open_ = np.concatenate([open_, count + np.flatnonzero(norms[count:] > COARSE)])
        shifts, fixed = values[open_], vectors[:, np.flatnonzero(locked[:count])]
        own = vectors[:, open_]

        def aside(block: np.ndarray, fixed=fixed, own=own) -> np.ndarray:
            block = block - fixed @ (fixed.T @ block)
            return block - own * (own * block).sum(axis=0)

        def corrected(block: np.ndarray, shifts=shifts, aside=aside) -> np.ndarray:
            block = aside(block)
            return aside(times(block) - block * shifts)

        step = _minres(corrected, aside(-residuals[:, open_]), INNER)
        more = _outside(np.column_stack([aside(step), residuals[:, open_]])[:, : len(open_)], basis)
        if not more.shape[1]:
            more = _outside(draws.standard_normal((dims, len(open_))), basis)
        basis, images = np.column_stack([basis, more]), np.column_stack([images, times(more)])
    raise ArithmeticError(f"no convergence in {ROUNDS} rounds: residuals {norms[:count]}")


def _about(whole: DataFrame) -> tuple[DataFrame, int, int, np.ndarray]:
    """The fit list (stored), its size, the number of dimensions, exact sums per dimension."""
    fit = written(whole.select("x").distinct(), "whitening-fit")
    n, dims = fit.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    places = fit.select(F.posexplode("x").alias("place", "entry")).groupBy("place").agg(F.sum("entry").alias("total"))
    sums = np.zeros(dims or 0, np.int64)
    for place, total in places.toPandas().itertuples(index=False):
        sums[place] = total
    return fit, n, dims or 0, sums


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Per row the exact sum of squares of n*x - S; None where it takes over 63 bits."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max((abs(int(s)) for s in sums), default=0)
    if most * most * max(1, len(sums)) < 2**63:
        return ((n * x - sums) ** 2).sum(axis=1).tolist()
    exact = [sum((n * a - b) ** 2 for a, b in zip(row, sums.tolist(), strict=True)) for row in x.tolist()]
    return [v if v < 2**63 else None for v in exact]


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable row of ``rows`` and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    ``rows`` has vec_id and embedding; other columns are not read. Rows whose vector is NULL or holds
    a NULL, NaN or infinite entry are left out. The covariance is that of the distinct vectors in
    whole numbers; rows that repeat a vector or a vec_id are each returned. Shorter vectors count as
    if they ended in zeros. ``deviation`` is NULL where it does not fit 64 bits. Directions without
    variance are no components, so a table of few distinct vectors has fewer of them, and one with
    a single distinct vector, or an empty one, gives no rows.
    """
    whole = cut(whole_vectors(rows))
    fit, n, dims, sums = _about(whole)
    empty = rows.sparkSession.createDataFrame([], RESULT)
    if n < 2 or not dims:
        return empty
    mean = sums / n

    def times(block: np.ndarray) -> np.ndarray:
        width = block.shape[1]

        def measure(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ block)

        return _summed(fit, dims * width, dims, measure).reshape(dims, width) / n

    trace = float(_summed(fit, dims, dims, lambda x: ((x - mean) ** 2).sum(axis=0)).sum()) / n
    if not trace:
        return empty
    values, vectors = leading_pairs(times, dims, components)
    real = values > NOTHING * max(values[0], trace)
    values, vectors = values[real], vectors[:, real]
    k = len(values)
    onto = vectors / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        z = (x - mean) @ onto
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

    found = _summed(fit, k + k * k, dims, moments) / n
    spread = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
    error = float(np.abs(spread - np.eye(k)).max())
    shares = values / trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 2048):
            x, size = _matrix(batch.column(1), dims), batch.num_rows
            z = (x - mean) @ onto
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(size), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                pa.array(np.full(size * k, n, np.int64)),
                pa.array(_deviation(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(size), k))),
                pa.array(z.ravel()),
                pa.array(np.tile(shares, size)),
                pa.array(np.full(size * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return whole.select("vec_id", "x").mapInArrow(project, RESULT)
