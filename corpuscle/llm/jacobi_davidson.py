"""Whitening by a matrix-free Jacobi-Davidson iteration.

The covariance is never formed.  The rows stay on the executors and one distributed
pass multiplies it with a block of directions: centre a row, project it, add the row
times its projections up.  The driver holds the search space and works on it alone:

* Rayleigh-Ritz picks the best directions in the space,
* the correction equation of every open one, projected off the locked ones and off
  itself, is solved roughly by MINRES; all equations take their steps together, so a
  step is one pass for all of them,
* the corrections widen the space, and directions whose residual is down to rounding
  are locked and projected out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import Stage, finite, matrix, scaled, total

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LIMIT = 1 << 40          # scaled entries beyond it are held there
SPARE = 4                # directions in the first space beyond those asked for
ROOM = 4                 # the space is cut back at so many times the directions asked for
INNER = 12               # MINRES steps of a correction at most
ROUNDING = 1e-14         # of the largest eigenvalue: a residual this small is rounding
FLAT = 1e-12             # of the trace: directions with less variance are none
SEED = 11

Product = Callable[[np.ndarray], np.ndarray]


def orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the block's part outside ``against``; dependent directions go."""
    kept: list[np.ndarray] = []
    for column in block.T:
        before = np.linalg.norm(column)
        if before == 0 or not np.isfinite(before):
            continue
        column = column / before
        lost = False
        for _ in range(3):
            length = np.linalg.norm(column)
            if against.shape[1]:
                column = column - against @ (against.T @ column)
            for other in kept:
                column = column - other * (other @ column)
            left = np.linalg.norm(column)
            if left < 1e-10 * length:
                lost = True
                break
            column = column / left
        if not lost:
            kept.append(column)
    return np.array(kept).T if kept else np.zeros((len(block), 0))


def minres(times: Product, right: np.ndarray, enough: np.ndarray, steps: int) -> np.ndarray:
    """Solve one symmetric system per column, all in step; ``times`` maps a block of columns.

    Column j ends when its residual is below ``enough[j]``; a column that has ended
    rides along as zeros.
    """
    x = np.zeros_like(right)
    w, w2 = np.zeros_like(right), np.zeros_like(right)
    r1, r2, y = right.copy(), right.copy(), right.copy()
    beta = np.linalg.norm(right, axis=0)
    old_beta, bar, eps, sine = (np.zeros_like(beta) for _ in range(4))
    cosine, residual = -np.ones_like(beta), beta.copy()
    open_ = beta > enough
    for step in range(steps):
        if not open_.any():
            break
        v = np.where(open_, y / np.where(beta > 0, beta, 1), 0)
        y = times(v)
        if step:
            y = y - r1 * (beta / np.where(old_beta > 0, old_beta, 1))
        alpha = (v * y).sum(axis=0)
        y = y - r2 * (alpha / np.where(beta > 0, beta, 1))
        r1, r2 = r2, y
        old_beta, beta = beta, np.linalg.norm(y, axis=0)
        old_eps = eps
        delta = cosine * bar + sine * alpha
        gamma_bar = sine * bar - cosine * alpha
        eps, bar = sine * beta, -cosine * beta
        gamma = np.maximum(np.hypot(gamma_bar, beta), 1e-300)
        cosine, sine = gamma_bar / gamma, beta / gamma
        phi, residual = cosine * residual, sine * residual
        w, w1, w2 = (v - old_eps * w2 - delta * w) / gamma, w2, w
        x = x + np.where(open_, phi * w, 0)
        open_ &= (residual > enough) & (beta > 1e-14 * np.abs(alpha))
    return x


def largest(times: Product, size: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns."""
    wanted = min(wanted, size)
    none = np.zeros((size, 0))
    locked = none
    space = orthonormal(np.random.default_rng(SEED).normal(size=(size, min(size, wanted + SPARE))), none)
    image = times(space)
    top, best, stuck = 0.0, np.inf, 0
    while True:
        small = space.T @ image
        values, mix = np.linalg.eigh((small + small.T) / 2)
        values, mix = values[::-1], mix[:, ::-1]
        space, image = space @ mix, image @ mix
        top = max(top, abs(values[0]) if len(values) else 0.0)
        missing = wanted - locked.shape[1]
        rest = image[:, :missing] - space[:, :missing] * values[:missing]
        rest = rest - locked @ (locked.T @ rest)
        norms = np.linalg.norm(rest, axis=0)
        done = norms <= ROUNDING * top
        stuck = stuck + 1 if norms.max() > 0.5 * best else 0
        best = min(best, norms.max())
        if stuck >= 3 and best <= 100 * ROUNDING * top:
            done[:] = True          # rounding of the products: no step makes it smaller
        lead = int(np.argmin(done)) if not done.all() else len(done)
        if lead:
            locked = np.concatenate([locked, space[:, :lead]], axis=1)
            space, image = space[:, lead:], image[:, lead:]
            rest, norms, values = rest[:, lead:], norms[lead:], values[lead:]
            best, stuck = np.inf, 0
        if locked.shape[1] == wanted:
            break
        if space.shape[1] > ROOM * wanted:
            space, image = space[:, :wanted + SPARE], image[:, :wanted + SPARE]
        go = np.flatnonzero(norms > ROUNDING * top)
        aim, shift = space[:, go], values[go]

        def project(block: np.ndarray) -> np.ndarray:
            block = block - locked @ (locked.T @ block)
            return block - aim * (aim * block).sum(axis=0)

        def shifted(block: np.ndarray) -> np.ndarray:
            block = project(block)
            return project(times(block) - block * shift)

        step = minres(shifted, -project(rest[:, go]), 0.05 * norms[go], INNER)
        old = np.concatenate([locked, space], axis=1)
        new = orthonormal(np.concatenate([step, rest[:, go]], axis=1)[:, :len(go)], old)
        if not new.shape[1]:        # the space is closed: try the residuals, else it is everything
            new = orthonormal(rest, old)
        if not new.shape[1]:
            new = orthonormal(np.random.default_rng(SEED + old.shape[1]).normal(size=(size, 1)), old)
        if not new.shape[1]:
            locked = np.concatenate([locked, space[:, :wanted - locked.shape[1]]], axis=1)
            break
        space, image = np.concatenate([space, new], axis=1), np.concatenate([image, times(new)], axis=1)
    # Once more on the locked ones alone, with a fresh product.
    small = locked.T @ times(locked)
    values, mix = np.linalg.eigh((small + small.T) / 2)
    return values[::-1].copy(), (locked @ mix)[:, ::-1].copy()


class Fit:
    """Centre, components and variances of the distinct rows of one length."""

    def __init__(self, distinct: DataFrame, size: int, wanted: int):
        self.size = size
        sums = total(distinct, "x", lambda x: np.append(x.sum(axis=0), len(x)), "long")
        self.n, self.sums = int(sums[-1]), [int(s) for s in sums[:-1]]
        whole, part = zip(*(divmod(s, self.n) for s in self.sums))
        self.whole = np.array(whole, dtype=np.int64)
        self.part = np.array([p / self.n for p in part])
        centred, n = self.centred, self.n
        self.trace = float(total(distinct, "x", lambda x: np.array([(centred(x) ** 2).sum()]))[0]) / n
        self.values, self.vectors, self.error = np.zeros(0), np.zeros((size, 0)), 0.0
        if self.trace == 0:
            return

        def times(block: np.ndarray) -> np.ndarray:
            def work(x: np.ndarray) -> np.ndarray:
                z = centred(x)
                return (z.T @ (z @ block)).ravel()
            return total(distinct, "x", work).reshape(size, -1) / n

        values, vectors = largest(times, size, wanted)
        keep = values > FLAT * self.trace
        self.values, self.vectors = values[keep], vectors[:, keep]
        whitened, k = self.whitened, len(self.values)
        mean = total(distinct, "x", lambda x: whitened(x).sum(axis=0)) / n

        def spread(x: np.ndarray) -> np.ndarray:
            w = whitened(x) - mean
            return (w.T @ w).ravel()
        self.error = float(np.abs(total(distinct, "x", spread).reshape(k, k) / n - np.eye(k)).max())

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: whole numbers first, so that nothing is lost to the size of x."""
        return (x - self.whole) - self.part

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n*x - S)^2 in whole numbers; null beyond a long."""
        rough = ((self.centred(x) * self.n) ** 2).sum(axis=1)
        if self.n * float(np.abs(x).max(initial=1)) < 2.0 ** 61 and rough.max(initial=0) < 2.0 ** 62:
            d = x * np.int64(self.n) - np.array(self.sums, dtype=np.int64)
            return (d * d).sum(axis=1).tolist()
        exact = [sum((self.n * a - s) ** 2 for a, s in zip(row, self.sums)) for row in x.tolist()]
        return [d if d < 1 << 63 else None for d in exact]


def whiten(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: ``key``, ``component``, ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``.

    Vectors that are null or hold null or non-finite entries give no row, nor do empty
    ones.  Vectors of each length are a fit of their own.  Equal vectors are one in the
    fit; every row is projected, repeated rows and null keys too.  Directions without
    variance (less than 1e-12 of the trace) have no whitened value and are left out, so
    a table of equal vectors gives no rows.  Scaled entries beyond 2^40 are held there;
    a deviation beyond a long is null.
    """
    spark = vectors.sparkSession
    stage = Stage(spark)
    rows = stage.write(vectors.where(finite(F.col(embedding)) & (F.size(embedding) > 0)).select(
        F.col(key).alias("id"), F.transform(scaled(F.col(embedding), SCALE, LIMIT), lambda c: c + SHIFT).alias("x")))
    distinct = stage.write(rows.select("x").distinct())
    parts = []
    for (size,) in sorted(rows.select(F.size("x")).distinct().collect()):
        fit = Fit(distinct.where(F.size("x") == size), size, components)
        if len(fit.values):
            parts.append(_project(rows.where(F.size("x") == size), fit))
    stage.drop(distinct)
    if not parts:
        parts.append(spark.createDataFrame([], f"id {rows.schema['id'].dataType.simpleString()}, {PROJECTED}"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.select(F.col("id").alias(key), "component", "n", "deviation", "whitened", "explained", "identity_error")


PROJECTED = "component INT, n BIGINT, deviation BIGINT, whitened DOUBLE, explained DOUBLE, identity_error DOUBLE"


def _project(rows: DataFrame, fit: Fit) -> DataFrame:
    key = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                x = matrix(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(fit.deviation(x), pa.int64()),
                     pa.array(fit.whitened(x).tolist(), pa.list_(pa.float64()))],
                    names=["id", "deviation", "whitened"])

    found = rows.select("id", "x").mapInArrow(run, f"id {key}, deviation BIGINT, whitened ARRAY<DOUBLE>")
    share = F.array(*[F.lit(float(e / fit.trace)) for e in fit.values])
    return found.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "id", (F.col("at") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(share, F.col("at") + 1).alias("explained"), F.lit(fit.error).alias("identity_error"))
