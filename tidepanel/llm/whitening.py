"""Embedding whitening by Chebyshev-filtered subspace iteration.

The covariance V of the distinct integer vectors is never formed: a block Q of columns is multiplied by it in a pass over
the table, in which each task adds up its centred X'(XQ). A polynomial recurrence of such passes damps the unwanted part
of the spectrum, QR makes the block orthonormal, and Rayleigh-Ritz turns it to the components and their eigenvalues, again
and again until the residuals certify them. A few Lanczos steps give the lower end of the spectrum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import LARGEST, blocks, entries, finite, scaled, summed

COMPONENTS, SCALE = 4, 256
#: Columns of the block besides the wanted ones, the filter's degree, Lanczos steps, and rounds at most.
GUARDS, DEGREE, STEPS, ROUNDS = 12, 10, 8, 200
#: Residuals relative to the largest eigenvalue: those below CERTIFIED are good, and are driven down until they stay.
CERTIFIED = 1e-11
#: Eigenvalues below this share of the largest are zero.
ZERO = 1e-12


@dataclass
class Spectrum:
    n: int
    sums: np.ndarray  # of each dimension, longs
    trace: float
    values: np.ndarray  # falling eigenvalues
    columns: np.ndarray  # dimensions x components, unit columns
    residual: float  # the largest, relative to the largest eigenvalue
    passes: int


class Covariance:
    """Products with the covariance of a table of blocks, one pass each."""

    def __init__(self, packed: DataFrame, width: int):
        self.packed, self.width, self.passes = packed, width, 0
        first = summed(packed, width, lambda x: np.concatenate([[len(x)], x.sum(axis=0)]), "long")
        self.n, self.sums = int(first[0]), first[1:]
        self.mean = np.array([int(s) / self.n for s in self.sums])

    def run(self, of, size: tuple[int, ...]) -> np.ndarray:
        mean = self.mean
        self.passes += 1
        return summed(self.packed, self.width, lambda x: of(x - mean)).reshape(size) / self.n

    def trace(self) -> float:
        return float(self.run(lambda c: np.array([np.einsum("ij,ij->", c, c)]), (1,))[0])

    def times(self, q: np.ndarray) -> np.ndarray:
        return self.run(lambda c: c.T @ (c @ q), q.shape)

    def of_projected(self, q: np.ndarray) -> np.ndarray:
        """The covariance of the projections on q."""

        def both(c: np.ndarray) -> np.ndarray:
            p = c @ q
            return np.concatenate([p.sum(axis=0), (p.T @ p).ravel()])

        k = q.shape[1]
        found = self.run(both, (k + k * k,))
        return found[k:].reshape(k, k) - np.outer(found[:k], found[:k])


def lower_end(v: Covariance, rng: np.random.Generator, steps: int) -> float:
    """A value at or below the smallest eigenvalue, as a few Lanczos steps see it: the least Ritz value less its residual."""
    q, before, beta, alphas, betas, basis = rng.normal(size=v.width), 0, 0.0, [], [], []
    q /= np.linalg.norm(q)
    for _ in range(min(steps, v.width)):
        basis.append(q)
        w = v.times(q[:, None])[:, 0] - beta * before
        alphas.append(float(w @ q))
        w -= alphas[-1] * q
        for b in basis:  # rounding is taken out again
            w -= (w @ b) * b
        before, beta = q, float(np.linalg.norm(w))
        if beta <= ZERO * max(map(abs, alphas)):
            beta = 0.0
            break
        betas.append(beta)
        q = w / beta
    k = len(alphas)
    values, vectors = np.linalg.eigh(np.diag(alphas) + np.diag(betas[: k - 1], 1) + np.diag(betas[: k - 1], -1))
    return max(0.0, float(values[0] - beta * abs(vectors[-1, 0])))


def filtered(v: Covariance, q: np.ndarray, vq: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial that stays small on [low, high], scaled to one at `top`, applied to q; vq is V times q."""
    half, centre = (high - low) / 2, (high + low) / 2
    first = half / (top - centre)
    sigma, before, now = first, q, (vq - centre * q) * (first / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        now, before = (v.times(now) - centre * now) * (2 * after / half) - sigma * after * before, now
        sigma = after
    return now


def leading(packed: DataFrame, width: int, components: int = COMPONENTS, guards: int = GUARDS, degree: int = DEGREE, seed: int = 12) -> Spectrum:
    """The largest eigenvalues of the covariance of the blocks' vectors, and their unit vectors."""
    v, rng = Covariance(packed, width), np.random.default_rng(seed)
    trace, wanted = v.trace(), min(components, width)
    if trace <= 0:
        return Spectrum(v.n, v.sums, 0.0, np.zeros(wanted), np.eye(width)[:, :wanted], 0.0, v.passes)
    size = min(width, wanted + guards)
    low = lower_end(v, rng, STEPS) if size < width else 0.0
    q = np.linalg.qr(rng.normal(size=(width, size)))[0]
    best = None
    for _ in range(ROUNDS):
        vq = v.times(q)
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        residual = float(np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max() / values[0])
        better = best is None or residual < best[0]
        stays = best is not None and best[0] <= CERTIFIED and residual > best[0] / 4
        if better:
            best = (residual, values[:wanted].copy(), q[:, :wanted].copy())
        if size == width or stays:
            break
        high = float(values[-1])
        low = min(low, high)
        if high - low > 1e-9 * values[0]:
            q = filtered(v, q, vq, low, high, float(values[0]), degree)
        else:  # the rest of the spectrum is one value, or zero: a product shifted by it leaves the wanted part alone
            q = vq - high * q
        q = np.linalg.qr(q)[0]
    if best[0] > CERTIFIED:
        raise ArithmeticError(f"the components are not certified: a residual of {best[0]:.1e}")
    residual, values, columns = best
    columns /= np.linalg.norm(columns, axis=0)
    columns *= np.sign(columns[np.abs(columns).argmax(axis=0), range(wanted)])
    return Spectrum(v.n, v.sums, trace, values, columns, residual, v.passes)


def whiten(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each kept row of rows (vec_id, embedding) and component.

    Rows whose vector is null or holds a null or non-finite entry are dropped; more columns are ignored; repeated rows and
    null vec_ids have rows of their own. Entries become floor(scale * c), and the distinct vectors are the fit list.
    Vectors shorter than the longest are filled with zeros. There are as many components as dimensions when these are
    fewer. A component without variance has the whitened value null, and identity_error is over the others. deviation is
    null where it doesn't fit a long. An empty table, or one of empty vectors, gives an empty result; entries of 2^27 and
    more (scaled) are an error.
    """
    spark, kind = rows.sparkSession, rows.schema["vec_id"].dataType.simpleString()
    out = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    kept = rows.where(finite("embedding")).select("vec_id", scaled("embedding", scale).alias("x"))
    width, most = kept.agg(F.max(F.size("x")), F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x"))))).first()
    if not width:
        return spark.createDataFrame([], out)
    if most >= LARGEST:
        raise ValueError(f"there are entries of {most}, above {LARGEST}")
    kept = kept.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))))
    packed = blocks(kept.select("x").distinct(), width)
    found = leading(packed, width, components)
    live = found.values > ZERO * max(found.values[0], 1e-300)
    turn = found.columns[:, live] / np.sqrt(found.values[live])
    error = float(np.abs(Covariance(packed, width).of_projected(turn) - np.eye(turn.shape[1])).max()) if live.any() else 0.0
    n, sums, k = found.n, found.sums, len(found.values)
    mean = np.array([int(s) / n for s in sums])
    explained = found.values / found.trace if found.trace else np.zeros(k)
    exact = width * (n * int(most) + int(np.abs(sums).max())) ** 2 < 1 << 63

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = entries(batch, "x", width)
            apart = (n * x if exact else n * x.astype(object)) - sums
            deviation = (apart * apart).sum(axis=1)
            deviation = pa.array(deviation if exact else [d if d < 1 << 63 else None for d in deviation], pa.int64())
            white = np.full((len(x), k), np.nan)
            white[:, live] = (x - mean) @ turn
            each, many = np.repeat(np.arange(len(x)), k), len(x) * k
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(many, n, np.int64)),
                deviation.take(pa.array(each)), pa.array(white.ravel(), from_pandas=True), pa.array(np.tile(explained, len(x))), pa.array(np.full(many, error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return kept.mapInArrow(project, out)


def op12(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
