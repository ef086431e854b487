"""Centroid clustering with Orchard's search.

Each centroid has the list of the others in order of their distance. A vector walks the list of its best centroid so far:
a closer one that it finds takes over, with its own list from the start; a centroid once visited is not measured again; and
the walk ends at a centroid strictly further than twice the current distance, beyond which the triangle inequality leaves
nothing as near. All the vectors of a block walk together, in integers, so ties are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import LARGEST, blocks, entries, finite, scaled, summed

WIDTH, SCALE, CENTROIDS, ROUNDS = 64, 1024, 8, 10
#: Vectors that walk together.
TOGETHER = 8192


class Search:
    """Nearest centroids; ties go to the smaller number."""

    def __init__(self, centroids: np.ndarray):
        self.centroids, k = centroids, len(centroids)
        apart = np.array([[((a - b) ** 2).sum() for b in centroids] for a in centroids], np.int64).reshape(k, k)
        order = np.argsort(apart, axis=1, kind="stable")
        self.neighbours = np.array([[j for j in row if j != i] for i, row in enumerate(order)], np.int64).reshape(k, k - 1)
        self.apart = np.take_along_axis(apart, self.neighbours, axis=1)

    def _distance(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        gap = x - self.centroids[at]
        return np.einsum("ij,ij->i", gap, gap)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest centroid of each row of x, and the squared distance."""
        parts = [self._walk(x[i : i + TOGETHER]) for i in range(0, len(x), TOGETHER)]
        return tuple(np.concatenate(p) for p in zip(*parts)) if parts else (np.empty(0, np.int64), np.empty(0, np.int64))

    def _walk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, k = len(x), len(self.centroids)
        best, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
        least = self._distance(x, best)
        visited = np.zeros((n, k), bool)
        visited[:, 0] = True
        walking = np.arange(n) if k > 1 else np.empty(0, np.int64)
        while len(walking):
            at, there = best[walking], place[walking]
            on = (self.apart[at, there] + 3) // 4 <= least[walking]  # apart <= 4 * least, without an overflow
            walking, at, there = walking[on], at[on], there[on]
            other = self.neighbours[at, there]
            new = ~visited[walking, other]
            place[walking] += 1
            w, o = walking[new], other[new]
            visited[w, o] = True
            d = self._distance(x[w], o)
            closer = (d < least[w]) | ((d == least[w]) & (o < best[w]))
            w = w[closer]
            best[w], least[w], place[w] = o[closer], d[closer], 0
            walking = walking[place[walking] < k - 1]
        return best, least


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of `<seed>:<vec_id>`, in that order; null vec_ids come last, ties by the vector."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return np.array([r["x"] for r in kept.orderBy(order.asc_nulls_last(), "x").limit(k).select("x").collect()], np.int64)


def moved(packed: DataFrame, width: int, centroids: np.ndarray) -> np.ndarray:
    """Each centroid's floored mean of the vectors nearest to it; one without vectors stays."""
    search, k = Search(centroids), len(centroids)

    def add(x: np.ndarray) -> np.ndarray:
        mine, _ = search.nearest(x)
        out = np.zeros((k, 1 + width), np.int64)
        for c in range(k):
            own = x[mine == c]
            out[c, 0], out[c, 1:] = len(own), own.sum(axis=0)
        return out

    found = summed(packed, width, add, "long").reshape(k, 1 + width)
    return np.where(found[:, :1] > 0, found[:, 1:] // np.maximum(found[:, :1], 1), centroids)


def inertias(packed: DataFrame, width: int, centroids: np.ndarray) -> np.ndarray:
    """The squared distances to the nearest centroid, summed over each cluster."""
    search, k = Search(centroids), len(centroids)

    def add(x: np.ndarray) -> np.ndarray:
        mine, least = search.nearest(x)
        return np.array([least[mine == c].sum() for c in range(k)], np.int64)

    return summed(packed, width, add, "long")


def cluster(rows: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: int = 3) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each kept row of rows (vec_id, embedding).

    Kept are vectors of exactly `width` entries, none null or non-finite; an entry c becomes floor(scale * c). More
    columns are ignored; repeated rows and null vec_ids have rows of their own. With fewer than k vectors each is a
    centroid, equal ones too (the smaller number then takes all). An empty table gives an empty result; entries of 2^27
    and more (scaled) are an error. Rounds end early once no centroid moves, which changes nothing.
    """
    spark, kind = rows.sparkSession, rows.schema["vec_id"].dataType.simpleString()
    out = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    kept = rows.where(finite("embedding") & (F.size("embedding") == width)).select("vec_id", scaled("embedding", scale).alias("x"))
    most = kept.agg(F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x"))))).first()[0]
    if most is None:
        return spark.createDataFrame([], out)
    if most >= LARGEST:
        raise ValueError(f"there are entries of {most}, above {LARGEST}")
    packed = blocks(kept, width)
    centroids = first_centroids(kept, k, seed)
    for _ in range(rounds):
        after = moved(packed, width, centroids)
        if (after == centroids).all():
            break
        centroids = after
    search, each = Search(centroids), inertias(packed, width, centroids)
    total, names = int(each.sum()), [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine, least = search.nearest(entries(batch, "x", width))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), pa.array(mine.astype(np.int32)), pa.array(least), pa.array(each[mine]), pa.array(np.full(len(mine), total, np.int64)), pa.array(names, pa.string()).take(pa.array(mine)),
            ], names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return kept.mapInArrow(assign, out)


def op13(spark, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
