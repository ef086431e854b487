"""Whitening and clustering of embeddings against brute force."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.llm import orchard, vectors, whitening

SCHEMA = "vec_id long, embedding array<float>, component int, n string, distance long, x double, block binary"


def table(spark, values):
    return spark.createDataFrame([(i, v, 7, "n", 1, 0.5, b"") for i, v in values], SCHEMA).repartition(3)


def odd_rows(width):
    return [(900, None), (901, [math.nan] + [0.0] * (width - 1)), (902, [None] + [0.1] * (width - 1)), (903, [math.inf] + [0.1] * (width - 1))]


def values(rng, n, width, spread):
    made = (rng.normal(size=(n, width)) * spread).astype(np.float32)
    out = [(i, v.tolist()) for i, v in enumerate(made)]
    return out + [(i, out[0][1]) for i in range(n, n + n // 2)] + [(None, out[1][1]), (2, out[2][1])]  # a hot vector, a null id, a repeated row


def plain_whitening(kept, k):
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for _, v in kept])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    cov = centred.T @ centred / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ q / np.sqrt(e), e / np.trace(cov)


@pytest.mark.parametrize("width, n", [(40, 300), (40, 25), (6, 100), (3, 50)])
def test_whitening_against_eigenvectors(spark, width, n):
    rng = np.random.default_rng(n)
    kept = values(rng, n, width, np.linspace(0.05, 0.3, width))
    got = whitening.whiten(table(spark, kept + odd_rows(width)))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    k = min(4, width)
    size, deviation, white, explained = plain_whitening(kept, k)
    want = sorted(((-1 if i is None else i), c + 1, size, int(deviation[r])) for r, (i, _) in enumerate(kept) for c in range(k))
    found = got.collect()
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.component, r.n, r.deviation) for r in found) == want
    row = {i: r for r, (i, _) in reversed(list(enumerate(kept)))}
    for c in range(k):
        mine = [(r, white[row[r.vec_id], c]) for r in found if r.component == c + 1]
        sign = np.sign(sum(r.whitened * w for r, w in mine))
        assert np.allclose([r.whitened for r, _ in mine], [sign * w for _, w in mine], atol=1e-7)
        assert mine[0][0].explained == pytest.approx(explained[c], rel=1e-9)
    assert {r.identity_error for r in found} == {found[0].identity_error} and found[0].identity_error < 1e-7


def test_whitening_of_odd_tables(spark):
    assert whitening.whiten(table(spark, [])).count() == 0 and whitening.whiten(table(spark, odd_rows(5))).count() == 0
    assert whitening.whiten(table(spark, [(1, []), (2, [])])).count() == 0
    same = whitening.whiten(table(spark, [(1, [0.5] * 6), (2, [0.5] * 6)])).collect()
    assert len(same) == 8 and {(r.n, r.deviation, r.whitened, r.explained) for r in same} == {(1, 0, None, 0.0)}
    line = whitening.whiten(table(spark, [(i, [i / 8] * 20) for i in range(9)])).collect()  # one component with variance
    assert len(line) == 36 and all((r.whitened is None) == (r.component > 1) for r in line)
    assert [r.explained for r in line if r.component == 1] == pytest.approx([1.0] * 9) and line[0].identity_error < 1e-9
    short = whitening.whiten(table(spark, [(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0]), (3, [0.0]), (4, [])])).collect()
    assert len(short) == 12 and {r.n for r in short} == {3}
    with pytest.raises(ValueError):
        whitening.whiten(table(spark, [(1, [1e30, 1.0])]))


def test_a_flat_end_and_equal_eigenvalues(spark):
    """Vectors along the axes: many equal eigenvalues, so components are any basis of theirs; they must still whiten."""
    rows = [(2 * i + s, [(2.0 if i < 3 else 1.0) * (1 - 2 * s) * (j == i) for j in range(30)]) for i in range(30) for s in (0, 1)]
    got = whitening.whiten(table(spark, rows)).collect()
    assert got[0].identity_error < 1e-9
    explained = [next(r.explained for r in got if r.component == c) for c in (1, 2, 3, 4)]
    assert explained == pytest.approx([4 / 39] * 3 + [1 / 39], rel=1e-9)


def test_long_vectors_come_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 64)
    kept = spark.range(10).select(F.array(*[F.col("id") * k for k in (1, -2, 3)]).alias("x"))
    packed = vectors.blocks(kept, 3)
    assert packed.count() >= 5
    assert vectors.summed(packed, 3, lambda x: x.sum(axis=0), "long").tolist() == [45, -90, 135]


def plain_clusters(kept, k=8, rounds=10):
    x = [(i, [math.floor(1024 * float(np.float32(c))) for c in v]) for i, v in kept]
    order = sorted(x, key=lambda r: ((1, "") if r[0] is None else (0, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest()), r[1]))
    centroids = [v for _, v in order[:k]]
    gap = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    nearest = lambda v: min((gap(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        mine = [nearest(v)[1] for _, v in x]
        for j in range(len(centroids)):
            own = [v for (_, v), m in zip(x, mine) if m == j]
            if own:
                centroids[j] = [sum(c) // len(own) for c in zip(*own)]
    found = [nearest(v) for _, v in x]
    each = [sum(d for d, j in found if j == c) for c in range(len(centroids))]
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, j, d, each[j], sum(each), name[j]) for (i, _), (d, j) in zip(x, found)]


@pytest.mark.parametrize("n, spread", [(200, 0.3), (60, 0.002), (5, 0.3)])
def test_clusters_against_brute_force(spark, n, spread):
    kept = values(np.random.default_rng(n), n, 64, spread)  # the small spread makes ties
    wrong = [(910, [0.1] * 63), (911, [0.1] * 65), (912, [])]
    got = orchard.cluster(table(spark, kept + odd_rows(64) + wrong))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain_clusters(kept)))


def test_clusters_of_odd_tables(spark):
    assert orchard.cluster(table(spark, [])).count() == 0 and orchard.cluster(table(spark, odd_rows(64))).count() == 0
    one = orchard.cluster(table(spark, [(1, [0.5] * 64)])).collect()
    assert [(r.cluster, r.distance, r.inertia) for r in one] == [(0, 0, 0)]
    with pytest.raises(ValueError):
        orchard.cluster(table(spark, [(1, [1e9] * 64)]))


def test_orchard_search_against_all_distances():
    rng = np.random.default_rng(2)
    for k, width, top in ((1, 3, 9), (2, 3, 9), (40, 2, 12), (60, 5, 1000)):
        centroids, x = rng.integers(-top, top, (k, width)), rng.integers(-top, top, (500, width))
        search = orchard.Search(centroids)
        measured = []
        plain, search._distance = search._distance, lambda a, at: measured.append(len(a)) or plain(a, at)
        best, least = search.nearest(x)
        apart = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
        assert (best == apart.argmin(axis=1)).all() and (least == apart.min(axis=1)).all()
        if k >= 40:
            assert sum(measured) < 0.8 * apart.size  # the walk ends early
